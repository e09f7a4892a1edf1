"""Quality rules as a learned decision list, in DataFrame operations only.

Sequential covering: a rule is grown as a conjunction of thresholds, each the
one with the largest information gain on two thirds of the labelled rows, and
pruned from its end while that does better on the other third. Rows it covers
are set aside and the next rule is learned from the rest. The ordered rules
become one conditional expression. Every step is one small aggregate over
binned statistics, of which the driver sees a histogram of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import SPACES, WORD, stored

#: Base rules: at least so many words, and at most so many percent of them in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
RUN = 8
SYMBOLS = "#*$%&|<>"
#: Labelled rows to learn from, at most (about); chosen by a hash of their ids.
SAMPLE = 60_000
CUTS = 24
MOST_RULES = 10
MOST_CONDITIONS = 4
#: A rule has to be so sure of rejecting on rows it wasn't grown on, so that clean documents stay.
PRECISION = 0.97
LEAST_ROWS = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeated(hashes: str) -> Column:
    """How many words lie in a window whose digest comes up again, from sorted (digest, place) pairs.

    Neighbours are paired by shifting arrays, so the work is that of one sort.
    """
    ranked = f"array_sort(transform({hashes}, (h, i) -> struct(h AS h, i AS i)))"
    paired = f"zip_with({ranked}, slice({ranked}, 2, size({hashes})), (x, y) -> struct(x.i AS i, x.h = y.h AS same, y.i AS other))"
    places = f"array_sort(array_distinct(flatten(transform(filter({paired}, p -> p.same), p -> array(p.i, p.other)))))"
    return F.expr(places)


def with_statistics(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` and a struct column ``into`` of counts, one row for each row; a null text has none of anything."""
    t = [f"{into}_{k}" for k in range(6)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.withColumn(t[0], text)
    step = step.withColumn(t[1], F.filter(F.split(t[0], SPACES), lambda w: w != ""))
    lines = F.filter(F.split(t[0], "\n"), lambda line: line.rlike(WORD))
    step = step.withColumns({t[2]: F.transform(t[1], lambda w: F.xxhash64(w)), t[5]: lines})
    windows = f"transform(sequence(1, size({t[2]}) - {RUN - 1}), i -> xxhash64(slice({t[2]}, i, {RUN})))"
    # Two references each to the arrays that lambdas look into keep Spark from working those out anew per element.
    step = step.withColumn(t[3], F.expr(f"CASE WHEN size({t[2]}) >= {RUN} THEN {windows} ELSE array() END"))
    again = F.size(F.array_distinct(t[3])) < F.size(t[3])
    step = step.withColumn(t[4], F.when(again, _repeated(t[3])).otherwise(F.expr("CAST(array() AS array<int>)")))
    covered = F.expr(
        f"aggregate(zip_with({t[4]}, slice({t[4]}, 2, size({t[4]})), (a, b) -> coalesce(least(b - a, {RUN}), {RUN})),"
        " 0L, (total, n) -> total + n)"
    )
    size = F.length(t[0])
    counts = F.struct(
        F.size(t[1]).cast("long").alias("n_words"),
        F.length(F.array_join(t[1], "")).cast("long").alias("word_chars"),
        (size - _without(F.col(t[0]), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(t[5]) - F.size(F.array_distinct(t[5]))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        size.cast("long").alias("chars"),
        (size - _without(F.col(t[0]), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("upper"),
        (size - _without(F.col(t[0]), "!?")).cast("long").alias("marks"),
        (size - _without(F.col(t[0]), "0123456789")).cast("long").alias("digits"),
        F.size(F.array_distinct(t[1])).cast("long").alias("distinct_words"),
    )
    return step.withColumn(into, counts).drop(*t)


def features(stats: str) -> dict[str, Column]:
    """Whole numbers that conditions may test, by name; ratios are per mille, and zero where nothing is counted."""
    s = {name: F.col(f"{stats}.{name}") for name in (*COUNTS, "chars", "upper", "marks", "digits", "distinct_words")}

    def ratio(part: str, whole: str) -> Column:
        return F.when(s[whole] > 0, F.floor(1000 * s[part] / s[whole])).otherwise(F.lit(0)).cast("long")

    return {
        "n_words": s["n_words"],
        "n_dup_lines": s["n_dup_lines"],
        "word_length": ratio("word_chars", "n_words"),
        "symbols": ratio("n_symbols", "chars"),
        "repeated": ratio("n_repeat_words", "n_words"),
        "upper": ratio("upper", "chars"),
        "marks": ratio("marks", "n_words"),
        "digits": ratio("digits", "chars"),
        "distinct": ratio("distinct_words", "n_words"),
    }


def base_failed(stats: str) -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold}"

    def column(self, values: dict[str, Column]) -> Column:
        return values[self.feature] >= self.threshold if self.at_least else values[self.feature] < self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects a row, and a row that none holds for is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def sql(self) -> str:
        whens = [f"WHEN {' AND '.join(c.sql() for c in rule)} THEN false" for rule in self.rules]
        return " ".join(["CASE", *whens, "ELSE true END"]) if whens else "true"

    def keeps(self, stats: str) -> Column:
        values, verdict = features(stats), None
        for rule in self.rules:
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column(values)
            verdict = F.when(holds, F.lit(False)) if verdict is None else verdict.when(holds, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def _labelled(rows: DataFrame, labels: DataFrame, stats: str) -> DataFrame:
    """``(bad, grown, <features>)`` of rows with one known label; ids with differing labels teach nothing."""
    known = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
    )
    total = known.count()
    share = min(1.0, SAMPLE / total) if total else 1.0
    chosen = known.where(F.expr(f"pmod(xxhash64(_labelled), 1000000) < {round(1e6 * share)}"))
    named = rows.where(~base_failed(stats)).select(F.col("doc_id").cast("long").alias("_id"), *[c.alias(n) for n, c in features(stats).items()])
    joined = named.join(chosen, named["_id"] == chosen["_labelled"])
    grown = F.expr("pmod(xxhash64(_id, 17), 3) < 2")
    return joined.select((F.col("low") == 0).alias("bad"), grown.alias("grown"), *features(stats))


def learn(rows: DataFrame, labels: DataFrame, stats: str) -> DecisionList:
    """The decision list for rows with statistics; without labels for both classes it has no rules."""
    names = list(features(stats))
    sample = stored(_labelled(rows, labels, stats).coalesce(8), "labelled")
    quantiles = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    found = sample.groupBy("bad").agg(F.count("*").alias("n"), *[F.percentile_approx(n, quantiles, 2000).alias(n) for n in names]).collect()
    if len(found) < 2:
        return DecisionList(())
    cuts = {n: sorted({int(v) for row in found for v in row[n]}) for n in names}

    def covered(rule: tuple[Condition, ...]) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & c.column({n: F.col(n) for n in names})
        return out

    def bins(name: str) -> Column:
        return F.expr(" + ".join(["0", *(f"int({name} >= {cut})" for cut in cuts[name])]))

    binned = F.posexplode(F.array(*[bins(n) for n in names])).alias("f", "b")
    rules: list[tuple[Condition, ...]] = []
    left = sample
    while len(rules) < MOST_RULES:
        rule: tuple[Condition, ...] = ()
        while len(rule) < MOST_CONDITIONS:
            counted = left.where(covered(rule)).where("grown").select("bad", binned).groupBy("f", "b", "bad").count().collect()
            best = _best(counted, names, cuts)
            if best is None:
                break
            rule = (*rule, best)
        tried = [rule[:k] for k in range(1, len(rule) + 1)]
        if not tried:
            break
        sums = [
            F.count_if(covered(r) & half & bad).alias(f"{kind}{h}{k}")
            for k, r in enumerate(tried)
            for h, half in (("g", F.col("grown")), ("p", ~F.col("grown")))
            for kind, bad in (("bad", F.col("bad")), ("good", ~F.col("bad")))
        ]
        tally = left.agg(*sums).first()
        worth = [_worth(tally[f"badp{k}"], tally[f"goodp{k}"]) for k in range(len(tried))]
        k = max(range(len(tried)), key=lambda k: (worth[k], -k))
        bad, good = tally[f"badp{k}"] + tally[f"badg{k}"], tally[f"goodp{k}"] + tally[f"goodg{k}"]
        if tally[f"badp{k}"] < LEAST_ROWS / 2 or bad < LEAST_ROWS or worth[k] < 2 * PRECISION - 1 or bad < PRECISION * (bad + good):
            break
        rules.append(tried[k])
        left = left.where(~covered(tried[k]))
    return DecisionList(tuple(rules))


def _worth(bad: int, good: int) -> float:
    return (bad - good) / (bad + good) if bad + good else -1.0


def _best(counted: list, names: list[str], cuts: dict[str, list[int]]) -> Condition | None:
    """The threshold with the largest gain: rejected rows kept, times the bits by which they stand out more."""
    counts: dict[tuple[int, int], list[int]] = {}
    for row in counted:
        counts.setdefault((row["f"], row["b"]), [0, 0])[int(row["bad"])] += row["count"]
    total = [sum(v[k] for (f, _), v in counts.items() if f == 0) for k in (0, 1)]
    if not total[0] or not total[1]:
        return None
    before, best, most = log2(total[1] / sum(total)), None, 1e-9
    for f, name in enumerate(names):
        below = [0, 0]
        for b, cut in enumerate(cuts[name]):
            below = [below[k] + counts.get((f, b), [0, 0])[k] for k in (0, 1)]
            for at_least, (good, bad) in ((False, below), (True, [total[k] - below[k] for k in (0, 1)])):
                if bad >= LEAST_ROWS and good + bad < sum(total):
                    gain = bad * (log2(bad / (good + bad)) - before)
                    if gain > most:
                        best, most = Condition(name, at_least, cut), gain
    return best


def judged(docs: DataFrame, labels: DataFrame, into: str) -> tuple[DataFrame, DecisionList]:
    """``docs`` with counts, ``base_failed`` and ``kept`` in a struct column ``into``, and the rules behind ``kept``.

    Each row is judged by its own text, so repeated rows fare alike; a null or
    empty text fails the base rules. Rows without a doc_id are judged but teach
    nothing. Without rows nothing comes out.
    """
    rows = stored(with_statistics(docs, into), "statistics")
    found = learn(rows, labels, into)
    failed = base_failed(into)
    kept = ~failed & found.keeps(into)
    return rows.withColumn(into, F.struct(f"{into}.*", failed.alias("base_failed"), kept.alias("kept"))), found


def fresh_name(docs: DataFrame, wanted: str) -> str:
    while any(wanted in name for name in docs.columns):
        wanted += "_"
    return wanted


def quality_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id``, the counts, ``base_failed`` and ``kept``."""
    rows, _ = judged(docs.select("doc_id", "text").select("doc_id", "text"), labels, "quality")
    return rows.select("doc_id", *[f"quality.{name}" for name in COUNTS], "quality.base_failed", "quality.kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned rules keep, with the columns of ``docs``."""
    into = fresh_name(docs, "quality")
    rows, _ = judged(docs, labels, into)
    return rows.where(f"{into}.kept").select(*docs.columns)
