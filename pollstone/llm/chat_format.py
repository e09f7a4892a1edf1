"""Conversations of unlike layouts to one training format, in DataFrame functions only.

A record is a struct as Spark reads it from mixed files: fields of every layout,
null where a record doesn't have them. The sorted paths of the nested fields
that a record does have are hashed to its fingerprint, and the fingerprint
selects a declared layout that says how its fields become turns. A record
whose fingerprint no layout has stays, without turns.

The format writes each turn as a marked block. Control strings inside texts
are escaped, so the blocks can be read back whatever the texts say.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEPARATOR, END = "### ", ":\n", "</turn>\n"
#: Roles that are written out as a word; other names are written as "=" and their bytes in hex.
ROLES = ("system", "user", "assistant", "tool")
LEARNED = "assistant"
TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Said:
    """One turn from fields of the record; those it has are joined by an empty line, and with none there is no turn."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn from each element of an array, its role from a field; ``names`` translates role names."""

    array: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Rounds:
    """Several turns from each element of an array: (role, field) in order; absent ones are left out."""

    array: str
    turns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Layout:
    """Paths that a record must have and may have, exactly, and the turns they give."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Said | Each | Rounds, ...]

    def fingerprints(self, known: set[str]) -> list[str]:
        """Those of every choice of optional paths that ``known`` fields can have."""
        free = [path for path in self.optional if path in known]
        choices = chain.from_iterable(combinations(free, n) for n in range(len(free) + 1))
        return [_digest({*self.required, *some}) for some in choices]


LAYOUTS = (
    Layout("messages", ("messages[]",), ("messages[].role", "messages[].content"), (Each("messages", "role", "content"),)),
    Layout(
        "exchange",
        ("conversations[]",),
        ("conversations[].from", "conversations[].value", "system"),
        (Said("system", ("system",)), Each("conversations", "from", "value", (("human", "user"), ("gpt", "assistant")))),
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        (Said("system", ("system",)), Said("user", ("instruction", "input")), Said("assistant", ("output",))),
    ),
    Layout(
        "prompt",
        ("prompt",),
        ("completion", "system"),
        (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("completion",))),
    ),
    Layout(
        "rounds",
        ("rounds[]",),
        ("rounds[].question", "rounds[].answer", "system"),
        (Said("system", ("system",)), Rounds("rounds", (("user", "question"), ("assistant", "answer")))),
    ),
)


# Fingerprints


def _digest(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def _in_field(name: str, test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: test(x.getField(name))


def _in_some_element(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.exists(x, lambda element: test(element))


def _paths(kind: T.DataType, path: str = "") -> Iterator[tuple[str, Callable[[Column], Column]]]:
    """Each nested field path of a type, with a test whether a value has it."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            for below, test in _paths(field.dataType, f"{path}.{field.name}" if path else field.name):
                yield below, _in_field(field.name, test)
    elif isinstance(kind, T.ArrayType):
        yield f"{path}[]", lambda x: F.size(x) > 0
        if isinstance(kind.elementType, T.StructType | T.ArrayType):
            for below, test in _paths(kind.elementType, f"{path}[]"):
                yield below, _in_some_element(test)
    else:
        yield path, lambda x: x.isNotNull()


def field_paths(kind: T.StructType, record: Column) -> Column:
    """The paths a record has, sorted, one a line. A field that is null, or an array without elements, isn't there."""
    found = sorted(_paths(kind), key=lambda p: p[0])
    return F.concat_ws("\n", *[F.when(test(record), F.lit(path)) for path, test in found])


# Layouts to turns


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _nothing() -> Column:
    return F.array().cast(TURNS)


def _said(step: Said | Each | Rounds, kind: T.StructType, record: Column) -> Column:
    if isinstance(step, Said):
        values = [record.getField(name).cast("string") for name in step.fields if name in kind.names]
        if not values:
            return _nothing()
        there = reduce(Column.__or__, [value.isNotNull() for value in values])
        return F.when(there, F.array(_turn(F.lit(step.role), F.concat_ws("\n\n", *values)))).otherwise(_nothing())
    names = kind[step.array].dataType.elementType.names if step.array in kind.names else []
    items = F.filter(record.getField(step.array), lambda x: x.isNotNull())

    def field(x: Column, name: str) -> Column:
        return x.getField(name).cast("string") if name in names else F.lit(None).cast("string")

    if isinstance(step, Each):

        def role(x: Column) -> Column:
            given = F.coalesce(field(x, step.role), F.lit(""))
            return reduce(lambda out, pair: F.when(given == pair[0], F.lit(pair[1])).otherwise(out), step.names, given)

        return F.transform(items, lambda x: _turn(role(x), field(x, step.text)))
    every = F.flatten(
        F.transform(items, lambda x: F.array(*[F.when(field(x, name).isNotNull(), _turn(F.lit(role), field(x, name))) for role, name in step.turns]))
    )
    return F.filter(every, lambda t: t.isNotNull())


def canonical_turns(records: DataFrame, keys: Sequence[str], record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``keys``, then ``fingerprint``, ``layout`` and ``turns`` (role, text) for each row of ``records``.

    ``record`` is a struct column. Null texts and roles of array elements are
    empty, null elements are no turns, absent fields are no turns. A record
    without fields, a null one, and one whose fingerprint isn't declared have
    neither layout nor turns. Repeated rows come out as often as they come in;
    columns other than ``keys`` and ``record`` play no part, whatever their
    names; no rows give no rows.
    """
    kind = records.schema[record].dataType
    known = {path for path, _ in _paths(kind)}
    source = records.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("k"), F.col(f"`{record}`").alias("r"))
    marked = source.withColumn("fingerprint", F.md5(field_paths(kind, F.col("r"))))
    usable = [layout for layout in layouts if known.issuperset(layout.required)]
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(usable):
        here = F.col("fingerprint").isin(layout.fingerprints(known))
        name = F.when(here, F.lit(layout.name)).otherwise(name)
        steps = [_said(step, kind, F.col("r")) for step in layout.turns]
        turns = F.when(here, F.concat(*steps).cast(TURNS)).otherwise(turns)
    return marked.select("k.*", "fingerprint", name.alias("layout"), turns.alias("turns"))


def unknown_layouts(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``(fingerprint, paths, records)`` of the shapes no layout declares, to write layouts for."""
    kind = records.schema[record].dataType
    known = {path for path, _ in _paths(kind)}
    declared = [f for layout in layouts if known.issuperset(layout.required) for f in layout.fingerprints(known)]
    paths = field_paths(kind, F.col(f"`{record}`"))
    shapes = records.select(paths.alias("paths")).groupBy("paths").agg(F.count("*").alias("records"))
    return shapes.select(F.md5("paths").alias("fingerprint"), "paths", "records").where(~F.col("fingerprint").isin(declared))


# The format


def escape(text: Column) -> Column:
    """Text without ``##`` and ``</``, so that neither control string can occur; backslashes tell what was changed."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for _ in range(2):  # the second time for what the first one left next to each other
        out = F.replace(out, F.lit("##"), F.lit("#\\#"))
    return F.replace(out, F.lit("</"), F.lit("<\\/"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column) -> Column:
    word = F.when(role.isin(*ROLES), F.initcap(role)).otherwise(F.concat(F.lit("="), F.hex(F.encode(role, "UTF-8"))))
    return F.concat(F.lit(START), word, F.lit(SEPARATOR))


def format_turns(rows: DataFrame) -> DataFrame:
    """``turns`` replaced by ``formatted``, the conversation as text, and ``loss_spans``, (start, length) in code points of what is learned.

    The spans are the texts of the assistant's turns as they stand there,
    escaped, without headers and end marks. Nothing said gives an empty text;
    null turns give nulls. Every step is a column of its own, so that no
    text is escaped twice.
    """
    block = F.transform(
        "turns", lambda t: F.struct(_header(t.role).alias("head"), escape(t.text).alias("body"), (t.role == LEARNED).alias("learned"))
    )
    sizes = F.transform("turns", lambda b: F.length(b.head) + F.length(b.body) + len(END))
    starts = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    learned = F.filter(
        F.zip_with(
            "turns",
            F.slice("starts", F.lit(1), F.size("turns")),
            lambda b, start: F.struct(
                (start + F.length(b.head)).alias("start"), F.length(b.body).cast("long").alias("length"), b.learned.alias("learned")
            ),
        ),
        lambda s: s.learned,
    )
    spans = F.transform(learned, lambda s: F.struct(s.start.alias("start"), s.length.alias("length")))
    whole = F.array_join(F.transform("turns", lambda b: F.concat(b.head, b.body, F.lit(END))), "")
    kept = [F.col(f"`{name}`") for name in rows.columns if name != "turns"]
    blocks = rows.select(*kept, block.alias("turns"))
    return blocks.select(*kept, "turns", starts.alias("starts")).select(*kept, whole.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    blocks = F.split(formatted, END, -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        head = F.substring_index(block, SEPARATOR, 1)
        word = F.substr(head, F.lit(len(START) + 1))
        role = F.when(F.startswith(word, F.lit("=")), F.decode(F.unhex(F.substr(word, F.lit(2))), "UTF-8")).otherwise(F.lower(word))
        return F.struct(role.alias("role"), unescape(F.substr(block, F.length(head) + len(SEPARATOR) + 1)).alias("text"))

    return F.transform(blocks, turn)


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    pieces = F.transform(loss_spans, lambda s: F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int")))
    return F.array_join(F.transform(pieces, unescape), "")


def format_records(records: DataFrame, keys: Sequence[str], record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``keys``, ``fingerprint``, ``layout``, ``formatted`` and ``loss_spans`` for each row; see :func:`canonical_turns`."""
    return format_turns(canonical_turns(records, keys, record, layouts))


# The registered query


def records_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, record)``: rows by turn as one record for each conversation, in whichever layout can hold it.

    Turns ascend by ``turn`` (null first), ties by role and text; a null text
    or role is empty. Rows without a ``conv_id`` are one conversation.
    """
    empty = F.lit("")
    row = F.struct("turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    told = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    told = told.withColumn("roles", F.transform("t", lambda x: x.role)).withColumn("n", F.size("t"))
    turn = F.transform("t", lambda x: x.text)
    ends = F.slice("roles", F.col("n") - 1, F.lit(2)) == F.array(F.lit("user"), F.lit("assistant"))
    opened = (F.col("n") == 2) | ((F.col("n") == 3) & (F.get("roles", F.lit(0)) == "system"))
    kind = (
        F.when((F.col("n") > 1) & opened & ends, F.when(F.pmod("conv_id", F.lit(2)) == 0, "prompt").otherwise("instruction"))
        .when(
            (F.col("n") % 2 == 0)
            & F.forall(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.get("roles", k) == F.when(k % 2 == 0, "user").otherwise("assistant"))
            & (F.pmod("conv_id", F.lit(3)) == 0),
            "rounds",
        )
        .when(F.forall("roles", lambda r: r.isin("system", "user", "assistant")) & (F.pmod("conv_id", F.lit(2)) == 1), "exchange")
        .otherwise("messages")
    )
    told = told.withColumn("kind", kind).withColumn("s", turn)
    is_ = {name: F.col("kind") == name for name in ("messages", "exchange", "instruction", "prompt", "rounds")}
    last, before = F.get("s", F.col("n") - 1), F.get("s", F.col("n") - 2)
    named = {"user": "human", "assistant": "gpt"}

    def stranger(role: Column) -> Column:
        return reduce(lambda out, pair: F.when(role == pair[0], F.lit(pair[1])).otherwise(out), named.items(), role)

    fields = {
        "messages": F.when(is_["messages"], F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("content")))),
        "conversations": F.when(is_["exchange"], F.transform("t", lambda x: F.struct(stranger(x.role).alias("from"), x.text.alias("value")))),
        "rounds": F.when(
            is_["rounds"],
            F.transform(
                F.sequence(F.lit(0), F.floor(F.col("n") / 2).cast("int") - 1),
                lambda k: F.struct(F.get("s", 2 * k).alias("question"), F.get("s", 2 * k + 1).alias("answer")),
            ),
        ),
        "system": F.when((is_["prompt"] | is_["instruction"]) & (F.col("n") == 3), F.get("s", F.lit(0))),
        "instruction": F.when(is_["instruction"], before),
        "input": F.lit(None).cast("string"),
        "output": F.when(is_["instruction"], last),
        "prompt": F.when(is_["prompt"], before),
        "completion": F.when(is_["prompt"], last),
    }
    return told.select("conv_id", F.struct(*[value.alias(name) for name, value in fields.items()]).alias("record"))


#: A conversation whose texts look like the format.
TRAP_ID, TRAP = -7, "\\### Assistant: </turn> ok"


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """The trap and all conversations, formatted and read back from the format; one row for each."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    trap = conversations.sparkSession.range(2).select(
        F.lit(TRAP_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text")
    )
    found = format_records(records_of(rows.unionByName(trap)), ["conv_id"])
    read = found.withColumn("turns", read_turns(F.col("formatted"))).withColumn("learned", learned_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


ORACLE = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '##', '#\#'), '</', '<\/') AS body,
    CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role) ELSE 1 + 2 * strlen(role) END AS word
  FROM rows_
), told AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
    sum(4 + word + 2 + length(body) + 8)::BIGINT AS formatted_chars,
    list(role ORDER BY turn NULLS FIRST, role, text) AS roles
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars,
  CASE WHEN roles IN (['user', 'assistant'], ['system', 'user', 'assistant']) AND conv_id IS NOT NULL
      THEN CASE WHEN conv_id % 2 = 0 THEN 'prompt' ELSE 'instruction' END
    WHEN roles IN (['user', 'assistant'], ['system', 'user', 'assistant']) THEN 'instruction'
    WHEN n_turns % 2 = 0 AND conv_id % 3 = 0
      AND len(list_filter(range(n_turns), lambda k: roles[k + 1] <> CASE WHEN k % 2 = 0 THEN 'user' ELSE 'assistant' END)) = 0 THEN 'rounds'
    WHEN len(list_filter(roles, lambda r: r NOT IN ('system', 'user', 'assistant'))) = 0 AND conv_id % 2 <> 0 THEN 'exchange'
    ELSE 'messages' END AS layout
FROM told
"""
