"""Raw CSV files whose columns may differ in order, number and encoding.

A first scan finds the header of each file, whether it is UTF-8 and whether a
quoted value goes over a line end. Files alike in that are then read together.
All files are split over tasks, also those with records of several lines
(`record_lines`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pollstone.contracts.model import Contract
from pollstone.functions.durable import durable

LATIN1 = "ISO-8859-1"
# Commas that are not inside quotes.
SEPARATOR = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# Whole fields and commas, then a quoted field that is still open at the end of the line. A quote
# opens a field at its beginning only; what follows its closing quote goes on to the next comma.
OPEN_END = r'^(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|,)*+"[^"]*+(?:""[^"]*+)*+$'
# Quotes, carriage return and byte order mark around a column name.
_NAME_EDGES = '"\r﻿'


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select("value", "_metadata").filter(F.trim("value") != "")


def _field_count(record: Column) -> Column:
    """Number of fields in a record; commas inside quotes do not count."""
    plain = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"[^"]*"', "")).otherwise(record)
    return F.length(plain) - F.length(F.replace(plain, F.lit(","))) + 1


def _name(text: Column) -> Column:
    return F.trim(F.btrim(F.trim(text), F.lit(_NAME_EDGES)))


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file: column names, whether every line is UTF-8, whether records go over line ends.

    One scan. Lines are combined per file before the shuffle, so one huge file
    costs no more than many small ones; ``collect_set`` over two flags keeps
    Spark on hash aggregation instead of sorting all lines.
    """
    meta, value = F.col("_metadata"), F.col("value")
    position = F.struct(meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"))
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"')))
    per_file = (
        _lines(spark, paths)
        .select(meta["file_path"].alias("uri"), "value", position.alias("position"))
        .groupBy("uri")
        .agg(
            F.min_by("value", "position").alias("first_line"),
            F.collect_set(F.is_valid_utf8("value")).alias("valid"),
            F.bool_or(quotes % 2 == 1).alias("spans"),
        )
    )
    names = F.split(F.make_valid_utf8("first_line"), SEPARATOR)
    header = F.transform(names, lambda name: F.replace(_name(name), F.lit('""'), F.lit('"')))
    return per_file.select("uri", header.alias("header"), (~F.array_contains("valid", False)).alias("utf8"), "spans")


def _entered(lines: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add what is known of a quoted value being open before each row of a group, from the rows before it.

    Each row says whether one is open after it if none was (`zero`) and if one
    was (`one`). Equal answers fix the state, opposite ones flip or keep it. The
    state before a row is ``coalesce(fixed, state at the group's begin) != odd``.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("zero") & ~F.col("one")
    odd = F.coalesce(F.count_if(flips).over(before) % 2 == 1, F.lit(False))
    # What the state must have been at the begin for later flips to come out right.
    begin = F.when(F.col("zero") == F.col("one"), F.col("zero") != F.col("odd"))
    return (
        lines.withColumn("odd", odd)
        .withColumn("begin", begin)
        .withColumn("fixed", F.last("begin", ignorenulls=True).over(before))
    )


def record_lines(spark: SparkSession, paths: Sequence[str], utf8: bool) -> DataFrame:
    """``uri, block, line, value, record, open`` of all lines of files whose records may go over line ends.

    ``record`` is the line that the record begins with and ``open`` tells that
    the record goes on after the line. Each block of a file is looked at alone,
    for both cases, a quoted value open at its begin or not; then one row per
    block tells which case holds, and where a record begun in an earlier block
    started. The lines are written once, so both steps see the same blocks.
    """
    value = F.col("value") if utf8 else F.decode(F.col("value").cast("binary"), LATIN1)
    meta = F.col("_metadata")
    read = (
        spark.read.text(list(paths), lineSep="\n")
        .select(meta["file_path"].alias("uri"), meta["file_block_start"].alias("block"), value.alias("value"))
        .withColumn("line", F.monotonically_increasing_id())
    )
    quoted = F.contains("value", F.lit('"'))
    ends = read.withColumns(
        {
            "zero": quoted & F.col("value").rlike(OPEN_END),
            "one": ~quoted | F.concat(F.lit('"'), "value").rlike(OPEN_END),
        }
    )
    upto = Window.partitionBy("uri", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = {case: F.coalesce("fixed", F.lit(case)) != F.col("odd") for case in (False, True)}
    known = _entered(ends, ["uri", "block"], "line")
    for case, name in ((False, "from_zero"), (True, "from_one")):
        known = known.withColumn(name, F.last(F.when(~state[case], F.col("line")), ignorenulls=True).over(upto))
    lines = durable(known.drop("begin"))

    after = {case: F.when(state[case], F.col("one")).otherwise(F.col("zero")) for case in (False, True)}
    blocks = lines.groupBy("uri", "block").agg(
        F.max_by(after[False], "line").alias("zero"),
        F.max_by(after[True], "line").alias("one"),
        F.max_by("from_zero", "line").alias("from_zero"),
        F.max_by("from_one", "line").alias("from_one"),
    )
    inside = F.coalesce("fixed", F.lit(False)) != F.col("odd")
    earlier = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.last(F.when(F.col("inside"), F.col("from_one")).otherwise(F.col("from_zero")), ignorenulls=True).over(earlier)
    places = (
        _entered(blocks, ["uri"], "block")
        .withColumn("inside", inside)
        .select("uri", "block", "inside", begun.alias("begun"))
    )
    now = F.coalesce("fixed", "inside") != F.col("odd")
    own = F.when(F.col("inside"), F.col("from_one")).otherwise(F.col("from_zero"))
    return lines.join(places, ["uri", "block"]).select(
        "uri",
        "block",
        "line",
        "value",
        F.coalesce(own, "begun").alias("record"),
        F.when(now, F.col("one")).otherwise(F.col("zero")).alias("open"),
    )


def _spanning(spark: SparkSession, paths: Sequence[str], schema: str, utf8: bool, options: dict[str, str]) -> DataFrame:
    """Fields and ``uri`` of all records; only the lines of records of several lines are brought together."""
    lines = record_lines(spark, paths, utf8)
    alone = (F.col("record") == F.col("line")) & ~F.col("open")
    whole = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    gathered = (
        lines.filter(~alone)
        .groupBy("uri", "record")
        .agg(F.array_join(F.transform(whole, lambda part: part["value"]), "\n").alias("value"))
    )
    records = lines.filter(alone).select("uri", "value").union(gathered.select("uri", "value"))
    text = F.regexp_replace("value", "^\ufeff|\\r\\z", "")
    rows = records.withColumn("value", text).filter(F.trim("value") != "")
    return rows.select(F.from_csv("value", schema, options).alias("row"), "uri").select("row.*", "uri")


def _records(spark: SparkSession, paths: Sequence[str], header: Sequence[str], utf8: bool, spans: bool) -> DataFrame:
    """Fields ``f0, f1, ..`` and the ``uri`` of all records that are rows of files with this header."""
    fields = [f"f{i}" for i in range(len(header))]
    schema = ", ".join(f"{name} string" for name in [*fields, "_unlike"])
    options = {"escape": '"', "columnNameOfCorruptRecord": "_unlike"}
    if spans:
        rows = _spanning(spark, paths, schema, utf8, options | {"multiLine": "true"})
    else:
        read = spark.read.schema(schema).options(encoding="UTF-8" if utf8 else LATIN1, **options)
        rows = read.csv(list(paths)).withColumn("uri", F.col("_metadata.file_path"))
    # Records with fewer or more fields than the header are unlike it.
    like = F.col("_unlike").isNull() | ((_field_count(F.col("_unlike")) < len(header)) & (F.trim("_unlike") != ""))
    is_header = reduce(
        Column.__and__, [F.coalesce(_name(F.col(f)), F.lit("")) == F.lit(name) for f, name in zip(fields, header)]
    )
    blank = (F.trim("f0") == "") & (F.col("f0") != "") if len(header) == 1 else F.lit(False)
    return rows.filter(like & ~is_header & ~F.coalesce(blank, F.lit(False)))


def parsed_rows(spark: SparkSession, files: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Contract columns as text from all files, each file by its own header.

    ``files`` has ``uri, header, utf8, spans``; its columns named in ``keep``
    come along with an underscore in front. Records with more fields than
    their header are skipped, short ones are padded with NULL, files that are
    not UTF-8 are read as Latin-1, and a record that repeats the header is no
    row. Files usually share a few headers; there is one read per group of
    equal files, and no row is shuffled.
    """
    groups: dict[tuple, list[str]] = {}
    for row in files.select("uri", "header", "utf8", "spans", *keep).toLocalIterator():
        groups.setdefault((tuple(row.header), *row[2:]), []).append(unquote(row.uri))
    parts = []
    for (header, utf8, spans, *facts), paths in groups.items():
        place = {name: f"f{i}" for i, name in reversed(list(enumerate(header)))}
        columns = [(F.col(place[n]) if n in place else F.lit(None).cast("string")).alias(n) for n in contract.columns]
        known = [F.lit(fact).alias(f"_{name}") for name, fact in zip(keep, facts)]
        # The place of the file comes last, for counts per file.
        parts.append(_records(spark, paths, header, utf8, spans).select(*columns, *known, F.col("uri").alias("_uri")))
    return reduce(DataFrame.union, parts)


def row_counts(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``uri, usable_rows`` of all files that have rows."""
    rows = parsed_rows(spark, files, Contract.of("none", {}))
    return rows.groupBy(F.col("_uri").alias("uri")).agg(F.count(F.lit(1)).alias("usable_rows"))


def read_csv_files(spark: SparkSession, paths: Sequence[str], contract: Contract) -> DataFrame:
    """All rows of several raw CSV files, typed by the contract."""
    if not paths:
        raise ValueError("A read needs at least one CSV path")
    return contract.conform(parsed_rows(spark, file_headers(spark, paths), contract).drop("_uri"))
