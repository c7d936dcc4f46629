"""Result tables of a time-series store, as annotated CSV.

An answer holds several tables, one after another, apart by blank lines. A table begins with annotation
rows (``#datatype``, ``#group``, ``#default``) and a header row; tables may have different columns. A cell
that is empty takes the default of its column. Line breaks within quotes are not part of this format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.schemas import SERIES

#: Columns that a table may have, at most; a wider one raises an error.
COLUMNS = 64
#: Records of a table that are typed together; a long table is dealt out in such slices.
SLICE = 1000
#: Records that a written table has, about; a group of more is told in several tables.
RECORDS = 5000
#: Fixed by the format: names of the annotations.
ANNOTATIONS = ("datatype", "group", "default")
_CELLS = ", ".join(f"c{k} string" for k in range(COLUMNS + 1))


def _cells(line: Column) -> Column:
    """The cells of a CSV line, without quotes; empty ones, and those it does not have, are null."""
    parsed = F.from_csv(line, _CELLS, {"quote": '"', "escape": '"'})
    # Bound as a variable, the line is parsed once, not once per cell.
    cells = F.transform(F.array(parsed), lambda row: F.array(*[row[f"c{k}"] for k in range(COLUMNS + 1)]))
    return F.get(cells, F.lit(0))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """(answer, body): one row per landed file, read whole, as records refer to the header above them."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("answer"), F.col("value").alias("body")
    )


def annotated_rows(answers: DataFrame) -> DataFrame:
    """(answer, block, line, fields, datatypes, group): one row per record of every table.

    ``fields`` maps columns to text, with defaults filled in; ``datatypes`` maps them to the types that the
    store gives; ``group`` lists the columns of the group key. Tables without records, and those that report an error, give no rows.
    A task cuts an answer into slices of its tables, each with its header; the slices are dealt out, and read apart.
    """
    body = F.regexp_replace("body", "\r\n?", "\n")
    # An annotation below a record begins a table, also without a blank line.
    body = F.regexp_replace(body, "(?m)^([^#\n][^\n]*)\n(?=#)", "$1\n\n")
    blocks = answers.select("answer", F.posexplode(F.split(body, "\n[ \t]*\n")).alias("block", "table"))
    lines = blocks.select("answer", "block", F.filter(F.split("table", "\n"), lambda t: F.trim(t) != "").alias("lines"))
    records = F.filter("lines", lambda t: ~t.startswith("#"))

    def note(name: str) -> Column:
        return _cells(F.get(F.filter("lines", lambda t: t.startswith(f"#{name}")), F.lit(0))).alias(name)

    notes = [note(name) for name in ANNOTATIONS]
    tables = lines.select("answer", "block", *notes, records.alias("records")).filter(F.size("records") > 1)
    header = _cells(F.get("records", F.lit(0)))
    wide = F.raise_error(F.lit(f"a table of {COLUMNS} columns at most is read"))
    tables = tables.withColumn("header", header)
    tables = tables.withColumn("header", F.when(F.get("header", F.lit(COLUMNS)).isNotNull(), wide).otherwise(F.col("header")))
    tables = tables.filter(~F.array_contains(F.array_compact("header"), "error"))
    # Places of the columns that have a name; of equal names the first counts.
    places = F.filter(
        F.sequence(F.lit(0), F.lit(COLUMNS - 1)), lambda k: F.array_position("header", F.get("header", k)) == k + 1
    )
    # The lines from the header down, in slices.
    slices = F.transform(
        F.sequence(F.lit(1), F.size("records") - 1, F.lit(SLICE)),
        lambda k: F.struct(k.alias("first"), F.slice("records", k + 1, F.lit(SLICE)).alias("records")),
    )
    dealt = (
        tables.withColumn("places", places)
        .select("answer", "block", *ANNOTATIONS, "header", "places", F.explode(slices).alias("slice"))
        .hint("rebalance")
    )
    told = dealt.select(
        "answer", "block", *ANNOTATIONS, "header", "places", "slice.first",
        F.posexplode(F.transform("slice.records", _cells)).alias("at", "cells"),
    )

    def named(value) -> Column:
        return F.map_from_arrays(F.transform("places", lambda k: F.get("header", k)), F.transform("places", value))

    return told.select(
        "answer",
        "block",
        (F.col("first") + F.col("at")).alias("line"),
        named(lambda k: F.coalesce(F.get("cells", k), F.get("default", k))).alias("fields"),
        named(lambda k: F.get("datatype", k)).alias("datatypes"),
        F.transform(
            F.filter("places", lambda k: F.coalesce(F.get("group", k), F.lit("")) == "true"), lambda k: F.get("header", k)
        ).alias("group"),
    )


def series_from_annotated(rows: DataFrame, bucket: str | None = None) -> DataFrame:
    """Readings with the range they were asked for (``_start``, ``_stop``) from ``annotated_rows``.

    The store does not name the bucket in its answer: it is given, or a column of the tables. A value that is no number is null.
    """
    fields = F.col("fields")
    kinds = {f.name: f.dataType for f in SERIES}
    columns = {name: fields[name].try_cast(kind) for name, kind in kinds.items()}
    if bucket is not None:
        columns["bucket"] = F.lit(bucket)
    bounds = [fields[name].try_cast("timestamp").alias(name) for name in ("_start", "_stop")]
    return rows.select(*[c.alias(n) for n, c in columns.items()], *bounds)


def annotated_tables(readings: DataFrame, group: tuple[str, ...], records: int = RECORDS) -> DataFrame:
    """``value``: the text of one table per ``group``, as the store would answer; the inverse of ``annotated_rows``.

    Columns of the group have the same value throughout a table, and stand in its defaults only. A group of more than
    ``records`` readings is dealt out by their hash to tables of about so many, so that no task holds it; equal readings stay together.
    """
    kinds = {"timestamp": "dateTime:RFC3339", "double": "double", "bigint": "long", "string": "string", "boolean": "boolean"}
    types = dict(readings.dtypes)

    def cell(name: str, value: Column) -> Column:
        if types[name] == "timestamp":
            value = F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        text = F.coalesce(value.cast("string"), F.lit(""))
        return F.when(text.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    rest = [c for c in readings.columns if c not in group]
    columns = [*group, *rest]
    keys = [f"g{k}" for k in range(len(group))]
    record = F.concat_ws(",", *[F.lit("")] * (len(group) + 1), *[cell(c, F.col(c)) for c in rest])
    rows = readings.select(*[F.col(c).alias(k) for c, k in zip(group, keys)], record.alias("record"))
    rows = rows.withColumn("hash", F.xxhash64(F.lit(0), *keys))
    # Groups that share a hash are counted together, which only makes their tables smaller.
    crowded = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > records)
    parts = F.coalesce(F.ceil(F.col("n") / records), F.lit(1))
    dealt = rows.join(crowded, "hash", "left").withColumn("part", F.pmod(F.xxhash64("record"), parts))
    tables = dealt.groupBy(*keys, "part").agg(F.concat_ws("\n", F.collect_list("record")).alias("records"))
    notes = {
        "datatype": F.lit(",".join(kinds[types[c]] for c in columns)),
        "group": F.lit(",".join("true" if c in group else "false" for c in columns)),
        "default": F.concat_ws(",", *[cell(c, F.col(k)) for c, k in zip(group, keys)], *[F.lit("")] * len(rest)),
    }
    head = [F.concat(F.lit(f"#{name},"), text) for name, text in notes.items()]
    return tables.select(F.concat_ws("\n", *head, F.lit("," + ",".join(columns)), "records", F.lit("")).alias("value"))
