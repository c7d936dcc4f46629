"""Lenient JSON decoding.

Messages whose scalars have their own JSON types are parsed as such, once. Where
a field has another type (a number in quotes, say) the message is parsed again
with every field as text, which is then cast with ``try_cast``: a bad field
becomes NULL and the others are kept. A message that is not a JSON object is
rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from gridsky.functions.timing import event_time
from gridsky.schemas import ENERGY_MESSAGE, WEATHER_MESSAGE

MALFORMED = "malformed"
NO_EVENT_TIME = "no_event_time"

_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Decoded:
    """Typed records, the messages that gave none with the reason, and both in one frame.

    ``marked`` has every message: its fields, or its text and ``reason``. A job that
    needs both sides lands this frame, so that a message is parsed once.
    """

    records: DataFrame
    rejected: DataFrame
    marked: DataFrame


def split_marked(marked: DataFrame) -> Decoded:
    """The two sides of a ``marked`` frame, wherever it was kept."""
    usable = F.col("reason").isNull()
    names = [c for c in marked.columns if c not in ("message", "reason")]
    fields = set(ENERGY_MESSAGE.names) | set(WEATHER_MESSAGE.names) | {"ts"}
    carried = [c for c in names if c not in fields]
    return Decoded(
        records=marked.filter(usable).select(*names),
        rejected=marked.filter(~usable).select("message", "reason", *carried),
        marked=marked,
    )


def _on_the_wire(kind: DataType) -> DataType:
    # Epoch milliseconds arrive as floats, which a long column would not take.
    return DoubleType() if isinstance(kind, LongType) else kind


def _from_text(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, BooleanType):
        # A plain cast would also take 'yes', 't' and '1' as true.
        return F.lower(F.trim(text)) == "true"
    return text.try_cast(_on_the_wire(kind))


def _parse(fields: StructType, kind: Callable[[DataType], DataType]) -> Column:
    schema = StructType(
        [StructField(f.name, kind(f.dataType)) for f in fields]
        + [StructField(_CORRUPT, StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json("message", schema, options)


def _columns(parsed: Column, fields: StructType, prefix: str) -> Column:
    # inline() is a generator, and filters on generated columns stay above it.
    # Of a projection, each of the filters below would parse the message anew.
    names = [*fields.names, _CORRUPT]
    return F.inline(F.array(parsed)).alias(*[f"{prefix}_{n}" for n in names])


def decode(messages: DataFrame, fields: StructType, carry: tuple[str, ...] = ()) -> Decoded:
    """Decode the ``value`` column into ``fields`` plus the event time ``ts``.

    ``carry`` names transport columns (an arrival position, say) to keep.
    """
    raw = messages.select(F.col("value").alias("message"), *carry)
    typed = raw.select("*", _columns(_parse(fields, _on_the_wire), fields, "typed"))
    clean = F.col(f"typed_{_CORRUPT}").isNull()
    # Only an object can give fields the second time.
    is_object = F.col("message").rlike(r"^\uFEFF?\s*\{")
    again = F.when(~clean & is_object, _parse(fields, lambda _: StringType()))
    both = typed.select("*", _columns(again, fields, "text"))

    def field(f: StructField) -> Column:
        from_text = _from_text(F.col(f"text_{f.name}"), f.dataType)
        value = F.when(clean, F.col(f"typed_{f.name}")).otherwise(from_text)
        # Cuts the fraction of a millisecond; NULL where a long cannot hold it.
        return value.try_cast(f.dataType) if isinstance(f.dataType, LongType) else value

    decoded = both.select(
        "message",
        *carry,
        *[field(f).alias(f.name) for f in fields],
        (~clean & (~is_object | F.col(f"text_{_CORRUPT}").isNotNull())).alias("corrupt"),
    ).withColumn("ts", event_time(F.col("time_stamp")))
    # A NULL or blank message is not flagged as corrupt; like {} it has no time.
    usable = ~F.col("corrupt") & F.col("ts").isNotNull()
    blank = F.col("message").isNull() | (F.length(F.trim("message")) == 0)
    reason = F.when(F.col("corrupt") | blank, F.lit(MALFORMED)).otherwise(F.lit(NO_EVENT_TIME))
    marked = decoded.select(
        *fields.names,
        "ts",
        *carry,
        F.when(~usable, F.col("message")).alias("message"),
        F.when(~usable, reason).alias("reason"),
    )
    return Decoded(
        records=decoded.filter(usable).select(*fields.names, "ts", *carry),
        rejected=decoded.filter(~usable).select("message", reason.alias("reason"), *carry),
        marked=marked,
    )


def decode_energy(messages: DataFrame, carry: tuple[str, ...] = ()) -> Decoded:
    return decode(messages, ENERGY_MESSAGE, carry)


def decode_weather(messages: DataFrame, carry: tuple[str, ...] = ()) -> Decoded:
    return decode(messages, WEATHER_MESSAGE, carry)


def split_null_keys(rows: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is complete, and rows a keyed table cannot hold."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return rows.filter(~missing), rows.filter(missing)
