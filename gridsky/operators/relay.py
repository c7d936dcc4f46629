"""Message relay with a per-message hook."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def relay_json(
    messages: DataFrame,
    fn: Callable[[str], str] | None = None,
    on_error: str = "fail",
    canonical: bool = False,
) -> DataFrame:
    """Pass on every ``value``; other columns pass through.

    Without ``fn`` each message is checked to be JSON and passed on as it is, or
    with ``canonical`` written anew from its parsed form; both run in the JVM. With
    ``fn`` the function gets each message, in Arrow batches. A message that is not
    JSON, or an exception, ends the job under ``on_error='fail'`` and gives
    NULL for that message under ``'null'``. A NULL message stays NULL.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    lenient = on_error == "null"
    if fn is None:
        parsed = (F.try_parse_json if lenient else F.parse_json)(F.col("value").cast("string"))
        whole = F.to_json(parsed) if canonical else F.when(parsed.isNotNull(), F.col("value").cast("string"))
        return messages.withColumn("value", whole)

    # Nested functions travel to the workers by value: the hook needs no package there.
    hook = fn

    def one(message):
        if message is None:
            return None
        try:
            return hook(message)
        except Exception:
            if lenient:
                return None
            raise

    @F.pandas_udf(StringType())
    def apply(values: pd.Series) -> pd.Series:
        return pd.Series([one(v) for v in values], dtype=object)

    return messages.withColumn("value", apply(F.col("value").cast("string")))
