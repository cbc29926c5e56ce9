"""Bronze: decode messages, stamp them, keep what could not be decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import schemas as S

DATE_FORMAT = "yyyy-MM-dd"
CORRUPT = "_corrupt"
KEY = "id"


def from_json_text(value: Column, schema: T.StructType = S.WIRE) -> Column:
    return F.from_json(value.cast("string"), schema)


def decode(messages: DataFrame, schema: T.StructType = S.WIRE) -> DataFrame:
    """Columns of the JSON value, plus `_corrupt`: null for good messages, else their
    text. Bad are those that are not JSON objects of this shape, those without a value
    (their text is empty) and, where the schema has an id, those without one."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    record = F.col("record")
    bad = record.isNull() | record[CORRUPT].isNotNull() | F.col("text").isNull()
    if KEY in schema.names:
        bad = bad | record[KEY].isNull()
    corrupt = F.when(bad, F.coalesce("text", F.lit(""))).alias(CORRUPT)
    rows = messages.select(text.alias("text"), parsed.alias("record"))
    return rows.select(*(record[n].alias(n) for n in schema.names), corrupt)


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(decoded: DataFrame) -> DataFrame:
    """Messages to look at, whole; nothing is lost on the way to bronze."""
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def stamp(feed: DataFrame, as_of: str | None = None) -> DataFrame:
    """Arrival time and date. The date is a string and the table's partition."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return feed.withColumns(
        {"bronze_timestamp": now, "bronze_date": F.date_format(now, DATE_FORMAT)}
    )
