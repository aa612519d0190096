"""Bars as keyed JSON messages, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import BRONZE

_CORRUPT = "_corrupt"
_PARSED = T.StructType([*BRONZE.fields, T.StructField(_CORRUPT, T.StringType())])


def encode_messages(bars: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(key, value): the symbol, and the bar as a JSON object with its nulls spelled out.

    Columns in ``keep`` travel beside the message instead of inside it.
    """
    fields = [c for c in bars.columns if c not in keep]
    return bars.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def to_base64(value: Column) -> Column:
    """The form in which a stream service hands over a message body."""
    return F.base64(F.encode(value, "utf-8"))


def decode_messages(records: DataFrame, data: str = "data") -> DataFrame:
    """Parse each record once into ``bar`` and say in ``failure`` what is wrong with it.

    The fixed schema makes absent fields null and drops unknown ones. A record that
    is not base64, not text, not a JSON object, or has a value of the wrong type is
    a failure of that record alone.
    """
    text = F.try_validate_utf8(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return (
        records.withColumn("_text", text)
        .withColumn("_parsed", F.from_json("_text", _PARSED, options))
        # One row in, one row out. Filters on what follows stay above this step, so
        # none of them is answered by parsing the text a second time.
        .withColumn("bar", F.explode(F.array("_parsed")))
        .withColumn(
            "failure",
            F.when(F.col("_text").isNull(), "encoding").when(
                F.col("bar").isNull() | F.col(f"bar.{_CORRUPT}").isNotNull(), "json"
            ),
        )
        .drop("_text", "_parsed")
    )


def split_good_bad(decoded: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Raw bars of the readable records (with the columns in ``keep``), and the unreadable records as they came."""
    good = decoded.filter(F.col("failure").isNull()).select(
        *[F.col(f"bar.{c}").alias(c) for c in BRONZE.fieldNames()], *keep
    )
    bad = decoded.filter(F.col("failure").isNotNull()).drop("bar")
    return good, bad


def decode_stats(decoded: DataFrame) -> DataFrame:
    """Records received, written and failed."""
    return decoded.agg(
        F.count("*").alias("received"),
        F.count_if(F.col("failure").isNull()).alias("written"),
        F.count_if(F.col("failure").isNotNull()).alias("decode_failures"),
    )
