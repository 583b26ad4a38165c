"""Exchange-rate feed: one JSON payload per poll to one row per currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUOTES = ("rtbBid", "rthOfr", "rtcOfr", "rthBid", "rtcBid", "ratTim", "ratDat")
PAYLOAD = "struct<body:array<struct<" + ",".join(f"{n}:string" for n in ("ccyNbr", "ccyNbrEng", *QUOTES)) + ">>>"


def rate_feed(df: DataFrame, column: str = "value") -> DataFrame:
    """``(ccy_zh, ccy_en, ct_time, data)``: code is the second word of the English name, the date is made ISO-like."""
    rate = df.select(F.explode(F.from_json(column, PAYLOAD).body).alias("r")).select("r.*")
    code = F.get(F.split("ccyNbrEng", " "), F.lit(1))
    day = F.translate("ratDat", "年月日", "--")
    data = F.to_json(F.struct(F.col("ccyNbr").alias("ccy_zh"), code.alias("ccy_en"), *QUOTES))
    return rate.select(
        F.col("ccyNbr").alias("ccy_zh"),
        code.alias("ccy_en"),
        F.concat_ws(" ", day, "ratTim").alias("ct_time"),
        data.alias("data"),
    )
