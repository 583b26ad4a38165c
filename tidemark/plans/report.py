"""Daily report: the day's last window with product names, overlap with the day before, and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import parse_clock
from tidemark.operators.ranking import latest_per_group


def percent_text(value) -> F.Column:
    """Two digits and a percent sign; NULL stays NULL."""
    return F.concat(F.round(value, 2).cast("decimal(38,2)").cast("string"), F.lit("%"))


def daily_report(gmv: DataFrame, products: DataFrame, k: int = 5, ids: str = "top5_product_ids") -> DataFrame:
    """One row per day from the intraday report and the product names.

    ``similarity_rate`` is the share of ``k`` names that the day before listed too, ``dod_rate`` the growth of
    ``win_gmv`` over the day before (NULL without one). ``products`` may repeat ids: the first name in order counts. Rows per day are few, so the day-on-day step runs on one row per day.
    """
    clocks = gmv.select(
        F.col("ds").cast("date").alias("ds"),
        parse_clock(F.col("window_start")).alias("window_start"),
        parse_clock(F.col("window_end")).alias("window_end"),
        "win_gmv",
        F.col(ids).alias("_ids"),
    )
    days = latest_per_group(clocks, ["ds"], ["window_end"])
    day = ["ds", "window_start", "window_end", "win_gmv"]
    listed = days.select(*day, F.posexplode(F.split("_ids", ",")).alias("_pos", "product_id"))
    # the names are not narrowed to the listed ids first: that would compute the report, the larger part, twice
    names = (
        products.select(F.col("product_id").cast("string").alias("product_id"), "product_desc")
        .groupBy("product_id")
        .agg(F.min("product_desc").alias("product_desc"))
    )
    first = F.min(F.when(F.col("product_desc").isNotNull(), F.struct("_pos", "product_desc")))
    named = (
        listed.join(names, "product_id", "left")
        .groupBy(*day, "product_id")
        .agg(first.alias("_name"))
        .groupBy(*day)
        .agg(F.array_sort(F.collect_list("_name")).alias("_n"))
        .select(*day, F.transform("_n", lambda n: n["product_desc"]).alias("_names"))
    )
    by_day = W.orderBy("ds")
    before = F.lag("_names").over(by_day)
    growth = (F.col("win_gmv") - F.col("pre_win_gmv")) / F.nullif(F.col("pre_win_gmv"), F.lit(0)) * 100
    return (
        named.withColumns({"_before": before, "pre_win_gmv": F.lag("win_gmv", 1, 0).over(by_day)})
        .select(
            "ds",
            "window_start",
            "window_end",
            "win_gmv",
            F.nullif(F.array_join("_names", ","), F.lit("")).alias("product_topN_name"),
            F.coalesce(F.array_join("_before", ","), F.lit("")).alias("pre_product_topN_name"),
            percent_text(
                F.coalesce(F.size(F.array_intersect("_names", "_before")), F.lit(0)) / F.lit(float(k)) * 100
            ).alias("similarity_rate"),
            percent_text(growth).alias("dod_rate"),
        )
        .orderBy("ds")
    )
