"""New products: recent launches, launch monitor, launch calendar, over the offline tables.

Tables with a ``ds`` column are read at their latest partition. Payments are matched to launches by product *and* span of
time: spans are as long as the launch period, so a period meets two of them at most and a launch costs two rows. The spans of
a product spread over tasks, and since the sum is by launch a skewed join partition may still be split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import top_rows
from tidemark.sources.partitions import latest_partition

PERIOD = "最近30天"


def _latest(df: DataFrame) -> DataFrame:
    return latest_partition(df) if "ds" in df.columns else df


def launches(products: DataFrame, history: DataFrame) -> DataFrame:
    """Products with their online dates; repeated rows count once."""
    online = (
        _latest(history)
        .filter((F.col("online_status") == 1) & F.col("online_time").isNotNull())
        .select("product_id", "online_date", "online_time")
        .distinct()
    )
    info = _latest(products).select("product_id", "product_title", "product_code", "product_image").distinct()
    return info.join(online, "product_id")


def _paid(orders: DataFrame) -> DataFrame:
    return _latest(orders).filter(F.col("payment_status") == 1)


def launch_spans(starts: DataFrame, days: int = 30) -> DataFrame:
    """``product_id, online_time, _end, _span``: each launch once for every span of ``days`` days that its period meets, one or two."""
    end = F.col("online_time") + F.make_dt_interval(F.lit(days))
    spans = F.sequence(_span(F.col("online_time"), days), _span(end, days))
    return starts.select("product_id", "online_time").distinct().withColumns({"_end": end, "_span": F.explode(spans)})


def _span(at: Column, days: int) -> Column:
    # a period of no days still takes a span of one
    return F.floor(F.unix_date(F.to_date(at)) / max(days, 1))


def payments_after(orders: DataFrame, starts: DataFrame, days: int = 30) -> DataFrame:
    """``product_id, online_time, paid``: sum of payments from each launch to ``days`` days after it."""
    paid = _paid(orders).select("product_id", "payment_time", "payment_amount")
    return (
        paid.withColumn("_span", _span(F.col("payment_time"), days))
        .join(launch_spans(starts, days), ["product_id", "_span"])
        .filter(F.col("payment_time").between(F.col("online_time"), F.col("_end")))
        .groupBy("product_id", "online_time")
        .agg(F.sum("payment_amount").alias("paid"))
    )


def _money(column) -> F.Column:
    return F.coalesce(column, F.lit(0)).cast("decimal(38,2)")


def recent_launches(
    products: DataFrame, history: DataFrame, orders: DataFrame, days: int = 30, k: int | None = 50
) -> DataFrame:
    """The last ``k`` launches with their payments in the first ``days`` days, newest first; ``k=None`` gives all."""
    found = launches(products, history)
    result = (
        found.join(payments_after(orders, found, days), ["product_id", "online_time"], "left")
        .withColumn(f"total_payment_{days}d", _money(F.col("paid")))
        .filter(F.col(f"total_payment_{days}d") >= 0)
        .select(
            "product_id", "product_title", "product_code", "product_image", "online_date", "online_time", f"total_payment_{days}d"
        )
    )
    newest = [F.desc("online_time"), F.asc("product_id")]
    return result if k is None else top_rows(result, newest, k, "rn")


def _fan_out(tags: DataFrame, viewers: DataFrame, found: DataFrame) -> DataFrame:
    """How often the plain five-way join repeats a payment of each product."""
    tagged = tags.groupBy("product_id").agg(F.count(F.lit(1)).alias("_tags"))
    seen = viewers.groupBy("product_id").agg(F.count(F.lit(1)).alias("_viewers"))
    return (
        found.select("product_id")
        .distinct()
        .join(tagged, "product_id")
        .join(seen, "product_id", "left")
        .select("product_id", (F.col("_tags") * F.coalesce("_viewers", F.lit(1))).alias("_times"))
    )


def launch_monitor(
    products: DataFrame,
    history: DataFrame,
    tags: DataFrame,
    orders: DataFrame,
    behavior: DataFrame,
    days: int = 30,
    view_type: str = "pv",
    label: str = PERIOD,
    faithful: bool = False,
) -> DataFrame:
    """One row on the tagged new products: products, payments, paid orders, buyers, and orders per 100 viewers.

    Each figure is aggregated on its own, so viewers do not multiply payments. ``faithful=True`` gives the payment sum
    of the plain join, where they do, by weighting each product's payments instead of making the pairs. No new product
    gives no row.
    """
    new_tags = _latest(tags).filter(F.col("is_tmall_new_product") == 1).select("product_id")
    found = launches(products, history).join(new_tags, "product_id", "left_semi")
    wanted = found.select("product_id").distinct()
    viewers = (
        _latest(behavior)
        .filter(F.col("behavior_type") == view_type)
        .select("user_id", "product_id")
        .join(wanted, "product_id", "left_semi")
        .distinct()
    )
    # orders are read once for all figures: a paid line adds its amount for every launch it follows closely enough
    per_product = found.select("product_id", "online_time").distinct().groupBy("product_id").agg(F.collect_list("online_time").alias("_launched"))
    per_product = per_product.withColumn("_times", F.lit(1).cast("bigint"))
    if faithful:
        per_product = per_product.drop("_times").join(_fan_out(new_tags, viewers, found), "product_id")
    paid = _paid(orders).select("product_id", "order_id", "user_id", "payment_time", "payment_amount").join(per_product, "product_id")
    period = F.make_dt_interval(F.lit(days))
    follows = F.filter("_launched", lambda t: F.col("payment_time").between(t, t + period))
    repeats = (F.size(follows) * F.col("_times")).cast("decimal(18,0)")
    # lines of an order collapse to one row before the shuffle
    bought_by = paid.groupBy("order_id", "user_id").agg(F.sum(F.col("payment_amount") * repeats).alias("paid"))
    bought = F.struct(
        _money(F.sum("paid")).alias("paid"), F.count_distinct("order_id").alias("orders"), F.count_distinct("user_id").alias("users")
    )
    figures = {
        "new_product_count": wanted.agg(F.count(F.lit(1))),
        "_bought": bought_by.agg(bought),
        "_viewers": viewers.agg(F.count_distinct("user_id")),
    }
    # one-row results side by side: each is a scalar subquery
    one = products.sparkSession.range(1).select(*(df.scalar().alias(name) for name, df in figures.items()))
    rate = F.round(F.col("_bought.orders") * F.lit(100.0).cast("decimal(4,1)") / F.col("_viewers"), 2)
    return one.filter(F.col("new_product_count") > 0).select(
        F.lit(label).alias("period_type"),
        "new_product_count",
        F.col("_bought.paid").alias("total_payment_amount"),
        F.col("_bought.orders").alias("total_order_count"),
        F.col("_bought.users").alias("total_user_count"),
        F.when(F.col("_viewers") > 0, rate).otherwise(F.lit(0)).cast("decimal(38,2)").alias("conversion_rate"),
    )


def launch_calendar(products: DataFrame, history: DataFrame, orders: DataFrame, days: int = 30) -> DataFrame:
    """Launches per online date with their payments in the first ``days`` days, in order of dates."""
    found = launches(products, history)
    paid = payments_after(orders, found, days)
    return (
        found.join(paid, ["product_id", "online_time"], "left")
        .groupBy("online_date")
        .agg(
            F.count_distinct("product_id").alias("new_product_count"),
            _money(F.sum("paid")).alias(f"total_payment_{days}d"),
        )
        .select(
            "online_date",
            "new_product_count",
            f"total_payment_{days}d",
            F.year("online_date").alias("year"),
            F.month("online_date").alias("month"),
            F.day("online_date").alias("day"),
        )
        .orderBy("online_date")
    )
