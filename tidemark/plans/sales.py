"""Sales during the day: cumulative sales, their working, top products per window, intraday revenue report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import clock_text, in_days
from tidemark.functions.text import clean_id, present
from tidemark.operators.cumulate import (
    DAY,
    STEP,
    cumulate_partials,
    cumulate_top,
    every_step,
    running_spans,
    step_partials,
    with_bounds,
    with_step,
)
from tidemark.operators.ranking import rank_list, top_per_window

def _clock_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clock_text(F.col(c)) for c in ("window_start", "window_end")})


def _on_day(df: DataFrame, ts: str, date: str | None, zone: str | None) -> DataFrame:
    return df if date is None else in_days(df, ts, date, zone=zone)


def amount_of(column: str = "total_amount"):
    """Lenient two-digit amount: text that is no number counts as missing."""
    return F.col(column).try_cast("decimal(10,2)")


def sale_steps(
    orders: DataFrame, step: str = "10 seconds", date: str | None = None, ts: str = "ts", zone: str | None = None
) -> DataFrame:
    """Sales per step of the day: the part of ``cumulative_sales`` that grows with the data."""
    rows = _on_day(orders, ts, date, zone).filter(present(F.col("total_amount")))
    return step_partials(rows, ts, step, {"total_cumulative_amount": amount_of()}, zone=zone)


def cumulative_from_steps(sums: DataFrame, step: str = "10 seconds", steps: tuple[Column, Column] | None = None) -> DataFrame:
    result = cumulate_partials(sums, step, ["total_cumulative_amount"], steps=steps)
    return result.withColumn("total_cumulative_amount", F.col("total_cumulative_amount").cast("decimal(38,2)"))


def cumulative_sales(
    orders: DataFrame, step: str = "10 seconds", date: str | None = None, ts: str = "ts", zone: str | None = None
) -> DataFrame:
    """``window_start, window_end, total_cumulative_amount`` for every step of ``date``, or of every day."""
    return cumulative_from_steps(sale_steps(orders, step, date, ts, zone), step)


def sale_lines(
    orders: DataFrame, step: str = "10 minutes", date: str | None = None, ts: str = "ts", zone: str | None = None
) -> DataFrame:
    """The working of the cumulative sums as rows: each order line once, with the first window that includes it.

    A window's working is the lines of its day whose ``first_window_end`` is not after the window's end. Nothing is
    grouped, so it holds at any size, where the text of ``cumulative_process`` grows with the day.
    """
    rows = _on_day(orders, ts, date, zone).filter(present(F.col("total_amount")))
    line = with_bounds(with_step(rows, ts, step, zone), step)
    return line.select("window_start", F.col("window_end").alias("first_window_end"), ts, "id", amount_of().alias("amount"))


def cumulative_process(
    orders: DataFrame, step: str = "10 minutes", date: str | None = None, ts: str = "ts", zone: str | None = None
) -> DataFrame:
    """Cumulative sales with their working, ``id(amount)+id(amount)…`` in time order, as text.

    The lines of a step are joined first, then the steps of a day, so a day's lines are never sorted in one task. The
    last text of a day still holds the whole day: use ``sale_lines`` where a day does not fit in a string.
    """
    rows = _on_day(orders, ts, date, zone).filter(present(F.col("total_amount")))
    lines = with_step(rows, ts, step, zone).select(DAY, STEP, F.col(ts).alias("_at"), "id", amount_of().alias("_amount"))
    written = F.concat("id", F.lit("("), F.col("_amount").cast("string"), F.lit(")"))
    line = F.when(written.isNotNull(), F.struct("_at", "id", written.alias("_text")))
    parts = lines.groupBy(DAY, STEP).agg(
        F.sum("_amount").alias("period_amount"), F.array_sort(F.collect_list(line)).alias("_lines")
    )
    # a step without readable lines adds nothing to the text: NULL, which lists leave out
    text = F.array_join(F.transform("_lines", lambda x: x["_text"]), "+")
    parts = parts.withColumn("cumulative_process", F.nullif(text, F.lit(""))).drop("_lines")
    spans = running_spans(parts, step, ["period_amount"], lists=["cumulative_process"])
    return with_bounds(every_step(spans), step).withColumns(
        {
            "period_amount": F.col("period_amount").cast("decimal(38,2)"),
            "cumulative_process": F.nullif(F.array_join("cumulative_process", "+"), F.lit("")),
        }
    )


def tumble_top5(
    orders: DataFrame,
    window: str = "5 minutes",
    date: str | None = None,
    k: int = 5,
    ts: str = "ts",
    key: str = "id",
    zone: str | None = None,
) -> DataFrame:
    """``window_start, window_end, top5_ids``: the ids with most pieces sold per window, one place per rank."""
    rows = _on_day(orders, ts, date, zone).filter(present(F.col("sale_num")) & present(F.col(key)))
    top = top_per_window(rows, ts, window, key, F.col("sale_num").try_cast("int"), k, zone)
    return top.withColumnRenamed("top_keys", f"top{k}_ids")


def gmv_steps(orders: DataFrame, step: str = "10 minutes", ts: str = "ts", zone: str | None = None) -> DataFrame:
    """Revenue per step and product. Amounts must be numbers: bad text fails the query, as a strict cast does."""
    rows = orders.withColumn("clean_product_id", clean_id(F.col("product_id")))
    money = {"product_gmv": F.col("total_amount").cast("decimal(18,2)")}
    return report_money(step_partials(rows, ts, step, money, ["clean_product_id"], zone))


def report_money(steps: DataFrame) -> DataFrame:
    """Sums in the report's own money type: its results must fit it, and it sorts as a plain number."""
    return steps.withColumn("product_gmv", F.col("product_gmv").cast("decimal(18,2)"))


def gmv_topn_from_steps(
    sums: DataFrame, step: str = "10 minutes", k: int = 5, steps: tuple[Column, Column] | None = None, with_total: bool = True
) -> DataFrame:
    """Report rows from revenue per step and product, of all steps or of ``steps``; see ``gmv_topn``."""
    ranked = cumulate_top(sums, step, "clean_product_id", "product_gmv", k, steps)
    top = rank_list(
        ranked, [DAY, STEP], "clean_product_id", k, F.sum("product_gmv").cast("decimal(18,2)").alias("win_gmv"), pad=False
    )
    report = top
    if with_total:
        totals = sums.groupBy(DAY, STEP).agg(F.sum("product_gmv").alias("total_gmv"))
        total = every_step(running_spans(totals, step, ["total_gmv"], steps=steps))
        report = top.join(total, [DAY, STEP]).withColumn("total_gmv", F.col("total_gmv").cast("decimal(18,2)"))
    report = _clock_bounds(with_bounds(report, step))
    return report.select(
        F.to_date("window_start").alias("ds"),
        "window_start",
        "window_end",
        "win_gmv",
        F.col("top_list").alias("win_gmv_ids"),
        F.col("top_list").alias(f"top{k}_product_ids"),
        *(["total_gmv"] if with_total else []),
    )


def gmv_topn(
    orders: DataFrame, step: str = "10 minutes", k: int = 5, ts: str = "ts", zone: str | None = None, with_total: bool = True
) -> DataFrame:
    """Intraday report: per cumulative window the ``k`` products with the greatest revenue.

    ``win_gmv`` is the revenue of the listed products and ``win_gmv_ids`` repeats their list, as the report table
    defines them; ``total_gmv`` is the revenue of all products. Both come from one exchange of the step sums.
    """
    return gmv_topn_from_steps(gmv_steps(orders, step, ts, zone), step, k, with_total=with_total)
