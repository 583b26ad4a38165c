"""The reports' input tables, expressed over the given tables: in Spark, and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the user log reports per user or event.
REGIONS = ("中国 广东省 深圳市", "中国 北京市", "北京市", "美国 加州", "广东", "中国 内蒙古 包头")
OPERATIONS = ("tap", "scroll", "")
BRANDS = ("Apple", "HUAWEI", "Xiaomi", "OPPO", "其他", "")
DEVICES = ("iPhone 15", "HUAWEI P60", "Redmi Note 12", "OPPO Reno", "Nokia 8", "")
PLATS = ("iPhone OS", "Android", "", "HarmonyOS")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _pick_sql(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST({number} % {len(values)} + 1 AS INTEGER)]"


def product_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k")


def lines_from(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        product_of().alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("string").alias("sale_num"),
        F.col("value").cast("decimal(10,2)").cast("string").alias("total_amount"),
        "ts",
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_from(table(spark, sf, "events"))


ORDER_LINES = """order_lines AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS product_id,
         1 + event_id % 5 AS sale_num, CAST(value AS DECIMAL(18,2)) AS amount, ts,
         CAST(ts AS DATE) AS day, date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + CAST(floor(date_part('second', ts)) AS BIGINT) AS sec
  FROM events WHERE event_type = 'purchase')"""


def logs_from(events: DataFrame) -> DataFrame:
    number = F.col("event_id")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("log_type"),
        "ts",
        _pick(REGIONS, F.col("user_id")).alias("region"),
        _pick(OPERATIONS, number).alias("opa"),
        F.concat(F.lit("page_"), (product_of().cast("int") % 7).cast("string")).alias("pageinfo"),
        _pick(BRANDS, number).alias("brand"),
        _pick(DEVICES, number).alias("device"),
        _pick(PLATS, number).alias("plat"),
        F.concat(F.lit("v"), (number % 3).cast("string")).alias("platv"),
        F.concat(F.lit("1."), (number % 5).cast("string")).alias("softv"),
    )


def user_logs(spark: SparkSession, sf: str) -> DataFrame:
    return logs_from(table(spark, sf, "events"))


USER_LOGS = f"""user_logs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type AS log_type, ts,
         {_pick_sql(REGIONS, 'user_id')} AS region, {_pick_sql(OPERATIONS, 'event_id')} AS opa,
         'page_' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 7) AS pageinfo,
         {_pick_sql(BRANDS, 'event_id')} AS brand, {_pick_sql(DEVICES, 'event_id')} AS device,
         {_pick_sql(PLATS, 'event_id')} AS plat, 'v' || (event_id % 3) AS platv, '1.' || (event_id % 5) AS softv
  FROM events)"""


def search_logs(spark: SparkSession, sf: str) -> DataFrame:
    return searches_from(table(spark, sf, "events"), table(spark, sf, "part"))


def searches_from(events: DataFrame, part: DataFrame) -> DataFrame:
    numbered = events.select("event_id", product_of().cast("bigint").alias("p_partkey"))
    named = numbered.join(part.select("p_partkey", "p_name"), "p_partkey")
    comma = F.when(F.col("event_id") % 2 == 0, "，").otherwise(",")
    return named.select("event_id", F.replace(F.col("p_name"), F.lit(" "), comma).alias("keywords"))


def product_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_desc"))


def product_info(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_brand").alias("product_code"),
        F.col("p_type").alias("product_image"),
    )


def online_history(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.min("l_shipdate").alias("online_time")
    )
    return first.select("product_id", F.lit(1).alias("online_status"), F.to_date("online_time").alias("online_date"), "online_time")


def order_info(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_linestatus", "l_extendedprice")
    buyers = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("payment_status"),
        F.col("l_shipdate").alias("payment_time"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_amount"),
    )


def new_tags(spark: SparkSession, sf: str) -> DataFrame:
    tag = F.when(F.col("p_type") == "PROMO", 1).otherwise(0)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), tag.alias("is_tmall_new_product"))


def user_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "user_id", product_of().cast("bigint").alias("product_id"), F.col("event_type").alias("behavior_type")
    )


LAUNCH_TABLES = """online AS (SELECT l_partkey AS product_id, MIN(l_shipdate) AS online_time FROM lineitem GROUP BY l_partkey),
paid AS (
  SELECT l_partkey AS product_id, l_orderkey AS order_id, o_custkey AS user_id, l_shipdate AS payment_time,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'),
paid30 AS (
  SELECT o.product_id, SUM(p.amount) AS amount FROM online o JOIN paid p ON p.product_id = o.product_id
  WHERE p.payment_time >= o.online_time AND p.payment_time <= o.online_time + INTERVAL 30 DAY GROUP BY o.product_id)"""


def change_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return envelopes_from(table(spark, sf, "orders"))


def envelopes_from(orders: DataFrame) -> DataFrame:
    """Envelopes as JSON text: every order read once, every fifth updated, every seventh deleted."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    status = F.col("o_orderstatus").alias("o_orderstatus")
    old = F.struct("o_orderkey", "o_custkey", status, price.cast("string").alias("o_totalprice"))
    new = F.struct("o_orderkey", "o_custkey", status, (price + 1).cast("string").alias("o_totalprice"))
    source = F.struct(F.lit("shop").alias("db"), F.lit("oms").alias("schema"), F.lit("orders").alias("table"))
    none = F.lit(None).cast(_ROW)

    def change(before: Column, after: Column, op: str, ts_ms: int) -> Column:
        return F.struct(
            before.alias("before"), after.alias("after"), source.alias("source"), F.lit(op).alias("op"), F.lit(ts_ms).alias("ts_ms")
        )

    changes = F.array(
        F.to_json(change(none, old, "r", 1)),
        F.when(F.col("o_orderkey") % 5 == 0, F.to_json(change(old, new, "u", 2))),
        F.when(F.col("o_orderkey") % 7 == 0, F.to_json(change(old, none, "d", 3))),
    )
    return orders.select(F.explode(F.array_compact(changes)).alias("value"))


_ROW = "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:string>"


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text per event, some of it damaged: cut off, not JSON, empty, a wrong field type, a null, a missing field."""
    number = F.col("event_id")
    head = F.concat(F.lit('{"id":"'), number.cast("string"), F.lit('"'))
    amount = F.concat(F.lit(',"total_amount":"'), F.col("value").cast("decimal(10,2)").cast("string"), F.lit('"'))
    stamp = F.concat(F.lit(',"ts":'), _epoch(number).cast("string"))
    value = (
        F.when(number % 10 == 0, head)
        .when(number % 10 == 1, F.col("event_type"))
        .when(number % 10 == 2, F.lit(""))
        .when(number % 10 == 3, F.concat(head, amount, F.lit(',"ts":"soon"}')))
        .when(number % 10 == 4, F.concat(head, F.lit(',"total_amount":null'), stamp, F.lit("}")))
        .when(number % 10 == 5, F.concat(head, stamp, F.lit("}")))
        .otherwise(F.concat(head, amount, stamp, F.lit("}")))
    )
    return table(spark, sf, "events").select("event_id", value.alias("value"))


def _epoch(number: Column) -> Column:
    # odd events in seconds, even ones in milliseconds
    return F.when(number % 2 == 1, number + 1_700_000_000).otherwise((number + 1_700_000_000) * 1000)


def renamed_products(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of product names, ``n``-th by product: there from 2024-01-03, each renamed some hours later, every third deleted after another day."""
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), "p_partkey", "p_name")
    begin = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")

    def change(n: int, hours: Column, name: Column, op: str) -> Column:
        at = F.timestamp_add("HOUR", hours.cast("int"), begin)
        return F.struct(at.alias("at"), F.lit(n).alias("n"), name.alias("product_desc"), F.lit(op).alias("op"))

    hours = F.col("p_partkey") % 500
    third = F.when(F.col("p_partkey") % 3 == 0, change(3, hours + 24, F.lit(None).cast("string"), "d"))
    changes = F.array(change(1, F.lit(0), F.col("p_name"), "c"), change(2, hours, F.concat(F.lit("new "), "p_name"), "u"), third)
    return part.select("product_id", F.explode(F.array_compact(changes)).alias("x")).select("product_id", "x.*")


RENAMED = """renamed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, unnest([
    {'at': TIMESTAMP '2024-01-03', 'n': 1, 'name': p_name}, {'at': TIMESTAMP '2024-01-03' + to_hours(p_partkey % 500), 'n': 2, 'name': 'new ' || p_name},
    {'at': CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '2024-01-03' + to_hours(p_partkey % 500 + 24) END, 'n': 3, 'name': NULL}]) AS x FROM part)"""
