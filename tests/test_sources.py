"""Parsing, change capture, cell tables, dated partitions, bucketed tables, option builders."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import cells, changes, database, partitions, rates, records, topics

SCHEMA = records.text_schema("id amount ts", numbers=("ts",))


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_lenient_json_keeps_rows_with_a_bad_field_and_drops_bad_rows(spark):
    good = ['{"id":"a","amount":"1","ts":5}', ' {"id":"b","amount":null}', '{"id":"c","ts":"x"}', '{"other":1}', '{}']
    bad = ["", "text", '{"id":"d"', "[1,2]", '"s"', "5", None]
    df = values(spark, *good, *bad)
    got = sorted(tuple(r) for r in records.parse_json(df, SCHEMA).na.fill("-", ["id"]).collect())
    assert got == sorted([("a", "1", 5), ("b", None, None), ("c", None, None), ("-", None, None), ("-", None, None)], key=str)
    assert records.rejects(df, SCHEMA).count() == len(bad)
    kept = records.parse_json(df, SCHEMA, on_bad="keep")
    assert kept.count() == len(good) + len(bad) and kept.filter("is_bad").count() == len(bad)


def test_strict_json_fails_the_job(spark):
    assert records.parse_json(values(spark, '{"id":"a"}'), SCHEMA, on_bad="fail").count() == 1
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        records.parse_json(values(spark, '{"id":'), SCHEMA, on_bad="fail").collect()


def test_json_lines_files(spark, folder):
    records.write_text(values(spark, '{"id":"a"}', "nothing"), f"{folder}/lines")
    assert [r.id for r in records.read_json_lines(spark, f"{folder}/lines", SCHEMA).collect()] == ["a"]
    records.write_text(values(spark, '{"id":"b"}'), f"{folder}/lines")
    assert [r.id for r in records.read_json_lines(spark, f"{folder}/lines", SCHEMA).collect()] == ["b"]


ROW = records.text_schema("k v")


def change(op, key, value, at, before=None):
    after = None if op == "d" else {"k": key, "v": value}
    return json.dumps({"before": before, "after": after, "source": {"db": "d", "schema": "s", "table": "t"}, "op": op, "ts_ms": at})


def envelopes(spark, *texts):
    return records.parse_json(values(spark, *texts), changes.envelope_schema(ROW))


def test_envelopes_flatten_and_deletes_are_apart(spark):
    df = envelopes(spark, change("r", "1", "a", 1), change("d", "1", None, 2, {"k": "1", "v": "a"}), change("d", "9", None, 3))
    assert [tuple(r) for r in changes.flatten_envelope(df).collect()] == [("1", "a", "d.s.t", "r")]
    assert [tuple(r) for r in changes.deletes(df).collect()] == [("1", "a", "d.s.t", "d")]


def test_table_name_skips_missing_parts(spark):
    text = json.dumps({"after": {"k": "1", "v": "a"}, "source": {"db": "d", "table": "t"}, "op": "c"})
    assert changes.flatten_envelope(envelopes(spark, text)).first().table_name == "d.t"


def test_latest_state_settles_order_by_position_not_arrival(spark):
    gone = {"k": "1", "v": "a"}
    df = envelopes(
        spark,
        change("u", "1", "again", 4),
        change("d", "1", None, 3, gone),
        change("r", "1", "a", 1),
        change("d", "2", None, 9, {"k": "2", "v": "x"}),
        change("r", "2", "x", 2),
        change("r", "3", "only", 1),
    )
    got = sorted(tuple(r) for r in changes.latest_state(df, ["k"], ["ts_ms"]).collect())
    assert got == [("1", "again", "u"), ("3", "only", "r")]


def test_cells_there_and_back(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5), (3, "c", 6)], "id int, name string, n int")
    wide = cells.cells_from_rows(df, "id")
    assert wide.count() == 4
    back = sorted(tuple(r) for r in cells.rows_from_cells(wide, ["name", "n"]).collect())
    assert back == [("1", "a", None), ("2", None, "5"), ("3", "c", "6")]
    assert [r.row_key for r in cells.rows_from_cells(wide, ["name"], limit=2).orderBy("row_key").collect()] == ["1", "2"]
    assert cells.row_count(wide).first().row_count == 3
    documents = {r.row_key: r.document for r in cells.documents_from_cells(wide, limit=1).collect()}
    assert documents == {"1": {"name": "a"}}
    assert sorted(r.row_key for r in cells.delete_keys(cells.rows_from_cells(wide, ["n"]), spark.createDataFrame([("2",)], "row_key string")).collect()) == ["1", "3"]


def test_latest_partition_reads_one_folder(spark, folder):
    df = spark.range(30).withColumn("ds", F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string")))
    records.write_partitioned(df, f"{folder}/t", "ds")
    latest = partitions.latest_partition(spark.read.parquet(f"{folder}/t"))
    assert {r.ds for r in latest.collect()} == {20240103} and latest.count() == 10
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_truncate_keeps_the_schema(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t")
    records.truncate(spark, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 0 and spark.read.parquet(f"{folder}/t").columns == ["id"]


def test_bucketed_table_groups_without_a_shuffle(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop LOCATION '%s'" % folder)
    records.save_bucketed(spark.range(100).withColumnRenamed("id", "user_id"), "shop.profile", "user_id")
    plan = spark.table("shop.profile").groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP DATABASE shop CASCADE")


def test_rate_feed(spark):
    quotes = {n: "1.5" for n in rates.QUOTES}
    body = [{"ccyNbr": "美元", "ccyNbrEng": "美元 USD", **quotes, "ratTim": "10:11:12", "ratDat": "2025年11月04日"}, {"ccyNbr": "无", "ccyNbrEng": "X", **quotes}]
    rows = rates.rate_feed(values(spark, json.dumps({"body": body}), json.dumps({"body": []}), "broken")).collect()
    assert (rows[0].ccy_zh, rows[0].ccy_en, rows[0].ct_time) == ("美元", "USD", "2025-11-04 10:11:12")
    assert json.loads(rows[0].data) == {"ccy_zh": "美元", "ccy_en": "USD", **quotes, "ratTim": "10:11:12", "ratDat": "2025年11月04日"}
    assert len(rows) == 2 and rows[1].ccy_en is None


def test_topic_options_and_messages(spark):
    assert topics.source_options("h:1", "t")["startingOffsets"] == "earliest"
    assert topics.source_options("h:1", "t", 5)["startingTimestamp"] == "5"
    sink = topics.sink_options("h:1", "t", max_request_bytes=10)
    assert sink["kafka.acks"] == "all" and sink["kafka.max.request.size"] == "10"
    df = spark.createDataFrame([(1, "é")], "a int, b string")
    sent = topics.to_topic_value(df, F.col("a"))
    assert (bytes(sent.first().key), bytes(sent.first().value)) == (b"1", '{"a":1,"b":"é"}'.encode())
    raw = spark.createDataFrame([(bytearray(b"x"),), (None,)], "value binary")
    assert [r.value for r in topics.text_values(raw).collect()] == ["x"]


def test_camel_names(spark):
    assert [database.camel(n) for n in ("order_total_amount", "ID", "a__b", "x_1")] == ["orderTotalAmount", "id", "aB", "x1"]


def test_text_dates_stay_local(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert cells.cells_from_rows(df.withColumn("id", F.lit(1)), "id").first().value == "2024-01-01 00:00:00"


def test_the_newest_partition_is_found_by_its_name(spark, folder):
    df = spark.range(30).withColumn("ds", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")))
    df = df.unionByName(spark.sql("SELECT 99L AS id, CAST(NULL AS STRING) AS ds"))
    records.write_partitioned(df, f"{folder}/t", "ds")
    latest = partitions.read_latest(spark, f"{folder}/t")
    assert sorted(r.id for r in latest.collect()) == list(range(2, 30, 3))
    assert {str(r.ds) for r in latest.collect()} == {"2024-01-03"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Subquery" not in plan and "t/ds=2024-01-03" in plan
    assert {p.split("/ds=")[1][:10] for p in latest.inputFiles()} == {"2024-01-03"}
    spark.range(3).withColumn("n", F.col("id") + 9).write.partitionBy("n").parquet(f"{folder}/n")
    assert [r.n for r in partitions.read_latest(spark, f"{folder}/n", "n").collect()] == [11]
    assert partitions.read_latest(spark, f"{folder}/n/n=9").count() == 1


def test_fields_get_their_types_when_they_are_used(spark):
    texts = ['{"id":"1","ts":5,"size":"x"}', '{"id":2,"ts":"7"}', '{"ts":{}}', "[1]", "broken", "", None, ' {"id":null}', '"{"']
    df = spark.createDataFrame([(t, n) for n, t in enumerate(texts)], "value string, n int")
    got = records.typed(records.variant_records(df), records.ORDER_LINE)
    assert sorted((r.n, r.id, r.ts, r.size) for r in got.collect()) == [(0, "1", 5, "x"), (1, "2", 7, None), (2, None, None, None), (7, None, None, None)]
    plan = got.select("id", "ts")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get") == 2 and plan.lower().count("parsejson") == 1
