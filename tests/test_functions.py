"""Column functions on hand-made values."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock, device, keys, numeric, region, text
from tidemark.sources.partitions import day_partitions


def each(spark, values, function, kind="string"):
    """``function`` of every value, in order."""
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in df.select(function(F.col("v")).alias("r"), "n").orderBy("n").select("r").collect()]


def test_epoch_seconds_and_millis_on_both_sides_of_the_threshold(spark):
    values = [99_999_999_999, 100_000_000_000, 1_700_000_000, 1_700_000_000_000, None]
    got = each(spark, values, lambda c: F.unix_millis(clock.epoch_to_ts(c)), "bigint")
    assert got == [99_999_999_999_000, 100_000_000_000, 1_700_000_000_000, 1_700_000_000_000, None]
    got = each(spark, [999_999_999_999, 10**12], lambda c: F.unix_millis(clock.epoch_to_ts(c, 10**12)), "bigint")
    assert got == [999_999_999_999_000, 10**12]


def test_day_parts_change_at_their_hours(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 21, 22, 23]
    values = [dt.datetime(2024, 1, 1, h, 59, 59) for h in hours] + [None]
    got = each(spark, values, clock.day_part, "timestamp_ntz")
    night, morning, noon, evening = "22:00-6:00", "6:00-12:00", "12:00-18:00", "18:00-22:00"
    assert got == [night, night, morning, morning, noon, noon, evening, evening, night, night, None]


def test_days_follow_the_zone(spark):
    got = each(spark, [dt.datetime(2024, 1, 1, 15, 59), dt.datetime(2024, 1, 1, 16, 0)], lambda c: clock.day_text(c, "Asia/Shanghai"), "timestamp")
    assert got == ["2024-01-01", "2024-01-02"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_day_range_keeps_midnight_and_drops_the_next(spark, kind):
    stamps = [dt.datetime(2024, 1, 1, 15, 59, 59), dt.datetime(2024, 1, 1, 16), dt.datetime(2024, 1, 2, 15, 59, 59), dt.datetime(2024, 1, 2, 16)]
    df = spark.createDataFrame([(s,) for s in stamps], f"ts {kind}")
    kept = [r.ts for r in clock.in_days(df, "ts", "2024-01-02", zone="Asia/Shanghai").orderBy("ts").collect()]
    assert kept == stamps[1:3]
    assert clock.in_days(df, "ts", "2024-01-01").count() == 2


def test_local_midnight():
    now = dt.datetime(2024, 1, 1, 17, 30, tzinfo=dt.timezone.utc)
    assert clock.local_midnight_ms("Asia/Shanghai", now) == int(dt.datetime(2024, 1, 1, 16, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_since_midnight_takes_an_injected_now(spark):
    stamps = [dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    assert clock.since_midnight(df, "ts", F.lit(dt.datetime(2024, 1, 2, 9))).count() == 2


def test_spans():
    assert [clock.seconds_of(s) for s in ("10 seconds", "1 minute", "2 hours", 30)] == [10, 60, 7200, 30]
    with pytest.raises(ValueError):
        clock.seconds_of("a while")


def test_parse_clock_gives_null_for_bad_text(spark):
    got = each(spark, ["2024-01-02 03:04:05", "soon", None], clock.parse_clock)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_words_take_both_commas(spark):
    got = each(spark, ["a,b，c", "，,a ,\tb\n,,", "", None, "one"], text.words)
    assert got == [["a", "b", "c"], ["a", "b"], [], None, ["one"]]


def test_strip_takes_control_characters(spark):
    assert each(spark, ["\t a b\r\n\x00", " ", None], text.strip) == ["a b", "", None]
    assert each(spark, [None, " x "], lambda c: text.field(c, "unknown")) == ["unknown", "x"]


def test_clean_id_drops_both_line_break_forms(spark):
    assert each(spark, [" 12\n", "1\\n2 ", "\n"], text.clean_id) == ["12", "12", ""]


def test_valid_text(spark):
    values = ["中文abc09", "a b", "", "a\n", "[x]-_+{y}:：“<z>`?!", "é", None]
    assert each(spark, values, text.valid_text) == [True, False, False, False, True, False, None]


def test_first_letters_and_blanks(spark):
    assert each(spark, ["abc", "", None], text.upper_first) == ["Abc", "", None]
    assert each(spark, ["ABC", "é"], text.lower_first) == ["aBC", "é"]
    assert each(spark, ["\t ", "", None, "x"], text.is_blank) == [True, True, True, False]
    assert each(spark, ["\t ", "", None, "x"], text.is_empty) == [False, True, True, False]


def test_append_to_a_list_text(spark):
    grow = lambda c: text.append_list(c, F.lit("z"))
    assert each(spark, [None, '["a","b"]', "[]"], grow) == ['["z"]', '["a","b","z"]', '["z"]']
    assert each(spark, [None, '["a","b"]'], lambda c: text.append_list(c, F.lit("z"), False)) == ["[z]", "[a, b, z]"]


def test_payload_words(spark):
    one, two = "a" * 64, "b" * 64
    values = ["0x" + one + two, "0x" + one + "ff", "0x", "", None, one]
    assert each(spark, values, text.payload_words) == [["0x" + one, "0x" + two], ["0x" + one], [], [], [], None]


def test_hash_bucket(spark):
    import hashlib

    values = ["a", "hello", "0X0000000000000000000000000000000000000000", ""]
    expected = [f"{int(hashlib.md5(v.encode()).hexdigest()[-3:], 16) % 128:04d}" for v in values]
    assert each(spark, values, lambda c: keys.hash_bucket(c, 128)) == expected
    fixed = each(spark, values, lambda c: keys.hash_bucket(c, 128, keys.BUSY_ADDRESSES))
    assert fixed == expected[:2] + ["9001"] + expected[3:]


def test_amounts_are_exact_at_any_length(spark):
    random.seed(7)
    hexes = ["0x" + "".join(random.choice("0123456789abcdefABCDEF") for _ in range(n)) for n in (1, 15, 16, 17, 31, 32, 38, 64, 78, 200)]
    for scale in (0, 18):
        got = each(spark, hexes, lambda c, s=scale: numeric.amount(c, s))
        for text_, result in zip(hexes, got):
            whole, _, part = result.partition(".")
            assert int(whole + part.ljust(scale, "0")) == int(text_, 16)
            assert not part.endswith("0")


def test_amount_edges(spark):
    values = [None, "0x0", "007", "-0", "-12.50", "1e5", "15E-1", "+5", "5.", ".5", "0x", "0xzz", "ten", "", "1" + "0" * 40]
    expected = ["0", "0", "7", "0", "-12.50", "100000", "1.5", "5", "5", "0.5", None, None, None, None, "1" + "0" * 40]
    assert each(spark, values, numeric.amount) == expected
    long = each(spark, ["1e100000", "12.5e3", "1.50e1", "-1E-3", "0e999999999999", ".e5"], numeric.amount)
    assert long == ["1" + "0" * 100000, "12500", "15.0", "-0.001", "0", None]
    edges = ["1e99", "1e100", "1e-100", "1e-101", "1.5e99", "1.5e100", "0e999", "1e99999999999999999999", "-2E-99999999999999999999", ".5e101", "1e", "x", None, "5"]
    far = [False, True, False, True, False, True, False, True, True, True, False, False, False, False]
    assert each(spark, edges, lambda c: numeric.too_long(c, 100)) == far
    written = each(spark, edges, lambda c: numeric.amount(c, longest=100))
    assert [w is None for w in written[:10]] == far[:10] and written[1] is None and written[2] == "0." + "0" * 99 + "1"
    scaled = each(spark, ["1500000000000000000", "1000000000000000000", "0", "-1", "2.00", "10" + "0" * 18 + ".00"], lambda c: numeric.amount(c, 18))
    assert scaled == ["1.5", "1", "0", "-0.000000000000000001", "0.000000000000000002", "10.00"]


def test_provinces(spark):
    values = {
        "中国 广东省 深圳市": "广东省",
        "中国 北京": "北京市",
        "中国 内蒙古 包头": "内蒙古自治区",
        "中国 内蒙古自治区": "内蒙古自治区",
        "新疆维吾尔自治区": "新疆维吾尔自治区",
        "香港特别行政区": "香港",
        "中国 澳门": "澳门",
        "中国": "",
        "美国 加州": "",
        "": "",
        "湖南省到河北省": "河北省",
        "广东到北京市": "北京市",
    }
    assert each(spark, list(values), region.province) == list(values.values())


def test_china_needs_the_country_or_an_official_name(spark):
    values = ["中国", "北京市", "北京", "广东", "香港岛", "美国", "", None]
    assert each(spark, values, region.in_china) == [True, True, False, False, True, False, False, False]


def test_platforms_and_makers(spark):
    rows = [("iPhone OS", ""), ("", "APPLE"), ("android 14", "x"), ("", "Vivo"), ("HarmonyOS", ""), ("android", "apple")]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, plat string, brand string").orderBy("n")
    got = [r[0] for r in df.select(device.platform_of(F.col("plat"), F.col("brand"))).collect()]
    assert got == ["iOS", "iOS", "Android", "Android", "其他", "iOS"]
    models = ["HUAWEI P60", "honor 9", "Mi 11", "Redmi", "xiaomi", "OPPO A", "vivo x", "Samsung", "OnePlus", "realme", "Nokia", ""]
    makers = ["华为", "华为", "小米", "小米", "小米", "OPPO", "VIVO", "三星", "一加", "Realme", "其他", "其他"]
    assert each(spark, models, lambda c: device.brand_of(c, F.lit("Android"))) == makers
    assert each(spark, ["anything"], lambda c: device.brand_of(c, F.lit("iOS"))) == ["苹果"]


def test_day_partitions_are_inclusive(spark):
    assert [r.ds for r in day_partitions(spark, "2024-02-28", "2024-03-01").collect()] == [20240228, 20240229, 20240301]
    assert day_partitions(spark, "2024-03-01", "2024-02-01").count() == 0
