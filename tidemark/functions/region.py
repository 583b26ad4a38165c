"""Chinese regions: is a place in China, and in which province."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

COUNTRY = "中国"

# Short name and official suffix of the provinces, in checking order.
MUNICIPALITIES = ("北京", "天津", "上海", "重庆")
PROVINCES = (
    "河北", "山西", "辽宁", "吉林", "黑龙江", "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南",
    "湖北", "湖南", "广东", "海南", "四川", "贵州", "云南", "陕西", "甘肃", "青海", "台湾",
)
AUTONOMOUS = {"内蒙古": "自治区", "广西": "壮族自治区", "西藏": "自治区", "宁夏": "回族自治区", "新疆": "维吾尔自治区"}
SPECIAL = ("香港", "澳门")

OFFICIAL = (
    {name: name + "市" for name in MUNICIPALITIES}
    | {name: name + "省" for name in PROVINCES}
    | {name: name + suffix for name, suffix in AUTONOMOUS.items()}
    | {name: name for name in SPECIAL}
)


def in_china(region: Column) -> Column:
    """Mentions the country, an official province name, or one of the two special regions."""
    names = [COUNTRY, *OFFICIAL.values()]
    return F.coalesce(region.rlike("|".join(names)), F.lit(False))


def province(region: Column) -> Column:
    """Official province named in the text: official names are looked for first, then short ones; none gives ``""``."""
    full = [name + "特别行政区" if name in SPECIAL else official for name, official in OFFICIAL.items()]
    names = F.array(*map(F.lit, [*full, *OFFICIAL]))
    results = F.array(*map(F.lit, [*OFFICIAL.values()] * 2))

    def first_named(place: Column) -> Column:
        hits = F.transform(names, lambda name: F.contains(place, name))
        return F.get(results, F.array_position(hits, F.lit(True)).cast("int") - 1)

    place = strip(F.replace(region, F.lit(COUNTRY), F.lit("")))
    return F.coalesce(F.get(F.transform(F.array(place), first_named), F.lit(0)), F.lit(""))
