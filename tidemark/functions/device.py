"""Platform and brand of a device from what the client reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER = "其他"
UNKNOWN_MODEL = "未知"
PLATFORMS = ("iOS", "Android", OTHER)

# Marks that tell the platform and the maker, compared in lower case.
IOS_PLAT, IOS_BRAND = ("iphone", "ios"), ("iphone", "apple")
ANDROID_PLAT, ANDROID_BRAND = ("android",), ("huawei", "xiaomi", "oppo", "vivo", "samsung")
IOS_MAKER = "苹果"
MAKERS = {
    "华为": ("huawei", "honor"),
    "小米": ("xiaomi", "mi ", "redmi"),
    "OPPO": ("oppo",),
    "VIVO": ("vivo",),
    "三星": ("samsung",),
    "一加": ("oneplus",),
    "Realme": ("realme",),
}


def _mentions(col: Column, marks: tuple[str, ...]) -> Column:
    return F.lower(col).rlike("|".join(marks))


def platform_of(plat: Column, brand: Column) -> Column:
    return (
        F.when(_mentions(plat, IOS_PLAT) | _mentions(brand, IOS_BRAND), "iOS")
        .when(_mentions(plat, ANDROID_PLAT) | _mentions(brand, ANDROID_BRAND), "Android")
        .otherwise(OTHER)
    )


def brand_of(device: Column, platform: Column) -> Column:
    """Maker of a device model; every iOS device has the same maker."""
    maker = F.when(platform == "iOS", F.lit(IOS_MAKER))
    for name, marks in MAKERS.items():
        maker = maker.when(_mentions(device, marks), F.lit(name))
    return maker.otherwise(F.lit(OTHER))
