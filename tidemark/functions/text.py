"""Text cleaning and small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Space and every control character below it.
BLANKS = "".join(map(chr, range(0x21)))

# Fixed value: characters a name or comment may consist of.
VALID_TEXT = (
    r"^[一-龥a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%\^&*(、，。；‘【】！@#￥%……&*（）)\"]+\z"
)


def strip(col: Column) -> Column:
    """Trim spaces, tabs, line breaks and other control characters on both ends (SQL ``trim`` takes spaces only)."""
    return F.trim(col, F.lit(BLANKS))


def field(col: Column, default: str = "") -> Column:
    """Stripped text of an optional field; missing gives ``default``."""
    return F.coalesce(strip(col.cast("string")), F.lit(default))


def present(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def is_blank(col: Column) -> Column:
    return F.coalesce(strip(col) == "", F.lit(True))


def is_empty(col: Column) -> Column:
    return F.coalesce(col == "", F.lit(True))


def clean_id(col: Column) -> Column:
    """Remove line breaks, real or written as backslash-n, then trim spaces."""
    return F.trim(F.replace(F.replace(col, F.lit("\\n"), F.lit("")), F.lit("\n"), F.lit("")))


def words(col: Column) -> Column:
    """Split on half- or full-width commas, strip each part, drop the empty ones."""
    return F.filter(F.transform(F.split(col, "[,，]"), strip), lambda w: w != "")


def valid_text(col: Column) -> Column:
    return col.rlike(VALID_TEXT)


def upper_first(col: Column) -> Column:
    return F.concat(F.upper(F.substring(col, 1, 1)), F.substr(col, F.lit(2)))


def lower_first(col: Column) -> Column:
    return F.concat(F.lower(F.substring(col, 1, 1)), F.substr(col, F.lit(2)))


def join_list(col: Column, delimiter: str) -> Column:
    return F.array_join(col, delimiter)


def to_csv_text(col: Column) -> Column:
    return join_list(col, ", ")


def repeated(char: str, n: int | Column) -> Column:
    return F.repeat(F.lit(char), n if isinstance(n, Column) else F.lit(n))


def zeros(n: int | Column) -> Column:
    return repeated("0", n)


def append_list(col: Column, item: Column, as_json: bool = True) -> Column:
    """Append to a list held as JSON text. ``as_json=False`` writes the plain ``[a, b]`` form instead."""
    items = F.array_append(F.coalesce(F.from_json(col, "array<string>"), F.array().cast("array<string>")), item)
    return F.to_json(items) if as_json else F.concat(F.lit("["), F.array_join(items, ", ", "null"), F.lit("]"))


def payload_words(col: Column) -> Column:
    """Cut a prefixed hex payload into its 64-digit words, each with ``0x`` put back in front.

    NULL and empty text give an empty list; a payload too short for its last word gives NULL.
    """
    n = F.floor(F.length(col) / 64).cast("int")
    cut = F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("0x"), F.substr(col, 3 + i * 64, F.lit(64)))),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(F.coalesce(F.length(col), F.lit(0)) == 0, F.array().cast("array<string>")).when(
        (n == 0) | (F.length(col) >= n * 64 + 2), cut
    )
