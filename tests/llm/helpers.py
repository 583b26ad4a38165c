"""Small frames for the corpus operators."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Invented prose, the same for the same seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, marks only."""
    long = prose(5, 6000)
    return [
        (1, prose(1, 60)), (2, None), (3, ""), (4, "   \n\t "), (5, long), (6, prose(1, 60)), (7, "!!! ???"),
        (None, prose(2, 40)), (None, None), (8, prose(3, 80)), (8, prose(3, 80)), (9, "één naïve 中文 текст"), (10, "a"),
        (11, prose(1, 59) + " new"), (12, "word " * 300), (13, None, None, None),
    ]
