"""Operator 4: quality rules with robust multivariate outliers. DataFrame operations only.

``statistics`` counts on the whole text of each row, inside the row, without a shuffle. ``fit`` estimates location and
scatter per (lang, source) by the minimum covariance determinant. From each of two starts, the quartiles of all rows and those of the group,
concentration steps keep the ``SUPPORT`` share of a group with the smallest distances and estimate anew from it, for as long as the
determinant of some group falls; an estimate is only replaced by one of smaller determinant, so the steps settle. Of the two ends the one
with the smaller determinant counts; a reweighting step follows. ``judge`` rejects rows whose squared Mahalanobis
distance from their group's estimate exceeds the ``CUT`` quantile of the chi-squared distribution.

Every group has its own estimate, whatever its size: its rows count beside ``PRIOR`` rows that are as those of its language, and those of
a language beside ``PRIOR`` rows that are as those of all. So a large group is judged by itself and a small one mostly by its language,
with no size at which one turns into the other. The share of a group that a
concentration step keeps is read off a histogram of log distances, so a hot group is never sorted in one task: all sums and
counts combine inside tasks first.

Defined cases: null text has no words; null lang and null source are groups like others; repeated rows get equal verdicts;
an empty table gives an empty result. Rows of a group that the fit has not seen are kept unless a base rule fails. Added columns sit in one struct column whose name no input column has.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import SPACE_CHARS, fresh, keep, let, stored, table, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
#: Share of a group that a concentration step keeps, and chi-squared quantiles for reweighting and for rejection.
SUPPORT, REWEIGHT, CUT = 0.75, 0.975, 0.999
#: Rows of its language that a group counts beside its own, and of all rows that a language does.
PRIOR = 50
#: Least fall of a log determinant that counts as one.
SETTLED = 0.1
#: Log-distance bins per unit of the natural logarithm.
BINS = 32
#: The transformed statistics, with the standard deviation that is added to each as a floor: most are 0 in most texts, and
#: without a floor the estimate is singular and any other value would be rejected.
FEATURES = {"word_length": 0.10, "symbols": 0.015, "dup_lines": 0.08, "repeats": 0.06, "capitals": 0.05, "marks": 0.05}
NAMES = tuple(FEATURES)


def chi2_quantile(p: float, d: int) -> float:
    """Wilson and Hilferty's approximation."""
    z = NormalDist().inv_cdf(p)
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


def chi2_share(x: float, d: int) -> float:
    return NormalDist().cdf(((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more among ``words``."""

    def covered(windows: Column) -> Column:
        def near(pairs: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                return x["h"].eqNullSafe(F.get(pairs, k - 1)["h"]) | x["h"].eqNullSafe(F.get(pairs, k + 1)["h"])

            places = F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"]))
            steps = let(
                places,
                lambda at: F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)

        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(let(pairs, near))

    last = F.size(words) - WINDOW
    starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(last < 1, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def statistics(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into`` of counts and transformed statistics."""
    body = F.coalesce(docs[text], F.lit(""))

    def without(chars: str) -> Column:
        return F.length(F.translate(body, chars, ""))

    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, SPACE_CHARS, "") != "")
    counted = let(words_of(docs[text]), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    parts = docs.withColumn(
        into,
        F.struct(
            counted.alias("words"),
            without(SPACE_CHARS).cast("long").alias("word_chars"),
            (F.length(body) - without(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"),
            F.regexp_count(body, F.lit(r"\p{Lu}")).alias("capitals"),
            (F.length(body) - without("!?")).alias("marks"),
        ),
    )
    c = F.col(into)
    n, chars = c["words"]["n"], c["word_chars"]
    some, some_chars = F.greatest(n, F.lit(1)), F.greatest(chars, F.lit(1))
    base_failed = (n < MIN_WORDS) | (100 * c["words"]["r"] > MAX_REPEAT_PERCENT * n)
    return parts.withColumn(
        into,
        F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            (c["lines"]["n"] - c["lines"]["d"]).cast("long").alias("n_dup_lines"),
            c["words"]["r"].alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            # a few words say little about a share: each is drawn to a usual value, as if by some more words of that kind
            F.log((chars + 100) / (n + 20)).alias("word_length"),
            F.log1p(c["n_symbols"] / some_chars).alias("symbols"),
            ((c["lines"]["n"] - c["lines"]["d"]) / (c["lines"]["n"] + 4)).alias("dup_lines"),
            (c["words"]["r"] / (some + 20)).alias("repeats"),
            (c["capitals"] / (some_chars + 20)).alias("capitals"),
            (c["marks"] / (some_chars + 20)).alias("marks"),
        ),
    )


def _label(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


GROUP = ["lang_", "source_"]
KEYS = [*GROUP, "start"]
D = len(NAMES)
#: Places (row, column) of the lower triangle, in the order of the arrays ``l`` and of the products in ``x``.
PLACES = [(i, j) for i in range(D) for j in range(i + 1)]
#: What estimates consist of: means, and the Cholesky factor of the scatter. Arrays, so that plans stay small.
FACTOR = ["m", "l"]
#: Files of a table with a row per group.
FILES = 8


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2`` from the columns m and l: forward substitution, one step a level. A filter by it would be pushed below the steps and
    repeat them in itself."""
    for i, name in enumerate(NAMES):
        rest = F.col(name) - F.col("m")[i]
        for j in range(i):
            rest = rest - F.col("l")[PLACES.index((i, j))] * F.col(f"z_{j}")
        rows = rows.withColumn(f"z_{i}", rest / F.col("l")[PLACES.index((i, i))])
    return rows.withColumn("d2", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, D)), F.col("z_0") * F.col("z_0")))


def _square_distance(values: Column, m: Column, l: Column) -> Column:
    """The same as one expression over arrays."""

    def step(z: Column, i: Column) -> Column:
        own = F.slice(l, (i * (i + 1) / 2).cast("int") + 1, i + 1)
        known = F.aggregate(F.zip_with(F.slice(own, F.lit(1), i), z, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
        return F.concat(z, F.array((F.get(values, i) - F.get(m, i) - known) / F.get(own, i)))

    scaled = F.aggregate(F.array(*map(F.lit, range(D))), F.array().cast("array<double>"), step)
    return F.aggregate(scaled, F.lit(0.0), lambda total, x: total + x * x)


def _factor(moments: DataFrame, scale: float) -> DataFrame:
    """Means, Cholesky factor and log determinant from sums; the scatter is ``scale`` times the covariance plus the floors."""
    x, n = F.col("x"), F.col("x")[0]
    means = moments.select(*KEYS, "x", F.transform(F.slice(x, 2, D), lambda s: s / n).alias("m"))
    floors = {i: FEATURES[name] ** 2 for i, name in enumerate(NAMES)}
    covs = []
    for place, (i, j) in enumerate(PLACES):
        cov = scale * (x[1 + D + place] / n - F.col("m")[i] * F.col("m")[j])
        if i == j:
            cov = F.greatest(cov, F.lit(0.0)) + floors[i]
        above = PLACES.index((j, 0))
        covs.append(F.struct(cov.alias("cov"), F.lit(j).alias("j"), F.lit(above).alias("above"), F.lit(floors[i] / 100 if i == j else 0.0).alias("least")))

    def step(l: Column, c: Column) -> Column:
        # the columns before this one, of this row and of row j
        own, other = F.slice(l, F.size(l) - c["j"] + 1, c["j"]), F.slice(l, c["above"] + 1, c["j"])
        rest = F.aggregate(F.zip_with(own, other, lambda a, b: a * b), c["cov"], lambda total, y: total - y)
        return F.concat(l, F.array(F.when(c["least"] > 0, F.sqrt(F.greatest(rest, c["least"]))).otherwise(rest / F.get(l, c["above"] + c["j"]))))

    factor = means.select(*KEYS, "m", F.aggregate(F.array(*covs), F.array().cast("array<double>"), step).alias("l"))
    logdet = sum((2 * F.log(F.col("l")[PLACES.index((i, i))]) for i in range(1, D)), 2 * F.log(F.col("l")[0]))
    return factor.select(*KEYS, *FACTOR, logdet.alias("logdet"))


def _by_group(df: DataFrame) -> DataFrame:
    """A table with a row per group, stored in few files. Spark sees its size, so while it is small no row is shuffled to be joined with it."""
    return stored(df.coalesce(FILES), "groups")


def _summed(values: list[Column]) -> Column:
    return F.array(*(F.coalesce(F.sum(v), F.lit(0.0)) for v in values)).alias("x")


def _moments(rows: DataFrame) -> DataFrame:
    """``x``: count, sums and sums of products of the rows that are ``inside``. Stored, as several small tables are made of it."""
    features = [F.col(name) for name in NAMES]
    values = [F.lit(1.0), *features, *(features[i] * features[j] for i, j in PLACES)]
    return _by_group(rows.groupBy(*KEYS).agg(_summed([F.when(F.col("inside"), v) for v in values])))


def _beside(own: DataFrame, above: DataFrame, on: list[str]) -> DataFrame:
    """Sums with ``PRIOR`` rows as those above added."""
    wider = above.select(*on, F.col("x").alias("p"))
    rest = [c for c in own.columns if c != "x"]
    return own.join(wider, on).select(*rest, F.zip_with("x", "p", lambda a, b: a + PRIOR * b / F.col("p")[0]).alias("x"))


def _shrunk(moments: DataFrame) -> DataFrame:
    """Sums of every group beside those of its language, and of that beside those of all. These tables have a row per group."""
    each = [F.col("x")[k] for k in range(1 + D + len(PLACES))]
    by_lang = moments.groupBy("lang_", "start").agg(_summed(each))
    by_all = by_lang.groupBy("start").agg(_summed(each))
    return _beside(moments, _beside(by_lang, by_all, ["start"]), ["lang_", "start"])


def _quartiles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Medians and quartile widths, as a diagonal factor."""
    spread = rows.groupBy(*keys).agg(*(F.percentile_approx(NAMES[i], [0.25, 0.5, 0.75], 1000).alias(f"p_{i}") for i in range(D)))
    wide = [F.sqrt(F.pow((F.col(f"p_{i}")[2] - F.col(f"p_{i}")[0]) / 1.349, 2) + FEATURES[NAMES[i]] ** 2) for i in range(D)]
    means = F.array(*(F.col(f"p_{i}")[1] for i in range(D)))
    return spread.select(*keys, means.alias("m"), F.array(*(wide[i] if i == j else F.lit(0.0) for i, j in PLACES)).alias("l"))


def _concentrated(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Whether rows are ``inside`` the ``SUPPORT`` share of their group with the smallest distances, to the end of a histogram bin."""
    near = _distance(rows.join(model.select(*KEYS, *FACTOR), KEYS)).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * BINS))
    group = Window.partitionBy(*KEYS)
    counted = near.groupBy(*KEYS, "bin").count().withColumns({"upto": F.sum("count").over(group.orderBy("bin")), "all": F.sum("count").over(group)})
    limit = _by_group(counted.groupBy(*KEYS).agg(F.min(F.when(F.col("upto") >= F.ceil(SUPPORT * F.col("all")), F.col("bin"))).alias("limit")))
    return near.join(limit, KEYS).withColumn("inside", F.col("bin") <= F.col("limit"))


def fit(stats: DataFrame, lang: str = "lang", source: str = "source", of: str = "stats") -> DataFrame:
    """The estimates, a row per (lang, source). ``stats`` is read several times: pass a stored table without texts."""
    s = stats.select(_label(F.col(lang)).alias("lang_"), _label(F.col(source)).alias("source_"), F.col(of).alias("x_"))
    single = keep(s.filter(~F.col("x_.base_failed")).select(*GROUP, *(F.col(f"x_.{name}") for name in NAMES)))
    rows = single.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    own = _by_group(_quartiles(single, GROUP))
    everywhere = _quartiles(single.withColumn("start", F.lit(0)), ["start"])
    first = own.select(*GROUP, F.lit(0).alias("start")).join(everywhere, "start").select(*KEYS, *FACTOR)
    model = _by_group(first.unionByName(own.select(*GROUP, F.lit(1).alias("start"), *FACTOR)).withColumn("logdet", F.lit(float("inf"))))
    consistency = SUPPORT / chi2_share(chi2_quantile(SUPPORT, D), D + 2)
    while True:
        after = _factor(_shrunk(_moments(_concentrated(rows, model))), consistency)
        both = model.select(*KEYS, F.struct(*FACTOR, "logdet").alias("old")).join(after.select(*KEYS, F.struct(*FACTOR, "logdet").alias("new")), KEYS)
        falls = F.col("new.logdet") < F.col("old.logdet") - SETTLED
        both = _by_group(both.select(*KEYS, falls.alias("falls"), F.when(falls, F.col("new")).otherwise(F.col("old")).alias("x")))
        model = both.select(*KEYS, "x.*")
        if not both.agg(F.max("falls")).first()[0]:
            break
    ends = model.groupBy(*GROUP).agg(F.min_by(F.struct(*FACTOR), F.struct("logdet", "start")).alias("x"))
    best = _by_group(ends.select(*GROUP, F.lit(0).alias("start"), "x.*"))
    weighted = _distance(single.withColumn("start", F.lit(0)).join(best, KEYS)).withColumn("inside", F.col("d2") <= chi2_quantile(REWEIGHT, D))
    return _by_group(_factor(_shrunk(_moments(weighted)), REWEIGHT / chi2_share(chi2_quantile(REWEIGHT, D), D + 2)).select(*GROUP, *FACTOR))


def judge(stats: DataFrame, model: DataFrame, lang: str = "lang", source: str = "source", of: str = "stats", into: str = "verdict") -> DataFrame:
    """``stats`` with a struct column ``into`` of (distance, kept)."""
    k, e = fresh(stats, "group_key"), fresh(stats, "estimate")
    lookup = model.select(F.struct(*GROUP).alias(k), F.struct(*FACTOR).alias(e))
    joined = stats.join(lookup, F.struct(_label(stats[lang]).alias("lang_"), _label(stats[source]).alias("source_")) == F.col(k), "left")
    square = _square_distance(F.array(*(F.col(of)[name] for name in NAMES)), F.col(e)["m"], F.col(e)["l"])

    def judged(d2: Column) -> Column:
        return F.struct(F.sqrt(d2).alias("distance"), (~F.col(of)["base_failed"] & F.coalesce(d2 <= chi2_quantile(CUT, D), F.lit(True))).alias("kept"))

    return joined.withColumn(into, let(square, judged)).drop(k, e)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = keep(statistics(docs, "stats").drop("text"))
    x = F.col("stats")
    return judge(stats, fit(stats)).select(
        "doc_id",
        *(x[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
        F.col("verdict")["kept"].alias("kept"),
        F.col("verdict")["distance"].alias("distance"),
    )
