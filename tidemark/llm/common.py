"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders

#: White space that separates words; every other character belongs to a word. Fixed by the contract.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def keep(df: DataFrame) -> DataFrame:
    """Compute once, store the rows in the shared folder and cut the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` evaluated once per row even where ``body`` uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(-1))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: With it Spark drops what a query has shuffled as soon as the query ends, not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(TIDY, None)
    conf.set(TIDY, "true")  # for this write alone: it shuffles for itself, and only its table is read again
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(TIDY) if before is None else conf.set(TIDY, before)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``keep``, as a compressed table in the shared folder; for tables too large for plain rows."""
    return _written(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stored`` for tables that only this block needs: they go when it ends, so nothing that is returned may read them."""
    paths: list[str] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        paths.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
        return _written(df, paths[-1])

    try:
        yield store
    finally:
        for path in paths:
            folders.delete(spark, path)
