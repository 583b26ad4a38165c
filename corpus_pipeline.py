"""A corpus pipeline: quality rules, language ID, near-duplicate join, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``docs``. Rows are judged as rows: ids may be null or repeat.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, ngram_join, packing, quality, suffixes
from tidemark.llm.common import fresh, shared_dir, stored, table

#: A text goes if no language has this share of its letters.
LEAST_SHARE = 0.5
#: Documents are near duplicates if their sets of so many words in a row have this Jaccard similarity. (op9's 4 words and 85 % are
#: the contract of that query alone.)
WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    stats, verdict = fresh(docs, "stats"), fresh(docs, "verdict")
    counted = stored(quality.statistics(docs, stats), "counted")  # counted once, for the fit and for the judgement
    model = quality.fit(counted.select("lang", "source", stats), of=stats)
    judged = quality.judge(counted, model, of=stats, into=verdict)
    return judged.filter(F.col(verdict)["kept"]).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or without a main language, go. Without a label to learn from, all stay."""
    model = language.train(docs, F.lit(True))
    if not model.languages:
        return docs
    name = fresh(docs, "language")
    found = language.label(docs, model, into=name)
    return found.filter((F.col(name)["lang"] != language.UNKNOWN) & (F.col(name)["score"] >= LEAST_SHARE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 or more on five words one row stays, that of the least id; null comes last."""
    key = fresh(docs, "row_key")
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = ngram_join.join(keyed, n=WORDS, percent=PERCENT, doc_id=key).select(F.col("doc_id").alias("row"), "component_id")
    rows = keyed.select(F.col(key).alias("row"), F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(key).alias("row")).alias("place"))
    first = rows.join(found, "row").groupBy("component_id").agg(F.min("place").alias("place"))
    return keyed.join(first.select(F.col("place.row").alias(key)), key, "left_semi").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a character that loses some of its bytes goes whole."""
    name = fresh(docs, "cleaned")
    cleaned = suffixes.remove(docs, into=name)
    text = F.when(F.col(name)["n_removed"] > 0, suffixes.readable(F.col(name)["kept"])).otherwise(F.col("text"))
    cleaned = cleaned.withColumn("text", text)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(name)["n_removed"] > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the packed sequences."""
    import public_tokenizers

    return packing.best_fit(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("best_fit_packing", packing_stage),
]

#: Packing and the learned stages cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
