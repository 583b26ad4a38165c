"""Lookup into a dimension that changes: every fact meets the version of its key that was valid at its time.

A version holds from its change to the key's next one. Facts and versions meet by key *and* bucket of time, a day mostly, so a
key's facts spread over tasks. A bucket that has facts needs the versions that begin in it and the one it starts with; that one is
carried forward over the buckets of a key, of which there are few: one row each, however many facts and changes they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import seconds_of


def _bucket(at: Column, bucket: str) -> Column:
    return F.floor(F.unix_seconds(at.cast("timestamp")) / seconds_of(bucket))


def as_of(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    ts: str,
    at: str,
    columns: Sequence[str],
    bucket: str = "1 day",
    deleted: Column | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """``facts`` with ``columns`` of the version valid at ``ts``; NULL before the first version and after a delete.

    ``changes`` has a row per change: the key, the time ``at``, the new values, and for deletes ``deleted`` is true. Of changes at
    one time the last by the columns ``order`` counts, their place in the change log; where these are equal or not given, a delete
    counts least, and the greatest values most. A version counts from its own time on. Facts without key or
    time stay, without values. Versions of one key in one bucket meet in one list: choose a bucket that keeps it short.
    """
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    known = changes.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    place = F.struct(*order) if order else F.lit(0)
    version = F.struct(F.col(at).cast("timestamp").alias("at"), place.alias("place"), (~gone).alias("there"), F.struct(*columns).alias("value"))
    versions = known.select(F.col(key).alias("_key"), _bucket(F.col(at), bucket).alias("_bucket"), version.alias("_version"))
    fact_bucket = _bucket(F.col(ts), bucket)
    wanted = facts.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("_key"), fact_bucket.alias("_bucket")).distinct()
    listed = versions.groupBy("_key", "_bucket").agg(F.sort_array(F.collect_set("_version")).alias("_list"))
    buckets = wanted.withColumn("_asked", F.lit(True)).join(listed, ["_key", "_bucket"], "full")
    in_time = W.partitionBy("_key").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    newest = F.last(F.when(F.col("_list").isNotNull(), F.element_at("_list", -1)), ignorenulls=True).over(in_time)
    held = buckets.withColumn("_start", newest).filter("_asked")
    all_ = F.concat(F.array_compact(F.array("_start")), F.coalesce("_list", F.array().cast(listed.schema["_list"].dataType)))
    held = held.select("_key", "_bucket", all_.alias("_list"))

    moment = F.col(ts).cast("timestamp")
    placed = facts.withColumns({"_key": F.col(key), "_bucket": fact_bucket})
    joined = placed.join(held, ["_key", "_bucket"], "left")
    past = F.filter("_list", lambda v: v["at"] <= moment)
    valid = F.when(F.size(past) > 0, F.element_at(past, -1))
    value = F.when(valid["there"], valid["value"])
    return joined.select(*facts.columns, *(value[c].alias(c) for c in columns))
