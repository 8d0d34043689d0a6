"""Publishing to a key-value store only what changed since the last publication.

What the store holds is remembered as a table in the shared folder: one row per
slot (a string's key, a hash's key and field, a set's key and member) with a
digest of its value. The next publication joins its entries with that table and
sends those that are new or differ, and the removal of those that are gone.

The table is a release (:mod:`tableferry.sinks.releases`), written twice: before
the first entry is sent, with the digests of all slots about to change left open,
and after the last one, with the new digests. A job that dies between the two
leaves open slots, which the next publication sends or removes whatever they hold.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.keyed import keyed_entries
from tableferry.session import scratch_dir
from tableferry.sinks.bulk import PIPELINE_ROWS, write_bulk
from tableferry.sinks.releases import publish, read_release, release

STATE = "key string, field string, member string, digest string, expire_ms bigint, sent_ms bigint"
CHANGES = ("set", "remove", "keep")
SLOT = ("key", "field", "member")


def published_state(spark: SparkSession, state: str) -> DataFrame:
    """What the store is known to hold, by slot; a null digest marks a slot whose value is open."""
    if not release(spark, state).number:
        return spark.createDataFrame([], STATE)
    return read_release(spark, state).select(*[c.split()[0] for c in STATE.split(", ")])


def _slots(entries: DataFrame) -> DataFrame:
    """Entries with their slot and digest; a set's value is part of its slot."""
    member = F.when(F.col("kind") == "set", F.col("value"))
    digest = F.when(F.col("kind") == "set", F.lit("")).otherwise(F.sha2(F.col("value").cast("binary"), 256))
    return entries.select("key", "field", member.alias("member"), "value", digest.alias("digest"), "expire_ms")


def _same_slot(old: DataFrame, new: DataFrame) -> Column:
    return (
        (old["key"] == new["key"])
        & old["field"].eqNullSafe(new["field"])
        & old["member"].eqNullSafe(new["member"])
    )


def entry_changes(old: DataFrame, entries: DataFrame, now_ms: int) -> DataFrame:
    """``key, field, member, value, digest, expire_ms, sent_ms, change`` for every slot of either side.

    ``change`` is ``set`` for new, different and open slots, and for those whose expiry
    changed or is half over, ``remove`` for slots without an entry, else ``keep``. Both
    sides have a slot once, so the join is even however often a key stands in the source.
    """
    new = _slots(entries)
    due = old["expire_ms"].isNotNull() & (F.lit(now_ms) - old["sent_ms"] >= old["expire_ms"] / 2)
    kept = (
        old["digest"].eqNullSafe(new["digest"]) & old["expire_ms"].eqNullSafe(new["expire_ms"]) & ~F.coalesce(due, F.lit(False))
    )
    change = F.when(new["key"].isNull(), "remove").when(old["key"].isNotNull() & kept, "keep").otherwise("set")
    both = old.join(new, _same_slot(old, new), "full_outer").withColumn("change", change)
    return both.select(
        *[F.coalesce(new[c], old[c]).alias(c) for c in SLOT],
        F.when(F.col("change") == "set", new["value"]).alias("value"),
        new["digest"].alias("digest"),
        new["expire_ms"].alias("expire_ms"),
        F.when(F.col("change") == "keep", old["sent_ms"]).otherwise(F.lit(now_ms)).alias("sent_ms"),
        "change",
    )


def publish_changes(
    df: DataFrame,
    open_writer: Callable[[], object],
    kind: str,
    state: str,
    order_by: Sequence[str] | str | None = None,
    expire_ms: int = 0,
    pipeline_rows: int = PIPELINE_ROWS,
    now_ms: int | None = None,
    **retrying,
) -> DataFrame:
    """Bring a store from what it holds to the entries of ``df``; ``n_set, n_removed, n_kept`` and the counters of ``write_bulk``.

    ``state`` is a folder that all executors share, one per store and kind of entries, and for
    one publication at a time. The writer gets ``change, key, kind, field, value, expire_ms``: an entry to
    set, or to remove (of a set, the member in ``value``). Each slot is sent at most
    once, so their order does not matter; a job that runs again may send a slot again, with the same value.
    An empty ``df`` removes everything. Without a state everything is set and nothing removed. Entries that expire
    are sent again when half their time is over, even if they did not change.
    """
    spark = df.sparkSession
    now = int(time.time() * 1000) if now_ms is None else now_ms
    seen = Observation()
    counted = [F.count_if(F.col("change") == c).alias(c) for c in CHANGES]
    plan = entry_changes(published_state(spark, state), keyed_entries(df, kind, order_by, expire_ms), now)
    # Computed once: what is sent and what is remembered must be the same rows.
    path = scratch_dir(spark, "changes")
    plan.observe(seen, *counted).write.parquet(path)
    plan = spark.read.schema(plan.schema).parquet(path)
    counts = {c: seen.get[c] or 0 for c in CHANGES}

    columns = [c.split()[0] for c in STATE.split(", ")]
    if counts["set"] or counts["remove"]:
        open_digest = F.when(F.col("change") == "keep", F.col("digest")).alias("digest")
        publish(plan.select(*[open_digest if c == "digest" else c for c in columns]), state)
    changed = plan.where("change <> 'keep'")
    value = F.when((F.col("change") == "remove") & (F.lit(kind) == "set"), F.col("member")).otherwise(F.col("value"))
    sent = write_bulk(
        changed.select("change", "key", F.lit(kind).alias("kind"), "field", value.alias("value"), "expire_ms"),
        open_writer, bulk_size=pipeline_rows, **retrying,
    )
    # If batches were given up, what was sent stays open, and the next publication sends it again.
    new = counts["set"] or counts["remove"] or not release(spark, state).number
    if new and not sent.first()["n_dropped_batches"]:
        publish(plan.where("change <> 'remove'").select(*columns), state)
    return sent.select(
        *[F.lit(counts[c]).cast("bigint").alias(n) for c, n in zip(CHANGES, ("n_set", "n_removed", "n_kept"))], *sent.columns
    )
