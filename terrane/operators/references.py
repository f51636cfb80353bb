"""References to records that do not exist at the time of the reference.

Method: references and changes of existence are signed deltas on a key and an instant. The *ledger* is
their sum per key and instant; :func:`merge` adds a batch of new deltas (a record that came late, was
deleted, created again, or a change taken back by the opposite sign), and rows that sum to nothing
vanish. The running sum of existence over a key's ledger gives the stretches of time in which it does
not exist (*gaps*); a key with references, counted with their first and last instant, is orphaned in
every gap that those meet. Only the references of such keys are looked at again, one by one, and
reported per table and month.

All sums are combined before the shuffle, so a hot key shrinks to one row a task (and per instant in
the ledger); references never enter a window, only changes of existence do.

Defined results
- a null key or null reference is no reference;
- a key exists at an instant if the changes up to that instant, it included, sum to more than nothing;
- repeated deliveries of one record are one life: from the earliest known begin (included) to the latest
  deletion (excluded); a key without any known begin never exists;
- a reference without an instant is an orphan only if its key never exists; its month is null;
- repeated rows count once; empty tables give empty reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Gaps of orphan keys up to this number (about 100 bytes each in a broadcast) are broadcast; beyond it they are joined by shuffle.
MAX_BROADCAST_KEYS = 200_000
#: A key with more than 1/HOT_SHARE of the references of orphan keys is hot: at most HOT_SHARE exist.
HOT_SHARE = 256
SALTS = 32

ALWAYS = "0001-01-01 00:00:00"


def existence_deltas(df: DataFrame, key: str, since: str | None, until: str | None) -> DataFrame:
    """(key, at, refs, exists) of a table of records: +1 where a record begins to exist, -1 where it ends. Repeated
    deliveries are one life; ``since`` None means always."""
    begin = F.col(since).cast("timestamp_ntz") if since else F.lit(ALWAYS).cast("timestamp_ntz")
    lives = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.min(begin).alias("born"), (F.max(F.col(until).cast("timestamp_ntz")) if until else F.lit(None).cast("timestamp_ntz")).alias("died")
    ).where("born is not null")
    steps = F.explode(F.array(F.struct(F.col("born").alias("at"), F.lit(1).alias("exists")), F.struct(F.col("died").alias("at"), F.lit(-1).alias("exists"))))
    return lives.select("key", steps.alias("s")).where("s.at is not null").select("key", F.col("s.at").alias("at"), F.lit(0).cast("long").alias("refs"), F.col("s.exists").cast("long").alias("exists"))


def reference_deltas(df: DataFrame, key: str, at: str, sign: int = 1) -> DataFrame:
    """(key, at, refs, exists) of a table of references; ``sign`` -1 takes references back."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(at).cast("timestamp_ntz").alias("at"), F.lit(sign).cast("long").alias("refs"), F.lit(0).cast("long").alias("exists"))


def ledger(deltas: DataFrame) -> DataFrame:
    """Signed sums per key and instant, without those that come to nothing."""
    return deltas.groupBy("key", "at").agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists")).where("refs <> 0 or exists <> 0")


def merge(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """The ledger after a batch of deltas; the order of batches does not matter."""
    return ledger(state.select("key", "at", "refs", "exists").unionByName(deltas.select("key", "at", "refs", "exists")))


def gaps(state: DataFrame) -> DataFrame:
    """(key, since, until) of the stretches in which keys with any existence do not exist: ``since`` included, null
    for ever before; ``until`` excluded, null for ever after."""
    w = Window.partitionBy("key").orderBy("at")
    changes = state.where("exists <> 0 and at is not null")
    steps = changes.select(
        "key", "at", F.sum("exists").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("count"), F.lead("at").over(w).alias("next"), F.lag("at").over(w).alias("before")
    )
    begins = F.when(F.col("before").isNull(), F.struct(F.lit(None).cast("timestamp_ntz").alias("since"), F.col("at").alias("until")))
    dead = F.when(F.col("count") <= 0, F.struct(F.col("at").alias("since"), F.col("next").alias("until")))
    return steps.select("key", F.explode(F.array(begins, dead)).alias("g")).where("g is not null").select("key", "g.since", "g.until")


def orphan_keys(references: DataFrame, changes: DataFrame) -> DataFrame:
    """(key, refs, since, until): gaps of keys with a reference in them.

    ``references`` has (key, at) or is a ledger (key, at, refs, exists); ``changes`` are deltas of existence or a ledger."""
    counted = references if "refs" in references.columns else references.select("key", "at", F.lit(1).cast("long").alias("refs"))
    held = counted.where("refs <> 0").groupBy("key").agg(
        F.sum("refs").alias("refs"), F.min(F.col("at").cast("timestamp_ntz")).alias("first_ref"), F.max(F.col("at").cast("timestamp_ntz")).alias("last_ref")
    ).where("refs > 0")
    met = held.join(gaps(ledger(changes.where("exists <> 0"))), "key", "left")
    never = F.col("since").isNull() & F.col("until").isNull()
    meets = (F.col("until").isNull() | (F.col("first_ref") < F.col("until"))) & (F.col("since").isNull() | (F.col("last_ref") >= F.col("since")))
    return met.where(never | F.coalesce(meets, F.lit(False))).select("key", "refs", "since", "until")


def orphan_references(references: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``references`` (src, row_id, key, at) whose key does not exist at ``at``:
    distinct (src, ref_month, row_id, fid). ``keys`` is a written table of :func:`orphan_keys`."""
    size = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum("refs"), F.lit(0)).alias("refs")).first()
    if size["n"] <= MAX_BROADCAST_KEYS:
        joined = references.join(F.broadcast(keys.drop("refs")), "key")
    else:
        hot = keys.where(F.col("refs") > max(1, size["refs"] // HOT_SHARE)).select("key").distinct().collect()  # at most HOT_SHARE rows
        is_hot = F.col("key").isin([r["key"] for r in hot]) if hot else F.lit(False)
        salted = references.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("row_id", "at"), F.lit(SALTS))).otherwise(0).cast("int"))
        spread = keys.drop("refs").withColumn(
            "salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
        )
        joined = salted.join(spread, ["key", "salt"]).drop("salt")
    at = F.col("at").cast("timestamp_ntz")
    never = F.col("since").isNull() & F.col("until").isNull()
    within = (F.col("since").isNull() | (at >= F.col("since"))) & (F.col("until").isNull() | (at < F.col("until")))
    missing = never | F.coalesce(within, F.lit(False))
    return joined.where(missing).select(
        "src", F.date_format("at", "yyyy-MM").alias("ref_month"), "row_id", F.col("key").alias("fid")
    ).distinct()
