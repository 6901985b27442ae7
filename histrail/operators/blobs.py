"""A content-addressed, reference-counted store of large payloads, as set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from .ordered import numbered


def acquire(payloads: DataFrame, content: str, arrival: str) -> DataFrame:
    """Adds ``content_hash``, ``ref_count_after`` and ``newly_stored`` to a log of stores: the n-th writer of a content sees a
    count of n, the first one stores it. The content itself isn't carried through the shuffle."""
    hashed = payloads.withColumn("content_hash", F.sha2(content, 256)).drop(content)
    return numbered(hashed, ["content_hash"], [arrival], "ref_count_after").withColumn("ref_count_after", F.col("ref_count_after").cast("int")).withColumn("newly_stored", F.col("ref_count_after") == 1)


def stored(payloads: DataFrame, content: str, key: str) -> DataFrame:
    """One row a content: ``content_hash``, its canonical id (the least), the number of references, its size."""
    hashed = payloads.select(key, F.sha2(content, 256).alias("content_hash"), F.octet_length(content).alias("n_bytes"))
    return hashed.groupBy("content_hash").agg(F.min(key).alias("id"), F.count(F.lit(1)).cast("int").alias("ref_count"), F.max("n_bytes").cast("long").alias("n_bytes"))


def net_counts(deltas: DataFrame, key: str = "content_hash", delta: str = "delta") -> DataFrame:
    """References left where no release comes before its acquire: signed sums, contents at zero are gone."""
    return deltas.groupBy(key).agg(F.sum(delta).alias("ref_count")).filter(F.col("ref_count") > 0)


def fold_counts(deltas: DataFrame, key: str, order: str, delta: str = "delta") -> DataFrame:
    """The same with a floor at zero after every step, for logs in which a release may come first (it then does nothing).

    The count after n steps is the running sum minus the lowest running sum so far (at most 0): one window, no loop.
    """
    w = Window.partitionBy(key).orderBy(order)
    run = deltas.withColumn("__sum", F.sum(delta).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("__floor", F.least(F.lit(0), F.min("__sum").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return run.withColumn("ref_count_after", F.col("__sum") - F.col("__floor")).drop("__sum", "__floor")


def candidates(variables: DataFrame, blobs: DataFrame, threshold: int, types: tuple[str, ...], limit: int | None = None) -> DataFrame:
    """Variables of the given types whose blob is larger than the threshold and not yet moved out, in the order of their ids."""
    sized = blobs.select(F.col("id").alias("blob_id"), F.octet_length("payload_bytes").cast("long").alias("n_bytes"), F.sha2("payload_bytes", 256).alias("content_hash")).filter(F.col("n_bytes") > threshold)
    found = variables.filter(F.col("type").isin(*types)).join(sized, "blob_id").select("variable_id", "blob_id", "n_bytes", "content_hash")
    found = found.withColumn("marker", S.marker_of(F.col("content_hash")))
    return found.orderBy("variable_id").limit(limit) if limit else found


def dereference(values: DataFrame, blobs: DataFrame, value: str) -> DataFrame:
    """Adds ``content_hash`` and ``payload`` where the value is a marker; ``broken`` marks one whose content isn't stored."""
    v = values.withColumn("content_hash", S.hash_in_marker(F.col(value)))
    b = blobs.select("content_hash", F.col("payload_bytes").alias("payload")).dropDuplicates(["content_hash"])
    return v.join(b, "content_hash", "left").withColumn("broken", F.col("content_hash").isNotNull() & F.col("payload").isNull())


def canonical(payloads: DataFrame, key: str = "id", content_hash: str = "content_hash") -> DataFrame:
    """``old_id, canonical_id``: every id of a content with the least of its ids."""
    best = payloads.groupBy(content_hash).agg(F.min(key).alias("canonical_id"))
    return payloads.select(F.col(key).alias("old_id"), content_hash).distinct().join(best, content_hash).select("old_id", "canonical_id")


def rewrite(refs: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """References with the canonical id in place of the one they had; unknown ids stay."""
    moved = mapping.withColumnRenamed("old_id", "__old")
    return refs.join(moved, F.col(column) == F.col("__old"), "left").withColumn(column, F.coalesce("canonical_id", column)).drop("__old", "canonical_id")


def recount(payloads: DataFrame, refs: list[DataFrame], key: str = "id") -> DataFrame:
    """``id, ref_count`` of every payload from all references to it (frames of one column ``payload_id``); 0 if there are none."""
    every = refs[0]
    for r in refs[1:]:
        every = every.unionByName(r)
    counts = every.groupBy("payload_id").agg(F.count(F.lit(1)).alias("__n"))
    return payloads.select(key).distinct().join(counts, F.col(key) == F.col("payload_id"), "left").select(F.col(key), F.coalesce("__n", F.lit(0)).cast("long").alias("ref_count"))


def ledger_drift(ledger: DataFrame, current: DataFrame) -> DataFrame:
    """Ledger rows to release: the variable is gone or its content is another now. ``ledger``: engine_id, variable_id,
    payload_id, content_hash; ``current``: engine_id, variable_id, current_hash."""
    joined = ledger.join(current, ["engine_id", "variable_id"], "left")
    return joined.filter(~F.col("current_hash").eqNullSafe(F.col("content_hash"))).withColumn("reason", F.when(F.col("current_hash").isNull(), "variable_deleted").otherwise("content_changed"))
