"""The queries p4, p8, p9 and p10, and SQL where it can say what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import load, same_id
from . import mojibake, packing, pii, tokens

CAPACITY = 2048


#: Where free text stands: the table and its column.
FREE_TEXT = {"variable_detail_history": "variable_value_text", "process_instance_history": "delete_reason"}


def p4_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's text with typed placeholders, and the types found in it."""
    parts = []
    for table, column in FREE_TEXT.items():
        t = load(spark, sf_dir, table).select(same_id("id").alias("record_id"), F.col(column).alias("text")).filter(F.col("text").isNotNull())
        parts.append(pii.redact(t, "record_id", "text").withColumn("source_table", F.lit(table)))
    return parts[0].unionByName(parts[1])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p4_redacted(spark, sf_dir)
    return found.select("source_table", "record_id", F.explode("pii_types").alias("pii_type")).distinct()


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(load(spark, sf_dir, "documents"), "doc_id", "text", tokens.tokenizer_path())


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, how many come back from decoding as they were, and the characters of these (all)."""
    docs = load(spark, sf_dir, "documents")
    path = tokens.tokenizer_path()
    ids = materialise(tokens.encode(docs, "doc_id", "text", path), "ids")
    back = tokens.decode(ids, "doc_id", "ids", path).withColumnRenamed("text", "again")
    both = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id")
    same = F.col("text") == F.col("again")
    return both.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(same).alias("n_same"), F.sum(F.when(same, F.length("text"))).cast("long").alias("n_chars"))


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the characters that its tokens cover, each counted once, and where the last of them ends."""
    spans = tokens.encode_with_offsets(load(spark, sf_dir, "documents"), "doc_id", "text", tokens.tokenizer_path())
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))
    more = lambda a, x: F.struct((a["covered"] + F.greatest(F.lit(0), x["ends"] - F.greatest(x["starts"], a["end"]))).alias("covered"), F.greatest(a["end"], x["ends"]).alias("end"))
    got = spans.select("doc_id", F.aggregate(F.arrays_zip("starts", "ends"), start, more).alias("r"))
    return got.select("doc_id", F.col("r.covered").cast("long").alias("n_covered"), F.col("r.end").cast("long").alias("last_end"))


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(load(spark, sf_dir, "documents"), "doc_id", "text", tokens.tokenizer_path())


def p9_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sizes(spark, sf_dir), "doc_id", "n_tokens", [CAPACITY])


def p9_bins_of_three_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sizes(spark, sf_dir), "doc_id", "n_tokens", [CAPACITY // 4, CAPACITY // 2, CAPACITY])


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p9_bins(spark, sf_dir))


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any packing: every document once and whole, no bin too full, no two pieces in one place."""
    packed = materialise(packing.pack(_sizes(spark, sf_dir), "doc_id", "n_tokens", [CAPACITY // 4, CAPACITY // 2, CAPACITY]), "packed")
    whole = packed.groupBy("doc_id").agg((F.max("piece") + 1 == F.count(F.lit(1))).alias("whole"))
    here = Window.partitionBy("bin_id").orderBy("bin_offset", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = packed.filter("n_tokens > 0").withColumn("__to", F.max(F.col("bin_offset") + F.col("n_tokens")).over(here))
    bad = placed.agg(F.count_if(F.col("bin_offset") + F.col("n_tokens") > F.col("bin_capacity")).alias("n_overfull"), F.count_if(F.col("bin_offset") < F.col("__to")).alias("n_overlapping"))
    names = ("n_documents", "n_whole", "n_overfull", "n_overlapping")
    counts = whole.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if("whole").alias("n_whole"))
    both = counts.unionByName(bad, allowMissingColumns=True)
    return both.agg(*[F.sum(n).cast("long").alias(n) for n in names])


def _restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restore(load(spark, sf_dir, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restored(spark, sf_dir).filter("wrongly_decoded").select("doc_id")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with their text as far as it can be restored."""
    return _restored(spark, sf_dir).filter("wrongly_decoded").drop("wrongly_decoded")


QUERIES = {
    "p4_found": p4_found, "p4_redacted": p4_redacted, "p8_ids": p8_ids, "p8_round_trip": p8_round_trip, "p8_offsets": p8_offsets, "p9_checks": p9_checks, "p9_bins": p9_bins, "p9_bins_of_three_sizes": p9_bins_of_three_sizes, "p9_report": p9_report, "p10_found": p10_found, "p10_restored": p10_restored,
}
ORACLE: dict[str, str] = {
    "p8_round_trip": "SELECT count(*) AS n_documents, count(*) AS n_same, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS n_chars FROM documents",
    "p8_offsets": "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_covered, CAST(length(coalesce(text, '')) AS BIGINT) AS last_end FROM documents",
    "p9_checks": "SELECT count(*) AS n_documents, count(*) AS n_whole, CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_overlapping FROM documents",
}
