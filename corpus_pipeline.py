"""From raw documents to token ids: quality, repeated lines, near duplicates, leaks, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the
shared folder and read again as the next stage's docs. All stages but the last return the columns of
the documents.

Rows with a null text fail the first stage's threshold or pass it by the mean label like any text
without words; what passes stays, empty, to the end. Rows with a null id are never taken for
duplicates of other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import decontamination, jaccard_join, line_dedup, neighbours, pieces
from lodeworks.llm.components import free, marked, stored
from lodeworks.llm.queries import vocabulary_path
from lodeworks.llm.registry import table
from lodeworks.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    return neighbours.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of near-equal lines. Documents left without any text go."""
    counts = free("n_lines", docs), free("n_removed", docs)
    untouched = F.col(counts[1]) == 0
    kept = line_dedup.dedup_lines(docs, counts=counts).where(untouched | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(untouched, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class; of rows repeated as a whole, one.

    An id that stands for several texts goes only if each of them is a duplicate.
    """
    found = jaccard_join.near_duplicates(docs).where(F.col("doc_id").isNotNull())
    ids = found.groupBy("doc_id").agg(F.max((F.col("class_id") == F.col("doc_id"))).alias("first"), F.count(F.lit(1)).alias("n"))
    first, flag = free("first", docs), free("_touched", docs)
    touched = stored(ids.where("NOT first OR n > 1").select("doc_id", F.col("first").alias(first)), "pipeline-duplicates")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    split = marked(docs, ["doc_id"], touched.select("doc_id"), flag)
    moved = split.where(F.col(flag)).drop(flag).join(touched, "doc_id", "left")
    one = moved.where(F.col(first)).dropDuplicates(["doc_id", "text"])
    # Distinct rows only: `first` is null for rows that the bit map let pass without need.
    still = split.where(~F.col(flag)).select(*columns).unionByName(moved.where(F.col(first).isNull()).select(*columns))
    return still.unionByName(one.select(*columns))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number and digest, and the digest of the text they decode to."""
    done = pieces.encode_decode(docs, vocabulary_path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("leaks", leaks),
    ("encoding", encoding),
]

#: Stages 1 to 3 and 5 are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
