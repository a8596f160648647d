"""Lineage over edge tables: neighbours, closure, column mappings, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.constants import DIRECT_TRANSFORMS, LAYER_ORDER, TRANSFORM_LABELS
from lodeworks.session import work_path
from lodeworks.sources.partitions import folders


def node(platform: str, table: str) -> Column:
    return F.concat_ws(".", F.col(platform).cast("string"), F.col(table).cast("string"))


def edges_of(relations: DataFrame) -> DataFrame:
    """``downstream struct, upstream array<struct>`` -> one distinct edge per pair."""
    pairs = relations.select("downstream", F.explode("upstream").alias("up"))
    return pairs.select(
        node("up.platform", "up.table").alias("src"),
        node("downstream.platform", "downstream.table").alias("dst"),
        F.coalesce("up.join_key", F.lit("")).alias("join_key"),
    ).distinct()


def upstream(edges: DataFrame, name: str) -> DataFrame:
    return edges.where(F.col("dst") == name).select(F.col("src").alias("node")).distinct().orderBy("node")


def downstream(edges: DataFrame, name: str) -> DataFrame:
    return edges.where(F.col("src") == name).select(F.col("dst").alias("node")).distinct().orderBy("node")


def reach(edges: DataFrame, start: str, forward: bool = True, buckets: int = 16) -> DataFrame:
    """All nodes reachable from ``start`` with the length of the longest path to them.

    Ordering by that depth is a topological order. The edges are written once, filed by a hash of the node they
    start from. A level is the distinct nodes at exactly one distance, written too; the next one reads the files
    of its nodes' buckets only. The loop counts levels, not rows; what the driver sees of a level is the numbers of
    its buckets, and none means the end. A graph with a cycle has no topological order: a level deeper than
    there are nodes proves one, and it is refused.
    """
    spark = edges.sparkSession
    a, b = ("src", "dst") if forward else ("dst", "src")
    folder = work_path(spark, "reach")
    bucket = F.pmod(F.xxhash64("node"), F.lit(buckets)).cast("int").alias("bucket")
    hops = edges.select(F.col(a).cast("string").alias("node"), F.col(b).cast("string").alias("next"))
    hops.select("*", bucket).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/edges")
    filed = set(folders(spark, f"{folder}/edges", "bucket"))

    def written(found: DataFrame, depth: int) -> tuple[DataFrame, list[str]]:
        path = f"{folder}/levels/depth={depth}"
        found.select(F.col("next").alias("node")).distinct().select("node", bucket).write.parquet(path)
        level = spark.read.schema("node string, bucket int").parquet(path)
        return level, [str(r.bucket) for r in level.select("bucket").distinct().collect()]

    def leaving(touched: list[str]) -> DataFrame:
        reader = spark.read.schema("node string, next string, bucket int").option("basePath", f"{folder}/edges")
        return reader.parquet(*[f"{folder}/edges/bucket={x}" for x in sorted(touched)])

    at = str(spark.range(1).select(F.lit(start).alias("node")).select(bucket).first().bucket)
    nodes, depth = None, 1
    level, touched = written((leaving([at]) if at in filed else hops).where(F.col("node") == start), 1)
    while touched:
        if depth >= 64:  # deep: see how deep it can be at all
            nodes = nodes or hops.select("node").union(hops.select("next")).distinct().count()
            if depth > nodes:
                raise ValueError(f"no end after {depth} levels over {nodes} nodes: the graph has a cycle")
        known = filed.intersection(touched)
        if not known:  # all of them are ends
            break
        depth += 1
        level, touched = written(leaving(list(known)).join(level, "node", "left_semi"), depth)
    levels = spark.read.schema("node string, depth int").option("basePath", f"{folder}/levels").parquet(f"{folder}/levels")
    return levels.groupBy("node").agg(F.max("depth").alias("depth"))


def blast_radius(edges: DataFrame, start: str) -> DataFrame:
    return reach(edges, start, forward=True).orderBy("depth", "node")


def ancestors(edges: DataFrame, start: str) -> DataFrame:
    """Everything upstream, sources first."""
    return reach(edges, start, forward=False).orderBy(F.desc("depth"), "node")


def column_lineage(relations: DataFrame) -> DataFrame:
    """Column mappings, one row per upstream table of a relation; ``*`` means all columns, no
    transform IDENTITY. With several upstreams a mapping does not say which one it reads, so it is
    told for each."""
    mapped = relations.select(
        node("downstream.platform", "downstream.table").alias("dst"), F.explode("upstream").alias("up"), "mappings"
    ).select("dst", node("up.platform", "up.table").alias("src"), F.explode("mappings").alias("m"))
    return mapped.select(
        "src",
        F.when(F.col("m.upstream_column") == "*", F.lit("ALL_COLUMNS")).otherwise(F.col("m.upstream_column")).alias("src_column"),
        "dst",
        F.col("m.downstream_column").alias("dst_column"),
        F.coalesce("m.transformation", F.lit("IDENTITY")).alias("transform"),
    )


def missing_edges(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """Expected edges that nobody recorded."""
    return expected.select("src", "dst").distinct().join(recorded.select("src", "dst"), ["src", "dst"], "left_anti")


def by_layer(nodes: DataFrame, layers: list[str] = LAYER_ORDER) -> DataFrame:
    """Nodes in the order of their layer; an unknown layer comes last."""
    position = F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(x) for x in layers]), F.split_part("node", F.lit("."), F.lit(1))), F.lit(0)) - 1,
        F.lit(len(layers)),
    )
    return nodes.withColumn("layer", position.cast("int")).orderBy("layer", "node")


def summarize_transforms(mappings: DataFrame, by: str = "dst", transform: str = "transform") -> DataFrame:
    """Short label for the transformations of each table. One flag per function and group, so the
    aggregate stays the same size however many mappings a table has."""
    text = F.coalesce(F.col(transform), F.lit(""))
    is_direct = F.trim(text).isin(DIRECT_TRANSFORMS)
    flags = mappings.groupBy(by).agg(
        F.bool_and(is_direct).alias("_direct"),
        *[F.bool_or(text.rlike(f"(?i){p}")).alias(f"_f{i}") for i, (p, _) in enumerate(TRANSFORM_LABELS)],
    )
    hits = F.filter(
        F.array(*[F.when(F.col(f"_f{i}"), F.lit(label)) for i, (_, label) in enumerate(TRANSFORM_LABELS)]),
        lambda x: x.isNotNull(),
    )
    labelled = flags.withColumn("_hits", hits)
    summary = (
        F.when(F.col("_direct"), F.lit("直接映射"))
        .when(F.size("_hits") == 0, F.lit("ETL加工"))
        .when(F.size("_hits") <= 3, F.array_join("_hits", "+"))
        .otherwise(F.concat(F.col("_hits")[0], F.lit("+"), F.col("_hits")[1], F.lit("+等"), F.size("_hits").cast("string"), F.lit("类")))
    )
    return labelled.select(by, summary.alias("summary"))
