"""Joins that keep the big side in place and survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions import outside
from lodeworks.session import work_path
from lodeworks.sources.literal import literal_table

#: Parts that a key's rows are dealt over when they meet a table with one row per key.
SALTS = 16
#: Parent keys that are broadcast at most: some tens of megabytes.
BROADCAST_KEYS = 1_000_000
#: Input rows for one task where a task holds a state for nearly every row.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The rows dealt by keys to as many tasks as ``rows`` rows ask for. What a task then sorts or groups by these keys
    grows neither with the table nor with a small number of shuffle partitions. Only for keys that many rows do not share."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def attach_all(big: DataFrame, *sides: tuple, how: str = "left") -> DataFrame:
    """Join per-key tables (usually aggregates) to a big table; each side is ``(table, on)``.

    How each join runs is left to the planner's byte statistics and to adaptive execution, which
    knows the size of an aggregate once it is there and broadcasts it if it is small.
    """
    for small, on in sides:
        big = big.join(small, on, how)
    return big


def attach(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    return attach_all(big, (small, on), how=how)


_COUNTED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "string"}


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> tuple[list, bool]:
    """Keys that hold at least a share of the rows, and whether NULL does; by one frequency sketch over the key
    column. A sketch of 10,000 counters cannot miss a key of one percent. At most 1 / ``share`` keys come back."""
    if df.schema[key].dataType.simpleString() not in _COUNTED:
        return [], False
    seen = df.agg(F.expr(f"approx_top_k(`{key}`, {round(1 / share)}, 10000)").alias("top"), F.count(F.lit(1)).alias("rows"), F.count(key).alias("known")).first()
    least = max(1.0, share * seen.rows)
    return sorted(x.item for x in seen.top or [] if x["count"] >= least and x.item is not None), seen.rows - seen.known >= least


def _free(name: str, *frames: DataFrame) -> str:
    """A column name that none of the tables has."""
    while any(name in df.columns for df in frames):
        name = f"_{name}"
    return name


def flag_member(child: DataFrame, parent: DataFrame, key: str, flag: str, parent_key: str | None = None, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Add a boolean column: does the key exist in the parent table? NULL gives false.

    The parent's keys are written once and counted. Up to ``broadcast_keys`` of them are broadcast, and the child
    rows stay where they are. More of them are joined by an exchange: there a sentinel or NULL key may hold a large
    share of the child rows, so the rows of such keys, and only those, are dealt over ``SALTS`` parts by a hash of the
    row, and the parent's one row is there for each. The salt also puts an exchange of its own over both sides, so
    that adaptive execution can split what is still too large.
    """
    path = work_path(child.sparkSession, "parent-keys")
    parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct().write.parquet(path)
    known = child.sparkSession.read.parquet(path)
    salt, hit = _free("_salt", child, known), _free("_hit", child, known)
    # A session that has turned broadcasting off means it.
    allowed = not child.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    few = allowed and known.count() <= broadcast_keys
    hot, null_is_hot = ([], False) if few else hot_keys(child, key)
    if few or not (hot or null_is_hot):
        keys = known.withColumn(hit, F.lit(True))
        joined = child.join(F.broadcast(keys) if few else keys, key, "left")
    else:
        is_hot = F.col(key).isin(hot) if hot else F.lit(False)
        parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        keys = known.select(key, F.explode(parts).alias(salt), F.lit(True).alias(hit))
        plain = [f.name for f in child.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
        dealt = is_hot | F.col(key).isNull() if null_is_hot else is_hot
        row = F.pmod(F.xxhash64(*[f"`{c}`" for c in plain]), F.lit(SALTS)).cast("int")
        joined = child.withColumn(salt, F.when(dealt, row).otherwise(F.lit(0))).join(keys, [key, salt], "left")
    return joined.select(*[F.col(f"`{c}`") for c in child.columns], F.coalesce(hit, F.lit(False)).alias(flag))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose parent is absent."""
    flagged = flag_member(child, parent, key, "_has_parent", parent_key)
    return flagged.where(~F.col("_has_parent")).drop("_has_parent")


def orphan_counts(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows and keys without a parent; keys are counted before the join, so hot keys cost nothing."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lonely = per_key.join(parent.select(F.col(parent_key or key).alias(key)).distinct(), key, "left_anti")
    return lonely.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def range_table(spark: SparkSession, ranges: dict[str, tuple[float, float]], key: str) -> DataFrame:
    """A constant ``key -> (lo, hi)`` table; its size is the size of the dictionary."""
    rows = [(k, float(lo), float(hi)) for k, (lo, hi) in ranges.items()]
    return literal_table(spark, rows, f"`{key}` string, lo double, hi double")


def with_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]], key: str) -> DataFrame:
    """Attach ``lo`` and ``hi`` by key; a key without a range gets NULL bounds."""
    return df.join(F.broadcast(range_table(df.sparkSession, ranges, key)), key, "left")


def out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]], key: str, value: str) -> DataFrame:
    return with_ranges(df, ranges, key).where(outside(value, "lo", "hi")).drop("lo", "hi")


def with_total(df: DataFrame, total: Column, alias: str) -> DataFrame:
    """Put one grand total next to every row, as a scalar subquery."""
    return df.withColumn(alias, df.agg(total).scalar())


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Columns of one-row results in one row. Each frame is a scalar subquery, so they run side by
    side and nothing is joined."""
    rows = [frame.select(F.struct("*")).scalar().alias(f"_{i}") for i, frame in enumerate(frames)]
    one = frames[0].sparkSession.range(1).select(*rows)
    return one.select(*[f"_{i}.*" for i in range(len(frames))])


def trace_orders(
    tags: DataFrame, samples: DataFrame, lines: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Walk tag -> newest lab sample of its mine -> order line by batch suffix -> order -> customer.

    Each hop keeps one row per key by an aggregate, so no hop can multiply rows.
    """
    tag_mines = tags.select("tag", "mine").distinct()
    newest = samples.groupBy(F.col("MINE_CODE").alias("mine")).agg(
        F.max_by("SAMPLE_ID", F.struct("SAMPLING_DATE", "SAMPLE_ID")).alias("sample_id")
    )
    hop = attach(tag_mines, newest, "mine", "inner").withColumn("suffix", F.right("sample_id", F.lit(4)))
    wanted = hop.select("suffix").distinct()
    line = (
        lines.withColumn("suffix", F.right("CHARG", F.lit(4)))
        .join(wanted, "suffix", "left_semi")
        .groupBy("suffix")
        .agg(F.min_by(F.struct("VBELN", "MATNR"), F.struct("VBELN", "POSNR", "MATNR")).alias("line"))
        .select("suffix", F.col("line.VBELN").alias("VBELN"), F.col("line.MATNR").alias("MATNR"))
    )
    return (
        hop.join(line, "suffix", "left")
        .join(orders.select("VBELN", "KUNNR", "NETWR"), "VBELN", "left")
        .join(customers.select("KUNNR", "NAME1"), "KUNNR", "left")
        .select("tag", "sample_id", "VBELN", "MATNR", "KUNNR", "NETWR", F.col("NAME1").alias("customer_name"))
    )
