"""Connected components and a bounded filter, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.session import work_path

SLOTS = 1 << 19
#: Drops what a query has written for its exchanges as soon as it ends. Else that stays until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: later jobs survive lost executors, and a join over
    it has an exchange of its own that adaptive execution can split. Files of exchanges end with the write."""
    spark = df.sparkSession
    path, before = work_path(spark, label), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node of its component.

    Union-find in rounds: every node points to the least node among itself and its neighbours, edges
    are carried over to what their ends point to, and loops and repetitions drop out, until no edge is
    left. The hot ends of stars are joined against stored tables, where skewed parts are split.
    """
    left = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), label)
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low")), label)
        moved = left.join(point.toDF("a", "x"), "a").join(point.toDF("b", "y"), "b")
        left = stored(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).where("a <> b").distinct(), label)
        if roots is None:
            roots = point.toDF("node", "root")
        else:
            roots = stored(roots.join(point.toDF("root", "low"), "root", "left").select("node", F.coalesce("low", "root").alias("root")), label)
    return roots if roots is not None else left.toDF("node", "root")


def _bits(*key: str | Column) -> tuple[Column, Column]:
    h = F.xxhash64(*key)
    return F.pmod(h, F.lit(SLOTS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 20), F.lit(64)).cast("int"))


def free(name: str, df: DataFrame) -> str:
    """The name, with underscores in front until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def marked(df: DataFrame, keys: list[str], wanted: DataFrame, flag: str) -> DataFrame:
    """df with a boolean column: false only where the keys are surely not in ``wanted``.

    A bit map of 2^25 bits, broadcast as at most 2^19 rows of 16 bytes whatever the data. It only
    saves moving rows; beyond some ten million wanted keys it saves nothing, and nothing goes wrong.
    """
    slot, bit = _bits(*keys)
    at, one, all_ = (free(name, df) for name in ("_slot", "_bit", "_bits"))
    bitmap = wanted.select(slot.alias(at), bit.alias(one)).groupBy(at).agg(F.bit_or(one).alias(all_))
    probe = df.withColumns({at: slot, one: bit})
    return probe.join(F.broadcast(bitmap), at, "left").withColumn(flag, F.coalesce(F.col(all_).bitwiseAND(F.col(one)) != 0, F.lit(False))).drop(at, one, all_)
