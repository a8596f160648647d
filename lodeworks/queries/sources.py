"""Scans, sources and sinks."""

from pyspark.sql import functions as F

from lodeworks.constants import SUBJECT_PATHS
from lodeworks.functions import in_sample, sample_rank
from lodeworks.queries.registry import query
from lodeworks.queries.roles import sql
from lodeworks.session import work_path
from lodeworks.sources import files, partitions
from lodeworks.sources import tables as lake

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


@query("src_parquet", _ORDERS)
def src_parquet(t):
    return files.read_parquet(t.spark, t.path("orders")).select(*ORDER_COLUMNS)


@query("src_filename_parts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def src_filename_parts(t):
    path = work_path(t.spark, "yearly")
    t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")).write.partitionBy("year").parquet(path)
    raw = t.spark.read.option("recursiveFileLookup", "true").parquet(path)
    return files.with_name_partitions(raw, ("year",))


@query("src_table", _ORDERS)
def src_table(t):
    path = work_path(t.spark, "table")
    lake.commit(t.orders.select(*ORDER_COLUMNS), path)
    return lake.read_table(t.spark, path, fallback=t.path("orders"))


@query(
    "src_table_fallback",
    _ORDERS,
)
def src_table_fallback(t):
    return lake.read_table(t.spark, work_path(t.spark, "absent"), fallback=t.path("orders")).select(*ORDER_COLUMNS)


@query(
    "src_concat_years",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS ihrez FROM orders",
)
def src_concat_years(t):
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    old = o.where(F.col("year") < 1998).select("o_orderkey", "year")
    new = o.where(F.col("year") >= 1998).select("o_orderkey", "year", F.col("o_orderpriority").alias("ihrez"))
    return files.concat_years([old, new])


@query("src_incremental", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = TIMESTAMP '1996-01-02 00:00:00'")
def src_incremental(t):
    base = work_path(t.spark, "incremental")
    day = t.orders.where(F.col("o_orderdate") == F.lit("1996-01-02").cast("timestamp_ntz"))
    files.write_increment(day.select("o_orderkey", "o_totalprice"), base, "1996-01-02", "sap_erp", "VBAK")
    return files.read_increment(t.spark, base, "1996-01-02", "sap_erp", "VBAK")


@query("src_sql_view", sql("vbak", "SELECT VBELN, KUNNR, NETWR, '2022' AS year FROM vbak"))
def src_sql_view(t):
    files.register_views({"vbak_parquet": t.vbak})
    return t.spark.sql("SELECT VBELN, KUNNR, NETWR, '2022' AS year FROM vbak_parquet")


_RANK = "CAST('0x' || left(md5(CAST(o_orderkey AS STRING) || ':42'), 8) AS BIGINT)"


@query("src_sample", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_RANK} % 10000 < 100")
def src_sample(t):
    return t.orders.where(in_sample("o_orderkey", 0.01)).select("o_orderkey", "o_totalprice")


@query("src_sample_n", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_RANK}, o_orderkey LIMIT 5000")
def src_sample_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(sample_rank("o_orderkey"), "o_orderkey").limit(5000)


@query("snk_overwrite", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def snk_overwrite(t):
    path = work_path(t.spark, "overwrite")
    o = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    lake.commit(o.withColumn("o_totalprice", F.lit(0.0)), path, partition_by=["year"])
    lake.commit(o, path, partition_by=["year"])
    return lake.read_version(t.spark, path)


@query(
    "snk_append",
    "SELECT 'sap_erp' AS source_system, count(*) AS n, count(*) AS stamped FROM orders "
    "UNION ALL SELECT 'oa', count(*), count(*) FROM customer",
)
def snk_append(t):
    path = work_path(t.spark, "append")
    lake.append(files.with_audit(t.orders.select(F.col("o_orderkey").alias("id")), "sap_erp"), path)
    lake.append(files.with_audit(t.customer.select(F.col("c_custkey").alias("id")), "oa"), path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("source_system").agg(F.count(F.lit(1)).alias("n"), F.count("etl_time").alias("stamped"))


_SUBJECT_SQL = " UNION ALL ".join(
    f"SELECT '{src}' AS source, '{dst}' AS target, count(*) AS written_rows FROM {src.split('/')[1]}"
    for src, dst in SUBJECT_PATHS.items()
)
_ALL_DWD = "dwd_vbak dwd_vbap dwd_kna1 dwd_tags dwd_samples dwd_doc_flow"


@query("snk_subject_copy", sql(_ALL_DWD, _SUBJECT_SQL))
def snk_subject_copy(t):
    cleaned = {src: getattr(t, src.split("/")[1]) for src in SUBJECT_PATHS}
    return lake.copy_by_subject(cleaned, SUBJECT_PATHS, work_path(t.spark, "subjects"))


@query(
    "snk_upsert",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders",
)
def snk_upsert(t):
    path = work_path(t.spark, "upsert")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    partitions.upsert(o, path, ["o_orderkey"], ["o_totalprice"], buckets=16)
    changed = o.where("o_orderstatus = 'F'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    partitions.upsert(changed, path, ["o_orderkey"], ["o_totalprice"], buckets=16)
    return partitions.read_buckets(t.spark, path)


def _two_versions(t, label):
    path = work_path(t.spark, label)
    lake.commit(t.orders.select("o_orderkey", "o_totalprice"), path)
    lake.commit(t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"), path, "DELETE")
    return path


@query(
    "snk_history",
    "SELECT CAST(0 AS BIGINT) AS snapshot_version, 'OVERWRITE' AS operation, count(*) AS row_count FROM orders "
    "UNION ALL SELECT 1, 'DELETE', count(*) FROM orders WHERE o_orderstatus = 'O'",
)
def snk_history(t):
    path = _two_versions(t, "history")
    sizes = [
        lake.read_version(t.spark, path, v).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(v).cast("bigint").alias("snapshot_version"), "row_count")
        for v in (0, 1)
    ]
    counts = sizes[0].unionByName(sizes[1])
    return lake.history(t.spark, path).select("snapshot_version", "operation").join(counts, "snapshot_version")


@query("src_as_of", "SELECT o_orderkey, o_totalprice FROM orders")
def src_as_of(t):
    path = _two_versions(t, "asof")
    first = lake.history(t.spark, path).where("snapshot_version = 0").first().committed_at
    return lake.read_as_of(t.spark, path, F.lit(first))
