"""Projection, filter, predicate; sort, limit, top-k; set operations."""

from pyspark.sql import functions as F

from lodeworks.constants import POINT_ALARMS, SENSOR_LIMITS
from lodeworks.functions import bucket_case, contains, exact_avg, half_up, mask_text, sensor_of
from lodeworks.operators.aggregates import truncated
from lodeworks.operators.catalog import decode
from lodeworks.operators.dedup import compare_counts, difference, distinct_by, duplicate_rows, not_null
from lodeworks.operators.dimensions import ASH_GRADE, ASH_GRADE4, ORDER_SIZE
from lodeworks.operators.joins import dealt
from lodeworks.operators.quality import ranked_alerts
from lodeworks.queries.registry import query
from lodeworks.queries.roles import davg, half, sql
from lodeworks.session import work_path
from lodeworks.sources import tables as lake
from lodeworks.sources.literal import literal_table
from lodeworks.streaming.alarms import alarm_level


@query(
    "prj_select_rename",
    sql("kna1", 'SELECT KUNNR AS kunnr, NAME1 AS customer_name, ORT01 AS region FROM kna1'),
)
def prj_select_rename(t):
    return t.kna1.select(
        F.col("KUNNR").alias("kunnr"), F.col("NAME1").alias("customer_name"), F.col("ORT01").alias("region")
    )


@query("prj_const", sql("kna1", "SELECT KUNNR, 'UNKNOWN' AS credit_level FROM kna1"))
def prj_const(t):
    return t.kna1.select("KUNNR", F.lit("UNKNOWN").alias("credit_level"))


@query("prj_copy", sql("tags", "SELECT row_no, value, value AS value_original FROM tags"))
def prj_copy(t):
    return t.tags.select("row_no", "value", F.col("value").alias("value_original"))


@query(
    "flt_not_null",
    sql("vbak", "SELECT ROW_NO, VBELN FROM vbak WHERE NETWR IS NOT NULL AND ERNAM IS NOT NULL AND VBELN IS NOT NULL"),
)
def flt_not_null(t):
    return not_null(t.vbak, ["NETWR", "ERNAM", "VBELN"]).select("ROW_NO", "VBELN")


@query("flt_positive", sql("vbap", "SELECT VBELN, POSNR, NETWR FROM vbap WHERE NETWR > 0"))
def flt_positive(t):
    return t.vbap.where("NETWR > 0").select("VBELN", "POSNR", "NETWR")


@query("flt_not_equal", sql("tags", "SELECT row_no, status FROM tags WHERE status IS DISTINCT FROM -1"))
def flt_not_equal(t):
    return t.tags.where(~F.col("status").eqNullSafe(-1)).select("row_no", "status")


@query("flt_range", sql("tags", "SELECT row_no, value FROM tags WHERE value BETWEEN 0 AND 10000"))
def flt_range(t):
    return t.tags.where(F.col("value").between(0, 10000)).select("row_no", "value")


@query("flt_sentinel_date", sql("vbak", "SELECT ROW_NO, ERDAT FROM vbak WHERE ERDAT IS NOT NULL AND ERDAT <> '00000000'"))
def flt_sentinel_date(t):
    return t.vbak.where("ERDAT IS NOT NULL AND ERDAT != '00000000'").select("ROW_NO", "ERDAT")


@query("flt_contains", sql("tags", "SELECT row_no, tag FROM tags WHERE coalesce(contains(tag, 'WAGAS'), FALSE)"))
def flt_contains(t):
    return t.tags.where(contains("tag", "WAGAS")).select("row_no", "tag")


@query("flt_like_suffix", sql("tags", "SELECT row_no, tag FROM tags WHERE tag LIKE '%_WAGAS'"))
def flt_like_suffix(t):
    return t.tags.where(F.col("tag").like("%_WAGAS")).select("row_no", "tag")


@query("flt_prefix", sql("vbak", "SELECT ROW_NO, ERDAT FROM vbak WHERE starts_with(ERDAT, '1996')"))
def flt_prefix(t):
    return t.vbak.where(F.col("ERDAT").startswith("1996")).select("ROW_NO", "ERDAT")


@query("flt_in", sql("doc_flow", "SELECT FLOW_ID FROM doc_flow WHERE FLOW_TYPE IN ('付款申请', '采购申请') AND AMOUNT = 0"))
def flt_in(t):
    return t.doc_flow.where(F.col("FLOW_TYPE").isin("付款申请", "采购申请") & (F.col("AMOUNT") == 0)).select("FLOW_ID")


@query("flt_month_eq", sql("samples", "SELECT SAMPLE_ID, AD FROM samples WHERE substr(SAMPLING_DATE, 1, 7) = '1996-01'"))
def flt_month_eq(t):
    return t.samples.where(F.substring("SAMPLING_DATE", 1, 7) == "1996-01").select("SAMPLE_ID", "AD")


def _case(value: str, cuts, default: str, op: str = ">") -> str:
    return "CASE " + " ".join(f"WHEN {value} {op} {c} THEN '{x}'" for c, x in cuts) + f" ELSE '{default}' END"


@query(
    "prj_case_bucket",
    sql(
        "vbak samples",
        f"SELECT 'order' AS kind, {_case('NETWR', *ORDER_SIZE)} AS label, count(*) AS n FROM vbak GROUP BY 2 "
        f"UNION ALL SELECT 'ash', {_case('AD', *ASH_GRADE)}, count(*) FROM samples GROUP BY 2",
    ),
)
def prj_case_bucket(t):
    orders = t.vbak.select(F.lit("order").alias("kind"), bucket_case("NETWR", *ORDER_SIZE).alias("label"))
    ash = t.samples.select(F.lit("ash").alias("kind"), bucket_case("AD", *ASH_GRADE).alias("label"))
    return orders.unionByName(ash).groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "prj_case_bucket4",
    sql(
        "dwd_samples",
        f"SELECT SAMPLE_TYPE AS coal_type, {_case('AD', *ASH_GRADE4, op='<')} AS ash_grade, count(*) AS n, "
        f"{half(davg('AD'))} AS avg_ash FROM dwd_samples GROUP BY 1, 2",
    ),
)
def prj_case_bucket4(t):
    grade = bucket_case("AD", *ASH_GRADE4, below=True)
    return t.dwd_samples.groupBy(F.col("SAMPLE_TYPE").alias("coal_type"), grade.alias("ash_grade")).agg(
        F.count(F.lit(1)).alias("n"), half_up(exact_avg("AD"), 2).alias("avg_ash")
    )


_LIMITS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', CAST({'NULL' if a is None else a} AS DOUBLE))" for p, a in POINT_ALARMS.items()
) + ") AS v(point, alarm)"
_LEVEL = "CASE WHEN alarm IS NULL THEN 0 WHEN value >= alarm * CAST(1.2 AS DOUBLE) THEN 2 WHEN value >= alarm THEN 1 ELSE 0 END"


@query(
    "prj_flag_range",
    sql("points", f"SELECT event_id, point, value, CAST({_LEVEL} AS INTEGER) AS level FROM points LEFT JOIN limits USING (point)", limits=_LIMITS),
)
def prj_flag_range(t):
    return alarm_level(t.points).select("event_id", "point", "value", "level")


_SENSOR = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', CAST({w} AS DOUBLE), CAST({n} AS DOUBLE), CAST({a} AS DOUBLE), CAST({d} AS DOUBLE))" for s, (w, n, a, d) in SENSOR_LIMITS.items()
) + ") AS v(sensor, normal_low, normal_high, alarm, danger)"


@query(
    "prj_threshold_class",
    sql(
        "tags",
        "SELECT row_no, nullif(regexp_extract(tag, '^[^_]+_FACE_[A-Z]_([A-Z0-9_]+)$', 1), '') AS sensor, CASE WHEN value >= danger THEN 'danger' WHEN value >= alarm THEN 'alarm' "
        "WHEN value < normal_low THEN 'low' WHEN value <= normal_high THEN 'normal' WHEN value IS NULL OR sensor IS NULL THEN NULL ELSE 'raised' END AS class "
        "FROM tags LEFT JOIN limits ON regexp_extract(tag, '^[^_]+_FACE_[A-Z]_([A-Z0-9_]+)$', 1) = sensor",
        limits=_SENSOR,
    ),
)
def prj_threshold_class(t):
    rows = [(s, *v) for s, v in SENSOR_LIMITS.items()]
    limits = literal_table(t.spark, rows, "sensor string, normal_low double, normal_high double, alarm double, danger double")
    label = (
        F.when(F.col("value") >= F.col("danger"), "danger")
        .when(F.col("value") >= F.col("alarm"), "alarm")
        .when(F.col("value") < F.col("normal_low"), "low")
        .when(F.col("value") <= F.col("normal_high"), "normal")
        .when(F.col("value").isNotNull() & F.col("danger").isNotNull(), "raised")
    )
    """Every reading; sensors without limits have no class."""
    tagged = t.tags.withColumn("sensor", sensor_of("tag"))
    return tagged.join(F.broadcast(limits), "sensor", "left").select("row_no", F.nullif("sensor", F.lit("")).alias("sensor"), label.alias("class"))


@query(
    "prj_decode",
    sql(
        "vbak",
        "SELECT ROW_NO, VKORG, label FROM vbak LEFT JOIN (SELECT * FROM (VALUES ('F', '销售一公司'), ('O', '销售二公司')) "
        "AS v(code, label)) m ON VKORG = code",
    ),
)
def prj_decode(t):
    glossary = t.spark.range(1).select(
        F.lit("vbak").alias("table_name"),
        F.lit("VKORG").alias("column_name"),
        F.create_map(F.lit("F"), F.lit("销售一公司"), F.lit("O"), F.lit("销售二公司")).alias("value_mappings"),
    )
    return decode(t.vbak.select("ROW_NO", "VKORG"), glossary, "vbak", "VKORG", "label").select("ROW_NO", "VKORG", "label")


@query(
    "prj_mask",
    sql("kna1", "SELECT KUNNR, left(STCD1, 4) || repeat('*', greatest(length(STCD1) - 4, 0)) AS stcd1 FROM kna1"),
)
def prj_mask(t):
    t.kna1.select("KUNNR", mask_text("STCD1", 4).alias("stcd1")).createOrReplaceTempView("kna1_masked")
    return t.spark.sql("SELECT KUNNR, stcd1 FROM kna1_masked")


# --- sort, limit, top-k ---


@query(
    "top_k",
    sql("tags", "SELECT tag, count(*) AS n FROM tags GROUP BY tag ORDER BY n DESC, tag LIMIT 10"),
)
def top_k(t):
    return t.tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(10)


@query(
    "sort_multi",
    sql(
        "samples",
        "SELECT substr(SAMPLING_DATE, 1, 7) AS month, MINE_CODE, count(*) AS n FROM samples GROUP BY 1, 2 ORDER BY month DESC, MINE_CODE",
    ),
)
def sort_multi(t):
    grouped = t.samples.groupBy(F.substring("SAMPLING_DATE", 1, 7).alias("month"), "MINE_CODE").agg(F.count(F.lit(1)).alias("n"))
    return grouped.orderBy(F.desc("month"), "MINE_CODE")


@query("sort_rows", sql("tags", 'SELECT tag, row_no, value FROM tags ORDER BY tag, "timestamp", row_no'))
def sort_rows(t):
    return t.tags.select("tag", "timestamp", "row_no", "value").orderBy("tag", "timestamp", "row_no").drop("timestamp")


_ALERTS = (
    "SELECT 'sap_erp' AS system, 'orphan_lines' AS alert, count(*) AS rows_affected FROM vbap WHERE VBELN = -1 "
    "UNION ALL SELECT 'pi_system', 'lost_points', count(*) FROM tags WHERE status = -1 "
    "UNION ALL SELECT 'pi_system', 'bad_points', count(*) FROM tags WHERE status = -2 "
    "UNION ALL SELECT 'lims', 'negative_ash', count(*) FROM samples WHERE AD < 0 "
    "UNION ALL SELECT 'oa', 'amount_null', count(*) FROM doc_flow WHERE AMOUNT IS NULL"
)


def alert_counts(t):
    """Affected rows per system and alert class: one small row each."""

    def counted(df, system, alert):
        return df.agg(F.count(F.lit(1)).alias("rows_affected")).select(
            F.lit(system).alias("system"), F.lit(alert).alias("alert"), "rows_affected"
        )

    lost = t.tags.agg(
        F.count_if(F.col("status") == -1).alias("lost_points"), F.count_if(F.col("status") == -2).alias("bad_points")
    ).unpivot([], ["lost_points", "bad_points"], "alert", "rows_affected")
    return (
        counted(t.vbap.where("VBELN = -1"), "sap_erp", "orphan_lines")
        .unionByName(lost.select(F.lit("pi_system").alias("system"), "alert", "rows_affected"))
        .unionByName(counted(t.samples.where("AD < 0"), "lims", "negative_ash"))
        .unionByName(counted(t.doc_flow.where("AMOUNT IS NULL"), "oa", "amount_null"))
    )


@query(
    "rank_alerts",
    sql(
        "vbap tags samples doc_flow",
        "SELECT system, alert, rows_affected, CAST(row_number() OVER (ORDER BY rows_affected DESC, system, alert) AS INTEGER) AS rank FROM alerts",
        alerts=_ALERTS,
    ),
)
def rank_alerts(t):
    return ranked_alerts(alert_counts(t))


@query(
    "limit_truncated",
    "SELECT o_orderkey, o_totalprice, (SELECT count(*) > 100 FROM orders) AS truncated FROM orders ORDER BY o_orderkey LIMIT 100",
)
def limit_truncated(t):
    return truncated(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


# --- set operations ---


@query("set_union_all", "SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer")
def set_union_all(t):
    return t.orders.select(F.col("o_custkey").alias("k")).unionByName(t.customer.select(F.col("c_custkey").alias("k")))


@query(
    "set_distinct_key",
    "SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey",
)
def set_distinct_key(t):
    rows = t.orders.select("o_custkey", F.col("o_orderkey").alias("first_order"))
    return distinct_by(rows, ["o_custkey"], ["o_custkey", "first_order"], ["first_order"])


@query(
    "set_dup_rows",
    "SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n - 1) AS BIGINT) AS dup FROM "
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag)",
)
def set_dup_rows(t):
    return duplicate_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


_REC = "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_returnflag <> 'R'"
_DECL = "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_returnflag <> 'A'"


@query(
    "set_except_edges",
    sql(
        "",
        "SELECT src, dst, 'recorded' AS only_in FROM (SELECT * FROM rec EXCEPT SELECT * FROM decl) UNION ALL "
        "SELECT src, dst, 'declared' FROM (SELECT * FROM decl EXCEPT SELECT * FROM rec)",
        rec=_REC,
        decl=_DECL,
    ),
)
def set_except_edges(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), "l_returnflag")
    # Nearly every line is an edge of its own: both sides and their difference are grouped in tasks of bounded size.
    edges = dealt(lines, t.lineitem.count(), "src", "dst")
    recorded = edges.where("l_returnflag <> 'R'").select("src", "dst").distinct()
    declared = edges.where("l_returnflag <> 'A'").select("src", "dst").distinct()
    return difference(recorded, declared, "recorded", "declared")


@query(
    "set_compare_counts",
    "SELECT 'orders' AS table_name, count(*) AS old_rows, count(*) AS new_rows, TRUE AS equal FROM orders "
    "UNION ALL SELECT 'customer', count(*), count(*), TRUE FROM customer",
)
def set_compare_counts(t):
    pairs = {}
    for name in ("orders", "customer"):
        path = work_path(t.spark, name)
        lake.commit(t.given(name), path)
        pairs[name] = (t.given(name), lake.read_version(t.spark, path))
    return compare_counts(pairs)
