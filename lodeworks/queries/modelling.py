"""Cleaning, repairs, dimensions, derived fields, the layer pipeline and the catalog."""

from pyspark.sql import functions as F

from lodeworks.constants import ASH_RANGES, SYSTEM_ASSETS
from lodeworks.functions import half_up
from lodeworks.operators import catalog, cleaning, dimensions
from lodeworks.plans import layers, marts
from lodeworks.queries.joins import DIM_MINE_SQL, QUANTILE_SQL, RANGES_SQL, WIDE_CTES, WIDE_ROLES, wide_table
from lodeworks.queries.registry import query
from lodeworks.queries.roles import GIVEN, ROW_ORDER, half, sql
from lodeworks.session import work_path
from lodeworks.sources.literal import literal_table


def _cleaned(role: str, columns: list[str]) -> None:
    picked = ", ".join(f'"{c}"' for c in columns)

    @query(f"cln_{role}", sql(f"dwd_{role}", f"SELECT {picked} FROM dwd_{role}"))
    def run(t):
        return t.cleaned(role).select(*columns)


_cleaned("vbak", ["VBELN", "ERDAT", "ERNAM", "KUNNR", "NETWR", "ROW_NO"])
_cleaned("vbap", ["VBELN", "POSNR", "MATNR", "NETWR", "LIFNR"])
_cleaned("kna1", ["KUNNR", "NAME1", "ORT01", "STCD1"])
_cleaned("tags", ["tag", "value", "status", "mine", "face", "row_no"])
_cleaned("samples", ["SAMPLE_ID", "MINE_CODE", "SAMPLE_TYPE", "AD", "ROW_NO"])
_cleaned("doc_flow", ["FLOW_ID", "FLOW_TYPE", "APPLY_DATE", "STATUS"])


@query(
    "rep_link_flag",
    sql(
        "dwd_vbap vbak",
        "SELECT b.VBELN, b.POSNR, p.VBELN IS NOT NULL AS IS_VALID_LINK FROM dwd_vbap b LEFT JOIN (SELECT DISTINCT VBELN FROM vbak) p ON b.VBELN = p.VBELN",
    ),
)
def rep_link_flag(t):
    return cleaning.mark_valid_link(t.dwd_vbap.select("VBELN", "POSNR"), t.vbak)


_UPPER = QUANTILE_SQL.format(key="tag", alias="upper", p=0.995, source="tags")


@query(
    "rep_clamp_p995",
    sql(
        "tags",
        f"SELECT row_no, t.tag, {half('CASE WHEN value > u.upper THEN u.upper ELSE value END', 6)} AS value, value AS value_original, "
        "coalesce(value > u.upper, FALSE) AS repaired FROM tags t LEFT JOIN u ON t.tag = u.tag",
        u=_UPPER,
    ),
)
def rep_clamp_p995(t):
    fixed = cleaning.clamp_spikes(t.tags)
    changed = F.coalesce(F.col("value_original") > F.col("value"), F.lit(False))
    return fixed.select("row_no", "tag", half_up("value", 6).alias("value"), "value_original", changed.alias("repaired"))


@query(
    "rep_clamp_range",
    sql(
        "samples",
        "SELECT SAMPLE_ID, SAMPLE_TYPE, CASE WHEN AD < lo THEN lo WHEN AD > hi THEN hi ELSE AD END AS AD, "
        "coalesce(AD < lo OR AD > hi, FALSE) AS repaired FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE)",
        ranges=RANGES_SQL,
    ),
)
def rep_clamp_range(t):
    return cleaning.clamp_ash(t.samples.select("SAMPLE_ID", "SAMPLE_TYPE", "AD"))


@query("dim_mine", sql("dwd_tags dwd_samples", DIM_MINE_SQL))
def dim_mine(t):
    return dimensions.dim_mine(t.dwd_tags, t.dwd_samples)


@query(
    "dim_customer",
    sql(
        "dwd_kna1",
        "SELECT KUNNR AS kunnr, NAME1 AS customer_name, ORT01 AS region, 'UNKNOWN' AS credit_level FROM (SELECT *, row_number() OVER "
        "(PARTITION BY KUNNR ORDER BY NAME1, ORT01) AS rn FROM dwd_kna1) WHERE rn = 1",
    ),
)
def dim_customer(t):
    return dimensions.dim_customer(t.dwd_kna1)


@query(
    "dim_material",
    sql(
        "dwd_vbap",
        "SELECT DISTINCT MATNR AS matnr, MATNR AS mat_desc, CASE WHEN length(MATNR) >= 4 THEN left(MATNR, 4) ELSE 'UNKNOWN' END AS mat_type FROM dwd_vbap",
    ),
)
def dim_material(t):
    return dimensions.dim_material(t.dwd_vbap)


@query(
    "dim_coal_type",
    sql(
        "dwd_samples",
        "SELECT SAMPLE_TYPE AS coal_type, coalesce(l.coal_name, SAMPLE_TYPE) AS coal_name, lo AS ash_min, hi AS ash_max, "
        f"{half('l.sulfur')} AS sulfur_limit_pct FROM (SELECT DISTINCT SAMPLE_TYPE FROM dwd_samples) LEFT JOIN ranges USING (SAMPLE_TYPE) LEFT JOIN l USING (SAMPLE_TYPE)",
        ranges=RANGES_SQL,
        l="SELECT SAMPLE_TYPE, SAMPLE_TYPE || ' (' || min(MINE_CODE) || ')' AS coal_name, max(\"全硫St\") AS sulfur FROM samples WHERE TEST_LAB <> 'LAB3' AND SAMPLE_TYPE <> '其他' GROUP BY 1",
    ),
)
def dim_coal_type(t):
    """Named after the first mine that sent a sample; the limit is the most sulfur that three of the labs ever measured."""
    known = t.samples.where("TEST_LAB <> 'LAB3' AND SAMPLE_TYPE <> '其他'").groupBy(F.col("SAMPLE_TYPE").alias("coal_type"))
    labels = known.agg(F.concat(F.first("SAMPLE_TYPE"), F.lit(" ("), F.min("MINE_CODE"), F.lit(")")).alias("coal_name"), F.max("全硫St").alias("sulfur_limit_pct"))
    return dimensions.dim_coal_type(t.dwd_samples, ASH_RANGES, labels)


@query(
    "ext_vbak",
    sql(
        "dwd_vbak",
        "SELECT VBELN, NETWR, CASE WHEN NETWR > 100000 THEN '大额订单' WHEN NETWR > 10000 THEN '中额订单' ELSE '小额订单' END AS order_size_category, "
        "substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) AS sale_date_formatted, KUNNR || '_' || VKORG AS customer_salesorg_key "
        "FROM (SELECT *, replace(ERDAT, '-', '') AS d FROM dwd_vbak WHERE ERDAT IS NOT NULL)",
    ),
)
def ext_vbak(t):
    compact = t.dwd_vbak.withColumn("RAW_DATE", F.replace(F.col("ERDAT"), F.lit("-"), F.lit("")))
    extended = dimensions.extend_orders(compact, "RAW_DATE")
    return extended.select("VBELN", "NETWR", "order_size_category", "sale_date_formatted", "customer_salesorg_key")


@query(
    "ext_lims",
    sql(
        "dwd_samples",
        "SELECT SAMPLE_ID, AD, CASE WHEN AD > 40 THEN '高灰煤' WHEN AD > 20 THEN '中灰煤' ELSE '低灰煤' END AS ash_grade, "
        + half('"全硫St" * 100 / NULLIF(AD, 0)')
        + " AS sulfur_ash_ratio FROM dwd_samples WHERE AD IS NOT NULL",
    ),
)
def ext_lims(t):
    return dimensions.extend_samples(t.dwd_samples).select("SAMPLE_ID", "AD", "ash_grade", "sulfur_ash_ratio")


_STATS_SQL = " UNION ALL ".join(
    f"SELECT '{key}' AS table_name, (SELECT count(*) FROM {name}) AS before, (SELECT count(*) FROM dwd_{name}) AS after, "
    f"(SELECT count(*) FROM {name}) - (SELECT count(*) FROM dwd_{name}) AS dropped"
    for key, name in ((k, s.split("/")[1]) for k, s in layers.DWD_SOURCES.items())
)
_ALL = "dwd_vbak dwd_vbap dwd_kna1 dwd_tags dwd_samples dwd_doc_flow"


def _raw(t):
    return {source: getattr(t, source.split("/")[1]) for source in layers.DWD_SOURCES.values()}


@query("pipe_ods_dwd_dwa", sql(_ALL, _STATS_SQL))
def pipe_ods_dwd_dwa(t):
    return layers.run(t.spark, work_path(t.spark, "lake"), _raw(t), ROW_ORDER)


@query(
    "dwa_fill_defaults",
    sql(
        WIDE_ROLES,
        "SELECT VBELN, coalesce(ERDAT, '') AS ERDAT, coalesce(KUNNR, '') AS KUNNR, coalesce(customer_name, '') AS customer_name, mine_code, "
        "coalesce(face, '') AS face, coalesce(daily_production, 0) AS daily_production, coalesce(ash_content, 0) AS ash_content, "
        "coalesce(calorific, 0) AS calorific, NETWR, first_face FROM wide",
        **WIDE_CTES,
    ),
)
def dwa_fill_defaults(t):
    return marts.fill_defaults(wide_table(t))


# --- catalog ---

_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in GIVEN)


@query("cat_partitions", _COUNTS)
def cat_partitions(t):
    """Rows per table, be it one file or many. Files, sizes and partition values are for tests to see."""
    return catalog.table_sizes(catalog.partitions(t.spark, [t.path(n) for n in GIVEN])).select("table_name", "row_count")


@query(
    "cat_profile",
    "SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS row_count, CAST(6 AS INTEGER) AS column_count, column_name, column_type FROM "
    "(VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), "
    "('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')) AS v(column_name, column_type)",
)
def cat_profile(t):
    return catalog.profile(t.spark, t.path("orders"), "orders")


# Which given table plays which source table.
ASSET_TABLES = {
    ("sap_erp", "vbak"): "orders",
    ("sap_erp", "vbap"): "lineitem",
    ("sap_erp", "kna1"): "customer",
    ("sap_erp", "mara"): "part",
    ("pi_system", "tags"): "events",
    ("lims", "samples"): "lineitem",
    ("oa", "doc_flow"): "orders",
}
_ASSETS_SQL = " UNION ALL ".join(
    f"SELECT '{system}' AS system, '{table}' AS table_name, '{label}' AS label, '{owner}' AS owner, '{level}' AS security_level, "
    + (f"count(*) AS row_count, '' AS partition_field, 'connected' AS status FROM {ASSET_TABLES[system, table]}" if (system, table) in ASSET_TABLES else "0, '', 'unknown'")
    for system, (owner, level, tables) in SYSTEM_ASSETS.items()
    for table, label in tables.items()
)


def _asset_counts(t):
    files = sorted(set(ASSET_TABLES.values()))
    counts = catalog.table_sizes(catalog.partitions(t.spark, [t.path(n) for n in files]))
    roles = literal_table(t.spark, [(*k, v) for k, v in ASSET_TABLES.items()], "system string, role string, table_name string")
    return roles.join(counts, "table_name").select("system", F.col("role").alias("table_name"), "row_count", "size_mb", "partition_field")


@query("cat_assets", _ASSETS_SQL)
def cat_assets(t):
    return catalog.assets(t.spark, _asset_counts(t)).drop("size_mb")  # SQL over views knows no file sizes


@query(
    "cat_system_status",
    f"SELECT system, count(*) AS tables, count(*) FILTER (WHERE status = 'connected') AS connected_tables, CAST(sum(row_count) AS BIGINT) AS row_count, "
    f"CASE WHEN bool_or(status = 'connected') THEN 'connected' ELSE 'unknown' END AS status FROM ({_ASSETS_SQL}) GROUP BY system",
)
def cat_system_status(t):
    return catalog.system_status(catalog.assets(t.spark, _asset_counts(t))).drop("size_mb")


_CLASSIFY_SQL = " UNION ALL ".join(
    f"SELECT '{system}' AS system, '{table}' AS table_name, count(*) AS row_count, '{SYSTEM_ASSETS[system][1]}' AS security_level FROM {source}"
    for (system, table), source in ASSET_TABLES.items()
)


@query("cat_classify", _CLASSIFY_SQL)
def cat_classify(t):
    return catalog.classify(t.spark, _asset_counts(t).select("system", "table_name", "row_count"))
