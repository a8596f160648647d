"""Joins."""

from pyspark.sql import functions as F

from lodeworks.constants import ASH_RANGES
from lodeworks.functions import bridge_mine, clamp, exact_avg, half_up, outside
from lodeworks.operators import dimensions
from lodeworks.operators.cleaning import mark_valid_link
from lodeworks.operators.joins import attach, orphan_counts, orphans, trace_orders, with_ranges
from lodeworks.operators.quantiles import exact_quantiles
from lodeworks.plans import marts
from lodeworks.queries.registry import query
from lodeworks.queries.roles import davg, half, sql, zpad

WIDE_ROLES = "dwd_vbak dwd_kna1 dwd_tags dwd_samples"
WIDE_CTES = {
    "tags_agg": f"SELECT mine, face, {davg('value')} AS avg_value, row_number() OVER (PARTITION BY mine ORDER BY face) "
    "AS face_rank FROM dwd_tags GROUP BY mine, face",
    "samples_agg": f"SELECT MINE_CODE, {davg('AD')} AS AD, {davg('QGR_AD')} AS QGR_AD FROM dwd_samples GROUP BY MINE_CODE",
    "wide": "SELECT v.VBELN, v.ERDAT, v.KUNNR, k.NAME1 AS customer_name, v.mine_code, t.face, "
    f"{half('t.avg_value', 4)} AS daily_production, {half('s.AD', 4)} AS ash_content, {half('s.QGR_AD', 4)} AS calorific, "
    f"{half('v.NETWR')} AS NETWR, coalesce(t.face_rank, 1) = 1 AS first_face "
    "FROM (SELECT *, 'M' || substr(BZIRK, 2, 3) AS mine_code FROM dwd_vbak) v "
    f"LEFT JOIN dwd_kna1 k ON {zpad('v.KUNNR', 10)} = k.KUNNR "
    "LEFT JOIN tags_agg t ON v.mine_code = t.mine LEFT JOIN samples_agg s ON v.mine_code = s.MINE_CODE",
}


def wide_table(t):
    return marts.sales_production(t.dwd_vbak, t.dwd_kna1, t.dwd_tags, t.dwd_samples)


@query("join_left_chain", sql(WIDE_ROLES, "SELECT * FROM wide", **WIDE_CTES))
def join_left_chain(t):
    return wide_table(t)


@query(
    "join_preagg",
    sql(
        "vbak dwd_samples",
        "SELECT v.ROW_NO, v.BZIRK, s.ad AS mine_ash, coalesce(s.n, 0) AS mine_samples FROM vbak v LEFT JOIN s ON 'M' || substr(v.BZIRK, 2, 3) = s.MINE_CODE",
        s=f"SELECT MINE_CODE, {half(davg('AD'), 4)} AS ad, count(*) AS n FROM dwd_samples GROUP BY MINE_CODE",
    ),
)
def join_preagg(t):
    per_mine = t.dwd_samples.groupBy(F.col("MINE_CODE").alias("mine_code")).agg(
        half_up(exact_avg("AD"), 4).alias("mine_ash"), F.count(F.lit(1)).alias("mine_samples")
    )
    orders = t.vbak.select("ROW_NO", "BZIRK", bridge_mine("BZIRK").alias("mine_code"))
    joined = attach(orders, per_mine, "mine_code").drop("mine_code")
    return joined.withColumn("mine_samples", F.coalesce("mine_samples", F.lit(0)))


@query(
    "join_derived_key",
    sql(
        "vbak tags",
        "SELECT m.mine, count(*) AS orders FROM (SELECT 'M' || substr(BZIRK, 2, 3) AS mine FROM vbak) v "
        "JOIN (SELECT DISTINCT mine FROM tags) m ON v.mine = m.mine GROUP BY m.mine",
    ),
)
def join_derived_key(t):
    # Orders are counted per derived key before the join: both sides are then one row per mine.
    orders = t.vbak.groupBy(bridge_mine("BZIRK").alias("mine")).agg(F.count(F.lit(1)).alias("orders"))
    return orders.join(t.tags.select("mine").distinct(), "mine")


_DIM_MINE = (
    "SELECT coalesce(p.mine, l.MINE_CODE) AS mine_code, coalesce(l.MINE_NAME, p.mine, l.MINE_CODE) AS mine_name, "
    "'生产矿井' AS mine_type, coalesce(p.mine, l.MINE_CODE) AS sap_mine_field, "
    "coalesce(p.mine, l.MINE_CODE) AS pi_mine_field, coalesce(l.MINE_CODE, p.mine) AS lims_mine_field "
    "FROM (SELECT DISTINCT mine FROM {tags}) p FULL OUTER JOIN "
    "(SELECT MINE_CODE, min(MINE_NAME) AS MINE_NAME FROM {samples} GROUP BY MINE_CODE) l ON p.mine = l.MINE_CODE"
)
DIM_MINE_SQL = _DIM_MINE.format(tags="dwd_tags", samples="dwd_samples")


@query("join_full_outer", sql("tags samples", _DIM_MINE.format(tags="tags", samples="samples")))
def join_full_outer(t):
    return dimensions.dim_mine(t.tags, t.samples)


@query(
    "join_inner_merge",
    "SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def join_inner_merge(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice")
    return lines.join(orders, "l_orderkey")


@query(
    "join_semi_flag",
    sql(
        "vbap vbak",
        "SELECT b.VBELN, b.POSNR, b.MATNR, p.VBELN IS NOT NULL AS IS_VALID_LINK FROM vbap b "
        "LEFT JOIN (SELECT DISTINCT VBELN FROM vbak) p ON b.VBELN = p.VBELN",
    ),
)
def join_semi_flag(t):
    return mark_valid_link(t.vbap.select("VBELN", "POSNR", "MATNR"), t.vbak)


@query(
    "join_anti_orphans",
    sql(
        "vbap vbak",
        "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows, count(*) AS orphan_keys FROM "
        "(SELECT VBELN, count(*) AS n FROM vbap WHERE VBELN NOT IN (SELECT VBELN FROM vbak) GROUP BY VBELN)",
    ),
)
def join_anti_orphans(t):
    return orphan_counts(t.vbap, t.vbak, "VBELN")


@query("join_anti_orphan_rows", sql("vbap vbak", "SELECT VBELN, POSNR, MATNR FROM vbap WHERE VBELN IS NULL OR VBELN NOT IN (SELECT VBELN FROM vbak WHERE VBELN IS NOT NULL)"))
def join_anti_orphan_rows(t):
    """The rows without a parent themselves."""
    return orphans(t.vbap, t.vbak, "VBELN").select("VBELN", "POSNR", "MATNR")


@query(
    "join_dim",
    sql(
        "dwd_vbak kna1 dwd_tags dwd_samples",
        "SELECT v.VBELN, c.NAME1 AS customer_name, m.mine_name FROM dwd_vbak v JOIN kna1 c ON v.KUNNR = c.KUNNR "
        "JOIN dim_mine m ON 'M' || substr(v.BZIRK, 2, 3) = m.sap_mine_field",
        dim_mine=DIM_MINE_SQL,
    ),
)
def join_dim(t):
    customers = dimensions.dim_customer(t.kna1).select(F.col("kunnr").alias("KUNNR"), "customer_name")
    mines = dimensions.dim_mine(t.dwd_tags, t.dwd_samples).select("sap_mine_field", "mine_name")
    orders = t.dwd_vbak.select("VBELN", "KUNNR", bridge_mine("BZIRK").alias("sap_mine_field"))
    with_mine = attach(orders, mines, "sap_mine_field", "inner")
    return with_mine.join(customers, "KUNNR").select("VBELN", "customer_name", "mine_name")


QUANTILE_SQL = (
    "SELECT {key}, lo + (hi - lo) * (pos - floor(pos)) AS {alias} FROM (SELECT {key}, pos, "
    "max(CASE WHEN rn = CAST(floor(pos) AS BIGINT) + 1 THEN value END) AS lo, "
    "max(CASE WHEN rn = CAST(ceil(pos) AS BIGINT) + 1 THEN value END) AS hi "
    "FROM (SELECT {key}, value, row_number() OVER (PARTITION BY {key} ORDER BY value) AS rn, "
    "CAST({p} AS DOUBLE) * (count(*) OVER (PARTITION BY {key}) - 1) AS pos FROM {source} WHERE value IS NOT NULL) GROUP BY {key}, pos)"
)


@query(
    "join_map_lookup",
    sql(
        "tags",
        f"SELECT t.row_no, t.tag, t.value, {half('u.upper', 6)} AS upper FROM tags t LEFT JOIN u ON t.tag = u.tag",
        u=QUANTILE_SQL.format(key="tag", alias="upper", p=0.995, source="tags"),
    ),
)
def join_map_lookup(t):
    upper = exact_quantiles(t.tags, ["tag"], "value", {"upper": 0.995})
    return attach(t.tags.select("row_no", "tag", "value"), upper, "tag").withColumn("upper", half_up("upper", 6))


RANGES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for k, (lo, hi) in ASH_RANGES.items()
) + ") AS v(SAMPLE_TYPE, lo, hi)"


@query(
    "join_range_lookup",
    sql(
        "samples",
        "SELECT SAMPLE_ID, SAMPLE_TYPE, AD, coalesce(AD < lo OR AD > hi, FALSE) AS out_of_range, "
        "CASE WHEN AD < lo THEN lo WHEN AD > hi THEN hi ELSE AD END AS clamped FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE)",
        ranges=RANGES_SQL,
    ),
)
def join_range_lookup(t):
    ranged = with_ranges(t.samples.select("SAMPLE_ID", "SAMPLE_TYPE", "AD"), ASH_RANGES, "SAMPLE_TYPE")
    return ranged.select(
        "SAMPLE_ID",
        "SAMPLE_TYPE",
        "AD",
        outside("AD", "lo", "hi").alias("out_of_range"),
        clamp("AD", F.col("lo"), F.col("hi")).alias("clamped"),
    )


@query(
    "join_trace",
    sql(
        "tags samples vbap dwd_vbak kna1",
        "SELECT g.tag, n.SAMPLE_ID AS sample_id, CAST(l.VBELN AS STRING) AS VBELN, l.MATNR, v.KUNNR, v.NETWR, k.NAME1 AS customer_name "
        "FROM (SELECT DISTINCT tag, mine FROM tags) g JOIN newest n ON g.mine = n.MINE_CODE "
        "LEFT JOIN line l ON right(n.SAMPLE_ID, 4) = l.suffix LEFT JOIN dwd_vbak v ON l.VBELN = v.VBELN "
        "LEFT JOIN kna1 k ON v.KUNNR = k.KUNNR",
        newest="SELECT MINE_CODE, SAMPLE_ID FROM (SELECT MINE_CODE, SAMPLE_ID, row_number() OVER (PARTITION BY MINE_CODE "
        "ORDER BY SAMPLING_DATE DESC, SAMPLE_ID DESC) AS rn FROM samples) WHERE rn = 1",
        line="SELECT suffix, VBELN, MATNR FROM (SELECT right(CHARG, 4) AS suffix, VBELN, MATNR, row_number() OVER "
        "(PARTITION BY right(CHARG, 4) ORDER BY VBELN, POSNR, MATNR NULLS FIRST) AS rn FROM vbap) WHERE rn = 1",
    ),
)
def join_trace(t):
    traced = trace_orders(t.tags, t.samples, t.vbap, t.dwd_vbak, t.kna1)
    return traced.withColumn("VBELN", F.col("VBELN").cast("string"))


@query(
    "join_fact_dim_order",
    "SELECT l_orderkey, l_linenumber, o_orderpriority, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def join_fact_dim_order(t):
    fact = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    dim = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return fact.join(dim, "o_orderkey").select(
        F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "o_orderpriority", F.datediff("l_shipdate", "o_orderdate").alias("days")
    )
