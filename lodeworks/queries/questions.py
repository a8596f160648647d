"""Business questions asked in SQL over the aggregated tables."""

from lodeworks.plans import marts
from lodeworks.queries.aggregates import COAL_QUALITY_SQL, SALES_DAILY_SQL, TAG_ALARM_SQL
from lodeworks.queries.joins import WIDE_CTES, WIDE_ROLES
from lodeworks.queries.registry import query
from lodeworks.queries.roles import davg, dsum, half, sql
from lodeworks.sources.files import register_views

_LAB = {"dwa_coal_quality": COAL_QUALITY_SQL}


def _avg(column: str, digits: int = 4) -> str:
    """Rounded exact mean in Spark SQL, the twin of ``half(davg(...))``. The tables asked here are
    aggregates, so decimal sums cost little."""
    scale = float(10**digits)
    return f"CAST(floor(try_divide(CAST(sum(CAST({column} AS DECIMAL(18,6))) AS DOUBLE), count({column})) * {scale}D + 0.5D) AS DOUBLE) / {scale}D"


def _lab(t):
    register_views({"dwa_coal_quality": marts.coal_quality(t.dwd_samples)})


@query(
    "nlq_1",
    sql(
        "dwd_samples",
        f"SELECT SAMPLE_TYPE, CAST(sum(sample_count) AS BIGINT) AS samples, {half(davg('avg_gross_calorific'), 4)} AS avg_heat FROM dwa_coal_quality GROUP BY SAMPLE_TYPE",
        **_LAB,
    ),
)
def nlq_1(t):
    """Samples and mean heat by coal type."""
    _lab(t)
    return t.spark.sql(
        f"SELECT SAMPLE_TYPE, sum(sample_count) AS samples, {_avg('avg_gross_calorific')} AS avg_heat FROM dwa_coal_quality GROUP BY SAMPLE_TYPE"
    )


@query(
    "nlq_2",
    sql(
        "dwd_samples",
        f"SELECT MINE_CODE, {half(davg('avg_ash_content'), 4)} AS ash FROM dwa_coal_quality WHERE SAMPLE_TYPE = '精煤' GROUP BY MINE_CODE ORDER BY ash, MINE_CODE",
        **_LAB,
    ),
)
def nlq_2(t):
    """Ash ranking of clean coal by mine."""
    _lab(t)
    return t.spark.sql(
        f"SELECT MINE_CODE, {_avg('avg_ash_content')} AS ash FROM dwa_coal_quality WHERE SAMPLE_TYPE = '精煤' GROUP BY MINE_CODE ORDER BY ash, MINE_CODE"
    )


@query(
    "nlq_3",
    sql(
        "tags",
        "SELECT tag, CAST(sum(high_value_count) AS BIGINT) AS alarms FROM dwa_tag_alarm GROUP BY tag ORDER BY alarms DESC, tag LIMIT 10",
        dwa_tag_alarm=TAG_ALARM_SQL.format(high=80),
    ),
)
def nlq_3(t):
    """The ten sensors with the most alarms."""
    register_views({"dwa_tag_alarm": marts.tag_alarm(t.tags, high=80.0)})
    return t.spark.sql("SELECT tag, sum(high_value_count) AS alarms FROM dwa_tag_alarm GROUP BY tag ORDER BY alarms DESC, tag LIMIT 10")


@query("nlq_4", sql("dwd_samples", "SELECT * FROM dwa_coal_quality WHERE month = '1996-01'", **_LAB))
def nlq_4(t):
    """Coal quality of one month."""
    _lab(t)
    return t.spark.sql("SELECT * FROM dwa_coal_quality WHERE month = '1996-01'")


@query(
    "nlq_5",
    sql("dwd_samples", f"SELECT MINE_CODE, {half(davg('avg_ash_content'), 4)} AS avg_ash FROM dwa_coal_quality GROUP BY MINE_CODE", **_LAB),
)
def nlq_5(t):
    """Mean ash by mine."""
    _lab(t)
    return t.spark.sql(f"SELECT MINE_CODE, {_avg('avg_ash_content')} AS avg_ash FROM dwa_coal_quality GROUP BY MINE_CODE")


@query("nlq_7", sql("dwd_vbak", "SELECT count(*) AS n FROM dwa_sales_daily", dwa_sales_daily=SALES_DAILY_SQL))
def nlq_7(t):
    """How many sales records there are."""
    register_views({"dwa_sales_daily": marts.sales_daily(t.dwd_vbak)})
    return t.spark.sql("SELECT count(*) AS n FROM dwa_sales_daily")


@query(
    "nlq_8",
    sql(
        WIDE_ROLES,
        f"SELECT mine_code, {dsum('CASE WHEN first_face THEN NETWR END')} AS sales, {half(davg('daily_production', 4), 2)} AS production FROM wide GROUP BY mine_code",
        **WIDE_CTES,
    ),
)
def nlq_8(t):
    """Sales next to production by mine; an order counts once although the wide table repeats it per face.

    Asked over the two sides of the wide table, each with one row per mine."""
    register_views({"sales_by_mine": marts.orders_by_mine(t.dwd_vbak), "production_by_face": marts.tags_by_face(t.dwd_tags)})
    return t.spark.sql(
        "WITH p AS (SELECT mine AS mine_code, sum(CAST(floor(avg_value * 10000D + 0.5D) / 10000D AS DECIMAL(18,4))) AS total, count(avg_value) AS n "
        "FROM production_by_face GROUP BY mine) "
        "SELECT s.mine_code, s.sales, CAST(floor(try_divide(CAST(p.total * s.orders AS DOUBLE), CAST(p.n * s.orders AS DOUBLE)) * 100D + 0.5D) AS DOUBLE) / 100D AS production "
        "FROM sales_by_mine s LEFT JOIN p ON s.mine_code = p.mine_code"
    )
