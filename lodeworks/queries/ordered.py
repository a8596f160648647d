"""Ordered work: dedup by rank, gaps, continuity, running shares."""

from pyspark.sql import functions as F

from lodeworks.functions import half_up
from lodeworks.operators import aggregates as agg
from lodeworks.operators import ordered
from lodeworks.operators.dedup import keep_first, keep_latest
from lodeworks.queries.registry import query
from lodeworks.queries.roles import ROW_ORDER, half, sql

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


_VBAP_ORDER = "EDATU {d}, LIFNR {d}, MATNR {d}, NETWR {d}, KWMENG {d}"


@query(
    "win_dedup_first",
    sql(
        "vbap",
        "SELECT VBELN, POSNR, MATNR, NETWR FROM (SELECT *, row_number() OVER (PARTITION BY VBELN, POSNR ORDER BY "
        + _VBAP_ORDER.format(d="NULLS FIRST")
        + ") AS rn FROM vbap) WHERE rn = 1",
    ),
)
def win_dedup_first(t):
    return keep_first(t.vbap, ["VBELN", "POSNR"], ROW_ORDER["vbap"]).select("VBELN", "POSNR", "MATNR", "NETWR")


@query(
    "win_dedup_latest",
    sql(
        "vbap",
        "SELECT VBELN, POSNR, MATNR, NETWR FROM (SELECT *, row_number() OVER (PARTITION BY VBELN, POSNR ORDER BY "
        + _VBAP_ORDER.format(d="DESC NULLS LAST")
        + ") AS rn FROM vbap) WHERE rn = 1",
    ),
)
def win_dedup_latest(t):
    return keep_latest(t.vbap, ["VBELN", "POSNR"], ROW_ORDER["vbap"]).select("VBELN", "POSNR", "MATNR", "NETWR")


@query(
    "win_diff_gap",
    sql(
        "tags",
        "SELECT tag, count(step) AS steps, count(*) FILTER (WHERE step > 36000000000) AS gaps, max(step) AS longest_micros FROM "
        "(SELECT tag, epoch_us(\"timestamp\") - epoch_us(lag(\"timestamp\") OVER (PARTITION BY tag ORDER BY \"timestamp\")) AS step FROM tags) GROUP BY tag",
    ),
)
def win_diff_gap(t):
    return ordered.gap_steps(t.tags, ["tag"], "timestamp", limit_seconds=36_000)


@query(
    "win_previous_reading",
    sql(
        "tags",
        "SELECT row_no, tag, value, lag(value) OVER w AS prev_value, " + _STAMP.format('lag("timestamp") OVER w') + " AS prev_time "
        "FROM tags WINDOW w AS (PARTITION BY tag ORDER BY \"timestamp\", row_no)",
    ),
)
def win_previous_reading(t):
    lagged = ordered.with_previous(t.tags, ["tag"], ["timestamp", "row_no"], {"prev_value": "value", "prev_time": "timestamp"})
    return lagged.select("row_no", "tag", "value", "prev_value", stamp("prev_time").alias("prev_time"))


_SLOTS = "SELECT DISTINCT tag, date_trunc('hour', \"timestamp\") AS slot FROM tags"


@query(
    "win_continuity",
    sql(
        "tags",
        "SELECT tag, expected, actual, expected - actual AS missing FROM (SELECT tag, "
        "date_diff('hour', min(slot), max(slot)) + 1 AS expected, count(*) AS actual FROM slots GROUP BY tag)",
        slots=_SLOTS,
    ),
)
def win_continuity(t):
    return ordered.continuity(t.tags, ["tag"], "timestamp", "hour")


@query(
    "win_missing_points",
    sql(
        "tags",
        "SELECT tag, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot FROM (SELECT tag, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS slot FROM "
        "(SELECT tag, min(slot) AS lo, max(slot) AS hi FROM slots GROUP BY tag)) e WHERE NOT EXISTS "
        "(SELECT 1 FROM slots s WHERE s.tag = e.tag AND s.slot = e.slot)",
        slots=_SLOTS,
    ),
)
def win_missing_points(t):
    absent = ordered.missing_slots(t.tags, ["tag"], "timestamp", "hour")
    return absent.select("tag", F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("slot"))


@query(
    "win_head_per_tag",
    sql("tags", "SELECT row_no, value FROM tags WHERE tag = 'M001_FACE_A_WAGAS' ORDER BY \"timestamp\", row_no LIMIT 2000"),
)
def win_head_per_tag(t):
    one = t.tags.where("tag = 'M001_FACE_A_WAGAS'").orderBy("timestamp", "row_no").limit(2000)
    return one.select("row_no", "value")


@query(
    "win_running_share",
    sql(
        "tags",
        f"SELECT tag, amount, {half('amount * CAST(100 AS DOUBLE) / total')} AS share_pct, {half('sum(amount) OVER (ORDER BY amount DESC, tag) * CAST(100 AS DOUBLE) / total')} AS running_pct "
        "FROM (SELECT tag, amount, sum(amount) OVER () AS total, row_number() OVER (ORDER BY amount DESC, tag) AS rn FROM "
        "(SELECT tag, count(*) FILTER (WHERE value > 80) AS amount FROM tags GROUP BY tag)) WHERE rn <= 10",
    ),
)
def win_running_share(t):
    return agg.top_share(t.tags, "tag", F.count_if(F.col("value") > 80), 10)


@query(
    "rep_fill_gap",
    sql(
        "tags",
        "SELECT row_no, tag, coalesce(value, lv) AS value_ffill, "
        + half("coalesce(value, lv + (hv - lv) * ((x - lx)::DOUBLE / NULLIF(hx - lx, 0)))", 6)
        + " AS value_linear FROM (SELECT row_no, tag, value, epoch_us(\"timestamp\") AS x, last_value(value IGNORE NULLS) OVER b AS lv, "
        "last_value(CASE WHEN value IS NOT NULL THEN epoch_us(\"timestamp\") END IGNORE NULLS) OVER b AS lx, first_value(value IGNORE NULLS) OVER a AS hv, "
        "first_value(CASE WHEN value IS NOT NULL THEN epoch_us(\"timestamp\") END IGNORE NULLS) OVER a AS hx FROM tags "
        "WINDOW b AS (PARTITION BY tag ORDER BY \"timestamp\", row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "a AS (PARTITION BY tag ORDER BY \"timestamp\", row_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))",
    ),
)
def rep_fill_gap(t):
    filled = ordered.fill_gaps(t.tags, ["tag"], ["timestamp", "row_no"], "value")
    return filled.select("row_no", "tag", "value_ffill", half_up("value_linear", 6).alias("value_linear"))


@query(
    "dim_scd2",
    "WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1), "
    "flagged AS (SELECT *, lag(o_orderpriority) OVER w AS prev, row_number() OVER w AS rn FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY day)), "
    "changed AS (SELECT * FROM flagged WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority) "
    "SELECT o_custkey, o_orderpriority, strftime(day, '%Y-%m-%d') AS valid_from, "
    "coalesce(strftime(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1, '%Y-%m-%d'), '9999-12-31') AS valid_to FROM changed",
)
def dim_scd2(t):
    dated = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority", "o_orderkey")
    rows = ordered.scd2(dated, ["o_custkey"], "day", "o_orderpriority", ["o_orderkey"])
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from", "valid_to")})
