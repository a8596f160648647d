"""Data quality."""

from pyspark.sql import functions as F

from lodeworks import constants as c
from lodeworks.functions import contains, exact_avg, half_up, outside, pct
from lodeworks.operators import cleaning
from lodeworks.operators import quality as dq
from lodeworks.operators import rules as rl
from lodeworks.operators.joins import with_ranges
from lodeworks.queries.joins import RANGES_SQL
from lodeworks.queries.registry import query
from lodeworks.queries.relational import _ALERTS, alert_counts
from lodeworks.queries.roles import half, sql
from lodeworks.session import work_path
from lodeworks.sources import reports

TABLES = list(c.QUALITY_RULES)
ROLES = " ".join(table for _, table in TABLES)


# --- SQL twins of the rules ---


def _within_sql(expr: str, lo, hi) -> str:
    parts = [f"{expr} >= {lo}"] if lo is not None else []
    parts += [f"{expr} <= {hi}"] if hi is not None else []
    return " AND ".join(parts) or "TRUE"


def rule_sql(no: int, kind: str, columns: tuple, lo, hi, source: str) -> str:
    col = f'"{columns[0]}"'
    if kind == c.NOT_NULL:
        bad = f"count(*) FILTER (WHERE {col} IS NULL)"
    elif kind == c.UNIQUE:
        picked = ", ".join(f'"{x}"' for x in columns)
        bad = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {picked} FROM {source}))"
    else:
        expr = col if kind == c.BETWEEN else f"length({col})"
        bad = f"count(*) FILTER (WHERE NOT coalesce({_within_sql(expr, lo, hi)}, FALSE))"
    return (
        f"SELECT CAST({no} AS INTEGER) AS rule_no, '{kind}' AS expectation, '{','.join(columns)}' AS column_name, bad = 0 AS success, "
        f"bad AS unexpected_count, {half('bad * CAST(100 AS DOUBLE) / total', 3)} AS unexpected_pct FROM (SELECT {bad} AS bad, count(*) AS total FROM {source})"
    )


def rules_sql(system: str, table: str, label: bool = False) -> str:
    head = f"SELECT '{system}' AS system, '{table}' AS table_name, * FROM " if label else "SELECT * FROM "
    body = " UNION ALL ".join(rule_sql(i, *spec, table) for i, spec in enumerate(c.QUALITY_RULES[system, table], 1))
    return f"{head}({body})"


RESULTS_SQL = " UNION ALL ".join(rules_sql(*key, label=True) for key in TABLES)


def _grade_sql(expr: str, scale) -> str:
    return "CASE " + " ".join(f"WHEN {expr} >= {cut} THEN '{g}'" for cut, g in scale) + " ELSE 'D' END"


def scored_sql(by: str, scale, digits: int) -> str:
    exact = "passed * CAST(100 AS DOUBLE) / (passed + failed)"
    return (
        f"SELECT {by}, passed, failed, {_grade_sql(exact, scale)} AS grade, {half(exact, digits)} AS score FROM "
        f"(SELECT {by}, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed FROM results GROUP BY ALL)"
    )


SCORES_SQL = scored_sql("system, table_name", c.GRADES_CHECKPOINT, 2)
_NO_ERROR = [x for x in rl.RESULT_COLUMNS if x != "error"]


def _single(name: str, role: str, rule: tuple) -> None:
    @query(name, sql(role, rule_sql(1, *rule, role)))
    def run(t):
        return rl.evaluate(getattr(t, role), [rl.Rule(*rule)]).select(*_NO_ERROR)


_single("dq_not_null", "vbak", (c.NOT_NULL, ("NETWR",), None, None))
_single("dq_unique", "vbap", (c.UNIQUE, ("VBELN", "POSNR"), None, None))
_single("dq_between", "samples", (c.BETWEEN, ("AD",), 0, 100))
_single("dq_length", "kna1", (c.LENGTH, ("STCD1",), 17, 20))


def _rule_run(system: str, table: str) -> None:
    @query(f"dq_rule_run_{table}", sql(table, rules_sql(system, table)))
    def run(t):
        return rl.evaluate(getattr(t, table), rl.rules_for(system, table)).select(*_NO_ERROR)


for _key in TABLES:
    _rule_run(*_key)


def all_results(t):
    return rl.checkpoint({key: getattr(t, key[1]) for key in TABLES})


@query("dq_rule_results", sql(ROLES, RESULTS_SQL))
def dq_rule_results(t):
    return all_results(t).drop("error")


@query("dq_checkpoint", sql(ROLES, SCORES_SQL, results=RESULTS_SQL))
def dq_checkpoint(t):
    return rl.scored(all_results(t), ["system", "table_name"])


@query(
    "dq_summary",
    sql(
        ROLES,
        "SELECT * FROM per_system UNION ALL SELECT 'average', CAST(sum(passed) AS BIGINT), CAST(sum(failed) AS BIGINT), "
        + _grade_sql("avg(score)", c.GRADES_SCAN)
        + f", {half('avg(score)', 1)} FROM per_system",
        results=RESULTS_SQL,
        per_system=scored_sql("system", c.GRADES_SCAN, 1),
    ),
)
def dq_summary(t):
    per_system = rl.scored(all_results(t), ["system"], c.GRADES_SCAN, digits=1)
    mean = exact_avg("score", 1)
    overall = per_system.agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), mean.alias("_mean")).select(
        F.lit("average").alias("system"),
        "passed",
        "failed",
        rl.grade(F.col("_mean"), c.GRADES_SCAN).alias("grade"),
        half_up("_mean", 1).alias("score"),
    )
    return per_system.unionByName(overall)


@query(
    "snk_json_report",
    sql(
        ROLES,
        "SELECT s.*, (SELECT count(*) FROM results r WHERE r.system = s.system AND r.table_name = s.table_name AND NOT r.success) AS failures, "
        "coalesce((SELECT sum(unexpected_count) FROM results r WHERE r.system = s.system AND r.table_name = s.table_name AND NOT r.success), 0)::BIGINT AS unexpected "
        "FROM scores s",
        results=RESULTS_SQL,
        scores=SCORES_SQL,
    ),
)
def snk_json_report(t):
    results = all_results(t)
    path = work_path(t.spark, "report")
    reports.write_report(reports.build_report(results, rl.scored(results, ["system", "table_name"])), path)
    stored = reports.read_report(t.spark, path)
    total = F.aggregate(F.coalesce("details", F.array()), F.lit(0).cast("bigint"), lambda acc, d: acc + d["unexpected_count"])
    return stored.select(
        "system",
        "table_name",
        "passed",
        "failed",
        "grade",
        "score",
        F.coalesce(F.array_size("details"), F.lit(0)).cast("bigint").alias("failures"),
        total.alias("unexpected"),
    )


# --- table checks ---


def _pct(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) * CAST(100 AS DOUBLE) / count(*)"


def _dup_pct(columns: str, source: str) -> str:
    return f"(SELECT sum(n - 1)::BIGINT * CAST(100 AS DOUBLE) / sum(n)::BIGINT FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns}))"


_VBAK_ROW = ["VBELN", "ERDAT", "ERZET", "ERNAM", "AUART", "KUNNR", "NETWR", "VKORG"]
CHECK_ORDERS_SQL = (
    "SELECT "
    + ", ".join(f"(SELECT {_pct(f'{x} IS NULL')} FROM vbak) AS null_{x}" for x in ("NETWR", "ERZET", "ERNAM", "KUNNR"))
    + f", {_dup_pct(', '.join(_VBAK_ROW), 'vbak')} AS dup_vbak, {_dup_pct('NAME1, ORT01', 'kna1')} AS dup_kna1, "
    + f"(SELECT {_pct('VBELN = -1')} FROM vbap) AS invalid_link_pct"
)


def check_orders(t):
    return dq.check_orders(t.vbak.select(*_VBAK_ROW), t.vbap, t.kna1.select("NAME1", "ORT01"), -1)


@query("dq_check_orders", sql("vbak vbap kna1", CHECK_ORDERS_SQL))
def dq_check_orders(t):
    return check_orders(t)


_GAS = "contains(tag, 'WAGAS')"
_MEDIAN = f"(SELECT median(value) FROM tags WHERE {_GAS})"
CHECK_SENSOR_SQL = (
    f"SELECT (SELECT {_pct('status = -1')} FROM tags) AS missing_pct, {_pct('value > 1.0')} AS wagas_danger_pct, "
    f"{_pct(f'value > {_MEDIAN} * CAST(3 AS DOUBLE)')} AS wagas_anomaly_pct FROM tags WHERE {_GAS}"
)


@query("dq_check_sensor", sql("tags", CHECK_SENSOR_SQL))
def dq_check_sensor(t):
    return dq.check_sensor(t.tags)


_LAB = ["AD", "VD", "QGR_AD", "全硫St"]
_LAB_ROW = ["SAMPLE_ID", "MINE_CODE", "SAMPLE_TYPE", "SAMPLING_DATE", *_LAB]
_OUT = "coalesce(AD < lo OR AD > hi, FALSE)"
CHECK_LAB_SQL = (
    "SELECT "
    + ", ".join(f'{_pct(chr(34) + x + chr(34) + " IS NULL")} AS "null_{x}"' for x in _LAB)
    + f", {_pct(_OUT)} AS ad_outlier_pct, "
    + _dup_pct(", ".join(f'"{x}"' for x in _LAB_ROW), "samples")
    + " AS dup_pct FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE)"
)


@query("dq_check_lab", sql("samples", CHECK_LAB_SQL, ranges=RANGES_SQL))
def dq_check_lab(t):
    return dq.check_lab(t.samples.select(*_LAB_ROW), _LAB)


_FLOW_ROW = ["DOC_NO", "FLOW_TYPE", "STATUS", "APPLY_DATE"]
CHECK_FLOW_SQL = (
    f"SELECT {_dup_pct(', '.join(_FLOW_ROW), 'doc_flow')} AS dup_pct, {_pct('FLOW_TYPE IS NULL')} AS \"null_FLOW_TYPE\", "
    f"{_pct('STATUS IS NULL')} AS \"null_STATUS\" FROM doc_flow"
)


@query("dq_check_flow", sql("doc_flow", CHECK_FLOW_SQL))
def dq_check_flow(t):
    return dq.check_flow(t.doc_flow.select(*_FLOW_ROW))


def _score_sql(expr: str, factor: int) -> str:
    return half(f"greatest(CAST(0 AS DOUBLE), CAST(100 AS DOUBLE) - ({expr}) * CAST({factor} AS DOUBLE))", 1)


def _scores_sql(system: str, source: str, nulls: str, dup: str, outlier: str, link: str) -> str:
    return (
        f"SELECT '{system}' AS system, {_score_sql(nulls, 10)} AS completeness, {_score_sql(dup, 10)} AS uniqueness, "
        f"{_score_sql(outlier, 5)} AS accuracy, {_score_sql(link, 5)} AS consistency FROM {source}"
    )


_Z = "CAST(0 AS DOUBLE)"
_DIMS_SQL = " UNION ALL ".join(
    [
        _scores_sql("SAP-ERP", "o", '("null_NETWR" + "null_ERNAM") / CAST(2 AS DOUBLE)', "dup_vbak", _Z, "invalid_link_pct"),
        _scores_sql("PI-System", "s", "missing_pct", _Z, "wagas_danger_pct", "wagas_anomaly_pct"),
        _scores_sql("LIMS", "l", '"null_AD"', "dup_pct", "ad_outlier_pct", _Z),
        _scores_sql("OA", "f", '"null_FLOW_TYPE"', "dup_pct", _Z, _Z),
    ]
)
_TOTAL = f"{_Z} + completeness * CAST(0.3 AS DOUBLE) + consistency * CAST(0.3 AS DOUBLE) + accuracy * CAST(0.2 AS DOUBLE) + uniqueness * CAST(0.2 AS DOUBLE)"


@query(
    "dq_score",
    sql(
        "vbak vbap kna1 tags samples doc_flow",
        f"SELECT *, {half(_TOTAL)} AS composite FROM dims",
        ranges=RANGES_SQL,
        o=CHECK_ORDERS_SQL,
        s=CHECK_SENSOR_SQL,
        l=CHECK_LAB_SQL,
        f=CHECK_FLOW_SQL,
        dims=_DIMS_SQL,
    ),
)
def dq_score(t):
    zero = F.lit(0.0)

    def scores(system, checks, nulls, dup, outlier, link):
        dims = dq.dimension_scores(nulls, dup, outlier, link)
        return checks.select(F.lit(system).alias("system"), *[e.alias(k) for k, e in dims.items()])

    half_sum = (F.col("null_NETWR") + F.col("null_ERNAM")) / F.lit(2.0)
    rows = (
        scores("SAP-ERP", check_orders(t), half_sum, F.col("dup_vbak"), zero, F.col("invalid_link_pct"))
        .unionByName(
            scores("PI-System", dq.check_sensor(t.tags), F.col("missing_pct"), zero, F.col("wagas_danger_pct"), F.col("wagas_anomaly_pct"))
        )
        .unionByName(
            scores("LIMS", dq.check_lab(t.samples.select(*_LAB_ROW), _LAB), F.col("null_AD"), F.col("dup_pct"), F.col("ad_outlier_pct"), zero)
        )
        .unionByName(
            scores("OA", dq.check_flow(t.doc_flow.select(*_FLOW_ROW)), F.col("null_FLOW_TYPE"), F.col("dup_pct"), zero, zero)
        )
    )
    return dq.composite(rows)


# --- root causes ---


@query(
    "dq_root_link",
    sql(
        "vbap",
        f"SELECT prefix, n, {half('n * CAST(100 AS DOUBLE) / total')} AS share_pct FROM (SELECT substr(MATNR, 1, 8) AS prefix, count(*) AS n, "
        "(SELECT count(*) FROM vbap WHERE VBELN = -1) AS total FROM vbap WHERE VBELN = -1 GROUP BY 1) ORDER BY n DESC, prefix NULLS FIRST LIMIT 10",
    ),
)
def dq_root_link(t):
    return dq.root_link(t.vbap, -1, width=8)


@query(
    "dq_root_missing",
    sql("tags", "SELECT tag, count(*) AS missing FROM tags WHERE status = -1 GROUP BY tag ORDER BY missing DESC, tag LIMIT 10"),
)
def dq_root_missing(t):
    return dq.root_missing_by_tag(t.tags)


@query(
    "dq_root_missing_hour",
    sql("tags", 'SELECT CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS missing FROM tags WHERE status = -1 GROUP BY 1'),
)
def dq_root_missing_hour(t):
    return dq.root_missing_by_hour(t.tags)


@query(
    "dq_root_spike",
    sql(
        "tags",
        f"SELECT tag, count(*) AS anomalies, {half(_MEDIAN, 4)} AS baseline, {half(_MEDIAN + ' * CAST(3 AS DOUBLE)', 4)} AS threshold FROM tags "
        f"WHERE {_GAS} AND value > {_MEDIAN} * CAST(3 AS DOUBLE) GROUP BY tag ORDER BY anomalies DESC, tag LIMIT 10",
    ),
)
def dq_root_spike(t):
    return dq.root_spike(t.tags)


@query(
    "dq_root_range",
    sql(
        "samples",
        f"SELECT SAMPLE_TYPE, count(*) AS outliers, {half('count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM samples)', 3)} AS share_pct "
        f"FROM samples JOIN ranges USING (SAMPLE_TYPE) WHERE {_OUT} GROUP BY SAMPLE_TYPE",
        ranges=RANGES_SQL,
    ),
)
def dq_root_range(t):
    return dq.root_range(t.samples)


_KINDS = ["orphan_lines", "lost_points", "bad_points", "negative_ash", "amount_null"]


@query(
    "dq_alert_matrix",
    sql(
        "vbap tags samples doc_flow",
        "SELECT system, " + ", ".join(f"coalesce(sum(rows_affected) FILTER (WHERE alert = '{k}'), 0)::BIGINT AS {k}" for k in _KINDS) + " FROM alerts GROUP BY system",
        alerts=_ALERTS,
    ),
)
def dq_alert_matrix(t):
    return dq.alert_matrix(alert_counts(t), _KINDS)


_COSTS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{label}', '{u}', CAST({y} AS DOUBLE))" for k, label, u, y in c.ALERT_COSTS) + ") AS v(alert_key, label, unit, unit_cost)"
_RATES_SQL = (
    f"SELECT 'SAP.invalid_link_pct' AS alert_key, count(*) AS total_rows, {_pct('VBELN = -1')} AS rate_pct FROM vbap "
    f"UNION ALL SELECT 'PI.wagas_danger_pct', count(*), {_pct('value > 1.0')} FROM tags WHERE {_GAS} "
    f"UNION ALL SELECT 'LIMS.ad_outlier_pct', count(*), {_pct(_OUT)} FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE)"
)


@query(
    "dq_impact",
    sql(
        "vbap tags samples",
        "SELECT alert_key, total_rows, rate_pct, label, unit, unit_cost, CAST(events AS BIGINT) AS events_per_year, "
        + half("CAST(events AS BIGINT) * unit_cost")
        + " AS total_yuan FROM (SELECT *, floor(total_rows * rate_pct / CAST(100 AS DOUBLE)) AS events FROM rates) JOIN costs USING (alert_key)",
        ranges=RANGES_SQL,
        rates=_RATES_SQL,
        costs=_COSTS_SQL,
    ),
)
def dq_impact(t):
    def rate(df, key, cond):
        return df.agg(F.count(F.lit(1)).alias("total_rows"), pct(cond).alias("rate_pct")).select(
            F.lit(key).alias("alert_key"), "total_rows", "rate_pct"
        )

    alerts = (
        rate(t.vbap, "SAP.invalid_link_pct", F.col("VBELN") == -1)
        .unionByName(rate(t.tags.where(contains("tag", "WAGAS")), "PI.wagas_danger_pct", F.col("value") > 1.0))
        .unionByName(rate(with_ranges(t.samples, c.ASH_RANGES, "SAMPLE_TYPE"), "LIMS.ad_outlier_pct", outside("AD", "lo", "hi")))
    )
    return dq.annual_cost(alerts)


@query(
    "dq_profile",
    sql(
        "kna1",
        "SELECT count(*) - count(DISTINCT KUNNR) AS dup_key, count(*) FILTER (WHERE NOT coalesce(regexp_matches(STCD1, '^[0-9]{18}$'), FALSE)) AS code_invalid, "
        "count(*) FILTER (WHERE length(NAME1) < 4) AS name_short, count(*) FILTER (WHERE regexp_matches(NAME1, '[0-9]')) AS name_digit, "
        "count(*) FILTER (WHERE TRY_CAST(ERDAT AS DATE) < DATE '2015-01-01' OR TRY_CAST(ERDAT AS DATE) > DATE '2025-01-01') AS date_out FROM kna1",
    ),
)
def dq_profile(t):
    return dq.profile_customers(t.kna1)


_DAYS = "date_diff('day', CAST(SAMPLING_DATE AS DATE), CAST(TEST_DATE AS DATE))"


@query(
    "dq_profile_lab",
    sql(
        "samples",
        f"SELECT count(*) FILTER (WHERE {_DAYS} > 30) AS slow, count(*) FILTER (WHERE {_DAYS} < 0) AS negative_days, "
        "count(*) FILTER (WHERE AD < 0 OR AD > 100) AS ash_out, count(*) FILTER (WHERE QGR_AD < 0) AS heat_negative, "
        "count(*) FILTER (WHERE \"全硫St\" < 0) AS sulfur_negative FROM samples",
    ),
)
def dq_profile_lab(t):
    return dq.profile_lab(t.samples)


@query(
    "dq_profile_flow",
    sql(
        "doc_flow",
        "SELECT count(*) FILTER (WHERE AMOUNT IS NULL) AS amount_null, count(*) FILTER (WHERE AMOUNT = 0 AND FLOW_TYPE IN ('付款申请', '采购申请')) AS amount_zero, "
        "count(*) FILTER (WHERE STATUS = '审批中') AS in_progress, "
        "count(*) FILTER (WHERE date_diff('day', CAST(APPLY_DATE AS DATE), make_date(year(CAST(APPLY_DATE AS DATE)), 12, 31)) > 30) AS slow FROM doc_flow",
    ),
)
def dq_profile_flow(t):
    return dq.profile_flow(t.doc_flow, ["付款申请", "采购申请"], "审批中")


@query(
    "dq_clean_stats",
    sql(
        "dwd_vbap",
        f"SELECT before, after, before - after AS dropped, {half('(before - after) * CAST(100 AS DOUBLE) / before')} AS dropped_pct FROM "
        "(SELECT (SELECT count(*) FROM vbap) AS before, (SELECT count(*) FROM dwd_vbap) AS after)",
    ),
)
def dq_clean_stats(t):
    return cleaning.cleaning_stats(t.vbap, t.dwd_vbap)


# --- score history ---

_EXACT = "passed * CAST(100 AS DOUBLE) / (passed + failed)"
HISTORY_SQL = (
    f"SELECT run_date, system, table_name, {half(_EXACT)} AS score, {_grade_sql(_EXACT, c.GRADES_CHECKPOINT)} AS grade, passed, failed FROM ("
    "SELECT CAST(o_orderdate AS DATE) AS run_date, 'sap_erp' AS system, 'vbak' AS table_name, count(*) FILTER (WHERE o_totalprice >= 150000) AS passed, "
    "count(*) FILTER (WHERE o_totalprice < 150000) AS failed FROM orders GROUP BY 1 UNION ALL "
    "SELECT CAST(ts AS DATE), 'pi_system', 'tags', count(*) FILTER (WHERE value < 100), count(*) FILTER (WHERE value >= 100) FROM events GROUP BY 1)"
)


def history(t):
    """Scores per day and table, derived from the share of large orders and of calm readings."""

    def daily(df, day, system, table, ok):
        return df.groupBy(F.col(day).cast("date").alias("run_date")).agg(
            F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed")
        ).select("run_date", F.lit(system).alias("system"), F.lit(table).alias("table_name"), "passed", "failed")

    rows = daily(t.orders, "o_orderdate", "sap_erp", "vbak", F.col("o_totalprice") >= 150000).unionByName(
        daily(t.events, "ts", "pi_system", "tags", F.col("value") < 100)
    )
    exact = F.try_divide(F.col("passed") * F.lit(100.0), F.col("passed") + F.col("failed"))
    return rows.select(
        *dq.SCORE_KEYS,
        half_up(exact, 2).alias("score"),
        rl.grade(exact, c.GRADES_CHECKPOINT).alias("grade"),
        "passed",
        "failed",
    )


def _text_date(df):
    return df.withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


_HIST_COLS = "strftime(run_date, '%Y-%m-%d') AS run_date, system, table_name, score, grade, passed, failed"


@query(
    "dq_history_upsert",
    sql(
        "",
        "SELECT strftime(run_date, '%Y-%m-%d') AS run_date, system, table_name, CASE WHEN redo THEN 100.0::DOUBLE ELSE score END AS score, "
        "CASE WHEN redo THEN 'A' ELSE grade END AS grade, passed, failed FROM (SELECT *, run_date >= DATE '2001-01-01' AS redo FROM h)",
        h=HISTORY_SQL,
    ),
)
def dq_history_upsert(t):
    old = history(t)
    redo = old.where(F.col("run_date") >= F.lit("2001-01-01").cast("date")).withColumns({"score": F.lit(100.0), "grade": F.lit("A")})
    return _text_date(dq.merge_history(old, redo))


@query(
    "dq_history_query",
    sql("", f"SELECT {_HIST_COLS} FROM h WHERE h.run_date >= DATE '2024-01-31' - 30 ORDER BY h.run_date, system, table_name", h=HISTORY_SQL),
)
def dq_history_query(t):
    return _text_date(dq.recent_history(history(t), F.lit("2024-01-31").cast("date"), 30))


@query("dq_alerts", sql("", f"SELECT {_HIST_COLS} FROM h WHERE score < 70", h=HISTORY_SQL))
def dq_alerts(t):
    path = work_path(t.spark, "alerts")
    dq.alerts_below(_text_date(history(t))).write.mode("append").json(path)
    columns = "run_date string, system string, table_name string, score double, grade string, passed bigint, failed bigint"
    return t.spark.read.schema(columns).json(path)


@query(
    "dq_gap_total",
    sql("", f"SELECT strftime(run_date, '%Y-%m-%d') AS run_date, system, {half('avg(score)')} AS avg_score FROM h GROUP BY h.run_date, system", h=HISTORY_SQL),
)
def dq_gap_total(t):
    return _text_date(dq.score_trend(history(t)))


_DAILY_RANGES = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for k, (lo, hi) in c.ASH_RANGES_DAILY.items()
) + ") AS v(SAMPLE_TYPE, lo, hi)"


@query(
    "dq_check_increment",
    sql(
        "vbak tags samples",
        "SELECT (SELECT " + " + ".join(f"count(*) FILTER (WHERE {x} IS NULL)" for x in _VBAK_ROW) + " FROM vbak) AS order_nulls, "
        f"(SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM vbak GROUP BY {', '.join(_VBAK_ROW)})) AS order_dups, "
        "(SELECT count(*) FILTER (WHERE status = -1)::DOUBLE / count(*) FROM tags) AS missing_rate, "
        "(SELECT count(*) FILTER (WHERE status = -2)::DOUBLE / count(*) FROM tags) AS bad_point_rate, "
        f"(SELECT count(*) FROM samples JOIN ranges USING (SAMPLE_TYPE) WHERE {_OUT}) AS lab_invalid",
        ranges=_DAILY_RANGES,
    ),
)
def dq_check_increment(t):
    return dq.check_increment(t.vbak.select(*_VBAK_ROW), t.tags, t.samples, c.ASH_RANGES_DAILY)


@query(
    "dq_qty_tolerance",
    "SELECT l_orderkey, ordered, delivered FROM (SELECT l_orderkey, sum(l_quantity) AS ordered, "
    "sum(CASE WHEN l_partkey % 11 = 0 THEN l_quantity - 2 ELSE l_quantity END) AS delivered FROM lineitem GROUP BY l_orderkey) "
    "WHERE abs(delivered - ordered) > CAST(0.05 AS DOUBLE) * ordered",
)
def dq_qty_tolerance(t):
    ordered = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("quantity"))
    delivered = t.lineitem.select(
        "l_orderkey", F.expr("CASE WHEN l_partkey % 11 = 0 THEN l_quantity - 2 ELSE l_quantity END").alias("quantity")
    )
    return dq.quantity_breaks(ordered, delivered, "l_orderkey")
