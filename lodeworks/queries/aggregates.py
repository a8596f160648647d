"""Aggregations."""

from pyspark.sql import functions as F

from lodeworks.functions import bucket_case, contains, exact_avg, exact_sum, half_up, month_of, pct, ratio, sensor_of
from lodeworks.operators import aggregates as agg
from lodeworks.operators.dimensions import ASH_GRADE4
from lodeworks.operators.joins import dealt, with_ranges
from lodeworks.operators.quality import null_counts
from lodeworks.operators.quantiles import exact_quantiles
from lodeworks.constants import ASH_RANGES
from lodeworks.plans import marts
from lodeworks.queries.joins import QUANTILE_SQL, RANGES_SQL, WIDE_CTES, WIDE_ROLES
from lodeworks.queries.registry import query
from lodeworks.queries.roles import davg, dsum, half, sql
from lodeworks.session import work_path
from lodeworks.sources import partitions

SALES_DAILY_SQL = (
    "SELECT strftime(TRY_CAST(ERDAT AS DATE), '%Y-%m-%d') AS sale_date, count(*) AS order_count, "
    f"count(DISTINCT KUNNR) AS customer_count, round({dsum('NETWR')}, 2) AS total_amount, {half(davg('NETWR'))} AS avg_order_amount, "
    "count(DISTINCT AUART) AS order_type_count, count(DISTINCT VKORG) AS sales_org_count "
    "FROM dwd_vbak WHERE ERDAT IS NOT NULL AND ERDAT <> '00000000' GROUP BY 1"
)


@query("agg_sales_daily", sql("dwd_vbak", SALES_DAILY_SQL))
def agg_sales_daily(t):
    return marts.sales_daily(t.dwd_vbak)


@query("agg_sales_daily_first30", sql("dwd_vbak", SALES_DAILY_SQL + " ORDER BY sale_date LIMIT 30"))
def agg_sales_daily_first30(t):
    return marts.first_days(marts.sales_daily(t.dwd_vbak), 30)


TAG_ALARM_SQL = (
    "SELECT mine, face, tag, count(*) AS total_records, count(*) FILTER (WHERE status = -1) AS missing_count, "
    f"count(*) FILTER (WHERE value > {{high}}) AS high_value_count, {half(davg('value'), 4)} AS avg_value, {half('stddev_samp(value)', 4)} AS stddev_value, "
    f"{half('min(value)', 4)} AS min_value, {half('max(value)', 4)} AS max_value FROM tags GROUP BY mine, face, tag"
)


@query("agg_tag_alarm", sql("tags", TAG_ALARM_SQL.format(high=80) + " ORDER BY high_value_count DESC, mine, face, tag LIMIT 20"))
def agg_tag_alarm(t):
    return marts.top_alarms(marts.tag_alarm(t.tags, high=80.0), 20)


@query("agg_tag_alarm_all", sql("tags", TAG_ALARM_SQL.format(high=8000)))
def agg_tag_alarm_all(t):
    return marts.tag_alarm(t.tags)


COAL_QUALITY_SQL = (
    "SELECT MINE_CODE, MINE_NAME, substr(SAMPLING_DATE, 1, 7) AS month, SAMPLE_TYPE, count(*) AS sample_count, "
    f"{half(davg('AD'))} AS avg_ash_content, {half(davg('VD'))} AS avg_volatile_content, {half(davg('全硫St'))} AS avg_sulfur_content, "
    f"{half(davg('QGR_AD'))} AS avg_gross_calorific, {half('min(AD)')} AS min_ash_content, {half('max(AD)')} AS max_ash_content, "
    "count(DISTINCT TEST_LAB) AS lab_count FROM dwd_samples WHERE SAMPLING_DATE IS NOT NULL AND MINE_CODE IS NOT NULL GROUP BY 1, 2, 3, 4"
)


@query("agg_coal_quality", sql("dwd_samples", COAL_QUALITY_SQL))
def agg_coal_quality(t):
    return marts.coal_quality(t.dwd_samples)


@query(
    "agg_wide_production_sales",
    sql(
        WIDE_ROLES,
        f"SELECT mine_code, count(DISTINCT VBELN) AS order_count, {half(davg('daily_production', 4))} AS avg_production, "
        f"{half(davg('NETWR'))} AS avg_order_amount FROM wide WHERE mine_code IS NOT NULL GROUP BY mine_code",
        **WIDE_CTES,
    ),
)
def agg_wide_production_sales(t):
    return marts.production_vs_sales_by_side(t.dwd_vbak, t.dwd_tags)


@query(
    "agg_wide_pricing",
    sql(
        WIDE_ROLES,
        f"SELECT mine_code, {half(davg('ash_content', 4))} AS avg_ash, {half(davg('calorific', 4))} AS avg_calorific, {half(davg('NETWR'))} AS avg_price, "
        f"{half(davg('calorific', 4) + ' / NULLIF(' + davg('ash_content', 4) + ', 0)', 4)} AS price_per_calorific "
        "FROM wide WHERE mine_code IS NOT NULL AND ash_content IS NOT NULL GROUP BY mine_code",
        **WIDE_CTES,
    ),
)
def agg_wide_pricing(t):
    return marts.quality_pricing_by_side(t.dwd_vbak, t.dwd_tags, t.dwd_samples)


@query(
    "agg_wide_safety",
    sql(
        WIDE_ROLES,
        f"SELECT mine_code, face, {half(davg('daily_production', 4))} AS mean_value, {half('stddev_samp(daily_production)')} AS stddev_value, "
        "count(*) AS sample_size FROM wide WHERE face IS NOT NULL GROUP BY mine_code, face ORDER BY stddev_value DESC, mine_code, face",
        **WIDE_CTES,
    ),
)
def agg_wide_safety(t):
    return marts.safety_trend_by_side(t.dwd_vbak, t.dwd_tags).orderBy(F.desc("stddev_value"), "mine_code", "face")


@query(
    "agg_wide_fulfillment",
    sql(
        WIDE_ROLES,
        f"SELECT customer_name, count(DISTINCT VBELN) AS order_count, {dsum('NETWR')} AS total_amount, "
        f"CAST(sum(CASE WHEN first_face THEN CAST(NETWR AS DECIMAL(18,2)) END) AS DOUBLE) AS order_amount, {half(davg('NETWR'))} AS avg_order_amount, "
        "count(DISTINCT substr(ERDAT, 1, 10)) AS active_days FROM wide WHERE customer_name IS NOT NULL GROUP BY customer_name "
        "ORDER BY total_amount DESC, customer_name LIMIT 20",
        **WIDE_CTES,
    ),
)
def agg_wide_fulfillment(t):
    return marts.fulfillment_by_side(t.dwd_vbak, t.dwd_kna1, t.dwd_tags).orderBy(F.desc("total_amount"), "customer_name").limit(20)


@query("agg_cond_count", sql("tags", "SELECT mine, count(*) FILTER (WHERE status = -1) AS missing, count(*) FILTER (WHERE value > 100) AS high FROM tags GROUP BY mine"))
def agg_cond_count(t):
    return t.tags.groupBy("mine").agg(
        F.count_if(F.col("status") == -1).alias("missing"), F.count_if(F.col("value") > 100).alias("high")
    )


@query(
    "agg_count_distinct",
    sql("vbak", "SELECT VKORG, count(DISTINCT KUNNR) AS customers, count(DISTINCT AUART) AS types FROM vbak GROUP BY VKORG"),
)
def agg_count_distinct(t):
    return t.vbak.groupBy("VKORG").agg(F.countDistinct("KUNNR").alias("customers"), F.countDistinct("AUART").alias("types"))


@query(
    "agg_pct",
    sql(
        "tags",
        "SELECT count(*) FILTER (WHERE value IS NULL) * 100.0::DOUBLE / count(*) AS null_pct, count(*) FILTER (WHERE value > 100) * 100.0::DOUBLE / count(*) AS high_pct FROM tags",
    ),
)
def agg_pct(t):
    return t.tags.agg(pct(F.col("value").isNull()).alias("null_pct"), pct(F.col("value") > 100).alias("high_pct"))


_NULL_COLS = ["SAMPLE_ID", "MINE_CODE", "SAMPLE_TYPE", "AD", "VD", "QGR_AD", "全硫St"]


@query(
    "agg_multi_col_nulls",
    sql("samples", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls FROM samples" for c in _NULL_COLS)),
)
def agg_multi_col_nulls(t):
    return null_counts(t.samples, _NULL_COLS)


@query("agg_value_counts", sql("doc_flow", "SELECT STATUS, count(*) AS n FROM doc_flow GROUP BY STATUS ORDER BY n DESC, STATUS LIMIT 10"))
def agg_value_counts(t):
    return agg.value_counts(t.doc_flow, "STATUS", 10)


@query("agg_by_hour", sql("tags", 'SELECT CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS n FROM tags GROUP BY 1'))
def agg_by_hour(t):
    return t.tags.groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_named",
    sql(
        "doc_flow",
        f"SELECT FLOW_TYPE, count(AMOUNT) AS requests, {half(davg('AMOUNT'))} AS avg_amount, max(AMOUNT) AS max_amount FROM doc_flow "
        "WHERE FLOW_TYPE IS NOT NULL GROUP BY FLOW_TYPE",
    ),
)
def agg_named(t):
    return t.doc_flow.where("FLOW_TYPE IS NOT NULL").groupBy("FLOW_TYPE").agg(
        F.count("AMOUNT").alias("requests"), half_up(exact_avg("AMOUNT"), 2).alias("avg_amount"), F.max("AMOUNT").alias("max_amount")
    )


@query(
    "agg_describe",
    sql(
        "tags",
        f"SELECT mine, count(value) AS count, {half('avg(value)', 4)} AS mean, {half('stddev_samp(value)', 4)} AS std, min(value) AS min, "
        f"{half('quantile_cont(value, 0.25)', 6)} AS q25, {half('quantile_cont(value, 0.5)', 6)} AS q50, {half('quantile_cont(value, 0.75)', 6)} AS q75, "
        "max(value) AS max FROM tags GROUP BY mine",
    ),
)
def agg_describe(t):
    d = agg.describe(t.tags, ["mine"], "value")
    return d.withColumns(
        {c: half_up(c, n) for c, n in (("mean", 4), ("std", 4), ("q25", 6), ("q50", 6), ("q75", 6))}
    )


@query(
    "agg_median",
    sql(
        "tags",
        f"SELECT tag, {half('median(value)', 6)} AS median FROM tags GROUP BY tag UNION ALL SELECT 'all', {half('median(value)', 6)} FROM tags",
    ),
)
def agg_median(t):
    per_tag = exact_quantiles(t.tags, ["tag"], "value", {"median": 0.5})
    total = exact_quantiles(t.tags, [], "value", {"median": 0.5}).select(F.lit("all").alias("tag"), "median")
    return per_tag.unionByName(total).withColumn("median", half_up("median", 6))


@query(
    "agg_quantile",
    sql(
        "tags",
        f"SELECT tag, {half('quantile_cont(value, 0.95)', 6)} AS p95, {half('quantile_cont(value, 0.995)', 6)} AS p995 FROM tags GROUP BY tag",
    ),
)
def agg_quantile(t):
    q = exact_quantiles(t.tags, ["tag"], "value", {"p95": 0.95, "p995": 0.995})
    return q.withColumns({"p95": half_up("p95", 6), "p995": half_up("p995", 6)})


@query(
    "agg_group_stat_ratio",
    sql(
        "tags",
        "SELECT t.mine, count(*) FILTER (WHERE t.value > m.median * CAST(3 AS DOUBLE)) AS spikes, count(*) AS readings FROM tags t JOIN m ON t.mine = m.mine GROUP BY t.mine",
        m=QUANTILE_SQL.format(key="mine", alias="median", p=0.5, source="tags"),
    ),
)
def agg_group_stat_ratio(t):
    return agg.group_spikes(t.tags, "mine", "value")


@query(
    "agg_having_unique",
    sql("vbap", "SELECT CHARG, count(DISTINCT MATNR) AS owners FROM vbap GROUP BY CHARG HAVING count(DISTINCT MATNR) > 1"),
)
def agg_having_unique(t):
    return agg.shared_owner(t.vbap, "CHARG", "MATNR")


@query(
    "agg_fact_daily",
    sql(
        "tags",
        "SELECT strftime(\"timestamp\", '%Y-%m-%d') AS production_date, mine AS mine_code, "
        "count(*) FILTER (WHERE status = 0) * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) AS daily_running_hours, max(value) AS daily_max_wagas, "
        f"{half(davg('value'), 4)} AS daily_avg_wagas, "
        f"{half('count(*) FILTER (WHERE status = 0) * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) / CAST(24 AS DOUBLE)', 6)} AS availability_rate "
        "FROM tags WHERE tag LIKE '%_WAGAS' GROUP BY 1, 2",
    ),
)
def agg_fact_daily(t):
    hours = F.count_if(F.col("status") == 0) * F.lit(5.0) / F.lit(60.0)
    return t.tags.where(F.col("tag").like("%_WAGAS")).groupBy(
        F.col("timestamp").cast("date").alias("production_date"), F.col("mine").alias("mine_code")
    ).agg(
        hours.alias("daily_running_hours"),
        F.max("value").alias("daily_max_wagas"),
        half_up(exact_avg("value"), 4).alias("daily_avg_wagas"),
        half_up(hours / F.lit(24.0), 6).alias("availability_rate"),
    ).withColumn("production_date", F.date_format("production_date", "yyyy-MM-dd"))


FACT_SQL = (
    "SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS dt, 'M00' || CAST(l_suppkey % 5 + 1 AS STRING) AS mine_code, "
    "l_returnflag AS coal_type, l_quantity AS output_t, l_extendedprice AS amount, l_tax * 100 + 0.0 AS wagas, l_discount * 100 + 0.0 AS ash FROM lineitem"
)


def fact_sales(t):
    """Shipment lines in the role of the daily fact table."""
    return t.lineitem.selectExpr(
        "l_orderkey AS order_id",
        "CAST(l_shipdate AS DATE) AS dt",
        "'M00' || CAST(l_suppkey % 5 + 1 AS STRING) AS mine_code",
        "l_returnflag AS coal_type",
        "l_quantity AS output_t",
        "l_extendedprice AS amount",
        "l_tax * 100 + 0.0 AS wagas",
        "l_discount * 100 + 0.0 AS ash",
    )


def _fact_with_customers(t, customer: str):
    """Shipment lines with their order's customer. Nearly every line is a group of its own in what follows (an order
    or a customer on a day or in a month), so lines and orders meet in tasks of bounded size."""
    rows = t.lineitem.count()
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias(customer))
    return dealt(fact_sales(t), rows, "order_id").join(dealt(orders, rows, "order_id").hint("merge"), "order_id")


def _monthly(df, *keys):
    """Group by the first day of the month; only the result rows get a readable month."""
    return df.groupBy(F.trunc("dt", "month").alias("stat_month"), *keys)


def _name_month(df):
    return df.withColumn("stat_month", F.date_format("stat_month", "yyyy-MM"))


@query(
    "agg_monthly_rollup",
    sql(
        "",
        f"SELECT strftime(dt, '%Y-%m') AS stat_month, mine_code, coal_type, {dsum('output_t')} AS total_output_t, {dsum('amount')} AS total_amount_cny, "
        f"{half(davg('wagas'), 4)} AS avg_wagas, {half(davg('ash'), 4)} AS avg_ash, count(DISTINCT o_custkey) AS customer_cnt "
        "FROM fact JOIN orders ON order_id = o_orderkey GROUP BY 1, 2, 3",
        fact=FACT_SQL,
    ),
)
def agg_monthly_rollup(t):
    return _monthly(_fact_with_customers(t, "o_custkey"), "mine_code", "coal_type").agg(
        exact_sum("output_t").alias("total_output_t"),
        exact_sum("amount").alias("total_amount_cny"),
        half_up(exact_avg("wagas"), 4).alias("avg_wagas"),
        half_up(exact_avg("ash"), 4).alias("avg_ash"),
        F.countDistinct("o_custkey").alias("customer_cnt"),
    ).transform(_name_month)


@query(
    "agg_fulfillment_rate",
    sql(
        "",
        "SELECT stat_month, mine_code, count(*) FILTER (WHERE delay <= 0) * CAST(1 AS DOUBLE) / count(*) AS fulfillment_rate, "
        "CAST(sum(delay) AS DOUBLE) / count(*) AS avg_delay_days FROM (SELECT strftime(dt, '%Y-%m') AS stat_month, mine_code, "
        "date_diff('day', CAST(o_orderdate AS DATE) + 60, dt) AS delay FROM fact JOIN orders ON order_id = o_orderkey) GROUP BY 1, 2",
        fact=FACT_SQL,
    ),
)
def agg_fulfillment_rate(t):
    dim = t.orders.select(F.col("o_orderkey").alias("order_id"), F.date_add("o_orderdate", 60).alias("promise"))
    fact = fact_sales(t).select("order_id", "dt", "mine_code").join(dim, "order_id")
    delay = F.datediff("dt", "promise")
    return _monthly(fact, "mine_code").agg(
        ratio(F.count_if(delay <= 0), F.count(F.lit(1))).alias("fulfillment_rate"),
        ratio(F.sum(delay), F.count(F.lit(1))).alias("avg_delay_days"),
    ).transform(_name_month)


def _grade_sql(value: str) -> str:
    cuts, default = ASH_GRADE4
    return "CASE " + " ".join(f"WHEN {value} < {c} THEN '{x}'" for c, x in cuts) + f" ELSE '{default}' END"


@query(
    "agg_corr",
    sql(
        "",
        f"SELECT coal_type, {_grade_sql('ash')} AS ash_grade, count(*) AS sample_count, {half('avg(amount / NULLIF(output_t, 0))', 4)} AS avg_price, "
        f"{half('corr(ash, amount / NULLIF(output_t, 0))', 6)} AS ash_price_corr FROM fact WHERE coal_type IN ('A', 'R') GROUP BY 1, 2",
        fact=FACT_SQL,
    ),
)
def agg_corr(t):
    price = ratio("amount", "output_t")
    grade = bucket_case("ash", *ASH_GRADE4, below=True)
    return fact_sales(t).where(F.col("coal_type").isin("A", "R")).groupBy("coal_type", grade.alias("ash_grade")).agg(
        F.count(F.lit(1)).alias("sample_count"),
        half_up(F.avg(price), 4).alias("avg_price"),
        half_up(F.corr(F.col("ash"), price), 6).alias("ash_price_corr"),
    )


@query(
    "agg_ratio_day",
    sql(
        "",
        f"SELECT strftime(dt, '%Y-%m-%d') AS dt, mine_code, {dsum('output_t')} AS output_t, {half(dsum('amount') + ' / NULLIF(' + dsum('output_t') + ', 0)', 4)} AS avg_price_cny_t, "
        f"{half(dsum('wagas') + ' / NULLIF(' + dsum('output_t') + ', 0)', 6)} AS gas_output_ratio FROM fact GROUP BY 1, 2",
        fact=FACT_SQL,
    ),
)
def agg_ratio_day(t):
    out = exact_sum("output_t")
    return fact_sales(t).groupBy("dt", "mine_code").agg(
        out.alias("output_t"),
        half_up(ratio(exact_sum("amount"), out), 4).alias("avg_price_cny_t"),
        half_up(ratio(exact_sum("wagas"), out), 6).alias("gas_output_ratio"),
    ).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@query(
    "agg_dwm_sales_daily",
    sql(
        "",
        f"SELECT o_custkey AS customer_id, coal_type, strftime(dt, '%Y-%m-%d') AS dt, count(DISTINCT order_id) AS orders, {dsum('output_t')} AS shipped_t, {dsum('amount')} AS amount "
        "FROM fact JOIN orders ON order_id = o_orderkey GROUP BY 1, 2, 3",
        fact=FACT_SQL,
    ),
)
def agg_dwm_sales_daily(t):
    return _fact_with_customers(t, "customer_id").groupBy("customer_id", "coal_type", "dt").agg(
        F.countDistinct("order_id").alias("orders"), exact_sum("output_t").alias("shipped_t"), exact_sum("amount").alias("amount")
    ).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@query(
    "agg_dwm_coal_grade",
    sql(
        "samples",
        f"SELECT MINE_CODE, SAMPLE_TYPE, substr(SAMPLING_DATE, 1, 7) AS month, {half(davg('AD'), 4)} AS avg_ash, {half(davg('QGR_AD'), 4)} AS avg_calorific, "
        "count(*) FILTER (WHERE AD >= lo AND AD <= hi) * CAST(1 AS DOUBLE) / NULLIF(count(lo), 0) AS pass_rate FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE) GROUP BY 1, 2, 3",
        ranges=RANGES_SQL,
    ),
)
def agg_dwm_coal_grade(t):
    ranged = with_ranges(t.samples, ASH_RANGES, "SAMPLE_TYPE")
    return ranged.groupBy("MINE_CODE", "SAMPLE_TYPE", month_of("SAMPLING_DATE").alias("month")).agg(
        half_up(exact_avg("AD"), 4).alias("avg_ash"),
        half_up(exact_avg("QGR_AD"), 4).alias("avg_calorific"),
        ratio(F.count_if((F.col("AD") >= F.col("lo")) & (F.col("AD") <= F.col("hi"))), F.count("lo")).alias("pass_rate"),
    )


@query(
    "agg_dwm_alarm_monthly",
    sql(
        "tags",
        "SELECT mine, strftime(\"timestamp\", '%Y-%m') AS month, count(*) FILTER (WHERE value > 100) AS alarms, count(*) FILTER (WHERE value > 100 AND status = 0) * CAST(1 AS DOUBLE) / "
        "NULLIF(count(*) FILTER (WHERE value > 100), 0) AS confirmed_rate FROM tags GROUP BY 1, 2",
    ),
)
def agg_dwm_alarm_monthly(t):
    alarm = F.col("value") > 100
    return t.tags.groupBy("mine", F.trunc(F.col("timestamp").cast("date"), "month").alias("month")).agg(
        F.count_if(alarm).alias("alarms"), ratio(F.count_if(alarm & (F.col("status") == 0)), F.count_if(alarm)).alias("confirmed_rate")
    ).withColumn("month", F.date_format("month", "yyyy-MM"))


@query(
    "agg_dwm_production_daily",
    sql(
        "tags",
        "SELECT mine, strftime(\"timestamp\", '%Y-%m-%d') AS day, "
        f"{half(davg('CASE WHEN contains(tag, ' + chr(39) + 'WAGAS' + chr(39) + ') THEN value END'), 4)} AS gas_mean, "
        "max(CASE WHEN contains(tag, 'WAGAS') THEN value END) AS gas_peak, count(*) FILTER (WHERE status = 0) * CAST(1 AS DOUBLE) / count(*) AS running_rate "
        "FROM tags GROUP BY 1, 2",
    ),
)
def agg_dwm_production_daily(t):
    gas = F.when(contains("tag", "WAGAS"), F.col("value"))
    return t.tags.groupBy("mine", F.col("timestamp").cast("date").alias("day")).agg(
        half_up(exact_avg(gas), 4).alias("gas_mean"),
        F.max(gas).alias("gas_peak"),
        ratio(F.count_if(F.col("status") == 0), F.count(F.lit(1))).alias("running_rate"),
    ).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "agg_sensor_types",
    sql("tags", "SELECT regexp_extract(tag, '^[^_]+_FACE_[A-Z]_([A-Z0-9_]+)$', 1) AS sensor, count(*) AS n FROM tags GROUP BY 1"),
)
def agg_sensor_types(t):
    return agg.value_counts(t.tags.select(sensor_of("tag").alias("sensor")), "sensor")


@query(
    "agg_incremental",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders, " + dsum("o_totalprice") + " AS amount FROM orders GROUP BY 1",
)
def agg_incremental(t):
    """A stale daily table filed by month, some days changed: with those months refreshed it equals a full rebuild."""
    facts = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), F.trunc("o_orderdate", "month").alias("month"), "o_orderstatus", "o_totalprice")

    def daily(df):
        return df.groupBy("month", "day").agg(F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("amount"))

    path = work_path(t.spark, "daily")
    partitions.replace(daily(facts.where("o_orderstatus != 'P'")), path, "month")
    partitions.refresh(path, facts, facts.where("o_orderstatus = 'P'"), "month", daily)
    return t.spark.read.parquet(path).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "orders", "amount")
