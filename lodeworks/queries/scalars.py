"""Scalar functions."""

from pyspark.sql import functions as F

from lodeworks import functions as fn
from lodeworks.constants import ASH_RANGES
from lodeworks.operators.joins import with_ranges
from lodeworks.queries.joins import RANGES_SQL
from lodeworks.queries.registry import query
from lodeworks.queries.roles import half, sql, zpad


@query("fn_round", "SELECT o_orderkey, round(o_totalprice, 0) AS r0, " + half("o_totalprice / 7") + " AS r2 FROM orders")
def fn_round(t):
    return t.orders.select("o_orderkey", F.round("o_totalprice", 0).alias("r0"), fn.half_up(F.col("o_totalprice") / 7, 2).alias("r2"))


@query("fn_cast_date_fmt", sql("vbak", "SELECT ROW_NO, strftime(TRY_CAST(ERDAT AS DATE), '%Y-%m-%d') AS day FROM vbak"))
def fn_cast_date_fmt(t):
    return t.vbak.select("ROW_NO", fn.iso_date("ERDAT").alias("day"))


@query("fn_substr", sql("samples", "SELECT SAMPLE_ID, substr(SAMPLING_DATE, 1, 7) AS month, substr(SAMPLING_DATE, 6, 2) AS mm FROM samples"))
def fn_substr(t):
    return t.samples.select("SAMPLE_ID", fn.month_of("SAMPLING_DATE").alias("month"), F.substring("SAMPLING_DATE", 6, 2).alias("mm"))


@query("fn_concat", sql("vbak", "SELECT ROW_NO, KUNNR || '_' || VKORG AS k FROM vbak"))
def fn_concat(t):
    return t.vbak.select("ROW_NO", F.concat("KUNNR", F.lit("_"), "VKORG").alias("k"))


@query(
    "fn_zfill",
    sql("kna1", f"SELECT KUNNR, {zpad('KUNNR', 10)} AS padded, {zpad('NAME1', 4)} AS kept FROM kna1"),
)
def fn_zfill(t):
    return t.kna1.select("KUNNR", fn.zfill("KUNNR", 10).alias("padded"), fn.zfill("NAME1", 4).alias("kept"))


@query("fn_nullif_div", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / NULLIF(l_discount + 0.0, 0) AS q FROM lineitem")
def fn_nullif_div(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", fn.ratio("l_quantity", F.col("l_discount") + F.lit(0.0)).alias("q"))


@query("fn_unit_scale", f"SELECT o_orderkey, {half('o_totalprice / CAST(1000000 AS DOUBLE)')} AS millions FROM orders")
def fn_unit_scale(t):
    return t.orders.select("o_orderkey", fn.half_up(F.col("o_totalprice") / F.lit(1e6), 2).alias("millions"))


@query(
    "fn_fill",
    sql("kna1 vbak", "SELECT ROW_NO, coalesce(KUNNR, BZIRK) AS k, coalesce(NETWR, 0) AS netwr, coalesce(ERNAM, '') AS ernam FROM vbak"),
)
def fn_fill(t):
    filled = t.vbak.select("ROW_NO", F.coalesce("KUNNR", "BZIRK").alias("k"), F.col("NETWR").alias("netwr"), F.col("ERNAM").alias("ernam"))
    return filled.fillna({"netwr": 0.0, "ernam": ""})


@query(
    "fn_clamp",
    sql(
        "samples",
        "SELECT SAMPLE_ID, AD, CASE WHEN AD < lo THEN lo WHEN AD > hi THEN hi ELSE AD END AS clamped FROM samples LEFT JOIN ranges USING (SAMPLE_TYPE)",
        ranges=RANGES_SQL,
    ),
)
def fn_clamp(t):
    ranged = with_ranges(t.samples.select("SAMPLE_ID", "SAMPLE_TYPE", "AD"), ASH_RANGES, "SAMPLE_TYPE")
    return ranged.select("SAMPLE_ID", "AD", fn.clamp("AD", F.col("lo"), F.col("hi")).alias("clamped"))


@query(
    "fn_regex_extract",
    sql("tags", "SELECT row_no, regexp_extract(tag, '^[^_]+_FACE_[A-Z]_([A-Z0-9_]+)$', 1) AS sensor, regexp_extract(tag, '^(M[0-9]+)', 1) AS mine FROM tags"),
)
def fn_regex_extract(t):
    return t.tags.select("row_no", fn.sensor_of("tag").alias("sensor"), fn.mine_of("tag").alias("mine"))


@query(
    "fn_regex_match",
    sql("kna1", "SELECT KUNNR, coalesce(regexp_matches(STCD1, '^[0-9]{18}$'), FALSE) AS is_code, coalesce(regexp_matches(NAME1, '[0-9]'), FALSE) AS has_digit FROM kna1"),
)
def fn_regex_match(t):
    """Every row; NULL does not match."""
    found = {"is_code": F.col("STCD1").rlike(r"^\d{18}$"), "has_digit": F.col("NAME1").rlike(r"\d")}
    return t.kna1.select("KUNNR", *(F.coalesce(c, F.lit(False)).alias(name) for name, c in found.items()))


@query("fn_length", sql("kna1", "SELECT KUNNR, coalesce(length(NAME1) < 4, FALSE) AS is_short, CAST(coalesce(length(STCD1), 0) AS INTEGER) AS code_length FROM kna1"))
def fn_length(t):
    return t.kna1.select(
        "KUNNR",
        F.coalesce(F.length("NAME1") < 4, F.lit(False)).alias("is_short"),
        F.coalesce(F.length("STCD1"), F.lit(0)).alias("code_length"),
    )


@query("fn_to_datetime", sql("kna1", "SELECT KUNNR, strftime(TRY_CAST(ERDAT AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created FROM kna1"))
def fn_to_datetime(t):
    return t.kna1.select("KUNNR", F.date_format(F.try_to_timestamp("ERDAT"), "yyyy-MM-dd HH:mm:ss").alias("created"))


@query(
    "fn_date_parts",
    sql(
        "samples",
        "SELECT SAMPLE_ID, CAST(year(CAST(SAMPLING_DATE AS DATE)) AS INTEGER) AS y, "
        "CAST(date_diff('day', CAST(SAMPLING_DATE AS DATE), CAST(TEST_DATE AS DATE)) AS INTEGER) AS days FROM samples",
    ),
)
def fn_date_parts(t):
    a, b = F.col("SAMPLING_DATE").try_cast("date"), F.col("TEST_DATE").try_cast("date")
    return t.samples.select("SAMPLE_ID", F.year(a).alias("y"), F.datediff(b, a).alias("days"))


_CONTEXT = "'column:' || o_orderstatus || '|cn:' || o_orderpriority || '|table:orders|values:k1=' || CAST(o_custkey AS STRING) || ',k2=' || o_orderstatus"


@query(
    "fn_split_map",
    "SELECT o_orderkey, o_orderstatus AS col, o_orderpriority AS cn, CAST(o_custkey AS STRING) AS k1, o_orderstatus AS k2 FROM orders",
)
def fn_split_map(t):
    context = t.orders.select("o_orderkey", F.expr(_CONTEXT).alias("context"))
    fields = context.withColumn("m", fn.text_map("context", r"\|", ":"))
    values = fields.withColumn("v", fn.text_map(F.col("m")["values"], ",", "="))
    return values.select(
        "o_orderkey", F.col("m")["column"].alias("col"), F.col("m")["cn"].alias("cn"), F.col("v")["k1"].alias("k1"), F.col("v")["k2"].alias("k2")
    )


@query(
    "fn_explode_terms",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word",
)
def fn_explode_terms(t):
    terms = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return terms.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("fn_prefix_or", sql("vbap", "SELECT VBELN, POSNR, LIFNR, CASE WHEN length(MATNR) >= 4 THEN left(MATNR, 4) ELSE 'UNKNOWN' END AS mat_type FROM vbap"))
def fn_prefix_or(t):
    return t.vbap.select("VBELN", "POSNR", "LIFNR", fn.prefix_or("MATNR", 4).alias("mat_type"))


@query(
    "fn_bucket_hash_urn",
    "SELECT p_partkey, 'urn:li:dataset:(urn:li:dataPlatform:' || p_type || ',' || p_name || ',PROD)' AS urn, p_type AS platform, p_name AS table_name FROM part",
)
def fn_bucket_hash_urn(t):
    named = t.part.select("p_partkey", fn.dataset_urn("p_type", "p_name").alias("urn"))
    return named.withColumns({"platform": fn.urn_platform("urn"), "table_name": fn.urn_table("urn")})
