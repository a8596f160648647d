"""The aggregated tables and the cross-system wide table, as plain query plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions import bridge_mine, exact_avg, exact_parts, exact_sum, exact_total, half_up, month_of, parse_date, ratio, zfill
from lodeworks.operators.joins import attach_all


def sales_daily(orders: DataFrame) -> DataFrame:
    """Orders, customers and amounts per day."""
    dated = orders.where(F.col("ERDAT").isNotNull() & (F.col("ERDAT") != "00000000"))
    # Grouped on the date itself; only the few result rows are formatted.
    daily = dated.groupBy(parse_date("ERDAT").alias("_day")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("KUNNR").alias("customer_count"),
        exact_sum("NETWR").alias("total_amount"),
        half_up(exact_avg("NETWR"), 2).alias("avg_order_amount"),
        F.countDistinct("AUART").alias("order_type_count"),
        F.countDistinct("VKORG").alias("sales_org_count"),
    )
    return daily.select(F.date_format("_day", "yyyy-MM-dd").alias("sale_date"), *[c for c in daily.columns if c != "_day"])


def first_days(daily: DataFrame, n: int = 30, ascending: bool = True) -> DataFrame:
    """The n earliest days, or the n latest with ``ascending=False``."""
    return daily.orderBy(F.asc("sale_date") if ascending else F.desc("sale_date")).limit(n)


def tag_alarm(tags: DataFrame, high: float = 8000.0) -> DataFrame:
    """Readings, lost readings and high values per sensor. Run it on raw tags: cleaned ones have no
    lost readings left."""
    return tags.groupBy("mine", "face", "tag").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("status") == -1).alias("missing_count"),
        F.count_if(F.col("value") > high).alias("high_value_count"),
        half_up(exact_avg("value"), 4).alias("avg_value"),
        half_up(F.stddev_samp("value"), 4).alias("stddev_value"),
        half_up(F.min("value"), 4).alias("min_value"),
        half_up(F.max("value"), 4).alias("max_value"),
    )


def top_alarms(alarms: DataFrame, k: int = 20) -> DataFrame:
    return alarms.orderBy(F.desc("high_value_count"), "mine", "face", "tag").limit(k)


def coal_quality(samples: DataFrame) -> DataFrame:
    """Lab results per mine, month and coal type."""
    known = samples.where(F.col("SAMPLING_DATE").isNotNull() & F.col("MINE_CODE").isNotNull())
    return known.groupBy("MINE_CODE", "MINE_NAME", month_of("SAMPLING_DATE").alias("month"), "SAMPLE_TYPE").agg(
        F.count(F.lit(1)).alias("sample_count"),
        half_up(exact_avg("AD"), 2).alias("avg_ash_content"),
        half_up(exact_avg("VD"), 2).alias("avg_volatile_content"),
        half_up(exact_avg("全硫St"), 2).alias("avg_sulfur_content"),
        half_up(exact_avg("QGR_AD"), 2).alias("avg_gross_calorific"),
        half_up(F.min("AD"), 2).alias("min_ash_content"),
        half_up(F.max("AD"), 2).alias("max_ash_content"),
        F.countDistinct("TEST_LAB").alias("lab_count"),
    )


def tags_by_face(tags: DataFrame) -> DataFrame:
    """Mean reading per mine and face; ``face_rank`` numbers the faces of a mine (a handful of rows)."""
    mean = tags.groupBy("mine", "face").agg(exact_avg("value").alias("avg_value"))
    return mean.withColumn("face_rank", F.row_number().over(Window.partitionBy("mine").orderBy("face")))


def samples_by_mine(samples: DataFrame) -> DataFrame:
    return samples.groupBy("MINE_CODE").agg(exact_avg("AD").alias("AD"), exact_avg("QGR_AD").alias("QGR_AD"))


def sales_production(orders: DataFrame, customers: DataFrame, tags: DataFrame, samples: DataFrame) -> DataFrame:
    """The wide table: one row per order and face of its mine.

    The many sides are aggregated first and attached without shuffling the orders. Both customer
    keys are padded alike. ``first_face`` marks one row per order, for money measures that must
    not count an order once per face.
    """
    o = orders.withColumns({"mine_code": bridge_mine("BZIRK"), "_k": zfill("KUNNR", 10)})
    c = customers.select(zfill("KUNNR", 10).alias("_k"), F.col("NAME1").alias("customer_name"))
    wide = o.join(c, "_k", "left")
    wide = attach_all(
        wide,
        (tags_by_face(tags).withColumnRenamed("mine", "mine_code"), "mine_code"),
        (samples_by_mine(samples).withColumnRenamed("MINE_CODE", "mine_code"), "mine_code"),
    )
    return wide.select(
        "VBELN",
        "ERDAT",
        "KUNNR",
        "customer_name",
        "mine_code",
        "face",
        half_up("avg_value", 4).alias("daily_production"),
        half_up("AD", 4).alias("ash_content"),
        half_up("QGR_AD", 4).alias("calorific"),
        half_up("NETWR", 2).alias("NETWR"),
        (F.coalesce("face_rank", F.lit(1)) == 1).alias("first_face"),
    )


def fill_defaults(wide: DataFrame) -> DataFrame:
    """Empty text and zero for missing values. Kept apart from the wide table, which keeps its NULLs."""
    text = [f.name for f in wide.schema if f.dataType.simpleString() == "string"]
    numbers = [f.name for f in wide.schema if f.dataType.simpleString() in ("double", "bigint", "int")]
    return wide.fillna("", text).fillna(0, numbers)


def production_vs_sales(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("mine_code").isNotNull()).groupBy("mine_code").agg(
        F.countDistinct("VBELN").alias("order_count"),
        half_up(exact_avg("daily_production", 4), 2).alias("avg_production"),
        half_up(exact_avg("NETWR"), 2).alias("avg_order_amount"),
    )


def quality_pricing(wide: DataFrame) -> DataFrame:
    known = wide.where(F.col("mine_code").isNotNull() & F.col("ash_content").isNotNull())
    means = known.groupBy("mine_code").agg(
        exact_avg("ash_content", 4).alias("_ash"), exact_avg("calorific", 4).alias("_cal"), exact_avg("NETWR").alias("_net")
    )
    return means.select(
        "mine_code",
        half_up("_ash", 2).alias("avg_ash"),
        half_up("_cal", 2).alias("avg_calorific"),
        half_up("_net", 2).alias("avg_price"),
        half_up(ratio("_cal", "_ash"), 4).alias("price_per_calorific"),
    )


def safety_trend(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("face").isNotNull()).groupBy("mine_code", "face").agg(
        half_up(exact_avg("daily_production", 4), 2).alias("mean_value"),
        half_up(F.stddev_samp("daily_production"), 2).alias("stddev_value"),
        F.count(F.lit(1)).alias("sample_size"),
    )


def fulfillment(wide: DataFrame) -> DataFrame:
    """Per customer. ``total_amount`` counts an order once per face, as the wide table holds it;
    ``order_amount`` counts it once."""
    return wide.where(F.col("customer_name").isNotNull()).groupBy("customer_name").agg(
        F.countDistinct("VBELN").alias("order_count"),
        exact_sum("NETWR").alias("total_amount"),
        exact_sum(F.when(F.col("first_face"), F.col("NETWR"))).alias("order_amount"),
        half_up(exact_avg("NETWR"), 2).alias("avg_order_amount"),
        F.countDistinct(F.substring("ERDAT", 1, 10)).alias("active_days"),
    )


# --- the same questions without the wide table ---
#
# An order stands in the wide table once for each face of its mine. Each side is therefore aggregated below the
# join, and the sums of one side are multiplied by the rows of the other: integer sums stay exact under that, so the
# answers are the wide table's to the last bit. Customers hold a key once, as the grain of the wide table has it.


def orders_by_mine(orders: DataFrame) -> DataFrame:
    """Orders and money per mine, each order counted once; the sums in two integer parts."""
    net = half_up("NETWR", 2)
    (high, low), (high2, low2) = exact_parts(net), exact_parts(net, 2)
    return orders.groupBy(bridge_mine("BZIRK").alias("mine_code")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("VBELN").alias("order_count"),
        F.count(net).alias("paid"),
        high.alias("net_high"),
        low.alias("net_low"),
        exact_total(high2, low2, 2).alias("sales"),
    )


def faces_by_mine(tags: DataFrame) -> DataFrame:
    """Faces per mine and the sum of their mean readings, in two integer parts."""
    shown = half_up("avg_value", 4)
    high, low = exact_parts(shown, 4)
    faces = tags_by_face(tags).where(F.col("mine").isNotNull())
    return faces.groupBy(F.col("mine").alias("mine_code")).agg(F.count(F.lit(1)).alias("faces"), F.count(shown).alias("measured"), high.alias("high"), low.alias("low"))


def _times(parts: tuple[str, str], n: Column, scale: int) -> Column:
    """The exact sum of values that stand n times each."""
    return exact_total(F.col(parts[0]) * n, F.col(parts[1]) * n, scale)


_NET, _READ = ("net_high", "net_low"), ("high", "low")


def _repeated() -> Column:
    """How often the wide table repeats an order: once per face, once without any."""
    return F.coalesce("faces", F.lit(1))


def production_vs_sales_by_side(orders: DataFrame, tags: DataFrame) -> DataFrame:
    sides = orders_by_mine(orders).where(F.col("mine_code").isNotNull()).join(faces_by_mine(tags), "mine_code", "left")
    production = F.try_divide(_times(_READ, F.col("orders"), 4), F.col("measured") * F.col("orders"))
    price = F.try_divide(_times(_NET, _repeated(), 6), F.col("paid") * _repeated())
    return sides.select("mine_code", "order_count", half_up(production, 2).alias("avg_production"), half_up(price, 2).alias("avg_order_amount"))


def quality_pricing_by_side(orders: DataFrame, tags: DataFrame, samples: DataFrame) -> DataFrame:
    lab = samples_by_mine(samples).select(F.col("MINE_CODE").alias("mine_code"), half_up("AD", 4).alias("ash"), half_up("QGR_AD", 4).alias("cal"))
    sides = orders_by_mine(orders).where(F.col("mine_code").isNotNull()).join(lab.where(F.col("ash").isNotNull()), "mine_code")
    faces = tags_by_face(tags).groupBy(F.col("mine").alias("mine_code")).agg(F.count(F.lit(1)).alias("faces"))
    rows = F.col("orders") * _repeated()

    def mean(value: str) -> Column:
        units = F.floor(F.col(value) * F.lit(1e4) + F.lit(0.5))
        return F.try_divide(exact_total(F.shiftright(units, 20) * rows, units.bitwiseAND(F.lit((1 << 20) - 1)) * rows, 4), F.when(F.col(value).isNotNull(), rows))

    price = F.try_divide(_times(_NET, _repeated(), 6), F.col("paid") * _repeated())
    return sides.join(faces, "mine_code", "left").select(
        "mine_code",
        half_up(mean("ash"), 2).alias("avg_ash"),
        half_up(mean("cal"), 2).alias("avg_calorific"),
        half_up(price, 2).alias("avg_price"),
        half_up(ratio(mean("cal"), mean("ash")), 4).alias("price_per_calorific"),
    )


def safety_trend_by_side(orders: DataFrame, tags: DataFrame) -> DataFrame:
    """Every order of a mine shows the same mean of a face, so the spread is zero, and none for a single order."""
    counted = orders.groupBy(bridge_mine("BZIRK").alias("mine_code")).agg(F.count(F.lit(1)).alias("orders"))
    faces = tags_by_face(tags).where(F.col("face").isNotNull()).select(F.col("mine").alias("mine_code"), "face", half_up("avg_value", 4).alias("shown"))
    units = F.floor(F.col("shown") * F.lit(1e4) + F.lit(0.5))
    mean = exact_total(F.shiftright(units, 20) * F.col("orders"), units.bitwiseAND(F.lit((1 << 20) - 1)) * F.col("orders"), 4) / F.col("orders")
    return faces.join(counted, "mine_code").select(
        "mine_code",
        "face",
        half_up(mean, 2).alias("mean_value"),
        half_up(F.when(F.col("shown").isNotNull() & (F.col("orders") > 1), F.lit(0.0)), 2).alias("stddev_value"),
        F.col("orders").alias("sample_size"),
    )


def fulfillment_by_side(orders: DataFrame, customers: DataFrame, tags: DataFrame) -> DataFrame:
    """Per customer name; an order stays one row, and brings the number of its mine's faces as a weight."""
    faces = tags_by_face(tags).groupBy(F.col("mine").alias("mine_code")).agg(F.count(F.lit(1)).alias("faces"))
    named = customers.where(F.col("NAME1").isNotNull()).select(zfill("KUNNR", 10).alias("_k"), F.col("NAME1").alias("customer_name"))
    keyed = orders.select("VBELN", "ERDAT", half_up("NETWR", 2).alias("net"), bridge_mine("BZIRK").alias("mine_code"), zfill("KUNNR", 10).alias("_k"))
    rows = attach_all(keyed, (faces, "mine_code")).withColumn("times", _repeated()).join(named, "_k")

    def parts(scale: int) -> tuple[Column, Column]:
        units = F.floor(F.col("net") * F.lit(float(10**scale)) + F.lit(0.5))
        return F.sum(F.shiftright(units, 20) * F.col("times")), F.sum(units.bitwiseAND(F.lit((1 << 20) - 1)) * F.col("times"))

    return rows.groupBy("customer_name").agg(
        F.countDistinct("VBELN").alias("order_count"),
        exact_total(*parts(2), 2).alias("total_amount"),
        exact_sum("net").alias("order_amount"),
        half_up(F.try_divide(exact_total(*parts(6), 6), F.sum(F.when(F.col("net").isNotNull(), F.col("times")))), 2).alias("avg_order_amount"),
        F.countDistinct(F.substring("ERDAT", 1, 10)).alias("active_days"),
    )
