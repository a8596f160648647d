"""Conformed dimensions and derived fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.constants import ASH_RANGES
from lodeworks.functions import bucket_case, half_up, prefix_or, ratio
from lodeworks.operators.dedup import distinct_by, not_null
from lodeworks.operators.joins import with_ranges


def dim_mine(tags: DataFrame, samples: DataFrame) -> DataFrame:
    """Mines known to the sensor system, the lab, or both."""
    sensor = not_null(tags.select(F.col("mine").alias("mine_code")), ["mine_code"]).distinct().withColumn("pi", F.col("mine_code"))
    lab = distinct_by(
        samples.select(F.col("MINE_CODE").alias("mine_code"), F.col("MINE_NAME").alias("lab_name")),
        ["mine_code"],
        ["mine_code", "lab_name"],
        ["lab_name"],
    ).withColumn("lims", F.col("mine_code"))
    merged = sensor.join(lab, "mine_code", "full_outer")
    return merged.select(
        "mine_code",
        F.coalesce("lab_name", "mine_code").alias("mine_name"),
        F.lit("生产矿井").alias("mine_type"),
        F.col("mine_code").alias("sap_mine_field"),
        F.coalesce("pi", "mine_code").alias("pi_mine_field"),
        F.coalesce("lims", "mine_code").alias("lims_mine_field"),
    )


def dim_customer(kna1: DataFrame) -> DataFrame:
    rows = distinct_by(kna1, ["KUNNR"], ["KUNNR", "NAME1", "ORT01"], ["NAME1", "ORT01"])
    return rows.select(
        F.col("KUNNR").alias("kunnr"),
        F.col("NAME1").alias("customer_name"),
        F.col("ORT01").alias("region"),
        F.lit("UNKNOWN").alias("credit_level"),
    )


def dim_material(vbap: DataFrame) -> DataFrame:
    keys = not_null(vbap.select(F.col("MATNR").cast("string").alias("matnr")), ["matnr"]).distinct()
    return keys.select("matnr", F.col("matnr").alias("mat_desc"), prefix_or("matnr", 4).alias("mat_type"))


def dim_coal_type(samples: DataFrame, ranges: dict = ASH_RANGES, labels: DataFrame | None = None) -> DataFrame:
    """Coal types seen in the lab, with name, reference ash range and sulfur limit (percent).

    ``labels`` is the caller's table (coal_type, coal_name, sulfur_limit_pct); of several rows for a type the first by name
    and limit counts. A type that it lacks goes by its code and has no limit.
    """
    types = not_null(samples.select("SAMPLE_TYPE"), ["SAMPLE_TYPE"]).distinct()
    ranged = with_ranges(types, ranges, "SAMPLE_TYPE").withColumnRenamed("SAMPLE_TYPE", "coal_type")
    if labels is None:
        named = ranged.withColumns({"coal_name": F.col("coal_type"), "sulfur_limit_pct": F.lit(None).cast("double")})
    else:
        order = ["coal_type", "coal_name", "sulfur_limit_pct"]
        named = ranged.join(distinct_by(labels, ["coal_type"], order, order[1:]), "coal_type", "left")
    return named.select(
        "coal_type",
        F.coalesce("coal_name", "coal_type").alias("coal_name"),
        F.col("lo").alias("ash_min"),
        F.col("hi").alias("ash_max"),
        half_up(F.col("sulfur_limit_pct").cast("double"), 2).alias("sulfur_limit_pct"),
    )


# --- fixed values: cuts of the derived classes ---
ORDER_SIZE = ([(100000.0, "大额订单"), (10000.0, "中额订单")], "小额订单")
ASH_GRADE = ([(40.0, "高灰煤"), (20.0, "中灰煤")], "低灰煤")
ASH_GRADE4 = ([(8.0, "优质（灰分<8%）"), (12.0, "良好（8-12%）"), (20.0, "中等（12-20%）")], "较差（>20%）")


def extend_orders(vbak: DataFrame, raw_date: str = "ERDAT") -> DataFrame:
    """Size class, readable date and the customer / sales-organisation key."""
    return vbak.where(F.col("ERDAT").isNotNull()).withColumns(
        {
            "order_size_category": bucket_case("NETWR", *ORDER_SIZE),
            "sale_date_formatted": F.concat_ws(
                "-", F.substring(raw_date, 1, 4), F.substring(raw_date, 5, 2), F.substring(raw_date, 7, 2)
            ),
            "customer_salesorg_key": F.concat(F.col("KUNNR"), F.lit("_"), F.col("VKORG")),
        }
    )


def extend_samples(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("AD").isNotNull()).withColumns(
        {
            "ash_grade": bucket_case("AD", *ASH_GRADE),
            "sulfur_ash_ratio": half_up(ratio(F.col("全硫St") * 100, F.col("AD")), 2),
        }
    )
