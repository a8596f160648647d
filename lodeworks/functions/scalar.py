"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: ColumnLike, digits: int = 2) -> Column:
    """Round half up with plain IEEE steps, so that any engine gives the same double."""
    scale = float(10**digits)
    return F.floor(_col(value) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def exact_parts(value: ColumnLike, scale: int = 6) -> tuple[Column, Column]:
    """High and low bits of an exact sum, as two integer sums that can be added up further."""
    units = F.floor(_col(value) * F.lit(float(10**scale)) + F.lit(0.5))
    return F.sum(F.shiftright(units, 20)), F.sum(units.bitwiseAND(F.lit((1 << 20) - 1)))


def exact_total(high: Column, low: Column, scale: int = 6) -> Column:
    """The sum that the two parts stand for."""
    return (high.cast("double") * F.lit(float(1 << 20)) + low.cast("double")) / F.lit(float(10**scale))


def exact_sum(value: ColumnLike, scale: int = 2) -> Column:
    """Sum of numbers with ``scale`` decimals that does not depend on the order of partitions.

    Values are counted in whole units of the last digit. High and low bits are summed apart, so
    that neither sum can overflow before some 10**12 rows meet in one group; primitive sums are
    several times faster than decimal ones.
    """
    return exact_total(*exact_parts(value, scale), scale)


def exact_avg(value: ColumnLike, scale: int = 6) -> Column:
    """Mean of numbers with up to ``scale`` decimals. Readings and lab values have three or four, money two."""
    return F.try_divide(exact_sum(value, scale), F.count(_col(value)))


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """``x / NULLIF(y, 0)``."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def pct(condition: Column) -> Column:
    """Share of rows for which the condition holds, in percent; NULL counts as not holding."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))


def zfill(value: ColumnLike, width: int) -> Column:
    """Pad with zeros on the left; a longer value is kept whole (``lpad`` alone would cut it)."""
    text = _col(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def clamp(value: ColumnLike, lo: ColumnLike, hi: ColumnLike) -> Column:
    """Limit to ``[lo, hi]``; a NULL value or a NULL bound changes nothing."""
    value, lo, hi = _col(value), _col(lo), _col(hi)
    return F.when(value < lo, lo).when(value > hi, hi).otherwise(value)


def outside(value: ColumnLike, lo: ColumnLike, hi: ColumnLike) -> Column:
    """True where the value lies outside the range; NULL value or bounds give false."""
    value = _col(value)
    return F.coalesce((value < _col(lo)) | (value > _col(hi)), F.lit(False))


def contains(value: ColumnLike, needle: str) -> Column:
    return F.coalesce(_col(value).contains(needle), F.lit(False))


def parse_date(value: ColumnLike) -> Column:
    """Date from ISO text; text that is no date becomes NULL."""
    return _col(value).try_cast("date")


def iso_date(value: ColumnLike) -> Column:
    return F.date_format(parse_date(value), "yyyy-MM-dd")


def month_of(value: ColumnLike) -> Column:
    return F.substring(_col(value), 1, 7)


def prefix_or(value: ColumnLike, width: int, default: str = "UNKNOWN") -> Column:
    text = _col(value).cast("string")
    return F.when(F.length(text) >= width, F.left(text, F.lit(width))).otherwise(F.lit(default))


def bridge_mine(district: ColumnLike) -> Column:
    """Mine code behind a sales district: ``D001`` belongs to ``M001``."""
    return F.concat(F.lit("M"), F.substring(_col(district), 2, 3))


def sensor_of(tag: ColumnLike) -> Column:
    """Sensor type, the part behind the face letter; the longest name wins, so CO2 stays CO2."""
    return F.regexp_extract(_col(tag), r"^[^_]+_FACE_[A-Z]_([A-Z0-9_]+)$", 1)


def mine_of(tag: ColumnLike) -> Column:
    return F.regexp_extract(_col(tag), r"^(M\d+)", 1)


def text_map(value: ColumnLike, pair_sep: str = ",", key_sep: str = "=") -> Column:
    """``k1=v1,k2=v2`` as a map."""
    return F.str_to_map(_col(value), F.lit(pair_sep), F.lit(key_sep))


def dataset_urn(platform: ColumnLike, table: ColumnLike) -> Column:
    return F.concat(
        F.lit("urn:li:dataset:(urn:li:dataPlatform:"), _col(platform), F.lit(","), _col(table), F.lit(",PROD)")
    )


def urn_platform(urn: ColumnLike) -> Column:
    return F.regexp_extract(_col(urn), r"dataPlatform:([^,]+),", 1)


def urn_table(urn: ColumnLike) -> Column:
    return F.regexp_extract(_col(urn), r"dataPlatform:[^,]+,(.+),[A-Z]+\)$", 1)


def mask_text(value: ColumnLike, keep: int = 4) -> Column:
    """Keep the first characters and star out the rest."""
    text = _col(value)
    hidden = F.greatest(F.length(text) - F.lit(keep), F.lit(0))
    return F.concat(F.left(text, F.lit(keep)), F.repeat(F.lit("*"), hidden))


def sample_rank(key: ColumnLike, seed: int = 42) -> Column:
    """Pseudo-random number between 0 and 2**32 that depends on key and seed only, so that every
    engine and every run picks the same rows."""
    digest = F.md5(F.concat(_col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint")


def in_sample(key: ColumnLike, fraction: float, seed: int = 42) -> Column:
    """Reproducible row sample."""
    return F.pmod(sample_rank(key, seed), F.lit(10_000)) < F.lit(int(fraction * 10_000))


def bucket_case(value: ColumnLike, cuts: list[tuple[float, str]], default: str, below: bool = False) -> Column:
    """First label whose cut is passed: ``value > cut`` (or ``value < cut`` with ``below``)."""
    value = _col(value)
    first, *rest = [((value < F.lit(c)) if below else (value > F.lit(c)), label) for c, label in cuts]
    chain = reduce(lambda acc, item: acc.when(item[0], F.lit(item[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default))
