"""Vietnamese number words as a Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound

# fixed values: the language's digit and group names
DIGITS = ["không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín"]
GROUPS = ["", "nghìn", "triệu", "tỷ", "nghìn tỷ", "triệu tỷ", "tỷ tỷ"]


def _name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in DIGITS]), d.cast("int") + 1)


def _three(n: Column, full: Column) -> Column:
    """A group of three digits; `full` keeps its hundreds though they are zero."""
    h, t, u = F.floor(n / 100).cast("int"), F.floor(n % 100 / 10).cast("int"), (n % 10).cast("int")
    hundred = F.when((h > 0) | full, F.concat(_name(h), F.lit(" trăm")))
    tens = F.when(t == 0, F.when((u > 0) & hundred.isNotNull(), F.lit("lẻ"))).when(t == 1, F.lit("mười")).otherwise(F.concat(_name(t), F.lit(" mươi")))
    unit = F.when(u == 0, None).when((u == 1) & (t > 1), F.lit("mốt")).when((u == 4) & (t > 1), F.lit("tư")).when((u == 5) & (t > 0), F.lit("lăm")).otherwise(_name(u))
    return F.concat_ws(" ", hundred, tens, unit)


def spoken(number: Column) -> Column:
    return bound(number.cast("long"), _spoken)


def _spoken(number: Column) -> Column:
    n = F.abs(number)
    text = n.cast("string")
    groups = F.ceil(F.char_length(text) / 3).cast("int")

    def part(x: Column, k: Column) -> Column:
        v = F.substr(x["t"], k * 3 + 1, F.lit(3)).cast("int")
        unit = F.element_at(F.array(*[F.lit(g) for g in GROUPS]), x["g"] - k)
        return bound(v, lambda v: F.when(v > 0, F.concat_ws(" ", _three(v, k > 0), F.nullif(unit, F.lit("")))))

    padded = F.struct(F.lpad(text, groups * 3, F.lit("0")).alias("t"), groups.alias("g"))
    said = bound(padded, lambda x: F.array_join(F.filter(F.transform(F.sequence(F.lit(0), x["g"] - 1), lambda k: part(x, k)), lambda w: w.isNotNull()), ", "))
    return F.when(n == 0, F.lit(DIGITS[0])).otherwise(F.concat(F.when(number < 0, F.lit("âm ")).otherwise(F.lit("")), said))
