"""Small scalar rules: scores, formats, ids and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nine even stops of the yellow-orange-red colour map.
COLOUR_STOPS = ["#ffffcc", "#ffeda0", "#fed976", "#feb24c", "#fd8d3c", "#fc4e2a", "#e31a1c", "#bd0026", "#800026"]


def colour_scale() -> list[tuple[float, str]]:
    return [(k / (len(COLOUR_STOPS) - 1), c) for k, c in enumerate(COLOUR_STOPS)]


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null where den is 0 (undefined ratios are null in tables, NaN only in JSON)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def chi_square(a: Column, b: Column, c: Column, d: Column) -> Column:
    """N (AD - CB)^2 / ((A+C)(B+D)(A+B)(C+D)) in doubles, 0 where undefined."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    den = (a + c) * (b + d) * (a + b) * (c + d)
    return F.when(den == 0, F.lit(0.0)).otherwise((a + b + c + d) * (a * d - c * b) ** 2 / den)


def pw_score(p: Column, reliability: float, witnesses: Column) -> Column:
    """min(p, (1 - r) ^ witnesses)."""
    return F.least(p.cast("double"), F.pow(F.lit(1.0 - reliability), witnesses))


def at_least(score: Column, threshold: float | Column) -> Column:
    return (score >= threshold).cast("byte")


def at_most(score: Column, cutoff: float | Column) -> Column:
    return (score <= cutoff).cast("byte")


def ci_text(lo: Column, hi: Column) -> Column:
    return F.format_string("[%.3f, %.3f]", lo, hi)


def p_text(p: Column) -> Column:
    return F.format_string("%.3f", p)


def lenient_double(s: Column) -> Column:
    """The number a text such as "0.948 [0.9, 1.0]" starts with, else null."""
    return F.regexp_extract(s, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1).try_cast("double")


def strip_prefix(block_id: Column, prefix: str) -> Column:
    return F.regexp_replace(block_id, f"^{prefix}", "")


def path_part(path: Column, from_end: int = 1) -> Column:
    """The last part of a path, or the from_end-th from its end."""
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -from_end)


def content_key(path: Column, size: Column, modified: Column) -> Column:
    return F.sha1(F.concat_ws("|", path, size.cast("string"), modified.cast("string")))


def with_db_suffix(block_id: Column, title: Column, db: Column) -> tuple[Column, Column]:
    return F.concat(block_id, F.lit("_"), db), F.concat(title, F.lit(" ("), db, F.lit(")"))


def models_per_balance(models: int, balance_methods: int | Column) -> int | Column:
    """Settings for each balance method, rounded up."""
    if isinstance(balance_methods, Column):
        return F.ceil(F.lit(models) / F.greatest(F.lit(1), balance_methods)).cast("int")
    return -(-models // max(1, balance_methods))
