"""Column-expression helpers. All are built-in Catalyst expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import (ON_SITE_DOMAINS, ON_SITE_LABEL, QUALITY_CUTS, QUALITY_DEFAULT,
                        REFERRER_RULES, SCORING_CUTS, SCORING_DEFAULT)

__all__ = [
    "col_", "classify", "scoring_class", "quality_class", "map_referrer", "guarded_ratio",
    "day_of", "month_of", "append_if", "empty_array", "nvl_array", "last_elem",
    "first_elem", "bits_to_long", "bit_count_masked", "ntz_to_utc_ts", "json_object",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(c: str | Column, cuts: Sequence[tuple[float, str]], default: str) -> Column:
    """Threshold classing: the first cut the value is strictly above wins;
    NULL and everything else fall to ``default`` (SQL CASE semantics)."""
    c = col_(c)
    expr = None
    for cut, label in cuts:
        expr = F.when(c > cut, label) if expr is None else expr.when(c > cut, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def scoring_class(c: str | Column) -> Column:
    return classify(c, SCORING_CUTS, SCORING_DEFAULT)


def quality_class(c: str | Column) -> Column:
    return classify(c, QUALITY_CUTS, QUALITY_DEFAULT)


def map_referrer(c: str | Column, on_site_domains: Sequence[str] = ON_SITE_DOMAINS,
                 rules: Sequence[tuple[str, str]] = REFERRER_RULES) -> Column:
    """Ordered substring rules to a label; no match keeps the text, NULL stays NULL.
    Like the SQL LIKE '%x%' rules, 't.co' also matches e.g. 'reddit.com'."""
    c = col_(c)
    all_rules = list(rules) + [(d, ON_SITE_LABEL) for d in on_site_domains]
    expr = None
    for pat, label in all_rules:
        cond = c.contains(pat)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(c)


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, dividing by 1 where den is 0 (NULL stays NULL)."""
    den = col_(den)
    return col_(num) / F.when(den == 0, F.lit(1)).otherwise(den)


def day_of(ts: str | Column) -> Column:
    """Calendar day of a timestamp (works for NTZ and zoned; no session-zone shift for NTZ)."""
    return F.to_date(col_(ts))


def month_of(d: str | Column) -> Column:
    return F.trunc(col_(d), "month")


def empty_array(elem_type: T.DataType) -> Column:
    return F.array().cast(T.ArrayType(elem_type))


def nvl_array(a: str | Column, elem_type: T.DataType) -> Column:
    return F.coalesce(col_(a), empty_array(elem_type))


def append_if(a: str | Column, cond: Column, value: Column, elem_type: T.DataType) -> Column:
    """``coalesce(a, []) || (cond ? [value] : [])``."""
    return F.concat(nvl_array(a, elem_type),
                    F.when(cond, F.array(value)).otherwise(empty_array(elem_type)))


def last_elem(a: str | Column) -> Column:
    return F.element_at(col_(a), -1)


def first_elem(a: str | Column) -> Column:
    return F.get(col_(a), 0)


def bits_to_long(bits: str | Column) -> Column:
    return col_(bits).cast("long")


def bit_count_masked(x: str | Column, mask: int) -> Column:
    return F.bit_count(col_(x).bitwiseAND(F.lit(mask).cast("long")))


def ntz_to_utc_ts(c: str | Column) -> Column:
    """Read a wall-clock TIMESTAMP_NTZ as a UTC instant (TIMESTAMP), independent of
    the session time zone. Streaming watermarks need TIMESTAMP."""
    return F.to_timestamp(F.concat(F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z")),
                          "yyyy-MM-dd HH:mm:ss.SSSSSSX")


def json_object(pairs: Sequence[tuple[str, Column]]) -> Column:
    """JSON object text keeping NULL fields (like json_build_object)."""
    return F.to_json(F.struct(*[col_(v).alias(k) for k, v in pairs]),
                     {"ignoreNullFields": "false"})
