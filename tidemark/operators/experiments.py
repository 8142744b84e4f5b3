"""Experiment assignment, exposure and read-out, computed from event data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import CONVERSION_URL, EXPOSURE_URL


def hash_bucket(experiment: str, unit: str | Column, buckets: int = 100) -> Column:
    """Deterministic bucket of a unit: first 32 bits of md5('<experiment>:<unit>')
    modulo ``buckets``. Stable across processes and engines (unlike a salted
    language hash)."""
    u = F.col(unit) if isinstance(unit, str) else unit
    h = F.md5(F.concat(F.lit(experiment + ":"), u.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % buckets).cast("int")


def variant_of(bucket: Column, weights: Sequence[tuple[str, int]]) -> Column:
    """Variant by cumulative weights over buckets 0..sum(weights)-1."""
    expr, hi = None, 0
    for name, w in weights:
        hi += w
        expr = F.when(bucket < hi, name) if expr is None else expr.when(bucket < hi, name)
    return expr


def assign(units: DataFrame, experiment: str, weights: Sequence[tuple[str, int]] = (("control", 50), ("treatment", 50)),
           unit: str = "user_id") -> DataFrame:
    """Variant per unit (a pure projection: assignment needs no shuffle)."""
    b = hash_bucket(experiment, unit, sum(w for _, w in weights))
    return units.select(unit, F.lit(experiment).alias("experiment"), b.alias("bucket"),
                        variant_of(b, weights).alias("variant"))


def exposures_and_outcomes(events: DataFrame, experiment: str,
                           weights: Sequence[tuple[str, int]] = (("control", 50), ("treatment", 50)),
                           exposure_url: str = EXPOSURE_URL, conversion_url: str = CONVERSION_URL,
                           unit: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """One row per exposed unit: first exposure time, variant, and whether a
    conversion event followed the first exposure. One aggregation per unit."""
    e = events.where(F.col(unit).isNotNull())
    per = e.groupBy(unit).agg(
        F.min(F.when(F.col("url") == exposure_url, F.col(time_col))).alias("exposure_time"),
        F.max(F.when(F.col("url") == conversion_url, F.col(time_col))).alias("__last_conv"))
    per = per.where(F.col("exposure_time").isNotNull())
    b = hash_bucket(experiment, unit, sum(w for _, w in weights))
    return per.select(unit, F.lit(experiment).alias("experiment"), variant_of(b, weights).alias("variant"),
                      "exposure_time",
                      F.coalesce(F.col("__last_conv") > F.col("exposure_time"), F.lit(False)).alias("converted"))


def readout(outcomes: DataFrame, control: str = "control") -> DataFrame:
    """Per variant: users, conversions, rate; against control: lift and the pooled
    two-proportion z statistic. Grouped sums only; the control row is joined back
    on the experiment key (one row per experiment)."""
    per = outcomes.groupBy("experiment", "variant").agg(
        F.count(F.lit(1)).alias("users"), F.sum(F.col("converted").cast("long")).alias("conversions"))
    per = per.withColumn("conversion_rate", F.col("conversions") / F.col("users"))
    # control figures attached with a window over the per-variant rows (a few
    # rows per experiment): no join, so no nested loop on the constant key
    by_exp = Window.partitionBy("experiment")
    is_c = F.col("variant") == control
    j = per.select("*",
                   F.max(F.when(is_c, F.col("users"))).over(by_exp).alias("__n0"),
                   F.max(F.when(is_c, F.col("conversions"))).over(by_exp).alias("__x0"),
                   F.max(F.when(is_c, F.col("conversion_rate"))).over(by_exp).alias("__p0"))
    pooled = (F.col("conversions") + F.col("__x0")) / (F.col("users") + F.col("__n0"))
    se = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / F.col("users") + F.lit(1.0) / F.col("__n0")))
    return j.select("experiment", "variant", "users", "conversions", "conversion_rate",
                    F.when(~is_c, F.col("conversion_rate") / F.col("__p0") - 1).alias("lift"),
                    F.when(~is_c, F.try_divide(F.col("conversion_rate") - F.col("__p0"), se)).alias("z_score"))


def sample_ratio_check(outcomes: DataFrame, weights: Sequence[tuple[str, int]]) -> DataFrame:
    """Chi-square of observed vs expected units per variant (sample ratio
    mismatch), one row per experiment."""
    total_w = sum(w for _, w in weights)
    per = outcomes.groupBy("experiment").agg(*[
        F.count(F.when(F.col("variant") == n, 1)).alias(f"users_{n}") for n, _ in weights])
    tot = sum((F.col(f"users_{n}") for n, _ in weights), F.lit(0))
    exp = {n: tot * (w / total_w) for n, w in weights}
    chi = sum((F.pow(F.col(f"users_{n}") - exp[n], 2) / exp[n] for n, _ in weights), F.lit(0.0))
    return per.select("experiment", *[f"users_{n}" for n, _ in weights],
                      *[exp[n].alias(f"expected_{n}") for n, _ in weights], chi.alias("chi_square"))


def welch_readout(events: DataFrame, outcomes: DataFrame, control: str = "control",
                  unit: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Lagging metric per exposed unit (events after first exposure), its mean
    and sample variance per variant, and Welch's t against control. Grouped
    moments only; control moments attached with a window over variant rows."""
    e = events.where(F.col(unit).isNotNull()).select(unit, time_col)
    o = outcomes.select(unit, "experiment", "variant", "exposure_time")
    per_unit = (o.join(e, unit, "left")
                .groupBy(unit, "experiment", "variant")
                .agg(F.count(F.when(F.col(time_col) > F.col("exposure_time"), 1)).alias("metric")))
    per = per_unit.groupBy("experiment", "variant").agg(
        F.count(F.lit(1)).alias("users"), F.round(F.avg("metric"), 9).alias("mean_events"),
        F.round(F.var_samp("metric"), 9).alias("var_events"))
    by_exp = Window.partitionBy("experiment")
    is_c = F.col("variant") == control
    n0 = F.max(F.when(is_c, F.col("users"))).over(by_exp)
    m0 = F.max(F.when(is_c, F.col("mean_events"))).over(by_exp)
    v0 = F.max(F.when(is_c, F.col("var_events"))).over(by_exp)
    se = F.sqrt(F.col("var_events") / F.col("users") + v0 / n0)
    return per.select("experiment", "variant", "users", "mean_events", "var_events",
                      F.round(F.when(~is_c, F.try_divide(F.col("mean_events") - m0, se)), 9).alias("welch_t"))


def unit_metrics(events: DataFrame, outcomes: DataFrame, unit: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Per exposed unit: ``metric`` (events after the first exposure) and ``before``
    (events before it), from one aggregation."""
    e = events.where(F.col(unit).isNotNull()).select(unit, time_col)
    o = outcomes.select(unit, "experiment", "variant", "exposure_time")
    return (o.join(e, unit, "left").groupBy(unit, "experiment", "variant")
            .agg(F.count_if(F.col(time_col) > F.col("exposure_time")).alias("metric"),
                 F.count_if(F.col(time_col) < F.col("exposure_time")).alias("before")))


def adjusted_readout(units: DataFrame, control: str = "control") -> DataFrame:
    """Means of ``metric`` adjusted by the covariate ``before``: theta = cov / var over all
    units of the experiment, adjusted = mean - theta (mean before - overall mean before).
    ``variance_kept`` is 1 - correlation squared, the share of the variance left.
    Moments per variant are summed once; the experiment's follow from them."""
    x, y = F.col("before").cast("double"), F.col("metric").cast("double")
    per = units.groupBy("experiment", "variant").agg(
        F.count(F.lit(1)).alias("users"), F.sum(x).alias("__x"), F.sum(y).alias("__y"),
        F.sum(x * x).alias("__xx"), F.sum(x * y).alias("__xy"), F.sum(y * y).alias("__yy"))
    whole = Window.partitionBy("experiment")
    for c in ("users", "__x", "__y", "__xx", "__xy", "__yy"):
        per = per.withColumn(f"__all{c}", F.sum(c).over(whole))
    n, sx, sy = F.col("__allusers"), F.col("__all__x"), F.col("__all__y")
    var_x, cov, var_y = F.col("__all__xx") - sx * sx / n, F.col("__all__xy") - sx * sy / n, F.col("__all__yy") - sy * sy / n
    theta = F.coalesce(F.try_divide(cov, var_x), F.lit(0.0))
    adjusted = F.col("__y") / F.col("users") - theta * (F.col("__x") / F.col("users") - sx / n)
    out = per.select("experiment", "variant", "users", F.round(F.col("__y") / F.col("users"), 9).alias("mean"), F.round(theta, 9).alias("theta"),
                     F.round(adjusted, 9).alias("adjusted_mean"), F.round(1 - F.coalesce(F.try_divide(cov * cov, var_x * var_y), F.lit(0.0)), 9).alias("variance_kept"))
    base = F.max(F.when(F.col("variant") == control, F.col("adjusted_mean"))).over(whole)
    return out.withColumn("adjusted_lift", F.when(F.col("variant") != control, F.round(F.try_divide(F.col("adjusted_mean") - base, base), 9)))


# P(Poisson(1) <= k) times 2^32, rounded up, for k = 0..11 (from the series e^-1 / k!).
def _poisson_cuts() -> list[int]:
    import math
    total, cuts = 0.0, []
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        cuts.append(math.ceil(total * 4294967296))
    return cuts


def poisson_weight(unit: Column, replicate: Column, seed: str) -> Column:
    """A Poisson(1) draw of (unit, replicate) from 32 bits of md5: the same in any run."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), unit.cast("string"), replicate.cast("string"))), 1, 8), 16, 10).cast("long")
    return sum((F.when(h >= c, 1).otherwise(0) for c in _poisson_cuts()), F.lit(0))


def bootstrap_intervals(units: DataFrame, replicates: int = 200, level: float = 0.95, seed: str = "bootstrap",
                        control: str = "control", unit: str = "user_id", metric: str = "metric") -> DataFrame:
    """Percentile intervals of each variant's mean of ``metric``, and of its difference to
    control, by a Poisson bootstrap: each replicate weighs every unit by its own
    Poisson(1) draw, so all replicates are sums in one aggregation, summed per task,
    and no unit is ever sampled or moved. Replicates of weight 0 are left out."""
    lo, hi = (1 - level) / 2, (1 + level) / 2
    r = F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("__r")
    w = units.select("experiment", "variant", F.col(unit).alias("__u"), F.col(metric).cast("double").alias("__m"), r)
    w = w.withColumn("__w", poisson_weight(F.concat_ws(":", F.col("experiment"), F.col("__u").cast("string")), F.col("__r"), seed)).where("__w > 0")
    per = w.groupBy("experiment", "variant", "__r").agg((F.sum(F.col("__w") * F.col("__m")) / F.sum("__w")).alias("__mean"))
    base = F.max(F.when(F.col("variant") == control, F.col("__mean"))).over(Window.partitionBy("experiment", "__r"))
    per = per.withColumn("__diff", F.when(F.col("variant") != control, F.col("__mean") - base))
    q = lambda c, p: F.round(F.percentile(c, F.lit(p)), 9)
    return per.groupBy("experiment", "variant").agg(
        F.count(F.lit(1)).alias("replicates"), q("__mean", lo).alias("mean_low"), q("__mean", hi).alias("mean_high"),
        q("__diff", lo).alias("diff_low"), q("__diff", hi).alias("diff_high"))
