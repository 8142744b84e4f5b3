"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Every text becomes a vector of transformed statistics. Per (lang, source) group a
minimum-covariance-determinant estimate is fitted: a start from medians and median
absolute deviations, then concentration steps that re-estimate centre and scatter
from the ``support`` share of rows with the least Mahalanobis distance. Rows whose
distance to the final estimate passes a chi-squared cut-off are rejected.

All of it is DataFrame expressions. Order statistics (medians, the distance that
bounds the support) come from counts per (group, bin): map-side combined, the same
on every run, and a group that holds a third of all rows costs no task more than
its bins. Estimates stay a table (one row per group) and never reach the driver.

Defined results: a null text has no words, so the limits reject it. A null lang or
source is a group of its own. Groups under ``min_rows`` rows use the estimate of all
groups under ``min_rows`` of the language, and those that are still too few that of
the pooled rest, however few its rows: every row that passes the limits is judged by
an estimate. Repeated rows count each. Scatter has a floor per statistic, so ties (all
rows alike) and few rows give a regular matrix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, keep_columns, materialize, word_array

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

DIMS = ("x_word", "x_symbol", "x_repeat", "x_lines", "x_upper")
# Least scatter of each statistic: smaller differences are no evidence.
FLOOR = {"x_word": 0.08, "x_symbol": 0.03, "x_repeat": 0.12, "x_lines": 0.15, "x_upper": 0.05}
# From this many rows on three quarters of a group are a support of (n + p + 1) / 2 rows or more.
MIN_ROWS = 2 * (len(DIMS) + 1)
START_BINS = 1024  # per unit of a statistic, for medians
DIST_BINS = 16  # per power of two of a squared distance


def _get(a: Column, i: Column) -> Column:
    return F.get(a, i)


def _repeat_words(win: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes."""
    pairs = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(p: Column) -> Column:
        same = lambda x, i, j: F.coalesce(_get(p, j)["h"] == x["h"], F.lit(False))
        dup = F.filter(p, lambda x, i: same(x, i, F.when(i > 0, i - 1)) | same(x, i, i + 1))
        return F.array_sort(F.transform(dup, lambda x: x["i"]))

    def covered(pos: Column) -> Column:
        return F.aggregate(
            F.transform(pos, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(_get(pos, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x)

    # One-element arrays bind the intermediate results, so each is computed once.
    return F.element_at(F.transform(F.transform(F.array(pairs), positions), covered), 1)


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table's columns with one struct more, ``__qr`` (n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper), from whole texts."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__qr_hash", F.transform(word_array(F.col(text_col)), lambda w: F.xxhash64(w)))
    h = F.col("__qr_hash")
    df = df.withColumn("__qr_win", F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[_get(h, i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("__qr_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    win, lines = F.col("__qr_win"), F.col("__qr_lines")
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    stats = F.struct(
        long(F.size(h)).alias("n_words"),
        long(F.length(F.regexp_replace(t, f"[{SPACE}]+", ""))).alias("word_chars"),
        long(F.regexp_count(t, F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        long(F.when(F.size(F.array_distinct(win)) < F.size(win), _repeat_words(win))).alias("n_repeat_words"),
        long(F.size(lines)).alias("n_lines"),
        long(F.regexp_count(t, F.lit(r"\p{Lu}"))).alias("n_upper"))
    # One row to one row: the generator keeps the optimizer from copying these
    # expressions into every later use of a field.
    rest = [F.col(f"`{c}`") for c in docs.columns]
    return df.select(*rest, F.explode(F.array(stats)).alias("__qr"))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def statistic_vector(s: Column) -> dict[str, Column]:
    """Transformed statistics: a log mean word length and angles of shares. Counts
    added to the denominators damp the noise of short texts."""
    angle = lambda part, whole, prior: F.asin(F.sqrt(F.least(F.lit(1.0), part / (whole + prior))))
    return {
        "x_word": F.log((s["word_chars"] + 20 * 5.5) / (s["n_words"] + 20)),
        "x_symbol": angle(s["n_symbols"], s["word_chars"], 200),
        "x_repeat": angle(s["n_repeat_words"], s["n_words"], 20),
        "x_lines": angle(s["n_dup_lines"], s["n_lines"], 5),
        "x_upper": angle(s["n_upper"], s["word_chars"], 200),
    }


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function, by the series of the incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 1000):
        term *= z / (a + n)
        total += term
        if term < total * 1e-15:
            break
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _bin_quantile(df: DataFrame, keys: list[str], bin_col: str, share: float, out: str, weight: str = "1") -> DataFrame:
    """Per key the least bin that ``share`` of the rows reach, from counts per bin; a
    row of ``df`` stands for ``weight`` rows."""
    counts = df.groupBy(*keys, bin_col).agg(F.expr(f"sum({weight}) AS __n"))
    # At most a few thousand bins a key by construction of the bins.
    rows = counts.groupBy(*keys).agg(F.expr(f"array_sort(collect_list(struct({bin_col} AS b, __n AS n))) AS __b"), F.expr("sum(__n) AS __all"))
    return rows.select(*keys, F.expr(f"""
        aggregate(__b, struct(0L AS seen, cast(null AS bigint) AS bin),
                  (a, x) -> struct(a.seen + x.n AS seen, coalesce(a.bin, if(a.seen + x.n >= {share!r}D * __all, x.b, null)) AS bin)).bin""").alias(out))


def _start(rows: DataFrame) -> DataFrame:
    """Centre and diagonal scatter per group from medians and median deviations. Only
    counts per (group, statistic, bin) meet the medians, never the rows."""
    p = len(DIMS)
    stats = ", ".join(f"struct({i} AS d, cast(floor({x} * {START_BINS}) AS bigint) AS b)" for i, x in enumerate(DIMS))
    bins = rows.select("__g", F.expr(f"inline(array({stats}))")).groupBy("__g", "d", "b").agg(F.count("*").alias("n"))
    bins = materialize(bins, "mcd-bins")
    med = _bin_quantile(bins, ["__g", "d"], "b", 0.5, "m", "n")
    dev = bins.join(med, ["__g", "d"]).withColumn("b", F.expr("abs(b - m)"))
    mad = _bin_quantile(dev, ["__g", "d"], "b", 0.5, "s", "n")
    pick = lambda c, i: f"max(if(d = {i}, {c}, null))"
    start = med.join(mad, ["__g", "d"]).groupBy("__g").agg(*[F.expr(x) for i in range(p) for x in (
        f"{pick(f'(m + 0.5D) / {START_BINS}', i)} AS c{i}",
        f"pow(1.4826D * {pick('s', i)} / {START_BINS}, 2) + {FLOOR[DIMS[i]] ** 2!r}D AS s{i}{i}")])
    return start.select("*", *[F.lit(0.0).alias(f"s{i}{j}") for i in range(p) for j in range(i)])


def _triangle(model: DataFrame) -> DataFrame:
    """Centre c{i} and the inverse w{i}{j} of the Cholesky triangle of the scatter
    s{i}{j}; the floor keeps the scatter regular."""
    p = len(DIMS)
    cols = ["__g", *[f"c{i}" for i in range(p)]]
    minus = lambda terms: "".join(f" - {a} * {b}" for a, b in terms)
    for j in range(p):
        cols.append(f"sqrt(greatest(s{j}{j}{minus((f'l{j}{k}', f'l{j}{k}') for k in range(j))}, 1e-12)) AS l{j}{j}")
        cols += [f"(s{i}{j}{minus((f'l{i}{k}', f'l{j}{k}') for k in range(j))}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, p)]
    for j in range(p):  # inverse of the triangle, column by column
        cols.append(f"1 / l{j}{j} AS w{j}{j}")
        cols += [f"-({' + '.join(f'l{i}{k} * w{k}{j}' for k in range(j, i))}) / l{i}{i} AS w{i}{j}" for i in range(j + 1, p)]
    return model.selectExpr(*cols).select("__g", *[f"c{i}" for i in range(p)], *[f"w{i}{j}" for i in range(p) for j in range(i + 1)])


def _with_distance(rows: DataFrame, model: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with ``__d2``, the squared Mahalanobis distance (null where the group has
    no estimate)."""
    p = len(DIMS)
    z = [" + ".join(f"w{i}{k} * ({DIMS[k]} - c{k})" for k in range(i + 1)) for i in range(p)]
    return rows.join(model, "__g", how).select(
        *rows.columns, F.expr(" + ".join(f"pow({x}, 2)" for x in z)).alias("__d2"))


def fit_mcd(rows: DataFrame, support: float = 0.75, steps: int = 4) -> DataFrame:
    """Estimates per group ``__g`` of the rows' statistics: centre c{i}, inverse triangle w{i}{j}."""
    p = len(DIMS)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    consistency = support / chi2_cdf(chi2_quantile(support, p), p + 2)
    model = materialize(_triangle(_start(rows)), "mcd-start")
    sums = [F.expr(x) for x in ("count(*) AS n", *[f"sum({x}) AS a{i}" for i, x in enumerate(DIMS)],
                                *[f"sum({DIMS[i]} * {DIMS[j]}) AS q{i}{j}" for i, j in pairs])]
    estimate = ["__g", *[f"a{i} / n AS c{i}" for i in range(p)],
                *[f"{consistency!r}D * (q{i}{j} / n - (a{i} / n) * (a{j} / n)) + {FLOOR[DIMS[i]] ** 2 if i == j else 0.0!r}D AS s{i}{j}" for i, j in pairs]]
    for _ in range(steps):
        near = _with_distance(rows, model).withColumn("__bin", F.expr(f"cast(floor({DIST_BINS} * log2(__d2 + pow(2, -20))) AS bigint)"))
        limit = _bin_quantile(near, ["__g"], "__bin", support, "__limit")
        half = near.join(limit, "__g").filter("__bin <= __limit")
        model = materialize(_triangle(half.groupBy("__g").agg(*sums).selectExpr(*estimate)), "mcd-step")
    return model


def _group_names(rows: DataFrame, min_rows: int) -> DataFrame:
    """(lang, source) -> group name ``__g``: own, the language's rest or the pooled rest."""
    sizes = rows.groupBy("__lang", "__source").agg(F.count("*").alias("n"))
    named = sizes.withColumn("own", F.col("n") >= min_rows)
    by_lang = named.filter(~F.col("own")).groupBy(F.col("__lang").alias("__small")).agg(F.sum("n").alias("ln"))
    named = named.join(by_lang, F.col("__lang").eqNullSafe(F.col("__small")), "left").drop("__small")
    named = named.withColumn("level", F.when(F.col("own"), 0).when(F.col("ln") >= min_rows, 1).otherwise(2))
    tag = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c))
    name = F.when(F.col("level") == 0, F.concat_ws("\x1f", F.lit("0"), tag(F.col("__lang")), tag(F.col("__source")))) \
        .when(F.col("level") == 1, F.concat_ws("\x1f", F.lit("1"), tag(F.col("__lang")))).otherwise(F.lit("2"))
    return named.select("__lang", "__source", name.alias("__g"))


def _joined(rows: DataFrame, names: DataFrame) -> DataFrame:
    n = names.withColumnRenamed("__lang", "__nl").withColumnRenamed("__source", "__ns")
    return rows.join(n, rows["__lang"].eqNullSafe(n["__nl"]) & rows["__source"].eqNullSafe(n["__ns"]), "left").drop("__nl", "__ns")


def _vectors(df: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    lang, source = keep_columns(df, lang_col, source_col)
    return df.withColumns({"__lang": lang.cast("string"), "__source": source.cast("string"),
                           "__failed": base_failed(F.col("__qr")), **statistic_vector(F.col("__qr"))})


def _verdict(rows: DataFrame, names: DataFrame, model: DataFrame, cutoff: float) -> DataFrame:
    d = _with_distance(_joined(rows, names), model, "left")
    return d.withColumn("__kept", ~F.col("__failed") & F.coalesce(F.col("__d2") <= cutoff, F.lit(True)))


def fit(stats: DataFrame, min_rows: int, support: float, steps: int) -> tuple[DataFrame, DataFrame]:
    """Group names and estimates, from the rows that pass the fixed limits."""
    rows = stats.filter(~F.col("__failed")).select("__lang", "__source", *DIMS)
    names = materialize(_group_names(rows, min_rows), "mcd-groups")
    return names, fit_mcd(_joined(rows, names).select("__g", *DIMS), support, steps)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", min_rows: int = MIN_ROWS, support: float = 0.75, steps: int = 4,
                     tail: float = 1e-7) -> DataFrame:
    """One row per input row: id, the base statistics, base_failed, distance2, kept."""
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                         *[c.alias(a) for c, a in zip(keep_columns(docs, lang_col, source_col), ("__l", "__s"))])
    stats = materialize(_vectors(text_statistics(narrow, "__text").drop("__text"), "__l", "__s").drop("__l", "__s"), "quality-stats")
    names, model = fit(stats, min_rows, support, steps)
    out = _verdict(stats, names, model, chi2_quantile(1 - tail, len(DIMS)))
    return out.select(F.col("__id").alias(id_col), *[F.col(f"__qr.{n}").alias(n) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__d2").alias("distance2"))


def reject_outliers(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                    min_rows: int = MIN_ROWS, support: float = 0.75, steps: int = 4, tail: float = 1e-7) -> DataFrame:
    """The rows that the rules keep, with the table's own columns. Statistics are
    computed twice (fit, verdict) so that no text is shuffled or written."""
    cols = docs.columns
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), F.col(text_col).alias("__text"),
                       *[c.alias(a) for c, a in zip(keep_columns(docs, lang_col, source_col), ("__l", "__s"))])
    stats = _vectors(text_statistics(wide, "__text").drop("__text"), "__l", "__s")
    fitted = materialize(stats.select("__failed", "__lang", "__source", *DIMS), "quality-stats")
    names, model = fit(fitted, min_rows, support, steps)
    kept = _verdict(stats, names, model, chi2_quantile(1 - tail, len(DIMS))).filter("__kept")
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in cols])
