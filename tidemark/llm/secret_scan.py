"""Secret scan: patterns, and a battery of randomness tests on opaque tokens.

Patterns find assignments, access keys and hex strings. Every other run of 20 or
more characters of the usual encodings is a candidate. Its encoding is inferred
(digits, hex, base 32, letters, joined words, alphanumeric, base 64) and gives an alphabet;
characters become numbers of that alphabet and meet three tests:

* chi-squared uniformity over the alphabet. Its sum of squared counts is also the
  number of coincidences, and the p-value is the chance of so few coincidences in
  text that is not random (coincidence rate at least ``TEXT_RATE``, or twice the
  uniform one);
* runs above and below the middle of the alphabet, and
* lag-one serial correlation: both must not reject randomness, else p is 1.

Power depends on length, so false discoveries are controlled within strata of
encoding and length class (Benjamini and Hochberg, level ``fdr``). Counts of
p-values per stratum and bin, over all texts, decide; that table has a bounded
number of rows whatever the input. The texts are read twice: for the counts,
and for the findings.

Everything on rows is DataFrame expressions; nothing is shuffled but the counts.

Defined results: a null or empty text has no findings. Spans are code points, end
exclusive. Ties go by start, then kind in the order of ``KINDS``. Repeated rows
give equal findings, and each counts in its stratum. An empty table finds nothing.
Very long texts, and texts of very many findings, are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns and least lengths of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters or more; a shorter run holds no longer match
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
KINDS = ("assign", "access", "hex", "random")

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"
# Encoding, pattern of its tokens, alphabet. The first that matches counts.
ENCODINGS = (
    ("digits", r"^[0-9]+$", DIGITS),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", r"^(?=.*[2-7])[A-Z2-7]+$", UPPER + "234567"),
    ("letters", r"^([A-Z]?[a-z]+|[A-Z]+)$", LOWER),
    ("words", r"^[A-Z]?[a-z]+([-_/+][A-Z]?[a-z]+)+$", LOWER + "-_/+"),
    ("alnum", r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64url", r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("base64", r"^.*$", UPPER + LOWER + DIGITS + "+/"),
)
TEXT_RATE = 0.060  # chance that two letters of text are equal, on the low side
TEXT_SPREAD = 0.0014  # sum of cubed letter shares less the squared rate
VETO = 3.3  # standard deviations
LAST_BIN = 150


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _held(df: DataFrame, **cols: Column) -> DataFrame:
    """The table with columns that are computed once a row: the optimizer does not move
    an expression past a generator, so what follows never computes it per element."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


BLOCK = 256  # matches per block: appending copies a block or the list of blocks, not all matches


def _matches(t: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, token)."""
    none = F.array().cast("array<struct<s:int,e:int,w:string>>")

    def place(x: Column) -> Column:
        m, gaps, n = x["m"], x["g"], F.size(x["m"])
        at = lambda a, i: a["at"] + F.length(F.get(gaps, i))
        step = lambda a, i: F.struct(
            (at(a, i) + F.length(F.get(m, i))).alias("at"),
            F.array_append(a["out"], F.struct(at(a, i).alias("s"), (at(a, i) + F.length(F.get(m, i))).alias("e"), F.get(m, i).alias("w"))).alias("out"))
        block = lambda a, b: F.aggregate(F.sequence(b * BLOCK, F.least(n, (b + 1) * BLOCK) - 1), F.struct(a["at"].alias("at"), none.alias("out")), step)
        join = lambda a, b: _bind(block(a, b), lambda r: F.struct(r["at"].alias("at"), F.array_append(a["out"], r["out"]).alias("out")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<s:int,e:int,w:string>>>").alias("out"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), start, join)["out"])

    found = F.struct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"), F.split(t, pattern, -1).alias("g"))
    return F.when(t.rlike(pattern), _bind(found, place)).otherwise(none)


def _touched(spans: Column, x: Column) -> Column:
    """Whether one of the disjoint, sorted ``spans`` overlaps x: a binary search for the
    first that ends behind x's start."""
    half = lambda a: F.floor((a["lo"] + a["hi"]) / 2).cast("int")
    step = lambda a, _: F.when(a["lo"] >= a["hi"], a).when(
        F.get(spans, half(a))["e"] <= x["s"], F.struct((half(a) + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), half(a).alias("hi")))
    n = F.size(spans)
    steps = F.sequence(F.lit(0), F.ceil(F.log2((n + 1).cast("double"))).cast("int"))
    first = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step)["lo"]
    return (n > 0) & F.coalesce(F.get(spans, first)["s"] < x["e"], F.lit(False))


def _lower_tail(z: Column) -> Column:
    """Normal distribution function, by a rational approximation of its tail."""
    x = F.abs(z)
    u = 1 / (1 + 0.2316419 * x)
    poly = u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))
    tail = F.greatest(F.exp(-x * x / 2) / 2.5066282746310002 * poly, F.lit(1e-15))
    return F.when(z < 0, tail).otherwise(1 - tail)


def _pick(enc: Column, values: list) -> Column:
    out = F.lit(values[-1])
    for i in range(len(ENCODINGS) - 2, -1, -1):
        out = F.when(enc == i, F.lit(values[i])).otherwise(out)
    return out


def battery(token: Column) -> Column:
    """Struct (stratum, bin) of a token: its encoding and length class, and the bin of
    its p-value (tenths of -log10, rounded down)."""
    body = F.rtrim(token, F.lit("="))
    enc = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        enc = F.when(body.rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(enc)

    def numbers(x: Column) -> Column:
        word = F.when(x["enc"].isin(1, 3, 4), F.lower(x["body"])).otherwise(x["body"])
        alphabet = _pick(x["enc"], [a for _, _, a in ENCODINGS])
        return F.struct(x["enc"].alias("enc"), _pick(x["enc"], [len(a) for _, _, a in ENCODINGS]).cast("double").alias("m"),
                        F.transform(F.split(word, ""), lambda c: F.instr(alphabet, c) - 1).alias("v"))

    def sums(x: Column) -> Column:
        v, m = x["v"], x["m"]
        n = F.size(v).cast("double")
        squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda a, d: a + F.pow(F.size(F.filter(v, lambda y: y == d)).cast("double"), F.lit(2.0)))
        mean = F.aggregate(v, F.lit(0.0), lambda a, y: a + y) / n
        high = F.aggregate(v, F.lit(0.0), lambda a, y: a + F.when(y >= m / 2, 1.0).otherwise(0.0))
        pairs = F.arrays_zip(F.slice(v, F.lit(1), F.size(v) - 1).alias("a"), F.slice(v, F.lit(2), F.size(v) - 1).alias("b"))
        runs = F.aggregate(pairs, F.lit(1.0), lambda a, p: a + F.when((p["a"] >= m / 2) != (p["b"] >= m / 2), 1.0).otherwise(0.0))
        products = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + p["a"].cast("double") * p["b"])
        return F.struct(x["enc"].alias("enc"), m.alias("m"), n.alias("n"), squares.alias("sq"), mean.alias("mean"), high.alias("hi"),
                        runs.alias("runs"), products.alias("prod"), F.element_at(v, 1).alias("v1"), F.element_at(v, -1).alias("vn"),
                        F.aggregate(v, F.lit(0.0), lambda a, y: a + y.cast("double") * y).alias("vv"))

    def verdict(x: Column) -> Column:
        n, m = x["n"], x["m"]
        chi2 = m / n * x["sq"] - n
        rate = F.greatest(F.lit(TEXT_RATE), 2 / m)
        couples = n * (n - 1) / 2
        spread = F.sqrt(couples * rate * (1 - rate) + n * (n - 1) * (n - 2) * TEXT_SPREAD)
        p_chi = _lower_tail(((x["sq"] - n) / 2 - couples * rate) / spread)
        expect = 2 * x["hi"] * (n - x["hi"]) / n + 1
        var = (expect - 1) * (expect - 2) / (n - 1)
        z_runs = F.when(var > 0, F.abs(x["runs"] - expect) / F.sqrt(var)).otherwise(F.lit(99.0))
        dev = x["vv"] - n * x["mean"] * x["mean"]
        cov = x["prod"] - x["mean"] * (2 * n * x["mean"] - x["v1"] - x["vn"]) + (n - 1) * x["mean"] * x["mean"]
        z_serial = F.when(dev > 0, F.abs(cov / dev) * F.sqrt(n)).otherwise(F.lit(99.0))
        uneven = chi2 > (m - 1) + VETO * F.sqrt(2 * (m - 1))
        p = F.when(uneven | (z_runs > VETO) | (z_serial > VETO), F.lit(1.0)).otherwise(p_chi)
        size_class = F.least(F.lit(12), F.floor(F.log2(n)).cast("int"))
        return F.struct((x["enc"] * 100 + size_class).cast("int").alias("stratum"),
                        F.least(F.lit(LAST_BIN), F.greatest(F.lit(0), F.floor(-10 * F.log10(p)).cast("int"))).alias("bin"))

    return _bind(_bind(_bind(F.struct(enc.alias("enc"), body.alias("body")), numbers), sums), verdict)


def _scan(docs: DataFrame, text_col: str) -> DataFrame:
    """The table with ``__base`` (sorted base spans) and ``__opaque`` (candidates that
    touch no base span, with stratum and bin). Time linear in a text's spans but for
    sorting them."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    df = _held(docs, __all=_matches(t, ASSIGN), __access=_matches(t, ACCESS), __hex=_matches(t, HEX), __run=_matches(t, OPAQUE))
    # Group 2 is what follows the separator and an opening quote.
    value = lambda w: F.regexp_extract(w, ASSIGN, 2)
    df = _held(df, __assign=F.filter("__all", lambda x: F.length(value(x["w"])) >= ASSIGN_LEAST))
    span = lambda k: lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"))
    # Characters of hex strings and access keys are a run's characters: spans that touch a run lie in it.
    free = F.filter("__run", lambda x: ~x["w"].rlike(HEX) & ~x["w"].rlike(ACCESS) & ~_touched(F.col("__assign"), x))
    df = _held(df, __base=F.array_sort(F.concat(*[F.transform(f"__{n}", span(k)) for k, n in enumerate(KINDS[:3])])),
               __opaque=F.transform(free, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), battery(x["w"]).alias("t"))))
    return df.drop("__all", "__assign", "__access", "__hex", "__run")


def discovery_bins(docs: DataFrame, text_col: str = "text", fdr: float = 0.05) -> dict[int, int]:
    """Per stratum the least bin that counts as a discovery, over all texts."""
    seen = _scan(docs.select(F.col(text_col).alias("__text")), "__text").select(F.explode("__opaque.t").alias("t"))
    counts: dict[int, dict[int, int]] = {}
    for stratum, b, n in seen.groupBy("t.stratum", "t.bin").count().collect():  # strata x bins: bounded
        counts.setdefault(stratum, {})[b] = n
    out = {}
    for stratum, bins in counts.items():
        total, above = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b / 10) * total <= fdr * above:
                out[stratum] = b
    return out


def with_findings(docs: DataFrame, text_col: str = "text", fdr: float = 0.05) -> DataFrame:
    """The table with ``__base`` and ``__found``: all spans (start, kind's number, end),
    sorted; the base spans are among them."""
    least = discovery_bins(docs, text_col, fdr)
    df = _scan(docs, text_col)
    if least:
        table = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv])
        hit = F.filter("__opaque", lambda x: F.coalesce(x["t"]["bin"] >= table[x["t"]["stratum"]], F.lit(False)))
    else:
        hit = F.filter("__opaque", lambda x: F.lit(False))
    extra = F.transform(hit, lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("k"), x["e"].alias("e")))
    return _held(df, __found=F.array_sort(F.concat("__base", extra))).drop("__opaque")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat(F.get(names, x["k"]), F.lit(":"), x["s"], F.lit(":"), x["e"])), ",")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.05) -> DataFrame:
    """One row per row: id, counts per base kind, base_sha256, spans."""
    df = with_findings(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text", fdr)
    n = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("long")
    return df.select(F.col("__id").alias(id_col), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                     F.sha2(spans_text(F.col("__base")), 256).alias("base_sha256"), spans_text(F.col("__found")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = 0.05) -> DataFrame:
    """The table with every found span replaced by a mark; overlapping spans by one."""
    cols = docs.columns
    df = with_findings(docs, text_col, fdr)
    t = F.col(text_col)

    def step(a: Column, x: Column) -> Column:
        fresh = x["s"] >= a["at"]
        out = F.when(fresh, F.concat(a["out"], F.substring(t, a["at"] + 1, x["s"] - a["at"]), F.lit(mark))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), out.alias("out"))

    cut = _bind(F.aggregate("__found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step),
                lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))))
    return df.withColumn(text_col, F.when(F.size("__found") > 0, cut).otherwise(t)).select(*[F.col(f"`{c}`") for c in cols])
