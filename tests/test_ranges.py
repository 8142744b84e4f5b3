"""Range joins over wide and nested ranges against brute force; cover sizes; plan shapes."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import narrowest_range, range_cover, range_join
from tidemark.plans import queries as Q
from tidemark.plans.explain import plan_text

from .conftest import SF_SMALL


def wide_ranges(r, n):
    out = []
    for i in range(n):
        width = 2 ** r.randint(0, 40)
        lo = r.choice([r.randint(-2 ** 20, 2 ** 20), r.randint(0, 2 ** 40), 0])
        out.append((lo, lo + r.choice([width - 1, width, r.randint(0, width)]), f"r{i}"))
    return out


def points_near(r, ranges, n):
    ends = [x for lo, hi, _ in ranges for x in (lo - 1, lo, hi, hi + 1)]
    return [(i, r.choice([r.choice(ends), r.randint(-2 ** 21, 2 ** 41)])) for i in range(n)]


@pytest.mark.parametrize("bits,base", [(1, 0), (2, 0), (4, 0), (3, 5)])
def test_cover_is_disjoint_exact_and_logarithmic(spark, bits, base):
    r = random.Random(bits)
    ranges = wide_ranges(r, 60) + [(5, 5, "point"), (7, 6, "empty"), (0, 2 ** 60, "most")]
    df = spark.createDataFrame(ranges + [(None, 3, "null")], "lo long, hi long, name string")
    per = {}
    for x in range_cover(df, "lo", "hi", base, bits).collect():
        per.setdefault(x.name, []).append((x["__node"] << x["__level"], ((x["__node"] + 1) << x["__level"]) - 1, x["__level"]))
    assert "empty" not in per and "null" not in per
    for lo, hi, name in ranges:
        if lo > hi:
            continue
        nodes = sorted(per[name])
        assert all(a[1] + 1 == b[0] for a, b in zip(nodes, nodes[1:])), name
        assert nodes[0][0] == lo >> base << base and nodes[-1][1] == ((hi >> base) + 1 << base) - 1
        levels = len({v for _, _, v in nodes})
        assert len(nodes) < levels * 2 ** (bits + 1) and levels <= 2 + (hi - lo + 1).bit_length() // bits


@pytest.mark.parametrize("how", ["left", "inner"])
def test_all_matches_of_wide_ranges(spark, how):
    r = random.Random(11)
    ranges = wide_ranges(r, 80)
    points = points_near(r, ranges, 400) + [(1000, None), (5, 0), (5, 0)]
    pts = spark.createDataFrame(points, "id long, ip long")
    rng = spark.createDataFrame(ranges, "lo long, hi long, name string")
    want = []
    for i, ip in points:
        hits = [n for lo, hi, n in ranges if ip is not None and lo <= ip <= hi]
        want += [(i, n) for n in hits] or ([(i, "")] if how == "left" else [])
    for block, bits in ((1, 1), (1000, 4), (1 << 30, 2)):
        got = sorted((x.id, x.name or "") for x in range_join(pts, rng, "ip", "lo", "hi", block, how, bits).collect())
        assert got == sorted(want), (block, bits)


def test_narrowest_of_nested_ranges(spark):
    r = random.Random(12)
    ranges = wide_ranges(r, 60) + [(0, 2 ** k - 1, f"n{k}") for k in range(41)] + [(10, 20, "b"), (10, 20, "a"), (12, 22, "c")]
    points = points_near(r, ranges, 500) + [(1000, None), (1001, 12), (1002, 2 ** 50)]
    pts = spark.createDataFrame(points, "id long, ip long")
    rng = spark.createDataFrame(ranges, "lo long, hi long, name string")
    want = {}
    for i, ip in points:
        hits = [(hi - lo, lo, n, hi) for lo, hi, n in ranges if ip is not None and lo <= ip <= hi]
        want[i] = (min(hits)[1], min(hits)[3], min(hits)[2]) if hits else (None, None, None)
    for bits in (1, 4):
        out = narrowest_range(pts, rng, "ip", "lo", "hi", ["name"], bits).collect()
        assert len(out) == len(points)
        assert {x.id: (x.lo, x.hi, x.name) for x in out} == want


def test_no_ranges(spark):
    pts = spark.createDataFrame([(1, 5)], "id long, ip long")
    rng = spark.createDataFrame([], "lo long, hi long, name string")
    assert [tuple(x) for x in narrowest_range(pts, rng, "ip", "lo", "hi", ["name"]).collect()] == [(1, 5, None, None, None)]
    assert [x.name for x in range_join(pts, rng, "ip", "lo", "hi", 100).collect()] == [None]


def test_plans_are_equi_joins(spark):
    txt = plan_text(Q.q_geo_enrich_nested(spark, SF_SMALL))
    assert "NestedLoop" not in txt and "Cartesian" not in txt
    wide = spark.createDataFrame([(0, 2 ** 40, "w"), (1, 2, "n")], "lo long, hi long, name string")
    txt = plan_text(range_join(spark.range(100).select(F.col("id").alias("ip")), wide, "ip", "lo", "hi", 16))
    assert "NestedLoop" not in txt and "Cartesian" not in txt
