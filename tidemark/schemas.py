"""Explicit schemas of the given tables. Reading with a declared schema skips
the footer-inference job per read and pins the types the operators expect."""

from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                    ("c_mktsegment", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                ("p_retailprice", D)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                  ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                  ("props", S)),
}
