"""Vertex/edge property-graph model built from fact and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import first_per_key


def _props_map(pairs: Sequence[tuple[str, Column]]) -> Column:
    args: list[Column] = []
    for k, v in pairs:
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def vertices(df: DataFrame, id_col: str, vtype: str, props: Sequence[tuple[str, Column]],
             order: Sequence[str | Column] | None = None) -> DataFrame:
    """One vertex per identifier: (identifier, type, properties map<string,string>).
    With ``order`` duplicates are removed keeping the first row by that order."""
    if order is not None:
        df = first_per_key(df, [id_col], order)
    return df.select(F.col(id_col).alias("identifier"), F.lit(vtype).alias("type"),
                     _props_map(props).alias("properties"))


def edges(df: DataFrame, subject: str, subject_type: str, obj: str, object_type: str,
          edge_type: str | Column, props: Sequence[tuple[str, Column]]) -> DataFrame:
    et = F.lit(edge_type) if isinstance(edge_type, str) else edge_type
    return df.select(F.col(subject).cast("string").alias("subject_identifier"),
                     F.lit(subject_type).alias("subject_type"),
                     F.col(obj).cast("string").alias("object_identifier"),
                     F.lit(object_type).alias("object_type"),
                     et.alias("edge_type"),
                     F.to_json(F.struct(*[v.alias(k) for k, v in props]),
                               {"ignoreNullFields": "false"}).alias("properties"))


def pair_cells(facts: DataFrame, group: str, node: str, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """The two sides of a self join of ``group``'s members, cut into triangle cells.

    A group of more than ``cell_rows`` rows is hashed by ``node`` into blocks of about that
    size; a row of block i goes to the cells (i, j >= i) on the left and (j <= i, i)
    on the right. Joined on (group, __i, __j), two rows of different blocks meet in
    one cell, rows of one block in the cell (i, i), where the caller orders them.
    A cell holds about 2 x ``cell_rows`` rows whatever the size of its group. Rows with a
    null group or node pair with nothing and are left out."""
    facts = facts.where(F.col(group).isNotNull() & F.col(node).isNotNull())
    big = (facts.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > cell_rows)
           .select(group, F.ceil(F.col("__n") / cell_rows).cast("int").alias("__blocks")))
    f = (facts.join(big, group, "left").withColumn("__blocks", F.coalesce("__blocks", F.lit(1)))
         .withColumn("__block", F.pmod(F.xxhash64(node), F.col("__blocks")).cast("int")))
    left = f.withColumn("__j", F.explode(F.sequence("__block", F.col("__blocks") - 1))).withColumnRenamed("__block", "__i").drop("__blocks")
    right = f.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__block")))).withColumnRenamed("__block", "__j").drop("__blocks")
    return left, right


def co_occurrence_edges(facts: DataFrame, group: str, node: str, node_name: str, side: str,
                        value: str, same_label: str, diff_label: str, cell_rows: int = 2000,
                        small: DataFrame | None = None) -> DataFrame:
    """Edges between nodes that share a group (players in the same game):
    one edge per unordered pair and relation (same side or not), with the
    number of shared groups and the value sums of both ends. The subject is the
    greater node.

    The self join runs on triangle cells (``pair_cells``), so the pairs of a group
    that holds much of the rows are made by many tasks, and are summed per task
    before they are shuffled by pair. Each side is projected to its columns first.

    ``small`` holds the rows of further groups, none of them in ``facts``, that are known
    to be of bounded size: they need no cells and are joined on the group as they are
    dealt, both sides from one shuffle where the rows are already dealt by group."""
    ends = (node, node_name, side, value)
    left, right = pair_cells(facts.select(group, *ends), group, node, cell_rows)
    a = left.select(group, "__i", "__j", F.struct(*ends).alias("__a"))
    b = right.select(group, "__i", "__j", F.struct(*ends).alias("__b"))
    j = a.join(b, [group, "__i", "__j"]).where(
        ((F.col("__i") < F.col("__j")) | (F.col(f"__a.{node}") > F.col(f"__b.{node}")))
        & (F.col(f"__a.{node_name}") != F.col(f"__b.{node_name}"))).select("__a", "__b")
    return _edge_sums(j if small is None else j.unionByName(_pairs_in_place(small, group, ends)), ends, same_label, diff_label)


def small_group_edges(small: DataFrame, group: str, node: str, node_name: str, side: str,
                      value: str, same_label: str, diff_label: str) -> DataFrame:
    """``co_occurrence_edges`` where every group is known to be of bounded size."""
    ends = (node, node_name, side, value)
    return _edge_sums(_pairs_in_place(small, group, ends), ends, same_label, diff_label)


def _pairs_in_place(small: DataFrame, group: str, ends: Sequence[str]) -> DataFrame:
    """Pairs (__a, __b) of a group's rows, the greater node first. Null groups and nodes pair with nothing."""
    node, node_name = ends[:2]
    a = small.select(group, F.struct(*ends).alias("__a"))
    b = small.select(group, F.struct(*ends).alias("__b"))
    return a.hint("merge").join(b, group).where(
        (F.col(f"__a.{node}") > F.col(f"__b.{node}")) & (F.col(f"__a.{node_name}") != F.col(f"__b.{node_name}"))).select("__a", "__b")


def _edge_sums(pairs: DataFrame, ends: Sequence[str], same_label: str, diff_label: str) -> DataFrame:
    node, node_name, side, value = ends
    first = F.col(f"__a.{node}") > F.col(f"__b.{node}")
    pick = lambda c: (F.when(first, F.col(f"__a.{c}")).otherwise(F.col(f"__b.{c}")),
                      F.when(first, F.col(f"__b.{c}")).otherwise(F.col(f"__a.{c}")))
    rel = F.when(F.col(f"__a.{side}") == F.col(f"__b.{side}"), same_label).otherwise(diff_label)
    (s_id, o_id), (s_name, o_name), (s_val, o_val) = pick(node), pick(node_name), pick(value)
    return (pairs.groupBy(s_id.alias("subject_identifier"), s_name.alias("subject_name"),
                          o_id.alias("object_identifier"), o_name.alias("object_name"), rel.alias("edge_type"))
            .agg(F.count(F.lit(1)).alias("num_games"), F.sum(s_val).alias("subject_points"),
                 F.sum(o_val).alias("object_points")))
