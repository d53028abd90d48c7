"""A property graph held as a node table and a relationship table.

Nodes: (id, label, value); relationships: (src, dst, type, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_pattern(
    nodes: DataFrame,
    rels: DataFrame,
    source: str,
    types: Sequence[str],
    target: str,
    value: str | None = "value",
    default: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges matching (source label)-[types]->(target label).

    All types are one filter, not one query each. Edges carry ``value`` or,
    where it is missing or not asked for, ``default``.
    """
    starts = nodes.where(F.col("label") == source).select(F.col("id").alias("src"))
    ends = nodes.where(F.col("label") == target).select(F.col("id").alias("dst"))
    carried = F.lit(float(default)) if value is None else F.coalesce(F.col(value).cast("double"), F.lit(float(default)))
    edges = (
        rels.where(F.col("type").isin(*types))
        .select("src", "dst", carried.alias("value"))
        .join(starts, "src", "left_semi")
        .join(ends, "dst", "left_semi")
        .select("src", "dst", "value")
        .distinct()
    )
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    vertices = nodes.join(ids, "id", "left_semi").select("id", "value").distinct()
    return vertices, edges


def merge_edges(nodes: DataFrame, rels: DataFrame, batch: DataFrame, source_label: str, target_label: str, rel_type: str) -> tuple[DataFrame, DataFrame]:
    """Add (src, dst, value) rows; what exists stays as it is.

    Missing nodes are created with no value, a missing relationship once with
    the smallest value offered. Values are set only on creation.
    """
    ends = batch.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(source_label).alias("label")),
                F.struct(F.col("dst").alias("id"), F.lit(target_label).alias("label")),
            )
        ).alias("n")
    ).select("n.id", "n.label").distinct()
    new_nodes = ends.join(nodes, ["id", "label"], "left_anti")
    offered = batch.groupBy("src", "dst").agg(F.min("value").alias("value")).withColumn("type", F.lit(rel_type))
    new_rels = offered.join(rels, ["src", "dst", "type"], "left_anti")
    return (
        nodes.unionByName(new_nodes, allowMissingColumns=True),
        rels.unionByName(new_rels.select("src", "dst", "type", "value")),
    )


def update_values(nodes: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New node table with (id, value) written onto known ids, and the number updated."""
    new = values.select("id", F.col("value").alias("_new"), F.lit(1).alias("_hit"))
    joined = nodes.join(new, "id", "left")
    out = joined.withColumn("value", F.coalesce("_new", "value")).drop("_new", "_hit")
    return out, joined.agg(F.count("_hit").alias("updated"))
