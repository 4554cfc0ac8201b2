"""Connected components of an edge list, with joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root): `root` names the component. `edges` has `a` and `b`, hash-like names of
    nodes (their order must be unrelated to the graph); loops are harmless.

    Each round maps a node to the smallest of itself and its neighbours and contracts the
    edges, until none is left; with names in random order that takes logarithmically many
    rounds. Tables written between rounds cut the lineage, and give both sides of each join
    an exchange of its own, so that the adaptive skew join can split a node that very many
    edges share. No node's neighbours are ever collected.
    """
    spark = edges.sparkSession
    left = common.written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    first = left
    maps: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        to = ends.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("n")).select(
            "node", F.least("node", "n").alias("to"))
        maps.append(common.written(to, "contraction"))
        m = maps[-1]
        left = common.written(
            left.join(m.withColumnsRenamed({"node": "a", "to": "x"}), "a")
            .join(m.withColumnsRenamed({"node": "b", "to": "y"}), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not maps:
        return spark.createDataFrame([], f"node {first.schema['a'].dataType.simpleString()}, "
                                         f"root {first.schema['a'].dataType.simpleString()}")
    out = maps[0].withColumnRenamed("to", "root")
    for m in maps[1:]:
        out = out.join(m.withColumnsRenamed({"node": "root", "to": "up"}), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root"))
    return common.written(out, "components")
