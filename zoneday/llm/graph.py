"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zoneday.llm.joins import split_join
from zoneday.session import materialize

FLUSH = 100_000

def _contract(edges: DataFrame) -> DataFrame:
    """In each task's share of the links, every node linked to the smallest node it is connected with there."""

    def run(batches):
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            # a share that outgrows a task's memory goes out in parts
            if len(parent) > FLUSH:
                yield from pairs(parent, find)
                parent.clear()
        yield from pairs(parent, find)

    def pairs(parent, find):
        out = [(x, r) for x in list(parent) if (r := find(x)) != x]
        if out:
            kind = pa.int64() if isinstance(out[0][0], int) else pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*out, strict=True)], ["a", "b"])

    kind = dict(edges.dtypes)["a"]
    return edges.mapInArrow(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), bigint or string; the component is its smallest node.

    Links are contracted within each task first.  Then, in the large step,
    every node hands its larger neighbours to its smallest neighbour, in the
    small step its smaller ones, until only stars around the smallest nodes
    are left.  A node's links are never gathered: minima are combined before
    they are dealt out, and adaptive execution splits the join of a node with
    very many links.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    edges = materialize(_contract(edges), "links")
    while not edges.isEmpty():
        seen = Observation()
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # in stars a node with a larger neighbour is a root, and any other has one neighbour
        bent = F.when(F.col("b") > F.col("a"), F.col("m") != F.col("a")).otherwise(F.col("m") != F.col("b"))
        met = split_join(both, lowest, "a").observe(seen, F.count_if(bent).alias("bent"))
        large = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node's smaller neighbours go to the smallest, and so does the node
        after = materialize(_contract(small.union(least.select("a", F.col("m").alias("b")))), "links")
        if not seen.get["bent"]:
            break
        edges = after
    edges = edges.distinct()
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
