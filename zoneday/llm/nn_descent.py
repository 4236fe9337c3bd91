"""Near-duplicate embeddings by NN-descent.

Vectors of one label are linked where their cosine reaches a threshold.
Equal unit vectors of a label are one node with a weight.

Seeds: random hyperplanes cut each label into cells, and cells into blocks of
bounded size; each node takes its best neighbours in its block.  Descent: the
neighbours of a node, its own and those that list it, are compared with each
other, and every node keeps the best it has seen, until lists hardly change.
Lists whose every entry reaches the threshold are saturated: links may be
missing.  They are enlarged to the whole component of threshold links they
lie in, which is compared block by block in double precision; other lists'
links are checked in double precision as they are.  An audit compares nodes
drawn per label and size of group with all nodes of their labels, and as long
as a label's mean recall per node is below ``RECALL`` it gets new seeds and its
lists descend again.  A label that is still below after ``most_seeds`` seeds
has all its nodes compared with each other, exactly, block by block.

A null or zero vector, one with null or non-finite components, and a null
label link with nothing; vectors of different lengths are never compared.
Repeated rows count as other vectors.  A component is named by its smallest
vec_id; null ids get their component's name, or null alone, and are not kept.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneday.llm.flat import few_rows_per_batch
from zoneday.llm.graph import components
from zoneday.session import materialize

THRESHOLD = 0.93
NEIGHBOURS = 8
BLOCK = 256
SEEDS = 2
ROUNDS = 4
AUDITED = 256  # of each label and size of group
AUDIT_BLOCK = 2048
RECALL = 0.98
SLACK = 1e-4  # lists hold cosines of single precision
UNIT = "vec_id bigint, label string, dim int, unit binary"


def _table(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(columns, names, strict=True)], [n for n, _ in names])


def units(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, unit): the unit vector in double precision as bytes, null where nothing can link."""

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_pylist()
            out, dims = [], []
            for name, x in zip(label, batch.column(2).to_pylist(), strict=True):
                unit = None
                if name is not None and x and None not in x:
                    x = np.array(x, dtype=np.float64)
                    top = np.abs(x).max()
                    if np.isfinite(top) and top > 0:
                        x = x / top
                        unit = (x / np.linalg.norm(x)).tobytes()
                out.append(unit)
                dims.append(None if unit is None else len(x))
            yield _table(UNIT, batch.column(0), label, dims, out)

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    return rows.mapInArrow(run, UNIT)


def _groups(batches, width: int):
    """Rows of the batches, group by group: rows follow each other while their first ``width`` cells are equal."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:width] != row[:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _matrix(units_: list[bytes], kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(units_), dtype=np.float64).reshape(len(units_), -1).astype(kind)


EDGES = "v bigint, u bigint, sim double"


def seeds(nodes: DataFrame, turn: int, k: int, block: int) -> DataFrame:
    """Edges to the best neighbours in blocks of cells between random hyperplanes."""

    def sign(batches):
        for batch in batches:
            node, dim, unit = (c.to_pylist() for c in batch.columns)
            sig = np.zeros(len(node), dtype=np.int64)
            for d in set(dim):
                at = [i for i, x in enumerate(dim) if x == d]
                planes = np.random.default_rng([turn, d]).standard_normal((d, 40))
                sig[at] = (_matrix([unit[i] for i in at]) @ planes > 0) @ (1 << np.arange(40))
            yield _table("node bigint, sig bigint", node, sig)

    def best(batches):
        for rows in _groups(batches, 4):
            if len(rows) > 1:
                x = _matrix([r[5] for r in rows], np.float32)
                node = np.array([r[4] for r in rows])
                yield _lists(node, node, x @ x.T, k)

    signed = nodes.select("node", "dim", "unit").mapInArrow(sign, "node bigint, sig bigint")
    sized = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    cells = nodes.join(signed, "node").join(sized, ["label", "dim"])
    # so many hyperplanes that a cell would have about one block
    bits = F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / block)))).cast("int")
    cells = cells.withColumn("bits", bits).withColumn("cell", F.expr("sig & (shiftleft(1L, bits) - 1)")).select("label", "dim", "cell", "node", "unit")
    held = cells.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = cells.join(held, ["label", "dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("blocks")))
    dealt = dealt.select("label", "dim", "cell", "block", "node", "unit").repartition("label", "dim", "cell", "block")
    return dealt.sortWithinPartitions("label", "dim", "cell", "block", "node").mapInArrow(best, EDGES)


def _lists(of: np.ndarray, among: np.ndarray, sim: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of ``among`` for each of ``of``."""
    sim = np.where(of[:, None] == among[None, :], -2.0, sim)
    k = min(k, len(among) - 1)
    top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return _table(EDGES, np.repeat(of, k), among[top].ravel(), np.take_along_axis(sim, top, axis=1).ravel().astype(np.float64))


def top(edges: DataFrame, k: int) -> DataFrame:
    """The k best edges of each node."""
    best = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
    unique = edges.groupBy("v", "u").agg(F.max("sim").alias("sim"))
    return unique.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")


def descend(nodes: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Lists after one round: neighbours of one node are compared with each other."""

    def run(batches):
        for rows in _groups(batches, 1):
            if len(rows) < 2:
                continue
            node, worst = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            x = _matrix([r[3] for r in rows], np.float32)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            a, b = np.nonzero(sim > worst[:, None])
            if len(a):
                yield _table(EDGES, node[a], node[b], sim[a, b].astype(np.float64))

    both = top(lists.union(lists.select(F.col("u").alias("v"), F.col("v").alias("u"), "sim")), 2 * k)
    worst = lists.groupBy("v").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-1.0).alias("worst"))
    cells = nodes.select(F.col("node").alias("u"), "unit").join(worst.withColumnRenamed("v", "u"), "u")
    rows = both.join(cells, "u").select("v", "u", "worst", "unit").repartition("v").sortWithinPartitions("v", "u")
    return top(lists.union(rows.mapInArrow(run, EDGES)), k)


def refine(nodes: DataFrame, lists: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """Descends until less than one entry in a hundred changes."""
    for _ in range(rounds):
        after = materialize(descend(nodes, lists, k), "neighbours")
        new, total = after.join(lists.select("v", "u"), ["v", "u"], "left_anti").count(), after.count()
        lists = after
        if 100 * new <= total:
            break
    return lists


COUNTS = "node bigint, links bigint, other bigint"


def _compare(nodes: DataFrame, members: DataFrame, threshold: float, block: int) -> DataFrame:
    """All pairs within each component (node, component), block by block: weights of links per node, and links that connect."""

    def run(batches):
        for rows in _groups(batches, 3):
            side, node = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
            weight, x = np.array([r[5] for r in rows]), _matrix([r[6] for r in rows])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            same = not len(right)
            right = left if same else right
            near = x[left] @ x[right].T >= threshold
            if same:
                np.fill_diagonal(near, False)
            yield _table(COUNTS, node[left], near @ weight[right], [None] * len(left))
            if not same:
                yield _table(COUNTS, node[right], weight[left] @ near, [None] * len(right))
            # each node's first link, and where rows share nothing yet the links between
            parent = np.arange(len(rows))
            out = []
            for a, b in zip(*np.nonzero(near), strict=True):
                i, j = left[a], right[b]
                while parent[i] != i:
                    parent[i] = i = parent[parent[i]]
                while parent[j] != j:
                    parent[j] = j = parent[parent[j]]
                if i != j:
                    parent[i] = j
                    out.append((node[left[a]], node[right[b]]))
            if out:
                yield _table(COUNTS, [a for a, _ in out], [0] * len(out), [b for _, b in out])

    sized = members.groupBy("component").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = members.join(sized, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    placed = placed.select("component", "node", "block", partner)
    placed = placed.select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node"
    )
    rows = placed.join(nodes.select("node", "weight", "unit"), "node").select("component", "i", "j", "side", "node", "weight", "unit")
    return rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side", "node").mapInArrow(run, COUNTS)


def _check(nodes: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The links among listed pairs (a < b), in double precision."""

    def run(batches):
        for batch in batches:
            a, b, wa, wb, xa, xb = (c.to_pylist() for c in batch.columns)
            rows = [(i, j, p, q) for i, j, p, q, x, y in zip(a, b, wa, wb, xa, xb, strict=True) if np.dot(np.frombuffer(x), np.frombuffer(y)) >= threshold]
            if rows:
                i, j, p, q = zip(*rows, strict=True)
                yield _table(COUNTS, [*i, *j], [*q, *p], [*j, *i])

    side = lambda n: nodes.select(F.col("node").alias(n), F.col("weight").alias(f"w{n}"), F.col("unit").alias(f"x{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "wa", "wb", "xa", "xb").mapInArrow(run, COUNTS)


def link_counts(nodes: DataFrame, lists: DataFrame, k: int, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(node, links, other): weights of links found, and links that connect, from neighbour lists; and the nodes of components compared whole."""
    near = materialize(lists.filter(F.col("sim") >= threshold - SLACK), "near")
    member = materialize(components(near.select(F.col("v").alias("a"), F.col("u").alias("b"))), "components")
    full = near.groupBy("v").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    saturated = member.join(full.select(F.col("v").alias("node")), "node", "left_semi").select("component").distinct()
    wide = member.join(saturated, "component", "left_semi").select("node", "component")
    pairs = near.select(F.least("v", "u").alias("a"), F.greatest("v", "u").alias("b")).distinct()
    plain = pairs.join(wide.select(F.col("node").alias("a")), "a", "left_anti")
    return materialize(_check(nodes, plain, threshold).unionByName(_compare(nodes, wide, threshold, block)), "link-counts"), wide


def against(nodes: DataFrame, asked: DataFrame, threshold: float, block: int) -> DataFrame:
    """The nodes of ``asked`` compared with every node of their labels, block by block: weights of links per asked node, and links that connect."""

    def run(batches):
        for rows in _groups(batches, 4):
            side, node = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
            weight, x = np.array([r[6] for r in rows]), _matrix([r[7] for r in rows])
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            if not len(left) or not len(right):
                continue
            near = (x[left] @ x[right].T >= threshold) & (node[left][:, None] != node[right][None, :])
            yield _table(COUNTS, node[left], near @ weight[right], [None] * len(left))
            i, j = np.nonzero(near)
            first = _firsts(left[i], right[j], len(rows))
            tied = np.flatnonzero((first != np.arange(len(rows))) & (node[first] != node))
            if len(tied):
                yield _table(COUNTS, node[tied], [0] * len(tied), node[first[tied]])

    key = ["label", "dim"]
    rows = nodes.select(*key, "node", "weight", "unit")
    own = rows.join(asked.select("node"), "node", "left_semi")
    sized = rows.groupBy(*key).agg(F.ceil(F.count("*") / block).alias("blocks"))
    parts = materialize(own.groupBy(*key).agg(F.ceil(F.count("*") / block).alias("parts")).join(sized, key), "audit-blocks")
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    dealt = lambda c: F.pmod(F.xxhash64("node", F.lit(c)), F.col(c))
    held = rows.join(parts, key).select(*key, dealt("blocks").alias("block"), all_of("parts").alias("part"), F.lit(0).alias("side"), "node", "weight", "unit")
    put = own.join(parts, key).select(*key, all_of("blocks").alias("block"), dealt("parts").alias("part"), F.lit(1).alias("side"), "node", "weight", "unit")
    pairs = held.unionByName(put).repartition(*key, "block", "part")
    return pairs.sortWithinPartitions(*key, "block", "part", "side", "node").mapInArrow(run, COUNTS)


def _firsts(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The first of the ``n`` rows that each row is connected with by links a - b."""
    first = np.arange(n)
    while True:
        before = first.copy()
        np.minimum.at(first, a, before[b])
        np.minimum.at(first, b, first[a])
        first = first[first]
        if (first == before).all():
            return first


def audit(nodes: DataFrame, counts: DataFrame, wide: DataFrame, threshold: float, audited: int = AUDITED, block: int = AUDIT_BLOCK) -> DataFrame:
    """(label, dim, recall): the mean over nodes with links of the share of their links that was found.

    Nodes are drawn per label and per size of what was found, about ``audited``
    of each, and compared with every node of their labels; a drawn node stands
    for as many as its draw left out.  Of the nodes without a link found so
    many are drawn that as few missed ones as the bound allows would show (at
    95 %), all of them where few links were found.  Nodes of components that
    were compared whole and other nodes are judged apart, and the lower mean
    counts.  A label without links has none to miss: null.
    """
    found = counts.groupBy("node").agg(F.sum("links").alias("got"))
    placed = nodes.select("node", "label", "dim").join(found, "node", "left").join(wide.select("node", F.lit(True).alias("wide")), "node", "left")
    size = F.when(F.col("got") > 0, F.floor(F.log2("got"))).otherwise(-1)
    placed = placed.select("node", "label", "dim", F.coalesce("wide", F.lit(False)).alias("wide"), F.coalesce("got", F.lit(0)).alias("got"), size.alias("size"))
    placed = materialize(placed, "audit-nodes")
    drawn_by = ["label", "dim", "wide", "size"]
    sizes = materialize(placed.groupBy(*drawn_by).agg(F.count("*").alias("n")), "audit-sizes")
    linked = sizes.filter("not wide and size >= 0").groupBy("label", "dim").agg(F.sum("n").alias("linked"))
    enough = F.coalesce(3 / ((1 - RECALL) * F.col("linked")), F.lit(1.0))
    rate = F.greatest(audited / F.col("n"), F.when(F.expr("not wide and size < 0"), enough).otherwise(0.0))
    rates = materialize(sizes.join(linked, ["label", "dim"], "left").select(*drawn_by, F.least(F.lit(1.0), rate).alias("rate")), "audit-rates")
    draw = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 40)) / float(1 << 40)
    asked = materialize(placed.join(rates, drawn_by).filter(draw < F.col("rate")).select("node", "label", "dim", "wide", "got", "rate"), "audited")
    true = against(nodes, asked, threshold, block).groupBy("node").agg(F.sum("links").alias("all"))
    judged = asked.join(true, "node").filter("all > 0").groupBy("label", "dim", "wide")
    means = judged.agg((F.sum(F.least(F.lit(1.0), F.col("got") / F.col("all")) / F.col("rate")) / F.sum(1 / F.col("rate"))).alias("recall"))
    recall = means.groupBy("label", "dim").agg(F.min("recall").alias("recall"))
    return materialize(nodes.select("label", "dim").distinct().join(recall, ["label", "dim"], "left"), "audit")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, block: int = BLOCK, most_seeds: int = 6
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    few_rows_per_batch(vectors.sparkSession)
    rows = materialize(units(vectors), "units")
    key = ["label", "dim", "unit"]
    nodes = rows.filter("unit is not null").groupBy(*key).agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    todo, lists, turn, done = nodes, None, 0, []
    while True:
        fresh = [seeds(todo, t, k, block) for t in range(turn, turn + SEEDS)]
        turn += SEEDS
        for f in fresh:
            lists = f if lists is None else lists.union(f)
        lists = refine(todo, materialize(top(lists, k), "neighbours"), k)
        counts, wide = link_counts(todo, lists, k, threshold, block)
        poor = audit(todo, counts, wide, threshold).filter(F.col("recall") < RECALL)
        if poor.isEmpty():
            done.append(counts)
            break
        short = materialize(todo.join(poor, ["label", "dim"], "left_semi"), "short-labels")
        done.append(counts.join(short.select("node"), "node", "left_anti"))
        if turn >= most_seeds:
            done.append(materialize(against(short, short, threshold, AUDIT_BLOCK), "exact-links"))
            break
        todo, lists = short, lists.join(short.select(F.col("node").alias("v")), "v", "left_semi")
    counts = reduce(DataFrame.unionByName, done)
    total = counts.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(counts.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = materialize(nodes.join(total, "node", "left").join(label, "node", "left").withColumn("component", F.coalesce("component", "node")), "named")
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "component").select(*key, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    found = rows.join(named, key, "left")
    component = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
