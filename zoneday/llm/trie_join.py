"""Similarity join of shingle sets by prefix trees.

A document's set holds its distinct shingles of five words; documents link
where the Jaccard similarity reaches a threshold.  Results are exact.

1.  A document can only link if enough of its shingles also occur elsewhere.
    Chunks of documents send short hashes of their shingles to the hash's
    owner, a shingle that occurs in several documents of the chunk once only,
    and get back how many of each document's shingles are known elsewhere.
    A short hash that meets another by chance lets too many pass, never too few.
2.  Of the documents left, equal sets become one node.  Shingles get a global
    order, rarest first, by a table of counts of a fixed size (any order gives
    right results).  Linked sets share a shingle among the first of both.
3.  Sets to be compared, as sequences in that order, are stored in a trie
    whose branches join equal beginnings.  Others walk down it together: the
    overlap of a branch is counted once for all sets below it, and a subtree
    is left as soon as the shingles left on both sides cannot reach the
    overlap that its sizes ask for.
4.  Where at most FEW nodes have a first shingle, each is asked against the
    others of like size.  Nodes that share one with more than these form
    clusters: these are joined block by block, then one node of each component
    found across blocks, and what then isn't in its cluster's main component
    is compared with all blocks.

Null and empty texts have an empty set and link with nothing; rows with equal
texts are linked with each other unless their set is empty.  A component is
named by its smallest doc_id, null ids aside; a row with a null id alone gets
a null component.  Column names of the input do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.llm.extendible_index import first_rows
from zoneday.llm.graph import components
from zoneday.llm.joins import split_join
from zoneday.llm.run_index import keyed
from zoneday.session import materialize

WORDS = 5
PERCENT = 75
CHUNK = 1 << 20
PIECE = 1 << 18  # bytes of whole texts that are hashed at once
PART = 1 << 19  # shingles of one hash range
CELLS = 1 << 21
FEW = 32
BLOCK = 256
CELL_BUDGET = 1 << 22
MANY = 0xFFFF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SALT = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xE7037ED1A0B428DB, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, and the text of each; data are UTF-8 bytes.

    Hashing holds some ten numbers a byte, so it takes a few texts at a time.
    """
    hashes, owners, a = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + PIECE, side="right")) - 1)
        h, t = _piece_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], words)
        hashes.append(h)
        owners.append(t + a)
        a = b
    return np.concatenate(hashes), np.concatenate(owners)


def _piece_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    low = _LOWER[data]
    starts, ends = flat.runs(~_SPACE[low], bounds)
    word = flat.FieldHashes(low).of(starts, ends)
    text = flat.owner(starts, bounds)
    count = np.bincount(text, minlength=len(bounds) - 1)
    salt = np.resize(_SALT, words) + np.arange(words, dtype=np.uint64) * np.uint64(2)
    hashes, owners = [], []
    for m in range(1, words + 1):
        n = len(word) - m + 1
        if n <= 0:
            break
        at = np.arange(n)
        ok = text[:n] == text[m - 1 :]
        # texts of fewer words have one shingle
        at = at[ok & (count[text[:n]] == m)] if m < words else at[ok]
        h = np.full(len(at), m, dtype=np.uint64)
        for j in range(m):
            h += word[at + j] * salt[j]
        hashes.append(flat.mix(h))
        owners.append(text[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, t = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]
    return h[keep], t[keep]


def fingerprints(h: np.ndarray, t: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text's set: its size and two sums of hashes that name it."""
    sums = []
    for salt in (1, 2):
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(flat.mix(h + np.uint64(salt)), out=total[1:])
        edge = np.searchsorted(t, np.arange(n + 1))
        sums.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return np.bincount(t, minlength=n), sums[0], sums[1]


def _table(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], list(columns))


NODE = "doc_id bigint, k1 bigint, k2 bigint, n bigint, s1 bigint, s2 bigint"


def nodes(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """For each row (doc_id, k1, k2, text): its set's size and name, and whether it can link to a different set at all."""
    spread = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    # about one shingle for seven bytes of text
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(30, max(6, int(size // 7 // PART).bit_length()))

    def ask(batches):
        number = TaskContext.get().partitionId() << 32
        for batch, data, bounds in flat.byte_chunks(batches, "text", CHUNK):
            for a in range(0, len(bounds) - 1, MANY - 1):
                edge = bounds[a : a + MANY]
                part = data[edge[0] : edge[-1]]
                h, t = shingle_sets(part, edge - edge[0], words)
                n, s1, s2 = fingerprints(h, t, len(edge) - 1)
                order = np.argsort(h, kind="stable")
                h, t = h[order], t[order]
                first = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
                df = np.diff(np.r_[np.flatnonzero(first), len(h)])
                known = np.repeat(df > 1, df)
                local = np.bincount(t[known], minlength=len(n))
                head = [batch.column(i).slice(a, len(n)) for i in range(3)]
                whole = pa.RecordBatch.from_arrays(
                    [*head, pa.array(n), pa.array(s1), pa.array(s2), pa.array(local)], ["doc_id", "k1", "k2", "n", "s1", "s2", "shared"]
                )
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, whole.schema) as out:
                    out.write_batch(whole)
                where = np.where(df > 1, MANY, t[first]).astype(np.uint16)
                h = h[first]
                owner = (h >> np.uint64(64 - bits)).astype(np.int64)
                short = ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(h) else np.zeros(0, int)
                ends = np.r_[cut[1:], len(h)] if len(h) else cut
                yield _table(
                    {
                        "chunk": ([number] * (len(cut) + 1), pa.int64()),
                        "part": ([-1 - number % spread, *owner[cut]], pa.int64()),
                        "hashes": ([sink.getvalue().to_pybytes(), *(short[x:y].tobytes() for x, y in zip(cut, ends, strict=True))], pa.binary()),
                        "docs": ([b"", *(where[x:y].tobytes() for x, y in zip(cut, ends, strict=True))], pa.binary()),
                    }
                )
                number += 1

    def answer(held):
        chunk = np.repeat(np.arange(len(held)), [len(r[2]) // 4 for r in held])
        h = np.frombuffer(b"".join(r[2] for r in held), dtype=np.uint32)
        doc = np.frombuffer(b"".join(r[3] for r in held), dtype=np.uint16)
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        yes = (count[inverse] > 1) & (doc != MANY)
        pair, n = np.unique(chunk[yes] * (MANY + 1) + doc[yes], return_counts=True)
        edge = np.searchsorted(pair, np.arange(len(held) + 1) * (MANY + 1))
        doc, n = (pair % (MANY + 1)).astype(np.uint16), n.astype(np.uint32)
        live = [k for k in range(len(held)) if edge[k] < edge[k + 1]]
        return _table(
            {
                "chunk": ([held[k][0] for k in live], pa.int64()),
                "part": ([0] * len(live), pa.int64()),
                "docs": ([doc[edge[k] : edge[k + 1]].tobytes() for k in live], pa.binary()),
                "counts": ([n[edge[k] : edge[k + 1]].tobytes() for k in live], pa.binary()),
            }
        )

    def count(batches):
        held = []
        for batch in _slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1] < 0:
                    yield _table({"chunk": ([row[0]], pa.int64()), "part": ([-1], pa.int64()), "docs": ([row[2]], pa.binary()), "counts": ([b""], pa.binary())})
                    continue
                if held and held[-1][1] != row[1]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    def finish(batches):
        """The rows of each chunk, its own list of documents first."""
        base = shared = None
        for batch in _slices(batches):
            for _, part, docs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part < 0:
                    if base is not None:
                        yield done(base, shared)
                    base = pa.ipc.open_stream(docs).read_all().combine_chunks().to_batches()
                    shared = np.asarray(base[0].column(6)).copy() if base else np.zeros(0, np.int64)
                else:
                    np.add.at(shared, np.frombuffer(docs, dtype=np.uint16), np.frombuffer(counts, dtype=np.uint32))
        if base is not None:
            yield done(base, shared)

    def done(base, shared):
        b = base[0]
        n = np.asarray(b.column(3))
        return pa.RecordBatch.from_arrays([*b.columns[:6], pa.array((n > 0) & (100 * shared >= percent * n))], [*b.schema.names[:6], "maybe"])

    asks = rows.select("doc_id", "k1", "k2", "text").mapInArrow(ask, "chunk bigint, part bigint, hashes binary, docs binary")
    answers = asks.repartition("part").sortWithinPartitions("part").mapInArrow(count, "chunk bigint, part bigint, docs binary, counts binary")
    by_chunk = answers.repartition("chunk").sortWithinPartitions("chunk", "part")
    return materialize(by_chunk.mapInArrow(finish, NODE + ", maybe boolean"), "shingle-nodes")


def _read_sets(texts: DataFrame, words: int) -> DataFrame:
    """(s1, s2, n, shingles) of each text."""

    def run(batches):
        for _, data, bounds in flat.byte_chunks(batches, "text"):
            h, t = shingle_sets(data, bounds, words)
            n, s1, s2 = fingerprints(h, t, len(bounds) - 1)
            edge = np.r_[0, np.cumsum(n)]
            sets = [h[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield _table({"s1": (s1, pa.int64()), "s2": (s2, pa.int64()), "n": (n, pa.int64()), "shingles": (sets, pa.binary())})

    return texts.mapInArrow(run, "s1 bigint, s2 bigint, n bigint, shingles binary")


def _slices(batches, rows: int = 512):
    """Smaller batches: a few sets are copied at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def frequencies(sets: DataFrame, cells: int = CELLS) -> np.ndarray:
    """How often the shingles of each of ``cells`` hash cells occur; always the same size."""
    block = 4096

    def run(batches):
        total = np.zeros(cells, dtype=np.int64)
        for batch in _slices(batches):
            np.add.at(total, _cell(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64), cells), 1)
        for i in np.flatnonzero(total.reshape(-1, block).any(axis=1)):
            part = total[i * block : (i + 1) * block]
            at = np.flatnonzero(part)
            yield _table({"block": ([i], pa.int64()), "at": ([at], pa.list_(pa.int64())), "n": ([part[at]], pa.list_(pa.int64()))})

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total.setdefault(i, np.zeros(block, dtype=np.int64))[at] += n
        for i, n in total.items():
            # an order needs no more than 16 bits
            yield _table({"block": ([i], pa.int64()), "n": ([np.minimum(n, MANY).astype(np.uint16).tobytes()], pa.binary())})

    parts = sets.select("shingles").mapInArrow(run, "block bigint, at array<bigint>, n array<bigint>")
    out = np.zeros(cells, dtype=np.uint16)
    for row in parts.repartition("block").mapInArrow(merge, "block bigint, n binary").collect():  # cells / 4096 rows
        out[row.block * block : (row.block + 1) * block] = np.frombuffer(row.n, dtype=np.uint16)
    return out


def _cell(h: np.ndarray, cells: int) -> np.ndarray:
    return (h & np.uint64(cells - 1)).astype(np.int64)


def order_of(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of a set in the global order: rarest first, then by hash."""
    return h[np.lexsort((h, counts[_cell(h, len(counts))]))]


def first_shingles(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(h, node, n, k): the first shingles of each node in the global order, and how many nodes have each; two or more."""

    def run(batches):
        for batch in _slices(batches):
            node, size, first = [], [], []
            for name, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = order_of(np.frombuffer(s, dtype=np.uint64), counts)
                head = h[: len(h) - -(-percent * len(h) // 100) + 1]
                head = head[counts[_cell(head, len(counts))] > 1]
                node += [name] * len(head)
                size += [len(h)] * len(head)
                first.append(head)
            if node:
                yield _table({"node": (node, pa.string()), "n": (size, pa.int64()), "h": (np.concatenate(first).view(np.int64), pa.int64())})

    heads = materialize(sets.select("node", "shingles").mapInArrow(run, "node string, n bigint, h bigint"), "first-shingles")
    held = heads.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1")
    return materialize(split_join(heads, held, "h"), "shared-first-shingles")


def pairs_of_few(heads: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: nodes of like size that share a first shingle, from groups of at most FEW nodes."""
    group = heads.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("node", "n"))).alias("g"))
    left = group.select("g", F.posexplode("g").alias("at", "x"))
    pair = left.select("x", F.explode(F.slice("g", F.col("at") + 2, F.size("g"))).alias("y"))
    like = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    return pair.filter(like).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


class Trie:
    """Sets in a global order, with equal beginnings stored once.

    ``rows``: arrays of ascending numbers.  An edge holds the numbers between
    two branchings.
    """

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows
        self.sizes = np.array([len(r) for r in rows])
        order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
        self.root = self._node(np.array(order, dtype=np.int64), 0)
        todo = [self.root]
        while todo:
            node = todo.pop()
            node[1] = [self._node(ids, depth) for ids, depth in node[1]]
            todo += node[1]

    def _node(self, ids: np.ndarray, depth: int) -> list:
        """Edge numbers, children, sets that end here, smallest and largest size below, most numbers below."""
        rows, sizes = self.rows, self.sizes
        a, b = rows[ids[0]][depth:], rows[ids[-1]][depth:]  # the first and the last in order differ first
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        edge = a[: differ[0] if len(differ) else n]
        depth += len(edge)
        here, rest = ids[sizes[ids] == depth], ids[sizes[ids] > depth]
        children = []
        if len(rest):
            key = np.array([rows[i][depth] for i in rest])
            children = [(part, depth) for part in np.split(rest, np.flatnonzero(np.diff(key)) + 1)]
        return [edge, children, here, int(sizes[ids].min()), int(sizes[ids].max()), int(sizes[ids].max()) - depth]

    def pairs(self, queries: list[np.ndarray], numbers: int, percent: int):
        """(query, set) of all pairs whose similarity is at least ``percent``."""
        sizes = np.array([len(q) for q in queries])
        has = np.zeros((len(queries), numbers), dtype=bool)
        for i, q in enumerate(queries):
            has[i, q] = True
        todo = [(self.root, np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64))]
        while todo:
            (edge, children, here, least, most, below), q, overlap = todo.pop()
            if len(edge):
                overlap = overlap + has[np.ix_(q, edge)].sum(axis=1)
            x = sizes[q]
            # the overlap that the smallest set below would ask for, and what is still to be had
            need = -(-percent * (x + least) // (100 + percent))
            left = np.minimum(below, x - overlap)
            ok = (overlap + left >= need) & (100 * most >= percent * x) & (100 * x >= percent * least)
            q, overlap, x = q[ok], overlap[ok], x[ok]
            if not len(q):
                continue
            for s in here:
                union = x + self.sizes[s] - overlap
                for k in q[100 * overlap >= percent * union]:
                    yield int(k), int(s)
            todo += [(child, q, overlap) for child in children]


def _join_task(names: list[str], sets: list[np.ndarray], side: np.ndarray, counts: np.ndarray, percent: int) -> list[tuple[str, str]]:
    """Links that connect what is connected among the sets of one task: side 0 with itself, or side 1 with side 0."""
    whole = np.unique(np.concatenate(sets))
    rank = np.empty(len(whole), dtype=np.int64)
    rank[np.lexsort((whole, counts[_cell(whole, len(counts))]))] = np.arange(len(whole))
    rows = [np.sort(rank[np.searchsorted(whole, s)]) for s in sets]
    stored = np.flatnonzero(side == 0)
    if not len(stored):  # a block's hash range may hold no node
        return []
    asked = np.flatnonzero(side == 1) if (side == 1).any() else stored
    trie = Trie([rows[i] for i in stored])
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    step = max(1, CELL_BUDGET // max(1, len(whole)))
    for at in range(0, len(asked), step):
        some = asked[at : at + step]
        for q, s in trie.pairs([rows[i] for i in some], len(whole), percent):
            a, b = find(int(some[q])), find(int(stored[s]))
            if a != b:
                parent[a] = b
                links.append((names[some[q]], names[stored[s]]))
    return links


def join_tasks(tasks: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """Links (a, b) within tasks (task, side, node, shingles); the rows of a task come together, never more than two blocks."""

    def run(batches):
        held: list[tuple] = []

        def emit():
            side = np.array([r[1] for r in held])
            links = _join_task([r[2] for r in held], [np.frombuffer(r[3], dtype=np.uint64) for r in held], side, counts, percent)
            return _table({"a": ([x for x, _ in links], pa.string()), "b": ([y for _, y in links], pa.string())})

        for batch in _slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    if len(held) > 1:
                        yield emit()
                    held = []
                held.append(row)
        if len(held) > 1:
            yield emit()

    dealt = tasks.select("task", "side", "node", "shingles").repartition("task").sortWithinPartitions("task", "side", "node")
    return dealt.mapInArrow(run, "a string, b string")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Adds the block of each member of a cluster: hash ranges of about ``block`` members."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / block).alias("blocks"))
    return members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))


def links(sets: DataFrame, counts: np.ndarray, percent: int, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """Links that connect all nodes (node, shingles) that are connected by similarity."""
    heads = first_shingles(sets, counts, percent)
    sides = sets.select("node", "shingles")
    # each node of a pair's smaller name is asked against the others, in blocks
    pairs = materialize(pairs_of_few(heads.filter(F.col("k") <= few), percent), "pairs")
    number = F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / block))
    dealt = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("m")), "a").select("a", F.col("b").alias("node"), number.alias("part"))
    asked = dealt.select("a", F.col("a").alias("node"), "part").distinct()
    one = lambda d, side: d.select(_task("a", "part").alias("task"), F.lit(side).alias("side"), "node")
    tasks = one(dealt, 0).union(one(asked, 1)).join(sides, "node")
    return join_tasks(tasks, counts, percent).union(links_of_many(heads.filter(F.col("k") > few), sides, counts, percent, block))


def _task(*columns: str) -> Column:
    return F.concat_ws("/", *(F.col(c).cast("string") for c in columns))


def links_of_many(heads: DataFrame, sides: DataFrame, counts: np.ndarray, percent: int, block: int) -> DataFrame:
    """The same for nodes that share a first shingle with many others."""
    leader = heads.groupBy("h").agg(F.min("node").alias("b"))
    clusters = components(split_join(heads, leader, "h").select(F.col("node").alias("a"), "b").distinct())
    placed = materialize(_blocks(clusters.select("node", F.col("component").alias("cluster")), block), "blocks")
    first = placed.join(sides, "node").select(_task("cluster", "block").alias("task"), F.lit(0).alias("side"), "node", "shingles")
    found = materialize(join_tasks(first, counts, percent), "near-links")
    big = placed.filter("blocks > 1")
    # one node of each component of a block is joined with those of other blocks
    one = _with_component(big.select("node", "cluster"), found).groupBy("cluster", "component").agg(F.min("node").alias("node"))
    one = _blocks(one.select("node", "cluster"), block).join(sides, "node")
    one = one.select(_task("cluster", "block").alias("task"), F.lit(0).alias("side"), "node", "shingles")
    found = materialize(found.union(join_tasks(one, counts, percent)), "near-links")
    # what isn't in its cluster's main component now is compared with every block
    joined = materialize(_with_component(big.select("node", "cluster"), found), "big-clusters")
    counted = joined.groupBy("cluster", "component").agg(F.count("*").alias("k"))
    main = counted.groupBy("cluster").agg(F.max(F.struct("k", "component"))["component"].alias("main"))
    rest = joined.join(main, "cluster").filter("component != main")
    rest = _blocks(rest.select("node", "cluster"), block).withColumnsRenamed({"block": "a", "blocks": "a_blocks"})
    rest = materialize(rest, "rest")
    span = rest.groupBy("cluster").agg(F.max("a_blocks").alias("a_blocks"))
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    asked = rest.join(big.groupBy("cluster").agg(F.max("blocks").alias("blocks")), "cluster").select(
        "cluster", "node", "a", all_of("blocks").alias("b"), F.lit(1).alias("side")
    )
    stored = big.join(span, "cluster").select("cluster", "node", all_of("a_blocks").alias("a"), F.col("block").alias("b"), F.lit(0).alias("side"))
    tasks = asked.unionByName(stored).join(sides, "node").select(_task("cluster", "a", "b").alias("task"), "side", "node", "shingles")
    return found.union(join_tasks(tasks, counts, percent))


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    label = components(found)
    return members.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return _labelled(docs, words, percent, **options).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, **options) -> DataFrame:
    """The documents without those that link to one with a smaller id, with their own columns.

    Of rows that share the smallest id of their component one stays; documents
    without words link with nothing, so they stay unless id and text are equal.
    """
    labelled = _labelled(docs, words, percent, **options).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = labelled.select("doc_id", "k1", "k2", "component").distinct()
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = keyed(docs.select(whole.alias("row"), F.col("doc_id").cast("bigint").alias("of"), F.col("text")), F.col("text"))
    same = (rows["k1"] == kept["k1"]) & (rows["k2"] == kept["k2"]) & rows["of"].eqNullSafe(kept["doc_id"])
    alone = F.when(F.col("component").isNull(), F.struct(rows["k1"], rows["k2"], "of"))
    met = rows.join(kept, same).select("row", F.struct("component", alone.alias("alone")).alias("same"))
    return first_rows(met).select("row.*")


def _labelled(docs: DataFrame, words: int, percent: int, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """Per document: doc_id, the two keys of its text, n_shingles, component_id, and the component's node (null without words)."""
    flat.few_rows_per_batch(docs.sparkSession)
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")), F.col("text"))
    found = nodes(rows, words, percent).withColumn("node", F.when(F.col("n") > 0, F.concat_ws("/", F.hex("s1"), F.hex("s2"), "n")))
    wanted = found.filter("maybe").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.*")
    texts = rows.join(wanted, ["k1", "k2"], "left_semi").select("text")
    sets = _read_sets(texts, words).select(F.concat_ws("/", F.hex("s1"), F.hex("s2"), "n").alias("node"), "shingles")
    sets = materialize(sets.groupBy("node").agg(F.min("shingles").alias("shingles")), "shingle-sets")
    # written first: contracting in the same tasks would take two Python workers a task
    found_links = materialize(links(sets, frequencies(sets), percent, block, few), "node-links")
    label = components(found_links)
    classes = found.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named, "near-classes")
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = split_join(named, lowest, "component").select("node", "component", "component_id")
    # a set that a single document has needs no join, and a hot one is split by adaptive execution
    return found.join(by_node, "node", "left").select(
        "doc_id", "k1", "k2", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "component"
    )
