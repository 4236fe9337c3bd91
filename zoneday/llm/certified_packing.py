"""Best-fit packing with certified bin counts.

Documents become token ids and one end id.  Longer ones are cut into pieces of
a full sequence, the first piece may be shorter; a full piece is a sequence of
its own.  The other pieces are dealt into partitions and packed there by
best-fit decreasing.

Dual-feasible functions give lower bounds: such a function maps the lengths
of any set that fits one sequence to a sum of at most 1, so the sum over all
pieces, rounded up, is a number of sequences that no packing goes below.  A
partition whose count meets its best bound is certified.  From a partition
with a gap the sequences with most room are given back; these sequences are
exchanged between partitions (dealt anew) and their pieces packed again.  Each
partition takes its new packing where that needs fewer sequences than it was
given and keeps the given ones otherwise.  Rounds go on while the number falls.

Null text counts as empty: it is one piece with the end id alone.  Repeated
rows are packed once each, and a null doc_id stays null.  Texts of any length
are handled whole.  An empty table gives no sequences.
"""

from __future__ import annotations

import base64
import zlib
from functools import cache, reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.session import materialize

SEQUENCE = 2048
PER_GROUP = 2048  # pieces packed at once
LONG_RUN = 50_000
OPEN_SHARE = 16  # a gap of one sequence gives back this many sequences
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, deal bigint"


@cache
def encoding(ranks_path: str, pattern: str, end: str):
    """The byte-level vocabulary, with its end string as the id behind the last rank."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={end: len(ranks)})


@cache
def library(path: str):
    """The vocabulary as the tokenizers library reads it, without truncation and padding."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib


def cut(
    docs: DataFrame, ranks_path: str, pattern: str, whole_path: str, end: str = "<|endoftext|>", end_id: int = 0, size: int = SEQUENCE
) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, and a hash that deals them out.

    ``whole_path`` is the tokenizers library's file of the same vocabulary.
    Texts with a run of LONG_RUN white-space characters are encoded by that
    library, as the faster encoder's search gives up in long runs.
    """

    def run(batches):
        import re

        enc, long_run = encoding(ranks_path, pattern, end), re.compile(rf"\s{{{LONG_RUN}}}")
        for batch, texts, _ in flat.text_rows(batches, "text"):
            ids = batch.column(0).to_pylist()
            rows = []
            for doc, text in zip(ids, texts, strict=True):
                slow = len(text) >= LONG_RUN and long_run.search(text)
                found = library(whole_path).encode(text, add_special_tokens=False).ids if slow else enc.encode(text, allowed_special="all")
                tokens = np.append(np.asarray(found, dtype="<u4"), np.uint32(end_id))
                n = len(tokens)
                first = n if n <= size else n % size or size
                bounds = [0, *range(first, n + 1, size)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc, k, a, b - a, zlib.crc32(tokens[a:b].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    # the row's own number keeps equal rows apart, so that no group is filled by one text
    return pieces.withColumn("deal", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()))


def lower_bound(lengths: np.ndarray, size: int = SEQUENCE) -> int:
    """The best of several dual-feasible bounds on the number of sequences.

    The plain sum of lengths; for each threshold t up to half, lengths above
    size - t count as whole and those below t as nothing; and for each k the
    function that counts floor((k + 1) x) / k unless (k + 1) x is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1)
    best = -(-int((counts * x).sum()) // size)
    mass, many = np.cumsum(counts * x), np.cumsum(counts)
    t = np.arange(1, size // 2 + 1)
    middle = mass[size - t] - mass[t - 1]
    whole = many[size] - many[size - t]
    best = max(best, int((whole - (-middle // size)).max()))
    for k in range(1, 41):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, k * x, scaled // size * size)  # times k * size
        best = max(best, -(-int((counts * value).sum()) // (k * size)))
    return best


def best_fit(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the sequence and the offset of each piece."""
    order = np.argsort(-lengths, kind="stable")
    which, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    rooms: list[list[int]] = [[] for _ in range(size + 1)]  # sequences by room left
    used = 0  # bit r: some sequence has room r
    n = 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = used >> length
        if fit:
            room = length + (fit & -fit).bit_length() - 1
            seq = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            room, seq = size, n
            n += 1
        which[i], offset[i] = seq, size - room
        left = room - length
        rooms[left].append(seq)
        used |= 1 << left
    return which, offset


def _pack(group: pd.DataFrame, size: int) -> pd.DataFrame:
    """One group packed: sequence number within the group, offset, room of the sequence, sequences and bound of the group.

    Pieces that come in sequences (was, at) stay in them unless fewer are needed.
    """
    group = group.sort_values(["length", "deal", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable")
    lengths = group["length"].to_numpy()
    which, offset = best_fit(lengths, size)
    if "was" in group:
        given = pd.factorize(group["was"])[0]
        if which.max() >= given.max():
            which, offset = given, group["at"].to_numpy()
    room = size - np.bincount(which, weights=lengths).astype(np.int64)
    return group.assign(local=which, offset=offset, room=room[which], made=which.max() + 1, bound=lower_bound(lengths, size))


PACKED = PIECES + ", grp bigint, local bigint, offset bigint, room bigint, made bigint, bound bigint"


def _group(deal: str, groups: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(deal, F.lit(salt)), F.lit(groups))


def _packed(pieces: DataFrame, groups: int, salt: int, size: int) -> DataFrame:
    # a sequence goes to one group as a whole
    dealt = pieces.withColumn("grp", _group("was" if "was" in pieces.columns else "deal", groups, salt))
    return dealt.groupBy("grp").applyInPandas(lambda g: _pack(g, size)[[c.split()[0] for c in PACKED.split(", ")]], PACKED)


def certificate(packed: DataFrame) -> DataFrame:
    """For each group: the sequences it made and the bound below which no packing of it goes."""
    return packed.groupBy("grp").agg(F.max("made").alias("made"), F.max("bound").alias("bound"))


def _roomiest(packed: DataFrame, share: int = OPEN_SHARE) -> DataFrame:
    """Of each group with a gap, the sequences with most room: ``share`` for each sequence above the bound."""
    by_room = Window.partitionBy("grp").orderBy(F.desc("room"), "local")
    open_ = packed.filter("made > bound").select("grp", "local", "room", "made", "bound").distinct()
    ranked = open_.withColumn("rank", F.row_number().over(by_room))
    return ranked.filter(F.col("rank") <= (F.col("made") - F.col("bound")) * share).select("grp", "local")


def pack(pieces: DataFrame, size: int = SEQUENCE, per_group: int = PER_GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces."""
    names = pieces.columns
    pieces = materialize(pieces, "packing-pieces")
    alone = pieces.filter(F.col("length") == size).withColumns(
        {"sequence_id": F.lit(-1) - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )

    def packed(rest: DataFrame, turn: int) -> DataFrame:
        groups = max(1, -(-rest.count() // per_group))
        number = F.lit(turn << 48).cast("bigint") + F.col("grp") * (1 << 20) + F.col("local")
        return materialize(_packed(rest, groups, turn, size).withColumn("sequence_id", number), f"packing-{turn}")

    current = packed(pieces.filter(F.col("length") < size), 0)
    done = [alone]
    for turn in count(1):
        back = materialize(_roomiest(current), f"packing-back-{turn}")
        given = back.count()
        if not given:
            break
        pool = current.join(back, ["grp", "local"], "left_semi").select(*names, F.col("sequence_id").alias("was"), F.col("offset").alias("at"))
        again = packed(pool, turn)
        needed = certificate(again).agg(F.coalesce(F.sum("made"), F.lit(0))).first()[0]
        if needed >= given:
            break
        done.append(current.join(back, ["grp", "local"], "left_anti"))
        current = again
    done.append(current)
    columns = [*names, "sequence_id", "offset"]
    return reduce(DataFrame.unionByName, [d.select(columns) for d in done])


def best_fit_sequences(docs: DataFrame, ranks_path: str, pattern: str, whole_path: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(docs, ranks_path, pattern, whole_path)).drop("deal")
