"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Spans of fixed patterns are found in every text.  Their values are candidates,
and so are long tokens of letters and digits that look live: each is hashed,
and for each hash the distinct owners and repositories that hold it are
counted over the whole corpus.  A candidate that more than ``max_owners``
owners or ``max_repositories`` repositories hold is a widely copied example,
any other is its owners' own.  An own token is added as an ``owned`` span;
spans of the patterns stay either way, and are told apart by counts.  Counting goes from (hash, owner, repository) over (hash, owner) to
(hash), each step combined before it is dealt out, so a token that a third
of all documents share is one row of each task.

Null text counts as empty and has no spans; a null source is an owner of its
own.  Repeated rows get equal results.  Positions are code points, the end is
exclusive.  A text may hold any number of matches: their positions are running
sums over blocks.  Rows travel in structs, so other columns' names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday.llm.joins import split_join
from zoneday.session import materialize

# The patterns of the base kinds, in the order in which they are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of 18 and more; shorter runs fail as a whole
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "owned")
ASSIGN_LEAST = 12
# end of fixed values
TOKEN = r"[A-Za-z0-9_-]{20,}"
BLOCK = 256
MAX_OWNERS = 2
MAX_REPOSITORIES = 16


def _running(x: Column) -> Column:
    """Running sums of a short array."""
    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, v: F.struct((acc["total"] + v).alias("total"), F.concat(acc["out"], F.array(acc["total"] + v)).alias("out"))
    return F.aggregate(x, start, step)["out"]


def running_sums(x: Column) -> Column:
    """Running sums of an array of any length: within blocks, then over the blocks' totals."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda b: _running(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))
    # the sum before each block: the running sums of the totals, one block later
    before = lambda inner: _running(F.concat(F.array(F.lit(0)), F.transform(inner, lambda a: F.element_at(a, -1))))
    whole = F.flatten(F.zip_with(blocks, F.slice(before(blocks), 1, F.size(blocks)), lambda a, o: F.transform(a, lambda v: v + o)))
    return F.when(F.size(x) > 0, whole).otherwise(F.array().cast("array<int>"))


def find(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds for each pattern an array of (start, end, hit), one for each leftmost non-overlapping match."""
    for name, p in patterns.items():
        has = F.col(text).rlike(p)
        rows = rows.withColumn(f"{name}_hit", F.when(has, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn(
            f"{name}_gap",
            F.when(F.size(f"{name}_hit") > 0, F.transform(F.split(F.col(text), p, -1), F.char_length)).otherwise(F.array().cast("array<int>")),
        )
    for name in patterns:
        hit, gap = F.col(f"{name}_hit"), F.col(f"{name}_gap")
        rows = rows.withColumn(f"{name}_step", F.zip_with(F.slice(gap, 1, F.size(hit)), hit, lambda g, h: g + F.char_length(h)))
    for name in patterns:
        rows = rows.withColumn(f"{name}_end", running_sums(F.col(f"{name}_step")))
    for name in patterns:
        rows = rows.withColumn(
            name,
            F.zip_with(
                F.col(f"{name}_end"),
                F.col(f"{name}_hit"),
                lambda e, h: F.struct((e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("hit")),
            ),
        ).drop(f"{name}_hit", f"{name}_gap", f"{name}_step", f"{name}_end")
    return rows


def _marks(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def looks_live(token: Column) -> Column:
    """Letters and at least two digits mixed, and no long run of one character."""
    return token.rlike("[A-Za-z]") & token.rlike("[0-9][^0-9]*[0-9]") & ~token.rlike(r"(.)\1{5}")


def candidates(docs: DataFrame, doc_id: Column, text: Column, source: Column) -> DataFrame:
    """Per document: its key, owner and repository, the base spans, and the candidates with the hashes of their values.

    A source named ``owner/repository`` belongs to that owner; any other source is its own owner.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    repository = F.coalesce(source.cast("string"), F.lit(""))
    rows = docs.select(
        doc_id.cast("bigint").alias("id"),
        F.xxhash64(text).alias("key"),
        repository.alias("repository"),
        F.substring_index(repository, "/", 1).alias("owner"),
        text.alias("whole"),
    )
    rows = find(rows, "whole", {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN}).drop("whole")
    value = lambda s: F.regexp_extract(s["hit"], ASSIGN, 2)
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    candidate = lambda s, v, base: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.sha2(v, 256).alias("hash"), F.lit(base).alias("base")
    )
    return rows.select(
        "id",
        "key",
        "repository",
        "owner",
        bare(F.filter("assign", lambda s: F.char_length(value(s)) >= ASSIGN_LEAST)).alias("assign"),
        bare(F.col("access")).alias("access"),
        bare(F.col("hex")).alias("hex"),
        F.concat(
            F.transform(F.filter("token", lambda s: looks_live(s["hit"])), lambda s: candidate(s, s["hit"], False)),
            F.transform(F.filter("assign", lambda s: F.char_length(value(s)) >= ASSIGN_LEAST), lambda s: candidate(s, value(s), True)),
            F.transform(F.concat("access", "hex"), lambda s: candidate(s, s["hit"], True)),
        ).alias("token"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate hash: how many owners and repositories hold it."""
    held = found.select("owner", "repository", F.explode(F.array_distinct(F.transform("token", lambda t: t["hash"]))).alias("hash"))
    by_owner = held.distinct().groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(
    docs: DataFrame, doc_id: Column, text: Column, source: Column, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES
) -> DataFrame:
    """Per document: id, key, its base spans by kind, ``owned`` spans, and how many tokens and base values are own or copied."""
    found = materialize(candidates(docs, doc_id, text, source), "secret-candidates")
    counts = ownership(found)
    tokens = found.filter(F.size("token") > 0).select("id", "key", F.explode("token").alias("t")).select("id", "key", "t.*").distinct()
    own = ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).alias("own")
    judged = split_join(tokens, counts, "hash").select("id", "key", F.struct("start", "end").alias("span"), "base", own)
    per_doc = judged.groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).agg(
        F.collect_list(F.when(F.col("own") & ~F.col("base"), F.col("span"))).alias("owned"),
        F.count_if(~F.col("own") & ~F.col("base")).alias("n_copied"),
        F.count_if(F.col("own") & F.col("base")).alias("n_base_own"),
        F.count_if(~F.col("own") & F.col("base")).alias("n_base_copied"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    counted = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_copied", "n_base_own", "n_base_copied")]
    return found.join(per_doc, (found["key"] == per_doc["of_key"]) & found["id"].eqNullSafe(per_doc["of"]), "left").select(
        "id", "key", "assign", "access", "hex", F.coalesce("owned", none).alias("owned"), *counted
    )


def secrets(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied, n_base_own, n_base_copied."""
    found = scan(docs, F.col("doc_id"), F.col("text"), F.col("source"), max_owners, max_repositories)
    base = F.concat(*(_marks(F.col(k), k) for k in KINDS[:3]))
    return found.select(
        F.col("id").alias("doc_id"),
        *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, _marks(F.col("owned"), "owned"))).alias("spans"),
        F.size("owned").cast("bigint").alias("n_owned"),
        *(F.col(c).cast("bigint").alias(c) for c in ("n_copied", "n_base_own", "n_base_copied")),
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]", max_owners: int = MAX_OWNERS) -> DataFrame:
    """The documents with every span replaced by ``mark``; overlapping spans become one mark.

    Where the table has n_chars, it is counted anew for changed texts.
    """
    found = scan(docs, F.col("doc_id"), F.col("text"), F.col("source"), max_owners)
    bare = "array<struct<start:int,end:int>>"
    spans = found.select("id", "key", F.array_sort(F.concat(*(F.col(k).cast(bare) for k in KINDS))).alias("spans")).filter(F.size("spans") > 0).distinct()
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    joined = rows.join(spans, (F.xxhash64(text) == spans["key"]) & F.col("row.doc_id").cast("bigint").eqNullSafe(spans["id"]), "left")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        kept = F.call_function("substring", text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(kept, F.lit(mark)))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    finish = lambda acc: F.concat(F.array_join(acc["out"], ""), F.call_function("substring", text, acc["at"] + 1, F.char_length(text)))
    clean = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.aggregate("spans", start, step, finish))
    out = joined.select(F.col("row"), clean.alias("clean"), F.col("spans").isNotNull().alias("changed"))
    cells = []
    for c in docs.columns:
        cell = F.col("row").getField(c)
        if c == "text":
            cell = F.col("clean")
        elif c == "n_chars":
            cell = F.when(F.col("changed"), F.char_length("clean").cast(docs.schema[c].dataType)).otherwise(cell)
        cells.append(cell.alias(c))
    return out.select(*cells)
