"""Operator 1, n-gram Jaccard join by token-combination prefixes.

A document is the set of its word shingles. Two sets of Jaccard similarity 3/4 share a token in their prefixes, in any
order of tokens that all sets follow. The order here puts rare tokens before frequent ones. Where a prefix has rare
tokens only, these are indexed one by one. A prefix that reaches into the frequent class is extended, and there pairs
of tokens are indexed: the class is dealt into as many parts as the extension has tokens, so two similar sets share at
least two tokens of one part. Pairs are formed within parts only, which keeps their number linear in the prefix.

Candidates are verified exactly. To lose no link and yet not pair off large groups, an index entry first links its
members to its smallest one; then only members that are still in different components meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from newsloom.llm.columns import let
from newsloom.llm.components import connected_components
from newsloom.llm.quality import mix
from newsloom.llm.shingles import Shingler
from newsloom.llm.storage import written
from newsloom.llm.words import chunks, expand, held, trimmed

#: Tokens in more documents than FREQUENT are of the frequent class, of which the FREQUENT_TOKENS most frequent ones at
#: most are told apart (8 bytes each, broadcast); any other token counts as rare, which changes costs, never results.
FREQUENT, FREQUENT_TOKENS, COUNTED = 64, 1 << 20, 1 << 18
#: Index entries that one task takes, pairs of one document that one task verifies, bits of a parity sketch per token.
BUCKET_ENTRIES, PAIRS_A_TASK, SKETCH_BITS = 500_000, 256, 4
#: Characters of text that a task cuts into shingles at a time; its arrays take some fifty bytes for each.
CHUNK = 400_000
#: 64-bit words of a sketch that members of an index entry carry with them.
BRIEF = 16
#: Ids up to which a set of documents goes out as a broadcast (8 bytes each); beyond it joins are by shuffle.
BROADCAST_IDS = 1_000_000
#: Members of an index entry that meet others in one block.
ENTRY_SIDE = 512


class HeavyCounter:
    """Counts of the most frequent keys in bounded memory (Misra and Gries); a count may fall short, never exceed."""

    def __init__(self, limit: int = COUNTED):
        self.limit, self.keys, self.counts = limit, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        new, counts = np.unique(keys, return_counts=True)
        every, at = np.unique(np.r_[self.keys, new], return_inverse=True)
        total = np.bincount(at, np.r_[self.counts, counts], len(every)).astype(np.int64)
        if len(every) > self.limit:
            total -= np.partition(total, len(total) - self.limit - 1)[len(total) - self.limit - 1]
            every, total = every[total > 0], total[total > 0]
        self.keys, self.counts = every, total


def prefix_sizes(sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Tokens of each set of which similar sets share one: n less the least overlap, plus one."""
    return np.where(sizes > 0, sizes - -(-num * sizes // den) + 1, 0)


def size_class(sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Classes such that sets of similar sizes are in one class or in two neighbouring ones."""
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(den / num) + 1e-9).astype(np.int64)


def single_entries(tokens: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Rare tokens in the prefixes of sets (each in ascending order): (token, set's number)."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    rare = ~is_in(tokens, frequent)
    before = np.cumsum(rare) - rare
    place = before - before[np.repeat(np.cumsum(sizes) - sizes, sizes)]
    take = rare & (place < np.repeat(prefix_sizes(sizes, num, den), sizes))
    return tokens[take], doc[take]


def pair_entries(tokens: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of frequent tokens in the extended prefixes that reach into that class: (hash of the pair, set's number)."""
    often = is_in(tokens, frequent)
    ends = np.cumsum(sizes)
    heavy = np.bincount(np.repeat(np.arange(len(sizes)), sizes), often, len(sizes)).astype(np.int64) if len(tokens) else np.zeros(len(sizes), np.int64)
    prefixes, classes = prefix_sizes(sizes, num, den), size_class(sizes, num, den)
    keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i in np.flatnonzero(sizes - heavy < prefixes).tolist():
        own = slice(ends[i] - sizes[i], ends[i])
        mine = tokens[own][often[own]]
        rare = int(sizes[i]) - len(mine)
        for c in (int(classes[i]), int(classes[i]) + 1):
            parts = max(1, int((den / num) ** c / 16))
            taken = mine[: int(prefixes[i]) - rare + parts]
            part = (mix(taken + np.uint64(1)) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            taken, part = taken[by], part[by]
            last = np.searchsorted(part, part, "right")
            n = last - np.arange(len(part)) - 1
            first = np.repeat(np.arange(len(part)), n)
            second = expand(np.arange(len(part)) + 1, n)
            keys.append(mix(taken[first] * np.uint64(0x9E3779B97F4A7C15) + taken[second] + np.uint64(c)))
            owner.append(np.full(len(first), i))
    return np.concatenate(keys), np.concatenate(owner)


def is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in an ascending table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _shingler(width: int) -> Shingler:
    return held(("shingler", width), lambda: Shingler(width))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """One pass over all texts. Rows with ``doc``: set size, two hashes of the set and a parity sketch; rows without:
    a token and how often this task saw it, at least twice.

    A sketch is as long as its set asks for, rounded up to a power of two, so its halves laid over each other are the
    sketch of half the length.
    """
    names = ["doc", "n", "k1", "k2", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counter = _shingler(width), HeavyCounter()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts, CHUNK):
                tokens, sizes = shingler.sets(texts[a:b])
                counter.add(tokens)
                sums = np.zeros((2, len(tokens) + 1), np.uint64)
                np.cumsum(mix(tokens ^ np.uint64(0x1234567)), out=sums[0, 1:])
                np.cumsum(mix(mix(tokens) + np.uint64(77)), out=sums[1, 1:])
                ends = np.cumsum(sizes)
                keys = [s[ends] - s[ends - sizes] for s in sums]
                longs = 1 << np.ceil(np.log2(np.maximum(sizes * SKETCH_BITS / 64, 1))).astype(np.int64)
                begin = np.cumsum(longs) - longs
                bit = (tokens >> np.uint64(9)).astype(np.int64) & np.repeat(64 * longs - 1, sizes)
                odd = (np.bincount(bit + np.repeat(64 * begin, sizes), minlength=64 * int(longs.sum())) & 1).astype(np.uint8)
                sketch = pa.ListArray.from_arrays(pa.array(np.r_[begin, longs.sum()], pa.int32()), pa.array(np.packbits(odd).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes), *map(_signed, keys), sketch], names=names)
        often = counter.counts > 1
        k = int(often.sum())
        none = pa.nulls(k, pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(counter.counts[often]), _signed(counter.keys[often]), none, pa.nulls(k, pa.list_(pa.int64()))], names=names)

    return docs.mapInArrow(trimmed(run), "doc long, n long, k1 long, k2 long, sketch array<long>")


def _narrow(docs: DataFrame, ids: DataFrame, how: str, id_: str = "doc") -> DataFrame:
    """Documents whose id is (``left_semi``) or is not (``left_anti``) among ids; these go out if they are few."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, id_, how)


def entries(docs: DataFrame, frequent, width: int, num: int, den: int, buckets: int) -> DataFrame:
    """Index entries of rare tokens, packed by hash range: ``bucket, packed`` of (token, doc) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(width)
        for batch in batches:
            texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(texts, CHUNK):
                tokens, doc = single_entries(*shingler.sets(texts[a:b]), frequent.value, num, den)
                bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                packed = np.stack([tokens[by], ids[a:b][doc[by]].astype(np.int64).view(np.uint64)], 1)
                found, first = np.unique(bucket[by], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([x.tobytes() for x in np.split(packed, first[1:])][: len(found)], pa.binary())], names=["bucket", "packed"])

    return docs.mapInArrow(trimmed(run), "bucket int, packed binary")


def shared_entries(group: pa.Table) -> pa.Table:
    """Entries of a bucket that several documents share: ``sig, doc, hub``, the hub being the smallest of them.

    Entries of the same documents are one: ``sig`` is a hash of the documents, not of what they share.
    """
    raw = b"".join(group.column("packed").to_pylist())
    packed = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    sig, doc = packed[:, 0], packed[:, 1].view(np.int64)
    by = np.lexsort((doc, sig))
    sig, doc = sig[by], doc[by]
    keep = np.ones(len(sig), bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
    sig, doc = sig[keep], doc[keep]
    start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[start, len(sig)])
    hub = np.repeat(doc[start], sizes)
    group = mix(np.add.reduceat(mix(doc.view(np.uint64) + np.uint64(11)), start) + sizes.astype(np.uint64)) if len(sig) else sig
    once = np.zeros(len(start), bool)
    once[np.unique(group, return_index=True)[1]] = True
    take = np.repeat((sizes > 1) & once, sizes)
    return pa.table({"sig": np.repeat(group, sizes)[take].view(np.int64), "doc": doc[take], "hub": hub[take]})


def frequent_entries(group: pa.Table) -> pa.Table:
    """Tokens of a bucket that are entries of more than FREQUENT documents: ``k1, df``."""
    token, counts = np.unique(np.frombuffer(b"".join(group.column("packed").to_pylist()), np.uint64).reshape(-1, 2)[:, 0], return_counts=True)
    many = counts > FREQUENT
    return pa.table({"k1": token[many].view(np.int64), "df": counts[many].astype(np.int64)})


def combinations(docs: DataFrame, frequent, width: int, num: int, den: int) -> DataFrame:
    """Index entries of frequent token pairs: ``sig, doc``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(width)
        for batch in batches:
            texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(texts, CHUNK):
                sig, doc = pair_entries(*shingler.sets(texts[a:b]), frequent.value, num, den)
                yield pa.RecordBatch.from_arrays([_signed(sig), pa.array(ids[a:b][doc].astype(np.int64))], names=["sig", "doc"])

    return docs.mapInArrow(trimmed(run), "sig long, doc long")


def plausible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``a, b`` that sizes leave open, and then sketches of what is left. A sketch bit is the parity of the tokens
    that fall on it, so as many bits differ as tokens do at most."""
    na, nb = (sets.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    fit = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    pairs = written(pairs.join(na, "a").join(nb, "b").where(fit).select("a", "b", (F.col("na") + F.col("nb")).alias("n_both")).distinct(), "fitting-pairs")
    sets = _narrow(sets, pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "left_semi")
    left, right = (sets.select(F.col("doc").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    near = _differ(F.col("sa"), F.col("sb")) * (den + num) <= F.col("n_both") * (den - num)
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b").distinct()


def _differ(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ at the length of the shorter one."""

    def at(size: Column) -> Column:
        return F.aggregate(F.zip_with(_folded(a, size), _folded(b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)

    return let(F.least(F.size(a), F.size(b)), at)


def _folded(sketch: Column, size: Column) -> Column:
    """A sketch at a length that it has or has twice; sets of similar sizes differ by no more."""
    return F.when(F.size(sketch) == size, sketch).otherwise(F.zip_with(F.slice(sketch, F.lit(1), size), F.slice(sketch, size + 1, size), lambda x, y: x.bitwiseXOR(y)))


def _brief(sketch: Column) -> Column:
    """A sketch cut down to BRIEF words by laying its parts over each other; a shorter one as it is."""
    zero = F.array_repeat(F.lit(0).cast("long"), F.lit(BRIEF))
    laid = F.aggregate(F.sequence(F.lit(0), (F.size(sketch) / BRIEF).cast("int") - 1), zero, lambda a, j: F.zip_with(a, F.slice(sketch, j * BRIEF + 1, F.lit(BRIEF)), lambda x, y: x.bitwiseXOR(y)))
    return F.when(F.size(sketch) > BRIEF, laid).otherwise(sketch)


def verified(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Pairs of documents whose sets are similar: ``a, b``. Pairs meet by their first document; one with many pairs is
    dealt to several tasks."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = written(_narrow(docs, nodes, "left_semi"), "pair-texts")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_TASK).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    right = dealt.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("other")), "b").select(F.col("a").alias("hub"), F.col("part").alias("deal"), "b", "other")
    left = texts.withColumnRenamed("doc", "a").join(parts, "a").select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")

    def compare(one: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        shingler = _shingler(width)
        if len(one) and len(others):
            a = int(one["a"].iloc[0])
            hubs = [shingler.sets([t or ""])[0] for t in one["text"]]
            texts = [t or "" for t in others["other"]]
            for i, j in chunks(texts, CHUNK):
                tokens, sizes = shingler.sets(texts[i:j])
                for hub in hubs:
                    both = np.bincount(np.repeat(np.arange(j - i), sizes), is_in(tokens, hub), j - i)
                    good = (both > 0) & (den * both >= num * (len(hub) + sizes - both))
                    found += [(a, int(b)) for b in others["b"].to_numpy()[i:j][good]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return left.groupBy("a", "part").cogroup(right.groupBy("hub", "deal")).applyInPandas(compare, "a long, b long").distinct()


def open_pairs(members: DataFrame, links: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of an index entry's members that links have not joined yet: ``a, b`` with a < b.

    Members of the component that most of an entry's members are in do not meet each other; every other member meets
    those of other components whose size and brief sketch leave it open that the two are similar.
    """
    roots = connected_components(links).withColumnRenamed("node", "doc")
    placed = members.join(roots, "doc", "left").select("sig", "doc", F.coalesce("component", "doc").alias("root"))
    counts = placed.groupBy("sig", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("sig").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("k"), F.sum("n").alias("every"), F.max("n").alias("most")).where("k > 1")
    # The members that ask and those that they meet are dealt into blocks of ENTRY_SIDE; each pair of blocks is a key.
    sides = [F.ceil(c / ENTRY_SIDE).cast("int").alias(x) for x, c in (("nx", F.col("every") - F.col("most")), ("ny", F.col("every")))]
    main = written(main.select("sig", "main", *sides), "open-roots")
    placed = placed.join(main, "sig")
    brief = _narrow(sets.select("doc", "n", _brief(F.col("sketch")).alias("s")), placed.select("doc").distinct(), "left_semi")
    placed = written(placed.join(brief, "doc"), "open-entries")
    deal = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = placed.where("root <> main").select("sig", "doc", "root", "main", "n", "s", deal("nx").alias("i"), every("ny").alias("j")).alias("x")
    y = placed.select("sig", "doc", "root", "main", "n", "s", deal("ny").alias("j"), every("nx").alias("i")).alias("y")
    fit = F.least("x.n", "y.n") * den >= F.greatest("x.n", "y.n") * num
    near = _differ(F.col("x.s"), F.col("y.s")) * (den + num) <= (F.col("x.n") + F.col("y.n")) * (den - num)
    meet = x.join(y, F.expr("x.sig = y.sig AND x.i = y.i AND x.j = y.j AND x.root <> y.root AND (y.root = y.main OR x.doc < y.doc)") & fit & near)
    return meet.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def similar_groups(docs: DataFrame, *, width: int = 5, num: int = 3, den: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its group: ``doc_id, n_shingles, component_id, n_spanning``.

    Documents link when their sets of ``width``-word shingles have a Jaccard similarity of num / den or more. The
    component is the smallest doc_id that links reach, the document's own included. ``n_spanning`` counts the verified
    links between documents of different sets that span the groups; it is not the number of all links, since members
    that are joined already are not compared again. Shingles are told apart by 64-bit hashes, so similarities are
    exact but for collisions of these.

    Words are cut at ASCII blanks, A-Z in lower case. With fewer words the whole sequence is one shingle. Null or
    empty texts, and texts of blanks only, have no shingles and link with nothing. Rows with one doc_id are one
    document with several texts: they share a component. A null doc_id links with nothing and has a null component.
    Ids may be of any ordered type; those that are no whole numbers are told apart by a 64-bit hash. Other columns
    are left out, so their names cannot clash; an empty table gives an empty result.
    """
    kind = docs.schema[doc_id].dataType
    if not isinstance(kind, IntegralType):
        named = docs.select(F.col(doc_id).alias("id"), F.when(F.col(doc_id).isNotNull(), F.xxhash64(doc_id)).alias("doc"), F.col(text).alias("text"))
        groups = similar_groups(named, width=width, num=num, den=den, doc_id="doc")
        ids = named.where("id IS NOT NULL").select(F.col("doc").alias("doc_id"), "id").distinct()
        first = groups.join(ids, "doc_id").groupBy("component_id").agg(F.min("id").alias("first"))
        groups = groups.join(first, "component_id", "left").join(ids, "doc_id", "left")
        return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.col("first").alias("component_id"), "n_spanning")
    spark, kind = docs.sparkSession, kind.simpleString()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    known = docs.where("doc IS NOT NULL")
    profile = written(profiles(known, width), "profiles")
    sets = profile.where("doc IS NOT NULL")
    often = profile.where("doc IS NULL").groupBy("k1").agg(F.sum("n").alias("df")).where(F.col("df") > FREQUENT).orderBy(F.desc("df"), "k1").limit(FREQUENT_TOKENS).select("k1").toPandas()
    frequent = spark.sparkContext.broadcast(np.sort(often["k1"].to_numpy(np.int64).view(np.uint64)))

    full = sets.where("n > 0")
    # Minima are written, so that the copies of one text are the large side of the join, which Spark splits.
    first = written(full.groupBy("n", "k1", "k2").agg(F.min("doc").alias("hub"), F.max("doc").alias("top")).where("hub < top").drop("top"), "first-copies")
    copies = written(full.select("doc", "n", "k1", "k2").join(first, ["n", "k1", "k2"]).where("doc <> hub").select("doc", "hub").distinct(), "copies")
    # A document of several sets stays in the index, as some of them may have no copy.
    several = full.groupBy("doc").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high").select("doc")
    out = written(copies.select("doc").distinct().join(several, "doc", "left_anti"), "left-to-copies")
    kept = _narrow(known, out, "left_anti")

    total = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * num / den) + 1)).first()[0] or 0
    buckets = max(8, -(-int(total) // BUCKET_ENTRIES))
    # What the bounded counts above have missed shows in the entries themselves.
    more = entries(kept, frequent, width, num, den, buckets).groupBy("bucket").applyInArrow(frequent_entries, "k1 long, df long")
    more = more.orderBy(F.desc("df"), "k1").limit(FREQUENT_TOKENS).select("k1").toPandas()
    often = np.union1d(frequent.value, more["k1"].to_numpy(np.int64).view(np.uint64))
    frequent = spark.sparkContext.broadcast(often)
    rare = entries(kept, frequent, width, num, den, buckets).groupBy("bucket").applyInArrow(shared_entries, "sig long, doc long, hub long")
    if len(often):
        pairs = written(combinations(kept, frequent, width, num, den), "combinations")
        hubs = pairs.distinct().groupBy("sig").agg(F.min("doc").alias("hub"), F.max("doc").alias("top"), F.xxhash64(F.bit_xor(F.xxhash64("doc")), F.count("*")).alias("group")).where("hub < top")
        rare = rare.unionByName(pairs.join(written(hubs, "pair-hubs"), "sig").select(F.col("group").alias("sig"), "doc", "hub"))
    members = written(rare.distinct(), "entries")

    known_sets = _narrow(full, out, "left_anti")
    stars = written(plausible(members.where("doc <> hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct(), known_sets, num, den), "stars")
    links = written(verified(stars, kept, width, num, den), "links")
    rest = open_pairs(members, links, known_sets, num, den)
    rest = written(plausible(rest, known_sets, num, den).join(stars, ["a", "b"], "left_anti"), "open-pairs")
    links = written(links.unionByName(verified(rest, kept, width, num, den)).where("a <> b"), "links")

    edges = links.unionByName(copies.select(F.col("hub").alias("a"), F.col("doc").alias("b")))
    groups = connected_components(edges)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_spanning"))
    out = sets.select("doc", F.col("n").alias("n_shingles")).join(groups, F.col("doc") == F.col("node"), "left").drop("node")
    out = out.join(degree, F.col("doc") == F.col("node"), "left")
    out = out.select(F.col("doc").cast(kind).alias("doc_id"), "n_shingles", F.coalesce("component", "doc").cast(kind).alias("component_id"), F.coalesce("n_spanning", F.lit(0)).cast("long").alias("n_spanning"))
    lost = profiles(docs.where("doc IS NULL").select(F.lit(0).cast("long").alias("doc"), "text"), width).where("doc IS NOT NULL")
    null = F.lit(None).cast(kind)
    return out.unionByName(lost.select(null.alias("doc_id"), F.col("n").alias("n_shingles"), null.alias("component_id"), F.lit(0).cast("long").alias("n_spanning")))


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of the document with the smallest id of each group, with all their columns, whatever their names.

    Rows without an id stay, as do null and empty texts, which are in no group. Several rows of one id are one document:
    they stay or go together. An empty table stays empty.
    """
    groups = similar_groups(docs, doc_id=doc_id, text=text, **options)
    gone = written(groups.where("component_id < doc_id").select("doc_id").distinct(), "near-copies")
    few = gone.count() <= BROADCAST_IDS
    return docs.alias("o").join((F.broadcast(gone) if few else gone).alias("g"), F.col(f"o.{doc_id}") == F.col("g.doc_id"), "left_anti")
