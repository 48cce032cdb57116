"""Operator 13, the trie of conversation prefixes, by smallest-member ownership.

A node is a sequence of turns that conversations start with; its key is its depth and two running checksums of the
turns, so no prefix is ever spelled out. Every node is owned by its smallest member. As members only fall away with
depth, a conversation owns a suffix of its own path: windows over the path mark it and sum it up from the end. What a
node's subtree holds is then a sum over its members, in one group-by of the prefixes: tokens of every occurrence, less
tokens of the nodes that members own, and one flag for every leaf. Nothing walks the trie.

A conversation may be of any length: its turns are numbered in sorted blocks, and running values are taken in segments
of its path whose totals are carried over, so no task holds a whole one. Texts never leave the scan; only checksums do.
Two 64-bit checksums tell sequences apart; that two different ones agree in both is not looked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.storage import written

#: Turns of a path in one window, and consecutive ids whose list is put together before it is hashed.
SEGMENT, IDS = 4096, 4096
KEY = ["depth", "k1", "k2"]


def turns(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Columns ``conv, place, t1, t2, tokens``: every turn of a conversation with its place from 0 on.

    Turns are dealt by ranges of the order, numbered in their block, and moved on by what earlier blocks hold of the
    same conversation: one row a conversation and block, so a long conversation is no single task's.
    """
    said, spoken = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), spoken.alias("role"), said.alias("text"), F.length(said).cast("long").alias("tokens")
    )
    sums = [F.xxhash64(F.lit(seed), "role", "text").alias(name) for seed, name in ((11, "t1"), (13, "t2"))]
    rows = rows.select("conv", "turn", "role", *sums, "tokens", F.monotonically_increasing_id().alias("row"))
    order = [F.col("turn").asc_nulls_first(), "role", "t1", "t2", "row"]
    dealt = written(rows.repartitionByRange("conv", *order).withColumn("block", F.spark_partition_id()), "turn-blocks")
    counts = dealt.groupBy("conv", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv", "block").orderBy(*order)
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1).join(moved, ["conv", "block"])
    return numbered.select("conv", (F.col("place") + F.col("before")).alias("place"), "t1", "t2", "tokens")


def shared_openings(own: DataFrame, *, every: int = 100, longest: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % every, then the own turns after the first h.

    h is the crc32 of the id as text, modulo ``longest``. Columns ``conv, depth, t1, t2, tokens``, depths from 1 on;
    every conversation has a row of depth 0 besides, whose checksums and tokens are 0.
    """
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % longest).alias("h")
    convs = own.groupBy("conv").agg(F.count("*").alias("n")).select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), head)
    opening = own.where(F.col("place") < longest - 1).select(F.col("conv").alias("base"), "place", "t1", "t2", "tokens")
    lent = convs.join(opening, "base").where("place < h").select("conv", (F.col("place") + 1).alias("depth"), "t1", "t2", "tokens")
    sizes = opening.groupBy("base").agg(F.count("*").alias("there"))
    start = convs.join(sizes, "base", "left").select("conv", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("lent"))
    kept = own.join(start, "conv").where("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("lent") + 1).alias("depth"), "t1", "t2", "tokens")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), zero.alias("tokens"))
    return lent.unionByName(kept).unionByName(roots).select("conv", F.col("depth").cast("long").alias("depth"), "t1", "t2", "tokens")


def paths(rebuilt: DataFrame) -> DataFrame:
    """Every node of every path: ``conv, depth, k1, k2, rest, end``; equal keys are equal sequences of turns.

    ``rest`` counts the tokens from this turn to the end of the path, ``end`` is its depth. Running values are folded in
    segments of ``SEGMENT`` turns; what earlier segments fold to is one row a segment, folded in a window of its own.
    """
    marks = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "t1", "t2")).otherwise(F.lit(0).cast("long")).alias(f"m{i}") for i in (1, 2)]
    rows = rebuilt.select("conv", "depth", F.floor(F.col("depth") / SEGMENT).alias("segment"), *marks, "tokens")
    along = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("conv", "segment", "depth", "tokens", F.bit_xor("m1").over(along).alias("x1"), F.bit_xor("m2").over(along).alias("x2"), F.sum("tokens").over(along).alias("x3"))
    totals = rows.groupBy("conv", "segment").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"), F.sum("tokens").alias("m3"), F.max("depth").alias("top"))
    earlier = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    before = [F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"b{i}") for i, (f, c) in enumerate(((F.bit_xor, "m1"), (F.bit_xor, "m2"), (F.sum, "m3")), 1)]
    totals = totals.select("conv", "segment", *before, F.sum("m3").over(whole).alias("all"), F.max("top").over(whole).alias("end"))
    keys = [F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"k{i}") for i in (1, 2)]
    return run.join(totals, ["conv", "segment"]).select("conv", "depth", *keys, (F.col("all") - F.col("b3") - F.col("x3") + F.col("tokens")).alias("rest"), "end")


def owners(path: DataFrame) -> DataFrame:
    """What a conversation owns: ``conv, owns_from, owned, above, leaf``, for conversations that own a node.

    Its nodes lie from depth ``owns_from`` on and hold ``owned`` tokens; ``above`` owns the node before them (null at
    the root), and ``leaf`` says whether the last one has no children. The table of minima has one row a node; paths
    are joined with it, so a node that most paths share is on the side of the join that adaptive execution splits. All
    paths share the root, whose only row goes to them instead.
    """
    low = [F.min("conv").alias("owner"), F.bool_and(F.col("depth") == F.col("end")).alias("childless")]
    top, below = path.where("depth = 0"), path.where("depth > 0")
    rooted = top.crossJoin(F.broadcast(top.agg(*low)))  # one row
    owned = below.join(below.groupBy(*KEY).agg(*low), KEY)
    own = F.col("owner") == F.col("conv")
    marked = rooted.select(owned.columns).unionByName(owned).groupBy("conv").agg(
        F.min(F.when(own, F.col("depth"))).alias("owns_from"),
        F.max(F.when(own, F.col("rest"))).alias("owned"),  # tokens to the end only shrink with depth
        F.max(F.when(~own, F.struct("depth", "owner")))["owner"].alias("above"),
        F.coalesce(F.bool_or(F.when(own, F.col("childless"))), F.lit(False)).alias("leaf"),
    )
    return marked.where("owns_from IS NOT NULL")


def id_digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: digests of the ids of conversations that end in a node, ascending.

    Ids are listed in runs of ``IDS`` numbers by Spark; a task then reads the runs of a node in order and feeds them
    to the digest one by one, holding one run at a time, however many conversations end there.
    """
    runs = ends.groupBy(*KEY, F.floor(F.col("conv") / IDS).alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    sorted_runs = runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").select(*KEY, "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and row[:3] != now:
                    done.append((*now, state.hexdigest()))
                    state = hashlib.sha256()
                elif now is not None:
                    state.update(b",")
                state.update(row[3].encode())
                now = row[:3]
            yield _digests(done)
        yield _digests([(*now, state.hexdigest())] if now is not None else [])

    return sorted_runs.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=[*KEY, "ends_sha256"])


def trie(rebuilt: DataFrame) -> DataFrame:
    """Every node of the trie of ``conv, depth, t1, t2, tokens`` (one row of depth 0 a conversation, and its turns).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, as the module's head explains them.
    """
    path = written(paths(rebuilt), "trie-paths")
    own = written(owners(path), "trie-owners")
    mine = F.coalesce(F.col("owns_from") <= F.col("depth"), F.lit(False))
    parent = F.when(mine, F.when(F.col("owns_from") < F.col("depth"), F.col("conv")).otherwise(F.col("above")))  # one member owns a node
    child = (F.col("depth") < F.col("end")) & F.coalesce(F.col("owns_from") <= F.col("depth") + 1, F.lit(False))
    owned = F.when(mine, F.col("rest")).otherwise(F.coalesce("owned", F.lit(0)))
    nodes = path.join(own, "conv", "left").groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.min(parent).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(child.cast("long")).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(False)).cast("long")).alias("n_leaves"),
        F.sum(F.col("rest") - owned).alias("saved_tokens"),
    )
    ends = id_digests(path.where("depth = end").select("conv", *KEY))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(ends, KEY, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def shared_prefixes(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of all conversations of a table, each rebuilt by ``shared_openings``.

    Turns stand in the order of ``turn``, null first; equal ones by role and then by checksums of their texts. A null
    role or text is an empty one. Rows without a conversation id belong to none and are left out. Repeated rows are
    turns of their own. A conversation that keeps no turn is a member of the root alone. An empty table has no nodes.
    Other columns are left out, so their names cannot clash. Ids are integers.
    """
    return trie(shared_openings(turns(conversations, conv_id=conv_id, turn=turn, role=role, text=text)))
