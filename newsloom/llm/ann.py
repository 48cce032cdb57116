"""Operator 8, approximate nearest neighbours by a hierarchical k-means tree.

The tree is built on the driver from a bounded sample. Every row goes down to its nearest leaf and is stored there.
A query walks the tree best bin first: a priority queue holds the branches not taken, nearest first, and leaves are
visited from it until their number reaches the one that gave the wanted recall on the sample. Distances to all rows
of a visited leaf are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows in the sample, children of a node, sample rows in a leaf, and queries that calibrate the search.
SAMPLE, BRANCH, LEAF, PROBES = 50_000, 12, 24, 200
#: Recall wanted on the sample; rows of a bin of leaves, and queries, that one task compares; queries that walk in one task.
RECALL, CHUNK, ASKED, WALKERS = 0.97, 2048, 2048, 64


@dataclass
class Tree:
    """Nodes as flat arrays: centre, first child, number of children (0 in a leaf) and the leaf's number."""

    centre: list[np.ndarray] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    width: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    visits: int = 1
    stacked: dict[int, np.ndarray] = field(default_factory=dict)

    def leaves(self) -> int:
        return max(self.leaf, default=0) + 1

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: down to the nearest child at every node."""
        node = np.zeros(len(points), np.int64)
        out = np.zeros(len(points), np.int64)
        todo = {0: np.arange(len(points))}
        while todo:
            at, rows = todo.popitem()
            if not self.width[at]:
                out[rows] = self.leaf[at]
                continue
            kids = np.arange(self.first[at], self.first[at] + self.width[at])
            near = kids[nearest(points[rows], np.stack([self.centre[k] for k in kids]))]
            node[rows] = near
            for k in np.unique(near).tolist():
                todo[k] = rows[near == k]
        return out

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves from the most promising one on."""
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            while self.width[at]:
                kids = range(self.first[at], self.first[at] + self.width[at])
                if at not in self.stacked:
                    self.stacked[at] = np.stack(self.centre[kids.start : kids.stop])
                gaps = ((self.stacked[at] - query) ** 2).sum(1).tolist()
                best = min(range(len(gaps)), key=gaps.__getitem__)
                for i, k in enumerate(kids):
                    if i != best:
                        heapq.heappush(queue, (gaps[i], k))
                at = kids[best]
            yield self.leaf[at]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centre is nearest to each point; the first of equals."""
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, 1)


def build(points: np.ndarray, *, branch: int = BRANCH, leaf: int = LEAF, recall: float = RECALL, k: int = 10, seed: int = 11) -> Tree:
    """The tree of a sample, with the number of leaves to visit for the wanted recall on it."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    tree = Tree()

    def add(centre: np.ndarray) -> int:
        tree.centre.append(centre)
        tree.first.append(0)
        tree.width.append(0)
        tree.leaf.append(-1)
        return len(tree.centre) - 1

    add(points.mean(0) if len(points) else np.zeros(1))
    todo, leaves = [(0, points)], 0
    while todo:
        at, own = todo.pop()
        if len(own) > leaf:
            centres = own[rng.choice(len(own), branch, replace=False)]
            for _ in range(8):
                by = nearest(own, centres)
                centres = np.stack([own[by == c].mean(0) if (by == c).any() else centres[c] for c in range(len(centres))])
            by = nearest(own, centres)
            used = [c for c in range(len(centres)) if (by == c).any()]
            if len(used) > 1:
                tree.first[at], tree.width[at] = len(tree.centre), len(used)
                todo += [(add(centres[c]), own[by == c]) for c in used]
                continue
        tree.leaf[at], leaves = leaves, leaves + 1
    if len(points) > k + 1:
        home = tree.assign(points)
        tried = points[rng.choice(len(points), min(PROBES, len(points)), replace=False)]
        ranks = []
        for q in tried:
            found = np.argsort(((points - q) ** 2).sum(1), kind="stable")[1 : k + 1]
            place = np.empty(leaves, np.int64)
            place[list(tree.walk(q))] = np.arange(leaves)
            ranks.append(place[home[found]])
        order = np.sort(np.concatenate(ranks))
        tree.visits = int(order[min(len(order) - 1, int(np.ceil(recall * len(order))) - 1)]) + 1
    return tree


def packed(sizes: list[int], most: int) -> tuple[list[int], list[int]]:
    """The bin of every leaf, and the parts of every bin: neighbouring leaves share a bin of ``most`` rows, a larger leaf
    has one of its own that is dealt into parts of as many."""
    bins, parts, rows = [], [], most + 1
    for n in sizes:
        if rows + n > most:
            parts.append(1)
            rows = 0
        rows += n
        parts[-1] = max(1, -(-rows // most))
        bins.append(len(parts) - 1)
    return bins, parts


def usable(vector: Column, size: int) -> Column:
    """Whether a vector takes part: of the usual length, all components there and finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == size) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(vectors: DataFrame, queries: Column, *, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """The k nearest rows of each query row: ``query_id, rank, vec_id, score`` by Euclidean distance.

    ``queries`` is a condition on ``vectors``; every other row is a candidate. Equal distances go to the smaller
    vec_id. Rows whose vector is null, zero, of another length than most, or holds null or non-finite components
    take no part, nor do rows without an id. If an id is on several query rows, its smallest vector is searched;
    repeated candidate rows count each. With fewer candidates than k all of them are returned; an empty table gives
    an empty result. Other columns are left out, so their names cannot clash.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), queries.alias("q")).where("vec_id IS NOT NULL")
    kind = base.schema["vec_id"].dataType.simpleString()
    schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
    lengths = base.where("v IS NOT NULL").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths or not lengths[0]["n"]:
        return spark.createDataFrame([], schema)
    base = base.where(usable(F.col("v"), lengths[0]["n"]))
    rows = base.count()
    if not rows:
        return spark.createDataFrame([], schema)
    share = min(1.0, sample / rows)
    taken = base.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("v").limit(2 * sample).toPandas()
    points = np.array(taken["v"].tolist(), float) if len(taken) else np.zeros((0, lengths[0]["n"]))
    tree = spark.sparkContext.broadcast(build(points, recall=recall, k=k))  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.asarray(batch.column(1).flatten(), float).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(tree.value.assign(points), pa.int32())], names=["vec_id", "v", "q", "leaf"])

    placed = base.mapInArrow(place, f"vec_id {kind}, v array<double>, q boolean, leaf int")
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row a leaf
    bins, parts = packed([held.get(i, 0) for i in range(tree.value.leaves())], CHUNK)
    shared = spark.sparkContext.broadcast((np.array(bins), np.array(parts), np.array([held.get(i, 0) for i in range(len(bins))])))  # a value a leaf
    asked = base.where("q").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    n_asked = asked.count()
    deals = max(1, -(-n_asked // ASKED))
    homes = spark.createDataFrame([(i, int(b), int(parts[b])) for i, b in enumerate(bins)], "leaf int, bin int, parts int")  # a row a leaf
    stored = placed.join(F.broadcast(homes), "leaf").select("vec_id", "v", "leaf", "bin", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bin_of, parts_of, count = shared.value
        for batch in batches:
            points = np.asarray(batch.column(1).flatten(), float).reshape(batch.num_rows, -1)
            rows: list[tuple[int, int, int, np.ndarray]] = []
            for i in range(batch.num_rows):
                seen, found = [], 0
                for leaf in tree.value.walk(points[i]):
                    if len(seen) >= tree.value.visits and found > k:
                        break
                    seen.append(leaf)
                    found += int(count[leaf])
                leaves = np.sort(np.array(seen, np.int32))
                for own in np.split(leaves, np.flatnonzero(np.diff(bin_of[leaves])) + 1):
                    rows += [(i, int(bin_of[own[0]]), part, own) for part in range(int(parts_of[bin_of[own[0]]]))]
            at, bin_, part, leaves_ = ([r[j] for r in rows] for j in range(4))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(bin_, pa.int32()), pa.array(part, pa.int32()), pa.array(leaves_, pa.list_(pa.int32()))], names=["query_id", "v", "bin", "part", "leaves"])

    visits = asked.repartition(max(1, -(-n_asked // WALKERS))).mapInArrow(visit, f"query_id {kind}, v array<double>, bin int, part int, leaves array<int>")
    visits = visits.withColumn("deal", F.pmod(F.xxhash64("query_id"), F.lit(deals)).cast("int"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        asks, found, scores = [], [], []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            ids, leaf, points = right["vec_id"].to_numpy(), right["leaf"].to_numpy(), np.array(right["v"].tolist(), float)
            for query, v, leaves in zip(left["query_id"].to_numpy(), left["v"], left["leaves"], strict=True):
                take = np.flatnonzero(np.isin(leaf, leaves) & (ids != query))
                gaps = np.sqrt(((points[take] - np.asarray(v)) ** 2).sum(1))
                best = np.argsort(gaps, kind="stable")[:k]
                asks.append(np.repeat(query, len(best)))
                found.append(ids[take[best]])
                scores.append(gaps[best])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in (asks, found, scores)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    one = ("bin", "part", "deal")
    near = visits.groupBy(*one).cogroup(stored.groupBy(*one)).applyInPandas(compare, f"query_id {kind}, vec_id {kind}, score double")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
