"""Operator 11, codes of vectors: parts of a vector are replaced by the number of their nearest codebook entry.

Components become integers, so every distance is exact. At each part position a ball tree over the entries (at most
``ENTRIES``) finds the nearest one by branch and bound: a ball is entered unless its nearest possible point is farther
than the best entry so far. Radii are rounded up and bounds down, equality enters, and what a leaf holds is compared in
integers, so ties go to the lower index exactly as in a search through all entries. Tasks return sums of parts per
entry; only those (parts x entries rows) reach the driver between rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.columns import unused
from newsloom.llm.storage import written
from newsloom.llm.words import trimmed

#: Parts of a vector, entries of a codebook, rounds of training, steps of one unit, and entries in a leaf of a tree.
PARTS, ENTRIES, ROUNDS, SCALE, LEAF = 16, 64, 2, 256, 4
#: Vectors handled at a time, and the largest component: sums of squares of up to 64 such differences fit 64 bits.
CHUNK, LARGEST = 4096, 1 << 27
#: Share by which bounds in floating point are widened; double precision errs by far less.
SLACK = 2.0**-40


@dataclass
class Ball:
    """A ball around some entries: an integer centre, a radius rounded up, and either two halves or the entries."""

    centre: np.ndarray
    radius: float
    halves: tuple[Ball, Ball] | None
    members: np.ndarray


def grow(entries: np.ndarray, members: np.ndarray, leaf: int = LEAF) -> Ball:
    """A ball tree over ``entries[members]``, halved along the widest component; members stay in ascending order."""
    own = entries[members]
    centre = own.sum(0) // len(own)
    radius = float(np.sqrt(float(((own - centre) ** 2).sum(1).max()))) * (1 + SLACK)
    if len(members) <= leaf or (own == own[0]).all():
        return Ball(centre, radius, None, members)
    widest = int(np.argmax(own.max(0) - own.min(0)))
    order = np.argsort(own[:, widest], kind="stable")
    low, high = np.sort(members[order[: len(order) // 2]]), np.sort(members[order[len(order) // 2 :]])
    return Ball(centre, radius, (grow(entries, low, leaf), grow(entries, high, leaf)), members)


def nearest(points: np.ndarray, entries: np.ndarray, tree: Ball) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest entry of every point, ties to the lower one, and its squared distance."""
    best = np.full(len(points), np.iinfo(np.int64).max, np.int64)
    index = np.full(len(points), len(entries), np.int64)

    def search(ball: Ball, at: np.ndarray, gap: np.ndarray) -> None:
        """``at``: points that may have their entry in this ball, ``gap``: their distance to its centre."""
        reach = np.sqrt(best[at].astype(float))
        may = gap - ball.radius <= reach + SLACK * (gap + ball.radius + reach)  # equality enters: ties count
        at, gap = at[may], gap[may]
        if not len(at):
            return
        if ball.halves is None:
            apart = ((points[at][:, None, :] - entries[ball.members][None, :, :]) ** 2).sum(2)
            first = apart.argmin(1)
            least, which = apart[np.arange(len(at)), first], ball.members[first]
            better = (least < best[at]) | ((least == best[at]) & (which < index[at]))
            best[at[better]], index[at[better]] = least[better], which[better]
            return
        gaps = [np.sqrt(((points[at] - half.centre) ** 2).sum(1).astype(float)) for half in ball.halves]
        left = gaps[0] <= gaps[1]
        for turn in (True, False):  # the nearer half first, then the other one with the bound that it gave
            for side, half in enumerate(ball.halves):
                mine = left == (turn == (side == 0))
                search(half, at[mine], gaps[side][mine])

    everything = np.arange(len(points))
    search(tree, everything, np.sqrt(((points - tree.centre) ** 2).sum(1).astype(float)))
    return index, best


def assign(points: np.ndarray, books: np.ndarray, trees: list[Ball]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances (both rows x parts) of integer vectors against codebooks (parts x entries x width)."""
    cut = points.reshape(len(points), len(books), -1)
    found = [nearest(np.ascontiguousarray(cut[:, p]), books[p], trees[p]) for p in range(len(books))]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def plant(books: np.ndarray) -> list[Ball]:
    return [grow(book, np.arange(len(book))) for book in books]


def steps(vector: Column, scale: int = SCALE) -> Column:
    """A vector as integers, floor(scale * x); a product with a power of two is exact."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Whether a vector is there with all of its components there and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def first_books(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of the rows with the smallest ids; ties go to the smaller vector."""
    rows = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    if not rows:
        return None
    points = np.array([r["v"] for r in rows], np.int64)
    if points.shape[1] % parts:
        raise ValueError(f"vectors of {points.shape[1]} components cannot be cut into {parts} equal parts")
    return np.ascontiguousarray(points.reshape(len(points), parts, -1).transpose(1, 0, 2))


def integers(batch: pa.RecordBatch, at: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Offsets and integer vectors of a batch, ``CHUNK`` rows at a time."""
    for start in range(0, batch.num_rows, CHUNK):
        column = batch.column(at).slice(start, CHUNK)
        yield start, np.asarray(column.flatten(), np.int64).reshape(len(column), width)


def improve(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts that are nearest to it; unused entries stay.

    A task adds up the parts of its own rows, Spark adds up the tasks' sums, and parts x entries rows come back.
    """
    parts, entries, width = books.shape
    shared = kept.sparkSession.sparkContext.broadcast((books, plant(books)))  # parts x entries, whatever the rows

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for _, points in integers(batch, 0, parts * width):
                cell = (assign(points, *shared.value)[0] + entries * np.arange(parts)).ravel()
                count += np.bincount(cell, minlength=parts * entries)
                np.add.at(total, cell, points.reshape(-1, width))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["cell", "n", "total"])

    sums = kept.select("v").mapInArrow(trimmed(totals), "cell long, n long, total array<long>")
    added = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for row in sums.groupBy("cell").agg(F.sum("n").alias("n"), *added).collect():  # at most parts x entries rows
        out[row["cell"] // entries, row["cell"] % entries] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    shared.unpersist()
    return out


def prepared(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", carry: str | None = None) -> DataFrame:
    """Columns ``id, v`` (and ``carry``, one column that goes along) of the vectors that take part, as integers."""
    extra = [] if carry is None else [F.col(carry).alias("carry")]
    rows = vectors.select(F.col(vec_id).alias("id"), *extra, F.col(embedding).alias("x")).where(usable(F.col("x")) & (F.size("x") > 0))
    lengths = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("x") == (lengths[0]["n"] if lengths else 0)).withColumn("v", steps(F.col("x")))
    large = F.exists("v", lambda x: F.abs(x) > LARGEST)
    checked = F.when(large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.col("v"))
    return rows.select("id", *(["carry"] if carry else []), checked.alias("v"))


def train(kept: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x width) of ``prepared`` vectors, or None where there are none."""
    books = first_books(kept, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = improve(kept, books)
    return books


def encode(kept: DataFrame, books: np.ndarray | None) -> DataFrame:
    """Every ``prepared`` vector as ``id, codes array<int>, error long``, with ``carry`` if it is there."""
    own = [f for f in kept.schema.fields if f.name != "v"]
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in own) + "codes array<int>, error long"
    if books is None:
        return kept.sparkSession.createDataFrame([], schema)
    parts, _, width = books.shape
    shared = kept.sparkSession.sparkContext.broadcast((books, plant(books)))  # parts x entries, whatever the rows

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, points in integers(batch, len(own), parts * width):
                codes, apart = assign(points, *shared.value)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel().astype(np.int32)), parts).cast(pa.list_(pa.int32()))
                kept_columns = [batch.column(i).slice(start, len(points)) for i in range(len(own))]
                yield pa.RecordBatch.from_arrays([*kept_columns, flat, pa.array(apart.sum(1))], names=[*(f.name for f in own), "codes", "error"])

    return kept.select(*(f.name for f in own), "v").mapInArrow(trimmed(code), schema)


def decode(coded: DataFrame, books: np.ndarray, *, scale: int = SCALE) -> DataFrame:
    """Adds ``decoded``, the vector that the codes stand for: entries side by side, as multiples of 1 / scale."""
    flat = F.lit([[[v / scale for v in entry] for entry in book] for book in books.tolist()])  # a literal of one codebook's size
    name = unused(coded, "decoded")
    return coded.withColumn(name, F.flatten(F.transform(F.col("codes"), lambda c, i: F.get(F.get(flat, i), c))))


def digest(books: np.ndarray | None) -> str:
    """Hex digest of all components of all entries as decimal numbers, by part, entry and place."""
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def compress(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Every usable vector as ``vec_id, code, error, label_error, codebooks_sha256``.

    Vectors that are null or hold a null or a non-finite component take no part, nor do vectors of another length than
    most (the smaller of equally frequent lengths) or of no components. A null vec_id is kept; it comes last where the
    first entries are chosen. Repeated ids and rows count each. With fewer rows than entries, codebooks are smaller.
    ``label_error`` adds up the errors of equal labels; null labels are one label. An empty table gives an empty
    result. Other columns are left out, so their names cannot clash. A length that ``parts`` does not divide, and a
    component beyond 2**27 / 256 in size, whose squares would not fit 64 bits, is an error and no wrong answer.
    """
    kept = prepared(vectors, vec_id=vec_id, embedding=embedding, carry=label)
    books = train(kept, parts=parts, entries=entries, rounds=rounds)
    coded = written(encode(kept, books), "vector-codes")
    by_label = written(coded.groupBy("carry").agg(F.sum("error").alias("label_error")), "label-errors")  # its size decides how Spark joins
    both = coded.alias("c").join(by_label.alias("l"), F.col("c.carry").eqNullSafe(F.col("l.carry")))
    code = F.array_join(F.transform("c.codes", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return both.select(F.col("c.id").alias("vec_id"), code.alias("code"), "c.error", "l.label_error", F.lit(digest(books)).alias("codebooks_sha256"))
