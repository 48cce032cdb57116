"""Operator 12, language-model scores by deleted interpolation of n-gram estimates (Jelinek and Mercer, 1980).

The probability of a token mixes maximum-likelihood estimates of every order down to the uniform distribution. The
weight of an order depends on how often its context was seen, in buckets that double, and is learned by expectation
maximisation on held-out counts: every training document is held out in turn, its own counts deleted from the whole.

Counts are asked for and answered. A chunk of documents lists its distinct n-grams once each, sorted and dealt into
buckets of their hash; one task adds up the lists of a bucket and answers every chunk with the totals, in the chunk's
own order. So a frequent n-gram is one entry a chunk and never a hot key, the table of all counts stays distributed
and grows with the corpus, and only chunk-sized arrays meet in a task. What EM needs of a token is its ratio between an
order's estimate and the mixture below it; ratios are counted in steps of 2 ** (1 / STEPS), a bounded table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.labelled import fold
from newsloom.llm.storage import release, written
from newsloom.llm.words import trimmed

#: Longest n-gram; characters of a chunk; n-grams that one answering task adds up, about.
ORDER, CHUNK_CHARS, ASKED = 2, 4_000_000, 4_000_000
#: Steps of a doubling in which ratios are counted, and rounds and precision of EM.
STEPS, ROUNDS, ENOUGH = 64, 2000, 1e-10
#: Hashes of the token that ends a text and of the place before its first token, and factors that mix hashes.
END, START = np.uint64(0x8F1B_3C5D_7E90_A2C4), np.uint64(0x41C6_4E6D_9B05_688C)
MIX = np.uint64(0x9E37_79B9_7F4A_7C15), np.uint64(0xD6E8_FEB8_6659_FD93)
#: Where a ratio of nought is counted.
NOUGHT = -(1 << 20)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs, first bytes together: short once compressed."""
    top = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)


def mixed(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of all but the last token and of the last."""
    x = before * MIX[0] + token
    x ^= x >> np.uint64(32)
    x *= MIX[1]
    return x ^ (x >> np.uint64(32))


@dataclass
class Chunk:
    """Tokens of some documents one after the other: hashes of distinct words, and which word stands where."""

    words: np.ndarray
    which: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Chunk:
        """Words are cut at blanks (space, tab to carriage return), A-Z lower-cased, and one end closes each text."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        flat = cut.flatten()
        real = pc.not_equal(flat, "")
        owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
        coded = flat.filter(real).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        hashes = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
        lengths = np.bincount(owner, minlength=len(texts)) + 1
        which = np.full(int(lengths.sum()), len(hashes), np.int64)
        inside = np.ones(len(which), bool)
        inside[np.cumsum(lengths) - 1] = False
        which[inside] = coded.indices.to_numpy()
        return cls(np.array([*hashes, int(END)], np.uint64), which, lengths)

    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def keys(self, order: int) -> np.ndarray:
        """Hashes of the n-grams of an order that end at every token; before a text stand as many starts as needed."""
        token = self.words[self.which]
        out, begin = token, START
        for _ in range(order - 1):
            before = np.empty_like(out)
            before[1:] = out[:-1]
            before[self.starts()] = begin
            out, begin = mixed(before, token), mixed(np.array([begin]), np.array([START]))[0]
        return out


@dataclass
class Model:
    """Sizes of the training part and the weights of every order: ``weights[k][b]`` for contexts seen 2**b times."""

    tokens: int
    documents: int
    words: int
    order: int
    weights: list[np.ndarray] = field(default_factory=list)

    def estimates(self, order: int, counts: list[np.ndarray], starts: np.ndarray, tokens: np.ndarray | int, documents: int) -> tuple[np.ndarray, np.ndarray]:
        """Maximum-likelihood estimates of an order at every token, and buckets of their contexts (-1: never seen)."""
        if order == 1:
            context = np.broadcast_to(np.asarray(tokens, float), counts[0].shape)
        else:
            context = np.empty(len(counts[0]))
            context[1:] = counts[order - 2][:-1]
            context[starts] = documents
        seen = context > 0
        share = np.divide(counts[order - 1], context, out=np.zeros(len(context)), where=seen)
        return share, np.where(seen, np.frexp(np.maximum(context, 1))[1] - 1, -1)

    def mixture(self, upto: int, counts: list[np.ndarray], starts: np.ndarray, tokens: np.ndarray | int, documents: int) -> np.ndarray:
        """Probabilities by the orders up to one; order 0 is uniform over the words and one unknown."""
        out = np.full(len(counts[0]), 1 / (self.words + 1))
        for order in range(1, upto + 1):
            share, bucket = self.estimates(order, counts, starts, tokens, documents)
            weight = np.where(bucket < 0, 0.0, self.weights[order - 1][bucket])
            out = weight * share + (1 - weight) * out
        return out


def maximised(bucket: np.ndarray, ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of 64 buckets by EM: ``n`` held-out tokens had an estimate of ``ratio`` times the mixture below it.

    One half of a token is added to either side, so no weight is 0 or 1. A bucket without tokens takes the weight of
    the nearest one below it, or above it, or one half.
    """
    total = np.bincount(bucket, n, 64)
    weight = np.full(64, 0.5)
    for _ in range(ROUNDS):
        upper = weight[bucket] * ratio
        share = n * upper / (upper + 1 - weight[bucket])
        new = (np.bincount(bucket, share, 64) + 0.5) / (total + 1)
        moved, weight = np.abs(new - weight).max(), new
        if moved < ENOUGH:
            break
    known = np.flatnonzero(total)
    if not len(known):
        return np.full(64, 0.5)
    return weight[known[np.maximum(np.searchsorted(known, np.arange(64), side="right") - 1, 0)]]


def chunked(docs: DataFrame, *, parts: int, held: int, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """Documents in chunks of whole texts: ids, which of them are learned from, and their words as hashes."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), fold(F.col(doc_id), parts, held).alias("held"))
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        pending, size = [], 0
        for batch in batches:
            start = 0
            for i, chars in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
                size += chars + 1
                if size >= CHUNK_CHARS:
                    yield made(at, [*pending, batch.slice(start, i + 1 - start)])
                    at, pending, size, start = at + 1, [], 0, i + 1
            if start < batch.num_rows:
                pending.append(batch.slice(start))
        if pending:
            yield made(at, pending)

    def made(at: int, pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(pieces).combine_chunks()
        chunk = Chunk.of(whole.column("text").to_pylist())
        learn = ~whole.column("held").to_numpy()
        sizes = int(chunk.lengths[learn].sum()), int(learn.sum()), int(chunk.lengths.sum())
        values = [at, whole.column("id").to_pylist(), packed(learn), packed(chunk.lengths), packed(chunk.words), packed(chunk.which), *sizes]
        ids = whole.schema.field("id").type
        kinds = [pa.int64(), pa.list_(ids), *[pa.binary()] * 4, *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["chunk", "ids", "learn", "lengths", "words", "which", "train_tokens", "train_docs", "tokens"])

    schema = f"chunk long, ids array<{kind}>, learn binary, lengths binary, words binary, which binary, train_tokens long, train_docs long, tokens long"
    return rows.mapInArrow(trimmed(cut), schema), kind


def read(row: dict) -> tuple[Chunk, np.ndarray]:
    """A chunk and which of its documents are learned from."""
    whole = Chunk(*(unpacked(row[c]) for c in ("words",)), *(unpacked(row[c]).astype(np.int64) for c in ("which", "lengths")))
    return whole, unpacked(row["learn"]).astype(bool)


def asked(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """Every distinct n-gram of a chunk, with how often its training documents hold it, in 2**bits buckets of hashes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk, learn = read(row)
                taught = np.repeat(learn, chunk.lengths)
                for n in range(1, order + 1):
                    keys, inverse = np.unique(chunk.keys(n), return_inverse=True)
                    counts = np.bincount(inverse[taught], minlength=len(keys))
                    bounds = [*np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)).tolist(), len(keys)]
                    own = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if lo < hi]
                    columns = [
                        pa.array([row["chunk"]] * len(own), pa.int64()), pa.array([n] * len(own), pa.int32()), pa.array([b for b, _, _ in own], pa.int32()),
                        pa.array([packed(np.diff(keys[lo:hi], prepend=np.uint64(0))) for _, lo, hi in own], pa.binary()), pa.array([packed(counts[lo:hi]) for _, lo, hi in own], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "n", "bucket", "keys", "counts"])

    return chunks.mapInArrow(trimmed(ask), "chunk long, n int, bucket int, keys binary, counts binary")


def answered(asks: DataFrame) -> DataFrame:
    """The total of every n-gram that was asked for, to each chunk in its order; one more row of a bucket, without a
    chunk, says how many distinct n-grams of the training part it holds."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(k), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([unpacked(c) for c in table.column("counts").to_pylist()])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(distinct), np.uint64)
        np.add.at(totals, inverse, counts)
        ends = np.cumsum([len(k) for k in keys])
        told = [packed(part) for part in np.split(totals[inverse], ends[:-1])]
        n, bucket = table.column("n")[0].as_py(), table.column("bucket")[0].as_py()
        size = len(told) + 1
        columns = [pa.array([*table.column("chunk").to_pylist(), None], pa.int64()), pa.array([n] * size, pa.int32()), pa.array([bucket] * size, pa.int32()), pa.array([*told, None], pa.binary()), pa.array([*[None] * len(told), int((totals > 0).sum())], pa.int64())]
        return pa.table(columns, names=["chunk", "n", "bucket", "totals", "n_distinct"])

    return asks.groupBy("n", "bucket").applyInArrow(answer, "chunk long, n int, bucket int, totals binary, n_distinct long")


def counted(chunks: DataFrame, answers: DataFrame, order: int, kind: str) -> DataFrame:
    """Chunks with the counts of the n-grams that end at every token: ``n1, n2, ...`` in the whole training part, and
    ``d1, d2, ...`` in the token's own document if that is learned from (else 0)."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        chunk, learn = read(row)
        told = right.sort_by([("n", "ascending"), ("bucket", "ascending")])
        owner = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
        taught = np.repeat(learn, chunk.lengths)
        out = {"chunk": row["chunk"], "ids": row["ids"], "learn": row["learn"], "lengths": row["lengths"]}
        for n in range(1, order + 1):
            own = told.filter(pc.equal(told.column("n"), n))
            totals = np.concatenate([unpacked(t) for t in own.column("totals").to_pylist()])
            keys, inverse = np.unique(chunk.keys(n), return_inverse=True)
            out[f"n{n}"] = packed(totals[inverse])
            _, at, times = np.unique(owner * len(keys) + inverse, return_inverse=True, return_counts=True)
            out[f"d{n}"] = packed(np.where(taught, times[at], 0))
        kinds = [pa.int64(), left.schema.field("ids").type, *[pa.binary()] * (2 + 2 * order)]
        return pa.table([pa.array([v], k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    columns = "".join(f", n{n} binary, d{n} binary" for n in range(1, order + 1))
    own = chunks.select("chunk", "ids", "learn", "lengths", "words", "which").groupBy("chunk")
    return own.cogroup(answers.where("chunk IS NOT NULL").select("chunk", "n", "bucket", "totals").groupBy("chunk")).applyInArrow(count, f"chunk long, ids array<{kind}>, learn binary, lengths binary{columns}")


def parts_of(batch: pa.RecordBatch, order: int) -> Iterator[tuple[dict, np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """Rows of ``counted`` with lengths, counts and deleted counts as numbers."""
    for i in range(batch.num_rows):
        row = batch.slice(i, 1).to_pylist()[0]
        lengths = unpacked(row["lengths"]).astype(np.int64)
        yield row, lengths, *([unpacked(row[f"{c}{n}"]).astype(float) for n in range(1, order + 1)] for c in "nd")


def held_out_ratios(counts: DataFrame, model: Model) -> DataFrame:
    """``bucket, step, n``: held-out tokens by the bucket of their context in the next order to learn, and by the ratio
    of that order's deleted estimate to the deleted mixture of the orders below."""
    upto = len(model.weights)

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for row, lengths, whole, deleted in parts_of(batch, model.order):
                learn = np.repeat(unpacked(row["learn"]).astype(bool), lengths)
                starts = np.cumsum(lengths) - lengths
                rest = [w - d for w, d in zip(whole, deleted, strict=True)]
                tokens = model.tokens - np.repeat(lengths, lengths)
                share, bucket = model.estimates(upto + 1, rest, starts, tokens, model.documents - 1)
                ratio = share / model.mixture(upto, rest, starts, tokens, model.documents - 1)
                step = np.full(len(ratio), NOUGHT, np.int64)
                step[ratio > 0] = np.rint(np.log2(ratio[ratio > 0]) * STEPS)
                cell_of = (bucket.astype(np.int64) << 32) + step - 2 * NOUGHT
                cells, n = np.unique(cell_of[learn & (bucket >= 0)], return_counts=True)
                for cell, times in zip(cells.tolist(), n.tolist(), strict=True):
                    found[cell] = found.get(cell, 0) + times
        cells = np.fromiter(found, np.int64, len(found))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.fromiter(found.values(), np.int64, len(found)))], names=["cell", "n"])

    sums = counts.mapInArrow(trimmed(ratios), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    bucket = F.shiftright("cell", 32).cast("int")
    return sums.select(bucket.alias("bucket"), (F.col("cell") - F.shiftleft(bucket.cast("long"), 32) + 2 * NOUGHT).alias("step"), "n")


def learned(counts: DataFrame, model: Model) -> Model:
    """Learns the weights of one order after the other, from order 1 up."""
    while len(model.weights) < model.order:
        rows = held_out_ratios(counts, model).collect()  # 64 buckets times the steps of a double's range at most
        bucket, step, n = (np.array([r[c] for r in rows], np.int64) for c in ("bucket", "step", "n"))
        ratio = np.where(step == NOUGHT, 0.0, np.exp2(np.where(step == NOUGHT, 0, step) / STEPS))
        model.weights.append(maximised(bucket, ratio, n.astype(float)))
    return model


def score(docs: DataFrame, *, parts: int = 7, held: int = 2, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32 of doc_id as text, modulo ``parts``, is ``held`` are scored but not learned from. A null text
    is an empty one: its single token is the end. Rows without a doc_id are learned from; repeated ids and rows count
    each, once a row. Without a training document every token has probability 1. Other columns are left out, so their
    names cannot clash. An empty table gives an empty result. N-grams are told apart by 64-bit hashes.
    """
    parts_, kind = chunked(docs, parts=parts, held=held, doc_id=doc_id, text=text)
    chunks = written(parts_, "lm-chunks")
    sizes = chunks.agg(F.sum("train_tokens").alias("n"), F.sum("train_docs").alias("docs"), F.sum("tokens").alias("all")).first()
    bits = max(0, int(np.ceil(np.log2(max(1, (sizes["all"] or 0) * order / ASKED)))))
    answers = written(answered(asked(chunks, order, bits)), "lm-answers")
    words = answers.where("n = 1 AND chunk IS NULL").agg(F.sum("n_distinct")).first()[0]
    counts = written(counted(chunks, answers, order, kind), "lm-counts")
    release(chunks, answers)
    model = learned(counts, Model(int(sizes["n"] or 0), int(sizes["docs"] or 0), int(words or 0), order))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lengths, whole, _ in parts_of(batch, order):
                starts = np.cumsum(lengths) - lengths
                base = np.log10((whole[0] + 1) / (model.tokens + model.words + 1))
                mine = np.log10(model.mixture(order, whole, starts, model.tokens, model.documents))
                known = np.add.reduceat((whole[0] > 0).astype(np.int64), starts)
                columns = [
                    pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(~unpacked(row["learn"]).astype(bool)), pa.array(lengths), pa.array(known),
                    pa.array(np.full(len(lengths), model.tokens)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(mine, starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counts.mapInArrow(trimmed(scored), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
