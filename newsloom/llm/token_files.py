"""Operator 7, token-id files coded by a static range asymmetric numeral system.

One frequency table, counted over all documents, is shared by all blocks. A block holds whole documents; its ids go
round-robin to many interleaved coders, so that each step codes a row of ids at once. Blocks do not depend on one
another: each has its own coder states, checkpoints inside it, and checksums of its bytes and of its ids.

A file set is a folder with two Parquet tables: ``table`` (id, count) and ``blocks`` (part, block, part_start,
n_tokens, doc_ids, counts, payload). Spark's own writers and commit protocol make them, on any file system.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.storage import scratch, written
from newsloom.llm.quality import mix
from newsloom.llm.words import HashIndex, chunks, expand, held

#: Ids in a block (a longer document has a block of its own), coders in a block, and steps between checkpoints.
BLOCK_IDS, LANES, CHECKPOINT_STEPS = 1 << 20, 1024, 256
#: Ids in a part, that is in one file of blocks; offsets of up to BROADCAST_PARTS parts go out as a broadcast of 16 bytes each.
PART_IDS, BROADCAST_PARTS = 1 << 23, 100_000
#: Plain words that the tokenizer is handed at once.
GROUP = 200
MAGIC, LOW = b"NLR1", np.uint64(1 << 31)
HEADER = struct.Struct("<4sIQIIII")  # magic, lanes, ids, words, checkpoints, checksum of the ids, checksum of what follows


class CorruptBlock(ValueError):
    """A block whose bytes or ids do not have the checksum that it states."""


@dataclass
class Coder:
    """Frequencies scaled to a power of two, with the tables for both directions."""

    freq: np.ndarray
    bits: int

    def __post_init__(self) -> None:
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.limit = self.freq << np.uint64(63 - self.bits)

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = 20) -> Coder:
        """Scales counts so that every id that occurs keeps a share and the shares fill 2 ** bits exactly."""
        counts = np.asarray(counts, np.float64)
        present = counts > 0
        bits = max(bits, int(np.ceil(np.log2(max(2, present.sum())))) + 2)
        total = 1 << bits
        if not present.any():
            counts, present = np.ones_like(counts), np.ones(len(counts), bool)
        freq = np.where(present, np.maximum(1, np.floor(counts * (total / counts.sum()))), 0).astype(np.int64)
        order = np.argsort(-freq, kind="stable")
        at = 0
        while (left := total - int(freq.sum())) != 0:  # the largest shares take up what rounding left
            k = order[at % len(order)]
            step = left if left > 0 else max(left, -(int(freq[k]) // 2))
            freq[k] += step
            at += 1
        return cls(freq, bits)

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
        """One block's bytes."""
        n = len(ids)
        lanes = max(1, min(lanes, n))
        steps = -(-n // lanes)
        grid = np.zeros(steps * lanes, np.int64)
        grid[:n] = ids
        x = np.full(lanes, LOW, np.uint64)
        out: list[np.ndarray] = []
        written_words, marks = 0, []
        shift, low32 = np.uint64(32), np.uint64(0xFFFFFFFF)
        bits = np.uint64(self.bits)
        for t in range(steps - 1, -1, -1):
            row = grid[t * lanes : min(n, (t + 1) * lanes)]
            f, own = self.freq[row], x[: len(row)]
            full = own >= self.limit[row]
            if full.any():
                words = (own[full] & low32).astype(np.uint32)
                out.append(words)
                written_words += len(words)
                own[full] >>= shift
            q = own // f
            x[: len(row)] = (q << bits) + (own - q * f) + self.start[row]
            if t % every == 0:
                marks.append((t, written_words, x.copy()))
        words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
        marks = marks[::-1]
        body = b"".join([*(struct.pack("<QQ", t, len(words) - at) + state.astype("<u8").tobytes() for t, at, state in marks), words.astype("<u4").tobytes()])
        return HEADER.pack(MAGIC, lanes, n, len(words), len(marks), zlib.crc32(np.asarray(ids).astype("<u4").tobytes()), zlib.crc32(body)) + body

    def decode(self, block: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of a block, or of its checkpoints ``first`` to ``last`` (exclusive) only, each of which stands alone."""
        magic, lanes, n, n_words, n_marks, ids_sum, body_sum = HEADER.unpack_from(block)
        body = memoryview(block)[HEADER.size :]
        if magic != MAGIC or zlib.crc32(body) != body_sum:
            raise CorruptBlock("the block's bytes do not have its checksum")
        if not n:
            return np.zeros(0, np.uint32)
        size = 16 + 8 * lanes
        words = np.frombuffer(body, "<u4", n_words, n_marks * size)
        last = n_marks if last is None else min(last, n_marks)
        begin, at = struct.unpack_from("<QQ", body, first * size)
        end = struct.unpack_from("<QQ", body, last * size)[0] * lanes if last < n_marks else n
        x = np.frombuffer(body, "<u8", lanes, first * size + 16).astype(np.uint64)
        bits, mask, shift = np.uint64(self.bits), np.uint64((1 << self.bits) - 1), np.uint64(32)
        out = np.zeros(end - begin * lanes, np.uint32)
        for t in range(0, len(out), lanes):
            k = min(lanes, len(out) - t)
            own = x[:k]
            slot = own & mask
            row = self.symbol[slot.astype(np.int64)]
            out[t : t + k] = row
            own = self.freq[row] * (own >> bits) + slot - self.start[row]
            low = np.flatnonzero(own < LOW)
            if len(low):
                own[low] = (own[low] << shift) | words[at : at + len(low)].astype(np.uint64)
                at += len(low)
            x[:k] = own
        if first == 0 and last == n_marks and zlib.crc32(out.astype("<u4").tobytes()) != ids_sum:
            raise CorruptBlock("the block's ids do not have its checksum")
        return out


#: Characters below this code, but for SLOW, keep their class and their 1:1 lower case in every version of Unicode.
PLAIN = 0x250
#: Characters that take the word around them to the library as it is: contractions, special tokens, a long lower case.
SLOW = (ord("'"), ord("<"), 0x130)
#: Distinct tokens that a worker remembers.
MEMORY_TOKENS = 1_000_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class (0 blank, 1 letter, 2 digit, 3 other, 4 slow) and lower case of every code."""
    kind, lower = np.full(0x110000, 4, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for code in range(PLAIN):
        char = chr(code)
        category = unicodedata.category(char)
        blank = char in "\t\n\v\f\r \x85\xa0"
        kind[code] = 0 if blank else 1 if category[0] == "L" else 2 if category[0] == "N" else 3
        if len(char.lower()) == 1:
            lower[code] = ord(char.lower())
    kind[list(SLOW)] = 4
    return kind, lower


class TokenTable:
    """Ids of texts by a lower-casing tokenizer that cuts at blanks and at changes between letters, digits and others.

    Plain texts are cut and hashed as arrays; each distinct piece goes to the library once. A word with a character
    that is not plain goes to the library whole, so what holds there decides.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.kind, self.lower = _classes()
        suffix = json.loads(text)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece of the text
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.index = HashIndex()
        self.clear()
        rng = np.random.default_rng(3)
        self.code_a, self.code_b = (rng.integers(0, 2**64, 0x110000, np.uint64, endpoint=False) | np.uint64(1) for _ in range(2))
        self.grow(1 << 12)

    def clear(self) -> None:
        self.index.clear()
        self.values, self.used = np.zeros(1024, np.uint32), 0
        self.starts, self.counts = np.zeros(256, np.int64), np.zeros(256, np.int64)

    def grow(self, n: int) -> None:
        """Powers of the hashes' bases and of their inverses, for texts of n characters."""
        self.power = []
        for base in (_A, _B):
            inverse = np.uint64(pow(int(base), -1, 2**64))
            up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
            up[1:], down[1:] = base, inverse
            self.power.append((np.multiply.accumulate(up), np.multiply.accumulate(down)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many each has."""
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        kind, low = self.kind[codes], self.lower[codes]
        edge, within = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == 2)]), None
        if (slow := np.flatnonzero(kind == 4)).size:
            gaps = np.flatnonzero(kind == 0)
            before = np.searchsorted(gaps, slow)  # the word of a slow character lies between two blanks
            word = np.unique(before)
            begin = np.r_[-1, gaps][word] + 1
            end = np.r_[gaps, len(codes)][word]
            low = low.copy()
            inside = expand(begin, end - begin)
            low[inside] = codes[inside]
            mark = np.zeros(len(codes) + 1, np.int32)
            np.add.at(mark, begin, 1)
            np.add.at(mark, end, -1)
            within = np.cumsum(mark[:-1]) > 0
            edge = np.unique(np.r_[edge[~within[edge]], begin, end[end < len(codes)]])
        stop = np.r_[edge[1:], len(codes)]
        keep = kind[edge] != 0
        edge, stop = edge[keep], stop[keep]
        if len(codes) >= len(self.power[0][0]):
            self.grow(2 * len(codes))
        a, b = (self._hash(low, edge, stop, k) for k in (0, 1))
        found = self.index.find(a, b)
        if (missing := np.flatnonzero(found < 0)).size:
            if self.index.size + len(missing) > MEMORY_TOKENS and self.index.size:
                self.clear()
                missing = np.arange(len(a))
            _, first = np.unique(a[missing] ^ (b[missing] * np.uint64(31)), return_index=True)
            new = missing[np.sort(first)]
            raw = low.astype("<u4")
            words = [raw[i:j].tobytes().decode("utf-32-le", "surrogatepass") for i, j in zip(edge[new].tolist(), stop[new].tolist(), strict=True)]
            self._learn(words, np.ones(len(new), bool) if within is None else ~within[edge[new]])
            self.index.add(a[new], b[new])
            found[missing] = self.index.find(a[missing], b[missing])
        counts = self.counts[found]
        ids = self.values[expand(self.starts[found], counts)]
        doc = np.searchsorted(np.cumsum(lengths), edge, "right")
        return ids, np.bincount(doc, counts, len(texts)).astype(np.int64)

    def _hash(self, low: np.ndarray, edge: np.ndarray, stop: np.ndarray, k: int) -> np.ndarray:
        up, down = self.power[k]
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((self.code_a, self.code_b)[k][low] * up[: len(low)], out=sums[1:])
        return mix((sums[stop] - sums[edge]) * down[edge])

    def _learn(self, words: list[str], plain: np.ndarray) -> None:
        """Adds words. Plain ones are one piece each, so the library takes many at once and their last ids part them."""
        counts, ids = np.zeros(len(words), np.int64), [np.zeros(0, np.uint32)] * len(words)
        at = np.flatnonzero(plain)
        for group in (at[i : i + GROUP] for i in range(0, len(at), GROUP)):
            row = [words[i] for i in group.tolist()]
            got = np.array(self.tokenizer.encode(" ".join(row), add_special_tokens=False).ids, np.uint32)
            cut = np.flatnonzero(self.last[got]) + 1
            if len(cut) == len(row) and cut[-1] == len(got):
                counts[group] = np.diff(np.r_[0, cut])
                for i, own in zip(group.tolist(), np.split(got, cut[:-1]), strict=True):
                    ids[i] = own
            else:
                plain = plain.copy()
                plain[group] = False
        rest = np.flatnonzero(~plain).tolist()
        for i, e in zip(rest, self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False), strict=True):
            ids[i], counts[i] = np.array(e.ids, np.uint32), len(e.ids)
        values = np.concatenate(ids)
        first, last = self.index.size, self.index.size + len(words)
        if self.used + len(values) > len(self.values):
            self.values = np.resize(self.values, 2 * (self.used + len(values)))
        if last > len(self.counts):
            self.starts, self.counts = np.resize(self.starts, 2 * last), np.resize(self.counts, 2 * last)
        self.values[self.used : self.used + len(values)] = values
        self.counts[first:last], self.starts[first:last] = counts, self.used + np.cumsum(counts) - counts
        self.used += len(values)


def _table(text: str) -> TokenTable:
    """A worker's tokenizer with its memory."""
    return held(("tokenizer", zlib.crc32(text.encode())), lambda: TokenTable(text))


def width_of(tokenizer_path: str, end_id: int | None) -> str:
    """The narrowest type that holds every id."""
    from tokenizers import Tokenizer

    most = max(Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values())
    return "<u2" if max(most, end_id or 0) < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_path: str, *, end_id: int | None = None, width: str = "<u4", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text as little-endian integers of the given width: ``doc_id, ids binary``.

    The tokenizer has to be one that TokenTable describes. A null text counts as empty; ``end_id`` is put after
    every text.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # bounded by the vocabulary
    tail = np.zeros(0, width) if end_id is None else np.array([end_id], width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                ids, counts = table.encode(texts[a:b])
                ids, ends = ids.astype(width), np.cumsum(counts)
                rows = [ids[i:j].tobytes() + tail.tobytes() for i, j in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def frequencies(tokens: DataFrame, width: str = "<u4") -> DataFrame:
    """How often each id occurs in all rows: ``id, count``, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                own = np.bincount(np.frombuffer(raw, width))
                if len(own) > len(total):
                    total = np.r_[total, np.zeros(len(own) - len(total), np.int64)]
                total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["id", "count"])

    return tokens.select("ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def _coder(spark: SparkSession, folder: str) -> Coder:
    """The coder of a file set. Its table has a row for each id of the vocabulary at most."""
    rows = spark.read.parquet(f"{folder}/table").toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    if len(rows):
        counts[rows["id"].to_numpy()] = rows["count"].to_numpy()
    return Coder.of(counts)


def write_tokens(tokens: DataFrame, folder: str, width: str = "<u4") -> None:
    """Writes ``doc_id, ids`` as a file set in ascending order of doc_id (nulls first; equal ids by their tokens)."""
    spark = tokens.sparkSession
    frequencies(tokens, width).coalesce(1).write.parquet(f"{folder}/table")
    coder = spark.sparkContext.broadcast(_coder(spark, folder))
    total = spark.read.parquet(f"{folder}/table").agg(F.sum("count")).first()[0] or 0
    kind, size = tokens.schema["doc_id"].dataType, np.dtype(width).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, block = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        docs: list = []
        held = 0

        def close() -> pa.RecordBatch:
            row = np.frombuffer(b"".join(ids), width).astype(np.uint32)
            values = [part, block, start, len(row), docs, [len(x) // size for x in ids], coder.value.encode(row)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(doc_kind), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["part", "block", "part_start", "n_tokens", "doc_ids", "counts", "payload"])

        for batch in batches:
            doc_kind = batch.column(0).type
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and held + len(raw) // size > BLOCK_IDS:
                    yield close()
                    start, block, held, ids, docs = start + held, block + 1, 0, [], []
                ids.append(raw)
                docs.append(doc)
                held += len(raw) // size
        if docs:
            yield close()

    schema = f"part int, block int, part_start long, n_tokens long, doc_ids array<{kind.simpleString()}>, counts array<long>, payload binary"
    dealt = tokens.select("doc_id", "ids").repartitionByRange(max(1, -(-total // PART_IDS)), "doc_id").sortWithinPartitions("doc_id", "ids")
    dealt.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a file set: ``doc_id, start, ids``, with start the number of ids in all documents before it.

    Every block is decoded on its own. Offsets of parts are summed from the blocks' headers.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    coder = spark.sparkContext.broadcast(_coder(spark, folder))
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    few = blocks.agg(F.max("part")).first()[0] or 0
    blocks = blocks.join(F.broadcast(parts) if few < BROADCAST_PARTS else parts, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, docs, counts, payload = (batch.column(k)[i] for k in range(4))
                counts = np.asarray(counts.values if counts.values is not None else [], np.int64)
                ids = coder.value.decode(payload.as_py()).astype("<u4")
                ends = np.cumsum(counts)
                rows = [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(start.as_py() + ends - counts, pa.int64()), pa.array(rows, pa.binary())], names=["doc_id", "start", "ids"])

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select((F.col("before") + F.col("part_start")).alias("start"), "doc_ids", "counts", "payload").mapInArrow(run, f"doc_id {kind}, start long, ids binary")


def encode_to_files(docs: DataFrame, tokenizer_path: str, *, end_id: int | None = None, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> str:
    """Tokenizes documents and writes them as a file set; returns its folder.

    Null texts count as empty; null doc_ids come first; repeated rows stay as many as they are; other columns are
    left out. Of an empty table the file set has no blocks.
    """
    spark = docs.sparkSession
    width = width_of(tokenizer_path, end_id)
    tokens = written(tokenize(docs, tokenizer_path, end_id=end_id, width=width, doc_id=doc_id, text=text), "tokens")
    folder = folder or scratch(spark, "token-files")
    write_tokens(tokens, folder, width)
    return folder


def digests(documents: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents read from a file set."""
    return documents.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
