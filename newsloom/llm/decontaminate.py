"""Operator 3, benchmark decontamination by CGK embedding and bit-sampling LSH over item-sized windows.

Texts and benchmark items are sequences of words. A random walk over a sequence emits a word at every step and moves
on or stays by a random bit of step and word (Chakraborty, Goldenberg and Koucky, 2016), so that sequences a few
edits apart come to agree at most steps: edit distance becomes Hamming distance, and words at a sample of steps make
an LSH key. Windows begin where a word's hash is the least among its neighbours, in items and in texts alike, so a
passage is met at several places. Independent walks are added until simulated edits of the items are found with the
wanted recall; items that walks do not find so are met by whole segments instead, of which one more than edits are
allowed always stands unchanged. What meets by a key is verified by exact edit distance over the windows of the item's
size, windows that overlap together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsloom.llm.columns import unused
from newsloom.llm.quality import mix
from newsloom.llm.shingles import Shingler
from newsloom.llm.storage import written
from newsloom.llm.words import chunks, held, trimmed

#: Edits per word of an item that still count as its text; recall wanted of them; fewest walks, and walks after which
#: items that still miss their recall are met by segments; words of items in a pass.
RATE, RECALL, LEAST_WALKS, MOST_WALKS, BLOCK_WORDS = 0.15, 0.99, 3, 64, 2_000_000
#: Neighbours that an anchor is the least of, steps of a walk, and steps that are sampled for a key.
ANCHOR, STEPS, SAMPLED = 6, 14, 4
#: Slots for each key, in powers of two, of the filter that rules out most keys before they are looked up, and most slots.
FILTER_SPARE, FILTER_BITS = 6, 22
#: Documents to remove up to which their keys go out as a broadcast (some 40 bytes each); beyond it the join is by shuffle.
BROADCAST_ROWS = 500_000


def word_hasher() -> Shingler:
    """Words are runs of ASCII letters and digits and of any other characters beyond ASCII."""
    part = np.ones(256, bool)
    part[48:58] = part[65:91] = part[97:123] = part[128:] = False
    return Shingler(1, part)


def sequences(hasher: Shingler, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts in lower case, one text after the other, and how many each has."""
    return hasher.words([t.lower() for t in texts])


def anchors(words: np.ndarray, counts: np.ndarray, span: int) -> np.ndarray:
    """Places whose hash is the least of some ``span`` words in a row of one text; the first of equals."""
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value = mix(words ^ np.uint64(0x5851F42D4C957F2D))
    low = value[:n].copy()
    for t in range(1, span):
        np.minimum(low, value[t : n + t], out=low)
    ends = np.cumsum(counts)
    inside = np.zeros(len(words) + 1, np.int32)
    firsts = ends - counts
    long = counts >= span
    np.add.at(inside, firsts[long], 1)
    np.add.at(inside, ends[long] - span + 1, -1)
    open_ = np.cumsum(inside)[:n] > 0
    found = np.zeros(len(words), bool)
    for t in range(span):
        hit = open_ & (value[t : n + t] == low)
        found[t : n + t] |= hit
        open_ = open_ & ~hit
    return np.flatnonzero(found)


def walk_keys(words: np.ndarray, starts: np.ndarray, walk: int, steps: int, sampled: int) -> tuple[np.ndarray, np.ndarray]:
    """LSH keys of the walks that begin at starts, and the last place that each has read."""
    rng = np.random.default_rng(1000 + walk)
    taken = set(rng.choice(steps, min(sampled, steps), replace=False).tolist())
    padded = np.r_[words, np.zeros(steps + 1, np.uint64)]
    bits = mix(padded ^ rng.integers(0, 2**64, dtype=np.uint64))
    at, key, read = starts.copy(), np.full(len(starts), walk + 1, np.uint64), starts.copy()
    for j in range(max(taken) + 1):
        if j in taken:
            key = key * np.uint64(0x9E3779B97F4A7C15) + padded[at]
            read = at.copy()
        at += ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
    return mix(key), read


def segment_keys(words: np.ndarray, size: int) -> np.ndarray:
    """Keys of ``size`` words in a row from every place on; those that reach over the end are of no use."""
    padded = np.r_[words, np.zeros(size, np.uint64)]
    key = np.full(len(words), size, np.uint64)
    for j in range(size):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + padded[j : j + len(words)])
    return key


def best_match(masks: dict[int, int], size: int, window: list[int]) -> tuple[int, int]:
    """Least edits between an item and some part of a window, and where that part ends (Myers, 1999)."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, end = full, 0, size, size, 0
    for i, word in enumerate(window):
        equal = masks.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (~(horizontal | up) & full)
        minus = up & horizontal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (~(vertical | plus) & full), plus & vertical
        if score < best:
            best, end = score, i + 1
    return best, end


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def shape(size: int) -> tuple[int, int, int]:
    """Neighbours of an anchor, steps of a walk and sampled steps for an item of so many words.

    A short item has few windows: they begin everywhere and their walks are short.
    """
    steps = min(STEPS, max(1, size))
    return (ANCHOR if size >= 2 * ANCHOR else 1), steps, min(SAMPLED, steps)


@dataclass
class Benchmark:
    """Items of one shape as word sequences with the keys of their windows."""

    ids: list
    items: list[list[int]]
    rate: float = RATE
    span: int = ANCHOR
    steps: int = STEPS
    sampled: int = SAMPLED
    walks: int = 1
    lengths: tuple[int, ...] = ()
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        self.span, self.steps, self.sampled = min((shape(len(w)) for w in self.items), default=shape(ANCHOR))
        self.edits = [int(self.rate * len(w)) for w in self.items]
        self.forward = [masks_of(w) for w in self.items]
        self.backward = [masks_of(w[::-1]) for w in self.items]

    def index(self, walks: int) -> None:
        """Keys of all windows of all items for a number of walks; walks that leave their item are no use."""
        self.walks = walks
        words = np.array([w for item in self.items for w in item], np.uint64)
        counts = np.fromiter(map(len, self.items), np.int64, len(self.items))
        begin, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(self.items)), counts)
        starts = anchors(words, counts, self.span)
        keys, item, offset = [], [], []
        for walk in range(walks):
            key, read = walk_keys(words, starts, walk, self.steps, self.sampled)
            good = read < begin[owner[starts]] + counts[owner[starts]]
            keys.append(key[good])
            item.append(owner[starts][good])
            offset.append((starts - begin[owner[starts]])[good])
        self.keys, self.item, self.offset = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, item, offset))
        self._sorted()

    def _sorted(self) -> None:
        by = np.argsort(self.keys, kind="stable")
        self.keys, self.item, self.offset = self.keys[by], self.item[by], self.offset[by]
        bits = min(FILTER_BITS, len(self.keys).bit_length() + FILTER_SPARE)
        self.filter, self.shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
        self.filter[(self.keys >> self.shift).astype(np.int64)] = True

    def index_segments(self) -> None:
        """Keys of segments of all items: each is cut into one more than it may have edits, so one stands unchanged in
        every text within them, and no such text is missed."""
        cuts = [np.linspace(0, len(w), e + 2).astype(int).tolist() for w, e in zip(self.items, self.edits, strict=True)]
        parts = [(k, a, b - a) for k, cut in enumerate(cuts) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.walks, self.lengths = 0, tuple(sorted({n for _, _, n in parts}))
        flat = np.array([w for item in self.items for w in item], np.uint64)
        begin = np.cumsum([0, *map(len, self.items)])
        found = {n: segment_keys(flat, n) for n in self.lengths}
        self.keys = np.array([found[n][begin[k] + a] for k, a, n in parts], np.uint64)
        self.item, self.offset = np.array([k for k, _, _ in parts], np.int64), np.array([a for _, a, _ in parts], np.int64)
        self._sorted()

    def calibrate(self, recall: float, trials: int = 400, seed: int = 5) -> float:
        """Adds walks until simulated edits at the full rate are found with the wanted recall; returns the recall.

        If MOST_WALKS do not reach it, the items are met by their segments, which misses nothing.
        """
        rng = np.random.default_rng(seed)
        made = []
        for k in rng.integers(0, len(self.items), trials).tolist():
            words = list(self.items[k])
            for _ in range(self.edits[k]):
                kind, at = rng.integers(3), int(rng.integers(len(words)))
                strange = int(rng.integers(1 << 62))
                words[at : at + (kind != 1)] = [strange] if kind != 2 else []
            noise = rng.integers(0, 1 << 62, 2 * ANCHOR).tolist()
            made.append((k, noise[:ANCHOR] + words + noise[ANCHOR:]))
        found = 0.0
        for walks in range(LEAST_WALKS, MOST_WALKS + 1):
            self.index(walks)
            flat, counts = np.array([w for _, m in made for w in m], np.uint64), np.array([len(m) for _, m in made], np.int64)
            at, entry = self.meet(flat, counts)
            owner = np.searchsorted(np.cumsum(counts), at, "right")
            hit = self.item[entry] == np.array([k for k, _ in made])[owner]
            found = len(np.unique(owner[hit])) / max(1, len(made))
            if found >= recall:
                return found
        self.index_segments()
        return 1.0

    def meet(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of texts whose key an item's window has: (place, entry of the index), for all walks or segments."""
        places, entries = [], []
        if self.lengths:
            ends = np.repeat(np.cumsum(counts), counts)
            tried = [(np.flatnonzero(np.arange(len(words)) + n <= ends), n) for n in self.lengths]
            looked = [(at, segment_keys(words, n)[at]) for at, n in tried]
        else:
            at = anchors(words, counts, self.span)
            looked = [(at, walk_keys(words, at, walk, self.steps, self.sampled)[0]) for walk in range(self.walks)]
        for starts, key in looked:
            maybe = np.flatnonzero(self.filter[(key >> self.shift).astype(np.int64)])
            key = key[maybe]
            low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            n = high - low
            places.append(np.repeat(starts[maybe], n))
            entries.append(np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum())))
        return np.concatenate(places), np.concatenate(entries)

    def search(self, words: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified matches: (text, item, first word, words, edits); the best of each text and item, then the first."""
        at, entry = self.meet(words, counts)
        ends = np.cumsum(counts)
        text = np.searchsorted(ends, at, "right")
        item, start = self.item[entry], at - self.offset[entry]
        tried = np.unique(np.stack([text, item, start], 1), axis=0) if len(at) else np.zeros((0, 3), np.int64)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        reach = np.array([len(w) + 2 * e for w, e in zip(self.items, self.edits, strict=True)], np.int64)[tried[:, 1]]
        far = np.r_[True, (tried[1:, :2] != tried[:-1, :2]).any(1) | (tried[1:, 2] - tried[:-1, 2] > reach[1:])] if len(tried) else np.zeros(0, bool)
        heads = np.flatnonzero(far)
        for (t, k, s), (_, _, last_s) in zip(tried[heads].tolist(), tried[np.r_[heads[1:], len(tried)] - 1].tolist() if len(tried) else [], strict=True):
            size, edits = len(self.items[k]), self.edits[k]
            first, last = int(ends[t] - counts[t]), int(ends[t])
            low, high = max(first, s - edits), min(last, last_s + size + edits)
            window = words[low:high].tolist()
            found, end = best_match(self.forward[k], size, window)
            if found <= edits:
                _, length = best_match(self.backward[k], size, window[max(0, end - size - found) : end][::-1])
                got = (found, low - first + end - length, length)
                if (t, k) not in best or got < best[t, k]:
                    best[t, k] = got
        return [(t, k, begin, length, found) for (t, k), (found, begin, length) in sorted(best.items())]


def load(benchmark: DataFrame, *, rate: float = RATE, recall: float = RECALL, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[list[Benchmark]]:
    """The benchmark in blocks of about ``block_words`` words, one on the driver at a time.

    The items of a block are parted by their shape, so that a short one does not make the windows of the others short.
    """
    hasher, held = word_hasher(), 0
    shapes: dict[tuple[int, int, int], tuple[list, list[list[int]]]] = {}

    def block() -> list[Benchmark]:
        out = [Benchmark(ids, items, rate) for ids, items in shapes.values()]
        for part in out:
            part.calibrate(recall)
        return out

    for row in benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t IS NOT NULL").toLocalIterator():
        words, _ = sequences(hasher, [row["t"]])
        if len(words):
            ids, items = shapes.setdefault(shape(len(words)), ([], []))
            ids.append(row["i"])
            items.append(words.tolist())
            held += len(words)
        if held >= block_words:
            yield block()
            shapes, held = {}, 0
    if shapes:
        yield block()


def matches(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, recall: float = RECALL, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Benchmark items in documents: ``doc_id, item_id, start_word, n_words, edits``, the best match of each pair.

    A document holds an item if some run of its words is within ``rate`` edits a word of it, rounded down. Case,
    punctuation and blanks do not count. Null and empty texts hold nothing; items without words are held by none.
    Repeated documents give their rows each; repeated items each match. Null ids stay null. Other columns are left
    out, so their names cannot clash; empty tables give an empty result.
    """
    spark = docs.sparkSession
    d, i = docs.schema[doc_id].dataType, benchmark.schema[item_id].dataType
    schema = f"doc_id {d.simpleString()}, item_id {i.simpleString()}, start_word int, n_words int, edits int"
    kinds = pa.schema([("doc_id", to_arrow_type(d)), ("item_id", to_arrow_type(i)), ("start_word", pa.int32()), ("n_words", pa.int32()), ("edits", pa.int32())])
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for block in load(benchmark, rate=rate, recall=recall, item_id=item_id, text="text"):
        shared = spark.sparkContext.broadcast(block)  # BLOCK_WORDS and an item more at most

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hasher = held("word hasher", word_hasher)
            for batch in batches:
                texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
                for a, b in chunks(texts):
                    words, counts = sequences(hasher, texts[a:b])
                    rows = [(ids[a + t], part.ids[k], begin, length, edits) for part in shared.value for t, k, begin, length, edits in part.search(words, counts)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

        found = docs.mapInArrow(trimmed(run), schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def remove(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents that hold no benchmark item; all columns stay, whatever their names.

    Rows are judged by their id and text together, so a row without an id by its text. Null and empty texts hold
    nothing and stay; with an empty benchmark all rows do.
    """
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, F.concat_ws(":", F.col(doc_id).cast("string"), F.xxhash64(F.coalesce(text, F.lit(""))).cast("string")))
    held = matches(keyed.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    held = written(held.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    few = held.count() <= BROADCAST_ROWS
    return keyed.join(F.broadcast(held) if few else held, key, "left_anti").select(*docs.columns)
