"""Operator 2, SentencePiece encoding and decoding by vectorised merge rounds.

Distinct words are laid out in one flat symbol array. Each round finds every word's best-ranked adjacent pair by a
segmented minimum, merges all leftmost occurrences of it at once and compacts the array, until no pair is left.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import WordTable, chunks, expand, held, trimmed

SPACE = "▁"
NONE = np.int32(2**31 - 1)


class PieceModel:
    """Tables of a BPE model: its pieces, which pairs of symbols merge, and in what order."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        self.byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.hidden = np.array([model.is_control(i) for i in range(n)])
        ids = {self.pieces[i]: i for i in plain}
        scores = {p: model.get_score(i) for p, i in ids.items()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {p: order[s] for p, s in scores.items()}
        if any(c == SPACE and k and p[k - 1] != SPACE for p in ids for k, c in enumerate(p)):
            raise ValueError("pieces that span words are not supported")
        self.newline_splits = not any("\n" in p for p in ids)
        symbols = dict.fromkeys(ids) | dict.fromkeys(c for p in ids for c in p)
        self.symbol_of = {s: k for k, s in enumerate(symbols)}
        self.symbol_text = list(self.symbol_of)
        self.symbol_id = np.array([ids.get(s, -1) for s in self.symbol_text], np.int32)
        left, right, whole = [], [], []
        for p in ids:
            for k in range(1, len(p)):
                if p[:k] in self.symbol_of and p[k:] in self.symbol_of:
                    left.append(self.symbol_of[p[:k]])
                    right.append(self.symbol_of[p[k:]])
                    whole.append(self.symbol_of[p])
        keys = np.array(left, np.int64) * len(self.symbol_of) + np.array(right, np.int64)
        by = np.argsort(keys)
        self.keys, self.merged = keys[by], np.array(whole, np.int32)[by]
        ranks = np.full(len(self.symbol_of), NONE, np.int32)
        for p, r in rank.items():
            ranks[self.symbol_of[p]] = r
        self.rank_of = ranks
        # A merge whose result can at once grow into a piece of the same or a better rank has to go one at a time.
        single = np.zeros(len(self.symbol_of), bool)
        for p, r in rank.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if (i or j < len(p)) and (inner := p[i:j]) in rank and rank[inner] >= r:
                        single[self.symbol_of[inner]] = True
        self.single = single
        self.char_symbol = np.full(0x110000, -1, np.int32)
        for s, k in self.symbol_of.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = k

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; NONE where they do not merge."""
        keys = left.astype(np.int64) * len(self.symbol_text) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        merged = np.where(hit, self.merged[at], -1)
        return np.where(hit, self.rank_of[merged], NONE), merged

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words after all merges: (symbols, counts). A symbol under 0 is -2 less a character's code."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sym = self.char_symbol[chars].astype(np.int64)
        sym = np.where(sym < 0, -2 - chars, sym)
        word = np.repeat(np.arange(len(words)), lengths)
        rank, merged = self._pairs(sym, word)
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            best = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(best < NONE, sizes)
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, merged = sym[open_], word[open_], rank[open_], merged[open_]
                sizes = sizes[best < NONE]
                best = best[best < NONE]
                if not len(sym):
                    break
                starts = np.cumsum(sizes) - sizes
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # Overlapping occurrences stand side by side: every second one of a run goes, from its left end.
            fresh = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            alone = np.zeros(len(at), bool)
            alone[:] = np.repeat(self.single[merged[at[first]]], np.diff(np.r_[np.flatnonzero(first), len(at)]))
            at = at[first | ~alone]
            sym[at] = merged[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
            touched = place[at]
            touched = np.unique(np.r_[touched, touched[touched > 0] - 1])
            rank[touched], merged[touched] = NONE, -1
            inner = touched[touched < len(sym) - 1]
            inner = inner[word[inner] == word[inner + 1]]
            rank[inner], merged[inner] = self.lookup(sym[inner], sym[inner + 1])
        if done_sym:
            sym, word = np.concatenate(done_sym), np.concatenate(done_word)
            by = np.argsort(word, kind="stable")
            sym, word = sym[by], word[by]
        return sym, np.bincount(word, minlength=len(words)).astype(np.int64)

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, merged = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], merged[inner] = self.lookup(sym[inner], sym[inner + 1])
        return rank, merged

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of words whose spaces are already marks; characters without a piece become their bytes."""
        sym, counts = self.merge(words)
        known = np.where(sym >= 0, self.symbol_id[np.maximum(sym, 0)], -1)
        bad = np.flatnonzero(known < 0)
        if not len(bad):
            return known.astype(np.int32), counts
        sizes, spelled = np.ones(len(sym), np.int64), []
        for i in bad.tolist():
            char = chr(-2 - int(sym[i])) if sym[i] < 0 else self.symbol_text[int(sym[i])]
            own = self.byte_ids[np.frombuffer(char.encode("utf-8", "surrogatepass"), np.uint8)]
            own = own if (own >= 0).all() else np.array([self.unknown], np.int32)
            spelled.append(own)
            sizes[i] = len(own)
        at = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int32)
        good = np.flatnonzero(known >= 0)
        out[at[good]] = known[good]
        out[expand(at[bad], sizes[bad])] = np.concatenate(spelled)
        word = np.repeat(np.repeat(np.arange(len(words)), counts), sizes)
        return out, np.bincount(word, minlength=len(words)).astype(np.int64)

    def words(self, text: str) -> list[str]:
        """A text as keys of words. A key that begins with a newline or a space stands for itself; any other has a
        space mark before it. No merge crosses from one key to the next."""
        text = text.replace(SPACE, " ") if SPACE in text else text
        if not text:
            return []
        if self.newline_splits and "  " not in text and text[0] != " ":
            return text.replace("\n", " \n").split(" ")
        found = re.findall(r"\n[^ \n]*| +[^ \n]*" if self.newline_splits else r" +[^ ]*", " " + text)
        return [k[1:] if k[0] == " " and k[1:2] not in (" ", "\n") else k for k in found]

    def key_ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.ids([(k if k[:1] in ("\n", " ") and k else SPACE + k).replace(" ", SPACE) for k in keys])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id sequences: pieces with marks as spaces, byte pieces as UTF-8, one leading space taken off.

        Bytes that are no UTF-8 give U+FFFD each; the unknown id gives its usual sign, control ids nothing.
        """
        if not hasattr(self, "_spelled"):
            is_byte = np.zeros(len(self.pieces), bool)
            is_byte[self.byte_ids[self.byte_ids >= 0]] = True
            spelled = [p.replace(SPACE, " ").encode() for p in self.pieces]
            for value, i in enumerate(self.byte_ids.tolist()):
                if i >= 0:
                    spelled[i] = bytes([value])
            for i in np.flatnonzero(self.hidden).tolist():
                spelled[i] = b""
            spelled[self.unknown] = " ⁇ ".encode()
            self._spelled, self._is_byte = np.array(spelled, object), is_byte
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = ids[a:b]
            raw = b"".join(self._spelled[own].tolist())
            if len(own) and self.pieces[int(own[0])].startswith(SPACE):
                raw = raw[1:]
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_lenient(raw))
        return out


def _lenient(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_texts(model: PieceModel, table: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts one after the other, and how many each has."""
    lists = [model.words(t) for t in texts]
    codes = table.codes([w for words in lists for w in words])
    ids, counts = table.gather(codes)
    ends = np.r_[0, np.cumsum(counts)][np.cumsum([0, *map(len, lists)])]
    return ids, np.diff(ends)


def encode_decode(docs: DataFrame, model_path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text and the text that they decode to: ``doc_id, ids array<int>, decoded string``.

    Ids are those of the sentencepiece library without begin and end ids. The model's tables go to the executors
    once, as a broadcast bounded by its vocabulary. A null text counts as empty: no ids, and an empty text decoded.
    Rows keep their number: repeated rows and null ids are encoded as they are. Other columns are left out, so
    their names cannot clash. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(PieceModel(model_path))
    name = f"{model_path}:{uuid.uuid4().hex}"
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = held(name, lambda: (shared.value, WordTable(shared.value.key_ids, np.int32)))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                ids, counts = encode_texts(model, table, texts[a:b])
                offsets = np.r_[0, np.cumsum(counts)]
                decoded = model.decode(ids, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(trimmed(run), f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Lengths and checksums of encoded documents: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
