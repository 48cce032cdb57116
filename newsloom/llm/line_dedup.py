"""Operator 5, line dedup by a segment-partition edit join; DataFrame and SQL functions only.

A line is cut into ``edits`` + 1 segments. A line within that many edits of it holds one of the segments unchanged,
shifted by few places only, so each line is indexed by its segments with their number and its length, and looks up
the substrings of itself that can be such a segment of a line as long or little shorter (Li et al., 2011). What meets
in the index is verified by a bit-parallel automaton over the band of diagonals that so many edits can reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.columns import let, unused
from newsloom.llm.storage import release, written

#: Edits between two repeats of a line, and characters from which on a line is compared with near ones.
EDITS, MIN_CHARS = 2, 30
#: Characters whose numbers are compared before two lines are: an edit changes two of the numbers by one at most.
COUNTED = ["e", "a", "i", "n", "r", "s", "t", "o", "h", "l", "d", "cu", "mpg", "0123456789", " "]
#: Lines up to which a set of line hashes goes out as a broadcast (16 bytes each); beyond it joins are by shuffle.
BROADCAST_LINES = 500_000
#: Lines of an index entry that meet others in one block.
ENTRY_SIDE = 512


def _segment(length: Column, number: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment; the first ones are shorter by one where the length does not divide."""
    parts = edits + 1
    short, longer = F.floor(length / parts), length % parts
    first_long = parts - longer  # segments from this number on have one character more
    begin = short * number + F.greatest(F.lit(0), F.lit(number) - first_long) + 1
    return begin.cast("int"), (short + F.when(F.lit(number) >= first_long, 1).otherwise(0)).cast("int")


def lookups(line: Column, length: Column, edits: int) -> Column:
    """Array of the keys that a line looks up; the first ``edits`` + 1 are its own segments, by which it is indexed."""
    code = F.encode(line, "UTF-32")  # four bytes a character, so that a segment is found without counting characters
    own, other = [], []
    for shorter in range(edits + 1):
        target = length - shorter
        for i in range(edits + 1):
            begin, size = _segment(target, i, edits)
            # Shifts by which segment i can have moved if the edits before it and those after it are in balance.
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                key = F.xxhash64(F.lit(i), target, F.substring(code, (begin + shift) * 4 - 3, size * 4))
                (own if shorter == 0 and shift == 0 else other).append(key)
    return F.array(*own, *other)


def within(x: Column, y: Column, edits: int) -> Column:
    """Whether two texts, given as arrays of characters, are at most so many edits apart.

    Bit i of state d says that the characters of y so far can be turned into the first j - edits + i characters of x
    with d edits, j being how many characters of y there were.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1

    def close(states: list[Column]) -> list[Column]:
        """Skips characters of x, at the price of an edit each."""
        out = [states[0]]
        for s in states[1:]:
            out.append(s.bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(F.lit(mask)))
        return out

    def pack(states: list[Column]) -> Column:
        return F.struct(*(s.alias(f"r{d}") for d, s in enumerate(states)))

    def step(old: Column, char: Column, j: Column) -> Column:
        equal = F.lit(0)
        for i in range(width):
            at = j - edits + i
            equal = equal + F.when((at >= 0) & (F.get(x, at) == char), F.lit(1 << i)).otherwise(F.lit(0))

        def move(same: Column) -> Column:
            states = [old["r0"].bitwiseAND(same)]
            for d in range(1, edits + 1):
                before = old[f"r{d - 1}"]
                states.append(old[f"r{d}"].bitwiseAND(same).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)))
            return pack(close(states))

        return let(equal, move)

    places = F.transform(y, lambda c, j: F.struct(c.alias("c"), j.alias("j")))
    begin = pack(close([F.lit(1 << edits)] + [F.lit(0)] * edits))
    goal = F.size(x) - F.size(y) + edits
    return F.when(F.abs(F.size(x) - F.size(y)) > edits, F.lit(False)).otherwise(
        F.aggregate(places, begin, lambda s, p: step(s, p["c"], p["j"]), lambda s: F.call_function("shiftright", s[f"r{edits}"], goal).bitwiseAND(F.lit(1)) == 1)
    )


def _lines(docs: DataFrame, min_chars: int, short: bool = False) -> DataFrame:
    """Lines that are compared: two hashes, their place as (doc, text's hash, number), their text and length."""
    compared = F.col("n") >= min_chars
    compared = compared | F.col("line").rlike(r"(?U)\S") if short else compared
    lines = docs.select("doc", "t", F.posexplode(F.split("text", "\n")).alias("no", "line")).select("doc", "t", "no", "line", F.length("line").alias("n")).where(compared)
    return lines.select(F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"), F.struct("doc", "t", "no").alias("place"), "line", "n")


def _semi(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among distinct keys; these go out if they are few."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_LINES else keys, on, "left_semi")


def _texts(ids: DataFrame, docs: DataFrame, min_chars: int, name: str) -> DataFrame:
    """Distinct lines of some hashes with their first place, text and character counts."""
    rows = _semi(_lines(docs, min_chars), ids, ["h1"]).groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("line").alias("line"))
    counts = [(F.length("line") - F.length(F.translate("line", chars, ""))).alias(f"b{i}") for i, chars in enumerate(COUNTED)]
    return written(rows.select("h1", "h2", "first", "line", *counts), name)


def _alike(x: str, y: str, edits: int) -> Column:
    """Whether the character counts of two lines leave it open that they are near."""
    return sum((F.abs(F.col(f"{x}.b{i}") - F.col(f"{y}.b{i}")) for i in range(len(COUNTED))), F.lit(0)) <= 2 * edits


def _near(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Of pairs ``a, b`` of line hashes that are within the edits, the line whose first place is later: ``h1, h2``."""
    met = pairs.join(texts.alias("x"), F.col("a") == F.col("x.h1")).join(texts.alias("y"), F.col("b") == F.col("y.h1")).where(_alike("x", "y", edits))
    met = written(met.select(*(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("h1", "h2", "first", "line"))), "line-candidates")
    close = let(F.split("x_line", ""), lambda x: let(F.split("y_line", ""), lambda y: within(x, y, edits)))
    later = F.when(F.col("x_first") > F.col("y_first"), F.struct(F.col("x_h1").alias("h1"), F.col("x_h2").alias("h2"))).otherwise(F.struct(F.col("y_h1").alias("h1"), F.col("y_h2").alias("h2")))
    return met.where(close).select(later.alias("l")).select("l.h1", "l.h2").distinct()


def repeated_lines(docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines to remove from each document: ``doc_id, text_hash, n_lines, repeats array<int>`` (numbers from 0, ascending).

    Lines are what newlines part. A line of ``min_chars`` code points or more is a repeat if a line at an earlier
    place, by doc_id, hash of the text and number, equals it or is within ``edits`` edits (insertions, deletions and
    substitutions of code points) of it, whether that one is a repeat itself or not. A shorter line is a repeat only with ``short``, if it is
    not blank and a line at an earlier place equals it.

    A null text counts as empty, with one empty line. Null doc_ids come before all others. Repeated rows, with one
    doc_id and one text, stand for one document: their lines do not repeat each other, and each row is returned.
    Other columns are left out, so their names cannot clash; an empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).alias("doc"), F.coalesce(text, F.lit("")).alias("text")).select("doc", "text", F.xxhash64("text").alias("t"))
    lines = _lines(docs, min_chars, short)
    # Keys of short lines go unused; a condition around them would compute each of their parts anew.
    keyed = lines.select("h1", "h2", "place", "n", lookups(F.col("line"), F.col("n"), edits).alias("keys"))
    distinct = written(keyed.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("c"), F.min("n").alias("n"), F.first("keys").alias("keys")), "distinct-lines")
    rows = distinct.where(F.col("n") >= min_chars).select("h1", F.posexplode("keys").alias("at", "key")).select("key", "h1", (F.col("at") <= edits).alias("own"))
    # Keys of an index entry that some other line looks up; minima are combined before they are dealt out.
    own = F.when(F.col("own"), F.col("h1"))
    shared = rows.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.min(own).alias("hub"), F.max(own).alias("top"))
    shared = written(shared.where("hub IS NOT NULL AND low <> high").select("key", "hub", (F.col("hub") != F.col("top")).alias("multi")), "shared-keys")
    few = shared.count() <= BROADCAST_LINES
    met = written(rows.join(F.broadcast(shared) if few else shared, "key").where("h1 <> hub OR multi").groupBy("key", "h1").agg(F.max("own").alias("own"), F.first("hub").alias("hub"), F.first("multi").alias("multi")), "line-hubs")

    stars = written(met.where("h1 <> hub").select(F.least("h1", "hub").alias("a"), F.greatest("h1", "hub").alias("b")).distinct(), "line-stars")
    ids = written(stars.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), "line-ids")
    near = written(_near(stars, _texts(ids, docs, min_chars, "star-texts"), edits), "near-lines")
    # Entries of several indexed lines: the others meet too, where counts leave it open and the later line of the two is
    # not known as a repeat yet.
    many = met.where("multi").select("key", "h1", "hub", "own")
    texts = _texts(many.select("h1").distinct(), docs, min_chars, "entry-texts")
    state = texts.drop("line").join(near.withColumn("known", F.lit(True)), ["h1", "h2"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    others = written(_entry_pairs(many, written(state, "line-state"), edits).join(stars, ["a", "b"], "left_anti"), "line-pairs")
    near = written(near.unionByName(_near(others, texts, edits)).distinct(), "near-lines")

    flagged = distinct.select("h1", "h2", "first", "c").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("c > 1 OR near")
    flagged = written(flagged.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "flagged-lines")
    release(distinct, shared, met, stars, ids, texts, others, near)
    few = flagged.count() <= BROADCAST_LINES
    gone = lines.select("h1", "h2", "place").join(F.broadcast(flagged) if few else flagged, ["h1", "h2"]).where("near OR place <> first").select("place.*")
    gone = gone.groupBy("doc", "t").agg(F.array_sort(F.collect_set("no")).alias("repeats"))
    every = docs.select("doc", "t", F.size(F.split("text", "\n")).alias("n_lines"))
    out = every.alias("e").join(gone.alias("g"), F.expr("e.doc <=> g.doc AND e.t = g.t"), "left")
    return out.select(F.col("e.doc").alias("doc_id"), F.col("e.t").alias("text_hash"), "n_lines", F.coalesce("repeats", F.array().cast("array<int>")).alias("repeats"))


def _entry_pairs(members: DataFrame, state: DataFrame, edits: int) -> DataFrame:
    """Pairs ``a, b`` of lines that share an index entry and that their counts leave open.

    The lines of an entry and those indexed in it are dealt into blocks of ENTRY_SIDE, and each pair of blocks is a
    key of the join, so that no task gets more than a block of either side at once.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / ENTRY_SIDE).cast("int").alias("nx"), F.ceil(F.sum(F.when((F.col("h1") != F.col("hub")) & F.col("own"), 1).otherwise(0)) / ENTRY_SIDE).cast("int").alias("ny"))
    sizes = written(sizes.where("ny > 0"), "entry-sizes")
    placed = members.join(sizes, "key")
    x = placed.select("key", "h1", F.pmod(F.xxhash64("h1"), F.col("nx")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("j"))
    y = placed.where("own AND h1 <> hub").select("key", "h1", F.pmod(F.xxhash64("h1"), F.col("ny")).cast("int").alias("j"), F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("i"))
    unknown = F.expr("x.key = y.key AND x.i = y.i AND x.j = y.j AND x.h1 <> y.h1 AND NOT (CASE WHEN x.first > y.first THEN x.known ELSE y.known END)")
    met = x.join(state, "h1").alias("x").join(y.join(state, "h1").alias("y"), unknown & _alike("x", "y", edits))
    return met.select(F.least("x.h1", "y.h1").alias("a"), F.greatest("x.h1", "y.h1").alias("b")).distinct()


def remove(docs: DataFrame, repeats: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without their repeated lines; all columns stay, whatever their names.

    ``repeats`` is what ``repeated_lines`` returns for the documents. A null text stays null, a row with a null id
    loses the lines found for its text, a text all of whose lines go becomes empty. An empty table stays empty.
    """
    own = unused(docs, "lines_gone")
    some = repeats.where(F.size("repeats") > 0).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("repeats").alias(own)).distinct().alias("s")
    kept = F.array_join(F.transform(F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(F.col(own), s["i"])), lambda s: s["x"]), "\n")
    joined = docs.alias("o").join(some, F.col(f"o.{doc_id}").eqNullSafe(F.col("s.d")) & (F.xxhash64(F.coalesce(F.col(f"o.{text}"), F.lit(""))) == F.col("s.t")), "left").select("o.*", f"s.{own}")
    return joined.withColumn(text, F.when(F.col(own).isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
