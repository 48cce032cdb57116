"""A stored article table that a batch changes in proportion to the batch, not to the table.

Rows lie in files by commit and by bucket of the hash of their key. A batch asks the Bloom filters of the commits which
of its keys may be stored, reads only the buckets of those commits, merges, and adds a commit: the rows that are new or
better, and the places of the rows that they stand for now. Nothing is overwritten, so a reader of a snapshot is never
disturbed. Commits are numbered files in a log, created only where there is none of that number: of two writers that
start from the same table one commits, the other merges once more. A writer that dies while it writes its entry leaves
a number that nobody gets; writers then end in ``Conflict`` until that file is deleted. ``compact`` writes buckets anew of which a good part
is dead or that lie in many commits.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.articles import upsert

#: Buckets of a table; bits of a filter for a key, of a bitmap that Spark builds, and places that a key sets.
BUCKETS, BITS, BITMAP, HASHES = 64, 12, 32_768, 4
#: Dead rows, as a share of a bucket's, and commits that a bucket may lie in, from which on it is written anew.
DEAD, COMMITS = 0.2, 8


class Conflict(RuntimeError):
    """Another writer has committed first, again and again."""


@dataclass
class Snapshot:
    """One state of a table: the commits whose rows it has, those whose dead places it heeds, and what came in last."""

    number: int = 0
    data: list[str] = field(default_factory=list)
    dead: list[str] = field(default_factory=list)
    next_seq: int = 0
    labels: list[str] = field(default_factory=list)
    buckets: int = BUCKETS


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(buckets)).cast("int")


def places(key: Column, parts: Column) -> Column:
    """The bits that a key sets in a filter of some bitmaps."""
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(100 + i)), parts * BITMAP) for i in range(HASHES)))


def filters(rows: DataFrame, key: str, bucket: str) -> DataFrame:
    """Bloom filters of the keys of each bucket: ``bucket, parts, part, bitmap``. A bucket has as many bitmaps as its
    rows need; Spark sets their bits in partial aggregates."""
    sized = rows.groupBy(bucket).agg(F.greatest(F.ceil(F.count("*") * BITS / BITMAP), F.lit(1)).alias("parts"))
    bits = rows.join(sized, bucket).select(F.col(bucket).alias("bucket"), "parts", F.explode(places(F.col(key), F.col("parts"))).alias("bit"))
    return bits.groupBy("bucket", "parts", (F.col("bit") / BITMAP).cast("long").alias("part")).agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(BITMAP))).alias("bitmap"))


def is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))


def _name() -> str:
    """A name of a commit, which no reader of partitions takes for a number."""
    return "c" + uuid.uuid4().hex


class Store:
    """A table of articles in a folder, by ``key``; ``columns`` as in the batches that are put in."""

    def __init__(self, spark: SparkSession, folder: str, key: str, *, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.key, self.buckets = spark, folder.rstrip("/"), key, buckets

    # The log

    def _fs(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def numbers(self) -> list[int]:
        fs, path = self._fs("_log")
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in (fs.listStatus(path) if fs.exists(path) else []) if s.getPath().getName().endswith(".json"))

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The last state, or that of a number; an entry that its writer did not finish counts as not there."""
        for n in reversed([n for n in self.numbers() if number is None or n <= number]):
            text = "\n".join(r[0] for r in self.spark.read.text(f"{self.folder}/_log/{n:010d}.json").collect())  # one line
            if text.endswith("}"):
                return Snapshot(**json.loads(text))
        return Snapshot(buckets=self.buckets)

    def _commit(self, after: Snapshot) -> bool:
        """Whether the state is the table's now: its number was free."""
        fs, path = self._fs("_log", f"{after.number:010d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as taken:
            if "AlreadyExists" in taken.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(json.dumps(asdict(after)).encode()))
        out.close()
        return True

    # Reading

    def _rows(self, commits: list[str], buckets: list[int] | None = None) -> DataFrame | None:
        if not commits:
            return None
        rows = self.spark.read.option("basePath", f"{self.folder}/data").parquet(*(f"{self.folder}/data/commit={c}" for c in commits))
        return rows if buckets is None else rows.where(F.col("_bucket").isin(buckets))

    def _live(self, rows: DataFrame, state: Snapshot) -> DataFrame:
        if not state.dead:
            return rows
        dead = self.spark.read.parquet(*(f"{self.folder}/dead/{c}" for c in state.dead)).select("_seq", "commit")
        return rows.join(dead, ["_seq", "commit"], "left_anti")

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a snapshot, with ``_seq``, the place in which their address came first; null for no table."""
        state = self.snapshot(number)
        rows = self._rows(state.data)
        return None if rows is None else self._live(rows, state).drop("commit", "_bucket")

    def may_hold(self, keys: DataFrame, state: Snapshot) -> DataFrame:
        """``key, bucket, commit`` of every key and commit whose filter does not rule it out."""
        blooms = self.spark.read.option("basePath", f"{self.folder}/bloom").parquet(*(f"{self.folder}/bloom/commit={c}" for c in state.data))
        asked = keys.select(F.col(self.key).alias("key")).distinct().withColumn("bucket", bucket_of(F.col("key"), state.buckets))
        sizes = blooms.select("commit", "bucket", "parts").distinct()
        bits = asked.join(sizes, "bucket").select("key", "bucket", "commit", F.explode(places(F.col("key"), F.col("parts"))).alias("bit")).withColumn("part", (F.col("bit") / BITMAP).cast("long"))
        hits = bits.join(blooms, ["commit", "bucket", "part"]).where(is_set(F.col("bitmap"), F.pmod("bit", F.lit(BITMAP))))
        return hits.groupBy("key", "bucket", "commit").agg(F.count("*").alias("n")).where(F.col("n") == HASHES).drop("n")

    # Writing

    def _add(self, rows: DataFrame, commit: str, buckets: int) -> None:
        """Writes rows of a commit, one file a bucket, and their filters."""
        placed = rows.withColumn("_bucket", bucket_of(F.col(self.key), buckets))
        placed.repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(f"{self.folder}/data/commit={commit}")
        there = self.spark.read.option("basePath", f"{self.folder}/data").parquet(f"{self.folder}/data/commit={commit}")
        filters(there, self.key, "_bucket").write.mode("overwrite").parquet(f"{self.folder}/bloom/commit={commit}")

    def put(self, incoming: DataFrame, *, label: str = "", tries: int = 5) -> dict[str, int]:
        """Merges a batch as ``articles.upsert`` does and says how many rows were added, updated, kept and read.

        Rows of the batch need ``_seq``, their order in it; stored rows come before them. A batch of a label that has
        been put in before changes nothing. If another writer commits meanwhile, the batch is merged once more.
        """
        for _ in range(tries):
            state = self.snapshot()
            if label and label in state.labels:
                return {"added": 0, "updated": 0, "kept": 0, "read": 0}
            commit = _name()
            done = self._merge(incoming, state, commit)
            wrote = done["added"] + done["updated"]
            after = Snapshot(state.number + 1, state.data + [commit] * (wrote > 0), state.dead + [commit] * (done["updated"] > 0), done.pop("next_seq"), (state.labels + [label])[-1000:] if label else state.labels, state.buckets)
            fs, work = self._fs("work", commit)
            committed = self._commit(after)
            fs.delete(work, True)
            if committed:
                return done
        raise Conflict(f"{self.folder}: {tries} times another writer was first")

    def _merge(self, incoming: DataFrame, state: Snapshot, commit: str) -> dict[str, int]:
        new = incoming.withColumn("_seq", F.col("_seq") + F.lit(state.next_seq))
        work = f"{self.folder}/work/{commit}"
        if state.data:
            self.may_hold(incoming, state).write.parquet(f"{work}/hits")
            hits = self.spark.read.parquet(f"{work}/hits")
            where = hits.select("commit", "bucket").distinct().collect()  # commits x buckets at most, as the log
            commits, buckets = sorted({r["commit"] for r in where}), sorted({r["bucket"] for r in where})
            held = self._rows(commits or state.data[-1:], buckets)
            stored = self._live(held, state).join(hits.select(F.col("key").alias(self.key)).distinct(), self.key, "left_semi")
        else:
            stored = new.limit(0).withColumn("commit", F.lit("")).withColumn("_bucket", F.lit(0))
        upsert(stored.select(new.columns), new, self.key, "_seq").write.parquet(f"{work}/merged")
        merged = self.spark.read.parquet(f"{work}/merged")
        counts = {r["change"]: r["n"] for r in merged.groupBy("change").agg(F.count("*").alias("n")).collect()}  # three kinds
        changed = merged.where("change <> 'kept'").drop("change")
        if counts.get("added") or counts.get("updated"):
            self._add(changed, commit, state.buckets)
        if counts.get("updated"):
            gone = stored.join(merged.where("change = 'updated'").select("_seq"), "_seq", "left_semi")
            gone.select("_seq", "commit", "_bucket").write.parquet(f"{self.folder}/dead/{commit}")
        last = new.agg(F.max("_seq")).first()[0]
        return {"added": counts.get("added", 0), "updated": counts.get("updated", 0), "kept": counts.get("kept", 0), "read": sum(counts.values()) - counts.get("added", 0), "next_seq": state.next_seq if last is None else last + 1}

    def compact(self, *, dead: float = DEAD, commits: int = COMMITS) -> list[int]:
        """Writes the buckets anew that have too many dead rows or lie in too many commits; which ones they were.

        The other buckets' rows stay where they are: a commit of which buckets were taken out is listed with those
        rows as dead, so their places are not read again.
        """
        state = self.snapshot()
        rows = self._rows(state.data)
        if rows is None:
            return []
        live = self._live(rows, state)
        every = rows.groupBy("_bucket").agg(F.count("*").alias("n"), F.countDistinct("commit").alias("commits"))
        both = every.join(live.groupBy("_bucket").agg(F.count("*").alias("live")), "_bucket", "left").collect()  # a row a bucket
        taken = sorted(r["_bucket"] for r in both if r["commits"] > commits or 1 - (r["live"] or 0) / r["n"] > dead)
        if not taken:
            return []
        commit = _name()
        chosen = live.where(F.col("_bucket").isin(taken))
        if len(taken) == len(both):  # nothing of the old commits is left
            self._add(chosen.drop("commit", "_bucket"), commit, state.buckets)
            after = Snapshot(state.number + 1, [commit], [], state.next_seq, state.labels, state.buckets)
        else:
            self._add(chosen.drop("commit", "_bucket"), commit, state.buckets)
            chosen.select("_seq", "commit", "_bucket").write.parquet(f"{self.folder}/dead/{commit}")
            after = Snapshot(state.number + 1, [*state.data, commit], [*state.dead, commit], state.next_seq, state.labels, state.buckets)
        return taken if self._commit(after) else []

    def vacuum(self) -> list[str]:
        """Deletes the files of commits that the last snapshot does not name; readers of older ones must be done."""
        state, gone = self.snapshot(), []
        for kind, named in (("data", state.data), ("bloom", state.data), ("dead", state.dead)):
            fs, path = self._fs(kind)
            for status in fs.listStatus(path) if fs.exists(path) else []:
                name = status.getPath().getName().removeprefix("commit=")
                if name not in named:
                    fs.delete(status.getPath(), True)
                    gone.append(f"{kind}/{name}")
        fs, path = self._fs("work")
        fs.delete(path, True)
        return gone
