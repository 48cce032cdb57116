"""Mind maps against the taxonomy of classes: every leaf of the map has to be a path of the taxonomy."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def leaves(topic: dict) -> Iterator[list[str]]:
    """Titles from the root to every topic without further ones, in their order, however deep the map is."""
    stack = [(topic, [])]
    while stack:
        node, above = stack.pop()
        path = [*above, str(node.get("title", ""))]
        below = ((node.get("children") or {}).get("attached")) or []
        if not below:
            yield path
        stack += [(child, path) for child in reversed(below)]


def map_leaves(data: bytes) -> Iterator[list[str]]:
    """Leaves of all sheets of a mind map, which is a zip with its topics as JSON."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        for sheet in json.loads(archive.read("content.json")):
            yield from leaves(sheet["rootTopic"])


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    """Distinct leaf paths of mind maps, one file a task: ``path array<string>``. A file that is no map is an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["content"]:
                yield pd.DataFrame({"path": list(map_leaves(bytes(data)))})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "path array<string>").distinct()


def leaves_of(topics: DataFrame, *, topic: str = "topic", parent: str = "parent", title: str = "title", deepest: int = 64) -> DataFrame:
    """Leaf paths of a forest that is stored as rows of topics with their parents: ``path array<string>``.

    Paths grow from the roots downwards, all topics of one depth at a time; a join a level, up to ``deepest``. Topics
    whose parent is not there, or that hang in a circle, belong to no root and are left out.
    """
    rows = topics.select(F.col(topic).alias("t"), F.col(parent).alias("p"), F.col(title).cast("string").alias("n"))
    inner = rows.where("p IS NOT NULL").select(F.col("p").alias("t")).distinct()
    level = rows.where("p IS NULL").select("t", F.array("n").alias("path"))
    out = level.join(inner, "t", "left_anti").select("path")
    for _ in range(deepest):
        level = level.select(F.col("t").alias("p"), "path").join(rows, "p").select("t", F.concat("path", F.array("n")).alias("path"))
        if level.isEmpty():
            break
        out = out.unionByName(level.join(inner, "t", "left_anti").select("path"))
    return out.distinct()


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a taxonomy file: ``path array<string>``."""
    rows = spark.read.schema("categories array<struct<path:array<string>>>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(F.explode("categories.path").alias("path")).distinct()


def compare(found: DataFrame, allowed: DataFrame) -> DataFrame:
    """``kind, path``: leaves that the taxonomy lacks (``missing``) and paths of it that are no leaf (``extra``)."""
    shown = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), F.array_join("path", " > ").alias("path"))
    a, b = found.select("path").distinct(), allowed.select("path").distinct()
    return shown(a.join(b, "path", "left_anti"), "missing").unionByName(shown(b.join(a, "path", "left_anti"), "extra"))


def verify(found: DataFrame, allowed: DataFrame, *, exact: bool = False) -> int:
    """Exit code: 1 if a leaf is missing, or, if asked for, if the taxonomy has paths of its own."""
    kinds = {r["kind"] for r in compare(found, allowed).select("kind").distinct().collect()}  # two at most
    return int("missing" in kinds or exact and "extra" in kinds)
