"""Classification: candidates, batches through an injected client, validation against the taxonomy."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import clip, present

BATCH, TEXT_CHARS, MAX_MATCHES = 6, 1500, 3


class ClassifierError(ValueError):
    """A reply that cannot be used."""


class PermanentClassifierError(ClassifierError):
    """A failure that no further request will mend."""


def candidates(rows: DataFrame, on_date: Column, version: str, *, force: bool = False) -> DataFrame:
    """Articles of a day that have no finished classification by this version of the taxonomy."""
    done = F.col("industry_classification_status").isin("classified", "unclassified") & (F.col("industry_taxonomy_version") == version)
    return rows.where(on_date).where(F.lit(force) | ~F.coalesce(done, F.lit(False)))


def payload(title: Column, source: Column, content: Column, limit: int = TEXT_CHARS) -> Column:
    return F.struct(F.left(present(title), F.lit(800)).alias("title"), F.left(present(source), F.lit(200)).alias("source"), clip(content, limit).alias("content"))


def parse_reply(reply: object) -> dict:
    """The JSON object of a reply: the reply itself, its whole text, or the first object in prose or fences."""
    if isinstance(reply, dict):
        return reply
    text = (reply if isinstance(reply, str) else "").strip()
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            found, _ = decoder.raw_decode(text, at)
            if isinstance(found, dict):
                return found
        except json.JSONDecodeError:
            pass
        at = text.find("{", at + 1)
    raise ClassifierError("the reply holds no JSON object")


def valid_matches(raw: DataFrame, taxonomy: DataFrame, least: float = 0.5, most: int = MAX_MATCHES) -> DataFrame:
    """The best matches of each article: paths of the taxonomy only, each once, by confidence in [0, 1].

    ``raw`` has ``article_id, pos, path array<string>, confidence, reason``. Of repeated paths the first that is
    confident enough counts; equal confidences keep the reply's order.
    """
    trimmed = raw.withColumn("path", F.transform("path", lambda p: F.trim(p))).withColumn("path_text", F.array_join("path", " > "))
    known = trimmed.join(F.broadcast(taxonomy.select(F.array_join("path", " > ").alias("path_text"))), "path_text", "left_semi")  # a taxonomy has some hundred rows
    sure = known.withColumn("confidence", F.least(F.greatest(F.col("confidence"), F.lit(0.0)), F.lit(1.0))).where(F.col("confidence") >= least)
    once = sure.groupBy("article_id", "path_text").agg(F.min_by(F.struct("pos", "path", "confidence", "reason"), F.col("pos")).alias("m")).select("article_id", "path_text", "m.*")
    rank = F.row_number().over(Window.partitionBy("article_id").orderBy(F.desc("confidence"), "pos"))
    return once.withColumn("confidence", F.bround("confidence", 4)).withColumn("rank", rank).where(F.col("rank") <= most).select("article_id", "rank", "path", "path_text", "confidence", F.left(F.trim(present("reason")), F.lit(300)).alias("reason"))


def batch_faults(asked: DataFrame, returned: DataFrame) -> DataFrame:
    """Ids of a batch that are missing, unexpected or returned twice: ``article_id, fault``."""
    both = asked.groupBy("article_id").agg(F.count("*").alias("a")).join(returned.groupBy("article_id").agg(F.count("*").alias("r")), "article_id", "full_outer")
    fault = F.when(F.col("r").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("r") > 1, "duplicate")
    return both.withColumn("fault", fault).where("fault IS NOT NULL").select("article_id", "fault")


def classify(rows: DataFrame, client: Callable[[list[dict]], object], *, batch: int = BATCH) -> DataFrame:
    """Replies of a client for ``article_id, payload``, in batches: ``article_id, matches (JSON), error``.

    A batch whose reply cannot be used is halved until single articles fail by themselves. After a permanent failure
    the rest of the partition is marked and no request is made any more.
    """

    def ask(items: list[tuple], state: dict) -> list[tuple]:
        if state["dead"]:
            return [(i, None, state["dead"]) for i, _ in items]
        try:
            found = {r["article_id"]: r.get("matches", []) for r in parse_reply(client([{"article_id": i, **p} for i, p in items])).get("results", [])}
            if set(found) != {i for i, _ in items}:
                raise ClassifierError("the reply's ids are not the batch's")
            return [(i, json.dumps(found[i], ensure_ascii=False), None) for i, _ in items]
        except PermanentClassifierError as e:
            state["dead"] = str(e)
            return [(i, None, str(e)) for i, _ in items]
        except ClassifierError as e:
            if len(items) == 1:
                return [(items[0][0], None, str(e))]
            half = len(items) // 2
            return ask(items[:half], state) + ask(items[half:], state)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = {"dead": ""}
        for frame in frames:
            items = [(i, dict(p)) for i, p in zip(frame["article_id"], frame["payload"], strict=True)]
            out = [r for k in range(0, len(items), batch) for r in ask(items[k : k + batch], state)]
            yield pd.DataFrame(out, columns=["article_id", "matches", "error"])

    return rows.select("article_id", "payload").mapInPandas(run, "article_id string, matches string, error string")
