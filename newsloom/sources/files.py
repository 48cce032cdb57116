"""Readers and writers of files: JSON lines, CSV with a byte-order mark, nested JSON, workbooks, versioned tables."""

from __future__ import annotations

import datetime as dt
import io
import itertools
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import is_challenge, present, strip
from newsloom.operators.articles import FIELDS, normalise
from newsloom.sources import workbooks

MATCH = "array<struct<path:array<string>,path_text:string,confidence:double,reason:string>>"
ARTICLE = ", ".join(f"{c} {MATCH if c == 'industry_classifications' else 'string'}" for c in FIELDS)
HEALTH_COUNTS = ["candidates_seen", "pages_fetched", "new_articles", "refreshed_articles", "usable_articles", "incomplete_articles", "short_articles", "min_content_chars", "content_chars_min", "content_chars_median", "content_chars_max"]
HEALTH = "generated_at string, target_date string, sources array<struct<" + ",".join(f"{c}:string" for c in ("source", "frequency", "status", "reason", "crawl_mode", "error_type")) + "," + ",".join(f"{c}:long" for c in HEALTH_COUNTS) + ">>"


def read_articles(spark: SparkSession, path: str, *, keep_malformed: bool = False) -> DataFrame:
    """Articles from JSON lines. Lines that are no JSON are dropped, or kept as they are in ``_corrupt``."""
    if not keep_malformed:
        return spark.read.schema(ARTICLE).option("mode", "DROPMALFORMED").json(path)
    return spark.read.schema(ARTICLE + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def stored_quality(rows: DataFrame) -> DataFrame:
    """Stored records in which a challenge page that was saved as an article counts as missing."""
    return rows.withColumn("content_status", F.when(is_challenge(F.col("content")), "missing").otherwise(present("content_status")))


def collected(rows: DataFrame, key: Column) -> DataFrame:
    """Addresses whose text is stored in full, each once: a later run need not fetch them again."""
    return rows.where(F.lower(strip(present("content_status"))) == "full").select(key.alias("url_key")).distinct()


def longest_content(rows: DataFrame, key: Column) -> DataFrame:
    """Greatest trimmed text length per address."""
    return rows.groupBy(key.alias("url_key")).agg(F.max(F.length(strip(present("content")))).alias("content_chars"))


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """CSV with a header, quoted newlines and a possible byte-order mark; absent columns as empty strings."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    have = {c.lstrip("﻿"): c for c in rows.columns}
    return rows.select(*((present(f"`{have[c]}`") if c in have else F.lit("")).alias(c) for c in columns), F.col("_metadata.file_path").alias("_file"))


def file_date(name: Column) -> Column:
    """The day in the name of a daily export, which may be a file or a folder of files: the last day in its path."""
    return F.try_to_timestamp(F.regexp_extract(name, r".*(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date")


def daily_paths(folder: str, first: dt.date, last: dt.date) -> list[str]:
    """Names of the daily exports of a window, so that only their files are listed and read."""
    return [f"{folder}/articles-{first + dt.timedelta(days=k)}.csv" for k in range((last - first).days + 1)]


def read_window(spark: SparkSession, folder: str, first: dt.date, last: dt.date, columns: list[str]) -> DataFrame:
    """Articles of the daily exports of a window with the day of their file as ``summary_date``; absent days have none."""
    there = [p for p in daily_paths(folder, first, last) if exists(spark, p)]
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_file"])
    rows = read_csv(spark, there, columns) if there else spark.createDataFrame([], schema)
    return rows.withColumn("summary_date", file_date(F.col("_file"))).drop("_file")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text beside its place and moves it there, on any file system."""
    jvm = spark.sparkContext._jvm
    final, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(final, False)
    fs.rename(part, final)


def first_path(spark: SparkSession, paths: list[str]) -> str:
    """The first of several places that is there, as for the channel workbook; none of them is an error."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths))


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON state file; a corrupt one is an error, never an empty state."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def health_rows(health: DataFrame) -> DataFrame:
    """One row per channel of health reports; rows without a channel are left out, absent counts are zero."""
    rows = health.select("generated_at", "target_date", F.explode("sources").alias("s")).where(present("s.source") != "")
    return rows.select("generated_at", "target_date", *(present(f"s.{c}").alias(c) for c in ("source", "frequency", "status", "reason", "crawl_mode", "error_type")), *(F.coalesce(f"s.{c}", F.lit(0).cast("long")).alias(c) for c in HEALTH_COUNTS))


def write_articles(rows: DataFrame, path: str) -> None:
    """Appends normalised articles as JSON lines."""
    normalise(rows).write.mode("append").json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV of fixed columns; nested values as JSON, others ignored; blanks around a text are the text's."""
    nested = {f.name for f in rows.schema if isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)}
    rows.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in columns)).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_partitioned(rows: DataFrame, path: str, day: str) -> None:
    """Articles in a folder per day; re-writing a day replaces that day only."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def export_day(rows: DataFrame, folder: str, day: dt.date, columns: list[str], date: Column) -> str:
    """The CSV export of one publication day; its folder is there even if the day has no rows."""
    path = f"{folder}/articles-{day}.csv"
    write_csv(rows.where(date == F.lit(day)), path, columns)
    return path


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str, str, bool]]:
    """Versions of a state table in the order they were begun: number, label, path, whether it was committed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        if name := re.fullmatch(r"version=(\d+)-(.*)", status.getPath().getName()):
            found.append((int(name[1]), name[2], str(status.getPath()), fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))))
    return sorted(found)


def claim(spark: SparkSession, folder: str) -> int:
    """The next number of a version, taken by creating a file that must not be there yet: of two writers that see the
    same last version one gets the next number and the other the one after it, wherever the store creates atomically."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    number = max((n for n, *_ in versions(spark, folder)), default=0) + 1
    while True:
        try:
            fs.create(jvm.org.apache.hadoop.fs.Path(root, f"_claims/{number:010d}"), False).close()
            return number
        except Py4JJavaError as taken:
            if "AlreadyExists" not in taken.java_exception.getClass().getName():
                raise
            number += 1


def write_version(rows: DataFrame, folder: str, label: str) -> str:
    """A state table as a new version behind all others, which stay as they are, so ``rows`` may be made of them.

    A version counts once its ``_SUCCESS`` marker is there: a write that fails, or is still under way, is never read.
    """
    path = f"{folder}/version={claim(rows.sparkSession, folder):010d}-{label}"
    rows.write.mode("error").parquet(path)
    return path


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all committed versions, for tables whose versions are additions."""
    return [path for _, _, path, done in versions(spark, folder) if done]


def latest_version(spark: SparkSession, folder: str) -> str | None:
    """Path of the last version that was committed, on any file system."""
    return max(((n, path) for n, _, path, done in versions(spark, folder) if done), default=(0, None))[1]


def purge_challenges(rows: DataFrame) -> DataFrame:
    return rows.where(~is_challenge(F.col("content")))


#: Headers of the channel workbook, and of the export workbook with the names that they may have.
SOURCE_HEADERS = {"name": "媒体名称", "media_type": "媒体类型", "domain": "领域", "sub_domain": "细分领域", "frequency": "更新频率", "description": "简介", "note": "备注", "url": "链接"}
EXPORT_HEADERS = {"title": ["新闻标题"], "published_at": ["发布时间"], "media": ["发布媒体"], "url": ["链接"], "content": ["新闻全文"]}


def write_workbook(sheets: dict[str, tuple[list[str], list[list]]]) -> bytes:
    """A workbook of sheets of (header, rows), for small roll-ups that a person opens."""
    out = io.BytesIO()
    book = workbooks.Book(out)
    for name, (header, content) in sheets.items():
        book.sheet(name, header, content)
    book.close()
    return out.getvalue()


def header_names(header: str) -> set[str]:
    """A header as it stands and as it was before its GBK bytes were read as Latin-1."""
    out = {header.strip()}
    try:
        out.add(header.strip().encode("latin-1").decode("gbk"))
    except UnicodeError:
        pass
    return out


def _sheets(spark: SparkSession, path: str, fields: dict[str, list[str]]) -> DataFrame:
    """Rows of workbooks, one file a task; a workbook without a required header is an error."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                rows = workbooks.rows(bytes(data))
                header = [header_names(h) for h in next(rows, [])]
                at = {f: next((i for i, h in enumerate(header) if h & set(names)), None) for f, names in fields.items()}
                if missing := [f for f, i in at.items() if i is None]:
                    raise ValueError(f"{name} has no column for {', '.join(missing)}")
                numbered = enumerate(rows)
                while part := list(itertools.islice(numbered, workbooks.BATCH)):
                    yield pd.DataFrame([{f: row[i].strip() if i < len(row) else "" for f, i in at.items()} | {"_pos": k} for k, row in part], columns=[*fields, "_pos"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, ", ".join(f"{f} string" for f in fields) + ", _pos long")


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The channel dimension from a workbook: rows with a name or an address."""
    return _sheets(spark, path, {k: [v] for k, v in SOURCE_HEADERS.items()}).where("name <> '' OR url <> ''").drop("_pos")


def read_export(spark: SparkSession, path: str, media_prefix: str, day: Column, date_of) -> DataFrame:
    """Articles of one medium and day from export workbooks; of an address the first row counts."""
    rows = _sheets(spark, path, EXPORT_HEADERS).where("title <> '' AND url <> ''").where(F.col("media").startswith(media_prefix))
    rows = rows.withColumn("date", date_of(F.col("published_at"))).where(F.col("date") == day)
    return rows.groupBy("url").agg(F.min_by(F.struct("title", "published_at", "media", "content", "date"), F.col("_pos")).alias("r")).select("url", "r.*")
