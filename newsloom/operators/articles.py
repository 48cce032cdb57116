"""Articles: the best record of each address, upserts, roll-up dedup, enrichment that survives a refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.dates import published_date, url_date
from newsloom.functions.text import assess, content_rank, present, strip, title_key

#: Columns of an article, and those of its classification.
FIELDS = [
    "title", "published_at", "content", "content_status", "content_issue", "content_extraction", "url", "source_name", "domain", "sub_domain", "crawled_at",
    "industry_primary_path", "industry_top_level", "industry_leaf", "industry_classifications", "industry_classification_status", "industry_classified_at",
    "industry_classifier_model", "industry_taxonomy_version", "industry_classification_error",
]
ENRICHMENT = FIELDS[-9:]


def normalise(rows: DataFrame) -> DataFrame:
    """The article columns only, in order; absent ones and nulls as the empty string (classifications as null)."""
    have = dict(rows.dtypes)
    return rows.select(*(F.col(c) if have.get(c, "string") != "string" else present(c).alias(c) if c in have else F.lit("").alias(c) for c in FIELDS))


def fill_published(rows: DataFrame) -> DataFrame:
    """A blank publication time as the date in the address."""
    return rows.withColumn("published_at", F.coalesce(F.nullif(present("published_at"), F.lit("")), url_date(F.col("url")).cast("string"), F.lit("")))


def normalise_published(rows: DataFrame) -> DataFrame:
    """Publication times as local dates; else the date in the address; else as they are."""
    day = F.coalesce(published_date(F.col("published_at")), url_date(F.col("url")))
    return rows.withColumn("published_at", F.coalesce(day.cast("string"), present("published_at")))


def assessed(rows: DataFrame, default_method: str = "dom_or_structured_full_text") -> DataFrame:
    """Rows with their completeness; a blank extraction method is the default one."""
    method = F.coalesce(F.nullif(present("content_extraction"), F.lit("")), F.lit(default_method))
    verdict = assess(F.col("content"), method)
    return rows.withColumn("content_status", verdict["status"]).withColumn("content_issue", verdict["issue"]).withColumn("content_extraction", method)


def tier(status: Column) -> Column:
    """Full texts (2) come before incomplete and unknown ones (1), these before missing ones (0)."""
    rank = content_rank(status)
    return F.when(rank == 3, 2).when(rank == 0, 0).otherwise(1)


def worth(status: Column, content: Column) -> Column:
    """Sort key of a record: its tier, then its length; missing texts are all alike."""
    t = tier(status)
    return F.struct(t.alias("tier"), F.when(t > 0, F.length(strip(present(content)))).otherwise(0).alias("chars"))


def best_by(rows: DataFrame, key: str, seq: str, *, status: str = "content_status", content: str = "content") -> DataFrame:
    """The best record of each key; of equals the one that came first (``seq`` is a whole number, once for each key).

    Tier, length and place make one number of fixed width, whose maximum is summed up by hashing; the texts themselves
    are moved once, for the join with the winners, and not sorted.
    """
    w = worth(F.col(status), F.col(content))
    number = (w["tier"].cast("decimal(1,0)") * F.lit(10**10).cast("decimal(11,0)") + w["chars"].cast("decimal(10,0)")) * F.lit("1" + "0" * 19).cast("decimal(20,0)") - F.col(seq).cast("decimal(19,0)")
    ranked = rows.withColumn("_rank", number.cast("decimal(38,0)"))
    best = ranked.groupBy(key).agg(F.max("_rank").alias("_rank")).hint("shuffle_hash")
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"b.{key}")) & (F.col("r._rank") == F.col("b._rank"))
    return ranked.alias("r").join(best.alias("b"), same, "left_semi").select(*rows.columns)


def fold_best(rows: DataFrame, key: str, seq: str, source: str, title_placeholder: str) -> DataFrame:
    """``best_by`` for records whose title may be the channel's name: such a record gives way to the next titled one
    of the same rank or a better one, so records of its key are compared one by one in their order.

    Keys without such a record, nearly all, go by ``best_by``. For the others only numbers are gathered: of every run of
    records between two that may be retitled or retitle, only those that a run of plain ones can end in take part. The
    records themselves are fetched by a join with the places of the winners. A null key is a key.
    """
    title, named = F.lower(strip(present("title"))), F.lower(strip(present(source))) == title_placeholder
    w = worth(F.col("content_status"), F.col("content"))
    marks = rows.select(
        F.col(key).alias("_key"), F.col(seq).alias("_at"), content_rank(F.col("content_status")).alias("_rank"), w["tier"].alias("_tier"), w["chars"].alias("_chars"),
        (named & (title == title_placeholder)).alias("_open"), ((title != "") & (title != title_placeholder)).alias("_titled"),
    )
    odd = marks.where("_open").select("_key").distinct()
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    plain = best_by(rows.alias("r").join(odd.alias("o"), same(f"r.{key}", "o._key"), "left_anti").select(*rows.columns), key, seq)
    own = marks.alias("m").join(odd.alias("o"), same("m._key", "o._key"), "left_semi")
    # before the first open record a key is a plain one: what comes out of that part is its best, one number a key
    begin = own.where("_open").groupBy("_key").agg(F.min("_at").alias("_first"))
    parted = own.alias("m").join(begin.alias("b"), same("m._key", "b._key")).select("m.*", "b._first")
    before = parted.where("_at < _first").groupBy("_key").agg(F.max(F.struct("_tier", "_chars", (-F.col("_at")).alias("_n"))).alias("_b"))
    head = parted.alias("m").join(before.alias("b"), same("m._key", "b._key") & (F.col("m._at") == -F.col("b._b._n"))).select("m.*")
    item = F.struct("_at", "_rank", F.struct("_tier", "_chars").alias("_worth"), "_open", "_titled")
    every = parted.where("_at >= _first").unionByName(head).groupBy("_key").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def better(old: Column, new: Column) -> Column:
        return (old["_open"] & new["_titled"] & (new["_rank"] >= old["_rank"])) | (new["_worth"] > old["_worth"])

    rest = F.slice("items", F.lit(2), F.greatest(F.size("items") - 1, F.lit(0)))
    winner = every.select("_key", F.aggregate(rest, F.get("items", F.lit(0)), lambda a, x: F.when(better(a, x), x).otherwise(a))["_at"].alias("_at"))
    found = rows.alias("r").join(winner.alias("w"), same(f"r.{key}", "w._key") & (F.col(f"r.{seq}") == F.col("w._at")), "left_semi")
    return plain.unionByName(found.select(*rows.columns))


def keeps_own_classification(new: Column, old: Column) -> Column:
    """Whether a refreshed record's own classification stands against the stored one's."""
    done = lambda c: F.lower(present(c)).isin("classified", "unclassified")
    return done(new) | ((F.lower(present(new)) == "error") & ~done(old))


def upsert(stored: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """Stored rows with better incoming ones in their place and unseen ones behind them; ``change`` says which.

    Of incoming rows of one key the best takes part. It is compared with the first stored row of that key only, whose
    later copies stay as they are. Columns of the classification come from the stored row unless the new one's stand.
    """
    new = best_by(incoming, key, seq)
    first = stored.groupBy(key).agg(F.min(seq).alias("_first"))
    heads = stored.join(first, key, "left").withColumn("_nth", F.when(F.col(seq) == F.col("_first"), 1).otherwise(2)).drop("_first").select(*stored.columns, "_nth")
    cols = [c for c in stored.columns if c not in (key, seq)]
    joined = heads.alias("o").join(new.alias("n"), (F.col(f"o.{key}") == F.col(f"n.{key}")) & (F.col("o._nth") == 1), "full_outer")
    old_there, new_there = F.col("o._nth").isNotNull(), F.col(f"n.{key}").isNotNull()
    wins = new_there & (~old_there | (worth(F.col("n.content_status"), F.col("n.content")) > worth(F.col("o.content_status"), F.col("o.content"))))
    enrich = [c for c in cols if c in ENRICHMENT]
    own = ~old_there | keeps_own_classification(F.col("n.industry_classification_status"), F.col("o.industry_classification_status")) if enrich else F.lit(True)
    out = [F.coalesce(f"o.{key}", f"n.{key}").alias(key), F.coalesce(f"o.{seq}", f"n.{seq}").alias(seq)]
    out += [F.when(wins & own if c in enrich else wins, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols]
    return joined.select(*out, F.when(~old_there, "added").when(wins, "updated").otherwise("kept").alias("change"))


def rollup_key(url: Column, source: Column, title: Column) -> Column:
    return F.when(present(url) != "", url).otherwise(F.concat(present(source), F.lit("::"), title_key(title)))


def rollup_dedup(rows: DataFrame, seq: str) -> DataFrame:
    """The first row of each raw address (or channel and title), by day, channel, title and order of arrival, which is
    a number of its own for every row. Only keys and what orders them are sorted; texts are moved once, for the join."""
    keyed = rows.withColumn("_key", rollup_key(F.col("url"), F.col("source_name"), F.col("title")))
    first = keyed.groupBy("_key").agg(F.min(F.struct("summary_date", "source_name", "title", seq)).alias("_f")).select("_key", F.col(f"_f.{seq}").alias("_first"))
    same = F.col("r._key").eqNullSafe(F.col("f._key")) & (F.col(f"r.{seq}") == F.col("f._first"))
    return keyed.alias("r").join(first.alias("f"), same, "left_semi").select(*rows.columns)


def first_seen(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The row with the lowest position of each key; positions of a key differ. Places are found by partial minima."""
    first = rows.groupBy(key).agg(F.min(position).alias("_first"))
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"f.{key}")) & F.col(f"r.{position}").eqNullSafe(F.col("f._first"))
    return rows.alias("r").join(first.alias("f"), same, "left_semi").select(key, *(F.col(c) for c in rows.columns if c != key))


def not_collected(rows: DataFrame, collected: DataFrame, key: str) -> DataFrame:
    """Rows whose address is not among those that are stored in full."""
    return rows.join(collected.select(key), key, "left_anti").select(*rows.columns)


def limit_each(rows: DataFrame, by: str | list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= k).drop("_n")
