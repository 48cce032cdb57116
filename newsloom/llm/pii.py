"""Operator 9, personal data with information-theoretic sanitisation; DataFrame and SQL functions only.

Patterns find the protected entities themselves. What else gives an entity away is estimated from the corpus: over
all distinct lines, the pointwise mutual information of a term and an entity, from smoothed counts, is compared with
the information that the entity carries. A term that discloses more than the allowed share of it is marked wherever it
stands in a document with that entity. It is generalised to its class, the words that begin alike, if that does not
disclose as much, and removed otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.columns import let, unused
from newsloom.llm.storage import release, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Quantifiers that cannot give anything back are possessive and runs are entered at
#: their start only, so that matches are the same and long runs cost no more than their length.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text without any match of a kind lacks.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Share of an entity's information that a term may disclose, lines that chance counts for in smoothing, letters of a
#: longer term that its class keeps.
ALLOWED, PRIOR, GENERAL = 0.8, 1.0, 3
SPAN = "array<struct<kind:string,start:int,end:int>>"
TERM_SPAN = "array<struct<kind:string,start:int,end:int,general:string>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def running(lengths: Column) -> Column:
    """Sums of the first 1, 2, ... values of an array, taken over blocks so that long arrays stay cheap."""
    starts = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 64).cast("int"))

    def within(block: Column, before: Column) -> Column:
        return F.transform(block, lambda _, i: before + _sum(F.slice(block, F.lit(1), i + 1)))

    def over(blocks: Column) -> Column:
        return let(F.transform(blocks, _sum), lambda sums: F.flatten(F.transform(blocks, lambda x, b: let(_sum(F.slice(sums, F.lit(1), b)), lambda before: within(x, before)))))

    blocks = F.transform(starts, lambda b: F.slice(lengths, b * 64 + 1, F.lit(64)))
    return F.when(F.size(lengths) > 0, let(blocks, over)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: array of (value, start, end) in code points, end exclusive."""

    def span(value: Column, end: Column) -> Column:
        return F.struct(value.alias("value"), (end - F.length(value)).cast("int").alias("start"), end.cast("int").alias("end"))

    def placed(found: Column, gaps: Column) -> Column:
        sizes = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return let(sizes, lambda s: let(running(s), lambda ends: F.transform(found, lambda m, i: span(m, F.get(ends, i)))))

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda found: let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    parts = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(digits(value))
        return (n >= 12) & (n <= 19) & luhn(digits(value))
    if kind == "phone":
        n = F.length(digits(value))
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind: array of (value, start, end)."""
    need = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
    need = need if kind == "email" else need & text.rlike("[0-9].*[0-9]" if kind == "phone" else "[0-9]{1}")
    none = F.array().cast("array<struct<value:string,start:int,end:int>>")
    return F.when(need, F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))).otherwise(none)


def entities(text: Column) -> Column:
    """Protected entities of a text, each in one spelling: ``kind:value``."""

    def spelled(kind: str) -> Column:
        return F.transform(base_spans(text, kind), lambda m: F.concat(F.lit(kind + ":"), digits(m["value"]) if kind in ("card", "phone") else F.lower(m["value"])))

    return F.array_distinct(F.concat(*map(spelled, KINDS)))


def names(line: Column) -> Column:
    """Distinct names of a line: its terms, which are its words in lower case, and the classes of those."""
    words = F.filter(F.split(F.lower(line), r"[^\p{L}]+", -1), lambda w: w != "")
    return let(F.array_distinct(words), lambda ws: F.concat(ws, F.array_distinct(F.transform(F.filter(ws, lambda w: F.length(w) > GENERAL), general))))


def general(term: Column) -> Column:
    """The class that a term is generalised to: what it begins with, and a mark that no word has."""
    return F.concat(F.left(term, F.lit(GENERAL)), F.lit("*"))


def disclosing_terms(docs: DataFrame, *, allowed: float = ALLOWED, prior: float = PRIOR) -> DataFrame:
    """Rows ``entity, term, general`` in which the term gives the entity away, from the distinct lines of all documents.

    With n lines, of which n(e) hold the entity, n(t) the term and n(t, e) both, a line with the term holds the entity
    with probability p = (n(t, e) + prior n(e) / n) / (n(t) + prior): to the lines with the term come ``prior`` lines
    in which chance puts the entity. The pointwise mutual information log(n p / n(e)) is set against the entity's
    information log(n / n(e)). No count has a floor: an entity of a single line is judged as well. ``general`` is the
    term's class if that, judged in the same way, does not give the entity away; else null.
    """
    lines = written(docs.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").distinct(), "distinct-lines")
    total = max(lines.count(), 1)
    shown = lines.where(F.col("line").rlike("[0-9@]")).select("line", F.explode(entities(F.col("line"))).alias("entity"))
    shown = shown.select("entity", F.concat(F.array(F.lit("")), names(F.col("line"))).alias("names"))
    pairs = written(shown.select("entity", F.explode("names").alias("name")).groupBy("entity", "name").agg(F.count("*").alias("n_te")), "entity-names")
    of_entity = pairs.where("name = ''").select("entity", F.col("n_te").alias("n_e"))
    of_name = lines.select(F.explode(names(F.col("line"))).alias("name")).groupBy("name").agg(F.count("*").alias("n_t"))
    n = F.lit(float(total))
    told = F.log(n * (F.col("n_te") + F.col("n_e") * (prior / total)) / ((F.col("n_t") + prior) * F.col("n_e")))
    whole = F.log(n / F.col("n_e"))
    judged = pairs.where("name <> ''").join(of_entity, "entity").join(of_name, "name")
    judged = written(judged.select("entity", "name", ((whole > 0) & (told >= allowed * whole)).alias("leaks")), "entity-names")
    release(lines, pairs)
    term = judged.where("leaks AND NOT endswith(name, '*')").select("entity", F.col("name").alias("term"), general(F.col("name")).alias("class"))
    safe = judged.where("NOT leaks AND endswith(name, '*')").select("entity", F.col("name").alias("class"), F.col("name").alias("general"))
    return term.join(safe, ["entity", "class"], "left").select("entity", "term", "general")


def _placed(text: Column) -> Column:
    """Base spans of a text by start, then kind as listed."""

    def of(order: int, kind: str) -> Column:
        return F.transform(base_spans(text, kind), lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end")))

    kinds = F.array(*(F.lit(k) for k in KINDS))
    spans = F.array_sort(F.concat(*map(of, range(len(KINDS)), KINDS)))
    return F.transform(spans, lambda s: F.struct(F.get(kinds, s["order"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(SPAN)


def term_spans(docs: DataFrame, *, allowed: float = ALLOWED, prior: float = PRIOR) -> DataFrame:
    """Terms that give away an entity of the same text, per distinct text of ``docs(text)`` that has some.

    Returns ``h, text, base, term_spans`` with the text's hash. Words inside a base span are no terms; spans have the kind ``term`` and in ``general`` what the
    term may be generalised to for all those entities, or null if it has to go.
    """
    pairs = written(disclosing_terms(docs, allowed=allowed, prior=prior), "disclosing")
    holders = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), F.explode(entities(F.col("text"))).alias("entity"))
    hints = holders.distinct().join(pairs, "entity")
    hints = hints.groupBy("h", "term").agg(F.when(F.count("*") == F.count("general"), F.first("general")).alias("general"))
    hints = hints.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("term", F.coalesce("general", F.lit("")).alias("general")))).alias("hints"))  # terms of one text
    hints = written(hints, "hints")
    texts = docs.where(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text")).join(hints.select("h"), "h", "left_semi").select("text").distinct()
    marked = texts.select("text", F.xxhash64("text").alias("h"), _placed(F.col("text")).alias("base")).join(hints, "h")
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    words = let(matches(F.col("text"), r"\p{L}+"), lambda ms: F.filter(F.transform(ms, lambda m: F.struct(F.lit("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.try_element_at(F.col("hints"), F.lower(m["value"])).alias("general"))), lambda s: s["general"].isNotNull() & apart(s)))
    words = F.transform(words, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.nullif(s["general"], F.lit("")).alias("general")))
    return marked.select("h", "text", "base", words.cast(TERM_SPAN).alias("term_spans"))


def find(docs: DataFrame, *, allowed: float = ALLOWED, prior: float = PRIOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All spans of every whole text: ``doc_id, base, term_spans, sanitised_sha256``, offsets in code points.

    ``base`` is ordered by start, then kind as listed. ``term_spans`` are of kind ``term``: words that give away an
    entity of the same document, with what they are generalised to (null: removed). ``sanitised_sha256`` is the
    lowercase hex digest of the text that ``sanitise`` gives. A null text counts as empty and has no spans. Rows keep
    their number: repeated rows and null ids get the spans of their own text. Other columns are left out, so their
    names cannot clash; an empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    given = term_spans(docs.select("text"), allowed=allowed, prior=prior)
    given = given.select("h", "term_spans", F.sha2(sanitise(F.col("text"), F.col("base"), F.col("term_spans")), 256).alias("sanitised"))
    given = written(given, "term-spans")  # a row for each text: large groups of copies are on the other side of the join
    none = F.array().cast(TERM_SPAN)
    base = docs.select("doc_id", F.xxhash64("text").alias("h"), let(_placed(F.col("text")), lambda b: F.struct(b.alias("base"), F.sha2(sanitise(F.col("text"), b, none), 256).alias("plain"))).alias("r"))
    return base.join(given, "h", "left").select("doc_id", "r.base", F.coalesce("term_spans", none).alias("term_spans"), F.coalesce("sanitised", "r.plain").alias("sanitised_sha256"))


def sanitise(text: Column, base: Column, terms: Column) -> Column:
    """A text with its spans replaced: entities by their kind in brackets, terms by their class, or by nothing.

    Of spans that overlap the one that begins first counts, of those the longest.
    """
    of_base = F.transform(base, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("by")))
    of_terms = F.transform(terms, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.coalesce(s["general"], F.lit("")).alias("by")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        taken = F.concat(a["out"], F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), s["by"]))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct((-s["back"]).alias("at"), taken.alias("out")))

    changed = F.aggregate(F.array_sort(F.concat(of_base, of_terms)), begin, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1)))
    return F.when(F.size(base) + F.size(terms) == 0, text).otherwise(changed)


def sanitised(docs: DataFrame, *, allowed: float = ALLOWED, prior: float = PRIOR, text: str = "text") -> DataFrame:
    """The documents with all their columns, and their texts as ``sanitise`` gives them; a null text stays null."""
    key, spans = unused(docs, "h"), unused(docs, "term_spans")
    texts = docs.select(F.coalesce(text, F.lit("")).alias("text"))
    given = written(term_spans(texts, allowed=allowed, prior=prior).select(F.col("h").alias(key), F.col("term_spans").alias(spans)), "term-spans")
    joined = docs.withColumn(key, F.xxhash64(F.coalesce(text, F.lit("")))).join(given, key, "left")
    new = let(_placed(F.col(text)), lambda b: sanitise(F.col(text), b, F.coalesce(spans, F.array().cast(TERM_SPAN))))
    return joined.withColumn(text, F.when(F.col(text).isNotNull(), new)).select(*docs.columns)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, sanitised_sha256``; a term at a start comes after
    the base kinds."""
    kinds = [*KINDS, "term"]
    order = lambda s: F.array_position(F.array(*(F.lit(k) for k in kinds)), s["kind"])
    every = F.array_sort(F.transform(F.concat("base", F.transform("term_spans", lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end"))).cast(SPAN)), lambda s: F.struct(s["start"].alias("start"), order(s).alias("order"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans"), "sanitised_sha256")
