"""Personal data, and terms that reveal whose it is.

Patterns find e-mail and network addresses, card and telephone numbers. A term
that shares a document with such an entity is judged by information: the entity's content is
IC = log2(N / n_entity) over all N documents, what a term tells of it is
PMI = log2(N * n_both / (n_term * n_entity)). A term that tells ``threshold``
of the content or more is disclosing, wherever it stands in a document that
holds the entity. It is generalised to its stem if the
stem stays below the threshold, else removed. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import row_key, text_of

#: Fixed values. A repeat never gives back what it took, and a run of characters is tried at its start only (or where
#: the match before ended): the same matches as the plain patterns, in time that follows the text's length.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: A term is a run of letters.
TERM = r"\p{L}{4,}"
STEM = 4
#: Share of an entity's information from which a term discloses it, and the documents that must show it.
THRESHOLD, SUPPORT = 0.8, 2


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(places, F.lit(0), lambda total, place: total + worth(place)) % 10 == 0


def _holds(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    card = F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(kind == "ip", hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", card)
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(True)
    )


def _matches(text: Column, kind: str, clue: Column) -> Column:
    """Array of a kind's matches in order, each with the code points since the one before."""
    pattern = F.lit(PATTERNS[kind])
    hits = F.when(clue, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size(hits) > 0, F.split(text, PATTERNS[kind], -1)).otherwise(F.array().cast("array<string>"))
    return F.zip_with(
        hits, F.slice(F.transform(gaps, F.length), F.lit(1), F.size(hits)), lambda hit, gap: F.struct(F.lit(kind).alias("kind"), hit.alias("hit"), gap.alias("gap"))
    )


def _places(texts: DataFrame) -> DataFrame:
    """``row_no, at, n, action`` of every occurrence of a row's ``told`` terms (term to action) in its ``body``."""
    words = F.regexp_extract_all("body", F.lit(TERM), F.lit(0))
    gaps = F.slice(F.transform(F.split("body", TERM, -1), F.length), F.lit(1), F.size(words))
    found = F.zip_with(
        words, gaps, lambda w, g: F.struct(F.length(w).alias("n"), g.alias("gap"), F.try_element_at(F.col("told"), F.lower(w)).alias("action"))
    )
    rows = texts.select("row_no", F.posexplode(found).alias("no", "t")).select("row_no", "no", "t.*")
    in_row = Window.partitionBy("row_no").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(in_row))
    return ended.filter(F.col("action").isNotNull()).select("row_no", (F.col("end") - F.col("n")).alias("at"), "n", "action")


def stem(term: Column) -> Column:
    return F.concat(F.substr(term, F.lit(1), F.lit(STEM)), F.lit("*"))


def _listed(text: Column) -> Column:
    """The distinct terms of a text and their stems."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.concat(words, F.transform(words, stem)))


def disclosing_terms(
    docs: DataFrame, holders: DataFrame, bodies: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT, text: str = "text"
) -> DataFrame:
    """``entity, term, disclosure, action`` of terms that tell ``threshold`` of an entity's information or more.

    ``holders`` has ``row_no, entity`` once for each entity of a document,
    ``bodies`` has ``row_no, body`` of these documents at least. Counts are
    whole documents, over all of ``docs``.
    """
    # No term is in more of an entity's documents than there are.
    entities = holders.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") >= support)
    held = holders.join(entities.select("entity"), "entity").groupBy("row_no").agg(F.collect_list("entity").alias("entities"))
    both = bodies.join(held, "row_no").select(F.explode("entities").alias("entity"), _listed(F.col("body")).alias("terms"))
    pairs = both.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    listed = docs.select(F.explode(_listed(text_of(text))).alias("term"))
    terms = listed.groupBy("term").agg(F.count("*").alias("n_term"))
    everything = docs.agg(F.count("*").alias("n"))
    told = (
        pairs.filter(F.col("n_both") >= support)
        .join(terms, "term")
        .join(entities, "entity")
        .crossJoin(F.broadcast(everything))  # one row
        .withColumn("ic", F.log2(F.col("n") / F.col("n_entity")))
        .withColumn("pmi", F.log2(F.col("n") * F.col("n_both") / (F.col("n_term") * F.col("n_entity"))))
        .select("entity", "term", F.when(F.col("ic") > 0, F.col("pmi") / F.col("ic")).otherwise(0.0).alias("disclosure"))
    )
    told = materialize(told.filter(F.col("disclosure") >= threshold), "terms")
    stems = told.filter(F.col("term").endswith("*")).select("entity", F.col("term").alias("stem"))
    whole = told.filter(~F.col("term").endswith("*")).withColumn("stem", stem(F.col("term")))
    action = F.when(F.col("s.stem").isNull(), "generalise").otherwise("remove")
    joined = whole.alias("w").join(stems.alias("s"), (F.col("w.entity") == F.col("s.entity")) & (F.col("w.stem") == F.col("s.stem")), "left")
    return joined.select("w.entity", "w.term", "w.disclosure", action.alias("action"))


def find_spans(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its spans: ``row_no, doc_id, key, base, spans``.

    ``base`` and ``spans`` are arrays of ``start, turn, end, kind, action`` in
    order, in code points, end exclusive; ``turn`` is the kind's place in
    ``KINDS``. ``spans`` also has the disclosing terms, which never overlap base
    ones. Null and empty texts have none; repeated rows each have theirs and
    count as documents. ``key`` is ``common.row_key``.
    """
    body = text_of(text)
    clues = {"email": F.contains(body, F.lit("@")), "ip": body.rlike(r"[0-9]\.[0-9]"), "card": body.rlike("[0-9]"), "phone": F.contains(body, F.lit("+"))}
    found = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(doc_id).alias("doc_id"),
        row_key(doc_id, text).alias("key"),
        F.concat(*[_matches(body, kind, clues[kind]) for kind in PATTERNS]).alias("found"),
        body.alias("body"),
    )
    found = materialize(found.withColumn("body", F.when(F.size("found") > 0, F.col("body"))), "found")

    rows = found.filter(F.size("found") > 0).select("row_no", F.posexplode("found").alias("no", "m")).select("row_no", "no", "m.*")
    in_kind = Window.partitionBy("row_no", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = rows.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(in_kind)).withColumn("start", F.col("end") - F.length("hit"))
    held = materialize(ended.filter(_holds(F.col("kind"), F.col("hit"))), "held")

    entity = F.concat_ws(":", "kind", F.when(F.col("kind").isin("card", "phone"), F.regexp_replace("hit", "[^0-9]", "")).otherwise(F.lower("hit")))
    holders = materialize(held.select("row_no", entity.alias("entity")).distinct(), "holders")
    bodies = found.filter(F.size("found") > 0).select("row_no", "body")
    told = disclosing_terms(docs, holders, bodies, threshold, support, text)
    # What one entity wants removed is removed.
    wanted = holders.join(told, "entity").groupBy("row_no", "term").agg(F.max("action").alias("action"))
    by_row = wanted.groupBy("row_no").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("told"))

    def span(kind: Column, start: Column, end: Column, action: Column) -> Column:
        turn = reduce(lambda c, k: c.when(kind == k, KINDS.index(k)), KINDS[1:], F.when(kind == KINDS[0], 0))
        return F.struct(start.cast("long").alias("start"), turn.alias("turn"), end.cast("long").alias("end"), kind.alias("kind"), action.alias("action"))

    base = held.groupBy("row_no").agg(F.array_sort(F.collect_list(span(F.col("kind"), F.col("start"), F.col("end"), F.lit("remove")))).alias("base"))
    terms = (
        _places(bodies.join(by_row, "row_no"))
        .groupBy("row_no")
        .agg(F.collect_list(span(F.lit("term"), F.col("at"), F.col("at") + F.col("n"), F.col("action"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start:bigint,turn:int,end:bigint,kind:string,action:string>>")
    joined = found.select("row_no", "doc_id", "key").join(base, "row_no", "left").join(terms, "row_no", "left")
    joined = joined.withColumn("base", F.coalesce("base", none))
    free = F.filter(F.coalesce("terms", none), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return joined.select("row_no", "doc_id", "key", "base", F.array_sort(F.concat("base", free)).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data as ``[kind]``, disclosing terms as their stem or as ``[term]``; other columns as they were.

    Overlapping spans are replaced as one, by the name of the first.
    """
    found = find_spans(docs, **options).filter(F.size("spans") > 0).select(F.col("key").alias("_key"), F.col("spans").alias("_spans")).dropDuplicates(["_key"])
    joined = docs.withColumn("_key", row_key()).join(found, "_key", "left")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        merged = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), last["turn"].alias("turn"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"), last["action"].alias("action"))),
        )
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"]), merged).otherwise(F.concat(done, F.array(s)))

    none = F.array().cast("array<struct<start:bigint,turn:int,end:bigint,kind:string,action:string>>")
    one = F.aggregate(F.coalesce("_spans", none), none, add)

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get(F.col("_one"), i - 1)["end"]).otherwise(F.lit(0)).cast("int")
        start, length = s["start"].cast("int"), (s["end"] - s["start"]).cast("int")
        name = F.when((s["kind"] == "term") & (s["action"] == "generalise"), stem(F.substr("text", start + 1, length))).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        return F.concat(F.substr("text", begin + 1, start - begin), name)

    rest = F.substr("text", F.element_at(F.col("_one"), -1)["end"].cast("int") + 1, F.length("text"))
    clean = F.when(F.size("_one") > 0, F.concat(F.array_join(F.transform("_one", piece), ""), rest)).otherwise(F.col("text"))
    return joined.withColumn("_one", one).withColumn("text", clean).select(*docs.columns)
