"""Bottom-k sketches of word shingles: fingerprints that merge, compare and count.

A fingerprint holds the ``K`` smallest distinct hashes of a text's five-word
shingles. Of a text in parts it is the smallest of the parts' fingerprints, so
long texts are taken part by part and no part is held beside another. The K
smallest of two fingerprints together are a sample of all shingles that either
text has: the share that both hold estimates resemblance, the share of one
that the other holds estimates containment, and how small the K-th is tells
how many distinct shingles there are.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, lower_ascii, text_of

SHINGLE = 5
#: Hashes in a fingerprint, and the hexadecimal digits of each.
K, DIGITS = 128, 12
#: Characters of a part; it ends with a word, and the next words up to a shingle's are read along.
PART = 32_768
#: Documents of one range of ids, unless that makes more than ``MOST_RANGES``.
RANGE, MOST_RANGES = 500, 1 << 16


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _empty() -> Column:
    return F.array().cast("array<string>")


def normalised(text: Column) -> Column:
    """A-Z in lower case and one space between words."""
    return F.trim(F.regexp_replace(lower_ascii(text), f"{SPACE}+", " "))


def _parts(words: Column, part: int) -> Column:
    body = f".{{1,{part - 1}}}[^ ]*+"
    return F.regexp_extract_all(words, F.lit(f"(?s)(?=({body}(?: [^ ]++){{0,{SHINGLE - 1}}})){body} ?"), F.lit(1))


def _shingles(words: Column) -> Column:
    """Every run of five words; each word is looked at once, whatever its length."""
    return F.regexp_extract_all(words, F.lit(f"(?<![^ ])(?=([^ ]++(?: [^ ]++){{{SHINGLE - 1}}}))[^ ]++"), F.lit(1))


def _hash(shingle: Column) -> Column:
    return F.substring(F.md5(F.encode(shingle, "utf-8")), 1, DIGITS)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Fingerprint of what either of two fingerprints stands for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def sketch(text: Column, k: int = K, part: int = PART) -> Column:
    """The ``k`` smallest hashes of a text's shingles as ordered hexadecimal strings.

    A text of fewer than five words is one shingle, one without words has none.
    """

    def add(found: Column, piece: Column) -> Column:
        hashes = F.transform(_shingles(piece), _hash)
        # Once there are k, larger ones need not be sorted.
        small = F.when(F.size(found) < k, hashes).otherwise(F.filter(hashes, lambda h: h < F.element_at(found, -1)))
        return merge(found, small, k)

    def of(words: Column) -> Column:
        few = F.size(F.split(words, " ", SHINGLE)) < SHINGLE
        whole = F.when(F.length(words) == 0, _empty()).otherwise(F.array(_hash(words)))
        return F.when(few, whole).otherwise(F.aggregate(_parts(words, part), _empty(), add))

    return _let(normalised(text), of)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either text that both have; 1 if neither has any."""
    shared = lambda sample: F.size(F.array_intersect(F.array_intersect(sample, a), b)) / F.size(sample)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(_let(merge(a, b, k), shared))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 if the first has none, 0 if none is in the sample."""
    shared = lambda own: F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, b)) / F.size(own))
    return F.when(F.size(a) == 0, 1.0).otherwise(_let(F.array_intersect(merge(a, b, k), a), shared))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    largest = F.conv(F.element_at(a, -1), 16, 10).cast("double") / float(16**DIGITS)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def _place(doc_id: Column, bounds: list[float], crowded: list[tuple]) -> Column:
    """``range, turn``: how many of the falling ``bounds`` are above the id, found by halving, and the part of a crowded id."""
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    value, limits = doc_id.cast("double"), F.lit(bounds or [0.0])

    def halve(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(limits, at + step - 1) > value, F.lit(False)), at + step).otherwise(at)

    found = F.aggregate(F.lit(steps), F.lit(0), halve) if steps else F.lit(0)
    turn = F.lit(0)
    for key, parts in crowded:
        turn = F.when(doc_id.eqNullSafe(F.lit(key)), F.floor(F.rand(7) * parts).cast("int")).otherwise(turn)
    return F.struct(F.when(doc_id.isNull(), len(bounds) + 1).otherwise(found).alias("range"), turn.alias("turn"))


def with_next(docs: DataFrame, rows: int = RANGE, most: int = MOST_RANGES) -> DataFrame:
    """``id, text`` of all rows with ``home, guest``, so that rows and their next ones meet range by range.

    The order is by falling id, null last, then by a hash of the text; after
    the last row comes the first. Ids are cut into ranges by approximate shares
    of the rows, and the first row of each range is also a guest at the end of
    the range before. An id that holds more than a 256th of the rows is dealt
    to several ranges by a seeded random number. The driver holds one bound and
    one first row (number and hash) for each range, ``most`` at most.
    """
    spark = docs.sparkSession
    ids = docs.select("id")
    total = ids.count()
    wanted = max(1, min(most, -(-total // rows)))
    shares = [k / wanted for k in range(1, wanted)]
    bounds = ids.agg(F.percentile_approx("id", shares, max(10_000, 10 * wanted))).first()[0] if shares else None
    full = max(rows, -(-total // 256))
    crowded = [(r["id"], -(-r["n"] // full)) for r in ids.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > full).collect()]
    placed = docs.select(
        "id", "text", _place(F.col("id"), sorted({float(b) for b in bounds or []}, reverse=True), crowded).alias("own"),
        F.xxhash64("text").alias("tie"),
    )
    rank = F.struct(F.col("id").isNull().alias("last"), (-F.col("id").cast("decimal(38,0)")).alias("low"), "tie")
    first = placed.groupBy("own").agg(F.min(F.struct(rank, "id")).alias("first")).select("own", "first.id", F.col("first.col1.tie").alias("tie"))
    heads = sorted(first.collect())
    before = spark.createDataFrame(
        [(head["own"], head["id"], head["tie"], heads[k - 1]["own"]) for k, head in enumerate(heads)],
        "own struct<range int, turn int>, head long, head_tie long, before struct<range int, turn int>",
    )
    led = placed.join(F.broadcast(before), "own", "left")
    is_first = F.col("id").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie"))
    seat = lambda home, guest: F.struct(F.col(home).alias("home"), F.lit(guest).alias("guest"))
    seats = F.when(is_first, F.array(seat("own", False), seat("before", True))).otherwise(F.array(seat("own", False)))
    return led.select("id", "text", "tie", F.inline(seats))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, part: int = PART, rows: int = RANGE) -> DataFrame:
    """Every text and its edited text with their fingerprints.

    Returns ``doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    next_fingerprint``, one row per row of ``docs``. The edited text has the
    last third of the code points (rounded down) replaced by the first as many,
    or all, of the next document by falling ``doc_id``, a whole number; null
    comes last, and after the last document the first. Rows that share an id
    follow each other by a hash of their text. Null texts are empty; an empty
    text has an empty fingerprint. A single document is its own next one. Other
    columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text"))
    # Texts are moved once and without their fingerprints; the window keeps this partitioning.
    seated = with_next(docs, rows).repartition("home").withColumn("fingerprint", sketch(F.col("text"), k, part))
    along = Window.partitionBy("home").orderBy("guest", F.col("id").desc_nulls_last(), "tie")
    near = seated.withColumns({"next": F.lead("text").over(along), "next_fingerprint": F.lead("fingerprint").over(along)})
    chars = F.length("text")
    cut = F.floor(chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), chars - cut), F.substring("next", F.lit(1), cut))
    return (
        near.filter(~F.col("guest"))
        .select(F.col("id").alias("doc_id"), chars.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
        .withColumn("edited_fingerprint", sketch(F.col("edited"), k, part))
    )
