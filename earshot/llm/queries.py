"""The registered queries of the corpus operators, with the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import captures, collocations, decontaminate, exact_dedup, fingerprints, html_text, lexical, lm_scores, mixing, near_dup, pii, quality, repeats, revisits

Plan = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "expected_grade", "p_grade_1", "p_grade_2", F.col("selected").alias("kept"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(captures.captures(_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("headers")))))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("key")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.PATTERNS]
    base = F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.span_text(F.col("spans")).alias("spans"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, size=3).drop("key")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).drop("key")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, edited, after = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    found = fingerprints.fingerprints(_table(spark, sf_dir, "documents")).withColumns({
        "near_edited": fingerprints.resemblance(own, edited),
        "near_next": fingerprints.resemblance(own, after),
        "kept_share": fingerprints.containment(own, edited),
        "n_shingles": fingerprints.distinct_shingles(own),
    })
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array_join(own, "").alias("fingerprint"),
        F.array_join(edited, "").alias("edited_fingerprint"), "near_edited", "near_next", "kept_share", "n_shingles",
    )


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents")).drop("cut")


OP10_SQL = r"""
WITH short AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER same AS place, first_value(doc_id) OVER same AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM short WINDOW same AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP8_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 2, 1))) AS i FROM split WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, hash(CASE WHEN len(words) < 3 THEN words ELSE words[i : i + 2] END) AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP11_SQL = r"""
WITH plain AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
beside AS (
  SELECT doc_id, text, length(text) AS n, length(text) // 3 AS cut,
         coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS after
  FROM plain),
texts AS (SELECT doc_id, n, text, left(text, n - cut) || left(after, cut) AS edited, after FROM beside),
each AS (
  SELECT doc_id, kind, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, unnest(['own', 'edited', 'after']) AS kind, unnest([text, edited, after]) AS t FROM texts)),
shingles AS (
  SELECT DISTINCT doc_id, kind, substr(md5(array_to_string(w[i : i + 4], ' ')), 1, 12) AS h
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM each WHERE len(w) > 0)),
least AS (
  SELECT doc_id, kind, list(h ORDER BY h) AS s
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY h) AS place FROM shingles) WHERE place <= 128 GROUP BY 1, 2),
wide AS (
  SELECT doc_id, n, edited, coalesce(a.s, []) AS a, coalesce(b.s, []) AS b, coalesce(c.s, []) AS c
  FROM texts LEFT JOIN (SELECT doc_id, s FROM least WHERE kind = 'own') a USING (doc_id)
  LEFT JOIN (SELECT doc_id, s FROM least WHERE kind = 'edited') b USING (doc_id)
  LEFT JOIN (SELECT doc_id, s FROM least WHERE kind = 'after') c USING (doc_id)),
sampled AS (
  SELECT *, list_sort(list_distinct(list_concat(a, b)))[1 : 128] AS ab, list_sort(list_distinct(list_concat(a, c)))[1 : 128] AS ac FROM wide)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint,
       CASE WHEN len(ab) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(ab, a), b)) / len(ab) END AS near_edited,
       CASE WHEN len(ac) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(ac, a), c)) / len(ac) END AS near_next,
       CASE WHEN len(a) = 0 THEN 1.0::DOUBLE WHEN len(list_intersect(ab, a)) = 0 THEN 0.0::DOUBLE
            ELSE len(list_intersect(list_intersect(ab, a), b)) / len(list_intersect(ab, a)) END AS kept_share,
       CASE WHEN len(a) < 128 THEN CAST(len(a) AS DOUBLE) ELSE 127 / (CAST('0x' || a[128] AS BIGINT) / 281474976710656.0::DOUBLE) END AS n_shingles
FROM sampled
"""

OP12_SQL = r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
sized AS (SELECT doc_id, len(t) AS n, t FROM found WHERE len(t) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
long AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM sized, totals),
freqs AS (SELECT doc_id, unnest(t) AS term FROM sized),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM freqs GROUP BY 1, 2),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY 1), totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN long USING (doc_id) GROUP BY 1, 2),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, s, unnest(generate_series(1, len(w) - s + 1)) AS i FROM words, (VALUES (1), (2), (3)) t(s) WHERE len(w) >= s),
counts AS (SELECT lang, s, w[i : i + s - 1] AS p, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE s = 1 GROUP BY 1),
cuts AS (
  SELECT c.lang, c.s, c.p, c.f AS a, x.f AS l, y.f AS r, k, CAST(1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM counts c, (VALUES (1), (2)) t(k), counts x, counts y
  WHERE c.f >= 10 AND c.s > k AND x.lang = c.lang AND x.p = c.p[1 : k] AND y.lang = c.lang AND y.p = c.p[k + 1 : c.s]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS turn FROM cuts),
longer AS (SELECT lang, unnest([p[1 : 2], p[2 : 3]]) AS p, f FROM counts WHERE s = 3 AND f >= 10),
most AS (SELECT lang, p, max(f) AS m FROM longer GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.p = b.p WHERE turn = 1 AND coalesce(100 * m < 50 * a, true)),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

QUERIES: dict[str, Plan] = {
    plan.__name__: plan
    for plan in (
        op1_quality, op2_html_text, op3_revisits, op4_mix_sources, op5_repeats, op6_pii, op7_decontaminate, op8_near_dup, op9_lm_scores,
        op10_exact_dedup, op11_fingerprints, op12_search, op13_collocations,
    )
}
SQL: dict[str, str] = {"op8_near_dup": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op11_fingerprints": OP11_SQL, "op12_search": OP12_SQL, "op13_collocations": OP13_SQL}
