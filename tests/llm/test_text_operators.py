import collections

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import captures, decontaminate, html_text, pii, quality, revisits


def _documents(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


# -- quality ----------------------------------------------------------------


def test_held_out_ratings_are_met(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    fitted = labels.filter("doc_id % 4 <> 0")
    scored = quality.score(_documents(spark, path), fitted).join(labels.filter("doc_id % 4 = 0"), "doc_id")
    rows = scored.select("p_grade_1", "p_grade_2", "expected_grade", "selected", quality.grade().alias("g")).collect()
    right = collections.Counter((r.g, r.selected) for r in rows)
    for g in range(3):
        assert right[g, g == 2] / (right[g, True] + right[g, False]) > 0.9, right
    assert all(r.p_grade_1 >= r.p_grade_2 for r in rows)


def test_thresholds_rise_and_gradient_is_right():
    rng = np.random.default_rng(1)
    found = [np.unique(rng.integers(0, 64, 6)) for _ in range(600)]
    grades = np.array([int(7 in f or 9 in f) + int(7 in f and 9 in f) for f in found])
    model = quality.fit(found, grades, bits=6)
    assert (np.diff(model.thresholds) > 0).all()
    edges = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    expected = model.tails(model.scores(np.concatenate(found), edges)).sum(1)
    assert expected[grades == 0].mean() < expected[grades == 1].mean() < expected[grades == 2].mean()


def test_quality_of_odd_rows(spark):
    rows = [(1, "good words here", 5), (2, None, 5), (3, "", 5), (None, "x", 5), (1, "good words here", 5), (4, "long " * 40_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, selected int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 0), (3, 0, None)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, labels)
    assert scored.count() == 6 and scored.columns == ["doc_id", "text", "expected_grade", "p_grade_1", "p_grade_2", "selected"]
    assert quality.select(docs, labels).columns == docs.columns
    blank = quality.score(docs, labels.limit(0)).collect()
    assert all(r.selected and r.expected_grade is None for r in blank)
    assert quality.score(docs.limit(0), labels).count() == 0


# -- pages ------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>We use cookies</p></div><main><article><h2>A &amp; B&nbsp;C</h2><p>One <b>bold</b>ly
 said.<br>Two<p>Three<div class="ad">Buy</div><form><input>Name</form><aside>Side</aside><p>Fo<!-- x -->ur &lt;five&gt;</article>
<section id="comments"><article>Nice!</article></section></main><footer>&copy; me</footer></body></html>"""


def _texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: (r.text, r.n_chars) for r in html_text.main_texts(pages).collect()}


def test_article_without_the_rest(spark):
    text = "A & B C One boldly said. Two Three Four <five>"
    rows = [(1, "http://a/1", PAGE), (2, None, None), (3, "http://a/3", ""), (4, "http://a/4", "<p>a < b & c"), (5, "x", "<article><nav>no</article><p>open")]
    got = _texts(spark, rows)
    assert got[1] == (text, len(text))
    assert got[2] == got[3] == ("", 0)
    assert got[4] == ("a < b & c", 9)
    assert got[5] == ("", 0)


def test_repeated_runs_go_where_no_article_is_marked(spark):
    notice = "This site keeps what you read for ninety days and shares nothing."
    rows = [(k, f"https://h{k % 2}.org/{k}", f"<div><p>{notice}</p><p>Page {k} says {' '.join(f'w{k}x{j}' for j in range(30))}.</p></div>") for k in range(8)]
    got = _texts(spark, rows)
    for k, (text, _) in got.items():
        assert text == f"Page {k} says {' '.join(f'w{k}x{j}' for j in range(30))}."
    copies = _texts(spark, [(k, "https://h.org/same", rows[0][2]) for k in range(3)])
    assert len(set(copies.values())) == 1 and notice in copies[0][0]


def _says(*words):
    return " ".join(str(w) for w in words)


def test_repeats_are_found_at_any_offset(spark):
    notice = _says(*(f"n{j}" for j in range(20)))
    rows = [(k, "https://h.org/x", f"<p>{_says(*(f'a{k}x{j}' for j in range(20 + k)))} {notice} {_says(*(f'b{k}x{j}' for j in range(20)))}</p>") for k in range(2, 12)]
    for k, (text, _) in _texts(spark, rows).items():
        assert text == _says(*(f"a{k}x{j}" for j in range(20 + k)), *(f"b{k}x{j}" for j in range(20)))


def test_repeats_go_from_marked_articles_and_unique_text_stays(spark):
    notice = "Our shop sells all that you read about here, at half price."
    own = {k: f"{_says(*(f'a{k}x{j}' for j in range(15)))}." for k in range(6)}
    rest = {k: f"Here {_says(*(f'b{k}x{j}' for j in range(15)))} end." for k in range(6)}
    rows = [(k, "https://h.org/x", f"<article><p>{own[k]} {notice} {rest[k]}</p></article><footer>f</footer>") for k in range(6)]
    # A near copy of an article is not boilerplate.
    rows += [(k, "https://g.org/x", f"<article><p>{own[0]} {notice} {rest[0]}</p><p>Copy {k}.</p></article>") for k in (10, 11)]
    got = _texts(spark, rows)
    assert {k: got[k][0] for k in range(6)} == {k: f"{own[k]} {rest[k]}" for k in range(6)}
    assert got[10][0] == f"{own[0]} {notice} {rest[0]} Copy 10."


def test_what_only_one_page_says_twice_stays(spark):
    twice = _says(*(f"t{j}" for j in range(10)))
    page = f"<p>{twice} {_says(*(f'a{j}' for j in range(12)))}</p><p>{twice} {_says(*(f'b{j}' for j in range(12)))}</p>"
    rows = [(1, "https://h.org/1", page), (2, "https://h.org/2", "<p>something else is said here on this other page</p>"), (3, "https://g.org/1", page)]
    got = _texts(spark, rows)
    assert got[1][0].count(twice) == got[3][0].count(twice) == 2


def test_names_do_not_take_the_article_with_them(spark):
    story = "The story that all came for is told here at some length."
    pages = {
        1: f'<article class="post comments-open"><p>{story}</p></article>',
        2: f'<article data-comment-count="3"><p>{story}</p></article>',
        3: f'<div class="layout-sidebar-right"><article><p>{story}</p></article><div class="sidebar">Elsewhere</div></div>',
        4: f'<div id="main-search-results" class="has-sidebar"><p>{story}</p></div><div class="site-footer">Imprint</div>',
        5: f'<article><p class="notice">Old browser<p>{story}</article>',
        6: f'<article><ul><li class="related">See also<ul><li>That</li></ul><li>{story}</ul></article>',
        7: f'<article><table><tr><td class="ad">Buy<td>{story}<tr><td class="ad">Buy</table></article>',
        8: f'<form id="page"><article><p>{story}</p><form>Vote</form></article></form><form>Find</form>',
        9: f'<article><p>{story}</p></article><section class="comments"><article>First!</article></section><article class="comment-7">Me too</article>',
        10: '<div class="cookie-notice">We use cookies</div><form>Name</form>',
        11: f'<div class="sidebar"><p>Elsewhere</p></div><p>{story}</p><div class="post-comments">First!</div>',
    }
    got = _texts(spark, [(k, f"http://h{k}/", page) for k, page in pages.items()])
    assert {k: text for k, (text, _) in got.items()} == {k: "" if k == 10 else story for k in pages}


def test_copies_of_an_article_keep_all_of_it(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(120)]
    pages = []
    for k in range(40):
        own = [f"e{k}" if rng.random() < 0.04 else w for w in words]
        text = [_says(*own[j : j + 12]) + "." for j in range(0, 120, 12)]
        pages.append(f"<article><h1>The same title of many words for each of the copies</h1><p>{' '.join(text)}</p><p>Released under the terms that are usual for such a text.</p></article>")
    got = _texts(spark, [(k, "https://h.org/x", page) for k, page in enumerate(pages)])
    for k, page in enumerate(pages):
        assert got[k][0] == " ".join(html_text.re.sub("<[^>]*>", " ", page).split())


def _plain_runs(pages, host):
    """All stretches that suffixes of a host share, found by looking at every prefix of every suffix."""
    import pyarrow as pa

    columns = [[p[0] for p in pages], [host] * len(pages), [p[2] for p in pages], [p[3] for p in pages], [p[4] for p in pages]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.int32())))], list("abcde"))
    tokens = {p[0]: p[3].split() for p in pages}
    marked = {p[0]: p[2] for p in pages}
    by_key = collections.defaultdict(list)
    for found in html_text._starts(iter([batch])):
        for r in found.to_pylist():
            by_key[r["key"]].append(r)
    best = {}
    for rows in by_key.values():
        around = collections.Counter(r["around"] for r in rows if r["first"])
        if sum(around.values()) < html_text.PAGES or 2 * max(around.values()) > sum(around.values()):
            continue
        prefixes = collections.defaultdict(list)
        for r in rows:
            own = tokens[r["row_no"]][r["at"] :]
            for depth in range(html_text.MARK, len(own) + 1):
                prefixes[tuple(own[:depth])].append(r)
        for prefix, members in prefixes.items():
            counting = [r for r in members if r["first"]]
            n = len(counting)

            def no_majority(values, n=n):
                return 2 * max(collections.Counter(values).values()) <= n

            def token(r, at):
                own = tokens[r["row_no"]]
                return own[at] if 0 <= at < len(own) else ("edge", None if marked[r["row_no"]] else r["row_no"])

            if n < html_text.PAGES or not no_majority([token(r, r["at"] + len(prefix)) for r in counting]):
                continue
            looked = 1 if marked[rows[0]["row_no"]] else html_text._CHOICE
            shared = []
            for k in range(1, looked + 1):
                lefts = collections.Counter(tuple(token(r, r["at"] - j) for j in range(1, k + 1)) for r in counting)
                top, count = lefts.most_common(1)[0]
                if 2 * count > n:
                    shared.append(top)
            if len(shared) == looked:
                continue
            for r in members:
                extra = sum(tuple(token(r, r["at"] - j) for j in range(1, len(s) + 1)) == s for s in shared)
                if extra + len(prefix) >= html_text.MIN_TOKENS:
                    place = (r["row_no"], r["at"])
                    best[place] = max(best.get(place, (0, 0)), (r["at"] + len(prefix), r["at"] - extra))
    return sorted((k, start, end) for (k, _), (end, start) in best.items())


@pytest.mark.parametrize("marked", [True, False])
def test_runs_are_those_of_a_plain_search(spark, marked):
    rng = np.random.default_rng(5)
    notices = [[f"n{k}x{j}" for j in range(size)] for k, size in enumerate((9, 14, 30))]
    notices.append(notices[1] + ["and", "more", "of", "it"])
    pages = []
    for k in range(40):
        parts, edges = [], [0]
        for _ in range(5):
            parts += [str(w) for w in rng.integers(0, 400, rng.integers(3, 12))]
            edges.append(len(parts))
            parts += notices[rng.integers(0, 4)] if rng.random() < 0.7 else [f"c{j}" for j in range(20)]
            edges.append(len(parts))
        pages.append((k, "h", marked, _says(*parts), edges[:-1]))
    frame = spark.createDataFrame(pages, "row_no long, host string, marked boolean, stream string, edges array<int>")
    # Which marks are chosen depends on the host's hash.
    want = _plain_runs(pages, frame.select(F.xxhash64("host", "marked")).first()[0])
    assert len(want) > 40
    for group in (4_096, 6):
        got = html_text.repeated_runs(frame, group=group).collect()
        assert sorted((r.row_no, r.start, r.end) for r in got) == want


def test_pages_without_foreign_text_keep_their_whole_article(spark):
    """The smallest table's articles as another parser reads them."""
    import html.parser

    class Article(html.parser.HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.pieces = False, []

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            if tag not in html_text._INLINE:
                self.pieces.append(" ")

        def handle_endtag(self, tag):
            self.inside &= tag != "article"
            if tag not in html_text._INLINE:
                self.pieces.append(" ")

        def handle_data(self, data):
            if self.inside:
                self.pieces.append(data)

    for sf in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
        got = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
        for row in pages.collect():
            reader = Article()
            reader.feed(row.html or "")
            assert got[row.page_id] == " ".join("".join(reader.pieces).split()), row.page_id


def test_long_and_broken_pages(spark):
    rows = [(1, "a", "<p " + 'x="' * 20_000), (2, "a", "<" * 50_000), (3, "a", "<div>" * 5_000 + "deep"), (4, "a", "<p>" + "word " * 100_000)]
    got = _texts(spark, rows)
    assert got[3][0] == "deep" and got[4][1] == 499_999
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string, text string")).count() == 0


# -- revisits ---------------------------------------------------------------


def _resolved(records):
    """Plain search: for each revisit all responses of its place."""
    out = {}
    for r in records:
        if r["kind"] != "revisit":
            continue
        if r["place"] is None or r["fetched_at"] is None:
            out[r["record_id"]] = ("no_url", None, None)
            continue
        old = [o for o in records if o["kind"] == "response" and o["place"] == r["place"] and o["fetched_at"] and o["fetched_at"] < r["fetched_at"]]
        if not old:
            out[r["record_id"]] = ("no_response", None, None)
            continue
        last = max(old, key=lambda o: (o["fetched_at"], o["record_id"]))
        plain = lambda t: (t or "").strip().removeprefix("W/").removeprefix("w/")
        if r["etag"] is not None:
            outcome = "resolved" if plain(r["etag"]) == plain(last["etag"]) else "changed"
        elif r["last_modified"] is not None:
            outcome = "resolved" if r["last_modified"] == last["last_modified"] else "changed"
        else:
            outcome = "unchecked"
        headers = None
        if outcome != "changed":
            low = lambda h: {k.lower(): v for k, v in (h or {}).items()}
            headers = {**low(last["headers"]), **{k: v for k, v in low(r["headers"]).items() if k not in revisits.NOT_MERGED}}
        out[r["record_id"]] = (outcome, last["record_id"], headers)
    return out


def test_revisits_as_by_plain_search(spark, sf):
    records = captures.captures(spark.read.parquet(f"{sf}/pages.parquet"))
    # Few places with many records each, ties and nulls among them.
    records = records.withColumn("url", F.when(F.col("record_id") % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("http://www.h.org/"), (F.col("record_id") % 4).cast("string"))))
    records = records.withColumn("fetched_at", F.when(F.col("record_id") % 13 != 0, F.timestamp_seconds(F.unix_timestamp("fetched_at") % 50)))
    rows = [r.asDict() for r in records.withColumn("place", revisits.canonical_url(F.col("url"))).collect()]
    got = {r.record_id: (r.outcome, r.response_id, r.headers) for r in revisits.resolve(records).collect()}
    assert got == _resolved(rows)
    assert {o for o, _, _ in got.values()} >= {"changed", "unchecked", "no_url", "no_response"}
    plain = captures.captures(spark.read.parquet(f"{sf}/pages.parquet"))
    one_each = [r.asDict() for r in plain.withColumn("place", revisits.canonical_url(F.col("url"))).collect()]
    got_plain = {r.record_id: (r.outcome, r.response_id, r.headers) for r in revisits.resolve(plain).collect()}
    assert got_plain == _resolved(one_each) and "resolved" in {o for o, _, _ in got_plain.values()}
    assert revisits.resolve(records.limit(0)).count() == 0
    bodies = revisits.with_bodies(revisits.resolve(records), records.withColumn("html", F.lit("b")), "html")
    assert bodies.count() == sum(o in ("resolved", "unchecked") for o, _, _ in got.values())


def test_canonical_urls(spark):
    same = ["http://www.A.org/x/", "https://a.org/x", "https://a.org:443/x#y", "http://a.org/x?utm_source=f", "HTTP://A.ORG/x/index.html"]
    rows = spark.createDataFrame([(u,) for u in [*same, "http://a.org/x?b=2&a=1", None, ""]], "u string")
    got = [r[0] for r in rows.select(revisits.canonical_url(F.col("u"))).collect()]
    assert got == ["a.org/x"] * 5 + ["a.org/x?a=1&b=2", None, ""]


# -- benchmark --------------------------------------------------------------


def test_leaks_are_found_and_others_left_alone(spark, sf):
    docs = _documents(spark, sf)
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    listed = {r.item_id: r.text for r in items.collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for k, (item, text) in enumerate(listed.items()):
        before, after = " ".join(rows[k][1].split()[: 3 * k]), " ".join(rows[-k][1].split()[:40])
        rows.append((10_000 + item, f"{before} {text.upper() if k % 2 else text} {after}"))
    plain = lambda t: " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split())
    want = {(i, item) for i, t in rows for item, text in listed.items() if f" {plain(text)} " in f" {plain(t)} "}
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    exact = {(r.doc_id, r.item_id) for r in got if r.similarity == 1}
    assert want <= {(r.doc_id, r.item_id) for r in got}
    assert exact == {(r.doc_id, r.item_id) for r in got if r.similarity > 0.999} and want >= exact
    # What else is found is nearly an item: most of its five-word shingles stand in the document.
    texts = dict(rows)
    for r in got:
        own = brute.shingles(plain(listed[r.item_id]), 5)
        assert len(own & brute.shingles(plain(texts[r.doc_id]), 5)) >= 0.7 * len(own)
    blocks = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items, block=7)
    assert blocks.count() == len(got)


def test_similarity_does_not_depend_on_blocks(spark):
    own = [f"w{k}" for k in range(38)]
    # Items share shingles with each other; a document has the first of them with its last words changed.
    items = [(k, " ".join(own[: 10 + k] + [f"i{k}x{j}" for j in range(28 - k)])) for k in range(24)] + [(24, " ".join(own)), (25, " ".join(own))]
    docs = spark.createDataFrame([(1, " ".join([*own[:35], "x", "y", "z"])), (2, items[5][1]), (3, " ".join(own))], "doc_id long, text string")
    listed = spark.createDataFrame(items, "item_id long, text string")
    whole, *others = (sorted(map(tuple, decontaminate.find_leaks(docs, listed, block=size).collect())) for size in (4096, 13, 1))
    assert whole and all(found == whole for found in others)


def test_fingerprints_are_votes():
    rng = np.random.default_rng(2)
    shingles = rng.integers(0, 2**63, 300, dtype=np.uint64)
    weights = rng.integers(1, 3, 300)
    bits = ((shingles[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)
    for lane, spans in ((8, (10, 55, 100)), (16, (10, 250))):
        votes = decontaminate.Votes(shingles, weights, lane)
        for span in spans:
            at = np.arange(0, 300 - span)
            want = [sum(1 << b for b in range(64) if 2 * (bits[s : s + span, b] * weights[s : s + span]).sum() > weights[s : s + span].sum()) for s in at]
            # Planes hold the bits in another order.
            order = [lane_no * lane + plane for lane_no in range(64 // lane) for plane in range(lane)]
            got = votes.prints(at, at + span)
            assert [int(g) for g in got] == [sum(((w >> b) & 1) << b for b in order) for w in want]


def test_leaks_in_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "tiny item"), (5, "x " * 300)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, f"so {item}, yes"), (4, "a tiny, item!"), (5, "word " * 100_000), (6, "x " * 300), (7, "one two three")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect())
    assert got == {(3, 1): 4, (None, 1): 2, (4, 4): 1, (6, 5): 1}
    left = decontaminate.drop_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 5, 7]
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs.limit(0), items).count() == 0


# -- personal data ----------------------------------------------------------

ODD = [
    None, "", "a@b.c", "x.y+z@d-e.f.g, a@b.c_d@e.f a@@b.c a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1.2.3", "é 4111 1111 1111 1111 4111-1111-1111-1112 12",
    "+1 (555) 123-4567. +123456789 +12345678901234567 +1+2 555", "4" * 5000, "a" * 50_000, "a." * 20_000 + "@", "😀 me@x.org 😀 +49 30 1234567 😀", "+1 4111111111111111",
]


def _spans(row):
    return [(s.start, s.turn, s.end, s.kind) for s in row]


def test_base_spans_are_those_of_the_plain_patterns(spark, sf):
    rows = [(r.doc_id, r.text) for r in _documents(spark, sf).select("doc_id", "text").collect()] + [(10_000 + k, t) for k, t in enumerate(ODD)]
    got = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {i: brute.personal(t) for i, t in rows}
    assert {r.doc_id: _spans(r.base) for r in got} == want
    for r in got:
        assert set(_spans(r.base)) <= set(_spans(r.spans)) and _spans(r.spans) == sorted(_spans(r.spans))


def test_terms_that_tell_who_it_is(spark):
    rows = [(k, f"Filler text number {k} from afar about nothing with common words") for k in range(40)]
    rows += [(100 + k, f"Common words from Zebulon Quxley at zq@example.org about nothing {k}") for k in range(3)]
    rows += [*((200 + k, "Zebulonian things") for k in range(5)), (210, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    text = dict(rows)[100]
    terms = {text[s.start : s.end]: s.action for s in found[100].spans if s.kind == "term"}
    assert terms == {"Zebulon": "generalise", "Quxley": "remove"}
    assert not found[0].spans and not found[210].spans
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "zq@" not in clean[100] and "[email]" in clean[100] and "Quxley" not in clean[100] and "Common words from Zebu* [term] at" in clean[100]
    assert clean[0] == dict(rows)[0] and clean[210] is None
    # The same by counting in plain Python.
    n, with_entity = len(rows), 3
    for term, told in (("quxley", True), ("common", False), ("about", False)):
        have = sum(term in (t or "").lower() for _, t in rows)
        share = np.log2(n * with_entity / (have * with_entity)) / np.log2(n / with_entity)
        assert (share >= pii.THRESHOLD) == told
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_disclosing_terms_are_found_in_the_whole_text(spark):
    filler = "common words about nothing " * 20
    rows = [(k, f"{filler} number {k}") for k in range(40)]
    rows += [(100 + k, f"Quxley began. {filler}Mail zq@example.org, exp 12, {filler}signed Quxley. {filler}QUXLEY said {k}") for k in range(3)]
    rows += [(200, f"{filler}Quxley elsewhere")]
    found = {r.doc_id: r for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        spans = [(s.start, text[s.start : s.end]) for s in found[i].spans if s.kind == "term" and text[s.start : s.end].lower() == "quxley"]
        want = [k for k in range(len(text)) if text[k : k + 6].lower() == "quxley"] if 100 <= i < 200 else []
        assert [at for at, _ in spans] == want
        assert not any("common" in text[s.start : s.end] for s in found[i].spans)


def test_spans_of_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "to me@x.org now", 1), (1, "to me@x.org now", 2), (None, "to me@x.org now", 3)], "doc_id long, text string, spans int")
    assert [[s.kind for s in r.base] for r in pii.find_spans(docs).collect()] == [["email"]] * 3
    assert {r.text for r in pii.sanitise(docs).collect()} == {"to [email] now"}


@pytest.mark.parametrize("kind", pii.PATTERNS)
def test_patterns_do_not_use_up_the_stack(spark, kind):
    docs = spark.createDataFrame([(1, {"email": "a@" + "b." * 60_000 + "c", "ip": "1." * 60_000, "card": "4 " * 60_000, "phone": "+1" + "(2)" * 60_000}[kind])], "doc_id long, text string")
    assert pii.find_spans(docs).count() == 1
