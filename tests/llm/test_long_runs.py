"""Boilerplate of any length goes: suffixes are followed chunk by chunk."""

import pytest

from earshot.llm import html_text
from earshot.session import materialize


def _frame(spark, sizes, pages=5):
    rows = []
    for k in range(pages):
        stream, edges = [], []
        for n, size in enumerate(sizes):
            edges.append(len(stream))
            stream += [f"own{k}x{n}x{j}" for j in range(7 + k)] + [f"n{n}x{j}" for j in range(size)]
        stream += [f"end{k}"]
        rows.append((k, "h", False, " ".join(stream), edges))
    return spark.createDataFrame(rows, "row_no long, host string, marked boolean, stream string, edges array<int>")


@pytest.mark.parametrize("group", [4_096, 2])
def test_runs_around_and_beyond_a_chunk(spark, group):
    sizes = [255, 256, 257, 300, 767, 1_500]
    got = html_text.repeated_runs(_frame(spark, sizes), group=group).collect()
    for k in range(5):
        at, want = 0, []
        for size in sizes:
            at += 7 + k
            want.append((at, at + size))
            at += size
        assert {(r.start, r.end) for r in got if r.row_no == k} == set(want)


def test_a_long_notice_goes_and_the_page_stays(spark):
    notice = " ".join(f"n{j}" for j in range(400))
    rows = [(k, f"https://h.org/{k}", f"<div><p>{notice}</p><p>{' '.join(f'w{k}x{j}' for j in range(30))}</p></div>") for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_text.main_texts(pages).collect():
        assert r.text == " ".join(f"w{r.page_id}x{j}" for j in range(30))


def test_pages_that_repeat_a_few_tokens_weigh_as_one_place(spark, monkeypatch):
    """Of a page only the first suffix with a key decides: a page of one word has hundreds, and no key becomes frequent."""
    notice = [f"n{k}" for k in range(12)]
    rows = []
    for k in range(8):
        tokens = [f"a{k}x{i}" for i in range(20)] + notice + [f"b{k}x{i}" for i in range(20)] + ["ha"] * (300 + 7 * k) + [f"c{k}"] * 9
        rows.append((k, "h", False, " ".join(tokens), [0]))
    frame = spark.createDataFrame(rows, "row_no long, host string, marked boolean, stream string, edges array<int>")
    labels = []

    def named(df, label="step"):
        labels.append(label)
        return materialize(df, label)

    monkeypatch.setattr(html_text, "materialize", named)
    plain = sorted(tuple(r) for r in html_text.repeated_runs(frame).collect())
    labels.clear()
    assert sorted(tuple(r) for r in html_text.repeated_runs(frame, group=16).collect()) == plain
    assert {(row, 20, 32) for row in range(8)} <= {r[:3] for r in plain}
    assert labels.count("frequent") == labels.count("places") - 1
