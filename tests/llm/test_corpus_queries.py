"""The registered queries: their columns, and their rows beside SQL where there is some."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_module
from earshot.llm import queries

COLUMNS = {
    "op2_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_repeats": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6_pii": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string",
        "spans": "string",
    },
    "op8_near_dup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_lm_scores": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
        "base_score": "double", "score": "double",
    },
    "op10_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
}


@pytest.mark.parametrize("name", list(queries.SQL))
def test_rows_are_those_of_sql(name, spark, sf):
    assert differences(queries.QUERIES[name](spark, sf), duck(sf), queries.SQL[name]) == []


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(name, spark, sf):
    df = queries.QUERIES[name](spark, sf)
    kinds = dict(df.dtypes)
    assert list(kinds)[: len(COLUMNS[name])] == list(COLUMNS[name])
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]
    table = "pages" if name.startswith("op2") else "documents"
    assert df.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


def test_all_are_registered():
    numbers = {name.split("_")[0] for name in entry_module.queries() if name.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= numbers and "pipeline" in entry_module.queries()
