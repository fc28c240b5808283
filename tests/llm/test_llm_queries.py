"""The registered queries against their SQL, and the pipeline's stages against each other."""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import duckdb
import pytest
from tests_llm_data import ODD

import __spark_entry__ as catalogue
import corpus_pipeline
from loadwarden.llm import minhash, quality, secrets
from loadwarden.llm.rows import stored

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


def test_all_are_registered():
    names = set(catalogue.queries()) - set(catalogue.library_queries())
    assert names - {"pipeline"} == {n for n in names if n.startswith("op")}
    assert sorted(int(n[2:].split("_")[0]) for n in names - {"pipeline"}) == list(range(1, 14))
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mix", "pack"]


WITH_SQL = [
    "op2_find_secrets",
    "op4_near_vectors",
    "op8_mix_sources",
    "op11_prefix_trie",
    "op12_format_chats",
    "op13_mine_collocations",
]


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_against_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    cursor = connection.execute(catalogue.oracle_sql()[name])
    names = sorted(column[0] for column in cursor.description)
    columns = [column[0] for column in cursor.description]
    expected = [dict(zip(columns, row)) for row in cursor.fetchall()]
    df = catalogue.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == names
    actual = [row.asDict() for row in df.collect()]
    assert sorted(repr([r[n] for n in names]) for r in actual) == sorted(
        repr([r[n] for n in names]) for r in expected
    )


def test_stages_build_on_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF_DIR), name)
        kept[name] = (before, docs)
        if name != "pack":
            assert docs.columns == before.columns
    before, good = kept["quality"]
    score = {r.doc_id: r.score for r in quality.score_quality(before, quality.fit_quality(before, labels)).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in score.items() if s >= 0.5}
    before, single = kept["near_dedup"]
    first = {r.doc_id for r in minhash.near_duplicates(before).collect() if r.kept}
    assert {r.doc_id for r in single.collect()} == first and len(first) < before.count()
    _, masked = kept["secrets"]
    assert all(not r.spans for r in secrets.find_secrets(masked).collect())
    before, mixed = kept["mix"]
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert abs(words(mixed) - words(before)) <= 30
    before, packed = kept["pack"]
    sizes = defaultdict(int)
    for r in packed.collect():
        assert len(r.ids) == 4 * r.length
        sizes[r.sequence_id] += r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.values())
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}


def test_stages_survive_odd_texts(spark, make_docs):
    docs = make_docs(ODD)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
    assert docs.columns[0] == "doc_id"
