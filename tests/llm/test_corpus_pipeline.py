"""Registered corpus queries and the pipeline, over whole small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import DOCUMENTS, corpus, prose
from tests.llm.test_copies import brute_lines, brute_near
from tillstar.llm import decontaminate, jaccard_join, piece_codec, quality, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(columns).collect()))
    expected = db.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    assert got == sorted(expected.select(*columns).fetchall())


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with bad labels on some, and a leaked benchmark item."""
    import random

    rng = random.Random(21)
    item = prose(rng, 30)
    rows = [*corpus(), (900, prose(rng, 30) + "\n" + item, "en", "s1", 5), (None, "no id", "en", "s", 5)]
    rows += [(500 + k, " ".join(f"{w}###" for w in prose(rng, 60).split()), "en", "s", 9) for k in range(30)]
    good = [(r[0], 1, 0) for r in rows if r[0] is not None and r[0] < 25]
    labels = good + [(500 + k, 0, 0) for k in range(20)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline_against_plain_steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = quality.good_documents(docs, labels).collect()
    assert not any(r.doc_id and 500 <= r.doc_id < 530 for r in kept)
    rows = [(r.doc_id, r.text or "") for r in kept]
    numbered = [(-(2**63) if i is None else i, t) for i, t in rows]
    lines = brute_lines(numbered)
    lines = [(i, t) for i, t, n in lines if t or not n]
    near = {i: c for i, _, c in brute_near([x for x in lines if x[0] >= 0])}
    lines = {x for x in lines if near.get(x[0], x[0]) == x[0]}
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    left = spark.createDataFrame(sorted(lines), "doc_id long, text string")
    left = decontaminate.decontaminated(left, bench)
    assert left.filter("doc_id = 900").isEmpty()
    coded = piece_codec.with_digests(left, queries.piece_model()).drop("text")
    expected = sorted(tuple(r) for r in coded.collect())
    got = corpus_pipeline.run(spark, folder).fillna({"doc_id": -(2**63)})
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_stages_keep_columns_and_take_empty_input(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert empty.columns == docs.columns


def test_one_document_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.STAGES[2][1](spark, docs, folder)
    groups = jaccard_join.near_duplicates(docs).filter("doc_id is not null")
    ids = sorted(r.doc_id for r in kept.filter("doc_id is not null").collect())
    assert ids == sorted({r.component_id for r in groups.collect()})


def test_near_copies_that_repeat_an_id_with_other_texts(spark):
    import random

    rng = random.Random(18)
    first, second, clean = (prose(rng, 80) for _ in range(3))
    rows = [(1, first), (2, first + " tail"), (2, clean), (3, second), (3, second + " tail")]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], DOCUMENTS)
    kept = corpus_pipeline.STAGES[2][1](spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert len(got) == 3 and got[:2] == [(1, first), (2, clean)]
    assert got[2] in [(3, second), (3, second + " tail")]
