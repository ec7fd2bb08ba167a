"""The queries on line_dedup do its whole work: copied passages go with their ends."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCUMENTS, prose
from tests.llm.test_line_extension import brute_extended
from tillstar.llm import line_dedup, queries


@pytest.fixture(scope="module")
def passages():
    """(id, text) of passages of 56 words, and of texts with a copy of one at some place of theirs."""
    rng = random.Random(51)
    found = [prose(rng, 56, 11) for _ in range(9)]
    rows = list(enumerate(found))
    for k, p in enumerate(found):
        before, after = (" ".join(f"{w}{k}{s}" for s, w in enumerate(prose(rng, 9 + 2 * k).split())) for _ in "ab")
        rows.append((100 + k, f"{before}\n{p}\t{after}"))
    return rows


def test_op1_removes_the_ends_of_copied_passages(spark, passages, tmp_path):
    docs = spark.createDataFrame(passages, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_line_dedup(spark, str(tmp_path)).collect()
    expected = [(i, n, sha256(t.encode()).hexdigest()) for i, t, n in brute_extended(passages)]
    assert sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in found) == expected
    assert all(n == (56 if i >= 100 else 0) for i, n, _ in expected)


def marks(spark, rows):
    given = ", ".join(f"struct(int({s}) as start, {f} as first, bigint({c}) as copy)" for s, f, c in rows)
    found = line_dedup._ends(F.expr(f"array({given})"), 16, 32)
    return [m.start for m in spark.range(1).select(found.alias("m")).first().m]


def test_only_matches_that_can_grow_are_extended(spark):
    one, two, own = "bigint(1)", "bigint(2)", "cast(null as bigint)"
    # A copied passage; two passages side by side; a gap; a period of one word; copies in the own text.
    assert marks(spark, [(s, one, s + 40) for s in range(0, 200, 9)]) == [0, 198]
    apart = [(s, one, s + 40) for s in (0, 9, 18)] + [(s, two, s) for s in (51, 60)]
    assert marks(spark, apart) == [0, 18, 51, 60]
    assert marks(spark, [(s, one, s + 40 * (s % 2)) for s in range(0, 90, 9)]) == [0, 9, 72, 81]
    assert set(marks(spark, [(s, one, 7) for s in range(90)])) <= {*range(16), *range(74, 90)}
    assert marks(spark, [(s, own, s - 60) for s in range(60, 120, 10)]) == [60, 110]
    assert marks(spark, [(5, two, 9)]) == [5]


def test_pipeline_stage_removes_the_ends_of_copied_passages(spark, passages):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in passages], DOCUMENTS)
    found = corpus_pipeline.line_dedup_stage(spark, docs, "").collect()
    expected = [(i, t, len(t)) for i, t, _ in brute_extended(passages)]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in found) == expected
    texts = dict(passages)
    assert not any(set(texts[r.doc_id - 100].split()) & set(r.text.split()) for r in found if r.doc_id >= 100)
