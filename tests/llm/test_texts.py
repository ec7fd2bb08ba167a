"""Decontamination, classifiers and the codec, by brute force, accuracy and the library."""

from __future__ import annotations

import random
import time
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as formats

from tests.llm.conftest import DOCUMENTS, prose
from tillstar.llm import decontaminate, piece_codec, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def least_edits(item: str, text: str) -> int:
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
        before = row
    return min(before)


def changed(rng: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.choice("sid")
        if kind == "s":
            out[at] = rng.choice("abcdefgh ")
        elif kind == "i":
            out.insert(at, rng.choice("abcdefgh "))
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_leaks_against_edit_distance(spark, block_bytes):
    rng = random.Random(6)
    items = [(k, "".join(rng.choice("abcdefgh ") for _ in range(n))) for k, n in
             enumerate((5, 25, 50, 90, 140, 200))]
    texts = []
    for k in range(60):
        item = rng.choice(items)[1]
        leak = changed(rng, item, rng.randint(0, len(item) // 8))
        texts.append(prose(rng, rng.randint(0, 12), 50) + leak + prose(rng, rng.randint(0, 12), 50))
    texts += [None, "", items[3][1].upper(), items[5][1][:100]]
    docs = spark.createDataFrame(
        [(k, t, "old") for k, t in enumerate(texts)], "doc_id long, text string, leaks string"
    )
    bench = spark.createDataFrame([*items, (9, None), (10, " "), (None, "abc")], "item_id long, text string")
    found = decontaminate.with_leaks(docs, bench, block_bytes=block_bytes).collect()
    assert len(found) == len(texts)
    for r in found:
        text = (r.text or "").lower().replace("\n", " ")
        got = {x.item_id: x for x in r.leaks}
        for k, item in items:
            size = len(item)
            budget = min(int(0.1 * size), max(size - 8, 0) // 8)
            edits = least_edits(item, text)
            assert (edits <= budget) == (k in got)
            if k in got:
                place = got[k]
                assert place.edits == edits == least_edits(item, text[place.start : place.end])
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.leaks}


def test_leaks_of_empty_tables(documents, no_documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminated(documents, none).count() == documents.count()
    assert decontaminate.decontaminated(no_documents, none).count() == 0


ODD = ["", " ", "▁", " ▁", "\n", "a", "\x00", "<s> </s> <0x0A>", "😀😀 日本", "   x   y  ", "é́ﬁ"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(queries.PIECE_MODEL)
    )


def test_codec_against_the_library(spark, documents, library):
    rng = random.Random(8)
    bits = [*ODD, "the", " tion", "ción", ".", "==", "\t", "한"]
    texts = [*ODD, None, *("".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(150))]
    texts += [r.text for r in documents.collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    model = queries.piece_model()
    spans = {r.doc_id: r for r in piece_codec.with_pieces(df, model).collect()}
    marks = {r.doc_id: r for r in piece_codec.with_digests(df, model).collect()}
    for k, text in enumerate(texts):
        text = text or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert list(spans[k].piece_ids) == ids
        raw = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids).encode()
        assert tuple(marks[k])[2:5] == (len(ids), sha256(raw).hexdigest(), sha256(decoded).hexdigest())
        surfaces = [p.surface for p in library.encode(text, return_type="proto").pieces]
        ends = zip(spans[k].piece_starts[1:-1], spans[k].piece_ends[1:-1], strict=True)
        assert [text.encode()[a:b].decode(errors="replace") for a, b in ends] == surfaces
        assert marks[k].spanned_bytes == len(text.encode())


def test_long_units_against_the_library(library):
    codec = piece_codec.Codec(queries.piece_model())
    rng = random.Random(21)
    chinese = [chr(k) for k in range(0x4E00, 0x4F00)]
    signs = [*"abcdefghijklmnopqrstuvwxyz"], [*"ACGT"], [*"aZ+/09xQ"], chinese, ["a"], ["a", "é", "😀"]
    texts = ["".join(rng.choices(s, k=n)) for s in signs for n in (199, 200, 201, 3_000, 40_000)]
    texts += [f"the {texts[3]} and {texts[8]}", texts[3]]
    started = time.process_time()
    ids, per_text, starts, ends = codec.encode(texts)
    assert time.process_time() - started < 10  # a step per merge over all that is left took minutes
    bounds = np.cumsum(per_text)[:-1]
    for text, own, a, b in zip(
        texts, *(np.split(v, bounds) for v in (ids, starts, ends)), strict=True
    ):
        assert own.tolist() == library.encode(text)
        assert a[0] == 0 and b[-1] == len(text.encode()) and (a[1:] == b[:-1]).all()


def test_units_that_share_a_key_keep_their_own_ids(library, monkeypatch):
    def few(self, points, first, count):
        return np.arange(len(first)) % 2

    monkeypatch.setattr(piece_codec.Codec, "_unit_keys", few)
    codec = piece_codec.Codec(queries.piece_model())
    rng = random.Random(22)
    for _ in range(3):
        texts = [prose(rng, 30).replace("\n", " ") for _ in range(5)] + ["", "x" * 300, "日 本"]
        ids, per_text, _, _ = codec.encode(texts)
        for text, own in zip(texts, np.split(ids, np.cumsum(per_text)[:-1]), strict=True):
            assert own.tolist() == library.encode(text)


def test_character_map_against_the_library():
    normalizer = sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc",
        add_dummy_prefix=False,
        escape_whitespaces=False,
        remove_extra_whitespaces=False,
    )
    proto = formats.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    table = piece_codec.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    rng = random.Random(1)
    signs = ["a", "Á", "ﬁ", "①", "　", "カ", "ﾞ", "e", "́", "㌔", "½", "\t", "\n", "한", "ᄒ", "ᅡ", "…", "😀"]
    for _ in range(500):
        text = "".join(rng.choices(signs, k=rng.randint(0, 15)))
        mapped, origin = table.mapped(text)
        assert mapped == normalizer.normalize(text)
        assert len(origin) == len(mapped) + 1 and origin[-1] == len(text.encode())
        assert (np.diff(origin) >= 0).all()


def toxic_corpus(rng):
    rows, labels = [], []
    bad = ["gronk", "snarfle", "blivver"]
    for k in range(900):
        words = prose(rng, rng.randint(20, 200), 10).split(" ")
        toxic = int(rng.random() < 0.2)
        for _ in range(len(words) // 25 + 1 if toxic else 0):
            word = rng.choice(bad)
            if k >= 600:  # spellings never seen in training
                word = word + rng.choice(["er", "z", "ed"])
            words[rng.randrange(len(words))] = word
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 1, toxic))
    return rows, labels


def test_toxicity_on_misspellings_and_edges(spark):
    rows, labels = toxic_corpus(random.Random(12))
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), rows[0]]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    known = spark.createDataFrame(labels[:600], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    assert len(got) == len(rows)
    truth = {k: t for k, _, t in labels}
    later = [r for r in got if 600 <= r.doc_id < 900]
    right = sum(r.predicted == truth[r.doc_id] for r in later)
    assert right >= 0.95 * len(later)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    empty = {r.score for r in got if r.doc_id >= 1000}
    assert len(empty) == 1
    none = known.limit(0)
    assert {r.predicted for r in toxicity.toxicity(docs.limit(5), none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), known).count() == 0


def test_toxicity_never_learns_held_out_labels(spark):
    rows, labels = toxic_corpus(random.Random(13))
    docs = spark.createDataFrame(rows[:300], DOCUMENTS)
    known = spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = known.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (
        sorted(map(tuple, toxicity.toxicity(docs, x).collect())) for x in (known, other)
    )
    assert first == second and any(r[1] for r in first)


def test_quality_held_out_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    scored = quality.with_quality(docs, labels.filter(~held))
    both = scored.join(labels.filter(held).select("doc_id", "quality"), "doc_id").collect()
    wrong = sum((r.quality_score >= 0.5) != bool(r.quality) for r in both)
    assert wrong <= 0.06 * len(both)
    assert sum(r.quality_score < 0.5 for r in both if r.quality) <= 0.03 * len(both)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and 0.7 < kept.count() / docs.count() < 0.98


def test_quality_without_labels_or_columns(documents, no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.good_documents(documents, none).count() == documents.count()
    known = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0)], none.schema)
    assert quality.good_documents(no_documents, known).count() == 0
    bare = documents.select("doc_id", "text").withColumn("quality_score", F.lit("old"))
    scored = quality.with_quality(bare, known).collect()
    assert len(scored) == bare.count() and all(0 <= r.quality_score <= 1 for r in scored)


def test_names_have_slots_of_their_own():
    names = ["en", "de", "fr", "es", "web", "news", "forum", *(f"src{k}" for k in range(20)), None]
    slots = quality._slots(names).tolist()
    assert len(set(slots)) == len(names) and slots[-1] == 0


def test_quality_that_follows_the_source_only(spark):
    rng = random.Random(31)
    rows = [(k, prose(rng, 40), "en", f"s{rng.randrange(6)}", 300) for k in range(800)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    labels = [(r[0], int(r[3] not in ("s1", "s4")), 0) for r in rows]
    known = spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int")
    truth = {k: q for k, q, _ in labels}
    later = quality.with_quality(docs, known).filter("doc_id >= 500").collect()
    assert sum((r.quality_score >= 0.5) == bool(truth[r.doc_id]) for r in later) >= 0.97 * len(later)


def test_quality_starts_from_one_row_of_each_id(spark, monkeypatch):
    rng = random.Random(41)
    rows = [(k, prose(rng, 12), "en", "s", 9) for k in range(40) for _ in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    # Labels without a row use nothing of the sample up.
    labels = [(1, 1, 0), (2, 0, 0), *((k, 1, 0) for k in range(100, 150))]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    seen = []
    learn = quality.cotrained
    monkeypatch.setattr(quality, "cotrained", lambda v, y, s: seen.append(y) or learn(v, y, s))
    quality.fitted(docs, known, labelled=2)
    assert sorted(seen[0]) == [0, 1]


def test_quality_rounds_over_all_rows_by_plain_sums(spark):
    """The weights equal those of one loop in numpy over all rows, however they are dealt out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("doc_id % 3 <> 0")
    with_odd = docs.withColumn("id", F.lit("x")).withColumn("label", F.lit(1))
    (inner, outer), shift = quality.fitted(with_odd.repartition(7), labels)
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow().sort_by("doc_id")
    batch = rows.combine_chunks().to_batches()[0]
    text, meta = (np.concatenate(p) for p in zip(*quality._views(batch, "text"), strict=True))
    text = text.astype(np.float16).astype(float)
    meta = meta.astype(np.float32).astype(float)
    known = labels.select("doc_id", "quality").dropna()
    given = {r.doc_id: int(r.quality > 0) for r in known.collect()}
    label = np.array([given.get(k, -1) for k in rows["doc_id"].to_pylist()])
    known, free = np.flatnonzero(label >= 0), np.flatnonzero(label < 0)
    assert len(known) <= quality.LABELLED and len(free) > 300
    known = known[np.random.default_rng(5).permutation(len(known))]
    used = np.unique(quality._named(meta[known]))
    opened = quality._opened(meta, used)
    asked = []

    def summed(make):
        asked.append(1)
        return sum(make([text[k : k + 1], opened[k : k + 1]]) for k in free)

    want, bias = quality.cotrained([text[known], opened[known]], label[known], summed)
    assert len(asked) == quality.ROUNDS * (1 + quality.PASSES)
    assert np.allclose(inner, want[0], atol=1e-5) and abs(shift - bias) < 1e-5
    places = np.concatenate([np.arange(quality._KINDS), used])
    assert np.allclose(outer[places], want[1], atol=1e-5)
    alone, _ = quality.cotrained([text[known], opened[known]], label[known], summed, rounds=0)
    assert not np.allclose(alone[0], want[0], atol=1e-3)  # the rounds do change the model


def test_surest_rows_and_slopes_by_hand():
    counts = np.zeros(quality.BINS, np.int64)
    counts[[0, 3, 200, 390]] = 2, 98, 800, 100
    assert quality.surest(counts) == (3, 390)
    counts[[0, 3, 200]] = 0, 0, 900  # the lowest rows are not sure
    assert quality.surest(counts) == (170, 390)
    views = [np.array([[9.0], [0.0], [-9.0]]), np.array([[1.0], [2.0], [4.0]])]
    models = [quality.Linear(np.zeros((2, 1)), np.array([0.0, 1.0])) for _ in views]
    for model, weight in zip(models, (1.0, 0.0), strict=True):
        model.mean, model.spread, model.bias = np.zeros(1), np.ones(1), 0.0
        model.weights = np.array([weight])
    got = quality.slopes(views, models, [(170, 230), (-1, 500)], models)
    # Only the first view is sure, of its first (good) and third row (bad): errors -1/2 and 1/2.
    assert got.tolist() == [0, 0, 0, round(1.5 * quality.PART), 0, 2]


def test_quality_of_clashing_columns(documents, spark):
    known = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    odd = documents
    for name in ("__id", "__label", "__text", "quality", "id", "label", "QUALITY_", "content"):
        odd = odd.withColumn(name, F.lit(name))
    plain = quality.good_documents(documents, known)
    kept = quality.good_documents(odd, known)
    assert kept.columns == odd.columns and kept.filter("quality <> 'quality'").count() == 0
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in plain.collect())
