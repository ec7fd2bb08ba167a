"""Language spans against plain Python, odd texts, mixed texts and held-out accuracy."""

from __future__ import annotations

import itertools
import math
import random
import unicodedata
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS
from tillstar.llm import language_id

SF = "/root/testdata/sf0.01"
SENTENCES = {
    "de": "der hund und die katze schlafen heute nicht im garten weil es schneit und kalt ist",
    "en": "the dog and the cat do not sleep in the garden today because it is snowing outside",
    "es": "el perro y el gato no duermen hoy en el jardín porque está nevando y hace mucho frío",
    "el": "ο σκύλος και η γάτα δεν κοιμούνται σήμερα στον κήπο γιατί χιονίζει",
    "ru": "собака и кошка сегодня не спят в саду потому что идёт снег и очень холодно",
    "uk": "собака і кішка сьогодні не сплять у саду бо йде сніг і дуже холодно",
}
ODD = ["", " \n ", "123 – 45!", "a", "été", "x" * 200, "\x00", "ﬁ Ａ", "日本語のテキスト", "ΣΑΣ", "😀", "퟿가"]


def plain_words(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, script, lower-cased letters) of every word."""
    out, run = [], None
    for k, char in enumerate(text):
        if unicodedata.category(char)[0] == "M":
            continue
        script = None
        if char.isalpha():
            script = next((n for n, a, b in language_id.SCRIPTS if a <= ord(char) <= b), "other")
        if script is None:
            run = None
            continue
        small = char.lower() if len(char.lower()) == 1 else char
        if run != script or len(out[-1][3]) == language_id.LONGEST:
            out.append((k, k + 1, script, small))
        else:
            start, _, _, letters = out[-1]
            out[-1] = (start, k + 1, script, letters + small)
        run = script
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows, k = [], 0
    for lang, sentence in SENTENCES.items():
        words = sentence.split()
        for _ in range(12):
            text = " ".join(rng.choices(words, k=rng.randint(1, 30)))
            rows.append((k, text, lang, "s", len(text)))
            k += 1
    for text in [*ODD, None]:
        rows.append((k, text, None, None, None))
        k += 1
    rows += [rows[0], (1, rows[30][1], "de", "s", 0), (None, "the dog", "ru", None, None)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3), rows


def test_words_against_plain_python(table):
    texts = [r[1] or "" for r in table[1]] + ["aЖb가é中の", "ab́" * 50]
    words = language_id.words_of(texts)
    found = defaultdict(list)
    letters = "".join(map(chr, words.stream.tolist())).split("\x00")
    letters = [x for x in letters if x]
    for k, text in enumerate(words.text.tolist()):
        name = language_id.NAMES[words.script[k]]
        found[text].append((int(words.start[k]), int(words.end[k]), name, letters[k]))
    for k, text in enumerate(texts):
        assert found[k] == plain_words(text)


def test_model_against_plain_counts(table):
    df, rows = table
    model = language_id.fitted(df)
    known = [r for r in rows if r[0] is not None and r[2] and crc32(str(r[0]).encode()) % 5]
    assert model.langs == sorted({r[2] for r in known})
    grams, letters = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, *_ in known:
        for _, _, script, word in plain_words(text):
            letters[lang][script] += len(word)
            marked = "\x00" + word + "\x00"
            for n in language_id.ORDERS:
                for at in range(len(marked) - n + 1):
                    grams[lang][marked[at : at + n]] += 1

    def slot(gram: str) -> int:
        mixed = len(gram)
        for char in gram:
            mixed = ((mixed ^ ord(char)) * 0x9E3779B1) % (1 << 32)
            mixed ^= mixed >> 15
        return mixed >> (32 - language_id.BITS)

    slots = {lang: Counter() for lang in model.langs}
    for lang in model.langs:
        for gram, n in grams[lang].items():
            slots[lang][slot(gram)] += n
    texts = [t or "" for _, t, *_ in rows]
    words = language_id.words_of(texts)
    scores = model.words(words)
    k = 0
    for text in texts:
        for _, _, script, word in plain_words(text):
            marked = "\x00" + word + "\x00"
            own = [c for c in model.langs if letters[c][script] >= max(0.01 * letters[c].total(), 1)]
            for place, lang in enumerate(model.langs):
                total = 0
                for n in language_id.ORDERS:
                    for at in range(len(marked) - n + 1):
                        held = slots[lang][slot(marked[at : at + n])] + language_id.SMOOTHING
                        room = slots[lang].total() + language_id.SMOOTHING * (1 << language_id.BITS)
                        total += round(math.log(held / room) * language_id.UNIT / 3)
                if own and lang not in own:
                    total = language_id.NEVER
                assert scores[k, place] == (total if own else 0)
            k += 1
    assert k == len(scores)


def test_viterbi_against_every_path():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 5, 6, 0, 4, 6, 2]
    scores = rng.integers(-9, 0, (sum(sizes), 3))
    first = np.concatenate([[0], np.cumsum(sizes)])
    for switch in (0, 4, 9, 100):
        label = language_id.viterbi(scores, first, switch)
        for a, b in itertools.pairwise(first):
            def worth(path, a=a):
                return sum(scores[a + k, x] for k, x in enumerate(path)) - switch * sum(
                    x != y for x, y in itertools.pairwise(path)
                )
            paths = itertools.product(range(3), repeat=b - a)
            assert worth(tuple(label[a:b])) == max(map(worth, paths))


def test_predictions_spans_and_odd_texts(spark, table):
    df, rows = table
    found = language_id.predicted(df)
    assert found.dtypes == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")
    ]
    lines = found.collect()
    assert Counter(r.doc_id for r in lines) == Counter(r[0] for r in rows)
    by_id = defaultdict(list)
    for r in lines:
        by_id[r.doc_id].append(r)
    for doc_id, text, lang, *_ in rows:
        for r in by_id[doc_id]:
            assert r.held_out == (doc_id is not None and crc32(str(doc_id).encode()) % 5 == 0)
            assert 0 <= r.score <= 1
            if text is None or not any(map(str.isalpha, text)):
                assert (r.lang_pred, r.score) == ("und", 0)
            else:
                assert r.lang_pred in SENTENCES
    model = language_id.fitted(df)
    parts = [("de", SENTENCES["de"]), ("ru", SENTENCES["ru"]), ("en", SENTENCES["en"]), ("el", "γάτα")]
    mixed = "… " + ". ".join(t for _, t in parts) + "!"
    more = spark.createDataFrame([(1, mixed, "x"), (2, None, "y")], "lang int, body string, spans string")
    spans = {r.lang: r.spans for r in language_id.with_spans(more, model, "body").collect()}
    assert spans[2] == []
    assert [(s.lang, mixed[s.start : s.end]) for s in spans[1]] == parts


def test_nothing_learned_and_nothing_asked(spark, table):
    df, _ = table
    unknown = language_id.predicted(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}
    assert language_id.predicted(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_long_texts_are_labelled_whole(table):
    model = language_id.fitted(table[0])
    text = " ".join([SENTENCES["en"]] * 2_000 + [SENTENCES["de"]] * 2_000)
    words = language_id.words_of([text, "", "der hund"])
    first = np.searchsorted(words.text, np.arange(4))
    label = language_id.viterbi(model.words(words), first, 12_000)
    langs = [model.langs[k] for k, _ in itertools.groupby(label[: first[1]])]
    assert langs == ["en", "de"] and model.langs[label[-1]] == "de"


def test_held_out_accuracy_and_sight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    found = language_id.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    aside = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in aside) >= 0.97 * len(aside) > 150
    # Labels of the held-out fold change nothing.
    spoiled = docs.withColumn(
        "lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    )
    again = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predicted(spoiled).collect()}
    assert again == {(r.doc_id, r.lang_pred, r.score) for r in found}
