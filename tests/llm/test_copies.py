"""Exact, near and partial copies against brute force."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS, prose
from tillstar.llm import exact_dedup, jaccard_join, line_dedup, suffix_dedup
from tillstar.llm.common import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        own = groups[t.translate(LOWER)]
        mark = sha256(t.translate(LOWER).encode()).hexdigest()
        out.append((i, max(own), len(own), i == max(own), mark))
    return sorted(out)


def test_exact_duplicates(documents):
    found = exact_dedup.exact_duplicates(documents)
    got = found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == brute_exact(pairs(documents))


def test_chunks_tile_the_text_and_follow_content():
    rng = random.Random(2)
    text = prose(rng, 9_000).encode()
    data = np.frombuffer(text, np.uint8)
    parts = exact_dedup.chunks(text, exact_dedup.cuts(data).tolist())
    assert b"".join(parts) == text and len(parts) > 10
    shifted = b"new words " + text
    again = exact_dedup.chunks(shifted, exact_dedup.cuts(np.frombuffer(shifted, np.uint8)).tolist())
    assert parts[1:] == again[-len(parts) + 1 :]
    assert max(map(len, exact_dedup.chunks(b"z" * 50_000, []))) == exact_dedup.MAX_CHUNK


def test_exact_duplicates_with_clashing_identifiers(documents, monkeypatch):
    class Weak:
        @staticmethod
        def xxh64_intdigest(part, seed):
            return (1 << 63) + seed % 3

    monkeypatch.setattr(exact_dedup, "xxhash", Weak)
    test_exact_duplicates(documents)


def brute_near(rows, percent=75):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * len(sets[a] | sets[b]):
                label = [label[a] if x == label[b] else x for x in label]
    least = defaultdict(lambda: 1 << 60)
    for (i, _), x in zip(rows, label, strict=True):
        least[x] = min(least[x], i)
    return sorted((i, len(s), least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize("piece_tokens", [jaccard_join.PIECE_TOKENS, 150])
def test_near_duplicates(documents, piece_tokens):
    found = jaccard_join.near_duplicates(documents, piece_tokens=piece_tokens)
    got = found.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_near(pairs(documents))


@pytest.mark.parametrize("piece_tokens", [jaccard_join.PIECE_TOKENS, 150])
def test_near_copies_without_or_with_repeated_ids(spark, piece_tokens):
    rng = random.Random(17)
    texts = [prose(rng, 80) for _ in range(4)]
    near = [t + " tail" for t in texts]
    rows = [(None, texts[0]), (7, near[0]), (None, texts[1]), (None, near[1]), (None, texts[2])]
    rows += [(5, texts[3]), (5, prose(rng, 80)), (3, near[3]), (9, texts[2]), (5, near[1] + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicates(df, piece_tokens=piece_tokens).collect()
    expected = [(-1, 7), (7, 7), (-1, 5), (-1, 5), (-1, 9), (5, 3), (5, 5), (3, 3), (9, 9), (5, 5)]
    none = [(r.doc_id, r.component_id) for r in got]
    assert sorted((-1 if a is None else a, -1 if b is None else b) for a, b in none) == sorted(expected)
    alone = jaccard_join.near_duplicates(df.filter("doc_id is null")).collect()
    assert len(alone) == 4 and {r.component_id for r in alone} == {None}


def test_search_sets_long_lists_aside_without_losing_links():
    rng = np.random.default_rng(4)
    base = np.arange(100, 200, dtype=np.uint64)
    sets = [base[rng.random(100) < 0.9] for _ in range(40)]
    sets += [np.unique(rng.integers(100, 400, 80).astype(np.uint64)) for _ in range(40)]
    search = jaccard_join.Search(sets, 75)
    for q, own in enumerate(sets):
        expected = [
            k
            for k, s in enumerate(sets)
            if 100 * len(np.intersect1d(own, s)) >= 75 * len(np.union1d(own, s))
        ]
        assert search.links(q).tolist() == expected


def test_roots_keep_links_between_components_that_were_largest_in_turn():
    # Windows of 100 link up to a distance of 14: the first finds two others, the fourth three;
    # only the link of the second and the fifth (110 and 124) joins them.
    sets = [np.arange(p, p + 100, dtype=np.uint64) for p in (100, 110, 95, 134, 124, 136, 138)]
    assert len(set(jaccard_join.roots(sets, 75).tolist())) == 1


def test_roots_on_random_chains():
    rng = np.random.default_rng(9)
    for _ in range(300):
        sets = []
        for _ in range(3):
            own = rng.integers(0, 400, 60)
            for _ in range(int(rng.integers(2, 7))):
                sets.append(np.unique(own).astype(np.uint64))
                own = np.where(rng.random(60) < 0.12, rng.integers(0, 400, 60), own)
        sets = [sets[k] for k in rng.permutation(len(sets))]
        label = np.arange(len(sets))
        search = jaccard_join.Search(sets, 75)
        for own in [search.links(q) for q in range(len(sets))] * len(sets):
            label[np.isin(label, label[own])] = label[own].min()
        found = jaccard_join.roots(sets, 75)
        for a in range(len(sets)):
            assert (found[a] == found).tolist() == (label[a] == label).tolist()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(k, k + 1) for k in range(1000, 1060)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    expected = {n: x for n, x in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == expected and len(got) == len(expected)


def brute_bytes(rows, length):
    texts = [t.encode() for _, t in rows]
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("key_contexts", [suffix_dedup.KEY_CONTEXTS, 1])
def test_repeated_bytes(documents, key_contexts):
    found = suffix_dedup.repeated_bytes_removed(documents, key_contexts=key_contexts)
    got = sorted(map(tuple, found.drop("kept").collect()))
    assert got == brute_bytes(pairs(documents), 200)


def test_suffix_ranks_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        n, kinds = rng.randint(1, 60), rng.choice([1, 2, 3, 9])
        text = np.array([rng.randrange(kinds) for _ in range(n)], np.int64)
        order = sorted(range(n), key=lambda k: text[k:].tolist())
        ranks = suffix_dedup.suffix_ranks(text)
        assert ranks[order].tolist() == list(range(n))
        shared = suffix_dedup.permuted_common_prefixes(text, ranks)
        for a, b in zip(order, order[1:], strict=False):
            same = 0
            while max(a, b) + same < n and text[a + same] == text[b + same]:
                same += 1
            assert shared[b] == same


def brute_lines(rows, window=line_dedup.WINDOW, gram=line_dedup.GRAM):
    """(id, what stays, words that went) of every row, from windows of words one by one."""
    parts = {(i, t): re.findall(r"(?:^[ \n\r\t]+)?[^ \n\r\t]+[ \n\r\t]*", t) for i, t in rows}
    first: dict = {}
    places = set()
    for (i, t), p in parts.items():
        words = [x.strip(" \n\r\t") for x in p]
        marks = [crc32(x.encode()) for x in words]
        windows = [range(s, s + window) for s in range(len(words) - window + 1)]
        ends = {0, len(words) - gram} if len(words) >= gram else set()
        for k in ends | {min(s, key=lambda n: (marks[n], n)) for s in windows}:
            if k + gram <= len(words):
                key = tuple(words[k : k + gram])
                places.add((i, t, k, key))
                first[key] = min(first.get(key, (i, k)), (i, k))
    gone = defaultdict(set)
    for i, t, k, key in places:
        if first[key] < (i, k):
            gone[i, t] |= set(range(k, k + gram))
    out = []
    for i, t in rows:
        own = gone[i, t]
        kept = "".join(x for k, x in enumerate(parts[i, t]) if k not in own) if own else t
        out.append((i, kept, len(own)))
    return sorted(out)


def test_shifted_and_changed_copies_of_passages(spark):
    """Passages at every offset in a line, broken into other lines, or with a word put in."""
    rng = random.Random(31)
    passages = [prose(rng, 56, 11).split() for _ in range(12)]
    rows = [(k, " ".join(p)) for k, p in enumerate(passages)]
    for k, p in enumerate(passages):
        before, after = prose(rng, rng.randint(0, 25), 99), prose(rng, rng.randint(0, 25), 99)
        rows.append((100 + k, f"{before} {' '.join(p)} {after}"))
        lines = "\r\n".join(" ".join(p[n : n + k + 1]) for n in range(0, len(p), k + 1))
        rows.append((200 + k, f"  {before}\n{lines}\t{after}\n"))
        half = len(p) // 2
        changed = [*p, *p][half:half + 40] if k % 2 else [*p[:half], "new", *p[half:], *p[:half]]
        rows.append((300 + k, f"{before} {' '.join(changed)}"))
    clean = [(400 + k, prose(rng, 200)) for k in range(15)]
    df = spark.createDataFrame(rows + clean, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in line_dedup.without_repeated_runs(df).collect()}
    assert sorted((r.doc_id, r.text, r.n_removed) for r in found.values()) == brute_lines(rows + clean)
    texts = dict(rows + clean)
    shortest = 56 - 2 * (line_dedup.WINDOW - 1)
    for k in range(12):
        assert found[k].n_removed == 0
        assert all(found[k + n].n_removed >= shortest for n in (100, 200))
    assert all(found[i].text == texts[i] for i, _ in clean)


def test_passages_of_over_fifty_words_never_stay_whole(spark):
    """Later copies of 51 words or more, found word by word, in the given documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(pairs(docs))
    kept = {r.doc_id: (r.text or "").split() for r in line_dedup.without_repeated_runs(docs).collect()}
    first: dict = {}
    later = []
    for i, t in rows:
        words = t.split()
        end = 0
        for s in range(len(words) - 50):
            place = first.setdefault(tuple(words[s : s + 51]), (i, s))
            if place < (i, s) and s >= end:
                later.append((i, words[s : s + 51]))
                end = s + 51
    assert len(later) > 150
    for i, words in later:
        left = " ".join(kept[i])
        assert " ".join(words) not in left


def test_line_runs(documents):
    found = line_dedup.without_repeated_runs(documents)
    got = [(r.doc_id, r.text or "", r.n_removed) for r in found.collect()]
    assert sorted(got) == brute_lines(pairs(documents))
    assert found.columns == [*documents.columns, "n_removed"]
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    odd = documents.withColumns({c: F.lit(c) for c in ("__id", "__tag", "__STARTS", "id", "starts")})
    again = line_dedup.without_repeated_runs(odd)
    assert again.columns == [*odd.columns, "n_removed"]
    assert sorted((r.doc_id, r.text or "", r.n_removed) for r in again.collect()) == sorted(got)
    with pytest.raises(ValueError, match="gaps"):
        line_dedup.without_repeated_runs(documents, window=9, gram=8)


def test_line_shuffles_leave_the_disk(spark, documents):
    """Only the texts and the starts of their copies are still to be shuffled, by the result."""
    documents.count()
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllBlocks().mkString(" ").split()
        return {x for x in names if x.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = spark.conf.get(setting), shuffled()
    found = line_dedup.without_repeated_runs(documents)
    end = time.monotonic() + 5
    while shuffled() - own and time.monotonic() < end:  # files are removed in the background
        time.sleep(0.1)
    assert not shuffled() - own
    assert spark.conf.get(setting) == before
    got = sorted((r.doc_id, r.text or "", r.n_removed) for r in found.collect())
    assert got == brute_lines(pairs(documents))
    assert shuffled() - own


def test_long_text_and_odd_columns(spark):
    rng = random.Random(9)
    long = prose(rng, 40_000)
    rows = [(1, long, "x"), (2, long, "y"), (None, "no id here", "z"), (None, None, None)]
    names = "doc_id long, text string, n_removed string"
    df = spark.createDataFrame(rows, names).withColumn("node", F.lit(1)).withColumn("tag", F.lit("t"))
    exact = {r.doc_id: r for r in exact_dedup.exact_duplicates(df).filter("doc_id > 0").collect()}
    assert exact[1].keep_id == 2 and exact[1].n_chunks > 50
    near = jaccard_join.near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in near) == [(0, 0), (0, 0), (1, 1), (2, 1)]
    cut = suffix_dedup.repeated_bytes_removed(df).collect()
    assert sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in cut) == [(0, 0), (0, 10), (1, 0), (2, 0)]
    kept = line_dedup.without_repeated_runs(df).collect()
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept) == [(0, 0), (0, 10), (1, len(long)), (2, 0)]


def test_empty_tables(no_documents):
    for found in (
        exact_dedup.exact_duplicates(no_documents),
        jaccard_join.near_duplicates(no_documents),
        suffix_dedup.repeated_bytes_removed(no_documents),
        line_dedup.without_repeated_runs(no_documents),
    ):
        assert found.count() == 0
    assert no_documents.schema == DOCUMENTS
