"""Substring dedup, fingerprints and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import fingerprints, ngramjoin, substrings

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeated_documents():
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["ä", "b", "cc", "dd,"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "  "), (103, "b " * 200), (7, docs[7][1]), (104, "\n\tb\x0bb\x0c" + docs[3][1] + " \r"),
                   (None, docs[9][1])]


@pytest.mark.parametrize("window, groups, size", [(3, 1, 100), (3, 7, 500), (5, 50, 1 << 20), (8, 3, 200)])
def test_drop_repeats(spark, window, groups, size):
    docs = repeated_documents()
    seen = Counter(tuple(words(t)[k:k + window]) for _, t in docs for k in range(len(words(t)) - window + 1))
    want = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, block string")
    got = substrings.drop_repeats(df, window, groups, size).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(want, key=str)
    assert all(sum(s["end"] - s["first"] for s in r.removed) == r.n_removed for r in got)


def test_drop_repeats_of_odd_documents(odd, empty):
    got = substrings.drop_repeats(odd, 5).collect()
    assert sorted(r.n_words for r in got) == sorted(len(words(t)) for _, t, *_ in ROWS)
    assert all(r.kept == "" for r in got if r.doc_id == 1)  # a repeated row repeats all its windows
    assert substrings.drop_repeats(empty).count() == 0


def test_prefixes_grow_where_suffixes_crowd():
    # one word starts nearly every suffix: its prefix must be longer than the others
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    hashes[::2] = hashes[0]
    starts = np.arange(3900)
    made = substrings.Prefixes.chosen(hashes, starts, 35, 16)
    assert len(made.tables) > 1
    sizes = np.bincount(made.of(hashes, starts), minlength=16)
    assert sizes.max() < 4 * sizes.mean()


def test_fingerprints(spark, odd, empty):
    docs = odd.select("doc_id", "text").dropDuplicates().where("doc_id IS NULL OR doc_id <> 7")
    got = {r.doc_id: r for r in fingerprints.digests(docs).collect()}
    texts = {i: t or "" for i, t, *_ in ROWS if i != 7}
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[2].fingerprint == got[3].fingerprint == "" and got[2].near_edited == 1.0
    assert fingerprints.digests(empty).count() == 0
    assert fingerprints.digests(odd).count() == len(ROWS)


def test_the_next_row_whatever_the_ranges(spark):
    rng = random.Random(8)
    ids = [5] * 60 + [None] * 60 + [rng.randint(-9, 9) for _ in range(60)] + [2**63 - 1, -2**63]
    rows = spark.createDataFrame([(i, f"text {k % 150}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(3)
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
    order = sorted(keyed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.tie))
    want = sorted((str(r.doc_id), r.text, order[(k + 1) % len(order)].text) for k, r in enumerate(order))
    for n in (1, 2, 7, 500):
        out = fingerprints.with_next(rows, ["text"], n)
        assert sorted((str(r.doc_id), r.text, r.next_text) for r in out.collect()) == want, n
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert fingerprints.with_next(one, ["text"], 4).collect() == [(1, "a", "a")]


def test_rows_of_one_id_lie_in_several_ranges(spark):
    rows = spark.range(1000).select(F.struct(F.lit(True).alias("none"), F.lit(0).alias("id"), F.xxhash64("id").alias("tie")).alias("key"))
    found = fingerprints.ranges(rows, 10).first().ranges
    assert [p[0] for p in found.cuts] == found.tops
    assert len({k for p in found.cuts for k in p}) == sum(map(len, found.cuts)) == 10


def test_equal_texts_have_equal_fingerprints_and_likeness_is_a_share(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 20) for _ in range(rng.randint(0, 80))) for _ in range(40)]
    rows = spark.createDataFrame([(k, texts[k % 25]) for k in range(60)], "doc_id long, text string")
    by = defaultdict(set)
    for r in fingerprints.digests(rows).collect():
        by[texts[r.doc_id % 25]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = ({x.split(":")[0] for x in f.split(",") if x} for f in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
    assert all(len(f) == 1 for f in by.values())


def test_winnowing_guarantee_and_rightmost_ties(spark):
    shared = " ".join(f"w{k}" for k in range(fingerprints.WINDOW + fingerprints.GRAM - 1))
    rows = spark.createDataFrame([(0, "x y z " + shared + " tail"), (1, "other words here " * 3 + shared), (2, "same " * 40)], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(rows).collect()}
    chosen = [{x >> fingerprints.PLACE_BITS for x in got[k].fp} for k in (0, 1)]
    assert chosen[0] & chosen[1]
    places = [fingerprints.PLACES - (x & fingerprints.PLACES) for x in got[2].fp]
    assert places == list(range(fingerprints.WINDOW - 1, 40 - fingerprints.GRAM + 1))  # all hashes tie: the last of each window


def test_units_are_words_and_every_place_of_longer_runs(spark):
    n = fingerprints.UNIT
    texts = ["", " \n", "one two", "x" * n, "abcdefghi " + "é" * 7, "\tabcdefghijkl\x0b12345678\x0cz ",
             "".join(map(chr, range(0x1F600, 0x1F614))) + " a\u3000b", "".join(map(chr, range(0x4E00, 0x4E40)))]
    want = [[w[k:k + n] for w in words(t) for k in range(max(1, len(w) - n + 1))] for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows.select("doc_id", fingerprints.units("text").alias("u")).collect()
    assert [r.u for r in sorted(got)] == want


def test_texts_without_white_space_are_alike_at_every_offset(spark):
    rng = random.Random(4)
    letters = [chr(k) for k in [*range(0x4E00, 0x5E00), *range(0x20000, 0x20400)]]
    some = lambda k: "".join(rng.choice(letters) for _ in range(k))
    text, passage = some(400), some(fingerprints.UNIT + fingerprints.WINDOW + fingerprints.GRAM - 2)
    moved = [(k, some(k) + text) for k in range(10)]
    holding = [(100 + k, some(50 + k) + passage + some(30)) for k in range(10)]
    rows = spark.createDataFrame(moved + holding, "doc_id long, text string")
    got = {r.doc_id: {x >> fingerprints.PLACE_BITS for x in r.fp} for r in fingerprints.fingerprints(rows).collect()}
    for k in range(1, 10):
        assert len(got[0] & got[k]) / len(got[0] | got[k]) > 0.9
        assert got[100] & got[100 + k]  # the shared passage is as short as the guarantee allows


def brute(docs):
    """(doc_id, class_id, n_links) by comparing every two documents."""
    sets = []
    for _, t in docs:
        w = words(t)
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links, parent = Counter(), list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                parent[max(top(a), top(b))] = min(top(a), top(b))
    names = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        names[top(k)].append(float("inf") if i is None else i)
    name = {k: None if min(v) == float("inf") else min(v) for k, v in names.items()}
    return [(i, name[top(k)], links[k]) for k, (i, _) in enumerate(docs)]


def copies(seed, groups=12, most=30):
    rng, docs = random.Random(seed), []
    for _ in range(groups):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, most)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"u{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_join(spark, seed):
    docs = copies(seed) + [(i, t) for i, t, *_ in ROWS if i not in (1, 6)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, class_id int")
    got = ngramjoin.join(df).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs), key=str)


def test_join_cuts_large_nodes(spark, monkeypatch):
    # so small that nodes are split further, and cut into parts at the deepest
    for name, value in (("SMALL", 6), ("DEEPEST", 4)):
        monkeypatch.setattr(ngramjoin, name, value)
    docs = copies(3, groups=3, most=40) + [(1000 + k, "one text that very many documents hold word for word") for k in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ngramjoin.join(df).select("doc_id", "class_id", "n_links").collect()
    want = sorted(brute(docs))
    same = sum(g[1] == w[1] for g, w in zip(sorted(map(tuple, got)), want))
    found, there = sum(r.n_links for r in got), sum(w[2] for w in want)
    assert same == len(docs) and there * 0.99 <= found <= there


def test_one_of_each(spark, odd, empty):
    kept = ngramjoin.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id), key=str) == sorted({(i, t) for i, t, *_ in ROWS if i}, key=str)
    assert ngramjoin.one_of_each(empty).count() == 0
    docs = copies(4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in ngramjoin.one_of_each(df).collect()} == {c for _, c, _ in brute(docs)}


def test_components(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(1000, 1100)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    parent = {}

    def top(k):
        parent.setdefault(k, k)
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r.rep: r.root for r in ngramjoin.components(spark.createDataFrame(edges, "rep long, root long")).collect()}
    assert got == {k: top(k) for k in parent if top(k) != k}


def structured(letters: int) -> tuple[str, str]:
    """Words that a polynomial modulo a power of two cannot tell apart: Thue and Morse's, and its complement."""
    bits = [bin(k).count("1") % 2 for k in range(letters)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_structured_words_are_told_apart(spark):
    """Texts that differ in one such word, or in the order of two words, share no passage across it."""
    one, other = structured(4096)
    rest = [f"w{k}" for k in range(70)]
    rows = [(1, " ".join([*rest[:17], one, *rest[17:34]])), (2, " ".join([*rest[:17], other, *rest[17:34]])),
            (3, " ".join("pq"[bin(k).count("1") % 2] for k in range(4096))), (4, " ".join("qp"[bin(k).count("1") % 2] for k in range(35)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substrings.drop_repeats(df, 35).collect()}
    assert got[1] == got[2] == 0
    words = [w.split(" ") for _, w in rows]
    passages = Counter(tuple(w[k:k + 35]) for w in words for k in range(len(w) - 34))
    covered = [sum(any(passages[tuple(w[s:s + 35])] > 1 for s in range(max(0, p - 34), min(p, len(w) - 35) + 1)) for p in range(len(w))) for w in words]
    assert [got[k] for k in (1, 2, 3, 4)] == covered
    nine = [(1, " ".join([*rest[:4], one, *rest[4:8]])), (2, " ".join([*rest[:4], other, *rest[4:8]]))]
    joined = ngramjoin.join(spark.createDataFrame(nine, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in joined)


def test_random_structured_passages_hash_apart():
    """Sequences of two word values in every order have as many hashes as there are sequences."""
    values = np.array([3, 1 << 40], np.uint64)
    words = np.concatenate([values[[n >> k & 1 for k in range(16)]] for n in range(1 << 16)])
    starts = np.arange(1 << 16) * 16
    assert len(np.unique(substrings.spans_hashed(words, substrings.WORD_BASE, starts, starts + 16))) == 1 << 16
