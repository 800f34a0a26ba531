"""Plain loops beside the operators that SQL cannot express, the pipeline on odd documents, and texts of megabytes."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from fieldbook.llm import fingerprints, langid, linededup, ngramjoin, secretscan, substrings, tokencount
from fieldbook.llm.common import written

from .conftest import ROWS
from .test_repeats import words

SF0001 = "/root/testdata/sf0.001"


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hashed(values, seed: int = 42) -> int:
    """Spark's xxhash64 of strings and longs in turn."""
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed=seed & (1 << 64) - 1)
    return signed(seed)


def winnowed(text: str) -> set[tuple[int, int]]:
    """(upper bits of the hash, place) of the least gram of every window, the rightmost of equals."""
    n, gram, window, low = fingerprints.UNIT, fingerprints.GRAM, fingerprints.WINDOW, fingerprints.PLACE_BITS
    units = [w[k:k + n] for w in words(text) for k in range(max(1, len(w) - n + 1))]
    level = [hashed([u]) for u in units]
    if not units:
        return set()
    if len(units) < gram:
        grams = [hashed(level)]
    else:
        apart = 1
        while apart < gram:
            level = [hashed([level[k], level[k + apart]]) for k in range(len(level) - apart)]
            apart *= 2
        grams = level
    grams = [g >> low for g in grams]
    windows = [range(k, k + window) for k in range(len(grams) - window + 1)] or [range(len(grams))]
    return {min(((grams[k], -k) for k in w)) for w in windows}


def test_winnowing_against_a_plain_loop(spark):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["", "one", "one two three", "a a a a a a a a a a a a a a a", "x" * 50, "語" * 30 + " b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    low, top = fingerprints.PLACE_BITS, fingerprints.PLACES
    for r in fingerprints.fingerprints(df).collect():
        got = {(x >> low, -(top - (x & top))) for x in r.fp}
        assert got == winnowed(texts[r.doc_id])


def plain_ftrl(rows, k):
    """Proximal follow-the-regularised-leader, one weight at a time."""
    z, n = {}, {}

    def weight(i, j):
        zij = z.get((i, j), 0.0)
        if abs(zij) <= langid.L1:
            return 0.0
        return -(zij - math.copysign(langid.L1, zij)) / ((langid.BETA + math.sqrt(n.get((i, j), 0.0))) / langid.ALPHA + langid.L2)

    for turn in range(langid.PASSES):
        for at in np.random.default_rng(turn).permutation(len(rows)):
            slots, x, y = rows[at]
            active = [*zip(slots.tolist(), x.tolist()), (langid.DIMENSIONS, 0.1)]
            scores = [sum(v * weight(i, j) for i, v in active) for j in range(k)]
            top = max(scores)
            e = [math.exp(s - top) for s in scores]
            for j in range(k):
                wrong = e[j] / sum(e) - (j == y)
                for i, v in active:
                    g, w, old = v * wrong, weight(i, j), n.get((i, j), 0.0)
                    z[i, j] = z.get((i, j), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / langid.ALPHA * w
                    n[i, j] = old + g * g
    return {key: weight(*key) for key in z}


def test_training_against_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        slots = np.sort(rng.choice(60, 12, replace=False))
        x = rng.random(12)
        rows.append((slots, x / x.sum(), int(slots[0] % 3)))
    weights, bias = langid.fit(rows, 3)
    plain = plain_ftrl(rows, 3)
    for (i, j), w in plain.items():
        got = weights[i, j] if i < langid.DIMENSIONS else bias[j] / 0.1
        assert got == pytest.approx(w, abs=1e-9)
    assert np.count_nonzero(weights) == sum(w != 0 for (i, _), w in plain.items() if i < langid.DIMENSIONS)


def test_idf_against_a_plain_count(spark):
    texts = ["one two", "two three", "", None, "!!", "One two"]
    n, df = langid.document_frequency(spark.createDataFrame([(t,) for t in texts], "text string"))
    seen = [set(langid.slots(t or "").tolist()) for t in texts]
    assert n == sum(bool(s) for s in seen)
    assert {i: int(df[i]) for i in np.flatnonzero(df)} == {i: sum(i in s for s in seen) for i in set().union(*seen)}


def test_owned_spans_against_a_plain_scan():
    rng = random.Random(8)
    for _ in range(300):
        text = " ".join(rng.choice(["plain", "AKIA" + "Q7" * 9, "q7Rt2Lp9Xv4Bn8Zk3Wd6", "token=" + "aB3" * 9, "deadbeef" * 4, "x" * 30, "é"]) for _ in range(8))
        base = secretscan.base_spans(text)
        letters = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
        runs, at = [], 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] in letters:
                end += 1
            if end - at >= secretscan.OWNED_CHARS:
                runs.append((at, end))
            at = max(end, at + 1)
        want = [(a, b) for a, b in runs if secretscan.mixed(text[a:b]) and not any(s < b and a < e for s, _, e, _ in base)]
        assert [(s, e) for s, _, e, _ in secretscan.owned_spans(text, base)] == want


def test_the_pipeline_on_odd_and_empty_documents(spark, odd, empty):
    for docs in (odd, empty):
        sizes = [docs.count()]
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, written(stage(spark, docs, SF0001), name)
            sizes.append(docs.count())
            if name != "byte_bpe":
                assert docs.columns == before.columns
        assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    assert sizes == [0] * 6
    with_letters = [r for r in ROWS if any(c.isalpha() for c in r[1] or "")]
    kept = corpus_pipeline.STAGES[0][1](spark, odd, SF0001)
    assert kept.count() == len(with_letters)


def test_language_id_of_an_empty_table(spark, empty):
    assert corpus_pipeline.STAGES[0][1](spark, empty, SF0001).count() == 0


def test_texts_of_megabytes(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(400_000))  # some 2.3 MB
    joined = "".join(rng.choice("abcdefghij") for _ in range(1_000_000))
    df = spark.createDataFrame([(1, long, "a", "en"), (2, "x " + long, "b", "en"), (3, joined, "c", "de"), (4, "few words", "a", "de")],
                               "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in substrings.drop_repeats(df, 35).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed) == (400_000, 400_000, 0) and got[2].kept == "x"
    prints = {r.doc_id: {x >> fingerprints.PLACE_BITS for x in r.fp} for r in fingerprints.fingerprints(df).collect()}
    assert len(prints[1] & prints[2]) / len(prints[1] | prints[2]) > 0.99 and len(prints[3]) > 100_000
    classes = {r.doc_id: r.class_id for r in ngramjoin.join(df).collect()}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 4}
    model = langid.train(df)
    assert {r.doc_id for r in langid.predict(df, model).collect() if r.lang_pred != "und"} == {1, 2, 3, 4}
    assert {r.doc_id: r.n_dropped for r in linededup.drop_lines(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    import public_tokenizers

    counts = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"), 1024).collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert counts[3] == len(library.encode(joined).ids) and counts[1] == len(library.encode(long).ids)
