"""The pipeline's stages, and the registered queries against SQL where there is any."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from fieldbook.llm import langid, queries
from fieldbook.llm.common import documents, written
from tests.oracle_check import compare

from .test_repeats import brute

SF0001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    found = compare(spark, SF0001, name, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert found["ok"], found


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "secret_scans", "mixing", "byte_bpe"]


def test_stages(spark):
    docs = documents(spark, SF0001)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = before, docs = docs, written(stage(spark, docs, SF0001), name)
        if name != "byte_bpe":
            assert docs.columns == before.columns
    before, after = out["language_id"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if any(c.isalpha() for c in r.text or "")}
    before, after = out["ngram_jaccard_join"]
    classes = {c for _, c, _ in brute([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in after.collect()) == sorted(classes)
    before, after = out["secret_scans"]
    old, new = ({r.doc_id: r for r in d.collect()} for d in out["secret_scans"])
    assert old.keys() == new.keys()
    for i, r in new.items():
        assert r.n_chars == len(r.text)
        parts = re.split("<SECRET>", r.text)
        assert re.fullmatch(".+?".join(map(re.escape, parts)), old[i].text, re.S)  # nothing else is changed
    before, after = out["mixing"]
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}
    before, after = out["byte_bpe"]
    assert after.count() == before.count()


def test_the_score_decides_what_language_id_keeps(spark, monkeypatch):
    weights = np.zeros((langid.DIMENSIONS, 2))
    weights[langid.slots("house"), 0] = 20.0
    model = langid.Model(["en", "fr"], np.ones(langid.DIMENSIONS), weights, np.zeros(2), 1.0)
    monkeypatch.setattr(langid, "train", lambda docs: model)
    rows = [(1, "A house!"), (2, "x 77 @@"), (3, "qq zz"), (4, "12 34"), (5, None), (6, "house")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.score for r in langid.predict(docs, model).collect()}[2] == 0.5  # chance
    kept = queries.keep_known_languages(spark, docs, SF0001)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 6]


@pytest.mark.parametrize("lang", ["CAST(NULL AS STRING)", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 'en', NULL)"])
def test_language_id_keeps_what_has_letters_where_nothing_is_learnt(spark, lang):
    rows = [(k, f"clean text number {k}") for k in range(20)] + [(30, None), (31, "12 -"), (None, "é"), (32, "漢")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", f"{lang} AS lang")
    kept = queries.keep_known_languages(spark, docs, SF0001).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        (tuple(r) for r in docs.collect() if any(c.isalpha() for c in r.text or "")), key=str)


def test_run_is_the_stages(spark):
    a = sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect()))
    assert a and a == sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect()))
