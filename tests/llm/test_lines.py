"""Line dedup: against a plain loop, and that insertions and deletions come to the same as a fresh start."""

from __future__ import annotations

import numpy as np
import pytest

from fieldbook.llm import linededup as ld

WS = " \t\n\x0b\x0c\r"
KIND = "doc_id bigint, text string"


def key_of(line: str) -> str | None:
    key = line.strip(WS)
    key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)
    return key if len(key) >= 10 else None


def brute(rows: list[tuple]) -> list[tuple]:
    """(id, lines, dropped, kept) by the rule, ids compared with None last."""
    last = lambda i: (i is None, i or 0)
    holders: dict[str, set] = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if key_of(line):
                holders.setdefault(key_of(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key_of(x) or min(holders[key_of(x)], key=last) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


def some_rows(seed: int, n: int, ids=None) -> list[tuple]:
    rng = np.random.default_rng(seed)
    pool = [f"Line number {k} of all" for k in range(40)] + ["short", "", "  Line NUMBER 3 of all\t", "ÄÖÜ äöü ÄÖÜ", "äöü äöü", "\r"]
    made = []
    for k in ids if ids is not None else range(n):
        text = "\n".join(pool[x] for x in rng.integers(0, len(pool), rng.integers(0, 9)))
        made.append((int(k), text + f"\nonly here {k} {seed}" if rng.random() < 0.5 else text))
    return made


def test_against_a_plain_loop(spark):
    rows = some_rows(1, 60) + [(3, "Line number 1 of all\nline NUMBER 1 of all  "), (3, None), (None, "Line number 2 of all"),
                               (None, "nobody else has this"), (-5, "Line number 7 of all\n\nLine number 7 of all")]
    rows += rows[-2:]  # repeated rows
    docs = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS k1", "'x' AS doc", "2 AS n", "'y' AS kept", "3 AS h")
    out = ld.drop_lines(docs)
    assert result(out) == brute(rows)
    for r in out.collect():
        assert r.n_dropped == len(r.dropped)


def test_odd_documents(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(ld.drop_lines(odd)) == brute(rows)
    assert ld.drop_lines(empty).count() == 0


def test_long_texts(spark):
    """Megabytes in one line, and hundreds of thousands of lines in one document."""
    line = "ab" * 1_500_000
    many = "\n".join(f"number {k % 70_000} in the list" for k in range(200_000))
    rows = [(1, line), (2, line + "\n" + many), (3, many)]
    assert result(ld.drop_lines(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_text_ids(spark):
    rows = [("b", "the very same line"), ("a", "the very same line"), ("c", "THE VERY SAME LINE")]
    out = ld.drop_lines(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {r.doc_id: r.n_dropped for r in out.collect()} == {"a": 0, "b": 1, "c": 1}


@pytest.mark.parametrize("keys", [1 << 16, 12])
def test_insertions_and_deletions(spark, monkeypatch, keys):
    """After each change the results are those of the documents that are there; shards grow on the way."""
    monkeypatch.setattr(ld, "KEYS", keys)
    first, second = some_rows(2, 25), some_rows(3, 0, range(25, 60)) + [(None, "Line number 4 of all")]
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    index = ld.LineIndex.create(spark).insert(frame(first)).insert(frame(second))
    assert result(index.dedup(frame(first + second))) == brute(first + second)
    gone = {0, 1, 2, 5, 30, 31, 999}
    left = [r for r in first + second if r[0] not in gone]
    index = index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id bigint"))
    assert result(index.dedup(frame(left))) == brute(left)
    index = ld.LineIndex.open(spark, index.path)  # another session goes on
    back = [r for r in first if r[0] in gone]
    index = index.insert(frame(back))
    assert result(index.dedup(frame(left + back))) == brute(left + back)
    # the exact counts, and as many fingerprints as they ask for
    holders: dict[str, set] = {}
    for i, text in left + back:
        for line in text.split("\n"):
            if key_of(line):
                holders.setdefault(key_of(line), set()).add(i)
    counts = index.counts().collect()
    assert sorted(r.n_docs for r in counts) == sorted(map(len, holders.values()))
    filters = {r.shard: ld.Cuckoo.from_bytes(r.buckets, r.data) for r in index._filters().collect()}
    assert sum(int((f.tables > 0).sum()) for f in filters.values()) == sum(min(2, len(x)) for x in holders.values())
    if keys == 12:
        assert index.shards > 1
    for r in counts:
        assert filters[r.k1 % index.shards].count(np.array([r.k2]))[0] >= min(2, r.n_docs)
    index = index.delete(frame(left + back))
    assert index.counts().count() == 0
    assert not any(ld.Cuckoo.from_bytes(r.buckets, r.data).tables.any() for r in index._filters().collect())


def test_an_id_goes_in_once(spark):
    index = ld.LineIndex.create(spark).insert(spark.createDataFrame([(1, "a line of some length")], KIND))
    with pytest.raises(ValueError):
        index.insert(spark.createDataFrame([(1, "another")], KIND))


def test_a_change_that_dies_leaves_the_index_as_it_was(spark, monkeypatch):
    rows = [(1, "a line of some length"), (2, "A line of some length")]
    index = ld.LineIndex.create(spark).insert(spark.createDataFrame(rows, KIND))
    monkeypatch.setattr(ld.LineIndex, "_changed_filters", lambda *x: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.delete(spark.createDataFrame([(1,)], "doc_id bigint"))
    monkeypatch.undo()
    again = ld.LineIndex.open(spark, index.path)
    assert result(again.dedup(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_known_keys_only_are_looked_up(spark):
    """What the filters don't know is new: it is not joined with the counts."""
    index = ld.LineIndex.create(spark).insert(spark.createDataFrame([(k, f"the line of number {k}") for k in range(300)], KIND))
    asked = ld.references(spark.createDataFrame([(0, "\n".join(f"the line of number {k}" for k in range(290, 3290)))], KIND), 10, "doc_id", "text")
    n = index._may_hold(asked.select("k1", "k2"), 1).count()
    assert 10 <= n <= 14  # ten are there; a fingerprint errs in one of some ten thousand
    assert index._may_hold(asked.select("k1", "k2"), 2).count() <= 4


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    keys = rng.integers(-(1 << 63), 1 << 63, 20_000)
    cuckoo = ld.Cuckoo.sized(2_000)  # far too small: further tables are added
    cuckoo.add(keys)
    cuckoo.add(keys[:5_000])
    assert len(cuckoo.tables) > 1
    assert (cuckoo.count(keys) >= 1).all() and (cuckoo.count(keys[:5_000]) >= 2).all()
    cuckoo = ld.Cuckoo.from_bytes(cuckoo.buckets, cuckoo.to_bytes())
    cuckoo.remove(np.concatenate([keys[:5_000], keys[:100]]))
    assert (cuckoo.count(keys[100:]) >= 1).all()
    assert (cuckoo.tables > 0).sum() == 20_000 - 100
    fits = ld.Cuckoo.sized(20_000)
    fits.add(keys)
    assert len(fits.tables) == 1
    others = rng.integers(-(1 << 63), 1 << 63, 100_000)
    assert (fits.count(others) > 0).mean() < 1e-3
    with pytest.raises(ValueError):
        ld.Cuckoo.sized(10).remove(keys[:1])
