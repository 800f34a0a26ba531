"""Byte-level BPE, token counts and token files against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import reduce

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from fieldbook.llm import bytebpe, tokencount, tokenfiles

from .conftest import ROWS

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return bytebpe.loaded(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def texts(bpe, n=300):
    rng = random.Random(4)
    vocabulary = list(bpe.ranks)
    for _ in range(n):
        yield "".join(rng.choice("ab cé\n\t　\xa0'sl1.,İ") for _ in range(rng.randint(0, 40)))
        yield b"".join(rng.choice(vocabulary) for _ in range(6)).decode("utf-8", "ignore")
        yield "".join(rng.choice(["ab", " ", "  ", "<|endoftext|>", "\n", "the", " c", "é", "\x1c"]) for _ in range(12))
    yield from (r[1] or "" for r in ROWS)
    yield from ("x" * 30_000, " " * 3_000 + "a", "ab" * 20_000)


def test_bpe_is_the_library_s(bpe, reference):
    for text in texts(bpe):
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), text[:80]
        assert bpe.decode(ids) == text.encode()


def test_bpe_of_every_plane_s_letters(bpe, reference):
    for point in [*range(0x3100), *range(0x3100, 0x20000, 97)]:
        if not 0xD800 <= point < 0xE000:
            c = chr(point)
            text = f"a{c}b {c}{c} 1{c}2 {c}\n"
            assert np.frombuffer(bpe.encode(text), "<u4").tolist() == reference.encode_ordinary(text), hex(point)


def test_bpe_memos_may_fill_up(bpe, reference):
    from fieldbook.llm.chunks import Chunked, Memo

    small = Memo(lambda k: k * 2, 3)
    assert [small[k] for k in ("a", "b", "c", "d", "a", "e", "f", "g", "a")] == [k * 2 for k in "abcdaefga"]
    chunks = Chunked(lambda c: [c], 2)
    for text in ("a b  c\nd", "a b c ", " a", "", "\n\na b", "a\n"):
        assert "".join(x[0] for x in chunks.of(text)) == text


def test_bpe_documents(odd, empty, reference):
    got = sorted(map(tuple, bytebpe.digests(odd, RANKS, P.PATTERN).collect()), key=str)
    want = []
    for i, text, *_ in ROWS:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bytebpe.digests(empty, RANKS, P.PATTERN).count() == 0


def test_decode_keeps_columns_and_nulls(spark, bpe):
    rows = spark.createDataFrame([(1, bytearray(bpe.encode("some text"))), (2, None)], "decoded int, token_ids binary")
    out = bytebpe.decode(rows, RANKS, P.PATTERN)
    assert out.columns == ["token_ids", "decoded"]
    assert sorted(bytes(r.decoded).decode() if r.decoded is not None else "" for r in out.collect()) == ["", "some text"]


def test_transducer_counts_as_the_library(bpe, library):
    machine = tokencount.loaded(JSON)
    for text in texts(bpe):
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.count(text) == n, text[:80]


def whole_map(machine, text, size):
    maps = [machine.state_map(*part) for part in tokencount.cut(text, size, machine.strings)]
    return maps, tokencount.total(reduce(tokencount.compose, maps))


def test_state_maps_compose_however_a_text_is_cut(bpe, library):
    machine, rng = tokencount.loaded(JSON), random.Random(9)
    made = ["".join(rng.choice(some) for _ in range(rng.randint(1, 60)))
            for some in ("ab", "a", "-", " ", " a", "'sla", "'!", "\n a", "12a!", "\u4f60\u597d\u4e16", " \u3000\xa0x", "=-", "ab ") for _ in range(60)]
    mixed = ["".join(rng.choice(["<|endoftext|>", "!!!", "   ", "aaaa", "<|", "7"]) for _ in range(12)) for _ in range(200)]
    for text in [*texts(bpe, 100), *made, *mixed]:
        if len(text) < 300:
            want = len(library.encode(text, add_special_tokens=False).ids)
            for size in (1, 3, rng.randint(2, 20)):
                parts = list(tokencount.cut(text, size, machine.strings))
                assert "".join(p[1] for p in parts) == text
                maps, n = whole_map(machine, text, size)
                assert n == want, (text, size, parts)
                if len(maps) > 2:  # composition is associative
                    left = tokencount.compose(tokencount.compose(maps[0], maps[1]), maps[2])
                    assert left == tokencount.compose(maps[0], tokencount.compose(maps[1], maps[2]))


def test_text_without_white_space_is_counted_in_slices(library):
    machine, rng = tokencount.loaded(JSON), random.Random(3)
    han = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(20_000))
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(60_000))
    for text in (han, letters, "-" * 20_000, "=" * 9_999, " " * 9_000 + "a", "ab" * 20_000, "x" + "1" * 9_000):
        maps, n = whole_map(machine, text, 3_000)
        assert n == len(library.encode(text, add_special_tokens=False).ids), text[:20]
        inner = [m for m in maps[1:-1] if all(x["enter"] and x["leave"] for x in m)]
        assert len(inner) == len(maps) - 2 > 0, text[:20]  # every one is entered and left inside a piece
        assert all(len(m) <= tokencount.BEGINNINGS for m in maps)


def test_states_before_a_slice_need_not_be_known(spark, library, monkeypatch):
    monkeypatch.setattr(tokencount.CountTransducer, "_entries", lambda self, before: [])
    text = "-" * 5_000
    machine = tokencount.CountTransducer(JSON)
    assert whole_map(machine, text, 700)[1] is None
    monkeypatch.undo()
    monkeypatch.setattr(tokencount, "total", lambda whole: None)  # as if no map composed
    rows = spark.createDataFrame([(1, text), (2, text), (3, "a b")], "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(rows, JSON, 20, 700).collect()}
    n = len(library.encode(text, add_special_tokens=False).ids)
    assert got == {1: n, 2: n, 3: 2}


def test_slices_of_one_text_are_dealt_out(spark, library):
    text = "".join(random.Random(5).choices("etaoinshrdlu", k=400_000))
    rows = spark.createDataFrame([(1, text)], "doc_id int, text string")
    got = tokencount.count_tokens(rows, JSON, 20, 20_000).collect()
    assert got == [(1, 400_000, len(library.encode(text, add_special_tokens=False).ids), True)]


def test_transducer_may_start_anew(bpe, library, monkeypatch):
    monkeypatch.setattr(tokencount, "TRANSITIONS", 50)
    machine = tokencount.CountTransducer(JSON)
    for text in texts(bpe, 30):
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("slice_chars", [65_536, 700, 3, 5_000])
def test_counted_documents(odd, library, slice_chars):
    got = tokencount.count_tokens(odd, JSON, 20, slice_chars).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t, *_ in ROWS]
    assert sorted(map(tuple, got), key=str) == sorted(((*w, w[2] > 20) for w in want), key=str)


def test_counting_nothing(empty):
    assert tokencount.count_tokens(empty, JSON, 20).count() == 0


def test_token_files(odd, library):
    got = {r.start: r for r in tokenfiles.round_trip(odd, JSON).collect()}
    encoded = {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t, *_ in ROWS}
    at, ids = 0, []
    while at in got:  # each document starts where the one before ends
        ids.append(got[at].doc_id)
        assert (got[at].n_tokens, got[at].ids_crc32) in {
            (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in encoded.items() if i == got[at].doc_id}
        at += got[at].n_tokens
    assert len(got) == len(ROWS) == len(ids)
    assert at == sum(len(encoded[i, t]) for i, t, *_ in ROWS)
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


def test_token_file_encoder(bpe, library):
    encoder = tokenfiles.loaded(JSON)
    for text in texts(bpe):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_file_encoder_of_many_texts(bpe, library):
    some = [*texts(bpe, 60), "", "a\u3000  b", "a\u3000 b", "x\xa0 \n y", "Fu\xdf, m\xf6\xe7. 2\xd7, 2\xf7,", "don't, '' s's", ""]
    encoder = tokenfiles.Encoder(JSON)
    for rows in (some, some[5:40], [""], ["", ""], []):
        got = encoder.encode_all(pa.array(["cut off", *rows], pa.string()).slice(1), 7).to_pylist()
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 7] for t in rows]


def test_token_file_encoder_looks_up_each_part_once_a_batch():
    class Counted(dict):
        asked = 0

        def __missing__(self, part):
            Counted.asked += 1
            return b""

    encoder = tokenfiles.Encoder(JSON)
    encoder.parts = Counted()
    encoder.encode_all(pa.array(["many words, and more words, and more" * 50] * 200), 0)
    assert Counted.asked <= 8


def test_marked_starts_are_starts_of_pieces():
    from fieldbook.llm.chunks import WHITE_SPACE, piece_starts, pieces

    rng = random.Random(8)
    signs = "aabb1  \n'stmdrevl,.-\x1c\x7f\xe9\xd7\xf7\xb2\u01c5\u0416\u4e2d\U0001d49c" + WHITE_SPACE
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        ends = np.cumsum([len(p.encode()) for p in pieces(text)])
        assert {*np.flatnonzero(piece_starts(np.frombuffer(text.encode(), np.uint8)))} <= {*ends}
    data = np.frombuffer("One caf\xe9, two; don't".encode(), np.uint8)
    assert np.flatnonzero(piece_starts(data)).tolist() == [3, 9, 10, 14, 15, 19]  # in bytes


def test_token_files_read_by_id_and_empty(spark, odd, empty, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfiles.write_tokens(odd, JSON, path, partitions=3)
    rows = tokenfiles.read_tokens(spark, path, [8])
    assert [r.doc_id for r in rows.collect()] == [8]
    assert "doc_id" in rows._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    tokenfiles.write_tokens(empty, JSON, str(tmp_path / "none"))
    assert tokenfiles.index(spark, str(tmp_path / "none")).count() == 0


def test_pieces_are_found_alike(bpe):
    import regex

    from fieldbook.llm.chunks import PIECES, pieces

    slow = regex.compile(PIECES).findall
    rng = random.Random(6)
    some = ["".join(rng.choice("ab '  \n\tstmdrevl1é²½ǅ!") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text in [*texts(bpe, 50), *some, *[t.encode("ascii", "ignore").decode() for t in some]]:
        assert pieces(text) == slow(text)
