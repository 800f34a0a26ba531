r"""Secret scans with corpus-wide ownership.

Three kinds of candidates are found in every whole text by fixed patterns: a value assigned to a
name such as ``password`` (``assign``), an access key id (``access``), a long run of hexadecimal
digits (``hex``). A fourth kind is only a candidate: a long run of credential letters standing by
itself that mixes digits with upper and lower case and has high entropy (``owned``).

Candidates are hashed, and over the whole corpus each hash is counted by the distinct texts
(repositories: copies of one document count once) and distinct sources (owners) that hold it. What few
texts hold looks live, and the fewer owners share it, the more texts they may be: up to
``few * (1 + 1 / owners)``, the same in every corpus. What more texts hold is a copied example, such as
documentation shows. Spans of the fixed patterns are always returned. An ``owned`` candidate becomes a
span if it looks live.

Places are code points, ends exclusive. Null text counts as empty. A null source is an owner of its
own. Repeated rows each get their spans. Of two spans at one place the kind listed first comes first. An
empty table gives no rows. Only the id, the source and the text are read (``mask`` keeps all columns).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, text_or_empty, written

#: Kinds in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "owned")

#: A candidate in so many distinct texts looks live whoever holds it; in twice as many if they have one owner.
FEW = 4

#: Least length of an ``owned`` candidate and least entropy, in bits a character.
OWNED_CHARS, OWNED_BITS = 20, 3.5

#: Fixed patterns; ``(?ai)``: ASCII letters in either case.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 characters or more; a shorter run holds no longer one
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
OWNED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{OWNED_CHARS},}}")
NAMES = ("passw", "secret", "token", "api")

CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string())])
CANDIDATES = "array<struct<kind:int,start:bigint,end:bigint,hash:string>>"

#: Salts that spread the occurrences of one value when its count is joined back.
SALTS = 16


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns."""
    found = []
    lower = text.lower()
    if any(n in lower for n in NAMES):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]


def mixed(value: str) -> bool:
    """Whether a run of letters looks drawn at random."""
    if not (any("0" <= c <= "9" for c in value) and any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= OWNED_BITS


def owned_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Long random-looking runs that touch no span of the fixed patterns."""
    found = [(m.start(), 3, m.end(), m[0]) for m in OWNED.finditer(text) if mixed(m[0])]
    return [f for f in found if not any(b[0] < f[2] and f[0] < b[2] for b in base)]


def digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def scan(texts: pa.Array) -> list[pa.Array]:
    out = []
    for text in texts.to_pylist():
        base = base_spans(text)
        out.append([{"kind": k, "start": s, "end": e, "hash": digest(v)} for s, k, e, v in sorted(base + owned_spans(text, base))])
    return [pa.array(out, pa.list_(CANDIDATE))]


def owners(scanned: DataFrame) -> DataFrame:
    """(hash, ``n_texts``, ``n_owners``) over the whole corpus, from rows of (copy, source, candidates).

    Texts and owners are made distinct first, each combined before its shuffle, so that a value that
    is everywhere meets no task whole.
    """
    held = scanned.select("copy", "source", F.explode("candidates.hash").alias("hash"))
    texts = held.groupBy("hash", "copy").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_texts"))
    by_owner = held.groupBy("hash", "source").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_owners"))
    return texts.join(by_owner, "hash")


def find(docs: DataFrame, few: int = FEW) -> DataFrame:
    """(row, doc_id, ``spans``) per document, ``spans`` by start and kind with ``n_texts``, ``n_owners`` and ``live``.

    ``row`` numbers the rows of ``docs`` as read, for joining back.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", text_or_empty().alias("text"))
    rows = rows.withColumn("copy", F.xxhash64("text"))
    rows = add_columns(rows, ["text"], scan, f"candidates {CANDIDATES}").drop("text")
    scanned = written(rows, "candidates")
    each = scanned.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    each = each.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    counts = owners(scanned).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = each.join(counts, ["hash", "salt"]).withColumn("live", F.col("n_texts") * F.col("n_owners") <= few * (F.col("n_owners") + 1))
    known = known.where((F.col("kind") < 3) | F.col("live"))
    spans = known.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", "kind", "end", "hash", "n_texts", "n_owners", "live"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return scanned.join(spans, "row", "left").select("row", "doc_id", F.coalesce("spans", none).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """Per document the numbers of spans of the fixed patterns, their digest, and all spans."""
    listed = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.element_at(listed, s["kind"] + 1), s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] < 3)
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return find(docs).select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                             F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
                             F.array_join(F.transform("spans", text), ",").alias("spans"), live.alias("n_live"))


def mask(docs: DataFrame, few: int = FEW, by: str = "<SECRET>") -> DataFrame:
    """``docs`` with every live-looking value masked; copied examples stay, and so does all other text."""
    rows = written(docs.withColumn("mask row", F.monotonically_increasing_id()), "to-mask")
    named = rows.select(F.col("mask row").alias("doc_id"), "source", "text")
    live = find(named, few).select(F.col("doc_id").alias("mask row"), F.expr("filter(spans, s -> s.live)").alias("mask spans"))
    hit = rows.join(live.where(F.size("mask spans") > 0), "mask row", "left")

    def cover(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            parts, at = [], 0
            for s in found or ():
                if s["start"] >= at:
                    parts += [text[at:s["start"]], by]
                at = max(at, s["end"])
            out.append("".join([*parts, text[at:]]) if parts else text)
        return [pa.array(out, pa.string())]

    covered = add_columns(hit, ["text", "mask spans"], cover, "mask_text string")
    text = F.col("mask_text").alias("text")
    n_chars = F.when(F.col("text").eqNullSafe(F.col("mask_text")), F.col("n_chars")).otherwise(F.char_length("mask_text")).alias("n_chars")
    return covered.select(*[{"text": text, "n_chars": n_chars}.get(c, F.col(c)) for c in docs.columns])
