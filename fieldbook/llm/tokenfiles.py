"""Token ids in ORC files.

Documents are dealt out by ranges of their id and sorted, encoded where they lie, and written one file
per range: rows in ascending order of the id, ids as integers (which ORC run-length encodes within
each stripe), with row indexes and a Bloom filter on the document id. Readers split the files by
stripes, and a read by document id skips stripes and row groups by their metadata.

Each row also keeps how many ids stand before it in its own file, so a document's place in the whole
sequence is that number and the ids of the files before: one small row per file.

Null text counts as empty: its document holds the end id only. Rows with a null id come first; rows
with the same id stand in the order of their texts' hashes. An empty table gives no rows. Only the id and the
text are read, whatever other columns there are.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.session import work_root

from .chunks import Memo, byte_letters, piece_starts, pieces
from .common import held, map_batches, map_partitions, text_or_empty

#: Bytes in a stripe and rows in a row group of the files.
STRIPE_BYTES, INDEX_ROWS = 16 << 20, 1_000

#: Parts of texts whose ids a worker keeps.
KEPT = 600_000

#: Bytes of text that a worker encodes at a time (one text at least).
TEXT_BYTES = 8 << 20


class Encoder:
    """The ``tokenizers`` library, asked once per piece as long as the piece is remembered.

    Texts are cut where the library's byte-level splitter cuts them, most of them into its pieces. Arrow numbers
    the different parts of many texts, each is looked up once, and each new piece goes
    to the library's model. Texts that hold one of the tokenizer's
    special strings, and tokenizers that aren't plain byte-level ones, go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"] or {}
        self.plain = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.any_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_letters().items()}
        self.parts = Memo(self.encode, KEPT)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # these bytes stand for themselves, but for the space
            word = piece.replace(" ", self.letters[0x20])
        else:
            word = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.plain or self.any_special(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        word = text.isascii() and text[text[:1] == " ":].isalpha()  # most are: one piece
        found = [text] if word else pieces(text)
        return self._piece(text) if len(found) == 1 else b"".join(map(self.parts.__getitem__, found))

    def encode_all(self, texts: pa.StringArray, end_id: int) -> pa.ListArray:
        """The ids of each text, and the end id after them."""
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        marks = piece_starts(data) if self.plain else np.zeros(len(data), bool)
        for special in self.special if self.plain else ():
            for k in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
                marks[at[k]:at[k + 1]] = False
        marks[at[:-1][at[:-1] < at[1:]]] = True
        starts = np.flatnonzero(marks).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, at[-1])), pa.py_buffer(data))
        parts = parts.dictionary_encode()
        ids = [*map(self.parts.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False)), np.array([end_id], "<u4").tobytes()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()),
                                       pa.array(np.frombuffer(b"".join(ids), "<i4")))
        ends = np.searchsorted(starts, at[1:])  # parts before the end of each text, without the end ids
        ids = ids.take(pa.array(np.insert(parts.indices.to_numpy(), ends, len(ids) - 1)))
        ends = ids.offsets.to_numpy()[ends + np.arange(1, len(ends) + 1)]
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), ids.values)


def loaded(path: str) -> Encoder:
    return held(("token_files", path), lambda: Encoder(path))


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, partitions: int | None = None,
                 id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every whole text and write (id, part, before, n_tokens, tokens) as ORC in ascending id order.

    ``before`` counts the ids that stand before the document in its own file.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = loaded(tokenizer_path), 0
        for whole in batches:
            texts = whole.column(1).cast(pa.string())
            till = np.cumsum(pc.binary_length(texts).to_numpy())
            k = 0
            while k < len(texts):
                n = max(1, int(np.searchsorted(till, (till[k - 1] if k else 0) + TEXT_BYTES, "right")) - k)
                tokens = encoder.encode_all(texts.slice(k, n), end_id)
                at = tokens.offsets.to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(k, n), pa.array(before + at[:-1]), pa.array(np.diff(at)), tokens],
                                                 ["id", "before", "n_tokens", "tokens"])
                k, before = k + n, before + int(at[-1])

    out = map_partitions(rows, run, f"id {kind}, before bigint, n_tokens bigint, tokens array<int>", keeps="token_files")
    out = out.select(F.col("id").alias("doc_id"), F.spark_partition_id().alias("part"), "before", "n_tokens", "tokens")
    (out.write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", INDEX_ROWS).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The documents of token files; with ``ids``, only these (stripes and row groups without them are skipped)."""
    rows = spark.read.orc(path)
    return rows if ids is None else rows.where(F.col("doc_id").isin(ids))


def index(spark: SparkSession, path: str) -> DataFrame:
    """From the files: (doc_id, ``start`` in the whole sequence, ``n_tokens``, ``ids_crc32``) per document."""
    files = spark.read.orc(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "base", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    parts = parts.select("part", F.coalesce("base", F.lit(0)).alias("base"))
    kind = files.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens = batch.column(3)
        ids, at = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), tokens.offsets.to_numpy()
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                                         ["id", "part", "before", "n_tokens", "ids_crc32"])

    read = map_batches(files.select("doc_id", "part", "before", "tokens"), run,
                       f"id {kind}, part int, before bigint, n_tokens bigint, ids_crc32 bigint")
    return read.join(parts, "part").select(F.col("id").alias("doc_id"), (F.col("base") + F.col("before")).alias("start"),
                                           "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the ids of all documents to the shared folder and return what the files say of each."""
    spark = docs.sparkSession
    path = f"{work_root(spark)}/llm/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer_path, path, end_id)
    return index(spark, path)
