"""Document fingerprints by winnowing, in DataFrame functions only.

A text's units are its words of at most ``UNIT`` characters and, of a longer run without ASCII white
space, the ``UNIT`` characters from each of its places on that has so many: overlapping, one character
apart. Each run of ``GRAM`` neighbouring units has a hash, rolled up by doubling: the hash of four units
is that of the hashes of their two halves. Of each ``WINDOW`` neighbouring hashes the least is chosen,
the rightmost where several are least; what is chosen, with its place, is the fingerprint. So any two
texts that share ``WINDOW + GRAM - 1`` units in a row share a chosen hash there. In text without white
space these are ``UNIT + WINDOW + GRAM - 2`` characters in a row, wherever they begin; elsewhere what
comes before or after a shared passage changes units of its first and last words only, by less than
``UNIT`` characters of each.

Null text counts as empty. A text without units has an empty fingerprint; one of fewer units than a
gram has one hash, of all of them. Two empty fingerprints are alike (1), an empty one and another are
not (0). Rows with one id follow each other in the order of their texts' hashes; null ids come after
all others in descending order. A table of one row has itself as next. An empty table gives no rows.
Places are counted in units, from 0, modulo 2**24. Only the id and the text are read, whatever other columns
there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_order, text_or_empty, written

#: Characters in a unit at most, units in a gram, grams in a window: the last two are powers of two.
UNIT, GRAM, WINDOW = 8, 4, 8

PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1


def units(text: str) -> Column:
    """A text's units in order: from each place the next characters, which end the run's units where they end the run."""
    in_run = r"[^\x20\x09-\x0D]"
    each = rf"(?=({in_run}{{1,{UNIT}}}+))(?:{in_run}{{1,{UNIT}}}+(?!{in_run})|{in_run})"
    return F.regexp_extract_all(text, F.lit(each), F.lit(1))


def doubled(rows: DataFrame, column: str, times: int, join, name: str) -> DataFrame:
    """Replace the array by what ``join`` makes of neighbours 1, 2, 4, ... places apart, ``times`` times."""
    for k in range(times):
        apart = 1 << k
        n = F.greatest(F.size(column) - apart, F.lit(0))
        rows = rows.withColumn(column, F.zip_with(F.slice(column, 1, n), F.slice(column, apart + 1, n), join))
    return rows.withColumnRenamed(column, name)


def fingerprinted(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text as an array of numbers, each a hash above the place counted down.

    Every step is a column of its own, so that none is worked out twice.
    """
    rows = rows.withColumn("fp units", F.transform(units(text), lambda u: F.xxhash64(u)))
    rows = rows.withColumn("fp all", F.xxhash64("fp units")).withColumn("fp n", F.size("fp units"))
    rows = doubled(rows, "fp units", int(math.log2(GRAM)), lambda a, b: F.xxhash64(a, b), "fp grams")
    few = F.when(F.col("fp n") > 0, F.array("fp all")).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("fp grams", F.when(F.col("fp n") >= GRAM, F.col("fp grams")).otherwise(few))
    # the place counts down, so that the least of equal hashes is the rightmost
    rows = rows.withColumn("fp grams", F.transform("fp grams", lambda h, at: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS).bitwiseOR(
        F.lit(PLACES).cast("bigint") - at.cast("bigint").bitwiseAND(F.lit(PLACES)))))
    rows = rows.withColumn("fp least", F.array_min("fp grams")).withColumn("fp n", F.size("fp grams"))
    rows = doubled(rows, "fp grams", int(math.log2(WINDOW)), lambda a, b: F.least(a, b), "fp mins")
    few = F.when(F.col("fp n") > 0, F.array("fp least")).otherwise(F.array().cast("array<bigint>"))
    chosen = F.when(F.col("fp n") >= WINDOW, F.array_distinct("fp mins")).otherwise(few)
    return rows.withColumn(name, chosen).drop("fp mins", "fp all", "fp least", "fp n")


def written_out(name: str) -> Column:
    """The fingerprint as text: hash and place of each choice."""
    return F.array_join(F.transform(name, lambda x: F.concat(
        F.lower(F.hex(F.shiftrightunsigned(x, PLACE_BITS))), F.lit(":"), F.lit(PLACES) - x.bitwiseAND(F.lit(PLACES)))), ",")


def hashes(name: str) -> Column:
    return F.array_distinct(F.transform(name, lambda x: F.shiftright(x, PLACE_BITS)))


def likeness(a: str, b: str) -> Column:
    """The share of the hashes of either that both have."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1))).cast("double")


def ranges(keys: DataFrame, n: int) -> DataFrame:
    """One row: the least keys of about n ranges of as many rows each, in order, as an array of arrays,
    ``cuts``, beside the first key of each of these, ``tops``.

    They are the keys at every so many places of all keys in order; nothing but keys is sorted. A key that
    holds several such places begins one range only.
    """
    places = in_order(keys, F.col("key"))
    step = max(1, -(-(places.agg(F.max("at")).first()[0] or 0) // n))
    cuts = places.where(F.col("at") % step == 0).select("key").distinct().agg(F.sort_array(F.collect_list("key")).alias("all"))
    wide = F.ceil(F.sqrt(F.size("all") + 1)).cast("int")
    pieces = F.sequence(F.lit(0), F.greatest(F.floor((F.size("all") - 1) / wide).cast("int"), F.lit(0)))
    cuts = cuts.select(F.transform(pieces, lambda k: F.slice("all", k * wide + 1, wide)).alias("cuts"))
    return cuts.select(F.struct("cuts", F.transform("cuts", lambda some: F.get(some, 0)).alias("tops")).alias("ranges"))


def with_next(docs: DataFrame, carried: list[str], n: int) -> DataFrame:
    """Add ``next_<column>`` of the next row in descending order of ids; the first row's after the last.

    Rows are dealt out by ranges of their places in this order, so that rows of one id, or without any, may lie in
    several. The first row of a range goes to the range before too (the topmost row to the last range), where
    it follows the last one.
    """
    # the order of ids turned round; of rows that are equal in id and text, any may come first
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0)).cast("bigint")).alias("id"),
                   F.xxhash64("text").alias("tie"))
    rows = docs.withColumn("key", key)
    rows = rows.withColumn("ranges", written(ranges(rows.select("key"), n), "ranges").scalar())
    rows = rows.select(*rows.columns[:-1], "ranges.*")
    up_to = lambda some: F.size(F.filter(some, lambda x: x <= F.col("key")))
    rows = rows.withColumn("part", up_to(F.col("tops")))
    rows = rows.withColumn("fine", up_to(F.element_at("cuts", F.col("part"))))
    first = F.element_at(F.element_at("cuts", F.col("part")), F.col("fine")) == F.col("key")
    wide, last = F.size(F.element_at("cuts", F.lit(1))), F.size(F.flatten("cuts"))
    rows = rows.withColumn("range", (F.col("part") - 1) * wide + F.col("fine"))
    here = F.struct("range", F.lit(False).alias("extra"))
    before = F.struct(F.when(F.col("range") > 1, F.col("range") - 1).otherwise(last).alias("range"), F.lit(True).alias("extra"))
    twice = rows.withColumn("at", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))))
    twice = twice.select(*docs.columns, "key", "at.range", "at.extra")
    w = Window.partitionBy("range").orderBy("extra", "key")
    out = twice.select(*docs.columns, "extra", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return out.where("not extra").drop("extra")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, ``n_chars``, ``text``, ``fp``) of every document; ``fp`` as :func:`fingerprinted` makes it."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
    return fingerprinted(rows, "text", "fp")


def edited_pairs(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every document beside its edited text: the last half replaced by the beginning of the next document."""
    n = partitions or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(fingerprints(docs), ["text", "fp"], n)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    return fingerprinted(rows, "edited", "edited_fp")


def digests(docs: DataFrame) -> DataFrame:
    """Per document both fingerprints as text, and how like its own is to the edited text's and the next one's."""
    rows = edited_pairs(docs).withColumns({f"{c} set": hashes(c) for c in ("fp", "edited_fp", "next_fp")})
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written_out("fp").alias("fingerprint"),
                       written_out("edited_fp").alias("edited_fingerprint"), likeness("fp set", "edited_fp set").alias("near_edited"),
                       likeness("fp set", "next_fp set").alias("near_next"))
