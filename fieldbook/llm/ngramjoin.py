"""N-gram Jaccard join along chosen paths.

A document is the set of its word n-grams. Documents with the same set are one *representative* with a
weight. Each set is embedded into ``COORDINATES`` sampled n-grams, the least under so many hash
functions; two sets agree on a coordinate with probability their Jaccard similarity.

*Chosen paths.* In one run every set starts at the root. At a node each coordinate is chosen with
probability ``1 / (LAMBDA * COORDINATES)``, drawn from the node's name, so the same for all sets there,
and a set moves on to one child for each chosen coordinate, named by the n-gram it has there. Sets that
share a sampled n-gram stay together. Nodes are split twice, and again while they hold more than
``SMALL`` sets; runs are repeated until pairs at the threshold meet with the target probability at the
depth that was reached. After ``DEEPEST`` splits a node that is still large is cut into parts, and each
two parts are compared apart, so nothing is left out.

*Brute force.* Small nodes compare all their sets: by their sketches first, well below the threshold,
then what passes by the sets themselves. A pair that meets in several nodes counts in the first only,
found from the lists of nodes of the two. A node returns, for each set, the number of its links, and the
smallest set it hangs together with; pairs themselves are never put out. Linked sets are then joined
into classes by alternating stars.

N-grams are of ``SHINGLE`` words, separated by ASCII white space; a shorter text is one n-gram of all its
words. A text without words, or null, is in no link and a class of its own. Rows with the same id are
rows of their own. A class is named by its smallest id; a null id comes after all others. An empty
table gives no rows. ``join`` reads the id and the text only; ``one_of_each`` keeps all columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, map_partitions, written
from .substrings import Words, mixed, spans_hashed

SHINGLE, THRESHOLD = 5, 0.8

#: Coordinates of the embedding; children of a node on average are 1 / LAMBDA; least splits and most; sets in a small node.
COORDINATES, LAMBDA, LEAST_SPLITS, DEEPEST, SMALL = 64, 0.7, 2, 5, 2048

#: Share of the pairs at the threshold to be found.
RECALL = 0.999

#: Sketches that agree on less than this share cannot well belong to sets at the threshold (four deviations below it).
SKETCH = THRESHOLD - 0.2

SHINGLE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_rng = np.random.default_rng(70_201)
MULTIPLY = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
COORDINATE = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64))


def shingled(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the n-grams of all texts in turn, where each text's begin and end)."""
    words = Words(texts)
    n = np.diff(words.before)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(n)), counts)
    starts = words.before[text] + np.arange(bounds[-1]) - bounds[text]
    return spans_hashed(words.hashes, SHINGLE_BASE, starts, np.minimum(starts + size, words.before[text + 1])), bounds


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text with n-grams, its least hash under each function (the upper 32 bits)."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), COORDINATES), "<u4")
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(mixed_once(hashes, k), starts) >> np.uint64(32) if len(starts) else 0
    return out


def mixed_once(hashes: np.ndarray, k: int) -> np.ndarray:
    return (hashes ^ PLUS[k]) * MULTIPLY[k]


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, ``h`` of the text, ``key`` of the set, ``n`` n-grams, ``sketch``) per document, written."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, bounds = shingled(batch.column(1).to_pylist(), size)
        full = np.diff(bounds) > 0
        sketch = iter(sketches(hashes, bounds))
        keys, sizes = [], []
        for a, b in zip(bounds, bounds[1:]):
            one = np.unique(hashes[a:b])
            sizes.append(len(one))
            # a sum and a product of the mixed members: the same for the same set
            keys.append((mixed(one).sum(dtype=np.uint64).tobytes() + np.multiply.reduce(mixed(~one) | np.uint64(1), dtype=np.uint64).tobytes()) if b > a else None)
        rows = [next(sketch).tobytes() if f else None for f in full]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                                          pa.array(rows, pa.binary())], ["doc_id", "h", "key", "n", "sketch"])

    return written(map_batches(rows, run, f"doc_id {kind}, h bigint, key binary, n bigint, sketch binary"), "sets")


def representatives(sets: DataFrame) -> DataFrame:
    """(rep, id, h, key, weight, sketch): one row for each set, numbered in the order of the least ids."""
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    least = sets.where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("weight"), F.min(F.struct(order.alias("id"), "h")).alias("first"))
    # sorted by ranges, so the numbers rise with the ids; written, so they stay
    rows = least.select("key", "weight", "first.id", "first.h").orderBy("id", "key")
    numbered = written(rows.withColumn("rep", F.monotonically_increasing_id()), "numbered")
    sketch = sets.where("key IS NOT NULL").groupBy("key").agg(F.min("sketch").alias("sketch"))
    return written(numbered.join(sketch, "key"), "representatives")


def descend(nodes: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the rows, child node) for every chosen coordinate of every row's node."""
    limit = np.uint64(int(2.0**64 / (LAMBDA * COORDINATES)))
    drawn = mixed(nodes[:, None] + COORDINATE[None, :])
    row, at = np.nonzero(drawn < limit)
    return row, mixed(mixed(drawn[row, at]) + sketch[row, at].astype(np.uint64) * SHINGLE_BASE)


def split(rows: DataFrame, runs: range | None, times: int) -> DataFrame:
    """(node, rep): the children, ``times`` levels down, of (node, rep, sketch), or of the runs' roots."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        reps = batch.column("rep").to_numpy()
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u4").reshape(-1, COORDINATES)
        starts = [mixed(np.full(len(reps), r + 1, np.uint64)) for r in runs] if runs is not None else [batch.column("node").to_numpy().view(np.uint64)]
        for nodes in starts:
            at = np.arange(len(reps))
            for _ in range(times):
                row, nodes = descend(nodes, sketch[at])
                at = at[row]
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(reps[at])], ["node", "rep"])

    return map_batches(rows, run, "node bigint, rep bigint")


def met(similarity: float, depth: int) -> float:
    """The probability that a pair meets in a run at a depth."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p * similarity / LAMBDA)
    return p


def runs_for(depth: int) -> int:
    return math.ceil(math.log(1 - RECALL) / math.log(1 - met(THRESHOLD, depth)))


def leaves_of(reps: DataFrame, runs: range) -> tuple[DataFrame, int]:
    """(leaf, part, rep, ``deep``) of all nodes with company, and the depth reached."""
    found, depth, rows = [], LEAST_SPLITS, split(reps.select("rep", "sketch"), runs, LEAST_SPLITS)
    while True:
        counts = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sized = written(rows.join(counts, "node"), "sized")
        small = (F.col("n") <= SMALL) | F.lit(depth >= DEEPEST)
        found.append(sized.where(small).select(F.col("node").alias("leaf"), "n", "rep", F.lit(depth > LEAST_SPLITS).alias("deep")))
        large = sized.where(~small)
        if depth >= DEEPEST or not large.head(1):
            break
        rows = split(large.join(reps.select("rep", "sketch"), "rep"), None, 1)
        depth += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, depth


def in_parts(leaves: DataFrame) -> DataFrame:
    """(leaf, part, side, rep): nodes left large are dealt into parts, and rows go to each two parts they belong to."""
    half = SMALL // 2
    parts = F.greatest(F.ceil(F.col("n") / half).cast("int"), F.lit(1))
    whole = F.col("n") <= SMALL
    mine = F.pmod(F.xxhash64("rep", "leaf"), parts).cast("int")
    pair = lambda k: F.least(mine, k).cast("bigint") * (1 << 31) + F.greatest(mine, k).cast("bigint")
    places = F.when(whole, F.array(F.struct(F.lit(0).cast("bigint").alias("part"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(pair(k).alias("part"), F.when(k == mine, 0).when(mine < k, 1).otherwise(2).alias("side"))))
    return leaves.withColumn("place", F.explode(places)).select("leaf", "place.part", "place.side", "rep")


def per_group(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each group: groups are brought together and met in sorted order.

    There are many groups of two rows here; this spares each of them a call of its own.
    """
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
                yield pa.Table.from_batches(held)
                held = []
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:-1]):
                yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
                held = []
            held.append(batch.slice(bounds[-2]))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.Table] = []
        for group in groups(b for b in batches if b.num_rows):
            if group.num_rows > 1 and (made := fn(group)).num_rows:
                done.append(made)
            if len(done) >= 500:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done = []
        if done:
            yield from pa.concat_tables(done).combine_chunks().to_batches()

    return map_partitions(rows.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def first_meeting(own: list[np.ndarray], leaf: int) -> np.ndarray:
    """For each two rows of a leaf, whether it is the least they share."""
    before = [set(o[:np.searchsorted(o, leaf)].tolist()) for o in own]
    seen: dict[int, list[int]] = {}
    for k, nodes in enumerate(before):
        for node in nodes:
            seen.setdefault(node, []).append(k)
    first = np.ones((len(own), len(own)), bool)
    for rows in seen.values():
        if len(rows) > 1:
            first[np.ix_(rows, rows)] = False
    return first


def compared(side: np.ndarray) -> np.ndarray:
    """For each two rows, whether they are to be compared here: a part with itself, or two parts with each other."""
    mask = np.triu(np.ones((len(side), len(side)), bool), 1)
    if (side > 0).any():  # two parts meet: rows of one part with each other are compared elsewhere
        mask &= side[:, None] != side[None, :]
    return mask


def shortlist(table: pa.Table) -> pa.Table:
    """Rows of a leaf that have a partner by their sketches which they meet here first."""
    rows = table.to_pydict()
    own = [np.frombuffer(o, "<i8") for o in rows["own"]]
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, COORDINATES)
    if len(own) <= 64:
        near = (sketch[:, None, :] == sketch[None, :, :]).sum(2)
    else:
        near = np.zeros((len(own), len(own)), np.int16)
        for k in range(COORDINATES):
            near += sketch[:, None, k] == sketch[None, :, k]
    mask = compared(np.array(rows["side"])) & (near >= SKETCH * COORDINATES)
    if mask.any():
        mask &= first_meeting(own, rows["leaf"][0])
    keep = pa.array(mask.any(0) | mask.any(1))
    return table.select(["leaf", "part", "side", "rep"]).filter(keep)


def linked(table: pa.Table, threshold: float) -> pa.Table:
    """For each row of a leaf: the weight of its links met here first, and the least row it hangs together with."""
    rows = table.to_pydict()
    _, at = np.unique(rows["rep"], return_index=True)  # a document in twice has its set in twice
    reps, weight, side = (np.array(rows[k])[at] for k in ("rep", "weight", "side"))
    sets = [np.frombuffer(rows["set"][k], "<u8") for k in at]
    own = [np.frombuffer(rows["own"][k], "<i8") for k in at]
    sizes = np.array([len(s) for s in sets])
    # shared n-grams of all pairs: members that several sets have, one list of sets each
    members, which = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), sizes)
    shared = np.zeros((len(sets), len(sets)), np.float32)
    often = np.flatnonzero(np.bincount(which, minlength=len(members)) > 1)
    column = np.full(len(members), -1)
    column[often] = np.arange(len(often))
    some = column[which] >= 0
    held_by, columns = holder[some], column[which][some]
    order = np.argsort(columns, kind="stable")
    held_by, columns = held_by[order], columns[order]
    step = max(1, (4 << 20) // max(1, len(sets)))
    for low in range(0, len(often), step):
        a, b = np.searchsorted(columns, [low, low + step])
        dense = np.zeros((len(sets), min(step, len(often) - low)), np.float32)
        dense[held_by[a:b], columns[a:b] - low] = 1
        shared += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - shared
    mask = compared(side) & (shared >= threshold * union - 1e-6)
    if mask.any():
        mask &= first_meeting(own, rows["leaf"][0])
    both = mask | mask.T
    root = np.arange(len(sets))
    while True:  # reps are in rising order: the least place is the least rep
        least = np.where(both, root[None, :], len(root)).min(1)
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    links, degree = both @ weight, both.sum(1)
    keep = degree > 0
    return pa.table({"rep": pa.array(reps[keep], pa.int64()), "root": pa.array(reps[root][keep], pa.int64()),
                     "links": pa.array(links[keep], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(rep, root): the least member of each connected component of (rep, root) edges, by alternating stars."""
    edges = written(edges.where("rep <> root").select(F.greatest("rep", "root").alias("rep"), F.least("rep", "root").alias("root")).distinct(), "edges")
    while True:
        # large star: every greater neighbour hangs on the least of the neighbourhood
        both = edges.unionByName(edges.select(F.col("root").alias("rep"), F.col("rep").alias("root")))
        least = both.groupBy("rep").agg(F.min("root").alias("m")).select("rep", F.least("m", "rep").alias("m"))
        large = both.join(least, "rep").where("root > rep").select(F.col("root").alias("rep"), F.col("m").alias("root")).distinct()
        # small star: every smaller neighbour, and the vertex, hang on the least of the smaller ones
        large = written(large, "large")
        least = large.groupBy("rep").agg(F.min("root").alias("m"))
        small = large.join(least, "rep").select(F.col("root").alias("rep"), F.col("m").alias("root")).where("rep <> root")
        new = written(small.unionByName(least.select("rep", F.col("m").alias("root"))).distinct(), "edges")
        if not new.exceptAll(edges).head(1) and not edges.exceptAll(new).head(1):
            return new
        edges = new


def join(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, h, key, ``class_id``, ``n_links``, ``first``) of every document.

    ``n_links`` is the number of other documents at the threshold or above, documents of the same set
    among them; ``first`` tells the one set of each class by which it is named; ``h`` is xxhash64 of the text
    and ``key`` tells sets apart.
    """
    sets = sets_of(docs, size)
    reps = representatives(sets)
    done = runs_for(LEAST_SPLITS)
    leaves, depth = leaves_of(reps, range(done))
    leaves = written(leaves, "leaves")
    while (needed := runs_for(depth)) > done:  # for what was split further, more runs
        deep = leaves.where("deep").select("rep").distinct()
        more, reached = leaves_of(written(reps.join(deep, "rep", "left_semi"), "deep"), range(done, needed))
        leaves = written(leaves.unionByName(more), "leaves")
        done, depth = needed, max(depth, reached)
    own = leaves.groupBy("rep").agg(F.array_sort(F.collect_set("leaf")).alias("own")).join(reps.select("rep", "sketch"), "rep")

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = [np.array(x, "<i8").tobytes() for x in batch.column(1).to_pylist()]
        # a byte a coordinate tells sketches apart well enough to choose what is compared exactly
        short = [np.frombuffer(x, "<u4").astype(np.uint8).tobytes() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary()), pa.array(short, pa.binary())], ["rep", "own", "sketch"])

    own = written(map_batches(own, pack, "rep bigint, own binary, sketch binary"), "own")
    shown = in_parts(leaves).join(own, "rep")
    chosen = written(per_group(shown, ["leaf", "part"], shortlist, "leaf bigint, part bigint, side int, rep bigint"), "shortlist")

    own = own.drop("sketch")
    wanted = chosen.select("rep").distinct().join(reps.select("rep", "id", "h", "weight"), "rep").join(own, "rep")
    wanted = written(wanted, "wanted")
    identity = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("bigint")
    texts = docs.select(identity.alias("id"), F.xxhash64("text").alias("h"), "text").join(wanted, ["id", "h"])

    def exact(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, bounds = shingled(batch.column(3).to_pylist(), size)
        members = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(members, pa.binary())], ["rep", "weight", "own", "set"])

    full = written(map_batches(texts.select("rep", "weight", "own", "text"), exact, "rep bigint, weight bigint, own binary, set binary"), "full")
    found = written(per_group(chosen.join(full, "rep"), ["leaf", "part"], lambda table: linked(table, threshold),
                              "rep bigint, root bigint, links bigint"), "linked")
    roots = components(found.select("rep", "root"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = reps.select("key", "rep", "id", "weight").join(roots, "rep", "left").join(links, "rep", "left")
    known = known.withColumn("root", F.coalesce("root", "rep")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("weight") - 1)
    names = reps.select(F.col("rep").alias("root"), F.col("id").alias("class"))
    known = written(known.join(names, "root").select("key", F.col("class"), "links", "id", (F.col("rep") == F.col("root")).alias("leads")), "classes")
    out = sets.join(known, "key", "left")
    name = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.nullif("class", F.lit((1 << 63) - 1)))
    first = F.col("key").isNull() | (F.col("leads") & (identity == F.col("id")))
    return out.select("doc_id", "h", "key", name.alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), first.alias("first"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one that names it. Rows that are the same in id and text stay once."""
    kept = written(join(docs, size, threshold).where("first").select(F.col("doc_id").alias("kept id"), F.col("h").alias("kept h"), "key").distinct(), "kept")
    # documents of one id but of different texts with the same set: the least text stays
    alone = F.when(F.col("key").isNull(), F.col("kept h"))
    kept = kept.groupBy("kept id", "key", alone.alias("alone")).agg(F.min("kept h").alias("kept h"))
    rows = docs.withColumn("kept text", F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept id")) & (F.col("kept text") == F.col("kept h")), "left_semi")
    return rows.dropDuplicates(["doc_id", "kept text"]).select(docs.columns)
