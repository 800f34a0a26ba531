"""Token counts by a transducer compiled from a byte-level BPE tokenizer.

Reading a piece byte by byte, let the *last token* of a prefix be the last one of the prefix's own
encoding. It is the one suffix of the prefix that is a token and may follow the last token of what
stands before it. So a deterministic machine can follow the encoding: its state keeps, for as many
bytes back as a token can still reach, the last token there and by how many tokens the count differs
from here. Each transition is annotated with the number of tokens it emits (the count of the longer
prefix less that of the shorter; it may be negative). States and transitions are made when first
needed and then looked up; there are finitely many, and a worker starts anew when it holds too many.

A text longer than a slice is cut into slices that are counted apart, wherever its task may be. A cut lies
where a piece certainly starts (the machine is in its start state) or, where there is no such place
near, certainly inside a piece, as in Chinese text, one-line data or long runs of one character. A
slice's *state map* says for each state the machine may enter it in where it leaves it and how many tokens
are counted on the way. All entry states a slice's map holds are gone through in step; where they come
together, they go on as one. Maps compose associatively without the text, so those of a text's slices are
combined by a tree of partial compositions, whichever worker made them.

States before a cut inside a piece are found from the ``CONTEXT`` characters there, read from each of
the first ``BEGINNINGS`` of them on. Should the state a slice is really entered in not be among these,
the maps do not compose, which is noticed, and the text is counted from its beginning.

Counts are those of the ``tokenizers`` library with no added special tokens; the tokenizer's special
strings count as one token where they occur in a text, as is the library's default. Null text counts
as empty: 0 bytes, 0 tokens. Repeated rows are counted each. Of equal merges in a piece the left one comes
first. An empty table gives no rows; only the id and the text are read, whatever other columns there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import WHITE_SPACE, Memo, byte_letters, pieces
from .common import held, map_batches, text_or_empty, written

#: Characters in a slice, slices whose maps are composed at once, and transitions kept by a worker.
SLICE, FAN_IN, TRANSITIONS = 65_536, 64, 400_000

#: Characters after a place for a cut within which a piece that starts is looked for; characters read before a
#: cut inside a piece, and how many of them a reading may begin at.
LOOK, CONTEXT, BEGINNINGS = 256, 512, 128

#: The kinds of characters the splitter tells apart: runs of each, from a place on.
RUNS_OF = {kind: regex.compile(f"{members}*+") for kind, members in {
    "space": f"[{WHITE_SPACE}]", "letter": r"\p{L}", "digit": r"\p{N}", "other": rf"[^{WHITE_SPACE}\p{{L}}\p{{N}}]"}.items()}

#: A state map: the states a slice may be entered in, the state it is left in and the tokens counted on the way.
#: States are written out; the empty one stands for the start of a piece.
MAP = "array<struct<enter:string,leave:string,count:bigint>>"
MAP_ARROW = pa.list_(pa.struct([("enter", pa.string()), ("leave", pa.string()), ("count", pa.int64())]))


def kind_of(letter: str) -> str:
    return next(kind for kind, run in RUNS_OF.items() if run.match(letter).end())


def splits(text: str, at: int, specials: list[str]) -> bool | None:
    """Whether a piece certainly starts at a place within a text (True) or certainly goes on there (False)."""
    if any(s in text[max(0, at - len(s)):at + len(s)] for s in specials):
        return None
    before, after = kind_of(text[at - 1]), kind_of(text[at])
    if before != after:  # a space may belong to what follows it, and so may an apostrophe
        return None if before == "space" or text[at - 1] == "'" else True
    if before == "space":  # the last one may belong to what follows
        return False if RUNS_OF["space"].match(text, at, at + 2).end() == at + 2 else None
    if before == "letter":  # up to two letters may belong to an apostrophe
        return False if at >= 3 and RUNS_OF["letter"].match(text, at - 3, at).end() == at else None
    return False


def cut(text: str, size: int, specials: list[str]) -> Iterator[tuple[str | None, str, bool]]:
    """A text's slices of about so many characters: (what was read before, None if a piece starts
    here; the slice; whether its last piece goes on after it)."""
    specials, places, at = [s for s in specials if s in text], [(0, True)], size
    while at < len(text):
        inside = None
        for place in range(at, len(text)):
            starts = splits(text, place, specials)
            if starts:
                places.append((place, True))
                break
            if inside is None and starts is False:
                inside = place
            if inside is not None and place - at >= min(LOOK, size):
                places.append((inside, False))
                break
        else:
            break
        at = places[-1][0] + size
    for (first, starts), (end, ends) in pairwise([*places, (len(text), True)]):
        yield None if starts else read_before(text, first), text[first:end], not ends


def read_before(text: str, at: int) -> str:
    """The characters of one kind before a place, at most ``CONTEXT``, and a space before all of them."""
    first, run = at, RUNS_OF[kind_of(text[at - 1])]
    while first > max(0, at - CONTEXT) and run.match(text, first - 1, first).end() == first:
        first -= 1
    return text[first - (first > 0 and text[first - 1] == " "):at]


class CountTransducer:
    """The machine for one ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec["pre_tokenizer"], spec["model"]
        if (split["type"], model["type"], spec["normalizer"]) != ("ByteLevel", "BPE", None) or split["add_prefix_space"]:
            raise ValueError(f"{path}: only plain byte-level BPE is compiled")
        letters = byte_letters()
        of = lambda word: bytes(letters[c] for c in word)
        self.strings = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.strings)) or r"(?!)")
        self.order = {(of(a), of(b)): n for n, (a, b) in enumerate(model["merges"])}
        self.parts: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (a, b), n in self.order.items():
            self.parts.setdefault(a + b, (n, a, b))
        self.tokens = {t: t for t in [*map(bytes, zip(range(256))), *self.parts]}
        self.starts = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.counts = Memo(self._piece, 250_000)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self._restart()

    def _restart(self) -> None:
        #: A state: the bytes a token can still reach back to, then (bytes back, last token, count) for
        #: each place where such a token can begin; counts are relative to the count here.
        begin = (b"", 0, None, 0)
        self.states = {begin: 0}
        self.meaning = [begin]
        self.next: dict[int, int] = {}

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Whether the merges leave two neighbouring tokens as they are: undo the later of their last
        merges, step by step, and see whether what touches would have merged before that."""
        a, b, limit = left, right, (len(self.order), 1)
        while True:
            n = self.order.get((a, b))
            if n is not None and (n, 0) < limit:
                return False
            at_a, at_b = (self.parts[x][0] if x in self.parts else -1 for x in (a, b))
            if at_a < 0 and at_b < 0:
                return True
            if at_a > at_b:  # of equal merges the left one comes first
                limit, a = (at_a, 0), self.parts[a][2]
            else:
                limit, b = (at_b, 1), self.parts[b][1]

    def _step(self, state: int, byte: int) -> int:
        """Compile one transition: the next state and the tokens emitted, in one number."""
        reach, *places = self.meaning[state]
        read = reach + bytes([byte])
        for back, before, count in zip(places[::3], places[1::3], places[2::3]):
            token = self.tokens.get(read[len(reach) - back:])
            if token is None:
                continue
            if before is not None:
                key = (before, token)
                if key not in self.fits:
                    self.fits[key] = self._apart(*key)
                if not self.fits[key]:
                    continue
            emitted = count + 1
            break
        start = next(k for k in range(len(read) + 1) if k == len(read) or read[k:] in self.starts)
        kept = []
        for back, before, count in zip(places[::3], places[1::3], places[2::3]):
            if back < len(read) - start and read[len(reach) - back:] in self.starts:
                kept += [back + 1, before, count - emitted]
        return self._state((read[start:], *kept, 0, token, 0)) << 9 | emitted + 256

    def _piece(self, piece: str) -> int:
        """Run the machine over a piece."""
        self._room()
        known, state, count = self.next, 0, 0
        for byte in piece.encode():
            key = state << 8 | byte
            to = known.get(key)
            if to is None:
                to = known[key] = self._step(state, byte)
            state = to >> 9
            count += (to & 511) - 256
        return count

    def _apart_from_special(self, text: str) -> list[str]:
        return self.special.split(text) if any(s in text for s in self.strings) else [text]

    def count(self, text: str) -> int:
        """Tokens of a text, special strings in it among them."""
        parts = self._apart_from_special(text)
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, pieces(part))) for part in parts)

    def _through(self, states: list[int], read: bytes) -> list[tuple[int, int]]:
        """Where each of some states gets to, and the tokens emitted on the way; those that meet go on as one."""
        known = self.next
        ends, live = [(0, 0)] * len(states), {}
        for n, state in enumerate(states):
            live.setdefault(state, (0, []))[1].append((n, 0))
        for byte in read:
            moved: dict[int, tuple[int, list]] = {}
            for state, (count, some) in live.items():
                key = state << 8 | byte
                to = known.get(key)
                if to is None:
                    to = known[key] = self._step(state, byte)
                count += (to & 511) - 256
                there = moved.get(to >> 9)
                if there is None:
                    moved[to >> 9] = count, some
                else:
                    there[1].extend((n, before + count - there[0]) for n, before in some)
            live = moved
        for state, (count, some) in live.items():
            for n, before in some:
                ends[n] = state, count + before
        return ends

    def _room(self) -> None:
        if len(self.next) > TRANSITIONS:
            self._restart()
            self.fits.clear()

    def _state(self, meaning: tuple) -> int:
        """The number of a state given what it means."""
        if meaning not in self.states:
            self.states[meaning] = len(self.meaning)
            self.meaning.append(meaning)
        return self.states[meaning]

    def _entries(self, before: str) -> list[tuple]:
        """States that reading some of the characters before a slice may have led to."""
        found = set()
        for k in range(min(len(before), BEGINNINGS)):
            found.add(self._through([0], before[k:].encode())[0][0])
        return sorted((self.meaning[s] for s in found), key=repr)

    def state_map(self, before: str | None, text: str, goes_on: bool) -> list[dict]:
        """The state map of a slice as :func:`cut` gives it."""
        heads, rest = [("", 0)], text
        self._room()
        if before is not None:
            kind = kind_of(before[-1])
            end, special = RUNS_OF[kind].match(text).end(), self.special.search(text)
            if special and special.start() <= end:
                end = special.start()
            elif kind == "space" and end < len(text):
                end -= 1
            entries = self._entries(before)
            ends = self._through([self._state(e) for e in entries], text[:end].encode())
            if goes_on and end == len(text):
                return [{"enter": repr(e), "leave": repr(self.meaning[state]), "count": count}
                        for e, (state, count) in zip(entries, ends)]
            heads, rest = [(repr(e), count) for e, (_, count) in zip(entries, ends)], text[end:]
        parts = self._apart_from_special(rest)
        found = pieces(parts.pop()) if goes_on else []
        count = len(parts) - (not goes_on) + sum(sum(map(self.counts.__getitem__, pieces(part))) for part in parts)
        leave = ""
        if goes_on:
            *found, last = found
            count += sum(map(self.counts.__getitem__, found))
            self._room()
            state, more = self._through([0], last.encode())[0]
            leave, count = repr(self.meaning[state]), count + more
        return [{"enter": enter, "leave": leave, "count": before + count} for enter, before in heads]


def compose(a: list[dict], b: list[dict]) -> list[dict]:
    """The map of a slice followed by another; states that the latter does not know are left out."""
    on = {x["enter"]: x for x in b}
    return [{"enter": x["enter"], "leave": on[x["leave"]]["leave"], "count": x["count"] + on[x["leave"]]["count"]}
            for x in a if x["leave"] in on]


def total(whole: list[dict]) -> int | None:
    """Tokens of a whole text with this map, if it could be composed."""
    return next((x["count"] for x in whole if (x["enter"], x["leave"]) == ("", "")), None)


def loaded(path: str) -> CountTransducer:
    return held(("token_counts", path), lambda: CountTransducer(path))


def count_tokens(docs: DataFrame, path: str, limit: int, slice_chars: int = SLICE,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) of every whole text.

    Texts of up to ``slice_chars`` characters are counted where they are read; the slices of longer ones are
    dealt out to all tasks.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    short = rows.where(F.length("text") <= slice_chars)
    long = rows.where(F.length("text") > slice_chars).withColumns({"row": F.monotonically_increasing_id(), "digest": F.sha2("text", 256)})

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine, texts = loaded(path), batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                          pa.array(map(machine.count, texts), pa.int64())], ["id", "n_bytes", "n_tokens"])

    counted = map_batches(short, count, f"id {kind}, n_bytes bigint, n_tokens bigint", keeps="token_counts")
    counted = counted.unionByName(_long_texts(long, path, slice_chars, kind))
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _long_texts(long: DataFrame, path: str, slice_chars: int, kind: str) -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``) of texts of several slices, by their state maps."""
    specials = added_strings(path)

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for one in range(batch.num_rows):
            row = batch.slice(one, 1)
            for seq, (before, text, goes_on) in enumerate(cut(row.column("text")[0].as_py(), slice_chars, specials)):
                yield pa.RecordBatch.from_arrays(
                    [row.column("row"), row.column("id"), row.column("digest"), pa.array([seq], pa.int64()),
                     pa.array([before], pa.string()), pa.array([text], pa.string()), pa.array([goes_on])],
                    ["row", "id", "digest", "seq", "before", "text", "goes_on"])

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = loaded(path)
        before, texts, goes_on = (batch.column(c).to_pylist() for c in ("before", "text", "goes_on"))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array([len(t.encode()) for t in texts], pa.int64()),
             pa.array(list(map(machine.state_map, before, texts, goes_on)), MAP_ARROW)],
            ["row", "id", "digest", "seq", "n_bytes", "map"])

    def tree(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        maps = [reduce(compose, (x["map"] for x in group)) for group in batch.column("maps").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(maps, MAP_ARROW)], ["row", "id", "digest", "seq", "n_bytes", "map"])

    def close(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = [total(reduce(compose, (x["map"] for x in group))) for group in batch.column("maps").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:4], pa.array(n, pa.int64())], ["id", "digest", "n_bytes", "n_tokens"])

    def again(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = loaded(path)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(machine.count, batch.column(1).to_pylist()), pa.int64())],
                                         ["digest", "whole"])

    fields = f"row bigint, id {kind}, digest string, seq bigint, n_bytes bigint, map {MAP}"
    parts = map_batches(long.select("row", "id", "digest", "text"), slices,
                        f"row bigint, id {kind}, digest string, seq bigint, before string, text string, goes_on boolean", keeps="token_counts")
    dealt = parts.repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "seq")
    maps = map_batches(dealt, measure, fields, keeps="token_counts")
    together = F.array_sort(F.collect_list(F.struct("seq", "map"))).alias("maps")
    groups = maps.groupBy("row", "id", "digest", F.expr(f"seq div {FAN_IN}").alias("seq")).agg(F.sum("n_bytes").alias("n_bytes"), together)
    maps = map_batches(groups, tree, fields, keeps="token_counts")
    whole = maps.groupBy("row", "id", "digest").agg(F.sum("n_bytes").alias("n_bytes"), together)
    done = written(map_batches(whole, close, f"id {kind}, digest string, n_bytes bigint, n_tokens bigint", keeps="token_counts"), "long-texts")
    missing = done.where("n_tokens is null").select("digest").distinct()
    if not missing.isEmpty():
        texts = long.join(missing, "digest", "left_semi").dropDuplicates(["digest"]).select("digest", "text")
        done = done.join(map_batches(texts, again, "digest string, whole bigint", keeps="token_counts"), "digest", "left").withColumn(
            "n_tokens", F.coalesce("n_tokens", "whole"))
    return done.select("id", "n_bytes", "n_tokens")


def added_strings(path: str) -> list[str]:
    """The tokenizer's special strings."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]
