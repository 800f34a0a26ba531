"""Landed JSON submissions: nested records flattened under a declared form.

A form service's JSON holds one record a submission, one a line, or pages of
them (``{"results": [...]}``). Answers lie under the groups of the form,
either flat, with the groups in the key (``"shop/name": "..."``), or as
objects within objects. Pictures are an array of attachments, each naming the
question it answers; places are an array of numbers. Answers are text whatever
their type.

``JsonForm`` declares where each column of the table comes from, and
``flatten`` makes the table from the records in one projection: a JSON parse of
the declared keys only, casts, and look-ups in the two arrays. A record that is
no JSON object, or holds a value that is not of its column's type, fails the
read or is reported beside its text; other keys of a record are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that holds a row as it stands in the file where it does not fit the schema.
BAD_ROW = "_bad_row"

_BROKEN = "_broken"


@dataclass(frozen=True)
class JsonField:
    """One column: ``answer`` at ``path``, the ``url`` of the attachment that answers ``path``, or number
    ``item`` of the ``place`` array at ``path``."""

    name: str
    path: str
    type: T.DataType = T.StringType()
    kind: str = "answer"
    item: int = 0


@dataclass(frozen=True)
class JsonForm:
    """A form's columns in their order. ``nested``: groups are objects, not parts of the keys.

    An attachment is an object with the ``question`` it answers and its ``url``, under these keys.
    """

    fields: tuple[JsonField, ...]
    nested: bool = False
    attachments: str = "_attachments"
    question: str = "question_xpath"
    url: str = "download_url"

    def _keys(self, path: str) -> tuple[str, ...]:
        return tuple(path.split("/")) if self.nested else (path,)

    def record_type(self) -> T.StructType:
        """The declared part of a record, answers as text."""
        tree: dict = {}
        for f in self.fields:
            if f.kind == "url":
                entry = T.StructType([T.StructField(k, T.StringType()) for k in (self.question, self.url)])
                tree[self.attachments] = T.ArrayType(entry)
                continue
            *groups, last = self._keys(f.path)
            here = tree
            for g in groups:
                here = here.setdefault(g, {})
            here[last] = T.ArrayType(T.StringType()) if f.kind == "place" else T.StringType()

        def built(node: dict) -> T.StructType:
            return T.StructType([T.StructField(k, built(v) if isinstance(v, dict) else v) for k, v in node.items()])

        return built(tree)

    def text_of(self, field: JsonField, record: Column) -> Column:
        """A column's value as the record has it, as text."""
        if field.kind == "url":
            hit = F.filter(record[self.attachments], lambda a: a[self.question] == field.path)
            return F.get(hit, F.lit(0))[self.url]
        for key in self._keys(field.path):
            record = record[key]
        return F.get(record, F.lit(field.item)) if field.kind == "place" else record

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])


def records(texts: DataFrame, column: str = "value") -> DataFrame:
    """One record a row (``value``) from texts that hold a record or a page of records each; blank ones are none."""
    value = F.col(column)
    page = F.from_json(value, "results array<string>")["results"]
    each = F.explode(F.when(page.isNotNull(), page).otherwise(F.array(value)))
    return texts.filter(F.trim(value) != "").select(*[c for c in texts.columns if c != column], each.alias("value"))


def flatten(rows: DataFrame, form: JsonForm, bad_rows: str = "fail", blank_as_null: bool = False,
            keep: Sequence[str] = ()) -> DataFrame:
    """The form's table from rows of (``value``), one record each; ``keep`` names other columns to keep."""
    if bad_rows not in ("fail", "report"):
        raise ValueError(f"bad_rows is 'fail' or 'report', not {bad_rows!r}")
    read = T.StructType([*form.record_type().fields, T.StructField(_BROKEN, T.StringType())])
    parsed = rows.select(*keep, "value", F.from_json("value", read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}).alias("_r"))
    record = F.col("_r")
    cells, misfits = [], [record[_BROKEN].isNotNull()]
    for f in form.fields:
        text = form.text_of(f, record)
        if isinstance(f.type, T.StringType):
            cells.append((F.nullif(text, F.lit("")) if blank_as_null else text).alias(f.name))
            continue
        cell = text.try_cast(f.type)
        misfits.append(text.isNotNull() & (F.trim(text) != "") & cell.isNull())
        cells.append(cell.alias(f.name))
    bad = F.coalesce(F.greatest(*[m.cast("int") for m in misfits]), F.lit(0)) == 1
    if bad_rows == "fail":
        failed = F.raise_error(F.concat(F.lit("Malformed submission: "), F.col("value"))).cast("boolean")
        return parsed.filter(F.when(bad, failed).otherwise(F.lit(True))).select(*keep, *cells)
    return parsed.select(*keep, *cells, F.when(bad, F.col("value")).alias(BAD_ROW))


def to_records(df: DataFrame, form: JsonForm, keep: Sequence[str] = ()) -> DataFrame:
    """(``value``): the rows of a form's table as its JSON records, as the service would send them."""
    tree: dict = {}
    places: dict[str, dict[int, Column]] = {}
    pictures = []
    for f in form.fields:
        text = F.col(f.name).cast("string")
        if f.kind == "url":
            entry = F.struct(F.lit(f.path).alias(form.question), text.alias(form.url))
            pictures.append(F.when(text.isNotNull(), entry))
            continue
        *groups, last = form._keys(f.path)
        here = tree
        for g in groups:
            here = here.setdefault(g, {})
        if f.kind == "place":
            places.setdefault(f.path, {})[f.item] = F.col(f.name)
            items = places[f.path]
            text = F.array(*[items.get(k, F.lit(None).cast("double")) for k in range(max(items) + 1)])
        here[last] = text
    if pictures:
        tree[form.attachments] = F.array_compact(F.array(*pictures))

    def built(node: dict) -> Column:
        return F.struct(*[(built(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return df.select(*keep, F.to_json(built(tree)).alias("value"))
