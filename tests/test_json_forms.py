"""Landed JSON submissions: groups, attachments, places, pages, and records that do not fit."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import types as T

from fieldbook.sources import schemas
from fieldbook.sources.json_forms import BAD_ROW, JsonField, JsonForm, to_records
from fieldbook.sources.landing import load_submissions, write_export

FORM = JsonForm((
    JsonField("uuid", "_uuid"), JsonField("Member Name", "person/details/name"), JsonField("age", "person/age", T.DoubleType()),
    JsonField("photo", "person/photo"), JsonField("photo_url", "person/photo", kind="url"),
    JsonField("latitude", "_geolocation", T.DoubleType(), "place", 0), JsonField("longitude", "_geolocation", T.DoubleType(), "place", 1)))

FLAT = {"_uuid": "u1", "person/details/name": 'A "quoted"\nname', "person/age": "41", "person/photo": "a.jpg", "other/answer": [1, {"x": 2}],
        "_attachments": [{"question_xpath": "shop/photo", "download_url": "/b"}, {"question_xpath": "person/photo", "download_url": "/a"}],
        "_geolocation": [12.5, None]}
NESTED = {"_uuid": "u1", "person": {"details": {"name": 'A "quoted"\nname'}, "age": 41, "photo": "a.jpg"}, "_attachments": FLAT["_attachments"],
          "_geolocation": [12.5, None]}
ROW = ("u1", 'A "quoted"\nname', 41.0, "a.jpg", "/a", 12.5, None)


def landed(*lines) -> str:
    path = Path(tempfile.mkdtemp(prefix="fieldbook-test-"), "export.json")
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(path)


def test_flat_and_nested_records(spark):
    df = load_submissions(spark, landed(FLAT, "", {"_uuid": "u2", "person/age": None}), FORM, fmt="json")
    assert df.columns == ["uuid", "member_name", "age", "photo", "photo_url", "latitude", "longitude"]
    assert sorted(map(tuple, df.collect())) == [ROW, ("u2", *[None] * 6)]
    nested = JsonForm(FORM.fields, nested=True)
    assert [tuple(r) for r in load_submissions(spark, landed(NESTED), nested, fmt="json").collect()] == [ROW]


def test_pages_of_records(spark):
    page = {"count": 2, "next": None, "results": [FLAT, {"_uuid": "u2"}]}
    df = load_submissions(spark, landed(page, {"_uuid": "u3"}, {"results": []}), FORM, fmt="json")
    assert sorted(r.uuid for r in df.collect()) == ["u1", "u2", "u3"]
    assert tuple(df.filter("uuid = 'u1'").first()) == ROW


def test_blank_answers_stay_or_go_missing(spark):
    path = landed({"_uuid": "", "person/age": ""})
    assert load_submissions(spark, path, FORM, fmt="json").first().uuid == ""
    assert load_submissions(spark, path, FORM, fmt="json", blank_as_null=True).first().uuid is None


@pytest.mark.parametrize("line", ['{"_uuid": "u1", "person/age": "forty"}', '{"_uuid": "u1", "person/ag', '["u1"]', "17", '{"_uuid": "u1", "_geolocation": ["x"]}'])
def test_a_record_that_does_not_fit_fails_or_is_reported(spark, line):
    path = landed({"_uuid": "u0", "person/age": "3"}, line)
    with pytest.raises(Exception, match="(?i)malformed"):
        load_submissions(spark, path, FORM, fmt="json").count()
    rows = load_submissions(spark, path, FORM, fmt="json", bad_rows="report").collect()
    assert sorted((r.age, r[BAD_ROW]) for r in rows if r[BAD_ROW] is None) == [(3.0, None)]
    assert [r[BAD_ROW] for r in rows if r[BAD_ROW] is not None] == [line]


def test_only_declared_keys_are_parsed_in_one_projection(spark):
    plan = load_submissions(spark, landed(FLAT), FORM, fmt="json").select("uuid")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("nested", [False, True])
def test_json_equals_the_csv_of_the_same_rows(spark, fx_small, nested):
    root, form, raw = tempfile.mkdtemp(prefix="fieldbook-test-"), schemas.contact_form(nested), schemas.raw_schema(schemas.CONTACT)
    contact = fx_small.contact.select(*schemas.CONTACT.fieldNames())
    to_records(contact, form).write.text(f"{root}/json")
    write_export(contact, f"{root}/csv", raw.fieldNames())
    by_json = load_submissions(spark, f"{root}/json", form, fmt="json")
    by_csv = load_submissions(spark, f"{root}/csv", raw)
    assert by_json.schema == by_csv.schema
    assert by_json.exceptAll(by_csv).count() == by_csv.exceptAll(by_json).count() == 0


def test_a_json_export_needs_a_form(spark):
    with pytest.raises(ValueError, match="form"):
        load_submissions(spark, landed(FLAT), fmt="json")
