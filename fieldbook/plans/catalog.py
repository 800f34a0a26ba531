"""Registered queries: one per job of the survey workflow.

Each entry takes ``(spark, sf_dir)``, builds the fixture views over that
folder's tables and returns the job's result DataFrame (lazy except where a
job must read a small statistic or publish, noted in the job). Names follow
the job functions.
"""

from __future__ import annotations

import os
import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators import linkage, reconcile
from fieldbook.operators.dictionary import dictionary_feedback, standardize
from fieldbook.operators.registry import assign_ids, refresh_registry
from fieldbook.operators.rollup import tidy_baseline
from fieldbook.plans import baseline as bl
from fieldbook.plans import first_contact as fc
from fieldbook.plans import report as rp
from fieldbook.sources import schemas
from fieldbook.sources.fixtures import Fixtures
from fieldbook.sources.json_forms import to_records
from fieldbook.sources.landing import load_submissions, write_export
from fieldbook.sources.versioned import publish, read_current, table_path
from fieldbook.streaming.ingest import ingest_latest, submissions_stream

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def master_of(fx: Fixtures) -> DataFrame:
    """The finished first-contact master of the fixture layout (computed)."""
    return fc.finished_master(fx.roster, fx.contact, fx.id_master, fc.fixture_lookups(fx))


_PUBLISHED: dict[tuple[str, str], DataFrame] = {}
_PUBLISH_LOCK = threading.Lock()


def published_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished master as the report reads it: a published table.

    The first-contact job publishes the master once (a new version under the
    shared folder) and every report panel reads that version, as the report
    reads the master file the first-contact job wrote. Within one session the
    master of an input folder is built and published once.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _PUBLISH_LOCK:
        if key not in _PUBLISHED:
            slug = re.sub(r"[^A-Za-z0-9]+", "_", key[1]).strip("_")
            table = f"first_contact_master/{slug}"
            master = master_of(_fx(spark, sf_dir))
            publish(master, table, by=rp.master_partitions())
            _PUBLISHED[key] = read_current(spark, table, partitions=True)  # a version never changes
        return _PUBLISHED[key]


# -- first contact ---------------------------------------------------------

def q_load_submissions(spark, sf_dir):
    """Land the submissions as a spreadsheet-style CSV export, read it back typed."""
    fx = _fx(spark, sf_dir)
    landing = f"{table_path(spark, 'landing')}/contact-{uuid.uuid4().hex}"
    raw = schemas.raw_schema(schemas.CONTACT)
    write_export(fx.contact.select(*schemas.CONTACT.fieldNames()), landing, raw.fieldNames())
    return load_submissions(spark, landing, raw)


def q_load_submissions_json(spark, sf_dir):
    """Land the submissions as the service's JSON, half as records and half as pages of them, read them back typed."""
    form = schemas.contact_form()
    landing = f"{table_path(spark, 'landing')}/contact-json-{uuid.uuid4().hex}"
    rows = _fx(spark, sf_dir).contact
    single = F.col("form_index") % 2 == 0
    to_records(rows.filter(single), form).write.text(f"{landing}/records")
    paged = rows.filter(~single)
    page = F.floor(F.col("form_index") / 200).alias("page")  # a hundred records to a page
    pages = to_records(paged.withColumn("page", page), form, keep=["page"]).groupBy("page").agg(F.collect_list("value").alias("results"))
    text = F.concat(F.lit('{"count": '), F.size("results"), F.lit(', "results": ['), F.array_join("results", ", "), F.lit("]}"))
    pages.select(text.alias("value")).write.text(f"{landing}/pages")
    return load_submissions(spark, f"{landing}/*", form, fmt="json")


def q_ingest_latest(spark, sf_dir):
    """Three whole exports landed one after the other, the last with edited rows: the latest row of every submission."""
    rows = _fx(spark, sf_dir).contact.select(*schemas.CONTACT.fieldNames())
    run = uuid.uuid4().hex
    landing, table = f"{table_path(spark, 'landing')}/exports-{run}", f"submissions-{run}"
    raw = schemas.raw_schema(schemas.CONTACT)
    edited = rows.withColumns({"notes": F.when(F.col("form_index") % 9 == 0, F.lit("edited, again")).otherwise(F.col("notes")),
                               "age": F.when(F.col("form_index") % 18 == 0, F.col("age") + 1).otherwise(F.col("age"))})
    for k, export in enumerate((rows, rows, edited), start=1):
        write_export(export, f"{landing}/e{k}", raw.fieldNames())
        stream = submissions_stream(spark, f"{landing}/*", raw, landed=True)
        query = ingest_latest(stream, table, "uuid", f"contact-{run}", order=("submission_time", "form_index"))
        query.awaitTermination()
    return read_current(spark, table)


def q_build_master(spark, sf_dir):
    """Roster full-joined to the submissions on phone (K2)."""
    fx = _fx(spark, sf_dir)
    return linkage.build_master(fx.roster, fx.contact)


def q_duplicate_keys(spark, sf_dir):
    """Phones typed on more than one submission, most frequent first (K3)."""
    fx = _fx(spark, sf_dir)
    contact = linkage.prepare_contact(fx.contact)
    return linkage.duplicate_keys(contact, "contact_phone").withColumnRenamed("contact_phone", "phone_number")


def q_resolve_shared_keys(spark, sf_dir):
    """The master with the shared-phone rule applied (K4)."""
    fx = _fx(spark, sf_dir)
    return linkage.link_members(fx.roster, fx.contact)


def q_resolve_hot_phone(spark, sf_dir):
    """The shared-phone rule where one phone holds a third of the submissions (K4)."""
    fx = _fx(spark, sf_dir)
    return linkage.link_members(fx.hot_roster, fx.hot_contact)


def q_shared_key_rejects(spark, sf_dir):
    """Roster rows and submissions the shared-phone rule removed (K4)."""
    fx = _fx(spark, sf_dir)
    return linkage.shared_key_rejects(fx.roster, fx.contact)


def q_assign_ids(spark, sf_dir):
    """Resolved master with member ids from the registry (K5)."""
    fx = _fx(spark, sf_dir)
    return assign_ids(linkage.link_members(fx.roster, fx.contact), fx.id_master)


def q_refresh_registry(spark, sf_dir):
    """Next registry version from the published master (as the first-contact run does)."""
    return refresh_registry(published_master(spark, sf_dir))


def q_standardize(spark, sf_dir):
    """Submissions with clean values from the four dictionaries (K6)."""
    fx = _fx(spark, sf_dir)
    return standardize(fx.contact, fc.fixture_lookups(fx))


def q_dictionary_feedback(spark, sf_dir):
    """Business-type dictionary grown from the published master."""
    fx = _fx(spark, sf_dir)
    return dictionary_feedback(published_master(spark, sf_dir), fx.dictionary, "business_type",
                               "business_type_clean")


def q_dictionary_feedback_origin(spark, sf_dir):
    """Origin dictionary grown from the published master."""
    return dictionary_feedback(published_master(spark, sf_dir), _fx(spark, sf_dir).origin_dictionary, "origin_city",
                               ["origin_city_clean", "origin_region_clean"])


def q_dictionary_feedback_locality(spark, sf_dir):
    """Locality dictionary grown from the published master."""
    return dictionary_feedback(published_master(spark, sf_dir), _fx(spark, sf_dir).locality_dictionary, "locality",
                               "locality_clean")


def q_dictionary_feedback_education(spark, sf_dir):
    """Education dictionary grown from the published master."""
    return dictionary_feedback(published_master(spark, sf_dir), _fx(spark, sf_dir).education_dictionary,
                               "education_level", "education_level_clean")


def q_first_contact_master(spark, sf_dir):
    """The finished first-contact master: link, ids, dictionaries (K2-K6)."""
    return master_of(_fx(spark, sf_dir))


def q_partner_export(spark, sf_dir):
    """Active rows for the partner, without phone (K8)."""
    return fc.partner_export(published_master(spark, sf_dir))


def q_ops_export(spark, sf_dir):
    """Active rows for field operations, with phone (K8)."""
    return fc.ops_export(published_master(spark, sf_dir))


def q_report_csv_hand_off(spark, sf_dir):
    """The finished master handed to the report as CSV and read back with its schema."""
    master = master_of(_fx(spark, sf_dir))
    publish(master, "report_input/first_contact_master", fmt="csv")
    return read_current(spark, "report_input/first_contact_master", schema=master.schema)


def q_registry_duplicates(spark, sf_dir):
    """Registry keys listed more than once (each would duplicate master rows)."""
    keys = rp.master_key_counts(_fx(spark, sf_dir).id_master, ["phone_number", "contact_name"])
    return keys.filter("count > 1")


def q_publish_round_trip(spark, sf_dir):
    """Publish the finished master as a new version, read the current one back."""
    publish(master_of(_fx(spark, sf_dir)), "first_contact_master")
    return read_current(spark, "first_contact_master")


# -- baseline --------------------------------------------------------------

def q_tidy_baseline(spark, sf_dir):
    """Raw baseline without layout columns, group codes renamed (K9)."""
    return tidy_baseline(_fx(spark, sf_dir).baseline_raw)


def q_missing_first_contact(spark, sf_dir):
    """Baseline rows without a first-contact partner (K10)."""
    fx = _fx(spark, sf_dir)
    return reconcile.missing_first_contact(fx.baseline, fx.id_master)


def q_missing_baseline(spark, sf_dir):
    """First-contact rows without a baseline partner (K10)."""
    fx = _fx(spark, sf_dir)
    return reconcile.missing_baseline(fx.id_master, fx.baseline)


def q_match_report(spark, sf_dir):
    """Both surveys side by side on the id with agreement flags (K11)."""
    fx = _fx(spark, sf_dir)
    return reconcile.match_report(fx.id_master, fx.baseline)


def q_match_report_single_ids(spark, sf_dir):
    """Both surveys side by side, rows without an id listed singly (K11)."""
    fx = _fx(spark, sf_dir)
    return reconcile.match_report(fx.id_master, fx.baseline, pair_missing_ids=False)


def q_match_report_factored(spark, sf_dir):
    """Both surveys side by side, rows without an id once with the number of their pairs (K11)."""
    fx = _fx(spark, sf_dir)
    return reconcile.match_report(fx.id_master, fx.baseline, factored=True)


def q_match_report_expanded(spark, sf_dir):
    """The pairs that the factored report stands for (K11)."""
    return reconcile.expand_missing_ids(q_match_report_factored(spark, sf_dir))


def q_standardize_roles(spark, sf_dir):
    """Baseline with the business dictionary applied to three slots (K12)."""
    fx = _fx(spark, sf_dir)
    return bl.reviewed_baseline(fx.baseline, fx.dictionary)


def q_compact_dictionary(spark, sf_dir):
    """Business dictionary merged with the baseline's matched pairs (K13)."""
    fx = _fx(spark, sf_dir)
    return bl.baseline_dictionary(fx.baseline, fx.dictionary)


def q_baseline_rollup(spark, sf_dir):
    """Per-person business text and NULL-skipping totals (K14)."""
    fx = _fx(spark, sf_dir)
    return bl.baseline_final(fx.baseline, fx.dictionary)


# -- report ----------------------------------------------------------------

def q_status_funnel(spark, sf_dir):
    """Status funnel, missing roster status counted as new (K15a)."""
    fx = _fx(spark, sf_dir)
    return rp.status_funnel(published_master(spark, sf_dir), fx.roster, rule="null_is_new")


def q_status_funnel_start(spark, sf_dir):
    """Status funnel with the start-aware status (K15b)."""
    fx = _fx(spark, sf_dir)
    return rp.status_funnel(published_master(spark, sf_dir), fx.roster, rule="start")


def q_waterfall_bars(spark, sf_dir):
    """Bar start/end of the funnel plus a total bar (K16)."""
    fx = _fx(spark, sf_dir)
    return rp.waterfall_bars(rp.status_funnel(published_master(spark, sf_dir), fx.roster, rule="start"))


def _on_master(fn, *args, **kwargs) -> Query:
    """A report panel over the published master."""
    def query(spark, sf_dir):
        return fn(published_master(spark, sf_dir), *args, **kwargs)
    query.__doc__ = fn.__doc__
    return query


QUERIES: dict[str, Query] = {
    "load_submissions": q_load_submissions,
    "load_submissions_json": q_load_submissions_json,
    "ingest_latest": q_ingest_latest,
    "build_master": q_build_master,
    "duplicate_keys": q_duplicate_keys,
    "resolve_shared_keys": q_resolve_shared_keys,
    "resolve_hot_phone": q_resolve_hot_phone,
    "shared_key_rejects": q_shared_key_rejects,
    "assign_ids": q_assign_ids,
    "refresh_registry": q_refresh_registry,
    "standardize": q_standardize,
    "dictionary_feedback": q_dictionary_feedback,
    "dictionary_feedback_origin": q_dictionary_feedback_origin,
    "dictionary_feedback_locality": q_dictionary_feedback_locality,
    "dictionary_feedback_education": q_dictionary_feedback_education,
    "first_contact_master": q_first_contact_master,
    "partner_export": q_partner_export,
    "ops_export": q_ops_export,
    "tidy_baseline": q_tidy_baseline,
    "missing_first_contact": q_missing_first_contact,
    "missing_baseline": q_missing_baseline,
    "match_report": q_match_report,
    "match_report_single_ids": q_match_report_single_ids,
    "match_report_factored": q_match_report_factored,
    "match_report_expanded": q_match_report_expanded,
    "standardize_roles": q_standardize_roles,
    "compact_dictionary": q_compact_dictionary,
    "baseline_rollup": q_baseline_rollup,
    "status_funnel": q_status_funnel,
    "status_funnel_start": q_status_funnel_start,
    "waterfall_bars": q_waterfall_bars,
    "status_crosstab": _on_master(rp.status_crosstab),
    "status_crosstab_all": _on_master(rp.status_crosstab, dropped=True),
    "status_funnel_given": _on_master(rp.status_funnel, rule="null_is_new", original=197),
    "status_type": _on_master(rp.status_type),
    "key_counts_phone_name": _on_master(rp.master_key_counts, ["phone_number", "contact_name"]),
    "key_counts_uuid": _on_master(rp.master_key_counts, ["uuid"]),
    "report_key_counts_phone_name": _on_master(rp.master_key_counts, ["phone_number", "contact_name"], dropped=False),
    "report_key_counts_uuid": _on_master(rp.master_key_counts, ["uuid"], dropped=False),
    "key_counts_business_type": _on_master(rp.master_key_counts, ["business_type_clean"], dropped=False),
    "age_histogram": _on_master(rp.age_histogram),
    "age_summary": _on_master(rp.age_summary),
    "facility_panel": _on_master(rp.facility_panel),
    "business_type_counts": _on_master(rp.category_counts, "business_type_clean"),
    "composition_means": _on_master(rp.composition_means),
    "finance_means_daily": _on_master(rp.finance_means, "daily"),
    "finance_histogram_daily": _on_master(rp.finance_histogram, "daily"),
    "finance_means_monthly": _on_master(rp.finance_means, "monthly"),
    "finance_histogram_monthly": _on_master(rp.finance_histogram, "monthly"),
    "finance_medians": _on_master(rp.finance_medians),
    "access_shares": _on_master(rp.access_shares),
    "access_labels": _on_master(rp.access_labels),
    "finance_labels_daily": _on_master(rp.finance_labels, "daily"),
    "finance_labels_monthly": _on_master(rp.finance_labels, "monthly"),
    "household_medians": _on_master(rp.household_medians),
    "education_counts": _on_master(rp.education_counts),
    "region_counts": _on_master(rp.category_counts, "origin_region_clean"),
    "report_csv_hand_off": q_report_csv_hand_off,
    "registry_duplicates": q_registry_duplicates,
    "publish_round_trip": q_publish_round_trip,
}
