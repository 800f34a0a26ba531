"""Baseline: tidy the export, reconcile with first contact, roll up per person.

    tidy_baseline        drop layout columns, rename form group codes
    missing_* / match    reconciliation lists against the ops export
    standardize_roles    business dictionary applied to the three business slots
    compact_dictionary   dictionary merged with the matched pairs
    baseline_rollup      all businesses as text, NULL-skipping totals
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldbook.operators.dictionary import compact_dictionary, standardize_roles
from fieldbook.operators.rollup import baseline_rollup

ROLES = ("type_b1", "type_b2", "type_b3")


def reviewed_baseline(baseline: DataFrame, dictionary: DataFrame) -> DataFrame:
    return standardize_roles(baseline, dictionary, ROLES)


def baseline_dictionary(baseline: DataFrame, dictionary: DataFrame) -> DataFrame:
    return compact_dictionary(reviewed_baseline(baseline, dictionary), dictionary, ROLES)


def baseline_final(baseline: DataFrame, dictionary: DataFrame) -> DataFrame:
    return baseline_rollup(reviewed_baseline(baseline, dictionary))
