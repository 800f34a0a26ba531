"""First contact: roster + submissions -> the finished master and its exports.

    link_members   roster full-joined to submissions on phone, shared-phone rule
    assign_ids     member id by (phone, trimmed name) from the registry
    standardize    clean values from the business, origin, locality and education dictionaries

The finished master is what the report reads. On a cluster it is published
once (``sources.versioned.publish``) and every panel reads the published
version instead of recomputing the chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.dictionary import Lookup, standardize
from fieldbook.operators.linkage import DEFAULT_COLUMNS, LinkColumns, link_members
from fieldbook.operators.registry import assign_ids

# The declared columns of the two exports, in the order in which they are handed over.
PARTNER_COLUMNS = (
    "member_id", "start_ts", "end_ts", "username", "enumerator_name", "contact_name", "data_status", "located",
    "gender", "age", "photograph", "photograph_url", "shop_name", "shop_location", "shop_latitude", "shop_longitude",
    "shop_altitude", "shop_precision", "locality", "business_photograph", "business_photograph_url", "ownership",
    "business_type", "business_details", "facility_type", "facility_type_other", "working_days", "daily_income",
    "daily_expenses", "daily_profits", "monthly_income", "monthly_expenses", "monthly_profits", "smartphone_access",
    "smartphone_usability", "bank_account", "digital_payments", "total_employees", "total_family_employees",
    "household_details", "family_size", "total_children", "total_earning_members", "education_level", "origin_city",
    "other_details", "submission_no", "uuid", "submission_time", "validation_status", "notes", "form_status",
    "submitted_by", "form_version", "tags", "form_index", "contact_status", "business_type_clean", "origin_city_clean",
    "origin_region_clean", "locality_clean", "education_level_clean",
)

OPS_COLUMNS = (
    "member_id", "enumerator_name", "contact_name", "phone_number", "data_status", "located", "gender", "age",
    "photograph", "shop_location", "locality", "business_photograph", "ownership", "business_type", "business_details",
    "facility_type", "working_days", "daily_income", "daily_expenses", "daily_profits", "monthly_income",
    "monthly_expenses", "monthly_profits", "smartphone_access", "smartphone_usability", "bank_account",
    "digital_payments", "total_employees", "total_family_employees", "household_details", "family_size",
    "total_children", "total_earning_members", "education_level", "origin_city", "other_details", "form_index",
)


def fixture_lookups(fx) -> list[Lookup]:
    """The four dictionaries of the fixture layout."""
    return [
        Lookup("business_type", fx.dictionary),
        Lookup("origin_city", fx.origin_dictionary),
        Lookup("locality", fx.locality_dictionary),
        Lookup("education_level", fx.education_dictionary),
    ]


def finished_master(roster: DataFrame, contact: DataFrame, registry: DataFrame,
                    lookups: Sequence[Lookup], cols: LinkColumns = DEFAULT_COLUMNS,
                    null_means_blank: bool = False) -> DataFrame:
    linked = link_members(roster, contact, cols, null_means_blank)
    with_ids = assign_ids(linked, registry, key=cols.roster_key, name=cols.contact_name)
    return standardize(with_ids, lookups)


def active_export(master: DataFrame, columns: Sequence[str], status_col: str = "contact_status",
                  active: str = "active") -> DataFrame:
    """Active rows, listed columns only (column pruning reaches the scan)."""
    return master.filter(F.col(status_col) == active).select(*columns)


def partner_export(master: DataFrame, columns: Sequence[str] = PARTNER_COLUMNS) -> DataFrame:
    """Export for the partner: active rows, no phone number."""
    return active_export(master, columns)


def ops_export(master: DataFrame, columns: Sequence[str] = OPS_COLUMNS) -> DataFrame:
    """Export for field operations: active rows with the phone number."""
    return active_export(master, columns)
