"""Declared schemas of the survey inputs (fixture layout).

Everything is nullable; numbers are DOUBLE (the only numeric type the survey
relies on), statuses and free text are strings, form timestamps stay ISO
text and are parsed late.
"""

from __future__ import annotations

from pyspark.sql import types as T

from fieldbook.sources.json_forms import JsonField, JsonForm

S, D, L = T.StringType(), T.DoubleType(), T.LongType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The test tables the fixture views read.
CUSTOMER = struct(("c_custkey", L), ("c_name", S), ("c_nationkey", T.IntegerType()), ("c_acctbal", D),
                  ("c_mktsegment", S))
NATION = struct(("n_nationkey", T.IntegerType()), ("n_name", S), ("n_regionkey", T.IntegerType()))
REGION = struct(("r_regionkey", T.IntegerType()), ("r_name", S))
ORDERS = struct(("o_orderkey", L), ("o_custkey", L))
INPUT_TABLES = {"customer": CUSTOMER, "nation": NATION, "region": REGION, "orders": ORDERS}

ROSTER = struct(("roster_no", S), ("phone_number", D), ("roster_name", S), ("final_status", S))

CONTACT = struct(
    ("uuid", S), ("submission_no", S), ("contact_name", S), ("phone_text", S), ("data_status", S),
    ("located", S), ("start_ts", S), ("gender", S), ("age", D), ("ownership", S), ("facility_type", S),
    ("business_type", S), ("daily_income", D), ("daily_expenses", D), ("daily_profits", D),
    ("bank_account", S), ("smartphone_access", S), ("education_level", S), ("family_size", D),
    ("origin_city", S), ("monthly_income", D), ("monthly_expenses", D), ("monthly_profits", D),
    ("digital_payments", S), ("smartphone_usability", S), ("total_employees", D),
    ("total_family_employees", D), ("total_children", D), ("total_earning_members", D),
    ("enumerator_name", S), ("end_ts", S), ("username", S), ("photograph", S), ("photograph_url", S), ("shop_name", S),
    ("shop_location", S), ("shop_latitude", D), ("shop_longitude", D), ("shop_altitude", D), ("shop_precision", D),
    ("locality", S), ("business_photograph", S), ("business_photograph_url", S), ("business_details", S),
    ("facility_type_other", S), ("working_days", S), ("household_details", S), ("other_details", S), ("submission_time", S),
    ("validation_status", S), ("notes", S), ("form_status", S), ("submitted_by", S), ("form_version", S), ("tags", S),
    ("form_index", D),
)

# The same form as the service's JSON has it: answers under their groups, pictures as attachments, the place as an array.
_GROUPS = {
    "person": ("contact_name", "phone_text", "data_status", "located", "gender", "age", "photograph", "education_level",
               "origin_city", "family_size", "total_children", "total_earning_members", "household_details", "other_details"),
    "shop": ("shop_name", "shop_location", "locality", "business_photograph", "ownership", "business_type", "business_details",
             "facility_type", "facility_type_other", "working_days", "total_employees", "total_family_employees"),
    "shop/money": ("daily_income", "daily_expenses", "daily_profits", "monthly_income", "monthly_expenses", "monthly_profits",
                   "bank_account", "digital_payments", "smartphone_access", "smartphone_usability"),
}
_PICTURES = {"photograph_url": "photograph", "business_photograph_url": "business_photograph"}
_PLACE = ("shop_latitude", "shop_longitude", "shop_altitude", "shop_precision")


def contact_form(nested: bool = False) -> JsonForm:
    """Where the columns of ``CONTACT`` lie in a JSON record."""
    group = {name: f"{g}/{name}" for g, names in _GROUPS.items() for name in names}

    def field(f: T.StructField) -> JsonField:
        if f.name in _PICTURES:
            return JsonField(f.name, group[_PICTURES[f.name]], f.dataType, "url")
        if f.name in _PLACE:
            return JsonField(f.name, "_geolocation", f.dataType, "place", _PLACE.index(f.name))
        return JsonField(f.name, group.get(f.name, f"_{f.name}"), f.dataType)

    return JsonForm(tuple(field(f) for f in CONTACT.fields), nested=nested)


REGISTRY = struct(("phone_number", D), ("contact_name", S), ("member_id", S))

BUSINESS_DICTIONARY = struct(("ord", T.IntegerType()), ("business_type", S), ("business_type_clean", S))


def export_header(schema: T.StructType) -> list[str]:
    """Spreadsheet-style header of a schema: ``contact_name`` -> ``Contact Name``."""
    return [f.name.replace("_", " ").title() for f in schema.fields]


def raw_schema(schema: T.StructType) -> T.StructType:
    """The schema under its spreadsheet-style header names."""
    return T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(export_header(schema), schema.fields)])
