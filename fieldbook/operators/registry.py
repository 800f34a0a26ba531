"""The member id registry: attach ids, write the next registry version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import trim_all
from fieldbook.operators.joins import null_safe_on


def assign_ids(master: DataFrame, registry: DataFrame, key: str = "phone_number",
               name: str = "contact_name", id_col: str = "member_id") -> DataFrame:
    """Trim the name, then attach the id by (phone, name), NULL matching NULL.

    The registry is joined as it is: a (phone, name) listed twice yields two
    rows, as the lookup has no first-match rule (``key_counts`` on the
    registry finds such keys). Whether the registry is broadcast is left to
    Spark's size statistics and AQE, which also splits a hot key of the
    master (such as many rows without phone and name).
    """
    m = master.withColumn(name, trim_all(name))
    reg = registry.select(F.col(key).alias("_rk"), F.col(name).alias("_rn"), F.col(id_col))
    return m.join(reg, null_safe_on([key, name], ["_rk", "_rn"]), "left").drop("_rk", "_rn")


def refresh_registry(master: DataFrame, registry: DataFrame | None = None,
                     status_col: str = "contact_status", active: str = "active",
                     key: str = "phone_number", name: str = "contact_name",
                     id_col: str = "member_id", keep_existing: bool = False) -> DataFrame:
    """Next registry version: distinct (phone, name, id) of the active rows.

    Rows without an id are listed with a NULL id for a person to fill in. By
    default only active rows survive (the published behaviour); with
    ``keep_existing`` the previous registry rows are kept as well.
    """
    out = master.filter(F.col(status_col) == active).select(key, name, id_col)
    if keep_existing and registry is not None:
        out = out.unionByName(registry.select(key, name, id_col))
    return out.distinct().orderBy(F.col(id_col).asc_nulls_last(), key, name)
