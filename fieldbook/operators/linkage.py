"""Linking the roster to the form submissions (master build, shared keys).

The master is the full outer join of roster and submissions on the phone
number. Two rules shape it:

* rows without a phone on either side are kept unmatched;
* a phone is *shared* when the master holds more than one ``existing`` row for
  it; on a shared phone only rows whose two names agree survive.

``link_members`` builds the resolved master without first materialising the
per-phone cross product: the shared test is computed from two per-phone
counts, rows on shared phones are joined on (phone, name), and every other
row takes the plain full join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import blank_to, recode, to_number
from fieldbook.operators.joins import full_outer_join, null_salt


@dataclass(frozen=True)
class LinkColumns:
    """Column names of the two inputs (defaults: the fixture layout)."""

    roster_key: str = "phone_number"      # numeric phone on the roster
    roster_name: str = "roster_name"
    roster_status: str = "final_status"
    contact_key_text: str = "phone_text"  # phone as typed in the form
    contact_key: str = "contact_phone"    # phone as a number (derived)
    contact_name: str = "contact_name"
    data_status: str = "data_status"      # '' / 'new' on the form
    located: str = "located"              # 'yes' / 'no' / other
    contact_status: str = "contact_status"  # derived from ``located``
    roster_id: str = "roster_no"
    contact_id: str = "submission_no"


DEFAULT_COLUMNS = LinkColumns()


def prepare_roster(roster: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Lower-case the roster status."""
    return roster.withColumn(cols.roster_status, F.lower(cols.roster_status))


def prepare_contact(contact: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS,
                    null_means_blank: bool = False) -> DataFrame:
    """Normalise the form statuses and turn the phone text into a number.

    * blank data status -> ``existing`` (NULL too when ``null_means_blank``);
    * located ``yes``/``no`` -> ``active``/``missing``, other values kept;
    * phone text -> DOUBLE, NULL when it is not a number.
    """
    derived = {
        cols.data_status: blank_to(cols.data_status, "existing", null_means_blank),
        cols.contact_status: recode(cols.located, {"yes": "active", "no": "missing"}),
        cols.contact_key: to_number(cols.contact_key_text),
    }
    kept = [F.col(c) if c not in derived else derived[c].alias(c)
            for c in contact.columns if c != cols.contact_key_text]
    extra = [e.alias(c) for c, e in derived.items() if c not in contact.columns]
    return contact.select(*kept, *extra)


def _merge_key(df: DataFrame, cols: LinkColumns, drop: tuple[str, ...] = ()) -> DataFrame:
    """One phone column (the roster's name, either side's value); ``drop`` removed."""
    merged = F.coalesce(cols.roster_key, cols.contact_key).alias(cols.roster_key)
    return df.select(*[merged if c == cols.roster_key else F.col(c)
                       for c in df.columns if c != cols.contact_key and c not in drop])


def build_master(roster: DataFrame, contact: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS,
                 null_means_blank: bool = False) -> DataFrame:
    """Roster full-outer-joined to the submissions on phone (no shared-key rule)."""
    r = prepare_roster(roster, cols)
    c = prepare_contact(contact, cols, null_means_blank)
    return _merge_key(full_outer_join(r, c, cols.roster_key, cols.contact_key), cols)


def duplicate_keys(contact: DataFrame, key: str, flag: str = "duplicate",
                   flag_col: str = "flag") -> DataFrame:
    """Keys seen more than once among non-NULL keys, most frequent first.

    The count is a partial (map-side) aggregate, so a hot key costs one row
    per map task in the shuffle.
    """
    return (contact.filter(F.col(key).isNotNull())
            .groupBy(key).count()
            .filter(F.col("count") > 1)
            .orderBy(F.desc("count"), F.asc(key))
            .select(key, F.lit(flag).alias(flag_col)))


def shared_keys(r: DataFrame, c: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Phones with more than one ``existing`` master row, from per-phone counts.

    A phone with ``m`` roster rows and ``e`` existing submissions gives
    ``max(m, 1) * e`` existing master rows, so no join of the raw rows is
    needed: the key columns of both sides are stacked and counted in one
    aggregate (partial counts per map task, one row per phone after it).
    """
    keys = (r.filter(F.col(cols.roster_key).isNotNull())
            .select(F.col(cols.roster_key).alias("_k"), F.lit(1).alias("_r"), F.lit(0).alias("_x"))
            .unionByName(
                c.filter(F.col(cols.contact_key).isNotNull() & (F.col(cols.data_status) == "existing"))
                .select(F.col(cols.contact_key).alias("_k"), F.lit(0).alias("_r"), F.lit(1).alias("_x"))))
    per_key = keys.groupBy("_k").agg(F.sum("_r").alias("_m"), F.sum("_x").alias("_e"))
    return per_key.filter(F.greatest(F.col("_m"), F.lit(1)) * F.col("_e") > 1).select("_k")


def _flag_shared(df: DataFrame, key: str, name: str, shared: DataFrame,
                 flag: str, join_name: str) -> DataFrame:
    """Mark rows (non-NULL keys only) on shared keys and derive the second join key.

    The second key is the name on a shared phone and ``''`` elsewhere, so one
    join on (phone, second key) pairs rows by name on shared phones and by
    phone alone on all others.
    """
    marks = shared.select(F.col("_k"), F.lit(True).alias("_hit"))
    on_shared = F.coalesce(F.col("_hit"), F.lit(False))
    return (df.join(marks, F.col(key) == F.col("_k"), "left")
            .select(*[F.col(c) for c in df.columns], on_shared.alias(flag),
                    F.when(on_shared, F.col(name)).otherwise(F.lit("")).alias(join_name)))


def linked(roster: DataFrame, contact: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS,
           null_means_blank: bool = False) -> DataFrame:
    """Full join on (phone, name-if-shared), with ``_on_shared`` and ``_matched`` of each row.

    The master and the rejects are both filters of it (``members_of``,
    ``rejects_of``), so a run that needs the two writes it once. Rows
    without a phone never match and cannot be shared: they are appended as
    they are, without a shuffle. The shared-phone set joins both sides as
    Spark sees fit: by its measured size AQE broadcasts it, or splits a hot
    phone of the other side.
    """
    r = prepare_roster(roster, cols)
    c = prepare_contact(contact, cols, null_means_blank)
    shared = shared_keys(r, c, cols)
    r_key, c_key = F.col(cols.roster_key), F.col(cols.contact_key)
    r_flagged = _flag_shared(r.filter(r_key.isNotNull()), cols.roster_key, cols.roster_name, shared,
                             "_r_shared", "_r_join")
    c_flagged = _flag_shared(c.filter(c_key.isNotNull()), cols.contact_key, cols.contact_name, shared,
                             "_c_shared", "_c_join")
    joined = (full_outer_join(r_flagged, c_flagged, [cols.roster_key, "_r_join"],
                              [cols.contact_key, "_c_join"])
              .unionByName(r.filter(r_key.isNull()), allowMissingColumns=True)
              .unionByName(c.filter(c_key.isNull()), allowMissingColumns=True))
    return (joined.withColumn("_on_shared", F.coalesce("_r_shared", "_c_shared", F.lit(False)))
            .withColumn("_matched", r_key.isNotNull() & c_key.isNotNull())
            .drop("_r_shared", "_r_join", "_c_shared", "_c_join"))


def members_of(joined: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS) -> DataFrame:
    """The master: on shared phones only pairs with equal names."""
    return _merge_key(joined.filter(~F.col("_on_shared") | F.col("_matched")), cols, drop=("_on_shared", "_matched"))


def rejects_of(joined: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows on shared phones without a partner of the same name."""
    lost = joined.filter(F.col("_on_shared") & ~F.col("_matched"))
    from_roster = F.col(cols.roster_key).isNotNull()
    return lost.select(
        F.when(from_roster, F.lit("roster")).otherwise(F.lit("contact")).alias("side"),
        F.coalesce(cols.roster_key, cols.contact_key).alias("phone_number"),
        F.when(from_roster, F.col(cols.roster_name)).otherwise(F.col(cols.contact_name)).alias("name"),
        F.when(from_roster, F.col(cols.roster_id).cast("string"))
         .otherwise(F.col(cols.contact_id).cast("string")).alias("record_id"))


def _per_phone(r: DataFrame, c: DataFrame, cols: LinkColumns) -> DataFrame:
    """(``_k``, ``_hit``: shared, ``_both``: on both sides) of every phone, from one aggregate of both sides' keys."""
    stacked = r.select(F.col(cols.roster_key).alias("_k"), F.lit(1).alias("_m"), F.lit(0).alias("_n"), F.lit(0).alias("_e"))
    existing = F.col(cols.data_status).eqNullSafe("existing").cast("int")
    stacked = stacked.unionByName(c.select(F.col(cols.contact_key).alias("_k"), F.lit(0).alias("_m"), F.lit(1).alias("_n"),
                                           existing.alias("_e")))
    counts = stacked.filter(F.col("_k").isNotNull()).groupBy("_k").agg(*[F.sum(x).alias(x) for x in ("_m", "_n", "_e")])
    return counts.select("_k", (F.greatest("_m", F.lit(1)) * F.col("_e") > 1).alias("_hit"),
                         ((F.col("_m") > 0) & (F.col("_n") > 0)).alias("_both"))


def link_members(roster: DataFrame, contact: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS,
                 null_means_blank: bool = False) -> DataFrame:
    """The master with the shared-key rule applied.

    Rows of phones that are not shared (and of NULL phones) are the plain full
    join; on shared phones only (roster, submission) pairs with equal names
    are kept. Names are compared as typed (not trimmed). The join never forms
    the per-phone cross product of a shared phone.

    One aggregate per phone says of each row whether its phone is shared and
    whether the other side has it. Rows of shared phones and of phones on both
    sides meet in one inner join on (phone, name if shared); rows whose phone
    is neither go through as they are, without an anti join. Each side is
    shuffled by phone once for both uses. Rows without a phone carry a salt
    (see ``joins.full_outer_join``).
    """
    r = prepare_roster(roster, cols)
    c = prepare_contact(contact, cols, null_means_blank)
    phones = _per_phone(r, c, cols)

    def marked(df: DataFrame, key: str, name: str, salt: str, join_name: str) -> DataFrame:
        salted = df.withColumn(salt, null_salt([key], 1))
        zero = F.lit(0).cast("bigint")
        rows = salted.join(phones.withColumn("_n0", zero), F.col(key).eqNullSafe(F.col("_k")) & (F.col(salt) == F.col("_n0")), "left")
        # a row of an unknown phone has no flags; said by a column of its own side (the salt is never negative),
        # so that both uses of the join stay the same left join and share one shuffle of the rows
        unknown = F.col(salt) < 0
        shared = F.coalesce(F.col("_hit"), unknown)
        return rows.select(*df.columns, shared.alias("_shared"), F.coalesce(F.col("_both"), unknown).alias("_paired"),
                           F.when(shared, F.col(name)).otherwise(F.lit("")).alias(join_name))

    r_marked = marked(r, cols.roster_key, cols.roster_name, "_rn", "_r_join")
    c_marked = marked(c, cols.contact_key, cols.contact_name, "_cn", "_c_join")
    flags = ("_shared", "_paired")
    paired = r_marked.filter("_paired").drop(*flags).join(
        c_marked.filter("_paired").drop(*flags),
        # paired phones are never NULL; == would filter each side by that, apart from its other use
        F.col(cols.roster_key).eqNullSafe(F.col(cols.contact_key)) & (F.col("_r_join") == F.col("_c_join")), "inner")
    parts = [paired, *[df.filter("NOT _shared AND NOT _paired").drop(*flags) for df in (r_marked, c_marked)]]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _merge_key(out.select(*r.columns, *c.columns), cols)


def shared_key_rejects(roster: DataFrame, contact: DataFrame, cols: LinkColumns = DEFAULT_COLUMNS,
                       null_means_blank: bool = False) -> DataFrame:
    """Input rows on shared phones that the shared-key rule removed.

    One row per roster row or submission (``side`` says which) that found no
    partner with the same name on its shared phone; linear in the input, so
    a hot phone does not produce a pair list.
    """
    return rejects_of(linked(roster, contact, cols, null_means_blank), cols)
