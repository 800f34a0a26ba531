"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the workflow's rules directly, in the most literal form (left
join + flag filter for the shared-phone rule, ``NOT EXISTS`` anti joins,
``IS NOT DISTINCT FROM`` for NULL-matching keys), not from the Spark plans.
Each statement starts with the fixture views as CTEs.
"""

from __future__ import annotations

from fieldbook.sources.fixtures import fixture_ctes


# Fixed values of the report, written out here so that the oracle shares no list with the engine.
FUNNEL_LEVELS = ["original", "inactive", "duplicate", "missing", "not located", "new"]
EDUCATION_LEVELS = ["1st", "3rd", "4th", "5th", "6th", "7th", "8th", "9th",
                    "10th", "11th", "12th", "PUC", "Diploma", "Degree", "Post Graduate", "Others"]


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _clean(c: str) -> str:
    # trim, then replace the first double space only (no 'g' flag)
    return f"regexp_replace({_trim(c)}, '  ', ' ')"


def _rank(c: str, levels) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(levels, start=1))
    return f"CAST(CASE {c} {whens} ELSE {len(levels) + 1} END AS BIGINT)"


def _in_levels(c: str, levels) -> str:
    listed = ", ".join(f"'{v}'" for v in levels)
    return f"CASE WHEN {c} IN ({listed}) THEN {c} END"


def _first(dict_view: str, key: str, values: list[str]) -> str:
    order = ", ".join(f"{v} NULLS LAST" for v in values)
    cols = ", ".join([key] + values)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ord NULLS LAST, "
            f"{order}) AS rn FROM {dict_view}) WHERE rn = 1")


CTES = fixture_ctes() + f""",
fc_roster AS (SELECT roster_no, phone_number, roster_name, lower(final_status) AS final_status FROM fx_roster),
fc_contact AS (
  SELECT * EXCLUDE (phone_text, data_status),
         CASE WHEN data_status = '' THEN 'existing' ELSE data_status END AS data_status,
         CASE WHEN located = 'yes' THEN 'active' WHEN located = 'no' THEN 'missing' ELSE located END
           AS contact_status,
         try_cast(phone_text AS DOUBLE) AS contact_phone
  FROM fx_contact),
fc_master0 AS (
  SELECT r.roster_no, coalesce(r.phone_number, c.contact_phone) AS phone_number, r.roster_name,
         r.final_status, c.* EXCLUDE (contact_phone)
  FROM fc_roster r FULL JOIN fc_contact c ON r.phone_number = c.contact_phone),
fc_shared AS (
  SELECT phone_number FROM fc_master0
  WHERE data_status = 'existing' AND phone_number IS NOT NULL
  GROUP BY phone_number HAVING count(*) > 1),
fc_master1 AS (
  SELECT m.* FROM fc_master0 m LEFT JOIN (SELECT phone_number AS sp, 'shared' AS flag FROM fc_shared) s
    ON m.phone_number = s.sp
  WHERE s.flag = 'shared' AND m.contact_name = m.roster_name
  UNION ALL
  SELECT m.* FROM fc_master0 m LEFT JOIN (SELECT phone_number AS sp, 'shared' AS flag FROM fc_shared) s
    ON m.phone_number = s.sp
  WHERE s.flag IS NULL),
fc_master2 AS (
  SELECT m.* REPLACE ({_trim('m.contact_name')} AS contact_name), r.member_id
  FROM fc_master1 m LEFT JOIN fx_id_master r
    ON m.phone_number IS NOT DISTINCT FROM r.phone_number
   AND {_trim('m.contact_name')} IS NOT DISTINCT FROM r.contact_name),
dict_business AS ({_first('fx_dictionary', 'business_type', ['business_type_clean'])}),
dict_origin AS ({_first('fx_origin_dictionary', 'origin_city', ['origin_city_clean', 'origin_region_clean'])}),
dict_locality AS ({_first('fx_locality_dictionary', 'locality', ['locality_clean'])}),
dict_education AS ({_first('fx_education_dictionary', 'education_level', ['education_level_clean'])}),
fc_master AS (
  SELECT m.*, d1.business_type_clean, d2.origin_city_clean, d2.origin_region_clean, d4.locality_clean,
         d3.education_level_clean
  FROM (SELECT * REPLACE ({_clean('business_type')} AS business_type, {_clean('origin_city')} AS origin_city,
                          {_clean('locality')} AS locality,
                          {_clean('education_level')} AS education_level) FROM fc_master2) m
  LEFT JOIN dict_locality d4 ON m.locality IS NOT DISTINCT FROM d4.locality
  LEFT JOIN dict_business d1 ON m.business_type IS NOT DISTINCT FROM d1.business_type
  LEFT JOIN dict_origin d2 ON m.origin_city IS NOT DISTINCT FROM d2.origin_city
  LEFT JOIN dict_education d3 ON m.education_level IS NOT DISTINCT FROM d3.education_level),
rp_master AS (
  SELECT * FROM (
    SELECT *, CASE WHEN final_status IS NULL AND start_ts IS NOT NULL THEN 'new'
                   WHEN final_status IS NULL THEN 'missing' ELSE final_status END AS new_final_status
    FROM fc_master) WHERE new_final_status <> 'dropped'),
rp_master_nn AS (
  SELECT * FROM (SELECT *, coalesce(final_status, 'new') AS new_final_status FROM fc_master)
  WHERE new_final_status <> 'dropped'),
rp_active AS (SELECT * FROM rp_master WHERE new_final_status IN ('active', 'new')),
bl_std AS (
  SELECT b.*, d1.business_type_clean AS type_b1_clean, d2.business_type_clean AS type_b2_clean,
         d3.business_type_clean AS type_b3_clean
  FROM (SELECT * REPLACE ({_clean('type_b1')} AS type_b1, {_clean('type_b2')} AS type_b2,
                          {_clean('type_b3')} AS type_b3) FROM fx_baseline) b
  LEFT JOIN dict_business d1 ON b.type_b1 IS NOT DISTINCT FROM d1.business_type
  LEFT JOIN dict_business d2 ON b.type_b2 IS NOT DISTINCT FROM d2.business_type
  LEFT JOIN dict_business d3 ON b.type_b3 IS NOT DISTINCT FROM d3.business_type)"""


def _q(body: str, extra_ctes: str = "") -> str:
    ctes = CTES + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def _funnel(master_view: str) -> str:
    return f"""
fn_counts AS (SELECT new_final_status AS status, count(*) AS n FROM {master_view} GROUP BY 1),
fn_rows AS (
  SELECT status, CASE WHEN status IN ('active', 'new') THEN n ELSE -n END AS cnt FROM fn_counts
  UNION ALL
  SELECT 'original', count(*) FROM fc_roster WHERE final_status IS DISTINCT FROM 'dropped'),
funnel AS (
  SELECT {_in_levels('status', FUNNEL_LEVELS)} AS final_status, CAST(cnt AS BIGINT) AS "count",
         {_rank('status', FUNNEL_LEVELS)} AS status_rank
  FROM fn_rows WHERE status <> 'active')"""


def _histogram(source: str, value: str, group: str, width: float, boundary: float | None,
               limits: tuple[float, float] | None) -> tuple[str, str]:
    """CTEs and the final SELECT of a fixed-width histogram (right-closed bins)."""
    b = width / 2 if boundary is None else boundary
    w = float(width)
    if limits is None:
        vals = f"SELECT {group} AS g, CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL"
        rng = "SELECT min(x) AS lo, max(x) AS hi FROM h_vals"
    else:
        lo, hi = float(limits[0]), float(limits[1])
        vals = (f"SELECT {group} AS g, CAST({value} AS DOUBLE) AS x FROM {source} "
                f"WHERE {value} IS NOT NULL AND {value} BETWEEN {lo} AND {hi}")
        rng = f"SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi"
    ctes = f"""
h_vals AS ({vals}),
h_rng AS ({rng}),
h_lay AS (SELECT CAST({b} AS DOUBLE) + floor((lo - CAST({b} AS DOUBLE)) / {w}) * {w} AS origin, hi FROM h_rng),
h_lay2 AS (SELECT origin, greatest(1, CAST(floor((hi - origin) / {w} + 1 - 1e-8) AS BIGINT)) AS nb FROM h_lay),
h_cells AS (
  SELECT g, CAST(greatest(least(ceil((x - origin) / {w} - 1e-8) - 1, nb - 1), 0) AS BIGINT) AS bin, 1 AS wt
  FROM h_vals, h_lay2
  UNION ALL
  SELECT g, CAST(unnest(range(0, nb)) AS BIGINT) AS bin, 0 AS wt FROM (SELECT DISTINCT g FROM h_vals), h_lay2)"""
    body = (f"SELECT g AS {group}, bin, origin + CAST(bin AS DOUBLE) * {w} AS xmin, "
            f"origin + CAST(bin AS DOUBLE) * {w} + {w} AS xmax, CAST(sum(wt) AS BIGINT) AS \"count\" "
            f"FROM h_cells, h_lay2 GROUP BY g, bin, origin")
    return ctes, body


def _finance_long(period: str) -> str:
    src = f"(SELECT * FROM rp_active WHERE {period}_expenses IS NOT NULL)"
    parts = [f"SELECT '{period}_{m}' AS variable, {period}_{m} AS metric FROM {src}"
             for m in ("income", "expenses", "profits")]
    return "\nfin_long AS (" + " UNION ALL ".join(parts) + ")"


def _finance_hist(period: str, width: float, limits) -> str:
    ctes, body = _histogram("fin_long", "metric", "variable", width, None, limits)
    return _q(body, _finance_long(period) + "," + ctes)


def _age_hist() -> str:
    ctes, body = _histogram("(SELECT * FROM rp_active WHERE age IS NOT NULL)", "age", "gender", 5, 0, None)
    return _q(body, ctes)


_ROLLUP_COLS = ", ".join(
    [f"type_{b}_clean AS {b}_type, {b}_total_rev, {b}_total_exp, {b}_total_prof, time_share_{b} AS {b}_months"
     for b in ("b1", "b2", "b3")])


def _sum0(measure: str) -> str:
    return " + ".join(f"coalesce({b}_total_{measure}, 0.0)" for b in ("b1", "b2", "b3"))


# The exports' declared columns.
# The declared columns of the two exports, written out here as well.
_PARTNER = ", ".join([
    "member_id", "start_ts", "end_ts", "username", "enumerator_name", "contact_name", "data_status", "located",
    "gender", "age", "photograph", "photograph_url", "shop_name", "shop_location", "shop_latitude",
    "shop_longitude", "shop_altitude", "shop_precision", "locality", "business_photograph",
    "business_photograph_url", "ownership", "business_type", "business_details", "facility_type",
    "facility_type_other", "working_days", "daily_income", "daily_expenses", "daily_profits", "monthly_income",
    "monthly_expenses", "monthly_profits", "smartphone_access", "smartphone_usability", "bank_account",
    "digital_payments", "total_employees", "total_family_employees", "household_details", "family_size",
    "total_children", "total_earning_members", "education_level", "origin_city", "other_details", "submission_no",
    "uuid", "submission_time", "validation_status", "notes", "form_status", "submitted_by", "form_version", "tags",
    "form_index", "contact_status", "business_type_clean", "origin_city_clean", "origin_region_clean",
    "locality_clean", "education_level_clean"])
_OPS = ", ".join([
    "member_id", "enumerator_name", "contact_name", "phone_number", "data_status", "located", "gender", "age",
    "photograph", "shop_location", "locality", "business_photograph", "ownership", "business_type",
    "business_details", "facility_type", "working_days", "daily_income", "daily_expenses", "daily_profits",
    "monthly_income", "monthly_expenses", "monthly_profits", "smartphone_access", "smartphone_usability",
    "bank_account", "digital_payments", "total_employees", "total_family_employees", "household_details",
    "family_size", "total_children", "total_earning_members", "education_level", "origin_city", "other_details",
    "form_index"])


def _feedback(view: str, key: str, values: list[str]) -> str:
    cols = ", ".join([key, *values])
    return f"""
SELECT min(ord) AS ord, {cols} FROM (
  SELECT ord, {cols} FROM {view}
  UNION ALL
  SELECT DISTINCT (SELECT coalesce(max(ord) + 1, 0) FROM {view}), {cols} FROM fc_master WHERE {values[0]} IS NULL)
WHERE {key} <> '' GROUP BY {cols}"""


def _printed(number: str) -> str:
    return f"coalesce(regexp_replace(CAST({number} AS VARCHAR), '\\.0$', ''), 'NA')"


def _access_labels() -> str:
    shares = [("bank_account", "bank_account", "'yes'", "have a bank account"),
              ("digital_payments", "digital_payments", "'yes'", "use digital payments"),
              ("smartphone_access", "smartphone_access", "'yes', 'shared'", "have access to smartphones"),
              ("smartphone_usability", "smartphone_usability", "'yes'", "can use smartphones"),
              ("shared_smartphone", "smartphone_access", "'shared'", "use shared smartphones")]
    columns = []
    for name, column, values, text in shares:
        share = f"round_even(count(*) FILTER ({column} IN ({values})) / count({column}) * 100.0, 1)"
        columns.append(f"{_printed(share)} || '% of all members {text}.' AS label_{name}")
    return _q("SELECT " + ", ".join(columns) + " FROM rp_active")


def _finance_labels(period: str) -> str:
    columns = [f"'{text}: Rs.  ' || {_printed(f'round_even(avg({period}_{m}), 2)')} AS label_{period}_{m}"
               for m, text in (("income", "Mean Revenue"), ("expenses", "Mean Expense"), ("profits", "Mean Profit"))]
    return _q("SELECT " + ", ".join(columns) + f" FROM rp_active WHERE {period}_expenses IS NOT NULL")


def oracle_sql() -> dict[str, str]:
    pairs_bl = " UNION ALL ".join(
        f"SELECT (SELECT coalesce(max(ord) + 1, 0) FROM fx_dictionary), type_{b}, type_{b}_clean FROM bl_std "
        f"WHERE type_{b}_clean IS NOT NULL"
        for b in ("b1", "b2", "b3"))
    return {
        "load_submissions": _q("SELECT * FROM fx_contact"),
        "load_submissions_json": _q("SELECT * FROM fx_contact"),
        "ingest_latest": _q("""
SELECT * EXCLUDE (notes, age, rn), CASE WHEN form_index % 9 = 0 THEN 'edited, again' ELSE notes END AS notes,
       CASE WHEN form_index % 18 = 0 THEN age + 1 ELSE age END AS age
FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY submission_time DESC, form_index DESC) AS rn FROM fx_contact)
WHERE rn = 1"""),
        "build_master": _q("SELECT * FROM fc_master0"),
        "duplicate_keys": _q(
            "SELECT contact_phone AS phone_number, 'duplicate' AS flag FROM fc_contact "
            "WHERE contact_phone IS NOT NULL GROUP BY contact_phone HAVING count(*) > 1"),
        "resolve_shared_keys": _q("SELECT * FROM fc_master1"),
        "resolve_hot_phone": _q("""
SELECT * FROM hp_master WHERE phone_number NOT IN (SELECT phone_number FROM hp_shared)
UNION ALL
SELECT * FROM hp_master WHERE phone_number IN (SELECT phone_number FROM hp_shared) AND contact_name = roster_name""", """
hp_contact AS (
  SELECT submission_no, contact_name, CASE WHEN data_status = '' THEN 'existing' ELSE data_status END AS data_status,
         located, 'active' AS contact_status, CAST(phone_text AS DOUBLE) AS contact_phone FROM fx_hot_contact),
hp_master AS (
  SELECT r.roster_no, coalesce(r.phone_number, c.contact_phone) AS phone_number, r.roster_name,
         lower(r.final_status) AS final_status, c.* EXCLUDE (contact_phone)
  FROM fx_hot_roster r FULL JOIN hp_contact c ON r.phone_number = c.contact_phone),
hp_shared AS (
  SELECT phone_number FROM hp_master WHERE data_status = 'existing' GROUP BY phone_number HAVING count(*) > 1)"""),
        "shared_key_rejects": _q("""
SELECT 'roster' AS side, r.phone_number, r.roster_name AS name, CAST(r.roster_no AS VARCHAR) AS record_id
FROM fc_roster r
WHERE r.phone_number IN (SELECT phone_number FROM fc_shared)
  AND NOT EXISTS (SELECT 1 FROM fc_contact c WHERE c.contact_phone = r.phone_number AND c.contact_name = r.roster_name)
UNION ALL
SELECT 'contact', c.contact_phone, c.contact_name, CAST(c.submission_no AS VARCHAR)
FROM fc_contact c
WHERE c.contact_phone IN (SELECT phone_number FROM fc_shared)
  AND NOT EXISTS (SELECT 1 FROM fc_roster r WHERE c.contact_phone = r.phone_number AND c.contact_name = r.roster_name)"""),
        "assign_ids": _q("SELECT * FROM fc_master2"),
        "refresh_registry": _q(
            "SELECT DISTINCT phone_number, contact_name, member_id FROM fc_master2 WHERE contact_status = 'active'"),
        "standardize": _q("""
SELECT c.*, d1.business_type_clean, d2.origin_city_clean, d2.origin_region_clean, d4.locality_clean,
       d3.education_level_clean
FROM (SELECT * REPLACE ({b} AS business_type, {o} AS origin_city, {l} AS locality, {e} AS education_level)
      FROM fx_contact) c
LEFT JOIN dict_locality d4 ON c.locality IS NOT DISTINCT FROM d4.locality
LEFT JOIN dict_business d1 ON c.business_type IS NOT DISTINCT FROM d1.business_type
LEFT JOIN dict_origin d2 ON c.origin_city IS NOT DISTINCT FROM d2.origin_city
LEFT JOIN dict_education d3 ON c.education_level IS NOT DISTINCT FROM d3.education_level""".format(
            b=_clean("business_type"), o=_clean("origin_city"), l=_clean("locality"), e=_clean("education_level"))),
        "dictionary_feedback": _q("""
SELECT min(ord) AS ord, business_type, business_type_clean FROM (
  SELECT ord, business_type, business_type_clean FROM fx_dictionary
  UNION ALL
  SELECT DISTINCT (SELECT coalesce(max(ord) + 1, 0) FROM fx_dictionary), business_type, business_type_clean
  FROM fc_master WHERE business_type_clean IS NULL)
WHERE business_type <> '' GROUP BY business_type, business_type_clean"""),
        "dictionary_feedback_origin": _q(_feedback("fx_origin_dictionary", "origin_city",
                                                   ["origin_city_clean", "origin_region_clean"])),
        "dictionary_feedback_locality": _q(_feedback("fx_locality_dictionary", "locality", ["locality_clean"])),
        "dictionary_feedback_education": _q(_feedback("fx_education_dictionary", "education_level",
                                                      ["education_level_clean"])),
        "first_contact_master": _q("SELECT * FROM fc_master"),
        "partner_export": _q(f"SELECT {_PARTNER} FROM fc_master WHERE contact_status = 'active'"),
        "ops_export": _q(f"SELECT {_OPS} FROM fc_master WHERE contact_status = 'active'"),
        "tidy_baseline": _q("""
SELECT member_id, member_name, phone_number, visit_status, type_b1, type_b2, type_b3,
       group_gn69x50_total AS b1_rev_total, group_cj4oj86_total AS b1_exp_total,
       group_wb4eu10_total AS b2_rev_total, group_ub0yl99_total AS b2_exp_total,
       group_ff57r52_total AS b3_rev_total, group_xp4ro84_total AS b3_exp_total
FROM fx_baseline_raw"""),
        "missing_first_contact": _q("""
SELECT b.member_id, b.member_name, b.phone_number FROM fx_baseline b
WHERE b.visit_status IS NULL
  AND NOT EXISTS (SELECT 1 FROM fx_id_master o WHERE o.member_id IS NOT DISTINCT FROM b.member_id)"""),
        "missing_baseline": _q("""
SELECT o.member_id, o.contact_name AS member_name, o.phone_number FROM fx_id_master o
WHERE NOT EXISTS (SELECT 1 FROM fx_baseline b WHERE b.member_id IS NOT DISTINCT FROM o.member_id)"""),
        "match_report": _q("""
SELECT o.phone_number AS fc_phone_number, o.contact_name AS fc_name,
       coalesce(o.member_id, b.member_id) AS member_id,
       b.phone_number AS bl_phone_number, b.member_name AS bl_name,
       CASE WHEN o.phone_number = b.phone_number THEN 'YES' WHEN o.phone_number <> b.phone_number THEN 'NO' END
         AS number_match,
       CASE WHEN o.contact_name = b.member_name THEN 'YES' WHEN o.contact_name <> b.member_name THEN 'NO' END
         AS name_match
FROM fx_id_master o FULL JOIN fx_baseline b ON o.member_id IS NOT DISTINCT FROM b.member_id
WHERE b.visit_status IS NULL"""),
        "match_report_single_ids": _q("""
SELECT o.phone_number AS fc_phone_number, o.contact_name AS fc_name,
       coalesce(o.member_id, b.member_id) AS member_id,
       b.phone_number AS bl_phone_number, b.member_name AS bl_name,
       CASE WHEN o.phone_number = b.phone_number THEN 'YES' WHEN o.phone_number <> b.phone_number THEN 'NO' END
         AS number_match,
       CASE WHEN o.contact_name = b.member_name THEN 'YES' WHEN o.contact_name <> b.member_name THEN 'NO' END
         AS name_match
FROM fx_id_master o FULL JOIN fx_baseline b ON o.member_id = b.member_id
WHERE b.visit_status IS NULL"""),
        "match_report_factored": _q("""
SELECT CASE WHEN o.row IS NOT NULL AND o.member_id IS NULL
              THEN (SELECT count(*) FROM fx_baseline x WHERE x.member_id IS NULL AND x.visit_status IS NULL)
            WHEN b.row IS NOT NULL AND b.member_id IS NULL THEN (SELECT count(*) FROM fx_id_master x WHERE x.member_id IS NULL)
            ELSE 1 END AS n_pairs,
       CASE WHEN o.row IS NOT NULL AND o.member_id IS NULL THEN 'fc' WHEN b.row IS NOT NULL AND b.member_id IS NULL THEN 'bl' END
         AS missing_on,
       o.phone_number AS fc_phone_number, o.contact_name AS fc_name,
       coalesce(o.member_id, b.member_id) AS member_id,
       b.phone_number AS bl_phone_number, b.member_name AS bl_name,
       CASE WHEN o.phone_number = b.phone_number THEN 'YES' WHEN o.phone_number <> b.phone_number THEN 'NO' END
         AS number_match,
       CASE WHEN o.contact_name = b.member_name THEN 'YES' WHEN o.contact_name <> b.member_name THEN 'NO' END
         AS name_match
FROM (SELECT 1 AS row, * FROM fx_id_master) o
FULL JOIN (SELECT 1 AS row, * FROM fx_baseline) b ON o.member_id = b.member_id
WHERE b.visit_status IS NULL"""),
        "match_report_expanded": _q("""
SELECT o.phone_number AS fc_phone_number, o.contact_name AS fc_name,
       coalesce(o.member_id, b.member_id) AS member_id,
       b.phone_number AS bl_phone_number, b.member_name AS bl_name,
       CASE WHEN o.phone_number = b.phone_number THEN 'YES' WHEN o.phone_number <> b.phone_number THEN 'NO' END
         AS number_match,
       CASE WHEN o.contact_name = b.member_name THEN 'YES' WHEN o.contact_name <> b.member_name THEN 'NO' END
         AS name_match
FROM fx_id_master o FULL JOIN fx_baseline b ON o.member_id IS NOT DISTINCT FROM b.member_id
WHERE b.visit_status IS NULL"""),
        "standardize_roles": _q("SELECT * FROM bl_std"),
        "compact_dictionary": _q(f"""
SELECT min(ord) AS ord, business_type, business_type_clean FROM (
  SELECT ord, business_type, business_type_clean FROM fx_dictionary UNION ALL {pairs_bl})
WHERE business_type <> '' GROUP BY business_type, business_type_clean"""),
        "baseline_rollup": _q(f"""
SELECT member_id,
       concat_ws(', ', coalesce(type_b1_clean, 'NA'), coalesce(type_b2_clean, 'NA'), coalesce(type_b3_clean, 'NA'))
         AS all_businesses,
       {_sum0('rev')} AS total_rev, {_sum0('exp')} AS total_exp, {_sum0('prof')} AS total_prof,
       {_ROLLUP_COLS}, enumerator_name, current_loan_count, second_business, third_business,
       house_ownership, house_type, vehicle_type, total_children, total_children_school
FROM bl_std"""),
        "status_funnel": _q("SELECT * FROM funnel", _funnel("rp_master_nn")),
        "status_funnel_start": _q("SELECT * FROM funnel", _funnel("rp_master")),
        "waterfall_bars": _q(f"""
SELECT final_status, "count", status_rank,
       CAST(sum("count") OVER (ORDER BY status_rank NULLS LAST, final_status NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS bar_end,
       CAST(sum("count") OVER (ORDER BY status_rank NULLS LAST, final_status NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - "count" AS BIGINT) AS bar_start
FROM funnel
UNION ALL
SELECT 'Total', CAST(sum("count") AS BIGINT), CAST(coalesce(max(status_rank), 0) + 1 AS BIGINT),
       CAST(sum("count") AS BIGINT), CAST(0 AS BIGINT)
FROM funnel""", _funnel("rp_master")),
        "status_crosstab": _q("""
SELECT final_status AS roster_status, data_status, contact_status, count(*) AS "count"
FROM rp_master_nn GROUP BY ALL"""),
        "status_crosstab_all": _q("""
SELECT final_status AS roster_status, data_status, contact_status, count(*) AS "count"
FROM fc_master GROUP BY ALL"""),
        "status_funnel_given": _q("""
SELECT final_status, CASE WHEN final_status = 'original' THEN 197 ELSE "count" END AS "count", status_rank
FROM funnel""", _funnel("rp_master_nn")),
        "status_type": _q("""
SELECT new_final_status AS final_status, gender, ownership, count(*) AS "count" FROM rp_master
WHERE try_cast(substr(start_ts, 1, 10) AS DATE) < DATE '2024-12-01'
GROUP BY ALL HAVING new_final_status <> 'inactive'"""),
        "key_counts_phone_name": _q(
            'SELECT phone_number, contact_name, count(*) AS "count" FROM fc_master GROUP BY ALL'),
        "key_counts_uuid": _q('SELECT uuid, count(*) AS "count" FROM fc_master GROUP BY ALL'),
        "report_key_counts_phone_name": _q(
            'SELECT phone_number, contact_name, count(*) AS "count" FROM rp_master_nn GROUP BY ALL'),
        "report_key_counts_uuid": _q('SELECT uuid, count(*) AS "count" FROM rp_master_nn GROUP BY ALL'),
        "key_counts_business_type": _q(
            'SELECT business_type_clean, count(*) AS "count" FROM rp_master_nn GROUP BY ALL'),
        "age_histogram": _age_hist(),
        "age_summary": _q("""
SELECT avg(age) AS mean_age, median(age) AS median_age, round_even(avg(age), 2) AS mean_age_r2,
       round_even(median(age), 2) AS median_age_r2
FROM rp_active WHERE age IS NOT NULL"""),
        "facility_panel": _q("""
SELECT *, avg("count") OVER (PARTITION BY facility_type) AS type_mean FROM (
  SELECT facility_type, ownership, count(*) AS "count" FROM rp_active
  WHERE facility_type IS NOT NULL GROUP BY ALL)"""),
        "business_type_counts": _q("""
SELECT business_type_clean, count(*) AS "count" FROM rp_master
WHERE business_type_clean IS NOT NULL GROUP BY ALL"""),
        "composition_means": _q("""
SELECT round_even(avg(total_employees), 1) AS mean_total_employees,
       round_even(avg(total_family_employees), 1) AS mean_total_family_employees
FROM rp_master"""),
        "finance_means_daily": _q("""
SELECT avg(daily_income) AS daily_income_mean, avg(daily_expenses) AS daily_expenses_mean,
       avg(daily_profits) AS daily_profits_mean
FROM rp_active WHERE daily_expenses IS NOT NULL"""),
        "finance_histogram_daily": _finance_hist("daily", 50, (0, 2500)),
        "finance_means_monthly": _q("""
SELECT avg(monthly_income) AS monthly_income_mean, avg(monthly_expenses) AS monthly_expenses_mean,
       avg(monthly_profits) AS monthly_profits_mean
FROM rp_active WHERE monthly_expenses IS NOT NULL"""),
        "finance_histogram_monthly": _finance_hist("monthly", 500, (0, 25000)),
        "finance_medians": _q("""
SELECT median(daily_income) AS median_daily_income, median(daily_expenses) AS median_daily_expenses,
       median(daily_profits) AS median_daily_profits, median(monthly_income) AS median_monthly_income,
       median(monthly_expenses) AS median_monthly_expenses, median(monthly_profits) AS median_monthly_profits
FROM rp_master"""),
        "access_shares": _q("""
SELECT
  round_even(avg(CASE WHEN bank_account IS NOT NULL THEN CASE WHEN bank_account IN ('yes') THEN 1 ELSE 0 END END)
             * 100.0, 1) AS pct_bank_account,
  round_even(avg(CASE WHEN digital_payments IS NOT NULL THEN CASE WHEN digital_payments IN ('yes') THEN 1 ELSE 0 END END)
             * 100.0, 1) AS pct_digital_payments,
  round_even(avg(CASE WHEN smartphone_access IS NOT NULL THEN CASE WHEN smartphone_access IN ('yes', 'shared') THEN 1 ELSE 0 END END)
             * 100.0, 1) AS pct_smartphone_access,
  round_even(avg(CASE WHEN smartphone_usability IS NOT NULL THEN CASE WHEN smartphone_usability IN ('yes') THEN 1 ELSE 0 END END)
             * 100.0, 1) AS pct_smartphone_usability,
  round_even(avg(CASE WHEN smartphone_access IS NOT NULL THEN CASE WHEN smartphone_access IN ('shared') THEN 1 ELSE 0 END END)
             * 100.0, 1) AS pct_shared_smartphone
FROM rp_active"""),
        "access_labels": _access_labels(),
        "finance_labels_daily": _finance_labels("daily"),
        "finance_labels_monthly": _finance_labels("monthly"),
        "household_medians": _q("""
SELECT round_even(median(family_size), 1) AS median_family_size,
       round_even(median(total_children), 1) AS median_total_children,
       round_even(median(total_earning_members), 1) AS median_total_earning_members
FROM rp_master"""),
        "education_counts": _q(f"""
SELECT education_level_clean, count(*) AS "count", {_rank('education_level_clean', EDUCATION_LEVELS)} AS level_rank
FROM rp_master WHERE education_level_clean IS NOT NULL GROUP BY education_level_clean"""),
        "region_counts": _q("""
SELECT origin_region_clean, count(*) AS "count" FROM rp_master
WHERE origin_region_clean IS NOT NULL GROUP BY ALL"""),
        "report_csv_hand_off": _q("SELECT * FROM fc_master"),
        "registry_duplicates": _q(
            'SELECT phone_number, contact_name, count(*) AS "count" FROM fx_id_master GROUP BY ALL HAVING count(*) > 1'),
        "publish_round_trip": _q("SELECT * FROM fc_master"),
    }
