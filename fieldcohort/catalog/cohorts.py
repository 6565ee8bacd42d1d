"""Cohort and KPI queries (K).

The test tables are first given the column names of the exports. That text is
plain SQL both engines read; the cohort itself is the DataFrame plan on one
side and a separate SQL statement on the other.
"""

from pyspark.sql import functions as F

from ..functions.bands import band
from ..operators import latest as lt
from ..operators import partials
from ..plans import contacts, dashboards, groups, maternal, nutrition, viral_load
from ..session import cut_lineage, scratch_path
from .aggregates import pct
from .joins import QUARTERS, presence_sql, service_sources
from .registry import AS_OF, Tables, query
from .scalars import due_sql, months_sql

ORDER_DAY = "CAST(o_orderdate AS DATE)"
SHIP_DAY = "CAST(l_shipdate AS DATE)"

INPUTS = {
    # --- nutrition: a child is an order, a visit a line ---
    "screening": f"""SELECT CAST(o_orderkey AS STRING) AS caseid, 'agent' || CAST(o_custkey % 7 AS STRING) || 'x' AS username,
        {ORDER_DAY} AS date_de_depistage, CASE WHEN o_totalprice > 150000 THEN 'yes' ELSE 'no' END AS eligible FROM {{orders}}""",
    "enrolment": f"""SELECT CAST(o_orderkey AS STRING) AS caseid,
          CASE o_orderstatus WHEN 'F' THEN 'MAS' WHEN 'O' THEN 'MAM' END AS manutrition_type,
          CASE WHEN o_orderpriority = '2-HIGH' THEN '---' ELSE CAST({ORDER_DAY} AS STRING) END AS enrollement_date_de_visite,
          CASE WHEN o_orderpriority < '3' THEN CAST({ORDER_DAY} + copy * 30 AS STRING) ELSE '---' END AS date_admission,
          CASE WHEN o_orderstatus = 'F' THEN CAST({ORDER_DAY} + 40 AS STRING) ELSE 'n/a' END AS approval_date,
          CAST({ORDER_DAY} + copy AS STRING) AS opened_date, CAST({ORDER_DAY} - 200 AS STRING) AS date_of_birth,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'inpatient' WHEN '2-HIGH' THEN '---' ELSE 'community' END AS enrrolled_where,
          CASE WHEN o_totalprice > 60000 THEN '---' ELSE CAST({ORDER_DAY} + 300 AS STRING) END AS closed_date,
          CASE WHEN o_totalprice > 300000 THEN 'yes' ELSE '---' END AS has_mamba,
          CASE WHEN o_totalprice < 20000 THEN 'moved' WHEN o_totalprice < 40000 THEN NULL ELSE '---' END AS visit_reason_not_reachable,
          CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS is_enrolled, CAST(o_custkey % 3 AS STRING) AS nbr_visit_succeed
        FROM (SELECT *, 0 AS copy FROM {{orders}} WHERE o_orderpriority <> '5-LOW'
              UNION ALL SELECT *, 5 AS copy FROM {{orders}} WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW') x""",
    "follow_up": f"""SELECT CAST(l_orderkey AS STRING) AS caseid,
          CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
            || CAST(l_suppkey AS STRING) || '-' || CAST(l_quantity AS STRING) AS formid,
          CASE WHEN l_tax = 0.08 THEN '---' ELSE CAST({SHIP_DAY} AS STRING) END AS date_of_visit,
          CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'derniere_visite' WHEN l_returnflag = 'A' AND l_linenumber = 6
            THEN 'suivi_post_exeat' ELSE 'Visite_de_Suivi' END AS type_of_visit,
          CASE WHEN l_quantity = 50 THEN 'abandonne_programme' WHEN l_quantity = 49 THEN 'atteind_poids_projecte'
            WHEN l_quantity = 48 THEN 'pas_atteind_poids' ELSE '---' END AS raison_pour_la_sortie,
          CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS STRING) ELSE '---' END AS mamba_quantity,
          '---' AS last_weight, '' AS last_height, CAST(l_discount AS STRING) AS last_muac,
          CAST(l_quantity AS INT) AS nbr_visit_succeed_suivi,
          CASE WHEN l_returnflag = 'N' THEN 'nurse' ELSE 'agent' || CAST(l_suppkey % 9 AS STRING) END AS username_suivi
        FROM {{lineitem}}""",
    "cases": f"""SELECT CAST(o_orderkey AS STRING) AS caseid, CASE WHEN o_totalprice > 200000 THEN '---' ELSE 'closed' END AS closed_date,
          CASE WHEN o_orderstatus = 'F' THEN {ORDER_DAY} END AS date_enrollement,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'c1' ELSE '---' END AS club_id, 'community' AS enrrolled_where,
          CASE WHEN o_custkey % 2 = 0 THEN '---' ELSE 'yes' END AS is_approve_by_manager FROM {{orders}}""",
    "presence": """SELECT CAST(user_id AS STRING) AS caseid, CAST(event_id AS STRING) AS session_id, CAST(CAST(ts AS DATE) AS STRING) AS session_date,
          CASE WHEN value < 20 THEN '0' WHEN value < 60 THEN '1' ELSE '---' END AS is_member_present, event_type AS member_type,
          'clerk' || CAST(user_id % 4 AS STRING) AS data_clerk, CAST(user_id % 12 AS STRING) AS club_id FROM {events}""",
    "clubs": "SELECT CAST(s_suppkey AS STRING) AS caseid, s_name AS name FROM {supplier}",
    # --- children in care: a patient is a customer, a visit an order ---
    "line_list": f"""SELECT c_custkey AS id, upper(c_name) AS patient_code, c_nationkey AS age, c_mktsegment AS office,
          CASE WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal > 5000 THEN 0 END AS is_abandoned, first_day AS arv_start_date, last_day AS last_viral_load_collection_date,
          CASE WHEN last_price < 200000 THEN 'oui' WHEN last_price < 300000 THEN 'NON' END AS suppressed,
          CASE WHEN c_acctbal > 3000 THEN 'YES' ELSE 'NO' END AS eligibility,
          CASE c_nationkey % 4 WHEN 0 THEN 'club_9_12' WHEN 1 THEN 'club_13_17' ELSE 'not_in_club' END AS club_type
        FROM {{customer}} LEFT JOIN (SELECT o_custkey, MIN({ORDER_DAY}) AS first_day, MAX({ORDER_DAY}) AS last_day, MIN(o_totalprice) * 4 AS last_price
          FROM {{orders}} WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "positives": "SELECT c_custkey AS id_patient FROM {customer} WHERE c_acctbal < 0",
    "regimes": f"""SELECT o_custkey AS id_patient, CASE WHEN o_orderpriority < '3' THEN 'regime_infant_treatment' ELSE 'other' END AS category,
          o_orderpriority AS regime, {ORDER_DAY} AS start_date FROM {{orders}} WHERE o_orderstatus = 'F'""",
    "club_members": "SELECT c_custkey AS id_patient, c_nationkey % 7 AS club_type FROM {customer} WHERE c_mktsegment = 'BUILDING'",
    "infants": """SELECT c_custkey AS id_patient, c_nationkey % 4 AS gender, c_nationkey AS id_hospital,
          DATE '1982-03-31' + CAST(c_custkey % 6000 AS INT) AS dob FROM {customer}""",
    "hospitals": """SELECT n_nationkey AS id_hospital, 'S/' || n_name AS site, r_name AS departement,
          CASE WHEN n_nationkey % 2 = 0 THEN 'CAP' ELSE 'PAP' END AS office FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    "loads": f"""SELECT o_orderkey AS id, o_custkey AS id_patient, {ORDER_DAY} AS date, {ORDER_DAY} + CAST(floor(o_totalprice / 3000) AS INT) AS next_appointment_date,
          CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS took_viral_load_test, {ORDER_DAY} AS viral_load_date,
          CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 100 END AS viral_load_count,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS viral_load_indetectable FROM {{orders}}""",
    "household_child": """SELECT CAST(l_orderkey AS STRING) AS caseid, CASE WHEN l_returnflag = 'R' THEN '3' ELSE '1' END AS infant_relationship,
          CAST(l_quantity AS INT) AS age_in_year, CASE l_linenumber % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' END AS hiv_test,
          CASE WHEN l_tax < 0.03 THEN 'positif' WHEN l_tax < 0.06 THEN 'negatif' WHEN l_tax < 0.07 THEN 'autre' END AS hiv_test_result,
          CASE WHEN l_discount < 0.05 THEN '0' WHEN l_discount < 0.08 THEN '1' END AS is_accepted FROM {lineitem}""",
    "index_children": """SELECT lower(c_name) AS patient_code, o_orderkey AS event_key, o_totalprice AS price FROM {orders}
        JOIN {customer} ON c_custkey = o_custkey WHERE o_orderstatus = 'F'""",
    "additions": "SELECT upper(c_name) AS patient_code FROM {customer} WHERE c_acctbal > 4000",
    # --- mothers: a mother is a customer, a pregnancy an order, a session a line ---
    "mothers": "SELECT c_custkey AS id_patient, c_name AS patient_code, c_nationkey AS id_site FROM {customer}",
    "pregnancies": f"""SELECT o_custkey AS id_patient, o_orderkey AS pregnancy_id, CASE WHEN o_orderstatus <> 'P' THEN {ORDER_DAY} END AS ddr,
          CASE WHEN o_orderpriority < '3' THEN {ORDER_DAY} + 280 END AS dpa,
          CASE WHEN o_totalprice < 150000 THEN {ORDER_DAY} + 270 END AS actual_delivery_date, o_totalprice > 450000 AS terminated,
          {ORDER_DAY} + 30 AS created_at FROM {{orders}}""",
    "mother_infants": f"SELECT o_custkey AS id_patient, o_orderkey AS infant_id, {ORDER_DAY} + 265 AS infant_dob FROM {{orders}}",
    "club_sessions": f"""SELECT o_custkey AS id_patient, {SHIP_DAY} AS session_date, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS is_present
        FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "places": """SELECT c_custkey AS id_patient, n_name AS commune, r_name AS departement FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        JOIN {region} ON r_regionkey = n_regionkey""",
    "specimens": f"""SELECT o_orderkey AS id, o_custkey AS id_patient, {ORDER_DAY} AS date_blood_taken,
          CASE WHEN o_orderstatus <> 'O' THEN {ORDER_DAY} - CAST(floor(o_totalprice / 1000) AS INT) END AS date_of_birth,
          CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 2 END AS pcr_result,
          {ORDER_DAY} + 60 AS pcr_result_date, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 2 END AS which_pcr FROM {{orders}}""",
    "children": "SELECT c_custkey AS id_patient, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS id_patient_mother FROM {customer}",
    "contact_log": f"""SELECT CASE WHEN o_custkey % 4 > 0 THEN o_custkey END AS patient_code, o_orderkey AS event_key, {ORDER_DAY} AS date,
          CASE WHEN o_orderstatus = 'F' THEN 'Oui' ELSE 'Non' END AS found, o_orderpriority AS type FROM {{orders}}""",
    "attendance": f"""SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS patient_code, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS event_key, {SHIP_DAY} AS session_date,
          CASE l_returnflag WHEN 'R' THEN '1- Present' WHEN 'A' THEN '2- Malade' END AS raison_absence
        FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "households": f"SELECT CASE WHEN o_custkey % 5 > 0 THEN o_custkey END AS patient_code, o_orderkey AS event_key, {ORDER_DAY} AS collection_date FROM {{orders}}",
    "cohort": f"SELECT c_custkey AS patient_code, c_mktsegment AS office, DATE '2000-01-15' + CAST(c_custkey % 400 AS INT) AS ddr FROM {{customer}}",
    "annual": f"""SELECT o_custkey AS patient_code, o_orderkey AS pregnancy_id, c_mktsegment AS office, CASE WHEN c_acctbal < -500 THEN 1 END AS is_abandoned,
          CASE WHEN c_acctbal > 9500 THEN 1 ELSE 0 END AS is_dead, CASE WHEN o_orderstatus <> 'P' THEN {ORDER_DAY} END AS ddr,
          CASE WHEN o_orderstatus = 'F' THEN {ORDER_DAY} + 280 END AS dpa, {ORDER_DAY} AS added_at,
          CASE WHEN o_orderpriority < '3' THEN {ORDER_DAY} - 600 END AS delivery_date,
          CASE WHEN o_totalprice > 450000 THEN 1 END AS termination_of_pregnancy FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey""",
    # --- calls, visits and club sessions: a form is an event ---
    "session_rows": """SELECT event_id AS session_id, event_id AS id_club_session, user_id AS id_patient, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'signup' THEN 4 END AS is_present,
          event_id % 2 AS clore, event_id % 3 AS nbre_deparasitaires, event_id % 5 AS nbre_preservatifs, user_id % 3 AS nbre_vit_a, user_id % 4 AS nbre_moustiquaires,
          user_id % 2 AS is_patient_tb, CASE WHEN value > 50 THEN 1 END AS is_patient_on_pf, event_type AS adh FROM {events}""",
    "session_heads": "SELECT event_id AS id_club_session, user_id % 6 AS id_club, ts AS date, user_id % 7 AS topic FROM {events}",
    "club_names": "SELECT s_suppkey AS id_club, s_name AS club_name FROM {supplier}",
    "club_info": "SELECT s_suppkey AS id_club, s_nationkey AS id_hospital, s_suppkey % 4 AS club_type FROM {supplier}",
    "session_hospitals": "SELECT n_nationkey AS id_hospital, n_name AS name, n_regionkey AS city_code, 'H' || CAST(n_nationkey AS STRING) AS hospital_code FROM {nation} WHERE n_nationkey > 3",
    "session_club_types": "SELECT r_regionkey AS club_type, r_name AS name FROM {region} WHERE r_regionkey > 0",
    "session_topics": "SELECT r_regionkey AS topic, r_name AS name FROM {region}",
    "mother_info": """SELECT c_custkey AS id_patient, c_name AS first_name, c_mktsegment AS last_name, 'M' || CAST(c_nationkey AS STRING) AS dob, c_custkey % 2 AS is_abandoned,
          CASE WHEN c_acctbal < 0 THEN 1 END AS is_dead, c_custkey % 3 AS is_graduate, CAST(c_nationkey AS STRING) AS graduation_date FROM {customer} WHERE c_nationkey < 15""",
    "infant_info": """SELECT c_custkey AS id_patient, c_name || ' jr' AS first_name, CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS last_name, 'I' || CAST(c_nationkey AS STRING) AS dob,
          CASE WHEN c_acctbal > 0 THEN 1 END AS is_abandoned, c_custkey % 5 AS is_dead, c_custkey % 4 + 1 AS gender FROM {customer} WHERE c_mktsegment <> 'BUILDING'""",
    "linked": "SELECT c_custkey AS id_patient, c_name AS patient_code, CASE WHEN c_acctbal < 2000 THEN c_nationkey ELSE 0 END AS linked_to_id_patient FROM {customer}",
    "calls": """SELECT event_id AS formid, user_id AS health_id, CASE WHEN event_id % 50 = 0 THEN '---' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS date_appel,
          CASE WHEN value > 80 THEN '---' WHEN value > 20 THEN '1' ELSE '0' END AS is_available, CAST(user_id % 8 AS STRING) || 'agent' AS username
        FROM {events} WHERE event_type IN ('view', 'click')""",
    "visits": """SELECT event_id AS formid, user_id AS patient_code, CAST(CAST(ts AS DATE) AS STRING) AS date_of_visit,
          CASE WHEN value > 30 THEN 1 ELSE 0 END AS is_present, CAST(user_id % 8 AS STRING) || 'agent' AS username
        FROM {events} WHERE event_type IN ('error', 'purchase')""",
    # --- savings groups and gardens: a group is a customer, a member an order ---
    "savings_groups": f"""SELECT c_custkey AS caseid, c_mktsegment AS name, CASE WHEN c_nationkey < 5 THEN 'old' || CAST(c_nationkey AS STRING) ELSE 'agent' END AS username,
          first_day AS creation_date FROM {{customer}} JOIN (SELECT o_custkey, MIN({ORDER_DAY}) AS first_day FROM {{orders}} GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "active_groups": f"""SELECT c_custkey AS caseid FROM {{customer}} JOIN (SELECT o_custkey, MIN({ORDER_DAY}) AS first_day FROM {{orders}} GROUP BY o_custkey) o
        ON o_custkey = c_custkey WHERE c_acctbal > 2000 AND first_day < DATE '1996-01-01'""",
    "members": """SELECT o_orderkey AS caseid, o_custkey AS caseid_group, CASE WHEN o_orderstatus = 'P' THEN '2000-01-01' ELSE '---' END AS removing_date,
          o_orderpriority AS rank FROM {orders}""",
    "officers": "SELECT c_custkey AS caseid_group, 'officer ' || CAST(c_nationkey AS STRING) AS officer_name FROM {customer} WHERE c_nationkey < 20",
    "known_duplicates": "SELECT o_orderkey AS caseid FROM {orders} WHERE o_totalprice > 490000",
    "questionnaires": f"""SELECT l_orderkey AS caseid, l_returnflag AS type_ppi, {SHIP_DAY} AS date_ppi,
          l_partkey * 10 + l_linenumber AS form FROM {{lineitem}}""",
    "gardens": f"""SELECT l_orderkey AS caseid, l_linenumber AS line, l_partkey AS plot, 'agent' || CAST(l_suppkey % 20 AS STRING) AS username,
          ' S' || CAST(l_suppkey AS STRING) || ' - site' AS site_label, l_shipdate AS last_modified_date, l_linestatus = 'F' AS closed,
          CASE WHEN l_tax < 0.05 THEN '---' ELSE '2000-01-01' END AS cycle_4_start_date,
          CASE l_returnflag WHEN 'R' THEN 'nord-ouest' WHEN 'A' THEN 'nord' END AS address_department FROM {{lineitem}}""",
    "site_info": """SELECT 'S' || CAST(s_suppkey AS STRING) AS site, 'open' AS status, CAST(s_nationkey AS STRING) AS network, n_name AS commune,
          n_name AS departement, 'CAP' AS office FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
}


def made(t: Tables, name: str):
    return t.sql(INPUTS[name])


def ctes(*names: str) -> str:
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    parts = []
    for n in names:
        text = INPUTS[n]
        for tb in tables:
            text = text.replace("{" + tb + "}", tb)
        parts.append(f"{n} AS ({text})")
    return "WITH " + ", ".join(parts)


def yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'yes' ELSE 'no' END"


# --- nutrition -----------------------------------------------------------------

USERS = ["1", "5", "6"]
_IN_USERS = "IN ('1', '5', '6')"
SUPPLIED = ("1997-01-01", "1999-12-31")
_SUP = "BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"


def _remaining(n: str) -> str:
    return f"GREATEST(CASE WHEN manutrition_type = 'MAM' AND {n} <= 12 THEN 8 - {n} WHEN manutrition_type = 'MAS' AND {n} <= 18 THEN 12 - {n} ELSE 0 END, 0)::INT"


K01_COLUMNS = [
    "caseid", "total_visits", "first_visit_date", "last_visit_date", "suivi_exists", "user_mamba_suivi", "mamba_disponible_suivi",
    "sortie", "raison_pour_la_sortie", "date_enrollement", "enroled", "visits_remaining", "mamba_remaining", "child_to_be_exited",
    "visit_mamba", "actif",
]


_K01 = (
    ctes("screening", "enrolment", "follow_up")
    + f""", f AS (SELECT *, TRY_CAST(date_of_visit AS DATE) AS d, COALESCE(TRY_CAST(mamba_quantity AS DOUBLE), 0) AS q FROM follow_up),
    s AS (SELECT caseid, COUNT(*) AS total_visits, MIN(d) AS first_visit, MAX(d) AS last_visit,
        COUNT(*) FILTER (type_of_visit = 'derniere_visite') AS derniere, COUNT(*) FILTER (type_of_visit = 'suivi_post_exeat') AS post,
        COUNT(*) FILTER (raison_pour_la_sortie = 'abandonne_programme') AS r1, COUNT(*) FILTER (raison_pour_la_sortie = 'atteind_poids_projecte') AS r2,
        COUNT(*) FILTER (raison_pour_la_sortie = 'pas_atteind_poids') AS r3, COUNT(*) FILTER (q > 0) AS supply,
        arg_max(nbr_visit_succeed_suivi, row(d, formid)) AS done, arg_min(username_suivi, row(d, formid)) AS u
      FROM f WHERE d BETWEEN DATE '1995-06-01' AND DATE '2001-06-30' GROUP BY 1),
    s2 AS (SELECT *, COALESCE(nullif(regexp_extract(u, '[0-9]+'), ''), '2') AS usr FROM s),
    e AS (SELECT *, TRY_CAST(enrollement_date_de_visite AS DATE) AS d1, TRY_CAST(date_admission AS DATE) AS d2, TRY_CAST(approval_date AS DATE) AS appr,
        TRY_CAST(opened_date AS DATE) AS opened FROM enrolment),
    e1 AS (SELECT * FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY caseid ORDER BY opened, d1 NULLS LAST, d2 NULLS LAST) = 1),
    e2 AS (SELECT e1.*, COALESCE(GREATEST(d1, d2), d1, d2) AS de, CASE WHEN enrrolled_where = '---' THEN 'community' ELSE enrrolled_where END AS place,
        nullif(regexp_extract(username, '[0-9]+'), '') AS eu FROM e1 LEFT JOIN screening USING (caseid)),
    itu AS (SELECT caseid FROM e2 WHERE place = 'inpatient' AND caseid NOT IN (SELECT caseid FROM s)),
    appr AS (SELECT caseid FROM e2 WHERE appr BETWEEN DATE '1998-01-01' AND DATE '2000-12-31'
        AND caseid NOT IN (SELECT caseid FROM s) AND caseid NOT IN (SELECT caseid FROM itu)),
    ids AS (SELECT caseid FROM itu UNION ALL SELECT caseid FROM appr UNION ALL SELECT caseid FROM s),
    a AS (SELECT ids.caseid, COALESCE(total_visits, 0) AS total_visits, COALESCE(first_visit, opened) AS fv, COALESCE(last_visit, opened) AS lv,
        {yn('s2.caseid IS NOT NULL AND e2.caseid IS NOT NULL')} AS suivi_exists, COALESCE(usr, eu) AS user_mamba_suivi,
        CASE WHEN s2.caseid IS NOT NULL THEN {yn(f'usr {_IN_USERS} AND last_visit {_SUP}')} ELSE {yn(f'eu {_IN_USERS} AND de {_SUP}')} END AS disp,
        {yn('COALESCE(derniere, 0) <> 0')} AS sortie,
        CASE WHEN r1 > 0 THEN 'abandonne_programme' WHEN r2 > 0 THEN 'atteind_poids_projecte' WHEN r3 > 0 THEN 'pas_atteind_poids' ELSE 'no_info' END AS reason,
        de, closed_date, manutrition_type, COALESCE(done, 0) AS done, COALESCE(supply, 0) AS supply, COALESCE(derniere, 0) AS derniere,
        COALESCE(post, 0) AS post, place, has_mamba, visit_reason_not_reachable AS unreach
      FROM ids LEFT JOIN s2 ON s2.caseid = ids.caseid LEFT JOIN e2 ON e2.caseid = ids.caseid),
    b AS (SELECT *, {_remaining('done')} AS vr, {_remaining('supply')} AS mr, {yn("supply > 0 OR has_mamba = 'yes'")} AS vm FROM a)
    SELECT caseid, total_visits, fv::VARCHAR AS first_visit_date, lv::VARCHAR AS last_visit_date, suivi_exists, user_mamba_suivi,
        disp AS mamba_disponible_suivi, sortie, reason AS raison_pour_la_sortie, de::VARCHAR AS date_enrollement,
        {yn("closed_date = '---' AND de BETWEEN DATE '1996-01-01' AND DATE '2001-12-01' AND disp = 'no'")} AS enroled,
        vr AS visits_remaining, mr AS mamba_remaining, {yn("place IS DISTINCT FROM 'inpatient' AND mr = 0 AND derniere = 0")} AS child_to_be_exited,
        vm AS visit_mamba, {yn('derniere = 0 AND post = 0')} AS actif
    FROM b WHERE NOT (unreach IS DISTINCT FROM '---' AND vm = 'no')"""
)


@query("k01_nutrition_enrolment", _K01)
def k01(t: Tables):
    return nutrition.nutrition_enrolment(
        made(t, "screening"),
        made(t, "follow_up"),
        made(t, "enrolment"),
        visits=("1995-06-01", "2001-06-30"),
        approvals=("1998-01-01", "2000-12-31"),
        enrolled=("1996-01-01", AS_OF),
        supplied_users=USERS,
        supplied=SUPPLIED,
        inpatient="inpatient",
    ).select(*K01_COLUMNS)


@query(
    "k02_waiting_and_unfollowed",
    ctes("screening", "cases")
    + """, c AS (SELECT * FROM cases WHERE caseid IN (SELECT caseid FROM screening WHERE eligible = 'yes')
          AND caseid NOT IN (SELECT CAST(l_orderkey AS STRING) FROM lineitem WHERE l_returnflag = 'N')),
        d AS (SELECT caseid, closed_date = '---' AND date_enrollement IS NULL AND club_id = '---' AND enrrolled_where = 'community'
          AND is_approve_by_manager = '---' AS w FROM c)
        SELECT caseid, CASE WHEN w THEN 'waiting' ELSE 'no_follow_up' END AS list FROM d
        WHERE w OR caseid NOT IN (SELECT CAST(o_orderkey AS STRING) FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def k02(t: Tables):
    visits = t.lineitem.where("l_returnflag = 'N'").select(F.col("l_orderkey").cast("string").alias("caseid"))
    enrolled = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("caseid"))
    out = nutrition.waiting_and_unfollowed(made(t, "screening"), visits, made(t, "cases"), enrolled)
    return out.select("caseid", "list")


CLERKS = {"clerk0": "CAP", "clerk1": "PAP", "clerk2": "GON"}
_IN_CLUB_PERIOD = "CAST(session_date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"


@query(
    "k03_club_attendance_children",
    ctes("presence")
    + f"""SELECT caseid, COUNT(*) AS forms, MIN(session_date) AS first_session_date, MAX(session_date) AS last_session_date,
          SUM(COALESCE(TRY_CAST(is_member_present AS DOUBLE), 1)) AS total_sessions,
          COUNT(*) FILTER (member_type = 'view') AS member_type_view, COUNT(*) FILTER (member_type = 'purchase') AS member_type_purchase,
          MIN(CASE data_clerk WHEN 'clerk0' THEN 'CAP' WHEN 'clerk1' THEN 'PAP' WHEN 'clerk2' THEN 'GON' END) AS office,
          'agent' || MIN(c.c_nationkey) AS username
        FROM presence LEFT JOIN customer c ON CAST(c.c_custkey AS STRING) = caseid WHERE {_IN_CLUB_PERIOD} GROUP BY caseid""",
)
def k03_children(t: Tables):
    agents = t.customer.select(
        F.col("c_custkey").cast("string").alias("caseid"), F.concat(F.lit("agent"), "c_nationkey").alias("username")
    )
    return nutrition.club_attendance_children(
        made(t, "presence"), agents, "2024-01-05", "2024-01-25", CLERKS, ["view", "purchase"]
    )


@query(
    "k03_club_attendance_clubs",
    ctes("presence", "clubs")
    + f"""SELECT club_id, name AS club_name, children, session_days FROM (SELECT club_id, COUNT(DISTINCT caseid) AS children,
          COUNT(DISTINCT session_date) AS session_days FROM presence WHERE {_IN_CLUB_PERIOD} GROUP BY 1) LEFT JOIN clubs ON clubs.caseid = club_id""",
)
def k03_clubs(t: Tables):
    return nutrition.club_attendance_clubs(made(t, "presence"), made(t, "clubs"), "2024-01-05", "2024-01-25")


# --- children in care ----------------------------------------------------------

_LL = ctes("line_list")


def _cascade_sql(since: str, split: bool) -> str:
    nr = "tested AND suppressed IS NULL AND eligibility = 'YES'" if split else "FALSE"
    p = [pct("s0", "s0"), pct("s1", "s0"), pct("s2", "s1"), pct("s3", "s2")]
    return (
        _LL
        + f""", a AS (SELECT *, COALESCE(arv_start_date <= DATE '2001-10-01', FALSE) AS therapy FROM line_list WHERE age BETWEEN 0 AND 18),
        b AS (SELECT *, therapy AND COALESCE(last_viral_load_collection_date >= {since}, FALSE) AS tested FROM a),
        c AS (SELECT *, {nr} AS nr FROM b), d AS (SELECT *, tested AND NOT nr AS covered FROM c),
        e AS (SELECT COUNT(*) AS s0, COUNT(*) FILTER (therapy) AS s1, COUNT(*) FILTER (covered) AS s2,
              COUNT(*) FILTER (covered AND upper(suppressed) = 'OUI') AS s3, COUNT(*) FILTER (nr) AS no_result FROM d)
        SELECT 0 AS step, 'in_care' AS stage, s0 AS n, {p[0]} AS pct_of_previous, s0 - s0 AS not_reached, no_result FROM e
        UNION ALL SELECT 1, 'on_therapy', s1, {p[1]}, s0 - s1, no_result FROM e
        UNION ALL SELECT 2, 'covered', s2, {p[2]}, s1 - s2, no_result FROM e
        UNION ALL SELECT 3, 'suppressed', s3, {p[3]}, s2 - s3, no_result FROM e"""
    )


@query("k04_viral_load_cascade", _cascade_sql("DATE '2000-12-01'", False))
def k04(t: Tables):
    return viral_load.viral_load_cascade(made(t, "line_list"), AS_OF)


@query("k04_cascade_with_no_result", _cascade_sql("DATE '2000-11-01'", True))
def k04_split(t: Tables):
    return viral_load.viral_load_cascade(made(t, "line_list"), AS_OF, split_no_result=True)


_DUE = "CASE WHEN ind = 1 OR cnt < 1000 THEN CAST(vd + INTERVAL 12 MONTH AS DATE) ELSE CAST(vd + INTERVAL 6 MONTH AS DATE) END"
_APPT = months_sql("appt", f"DATE '{AS_OF}'")


@query(
    "k05_pediatric_line_list",
    ctes("positives", "regimes", "club_members", "infants", "hospitals", "loads")
    + f""", people AS (SELECT id_patient FROM positives UNION SELECT id_patient FROM regimes WHERE category = 'regime_infant_treatment'
          UNION SELECT id_patient FROM club_members WHERE club_type <> 1),
        ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY viral_load_date DESC, id DESC) AS rn FROM loads WHERE took_viral_load_test = 1),
        visits AS (SELECT * FROM loads QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY date DESC, id DESC) = 1),
        arv AS (SELECT id_patient, MIN(start_date) AS arv, string_agg(DISTINCT regime, '-' ORDER BY regime) AS regimes,
          string_agg(DISTINCT CAST(start_date AS STRING), ' | ' ORDER BY CAST(start_date AS STRING)) AS starts FROM regimes GROUP BY 1),
        clubs AS (SELECT id_patient, MIN(club_type) AS ct FROM club_members WHERE club_type <> 1 GROUP BY 1),
        j AS (SELECT p.id_patient, h.site, h.office, h.departement, i.gender, i.dob, c.ct, a.viral_load_date AS vd, a.viral_load_count AS cnt,
            a.viral_load_indetectable AS ind, b.viral_load_date AS pvd, b.viral_load_count AS pcnt, arv, arv.regimes, starts, v.date AS fd, v.next_appointment_date AS appt
          FROM people p LEFT JOIN infants i USING (id_patient) LEFT JOIN hospitals h USING (id_hospital)
          LEFT JOIN ranked a ON a.id_patient = p.id_patient AND a.rn = 1 LEFT JOIN ranked b ON b.id_patient = p.id_patient AND b.rn = 2
          LEFT JOIN visits v ON v.id_patient = p.id_patient LEFT JOIN arv ON arv.id_patient = p.id_patient LEFT JOIN clubs c ON c.id_patient = p.id_patient)
        SELECT id_patient, site, office, departement, CASE gender WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE gender::VARCHAR END AS sex,
          ({months_sql('dob', f"DATE '{AS_OF}'")} // 12)::INT AS age,
          CASE ct WHEN 2 THEN 'club_9_12' WHEN 3 THEN 'club_13_17' WHEN 4 THEN 'club_18+' WHEN 5 THEN 'club_3_5' WHEN 6 THEN 'club_6_8' ELSE 'not_in_club' END AS club_type,
          vd::VARCHAR AS viral_load_date, cnt AS viral_load_count, pvd::VARCHAR AS prev_viral_load_date, pcnt AS prev_viral_load_count,
          CASE WHEN ind = 1 OR cnt < 1000 THEN 'OUI' WHEN cnt >= 1000 THEN 'NON' END AS suppressed, ({_DUE})::VARCHAR AS next_viral_load_date,
          CASE WHEN (vd IS NOT NULL AND {_DUE} <= DATE '{AS_OF}') OR (vd IS NULL AND CAST(arv + INTERVAL 6 MONTH AS DATE) <= DATE '{AS_OF}') THEN 'YES' ELSE 'NO' END AS eligibility,
          arv::VARCHAR AS arv_start_date, regimes, starts AS all_arv_start_date, fd::VARCHAR AS last_followup_date, appt::VARCHAR AS next_appointment_date,
          {yn("fd >= DATE '2000-12-01'")} AS seen_in_12_months,
          CASE WHEN appt - fd <= 35 THEN '0-35' WHEN appt - fd <= 89 THEN '36-89' WHEN appt - fd <= 120 THEN '90-120' WHEN appt - fd <= 180 THEN '121-180' WHEN appt - fd > 180 THEN '>180' END AS mms,
          {yn(f"DATE '{AS_OF}' - appt > 30")} AS ltfu_over_30_days, {yn(f'{_APPT} >= 1 AND {_APPT} < 6')} AS ltfu_1_to_6_months,
          {yn(f'{_APPT} >= 6 AND {_APPT} < 12')} AS ltfu_6_to_12_months, {yn(f'{_APPT} >= 6')} AS ltfu_over_6_months, {yn(f'{_APPT} >= 12')} AS ltfu_over_12_months
        FROM j""",
)
def k05(t: Tables):
    return viral_load.pediatric_line_list(
        *[made(t, n) for n in ("positives", "regimes", "club_members", "infants", "loads", "hospitals")], AS_OF
    )


@query(
    "k06_club_membership_gap",
    _LL
    + """SELECT CASE WHEN age BETWEEN 9 AND 17 AND club_type IN ('club_9_12', 'club_13_17') THEN 'in_club' WHEN age BETWEEN 9 AND 17
          THEN 'in_age_not_in_club' ELSE 'out_of_age' END AS club_status, COUNT(*) AS n FROM line_list
        WHERE office NOT IN ('BUILDING') AND age BETWEEN 0 AND 17 AND is_abandoned IS DISTINCT FROM 1 GROUP BY 1""",
)
def k06(t: Tables):
    rows = made(t, "line_list").withColumns({"network": F.lit("none"), "site": F.lit(None).cast("string")})
    care = viral_load.current_in_care(rows, offices=["BUILDING"], networks=["UGP"], sites=["X/Y"], order=[F.col("id").desc()])
    return viral_load.club_membership_gap(care).groupBy("club_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k07_quarter_service_presence",
    f"SELECT p.*, c_name FROM ({presence_sql()}) p JOIN customer USING (c_custkey) WHERE any_q1 = 'yes' OR any_q2 = 'yes'",
)
def k07(t: Tables):
    people = t.customer.select("c_custkey", "c_name")
    return maternal.quarter_service_presence(service_sources(t), "c_custkey", QUARTERS, people)


# --- mothers -------------------------------------------------------------------

_ON = "DATE '2000-06-30'"
_RECENT = "BETWEEN DATE '1998-06-30' AND DATE '2001-03-30'"
_DELIV = "COALESCE(actual_delivery_date, infant_dob)"
_PROB = f"COALESCE(actual_delivery_date, (SELECT MAX(x) FROM unnest([infant_dob, dpa, {due_sql('ddr')}]) u(x)))"


@query(
    "k08_mother_mastersheet",
    ctes("mothers", "pregnancies", "mother_infants", "loads", "club_sessions")
    + f""", base AS (SELECT id_patient FROM pregnancies WHERE dpa {_RECENT} OR {due_sql('ddr')} {_RECENT} OR actual_delivery_date {_RECENT}
          UNION SELECT id_patient FROM mother_infants WHERE infant_dob {_RECENT}),
        p AS (SELECT * FROM pregnancies QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY ddr DESC NULLS LAST, pregnancy_id DESC) = 1),
        i AS (SELECT * FROM mother_infants QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY infant_dob DESC, infant_id DESC) = 1),
        v AS (SELECT * FROM loads QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY date DESC, id DESC) = 1),
        s AS (SELECT id_patient, MAX(session_date) AS cs FROM club_sessions GROUP BY 1),
        j AS (SELECT b.id_patient, m.patient_code, ddr, dpa, actual_delivery_date, terminated, infant_dob, v.date AS fd, cs
          FROM base b LEFT JOIN mothers m USING (id_patient) LEFT JOIN p USING (id_patient) LEFT JOIN i USING (id_patient)
          LEFT JOIN v ON v.id_patient = b.id_patient LEFT JOIN s ON s.id_patient = b.id_patient)
        SELECT id_patient, patient_code, {due_sql('ddr')}::VARCHAR AS dpa_calculated, {_DELIV}::VARCHAR AS delivery_date_merge,
          {_PROB}::VARCHAR AS delivery_probable_date, fd::VARCHAR AS last_followup_date, {yn("cs >= DATE '1999-06-30'")} AS is_actually_in_club,
          CASE WHEN {months_sql('infant_dob', _ON)} < 24 THEN 'yes' WHEN terminated THEN 'no' WHEN {months_sql(_DELIV, _ON)} < 24 THEN 'yes' ELSE 'no' END AS breastfeeding,
          CASE WHEN COALESCE(actual_delivery_date BETWEEN DATE '2000-01-30' AND {_ON}, FALSE) OR COALESCE(terminated, FALSE) THEN 'no'
               WHEN {months_sql('ddr', _ON)} < 9 OR COALESCE(actual_delivery_date, {_PROB}) > {_ON} THEN 'yes' ELSE 'no' END AS pregnant
        FROM j""",
)
def k08(t: Tables):
    followups = made(t, "loads").withColumnRenamed("id", "followup_id")
    out = maternal.mother_mastersheet(
        made(t, "mothers"), made(t, "pregnancies"), made(t, "mother_infants"), followups, made(t, "club_sessions"), "2000-06-30"
    )
    return out.select(
        "id_patient", "patient_code", "dpa_calculated", "delivery_date_merge", "delivery_probable_date", "last_followup_date",
        "is_actually_in_club", "breastfeeding", "pregnant",
    )


_P = "DATE '2000-01-01' AND DATE '2000-03-31'"
_LAST = f"COALESCE(dpa, {due_sql('ddr')})"
_FIRST = "COALESCE(ddr, CAST(dpa - INTERVAL 9 MONTH AS DATE) - 7)"
_OVER = f"COALESCE({_LAST} >= DATE '2000-01-01' AND {_FIRST} <= DATE '2000-03-31', FALSE)"


@query(
    "k09_pregnancy_tracking",
    ctes("pregnancies", "club_sessions", "loads")
    + f""", one AS (SELECT * FROM pregnancies WHERE {_OVER} OR COALESCE(actual_delivery_date BETWEEN {_P}, FALSE) OR created_at BETWEEN {_P}
          QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY ddr DESC NULLS LAST, pregnancy_id DESC) = 1),
        v AS (SELECT one.id_patient, MIN(session_date) AS f, MAX(session_date) AS l FROM one JOIN club_sessions c ON c.id_patient = one.id_patient AND is_present = 1
          AND (session_date BETWEEN ddr AND {due_sql('ddr')} OR session_date BETWEEN CAST(dpa - INTERVAL 9 MONTH AS DATE) - 7 AND dpa) GROUP BY 1),
        l AS (SELECT id_patient, MAX(viral_load_date) AS vd, arg_max(COALESCE(viral_load_count, -1), row(viral_load_date, id)) AS vc, bool_or(viral_load_date BETWEEN {_P}) AS inn FROM loads GROUP BY 1)
        SELECT one.id_patient, pregnancy_id, ddr::VARCHAR AS ddr, dpa::VARCHAR AS dpa, actual_delivery_date::VARCHAR AS actual_delivery_date,
          f::VARCHAR AS first_session, l.l::VARCHAR AS last_session, {yn('f IS NOT NULL')} AS has_session_during_pregnancy, {yn(_OVER)} AS is_pregnant_in_the_interval,
          {yn(f'actual_delivery_date BETWEEN {_P}')} AS has_delivery_in_the_interval, {yn(f"dpa BETWEEN {_P} OR {due_sql('ddr')} BETWEEN {_P}")} AS expected_delivery_in_period,
          {yn(f'created_at BETWEEN {_P}')} AS pregnancy_added_in_the_interval, vd::VARCHAR AS viral_load_date, nullif(vc, -1) AS viral_load_count,
          {yn('inn')} AS has_viral_load_in_the_interval, {yn("CAST(vd + INTERVAL 12 MONTH AS DATE) > DATE '2000-03-31'")} AS has_valid_viral_load
        FROM one LEFT JOIN v l USING (id_patient) LEFT JOIN l ld ON ld.id_patient = one.id_patient""",
)
def k09(t: Tables):
    return maternal.pregnancy_tracking(
        made(t, "pregnancies"), made(t, "club_sessions"), made(t, "loads"), "2000-01-01", "2000-03-31"
    )


@query(
    "k10_current_pregnancies",
    ctes("pregnancies", "club_sessions", "places")
    + f""", s AS (SELECT id_patient, MIN(session_date) AS f, MAX(session_date) AS l FROM club_sessions WHERE is_present = 1
          AND session_date > DATE '1999-05-30' AND session_date <= {_ON} GROUP BY 1)
        SELECT pregnancies.id_patient, pregnancy_id, commune, departement, CAST(ddr + INTERVAL 9 MONTH AS DATE)::VARCHAR AS dpa_calculated, f::VARCHAR AS first_session_in_13_months, l::VARCHAR AS last_session
        FROM pregnancies LEFT JOIN s USING (id_patient) LEFT JOIN places USING (id_patient)
        WHERE ({due_sql('ddr')} > DATE '2000-06-16' OR dpa > DATE '2000-06-16') AND actual_delivery_date IS NULL AND terminated IS DISTINCT FROM TRUE
          AND commune NOT IN ('NATION_3', 'NATION_8') AND departement NOT IN ('EUROPE')""",
)
def k10(t: Tables):
    out = maternal.current_pregnancies(
        made(t, "pregnancies"),
        made(t, "club_sessions"),
        made(t, "places"),
        "2000-06-30",
        without_communes=["NATION_3", "NATION_8"],
        without_departements=["EUROPE"],
    )
    return out.select(
        "id_patient", "pregnancy_id", "commune", "departement", "dpa_calculated", "first_session_in_13_months", "last_session"
    )


_AGE = months_sql("date_of_birth", "date_blood_taken")
_YEAR = "DATE '1999-01-01' AND DATE '1999-12-31'"


@query(
    "k11_pcr_analysis",
    ctes("specimens", "mothers")
    + f"""SELECT id, patient_code, {_AGE} AS age_month, CASE WHEN {_AGE} <= 2 THEN '0-2' WHEN {_AGE} <= 12 THEN '2-12' WHEN {_AGE} > 12 THEN '+12' END AS age_range,
          {yn(f'pcr_result_date BETWEEN {_YEAR}')} AS result_in_the_interval, CASE WHEN pcr_result <> 0 THEN 'with_result' ELSE 'no_result' END AS has_result,
          CASE WHEN pcr_result = 1 THEN 'positif' ELSE 'no_positif' END AS is_positive
        FROM specimens LEFT JOIN mothers USING (id_patient) WHERE which_pcr = 1 AND date_blood_taken BETWEEN {_YEAR}""",
)
def k11(t: Tables):
    return maternal.pcr_analysis(made(t, "specimens"), made(t, "mothers"), "1999-01-01", "1999-12-31")


@query(
    "k12_mother_child_pcr",
    ctes("specimens", "children", "pregnancies")
    + """, n AS (SELECT * FROM specimens WHERE date_blood_taken > DATE '2001-01-01'
          QUALIFY ROW_NUMBER() OVER (PARTITION BY id_patient ORDER BY date_blood_taken DESC, id DESC) = 1)
        SELECT DISTINCT n.id_patient, id_patient_mother, n.id, pcr_result, actual_delivery_date::VARCHAR AS actual_delivery_date
        FROM n JOIN children USING (id_patient) JOIN pregnancies p ON p.id_patient = id_patient_mother
        WHERE actual_delivery_date > DATE '2001-01-01' AND actual_delivery_date < DATE '2001-09-30'""",
)
def k12(t: Tables):
    out = maternal.mother_child_pcr(made(t, "specimens"), made(t, "children"), made(t, "pregnancies"), "2001-01-01", "2001-09-30")
    return out.select("id_patient", "id_patient_mother", "id", "pcr_result", "actual_delivery_date")


# --- sessions, calls and visits --------------------------------------------------

REASONS = {1: "1- Present", 2: "2- Malade", 3: "3- Voyage"}


@query(
    "k13_session_detail",
    ctes("session_rows", "session_heads", "club_names", "linked")
    + """, r AS (SELECT s.session_id, s.id_patient, s.is_present, CAST(h.date AS DATE) AS d, h.id_club, patient_code,
            CASE WHEN linked_to_id_patient > 0 THEN linked_to_id_patient ELSE id_patient END AS person
          FROM session_rows s JOIN session_heads h USING (id_club_session) JOIN linked USING (id_patient) WHERE is_present IS NOT NULL),
        w AS (SELECT *, MIN(d) OVER (PARTITION BY person) AS f1, MAX(d) OVER (PARTITION BY id_patient) AS l1, MIN(d) OVER (PARTITION BY id_patient, id_club) AS f2 FROM r)
        SELECT person, patient_code, club_name, d::VARCHAR AS session_date, f1::VARCHAR AS first_attendance_date, l1::VARCHAR AS last_attendance_date,
          f2::VARCHAR AS first_attendance_date_by_club, is_present, CASE is_present WHEN 1 THEN '1- Present' WHEN 2 THEN '2- Malade' WHEN 3 THEN '3- Voyage' END AS reason, session_id
        FROM w LEFT JOIN club_names USING (id_club) WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def k13(t: Tables):
    return contacts.session_detail(
        made(t, "session_rows"), made(t, "session_heads"), made(t, "club_names"), made(t, "linked"), REASONS, "2024-01-10", "2024-01-20"
    )


_PERSON = ", ".join(f"COALESCE(i.{c}, m.{c}) AS {c}" for c in ("first_name", "last_name", "dob", "is_abandoned", "is_dead"))


@query(
    "k13_session_lines",
    ctes("session_rows", "session_heads", "club_names", "linked", "club_info", "session_hospitals", "session_club_types", "session_topics", "mother_info", "infant_info")
    + f""", r AS (SELECT s.*, CAST(h.date AS DATE) AS d, h.id_club, h.topic, patient_code,
            CASE WHEN linked_to_id_patient > 0 THEN linked_to_id_patient ELSE s.id_patient END AS person
          FROM session_rows s JOIN session_heads h USING (id_club_session) JOIN linked l ON l.id_patient = s.id_patient WHERE is_present IS NOT NULL),
        w AS (SELECT *, MIN(d) OVER (PARTITION BY person) AS f1, MAX(d) OVER (PARTITION BY id_patient) AS l1, MIN(d) OVER (PARTITION BY id_patient, id_club) AS f2 FROM r)
        SELECT person, hs.name AS hospital, hs.city_code || '/' || hs.hospital_code AS site_code, club_name, ct.name AS club_type, patient_code, tp.name AS topic,
          d::VARCHAR AS session_date, f1::VARCHAR AS first_attendance_date, l1::VARCHAR AS last_attendance_date, f2::VARCHAR AS first_attendance_date_by_club,
          {_PERSON}, CASE WHEN m.is_graduate = 1 THEN 'Yes' ELSE 'Non' END AS graduation, m.graduation_date,
          CASE i.gender WHEN 1 THEN 'male' WHEN 2 THEN 'female' WHEN 3 THEN 'unknown' ELSE i.gender::VARCHAR END AS sex, {", ".join(contacts.SERVICES)}, is_present,
          CASE is_present WHEN 1 THEN '1- Present' WHEN 2 THEN '2- Malade' WHEN 3 THEN '3- Voyage' END AS reason, session_id
        FROM w LEFT JOIN club_names USING (id_club) LEFT JOIN club_info ci USING (id_club) LEFT JOIN session_hospitals hs USING (id_hospital) LEFT JOIN session_club_types ct ON ct.club_type = ci.club_type
          LEFT JOIN session_topics tp ON tp.topic = w.topic LEFT JOIN mother_info m ON m.id_patient = person LEFT JOIN infant_info i ON i.id_patient = person
        WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def k13_lines(t: Tables):
    heads = ("session_rows", "session_heads", "club_names", "linked")
    detail = contacts.session_detail(*[made(t, n) for n in heads], REASONS, "2024-01-10", "2024-01-20", keep=["id_club", "topic", *contacts.SERVICES])
    return contacts.session_lines(detail, *[made(t, n) for n in ("club_info", "session_hospitals", "session_club_types", "session_topics", "mother_info", "infant_info")])


@query(
    "k14_mother_club_sessions",
    ctes("mothers", "club_sessions")
    + f""", s AS (SELECT id_patient, MIN(session_date) AS f, MAX(session_date) AS l FROM club_sessions GROUP BY 1)
        SELECT id_patient, patient_code, n_name, f::VARCHAR AS first_date, l::VARCHAR AS last_date, (DATE '{AS_OF}' - l)::INT AS days_since,
          {yn(f"DATE '{AS_OF}' - l <= 365")} AS is_active FROM s JOIN mothers USING (id_patient) JOIN nation ON n_nationkey = id_site""",
)
def k14(t: Tables):
    sites = t.nation.select(F.col("n_nationkey").alias("id_site"), "n_name")
    out = maternal.mother_club_sessions(made(t, "mothers"), made(t, "club_sessions"), sites, AS_OF)
    return out.select("id_patient", "patient_code", "n_name", "first_date", "last_date", "days_since", "is_active")


ZONES = {"1": "Nord", "2": "Ouest", "5": "Nord-Ouest", "6": "Artibonite"}
_LOG = (
    ctes("calls", "visits")
    + """, u AS (SELECT CAST(formid AS STRING) AS formid, CAST(health_id AS STRING) AS patient_code, date_appel AS d, is_available AS f, username, 'PTME' AS program, 'Appel' AS type FROM calls
        UNION ALL SELECT CAST(formid AS STRING), CAST(patient_code AS STRING), date_of_visit, CAST(is_present AS STRING), username, 'OEV', 'Visite' FROM visits),
    log AS (SELECT formid, patient_code, TRY_CAST(d AS DATE) AS date, CASE f WHEN '0' THEN 'Non' WHEN '1' THEN 'Oui' ELSE f END AS found, username, program, type,
        CASE username[1] WHEN '1' THEN 'Nord' WHEN '2' THEN 'Ouest' WHEN '5' THEN 'Nord-Ouest' WHEN '6' THEN 'Artibonite' ELSE 'Autre' END AS commune FROM u
        WHERE TRY_CAST(d AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-28') """
)


def _log(t: Tables):
    feeds = [
        (made(t, "calls"), {"health_id": "patient_code", "date_appel": "date", "is_available": "found"}, "PTME", "Appel"),
        (made(t, "visits"), {"date_of_visit": "date", "is_present": "found"}, "OEV", "Visite"),
    ]
    return contacts.calls_visits(feeds, "2024-01-03", "2024-01-28", ZONES)


@query(
    "k15_calls_visits_clean",
    _LOG
    + """SELECT formid, patient_code, date::VARCHAR AS date, found, username, program, type, commune, monthname(date) AS mois, year(date)::VARCHAR AS annee FROM log WHERE found IN ('Oui', 'Non')""",
)
def k15(t: Tables):
    return contacts.decided(_log(t))


@query("k15_calls_visits_undecided", _LOG + "SELECT formid, patient_code, username FROM log WHERE found = '---'")
def k15_undecided(t: Tables):
    return contacts.undecided(_log(t)).select("formid", "patient_code", "username")


_CLEAN = _LOG + ", c AS (SELECT *, monthname(date) AS mois FROM log WHERE found IN ('Oui', 'Non')) "
_OUI = "COUNT(*) FILTER (found = 'Oui')"


@query(
    "k16_contact_totals",
    _CLEAN
    + f"""SELECT COUNT(*) AS contacts, {_OUI} AS found, COUNT(DISTINCT username) AS agents, COUNT(DISTINCT patient_code) AS people, {pct(_OUI, 'COUNT(*)')} AS pct_found FROM c""",
)
def k16_totals(t: Tables):
    return contacts.contact_totals(contacts.decided(_log(t)))


@query(
    "k16_contacts_by",
    _CLEAN
    + f"""SELECT username, program, type, COUNT(*) AS contacts, {_OUI} AS found, {pct(_OUI, 'COUNT(*)')} AS pct_found FROM c GROUP BY 1, 2, 3""",
)
def k16_by(t: Tables):
    return contacts.contacts_by(contacts.decided(_log(t)), "username", "program", "type")


_COMMUNES = ["Nord", "Ouest", "Artibonite"]


@query(
    "k16_contacts_by_month",
    _CLEAN
    + ", p AS (SELECT COALESCE(mois, 'Total') AS mois, "
    + ", ".join(
        f"COUNT(*) FILTER (commune = '{c}' AND found = '{f}') AS {c.lower().replace('-', '_')}_{f.lower()}" for c in _COMMUNES for f in ("Oui", "Non")
    )
    + ", COUNT(*) FILTER (NOT (commune IN ({0}) AND found IN ('Oui', 'Non'))) AS other".format(", ".join(f"'{c}'" for c in _COMMUNES))
    + f", COUNT(*) AS total, {_OUI} AS total_found FROM c WHERE commune IS NOT NULL AND found IS NOT NULL GROUP BY ROLLUP(mois)) SELECT *, {pct('total_found', 'total', 2)} AS pct_found FROM p",
)
def k16_month(t: Tables):
    return contacts.contacts_by_month(contacts.decided(_log(t)), _COMMUNES)


# --- groups and gardens ----------------------------------------------------------


@query(
    "k17_savings_groups_active",
    ctes("savings_groups", "active_groups", "members", "officers", "known_duplicates", "questionnaires")
    + """, b AS (SELECT * FROM savings_groups WHERE caseid IN (SELECT caseid FROM active_groups)),
        g AS (SELECT * FROM b UNION ALL SELECT * FROM savings_groups WHERE creation_date > (SELECT MAX(creation_date) FROM b)),
        g2 AS (SELECT caseid AS caseid_group, CASE WHEN name = 'BUILDING' THEN 'agent_a' WHEN username = 'old1' THEN 'agent_b' WHEN username = 'old2' THEN 'agent_c' ELSE username END AS username FROM g),
        q AS (SELECT * FROM questionnaires QUALIFY ROW_NUMBER() OVER (PARTITION BY caseid ORDER BY date_ppi DESC, form DESC) = 1)
        SELECT m.caseid, m.caseid_group, g2.username, officer_name, rank, type_ppi, date_ppi::VARCHAR AS date_ppi FROM members m JOIN g2 USING (caseid_group)
        LEFT JOIN officers USING (caseid_group) LEFT JOIN q ON q.caseid = m.caseid
        WHERE removing_date = '---' AND m.caseid NOT IN (SELECT caseid FROM known_duplicates)""",
)
def k17(t: Tables):
    names = ("savings_groups", "active_groups", "members", "officers", "known_duplicates", "questionnaires")
    out = groups.savings_groups_active(
        *[made(t, n) for n in names],
        agent_by_name={"BUILDING": "agent_a"},
        agent_by_agent={"old1": "agent_b", "old2": "agent_c"},
        newest=[F.col("date_ppi").desc(), F.col("form").desc()],
    )
    return out.select("caseid", "caseid_group", "username", "officer_name", "rank", "type_ppi", "date_ppi")


@query(
    "k18_garden_active",
    ctes("gardens", "site_info")
    + """SELECT caseid, line, plot, g.username, s.site, commune, network FROM (SELECT *, trim(split_part(site_label, '-', 1)) AS site FROM gardens) g
        LEFT JOIN site_info s ON s.site = g.site
        WHERE username IN ('agent1', 'agent3', 'agent19') AND last_modified_date >= DATE '1998-10-01' AND last_modified_date < DATE '2001-12-02'
          AND NOT closed AND cycle_4_start_date = '---' AND address_department IS DISTINCT FROM 'nord-ouest'""",
)
def k18(t: Tables):
    users = ["agent1", "agent3", "agent19"]
    out = groups.garden_active(made(t, "gardens"), made(t, "site_info"), users, "1998-10-01", AS_OF, "nord-ouest")
    return out.select("caseid", "line", "plot", "username", "site", "commune", "network")


_STAGES = {
    "total": "TRUE", "tested": "tested", "negative": "negative", "unknown": "unk", "positive": "positive", "untested": "offered AND NOT COALESCE(tested, FALSE)",
}


@query(
    "k19_sibling_testing_cascade",
    ctes("household_child")
    + """, c AS (SELECT caseid, bool_or(hiv_test = '1') AS tested, bool_or(hiv_test = '1' AND hiv_test_result = 'positif') AS positive,
            bool_or(hiv_test = '1' AND hiv_test_result = 'negatif') AS negative, bool_or(hiv_test = '1' AND COALESCE(hiv_test_result NOT IN ('positif', 'negatif'), TRUE)) AS unk,
            bool_or(hiv_test = '2' AND is_accepted IS DISTINCT FROM '0') AS offered
          FROM household_child WHERE infant_relationship = '3' AND age_in_year BETWEEN 0 AND 17 GROUP BY 1) """
    + " UNION ALL ".join(f"SELECT {i} AS step, '{n}' AS stage, COUNT(*) FILTER ({c}) AS n FROM c" for i, (n, c) in enumerate(_STAGES.items())),
)
def k19(t: Tables):
    return viral_load.sibling_testing_cascade(made(t, "household_child"))


def _newest(source: str, day: str, where: str) -> str:
    return f"(SELECT * FROM {source} WHERE {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_code ORDER BY {day} DESC, event_key DESC) = 1)"


_FLAGS = (
    ctes("cohort", "contact_log", "attendance", "households")
    + f""", flags AS (SELECT c.patient_code, c.office, c.ddr, {yn('a.patient_code IS NOT NULL')} AS service_type, {yn('a.date >= ddr')} AS service_during_pregnancy,
        {yn('b.patient_code IS NOT NULL')} AS mother_in_club, {yn('b.session_date >= ddr')} AS club_during_pregnancy,
        {yn('h.patient_code IS NOT NULL')} AS has_household, {yn('h.collection_date >= ddr')} AS household_during_pregnancy
      FROM cohort c LEFT JOIN {_newest('contact_log', 'date', "found = 'Oui'")} a USING (patient_code)
      LEFT JOIN {_newest('attendance', 'session_date', "raison_absence = '1- Present'")} b ON b.patient_code = c.patient_code
      LEFT JOIN {_newest('households', 'collection_date', 'TRUE')} h ON h.patient_code = c.patient_code) """
)


def _flags(t: Tables):
    return maternal.cohort_services(*[made(t, n) for n in ("cohort", "contact_log", "attendance", "households")])


@query("k20_cohort_services", _FLAGS + "SELECT * REPLACE (ddr::VARCHAR AS ddr) FROM flags")
def k20(t: Tables):
    return _flags(t).select(
        "patient_code", "office", "ddr", "service_type", "service_during_pregnancy", "mother_in_club", "club_during_pregnancy",
        "has_household", "household_during_pregnancy",
    )


@query(
    "k20_cohort_service_summary",
    _FLAGS
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS service, COUNT(*) AS total, COUNT(*) FILTER ({f} = 'yes') AS with_service, COUNT(*) FILTER ({f} = 'no') AS without_service,
            {pct(f"COUNT(*) FILTER ({f} = 'yes')", 'COUNT(*)')} AS pct FROM flags"""
        for f in maternal.SERVICE_FLAGS
    ),
)
def k20_summary(t: Tables):
    return maternal.cohort_service_summary(_flags(t))


@query(
    "k21_annual_pregnancy_cohort",
    ctes("annual", "contact_log")
    + f""", b AS (SELECT p.*, {yn('a.patient_code IS NOT NULL')} AS service_type, {yn('a.date >= ddr')} AS service_during_pregnancy
          FROM annual p LEFT JOIN {_newest('contact_log', 'date', "found = 'Oui'")} a ON a.patient_code = p.patient_code
          WHERE office NOT IN ('BUILDING', 'FURNITURE') AND is_abandoned IS DISTINCT FROM 1 AND is_dead IS DISTINCT FROM 1),
        chosen AS (SELECT * FROM b WHERE dpa >= DATE '2000-10-01' OR (dpa IS NULL AND added_at BETWEEN DATE '2000-10-01' AND DATE '2001-09-30')),
        recent AS (SELECT patient_code FROM chosen WHERE delivery_date IS NULL OR delivery_date >= DATE '1998-10-01'),
        old AS (SELECT patient_code FROM chosen WHERE patient_code NOT IN (SELECT patient_code FROM recent) AND delivery_date IS NOT NULL),
        kept AS (SELECT *, CASE WHEN ddr >= DATE '2000-10-01' THEN CAST(ddr - INTERVAL 1 MONTH AS DATE) ELSE added_at END AS added FROM chosen
          WHERE patient_code NOT IN (SELECT patient_code FROM old) AND (COALESCE(delivery_date > DATE '2000-07-01', FALSE) OR dpa IS NOT NULL OR ddr IS NOT NULL))
        SELECT patient_code, pregnancy_id, CASE WHEN delivery_date IS NULL THEN 'pregnant' ELSE 'breastfeeding' END AS list, added::VARCHAR AS added_at,
          {yn("added >= DATE '2000-10-01'")} AS added_in_the_interval, service_type, service_during_pregnancy FROM kept WHERE termination_of_pregnancy IS DISTINCT FROM 1""",
)
def k21(t: Tables):
    return maternal.annual_pregnancy_cohort(
        made(t, "annual"), made(t, "contact_log"), "2000-10-01", "2001-09-30", ["BUILDING", "FURNITURE"]
    )


@query(
    "k21_annual_attendance",
    ctes("attendance")
    + """SELECT patient_code, COUNT(*) FILTER (raison_absence = '1- Present') AS present, COUNT(*) FILTER (raison_absence IS DISTINCT FROM '1- Present') AS absent FROM attendance
         WHERE patient_code IS NOT NULL GROUP BY 1""",
)
def k21_attendance(t: Tables):
    return maternal.annual_attendance(made(t, "attendance"), F.col("raison_absence") == "1- Present")


@query(
    "k22_household_coverage",
    ctes("index_children", "additions")
    + f""", o AS (SELECT * FROM index_children QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_code ORDER BY event_key) = 1)
        SELECT upper(patient_code) AS patient_code, event_key, {yn('upper(patient_code) IN (SELECT patient_code FROM additions)')} AS has_household FROM o""",
)
def k22(t: Tables):
    out = viral_load.household_coverage(made(t, "index_children"), made(t, "additions"), [F.col("event_key")])
    return out.select("patient_code", "event_key", "has_household")


# --- dashboards ------------------------------------------------------------------

_DASH = """d AS (SELECT o_orderdate, o_custkey, n_name, p.lines FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) p ON l_orderkey = o_orderkey WHERE c_mktsegment = 'MACHINERY'),
  i AS (SELECT *, CASE WHEN lines < 3 THEN '<3' WHEN lines < 6 THEN '3-5' WHEN lines IS NOT NULL THEN '6+' END AS band FROM d
    WHERE o_orderdate >= DATE '2000-04-01' AND o_orderdate < DATE '2000-07-01')"""


_DASHBOARD = (
    f"""WITH {_DASH}, tr AS (SELECT COUNT(*) FILTER (o_orderdate >= DATE '2000-04-01' AND o_orderdate < DATE '2000-07-01') AS c,
          COUNT(*) FILTER (o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-04-01') AS p FROM d),
        ag AS (SELECT band, COUNT(*) AS n FROM i WHERE band IS NOT NULL GROUP BY 1)
        SELECT 'trend' AS block, 'current' AS label, c AS n, CASE WHEN p > 0 THEN round_even((c - p) * 100.0::DOUBLE / p, 2) ELSE 0 END::DOUBLE AS measure FROM tr
        UNION ALL SELECT 'daily', CAST(g AS DATE)::VARCHAR, COUNT(o_orderdate), NULL FROM generate_series((SELECT MIN(o_orderdate) FROM i), (SELECT MAX(o_orderdate) FROM i), INTERVAL 1 DAY) s(g)
          LEFT JOIN i ON CAST(o_orderdate AS DATE) = CAST(g AS DATE) GROUP BY 2
        UNION ALL SELECT 'ages', band, n, {pct('n', '(SELECT SUM(n) FROM ag)')} FROM ag
        UNION ALL (SELECT 'agents', o_custkey::VARCHAR, COUNT(*) AS n, NULL FROM i GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10)
        UNION ALL SELECT 'offices', n_name, COUNT(*), COUNT(DISTINCT o_custkey)::DOUBLE FROM i GROUP BY n_name"""
)


def _activity(t: Tables):
    from ..operators.filters import dashboard_filter

    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    people = dashboard_filter(t.customer, office=("c_mktsegment", "MACHINERY"))
    rows = (
        t.orders.join(people, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    return rows, {"day": "o_orderdate", "office": "n_name", "agent": "o_custkey", "age_band": band("lines", [(3, "<3"), (6, "3-5")], "6+")}


@query("k23_dashboard_pack", _DASHBOARD)
def k23(t: Tables):
    rows, columns = _activity(t)
    return dashboards.dashboard_pack(rows, **columns, start="2000-04-01", end="2000-06-30")


@query("k23_dashboard_from_summary", _DASHBOARD)
def k23_summary(t: Tables):
    # the summary holds all days; the dashboard of a quarter reads nothing else
    rows, columns = _activity(t)
    daily = cut_lineage(dashboards.daily_activity(rows, **columns), "daily")
    return dashboards.dashboard_pack(daily, day="day", office="office", agent="agent", age_band=F.col("band"), start="2000-04-01", end="2000-06-30", weight="n")


_PERIOD_SQL = {
    "current_week": ("2024-01-15", "2024-01-21"),
    "previous_week": ("2024-01-08", "2024-01-14"),
    "current_month": ("2024-01-01", "2024-01-31"),
    "previous_month": ("2023-12-01", "2023-12-31"),
    "last_3_months": ("2023-10-01", "2023-12-31"),
}
#: Some events lie long before and after the run date, and some have no date.
_SPREAD = """(SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 7 = 1 THEN ts - INTERVAL 9 YEAR WHEN user_id % 7 = 2 THEN ts + INTERVAL 3 YEAR ELSE ts END AS ts)
       FROM events)"""
_IND = {
    "forms": "COUNT(*)",
    "errors": "COUNT(*) FILTER (event_type = 'error')",
    "users": "COUNT(DISTINCT user_id)",
    "large": "COUNT(*) FILTER (value > 300)",
}


_ACTIVITY = (
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{p}' AS period, '{n}' AS indicator, {e} AS n FROM {_SPREAD} WHERE {where}"
        for p, where in [*((p, f"CAST(ts AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'") for p, (lo, hi) in _PERIOD_SQL.items()), ("all", "TRUE")]
        for n, e in _IND.items()
    )
    + ") WHERE n > 0"
)


def _spread_events(t: Tables):
    group, ts = F.col("user_id") % 7, F.col("ts")
    moved = F.when(group == 0, None).when(group == 1, ts - F.expr("interval 9 year")).when(group == 2, ts + F.expr("interval 3 year")).otherwise(ts)
    return t.events.withColumn("ts", moved)


@query("k24_activity_from_partials", _ACTIVITY)
def k24_partials(t: Tables):
    path = scratch_path(t.spark, "daily")
    counts = {"forms": F.lit(True), "errors": F.col("event_type") == "error", "large": F.col("value") > 300}
    partials.write_partials(partials.daily_partials(_spread_events(t), "ts", counts, {"users": (F.col("user_id"), None)}), path)
    return dashboards.activity_from_partials(partials.read_partials(t.spark, path), "2024-01-18", ["forms", "errors", "users", "large"])


@query("k24_weekly_activity_pack", _ACTIVITY)
def k24(t: Tables):
    return dashboards.activity_pack(
        _spread_events(t),
        "ts",
        "2024-01-18",
        {
            "forms": F.count(F.lit(1)),
            "errors": F.count_if(F.col("event_type") == "error"),
            "users": F.count_distinct("user_id"),
            "large": F.count_if(F.col("value") > 300),
        },
    )


_D1, _D2 = "TRY_CAST(enrollement_date_de_visite AS DATE)", "TRY_CAST(date_admission AS DATE)"


@query(
    "k25_enrolment_window_cohort",
    ctes("enrolment", "screening")
    + f""", e AS (SELECT *, COALESCE(GREATEST({_D1}, {_D2}), {_D1}, {_D2}) AS de FROM enrolment WHERE (is_enrolled = 'yes' OR TRY_CAST(nbr_visit_succeed AS DOUBLE) > 0)
          AND ({_D1} >= DATE '1999-05-01' OR {_D2} >= DATE '1999-05-01')),
        c AS (SELECT *, LEAST(GREATEST(de, DATE '1999-05-01'), DATE '2000-09-30') AS dc, round_even((DATE '2000-12-31' - TRY_CAST(date_of_birth AS DATE)) / 30.44::DOUBLE, 0)::INT AS m FROM e)
        SELECT caseid, opened_date, dc::VARCHAR AS date_enrollement, CASE WHEN enrrolled_where = '---' THEN 'community' ELSE enrrolled_where END AS enrrolled_where, m AS age_months,
          CASE WHEN m < 0 THEN NULL WHEN m <= 2 THEN '0-2' WHEN m <= 12 THEN '2-12' WHEN m > 12 THEN '+12' END AS age_range, regexp_extract(username, '[0-9]+') AS user_mamba,
          {yn("dc >= DATE '1999-05-01'")} AS mamba_given FROM c LEFT JOIN screening USING (caseid)""",
)
def k25(t: Tables):
    out = nutrition.enrolment_window_cohort(made(t, "enrolment"), made(t, "screening"), "1999-05-01", "2000-09-30", "2000-12-31")
    return out.select(
        "caseid", "opened_date", "date_enrollement", "enrrolled_where", "age_months", "age_range", "user_mamba", "mamba_given"
    )


# Some of the mothers are on therapy, of some it is not known.
_THERAPY_SQL = "CASE patient_code % 3 WHEN 0 THEN 'Oui' WHEN 1 THEN 'Non' END"
_LISTS = {
    "not_in_club": "mother_in_club = 'no'",
    "not_served": "service_type = 'no'",
    "no_household_count": "has_household = 'no'",
    "served_in_club_only": "mother_in_club = 'yes' AND service_type = 'no'",
    "third_trimester_without_therapy": f"{due_sql('ddr')} - DATE '2001-03-01' <= 91 AND COALESCE({_THERAPY_SQL}, 'Non') = 'Non'",
}
_WORK = _FLAGS + ", lists AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS list, patient_code AS key, office, ddr AS sort_date FROM flags WHERE {c}" for n, c in _LISTS.items()
) + ") "


def _work_lists(t: Tables):
    from ..functions.dates import trimester, due_date

    in_club, served, counted = (F.col(c) == "yes" for c in ("mother_in_club", "service_type", "has_household"))
    therapy = F.when(F.col("patient_code") % 3 == 0, "Oui").when(F.col("patient_code") % 3 == 1, "Non")
    return dashboards.action_lists(
        _flags(t),
        "patient_code",
        "office",
        "ddr",
        {
            "not_in_club": ~in_club,
            "not_served": ~served,
            "no_household_count": ~counted,
            "served_in_club_only": in_club & ~served,
            "third_trimester_without_therapy": (trimester(due_date("ddr"), "2001-03-01") == "3rd") & (F.coalesce(therapy, F.lit("Non")) == "Non"),
        },
    )


@query("k26_action_lists", _WORK + "SELECT list, key, office, sort_date::VARCHAR AS sort_date FROM lists")
def k26(t: Tables):
    return lt.sort_multi(_work_lists(t), F.col("list"), F.col("office"), F.col("sort_date"), F.col("key"))


_EXITS = {"to_be_exited": "child_to_be_exited = 'yes'", "exited": "sortie = 'yes'", "without_supply": "visit_mamba = 'no'"}


@query(
    "k26_nutrition_action_lists",
    f"WITH k AS ({_K01}) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS list, caseid AS key, raison_pour_la_sortie AS office, last_visit_date AS sort_date FROM k WHERE {c}" for n, c in _EXITS.items()
    ),
)
def k26_nutrition(t: Tables):
    return dashboards.action_lists(
        k01(t),
        "caseid",
        "raison_pour_la_sortie",
        "last_visit_date",
        {
            "to_be_exited": F.col("child_to_be_exited") == "yes",
            "exited": F.col("sortie") == "yes",
            "without_supply": F.col("visit_mamba") == "no",
        },
    )


@query(
    "k26_action_list_counts",
    _WORK + f"""SELECT list, office, n, {pct('n', 't')} AS pct FROM (SELECT list, office, COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY list) AS t FROM lists GROUP BY 1, 2)""",
)
def k26_counts(t: Tables):
    return dashboards.action_list_counts(_work_lists(t))
