"""Child nutrition: enrolment status, waiting lists, club attendance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import age_band_0_2_12, period_eligible, pick_reason, visits_remaining
from ..functions.dates import age_months_rounded
from ..functions.nulls import BLANK_TEXT, as_date, differs, yes_no
from ..functions.text import extract_digits
from ..operators import aggregate, clean, filters, joins, latest

# Coded answers of the follow-up form.
VISIT_TYPES = ("Visite_de_Suivi", "derniere_visite", "suivi_post_exeat")
EXIT_REASONS = ("abandonne_programme", "atteind_poids_projecte", "pas_atteind_poids")
BLANK = "---"


def follow_up_per_child(
    follow_up: DataFrame, start, end, supplied_users: Sequence[str], supplied: tuple
) -> DataFrame:
    """One row per child from the visit forms of the period.

    Counts per visit type, exit reason and food supply, first and last visit,
    summed measures, the newest success counter, and the texts of the first
    visit.
    """
    rows = filters.between_dates(clean.to_date_coerce(follow_up, ["date_of_visit"]), "date_of_visit", start, end)
    for c in ("mamba_quantity", "last_weight", "last_height", "last_muac"):
        rows = clean.to_number_coerce(rows, c)
    order = F.struct("date_of_visit", "formid")

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), order)).alias(name)

    supply = F.col("mamba_quantity") > 0
    done = F.max_by("nbr_visit_succeed_suivi", F.when(F.col("nbr_visit_succeed_suivi").isNotNull(), order))
    out = rows.where("caseid is not null").groupBy("caseid").agg(
        F.count("formid").alias("total_visits"),
        F.min("date_of_visit").alias("first_visit_date"),
        F.max("date_of_visit").alias("last_visit_date"),
        *[F.count_if(F.col("type_of_visit") == v).alias(v) for v in VISIT_TYPES],
        *[F.count_if(F.col("raison_pour_la_sortie") == r).alias(r) for r in EXIT_REASONS],
        F.count_if(supply).alias("visit_mamba_yes"),
        F.count_if(~supply).alias("visit_mamba_no"),
        F.sum("mamba_quantity").alias("mamba_quantity"),
        done.cast("int").alias("nbr_visit_succeed_suivi"),
        first("username_suivi"),
    )
    user = F.coalesce(extract_digits("username_suivi"), F.lit("2"))
    return out.withColumns(
        {
            "user_mamba_suivi": user,
            "mamba_disponible_suivi": period_eligible(user, "last_visit_date", supplied_users, *supplied),
            "sortie": yes_no(F.col("derniere_visite") != 0),
            "raison_pour_la_sortie": pick_reason({r: r for r in EXIT_REASONS}, BLANK_TEXT),
        }
    )


def clean_enrolment(enrolment: DataFrame, screening: DataFrame, supplied_users: Sequence[str], supplied: tuple) -> DataFrame:
    """One enrolment record per child, with the screening agent.

    Of repeated records the first opened is kept.
    """
    rows = clean.to_date_coerce(
        enrolment, ["enrollement_date_de_visite", "date_admission", "approval_date", "opened_date"]
    )
    rows = latest.dedupe_keep(rows, "caseid", ["opened_date", "enrollement_date_de_visite", "date_admission"])
    rows = clean.row_max_date(rows, "date_enrollement", "enrollement_date_de_visite", "date_admission")
    rows = clean.fill_value(rows, "enrrolled_where", BLANK, "community")
    rows = joins.left_lookup(rows, screening, "caseid", ["username", "date_de_depistage"])
    user = extract_digits("username")
    return rows.withColumns(
        {
            "user_mamba": user,
            "mamba_period_eligible": period_eligible(user, "date_enrollement", supplied_users, *supplied),
        }
    )


def nutrition_enrolment(
    screening: DataFrame,
    follow_up: DataFrame,
    enrolment: DataFrame,
    *,
    visits: tuple,
    approvals: tuple,
    enrolled: tuple,
    supplied_users: Sequence[str],
    supplied: tuple,
    inpatient: str,
) -> DataFrame:
    """Status of every followed, inpatient or approved child.

    ``inpatient`` is the place of enrolment that stands for the hospital unit.
    Visits and enrolments meet in one full join. A child stays when it has
    visits, was enrolled in the inpatient unit, or was approved in the period;
    what a child without visits lacks is taken from its enrolment.
    """
    seen = follow_up_per_child(follow_up, *visits, supplied_users, supplied)
    known = clean_enrolment(enrolment, screening, supplied_users, supplied)
    both = known.withColumn("_enrolled", F.lit(True)).join(seen.withColumn("_seen", F.lit(True)), "caseid", "full")
    approved = F.col("approval_date").between(as_date(approvals[0]), as_date(approvals[1]))
    rows = both.where(F.col("_seen") | (F.col("enrrolled_where") == inpatient) | approved)

    zero = ["total_visits", "nbr_visit_succeed_suivi", "visit_mamba_yes", "visit_mamba_no", *VISIT_TYPES, *EXIT_REASONS]
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero}).withColumns(
        {
            "suivi_exists": yes_no(F.col("_seen") & F.col("_enrolled")),
            "username_suivi": F.coalesce("username_suivi", "username"),
            "user_mamba_suivi": F.coalesce("user_mamba_suivi", "user_mamba"),
            "mamba_disponible_suivi": F.coalesce("mamba_disponible_suivi", "mamba_period_eligible"),
            "sortie": F.coalesce("sortie", F.lit("no")),
            "raison_pour_la_sortie": F.coalesce("raison_pour_la_sortie", F.lit(BLANK_TEXT)),
            "first_visit_date": F.coalesce("first_visit_date", "opened_date"),
            "last_visit_date": F.coalesce("last_visit_date", "opened_date"),
        }
    )
    rows = rows.withColumns(
        {
            "enroled": yes_no(
                (F.col("closed_date") == BLANK)
                & F.col("date_enrollement").between(as_date(enrolled[0]), as_date(enrolled[1]))
                & (F.col("mamba_disponible_suivi") == "no")
            ),
            "visits_remaining": visits_remaining("manutrition_type", "nbr_visit_succeed_suivi"),
            "mamba_remaining": visits_remaining("manutrition_type", "visit_mamba_yes"),
            "visit_mamba": yes_no((F.col("visit_mamba_yes") > 0) | (F.col("has_mamba") == "yes")),
            "actif": yes_no((F.col("derniere_visite") == 0) & (F.col("suivi_post_exeat") == 0)),
        }
    )
    rows = rows.withColumn(
        "child_to_be_exited",
        yes_no(differs("enrrolled_where", inpatient) & (F.col("mamba_remaining") == 0) & (F.col("derniere_visite") == 0)),
    )
    unreachable = differs("visit_reason_not_reachable", BLANK) & (F.col("visit_mamba") == "no")
    return rows.where(~unreachable).drop("_seen", "_enrolled")


def waiting_and_unfollowed(screening: DataFrame, follow_up: DataFrame, enrolment: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Eligible children without a visit: waiting for admission, or not followed.

    ``enrolment`` has one row per child; ``enrolled`` holds the children who
    count as enrolled and appear on neither list.
    """
    eligible = screening.where("eligible = 'yes'").select("caseid")
    open_cases = joins.semi_join(joins.anti_join(enrolment, follow_up, "caseid"), eligible, "caseid")
    waiting = (
        (F.col("closed_date") == BLANK)
        & F.col("date_enrollement").isNull()
        & (F.col("club_id") == BLANK)
        & (F.col("enrrolled_where") == "community")
        & (F.col("is_approve_by_manager") == BLANK)
    )
    rows = joins.exists_flag(open_cases, enrolled, "caseid", "is_enrolled_now")
    status = F.when(waiting, "waiting").when(F.col("is_enrolled_now") == "no", "no_follow_up")
    return rows.withColumn("list", status).where("list is not null").drop("is_enrolled_now")


def clean_presence(presence: DataFrame, start, end, office_of_clerk: Mapping[str, str]) -> DataFrame:
    """Attendance forms of the period; an unreadable presence counts as present."""
    rows = clean.to_date_coerce(presence, ["session_date"])
    rows = clean.to_number_coerce(rows, "is_member_present", 1)
    rows = filters.between_dates(rows, "session_date", start, end)
    return clean.map_values(rows, "data_clerk", office_of_clerk, "office")


def club_attendance_children(
    presence: DataFrame, screening: DataFrame, start, end, office_of_clerk: Mapping[str, str], member_types: Sequence[str]
) -> DataFrame:
    """Sessions, member types and first and last session per child."""
    rows = clean.one_hot(clean_presence(presence, start, end, office_of_clerk), "member_type", member_types)
    flags = [f"member_type_{clean.safe_name(m)}" for m in member_types]
    rows = rows.select("caseid", "session_id", "session_date", "is_member_present", "office", *flags)
    out = aggregate.smart_aggregate(
        rows, "caseid", order=["session_date", "session_id"], count_cols=["session_id"], span_cols=["session_date"]
    )
    out = clean.rename_cols(out, {"is_member_present": "total_sessions", "session_id": "forms"})
    return joins.left_lookup(out, screening, "caseid", ["username"])


def club_attendance_clubs(presence: DataFrame, clubs: DataFrame, start, end) -> DataFrame:
    """Distinct children per club and clerk with the club's name."""
    rows = clean_presence(presence, start, end, {"-": "-"})
    counts = rows.where("club_id is not null").groupBy("club_id").agg(
        F.count_distinct("caseid").alias("children"), F.count_distinct("session_date").alias("session_days")
    )
    names = clubs.select(F.col("caseid").alias("club_id"), F.col("name").alias("club_name"))
    return counts.join(names, "club_id", "left")


def enrolment_window_cohort(
    enrolment: DataFrame, screening: DataFrame, start, end, as_of, clamp: bool = True
) -> DataFrame:
    """Children enrolled since ``start`` with clamped date, age band and supply flag."""
    rows = clean.to_date_coerce(enrolment, ["enrollement_date_de_visite", "date_admission", "date_of_birth"])
    rows = filters.enrolled_with_visits(rows, start)
    rows = clean.row_max_date(rows, "date_enrollement", "enrollement_date_de_visite", "date_admission")
    if clamp:
        rows = clean.clamp_dates(rows, "date_enrollement", start, end)
    rows = clean.fill_value(rows, "enrrolled_where", BLANK, "community")
    months = F.when(F.col("date_of_birth").isNotNull(), age_months_rounded("date_of_birth", as_of))
    rows = rows.withColumn("age_months", months).withColumn("age_range", age_band_0_2_12("age_months"))
    rows = joins.left_lookup(rows, screening, "caseid", ["date_de_depistage", "username"])
    return rows.withColumns(
        {
            "user_mamba": extract_digits("username"),
            "mamba_given": yes_no(F.col("date_enrollement") >= as_date(start)),
        }
    )
