"""Mothers and pregnancies: cohorts, services, tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import age_band_0_2_12, safe_pct
from ..functions.dates import (
    active_within,
    breastfeeding_status,
    complete_months,
    due_date,
    merged_delivery_date,
    pregnant_status,
)
from ..functions.nulls import as_date, differs, yes_no
from ..operators import aggregate, filters, joins, latest, skew


def quarter_service_presence(
    sources: Mapping[str, tuple[DataFrame, str, Column | None]], key: str, periods: Mapping[str, tuple], people: DataFrame
) -> DataFrame:
    """People served in any of the periods by source and period.

    The base is everybody whom a source saw in one of the periods, which is
    what the matrix without a population holds.
    """
    return joins.presence_matrix(None, key, sources, periods).join(people, key, "left")


def mother_mastersheet(
    mothers: DataFrame, pregnancies: DataFrame, infants: DataFrame, followups: DataFrame, sessions: DataFrame, as_of
) -> DataFrame:
    """Mother-infant line list.

    Mothers with a due date, expected date, delivery or infant birth between
    24 months back and nine months ahead, each with the newest pregnancy,
    infant, follow-up and club session.
    """
    ref = as_date(as_of)
    lo, hi = F.add_months(ref, -24), F.add_months(ref, 9)
    recent = (
        F.col("dpa").between(lo, hi) | due_date("ddr").between(lo, hi) | F.col("actual_delivery_date").between(lo, hi)
    )
    base = latest.union_distinct(
        pregnancies.where(recent).select("id_patient"), infants.where(F.col("infant_dob").between(lo, hi)).select("id_patient")
    )

    def newest(df: DataFrame, day: str, tie: str, *cols: str) -> DataFrame:
        order = [F.col(day).desc_nulls_last(), F.col(tie).desc()]
        return latest.latest_per_key(df.select("id_patient", *{day, tie, *cols}), "id_patient", order).select(
            "id_patient", *cols
        )

    rows = joins.left_star(
        base,
        (mothers, "id_patient"),
        (newest(pregnancies, "ddr", "pregnancy_id", "ddr", "dpa", "actual_delivery_date", "terminated"), "id_patient"),
        (newest(infants, "infant_dob", "infant_id", "infant_dob"), "id_patient"),
        (
            newest(followups, "date", "followup_id", "date", "next_appointment_date").withColumnRenamed(
                "date", "last_followup_date"
            ),
            "id_patient",
        ),
        (sessions.groupBy("id_patient").agg(F.max("session_date").alias("club_session_date")), "id_patient"),
    )
    delivery = merged_delivery_date("actual_delivery_date", "infant_dob")
    expected = due_date("ddr")
    probable = merged_delivery_date("actual_delivery_date", "infant_dob", "dpa", expected)
    return rows.withColumns(
        {
            "dpa_calculated": expected,
            "delivery_date_merge": delivery,
            "delivery_probable_date": probable,
            "breastfeeding": breastfeeding_status(F.col("infant_dob"), delivery, F.col("terminated"), as_of),
            "pregnant": pregnant_status(F.col("ddr"), F.col("actual_delivery_date"), probable, F.col("terminated"), as_of),
            "is_actually_in_club": active_within("club_session_date", as_of),
        }
    )


def pregnancy_tracking(pregnancies: DataFrame, sessions: DataFrame, loads: DataFrame, start, end) -> DataFrame:
    """Pregnancies that overlap the interval, newest per mother, with club
    sessions during the episode and validity of the newest viral load."""
    lo, hi = as_date(start), as_date(end)
    overlaps = F.coalesce(filters.episode_overlaps(F.col("ddr"), F.col("dpa"), start, end), F.lit(False))
    delivered = F.coalesce(F.col("actual_delivery_date").between(lo, hi), F.lit(False))
    added = F.coalesce(as_date(F.col("created_at")).between(lo, hi), F.lit(False))
    chosen = pregnancies.where(overlaps | delivered | added)
    one = latest.latest_per_key(chosen, "id_patient", [F.col("ddr").desc_nulls_last(), F.col("pregnancy_id").desc()])
    visits = joins.interval_join(
        one.select("id_patient", "ddr", "dpa"),
        sessions.where("is_present = 1").select("id_patient", "session_date"),
        "id_patient",
        "session_date",
        start=F.col("ddr"),
        due=F.col("dpa"),
        how="inner",
    )
    spans = visits.groupBy("id_patient").agg(
        as_date(F.min("session_date")).alias("first_session"), as_date(F.max("session_date")).alias("last_session")
    )
    load = loads.where("viral_load_date is not null").groupBy("id_patient").agg(
        F.max("viral_load_date").alias("viral_load_date"),
        F.max_by("viral_load_count", F.struct("viral_load_date", "id")).alias("viral_load_count"),
        F.max(F.col("viral_load_date").between(lo, hi)).alias("_in"),
    )
    rows = one.join(spans, "id_patient", "left").join(load, "id_patient", "left")
    expected = due_date("ddr")
    return rows.select(
        "id_patient",
        "pregnancy_id",
        "ddr",
        "dpa",
        "actual_delivery_date",
        "first_session",
        "last_session",
        yes_no(F.col("first_session").isNotNull()).alias("has_session_during_pregnancy"),
        yes_no(overlaps).alias("is_pregnant_in_the_interval"),
        yes_no(delivered).alias("has_delivery_in_the_interval"),
        yes_no(F.col("dpa").between(lo, hi) | expected.between(lo, hi)).alias("expected_delivery_in_period"),
        yes_no(added).alias("pregnancy_added_in_the_interval"),
        "viral_load_date",
        "viral_load_count",
        yes_no(F.col("_in")).alias("has_viral_load_in_the_interval"),
        yes_no(F.add_months("viral_load_date", 12) > hi).alias("has_valid_viral_load"),
    )


def current_pregnancies(
    pregnancies: DataFrame,
    sessions: DataFrame,
    places: DataFrame,
    as_of,
    *,
    without_communes: Sequence[str] = (),
    without_departements: Sequence[str] = (),
) -> DataFrame:
    """Pregnancies not yet delivered whose due date is not two weeks past,
    with the mothers' club sessions of the last 13 months."""
    ref = as_date(as_of)
    limit = F.date_sub(ref, 14)
    open_now = (
        ((due_date("ddr") > limit) | (F.col("dpa") > limit))
        & F.col("actual_delivery_date").isNull()
        & differs("terminated", True)
    )
    seen = filters.last_n_months(sessions.where("is_present = 1"), "session_date", 13, as_of)
    spans = seen.groupBy("id_patient").agg(
        as_date(F.min("session_date")).alias("first_session_in_13_months"), as_date(F.max("session_date")).alias("last_session")
    )
    rows = joins.left_star(
        pregnancies.where(F.coalesce(open_now, F.lit(False))), (spans, "id_patient"), (places, "id_patient")
    ).withColumn("dpa_calculated", due_date("ddr", 0))
    return filters.exclude_on_alias(rows, commune=without_communes, departement=without_departements)


def pcr_analysis(specimens: DataFrame, patients: DataFrame, start, end) -> DataFrame:
    """First tests taken in the interval with age band and result flags."""
    rows = filters.between_dates(specimens.where("which_pcr = 1"), "date_blood_taken", start, end)
    months = complete_months(F.col("date_of_birth"), F.col("date_blood_taken"))
    return joins.left_lookup(rows, patients, "id_patient", ["patient_code"]).select(
        "id",
        "patient_code",
        months.alias("age_month"),
        age_band_0_2_12(months).alias("age_range"),
        yes_no(F.col("pcr_result_date").between(as_date(start), as_date(end))).alias("result_in_the_interval"),
        F.when(F.col("pcr_result") != 0, "with_result").otherwise("no_result").alias("has_result"),
        F.when(F.col("pcr_result") == 1, "positif").otherwise("no_positif").alias("is_positive"),
    )


def mother_child_pcr(specimens: DataFrame, children: DataFrame, pregnancies: DataFrame, start, end) -> DataFrame:
    """Newest specimen per child with the mother and her deliveries in the window.

    Mothers with many children and deliveries are cut in a grid of tasks.
    """
    order = [F.col("date_blood_taken").desc(), F.col("id").desc()]
    newest = latest.latest_per_key(specimens.where(F.col("date_blood_taken") > as_date(start)), "id_patient", order)
    delivered = pregnancies.where(
        (F.col("actual_delivery_date") > as_date(start)) & (F.col("actual_delivery_date") < as_date(end))
    ).select(F.col("id_patient").alias("id_patient_mother"), "actual_delivery_date")
    rows = newest.join(children.where("id_patient_mother is not null"), "id_patient")
    return skew.grid_join(rows, delivered.distinct(), "id_patient_mother")


def mother_club_sessions(
    patients: DataFrame, sessions: DataFrame, sites: DataFrame, as_of, active_days: int = 365
) -> DataFrame:
    """First and last club session per mother with her location."""
    spans = aggregate.first_last_dates(sessions, "id_patient", "session_date", as_of, active_days)
    return joins.inner_chain(spans, (patients, "id_patient"), (sites, "id_site"))


def cohort_services(cohort: DataFrame, contacts: DataFrame, attendance: DataFrame, households: DataFrame) -> DataFrame:
    """Pregnant cohort with its newest contact, club presence and household
    count, and whether each lies on or after the episode start."""
    services = [
        (contacts, "date", F.col("found") == "Oui", "service_type", "service_during_pregnancy"),
        (attendance, "session_date", F.col("raison_absence") == "1- Present", "mother_in_club", "club_during_pregnancy"),
        (households, "collection_date", F.lit(True), "has_household", "household_during_pregnancy"),
    ]
    rows = cohort
    for events, day, positive, found, during in services:
        rows = joins.latest_then_flag(
            rows,
            events,
            "patient_code",
            positive=positive,
            event_date=day,
            order=[F.col(day).desc(), F.col("event_key").desc()],
            since=F.col("ddr"),
            found=found,
            during=during,
        ).drop("event_key", "found", "raison_absence")
    return rows


SERVICE_FLAGS = ("mother_in_club", "service_type", "has_household")


def cohort_service_summary(flags: DataFrame) -> DataFrame:
    """With, without and share for each service, from one pass."""
    row = flags.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(f) == "yes").alias(f) for f in SERVICE_FLAGS]
    )
    cells = [
        F.struct(
            F.lit(f).alias("service"),
            F.col("total"),
            F.col(f).alias("with_service"),
            (F.col("total") - F.col(f)).alias("without_service"),
            safe_pct(F.col(f), F.col("total")).alias("pct"),
        )
        for f in SERVICE_FLAGS
    ]
    return row.select(F.inline(F.array(*cells)))


def annual_pregnancy_cohort(
    pregnancies: DataFrame, contacts: DataFrame, start, end, without_offices: Sequence[str]
) -> DataFrame:
    """Yearly pregnant and breastfeeding women with the service flag.

    Terminated episodes are left out. Episodes that began in the year count as
    added a month before their start.
    """
    lo = as_date(start)
    rows = joins.latest_then_flag(
        pregnancies,
        contacts,
        "patient_code",
        positive=F.col("found") == "Oui",
        event_date="date",
        order=[F.col("date").desc(), F.col("event_key").desc()],
        since=F.col("ddr"),
        found="service_type",
        during="service_during_pregnancy",
    )
    rows = filters.exclude_values(rows, "office", without_offices)
    rows = rows.where(differs("is_abandoned", 1) & differs("is_dead", 1))
    kept = joins.disjoint_by_key(rows, "patient_code", start, end, "_part").where("_part = 'kept'")
    added = F.when(F.col("ddr") >= lo, F.add_months("ddr", -1)).otherwise(F.col("added_at"))
    label = F.when(F.col("delivery_date").isNull(), "pregnant").otherwise("breastfeeding")
    return (
        kept.where(differs("termination_of_pregnancy", 1))
        .withColumns({"added_at": added, "added_in_the_interval": yes_no(added >= lo), "list": label})
        .select(
            "patient_code", "pregnancy_id", "list", "added_at", "added_in_the_interval", "service_type", "service_during_pregnancy"
        )
    )


def annual_attendance(attendance: DataFrame, present: Column) -> DataFrame:
    """Sessions attended and missed per mother."""
    return aggregate.attendance_summary(attendance, "patient_code", present)
