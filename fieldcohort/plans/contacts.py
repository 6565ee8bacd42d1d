"""Calls and visits, and club session detail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import safe_pct
from ..functions.dates import month_name
from ..functions.nulls import BLANK_DATE, as_date
from ..functions.text import decode, zone_from_prefix
from ..operators import aggregate, clean, filters, joins, latest

COMMON = ("formid", "patient_code", "date", "found", "username")


def calls_visits(
    feeds: Sequence[tuple[DataFrame, Mapping[str, str], str, str]], start, end, zones: Mapping[str, str]
) -> DataFrame:
    """One contact log from several form feeds.

    A feed is (table, names, program, type), where ``names`` maps its columns
    to the common ones. Blank dates become a far date and so leave the period.
    ``found`` is Oui or Non; other answers are marked undecided.
    """
    parts = []
    for df, names, program, kind in feeds:
        rows = clean.rename_cols(df, names).select(*[F.col(c).cast("string").alias(c) for c in COMMON])
        parts.append(rows.withColumns({"program": F.lit(program), "type": F.lit(kind)}))
    rows = latest.union_all(*parts)
    day = F.nullif("date", F.lit("---"))
    rows = rows.withColumn("date", F.coalesce(day, F.lit(BLANK_DATE)).try_cast("date"))
    rows = filters.between_dates(rows, "date", start, end)
    return rows.withColumns(
        {
            "found": decode("found", {"0": "Non", "1": "Oui"}, keep_unknown=True),
            "commune": zone_from_prefix("username", zones),
            "mois": month_name("date"),
            "annee": F.date_format("date", "yyyy"),
        }
    ).withColumn("decided", F.coalesce(F.col("found").isin("Oui", "Non"), F.lit(False)))


def decided(log: DataFrame) -> DataFrame:
    return log.where("decided").drop("decided")


def undecided(log: DataFrame) -> DataFrame:
    return log.where("not decided and found = '---'").drop("decided")


def contact_totals(log: DataFrame) -> DataFrame:
    """Overall contacts, people found, agents and people reached."""
    return aggregate.kpi_row(
        log,
        {
            "contacts": F.count(F.lit(1)),
            "found": F.count_if(F.col("found") == "Oui"),
            "agents": F.count_distinct("username"),
            "people": F.count_distinct("patient_code"),
        },
        {"pct_found": ("found", "contacts")},
    )


def contacts_by(log: DataFrame, *keys: str) -> DataFrame:
    """Contacts and found share per agent, program, type or month."""
    out = log.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("contacts"), F.count_if(F.col("found") == "Oui").alias("found"))
    return out.withColumn("pct_found", safe_pct(F.col("found"), F.col("contacts")))


def contacts_by_month(log: DataFrame, communes: Sequence[str]) -> DataFrame:
    """Month by commune and found, with totals and the found percentage."""
    groups = [("commune", communes), ("found", ["Oui", "Non"])]
    pivot = aggregate.pivot_margins(log, F.col("mois"), "mois", groups, counts={"total_found": F.col("found") == "Oui"})
    return pivot.withColumn("pct_found", safe_pct(F.col("total_found"), F.col("total"), 2))


def session_detail(
    sessions: DataFrame, club_sessions: DataFrame, clubs: DataFrame, patients: DataFrame, reasons: Mapping[int, str], start, end, keep: Sequence[str] = ()
) -> DataFrame:
    """Attendance rows of the period with first and last dates at three levels.

    First per person (linked records count as one), last per record, first per
    record and club; all over every recorded session, not only the period.
    ``keep`` names further columns of the sessions and club sessions.
    """
    more = [c for c in club_sessions.columns if c in keep and c != "id_club"]
    rows = joins.inner_chain(
        sessions.where("is_present is not null"),
        (club_sessions.select("id_club_session", "id_club", F.col("date").alias("session_date"), *more), "id_club_session"),
        (patients, "id_patient"),
    ).withColumn("person", joins.canonical_id("linked_to_id_patient", "id_patient"))
    levels = [
        (["person"], {"first_attendance_date": "first"}),
        (["id_patient"], {"last_attendance_date": "last"}),
        (["id_patient", "id_club"], {"first_attendance_date_by_club": "first"}),
    ]
    inside = rows.where(filters.on_or_between("session_date", start, end))
    detail = latest.first_last_at_levels(inside, rows, "session_date", levels)
    return detail.join(clubs, "id_club", "left").select(
        "person",
        "patient_code",
        "club_name",
        as_date(F.col("session_date")).alias("session_date"),
        *[as_date(F.col(n)).alias(n) for _, s in levels for n in s],
        "is_present",
        decode("is_present", reasons).alias("reason"),
        "session_id",
        *keep,
    )


#: Services that a session records, with the names the reports use.
SERVICES = ("clore", "nbre_deparasitaires", "nbre_preservatifs", "nbre_vit_a", "nbre_moustiquaires", "is_patient_tb", "is_patient_on_pf", "adh")
# The codes of a person's sex.
SEXES = {1: "male", 2: "female", 3: "unknown"}


def session_lines(
    detail: DataFrame, clubs: DataFrame, hospitals: DataFrame, club_types: DataFrame, topics: DataFrame, mothers: DataFrame, infants: DataFrame
) -> DataFrame:
    """Session detail with hospital, club, topic, person and services given.

    ``detail`` comes from ``session_detail`` with id_club, topic and the services
    kept. A person's record as an infant goes before that as a mother; each
    lookup may be missing.
    """
    person = ("first_name", "last_name", "dob", "is_abandoned", "is_dead")
    as_infant = infants.select(F.col("id_patient").alias("person"), *[F.col(c).alias(f"infant_{c}") for c in (*person, "gender")])
    as_mother = mothers.select(F.col("id_patient").alias("person"), *[F.col(c).alias(f"mother_{c}") for c in (*person, "is_graduate", "graduation_date")])
    places = clubs.select("id_club", "id_hospital", "club_type").join(
        hospitals.select("id_hospital", F.col("name").alias("hospital"), F.concat_ws("/", "city_code", "hospital_code").alias("site_code")), "id_hospital", "left"
    )
    kinds = club_types.select("club_type", F.col("name").alias("type_name"))
    subjects = topics.select("topic", F.col("name").alias("topic_name"))
    full = detail.join(places, "id_club", "left").join(kinds, "club_type", "left").join(subjects, "topic", "left")
    full = full.join(as_mother, "person", "left").join(as_infant, "person", "left")
    sex = F.coalesce(decode("infant_gender", SEXES), F.col("infant_gender").cast("string"))
    dates = ("session_date", "first_attendance_date", "last_attendance_date", "first_attendance_date_by_club")
    return full.select(
        "person", "hospital", "site_code", "club_name", F.col("type_name").alias("club_type"), "patient_code", F.col("topic_name").alias("topic"), *dates,
        *[F.coalesce(f"infant_{c}", f"mother_{c}").alias(c) for c in person],
        F.when(F.col("mother_is_graduate") == 1, "Yes").otherwise("Non").alias("graduation"),
        F.col("mother_graduation_date").alias("graduation_date"),
        sex.alias("sex"), *SERVICES, "is_present", "reason", "session_id",
    )
