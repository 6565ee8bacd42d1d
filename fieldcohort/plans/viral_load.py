"""Children in care: line list, viral load cascade, clubs, households, siblings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import safe_pct, suppressed_flag
from ..functions.dates import (
    active_within,
    appointment_gap_bucket,
    complete_years,
    lost_to_followup_flags,
    next_test_date,
    reference_month_last_year,
    test_eligible,
)
from ..functions.nulls import as_date, differs
from ..functions.text import decode
from ..operators import aggregate, filters, joins, latest

# Codes of clubs and sexes.
CLUB_TYPES = {2: "club_9_12", 3: "club_13_17", 4: "club_18+", 5: "club_3_5", 6: "club_6_8"}
SEXES = {1: "M", 2: "F"}


def viral_load_cascade(
    line_list: DataFrame, as_of, ages: tuple[int, int] = (0, 18), therapy_months: int = 2, split_no_result: bool = False
) -> DataFrame:
    """Nested stages with the share of the stage before and the rest.

    In care, on therapy for ``therapy_months``, covered by a test, suppressed.
    A test covers for twelve months; with ``split_no_result`` it must lie after
    the first day of the previous month a year ago, and people due for a test
    whose result is missing are counted apart and not as covered.
    """
    on_therapy = F.col("arv_start_date") <= F.add_months(as_date(as_of), -therapy_months)
    since = reference_month_last_year(as_of) if split_no_result else F.add_months(as_date(as_of), -12)
    tested = on_therapy & (F.col("last_viral_load_collection_date") >= since)
    no_result = tested & F.col("suppressed").isNull() & (F.col("eligibility") == "YES")
    covered = tested & ~F.coalesce(no_result, F.lit(False)) if split_no_result else tested
    suppressed = covered & (F.upper("suppressed") == "OUI")
    counts = line_list.where(F.col("age").between(*ages)).agg(
        F.count(F.lit(1)).alias("s0"),
        F.count_if(on_therapy).alias("s1"),
        F.count_if(covered).alias("s2"),
        F.count_if(suppressed).alias("s3"),
        F.count_if(no_result if split_no_result else F.lit(False)).alias("no_result"),
    )
    names = ["in_care", "on_therapy", "covered", "suppressed"]
    rows = []
    for i, name in enumerate(names):
        before = F.col(f"s{max(i - 1, 0)}")
        rows.append(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("stage"),
                F.col(f"s{i}").alias("n"),
                safe_pct(F.col(f"s{i}"), before).alias("pct_of_previous"),
                (before - F.col(f"s{i}")).alias("not_reached"),
            )
        )
    return counts.select(F.inline(F.array(*rows)), "no_result")


def pediatric_line_list(
    positives: DataFrame,
    regimes: DataFrame,
    club_members: DataFrame,
    infants: DataFrame,
    followups: DataFrame,
    sites: DataFrame,
    as_of,
    infant_category: str = "regime_infant_treatment",
) -> DataFrame:
    """One row per child in care with the newest of everything.

    The population is the union of positive children, children on treatment
    and members of children's clubs. Only real tests rank as newest and
    previous load. An unknown result stays unknown, so no column mixes dates
    and texts.
    """
    children_clubs = club_members.where("club_type <> 1")
    people = latest.union_distinct(
        positives.select("id_patient"),
        regimes.where(F.col("category") == infant_category).select("id_patient"),
        children_clubs.select("id_patient"),
    )
    loads = latest.latest_and_previous(
        followups.withColumn("load", F.struct("viral_load_date", "viral_load_count", "viral_load_indetectable")),
        "id_patient",
        [F.col("viral_load_date").desc_nulls_last(), F.col("id").desc()],
        ["load"],
        where=F.col("took_viral_load_test") == 1,
    )
    visits = latest.latest_per_key(followups, "id_patient", [F.col("date").desc(), F.col("id").desc()]).select(
        "id_patient", F.col("date").alias("last_followup_date"), "next_appointment_date"
    )
    therapy = regimes.groupBy("id_patient").agg(F.min("start_date").alias("arv_start_date"))
    names = aggregate.string_agg_by(regimes, "id_patient", F.col("regime"), "regimes", "-")
    starts = aggregate.string_agg_by(regimes, "id_patient", F.col("start_date"), "all_arv_start_date", " | ")
    clubs = latest.latest_per_key(children_clubs, "id_patient", [F.col("club_type")]).select("id_patient", "club_type")

    # one partitioning by patient serves all joins but the last
    rows = joins.left_star(
        people,
        (infants, "id_patient"),
        (loads, "id_patient"),
        (visits, "id_patient"),
        (therapy, "id_patient"),
        (names, "id_patient"),
        (starts, "id_patient"),
        (clubs, "id_patient"),
        (sites, "id_hospital"),
    )
    count, undetectable = F.col("last_load.viral_load_count"), F.col("last_load.viral_load_indetectable") == 1
    low = undetectable | (count < 1000)
    return rows.select(
        "id_patient",
        "site",
        "office",
        "departement",
        decode("gender", SEXES, keep_unknown=True).alias("sex"),
        complete_years(F.col("dob"), as_of).cast("int").alias("age"),
        F.coalesce(decode("club_type", CLUB_TYPES), F.lit("not_in_club")).alias("club_type"),
        F.col("last_load.viral_load_date").alias("viral_load_date"),
        count.alias("viral_load_count"),
        F.col("previous_load.viral_load_date").alias("prev_viral_load_date"),
        F.col("previous_load.viral_load_count").alias("prev_viral_load_count"),
        suppressed_flag(undetectable, count).alias("suppressed"),
        next_test_date("last_load.viral_load_date", low).alias("next_viral_load_date"),
        test_eligible("last_load.viral_load_date", low, "arv_start_date", as_of).alias("eligibility"),
        "arv_start_date",
        "regimes",
        "all_arv_start_date",
        "last_followup_date",
        "next_appointment_date",
        active_within("last_followup_date", as_of).alias("seen_in_12_months"),
        appointment_gap_bucket("last_followup_date", "next_appointment_date").alias("mms"),
        *[c.alias(n) for n, c in lost_to_followup_flags("next_appointment_date", as_of).items()],
    )


def club_membership_gap(line_list: DataFrame, ages: tuple[int, int] = (9, 17), clubs: Sequence[str] = ("club_9_12", "club_13_17")) -> DataFrame:
    """Place of every child against the clubs of its age."""
    in_age = F.col("age").between(*ages)
    label = (
        F.when(in_age & F.col("club_type").isin(*clubs), "in_club")
        .when(in_age, "in_age_not_in_club")
        .otherwise("out_of_age")
    )
    return line_list.withColumn("club_status", label)


def current_in_care(line_list: DataFrame, *, offices: Sequence, networks: Sequence, sites: Sequence, order: Sequence[Column]) -> DataFrame:
    """Children in care: exclusions that keep unknown values, age 0-17, one row each."""
    rows = line_list
    for col, values in (("office", offices), ("network", networks), ("site", sites)):
        rows = filters.exclude_values(rows, col, values)
    rows = rows.where(F.col("age").between(0, 17) & differs("is_abandoned", 1))
    return latest.latest_per_key(rows, "patient_code", order)


def household_coverage(index_children: DataFrame, additions: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Index children with and without a household count, codes in any case; they come out upper."""
    one = latest.latest_per_key(index_children, "patient_code", order)
    counted = additions.select(F.lower("patient_code").alias("_code")).where("_code is not null").distinct().withColumn("_found", F.lit(True))
    marked = one.withColumn("_code", F.lower("patient_code")).join(counted, "_code", "left")
    marked = marked.withColumn("patient_code", F.upper("patient_code"))
    return marked.withColumn("has_household", F.when(F.col("_found"), "yes").otherwise("no")).drop("_code", "_found")


def sibling_testing_cascade(children: DataFrame, relationship: str = "3") -> DataFrame:
    """Households with siblings aged 0-17 by testing stage.

    Every stage judges the household by any of its siblings, so tested is
    inside total, and positive, negative and unknown are inside tested.
    Untested households have a sibling who was offered and not tested, and
    none who was.
    """
    siblings = children.where((F.col("infant_relationship") == relationship) & F.col("age_in_year").between(0, 17))
    tested = F.col("hiv_test") == "1"
    result = F.col("hiv_test_result")
    per_case = siblings.groupBy("caseid").agg(
        F.max(tested).alias("tested"),
        F.max(tested & (result == "positif")).alias("positive"),
        F.max(tested & (result == "negatif")).alias("negative"),
        F.max(tested & F.coalesce(~result.isin("positif", "negatif"), F.lit(True))).alias("unknown"),
        F.max((F.col("hiv_test") == "2") & differs("is_accepted", "0")).alias("offered"),
    )
    stages = {
        "total": F.count(F.lit(1)),
        "tested": F.count_if("tested"),
        "negative": F.count_if("negative"),
        "unknown": F.count_if("unknown"),
        "positive": F.count_if("positive"),
        "untested": F.count_if(F.col("offered") & ~F.coalesce("tested", F.lit(False))),
    }
    row = per_case.agg(*[c.alias(n) for n, c in stages.items()])
    cells = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("n")) for i, n in enumerate(stages)])
    return row.select(F.inline(cells))


