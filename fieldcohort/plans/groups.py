"""Savings groups and household gardens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import site_from_code
from ..operators import clean, filters, joins, latest, linkage


def active_groups(
    groups: DataFrame, active: DataFrame, agent_by_name: Mapping[str, str], agent_by_agent: Mapping[str, str]
) -> DataFrame:
    """Curated active groups plus all groups created after the newest of them.

    The agent is taken over by group name first, then by the former agent.
    """
    base = joins.semi_join(groups, active, "caseid")
    rows = latest.append_newer_than(base, groups, "creation_date")
    rows = clean.map_values(rows, "name", agent_by_name, "_agent").withColumn("username", F.coalesce("_agent", "username"))
    return clean.map_values(rows.drop("_agent"), "username", agent_by_agent, keep=True)


def savings_groups_active(
    groups: DataFrame,
    active: DataFrame,
    members: DataFrame,
    officers: DataFrame,
    known_duplicates: DataFrame,
    questionnaires: DataFrame,
    *,
    agent_by_name: Mapping[str, str],
    agent_by_agent: Mapping[str, str],
    newest: Sequence[Column],
) -> DataFrame:
    """Present members of active groups with agent, officer and newest questionnaire."""
    current = active_groups(groups, active, agent_by_name, agent_by_agent)
    agents = current.select(F.col("caseid").alias("caseid_group"), "username")
    rows = members.where("removing_date = '---'").join(agents, "caseid_group")
    rows = joins.left_lookup(rows, officers, "caseid_group", ["officer_name"])
    rows = linkage.remove_known_duplicates(rows, known_duplicates, "caseid")
    return rows.join(latest.latest_per_key(questionnaires, "caseid", newest), "caseid", "left")


def garden_active(
    gardens: DataFrame, sites: DataFrame, users: Sequence, start, end, not_area: str, blank: str = "---"
) -> DataFrame:
    """Open first-cycle gardens of listed agents with their site."""
    rows = gardens.withColumn("site", site_from_code("site_label", sep="-"))
    rows = filters.conjunctive_filter(
        rows,
        user="username",
        users=users,
        day="last_modified_date",
        start=start,
        end=end,
        closed=F.col("closed"),
        cycle_blank=F.col("cycle_4_start_date") == blank,
        area="address_department",
        not_area=not_area,
    )
    return joins.left_lookup(rows, sites, "site", ["status", "network", "commune", "departement", "office"])
