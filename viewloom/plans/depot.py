"""Depot duration: for how many years a depot can finance the indexation of a policy.

Policies reach depots through a relation list; per policy relation and category (active, inactive, both)
the latest balances and the bookings of the depots are summed and divided.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from viewloom.functions import scalar as fn
from viewloom.operators.nodes import aggregate, project, rank_node, value_filter
from viewloom.operators.relational import conditional_key_join, latest_load

# Codes of the source tables.
FINANCED = ("3", "7", "8")
INDEXED = ("3", "4")
NO_BOOKING = ("651", "652", "653", "654", "655", "656", "657")

# Columns of the base table.
BASE_COLUMNS = (
    "RELNR", "VOLGNR", "VZ_CD_PA", "GRPNR", "ACT_FIN_TYPE", "ACT_TOESL_CAT", "INACT_FIN_TYPE", "INACT_TOESL_CAT",
    "RUN_ID", "RUN_TYPE", "REFERENCE_DATE", "RUN_TIMESTAMP", "RUN_DATE",
)
GROUP = ("RELNR", "category")


@dataclass(frozen=True)
class DepotInputs:
    base: DataFrame
    amounts: DataFrame
    relations: DataFrame
    balances: DataFrame
    journal: DataFrame


def depot_relations(inputs: DepotInputs, reference_date: str) -> DataFrame:
    """Relations of the latest load with the depot amount of the year before the reference date."""
    last_year = str(int(reference_date[:4]) - 1)
    relations = project(
        latest_load(inputs.relations, "ZVALIDFRM"),
        {"RELNR": "RELNR", "TOESL_CAT_A_I": "TOESL_CAT_DLN", "RELNR_DEPOT": "RELNR_DEPOT", "GRPNR": "GRPNR"},
    )
    amounts = value_filter(inputs.amounts, {"JAAR": last_year}).select("RELNR_DEPOT", "SALDO_VJ")
    return relations.join(amounts, "RELNR_DEPOT", "inner")


def _category() -> Column:
    """Whether a depot counts for the active part, the inactive part or both, given the policy and the link."""
    active = F.col("ACT_FIN_TYPE").isin(*FINANCED) & F.col("ACT_TOESL_CAT").isin(*INDEXED)
    inactive = F.col("INACT_FIN_TYPE").isin(*FINANCED) & F.col("INACT_TOESL_CAT").isin(*INDEXED)
    link = F.col("TOESL_CAT_A_I")
    return (
        F.when(active & inactive & (link == "AI"), "AI")
        .when(active & link.isin("A", "AI"), "A")
        .when(inactive & link.isin("I", "AI"), "I")
        .otherwise("")
    )


def policy_depots(inputs: DepotInputs, reference_date: str) -> DataFrame:
    """Policies with the depots that finance them, one row per policy, depot and link."""
    base = aggregate(inputs.base, {c: c for c in BASE_COLUMNS})
    links = depot_relations(inputs, reference_date)
    # a link without group counts for all groups of the relation
    joined = conditional_key_join(base, links, "RELNR", "GRPNR", ["TOESL_CAT_A_I", "RELNR_DEPOT", "SALDO_VJ"])
    return joined.withColumn("category", _category()).filter(F.col("category") != "")


def balances(depots: DataFrame, mutations: DataFrame, reference_date: str) -> DataFrame:
    """Latest balance per relation, depot and category before 1 January of the reference year, summed.

    Policies fall away before the join, since the balances do not depend on them.
    """
    new_year = reference_date[:4] + "0101"
    links = depots.select(*GROUP, "TOESL_CAT_A_I", "RELNR_DEPOT", "SALDO_VJ").distinct()
    moves = mutations.filter(F.col("WYZ_VERWERK_DAT") < new_year).select(
        F.col("RELNR_PADDED").alias("RELNR_DEPOT"), "WYZ_VERWERK_DAT", "VRG_J_SLD_VERSCHUL"
    )
    # the last date of a depot is the same for all its links: rank the moves, then join the few that are left
    last = rank_node(moves, ["RELNR_DEPOT"], ["WYZ_VERWERK_DAT"])
    kept = links.join(last.distinct(), "RELNR_DEPOT", "inner")
    return kept.groupBy(*GROUP).agg(F.sum("VRG_J_SLD_VERSCHUL").alias("TMP_SALDO"), F.sum("SALDO_VJ").alias("SALDO_VJ"))


def bookings(depots: DataFrame, journal: DataFrame, reference_date: str, follow_note: bool) -> DataFrame:
    """Booked amounts per relation and category.

    The node joins every policy row to the journal, so a depot counts once per policy row. Both sides are
    aggregated first, and the number of policy rows multiplies the sum. With ``follow_note`` the written
    rule is used: bookings of the year before the reference date, each depot once.
    """
    lines = journal.filter(fn.not_in("BOEKCD", *NO_BOOKING))
    if follow_note:
        lines = lines.filter(F.col("BOEKJR") == str(int(reference_date[:4]) - 1))
    lines = aggregate(lines, {c: c for c in ("RELNR", "BOEK", "BOEKJR", "BOEKCD", "REF_YEAR", "REF_YEAR_MINUS_1")})
    booked = lines.groupBy(F.col("RELNR").alias("RELNR_DEPOT")).agg(F.sum(fn.comma_decimal("BOEK")).alias("booked"))
    if follow_note:
        links = depots.select(*GROUP, "RELNR_DEPOT").distinct().withColumn("n", F.lit(1))
    else:
        links = depots.distinct().groupBy(*GROUP, "RELNR_DEPOT").agg(F.count(F.lit(1)).alias("n"))
    joined = links.join(booked, "RELNR_DEPOT", "inner")
    total = F.sum((F.col("booked") * F.col("n")).cast("decimal(30,2)")).alias("TMP_BOEK")
    return joined.groupBy(*GROUP).agg(total)


def _duration(categories: tuple[str, ...], follow_note: bool) -> Column:
    """Years as text of at most three digits: blank when positive, the absolute value otherwise."""
    ratio = fn.safe_div("SALDO_VJ", "TMP_BOEK")
    whole = F.floor(ratio) if follow_note else fn.round0(ratio)
    years = fn.decfloat(fn.if_(F.col("category").isin(*categories), whole, F.lit(0)))
    text = F.when(years > 0, "").when(years < 0, fn.string(-years)).otherwise(fn.string(years))
    return fn.rightstr(text, 3)


def depot_duration(inputs: DepotInputs, reference_date: str, follow_note: bool = False) -> DataFrame:
    """The report: policy, its two durations and the summed depot amount."""
    depots = policy_depots(inputs, reference_date)
    policies = depots.select(*[c for c in depots.columns if c not in ("REFERENCE_DATE", "RUN_ID", "RUN_TYPE",
                              "RUN_TIMESTAMP", "RUN_DATE", "GRPNR")]).distinct().drop("SALDO_VJ")
    summed = balances(depots, inputs.balances, reference_date)
    booked = bookings(depots, inputs.journal, reference_date, follow_note)
    joined = policies.join(summed, list(GROUP), "inner").join(booked, list(GROUP), "inner")
    return joined.select(
        "RELNR",
        "VOLGNR",
        "VZ_CD_PA",
        _duration(("A", "AI"), follow_note).alias("MAX_DUUR_INDEXATIE_ACT"),
        _duration(("I", "AI"), follow_note).alias("MAX_DUUR_INDEXATIE_INACT"),
        "SALDO_VJ",
    )
