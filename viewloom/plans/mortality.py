"""Yearly mortality snapshots from a policy mutation log.

Every policy coverage is reported once per year from its first mutation on, as it stood at the end of the
year (EoY) and on its first day (BoY). The log is keyed by policy and sorted by processing date, change
number and mutation date. Frames that several branches read are written once while the report is planned
(``session.materialize``); the report itself is lazy, and the caller runs the last action.

Scale: a policy may hold a large share of the log. Ordered steps use the two-level scans of
``viewloom.operators.scans``, or windows over whole policies where none holds more than ``CROWDED`` rows; "latest" steps are aggregations; conditions on other rows of a policy are
reduced to one bound per key before the join. Each join has at most a handful of rows per key on one side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from viewloom.functions import scalar as fn
from viewloom.operators.scans import (
    Ordering,
    last_known,
    latest_values,
    next_value,
    previous_values,
    running,
    running_count,
)
from viewloom.operators.temporal import cut_after_event, latest_before, valid_at, without_event, year_spine
from viewloom.session import materialize

# Fields of the mutation log and the names used here. A leading ``_BIC_`` is ignored.
LOG_FIELDS = {
    "ZMUTID": "mutation_id",
    "ZVTAID": "vta_id",
    "ZPDEELNID": "participant_id",
    "ZVERW_DAT": "processed_on",
    "MWYZVLGNR": "change_no",
    "ZMUTDATE": "mutated_on",
    "ZMUTJAAR": "mutation_year",
    "ZAANSTYP": "claim_type",
    "ZVZ_GROEP": "insured_group",
    "MMUTCOD": "mutation_code",
    "ZPDEELID": "policy",
    "ZEVENTID": "event",
    "ZVVAANTP": "coverage",
    "ZWERKGID": "employer",
    "ZINDATPOL": "policy_start",
    "ZVSTATP": "policy_status",
    "ZVVSTATP": "vta_policy_status",
    "ZVVSTATA": "vta_claim_status",
    "ZVSTATA": "claim_status",
    "ZVFINSTA": "financing_status",
    "ZBSN1": "bsn_1",
    "ZGESL": "gender_1",
    "ZGEBDAT": "birth_1",
    "ZSTEDAT": "death_1",
    "ZTYPE": "kind",
    "ZVZBSN": "bsn_2",
    "ZVZGESL": "gender_2",
    "ZVZGEBDAT": "birth_2",
    "ZVZSTEDAT": "death_2",
    "ZTGZ_BDR": "promised",
    "ZVERBDR": "insured",
    "ZLTSAL": "salary",
    "ZLTSALDT": "salary_date",
    "ZBSSALAM": "salary_base",
    "MBETTCP": "payment_term",
    "MBETMCP": "payment_moment",
    "ZPRVMUTID": "previous_mutation",
    "ZPENREGID": "pension_slice",
}

# Codes of the log.
START, CHANGE, END = "510_ONLY", "BOTH", "508_ONLY"
OLD_AGE, PARTNER = ("007",), ("008", "015")
DEATH_1, DEATH_2 = ("E001", "B001"), ("E002", "B002")
EOY, BOY, DEATH_SNAPSHOT = "EoY Snapshot", "BoY Snapshot", "Death Snapshot"
FIRST_REPORT_YEAR = 2000
ADMINISTRATION = "LEGO"

SORT = ("processed_on", "change_no", "mutated_on")
COVERAGE = ("policy", "claim_type", "insured_group", "coverage")
BEFORE = {
    "policy_status": "prev_policy_status",
    "vta_policy_status": "prev_vta_policy_status",
    "promised": "prev_promised",
    "claim_status": "prev_claim_status",
    "vta_claim_status": "prev_vta_claim_status",
    "insured": "prev_insured",
}
# rows of a policy from which on its ordered steps go by chunks
CROWDED = 100_000
# what the report takes from the persons, or not at all
PERSONAL = ("participant_id", "mutation_code", "bsn_1", "gender_1", "birth_1", "death_1", "bsn_2", "gender_2", "birth_2", "death_2")


@dataclass(frozen=True)
class SnapshotParams:
    """``include_corrections`` also reports deaths known from correction mutations only.

    The source text drops every mutation that corrects another one before it looks at corrections, which
    leaves that branch without rows; here the switch decides about both.
    """

    processed_until: str
    year_until: int
    include_corrections: bool = True


# --- the log ----------------------------------------------------------------------------------


def distinct_rows(rows: DataFrame, o: Ordering) -> DataFrame:
    """Distinct rows; where keys stay whole, these meet by the keys already, and the scan behind needs no other shuffle."""
    return (rows.repartition(*o.keys) if o.whole else rows).distinct()


def crowded(rows: DataFrame) -> bool:
    """Does a policy, its segments included, hold more rows than one task should sort?"""
    return not rows.groupBy(policy_root().alias("root")).count().filter(F.col("count") > CROWDED).isEmpty()


def log_order(*keys: str, last: Sequence[str] = ("mutation_id",), descending: bool = False, whole: bool = False) -> Ordering:
    """The order of the log within ``keys``; ``last`` decides between mutations of the same moment.

    A chunk is a processing date, and for dates with very many changes (an initial load) a range of them.
    """
    chunk = F.struct(F.col("processed_on"), F.floor(F.col("change_no") / 100_000))
    return Ordering(keys, (*SORT, *last), descending, chunk, whole)


def base_mutations(log: DataFrame, p: SnapshotParams, repeats: bool = False) -> DataFrame:
    """Mutations up to the parameters, with the year they first count on 1 January and the correction flag.

    ``repeats`` leaves repeated rows in, for steps that take the latest or greatest: all columns of the log need not be shuffled for these.
    """
    plain = log.toDF(*[c.removeprefix("_BIC_") for c in log.columns])
    rows = plain.select(*[F.col(source).alias(name) for source, name in LOG_FIELDS.items()])
    rows = rows.filter((F.col("processed_on") <= p.processed_until) & (F.col("mutation_year") <= p.year_until))
    if not p.include_corrections:
        rows = rows.filter(F.col("previous_mutation") == "")
    on_new_year = F.substring("mutated_on", 5, 4) == "0101"
    derived = rows.withColumns(
        {
            "begin_year": F.col("mutation_year") + F.when(on_new_year, 0).otherwise(1),
            "birth_1": F.when(F.col("birth_1") == fn.BLANK_DATE, "").otherwise(F.col("birth_1")),
            "correction": F.when(F.col("previous_mutation") != "", "X").otherwise(""),
        }
    )
    derived = derived.drop("previous_mutation")
    return derived if repeats else derived.distinct()


def segment_reuse(mutations: DataFrame, whole: bool = False) -> DataFrame:
    """Policies that were closed and started again for somebody else, with the id of each later segment.

    Our definition: per policy and moment the highest kind tells whether everything ended; a segment opens
    where everything had ended before and a later moment starts again with another birth date.
    """
    normal = mutations.filter(F.col("correction") == "")
    moments = normal.groupBy("policy", *SORT).agg(F.max("kind").alias("state"), F.max("birth_1").alias("birth"))
    order = log_order("policy", last=(), whole=whole)
    stepped = previous_values(moments, order, {"__state": F.col("state"), "__birth": F.col("birth")})
    opens = (F.col("__state") == END) & (F.col("state") != END) & (F.col("birth") != F.col("__birth"))
    flagged = stepped.select("policy", *SORT, F.when(opens, 1).alias("__opens"))
    counted = running_count(flagged, order, "__opens", "segment")
    reused = counted.filter(F.col("segment") > 0)
    return reused.select("policy", *SORT, F.concat("policy", F.lit("_"), F.col("segment").cast("string")).alias("reused_id"))


def policy_root(policy: str = "policy") -> Column:
    """What a policy and its segments have in common: the id without trailing segment numbers."""
    return F.regexp_replace(policy, r"(_[0-9]+)+\z", "")


def with_new_ids(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Give reused policies their segment id, then sum the insured amount over pension slices; repeated rows count once.

    All columns cross one shuffle, by the root of the policy and the moment: repeated rows, slices and segment ids meet there. Segments share
    the root of their policy, so the sum under the new id needs no other shuffle; the ids of a root and moment come as a list, as policy and
    segment of one root may both exist.
    """
    spot = ["root", *SORT]
    reused = segment_reuse(rows, whole).withColumn("root", policy_root())
    ids = reused.groupBy(*spot).agg(F.collect_list(F.struct("policy", "reused_id")).alias("reused"))
    log = rows.withColumn("root", policy_root()).repartition(*spot).distinct()
    own = F.filter("reused", lambda entry: entry["policy"] == F.col("policy"))
    renamed = log.join(ids, spot, "left").withColumn("policy", F.coalesce(F.get(own, F.lit(0))["reused_id"], "policy"))
    keys = [c for c in rows.columns if c not in ("insured", "pension_slice")]
    return renamed.groupBy("root", *keys).agg(F.sum("insured").alias("insured")).drop("root")


_STATE = [
    "mutation_id", "policy", "coverage", "claim_type", *SORT, "event", *BEFORE, "kind", "bsn_1", "death_1", "death_2",
    "correction",
]


def coverage_states(mutations: DataFrame, whole: bool = False) -> DataFrame:
    """Mutations on coverage level, each pointing to its successor; corrections form their own chain."""
    order = log_order("policy", "coverage", "correction", whole=whole)
    return next_value(distinct_rows(mutations.select(*_STATE), order), order, "mutation_id", "next_mutation")


def attach_previous(mutations: DataFrame, states: DataFrame) -> DataFrame:
    """Add what the predecessor of each mutation said."""
    before = states.filter(F.col("next_mutation").isNotNull()).select(
        F.col("next_mutation").alias("mutation_id"), "coverage", *[F.col(c).alias(n) for c, n in BEFORE.items()]
    )
    before = before.distinct()  # narrow here, where repeated predecessors would repeat whole mutations
    return mutations.join(before, ["mutation_id", "coverage"], "left")


# --- persons and deaths -----------------------------------------------------------------------


def person_feed(transactions: DataFrame) -> DataFrame:
    """Personal data and deaths of the first and second insured as rows of one shape, read in one pass."""

    def entry(role: str, purpose: str, birth, gender, bsn, death, event, when: Column | None) -> Column:
        row = F.struct(
            F.lit(role).alias("role"), F.lit(purpose).alias("purpose"), birth.alias("birth"), gender.alias("gender"),
            bsn.alias("bsn"), death.alias("death"), event.alias("event"),
        )
        return row if when is None else F.when(when, row)

    no, c = F.lit(""), F.col
    entries = [
        entry("First", "Death", no, no, no, c("death_1"), c("event"), c("event").isin("E001", "R001")),
        entry("First", "GBB", c("birth_1"), c("gender_1"), c("bsn_1"), no, no, None),
        entry("Second", "Death", no, no, no, c("death_2"), c("event"),
              c("event").isin("E002", "R002") & c("claim_type").isin(*PARTNER)),
        entry("Second", "GBB", c("birth_2"), c("gender_2"), c("bsn_2"), no, no, c("birth_2") != fn.BLANK_DATE),
    ]
    exploded = transactions.select("policy", *SORT, F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return exploded.select("policy", *SORT, "e.*").distinct()


def latest_person(feed: DataFrame) -> DataFrame:
    """Latest row per policy, role and purpose.

    Our definition: personal data count only where birth date, gender or BSN is filled; of deaths the last
    event counts, a reversal too, so the caller asks for the death event.
    """
    filled = (F.col("birth") != "") | (F.col("gender") != "") | (F.col("bsn") != "")
    rows = feed.filter((F.col("purpose") != "GBB") | filled)
    return latest_values(rows, ["policy", "role", "purpose"], SORT, ["birth", "gender", "bsn", "death", "event"])


def normal_deaths(persons: DataFrame, role: str, event: str) -> DataFrame:
    """Deaths whose last event was not reversed."""
    rows = persons.filter((F.col("role") == role) & (F.col("purpose") == "Death") & (F.col("event") == event))
    return rows.select("policy", "death", F.lit("").alias("death_source"))


def correction_deaths(corrections: DataFrame, death: str, normal: DataFrame) -> DataFrame:
    """Deaths that only corrections know, together with the normal ones."""
    extra = without_event(corrections.select("policy", F.col(death).alias("death")).distinct(), normal, ["policy"])
    return extra.withColumn("death_source", F.lit("X")).unionByName(normal).distinct()


def state_before_death(states: DataFrame, corrections: DataFrame, types: Sequence[str], death: str) -> DataFrame:
    """Last normal state of the coverage before a death that a correction reports."""
    normal = states.filter((F.col("correction") == "") & F.col("claim_type").isin(*types))
    found = latest_before(normal, corrections, ["policy"], SORT, "mutated_on", "processed_on", death)
    return found.select("policy", *[F.col(c).alias(n) for c, n in BEFORE.items()]).distinct()


@dataclass(frozen=True)
class Deaths:
    """Deaths of the first and second insured and the states before those known from corrections only."""

    first: DataFrame
    second: DataFrame
    before_first: DataFrame
    before_second: DataFrame


def find_deaths(states: DataFrame, persons: DataFrame, p: SnapshotParams) -> Deaths:
    normal_1 = normal_deaths(persons, "First", "E001")
    corrections = states.filter(F.col("correction") == "X")
    by_1 = corrections.filter(F.col("event") == "B001")
    by_2 = corrections.filter(F.col("event") == "B002")
    if not p.include_corrections:
        # no rows: the report asks for these states only where a correction reports the death
        none = states.limit(0)
        before_1, before_2 = (state_before_death(none, none, coverages, name) for coverages, name in ((OLD_AGE, "death_1"), (PARTNER, "death_2")))
        return Deaths(normal_1, normal_1.limit(0), before_1, before_2)
    before_1 = state_before_death(states, by_1, OLD_AGE, "death_1")
    before_2 = state_before_death(states, by_2, PARTNER, "death_2")
    first = correction_deaths(by_1, "death_1", normal_1)
    ended_2 = by_2.filter(F.col("kind") == END)
    second = correction_deaths(ended_2, "death_2", normal_deaths(persons, "Second", "E002"))
    return Deaths(first, second, before_1, before_2)


def personal_info(transactions: DataFrame, persons: DataFrame, deaths: Deaths) -> DataFrame:
    """One row per policy (per death date, if there are several) with both persons side by side."""
    own = persons.filter(F.col("purpose") == "GBB")
    sides = [
        F.max(F.when(F.col("role") == role, F.col(field))).alias(f"{field}_{no}")
        for no, role in ((1, "First"), (2, "Second"))
        for field in ("gender", "bsn", "birth")
    ]
    wide = transactions.select("policy").distinct().join(own.groupBy("policy").agg(*sides), "policy", "left")
    first = deaths.first.select("policy", F.col("death").alias("death_1"), F.col("death_source").alias("source_1"))
    second = deaths.second.select("policy", F.col("death").alias("death_2"), F.col("death_source").alias("source_2"))
    return wide.join(first, "policy", "left").join(second, "policy", "left").distinct()


# --- years ------------------------------------------------------------------------------------


def relevant_transactions(transactions: DataFrame, deaths: Deaths) -> DataFrame:
    """Drop corrections, except those that report a counted death; cut coverages after such a death.

    The three parts differ in correction or event: distinct rows stay so.
    """
    ended = transactions.filter((F.col("correction") == "X") & (F.col("kind") == END))

    def reporting(event: str, death: str, known: DataFrame) -> DataFrame:
        dates = known.filter(F.col("death_source") == "X").select("policy", F.col("death").alias(death))
        return ended.filter(F.col("event") == event).join(dates, ["policy", death], "left_semi").select(*ended.columns)

    kept = transactions.filter(F.col("correction") == "")
    kept = kept.unionByName(reporting("B001", "death_1", deaths.first))
    kept = kept.unionByName(reporting("B002", "death_2", deaths.second))
    closing = kept.filter(F.col("event").isin("B001", "B002") & (F.col("kind") == END))
    return cut_after_event(kept, closing, ["policy", "coverage"], "processed_on")


def yearly_states(relevant: DataFrame, p: SnapshotParams, whole: bool = False) -> DataFrame:
    """Coverage, report year and snapshot kind with the mutation that counts for it.

    A mutation counts for its year unless a mutation processed later belongs to an earlier year: the running
    minimum from the latest processing backwards finds that. Years without mutation take the last known one.
    """
    starts = relevant.groupBy(*COVERAGE).agg(F.min("mutation_year").alias("start"))
    columns = ["policy", "coverage", *SORT, "mutation_id", "kind", "event", "mutation_year", "begin_year"]
    backwards = log_order("policy", "coverage", descending=True, whole=whole)
    settled = running(
        relevant.select(*columns),
        backwards,
        {"settled_year": (F.min, "mutation_year"), "settled_begin": (F.min, "begin_year")},
    )
    # a mutation may count for the year it falls in (EoY) and for the year it opens (BoY)
    counts = F.array(
        F.when(
            F.col("mutation_year") == F.col("settled_year"),
            F.struct(F.lit(EOY).alias("snapshot"), F.col("mutation_year").alias("report_year")),
        ),
        F.when(
            F.col("begin_year") == F.col("settled_begin"),
            F.struct(F.lit(BOY).alias("snapshot"), F.col("begin_year").alias("report_year")),
        ),
    )
    counting = settled.select(*columns, F.inline(F.array_compact(counts)))
    keys = ["policy", "coverage", "snapshot", "report_year"]
    last = latest_values(counting, keys, (*SORT, "mutation_id"), ["kind", "event", *SORT])
    link = {c: f"link_{c}" for c in SORT}
    hit = F.struct("report_year", "snapshot", "kind", "event", *[F.col(c).alias(n) for c, n in link.items()])
    # at most two hits a year: the years of a coverage are filled in its row, and only the filled ones become rows
    hits = last.filter(F.col("mutated_on").isNotNull()).groupBy("policy", "coverage").agg(F.collect_list(hit).alias("hits"))
    found = starts.withColumn("first", F.col("start")).join(hits, ["policy", "coverage"])
    years = year_spine(found, "start", p.year_until, "report_year")
    years = years.select("*", F.explode(F.array(F.lit(EOY), F.lit(BOY))).alias("snapshot"))

    def so_far(h: Column) -> Column:
        return (h["snapshot"] == F.col("snapshot")) & h["report_year"].between(F.col("first"), F.col("report_year"))

    filled = years.withColumn("latest", F.array_max(F.filter("hits", so_far)))
    latest = [F.col(f"latest.{c}").alias(c) for c in ("kind", "event", *link.values())]
    return filled.select(*COVERAGE, "snapshot", "report_year", *latest).filter(F.col("kind").isNotNull())


def valid_years(states: DataFrame, first_deaths: DataFrame) -> DataFrame:
    """Years to report: running coverages, and ended ones in the year of a death."""
    c = F.col
    joined = states.filter(c("report_year") >= FIRST_REPORT_YEAR).join(
        first_deaths.select("policy", c("death").alias("__death"), c("death_source").alias("__source")), "policy", "left"
    )
    death_year = fn.to_int(fn.leftstr("__death", 4))
    link_year = fn.to_int(fn.leftstr("link_mutated_on", 4))
    ended, in_link_year = c("kind") == END, c("report_year") == link_year
    own = c("claim_type").isin(*OLD_AGE)
    corrected = (c("__source") == "X") & own

    end_of_year_death = ended & in_link_year & (c("snapshot") == EOY)
    shown = (
        F.when(corrected & (c("report_year") < death_year), ~ended)
        .when(corrected & (c("report_year") == death_year) & in_link_year & ended, F.lit(True))
        .when(corrected & (c("report_year") > death_year), F.lit(False))
        .when(end_of_year_death & own & (c("event") == "E001"), F.lit(True))
        .when(end_of_year_death & c("claim_type").isin(*PARTNER) & c("event").isin(*DEATH_2), F.lit(True))
        .otherwise(c("kind").isin(START, CHANGE))
    )
    return joined.filter(shown).drop("__death", "__source")


def fill_salaries(relevant: DataFrame, whole: bool = False) -> DataFrame:
    """Salary, its date and base of every mutation; where the salary is missing, the last known ones.

    Our definition: a salary is missing when it is NULL or zero; the three fields are taken together.
    """
    order = log_order("policy", whole=whole)
    rows = distinct_rows(relevant.select("mutation_id", "policy", *SORT, "salary", "salary_date", "salary_base"), order)
    triple = {c: F.col(c) for c in ("salary", "salary_date", "salary_base")}
    return last_known(rows, order, triple, known=F.col("salary").isNotNull() & (F.col("salary") != 0))


def addresses_of(persons: DataFrame, addresses: DataFrame, income: DataFrame) -> DataFrame:
    """Address history of the persons at hand, with the income class of the postcode."""
    known = addresses.join(persons.select(F.col("bsn").alias("BSN")).distinct(), "BSN", "left_semi")
    classed = known.join(income, "POSTCODE", "left")
    return classed.select(
        F.col("BSN").alias("bsn"), F.col("SNAPSHOT_TYPE").alias("snapshot"), "ADDR_VALID_FROM", "ADDR_VALID_TO",
        F.col("POSTCODE").alias("postcode"), F.col("BUITENLAND").alias("abroad"), F.col("HH_INKOM").alias("income_class"),
    )


# --- report -----------------------------------------------------------------------------------


def _report_columns() -> dict[str, Column]:
    """Output columns in report order.

    Aliases: a = year state, b = its mutation, d = persons, with c1/c2 = states before a corrected death.
    """
    c = F.col
    year, snapshot, kind = c("a.report_year"), c("a.snapshot"), c("a.kind")
    own, partner = c("a.claim_type").isin(*OLD_AGE), c("a.claim_type").isin(*PARTNER)
    died_1, died_2 = c("a.event").isin(*DEATH_1), c("a.event").isin(*DEATH_2)
    death_year_1, death_year_2 = fn.year8("d.death_1"), fn.year8("d.death_2")
    dead_on_new_year_1 = fn.midstr("d.death_1", 5, 4) == "0101"
    boy, eoy = snapshot == BOY, snapshot == EOY
    # a death on 1 January already counts for the BoY snapshot, any other for the EoY snapshot of the year
    counts_1 = eoy | (boy & dead_on_new_year_1)
    counts_2 = eoy | (boy & (fn.midstr("d.death_2", 5, 4) == "0101"))
    in_death_year_1 = (year == death_year_1) & counts_1
    corrected_1 = (c("d.source_1") == "X") & own & in_death_year_1
    corrected_2 = (c("d.source_2") == "X") & partner & (year == death_year_2) & counts_2
    ended_partner = (c("a.event") == "E002") & partner & (kind == END)
    normal_death = ((c("a.event") == "E001") & own) | ((c("a.event") == "E002") & partner)

    no_amount = (died_1 & own) | (died_2 & partner & (kind == END)) | (own & in_death_year_1)

    def amount(field: str) -> Column:
        return F.when(no_amount, F.lit(0)).otherwise(c(f"b.{field}"))

    def or_zero(field: str) -> Column:
        return F.when(c(field) == "", "0").otherwise(c(field))

    def before(field: str, zero: bool = False) -> Column:
        first = c(f"c1.{field}")
        if zero:
            first = F.coalesce(first, F.lit("0"))
        return F.when(corrected_1, first).when(normal_death, c(f"b.{field}")).when(corrected_2, c(f"c2.{field}"))

    def amount_before_1(field: str) -> Column:
        ended_own = (c("a.event") == "E001") & own & (kind == END)
        return F.when(ended_own, c(f"b.{field}")).when(corrected_1, c(f"c1.{field}")).otherwise(F.lit(0))

    def amount_before_2(field: str) -> Column:
        return F.when(ended_partner, c(f"b.{field}")).when(corrected_2, c(f"c2.{field}")).otherwise(F.lit(0))

    def status_before_2(field: str, blank: str) -> Column:
        at_death = ended_partner & (year == death_year_2)
        return (
            F.when(at_death, F.coalesce(c(f"b.{field}"), F.lit(blank)))
            .when(corrected_2, c(f"c2.{field}"))
            .otherwise(F.lit(blank))
        )

    age_1 = year - fn.year8("d.birth_1")
    # the age shows while the person lives; the year of death has its own column
    mutated_after = fn.year8("b.mutated_on") >= death_year_1
    gone_1 = (
        (mutated_after & boy & (year > death_year_1))
        | (mutated_after & eoy)
        | ((year >= death_year_1) & counts_1)
    )
    unknown_birth = c("d.birth_1") == ""
    dies_here = (died_1 & (fn.year8("b.mutated_on") == year)) | in_death_year_1
    age_2 = fn.age("a.report_year", "d.birth_2")

    return {
        "VTA": F.lit(ADMINISTRATION),
        "ZEVENTID": c("a.event"),
        "POLIS_ID": c("a.policy"),
        "CONTRACT_ID": F.lit(""),
        "AANSPRAAK_ID": fn.cat("a.policy", F.lit("#"), "a.coverage"),
        "RAPPORTAGE_MUTATIE_JAAR": year,
        "MUTATIE_DATUM": fn.sap_date("b.mutated_on"),
        "VERWERKINGS_MOMENT": fn.sap_timestamp(fn.midstr("b.mutation_id", 14, 18)),
        "COMMERCIEEL_PRODUCT_CODE": F.lit("0"),
        "COMMERCIEEL_PRODUCT": F.lit(""),
        "AANSPRAAK_TYPE": or_zero("a.claim_type"),
        "AANSPRAAK_STATUS": or_zero("b.claim_status"),
        "AANSPRAAK_FINANCIERINGS_STATUS": c("b.financing_status"),
        "VERZEKERINGS_GROEP": c("a.insured_group"),
        "POLIS_STATUS": or_zero("b.policy_status"),
        "INGANGSDATUM_POLIS": c("b.policy_start"),
        "VERZEKERD_BEDRAG": amount("insured"),
        "TOEGEZEGD_BEDRAG": amount("promised"),
        "DEELNEMER_ID": c("a.policy"),
        "VERZEKERDE_GESLACHT": c("d.gender_1"),
        "VERZEKERDE_BSN": c("d.bsn_1"),
        "VERZEKERDE_BSN_HASHED": fn.hash_id("d.bsn_1"),
        "VERZEKERDE_GEB_DATUM": fn.sap_date("d.birth_1"),
        "VERZEKERDE_STERFTE_DATUM": fn.sap_date("d.death_1"),
        "VERZEKERDE_LEEFTIJD": F.when(unknown_birth | died_1 | gone_1, None).otherwise(age_1),
        "VERZEKERDE_STERFTE_LEEFTIJD": F.when(unknown_birth, None).when(dies_here, age_1),
        "VERZEKERDE_ROOK_STATUS": F.lit(""),
        "VERZEKERDE_POST_CODE": c("postcode_1"),
        "VERZEKERDE_LAND": c("abroad_1"),
        "VERZORGDE_GESLACHT": c("d.gender_2"),
        "VERZORGDE_BSN": c("d.bsn_2"),
        "VERZORGDE_BSN_HASHED": fn.hash_id("d.bsn_2"),
        "VERZORGDE_GEB_DATUM": fn.sap_date("d.birth_2"),
        "VERZORGDE_STERFTE_DATUM": fn.sap_date("d.death_2"),
        "VERZORGDE_LEEFTIJD": F.when(partner & ~died_2, age_2),
        "VERZORGDE_STERFTE_LEEFTIJD": F.when(partner & died_2, age_2),
        "VERZORGDE_ROOK_STATUS": F.lit(""),
        "VERZORGDE_POST_CODE": c("postcode_2"),
        "VERZORGDE_LAND": c("abroad_2"),
        "VORIGE_POLIS_STATUS": before("prev_policy_status"),
        "VORIGE_VTA_POLIS_STATUS": before("prev_vta_policy_status"),
        "VORIGE_AANSPRAAK_STATUS": before("prev_claim_status", zero=True),
        "VORIGE_VTA_AANSPRAAK_STATUS": before("prev_vta_claim_status"),
        "VORIGE_VERZEKERD_BEDRAG": amount_before_1("prev_insured"),
        "VORIGE_TOEGEZEGD_BEDRAG": amount_before_1("prev_promised"),
        "VORIGE_VERZORGDE_AANSPRAAK_STATUS": status_before_2("prev_claim_status", "0"),
        "VORIGE_VERZORGDE_VTA_AANSPRAAK_STATUS": status_before_2("prev_vta_claim_status", ""),
        "VORIGE_VERZORGDE_VERZEKERD_BEDRAG": amount_before_2("prev_insured"),
        "VORIGE_VERZORGDE_TOEGEZEGD_BEDRAG": amount_before_2("prev_promised"),
        "WERKGEVER_CONTRACT_ID": c("b.employer"),
        "SALARIS": c("s.salary"),
        "DATUM_VASTSTELLING_SALARIS": c("s.salary_date"),
        "SALARIS_PENSIOENGRONDSLAG": c("s.salary_base"),
        "BETALING_TERM": c("b.payment_term"),
        "BETALING_MOMENT": c("b.payment_moment"),
        "VTA_ID": c("b.vta_id"),
        "VTA_AANSPRAAK_TYPE": c("a.coverage"),
        "VTA_AANSPRAAK_STATUS": c("b.vta_claim_status"),
        "VTA_POLIS_STATUS": c("b.vta_policy_status"),
        "PENSIOEN_LEEFTIJD": F.lit(None).cast("int"),
        "CORRECTION_APPLIED": c("d.source_1"),
        "SNAPSHOT": F.when(kind == END, DEATH_SNAPSHOT).otherwise(snapshot),
        "VERZEKERDE_INKOMENSKLASSE": c("income_class_1"),
        "VERZORGDE_INKOMENSKLASSE": c("income_class_2"),
        "VERZEKERDE_RATIO_TOEGEZEGD_BEDRAG": F.lit(0),
        "VERZORGDE_RATIO_TOEGEZEGD_BEDRAG": F.lit(0),
    }


def report(
    states: DataFrame, relevant: DataFrame, deaths: Deaths, info: DataFrame, salaries: DataFrame, history: DataFrame,
    p: SnapshotParams,
) -> DataFrame:
    """Join each reported year to its mutation, persons, salary and addresses."""
    # persons with the addresses of each report year and snapshot: small next to the mutations
    # what belongs to a policy comes with its persons: the mutations need not be shuffled for it
    for name, before in (("c1", deaths.before_first), ("c2", deaths.before_second)):
        info = info.join(before.select("policy", F.struct(*BEFORE.values()).alias(name)), "policy", "left")
    spots = states.select("policy", "report_year", "snapshot").distinct().join(info, "policy", "left")
    persons = spots
    for no in (1, 2):
        side = history.toDF(*[f"bsn_{no}" if n == "bsn" else n for n in history.columns])
        renamed = side.withColumnsRenamed({n: f"{n}_{no}" for n in ("postcode", "abroad", "income_class")})
        persons = valid_at(
            persons, renamed, [f"bsn_{no}", "snapshot"], "report_year", "ADDR_VALID_FROM", "ADDR_VALID_TO",
            [f"postcode_{no}", f"abroad_{no}", f"income_class_{no}"],
        )
    a, b, s, d = states.alias("a"), relevant.alias("b"), salaries.alias("s"), persons.alias("d")

    def moment(side: str) -> list[Column]:
        return [F.col(f"a.link_{c}") == F.col(f"{side}.{c}") for c in SORT]

    def equal(side: str, *columns: str) -> list[Column]:
        return [F.col(f"a.{c}") == F.col(f"{side}.{c}") for c in columns]

    return (
        a.join(b, equal("b", "policy", "coverage") + moment("b"), "left")
        .join(s, equal("s", "policy") + moment("s"), "left")
        .join(d, equal("d", "policy", "report_year", "snapshot"), "left")
        .select(*[column.alias(name) for name, column in _report_columns().items()])
    )


def mortality_snapshot(log: DataFrame, addresses: DataFrame, income: DataFrame, p: SnapshotParams) -> DataFrame:
    """The whole report. Frames that feed several branches are written once."""
    rows = base_mutations(log, p, repeats=True)
    whole = not crowded(rows)
    mutations = materialize(with_new_ids(rows, whole), "mutations")
    states = materialize(coverage_states(mutations, whole), "states")
    persons = materialize(latest_person(person_feed(mutations)), "persons")
    deaths = find_deaths(states, persons, p)
    info = personal_info(mutations, persons, deaths)
    relevant = relevant_transactions(mutations, deaths).drop(*PERSONAL)
    relevant = materialize(attach_previous(relevant, states), "relevant")
    shown = materialize(valid_years(yearly_states(relevant, p, whole), deaths.first), "years")
    history = addresses_of(persons, addresses, income)
    return report(shown, relevant, deaths, info, fill_salaries(relevant, whole), history, p)
