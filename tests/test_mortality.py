"""Hand-made mutation logs through the steps that have no counterpart to compare with."""

from conftest import rows
from pyspark.sql import functions as F

from viewloom.plans import mortality as mo

DEFAULTS = {source: "" for source in mo.LOG_FIELDS} | {
    "MWYZVLGNR": 1, "ZMUTJAAR": 2000, "ZTGZ_BDR": 10.0, "ZVERBDR": 5.0, "ZLTSAL": None, "ZBSSALAM": None, "ZAANSTYP": "007",
    "ZVVAANTP": "CP07", "ZVZGEBDAT": "00000000", "ZPDEELID": "P", "ZTYPE": "510_ONLY", "ZEVENTID": "M100", "ZGEBDAT": "19500101",
    "ZGESL": "M", "ZBSN1": "123", "ZPENREGID": "1",
}
NUMBERS = {"MWYZVLGNR": "int", "ZMUTJAAR": "int", "ZTGZ_BDR": "double", "ZVERBDR": "double", "ZLTSAL": "double", "ZBSSALAM": "double"}
ADDRESSES = "BSN string, SNAPSHOT_TYPE string, ADDR_VALID_FROM int, ADDR_VALID_TO int, POSTCODE string, BUITENLAND string"


def log(spark, *mutations):
    data = []
    for i, (date, fields) in enumerate(mutations):
        row = DEFAULTS | {"ZMUTID": f"M{i}", "ZVERW_DAT": date, "ZMUTDATE": date, "ZMUTJAAR": int(date[:4]), "MWYZVLGNR": i} | fields
        data.append(tuple(row[c] for c in mo.LOG_FIELDS))
    schema = ", ".join(f"_BIC_{c} {NUMBERS.get(c, 'string')}" for c in mo.LOG_FIELDS)
    return spark.createDataFrame(data, schema)


def report(spark, mutations, until=2003, corrections=True):
    addresses = spark.createDataFrame([("123", mo.EOY, 1990, 2002, "1000", ""), ("123", mo.EOY, 2002, 9999, "2000", "X")], ADDRESSES)
    income = spark.createDataFrame([("1000", "low")], "POSTCODE string, HH_INKOM string")
    params = mo.SnapshotParams("20031231", until, corrections)
    return mo.mortality_snapshot(log(spark, *mutations), addresses, income, params).cache()


START, DEATH = ("20000615", {}), ("20020310", {"ZTYPE": "508_ONLY", "ZEVENTID": "E001", "ZSTEDAT": "20020310"})


def test_yearly_rows_until_death(spark):
    got = report(spark, [START, DEATH])
    assert len(got.columns) == 66
    assert rows(got, "RAPPORTAGE_MUTATIE_JAAR", "SNAPSHOT", "VERZEKERD_BEDRAG", "VERZEKERDE_LEEFTIJD", "VERZEKERDE_STERFTE_LEEFTIJD") == [
        (2000, mo.EOY, 5.0, 50, None),
        (2001, mo.BOY, 5.0, 51, None),
        (2001, mo.EOY, 5.0, 51, None),
        (2002, mo.BOY, 5.0, 52, None),
        (2002, mo.DEATH_SNAPSHOT, 0.0, None, 52),
    ]
    last = got.filter(F.col("SNAPSHOT") == mo.DEATH_SNAPSHOT).first()
    assert (last.VORIGE_VERZEKERD_BEDRAG, last.VERZEKERDE_POST_CODE, last.VERZEKERDE_LAND) == (5.0, "2000", "X")
    first = got.filter("RAPPORTAGE_MUTATIE_JAAR = 2001").filter(F.col("SNAPSHOT") == mo.EOY).first()
    assert (first.VERZEKERDE_POST_CODE, first.VERZEKERDE_INKOMENSKLASSE) == ("1000", "low")


def test_reversed_death_is_no_death(spark):
    reversal = ("20020401", {"ZTYPE": "BOTH", "ZEVENTID": "R001", "ZSTEDAT": ""})
    got = report(spark, [START, DEATH, reversal])
    assert got.filter("VERZEKERDE_STERFTE_DATUM is not null").isEmpty()
    assert got.filter("RAPPORTAGE_MUTATIE_JAAR = 2003").count() == 2


CORRECTION = ("20020310", {"ZTYPE": "508_ONLY", "ZEVENTID": "B001", "ZSTEDAT": "20020310", "ZPRVMUTID": "M0"})


def test_death_known_from_a_correction(spark):
    with_it = report(spark, [START, CORRECTION])
    last = with_it.filter("RAPPORTAGE_MUTATIE_JAAR = 2002").filter(F.col("SNAPSHOT") == mo.DEATH_SNAPSHOT).first()
    assert (last.CORRECTION_APPLIED, last.VERZEKERD_BEDRAG, last.VORIGE_VERZEKERD_BEDRAG) == ("X", 0.0, 5.0)
    assert with_it.filter("RAPPORTAGE_MUTATIE_JAAR > 2002").isEmpty()
    without = report(spark, [START, CORRECTION], corrections=False)
    assert without.filter("RAPPORTAGE_MUTATIE_JAAR = 2003").count() == 2
    assert without.filter("CORRECTION_APPLIED = 'X'").isEmpty()


def test_reused_policy_gets_a_segment(spark):
    end = ("20010101", {"ZTYPE": "508_ONLY"})
    again = ("20010601", {"ZGEBDAT": "19700101"})
    later = ("20020601", {"ZGEBDAT": "19700101", "ZTYPE": "BOTH"})
    base = mo.base_mutations(log(spark, START, end, again, later), mo.SnapshotParams("20031231", 2003))
    assert rows(mo.segment_reuse(base), "processed_on", "reused_id") == [("20010601", "P_1"), ("20020601", "P_1")]
    same_person = ("20010601", {})
    base = mo.base_mutations(log(spark, START, end, same_person), mo.SnapshotParams("20031231", 2003))
    assert mo.segment_reuse(base).isEmpty()


def test_salary_gaps_take_the_last_known(spark):
    paid = {"ZLTSAL": 100.0, "ZLTSALDT": "20000615", "ZBSSALAM": 90.0}
    base = mo.base_mutations(
        log(spark, ("20000615", paid), ("20010101", {"ZLTSAL": 0.0}), ("20020101", {}), ("19991231", {})), mo.SnapshotParams("20031231", 2003)
    )
    got = rows(mo.fill_salaries(base), "processed_on", "salary", "salary_base")
    assert got == [("19991231", None, None), ("20000615", 100.0, 90.0), ("20010101", 100.0, 90.0), ("20020101", 100.0, 90.0)]


def test_latest_person_needs_some_data(spark):
    blank = ("20030101", {"ZGEBDAT": "", "ZGESL": "", "ZBSN1": ""})
    changed = ("20010101", {"ZGESL": "V"})
    base = mo.base_mutations(log(spark, START, changed, blank), mo.SnapshotParams("20031231", 2003))
    got = mo.latest_person(mo.person_feed(base))
    assert rows(got, "role", "purpose", "gender", "birth") == [("First", "GBB", "V", "19500101")]


def test_latest_person_of_repeated_rows(spark):
    params = mo.SnapshotParams("20031231", 2003)
    twice = log(spark, START, DEATH).union(log(spark, START, DEATH))
    left = mo.base_mutations(twice, params, repeats=True)
    assert (left.count(), mo.base_mutations(twice, params).count()) == (4, 2)
    names = ["policy", "role", "purpose", "birth", "gender", "bsn", "death", "event"]
    got, want = (rows(mo.latest_person(mo.person_feed(base)), *names) for base in (left, mo.base_mutations(log(spark, START, DEATH), params)))
    assert got == want and len(got) == 2


def test_whole_mutations_cross_one_shuffle(spark):
    plan = mo.with_new_ids(mo.base_mutations(log(spark, START), mo.SnapshotParams("20031231", 2003), repeats=True))._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.split("\n") if "hashpartitioning(" in line]
    # distinct rows and sums need no shuffle by their columns
    assert shuffles and not [line for line in shuffles if "employer" in line]


def test_slices_repeats_and_a_policy_named_like_a_segment(spark):
    params = mo.SnapshotParams("20031231", 2003)
    end, again = ("20010101", {"ZTYPE": "508_ONLY"}), ("20010601", {"ZGEBDAT": "19700101", "ZMUTID": "S"})
    slices = [("20010601", again[1] | {"MWYZVLGNR": 2, "ZPENREGID": no, "ZVERBDR": amount}) for no, amount in (("1", 5.0), ("2", 7.0), (None, 1.0))]
    namesake = ("20010601", slices[0][1] | {"ZPDEELID": "P_1", "ZVERBDR": 11.0})
    odd = ("20010601", {"ZPDEELID": None, "ZVERBDR": 3.0, "MWYZVLGNR": None})
    once = [START, (end[0], end[1] | {"MWYZVLGNR": 1}), *slices, namesake, odd]
    for mutations in (once, once + once):
        # rows are numbered by their place: the ids are given here
        mutations = [(date, {"ZMUTID": f"N{date}{fields.get('ZPDEELID')}", "MWYZVLGNR": 0} | fields) for date, fields in mutations]
        got = mo.with_new_ids(mo.base_mutations(log(spark, *mutations), params, repeats=True))
        assert rows(got, "policy", "processed_on", "insured") == [(None, "20010601", 3.0), ("P", "20000615", 5.0), ("P", "20010101", 5.0), ("P_1", "20010601", 24.0)]


def test_repeated_predecessors_do_not_repeat_a_mutation(spark):
    states = spark.createDataFrame([("A", "B", "C", p, *["1"] * len(mo.BEFORE)) for p in ("P", "Q")] + [("B", None, "C", "P", *["2"] * len(mo.BEFORE))],
                                   ["mutation_id", "next_mutation", "coverage", "policy", *mo.BEFORE])
    mutations = spark.createDataFrame([("B", "C"), ("X", "C")], ["mutation_id", "coverage"])
    assert rows(mo.attach_previous(mutations, states), "mutation_id", "prev_insured") == [("B", "1"), ("X", None)]


def test_whole_policies_give_the_rows_of_chunks(spark, monkeypatch):
    reversal, end = ("20020401", {"ZTYPE": "BOTH", "ZEVENTID": "R001"}), ("20010101", {"ZTYPE": "508_ONLY", "ZLTSAL": 7.0})
    again = ("20010601", {"ZGEBDAT": "19700101", "ZMUTJAAR": 2000})
    mutations = [START, end, again, ("20010601", {"ZPENREGID": "2"}), ("20020101", {"ZVVAANTP": None}), CORRECTION, DEATH, reversal]
    mutations += [(date, fields | {"ZPDEELID": None}) for date, fields in mutations[:3]] + [(date, fields | {"ZPDEELID": "Q"}) for date, fields in mutations[:3]]
    base = mo.base_mutations(log(spark, *mutations), mo.SnapshotParams("20031231", 2003), repeats=True)
    assert not mo.crowded(base)
    whole = rows(report(spark, mutations))
    monkeypatch.setattr(mo, "CROWDED", 1)
    assert mo.crowded(base)
    assert rows(report(spark, mutations)) == whole and len(whole) > 10


def test_small_policies_are_shuffled_once_for_their_order(spark):
    states = mo.coverage_states(mo.base_mutations(log(spark, START), mo.SnapshotParams("20031231", 2003), repeats=True), whole=True)
    assert states._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(") == 1


def test_years_are_filled_in_the_row_of_their_coverage(spark):
    params = mo.SnapshotParams("20031231", 2003)
    late, other = ("20021231", {"ZMUTJAAR": 2002, "ZTYPE": "BOTH"}), ("20010101", {"ZAANSTYP": "008"})
    relevant = mo.base_mutations(log(spark, START, other, late), params)
    states = mo.yearly_states(relevant, params, whole=True)
    # the window of the running minimum alone: years are not sorted
    assert states._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    got = rows(states.filter(F.col("snapshot") == mo.EOY), "claim_type", "report_year", "kind", "link_mutated_on")
    assert got == [
        ("007", 2000, mo.START, "20000615"), ("007", 2001, mo.START, "20010101"), ("007", 2002, mo.CHANGE, "20021231"), ("007", 2003, mo.CHANGE, "20021231"),
        ("008", 2001, mo.START, "20010101"), ("008", 2002, mo.CHANGE, "20021231"), ("008", 2003, mo.CHANGE, "20021231"),
    ]
