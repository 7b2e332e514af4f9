from pyspark.sql import functions as F

from finwater.operators.cohorts import cohort_chain, entity_cohorts
from finwater.operators.eligibility import dedup_statements, eligible
from finwater.plans.all_snapshots import reliable_cut
from finwater.plans.client_financials import client_financials, select_statements
from golden import OLDER, frame, months_back, row, run_of


def cohorts_of(spark, rows):
    tagged = select_statements(frame(spark, rows))
    return {r["entityid"]: r["CF_Type"] for r in entity_cohorts(tagged).collect()}, tagged


def test_waterfall_golden(spark):
    rows = []
    rows += run_of(1, 10, 12, 2)                      # two annual -> A
    rows += run_of(2, 10, 12, 1)                      # one annual -> C
    rows += run_of(3, 10, 12, 1) + run_of(3, 40, 1, 12)   # annual + 12 monthly -> D
    rows += run_of(4, 10, 1, 23)                      # 23 monthly -> D
    rows += run_of(5, 10, 1, 24)                      # 24 monthly -> B
    rows += run_of(6, 10, 1, 25)                      # 25 monthly -> B (newest 24)
    rows += run_of(7, 10, 1, 11)                      # 11 monthly -> R
    rows += run_of(8, 10, 3, 7)                       # 7 quarterly -> G
    rows += run_of(9, 10, 3, 8)                       # 8 quarterly -> F
    rows += run_of(11, 10, 3, 3)                      # 3 quarterly -> R
    rows += run_of(13, 10, 12, 1) + run_of(13, 40, 3, 8)  # annual + 8 quarterly -> C
    rows += run_of(14, 10, 1, 24, step=2)             # gaps: 24 monthly over 4 years -> B
    got, tagged = cohorts_of(spark, rows)
    assert got == {1: "A", 2: "C", 3: "D", 4: "D", 5: "B", 6: "B", 7: "R", 8: "G", 9: "F", 11: "R", 13: "C", 14: "B"}
    kept = {(r["entityid"], r["CF_Type"]): r["n"] for r in tagged.groupBy("entityid", "CF_Type").agg(F.count("*").alias("n")).collect()}
    assert kept[(1, "A")] == 2 and kept[(4, "D")] == 12 and kept[(6, "B")] == 24 and kept[(8, "G")] == 4
    assert kept[(13, "C")] == 1
    ranks = {r["pkid_"]: r["ranked_order"] for r in tagged.filter("entityid = 6").collect()}
    assert ranks["610"] == 1 and "634" not in ranks  # the oldest of 25 drops out


def test_eligibility_drops(spark):
    d = months_back(2, 12)
    rows = [
        row(21, 1, d[0], 12, audit="Unaudited"),
        row(21, 2, d[1], 12, audit=None),
        row(22, 1, d[0], 12, stype="FY-To-Date"),
        row(22, 2, d[1], 12, stype=None),
        row(23, 1, d[0], 12, stype="Rolling Stmt"),
        row(None, 1, d[0], 12),
    ]
    assert eligible(frame(spark, rows)).count() == 0


def test_dedup_text_max_and_ties(spark):
    d = months_back(3, 12)
    rows = [
        row(31, 9, d[0], 12), row(31, 10, d[0], 12),       # same date+type: '319' > '3110' as text
        row(32, 5, d[0], 12, stype="Annual"), row(32, 6, d[0], 12, stype="Interim"),  # two types: both kept
    ]
    dd = dedup_statements(eligible(frame(spark, rows)))
    assert sorted(r["pkid_"] for r in dd.collect()) == ["319", "325", "326"]
    tagged = select_statements(frame(spark, rows))
    ranks = {r["pkid_"]: r["ranked_order"] for r in tagged.filter("entityid = 32").collect()}
    assert ranks == {"326": 1, "325": 2}  # equal date: key text, greatest first


def test_key_collision_default_vs_faithful(spark):
    d = months_back(2, 12)
    # entity 1 / statement 23 and entity 12 / statement 3 share the text key '123'
    rows = [row(1, 23, d[0], 12, netsales=100.0), row(1, 24, d[1], 12, netsales=10.0),
            row(12, 3, d[0], 12, netsales=7.0), row(12, 4, d[1], 12, netsales=1.0)]
    df = frame(spark, rows)
    latest = {r["ENTITYID"]: r["NetSalesCurrent"] for r in client_financials(df).collect()}
    assert latest == {1: 100.0, 12: 7.0}
    faithful = {r["ENTITYID"]: r["NetSalesCurrent"] for r in client_financials(df, snapshots="all").collect()}
    assert faithful == {1: 107.0, 12: 107.0}  # key lookups mix the two statements


def test_all_snapshots_weight(spark):
    d = months_back(2, 12)
    same = [row(41, 1, d[0], 12, netsales=5.0), row(41, 1, d[0], 12, netsales=5.0, asof=OLDER), row(41, 2, d[1], 12)]
    diff = [row(42, 1, d[0], 12, netsales=5.0), row(42, 1, d[0], 12, netsales=6.0, asof=OLDER), row(42, 2, d[1], 12)]
    out = {r["ENTITYID"]: r["NetSalesCurrent"] for r in client_financials(frame(spark, same + diff), snapshots="all").collect()}
    assert out[41] == 10.0          # 2 snapshot dates x 1 distinct metric row
    assert out[42] == 22.0          # 2 snapshot dates x (5 + 6)
    latest = {r["ENTITYID"]: r["NetSalesCurrent"] for r in client_financials(frame(spark, same + diff)).collect()}
    assert latest == {41: 5.0, 42: 5.0}


def test_ladder_equals_chain_on_fixture(spark):
    from finwater.sources.statements import fixture_statements
    from finwater.operators.snapshot import latest_snapshot
    from finwater.schema import KEY_COLUMNS

    st = fixture_statements(spark, "/root/testdata/sf0.01")
    ladder = select_statements(st).select("entityid", "pkid_", "ranked_order", "CF_Type")
    latest = latest_snapshot(st.select(*KEY_COLUMNS))
    chain = cohort_chain(dedup_statements(eligible(latest)), eligible(latest), cut_lineage=reliable_cut).select(
        "entityid", "pkid_", "ranked_order", "CF_Type"
    )
    assert ladder.exceptAll(chain).count() == 0 and chain.exceptAll(ladder).count() == 0


def test_each_entity_in_one_cohort_and_months_cover(spark):
    from finwater.sources.statements import fixture_statements

    tagged = select_statements(fixture_statements(spark, "/root/testdata/sf0.01"))
    per = tagged.groupBy("entityid").agg(F.countDistinct("CF_Type").alias("k"), F.first("CF_Type").alias("t"),
                                         F.sum("statementmonths").alias("m"))
    assert per.filter("k != 1").count() == 0
    target = {"A": 24, "B": 24, "F": 24, "C": 12, "D": 12, "G": 12}
    for t, months in target.items():
        assert per.filter(f"t = '{t}' AND m != {months}").count() == 0, t


def test_partition_count_does_not_change_result(spark):
    from finwater.sources.statements import fixture_customers, fixture_statements

    st = fixture_statements(spark, "/root/testdata/sf0.001")
    a = client_financials(st, fixture_customers(spark, "/root/testdata/sf0.001"))
    b = client_financials(st.repartition(3).sortWithinPartitions(F.rand(7)), fixture_customers(spark, "/root/testdata/sf0.001"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_key_only_single_annual_step_matches_chain(spark):
    from finwater.operators.cohorts import assign_cohorts_by_key
    from finwater.operators.eligibility import dedup_statements_by_key_set
    from finwater.schema import KEY_COLUMNS

    # entity 1 has one annual statement, key '123'; entity 12's quarterly
    # statement 3 has the same key text, so the key lookup takes entity 12
    # into the single-annual cohort although it has eight quarterly ones.
    rows = run_of(1, 23, 12, 1) + [row(12, 3, d, 3) for d in months_back(1, 3)] + run_of(12, 40, 3, 7, start=None)
    df = eligible(frame(spark, rows).select(*KEY_COLUMNS))
    dd = dedup_statements_by_key_set(df).distinct()
    by_key = assign_cohorts_by_key(dd).select("entityid", "pkid_", "ranked_order", "CF_Type")
    chain = cohort_chain(dd, df, cut_lineage=reliable_cut).select("entityid", "pkid_", "ranked_order", "CF_Type")
    assert by_key.exceptAll(chain).count() == 0 and chain.exceptAll(by_key).count() == 0
    got = {(r["entityid"], r["CF_Type"]) for r in by_key.collect()}
    assert got == {(1, "C"), (12, "C")}


def test_eligibility_collation_option(spark):
    d = months_back(1, 12)
    rows = [row(61, 1, d[0], 12, audit="qualified "), row(62, 1, d[0], 12, stype="fy-to-date")]
    df = frame(spark, rows)
    # exact match: 'qualified ' is not an accepted method, 'fy-to-date' is not an excluded type
    assert {r["entityid"] for r in eligible(df).collect()} == {62}
    got = {r["entityid"] for r in eligible(df, collation="UTF8_LCASE_RTRIM").collect()}
    assert got == {61}  # method matches ignoring case/trailing blank; the excluded type is excluded


def test_repeated_key_keeps_every_measure_row(spark):
    d = months_back(3, 12)
    rows = [
        # the same statement twice, alike: one row
        row(71, 1, d[0], 12, netsales=5.0), row(71, 1, d[0], 12, netsales=5.0),
        # twice with different measures: one statement, both rows summed
        row(72, 1, d[0], 12, netsales=5.0), row(72, 1, d[0], 12, netsales=7.0),
        # two annual statements, the newest twice with different measures: cohort A, current is the newest alone
        row(73, 2, d[0], 12, netsales=1.0), row(73, 2, d[0], 12, netsales=2.0), row(73, 1, d[1], 12, netsales=40.0),
        # twice with different audit methods: two distinct key rows, which rank and count as two
        row(74, 1, d[0], 12, audit="Qualified", netsales=3.0), row(74, 1, d[0], 12, audit="Reviewed", netsales=4.0),
    ]
    df = frame(spark, rows)
    dd = dedup_statements(eligible(df))
    assert {r["entityid"]: r["n"] for r in dd.groupBy("entityid").agg(F.count("*").alias("n")).collect()} == {71: 1, 72: 2, 73: 3, 74: 2}
    got, tagged = cohorts_of(spark, rows)
    assert got == {71: "C", 72: "C", 73: "A", 74: "A"}
    ranks = {(r["entityid"], r["statementid"], r["auditmethod"], r["ranked_order"]) for r in tagged.collect()}
    assert ranks == {(71, 1, "Qualified", 1), (72, 1, "Qualified", 1), (73, 2, "Qualified", 1), (73, 1, "Qualified", 2),
                     (74, 1, "Qualified", 1), (74, 1, "Reviewed", 2)}
    report = {r["ENTITYID"]: (r["NetSalesCurrent"], r["NetSalesPriorYear"]) for r in client_financials(df).collect()}
    assert report == {71: (5.0, None), 72: (12.0, None), 73: (3.0, 40.0), 74: (3.0, 4.0)}


def test_cohort_rows_are_distinct(spark):
    """A lone 12-month key whose rows differ in the audit method only is one
    row of the single-annual cohort (its rank is forced to 1)."""
    from finwater.operators.cohorts import assign_cohorts_by_key, cohort_rows
    from finwater.operators.eligibility import dedup_statements_by_key_set
    from finwater.schema import KEY_COLUMNS

    d = months_back(2, 12)
    # entity 8's key '812' is also that of entity 81's lone annual statement 2
    rows = [row(81, 2, d[0], 12), row(8, 12, d[0], 6), row(8, 12, d[0], 6, audit="Reviewed")]
    df = eligible(frame(spark, rows).select(*KEY_COLUMNS))
    dd = dedup_statements_by_key_set(df).distinct()
    for tagged in (assign_cohorts_by_key(dd), cohort_chain(dd, df, cut_lineage=reliable_cut)):
        got = sorted((r["entityid"], r["CF_Type"], r["ranked_order"]) for r in cohort_rows(tagged).collect())
        assert got == [(8, "C", 1), (81, "C", 1)]


def test_text_entity_ids(spark, scratch):
    from finwater.sources.statements import read_statements

    rows = run_of(1, 10, 12, 2) + run_of(2, 10, 12, 1)
    df = frame(spark, rows).drop("pkid_").withColumn("entityid", F.concat(F.lit("00A"), F.col("entityid").cast("string")))
    df.write.partitionBy("asofdate").parquet(scratch + "/h")
    back = read_statements(spark, scratch + "/h")
    assert {r["pkid_"] for r in back.collect()} == {"00A110", "00A111", "00A210"}
    for mode in ("latest", "all"):
        assert sorted(r["ENTITYID"] for r in client_financials(back, snapshots=mode).collect()) == ["00A1", "00A2"]


def test_rank_columns_with_collation(spark):
    from finwater.operators.snapshot import with_statement_ranks

    df = frame(spark, [row(1, 1, months_back(1)[0], 12, stype="annual ", audit="QUALIFIED")])
    exact, folded = (with_statement_ranks(df, c).first() for c in (None, "UTF8_LCASE_RTRIM"))
    assert (exact["Audit_Rank"], exact["StatmentType_Rank"]) == (None, None)
    assert (folded["Audit_Rank"], folded["StatmentType_Rank"]) == (2, 1)
