"""Whole runs on landed fixtures: every source, failures, repetition, streaming."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe import schema as S
from vigilframe.operators.update import Policy
from vigilframe.plans.run import run
from vigilframe.plans.updaters import SOURCES, Inputs, register_source
from vigilframe.schema import FLAGS, PAGE_SCHEMA, REGISTER, REGISTER_SCHEMA
from vigilframe.sources import sinks
from vigilframe.sources import tables as T
from vigilframe.streaming.refresh import apply_batch, batch_run_id, refresh
from vigilframe.streaming.state import PageState

AT = datetime(2024, 6, 15, 9, 30, 5)

COUNTRIES = [
    (1, "IRAN", "IRAN"), (2, "MYANMAR (BURMA)", "BIRMANIE"), (3, R.LONG_KOREA, "COREE DU NORD"), (4, "CUBA", "CUBA"),
    (5, "FIJI", "FIDJI"), (6, "RUSSIA", "RUSSIE"), (7, "SYRIA", "SYRIE"), (8, None, None), (9, "MALI", "MALI"),
    (10, "BOSNIA AND HERZEGOVINA", "BOSNIE"), (11, "NORWAY", "NORVEGE"), (12, "DEMOCRATIC PEOPLE’S REPUBLIC OF KOREA", "X"),
]


def register(spark, old="NO"):
    data = [(i, en, fr, None, None, 40, 90, *[old] * 18) for i, en, fr in COUNTRIES]
    return spark.createDataFrame(data, REGISTER_SCHEMA)


def page(source, url, body, status=200, at=AT):
    return (source, url, status, at, body)


def fr_page(slug, *items):
    lis = "".join(f"<li>{i}</li>" for i in items)
    body = f"<section class='page-section'><h3>Mesures restrictives</h3><ul>{lis}</ul></section>"
    return page(R.FR_MEASURES, R.FR_URL + slug, body)


def published():
    russia = R.FR_SLUGS["RUSSIE"]
    links = "".join(f"<a href='{R.FR_URL}{slug}'>x</a>" for slug in ("iran", russia, "mali"))
    title = "<div class='gem-c-document-list__item-title'><a href='#'>Financial sanctions, {}</a></div>"
    span = "<p class='oj-ti-grseq-1'><span class='oj-bold'>{}</span></p>"
    return [
        page(R.CPI, R.CPI_URL + "norway", "<dl><dt>Score</dt><dd>84/100</dd><dt>Rank</dt><dd>5/180</dd></dl>"),
        page(R.CPI, R.CPI_URL + "mali", "<dl><dt>Score</dt><dd>28/100</dd><dt>Rank</dt><dd>13.5/180</dd></dl>"),
        page(R.CPI, R.CPI_URL + "fiji", None, status=503),
        page(R.CPI, R.CPI_URL + "syria", None, status=404),
        page(R.EU_AML, "aml", "<table class='ecl-table'><tr><td>Old</td></tr></table>", at=datetime(2023, 1, 1)),
        page(R.EU_AML, "aml", "<table class='ecl-table'><tr><td>Myanmar</td></tr><tr><td>North Korea</td></tr></table>"),
        page(R.EU_AML, "aml", "<table class='ecl-table'><tr><td>Mali</td></tr></table>", at=datetime(2025, 1, 1)),
        page(R.EU_TAX, "tax", "<p id='d1e39-2-1'>I</p>" + span.format("Russian Federation, Fiji (x)") + span.format("State of play")
             + "<p class='oj-normal'><span class='oj-bold'>Mali and Norway</span></p>"),
        page(R.FATF_CALL, R.FATF_URL + "Call-for-action-june-2024.html", "<h3><b>Iran</b></h3><h3><b>Myanmar</b></h3>"),
        page(R.FATF_CALL, R.FATF_URL + "Call-for-action-february-2024.html", "<h3><b>Mali</b></h3>"),
        page(R.FATF_MONITORING, R.FATF_URL + "increased-monitoring-june-2024.html",
             "<h6 class='cmp-title__text'>Country</h6><p>Mali, Syria</p>"),
        page(R.FR_MEASURES, R.FR_INDEX_URL, f"<h2>{R.FR_INDEX_HEADING} ?</h2><p>{links}</p>"),
        fr_page("iran", "Gel des avoirs", "Équipements de répression interne"),
        fr_page(russia, "Embargos sectoriels et militaires"),
        fr_page("cuba", "Gel des avoirs"),
        page(R.FR_MEASURES, R.FR_URL + "mali", "<section class='other'></section>"),
        page(R.FR_TAX, "taxe", "<table><tr><th>Liste source</th></tr><tbody><tr><td>Fidji</td></tr></tbody></table>"),
        page(R.UK, "uk", title.format("Iran (nuclear)") + title.format("Democratic People’s Republic of Korea, Mali")),
    ]


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    register(spark).write.parquet(f"{root}/register")
    spark.createDataFrame(published(), PAGE_SCHEMA).write.partitionBy("source").parquet(f"{root}/pages")
    docs = [
        (1, 1, "Regime\nInvestments\nIRAN\nAsset freeze and prohibition to "),
        (1, 2, "make funds available\nBOSNIA & HERZEGOVINA\nFinancial measures"),
        (70, 1, "RUSSIA\ninvestments"),
        (71, 1, "MALI\ninvestments"),
    ]
    spark.createDataFrame(docs, "doc_id long, page_no long, text string").write.parquet(f"{root}/docs")
    (root / "sdn").mkdir()
    head = ",".join(f"h{i}" for i in range(12))
    lines = [head, ",".join("abc"), ",".join("x" * 11) + ",syria; DPRK  Burma", ",".join("x" * 11) + ",\"cuba\",extra,more", ",".join("x" * 11) + ", "]
    (root / "sdn" / "sdn.csv").write_text("\n".join(lines), encoding="utf8")
    return root


def inputs(spark, root, **changes):
    ready = Inputs(
        register=T.read_register(spark, f"{root}/register"),
        at=AT,
        pages=T.read_pages(spark, f"{root}/pages"),
        documents=T.regimes(T.read_documents(spark, f"{root}/docs"), 1, 70),
        programmes=T.read_program_csv(spark, f"{root}/sdn"),
        separator="",
    )
    return replace(ready, **changes)


def listed(df, flag):
    return {r[0] for r in df.where(F.col(flag) == "YES").select(REGISTER.key).collect()}


def test_whole_run(spark, landing, tmp_path):
    out = str(tmp_path)
    result = run(spark, inputs(spark, landing), out, "r1", export_to=f"{out}/export")
    assert result.failures == {}
    new = spark.read.parquet(result.register).cache()
    assert new.columns == REGISTER_SCHEMA.fieldNames() and new.count() == len(COUNTRIES)
    freeze, invest, money = S.EU_MEASURE_FLAGS
    expected = {
        S.EU_AML: {2, 3}, S.EU_TAX: {5, 6}, S.FATF_CALL: {1, 2}, S.FATF_MONITORING: {9, 7},
        S.FR_TAX: {5}, S.US_PROGRAMMES: {7, 3, 2, 4}, S.UK: {1, 12, 9, 3}, freeze: {1}, invest: {6}, money: {10},
        S.FR_MEASURE_FLAGS[0]: {1}, S.FR_MEASURE_FLAGS[1]: {6}, S.FR_MEASURE_FLAGS[2]: {6}, S.FR_MEASURE_FLAGS[3]: {1},
    }
    # The UK list maps IRAN on both sides, so row 1 is found; row 3's name contains the listed one.
    for flag in FLAGS:
        assert listed(new, flag) == expected.get(flag, set()), flag
    values = {r[REGISTER.key]: (r["CPI_SCORE"], r["CPI_RANK"]) for r in new.collect()}
    assert values[11] == (84, 5)  # page with both
    assert values[9] == (40, 90)  # rank that is not whole: row kept
    assert values[5] == (40, 90)  # failed fetch: row kept
    assert values[7] == values[1] == (None, None)  # not found, or no page
    assert values[8] == (40, 90)  # no name, never fetched

    log = spark.read.parquet(result.audit).cache()
    changed = {(r["SanctionsMapId"], r["ColumnName"]): (r["OldValue"], r["NewValue"]) for r in log.collect()}
    assert changed[1, S.FATF_CALL] == ("NO", "YES") and changed[1, "CPI_SCORE"] == ("40", None)
    assert changed[1, "LIST"] == ("AMBER", "PROHIBITED") and (4, "LIST") not in changed
    assert changed[11, "LEVEL_OF_RISK"] == ("MEDIUM", "STANDARD")
    ids = sorted(r["AuditID"] for r in log.collect())
    assert ids == list(range(1, len(ids) + 1)) and {r["UpdatedAt"] for r in log.collect()} == {AT}
    exported = spark.read.option("header", True).csv(result.export)
    assert result.export.endswith("audit_Export_2024-06-15_09-30-05") and exported.count() == log.count()

    # The same run again replaces its own rows; a second run finds nothing to change.
    run(spark, inputs(spark, landing), out, "r1")
    assert spark.read.parquet(result.audit).count() == len(ids)
    again = run(spark, inputs(spark, landing, register=spark.read.parquet(result.register)), out, "r2")
    rows = spark.read.parquet(again.audit).where("run_id = 'r2'").collect()
    assert [(r["SanctionsMapId"], r["ColumnName"], r["AuditID"]) for r in rows] == [(-1, "None", len(ids) + 1)]


def test_order_of_sources_does_not_matter(spark, landing, tmp_path, rows):
    one = run(spark, inputs(spark, landing), f"{tmp_path}/a", "r")
    two = run(spark, inputs(spark, landing), f"{tmp_path}/b", "r", sources=SOURCES[::-1])
    assert rows(spark.read.parquet(one.register)) == rows(spark.read.parquet(two.register))


def test_failing_and_silent_sources_keep_their_flags(spark, landing, tmp_path):
    def broken(pages):
        raise ValueError("page layout changed")

    sources = register_source("BAD", broken, S.UK, Policy("U-2"), sources=SOURCES[:1])
    old = register(spark, "YES")
    old.write.parquet(f"{tmp_path}/old")
    silent = inputs(spark, landing, register=spark.read.parquet(f"{tmp_path}/old"), documents=None, programmes=None)
    result = run(spark, silent, f"{tmp_path}/out", "r", sources=sources)
    assert set(result.failures) == {"BAD"}
    new = spark.read.parquet(result.register)
    assert listed(new, S.UK) == {i for i, *_ in COUNTRIES} and listed(new, S.US_PROGRAMMES) == {i for i, *_ in COUNTRIES}
    assert listed(new, S.EU_AML) == {2, 3, 8}  # an unknown name keeps its old value


def test_plugged_in_source_with_a_flag_of_its_own(spark, tmp_path):
    layout = replace(REGISTER, flags=(*FLAGS, "OWN_LIST"))
    old = register(spark).withColumn("OWN_LIST", F.lit(None).cast("string"))
    old.write.parquet(f"{tmp_path}/old")
    pages = spark.createDataFrame([page("OWN", "u", "MALI|CUBA")], PAGE_SCHEMA)
    sources = register_source(
        "OWN", lambda p: p.select(F.explode(F.split("body", r"\|")).alias("name")), "OWN_LIST", Policy("U-1"), sources=()
    )
    own = Inputs(register=spark.read.parquet(f"{tmp_path}/old"), at=AT, pages=pages, layout=layout)
    result = run(spark, own, f"{tmp_path}/out", "r", sources=sources)
    new = spark.read.parquet(result.register)
    assert listed(new, "OWN_LIST") == {4, 9}
    assert new.where(F.col("OWN_LIST").isNull()).count() == 1
    columns = {r["ColumnName"] for r in spark.read.parquet(result.audit).collect()}
    assert columns == {"OWN_LIST"}


def test_register_reading_and_schema_checks(spark, tmp_path, rows):
    old = register(spark).withColumnRenamed("FR_ASSET_FREEZE", "FR_ASSET_FREEEZE").drop("COUNTRY_CODE_ISO_2")
    old.withColumn("LIST", F.lit("RED")).write.option("header", True).csv(f"{tmp_path}/csv")
    read = T.read_register(spark, f"{tmp_path}/csv", format="csv")
    assert read.schema.fieldNames() == REGISTER_SCHEMA.fieldNames()
    assert rows(read) == rows(register(spark))
    odd = read.withColumn(S.UK, F.when(F.col(REGISTER.key) == 3, "MAYBE").when(F.col(REGISTER.key) == 4, None).otherwise("NO"))
    good, rejects = T.enforce_flag_schema(odd, FLAGS)
    assert good.count() == len(COUNTRIES) - 1 and rejects.select(REGISTER.key).collect()[0][0] == 3


def test_bucketed_register_joins_without_shuffle(spark):
    from vigilframe.operators.audit import diff_snapshots

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, old in (("register_a", "NO"), ("register_b", "YES")):
            sinks.save_register_table(register(spark, old), name, REGISTER.key, 4)
        diff = diff_snapshots(spark.table("register_a"), spark.table("register_b"), REGISTER.key)
        assert diff.count() == 18 * len(COUNTRIES)
        assert "Exchange" not in diff._jdf.queryExecution().sparkPlan().toString()
        assert "Exchange hashpartitioning" not in diff._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("register_a", "register_b"):
            spark.sql(f"drop table if exists {name}")


def test_streaming_refresh(spark, tmp_path):
    root = str(tmp_path)
    register(spark).write.parquet(f"{root}/start")
    sources = tuple(s for s in SOURCES if s.name in (R.EU_AML, R.FR_TAX))

    def land(name, at):
        body = f"<table class='ecl-table'><tr><td>{name}</td></tr></table>"
        spark.createDataFrame([page(R.EU_AML, "aml", body, at=at)], PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def step():
        query = refresh(spark, f"{root}/in", f"{root}/out", f"{root}/start", f"{root}/checkpoint", sources=sources)
        query.awaitTermination()
        assert query.exception() is None

    land("Mali", AT)
    step()
    land("Syria", datetime(2024, 7, 1))
    step()
    step()  # nothing new
    for batch, ids in ((0, {9}), (1, {7})):
        path = sinks.snapshot_path(f"{root}/out/register", batch_run_id(batch))
        assert listed(spark.read.parquet(path), S.EU_AML) == ids
    log = spark.read.parquet(f"{root}/out/audit")
    moves = {(r["SanctionsMapId"], r["NewValue"], r["UpdatedAt"].month) for r in log.where(F.col("ColumnName") == S.EU_AML).collect()}
    assert moves == {(9, "YES", 6), (9, "NO", 7), (7, "YES", 7)}
    assert sorted(r["AuditID"] for r in log.collect()) == list(range(1, log.count() + 1))


def test_scores_that_land_one_page_a_batch_are_kept(spark, tmp_path):
    root = str(tmp_path)
    register(spark).write.parquet(f"{root}/start")
    body = "<dl><dt>Score</dt><dd>{}/100</dd><dt>Rank</dt><dd>{}/180</dd></dl>"
    for batch, (slug, score, rank) in enumerate([("norway", 84, 5), ("mali", 28, 136)]):
        one = [page(R.CPI, R.CPI_URL + slug, body.format(score, rank))]
        spark.createDataFrame(one, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        query = refresh(spark, f"{root}/in", f"{root}/out", f"{root}/start", f"{root}/checkpoint", sources=())
        query.awaitTermination()
        assert query.exception() is None
    new = spark.read.parquet(sinks.snapshot_path(f"{root}/out/register", batch_run_id(batch)))
    values = {r[REGISTER.key]: (r["CPI_SCORE"], r["CPI_RANK"]) for r in new.collect()}
    assert values[11] == (84, 5) and values[9] == (28, 136)


def test_measures_of_accented_entities(spark, tmp_path):
    old = register(spark).withColumn(REGISTER.name_eng, F.when(F.col(REGISTER.key) == 5, "CÔTE D’IVOIRE").otherwise(F.col(REGISTER.name_eng)))
    old.write.parquet(f"{tmp_path}/old")
    docs = spark.createDataFrame([(1, 1, "Côte d'Ivoire\ninvestments")], "doc_id long, page_no long, text string")
    own = Inputs(register=spark.read.parquet(f"{tmp_path}/old"), at=AT, documents=docs)
    result = run(spark, own, f"{tmp_path}/out", "r", sources=[s for s in SOURCES if s.name == R.EU_MEASURES])
    assert result.failures == {}
    assert listed(spark.read.parquet(result.register), S.EU_MEASURE_FLAGS[1]) == {5}


def test_programme_csv_with_doubled_quotes_and_line_breaks(spark, tmp_path):
    row = ",".join(["x"] * 10)
    lines = [",".join(f"h{i}" for i in range(12)), f'{row},"He said ""x"", y",burma', f'{row},"two\nlines",cuba']
    (tmp_path / "p.csv").write_text("\n".join(lines), encoding="utf8")
    read = T.read_program_csv(spark, str(tmp_path), multi_line=True)
    assert sorted(r.programme for r in read.collect()) == ["BURMA", "CUBA"]


def test_regimes_takes_the_bounds_given(spark):
    docs = spark.createDataFrame([(1, "a"), (71, "b")], "doc_id long, text string")
    assert [r.doc_id for r in T.regimes(docs, 70, 80).collect()] == [71]


def test_batches_with_state_equal_one_run(spark, tmp_path):
    """A repeated batch changes nothing; what batches build up equals one run over all pages."""
    root, late = str(tmp_path), datetime(2024, 6, 20)
    register(spark).write.parquet(f"{root}/start")
    table = "<table class='ecl-table'><tr><td>{}</td></tr></table>"
    score = "<dl><dt>Score</dt><dd>{}/100</dd><dt>Rank</dt><dd>{}/180</dd></dl>"
    batches = [
        [page(R.EU_AML, "aml", table.format("Mali"), at=AT), page(R.CPI, R.CPI_URL + "norway", score.format(84, 5), at=AT)],
        [page(R.EU_AML, "aml", table.format("Syria"), at=datetime(2024, 6, 1)), (R.CPI, R.CPI_URL + "mali", 404, late, None)],
    ]
    sources = [s for s in SOURCES if s.name == R.EU_AML]
    results = []
    for n in (0, 1, 1):
        df = spark.createDataFrame(batches[n], PAGE_SCHEMA)
        result = apply_batch(df, n, f"{root}/out", f"{root}/start", sources=sources, buckets=8)
        assert result.failures == {}
        results.append([sorted(map(repr, spark.read.parquet(p).collect())) for p in (result.register, f"{root}/out/state/pages", f"{root}/out/audit")])
    assert results[1] == results[2]
    everything = spark.createDataFrame(sum(batches, []), PAGE_SCHEMA)
    whole = run(spark, Inputs(register=spark.read.parquet(f"{root}/start"), at=late, pages=everything), f"{root}/whole", "r", sources=sources)
    assert results[2][0] == sorted(map(repr, spark.read.parquet(whole.register).collect()))


def test_page_state_keeps_current_pages_and_untouched_buckets(spark, tmp_path):
    early, late = datetime(2024, 6, 1), datetime(2024, 6, 20)
    batches = [
        [page(R.EU_AML, "aml", "1", at=AT), page(R.CPI, "n", "2", at=early), page(R.FATF_CALL, "call", "3", at=AT)],
        [page(R.EU_AML, "other", "old", at=early), (R.EU_AML, "aml", 500, late, "failed"), page(R.CPI, "m", "4", at=AT)],
        [],
        [page(R.CPI, "n", "5", at=AT), (R.CPI, "m", 404, late, None), page(R.FATF_CALL, "call", "late", at=early)],
    ]
    state = PageState(spark, str(tmp_path), 64)
    versions = [f"v{n}" for n in range(4)]
    times = []
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, PAGE_SCHEMA)
        times.append(state.merge(df, versions[n], versions[n - 1] if n else None))
    assert times == [AT, late, late, late]
    kept = sorted((r.source, r.url, r.status, r.body or "") for r in state.read("v3").collect())
    assert kept == sorted([(R.EU_AML, "aml", 200, "1"), (R.CPI, "n", 200, "5"), (R.CPI, "m", 404, ""), (R.FATF_CALL, "call", 200, "3")])
    # Older versions stay as they were.
    assert sorted(r.body for r in state.read("v0").collect()) == ["1", "2", "3"]
    writers = [state.manifest(v)[0] for v in versions]
    assert writers[1] == writers[2] and {b for b, v in writers[3].items() if v == "v3"} < set(writers[3])
    assert "v2" in state.vacuum("v3", versions[:3]) and state.read("v3").count() == 4
    assert PageState(spark, f"{tmp_path}/empty").merge(spark.createDataFrame([], PAGE_SCHEMA), "v", None) is None
    assert PageState(spark, f"{tmp_path}/empty").read("v").count() == 0


def test_repeated_run_on_a_later_day_replaces_its_audit(spark, tmp_path):
    log = str(tmp_path / "audit")
    schema = "SanctionsMapId long, UpdatedAt timestamp"
    for run_id, day, keys in (("a", 1, [1, 2]), ("b", 1, [3]), ("a", 2, [1, 4]), ("a", 2, [1, 4])):
        rows = spark.createDataFrame([(k, datetime(2024, 6, day)) for k in keys], schema)
        sinks.append_audit(rows, log, run_id)
    found = {(r.run_id, r.run_date.day, r.SanctionsMapId) for r in spark.read.parquet(log).collect()}
    assert found == {("a", 2, 1), ("a", 2, 4), ("b", 1, 3)} and spark.read.parquet(log).count() == 3
