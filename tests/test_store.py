"""Run claims, versions of pages, tables made from the history, retention, and what a load may read of it."""

from __future__ import annotations

import glob
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ranktide.operators import cleaning, loading, quality, rules
from ranktide.operators.numbering import number_rows, rank_rows, with_ranges
from ranktide.operators.snapshots import latest_per_pair
from ranktide.plans import batch
from ranktide.schemas import DIM_PAGE, LONG, TEXT, Table
from ranktide.session import freeze, passing_tables, shared_folder
from ranktide.sources import files, store as storage
from ranktide.sources.store import Conflict, Store
from test_loading import ORDER, staging


def load(store, day, load_id, positions=(("zeta", "https://www.shop.example/1", 4),), **options):
    return batch.load_staging(store, staging(store.spark, [day], positions), day, load_id, ORDER, **options)


def many(spark, days, n=6):
    """Staging tables of some pages and keywords whose positions move from day to day."""
    tables = staging(spark, days)
    urls = [f"https://www.shop.example/{i}" for i in range(n)]
    tables["keywords"] = spark.createDataFrame([(f"k{i}", "comercial", "x", 5, 5) for i in range(n)], tables["keywords"].schema)
    tables["pages"] = spark.createDataFrame([(u, "t", "h", 1, int(i % 3 > 0), 50, "2026-01-01T00:00:00Z") for i, u in enumerate(urls)], tables["pages"].schema)
    rows = [(f"k{i}", urls[i], d, (i * 7 + int(d[-2:]) * 11) % 40) for i in range(n) for d in days]
    tables["positions"] = spark.createDataFrame(rows, tables["positions"].schema)
    return tables


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "claims" / "one")
    assert files.create_new(spark, path, "first") and not files.create_new(spark, path, "second")
    assert files.read_text(spark, path) == "first" and files.listed(spark, str(tmp_path / "claims" / "*"))
    assert files.remove(spark, path) and files.listed(spark, str(tmp_path / "claims" / "*")) == []


def commit(store, note="run", **options):
    """A run without any work."""
    run = store.open_run(note, **options)
    store.close_run(run, "success", 0, 0, note)
    return run


def test_two_open_runs_share_no_folder_and_one_is_committed(spark, tmp_path):
    a, b = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    commit(a)
    first, second = a.open_run("a"), b.open_run("b")
    assert (first.run_id, second.run_id) == (2, 3) and first.before == second.before == (1,)
    row = [("2026-02-01",)]
    for store, run in ((a, first), (b, second)):
        assert store.append("snapshot_calendar", spark.createDataFrame(row, "snapshot_date string"), run) == 1
    b.close_run(second, "success", 1, 1, "b")
    with pytest.raises(Conflict):
        a.close_run(first, "success", 1, 1, "a")
    assert a.read("snapshot_calendar").count() == 1
    slow = a.open_run("slow")
    commit(b, full_refresh=True)
    with pytest.raises(Conflict):
        a.close_run(slow, "success", 0, 0, "overtaken by a full refresh")


def test_a_load_that_is_overtaken_fails_and_can_be_repeated(spark, tmp_path, monkeypatch):
    store, real = Store(spark, str(tmp_path / "s")), batch.quality.load_checks

    def overtaken(tables):
        commit(Store(spark, store.root), "meanwhile")
        return real(tables)

    with monkeypatch.context() as patched:
        patched.setattr(batch.quality, "load_checks", overtaken)
        with pytest.raises(Conflict):
            load(store, "2026-01-15", "w3")
    load(store, "2026-01-15", "w3")
    assert sorted(r.status for r in store.runs().collect()) == ["failed", "success", "success"]
    assert [r.position_id for r in store.read("fact_keyword_position").collect()] == [1]


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """A store with three loads, the last of them back-dated in part; and what it held behind each of them."""
    store, states = Store(spark, str(tmp_path_factory.mktemp("history") / "s")), []
    for i, days in enumerate((["2026-01-05", "2026-01-12"], ["2026-01-19"], ["2026-01-08", "2026-01-19", "2026-01-26"])):
        tables = many(spark, days, 9 if i < 2 else 10)
        if i == 2:
            title = F.when(F.col("url").endswith("/2"), "new").otherwise(F.col("title"))
            tables["pages"] = tables["pages"].withColumn("title", title)
        outcome = batch.load_staging(store, tables, days[-1], f"w{i}", ORDER)
        names = ("fact_keyword_position", "fact_technical_issue", "latest_position", "ranked_page", "fallen_position", "greatest_id", "dim_page", "dim_keyword")
        states.append((outcome, {name: store.read(name).collect() for name in names}))
    return store, states


def test_a_run_writes_as_many_page_rows_as_it_changes(spark, history):
    store, states = history
    (first, _), (second, _), (third, after) = states
    assert store.written("dim_page", first.run).count() == first.loaded["dim_page"] == 9
    assert store.written("dim_page", second.run).count() == second.loaded["dim_page"] == 0
    assert third.loaded["dim_page"] == 1
    assert {r.url[-1] for r in store.written("dim_page", third.run).collect()} == {"2", "9"}
    pages = {r.url[-1]: r for r in after["dim_page"]}
    assert len(pages) == 10 and pages["2"].title == "new" and pages["3"].title == "t" and pages["9"].page_id == 10


def test_versions_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "COMPACT_AFTER", 2)
    store, expected = Store(spark, str(tmp_path / "s")), {}
    for i in range(8):
        run = store.open_run(f"run {i}")
        changed = [(i, 1, f"u{i}", f"t{i}"), (0, 1, "u0", f"t{i}")][: 1 if i == 0 else 2]
        rows = spark.createDataFrame(changed, "page_id bigint, site_id bigint, url string, title string")
        rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(k).alias(c) for c, k in zip(DIM_PAGE.names, (f.dataType for f in DIM_PAGE.struct), strict=True)])
        assert store.update("dim_page", rows, run) == len(changed)
        expected |= {u: t for _, _, u, t in changed}
        assert {r.url: r.title for r in store.read("dim_page", run).collect()} == expected
        store.close_run(run, "success", 0, 0, "")
    whole = files.listed(spark, f"{store.root}/dim_page/generation=1/run_id=*/whole=1")
    assert 2 <= len(whole) <= 4 and len(store._versions("dim_page", 1, tuple(range(1, 9)))) <= 4


def bag(rows):
    return Counter(map(tuple, rows))


def test_tables_made_from_the_history_equal_a_full_scan(spark, history):
    store, states = history
    for i, (_, held) in enumerate(states):
        fact = spark.createDataFrame(held["fact_keyword_position"], store.read("fact_keyword_position").schema)
        assert bag(latest_per_pair(fact).collect()) == bag(held["latest_position"])
        assert {r.page_id for r in rules.ranked_pages(fact).collect()} == {r.page_id for r in held["ranked_page"]}
        assert bag(rules.fallen_positions(fact).collect()) == bag(held["fallen_position"]) and (i == 0 or held["fallen_position"])
        marks = {}
        for r in held["greatest_id"]:
            marks[r.name] = max(r.id, marks.get(r.name, 0))
        for name, key in (("fact_keyword_position", "position_id"), ("dim_keyword", "keyword_id"), ("dim_page", "page_id"), ("fact_technical_issue", "issue_id")):
            assert sorted(r[key] for r in held[name]) == list(range(1, marks.get(name, 0) + 1))
    by_pair = {}
    for r in sorted(states[-1][1]["fact_keyword_position"], key=lambda r: (r.keyword_id, r.page_id, r.snapshot_date)):
        by_pair.setdefault((r.keyword_id, r.page_id), []).append(r)
    assert sorted(len(rows) for rows in by_pair.values()) == [3] + [5] * 9
    for rows in by_pair.values():
        if len(rows) == 5:
            first, back_dated, next_one, _, newest = rows
            assert first.previous_position is None and back_dated.previous_position == first.position
            # Rows that were stored before the back-dated one keep what they were given.
            assert next_one.previous_position is None and newest.previous_position == rows[3].position


def test_rules_of_a_second_load_equal_the_full_scan(spark, history):
    store, states = history
    (_, before), (_, after) = states[:2]
    frame = {name: spark.createDataFrame(after[name], store.read(name).schema) for name in ("dim_page", "fact_keyword_position")}
    known = spark.createDataFrame(before["fact_technical_issue"], store.read("fact_technical_issue").schema)
    pages, fact = frame["dim_page"], frame["fact_keyword_position"]
    found = rules.noindex_issues(pages, rules.ranked_pages(fact), known, "2026-01-19").collect()
    known = known.unionByName(spark.createDataFrame(found, known.schema))
    found += rules.decay_issues(pages, fact, known, "2026-01-19", suppress="today").collect()
    assert bag(after["fact_technical_issue"]) == bag(before["fact_technical_issue"] + found) and found


def test_a_load_reads_no_positions_of_earlier_dates(spark, history, tmp_path):
    """Files of earlier dates are made unreadable: whoever opens one fails."""
    shutil.copytree(history[0].root, tmp_path / "s")
    store = Store(spark, str(tmp_path / "s"))
    for path in glob.glob(str(tmp_path / "s/fact_keyword_position/**/*.parquet"), recursive=True):
        with open(path, "wb") as broken:
            broken.write(b"PAR1 no parquet PAR1")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        store.read("fact_keyword_position").agg(F.sum("position")).collect()
    clean = cleaning.staged_positions(many(spark, ["2026-02-02"])["positions"], ORDER["positions"])
    none = F.lit(None).cast("int")
    with_figures = {"previous_position": none, "clicks_30d": F.lit(0).cast("bigint"), "impressions_30d": F.lit(0).cast("bigint")}
    for previous, rows in (("history", clean), ("export", clean.withColumns(with_figures))):
        fresh = loading.new_positions(
            store.read("fact_keyword_position"), rows, store.read("dim_keyword"), store.read("dim_page"), previous,
            latest=store.read("latest_position"), greatest=12,
        )
        got = fresh.collect()
        assert sorted(r.position_id for r in got) == list(range(13, 19))
        assert previous == "export" or all(r.previous_position is not None for r in got)


def counting(rows):
    """The same rows, counted by an accumulator whenever they are made."""
    made = rows.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema), made


@pytest.mark.parametrize("previous", ["history", "export"])
@pytest.mark.parametrize("with_latest", [False, True])
def test_a_batch_of_positions_is_made_once(spark, history, previous, with_latest):
    store = history[0]
    rows = cleaning.staged_positions(many(spark, ["2026-01-19", "2026-02-02"])["positions"], ORDER["positions"])
    rows = rows.withColumns({"previous_position": F.lit(None).cast("int"), "clicks_30d": F.lit(1).cast("bigint"), "impressions_30d": F.lit(2).cast("bigint")})
    rows, made = counting(rows)
    fresh = loading.new_positions(
        store.read("fact_keyword_position"), rows, store.read("dim_keyword"), store.read("dim_page"), previous,
        latest=store.read("latest_position") if with_latest else None,
    )
    got = fresh.collect()
    assert {r.snapshot_date for r in got} == {"2026-02-02"} and len(got) == 6
    assert made.value == 12


def test_vacuum_removes_what_no_visible_run_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "COMPACT_AFTER", 1)
    store = Store(spark, str(tmp_path / "s"))
    calendar = spark.createDataFrame([("2026-01-01",)], "snapshot_date string")
    kinds = {f.name: f.dataType for f in DIM_PAGE.struct}

    def step(load_id, url, status="success", **options):
        run = store.open_run(load_id, load_id=load_id, **options)
        store.stage("stg_pages_raw", spark.range(1), load_id)
        store.append("snapshot_calendar", calendar, run)
        row = spark.createDataFrame([(url, load_id)], "url string, title string")
        row = row.select(*[F.col(c) if c in row.columns else F.lit(None).cast(kinds[c]).alias(c) for c in DIM_PAGE.names])
        store.update("dim_page", row, run)
        if status:
            store.close_run(run, status, 0, 0, load_id)

    step("old", "a")
    step("w1", "a", full_refresh=True)
    step("lost", "a", "failed")
    for load_id, url in (("w2", "b"), ("w3", "a"), ("w4", "c")):
        step(load_id, url)
    step("open", "a", None)

    def folders(pattern):
        return {os.path.relpath(p, store.root) for p in glob.glob(f"{store.root}/{pattern}")}

    def rows():
        return {name: bag(store.tables()[name].collect()) for name in ("dim_page", "snapshot_calendar")}

    before = rows()
    assert {(r.url, r.title) for r in store.read("dim_page").collect()} == {("a", "w3"), ("b", "w2"), ("c", "w4")}
    gone = store.vacuum()
    assert rows() == before and store.vacuum() == [] and len(gone) >= 6
    assert folders("snapshot_calendar/*/*") == {f"snapshot_calendar/generation=2/run_id={i}" for i in (1, 3, 4, 5, 6)}
    assert {os.path.basename(p) for p in folders("*/load_id=*")} == {f"load_id={x}" for x in ("w1", "w2", "w3", "w4", "open")}
    # Versions behind the last whole one are gone.
    assert len(folders("dim_page/generation=2/*")) < 5 and folders("dim_page/generation=1") == set()


def test_tables_written_in_passing_go(spark):
    with passing_tables(spark):
        inside = freeze(spark.range(3))
        path = inside.inputFiles()[0]
        assert inside.count() == 3
    frozen = files.listed(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/frozen/*")
    assert not [p for p in frozen if os.path.basename(p) in path]
    assert freeze(spark.range(3)).count() == 3


def test_numbers_are_lazy_and_leave_nothing(spark):
    tracker = spark.sparkContext.statusTracker()
    frozen = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/frozen/*"
    before, frame = files.listed(spark, frozen), spark.range(5000).selectExpr("id", "id % 7 AS g", "id % 50 AS v")
    spark.sparkContext.setJobGroup("lazy", "numbers")
    numbered = number_rows(frame, ["v", "id"], "n", within=["g"])
    ranked = rank_rows(frame, "v", "r", within=["g"])
    assert not tracker.getJobIdsForGroup("lazy")
    assert numbered.count() == ranked.count() == 5000 and tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("", "")
    assert files.listed(spark, frozen) == before


def test_ranges_are_even_and_numbers_do_not_change(spark):
    frame = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 > 0, 'hot', cast(id AS string)) AS k", "id")
    sizes = [r["count"] for r in with_ranges(frame, ["k", "id"], 32).groupBy("_range").count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 40_000 / 32 * 3
    numbered = number_rows(frame, ["k", "id"], "n")
    assert Counter(map(tuple, numbered.collect())) == Counter(map(tuple, number_rows(frame.repartition(3), ["k", "id"], "n").collect()))


def test_ranges_are_found_in_generated_code_and_groups_need_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(5000).selectExpr("id", "id % 7 AS g", "id % 50 AS v")
        for df in (number_rows(frame, ["v", "id"], "n", within=["g"]), with_ranges(frame, ["v", "id"], 32)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            main = plan.split("Subqueries")[0]
            assert "SortMergeJoin" not in main and "transform(" not in main
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    places = {r.id: r._range for r in with_ranges(frame, ["v", "id"], 32).collect()}
    ordered = sorted(places, key=lambda i: (i % 50, i))
    ranges = [places[i] for i in ordered]
    assert ranges == sorted(ranges) and len(set(ranges)) > 20


def test_numbers_of_few_rows_nulls_and_ties(spark):
    frame = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), (None, 0)], "k string, id int")
    assert {r.id: r.n for r in number_rows(frame, ["k", "id"], "n").collect()} == {0: 1, 1: 2, 3: 3, 2: 4}
    assert number_rows(frame.limit(0), ["k"], "n").count() == 0
    tied = spark.createDataFrame([("x",)] * 3000, "k string")
    assert sorted(r.n for r in number_rows(tied, ["k"], "n").collect()) == list(range(1, 3001))
    values = [(g, v) for g in (None, 1) for v in (5, 5, None, 7, None)]
    got = rank_rows(spark.createDataFrame(values, "g int, v int"), "v", "r", within=["g"]).collect()
    assert Counter((r.v, r.r) for r in got) == {(7, 1): 2, (5, 2): 4, (None, 4): 4}


def test_constraints_scan_a_table_once(spark, tmp_path):
    child = Table(columns=(("id", LONG), ("a", LONG), ("b", LONG), ("t", TEXT)), key="id", required=("t",), unique=(("a", "t"),), allowed={"t": ("x", "y")}, ranges={"id": (0, 9)}, parents={"a": "p", "b": "q"})
    rows = [(1, 1, 1, "x"), (1, 1, 2, "x"), (2, 9, None, "z"), (None, None, 9, None), (-3, 2, 9, "y"), (None, 2, 9, "y")]
    where = str(tmp_path / "child")
    spark.createDataFrame(rows, child.struct).write.parquet(where)
    star = {"c": spark.read.parquet(where), "p": spark.createDataFrame([(1,), (2,)], "a bigint"), "q": spark.createDataFrame([(1,), (2,), (2,)], "b bigint")}
    report = quality.constraint_checks(star, {"c": child})
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.check: r.violations for r in report.collect()} == {
        "c.id not null": 2, "c.t not null": 1, "c.t in accepted values": 1, "c.id in range": 1,
        "c.id unique": 1, "c.a+t unique": 2, "c.a has parent": 1, "c.b has parent": 3,
    }
    empty = {name: df.limit(0) for name, df in star.items()}
    assert {r.violations for r in quality.constraint_checks(empty, {"c": child}).collect()} == {0}
