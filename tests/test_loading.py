"""Numbering, upserts, as-of positions, whole runs."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ranktide.operators import loading, rules
from ranktide.operators.numbering import number_rows, rank_rows, with_ids
from ranktide.operators.snapshots import stage_against_history
from ranktide.plans import analyses, batch, loaded, views
from ranktide.schemas import DIM_KEYWORD, DIM_PAGE, EXPORT_COLUMNS, FACT_POSITION, SOURCE_ORDER, STAR
from ranktide.session import application_folder, shared_folder
from ranktide.sources import files, trade
from ranktide.sources.exports import read_export
from ranktide.sources.legacy import copy_tables
from ranktide.sources.store import Store
from sample import sample_star

SMALL = "/root/testdata/sf0.001"


def test_numbers_follow_the_order_without_gaps(spark):
    rng = random.Random(1)
    keys = [f"https://x.example/{rng.random()}" for _ in range(5000)]
    frame = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    got = {r.k: r.n for r in number_rows(frame, ["k"], "n", start=100).collect()}
    assert got == {k: 101 + i for i, k in enumerate(sorted(keys))}


def test_numbers_start_anew_within_groups_one_of_which_is_large(spark):
    rows = [(("hot" if i % 3 else f"g{i % 17}"), i * 37 % 3001) for i in range(3001)] + [(None, 5), (None, 4)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = number_rows(frame, [-F.col("v")], "n", within=["g"]).collect()
    expected = {}
    for g in {g for g, _ in rows}:
        for n, v in enumerate(sorted((v for h, v in rows if h == g), reverse=True), 1):
            expected[g, v] = n
    assert {(r.g, r.v): r.n for r in got} == expected


def test_rank_shares_numbers_between_equal_values(spark):
    rows = [(i % 2, 0 if i % 3 else i % 11, i) for i in range(900)]
    frame = spark.createDataFrame(rows, "g int, v int, id int").repartition(6)
    got = {r.id: r.rank for r in rank_rows(frame, "v", "rank", within=["g"]).collect()}
    assert got == {i: 1 + sum(1 for h, w, _ in rows if h == g and w > v) for g, v, i in rows}


def test_ids_go_on_from_the_greatest(spark):
    stored = spark.createDataFrame([(4,), (9,)], "id bigint")
    new = spark.createDataFrame([("b",), ("a",)], "k string")
    assert sorted((r.k, r.id) for r in with_ids(new, stored, "id", ["k"]).collect()) == [("a", 10), ("b", 11)]
    assert with_ids(new.limit(0), stored, "id", ["k"]).count() == 0
    assert {r.id for r in with_ids(new, stored.limit(0), "id", ["k"]).collect()} == {1, 2}


def keyword_table(spark, rows):
    return spark.createDataFrame(rows, DIM_KEYWORD.struct)


def test_keywords_are_added_but_never_changed(spark):
    stored = keyword_table(spark, [(3, "Old One", "comercial", "x", 5, 5, "u")])
    fresh = spark.createDataFrame([("old one", "informativo", "y", 9, 9), ("zeta", "comercial", "x", 1, 1),
                                   ("alpha", "comercial", "x", 1, 1)], "keyword string, category string, "
                                  "search_intent string, monthly_search_volume bigint, keyword_difficulty int")
    got = sorted(tuple(r) for r in loading.upsert_keywords(stored, fresh).collect())
    assert got == [(3, "Old One", "comercial", "x", 5, 5, "u"), (4, "alpha", "comercial", "x", 1, 1, None),
                   (5, "zeta", "comercial", "x", 1, 1, None)]


PAGE_BATCH = ("url string, title string, h1 string, word_count int, indexable int, page_speed_score int, "
              "loaded_at string")


def test_pages_are_updated_in_either_mode(spark):
    stored = spark.createDataFrame(
        [(1, 1, "https://a.example/1", "t", "about", "h", 10, 1, 50, "2026-01-01"),
         (2, 1, "https://a.example/2", "t2", "about2", "h2", 20, 1, 60, "2026-01-01")], DIM_PAGE.struct)
    sites = spark.createDataFrame([(1, "a.example"), (7, "b.example")], "site_id bigint, domain string")
    fresh = spark.createDataFrame(
        [("https://a.example/1", None, "new h", None, 0, None, "2026-02-02T10:00:00Z"),
         ("https://B.example/9", "n", None, None, None, None, None),
         ("https://c.example/9", "n", None, 5, 0, 9, "2026-02-03T10:00:00Z")], PAGE_BATCH)
    for mode, first in (("coalesce", ("t", "new h", 10, 0, 50, "2026-02-02")),
                        ("overwrite", (None, "new h", None, 0, None, "2026-01-01"))):
        got = {r.page_id: r for r in loading.upsert_pages(stored, fresh, sites, "2026-03-03", mode).collect()}
        assert (got[1].title, got[1].h1, got[1].word_count, got[1].indexable, got[1].page_speed_score,
                got[1].last_crawled_at) == first
        assert got[1].meta_description == "about" and tuple(got[2])[3:] == ("t2", "about2", "h2", 20, 1, 60, "2026-01-01")
        assert (got[3].url, got[3].site_id, got[3].word_count, got[3].indexable, got[3].last_crawled_at) == (
            "https://B.example/9", 7, 0, 1, "2026-03-03")
        assert (got[4].site_id, got[4].word_count, got[4].indexable, got[4].last_crawled_at) == (1, 5, 0, "2026-02-03")
    with pytest.raises(ValueError):
        loading.updated_pages(stored, fresh, "merge")


def test_previous_position_comes_from_stored_rows_before_the_date(spark):
    rng = random.Random(7)
    days = [f"2026-01-{d:02d}" for d in range(1, 29)]
    stored = {(k, p, d): rng.randint(0, 50) for k in range(6) for p in range(4) for d in rng.sample(days, 6)}
    staged = {(k, p, d): rng.randint(0, 50) for k in range(8) for p in range(4) for d in rng.sample(days, 5)}
    as_frame = lambda rows: spark.createDataFrame(
        [(*key, v) for key, v in rows.items()],
        "keyword_id bigint, page_id bigint, snapshot_date string, position int").repartition(4)
    got = {(r.keyword_id, r.page_id, r.snapshot_date): (r.position, r.previous_position)
           for r in stage_against_history(as_frame(stored), as_frame(staged)).collect()}
    expected = {}
    for (k, p, d), now in staged.items():
        if (k, p, d) in stored:
            continue
        before = [e for (l, q, e) in stored if (l, q) == (k, p) and e < d]
        expected[k, p, d] = (now, stored[k, p, max(before)] if before else None)
    assert got == expected


def test_unresolvable_positions_drop_out(spark):
    keywords = keyword_table(spark, [(1, "Foo", "comercial", "x", 5, 5, None)])
    pages = spark.createDataFrame([(1, "https://a.example/")], "page_id bigint, url string")
    staged = spark.createDataFrame([("foo", "https://a.example/", "2026-01-01", 4),
                                    ("bar", "https://a.example/", "2026-01-01", 4),
                                    ("foo", "https://z.example/", "2026-01-01", 4)],
                                   "keyword string, url string, snapshot_date string, position int")
    empty = spark.createDataFrame([], FACT_POSITION.struct)
    (row,) = loading.new_positions(empty, staged, keywords, pages).collect()
    assert (row.position_id, row.keyword_id, row.previous_position, row.clicks_30d, row.ctr_30d) == (1, 1, None, 0, None)
    with pytest.raises(ValueError):
        loading.new_positions(empty, staged, keywords, pages, previous="guess")


def write_exports(folder, day, positions, pages=("https://shop.example/1", "https://blog-demo.com/2")):
    folder.mkdir(exist_ok=True)
    (folder / "keywords.csv").write_text(
        "keyword,category,search_intent,monthly_search_volume,keyword_difficulty\n"
        "Zeta,comercial,commercial,5000,10\nalpha,comercial,commercial,100,20\n,comercial,x,1,1\n")
    (folder / "pages.csv").write_text(
        "url,title,h1,word_count,indexable,page_speed_score\n"
        + "".join(f"{u},t,h,10,{int('2' not in u)},50\n" for u in pages))
    (folder / "positions.csv").write_text(
        "keyword,url,snapshot_date,position,previous_position,clicks_30d,impressions_30d\n"
        + "".join(f"{k},{u},{day},{now},{before},10,100\n" for k, u, now, before in positions))
    return str(folder)


def content(store):
    return {name: sorted(map(tuple, store.read(name).collect()), key=repr) for name in
            ("dim_site", "dim_keyword", "dim_page", "fact_keyword_position", "fact_technical_issue",
             "snapshot_calendar")}


def test_exports_load_once_and_accumulate(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    week1 = write_exports(tmp_path / "w1", "2026-01-05", [
        ("zeta", "https://shop.example/1", 9, 3), ("alpha", "https://blog-demo.com/2", 20, "")])
    first = batch.load_exports(store, week1, "2026-01-06", "w1")
    assert first.extracted == {"keywords": 3, "pages": 2, "positions": 2} and first.rejected == 1
    assert first.loaded == {"dim_keyword": 2, "dim_page": 2, "fact_keyword_position": 2, "fact_technical_issue": 2}
    state = content(store)
    assert [r[:2] for r in state["dim_keyword"]] == [(1, "zeta"), (2, "alpha")]  # ids in input order
    assert [r[:3] for r in state["dim_page"]] == [(1, 1, "https://shop.example/1"), (2, 2, "https://blog-demo.com/2")]
    assert [r[2:5] for r in state["fact_technical_issue"]] == [(2, "noindex", "critical"),
                                                               (1, "content_decay", "medium")]
    assert state["snapshot_calendar"] == [("2026-01-05",)]

    again = batch.load_exports(store, week1, "2026-01-07", "w1-again")
    assert set(again.loaded.values()) == {0} and content(store) == state

    week2 = write_exports(tmp_path / "w2", "2026-01-12", [("zeta", "https://shop.example/1", 4, 9)],
                          pages=("https://shop.example/1", "https://shop.example/3"))
    second = batch.load_exports(store, week2, "2026-01-13", "w2")
    assert second.loaded["fact_keyword_position"] == 1 and second.loaded["dim_page"] == 1
    assert second.loaded["dim_keyword"] == 0


def test_exports_accumulate_snapshots(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for week, (day, now, before) in enumerate((("2026-01-05", 9, ""), ("2026-01-12", 4, 9))):
        folder = write_exports(tmp_path / f"w{week}", day, [("zeta", "https://shop.example/1", now, before)])
        batch.load_exports(store, folder, day, f"w{week}")
    star = store.tables()
    assert [tuple(r) for r in views.position_changes(star).select("snapshot_date", "position", "trend").orderBy(
        "snapshot_date").collect()] == [("2026-01-05", 9, "new"), ("2026-01-12", 4, "improved")]
    assert analyses.almost_winning(star).count() == 1
    log = {r.run_id: r for r in store.runs().collect()}
    assert {r.status for r in log.values()} == {"success"} and set(log) == {1, 2}
    assert log[2].rows_extracted == 3 + 2 + 1 and log[2].rows_loaded == 1 and log[2].finished_at
    assert analyses.table_counts(star).filter("tabla = 'etl_run_log'").first().filas == 2

    plan = views.category_summary(star)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "(snapshot_date" in plan.split("PartitionFilters")[1]


def test_failed_run_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    folder = write_exports(tmp_path / "w", "2026-01-05", [("zeta", "https://shop.example/1", 9, 3)])

    def broken(*_args, **_options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(batch.rules, "decay_issues", broken)
        with pytest.raises(RuntimeError):
            batch.load_exports(store, folder, "2026-01-06", "w")
    assert store.generation() == 0 and store.read("dim_keyword").count() == 0
    assert [r.status for r in store.runs(1).collect()] == ["failed"]
    batch.load_exports(store, folder, "2026-01-06", "w")
    assert store.read("dim_keyword").count() == 2 and store.read("fact_keyword_position").count() == 1
    assert sorted((r.run_id, r.status) for r in store.runs().collect()) == [(1, "failed"), (2, "success")]


def test_full_refresh_starts_from_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    folder = write_exports(tmp_path / "w1", "2026-01-05", [("zeta", "https://shop.example/1", 9, 3)])
    batch.load_exports(store, folder, "2026-01-06", "w1")
    folder = write_exports(tmp_path / "w2", "2026-01-12", [("alpha", "https://shop.example/1", 7, "")])
    batch.load_exports(store, folder, "2026-01-13", "w2", full_refresh=True)
    assert {r.snapshot_date for r in store.read("fact_keyword_position").collect()} == {"2026-01-12"}
    assert store.runs().count() == 1 and store.generation() == 2


def test_staging_load_looks_positions_up_in_the_history(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    keywords = spark.createDataFrame([(1, "Foo", None, None, 100, None)], "n int, keyword string, category string, "
                                     "search_intent string, monthly_search_volume int, keyword_difficulty int")
    pages = spark.createDataFrame([(1, "https://shop.example/", "t", "h", 5, 1, 50, "2026-01-05T00:00:00Z")],
                                  "n int, " + PAGE_BATCH)
    order = {"keywords": ["n"], "pages": ["n"], "positions": ["n"]}

    def load(day, position, run_date):
        positions = spark.createDataFrame([(1, "foo ", "https://shop.example/", day, position)],
                                          "n int, keyword string, url string, snapshot_date string, position int")
        staging = {"keywords": keywords, "pages": pages, "positions": positions}
        return batch.load_staging(store, staging, run_date, f"load-{day}", order)

    load("2026-01-05", 4, "2026-01-06")
    load("2026-01-19", 12, "2026-01-20")
    late = load("2026-01-12", 9, "2026-01-20")  # a back-dated snapshot
    got = {r.snapshot_date: r.previous_position for r in store.read("fact_keyword_position").collect()}
    assert got == {"2026-01-05": None, "2026-01-19": 4, "2026-01-12": 4}
    # The drop to 12 was reported on the 20th, so the page is silent for the rest of that day.
    assert late.loaded["fact_technical_issue"] == 0
    severities = [(r.issue_type, r.severity) for r in store.read("fact_technical_issue").collect()]
    assert severities == [("content_decay", "high")]


def test_copied_tables_are_counted(spark, tmp_path):
    source = tmp_path / "old"
    spark.range(5).write.parquet(str(source / "dim_keyword"))
    spark.range(7).write.parquet(str(source / "dim_date"))
    report = copy_tables(spark, str(source), str(tmp_path / "new"), ["dim_keyword", "dim_date"])
    assert sorted(map(tuple, report.collect())) == [("dim_date", 7, 7, True), ("dim_keyword", 5, 5, True)]
    copy_tables(spark, str(source), str(tmp_path / "new"), ["dim_keyword"])
    assert spark.read.parquet(str(tmp_path / "new" / "dim_keyword")).count() == 5


def test_sample_tables_match_their_declaration(spark):
    for name, df in sample_star(spark).items():
        assert df.columns == STAR[name].names


def staging(spark, day, positions=(("zeta", "https://www.shop.example/1", 4),)):
    return {
        "keywords": spark.createDataFrame([("zeta", "comercial", "x", 5, 5)], "keyword string, category string, search_intent string, monthly_search_volume int, keyword_difficulty int"),
        "pages": spark.createDataFrame(
            [("https://www.shop.example/1", "t", "h", 1, 1, 50, "2026-01-01T00:00:00Z")],
            "url string, title string, h1 string, word_count int, indexable int, page_speed_score int, loaded_at string"),
        "positions": spark.createDataFrame(
            [(k, u, d, p) for k, u, p in positions for d in day], "keyword string, url string, snapshot_date string, position int"),
    }


ORDER = {"keywords": ["keyword"], "pages": ["url"], "positions": ["keyword", "url", "position"]}


def test_undated_positions_go_to_quarantine_and_hide_no_later_ones(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    first = batch.load_staging(store, staging(spark, ["", " ", "zzz", "2026-02-30", None, "2026-01-01"]), "2026-01-02", "a", ORDER)
    assert first.rejected == 5 and first.loaded["fact_keyword_position"] == 1
    second = batch.load_staging(store, staging(spark, [" 2026-01-08 "]), "2026-01-09", "b", ORDER)
    assert second.loaded["fact_keyword_position"] == 1
    assert {r.snapshot_date for r in store.read("fact_keyword_position").collect()} == {"2026-01-01", "2026-01-08"}


def test_a_stored_row_without_date_hides_nothing(spark):
    stored = spark.createDataFrame([(1, 1, None, 5), (1, 1, "2026-01-01", 7)], "keyword_id bigint, page_id bigint, snapshot_date string, position int")
    staged = spark.createDataFrame([(1, 1, "2026-01-08", 3, "k", "u")], "keyword_id bigint, page_id bigint, snapshot_date string, position int, keyword string, url string")
    for history, before in ((stored, 7), (stored.filter("snapshot_date IS NULL"), None)):
        assert [r.previous_position for r in stage_against_history(history, staged).collect()] == [before]


def test_tables_show_one_set_of_runs(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    batch.load_staging(store, staging(spark, ["2026-01-01"]), "2026-01-02", "a", ORDER)
    seen, calls = Store._seen, []

    def commit_between(self, name, generation, run_ids):
        if not calls:  # a load is committed while the first table is opened
            calls.append(name)
            batch.load_staging(Store(spark, self.root), staging(spark, ["2026-01-08"]), "2026-01-09", "b", ORDER)
        return seen(self, name, generation, run_ids)

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_seen", commit_between)
        star = store.tables()
    assert star["fact_keyword_position"].count() == star["dim_keyword"].count() == star["snapshot_calendar"].count() == 1
    assert store.tables()["fact_keyword_position"].count() == 2


def test_a_load_with_failing_checks_stays_invisible(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    bad = staging(spark, ["2026-01-01"])
    bad["pages"] = bad["pages"].withColumn("indexable", F.lit(7))
    with pytest.raises(ValueError, match="accepted values"):
        batch.load_staging(store, bad, "2026-01-02", "a", ORDER)
    assert [r.status for r in store.runs(1).collect()] == ["failed"] and store.read("dim_page").count() == 0
    told = batch.load_staging(store, bad, "2026-01-02", "a", ORDER, publish_failing=True)
    assert told.failed_checks == 1 and store.read("dim_page").count() == 1


def test_own_sites_and_subdomains(spark, tmp_path):
    sites = [(5, "shop.example", "S", "en", "GB", 1), (6, "old.shop.example", "O", "en", "GB", 1)]
    store = Store(spark, str(tmp_path / "store"))
    batch.load_staging(store, staging(spark, ["2026-01-01"]), "2026-01-02", "a", ORDER, sites=sites)
    assert [r.site_id for r in store.read("dim_page").collect()] == [5]
    urls = ["https://a.old.shop.example/x", "https://myshop.example/", "https://SHOP.example:80/", "https://old.shop.example"]
    pages = loading.site_of(spark.createDataFrame([(u,) for u in urls], "url string"), store.read("dim_site"))
    assert {r.url: r.site_id for r in pages.collect()} == dict(zip(urls, (6, 1, 5, 6)))


def test_backlinks_are_loaded_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    batch.load_staging(store, staging(spark, ["2026-01-01"]), "2026-01-02", "a", ORDER)
    links = spark.createDataFrame(
        [("https://www.shop.example/1", "A.example ", 30, "editorial", "2026-01-01"),
         ("https://www.shop.example/1", "a.example", 30, "editorial", "2026-01-01"), ("https://x.example", "b.example", 3, "x", "y")],
        "url string, referring_domain string, domain_authority int, link_type string, first_seen_at string")
    outcome = batch.load_backlinks(store, links, "l1")
    assert outcome.loaded == {"fact_backlink": 1} and outcome.rejected == 1
    assert batch.load_backlinks(store, links, "l2").loaded == {"fact_backlink": 0}
    assert [tuple(r)[:3] for r in store.read("fact_backlink").collect()] == [(1, 1, "a.example")]
    assert store.read("dim_page").count() == 1


def test_an_export_is_written_compressed_and_in_order(spark):
    loaded.write_exports(spark, SMALL, where := application_folder(spark, "scratch"), "positions")
    names = [path.rsplit("/", 1)[1] for path in files.listed(spark, f"{where}/positions.csv/part-*")]
    assert names and all(name.endswith(".csv.lz4") for name in names)
    t = trade.Trade(spark, SMALL)
    columns = EXPORT_COLUMNS["positions"]
    expected = trade.raw_positions(t).orderBy(*trade.POSITION_ORDER).select(*columns).collect()
    read = read_export(spark, where, "positions").orderBy(*SOURCE_ORDER).select(*columns).collect()
    assert len(read) > 1000 and read == expected


def test_a_load_keeps_no_copies_of_its_positions_while_the_rules_run(spark, tmp_path, monkeypatch):
    folder = f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/frozen/*"
    before, seen, new_positions, ranked_pages = [], [], loading.new_positions, rules.ranked_pages

    def begins(*args):
        before.extend(files.listed(spark, folder))
        return new_positions(*args)

    def ended(fact):
        seen.append(set(files.listed(spark, folder)) - set(before))
        return ranked_pages(fact)

    monkeypatch.setattr(loading, "new_positions", begins)
    monkeypatch.setattr(rules, "ranked_pages", ended)
    exports = write_exports(tmp_path / "w1", "2026-01-05", [("zeta", "https://shop.example/1", 9, 3)])
    outcome = batch.load_exports(Store(spark, str(tmp_path / "store")), exports, "2026-01-06", "w1")
    assert outcome.loaded["fact_keyword_position"] == 1 and seen == [set()]
    assert not files.listed(spark, str(tmp_path / "store" / "checked_positions" / "load_id=*"))
    assert files.listed(spark, str(tmp_path / "store" / "stg_positions_raw" / "load_id=*"))


def test_shuffles_of_a_load_go_when_its_positions_are_written(spark, tmp_path, monkeypatch):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {name for top in folders for _, _, names in os.walk(top) for name in names if name.endswith(".data")}

    seen, newer_positions = [], batch.newer_positions

    def spied(latest, written):
        until = time.monotonic() + 30  # Spark's cleaner works beside the driver
        while (left := shuffled() - before) and time.monotonic() < until:
            time.sleep(0.2)
        seen.append(left)
        return newer_positions(latest, written)

    monkeypatch.setattr(batch, "newer_positions", spied)
    exports = write_exports(tmp_path / "w1", "2026-01-05", [("zeta", "https://shop.example/1", 9, 3)])
    before = shuffled()
    batch.load_exports(Store(spark, str(tmp_path / "store")), exports, "2026-01-06", "w1")
    assert seen == [set()]
