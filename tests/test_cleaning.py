"""Reading exports and the contracts on them."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ranktide.functions.text import is_malformed_int, keyword_key, parse_int, strip, url_host
from ranktide.operators import cleaning
from ranktide.sources.exports import read_export, tag_batch

KEYWORDS_CSV = '''keyword,category,search_intent,monthly_search_volume,keyword_difficulty
  Running Shoes ,transaccional,transactional,100,45
running shoes,comercial,commercial,999,10
   ,informativo,informational,10,10
bad numbers,informativo,informational,abc,200
negative,informativo,informational,-5,101
no category,,informational,1,1
odd category,otros,informational,1,1
defaults,comercial,,,
"quoted, ""so""",comercial,commercial,7,0
'''

PAGES_CSV = """url,title,h1,word_count,indexable,page_speed_score
 https://a.example/1 ,One, H ,100,1,90
https://a.example/1,Again,,200,1,80
https://a.example/2,Two,,,,
https://A.example/1,Other case,,5,0,0
ftp://a.example/3,Three,,1,1,1
https://a.example/4,Four,,-1,1,101
http://a.example/5,Five,,x,y,z
"""

POSITIONS_CSV = """keyword,url,snapshot_date,position,previous_position,clicks_30d,impressions_30d
running shoes,https://a.example/1,2026-01-05,-1,,1,10
RUNNING SHOES ,https://a.example/1,2026-01-05,5,7,20,10
running shoes,https://a.example/1,2026-01-05,6,7,1,10
running shoes,https://a.example/2,2026-01-05,,,-3,0
running shoes,https://a.example/2,,4,,1,1
defaults,https://a.example/4,2026-01-05,4,,1,1
nobody,https://a.example/4,2026-01-05,4,,1,1
nobody,https://a.example/1,2026-01-05,4,,1,1
defaults,https://a.example/1,2026-01-05,abc,,1,1
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("exports")
    for name, text in (("keywords", KEYWORDS_CSV), ("pages", PAGES_CSV), ("positions", POSITIONS_CSV)):
        (path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(path)


def by_key(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def errors(cleaned):
    return sorted((r.key, "; ".join(r.errors)) for r in cleaned.quarantine.collect())


def test_keywords(spark, folder):
    cleaned = cleaning.clean_keywords(read_export(spark, folder, "keywords"))
    valid = by_key(cleaned.valid, "keyword")
    assert set(valid) == {"running shoes", "defaults", 'quoted, "so"'}
    assert valid["running shoes"].monthly_search_volume == 100
    assert (valid["defaults"].monthly_search_volume, valid["defaults"].keyword_difficulty) == (0, 50)
    assert errors(cleaned) == [
        ("", "blank keyword"),
        ("bad numbers", "malformed number in monthly_search_volume: abc; difficulty out of range: 200"),
        ("negative", "negative volume: -5; difficulty out of range: 101"),
        ("no category", "unknown category: "),
        ("odd category", "unknown category: otros"),
    ]


def test_pages(spark, folder):
    cleaned = cleaning.clean_pages(read_export(spark, folder, "pages"))
    valid = by_key(cleaned.valid, "url")
    assert set(valid) == {"https://a.example/1", "https://a.example/2", "https://A.example/1"}
    assert valid["https://a.example/1"].title == "One"
    two = valid["https://a.example/2"]
    assert (two.word_count, two.indexable, two.page_speed_score) == (0, 0, None)
    assert errors(cleaned) == [
        ("ftp://a.example/3", "invalid URL: ftp://a.example/3"),
        ("http://a.example/5", "malformed number in word_count: x; malformed number in indexable: y; "
                               "malformed number in page_speed_score: z"),
        ("https://a.example/4", "negative word count: -1; page speed out of range: 101"),
    ]


def test_positions(spark, folder):
    keywords = cleaning.clean_keywords(read_export(spark, folder, "keywords"))
    pages = cleaning.clean_pages(read_export(spark, folder, "pages"))
    raw = read_export(spark, folder, "positions")
    cleaned = cleaning.clean_positions(raw, keywords.valid, pages.valid)
    valid = by_key(cleaned.valid, "keyword", "url")
    first = valid["running shoes", "https://a.example/1"]
    # The first copy is invalid, so the second wins; impressions are raised to the clicks.
    assert (first.position, first.clicks_30d, first.impressions_30d, first.ctr_30d) == (5, 20, 20, 1.0)
    unseen = valid["running shoes", "https://a.example/2"]
    assert (unseen.position, unseen.previous_position, unseen.clicks_30d, unseen.ctr_30d) == (0, None, 0, None)
    assert errors(cleaned) == [
        ("defaults @ https://a.example/1", "malformed number in position: abc"),
        ("defaults @ https://a.example/4", "orphan, unknown URL: https://a.example/4"),
        ("nobody @ https://a.example/1", "orphan, unknown keyword: nobody"),
        ("nobody @ https://a.example/4", "orphan, unknown keyword: nobody"),
        ("running shoes @ https://a.example/1", "negative position: -1"),
        ("running shoes @ https://a.example/2", "empty snapshot date"),
    ]
    assert raw.count() == len(valid) + len(errors(cleaned)) + 1  # one further copy


def test_missing_columns_take_their_own_defaults(spark, tmp_path):
    (tmp_path / "keywords.csv").write_text("keyword\nfoo\n")
    (tmp_path / "pages.csv").write_text("url\nhttps://a.example/\n")
    keyword = cleaning.clean_keywords(read_export(spark, str(tmp_path), "keywords")).valid.first()
    assert (keyword.category, keyword.search_intent, keyword.monthly_search_volume, keyword.keyword_difficulty) == (
        "informativo", "informational", 0, 50)
    page = cleaning.clean_pages(read_export(spark, str(tmp_path), "pages")).valid.first()
    assert (page.title, page.word_count, page.indexable, page.page_speed_score) == (None, 0, 1, None)


def test_missing_file_is_empty_and_missing_key_column_is_an_error(spark, tmp_path):
    assert read_export(spark, str(tmp_path), "positions").count() == 0
    (tmp_path / "pages.csv").write_text("title\nOne\n")
    with pytest.raises(ValueError, match="url"):
        read_export(spark, str(tmp_path), "pages")


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "keywords.csv").write_text("category,extra,keyword\ncomercial,1,foo\n")
    row = read_export(spark, str(tmp_path), "keywords").first()
    assert (row.keyword, row.category, row.search_intent) == ("foo", "comercial", None)


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "pages.csv").write_text('url,title\nhttps://a.example/,"two\nlines"\n')
    row = read_export(spark, str(tmp_path), "pages", multiline=True).first()
    assert row.title == "two\nlines"


def test_first_row_wins_over_many_files_and_splits(spark, tmp_path):
    """The winner is the one a sequential reader of the files in order of their names would meet first."""
    folder = tmp_path / "keywords.csv"
    folder.mkdir()
    expected = {}
    for part in range(3):
        lines = ["keyword,category,search_intent,monthly_search_volume,keyword_difficulty"]
        for n in range(400):
            key, volume = f"kw {n * 7 % 90}", part * 1000 + n
            expected.setdefault(key, volume)
            lines.append(f"{key},comercial,commercial,{volume},1")
        (folder / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        raw = read_export(spark, str(tmp_path), "keywords")
        assert raw.rdd.getNumPartitions() > 3
        valid = cleaning.clean_keywords(raw).valid
        assert {r.keyword: r.monthly_search_volume for r in valid.collect()} == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batch_tag(spark, folder):
    staged = tag_batch(read_export(spark, folder, "keywords"), "b-1", "2026-01-05T00:00:00Z")
    assert {(r.load_id, r.loaded_at) for r in staged.collect()} == {("b-1", "2026-01-05T00:00:00Z")}


def test_staging_defaults(spark):
    keywords = spark.createDataFrame(
        [(1, " Foo ", "  ", None, None, None), (2, "foo", "comercial", "x", 5, 5), (3, "  ", "a", "b", 1, 1)],
        "n int, keyword string, category string, search_intent string, monthly_search_volume int, "
        "keyword_difficulty int")
    assert [tuple(r) for r in cleaning.staged_keywords(keywords, ["n"]).collect()] == [
        ("foo", "informativo", "informational", 0, 50)]
    pages = spark.createDataFrame(
        [(1, " https://a.example/ ", "old", None, 1, 1, 1, "2026-01-01T00:00:00Z"),
         (2, "https://a.example/", " new ", None, None, None, None, "2026-01-02T00:00:00Z"),
         (3, "https://a.example/", "undated", None, 1, 1, 1, None)],
        "n int, url string, title string, h1 string, word_count int, indexable int, page_speed_score int, "
        "loaded_at string")
    (page,) = cleaning.staged_pages(pages, ["n"]).collect()
    assert (page.url, page.title, page.word_count) == ("https://a.example/", "new", None)
    positions = spark.createDataFrame(
        [(1, "Foo", "u ", "2026-01-01", None), (2, "foo", "u", "2026-01-01", 3), (3, "foo", "u", None, 3)],
        "n int, keyword string, url string, snapshot_date string, position int")
    assert [tuple(r) for r in cleaning.staged_positions(positions, ["n"]).collect()] == [("foo", "u", "2026-01-01", 0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12), min_size=1, max_size=30))
def test_text_functions_follow_python(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(strip(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


def test_numbers_and_hosts(spark):
    texts = ["12", " 7 ", "+3", "-4", "", "1.5", "abc", "99999999999", " "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = [tuple(r) for r in frame.select(parse_int(t, "int"), is_malformed_int(t, "int")).collect()]
    assert got == [(12, False), (7, False), (3, False), (-4, False), (None, False), (None, True), (None, True),
                   (None, True), (None, True)]
    urls = ["https://A.example/x", "http://me@b.example:80/", "https://c.example?q", "nothing", ""]
    hosts = spark.createDataFrame([(u,) for u in urls], "u string").select(url_host(F.col("u"))).collect()
    assert [h[0] for h in hosts] == ["a.example", "b.example", "c.example", "", ""]
    keys = spark.createDataFrame([(" ÁRBOL \t",)], "k string").select(keyword_key(F.col("k"))).first()
    assert keys[0] == "árbol"
