"""Language, BPE, main text, toxicity, quality and token files against plain versions and on held-out rows."""

from __future__ import annotations

import hashlib
import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import regex
from helpers import TEXTS, documents, empty, rows, words
from pyspark.sql import functions as F

from ranktide.llm import bpe, catalog, language, maintext, quality, runtime, tokenfile, toxicity
from ranktide.llm.pretokens import Numbers, Pretokenizer, Vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = bpe.read_ranks(bpe.vocabulary_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_equal_the_pattern():
    cutter, pattern = Pretokenizer(), regex.compile(public_tokenizers.PATTERN)
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "a", "S", "t", "é", "1", "٣", "²", "!", "_", "\xa0", "　", "\x1c", "中", "😀", "'d", "''"]
    for _ in range(500):
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(4)]
        points, _, starts, by_text = cutter.cut(texts)
        whole, ends = "".join(texts), np.append(starts[1:], len(points))
        got = [[whole[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(by_text[:-1], by_text[1:], strict=True)]
        assert got == [pattern.findall(t) for t in texts]


def test_both_forms_of_merges_equal_the_library(spark, library):
    df = documents(spark)
    expected = Counter()
    for doc_id, text, *_ in rows():
        ids = library.encode_ordinary(text or "")
        expected[doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    for merges in ("task", "fold"):
        assert Counter(map(tuple, bpe.digest(df, merges=merges).collect())) == expected
        assert bpe.encode(empty(spark), merges=merges).count() == 0


def test_queries_merge_by_the_fold(spark, library, monkeypatch):
    import corpus_pipeline

    text = "zxqvian blorptastic zxqvian hello world"
    df = spark.createDataFrame([(1, text), (2, f"{text} once")], "doc_id long, text string")
    for known in (bpe.KNOWN, 0):  # all words folded for all documents, or each in its task
        monkeypatch.setattr(bpe.frequent_words, "__defaults__", (known,))
        stage = corpus_pipeline.byte_bpe(spark, df, "")
        assert "aggregate(" in stage._jdf.queryExecution().optimizedPlan().toString()
        expected = {i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in df.collect()}
        assert {r.doc_id: bytes(r.ids) for r in stage.collect()} == expected
    docs = bpe.documents(df)
    table = bpe.rank_table(bpe.joins(bpe.read_ranks(bpe.vocabulary_path())))
    assert not len(bpe.frequent_words(docs, bpe.vocabulary_path(), table, 0).names)
    found = bpe.frequent_words(docs, bpe.vocabulary_path(), table, 100)
    fold = [" zxqvian", " blorptastic", " absent"]
    first, second, absent = found.places(Pretokenizer().named(fold))
    assert absent == -1 and first >= 0 and second >= 0
    assert [found.ids(p).tolist() for p in (first, second)] == [library._encode_single_piece(w.encode()) for w in fold[:2]]


def test_words_of_several_tasks_are_folded_once(spark):
    """A million words that come twice are among those that are folded for all documents."""
    counted = spark.range(1_000_000).select(F.lit(2).cast("long").alias("n"))
    assert bpe.frequent_from(counted, bpe.KNOWN) <= 2


def test_a_fold_begins_with_the_ranks_of_byte_pairs(spark, library):
    """A word reaches the fold as one array, so that a step has one array to cut."""
    ranks, draw = bpe.read_ranks(bpe.vocabulary_path()), random.Random(4)
    words = [bytes(draw.choices(range(256), k=draw.randint(1, 48))) for _ in range(100)]
    words += [bytes(draw.choices(b"abcdeth  in", k=draw.randint(1, 48))) for _ in range(100)]
    states = bpe.Begin(ranks).words(words).to_pylist()
    assert [len(s) for s in states] == [2 * len(w) + 3 for w in words]
    for word, state in zip(words, states, strict=True):
        assert state[2:-2:2] == [ranks[word[i : i + 1]] for i in range(len(word))]
        below = [ranks.get(word[i : i + 2], bpe.NO_RANK) - bpe.BELOW for i in range(len(word) - 1)]
        assert state[1::2] == [bpe.NO_RANK - bpe.BELOW, *below, bpe.NO_RANK - bpe.BELOW]
    table = bpe.rank_table(bpe.joins(ranks))
    df = spark.createDataFrame(list(enumerate(states)), "n int, word array<long>")
    got = df.select("n", bpe.folded_words(F.array("word"), table)[0].alias("ids")).collect()
    assert [r.ids for r in sorted(got)] == [library._encode_single_piece(w) for w in words]


def test_numbers_go_on_from_slice_to_slice():
    numbers, known, draw = Numbers(), {}, random.Random(5)
    for _ in range(30):
        names = sorted({draw.randrange(200) for _ in range(20)})
        found, new = numbers.of(np.array(names, dtype=np.uint64))
        assert [names[i] for i in new] == [n for n in names if n not in known]
        known |= {names[i]: len(known) + k for k, i in enumerate(new)}
        assert found.tolist() == [known[n] for n in names]


def test_long_words_merge_alike(library):
    ranks, draw = bpe.read_ranks(bpe.vocabulary_path()), random.Random(1)
    for _ in range(200):
        word = bytes(draw.choices(b"abcdeth  in", k=draw.randint(2, 120)))
        expected = library._encode_single_piece(word)
        assert bpe.merge_long(word, ranks) == expected == bpe.merge(word, ranks)


def test_a_worker_meets_a_million_words_once():
    asked, cutter = [], Pretokenizer()

    def encode(pieces):
        asked.extend(pieces)
        return [[len(p)] * (1 + len(p) % 3) for p in pieces]

    words = Vocabulary(encode, tokenfile.HELD_WORDS)
    texts = ["".join(f" {i:x}z" for i in range(start, start + 100_000)) for start in range(0, 500_000, 100_000)]
    ids = [words.ids([text, "", text[:700]], cutter) for text in texts]
    met = len(asked)
    for text, (flat, bounds) in zip(texts, ids, strict=True):
        again, cuts = words.ids([text, "", text[:700]], cutter)
        assert (again == flat).all() and (cuts == bounds).all()
    assert len(asked) == met == len(set(asked))
    expected = [n for piece in regex.findall(public_tokenizers.PATTERN, texts[1][:700]) for n in encode([piece])[0]]
    assert ids[1][0][ids[1][1][2] :].tolist() == expected
    held = words.names.nbytes + words.places.nbytes + words.offsets.nbytes + words.lengths.nbytes + words.flat.nbytes
    assert held <= 64 * len(words.names)


def test_token_files(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfile, "FILE_BYTES", 20_000)
    tokenizer = Tokenizer.from_file(tokenfile.vocabulary_path())
    tokenizer.encode_special_tokens = True
    folder = str(tmp_path / "tokens")
    manifest = tokenfile.write_tokens(documents(spark).where("doc_id IS NULL OR doc_id <> 9"), folder)
    got = [tuple(r) for r in tokenfile.read_digests(manifest, folder).collect()]
    expected, start = [], 0
    for doc_id, text, *_ in sorted((r for r in rows() if r[0] != 9), key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert manifest.count() > 1
    with pafs.LocalFileSystem().open_input_file(f"{folder}/{manifest.where('documents > 1').first()['file']}") as source:
        reader = tokenfile.FrameReader(source)
        wanted = reader.doc_id(1)
        assert [d for d, _ in reader.find([wanted])] == [wanted]
    nothing = tokenfile.write_tokens(empty(spark), str(tmp_path / "none"))
    assert tokenfile.read_digests(nothing, str(tmp_path / "none")).count() == 0


def test_token_files_of_texts_with_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenfile.vocabulary_path())
    texts = ["abc <|endoftext|> def", "<|endoftext|><|endoftext|>", "<|endoftext", "plain words", "", "x<|endoftext|>"]
    folder = str(tmp_path / "tokens")
    manifest = tokenfile.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folder)
    expected, start = [], 0
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in tokenfile.read_digests(manifest, folder).collect()]
    assert sorted(got) == expected and manifest.agg(F.sum("n_tokens")).first()[0] == start


def test_damaged_frames_are_noticed(tmp_path):
    path = str(tmp_path / "x.zst")
    with pafs.LocalFileSystem().open_output_stream(path, compression=None) as sink:
        writer = tokenfile.FrameWriter(sink)
        writer.add(1, b"\1\0\0\0" * 9)
        writer.add(2, b"\2\0\0\0" * 9)
        writer.finish()
    with pafs.LocalFileSystem().open_input_file(path) as source:
        reader = tokenfile.FrameReader(source)
        assert reader.ids(1).tolist() == [2] * 9
        reader.entries = reader.entries.copy()
        reader.entries["checksum"][0] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            reader.ids(0)


def test_languages(spark):
    draw = random.Random(4)
    vocabulary = {"xx": ["kata", "lobi", "mano", "siru"], "yy": ["grzeb", "wstrz", "plok", "chrum"]}
    data = [(i, " ".join(draw.choices(vocabulary[lang], k=12)), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    model = language.train(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    unseen = [(i, " ".join(draw.choices(vocabulary[lang], k=5)), lang) for i, lang in enumerate(["xx", "yy"] * 20)]
    found = language.identify(spark.createDataFrame(unseen, "doc_id long, text string, lang string"), model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in found)
    awkward = language.identify(documents(spark), model)
    assert set(documents(spark).columns) <= set(awkward.columns) and awkward.count() == len(rows())
    assert all(r["score"] == 0.0 for r in awkward.where("doc_id IN (0, 1, 2)").collect())
    assert language.identify(empty(spark), model).count() == 0
    assert language.train(empty(spark)) is None
    assert {r["lang_pred"] for r in language.identify(documents(spark), None).collect()} == {"und"}


def test_language_tables_stay_small(monkeypatch):
    """A worker holds the counts of few texts at once, whatever the rows of a batch."""
    model = language.LanguageModel(["xx", "yy"], np.ones(language.FEATURES, np.float32), np.eye(language.FEATURES, 2, dtype=np.float32), np.zeros(2, np.float32))
    texts = [f"text number {i}" for i in range(1000)]
    sizes, count = [], language.counts

    def counted(some):
        table = count(some)
        sizes.append(table.nbytes)
        return table

    monkeypatch.setattr(language, "counts", counted)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": texts, "lang": ["xx"] * 1000})
    assert sum(b.num_rows for b in language._scorer(model)([batch])) == 1000
    frequency = {f: n for b in language._document_frequencies([batch]) for f, n in zip(*b.to_pydict().values(), strict=True)}
    assert frequency[-1] == 1000 and sum(b.num_rows for b in language._sparse_counts([batch])) == 1000
    assert max(sizes) <= 8 << 20


def test_training_holds_few_vectors():
    """The driver keeps the sample packed, and makes the vectors of its rows one after the other."""
    features, ones = np.arange(2000).astype("<u2").tobytes(), np.ones(2000).astype("<u4").tobytes()
    sample = [{"features": features, "counts": ones, "lang": "xy"[i % 2]} for i in range(1000)]
    tracemalloc.start()
    try:
        language._fit(["x", "y"], np.ones(language.FEATURES, np.float32), sample)
        assert tracemalloc.get_traced_memory()[1] < 10 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="memory can't be read here")
def test_a_task_gives_its_memory_back():
    """What a task has freed goes to the system when it ends, also below what is still in use."""
    pinned = []

    def held():
        with open("/proc/self/statm") as figures:
            return int(figures.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    def work(batches):
        blocks = [bytearray(100_000) for _ in range(3000)]
        pinned.append(bytearray(100_000))
        assert held() > before + (200 << 20)
        del blocks
        yield from batches

    before = held()
    assert list(runtime.lean(work)([1, 2])) == [1, 2]
    assert pinned and held() < before + (100 << 20)


@needs_tables
def test_held_out_languages(spark):
    found = catalog.QUERIES["op4_language_id"](spark, FOLDER).where("held_out")
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    hits = found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert hits > 0.98


@needs_tables
def test_held_out_toxicity(spark):
    folder = FOLDER.replace("0.01", "0.1")
    found = catalog.QUERIES["op8_toxicity"](spark, folder).where("held_out")
    counts = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("toxic").agg(F.avg("predicted")).collect()
    share = {r[0]: r[1] for r in counts}
    assert share[1] > 0.8 and share[0] < 0.02


def test_swapped_groups_keep_their_score(spark):
    """Insults come with one group in the labelled texts; with the penalty its mere mention is not toxic."""
    draw = random.Random(6)
    vocabulary = [f"plain{i}" for i in range(300)]
    data, labels = [], []
    for i in range(400):
        text, toxic = draw.choices(vocabulary, k=12), i % 2
        if toxic:
            text += ["vile", "muslims"] if draw.random() < 0.9 else ["vile"]
        draw.shuffle(text)
        data.append((i, " ".join(text)))
        labels.append((i, toxic))
    docs, marked = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = spark.createDataFrame([(1, "plain1 plain2 muslims plain3"), (2, "plain4 christians plain5")], "doc_id long, text string")
    scores = {}
    for fairness in (0.0, 1.0):
        found = toxicity.score(neutral, toxicity.train(docs, marked, fairness=fairness)).collect()
        scores[fairness] = {r["doc_id"]: r["score"] for r in found}
    assert abs(scores[1.0][1] - scores[1.0][2]) < abs(scores[0.0][1] - scores[0.0][2])
    assert scores[1.0][1] < 0.5
    assert toxicity.counterfactual("The Muslims came.", toxicity.swaps()) == "the christians came."
    assert toxicity.counterfactual("nobody", toxicity.swaps()) is None


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(6, 1), (6, 0), (9, 0), (12, None), (999, 1), (13, 0)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark), labels)
    found = toxicity.score(documents(spark), model).collect()
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.train(documents(spark), labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score(documents(spark), None).collect()} == {0.0}


def plain_measures(text):
    found = words(text, lower=False)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return len(found), sum(map(len, found)), symbols, copies, len(covered), failed


def test_measures_equal_brute_force(spark):
    draw = random.Random(8)
    texts = [*TEXTS, "a b c d e f g h a b c d e f g h x", "x\nx\n\n \n x\nx", "#*$% [&|<>] é"]
    texts += ["\n".join(" ".join(draw.choices("ab", k=draw.randint(0, 12))) for _ in range(draw.randint(0, 6))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.measures(df).collect()}
    assert got == {i: plain_measures(t) for i, t in enumerate(texts)}


def test_weak_supervision_finds_the_unreliable_rule():
    draw = random.Random(1)
    patterns: Counter = Counter()
    truth: dict[tuple, list] = {}
    for _ in range(4000):
        good = draw.random() < 0.7
        sign = 1 if good else -1
        votes = tuple(0 if draw.random() < 0.2 else sign if draw.random() < right else -sign for right in (0.9, 0.85, 0.8, 0.5))
        patterns[votes] += 1
        truth.setdefault(votes, []).append(good)
    ordered = sorted(patterns.items())
    posterior = dict(zip([p for p, _ in ordered], quality.fit(ordered), strict=True))
    hits = sum((posterior[v] >= 0.5) == good for v, each in truth.items() for good in each)
    # No verdict by pattern can do better than the majority of each pattern.
    best = sum(max(sum(each), len(each) - sum(each)) for each in truth.values())
    assert hits / best > 0.99
    assert abs(posterior[1, 1, 1, -1] - posterior[1, 1, 1, 1]) < 0.05
    assert len(quality.fit([])) == 0


def test_quality_of_awkward_rows(spark):
    found = quality.judge(documents(spark)).collect()
    assert len(found) == len(rows())
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert quality.judge(empty(spark)).count() == 0


@needs_tables
def test_good_documents_are_kept(spark):
    found = catalog.QUERIES["op9_weak_supervision"](spark, FOLDER).where("NOT base_failed")
    shares = found.join(spark.read.parquet(f"{FOLDER}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id")
    share = {r[0]: r[1] for r in shares.groupBy("label").agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert share[1] > 0.98 and share[0] < 0.5


PAGE = """<html><head><title>T</title><script>var x = "<p>";</script></head><body><header><h1>Site</h1></header>
<nav><a href="x">A</a> B</nav><article><h1>Title</h1><p>Hello &amp; world<br>again<p>Second <a href="y">link</a>
<div class="advert">buy</div><ul><li>one<li>two</ul><p>1 < 2 &lt;b&gt;</article><div id="comments"><p>First!</p></div>
<aside>side</aside><form>Name <input></form><footer>&copy;</footer></body></html>"""


def test_main_text(spark):
    plain = "<div><h2>Long title of it</h2><p>Many words stand here in a row</p><p>and here</p></div><ul><li><a>x</a></li></ul>"
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "just text"), (5, "u", plain), (None, "u", PAGE), (1, "u", PAGE)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, text string")
    found = maintext.extract(df, maintext.train(df)).collect()
    article = "Title\n\nHello & world again\n\nSecond link\n\none\n\ntwo\n\n1 < 2 <b>"
    texts = {r["page_id"]: r["text"] for r in found}
    assert len(found) == 7 and texts[1] == texts[None] == article
    assert texts[2] == texts[3] == "" and texts[4] == "just text"
    assert texts[5] == "Long title of it\n\nMany words stand here in a row\n\nand here"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    nothing = maintext.train(df.limit(0))
    assert maintext.extract(df.limit(0), nothing).count() == 0
    assert maintext.best_region([-1.0, 2.0, -1.0, 2.0, -5.0, 2.5]) == (1, 4) and maintext.best_region([-1.0]) == (0, 0)


@pytest.mark.parametrize(
    ("opening", "closing"),
    [
        ('<body class="has-sidebar"><article>', "</article></body>"),
        ('<main class="with-nav">', "</main>"),
        ('<div id="search-page"><article>', "</article></div>"),
        ('<div id="search-page"><div>', "</div></div>"),
        ('<article class="post comment-open">', "</article>"),
        ('<article><div class="share-content">', "</div></article>"),
        ("<form><article>", "</article></form>"),
        ("<form>", "</form>"),
    ],
)
def test_wrappers_are_not_passed_over(opening, closing):
    content = '<p>Many words stand here in a row</p><div class="ad">buy this</div><p>and some more of them follow</p>'
    source = f'<html>{opening}{content}{closing}<div id="comments"><p>First one!</p></div></html>'
    assert maintext.main_text(source, maintext.Weights()) == "Many words stand here in a row\n\nand some more of them follow"
    assert maintext.read_page(source).gold_elements == (("<article" in opening) or ("<main" in opening))


@pytest.mark.parametrize(
    ("block", "text"),
    [
        ('<header class="entry-header"><h1>The title</h1></header>', "The title"),
        ('<h2 class="section-header">The title</h2>', "The title"),
        ('<table class="side-by-side"><tr><td>The title</td></tr></table>', "The title"),
        ('<p class="side-note">The title</p>', "The title"),
        ("<p>The <math><mi>x</mi></math> title</p>", "The x title"),
        ('<div class="section-header"><h2>The title</h2></div>', "The title"),
        ('<blockquote class="related">The title</blockquote>', "The title"),
        ('<div class="related-posts"><p>Read this</p></div>', ""),
        ('<div class="post banner">Buy</div>', ""),
        ('<form class="x"><input>Your name</form>', ""),
    ],
)
def test_class_words_inside_an_article(block, text):
    words = " ".join(f"word{i}" for i in range(30))
    found = maintext.main_text(f"<html><body><nav><a>x</a></nav><article><p>{words}</p>{block}<p>{words}</p></article></body></html>", maintext.Weights())
    assert found == "\n\n".join(x for x in (words, text, words) if x)


@needs_tables
def test_main_text_of_a_table_is_its_articles(spark):
    """A plain reading of the pages, whose articles are marked: their blocks but for adverts, forms and what is no text."""
    import html as entities

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in maintext.extract(pages, maintext.train(pages)).collect()}
    for row in pages.collect():
        inner = regex.search(r"(?s)<article>(.*)</article>", row["html"])[1]
        inner = regex.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", inner)
        inner = regex.sub(r"(?s)<(nav|aside|form|footer)\b.*?</\1>|<div class=\"ad\">.*?</div>", "<p>", inner)
        blocks = regex.split(r"</?(?:p|h[1-6]|ul|ol|li|div|blockquote|table|tr|td|th|tbody|pre|section|header)\b[^>]*>", inner)
        plain = [entities.unescape(regex.sub(r"<[^>]*>", "", regex.sub(r"<br\b[^>]*>", " ", b))) for b in blocks]
        texts = [" ".join(t.split()) for t in plain]
        assert got[row["page_id"]] == "\n\n".join(t for t in texts if t)


def test_large_comments_beside_the_article_are_passed_over():
    comments = '<div id="comments">' + "<p>a remark of a reader</p>" * 30 + "</div>"
    wrapped = f'<div class="with-sidebar"><article><p>Many words stand here in a row</p></article></div>{comments}'
    assert maintext.main_text(wrapped, maintext.Weights()) == "Many words stand here in a row"


def test_lists_tables_and_headings_inside_the_region_stay():
    """Most words of li, td and h3 stand outside the article, so that they weigh less than nothing."""
    plenty = "".join(f"<ul><li>entry {i} of a list</li></ul><table><tr><td>cell {i} here</td></tr></table><h3>box {i}</h3>" for i in range(20))
    words = " ".join(f"word{i}" for i in range(40))
    article = f"<article><p>{words}</p><h3>Part two</h3><ul><li>one item</li></ul><table><tr><td>a cell</td></tr></table><p>{words}</p></article>"
    source = f"<html><body><div>{plenty}</div>{article}<div>{plenty}</div></body></html>"
    page, counts = maintext.read_page(source), Counter()
    for key, size, gold in zip(page.keys, page.sizes, page.gold, strict=True):
        counts[key, gold] += size if key.startswith("w:") else 1
    weights = maintext.learn(counts)
    assert all(weights.of(f"w:{name}") < 0 for name in ("li", "td", "h3"))
    assert maintext.main_text(source, weights) == f"{words}\n\nPart two\n\none item\n\na cell\n\n{words}"


def test_pipeline_keeps_clean_documents_and_columns(spark):
    import corpus_pipeline

    folder = FOLDER.replace("0.01", "0.001")
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    n = docs.count()
    first = corpus_pipeline.language_id(spark, docs, folder)
    assert first.columns == docs.columns and first.count() == n
    result = corpus_pipeline.run(spark, folder)
    kept = result.count()
    assert 0.7 * n < kept <= n and result.select("doc_id").distinct().count() == kept
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
