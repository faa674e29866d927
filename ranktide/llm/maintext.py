"""Operator 6: main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive and tags negative, with weights learned from
labelled pages: those that mark their content with exactly one ``article`` or ``main`` element, of which at most
``sample_pages`` are used (documented parameter), those with the smallest id hash. A word's weight follows from the
element that holds it; words in links, lists or boxes that labelled pages have outside their content turn out
negative. One linear scan finds the contiguous region of the largest sum; all its blocks are the text, whatever their
weights.

Elements that never belong to an article (navigation, page headers and footers, sidebars, scripts, styles) are passed over
wherever they stand, and so are forms and boxes whose class or id says advert, notice, comment and the like, unless they
are wrappers: html, body, main and article are never passed over for their class; another box is a wrapper if it holds the
page's one ``article`` or ``main`` or most of its words, or, on a page without exactly one, most of the page's words.
Within the region nothing else is left out.

Defined results: null, empty and contentless html give the empty text; unclosed elements end where their parent ends;
``<`` that opens no tag is text; repeated pages get a row each; with no labelled page built-in weights are used; an empty
table gives an empty result; columns besides page_id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.runtime import ready, slices, table, to_batches

SAMPLE_PAGES = 2000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Fixed values of HTML: elements without content, with raw content, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
# Elements whose content is never part of an article, and words in a class or id that say the same unless of a wrapper.
OUTSIDE = frozenset(
    "head nav aside button select option svg canvas object audio video map dialog menu script style "
    "textarea title noscript template iframe".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar side aside widget footer header masthead notice notices cookie cookies "
    "consent gdpr alert popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comment comments commentlist discussion replies reply disqus login search form "
    "pagination pager toolbar copyright disclaimer".split()
)
# Of these the ones that say so inside an article as a part of a longer class too; the others do as a whole class only, as
# "section-header" or "side-note" name parts of the text.
OUTSIDE_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies newsletter "
    "subscribe subscription share sharing related recommended recommendations comment comments commentlist replies disqus".split()
)
GOLD = frozenset(("article", "main"))
# Blocks that hold the text itself are never passed over for their class.
CONTENT = frozenset(
    "blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr legend li p pre table tbody td tfoot th thead tr".split()
)
BOXES = BLOCK - GOLD - CONTENT - {"html", "body"}

DEFAULT_WORD, DEFAULT_LINK, DEFAULT_TAG = 1.0, -1.0, 0.3


@dataclass
class Node:
    name: str
    key: str
    outside: bool
    link: bool
    gold: int  # the outermost article or main, -1 if in none
    box: int  # the innermost box that may be passed over, -1 if in none


@dataclass
class Page:
    """Tokens of a page: words of a text run by holder, and tags; runs that are passed over have no tokens."""

    keys: list[str] = field(default_factory=list)  # "w:holder" or "t:tag"
    sizes: list[int] = field(default_factory=list)  # words of a run; 0 for a tag
    blocks: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    gold: list[bool] = field(default_factory=list)
    passed_links: int = 0  # words in links of what is passed over
    gold_elements: int = 0


@dataclass
class Boxes:
    """Boxes that may be passed over and article or main elements, found while a page is read."""

    parent: list[int] = field(default_factory=list)  # the box around a box
    in_gold: list[int] = field(default_factory=list)  # the article or main around a box
    gold_in: list[int] = field(default_factory=list)  # the box around an article or main
    box: list[int] = field(default_factory=list)  # of every token
    gold: list[int] = field(default_factory=list)  # of every token

    def around(self, box: int) -> Iterator[int]:
        while box >= 0:
            yield box
            box = self.parent[box]

    def passed(self, sizes: list[int]) -> list[bool]:
        """Which boxes are passed over: all but wrappers, and what lies in one that is."""
        free = [g for g, box in enumerate(self.gold_in) if box < 0] or list(range(len(self.gold_in)))
        one = free[0] if len(free) == 1 else -1
        holds = set(self.around(self.gold_in[one])) if one >= 0 else set()
        words = [0] * len(self.parent)
        base = 0
        for size, box, gold in zip(sizes, self.box, self.gold, strict=True):
            if size and (one < 0 or gold == one):
                base += size
            if size and box >= 0:
                words[box] += size
        for box in range(len(words) - 1, -1, -1):
            if self.parent[box] >= 0:
                words[self.parent[box]] += words[box]
        result: list[bool] = []
        for box, parent in enumerate(self.parent):
            most = 2 * words[box] > base and (one < 0 or self.in_gold[box] == one)
            result.append((parent >= 0 and result[parent]) or not (box in holds or most))
        return result


def _says_outside(rest: str, in_article: bool) -> bool:
    """Whether a class, id or role says that a box is no part of an article."""
    for found in MARKS.finditer(rest):
        classes = (found[1] or found[2] or found[3] or "").lower()
        words = set(re.findall(r"[a-z]+", classes))
        if in_article:
            words = words.intersection(OUTSIDE_PARTS).union(classes.split())
        if OUTSIDE_WORDS.intersection(words):
            return True
    return False


def read_page(source: str) -> Page:
    """One pass over the html."""
    page, boxes, stack = Page(), Boxes(), [Node("", "", False, False, -1, -1)]

    def add(key: str, size: int, text: str, gold: int, box: int) -> None:
        page.keys.append(key)
        page.sizes.append(size)
        page.blocks.append(block)
        page.texts.append(text)
        boxes.gold.append(gold)
        boxes.box.append(box)

    block, at, n = 0, 0, len(source)
    while at < n:
        found = TOKEN.match(source, at)
        at, text, name = found.end(), found["text"], found["name"]
        top = stack[-1]
        if text is not None:
            decoded = entities.unescape(text)
            words, key = len(decoded.split()), "w:a" if top.link else "w:" + top.key
            if top.outside:
                page.passed_links += words * top.link
            else:
                add(key, words, decoded, top.gold, top.box)
            continue
        if name is None:
            continue
        name = name.lower()
        if found["end"]:
            if name in BLOCK:
                block += 1
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    top = stack[depth]
                    del stack[depth:]
                    break
            else:
                top = stack[-1]
        else:
            if name in BLOCK:
                block += 1
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == "p":
                        del stack[depth:]
                        break
                    if stack[depth].name in BLOCK:
                        if stack[depth].name == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                            del stack[depth:]
                        break
            parent = stack[-1]
            outside = parent.outside or name in OUTSIDE
            if name in ("header", "footer"):
                outside = outside or name == "footer" or parent.gold < 0
            gold, box = parent.gold, parent.box
            if name in GOLD and not outside and gold < 0:
                gold = len(boxes.gold_in)
                boxes.gold_in.append(box)
            boxed = name in BOXES and (name != "header" or gold < 0)
            if not outside and (name == "form" or (boxed and _says_outside(found["rest"], gold >= 0))):
                boxes.parent.append(box)
                boxes.in_gold.append(gold)
                box = len(boxes.parent) - 1
            top = Node(
                name,
                name if name in BLOCK else parent.key,
                outside,
                parent.link or name == "a",
                gold,
                box,
            )
            if name == "br" and not outside:
                add("w:" + top.key, 0, " ", gold, box)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else n
            elif name not in VOID and not found["rest"].endswith("/"):
                stack.append(top)
            elif name not in VOID and name in BLOCK:
                stack.append(top)  # html ignores the slash
        if not top.outside:
            add("t:" + name, 0, "", top.gold, top.box)
    return _without_passed(page, boxes)


def _without_passed(page: Page, boxes: Boxes) -> Page:
    passed = boxes.passed(page.sizes)
    kept = [i for i, box in enumerate(boxes.box) if box < 0 or not passed[box]]
    if len(kept) < len(boxes.box):
        links = sum(size for key, size in zip(page.keys, page.sizes, strict=True) if key == "w:a")
        for name in ("keys", "sizes", "blocks", "texts"):
            values = getattr(page, name)
            setattr(page, name, [values[i] for i in kept])
        page.passed_links += links - sum(size for key, size in zip(page.keys, page.sizes, strict=True) if key == "w:a")
    page.gold = [boxes.gold[i] >= 0 for i in kept]
    page.gold_elements = sum(box < 0 or not passed[box] for box in boxes.gold_in)
    return page


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, key: str) -> float:
        if key.startswith("w:"):
            return self.words.get(key, DEFAULT_LINK if key == "w:a" else DEFAULT_WORD)
        return -self.tags.get(key, DEFAULT_TAG)


def learn(counts: dict[tuple[str, bool], int]) -> Weights:
    """Weights from how often each key stands in the content of labelled pages and outside it.

    A word weighs the log odds of being content, bounded to 3; a tag costs more the more of its kind stand outside.
    """
    inside, outside = Counter(), Counter()
    for (key, gold), n in counts.items():
        (inside if gold else outside)[key] += n
    weights = Weights()
    for key in inside.keys() | outside.keys():
        odds = math.log((inside[key] + 1) / (outside[key] + 1))
        if key.startswith("w:"):
            weights.words[key] = max(-3.0, odds) if odds < 0 else max(0.1, min(3.0, odds))
        else:
            weights.tags[key] = 0.1 + 0.4 * (outside[key] + 1) / (inside[key] + outside[key] + 2)
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range of the largest positive sum; of equal sums the first found; empty if none is positive."""
    best, best_range = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, value in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, best_range = total, (start, i + 1)
    return best_range


def main_text(source: str | None, weights: Weights) -> str:
    page = read_page(source or "")
    value = {key: weights.of(key) for key in set(page.keys)}
    scores = [value[k] * s if k.startswith("w:") else value[k] for k, s in zip(page.keys, page.sizes, strict=True)]
    start, end = best_region(scores)
    # A block that the region enters or leaves midway is kept whole.
    if end > start:
        while start > 0 and page.blocks[start - 1] == page.blocks[start]:
            start -= 1
        while end < len(scores) and page.blocks[end] == page.blocks[end - 1]:
            end += 1
    blocks: dict[int, list[str]] = {}
    for i in range(start, end):
        if page.texts[i]:
            blocks.setdefault(page.blocks[i], []).append(page.texts[i])
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in joined if text)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.string()), ("gold", pa.bool_()), ("n", pa.int64())])
    counted: Counter = Counter()
    for batch in batches:
        for source in batch.column("html").to_pylist():
            page = read_page(source or "")
            if page.gold_elements == 1:
                for key, size, gold in zip(page.keys, page.sizes, page.gold, strict=True):
                    counted[key, gold] += size if key.startswith("w:") else 1
                counted["w:a", False] += page.passed_links
    if counted:
        keys, golds = zip(*counted, strict=True)
        yield to_batches({"key": keys, "gold": golds, "n": list(counted.values())}, schema)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    ready(pages.sparkSession)
    hashed = pages.select(F.xxhash64(F.col("page_id").cast("string")).alias("_hash"), F.col("html").cast("string").alias("html"))
    labelled = hashed.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    # The largest hash in the sample, from the hashes alone, so that no html is sorted.
    last = labelled.select("_hash").orderBy("_hash").limit(sample_pages).agg(F.max("_hash")).first()[0]
    if last is None:
        return Weights()
    rows = labelled.where(F.col("_hash") <= last).select("html").mapInArrow(_counts, schema="key string, gold boolean, n long")
    summed = rows.groupBy("key", "gold").agg(F.sum("n").alias("n")).collect()  # one row per element name
    return learn({(r["key"], r["gold"]): r["n"] for r in summed})


def _extractor(weights: Weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(source, weights) for source in batch.column("html").to_pylist()]
            yield to_batches(
                {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]},
                schema,
            )

    return extract


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and ``n_chars`` for every page."""
    ready(pages.sparkSession)
    typed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return typed.mapInArrow(_extractor(weights), schema="page_id long, url string, text string, n_chars long")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
