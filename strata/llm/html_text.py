"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is flattened to its text blocks. Each has its word count and link
density (share of words inside links), those of the blocks before and behind
it, and what encloses it: an article, parts that are never its text (menus,
headers, footers, sidebars, notices, adverts, forms, comments; by element, role
and exact class), and parts whose class or id only holds such a word, which
counts with words and links but decides nothing alone (``named``). A decision tree is trained on a
small labelled table of such blocks and applied as a column expression, so
pages are neither shuffled nor split over tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

FEATURES = ["words", "links", "words_before", "links_before", "words_behind", "links_behind", "article", "aside",
            "named"]

#: Elements whose content is no text of the page.
SILENT = {"script", "style", "head", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio",
          "video", "select", "textarea", "button", "datalist", "title"}
#: What may stand in a head; anything else ends it.
IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style",
           "template", "title"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "meter", "nobr", "output", "progress", "q", "rp", "rt", "ruby", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: An element that ends where one of these begins, inside the same parent.
ENDS_AT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
           "th": {"td", "th", "tr"}}
PARENTS = {"ul", "ol", "dl", "table", "div", "article", "section", "nav", "aside", "main", "body", "header", "footer",
           "form", "blockquote"}
STOPS = PARENTS | ENDS_AT.keys() | {"p"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
         "menu", "menubar", "toolbar", "status"}
ASIDE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
               "promoted", "promotion", "banner", "nav", "navbar", "navigation", "menu", "menus", "breadcrumb",
               "breadcrumbs", "sidebar", "sidebars", "widget", "widgets", "footer", "header", "masthead", "cookie",
               "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter",
               "subscribe", "subscription", "signup", "login", "social", "share", "sharing", "related", "recommended",
               "recommendations", "comment", "comments", "commentlist", "disqus", "replies", "respond", "pagination",
               "pager", "copyright", "legal", "disclaimer", "toolbar", "search"}
#: Words beside such a name that leave its meaning ("comment-list", "site-footer").
FRAME_WORDS = {"area", "article", "block", "blog", "body", "bottom", "box", "container", "content", "entry", "global", "inner",
               "item", "items", "left", "list", "outer", "page", "post", "right", "section", "site", "text", "top", "user",
               "wrap", "wrapper"}
#: Names of reader comments and adverts: nothing inside is main text. Any other
#: name says only how its own blocks look; an article inside is one.
LASTING_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "commentlist",
                 "disqus", "promo", "promoted", "promotion", "replies", "reply", "respond", "sponsor", "sponsored"}
WRAPPER_WORDS = {"header", "search", "widget", "widgets"}
COMMENT_WORDS = {"comment", "comments", "reply", "ad", "advert", "advertisement", "sponsored"}
_WORDS = re.compile(r"[a-z0-9]+")
_TITLE_END = re.compile(r"</?title|<body", re.IGNORECASE)


def _names_aside(names: str, tag: str) -> bool:
    """Whether class and id hold the name of a part that is no main text ("has-sidebar" does not)."""
    wanted = COMMENT_WORDS if tag in ARTICLE else ASIDE_WORDS
    for name in names.split():
        before = ""
        for word in _WORDS.findall(name):
            if word in wanted and before not in ("has", "with", "no", "without", "not"):
                return True
            before = word
    return False


def _aside_by_name(names: str, tag: str) -> int:
    """Whether a class or id is such a name, alone or with frame words only:
    3 if nothing inside is main text, 2 if an article inside is, 1 if it also
    names wrappers of whole pages, 0 if not."""
    wanted, found = COMMENT_WORDS if tag in ARTICLE else ASIDE_WORDS, 0
    for name in names.split():
        words = set(_WORDS.findall(name))
        own = words & wanted
        if own and words <= wanted | FRAME_WORDS:
            found = max(found, 3 if own & LASTING_WORDS else 1 if own <= WRAPPER_WORDS else 2)
    return found


class Flattener(HTMLParser):
    """Collects (text, words, words in links, in article, aside, named) per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, bool]] = []  # tag, silent, aside (0 to 3), article, named (inherited)
        self.count: Counter[str] = Counter()  # open elements by tag
        self.stops: list[int] = []  # places of open elements that _end_implied looks at
        self.links = 0
        self.at = 0
        self.parts: list[tuple[str, bool]] = []
        self.blocks: list[tuple[str, int, int, bool, int, bool]] = []

    def flush(self) -> None:
        parts, self.parts = self.parts, []
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            _, _, aside, article, named = self.open[-1] if self.open else ("", False, 0, False, False)
            linked = len(" ".join(p for p, a in parts if a).split())
            n = len(text.split(" "))
            self.blocks.append((text, n, min(n, linked), article, aside, named and not aside))

    def _close(self, index: int) -> None:
        for e in self.open[index:]:
            self.links -= e[0] == "a"
            self.count[e[0]] -= 1
        del self.open[index:]
        while self.stops and self.stops[-1] >= index:
            self.stops.pop()

    def parse_marked_section(self, i, report=1):
        if self.rawdata[i + 3:i + 9].lower() == "cdata[":
            return super().parse_marked_section(i, report)
        return self.parse_bogus_comment(i, report)  # up to the next ">", whatever it names

    def parse_starttag(self, i):
        self.at = i
        return super().parse_starttag(i)

    def _in_title(self, tag: str) -> bool:
        """Whether the tag is text of an open title. One that is never closed ends here, and so does an open head."""
        if self.open and self.open[-1][0] == "title":
            found = _TITLE_END.search(self.rawdata, self.at)
            if found and found.group(0).lower() == "</title":
                return True
            if tag not in IN_HEAD:
                self._close(len(self.open) - 1)
        if self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._close(len(self.open) - 1)
        return False

    def handle_starttag(self, tag, attrs):
        if self._in_title(tag):
            return
        if tag not in INLINE:
            self.flush()
            self._end_implied(tag)
        elif tag == "br":
            self.parts.append(("\n", False))
        if tag in VOID:
            return
        _, silent, aside, article, named = self.open[-1] if self.open else ("", False, 0, False, False)
        given = {k: (v or "").lower() for k, v in attrs}
        classes = given.get("class", "")
        if tag in ASIDE or given.get("role") in ROLES or "hidden" in given or given.get("aria-hidden") == "true":
            aside = 3
        elif tag not in ("body", "html"):
            # A heading's id is made from its own words.
            names = classes + " " + (given.get("id", "") if tag not in HEADINGS else "")
            if aside in (1, 2) and (tag in ARTICLE or given.get("role") in ("main", "article")):
                aside = 0
            aside = max(aside, _aside_by_name(names, tag))
            # What names the whole article says nothing of a block.
            named = _names_aside(names, tag) or (named and tag not in ARTICLE)
        article = article or tag in ARTICLE or given.get("role") in ("main", "article")
        self.links += tag == "a"
        self.count[tag] += 1
        if tag in STOPS:
            self.stops.append(len(self.open))
        self.open.append((tag, silent or tag in SILENT, aside, article, named))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in INLINE and tag not in VOID:
            self.handle_endtag(tag)

    def _end_implied(self, tag: str) -> None:
        for i in reversed(self.stops):
            own = self.open[i][0]
            if own == "p" or tag in ENDS_AT.get(own, ()):
                self._close(i)
                return
            if own in PARENTS:
                return

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._close(len(self.open) - 1)
        if not (self.open and self.open[-1][1]):
            self.parts.append((data, self.links > 0))


def blocks(html: str | None) -> list[tuple[str, int, int, bool, bool, bool]]:
    """The page's blocks. A "<" behind the last ">" opens nothing that is ever
    closed, so what follows there is text; looking for its end again and again
    would take time with the square of its length."""
    html = html or ""
    end = html.rfind(">") + 1
    parser = Flattener()
    parser.feed(html[:end])
    parser.close()
    if html[end:]:
        parser.handle_data(unescape(html[end:]))
    parser.flush()
    # Such a name that would take all of the page is a wrapper's, and is only weighed.
    wrapped = all(b[4] for b in parser.blocks)
    return [(*b[:4], b[4] > 1 or (b[4] == 1 and not wrapped), b[5] or (b[4] == 1 and wrapped)) for b in parser.blocks]


def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., html) -> (..., blocks): the page's blocks with their features."""
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.slice(low, 256)
            texts, numbers, offsets = [], {f: [] for f in FEATURES}, [0]
            for html in part.column("html").to_pylist():
                found = blocks(html)
                density = [b[2] / b[1] for b in found]
                count = [b[1] for b in found]
                texts += [b[0] for b in found]
                numbers["words"] += count
                numbers["links"] += density
                numbers["words_before"] += [0, *count[:-1]] if found else []
                numbers["links_before"] += [0.0, *density[:-1]] if found else []
                numbers["words_behind"] += [*count[1:], 0] if found else []
                numbers["links_behind"] += [*density[1:], 0.0] if found else []
                numbers["article"] += [b[3] for b in found]
                numbers["aside"] += [b[4] for b in found]
                numbers["named"] += [b[5] for b in found]
                offsets.append(len(texts))
            rows = pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), *(pa.array([float(x) for x in numbers[f]], pa.float64()) for f in FEATURES)],
                ["text", *FEATURES])
            own = {n: part.column(n) for n in part.schema.names if n != "html"}
            yield pa.RecordBatch.from_pydict(own | {"blocks": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)})


#: Labelled blocks: FEATURES but the last, then whether the block is main text.
_UNNAMED = [
    # Inside an article: text of any length, headings, captions, a linked paragraph.
    (120, 0.0, 8, 0.0, 90, 0.0, 1, 0, 1), (60, 0.05, 120, 0.0, 3, 0.0, 1, 0, 1), (1, 0.0, 60, 0.0, 45, 0.0, 1, 0, 1),
    (8, 0.0, 5, 1.0, 120, 0.0, 1, 0, 1), (3, 0.0, 0, 0.0, 2, 0.0, 1, 0, 1), (2, 0.0, 4, 0.0, 0, 0.0, 1, 0, 1),
    (12, 1.0, 60, 0.0, 40, 0.0, 1, 0, 1), (25, 0.4, 30, 0.1, 2, 1.0, 1, 0, 1), (1, 0.0, 12, 1.0, 9, 0.0, 1, 0, 1),
    (400, 0.01, 7, 0.0, 15, 0.0, 1, 0, 1), (6, 0.0, 14, 0.0, 12, 0.0, 1, 0, 1), (1, 1.0, 40, 0.0, 50, 0.0, 1, 0, 1),
    # Menus, headers, footers, sidebars, adverts, notices, forms and comments, in an article or not.
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (4, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0), (12, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0),
    (30, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0), (9, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0), (55, 0.1, 20, 0.5, 40, 0.0, 0, 1, 0),
    (40, 0.0, 80, 0.0, 70, 0.0, 1, 1, 0), (5, 0.4, 80, 0.0, 70, 0.0, 1, 1, 0), (2, 1.0, 30, 0.0, 2, 1.0, 1, 1, 0),
    (150, 0.0, 40, 0.0, 90, 0.0, 1, 1, 0), (18, 0.0, 3, 0.0, 22, 0.0, 0, 1, 0), (90, 0.0, 18, 0.0, 5, 0.0, 0, 1, 0),
    (200, 0.0, 3, 1.0, 100, 0.0, 0, 1, 0), (3, 0.0, 0, 0.0, 6, 0.2, 0, 1, 0), (7, 0.0, 200, 0.0, 120, 0.0, 1, 1, 0),
    # Pages without such elements: long text with few links is text, so is a short block between such.
    (80, 0.0, 3, 1.0, 60, 0.05, 0, 0, 1), (45, 0.1, 80, 0.0, 30, 0.0, 0, 0, 1), (20, 0.0, 45, 0.0, 25, 0.0, 0, 0, 1),
    (150, 0.02, 2, 1.0, 2, 1.0, 0, 0, 1), (35, 0.0, 4, 0.0, 2, 0.9, 0, 0, 1), (14, 0.0, 30, 0.0, 22, 0.0, 0, 0, 1),
    (5, 0.0, 60, 0.0, 70, 0.0, 0, 0, 1), (4, 0.0, 3, 1.0, 80, 0.0, 0, 0, 1), (7, 0.0, 90, 0.0, 40, 0.1, 0, 0, 1),
    (2, 0.0, 50, 0.0, 50, 0.0, 0, 0, 1), (9, 0.0, 25, 0.1, 45, 0.0, 0, 0, 1), (15, 0.2, 70, 0.0, 5, 0.0, 0, 0, 1),
    # Link lists and short loose lines are not.
    (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0), (6, 0.9, 4, 1.0, 5, 0.8, 0, 0, 0), (30, 0.8, 12, 0.9, 10, 1.0, 0, 0, 0),
    (3, 0.5, 60, 0.0, 4, 1.0, 0, 0, 0), (4, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0), (3, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0),
    (5, 1.0, 90, 0.0, 60, 0.0, 0, 0, 0), (60, 0.7, 3, 1.0, 40, 0.6, 0, 0, 0), (2, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0),
    (1, 0.0, 5, 0.9, 1, 0.0, 0, 0, 0), (6, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0), (8, 0.6, 20, 0.0, 15, 0.0, 0, 0, 0),
]
#: The same below a class or id that holds the name of such a part.
_NAMED = [
    # Long blocks with few links are text, and so are headings and short blocks next to such.
    (30, 0.0, 5, 0.0, 40, 0.0, 0, 0, 1), (45, 0.05, 3, 1.0, 2, 1.0, 0, 0, 1), (80, 0.0, 30, 0.0, 60, 0.0, 0, 0, 1),
    (150, 0.02, 2, 1.0, 90, 0.0, 0, 0, 1), (400, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (35, 0.1, 3, 0.0, 0, 0.0, 1, 0, 1),
    (60, 0.0, 2, 0.0, 50, 0.0, 1, 0, 1), (200, 0.01, 80, 0.0, 3, 0.0, 1, 0, 1), (30, 0.0, 4, 0.0, 2, 1.0, 1, 0, 1),
    (3, 0.0, 60, 0.0, 70, 0.0, 1, 0, 1), (5, 0.0, 70, 0.0, 50, 0.0, 0, 0, 1), (2, 0.0, 45, 0.0, 40, 0.0, 0, 0, 1),
    (4, 0.0, 2, 1.0, 80, 0.0, 0, 0, 1), (2, 0.0, 3, 0.0, 90, 0.0, 1, 0, 1), (15, 0.0, 50, 0.0, 45, 0.0, 1, 0, 1),
    # Short ones elsewhere, notices before the text, and link lists are not.
    (8, 0.0, 4, 0.0, 1, 0.0, 1, 0, 0), (12, 0.0, 0, 0.0, 30, 0.0, 0, 0, 0), (11, 0.0, 1, 1.0, 60, 0.0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0), (3, 0.0, 60, 0.0, 4, 1.0, 0, 0, 0), (6, 0.0, 14, 0.0, 9, 0.0, 1, 0, 0),
    (9, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0), (40, 0.7, 30, 0.8, 50, 0.0, 0, 0, 0), (12, 1.0, 60, 0.0, 40, 0.0, 1, 0, 0),
    (20, 0.0, 5, 0.0, 12, 0.0, 0, 0, 0), (16, 0.0, 90, 0.0, 2, 0.0, 1, 0, 0), (24, 0.0, 0, 0.0, 60, 0.0, 0, 0, 0),
    (22, 0.1, 12, 0.0, 70, 0.0, 1, 0, 0), (3, 0.0, 4, 0.0, 14, 0.0, 1, 0, 0), (2, 0.0, 1, 1.0, 18, 0.0, 0, 0, 0),
    (4, 0.0, 60, 0.0, 12, 0.0, 1, 0, 0), (1, 0.0, 0, 0.0, 22, 0.0, 0, 0, 0), (5, 0.0, 18, 0.0, 20, 0.0, 1, 0, 0),
    (12, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0), (14, 0.0, 4, 0.0, 90, 0.0, 0, 0, 0), (9, 0.0, 12, 1.0, 45, 0.0, 0, 0, 0),
    (10, 0.0, 5, 0.5, 50, 0.0, 1, 0, 0), (18, 0.0, 3, 0.0, 70, 0.0, 1, 0, 0), (8, 0.0, 9, 0.0, 55, 0.0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 80, 0.0, 0, 0, 0), (3, 1.0, 40, 0.0, 60, 0.0, 1, 0, 0), (5, 0.8, 4, 1.0, 90, 0.0, 0, 0, 0),
    (5, 0.4, 80, 0.0, 4, 0.8, 1, 0, 0), (60, 0.8, 3, 1.0, 40, 0.6, 1, 0, 0), (14, 0.1, 5, 0.0, 6, 0.0, 1, 0, 0),
]
LABELLED = [(*r[:-1], named, r[-1]) for named, rows in enumerate([_UNNAMED, _NAMED]) for r in rows]


def train_tree(spark: SparkSession, labelled=None):
    """A tree over FEATURES from (features ..., label) rows: its branches at the
    root, for blocks that are not ``named`` and for those that are."""
    rows = [tuple(map(float, r)) for r in (labelled or LABELLED)]
    branches = []
    for named in (0.0, 1.0):
        data = spark.createDataFrame([r for r in rows if r[-2] == named], [*FEATURES, "label"])
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data)
        branches.append(DecisionTreeClassifier(maxDepth=6, maxBins=64, seed=5).fit(vectors.coalesce(1)))
    return branches


def tree_column(model, block: Column) -> Column:
    """The tree as an expression over a struct of FEATURES: is it main text?"""
    def of(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        feature = block[FEATURES[split.featureIndex()]]
        return F.when(feature <= split.threshold(), of(node.leftChild())).otherwise(of(node.rightChild()))
    plain, named = (of(branch._java_obj.rootNode()) for branch in model)
    return F.when(block["named"] > 0, named).otherwise(plain)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html; others ignored):
    page_id, url, text, n_chars.

    White space inside a block becomes one blank, blocks are joined by one in
    page order. NULL or empty html, and a page without main text, give an
    empty text. Any id and url pass through, NULL too.
    """
    model = train_tree(pages.sparkSession)
    kept = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}
    features = ",".join(f"{f}:double" for f in FEATURES)
    ddl = ", ".join([*(f"{n} {t}" for n, t in kept.items()), f"blocks array<struct<text:string,{features}>>"])
    flat = pages.select("page_id", "url", "html").mapInArrow(flatten, ddl)
    chosen = F.filter("blocks", lambda b: tree_column(model, b))
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
    return (flat.select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return main_text(table(spark, sf_dir, "pages"))
