"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read tag by tag into a flat list of text blocks; a block ends where a block-level element begins or
ends. Each block has a word count and a link density, and those of its neighbours, and knows which kinds of
element it stands in. A decision tree, trained on the small labelled table below, tells main text from the
rest. What can never be text to read (scripts, styles, controls, comments, hidden parts) makes no block; a form
makes blocks only when it holds running text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm import common

#: Elements whose content is never shown as text, and those that are controls to fill in.
SILENT = {"script", "style", "template", "noscript", "svg", "annotation", "annotation-xml", "iframe", "object", "canvas", "audio", "video",
          "head", "title", "button", "select", "textarea", "option", "datalist", "dialog", "map"}
#: Of these, elements whose content is plain characters up to their end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input", "picture", "source", "output", "meter",
          "progress", "nobr", "rb", "rtc", "link", "meta", "script", "style", "template", "noscript", "svg", "iframe",
          "object", "embed", "param", "canvas", "audio", "video", "track", "button", "select", "textarea", "map", "area",
          "math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "mpadded",
          "mphantom", "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts",
          "mprescripts", "mtable", "mtr", "mtd", "semantics", "annotation", "annotation-xml"}
#: An open element that ends where one of these begins.
ENDS = {"p": {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1",
              "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"},
        "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
        "tr": {"tr"}}
#: What may stand in a head; any other element, and text, ends a head that was not closed.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noscript", "script", "style", "template", "title"}
#: A form without a block of so many unlinked words is there to be filled in.
FORM_WORDS = 20
#: Words in a class or id for what surrounds an article. Such a word may also be a first part that says where
#: an element is, or what it is like ("sidebar-layout", "banner-page").
AROUND = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adverts?|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|"
    r"side|widgets?|related|recommend\w*|share|sharing|social|footer|header|masthead|cookies?\w*|consent|gdpr|notice\w*|"
    r"popup|modal|overlay|newsletter|subscribe\w*|signup|login|search\w*|pagination|pager|toolbar|comments?|respond|replies|"
    r"disqus|complementary|contentinfo|navigation|banner|alert|disclaimer|copyright|tags?|toc)(?:$|[-_\s])", re.I)
#: Names that say what the element itself is: a word for surroundings as the last part of the name, or before a
#: last part that only says that there is a box with something in it.
NAMED = (r"(?:ads?|adverts?|advert\w*|sponsor\w*|promos?|promotions?|nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|"
         r"widgets?|related|recommendations?|recommended|share|sharing|social|footer|masthead|cookies?|consent|gdpr|notices?|"
         r"newsletter|subscribe|subscription|signup|login|pagination|pager|toolbar|copyright|alert)")
REPLIES = r"(?:comments?|responses?|respond|repl(?:y|ies)|disqus|commentlist|discussion)"
_BOX = (r"(?:list|box|block|section|sections|wrapper|wrap|container|area|items?|body|content|contents|text|form|links?|bar|"
        r"inner|outer|thread|threads|meta|author|buttons?|icons?|posts?|articles?|stories|message|panel|group|row|col|"
        r"modal|popup|overlay|banner|header|heading|title|\d+)")
IS_AROUND = re.compile(rf"(?:^|[-_\s]){NAMED}(?:[-_]{_BOX})*(?:$|\s)", re.I)
IS_REPLIES = re.compile(rf"(?:^|[-_\s]){REPLIES}(?:[-_]{_BOX})*(?:$|\s)", re.I)
#: Parts of a class that say what an element has beside it, or lacks, or is about.
BESIDE = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|tags?|category|is|hide|show)-\S*", re.I)
#: Names whose last part says that the element is an article, or a part of one that a word above only describes.
_STORY = re.compile(r"[-_](?:story|article|post|work|works|paper|report)$", re.I)
#: Words that mark the article itself.
INSIDE = re.compile(r"(?:^|[-_\s])(?:article\w*|content|main\w*|post|post-?body|entry\w*|story\w*|body|text|prose)(?:$|[-_\s])", re.I)

# Where markup begins; the rest of a comment or declaration; a tag, and one whose quotes do not pair.
_OPEN = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_NO_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CHROME = {"nav", "aside", "footer", "menu"}

FEATURES = ("words", "link_density", "previous_words", "previous_density", "next_words", "next_density",
            "in_article", "in_chrome", "in_header", "heading", "list_item", "ends_sentence", "around")

# Labelled blocks: FEATURES in order, then 1 for main text. Blocks inside what surrounds an article, and plain
# blocks of an article, occur at any length, linked or not, next to anything; they are laid out by rule. The last
# feature is 2 inside an element that a class or id names as surroundings, 1 when an article begins inside of that.
_ANY = [(w, d, pw, pd, nw, nd) for w, d in ((1, 0.0), (2, 1.0), (7, 0.0), (9, 0.6), (30, 0.0), (90, 0.1))
        for pw, pd, nw, nd in ((0, 0.0, 40, 0.0), (3, 1.0, 2, 1.0), (60, 0.0, 0, 0.0))]
TRAINING = [(*x, article, 1, 0, 0, item, end, 0) for x in _ANY for article, item, end in ((0, 0, 1), (0, 1, 0), (1, 0, 1))]
TRAINING += [(*x, 1, 0, 0, heading, item, end, 1)
             for x in _ANY for heading, item, end in ((0, 0, 1), (0, 0, 0), (1, 0, 0), (0, 1, 0))]
TRAINING += [
    # a header with the site's name, its slogan and links; an article's own header with its heading
    (2, 1.0, 0, 0.0, 5, 0.0, 0, 0, 1, 0, 0, 0, 0), (5, 0.0, 2, 1.0, 1, 1.0, 0, 0, 1, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 1, 1.0, 0, 0, 1, 1, 0, 0, 0), (15, 0.0, 3, 1.0, 1, 1.0, 0, 0, 1, 0, 0, 1, 0),
    (7, 0.0, 3, 1.0, 30, 0.0, 1, 0, 1, 1, 0, 0, 1), (12, 0.0, 7, 0.0, 30, 0.0, 1, 0, 1, 0, 0, 1, 1),
    # sidebars and readers' comments, inside an article element as well
    (3, 0.0, 40, 0.0, 2, 1.0, 1, 1, 0, 1, 0, 0, 0), (2, 1.0, 3, 0.0, 2, 1.0, 1, 1, 0, 0, 1, 0, 0),
    (35, 0.0, 2, 0.0, 40, 0.0, 1, 1, 0, 0, 0, 1, 0), (18, 0.0, 35, 0.0, 0, 0.0, 1, 1, 0, 0, 0, 1, 0),
    # pages without an article element: paragraphs among links
    (50, 0.0, 6, 0.0, 40, 0.0, 0, 0, 0, 0, 0, 1, 1), (35, 0.1, 50, 0.0, 4, 1.0, 0, 0, 0, 0, 0, 1, 1),
    (18, 0.0, 50, 0.0, 22, 0.0, 0, 0, 0, 0, 0, 1, 1), (13, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0, 1, 1),
    (6, 0.0, 1, 1.0, 45, 0.0, 0, 0, 0, 1, 0, 0, 1), (4, 0.0, 50, 0.0, 30, 0.0, 0, 0, 0, 1, 0, 0, 1),
    (4, 0.0, 50, 0.0, 35, 0.0, 0, 0, 0, 0, 0, 1, 1), (3, 0.0, 20, 0.0, 25, 0.0, 0, 0, 0, 0, 0, 1, 1),
    (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0, 0, 0), (2, 1.0, 3, 1.0, 50, 0.0, 0, 0, 0, 0, 0, 0, 0),
    (5, 0.8, 40, 0.0, 3, 1.0, 0, 0, 0, 0, 1, 0, 0), (8, 1.0, 2, 1.0, 7, 1.0, 0, 0, 0, 0, 1, 0, 0),
    (20, 0.9, 8, 1.0, 7, 1.0, 0, 0, 0, 0, 0, 0, 0), (12, 0.6, 4, 1.0, 4, 1.0, 0, 0, 0, 0, 0, 0, 0),
    (2, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0, 0, 0), (3, 0.0, 4, 1.0, 2, 1.0, 0, 0, 0, 0, 1, 0, 0),
    (10, 0.0, 40, 0.0, 30, 0.0, 0, 0, 0, 0, 1, 0, 1), (7, 0.0, 10, 0.0, 9, 0.0, 0, 0, 0, 0, 1, 0, 1),
]


TRAINING = [(*row[:-1], 0, row[-1]) for row in TRAINING]
# named as surroundings: only long plain text outside of an article is text; an article inside has its long blocks
# and what stands next to them
TRAINING += [(*x, article, 0, 0, heading, item, end, 2, int(x[0] >= 60 and not article)) for x in _ANY
             for article, heading, item, end in ((0, 0, 0, 1), (0, 0, 0, 0), (0, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 1), (1, 0, 0, 0))]
TRAINING += [(*x, 1, 0, 0, heading, item, end, 1, int(x[1] < 0.5 and (x[0] >= 20 or max(x[2], x[4]) >= 20))) for x in _ANY
             for heading, item, end in ((0, 0, 1), (0, 0, 0), (1, 0, 0), (0, 1, 0))]
# classes with has-, no-, with- say nothing about their own element ("content with-sidebar", "post tag-news",
# "entry-content no-sidebar", "post-content has-comments"): an article's blocks with no surroundings
TRAINING += [(9, 0.0, 6, 0.0, 25, 0.0, 1, 0, 0, 0, 0, 1, 0, 1), (25, 0.0, 9, 0.0, 3, 1.0, 1, 0, 0, 0, 0, 1, 0, 1),
             (4, 0.0, 0, 0.0, 9, 0.0, 1, 0, 0, 1, 0, 0, 0, 1), (6, 0.2, 25, 0.0, 0, 0.0, 1, 0, 0, 0, 1, 0, 0, 1)]


def grow(rows: np.ndarray, depth: int = 8) -> tuple | int:
    """Decision tree by Gini impurity: a label, or (feature, cut, tree below the cut, tree from it on)."""
    y = rows[:, -1]
    if depth == 0 or (y == y[0]).all():
        return int(2 * y.sum() >= len(y))
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, f] < cut
            cost = sum(2 * p.mean() * (1 - p.mean()) * len(p) for p in (y[left], y[~left]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(cut))
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, f, cut = best
    left = rows[:, f] < cut
    return f, cut, grow(rows[left], depth - 1), grow(rows[~left], depth - 1)


def decide(tree: tuple | int, x: list[float]) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
    return tree


class Page:
    """The flat blocks of a page: text, linked words, and marks of where each stands.

    One pass, in time that grows with the page: marks and names of the open elements are counted, and what ends a
    tag is looked for once. When the quotes of a tag do not pair up to the end of the page, that tag and later
    ones end at their first `>`.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, int, frozenset]] = []
        self.open: list[tuple[str, set]] = []  # open elements with the marks they set
        self.names: Counter[str] = Counter()  # how many open elements have a name, or set a mark
        self.counts: Counter[str] = Counter()
        self.turns: list[str] = []  # of open elements: whether surroundings begin, or an article within
        self.known: frozenset | None = None  # marks of the place, while no element begins or ends
        self.parts: list[str] = []
        self.linked = 0
        self.forms = 0
        at, tags_end, tag_of = 0, source.rfind(">"), _TAG
        while at < len(source):
            begin = _OPEN.search(source, at)
            stop = begin.start() if begin else len(source)
            if begin and stop > tags_end and not source.startswith("<!--", stop):
                stop, begin = len(source), None  # nothing ends a tag any more
            if stop > at:
                self.text(source[at:stop])
            if not begin:
                break
            if source[stop + 1] in "!?":
                at = _NO_TAG.match(source, stop).end()
                continue
            tag = tag_of.match(source, stop)
            if not tag:
                tag_of = _BROKEN
                tag = tag_of.match(source, stop)
            at = tag.end()
            name, attributes = tag[2].lower(), tag[3]
            if tag[1]:
                self.end(name)
            else:
                self.begin(name, attributes)
                if name in RAW and not attributes.endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = close.end() if close else len(source)
                    self.end(name)
        self.flush()
        written = {m for _, n, linked, marks in self.blocks if n - linked >= FORM_WORDS for m in marks if m.startswith("form ")}
        self.blocks = [b for b in self.blocks if all(m in written for m in b[3] if m.startswith("form "))]

    def marks(self) -> frozenset:
        if self.known is None:
            marks = {m for m, n in self.counts.items() if n}
            # what is named as surroundings inside an article that began in such an element is so again
            self.known = frozenset(marks - {"begins"} if self.turns and self.turns[-1] == "around" else marks)
        return self.known

    def push(self, name: str, marks: set) -> None:
        self.open.append((name, marks))
        self.names[name] += 1
        if marks:
            self.counts.update(marks)
            self.known = None
            if marks & {"around", "begins"}:
                self.turns.append("around" if "around" in marks else "begins")

    def pop(self) -> str:
        name, marks = self.open.pop()
        self.names[name] -= 1
        if marks:
            for m in marks:
                self.counts[m] -= 1
                if not self.counts[m]:
                    del self.counts[m]
            self.known = None
            if marks & {"around", "begins"}:
                self.turns.pop()
        return name

    def text(self, raw: str) -> None:
        if self.open and self.open[-1][0] == "head" and raw.strip():
            self.pop()
        marks = self.marks()
        if "silent" in marks:
            return
        plain = html.unescape(raw)
        self.parts.append(plain)
        if "link" in marks:
            self.linked += len(plain.split())

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, len(text.split()), self.linked, self.marks()))
        self.parts, self.linked = [], 0

    def begin(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if self.open and self.open[-1][0] == "head" and name not in IN_HEAD:
            self.pop()
        while self.open and name in ENDS.get(self.open[-1][0], ()):
            self.flush()
            self.pop()
        if name not in INLINE and "silent" not in self.marks():
            self.flush()
        if name in VOID or attributes.endswith("/"):
            return
        marks = set()
        if name in SILENT:
            marks.add("silent")
        if name == "form" and not self.names["form"]:
            self.forms += 1
            marks.add(f"form {self.forms}")
        if name in ("label", "legend") and self.names["form"]:
            marks.add("silent")
        if name == "a":
            marks.add("link")
        if name in _CHROME:
            marks.add("chrome")
        if name in ("article", "main"):
            marks.add("article")
        if name == "header":
            marks.add("header")
        if name in _HEADINGS:
            marks.add("heading")
        if name in ("li", "dd", "dt"):
            marks.add("item")
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
                marks.add("silent")
            elif key in ("class", "id", "role") and name not in INLINE and name not in ("html", "body"):
                value = BESIDE.sub("", value)
                body = name in ("article", "main")
                if IS_REPLIES.search(value) or not body and IS_AROUND.search(value) and not any(
                        INSIDE.search(x) and not IS_AROUND.search(x) for x in value.split()):
                    marks |= {"named", "chrome"}
                elif AROUND.search(value) and not any(map(_STORY.search, value.split())):
                    marks.add("named")
                    if not body:
                        marks.add("chrome" if key == "role" else "around")
                elif INSIDE.search(value):
                    marks.add("article")
        if "article" in marks and not marks & {"named", "chrome"} and "around" in self.marks():
            marks.add("begins")
        self.push(name, marks)

    def end(self, name: str) -> None:
        if not self.names[name]:
            return
        if name not in INLINE and "silent" not in self.marks():
            self.flush()
        while self.open:
            top = self.open[-1][0]
            if top != name and top not in INLINE and "silent" not in self.marks():
                self.flush()
            self.pop()
            if top == name:
                break

    def features(self) -> Iterator[tuple[str, list[float]]]:
        none = ("", 0, 0, frozenset())
        for before, own, after in zip([none, *self.blocks], self.blocks, [*self.blocks[1:], none]):
            density = [b[2] / b[1] if b[1] else 0.0 for b in (own, before, after)]
            marks = own[3]
            yield own[0], [own[1], density[0], before[1], density[1], after[1], density[2], "article" in marks,
                           "chrome" in marks, "header" in marks, "heading" in marks, "item" in marks,
                           own[0].rstrip("\"')”»").endswith((".", "!", "?", ":", "…")),
                           2 - ("begins" in marks) if "around" in marks else 0]


_TREE: list = []


def main_text(source: str) -> str:
    """Blocks that the tree takes for main text, in page order, one line each."""
    if not _TREE:
        _TREE.append(grow(np.array(TRAINING, dtype=float)))
    return "\n".join(t for t, x in Page(source).features() if decide(_TREE[0], x))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    A null html is empty; a page without main text has an empty text. Markup that is cut off or never closed is
    read as far as it goes. Repeated rows come out as often as they occur; null ids and urls stay null. No pages
    give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "html"):
                texts = [main_text(h or "") for h in part.column("html").to_pylist()]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                      names=["page_id", "url", "text"])

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        pages["html"].alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
