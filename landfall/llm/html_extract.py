"""Operator 6, main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each on the tag path from the root
to its block element (tags with their class and id; inline tags are left out).
Per path, the text length and punctuation of its blocks are summed into ratios
per block; the ratios are smoothed over neighbouring blocks, fused to one number
per path, and thresholded by their spread. The paths above it mark the content;
the deepest container that holds most of it (or the article element around
that) gives the bounds of the article, inside which its headings, short
paragraphs and lists also belong to it: a heading even if it is a link (to its
own place on the page, or with text of the article below it), a list of links if
a heading or a line that ends in a colon stands right above it in the same box.

Paths through page furniture (navigation, footers, asides, forms, scripts, and
boxes whose class or id names menus, adverts, notices, comments ...) are no
content. A box that is named so but holds the article element, or half the text
of the article element around it (of the page, where there is none), is not
believed. A name is a whole class or id. Names that are only a part of one
(``related-work``), that also name topics (``discussion``), or that are ids
inside an article, are believed of a box inside the article (or anywhere, where
there is none) only if half its text is in links or its ratio is low. Names of
reader comments (``reader-comments``: all its parts are words of such boxes) are
believed however much they hold, unless the article has no other text. Headings
are never furniture by name, paragraphs and the like not inside an article.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by two line breaks in page order.

Defined cases: null or empty html, or a page without text, gives an empty text;
null and repeated ids and urls are passed on; unclosed and misnested tags and
unclosed comments or scripts are read as far as the page goes, a tag whose
quoted value never closes as far as the next ``>`` after its quote (quoted
values may be of any length); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import slices, table

BATCH_BYTES = 4 << 20

# A quoted value begins after "=" only, and ends at the next such quote, however far.
_TAG = r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+|(?=>)))*+)"""
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*+>?|<!(?=[a-zA-Z])[^>]*+>?
    |""" + _TAG + "()>", re.S | re.X)
_LOOSE = re.compile(_TAG + "([^>]*+)>?")  # without a closing quote in the rest of the page, or without an end
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed")}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
           "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_TEXTUAL = _HEADINGS | {"p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", "caption", "summary"}
_NEVER = {"nav", "footer", "aside", "form", "button", "select", "option", "label", "fieldset", "dialog", "menu", "noscript",
          "template", "head", "svg", "canvas", "object", "audio", "video", "datalist"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog",
          "alertdialog", "alert", "status", "note"}
_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsors", "sponsored",
          "promo", "promos", "promotion", "banner", "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs",
          "sidebar", "sidebars", "rail", "aside", "footer", "foot", "header", "masthead", "topbar", "comment", "comments",
          "commentlist", "disqus", "reply", "replies", "respond", "discussion", "cookie", "cookies", "consent", "gdpr", "notice",
          "notices", "alert", "alerts", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
          "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "widgets", "toolbar",
          "pagination", "pager", "skip", "copyright", "search", "disclaimer"}
_TOPICS = {"promotion", "advertising", "banner", "navigation", "menu", "menus", "rail", "foot", "header", "reply", "replies",
           "respond", "discussion", "notice", "notices", "alert", "alerts", "overlay", "subscribe", "subscription", "social",
           "related", "skip", "search", "disclaimer"}   # of _NAMES, those that an article's own part may have
_COMMENT = re.compile(r"(?:comments?|repl(?:y|ies))(?:[-_]?(?:item|body|content|text|\d+))?", re.I)
_COMMENTS = {"comment", "comments", "commentlist", "commentary", "replies", "disqus"}
_OF_COMMENTS = _COMMENTS | {"reader", "readers", "user", "users", "visitor", "visitors", "list", "section", "area", "thread", "threads",
                            "wrapper", "wrap", "container", "box", "item", "items", "block", "post", "page", "article", "entry", "body",
                            "content", "reply", "view", "feed", "main", "blog", "story", "node", "group", "panel", "inner", "outer",
                            "holder", "tree", "children", "facebook", "wp", "all", "more", "latest", "text"}
_OWN_HEADER = {"entry", "post", "article", "content", "story", "title"}
_SENTENCES = _HEADINGS | {"p", "pre", "blockquote", "figcaption", "caption", "summary"}
_P_ENDS = {"p"}
_IMPLIED = {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"},
            "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}}
_PUNCTUATION = re.compile(r"[.,;:!?…，。、；：！？]")
_MAJORITY = 0.5   # of the text of the article or page: a box that holds so much is content, whatever its name
_ALONE = 80       # characters of an article beside its comments, below which the comments are the text
_LOW = 0.5        # of the ratio of the article or page: a box below it is furniture if its name says so
_MOST = 0.7       # of the content: the container that holds so much is the article's
_SMOOTH = (0.25, 0.5, 0.25)


class Page:
    """Paths and text blocks of one page."""

    def __init__(self, source: str):
        self.parent, self.tag, self.kind = [-1], ["#root"], [0]   # kind 0: none, 1: perhaps furniture, 2: furniture by name, 3: never content
        self.paths: dict = {}
        self.blocks: list = []       # (path, text, characters in links, article)
        self.own_place: list = []    # of each block, characters in links to a place on the page
        self.comments = [False]      # paths of reader comments by name
        self._parts: list[str] = []
        self._in_links = self._in_own_place = 0
        self._stack = [("#root", 0, 0)]
        self._open: dict[str, int] = {}
        self._links = self._articles = 0
        self._read(source)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                _, path, article = self._stack[-1]
                self.blocks.append((path, text, min(self._in_links, len(text)), article))
                self.own_place.append(min(self._in_own_place, len(text)))
            self._parts, self._in_links, self._in_own_place = [], 0, 0

    def _text(self, raw: str) -> None:
        if raw:
            self._parts.append(raw)
            if self._links:
                self._in_links += len(raw.strip())
                if self._links == 2:
                    self._in_own_place += len(raw.strip())

    def _pop(self) -> None:
        name = self._stack.pop()[0]
        self._open[name] -= 1

    def _push(self, name: str, attributes: str) -> None:
        path, article = self._stack[-1][1:]
        kind, sign, comments = (3 if name in _NEVER else 0), name, False
        inside = bool(article or self._open.get("main") or name in ("article", "main"))
        if name == "header" and not self._open.get("article") and not self._open.get("main"):
            kind = 2
        if attributes:
            given = _given(attributes)
            names = f"{given.get('class', '')} {given.get('id', '')}".strip()
            sign = f"{name} {names}"
            if _hidden(given):
                kind, sign = 3, sign + " #hidden"
            elif name not in ("html", "body", "article", "main") or any(map(_COMMENT.fullmatch, names.split())):
                role = given.get("role", "").lower()
                if role in _ROLES:
                    kind, sign = max(kind, 2), f"{sign} #{role}"
                elif name in ("article", "main"):
                    kind = max(kind, 2)
                elif name not in (_SENTENCES if inside else _HEADINGS):
                    kind = max(kind, _named(given, inside, name in _SENTENCES))
                    if name not in _TEXTUAL and _comment_box(given):
                        kind, comments = max(kind, 2), True
        key = (path, sign)
        number = self.paths.get(key)
        if number is None:
            number = self.paths[key] = len(self.parent)
            self.parent.append(path)
            self.tag.append(name)
            self.kind.append(kind)
            self.comments.append(comments)
        if name == "article":
            self._articles += 1
            article = self._articles
        self._stack.append((name, number, article))
        self._open[name] = self._open.get(name, 0) + 1

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            begin = source.find("<", at)
            if begin < 0:
                self._text(source[at:])
                break
            self._text(source[at:begin])
            m = _TOKEN.match(source, begin) or _LOOSE.match(source, begin)
            if m is None:
                self._text("<")
                at = begin + 1
                continue
            at = m.end()
            if m.group(2) is None:
                continue
            close, name, attributes = m.group(1), m.group(2).lower(), m.group(3) + m.group(4)
            if name == "a":
                self._links = 0 if close else 2 if _given(attributes).get("href", "").startswith("#") else 1
                continue
            if name == "br":
                self._parts.append(" ")
                continue
            if name in _VOID:
                if name == "hr":
                    self._flush()
                continue
            if name in _INLINE and not (name == "span" and (attributes or close)):
                continue
            if close:
                if self._open.get(name):
                    if name != "span" or self._stack[-1][0] == "span":
                        self._flush_if(name)
                        while self._stack[-1][0] != name:
                            self._pop()
                        self._pop()
                continue
            if name in _RAW and not attributes.rstrip().endswith("/"):
                end = _RAW[name].search(source, at)
                at = end.start() if end else size
                if end:
                    at = source.find(">", at) + 1 or size
                continue
            if name == "span":
                given = _given(attributes)
                sentence = self._stack[-1][0] in _TEXTUAL or self._stack[-1][0] == "span"
                if not _hidden(given) and (sentence or not _named(given, True, True)):
                    self._stack.append(("span", *self._stack[-1][1:]))
                    self._open["span"] = self._open.get("span", 0) + 1
                    continue
            self._flush()
            ends = _IMPLIED.get(name, _P_ENDS)
            while self._stack[-1][0] in ends or (self._stack[-1][0] == "span" and self._open.get("p")):
                self._pop()
            if attributes.rstrip().endswith("/") and name in ("svg", "path", "use"):
                continue
            self._push(name, attributes)
        self._flush()

    def _flush_if(self, name: str) -> None:
        """A span that shares its parent's path does not end a block."""
        if name != "span" or self._stack[-1][1] != self._stack[-2][1]:
            self._flush()


def _given(attributes: str) -> dict[str, str]:
    given: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        given.setdefault(key.lower(), value.strip("\"'"))
    return given


def _hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(given.get("style", "")))


def _named(given: dict[str, str], inside: bool, whole: bool) -> int:
    """2 if a class or id is a name of furniture, 1 if it may be (not with ``whole``), else 0."""
    kind = 0
    for key in ("class", "id"):
        for token in given.get(key, "").split():
            name = token.lower()
            if name in _NAMES and not (inside and (key == "id" or name in _TOPICS)) and name not in ("discussion", "related"):
                return 2
            if not whole:
                parts = {p.lower() for p in _NAME_PARTS.findall(token)} & _NAMES
                if parts == {"header"} and (inside or _OWN_HEADER & {p.lower() for p in _NAME_PARTS.findall(token)}):
                    continue
                kind = max(kind, bool(parts))
    return kind


def _comment_box(given: dict[str, str]) -> bool:
    """Whether a class or id names a box of reader comments and nothing else."""
    for token in f"{given.get('class', '')} {given.get('id', '')}".split():
        parts = {p.lower() for p in _NAME_PARTS.findall(token)}
        if parts & _COMMENTS and parts <= _OF_COMMENTS and parts != {"commentary"}:
            return True
    return False


def main_text(source: "str | None") -> str:
    """The blocks of the article of one page, joined by two line breaks."""
    page = Page(source or "")
    if not page.blocks:
        return ""
    parent, tag, kind = page.parent, page.tag, page.kind
    n = len(parent)
    # Furniture, inherited along the path (a path's number is above its parent's).
    under, links_under, blocks_under, marks_under = [0.0] * n, [0] * n, [0] * n, [0] * n
    hard = [False] * n
    for p in range(1, n):
        hard[p] = kind[p] == 3 or hard[parent[p]]
    for path, text, links, _ in page.blocks:
        if not hard[path]:
            under[path] += len(text) - links
            links_under[path] += links
            blocks_under[path] += 1
            marks_under[path] += len(_PUNCTUATION.findall(text))
    for p in range(n - 1, 0, -1):
        for sums in (under, links_under, blocks_under, marks_under):
            sums[parent[p]] += sums[p]
    articles = [tag[p] in ("article", "main") and not kind[p] and not hard[p] and under[p] > 0 for p in range(n)]
    scope = [0] * n   # the article around a path
    for p in range(1, n):
        scope[p] = p if articles[p] else scope[parent[p]]

    def ratio(p: int) -> float:
        return under[p] / blocks_under[p] * (1 + marks_under[p] / blocks_under[p])

    def furniture(p: int) -> bool:
        """Whether a named box is believed to be furniture."""
        if page.comments[p] and (scope[p] or not holds[p]):
            return under[scope[p]] - under[p] >= _ALONE
        if holds[0] and not scope[p]:
            return not holds[p]
        if kind[p] == 2:
            return under[p] < _MAJORITY * under[scope[p]]
        return not blocks_under[p] or links_under[p] >= under[p] or ratio(p) < _LOW * ratio(scope[p])

    holds = articles[:]
    for p in range(n - 1, 0, -1):
        holds[parent[p]] |= holds[p]
    out = hard[:]
    for p in range(1, n):
        out[p] = out[p] or out[parent[p]] or (kind[p] in (1, 2) and furniture(p))
    own_place = [a for a, b in zip(page.own_place, page.blocks) if not out[b[0]]]
    blocks = [b for b in page.blocks if not out[b[0]]]
    if not blocks:
        return ""
    # Ratios of every path: text outside links and punctuation per block.
    count, length, marks, linked = [0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for path, text, links, _ in blocks:
        count[path] += 1
        length[path] += len(text) - links
        linked[path] += links
        marks[path] += len(_PUNCTUATION.findall(text))
    rows = [(length[b[0]] / count[b[0]], marks[b[0]] / count[b[0]]) for b in blocks]
    smooth = [(0.0, 0.0)] * n
    total: dict[int, list[float]] = {}
    for i, b in enumerate(blocks):
        near = [rows[max(0, i - 1)], rows[i], rows[min(len(rows) - 1, i + 1)]]
        own = total.setdefault(b[0], [0.0, 0.0])
        for j in (0, 1):
            own[j] += sum(w * r[j] for w, r in zip(_SMOOTH, near))
    fused = {p: (t / count[p]) * (1 + m / count[p]) for p, (t, m) in total.items()}
    every = [fused[b[0]] for b in blocks]
    mean = sum(every) / len(every)
    limit = min((sum((x - mean) ** 2 for x in every) / len(every)) ** 0.5, max(every))
    content = {p for p, f in fused.items() if f >= limit and 2 * linked[p] <= length[p] + linked[p]}
    if not content:
        content = {p for p, f in fused.items() if f == max(every)}
    # The container of the article.
    mass = [0.0] * n
    of_article: dict[int, float] = {}
    for path, text, links, article in blocks:
        if path in content:
            mass[path] += len(text) - links
            of_article[article] = of_article.get(article, 0) + len(text) - links
    own = mass[:]
    children: dict[int, list[int]] = {}
    for p in range(n - 1, 0, -1):
        mass[parent[p]] += mass[p]
        children.setdefault(parent[p], []).append(p)
    box = 0
    while True:
        best = max((c for c in children.get(box, ()) if children.get(c) and not out[c]), key=mass.__getitem__, default=None)
        if best is None or mass[best] < _MOST * mass[box] or mass[best] == own[best] > 0:
            break
        box = best
    around = box
    while around > 0 and tag[around] not in ("article", "main"):
        around = parent[around]
    if around > 0:
        while parent[around] > 0 and tag[parent[around]] == "article":
            around = parent[around]
        box = around
    article = max(of_article, key=of_article.get)
    alone = article and of_article[article] >= 0.6 * sum(of_article.values())
    inside = [False] * n
    for p in range(n):
        inside[p] = p == box or (p > 0 and inside[parent[p]])

    def belongs(i: int, path: int, text: str, links: int, in_article: int) -> bool:
        if not inside[path] or (alone and in_article != article):
            return False
        if path in content:
            return True
        if tag[path] in _HEADINGS and 2 * links > len(text):
            below = blocks[i + 1] if i + 1 < len(blocks) else None
            return 2 * (links - own_place[i]) <= len(text) or (
                below is not None and below[0] in content and parent[below[0]] == parent[path])
        return 2 * links <= len(text) and (tag[path] in _TEXTUAL or path == box or tag[box] in ("article", "main"))

    taken = [belongs(i, *b) for i, b in enumerate(blocks)]
    if not any(taken):
        return ""
    # A list of links belongs to the heading or the line with a colon right above it.
    head = None   # the box that holds the list, if the block above introduces one
    for i, (path, words, links, in_article) in enumerate(blocks):
        if taken[i]:
            introduces = tag[path] in _HEADINGS or words.endswith((":", "："))
            head = parent[path] if introduces else head if head is not None and _listed(path, head, parent, tag) else None
        elif head is not None and inside[path] and (not alone or in_article == article) and 2 * own_place[i] <= len(words) \
                and _listed(path, head, parent, tag):
            taken[i] = True
        else:
            head = None
    first = taken.index(True)
    text = []
    for i, (path, words, _, _) in enumerate(blocks):
        title = tag[path] == "h1" and i < first and not any(tag[b[0]] == "h1" for b, t in zip(blocks, taken) if t)
        if taken[i] or title:
            text.append(words)
    return "\n\n".join(text)


def _listed(path: int, box: int, parent: list, tag: list) -> bool:
    """Whether a path is an item of a list that stands in ``box`` itself."""
    if tag[path] not in ("li", "dd", "dt"):
        while path > 0 and tag[path] in _TEXTUAL and tag[path] not in ("li", "dd", "dt"):
            path = parent[path]
    while path > 0 and tag[path] in ("li", "dd", "dt", "ul", "ol", "dl"):
        path = parent[path]
        if path == box:
            return True
    return False


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", BATCH_BYTES):
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    return pages.mapInArrow(_extract_batches, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))
