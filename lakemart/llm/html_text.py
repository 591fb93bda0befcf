"""Main text of HTML pages by tree scoring.

A tolerant reader builds the element tree and its text blocks. Each block passes points for its
length and its commas to its container and, fewer with each step, to the elements around it; a
container's points are discounted by the share of its text that is in links. The best container is
kept with those siblings that score or read like article text.

Always left out: scripts, styles, form controls, navigation, page headers and footers, asides, and what is hidden
(``hidden``, ``display: none``). A class or id
that says menu, advert, notice, comments and the like, or a form, lowers the points of the element and of what is in
it, the more the less of the page's text it has; it is left out unless the best container or the best
article is in it, and a form also if it has neither an article nor two paragraphs that read. What stands between
kept siblings of the best container is kept unless it is links for the most part. Inside the kept part, what is links for the most part is left out if it stands as navigation
does: before the first text that reads, or boxes of bare links (no list, no heading) after the last.
Nothing else is dropped or cut.

A block is the text between the starts and ends of block elements: character references decoded,
white space (also ``br``) one space, trimmed; blocks are joined by an empty line, in page order.

Cases: null, empty and textless pages give an empty text; unclosed, stray and cut tags are tolerated;
equal rows are judged one by one; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa

from pyspark.sql import DataFrame

from lakemart.llm import common as C

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?""")
_PART = re.compile(r"[a-z]+")
_HIDES = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
            "summary table tbody td tfoot th thead tr ul".split())
DROP = set("script style noscript template svg math iframe object embed applet nav footer aside button select textarea "
           "input label fieldset datalist output progress meter menu dialog head title canvas audio video".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
             "tfoot": {"tr", "td", "th", "thead", "tbody"}}
WALL = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE = {"table", "td", "th", "caption", "button", "object", "template"}

HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = {"ul", "ol", "dl", "pre", "table"}

# Words of class and id names that say what an element is.
NOT_TEXT = set("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
               "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay "
               "pager pagination popup promo promoted recommended related reply replies respond share sharing sidebar "
               "signup skip social sponsor sponsored subscribe toolbar topbar widget".split())
TEXT = set("article blog body column content entry hentry main page post story text".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar"}


class Page:
    """Elements (tag, parent, bonus, dropped, nearest with an unlikely name) and text blocks (element, pieces of text with
    that name's element and whether in links) of a page."""

    def __init__(self, source: str):
        self.tag, self.up, self.bonus, self.drop, self.named = ["#page"], [-1], [0.0], [False], [0]
        self.blocks: list[tuple[int, list[tuple[int, str, bool]]]] = []
        self._read(source)

    def _open(self, tag, attrs, parent):
        named = tag == "form"
        bonus, drop = (25.0, False) if tag in ("article", "main") else (0.0, tag in DROP)
        if attrs:
            read = {}  # each attribute whole, so no name is found in a value; the first of a name holds
            for key, a, b, c in _ATTR.findall(attrs):
                read.setdefault(key.lower(), a or b or c)
            for key in read.keys() & {"class", "id", "role", "hidden", "style"}:
                value = read[key].lower()
                if key == "hidden":
                    drop = True
                elif key == "style":
                    drop = drop or _HIDES.search(value) is not None
                elif key == "role":
                    drop = drop or value in ROLES
                    bonus += 25 * (value in ("main", "article"))
                elif tag not in ("html", "body", "main", "article"):
                    words = set(_PART.findall(value))
                    named = named or not words.isdisjoint(NOT_TEXT)
                    bonus += 25 * (not words.isdisjoint(TEXT))
        if tag == "header":  # a page's header; an article's own holds its title
            k = parent
            while k > 0 and self.tag[k] not in ("article", "main"):
                k = self.up[k]
            drop = drop or k <= 0
        self.tag.append(tag)
        self.up.append(parent)
        self.bonus.append(bonus)
        self.drop.append(drop or self.drop[parent])
        self.named.append(len(self.tag) - 1 if named else 0 if tag == "main" else self.named[parent])  # a page has one main
        return len(self.tag) - 1

    def _read(self, source):
        stack, links, at = [0], 0, 0
        text: list[tuple[int, str, bool]] = []

        def end_block():
            if text:
                if not self.drop[holder()]:
                    self.blocks.append((holder(), text.copy()))
                text.clear()

        def holder():
            for k in reversed(stack):
                if self.tag[k] in BLOCK or not k:
                    return k
            return 0

        def pop_to(i):
            nonlocal links
            for k in stack[i:]:
                links -= self.tag[k] == "a"
            del stack[i:]

        def say(raw):
            if raw and not self.drop[stack[-1]]:
                raw = html.unescape(raw) if "&" in raw else raw
                text.append((self.named[stack[-1]], raw, links > 0))

        n = len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                say(source[at:])
                break
            say(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, closing, attrs = name.lower(), m[1] or m[4], m[3] if m[2] else m[6]
            if tag == "br":
                say(" ")
                continue
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    t = self.tag[stack[i]]
                    if t == tag:
                        if tag in BLOCK:
                            end_block()
                        pop_to(i)
                        break
                    if t in TABLE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                        break
                continue
            if tag in BLOCK:
                end_block()
                self._imply(tag, stack, pop_to)
            elif tag == "a" and links:  # links do not nest
                i = max((i for i, k in enumerate(stack) if self.tag[k] == "a"), default=0)
                if i and not any(self.tag[k] in BLOCK for k in stack[i:]):
                    pop_to(i)
            node = self._open(tag, attrs, stack[-1])
            if tag in VOID or attrs.endswith("/") and tag in ("path", "circle", "rect", "line", "use"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else n
                continue
            stack.append(node)
            links += tag == "a"
        end_block()

    def _imply(self, tag, stack, pop_to):
        """Close what a start tag closes: an open paragraph, or the item, cell or row before."""
        for i in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[i]]
            if t == "p":
                pop_to(i)
                break
            if t in TABLE or t in BLOCK and t not in ("p",):
                break
        shuts, wall = CLOSED_BY.get(tag), WALL.get(tag, {"table"})
        if shuts:
            low = None
            for i in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[i]]
                if t in wall:
                    break
                if t in shuts:
                    low = i
                    if tag in ("li", "dt", "dd", "td", "th", "option"):
                        break
            if low:
                pop_to(low)


def _points(text: str) -> float:
    return 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) // 100, 3)


def _joined(pieces) -> str:
    return " ".join("".join(pieces).split())


def _without_forms(page: Page) -> None:
    """Drop forms that are no frame of text: without an article, and with fewer than two paragraphs that read."""
    if "form" not in page.tag:
        return
    form = [0] * len(page.tag)   # the outermost form that an element is in
    for k in range(1, len(page.tag)):
        form[k] = form[page.up[k]] or (k if page.tag[k] == "form" else 0)
    reads = [0] * len(page.tag)
    for k, tag in enumerate(page.tag):
        reads[form[k]] += 2 * (tag in ("article", "main"))
    for node, pieces in page.blocks:
        text = _joined(raw for _, raw, _ in pieces)
        reads[form[node]] += len(text) >= 25 and 2 * len(_joined(raw for _, raw, linked in pieces if linked)) < len(text)
    for k in range(1, len(page.tag)):
        page.drop[k] = page.drop[k] or form[k] > 0 and reads[form[k]] < 2
    page.blocks = [b for b in page.blocks if not page.drop[b[0]]]


def main_text(source: str | None) -> str:
    """The page's main text (see the module's text)."""
    if not source:
        return ""
    page = Page(source)
    _without_forms(page)
    n = len(page.tag)
    score, size, link, whole = [0.0] * n, [0] * n, [0] * n, [0] * n
    blocks = []  # as they stand, without what has an unlikely name inside them
    for node, pieces in page.blocks:
        own = [(raw, linked) for name, raw, linked in pieces if name == page.named[node]]
        blocks.append((node, _joined(raw for raw, _ in own), len(_joined(raw for raw, linked in own if linked))))
        whole[node] += len(_joined(raw for _, raw, _ in pieces))
    for k in range(n - 1, 0, -1):
        whole[page.up[k]] += whole[k]
    if not whole[0]:
        return ""
    for node, text, linked in blocks:
        k, out = node, page.named[node]  # an unlikely name's text counts for what is in that element only
        while k >= 0 and text:
            size[k] += len(text)
            link[k] += linked
            k = -1 if k and k == out else page.up[k]
        if len(text) >= 25 and 2 * linked < len(text):
            points = _points(text) * (1 - linked / len(text))
            k, step = page.up[node] if page.tag[node] in ("p", "pre", "h1", "h2", "h3", "h4", "h5", "h6") else node, 0
            if out and page.up[out] == k:  # the paragraph itself has the name
                k = node
            while k >= 0:
                score[k] += points / (1, 2)[step] if step < 2 else points / (3 * step)
                k, step = -1 if k and k == out else page.up[k], step + 1
    total = [0.0] * n
    for k in range(n):
        if size[k] and not page.drop[k]:
            total[k] = (score[k] + page.bonus[k]) * (1 - link[k] / size[k])
            out = page.named[k]
            while out:
                total[k] = total[k] / 5 - 10 * (1 - whole[out] / whole[0])
                out = page.named[page.up[out]]
    paragraphs = {"p", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "a"}
    best = max((k for k in range(n) if size[k] and page.tag[k] not in paragraphs), key=lambda k: (total[k], -k), default=0)
    k = best  # text in a part of an article belongs to the whole of it
    while k > 0:
        if page.tag[k] in ("article", "main") and total[k] > 0:
            best = k
            if page.tag[k] == "article":
                break
        k = page.up[k]
    articles = [k for k in range(n) if page.tag[k] in ("article", "main") and size[k]]
    spared = {0}  # what holds the best container and the best article
    for k in (best, max(articles, key=lambda k: (total[k], -k), default=0)):
        while k > 0:
            spared.add(k)
            k = page.up[k]
    out = [False] * n  # has, or is in, what has an unlikely name and is not spared
    for k in range(1, n):
        out[k] = out[page.up[k]] or page.named[k] == k and k not in spared
    kept = [False] * n
    longest: dict[int, str] = {}
    for node, text, _ in blocks:
        if len(text) > len(longest.get(node, "")):
            longest[node] = text
    least = total[best] / 5
    for k in range(n):
        if k == best:
            kept[k] = True
        elif page.up[k] == page.up[best] and best and not page.drop[k] and not out[k] and size[k]:
            dense = link[k] / size[k]
            reads = page.tag[k] == "p" and (size[k] > 80 and dense < 0.25 or not link[k] and longest.get(k, "").endswith((".", "!", "?")))
            kept[k] = reads or page.tag[k] not in paragraphs and total[k] >= least and total[k] > 0
    ahead = False  # a heading belongs to what follows it, other text to what stands around it
    beside = [k for k in range(1, n) if best and page.up[k] == page.up[best] and not out[k] and size[k]]
    for k in reversed(beside):
        if page.tag[k] in HEADINGS and 2 * link[k] < size[k]:
            kept[k] = ahead
        ahead = kept[k] or page.tag[k] in LISTS and ahead
    within = [i for i, k in enumerate(beside) if kept[k]]
    for k in beside[within[0]:within[-1]] if within else ():
        kept[k] = kept[k] or 5 * link[k] <= 3 * size[k] and not page.drop[k]
    for k in range(1, n):
        kept[k] = kept[k] or kept[page.up[k]]
    first, last, titled = [len(blocks)] * n, [-1] * n, [False] * n
    reads = [len(blocks), -1]
    for i, (node, text, linked) in enumerate(blocks):
        if not kept[node] or out[node] or not text:
            continue
        heading = page.tag[node] in HEADINGS
        if 2 * linked < len(text) and not heading:
            reads = [min(reads[0], i), i]
        k = node
        while k >= 0:
            first[k], last[k], titled[k] = min(first[k], i), i, titled[k] or heading or page.tag[k] in LISTS
            k = page.up[k]
    links_only = [False] * n
    for k in range(1, n):
        links_only[k] = links_only[page.up[k]]
        if kept[page.up[k]] and page.tag[k] in ("ul", "ol", "dl", "div", "section", "table") and size[k] and 5 * link[k] > 3 * size[k]:
            led = first[k] > 0 and (page.tag[blocks[first[k] - 1][0]] in HEADINGS or blocks[first[k] - 1][1].endswith(":"))
            links_only[k] = links_only[k] or last[k] < reads[0] or first[k] > reads[1] and not titled[k] and not led
    texts = (_joined(raw for name, raw, _ in pieces if not out[name])
             for node, pieces in page.blocks if kept[node] and not out[node] and not links_only[node])
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars (its code points)."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select(C.column(pages, page_id, "long").alias("i"), C.column(pages, url, "string").alias("u"),
                        C.column(pages, source, "string").alias("h")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
