"""Main text of web pages by scoring the element tree.

Every element with text of its own is a paragraph. It passes points for its length and its commas,
discounted by the share of its text that is link text, to the elements around it: all of them to the
nearest container, half to the next, less further up. The container with the most points after its
own discount is the article. Siblings that score near it, longer plain paragraphs, headings before a
kept part and whatever lies between two kept parts are kept as well. Menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are cut before the points are
counted, by tag, role and the words of class and id; blocks that are nearly all links are cut after.

A page is read in one pass inside a map task, so it costs time and memory in proportion to its own
length, and nothing is shuffled. (The standard library's parser is quadratic in unfinished tags.) Nesting is followed to
``DEEPEST`` levels; elements further in become siblings on that level, with no text lost.

Defined results: null, empty and text-free pages, and pages whose every part is cut, give an empty
string; the first of equally good containers wins; text outside all tags counts as the body's;
references that name no character stay as they are written; a page that breaks off ends its open
elements; ``br`` is white space; repeated rows and null ids are kept as they come.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from mailsift.llm.common import text_slices

DEEPEST = 500
REACH = 6  # containers above a paragraph that get points
FULL, LONG = 25, 100  # characters for the first point, and for each of up to three more
COMMAS = re.compile("[,،、，]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub"
    " sup time tt u var wbr br img".split()
)
START = re.compile(  # quotes count after an equals sign only; nothing is tried twice
    r"""<([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+|=)*+)>"""
)
END = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+""")
TELLING = re.compile("class|id|role|hidden|style", re.I)
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())  # their text holds no tags
LEAF = frozenset("p pre li dt dd blockquote h1 h2 h3 h4 h5 h6 figcaption caption address summary td th".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD = frozenset("head title meta link base style script noscript template".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre search section summary table ul body".split()
)
ENDED_BY = {  # an open element of the value's names ends where the key starts, up to the nearest of BOUNDS
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"},
}
BOUNDS = frozenset("table td th caption html object template".split())
LIST_BOUNDS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
NOTHING, TABLE = frozenset(), frozenset(["table"])
TABLE_PARTS = frozenset("table tr td th thead tbody tfoot caption".split())

CUT_TAGS = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input datalist iframe object embed applet svg canvas"
    " audio video map menu dialog search".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
# Words of a class or id that name a part which is no article.
CUT_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toc footer foot sidebar aside rail widget widgets ad ads adv advert"
    " adverts advertisement advertisements advertising adsense adbox sponsor sponsors sponsored promo promotion promoted banner cookie cookies"
    " consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login signin register paywall"
    " share sharing sharebar social related recommended recommendations trending popular comment comments commentlist disqus respond reply replies"
    " discussion feedback toolbar masthead copyright legal disclaimer skip search outbrain taboola hidden".split()
)
HEADER_WORDS = frozenset("header head topbar".split())  # cut outside of an article only
NOT_CUT = frozenset("html body article main".split())
NEGATIONS = frozenset("with has no without hide is show".split())  # "has-sidebar" is about a layout
GOOD_WORDS = frozenset("article content post entry main body story text blog page hentry prose".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LIKE_LIST = frozenset("ul ol dl div section table tr tbody".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "words", "cut", "chars", "links", "points", "own", "own_links", "commas")

    def __init__(self, tag: str, parent: Node | None, words: list[str], cut: bool) -> None:
        self.tag, self.parent, self.words, self.cut = tag, parent, words, cut
        self.parts: list = []
        self.chars = self.links = self.own = self.own_links = self.commas = 0
        self.points = 0.0

    def density(self) -> float:
        return self.links / self.chars if self.chars else 0.0


def _named_for_cutting(tag: str, words: list[str], in_article: bool) -> bool:
    if tag in NOT_CUT:
        return any(w in ("comment", "comments") for w in words) and tag == "article"
    for i, word in enumerate(words):
        if (word in CUT_WORDS or (word in HEADER_WORDS and not in_article)) and not (i and words[i - 1] in NEGATIONS):
            return True
    return False


class Tree:
    """Elements in page order, with the parts that are no article marked as cut."""

    def __init__(self) -> None:
        self.root = Node("html", None, [], False)
        self.nodes, self.open = [self.root], [self.root]
        self.count = Counter(["html"])  # open elements by name

    def read(self, page: str) -> Tree:
        """One pass over the page; a tag that never ends takes the rest with it, as in a browser."""
        at, size = 0, len(page)
        while at < size:
            less = page.find("<", at)
            less = size if less < 0 else less
            if less > at:
                self.text(page[at:less])
            if less == size:
                break
            follows = page[less + 1 : less + 2]
            if follows.isalpha() and follows.isascii():
                tag = START.match(page, less)
                if tag is None:
                    break
                name, at = tag[1].lower(), tag.end()
                self.start(name, tag[2])
                if name in RAW:
                    end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
                    at = end.start() if end else size
            elif page.startswith("<!--", less):
                if page.startswith((">", "->"), less + 4):
                    at = page.index(">", less) + 1
                else:
                    end = page.find("-->", less + 4)
                    at = size if end < 0 else end + 3
            elif follows in ("!", "?", "/") and follows:
                end = page.find(">", less)
                if end < 0:
                    break
                name, at = END.match(page, less + 2), end + 1
                if follows == "/" and name:
                    self.end(name[0].lower())
            else:
                self.text("<")
                at = less + 1
        return self

    def text(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self._pop(len(self.open) - 1)
        self.open[-1].parts.append(unescape(data) if "&" in data else data)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "html" or tag == "body" and self.count["body"]:
            return
        if self.open[-1].tag == "head" and tag not in HEAD:
            self._pop(len(self.open) - 1)
        if tag in CLOSES_P:
            self._end("p", BOUNDS)
        if tag in HEADING and self.open[-1].tag in HEADING:
            self._pop(len(self.open) - 1)
        for name in ENDED_BY.get(tag, ()):
            self._end(name, BOUNDS | LIST_BOUNDS[tag] if tag in LIST_BOUNDS else TABLE)
        parent = self.open[-1]
        words, cut = [], tag in CUT_TAGS or tag == "header" and not self.count["article"]
        if attributes and TELLING.search(attributes):
            given = {m[1].lower(): m[2].strip("\"'") if m[2] else "" for m in ATTRIBUTE.finditer(attributes)}
            words = [w.lower() for key in ("class", "id") for w in WORD.findall(given.get(key, ""))]
            cut = (
                cut or given.get("role", "").strip().lower() in CUT_ROLES or "hidden" in given or given.get("aria-hidden", "").lower() == "true"
                or bool(HIDDEN.search(given.get("style", ""))) or _named_for_cutting(tag, words, self.count["article"] > 0)
            )
        node = Node(tag, parent, words, parent.cut or cut)
        parent.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(node)
            self.count[tag] += 1

    def end(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID or not (self.count[tag] or tag in HEADING):
            return
        if tag in INLINE:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    return self._pop(i)
                if self.open[i].tag not in INLINE:
                    return None
        if tag in TABLE_PARTS:
            return self._end(tag, NOTHING if tag == "table" else TABLE)
        if tag in HEADING:
            for name in HEADING:
                self._end(name, BOUNDS)
            return None
        return self._end(tag, BOUNDS | LIST_BOUNDS.get(tag, NOTHING))

    def _end(self, tag: str, bounds: frozenset[str]) -> None:
        if self.count[tag]:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    return self._pop(i)
                if self.open[i].tag in bounds:
                    return None
        return None

    def _pop(self, at: int) -> None:
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]


def _measure(nodes: list[Node]) -> None:
    """Characters, link characters and commas: of an element, and of its own text outside inner blocks."""
    block, linked = {}, {}
    for node in nodes:
        inner = node.parent is not None and node.tag in INLINE
        block[node] = block[node.parent] if inner else node
        linked[node] = node.tag == "a" or (inner and linked[node.parent])
        if node.cut:
            continue
        for part in node.parts:
            if isinstance(part, str):
                size = len(" ".join(part.split()))
                node.chars += size
                owner = block[node]
                owner.own += size
                owner.commas += len(COMMAS.findall(part))
                if linked[node]:
                    node.links += size
                    owner.own_links += size
    for node in reversed(nodes):
        if node.parent is not None and not node.cut:
            node.parent.chars += node.chars
            node.parent.links += node.links


def _score(nodes: list[Node]) -> Node | None:
    """Pass the points on; the best container, or None if there is no text."""
    for node in nodes:
        if node.cut or not node.own or node.tag in HEADING:
            continue
        points = min(node.own / FULL, 1) + node.commas + min(node.own // LONG, 3)
        points *= 1 - node.own_links / node.own
        at, level = (node.parent if node.tag in LEAF else node), 0
        while at is not None and level < REACH:
            if at.tag not in INLINE and at.tag not in ("tr", "tbody", "thead", "tfoot"):
                at.points += points / (1, 2, 6, 9, 12, 15)[level]
                level += 1
            at = at.parent
    best, most = None, 0.0
    for node in nodes:
        if node.points > 0 and not node.cut:
            total = _total(node)
            if total > most:
                best, most = node, total
    return best


def _total(node: Node) -> float:
    bonus = {"article": 25, "main": 15, "div": 5, "section": 5, "blockquote": 3, "td": 3, "ul": -3, "ol": -3, "dl": -3, "body": 0}.get(node.tag, 0)
    bonus += 25 if any(w in GOOD_WORDS for w in node.words) and node.tag not in ("body", "html") else 0
    return (node.points + max(bonus, -node.points / 2)) * (1 - node.density()) if node.points > 0 else 0.0


def _kept(best: Node) -> list:
    """The best container with the parts beside it that belong to it, in page order."""
    above = best
    while above is not None and above.tag != "article":
        above = above.parent
    best = above or best
    while best.parent is not None and best.tag not in ("body", "article") and best.parent.chars == best.chars and best.parent.tag != "html":
        best = best.parent
    if best.parent is None or best.tag == "body":
        return [best]
    limit, beside = max(10.0, 0.2 * _total(best)), best.parent.parts
    sure = []
    for part in beside:
        if isinstance(part, str):
            sure.append(False)
        elif part is best:
            sure.append(True)
        elif part.cut or not part.chars:
            sure.append(False)
        elif part.tag in ("p", "pre", "blockquote", "td"):
            text = part.chars
            sure.append(part.density() < 0.25 and text > 80 or part.density() == 0 and text > 0 and _ends_sentence(part))
        else:
            sure.append(_total(part) >= limit and part.tag not in HEADING)
    first, last = sure.index(True), len(sure) - 1 - sure[::-1].index(True)
    while first > 0 and _may_lead(beside[first - 1]):
        first -= 1
    return [
        part for i, part in enumerate(beside)
        if sure[i] or (first <= i <= last and (isinstance(part, str) or not part.cut and part.density() < 0.5))
    ]


def _may_lead(part) -> bool:
    """A heading, or the white space around it."""
    return not part.strip() if isinstance(part, str) else part.tag in HEADING and not part.cut and part.density() < 0.5


def _ends_sentence(node: Node) -> bool:
    return "".join(_texts([node])).rstrip()[-1:] in tuple(".!?…。！？")


def _link_block(node: Node) -> bool:
    return node.tag in LIKE_LIST and node.chars > 0 and node.density() > 0.7


def _texts(parts: list, cut_links: bool = False) -> Iterator[str]:
    """The text in page order; a line break wherever a block starts or ends."""
    stack: list = [iter(parts)]
    ends = [""]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            yield ends.pop()
        elif isinstance(part, str):
            yield part.replace("\n", " ")
        elif part.tag == "br":
            yield " "
        elif not part.cut and not (cut_links and _link_block(part)):
            edge = "" if part.tag in INLINE else "\n"
            yield edge
            stack.append(iter(part.parts))
            ends.append(edge)


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by a line break."""
    if not html:
        return ""
    nodes = Tree().read(html).nodes
    _measure(nodes)
    best = _score(nodes)
    if best is None:
        return ""
    blocks = (" ".join(block.split()) for block in "".join(_texts(_kept(best), True)).split("\n"))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    types = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "html"):
            texts = [main_text(html) for html in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def result(pages: DataFrame) -> DataFrame:
    return extract(pages)
