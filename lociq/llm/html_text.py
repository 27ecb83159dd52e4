"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each with the path of block elements from the root to it.
Text length and punctuation are summed per path, smoothed along the page, fused into one
figure a path, and a threshold of the page's own chooses the paths whose blocks are content.
What elements say of themselves (``nav``, ``footer``, ``class="ad"``, ``article`` ...) goes
into the fusion as a prior: boilerplate counts nothing, and where a page marks its article,
text outside of it counts nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame

from lociq.llm.frames import map_columns

# Elements by their part in a page, of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre"
    " search section summary table tbody td template tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no article text, whatever they are called.
NEVER = frozenset("head script style noscript template nav aside footer form button select option textarea dialog menu iframe object svg canvas audio video map datalist title xmp noembed noframes search".split())
#: Opening one of the first ends an open one of the second, up to the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words in a class or id that tell of boilerplate.
HINTS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription signup login register sidebar sidebars aside widget widgets menu menus nav navs navigation navbar breadcrumb breadcrumbs pagination pager masthead topbar footer footers comment comments"
    " commentlist disqus respond reply replies share sharing social related recommended recommendations toolbar header headers".split()
)
#: A hint after one of these speaks of the page's layout, not of the element.
NOT_ITSELF = frozenset("has with no without is not hide".split())
PUNCTUATION = re.compile(r"[.,;:!?…，。、；：！？]")
# End of the fixed values.

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?P<close>>|\Z)", re.DOTALL
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.IGNORECASE) for n in RAW}


def _attributes(attrs: str) -> dict[str, str]:
    got: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        got.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return got


def _hinted(got: dict[str, str]) -> bool:
    """Whether an element's role, class, id or style marks it as boilerplate or hidden."""
    if "hidden" in got or got.get("role", "").strip().lower() in ROLES or _HIDDEN.search(got.get("style", "")):
        return True
    for name in (got.get("class", "") + " " + got.get("id", "")).split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if any(w in HINTS and not (i and words[i - 1] in NOT_ITSELF) for i, w in enumerate(words)):
            return True
    return False


class _Element:
    __slots__ = ("name", "block", "path", "never", "hinted", "above", "article", "link", "out")

    def __init__(self, name: str, above: _Element | None, got: dict[str, str]):
        self.name, self.above, self.block, self.path, self.out = name, above, name in BLOCKS, 0, False
        self.article = name in ("article", "main") or got.get("role") == "main" or got.get("itemprop") == "articleBody" or bool(above and above.article)
        self.link = name == "a" or bool(above and above.link)
        self.never = name in NEVER or (name == "header" and not self.article) or bool(above and above.never)
        self.hinted = name not in ("html", "body") and bool(got) and _hinted(got)


class Block:
    """Text of one innermost block element: the number of its path, its heading mark, characters outside links, and whether it is boilerplate by its marks."""

    __slots__ = ("pieces", "owner", "own", "text", "boilerplate")

    def __init__(self, owner: _Element | None):
        self.owner, self.pieces, self.own, self.text, self.boilerplate = owner, [], 0, "", False

    @property
    def path(self) -> int:
        return self.owner.path if self.owner else 0

    @property
    def heading(self) -> bool:
        return bool(self.owner) and self.owner.name in HEADINGS

    @property
    def links_only(self) -> bool:
        """At most an eighth of the text is outside links, as where links stand between bars."""
        return self.own * 8 <= len(self.text)


class _Page:
    """The open elements of a page while it is read, and its blocks. Paths are numbered: a path is its parent path's number and a name."""

    def __init__(self):
        self.stack: list[_Element] = []
        self.blocks_open: list[int] = []  # where in the stack block elements are
        self.names: Counter[str] = Counter()
        self.paths: dict[tuple[int, str], int] = {}
        self.made: list[_Element] = []
        self.found: list[Block] = []
        self.now = Block(None)

    def cut(self) -> None:
        """A block ends, and what follows is a block of the innermost open block element."""
        self.now.text = " ".join("".join(self.now.pieces).split())
        if self.now.text:
            self.found.append(self.now)
        self.now = Block(self.stack[self.blocks_open[-1]] if self.blocks_open else None)

    def say(self, text: str) -> None:
        top = self.stack[-1] if self.stack else None
        if top and not top.block and (top.never or top.hinted):
            return  # an inline mark hides its text, a block's is judged when all is read
        text = unescape(text) if "&" in text else text
        self.now.pieces.append(text)
        if not (top and top.link):
            self.now.own += sum(map(len, text.split()))

    def open(self, name: str, got: dict[str, str]) -> None:
        e = _Element(name, self.stack[-1] if self.stack else None, got)
        above = self.stack[self.blocks_open[-1]].path if self.blocks_open else 0
        e.path = self.paths.setdefault((above, name), len(self.paths) + 1) if e.block else above
        if name in ("article", "main") and not e.never and not e.hinted:
            x = e.above  # what holds the article isn't boilerplate, whatever its class says
            while x and not x.out:
                x.hinted, x.out = False, True
                x = x.above
        if e.block:
            self.cut()
            self.blocks_open.append(len(self.stack))
        self.stack.append(e)
        self.made.append(e)
        self.names[name] += 1
        if e.block:
            self.now.owner = e

    def close(self, at: int) -> None:
        """End all elements from a place in the stack on."""
        ends = bool(self.blocks_open) and self.blocks_open[-1] >= at
        for e in self.stack[at:]:
            self.names[e.name] -= 1
        if ends:
            while self.blocks_open and self.blocks_open[-1] >= at:
                self.blocks_open.pop()
            del self.stack[at:]
            self.cut()
        else:
            del self.stack[at:]

    def end(self, name: str) -> None:
        if not self.names[name]:
            return
        least = 0 if name in BLOCKS or not self.blocks_open else self.blocks_open[-1]  # the end of an inline element ends no block
        for k in range(len(self.stack) - 1, least - 1, -1):
            if self.stack[k].name == name:
                self.close(k)
                return

    def imply_ends(self, name: str) -> None:
        """What the start of a block element ends."""
        if name in IMPLIED:
            ends, bound = IMPLIED[name]
            if any(self.names[x] for x in ends):
                for k in reversed(self.blocks_open):
                    if self.stack[k].name in ends:
                        self.close(k)
                        return
                    if self.stack[k].name in bound:
                        return
        elif self.blocks_open:
            k = self.blocks_open[-1]
            if self.stack[k].name == "p" or (name in HEADINGS and self.stack[k].name in HEADINGS):
                self.close(k)

    def blocks(self) -> list[Block]:
        self.cut()
        bad: set[int] = set()
        for e in self.made:  # elements come after those that hold them
            if e.never or e.hinted or (e.above and id(e.above) in bad):
                bad.add(id(e))
        for b in self.found:
            b.boilerplate = b.owner is not None and id(b.owner) in bad
        return self.found


def blocks_of(html: str) -> list[Block]:
    """The non-empty blocks of a page in page order; open elements at the end of the page end there."""
    page, at, n = _Page(), 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            page.say(html[at:])
            break
        if lt > at:
            page.say(html[at:lt])
        m = _TOKEN.match(html, lt)
        if not m:  # a bare < is text
            page.say("<")
            at = lt + 1
            continue
        at = m.end()
        if name := m["end"]:
            page.end(name.lower())
            continue
        if not (name := m["start"]) or not m["close"]:
            continue
        name, attrs = name.lower(), m["attrs"]
        if name == "hr":
            page.cut()
        elif name in ("br", "img"):
            page.now.pieces.append(" ")
        elif name in RAW:
            end = _RAW_END[name].search(html, at)
            at = _TOKEN.match(html, end.start()).end() if end else n
        elif name not in VOID:
            if name in BLOCKS:
                page.imply_ends(name)
            elif attrs.endswith("/"):
                continue
            page.open(name, _attributes(attrs) if attrs else {})
    return page.blocks()


#: Width of the smoothing along the page in blocks, and the share of the scores' deviation that a path has to reach.
SIGMA, SHARE = 1.0, 0.5
#: What a block without punctuation counts beside marks.
BARE = 0.1


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian means over neighbouring blocks; at the ends of the page over those that there are."""
    reach = math.ceil(2 * sigma)
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        w = [weights[abs(j - i)] for j in range(lo, hi)]
        out.append(sum(map(float.__mul__, w, values[lo:hi])) / sum(w))
    return out


def path_scores(blocks: list[Block]) -> dict[int, float]:
    """A fused score for each path: the mean text length outside links times the mean punctuation of its blocks, by itself and as smoothed along the page."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        s[0] += 1
        s[1] += b.own
        s[2] += 0 if b.links_only else len(PUNCTUATION.findall(b.text))
    lengths = smoothed([sums[b.path][1] / sums[b.path][0] for b in blocks])
    marks = smoothed([sums[b.path][2] / sums[b.path][0] for b in blocks])
    near: dict[int, float] = {}
    for b, x, y in zip(blocks, lengths, marks, strict=True):
        near[b.path] = near.get(b.path, 0.0) + x * (BARE + y)
    # the geometric mean: a path needs text of its own and text around it
    return {p: math.sqrt(near[p] / k * (chars / k) * (BARE + points / k)) for p, (k, chars, points) in sums.items()}


def filled(blocks: list[Block], keep: list[bool]) -> list[bool]:
    """Blocks with text outside links between two kept ones stay too, and so do headings right before a kept block."""
    spots = [i for i, k in enumerate(keep) if k]
    out = [k or (bool(spots) and spots[0] < i < spots[-1] and not b.links_only) for i, (b, k) in enumerate(zip(blocks, keep, strict=True))]
    for i in range(len(blocks) - 2, -1, -1):
        out[i] = out[i] or (out[i + 1] and blocks[i].heading)
    return out


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks of the chosen paths, in page order."""
    left = [b for b in blocks if not b.boilerplate]
    if marked := [b for b in left if b.owner and b.owner.article]:  # the page itself says what the article is: only paths all of links go
        worded = {b.path for b in marked if not b.links_only}
        return [b for b in marked if b.path in worded or b.heading]
    if not left:
        return []
    scores = path_scores(left)
    each = [scores[b.path] for b in left]
    mean = sum(each) / len(each)
    least = min(SHARE * mean + SHARE * math.sqrt(sum((x - mean) ** 2 for x in each) / len(each)), max(each))
    keep = filled(left, [scores[b.path] >= least for b in left])
    return [b for b, k in zip(left, keep, strict=True) if k]


def main_text(html: str | None) -> str:
    """Main text of a page: blocks joined by two line feeds. A null or empty page, and one without text, gives the empty string."""
    return "\n\n".join(b.text for b in content_blocks(blocks_of(html))) if html else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; repeated rows stay, further columns are left out.

    A page is judged by itself, so nothing is shuffled and a page costs time in its length.
    Null ids and urls stay null. White space is what Unicode calls so, a no-break space too;
    ``br`` counts as white space. A page without any marks has its threshold from its own
    blocks, so one with a single block keeps it.
    """

    def run(cols: dict) -> dict:
        texts = [main_text(h) for h in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": list(map(len, texts))}

    return map_columns(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
