"""Main text of web pages by tag-path ratios.

A page's text falls into blocks (inline markup is transparent, ``<br>`` is white space).  Every
block has a root-to-leaf tag path.  For each path of the page the text length, the punctuation and
the link text of its blocks are summed up; text and punctuation per block, less the share of
links, fuse into the path's ratio.  The ratios are smoothed along the page with a small Gaussian,
fused with the unsmoothed ones, averaged by path again, and paths at or above half a standard
deviation are content.  The content paths' text chooses the article's element: ``article`` or
``main`` if they hold a good part of it, else the deepest element with most of it, whatever its
tag; ``article`` elements side by side that each hold a good part are one text.  Of an ``article`` or
``main`` every block stays that is not inside a part that names itself (menu, header, footer, sidebar,
notice, advert, form, script, style, comments); of any other element such a block stays if it is not on a
path of mere links and is on a content path, a heading, or
an item, cell or paragraph whose part (``div``, ``section``) has a block on a content path.

A part's name counts by whole tokens: one made of listed and layout words only ("share-box") is noise.
One with other words ("share-price", "related-work") or whose listed word is also an ordinary heading
("discussion") is noise only if most of its text is on no content path.  A
named part that wraps the page (it holds most of the content paths' text, or the article) is not
dropped for its name; the parts inside it are judged on their own.

Pages are independent of each other, so this is one pass over the table without a shuffle.

Defined results: a null or empty page and a page without text give an empty text; an unclosed
comment, script or style runs to the end of the page, an unclosed drawing to the next block, and the start tag
of any other unclosed embedded element is ignored; formulas keep their text; a stray end tag is ignored; repeated rows
give repeated results; other columns of ``pages`` are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Path selection: Gaussian over so many blocks to either side, and the share of the deviation.
RADIUS, DEVIATIONS = 2, 0.5
#: An element is the article if it holds this share of the content paths' text.
SEMANTIC_SHARE, DEEPEST_SHARE = 0.4, 0.75
#: Of ``article`` elements side by side, one with this share of the heaviest one's content belongs to the text.
SIBLING_SHARE = 0.25
#: A part with a doubtful name stays if this share of its text is on content paths.
DOUBT_SHARE = 0.5
#: A path whose text is links to this share is a list of links, unless it is a content path.
LINK_SHARE = 0.7

_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
_RAW = frozenset("script style title textarea noscript template iframe noframes noembed xmp svg annotation annotation-xml select object canvas audio video".split())
_NOISE_TAGS = frozenset("nav footer aside form button dialog menu head label input".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar sidebars side aside rail widget widgets related recommended recommendations teaser teasers share sharing social "
    "breadcrumb breadcrumbs menu menus nav navbar navigation topnav pagination pager toolbar "
    "footer footers header masthead topbar copyright disclaimer "
    "comment comments commentlist disqus reply replies respond discussion feedback "
    "form login search skip hidden tags tagcloud".split()
)
#: Words of layout that leave a listed word's meaning as it is.
_LAYOUT_WORDS = frozenset(
    "area article articles bar block blog body bottom box btn button buttons by col column component container content contents default "
    "email facebook first fixed for global google group holder hot icon icons image images inner inside item items large last latest left "
    "link links list lower mail main mobile module more news of on outer page panel popular post posts primary reader readers recent region right "
    "row secondary section site slot small sticky strip text the this title to top trending twitter unit upper us user users with wrap wrapper "
    "your zone".split()
)
#: Listed words that are also ordinary headings of a text's parts.
_DOUBTFUL = frozenset("discussion feedback form login promotion search side skip social".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Parts of a page: outside ``article`` and ``main`` one without a block on a content path is no content.
_PARTS = frozenset("# address article body center details div fieldset html main section".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of these, up to the given boundary.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?>[^<>"']+|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)>")
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DRAWING_ENDS = re.compile(r"(</svg(?=[\s/>])[^>]*>)|<(?:p|div|h[1-6]|ul|ol|table|article|section|main|body|blockquote|pre|nav|footer|header)(?=[\s/>])", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


@dataclass
class Block:
    text: str
    element: int
    path: int
    links: int


#: What an element's name says: nothing, perhaps noise, noise.
PLAIN, DOUBT, NOISE = 0, 1, 2


class Page:
    """Elements (parent, tag, path, named: whether it names itself noise) and text blocks of one page, in page order."""

    def __init__(self, html: str):
        self.parent, self.tag, self.path, self.named = [-1], ["#"], [0], [PLAIN]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        self._stack = [0]
        # the open elements that hold blocks of their own: block elements and named ones
        self._holders = [0]
        self._open: dict[str, int] = {}
        self._text: list[str] = []
        self._links = 0
        self._scan(html)

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            at = self._holders[-1]
            self.blocks.append(Block(text, at, self.path[at], min(self._links, len(text))))
        self._text, self._links = [], 0

    def _add(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self._text.append(text)
        if self._open.get("a"):
            self._links += len(text.strip())

    def _named_noise(self, tag: str, attributes: str, inside_article: bool) -> int:
        if tag in ("html", "body", "main"):
            return PLAIN
        if tag in _NOISE_TAGS or tag == "header" and not inside_article:
            return NOISE
        if not attributes or "=" not in attributes and "hidden" not in attributes:
            return PLAIN
        most = PLAIN
        for name, value in _NAMES.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" and not value or name == "aria-hidden" and value == "true":
                return NOISE
            if name == "role" and value.lower() in _NOISE_ROLES:
                return NOISE
            if name in ("class", "id"):
                for token in value.split():
                    words = {w.lower() for w in _WORD.findall(token)}
                    listed = words & _NOISE_WORDS
                    if inside_article:
                        listed -= {"header"}
                    if tag == "article":
                        listed &= {"comment", "comments", "reply", "teaser", "related", "ad", "ads", "advert", "promo", "sponsored"}
                    if listed:
                        sure = listed - _DOUBTFUL and words <= _NOISE_WORDS | _LAYOUT_WORDS
                        most = max(most, NOISE if sure else DOUBT)
        return most

    def _push(self, tag: str, attributes: str) -> None:
        top = self._stack[-1]
        inside = bool(self._open.get("article") or self._open.get("main"))
        named = self._named_noise(tag, attributes, inside)
        key = (self.path[top], tag) if tag in _BLOCK or named else None
        self.parent.append(top)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault(key, len(self.paths) + 1) if key else self.path[top])
        self.named.append(named)
        self._stack.append(len(self.tag) - 1)
        if key:
            self._holders.append(len(self.tag) - 1)
        self._open[tag] = self._open.get(tag, 0) + 1

    def _pop_to(self, tags: Iterable[str], stop: Iterable[str] = ()) -> None:
        """Close elements up to the innermost of ``tags``, if it is open inside ``stop``."""
        for k in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[k]]
            if name in tags:
                if any(self.named[e] for e in self._stack[k:]):
                    self._flush()
                for e in self._stack[k:]:
                    self._open[self.tag[e]] -= 1
                while self._holders[-1] >= self._stack[k] > 0:
                    self._holders.pop()
                del self._stack[k:]
                return
            if name in stop:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag in ("td", "th"):
            self._text.append(" ")
        if tag in _BLOCK:
            self._flush()
            if self._open.get("p"):
                self._pop_to(("p",))
        if tag in _CLOSES:
            closed, stop = _CLOSES[tag]
            if any(self._open.get(t) for t in closed):
                self._pop_to(closed, stop)
        if tag not in _VOID:
            named = self._named_noise(tag, attributes, True)
            if named:
                self._flush()
            self._push(tag, attributes)

    def _end(self, tag: str) -> None:
        if not self._open.get(tag):
            return
        if tag in _BLOCK:
            self._flush()
        self._pop_to((tag,))

    def _scan(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self._add(html[at:])
                break
            if lt > at:
                self._add(html[at:lt])
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 4)
                at = end if close < 0 else close + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
                continue
            found = _TAG.match(html, lt) or _LOOSE.match(html, lt)
            if not found:
                self._add("<")
                at = lt + 1
                continue
            closing, tag, attributes = found[1], found[2].lower(), found[3]
            at = found.end()
            if closing:
                self._end(tag)
            elif tag in _RAW:
                if not attributes.endswith("/") or tag in ("script", "style", "title", "textarea"):
                    shut = (_DRAWING_ENDS if tag == "svg" else re.compile(rf"(</{tag}(?=[\s/>])[^>]*>)", re.IGNORECASE)).search(html, at)
                    if shut:
                        at = shut.end() if shut[1] else shut.start()
                    elif tag in ("script", "style"):
                        at = end
            else:
                self._start(tag, attributes)
        self._flush()


def path_ratios(blocks: list[Block]) -> tuple[dict[int, float], dict[int, float], float]:
    """Of every path: the smoothed and fused ratio, and the share of link text; and the threshold."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(b.text)
        s[2] += len(_PUNCTUATION.findall(b.text))
        s[3] += b.links
    links = {p: s[3] / s[1] for p, s in sums.items()}
    raw = {p: math.sqrt(s[1] / s[0] * (1 + s[2] / s[0])) * (1 - links[p]) for p, s in sums.items()}
    x = [raw[b.path] for b in blocks]
    kernel = [math.exp(-d * d / (2 * RADIUS)) for d in range(RADIUS + 1)]
    fused: dict[int, list[float]] = {}
    values = []
    for i, b in enumerate(blocks):
        near = [(kernel[abs(j - i)], x[j]) for j in range(max(0, i - RADIUS), min(len(x), i + RADIUS + 1))]
        smooth = sum(k * v for k, v in near) / sum(k for k, _ in near)
        values.append(math.sqrt(x[i] * smooth))
        fused.setdefault(b.path, []).append(values[-1])
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    return {p: sum(v) / len(v) for p, v in fused.items()}, links, DEVIATIONS * deviation


def _weights(page: Page, content: list[Block], noise: list[bool]) -> list[int]:
    """Text of the ``content`` blocks inside each element, without those in ``noise``."""
    weight = [0] * len(page.tag)
    for b in content:
        if not noise[b.element]:
            weight[b.element] += len(b.text)
    for e in range(len(weight) - 1, 0, -1):
        weight[page.parent[e]] += weight[e]
    return weight


def _noise(page: Page, named: list[bool]) -> list[bool]:
    noise = list(named)
    for e in range(1, len(noise)):
        noise[e] = noise[e] or noise[page.parent[e]]
    return noise


def noise_of(page: Page, content: list[Block]) -> list[bool]:
    """Whether each element is, or is inside, a part that names itself noise.

    A part is none, whatever its name, if it is the page's wrapper: it holds most of the text of
    the content paths, or the ``article`` or ``main`` with a good part of it and more than stands
    outside all named parts.
    """
    if not any(page.named):
        return [False] * len(page.named)
    sure = [n == NOISE for n in page.named]
    if DOUBT in page.named:
        text, good = _weights(page, page.blocks, _noise(page, sure)), _weights(page, content, _noise(page, sure))
        sure = [n or page.named[e] == DOUBT and good[e] < DOUBT_SHARE * max(1, text[e]) for e, n in enumerate(sure)]
    noise = _noise(page, sure)
    outside, whole = _weights(page, content, noise)[0], _weights(page, content, [False] * len(noise))
    # Text in each element without the named parts inside it: an article's own.
    clean = [0] * len(noise)
    for b in content:
        if not sure[b.element]:
            clean[b.element] += len(b.text)
    for e in range(len(clean) - 1, 0, -1):
        if not sure[e]:
            clean[page.parent[e]] += clean[e]
    wraps = [False] * len(noise)
    for e in range(len(noise) - 1, 0, -1):
        own = page.tag[e] in ("article", "main") and not sure[e]
        if wraps[e] or own and clean[e] > outside and clean[e] >= SEMANTIC_SHARE * whole[0]:
            wraps[e] = wraps[page.parent[e]] = True
    return _noise(page, [n and not (wraps[e] or 0 < DEEPEST_SHARE * whole[0] <= whole[e]) for e, n in enumerate(sure)])


def _article(page: Page, noise: list[bool], weight: list[int], total: int) -> list[int]:
    """The elements that hold the article, one but for articles side by side; ``weight``: text of content paths inside each element."""
    def heaviest(tags: tuple[str, ...]) -> int:
        return max((e for e, t in enumerate(page.tag) if t in tags and not noise[e]), key=lambda e: weight[e], default=-1)

    main, article = heaviest(("main",)), heaviest(("article",))
    if article >= 0 and weight[article] >= SEMANTIC_SHARE * (weight[main] if main >= 0 and weight[main] else total):
        beside = [e for e, t in enumerate(page.tag) if t == "article" and page.parent[e] == page.parent[article]]
        return [e for e in beside if not noise[e] and weight[e] >= SIBLING_SHARE * weight[article]]
    if main >= 0 and weight[main] >= SEMANTIC_SHARE * total:
        return [main]
    children: dict[int, int] = {}
    for e in range(1, len(weight)):
        if not noise[e] and weight[e] >= DEEPEST_SHARE * total:
            children[page.parent[e]] = e
    titles = {b.element for b in page.blocks if page.tag[b.element] == "h1" and not noise[b.element]}
    at = 0
    while (below := children.get(at)) is not None and page.tag[below] not in ("p", "li", "pre", "blockquote", *_HEADINGS):
        if page.tag[at] not in ("#", "html", "body") and any(page.parent[t] == at for t in titles):
            break
        at = below
    return [at]


def article_blocks(html: str) -> list[str]:
    """The article's blocks in page order."""
    page = Page(html)
    if not page.blocks:
        return []
    ratio, links, threshold = path_ratios(page.blocks)
    chosen = [b for b in page.blocks if ratio[b.path] >= threshold and links[b.path] < LINK_SHARE]
    noise = noise_of(page, chosen)
    weight = _weights(page, chosen, noise)
    roots = _article(page, noise, weight, weight[0]) if weight[0] else [0]
    inside = [False] * len(page.tag)
    for e in roots:
        inside[e] = True
    for e in range(1, len(inside)):
        inside[e] = inside[e] or inside[page.parent[e]]
    part = [0] * len(page.tag)
    for e in range(1, len(part)):
        part[e] = e if page.tag[e] in _PARTS else part[page.parent[e]]
    content = {part[b.element] for b in chosen}
    own = page.tag[roots[0]] in ("article", "main")

    def stays(b: Block) -> bool:
        if not inside[b.element] or noise[b.element]:
            return False
        return own or ratio[b.path] >= threshold or links[b.path] < LINK_SHARE and (page.tag[b.element] in _HEADINGS or part[b.element] in content)

    return [b.text for b in page.blocks if stays(b)]


def main_text(html: str | None) -> str:
    return "\n\n".join(article_blocks(html)) if html else ""


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and its number of code points, for every row."""
    given = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column("html")
            texts = [main_text(html[k].as_py()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return given.mapInArrow(extract, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


op1_html_extraction = extracted
