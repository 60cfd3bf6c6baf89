"""Main-text extraction from HTML by tag-path ratios.

A page is cut into text blocks, each with its root-to-leaf path of tags (with the class or role words that matter).
Blocks under tags that never hold an article (menus, headers, footers ...) and in comments have a weight of nothing.
Forms and elements with a class word of menus, adverts and the like have none either, unless the element holds the
page's largest article or most of its text: then it is a wrapper of the page. Outside articles a part of a compound
class name counts as such a word (site-nav); inside an article only a whole class name does, and a word that authors use
for parts of articles too (share, notice, related) is outweighed by text and punctuation. For every other path the text
length and the punctuation of its blocks are aggregated into two ratios per block; both are fused with those of the
enclosing container, smoothed over neighbouring blocks in page order, and paths above a share of the best one are the
content. In an article element the other blocks stay too, but for those that are mostly links. An article's own header
element, heading included, is a header and goes.

Null, empty and tag-only pages give an empty text. Unclosed, truncated and badly nested tags are repaired as browsers
do for the common cases; a truncated tag at the end is dropped. Nothing is capped: very long pages are read whole.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import table

#: A quote opens a value only after an equals sign, as in browsers; any other quote is a character like the rest.
_ATTRIBUTES = r"(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+"
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|object|textarea|select|title)\b" + _ATTRIBUTES + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>" + _ATTRIBUTES + r")>"
    r"|<[a-zA-Z/][^>]*\Z|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTR = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
#: Tags that flow inside a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags and class words under which no article text stands.
NEVER = frozenset("head nav header footer aside button menu dialog input option label fieldset".split())
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu nav navbar navigation "
    "newsletter notice notices pagination popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, words that authors use for parts of an article too: there, enough prose outweighs them.
SOFT_WORDS = frozenset("banner breadcrumb breadcrumbs header masthead menu notice notices popup promo related share sharing social toolbar widget".split())
PROSE_CHARS, PROSE_MARKS = 80, 2
ARTICLE = frozenset("article main".split())
#: Class words of readers' comments, which no amount of text makes the article; and words with which a class only says what a page has.
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
HAS_WORDS = frozenset("has with no without".split())
#: Vetoes of an element: none, one that prose in an article outweighs, one that a wrapper of the page is spared (as the one before), one that always holds.
FREE, SOFT, WEAK, HARD = range(4)
#: A tag that opens one of these closes an open one of the same set.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}
BLOCK_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPES = frozenset("article aside blockquote body button div dl fieldset footer form header main nav ol section table td th ul".split())
WHITE = re.compile(r"\s+")
MARKS = re.compile(r"[.,;:!?。，！？…]")
#: Share of the best fused ratio that a path needs.
SHARE = 0.1


def blocks(page: str) -> list[tuple[str, str, str, int, bool]]:
    """(container path, path, text, characters inside links, article?) of each non-empty block in page order."""
    out: list[tuple[tuple[str, str, str, int, bool], set[int]]] = []
    stack: list[tuple[str, str, int, bool, int]] = []  # tag, step of the path, veto, article?, number
    links, buffer, linked, opened = 0, [], 0, 0
    chars: dict[int, int] = defaultdict(int)  # text outside links by article or vetoed element, 0 for the page
    in_links: dict[int, int] = defaultdict(int)
    marks: dict[int, int] = defaultdict(int)
    around: dict[int, set[int]] = {}  # vetoed elements around each article
    soft: set[int] = set()  # elements that prose outweighs

    def flush() -> None:
        nonlocal buffer, linked
        text = WHITE.sub(" ", _html.unescape("".join(buffer))).strip()
        if text and not any(s[2] == HARD for s in stack if s[0] not in INLINE):
            steps = [s[1] for s in stack if s[0] not in INLINE]
            weak = {s[4] for s in stack if s[2] in (SOFT, WEAK) and s[0] not in INLINE}
            inside = [s[4] for s in stack if s[3]]
            for k in {0, *weak, *inside}:
                chars[k] += len(text) - min(linked, len(text))
                in_links[k] += min(linked, len(text))
                marks[k] += len(MARKS.findall(text))
            for k in inside:
                around.setdefault(k, weak - {x for x in weak if x > k})
            out.append((("/".join(steps[:-1]), "/".join(steps), text, min(linked, len(text)), bool(inside)), weak))
        buffer, linked = [], 0

    def close(names: tuple[str, ...]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in SCOPES:
                return

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if stack and stack[-1][0] in INLINE and any(s[2] for s in stack if s[0] in INLINE):
                continue
            buffer.append(text)
            if links:
                linked += len(text)
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            buffer.append("\n")
        elif tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if m["end"] else 1))
            if tag in VOID:
                continue
            if m["end"]:
                close((tag,))
            elif not (m["attrs"] or "").endswith("/"):
                stack.append((tag, tag, _veto(tag, m["attrs"], any(s[3] for s in stack)), False, -1))
        elif m["end"]:
            flush()
            names = [s[0] for s in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag) :]
            links = 0
        else:
            flush()
            links = 0
            if tag in CLOSES:
                close(CLOSES[tag])
            elif tag in BLOCK_CLOSES_P:
                close(("p",))
            if tag == "body":
                stack[:] = [s for s in stack if s[0] != "head"]
            if tag not in VOID and not (m["attrs"] or "").endswith("/"):
                opened += 1
                veto = _veto(tag, m["attrs"], any(s[3] for s in stack))
                if veto == SOFT:
                    soft.add(opened)
                stack.append((tag, tag, veto, tag in ARTICLE, opened))
    flush()
    spared = around[max(around, key=chars.__getitem__)] if around else set()

    def outweighed(k: int) -> bool:
        prose = k in soft and chars[k] >= PROSE_CHARS and marks[k] >= PROSE_MARKS
        return k in spared or chars[k] > in_links[k] and (prose or 2 * chars[k] > chars[0])

    return [b for b, weak in out if all(map(outweighed, weak))]


def _veto(tag: str, attrs: str | None, inside: bool) -> int:
    if tag in NEVER:
        return HARD
    if not attrs or tag in ("html", "body", "main"):
        return WEAK if tag == "form" else FREE
    if tag != "article" and HIDDEN.search(attrs):
        return HARD
    names = [x for a in ATTR.findall(attrs) for x in "".join(a).lower().split()]
    parts = [{x} if inside else set(re.split(r"[^a-z]+", x)) for x in names]
    if any(set(re.split(r"[^a-z]+", x)) & COMMENT_WORDS and not set(re.split(r"[^a-z]+", x)) & HAS_WORDS for x in names):
        return HARD
    if tag == "form":
        return WEAK
    found = {w for x in parts for w in x & NEVER_WORDS} if tag != "article" else set()
    return FREE if not found else SOFT if inside and found <= SOFT_WORDS else WEAK


def content(found: list[tuple[str, str, str, int, bool]], share: float = SHARE, reach: int = 1) -> list[str]:
    """Texts of the blocks whose tag paths are content, in page order."""
    if not found:
        return []
    article = any(f[4] for f in found)
    if article:
        found = [f for f in found if f[4]]
    sums: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for container, path, text, linked, _ in found:
        for key in (path, container + "/*"):
            s = sums[key]
            s[0] += 1
            s[1] += len(text) - linked
            s[2] += len(MARKS.findall(text))
    ratio = {k: (chars / n) * (1 + marks) / (1 + n) if n else 0.0 for k, (n, chars, marks) in sums.items()}
    fused = [max(ratio[path], ratio[container + "/*"]) for container, path, *_ in found]
    smooth = [max(v, sum(fused[max(0, i - reach) : i + reach + 1]) / len(fused[max(0, i - reach) : i + reach + 1])) for i, v in enumerate(fused)]
    by_path: dict[str, float] = {}
    for f, v in zip(found, smooth):
        by_path[f[1]] = max(v, by_path.get(f[1], 0.0))
    least = share * max(by_path.values())
    return [f[2] for f in found if by_path[f[1]] >= least or article and 2 * f[3] < len(f[2])]


def main_text(page: str | None) -> str:
    return "\n\n".join(content(blocks(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page; one pass, no shuffle."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None)

    return pages.select("page_id", "url", texts("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
