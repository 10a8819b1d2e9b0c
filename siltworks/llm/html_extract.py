"""Main text of web pages by a maximum-scoring run of words and tags.

A page becomes a sequence of items: words count for the region they stand in,
tags count against it. The weights come from labelled pages, whose main region
is marked. One linear scan finds the run of items with the largest sum; the
text of that run, less the parts that are never main text, is the result.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is text for a parser, not markup, and those of them that run to the page's end without an end tag (fixed values).
RAW = frozenset("script style noscript template textarea iframe svg object select".split())
TO_END = frozenset("script style textarea".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: Elements that start a new block (fixed values).
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that have no end tag (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are not main text wherever they stand, and those that are not outside an article.
NEVER, OUTSIDE = frozenset("head nav footer aside form button dialog menu".split()), frozenset(["header"])
#: Names in class, id or role that mark notices, adverts, menus and reader comments; those that mark headers, outside an article only;
#: those that hold articles of others; and what may stand beside a name in one token. A token counts as a whole, so has-sidebar is none.
NAMES = (
    r"ads?\d*|advert\w*|adsense|banner|sponsor\w*|promo|promos|promoted|promotions?|cookies?|consent|gdpr|notices?|notifications?|alerts?|popup|modal|newsletter|subscribe|signup|"
    r"side-?bar|menu|nav|navbar|navigation|navi|navlist|navmenu|breadcrumbs?|footer|toolbar|pagination|pager|share|sharing|social|widgets?|search|login"
)
HEADERS = r"header|masthead"
OF_OTHERS = r"comments?|commentlist|replies|reply|disqus|respond|related|recommend\w*"
BESIDE = r"site|main|global|primary|secondary|top|bottom|left|right|mobile|google|area|bar|box|list|wrap|wrapper|container|inner|block|section|slot|unit|links?|buttons?|items?|form|\d+"


OF_PARTS = r"posts?|articles?|stories|story|entry|entries|page|blog|users?|readers?"


def tokens_of(names: str, beside: str) -> re.Pattern:
    """Whole tokens that are made of these names and of what may stand beside them."""
    return re.compile(rf"(?<!\S)(?:(?:{beside})[_-]+)*(?:{names})(?:[_-]+(?:{names}|{beside}))*(?!\S)", re.I)


MARKED, MARKED_OTHERS, MARKED_OUTSIDE = tokens_of(f"{NAMES}|{OF_OTHERS}", f"{BESIDE}|{OF_PARTS}"), tokens_of(OF_OTHERS, f"{BESIDE}|{OF_PARTS}"), tokens_of(f"{NAMES}|{HEADERS}", BESIDE)
#: Headings, which no name marks inside an article.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: An attribute as parsers read it: quotes count at the start of a value only; a value without quotes ends at white space or the tag's end.
QUOTED = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
ITEM = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{QUOTED})?+)*+)>"
    r"|(?P<text>(?:[^<]++|<(?![A-Za-z/!?]))++)|<",
    re.S | re.I,
)
TAG_START = re.compile("</?[A-Za-z]")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(?!["'])([^\s>]++))""")
SPACE = re.compile(r"\s+")

#: Labelled pages: what stands between the braces is the main region.
LABELLED = (
    '<html><head><title>a b c</title></head><body><nav><ul><li><a href="/a">a</a></li><li><a href="/b">b b</a></li><li><a href="/c">c</a></li></ul></nav>'
    '<div class="ad">buy this now and save</div>{<article><h1>a head line</h1><p>some words of text that go on and on</p><p><b>more words of text<br><p>and <a href="/x">a link</a> in it</p></article>}<footer>copy of a site</footer></body></html>',
    "<html><body><header><h1>site name</h1><ul><li><a>home</a></li><li><a>about us</a></li></ul></header>{<main><h1>title of it</h1><p>a first part of the text that is read</p><ul><li>one item of it</li><li>one more item of it</li></ul>"
    '<p>the last part of the text</p></main>}<aside><h2>more</h2><ul><li><a>one</a></li><li><a>two</a></li></ul></aside><form><label>mail</label><button>send</button></form></body></html>',
    '<html><body><div id="menu"><a>one</a> <a>two</a> <a>three</a></div>{<div class="post"><h2>a title</h2><p>long text of a post with many words in it</p><blockquote>said by someone there</blockquote><p>text again and words</p></div>}'
    '<div class="comments"><div><b>ann</b><p>nice</p></div><div><b>bob</b><p>so so</p></div></div><div class="footer"><a>terms</a> <a>privacy</a></div></body></html>',
)


class Part:
    """One item of a page: its kind for scoring, its words, its text, and whether it may be main text."""

    __slots__ = ("breaks", "kind", "main", "text", "words")

    def __init__(self, kind: str, words: int, text: str, main: bool, breaks: bool):
        self.kind, self.words, self.text, self.main, self.breaks = kind, words, text, main, breaks


def parts_of(page: str) -> list[Part]:
    """The items of a page in order.

    An article in a marked element counts where the page has no other; if none
    counts (they stand in a menu, an aside, comments or a note of the source),
    the page is one without articles.
    """
    whole_article = bool(re.search(r"<(?:article|main)\b", page, re.I))
    out, reached = read_parts(page, whole_article, False)
    if whole_article and not reached:
        out, reached = read_parts(page, True, True)
        if not reached:
            out, _ = read_parts(page, False, False)
    return out


def items_of(page: str):
    """Matches of ITEM in order, each with whether it is a whole raw element."""
    at, endless, last = 0, set(), page.rfind(">")
    while at < len(page):
        if at > last and TAG_START.match(page, at):
            return  # a page that ends inside a tag: parsers drop the tag, and no later one has an end
        m = ITEM.match(page, at)
        at = m.end()
        tag = m["tag"]
        if not tag or m["end"] or (tag := tag.lower()) not in RAW:
            yield m, False
            continue
        if tag not in endless and (tag in TO_END or not m["attrs"].endswith("/")):
            if end := RAW_END[tag].search(page, at):
                at = end.end()
            elif tag in TO_END:
                at = len(page)
            else:
                endless.add(tag)
        yield m, True


def read_parts(page: str, whole_article: bool, in_marked: bool) -> tuple[list[Part], bool]:
    """The items of a page, and whether an article or main of it may be main text; ``in_marked``: an article in a marked element may."""
    out: list[Part] = []
    open_tags: list[tuple[str, bool, str, bool]] = []  # tag, unwanted by a tag inside, by a name inside, article or main inside
    state = outer = (False, "", False)
    link, reached = 0, False
    for m, raw in items_of(page):
        barred, marked, within = state
        unwanted = barred or bool(marked)
        if text := m["text"]:
            text = html.unescape(text)
            kind = ("dropped" if within else "unwanted") if unwanted else "outside" if whole_article and not within else "link" if link else "word"
            out.append(Part(kind, len(text.split()), text, not unwanted, False))
            continue
        if raw:
            out.append(Part("raw", 0, "", False, False))
            continue
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        breaks = tag in BLOCKS
        out.append(Part(f"<{tag}>", 0, " " if tag == "br" else "", not unwanted, breaks))
        if tag in VOID:
            continue
        if m["end"]:
            if tag == "a":
                link = max(0, link - 1)
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    del open_tags[k:]
                    state = open_tags[-1][1:] if open_tags else outer
                    break
            continue
        link += tag == "a"
        if tag not in BLOCKS and tag not in NEVER and not m["attrs"].strip():
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_tags and open_tags[-1][0] == tag:
            open_tags.pop()  # its end tag may be left out
            barred, marked, within = open_tags[-1][1:] if open_tags else outer
        if tag in ("article", "main"):
            if not within and marked != "others" and (in_marked or tag == "main"):
                marked = ""
            within = True
            reached = reached or not (barred or marked)
        elif marked != "others" and tag not in ("html", "body") and not (within and tag in HEADINGS):
            marked = mark_of(m["attrs"], within) or marked
        state = (barred or tag in NEVER or tag in OUTSIDE and not within, marked, within)
        open_tags.append((tag, *state))
    return out, reached


def mark_of(attrs: str, within: bool) -> str:
    """How names in class, id or role mark an element: "others" (articles of others), "part" or not at all."""
    if not attrs or "=" not in attrs:
        return ""
    found = [a or b or c for name, a, b, c in ATTRIBUTE.findall(attrs) if name.lower() in ("class", "id", "role")]
    if any(MARKED_OTHERS.search(x) for x in found):
        return "others"
    return "part" if any(MARKED.search(x) or not within and MARKED_OUTSIDE.search(x) for x in found) else ""


def fit_weights(pages=LABELLED) -> dict[str, float]:
    """Log odds of each kind of item to lie in the main region; tags never count for it."""
    inside: dict[str, float] = {}
    total: dict[str, float] = {}
    for page in pages:
        head, _, rest = page.partition("{")
        main, _, tail = rest.partition("}")
        n_head, n_main = len(parts_of(head)), len(parts_of(head + main))
        for i, p in enumerate(parts_of(head + main + tail)):
            n = p.words if p.text and p.words else 1
            total[p.kind] = total.get(p.kind, 0) + n
            inside[p.kind] = inside.get(p.kind, 0) + n * (n_head <= i < n_main)
    out = {}
    for kind, n in total.items():
        odds = math.log((inside[kind] + 0.5) / (n - inside[kind] + 0.5))
        out[kind] = min(odds / 8, -0.02) if kind[0] == "<" else odds
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the run with the largest sum; the earliest and longest of equals; (0, 0) if none is positive."""
    best = total = 0.0
    start, found = 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best > 0 and found[0] == start:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a page: one line for each block, empty if there is none."""
    if not page:
        return ""
    parts = parts_of(page)
    scores = []
    for p in parts:
        w = weights.get(p.kind, -0.05 if p.kind[0] == "<" else -0.5)
        if p.kind[0] == "<":
            # tags of unwanted parts are bridged: what they cost lies in their words
            scores.append(min(w, -0.001) if p.main else -0.001)
        elif p.kind in ("word", "link"):
            scores.append(p.words * max(w, 0.5 if p.kind == "word" else 0.2))
        else:
            # unwanted parts inside an article are left out, but do not end its region
            scores.append(0.0 if p.kind in ("raw", "dropped") else p.words * min(w, -0.1))
    start, end = best_run(scores)
    blocks, line = [], []
    for p in parts[start:end]:
        if p.breaks:
            blocks.append("".join(line))
            line = []
        elif p.main and p.text:
            line.append(p.text)
    blocks.append("".join(line))
    lines = [SPACE.sub(" ", x).strip() for x in blocks]
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each page.

    A null or empty html, or a page of markup alone, gives an empty text. Pages
    may be cut off anywhere. Repeated rows give a row each; other columns are
    not read. One pass without a shuffle; a page is handled whole.
    """
    weights = fit_weights()

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py(), weights) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
