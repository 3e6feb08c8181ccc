"""Main text of web pages: flat text blocks classified by a decision tree.

Method.  A page is read once from left to right and cut into flat blocks of
text at every block-level tag; inline tags join their text without a space.  A
block's features are its number of words and its link density (the share of
its words inside links), those of the block before and after it, whether it is
a heading, and what encloses it: an article or main element, a menu, header,
footer, sidebar or form, or an element whose class, id, role or label surely
names something else than the article (an advert, a notice, reader comments,
...); inside an article only a whole class or role token is sure.  A name that
may mean either is one more feature, beside words and link densities.
A decision tree, trained by Gini impurity on the small labelled table below,
says for each block whether it is main text.

Scripts, styles, comments and the like never make a block.  Character
references are decoded per block; white space inside a block becomes one space;
the accepted blocks are joined by one space in page order.

Scale.  One pass over Arrow batches without a shuffle; a page is processed in
time and memory proportional to its length, and the tree goes to the tasks
with the function.

Defined cases.  Null or empty html gives the empty text; html without tags is
one block.  Unclosed tags end with their parent or the page (an unclosed script,
style, iframe, textarea or title hides the rest of the page, as in a browser),
an opening paragraph, block, list item, table part or option ends what HTML ends
there, stray closing tags are ignored, and a ``<`` that starts no tag is text.  Repeated pages give
repeated rows; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from curato.llm.common import freed, table

# -- blocks --------------------------------------------------------------------------

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*\Z"
    r"|<(?=[a-zA-Z])",      # a tag that the page does not end
    re.S | re.I)
# From then on, tags end at the next < or >, so no part of the page is read again and again.
_PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>|<[!?/][^<>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NAMING = frozenset("class id role aria-label".split())
# Elements without text of the page: what holds no tags runs to its end tag or the
# page's end, and of the others an unclosed one ends with its parent.
RAW = frozenset("script style iframe textarea title".split())
SKIPPED = frozenset("noscript template svg object select".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
# Start tags that end an svg, unless they lie in one of its parts that hold HTML.
BREAKOUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li
    listing menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var""".split())
SVG_HTML = ("foreignobject", "desc", "title")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LIGHT = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 thead tbody tfoot html body head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What HTML ends at a start tag: open elements of some kinds, as far out as the nearest that bounds them.
_BOX = frozenset("button caption table td th marquee applet".split()) | SKIPPED | frozenset(SVG_HTML)
_ITEM = _BOX | HEADINGS | frozenset("""article aside blockquote body center details dialog dir dl fieldset figcaption
    figure footer form frameset header hgroup html iframe listing main menu nav ol optgroup pre search section summary
    tbody tfoot thead tr ul""".split())
_TABLE = SKIPPED | frozenset(SVG_HTML) | {"table"}
BOUNDS = {"p": "in_box", "li": "in_list", "dt": "in_terms", "dd": "in_terms", "option": "in_list", "optgroup": "in_box",
          **dict.fromkeys("td th tr thead tbody tfoot caption".split(), "in_table"), **dict.fromkeys(HEADINGS, "in_box")}
_WITHIN = {"in_box": _BOX, "in_list": _ITEM | {"dd", "dt"}, "in_terms": _ITEM | {"li"}, "in_table": _TABLE}
KEYS = {tag: (tag, *(k for k, tags in _WITHIN.items() if tag in tags)) for tag in frozenset().union(*_WITHIN.values())}
_CELLS = ("td", "th", "caption")
_ROWS = ("tr", *_CELLS)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
        "td": _CELLS, "th": _CELLS, "tr": _ROWS,
        **dict.fromkeys("thead tbody tfoot caption".split(), ("thead", "tbody", "tfoot", *_ROWS))}
ENDS_P = HEADINGS | frozenset("""address article aside blockquote center dd details dialog dir div dl dt fieldset
    figcaption figure footer form header hgroup hr li listing main menu nav ol p pre search section summary table
    ul""".split())
INSIDE = frozenset("article main".split())
OUTSIDE = frozenset("nav footer aside form menu dialog button".split())
# Words of a class, id or role that name something else than the article.
OTHER = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted banner
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    comment comments commentlist respond disqus reply replies discussion nav navbar navigation menu menus breadcrumb
    breadcrumbs toolbar pagination pager tabs sidebar aside related recommended recommendations share sharing social
    widget widgets footer masthead topbar copyright legal search banner contentinfo complementary
    adsbygoogle adsense adslot adbox adcontainer cookiebanner cookiebar cookieconsent commentsection
    werbung werbeanzeige kommentar kommentare publicidad comentario comentarios publicite commentaires""".split())


# Of these, the ones that a page's layout element may carry around its article.
LAYOUT = frozenset("nav navbar navigation menu menus sidebar aside toolbar banner widget widgets share sharing".split())
# Of these, the ones that article text may as well be about or be called by.
AMBIGUOUS = frozenset("""adv alert aside banner consent copyright discussion legal login menu menus modal navigation
    notice notices overlay promo recommendations recommended related replies reply respond search share sharing signup
    social sponsor sponsors subscription tabs toolbar widget widgets""".split())
# Words that change nothing in a name made of them and the above.
FILLER = frozenset("""area articles bar block bottom box button buttons container content fixed form google icons inner
    item items js left link links list main module news outer page panel post posts reader readers region right section
    site slot sticky stories thread title top unit user users wrap wrapper zone""".split())
# Of the fillers, the ones that make the name of an ambiguous word sure (related-posts, share-buttons).
CONTROLS = frozenset("articles button buttons icons posts slot stories".split())
# Words that are sure as an id: no passage of an article is called so.
ID_SURE = frozenset("""ad ads adsbygoogle adsense adslot advert adverts comment comments commentaires commentlist
    commentsection comentarios cookieconsent disqus gdpr kommentare publicidad werbung""".split())
SKIP = -3   # place of what is inside a skipped element


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    place: int = 0       # 1 in the article, 0 nowhere, below 0 in something else
    heading: int = 0
    doubt: int = 0       # 1 in an element whose name may or may not mean something else
    form: int = 0        # the number of the form it lies in


def _names(tag: str, attributes: str, inside: bool) -> tuple[set[str], bool]:
    """What an element's names say: the words that surely name something else
    than the article, and whether a name leaves that in doubt.

    A name is a class or role token, an id or a label.  It is sure if it is made of
    words of ``OTHER`` and ``FILLER`` and one of them is not ambiguous, or stands beside a
    word for controls; outside an article also if it names a layout.  Inside an
    article a label is never sure, and an id, which may be the anchor of any passage, only
    on an element that holds blocks and for a word of ``ID_SURE``."""
    sure: set[str] = set()
    doubt = False
    for found in _ATTRIBUTE.findall(attributes):
        kind = found[0].lower()
        if kind not in NAMING:
            continue
        value = "".join(found[1:]).lower()
        for name in value.split() if kind in ("class", "role") else [value]:
            words = {w for w in re.split(r"[^a-z]+", name) if w}
            other = words & OTHER
            if not other:
                continue
            clear = words <= OTHER | FILLER
            if inside and kind == "id":
                clear = clear and bool(words & ID_SURE) and tag not in HEADINGS and tag not in INLINE and tag not in LIGHT
            elif inside and kind not in ("class", "role"):
                clear = False
            certain = not other <= (AMBIGUOUS if inside else AMBIGUOUS - LAYOUT) or bool(words & CONTROLS)
            if clear and (kind == "role" or certain):
                sure |= other
            else:
                doubt = True
    return sure, doubt


def _place(tag: str, attributes: str, outer: int) -> tuple[int, int]:
    """Where the content of an element lies, given where the element lies, and
    whether its names leave that in doubt: 1 in the article, 0 nowhere, -1 in
    something with a layout name (an article inside it is one all the same),
    -2 in something else."""
    if tag in SKIPPED or outer == SKIP:
        return SKIP, 0
    if outer == -2 or tag in OUTSIDE or tag == "header" and outer == 0:
        return -2, 0
    sure, doubt = _names(tag, attributes, outer == 1 or tag in INSIDE)
    if sure - LAYOUT:
        return -2, 0
    if tag in INSIDE:
        return 1, int(doubt)
    return -1 if sure else outer, int(doubt)


def blocks_of(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order.

    Some pages lie in one form.  A form that holds an article or main element, or more
    than half of the page's words, is no part of the page beside others, so it is read
    once more as a plain element."""
    out, articles = _read_blocks(page, frozenset())
    words = [len("".join(b.parts).split()) for b in out]
    per: dict[int, int] = dict.fromkeys(articles, 0)
    for b, n in zip(out, words, strict=True):
        if b.form:
            per[b.form] = per.get(b.form, 0) + n
    plain = frozenset(f for f, n in per.items() if f in articles or 2 * n > sum(words))
    return _read_blocks(page, plain)[0] if plain else out


def _read_blocks(page: str, plain_forms: frozenset[int]) -> tuple[list[Block], set[int]]:
    """The blocks, and the numbers (from 1, in page order) of the forms that hold an article
    or main element; the forms in ``plain_forms`` count as plain elements."""
    out: list[Block] = []
    articles: set[int] = set()
    forms, in_form = 0, 0                 # started so far; the number of the one that is open, or 0
    open_: list[tuple[str, int, int]] = []   # enclosing elements with the place of their content, and its doubt
    spots: dict[str, list[int]] = {}    # their positions in open_ by tag, and by what they bound
    block, link, heading = Block(), False, 0

    def place() -> int:
        return open_[-1][1] if open_ else 0

    def cut() -> None:
        nonlocal block
        if place() == SKIP:
            return
        if any(not p.isspace() for p in block.parts if p):
            out.append(block)
        block = Block(place=place(), heading=heading, doubt=open_[-1][2] if open_ else 0, form=in_form)

    def enter(tag: str, place: int, doubt: int = 0) -> None:
        for key in KEYS.get(tag, (tag,)):
            spots.setdefault(key, []).append(len(open_))
        open_.append((tag, place, doubt))

    def last(tag: str) -> int:
        """The position of the innermost open element of a tag, or -1."""
        found = spots.get(tag)
        return found[-1] if found else -1

    def close(to: int) -> None:
        """End the open elements from position ``to`` on."""
        nonlocal in_form
        while len(open_) > to:
            tag = open_.pop()[0]
            if tag == "form":
                in_form = 0
            for key in KEYS.get(tag, (tag,)):
                spots[key].pop()

    def end(*tags: str) -> None:
        """End the open elements of some kinds that nothing open bounds."""
        edge = last(BOUNDS[tags[0]])
        while (inner := max(map(last, tags))) > edge:
            close(inner)

    def text(part: str) -> None:
        if part and place() != SKIP:
            block.parts.append(part)
            if link:
                block.linked.append(part)

    at, tags = 0, _TAG
    while m := tags.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m[0] == "<":     # no end up to the end of the page
            at, tags = m.start(), _PLAIN_TAG
            continue
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1]), m[3] or ""
        if place() == SKIP:
            if last("svg") > max(map(last, SVG_HTML)) and (tag == "p" if closing else tag in BREAKOUT):
                while last("svg") > max(map(last, SVG_HTML)):
                    close(last("svg"))
            elif closing and tag in SKIPPED and last(tag) >= 0:
                close(last(tag))
                if tag == "select":
                    cut()
                continue
        in_svg = last("svg") > max(map(last, SVG_HTML))
        if tag in RAW and not closing and not in_svg:
            stop = _RAW_END[tag].search(page, at)
            at = stop.end() if stop else len(page)
            if tag in ("textarea", "title"):
                cut()
            continue
        if place() == SKIP or tag in SKIPPED:
            if not closing:
                if tag in ("noscript", "select") and last(tag) >= 0:
                    close(last(tag))   # it cannot hold itself
                if not (attributes.endswith("/") or tag in VOID or tag in INLINE):
                    if tag == "select":
                        cut()
                    enter(tag, SKIP)
                continue
            if last(tag) < 0:
                continue
            if open_[last(tag)][1] == SKIP:
                close(last(tag))
                continue
        if tag == "a":
            link = not closing
            continue
        if tag in INLINE:
            if not closing and "=" in attributes and _place(tag, attributes, place())[0] < min(0, place()):
                cut()   # a named inline element is a block of its own
                enter(tag, -2)
                block.place = -2
            elif closing and open_ and open_[-1][0] == tag:
                close(len(open_) - 1)
                cut()
            continue
        if tag in HEADINGS:
            heading = 0 if closing else 1
        elif tag in ("p", "li", "div", "section"):
            heading = 0
        if not closing:
            if tag in ENDS:
                end(*ENDS[tag])
            if tag in ENDS_P:
                end("p")
            if tag in HEADINGS and open_ and open_[-1][0] in HEADINGS:
                close(len(open_) - 1)
        if tag in VOID:
            if tag in ("br", "hr"):
                cut()
            continue
        if closing:
            if tag in HEADINGS:
                inner = max(map(last, HEADINGS))
                if inner > last("in_box"):
                    close(inner)
            elif tag in BOUNDS:
                if last(tag) > last(BOUNDS[tag]):
                    close(last(tag))
            elif last(tag) >= 0:   # a stray closing tag has nothing to end
                close(last(tag))
            link = False
        elif not attributes.endswith("/"):
            outer, doubt = open_[-1][1:] if open_ else (0, 0)
            if tag in INSIDE and in_form:
                articles.add(in_form)
            if tag == "form" and in_form:
                continue                          # a form holds no other
            if tag == "form":
                forms += 1
                in_form = forms
                if in_form in plain_forms:
                    enter(tag, outer, doubt)
                    cut()
                    continue
            where, more = _place(tag, attributes, outer) if tag not in LIGHT or "=" in attributes else (outer, 0)
            if tag not in ("html", "body", "head") or where != outer and tag == "head":
                enter(tag, where, more if tag in INSIDE else doubt | more)
        cut()
    text(page[at:])
    close(0)
    cut()
    return out, articles


def block_text(block: Block) -> str:
    return " ".join(html.unescape("".join(block.parts)).split())


def features(blocks: Sequence[Block]) -> np.ndarray:
    """(blocks, 9): words, link density, both of the block before and after, place, heading, doubt."""
    words = np.array([len("".join(b.parts).split()) for b in blocks], dtype=np.float64)
    linked = np.array([len(" ".join(b.linked).split()) for b in blocks], dtype=np.float64)
    density = np.minimum(1, linked / np.maximum(1, words))
    pad = [np.concatenate([[0], x, [0]]) for x in (words, density)]
    return np.stack([words, density, pad[0][:-2], pad[1][:-2], pad[0][2:], pad[1][2:],
                     np.maximum(-1.0, [b.place for b in blocks]),
                     np.array([b.heading for b in blocks], dtype=np.float64),
                     np.array([b.doubt and b.place >= 0 for b in blocks], dtype=np.float64)], axis=1)


# -- the labelled table and the tree ---------------------------------------------------

# words, link density, words before, density before, words after, density after, place, heading, doubt: main text?
LABELLED = """
  30 0.00  25 0.00  40 0.00   1 0  0  1
   3 0.00   9 0.00  60 0.00   1 0  0  1
   1 0.00   0 0.00   0 0.00   1 0  0  1
   9 0.00   4 0.00  12 0.00   1 1  0  1
   2 0.00   6 1.00  80 0.00   1 1  0  1
 120 0.10  15 0.00  90 0.05   1 0  0  1
  45 0.40  30 0.00  22 0.10   1 0  0  1
   8 1.00  50 0.00  70 0.00   1 0  0  1
   4 1.00  12 0.10  35 0.00   1 0  0  1
   1 1.00  20 0.00   0 0.00   1 0  0  1
 300 0.00   0 0.00   0 0.00   1 0  0  1
  17 0.05   2 0.00   1 0.00   1 0  0  1
   6 0.00   5 1.00   7 0.00   1 0  0  1
  11 0.20  11 0.20  11 0.20   1 0  0  1
  14 0.00  30 0.00   4 1.00   1 0  0  1
   2 0.00   8 0.00   1 1.00   1 0  0  1
  70 0.00   3 1.00   5 1.00   1 0  0  1
   5 0.00   1 1.00   2 1.00   1 0  0  1
  40 0.00  22 0.00   3 0.80   1 0  0  1
   1 0.00   2 1.00   9 1.00   1 1  0  1
   3 0.00   0 0.00   6 1.00   1 1  0  1
  25 0.30   4 1.00   8 0.90   1 0  0  1
   9 0.00   7 0.60   6 0.70   1 0  0  1
 110 0.00   2 1.00   1 1.00   1 0  0  1
   4 1.00   5 1.00   3 1.00   1 0  0  0
   6 1.00   2 0.00   6 1.00   1 0  0  0
   2 1.00   4 1.00   2 1.00   1 0  0  0
   5 0.90   6 1.00   9 0.95   1 0  0  0
  35 0.00  30 0.00  30 0.00  -1 0  0  0
   4 0.00   2 1.00  60 0.00  -1 0  0  0
   1 1.00   1 1.00   1 1.00  -1 0  0  0
   2 1.00   0 0.00   3 1.00  -1 0  0  0
  12 0.00   1 1.00   9 0.00  -1 0  0  0
   8 0.00  90 0.00   0 0.00  -1 0  0  0
   5 0.00  10 0.00  40 0.00  -1 1  0  0
 150 0.00  80 0.00  60 0.00  -1 0  0  0
  20 0.50  10 0.50  20 0.50  -1 0  0  0
   3 0.00   8 0.00  14 0.10  -1 1  0  0
  40 0.00   2 0.00  90 0.00  -1 0  0  0
   1 0.00   0 0.00   2 0.00  -1 0  0  0
   3 0.00   0 0.00   0 0.00  -1 0  0  0
  16 0.00  20 0.00  18 0.00  -1 0  0  0
 400 0.05  30 0.00  20 0.00  -1 0  0  0
  60 0.00  45 0.00  70 0.00   0 0  0  1
   1 0.00   0 0.00   0 0.00   0 0  0  1
   4 0.00   0 0.00   0 0.00   0 0  0  1
   9 0.00   0 0.00   0 0.00   0 0  0  1
  25 0.05  60 0.00  30 0.00   0 0  0  1
  18 0.00  40 0.00  55 0.10   0 0  0  1
 200 0.10   3 0.00   2 1.00   0 0  0  1
  40 0.20  12 0.00   4 0.50   0 0  0  1
  12 0.00  35 0.00  45 0.00   0 0  0  1
  15 0.00  20 0.10  18 0.00   0 0  0  1
   8 0.00   3 1.00  70 0.00   0 1  0  1
   5 0.00  50 0.00  40 0.00   0 1  0  1
   4 0.00  30 0.00  65 0.00   0 0  0  1
  33 0.00   0 0.00   0 0.00   0 0  0  1
  80 0.30  50 0.20  70 0.00   0 0  0  1
   3 1.00   2 1.00   4 1.00   0 0  0  0
   1 1.00   0 0.00   1 1.00   0 0  0  0
   2 0.00   3 1.00   2 1.00   0 0  0  0
  10 1.00   8 1.00  12 0.90   0 0  0  0
  25 0.80  20 0.90  30 0.85   0 0  0  0
   4 0.00   2 0.00   3 0.00   0 0  0  0
   6 0.50   4 0.50   8 0.60   0 0  0  0
   3 0.00  40 0.00   2 1.00   0 0  0  0
   5 0.00   2 1.00   1 1.00   0 1  0  0
  12 0.70  60 0.00   3 1.00   0 0  0  0
   7 0.00   1 0.00   2 1.00   0 0  0  0
   4 1.00  50 0.00   0 0.00   0 0  0  0
  45 0.00  30 0.00  60 0.00   1 0  1  1
  12 0.00  40 0.00  20 0.00   1 0  1  1
   2 0.00  50 0.00  70 0.00   1 1  1  1
 120 0.10  15 0.00  90 0.05   1 0  1  1
   3 0.00  80 0.00   0 0.00   1 0  1  1
   1 0.00   0 0.00   0 0.00   1 0  1  1
  30 0.40  60 0.00  25 0.10   1 0  1  1
  60 0.00   2 0.00   4 1.00   1 0  1  1
  25 0.00   5 1.00   8 1.00   1 0  1  1
   4 1.00   5 1.00   3 1.00   1 0  1  0
   6 1.00   2 0.00   6 1.00   1 0  1  0
   8 1.00  40 0.00   0 0.00   1 0  1  0
   5 0.80  30 0.00  50 0.00   1 0  1  0
  12 0.75   3 1.00   9 0.90   1 0  1  0
   2 0.00  60 0.00   5 1.00   1 1  1  0
   3 0.00   4 1.00   2 1.00   1 0  1  0
  60 0.00  45 0.00  70 0.00   0 0  1  1
  25 0.00  30 0.00  40 0.00   0 0  1  1
 200 0.10   3 0.00   2 1.00   0 0  1  1
  18 0.00  35 0.00  45 0.00   0 0  1  1
   5 0.00  50 0.00  40 0.00   0 1  1  1
  35 0.00   0 0.00   0 0.00   0 0  1  1
   3 1.00   2 1.00   4 1.00   0 0  1  0
   8 0.70  60 0.00   3 1.00   0 0  1  0
  25 0.80  20 0.90  30 0.85   0 0  1  0
   6 0.00   1 0.00   2 1.00   0 0  1  0
   3 0.00   0 0.00   6 1.00   0 0  1  0
   2 0.00   2 1.00   5 1.00   0 1  1  0
"""
MIN_GAIN = 1e-9
MAX_DEPTH = 6
DOUBT = 8    # the tree's first test, so names in doubt change nothing for the others


@dataclass(frozen=True)
class Node:
    """A leaf (``value``) or a test: feature <= cut goes to ``low``."""

    value: float
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = MAX_DEPTH) -> Node:
    """A decision tree by Gini impurity; of equal splits the first feature and lowest cut win."""
    share = float(y.mean()) if len(y) else 0.0
    best, gain = None, MIN_GAIN
    if depth and 0 < share < 1:
        whole = share * (1 - share)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = x[:, f] <= cut
                a, b = y[low].mean(), y[~low].mean()
                got = whole - low.mean() * a * (1 - a) - (1 - low.mean()) * b * (1 - b)
                if got > gain + 1e-12:
                    best, gain = (f, float(cut), low), got
    if best is None:
        return Node(share)
    f, cut, low = best
    return Node(share, f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def judge(node: Node, x: np.ndarray) -> np.ndarray:
    """The tree's value for each row."""
    if node.feature < 0:
        return np.full(len(x), node.value)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x))
    out[low], out[~low] = judge(node.low, x[low]), judge(node.high, x[~low])
    return out


def train(labelled: str = LABELLED) -> Node:
    rows = np.array([line.split() for line in labelled.strip().splitlines()], dtype=np.float64)
    doubt = rows[:, DOUBT] > 0
    return Node(float(rows[:, -1].mean()), DOUBT, 0.5, grow(rows[~doubt, :-1], rows[~doubt, -1]),
                grow(rows[doubt, :-1], rows[doubt, -1]))


def main_text(page: str | None, tree: Node) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    kept = judge(tree, features(blocks)) >= 0.5
    return " ".join(t for t in (block_text(b) for b, k in zip(blocks, kept, strict=True) if k) if t)


def extract_pages(pages: DataFrame, tree: Node) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            texts = [main_text(page.as_py(), tree) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"), train())
