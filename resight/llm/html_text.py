"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Scripts, styles and markup go; so do controls such as buttons, and
navigation, headers, footers, asides and elements with a class, id or role that names them as such, unless
such an element holds the page's only ``<article>`` or ``<main>``, or nearly all of the good text. Pass one
decides the other blocks by length, stop-word density and link density. Pass two gives blocks too short or too
unclear to decide the label of the nearest decided block (before and after; on a draw the later one).
``<article>`` and ``<main>`` are one feature among these: the limits are lower inside and higher outside, labels do
not pass from one side to the other, and where a side has none, its blocks are good only inside. If the marked
part holds little of the good text, the page is taken as one without marks. Where stop words say nothing (other letters, or
a page with hardly any of them), length and link density decide alone; without spaces between words, characters count.
Short notes of copyright go, and no neighbour follows them.

Cases: null or empty html gives empty text; unclosed tags end with their container; a cut-off tag at the end is
markup; repeated rows come out alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 10  # words: shorter blocks are not decided in pass one
STOP_DENSITY = 0.15
LINK_DENSITY = 0.4
INSIDE = (0.08, 0.6)  # stop-word and link density inside article or main
OUTSIDE = (0.2, 0.2)  # the same outside, on pages that have one
LITTLE = 0.3  # share of the good words that the marked part must hold
FEW = 0.03  # stop-word density of a page whose language the stop words do not know
MOST = 0.8  # share of the good words that frees a skipped element

# Frequent function words of English, German, French, Spanish.
STOP_WORDS = frozenset(
    "the of and to in is that for it was with as on are by this be at from or an have not but they "
    "der die und das ist nicht ein eine zu den von mit sich des auf im dem als auch es an bei oder "
    "le la les et de des un une que qui est dans pour sur pas par au avec ce il elle du en aux "
    "el los las y en que del se por con para una no su lo como más al".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
SKIPPED_TAGS = frozenset(
    "head title button select textarea input label option noscript iframe object svg canvas template audio video map".split()
)
SIDE_TAGS = frozenset("nav footer aside menu dialog".split())
RAW_TAGS = ("script", "style", "textarea", "template", "noscript", "iframe", "svg", "title")
_LATIN = "\u024f"  # the last letter of extended Latin
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social sidebar side "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar comment comments "
    "disqus reply replies respond related recommended widget toolbar skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
# As in browsers, a quote opens a value only behind "=", and a tag without an end runs to the end of the page. Each
# quantifier is possessive or fails at once, so a page is read in linear time.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TAGS}
# Thai, Lao, Myanmar, Khmer, kana and Han put no spaces between words, so each character counts.
_WORD = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]|\w+")
_RIGHTS = re.compile(r"\W*(?:©|\(c\)|copyright\W+(?:©|\(c\)|\d{4})).*|.*all rights reserved\W*", re.I | re.S)


@dataclass
class Block:
    inside: bool  # of article or main
    sides: tuple[int, ...] = ()  # side elements around
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _named_out(attributes: str) -> bool:
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "role":
            if value in _ROLES:
                return True
        elif name in ("class", "id") and not SKIPPED_NAMES.isdisjoint(value.split()):
            return True
    return False


@dataclass
class Side:
    """A side element, which is skipped unless freed."""

    inside: bool  # of article or main
    holds: bool = False  # an article or main


def blocks(page: str) -> tuple[list[Block], list[Side], bool]:
    """The blocks outside skipped elements, in page order, the side elements, and whether an article is in none of them."""
    out, open_, sides = [], [], []  # open_: (tag, skipped, main, side) of the elements around
    skipped = mains = links = 0
    around: list[int] = []
    marked = False
    now = Block(False)

    def fresh() -> None:
        nonlocal now
        now = Block(mains > 0, tuple(around))

    def end() -> None:
        if now.parts:
            out.append(now)
        fresh()

    def add(text: str) -> None:
        if text and not skipped:
            now.parts.append(text)
            if links:
                now.linked += len(text)

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        closed = m[3].rstrip().endswith("/")
        if tag in BLOCK_TAGS:
            end()
        if m[1]:
            if any(t == tag for t, *_ in open_):
                if any(side for *_, side in open_[max(i for i, o in enumerate(open_) if o[0] == tag) :]):
                    end()
                while True:
                    t, s, a, side = open_.pop()
                    skipped, mains, links = skipped - s, mains - a, links - (t == "a")
                    if side:
                        around.pop()
                    if t == tag:
                        break
                if tag in BLOCK_TAGS or len(around) != len(now.sides):
                    fresh()
        elif tag == "svg" and closed:
            continue
        elif tag in _RAW_END:
            stop = _RAW_END[tag].search(page, at)
            at = stop.end() if stop else len(page)
        elif tag not in VOID_TAGS and not closed:
            main = tag in ("article", "main")
            skip = tag in SKIPPED_TAGS
            # a header outside the article is the site's; inside it is the article's own
            side = tag in SIDE_TAGS or (tag == "header" and not mains) or (tag not in ("html", "body") and not main and _named_out(m[3]))
            if side:
                end()
                around.append(len(sides))
                sides.append(Side(mains > 0))
            if main and not skipped:
                marked |= not around
                for i in around:
                    sides[i].holds = True
            open_.append((tag, skip, main, side))
            skipped, mains, links = skipped + skip, mains + main, links + (tag == "a")
            if tag in BLOCK_TAGS or side:
                fresh()
    add(page[at:])
    end()
    return out, sides, marked


@dataclass
class _Words:
    n: int
    stops: float
    links: float
    foreign: bool = False  # in letters that no stop word has
    rights: bool = False  # a short note of copyright


def _measure(b: Block) -> _Words:
    text = b.text()
    words = [w.lower() for w in _WORD.findall(text)]
    n = len(words)
    return _Words(
        n,
        sum(w in STOP_WORDS for w in words) / n if n else 0.0,
        b.linked / max(len(text), 1),
        2 * sum(w[0] > _LATIN for w in words) > n,
        n < 2 * SHORT and _RIGHTS.fullmatch(text) is not None,
    )


def _mute(sizes: list[_Words]) -> bool:
    """Whether the stop words say nothing about a page: its unlinked blocks hold hardly any of them."""
    some = [w for w in sizes if w.n >= SHORT and w.links <= LINK_DENSITY]
    return sum(w.stops * w.n for w in some) < FEW * sum(w.n for w in some)


def _decide(found: list[Block], sizes: list[_Words], marked: bool) -> list[bool | None]:
    decided: list[bool | None] = []
    mute = _mute(sizes)
    for b, w in zip(found, sizes, strict=True):
        inside = marked and b.inside
        stops, links = INSIDE if inside else OUTSIDE if marked else (STOP_DENSITY, LINK_DENSITY)
        if w.rights:
            decided.append(None)
        elif w.links > links and not (inside and w.n < SHORT and w.links <= 0.9):
            decided.append(False)
        elif w.n >= SHORT * (2 if marked and not inside else 1) and w.stops >= stops:
            decided.append(True)
        elif w.n >= 2 * SHORT and (mute or w.foreign) and (inside or not marked):
            decided.append(True)
        elif w.n >= 3 * SHORT and not inside:  # inside it may be a list or a language without known stop words
            decided.append(w.stops >= stops / 3 and not marked)
        else:
            decided.append(None)
    return decided


def _inherit(found: list[Block], sizes: list[_Words], decided: list[bool | None], marked: bool) -> list[bool]:
    n = len(found)
    before, after = [None] * n, [None] * n
    for order, nearest in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[bool, int] = {}
        for i in order:
            side = marked and found[i].inside
            if decided[i] is not None:
                last[side] = i
            nearest[i] = last.get(side)
    out = []
    for i, d in enumerate(decided):
        if sizes[i].rights:
            d = False
        elif d is None:
            lo, hi = before[i], after[i]
            near = hi if lo is None or (hi is not None and hi - i <= i - lo) else lo
            d = decided[near] if near is not None else marked and found[i].inside
        out.append(bool(d))
    return out


def classify(found: list[Block], marked: bool) -> list[bool]:
    """Good or not for every block: rules first, then neighbours."""
    sizes = [_measure(b) for b in found]
    if marked:
        plain = _inherit(found, sizes, _decide(found, sizes, False), False)
        good = sum(w.n for w, g in zip(sizes, plain, strict=True) if g)
        held = sum(w.n for b, w, g in zip(found, sizes, plain, strict=True) if g and b.inside)
        if held < LITTLE * good:
            return plain
    return _inherit(found, sizes, _decide(found, sizes, marked), marked)


def _kept(page: str) -> tuple[list[Block], bool]:
    """The blocks in no side element, or only in freed ones, and whether any is marked."""
    found, sides, marked = blocks(page)
    free = {i for i, s in enumerate(sides) if s.holds and not s.inside and not marked}
    if sides:
        sizes = [_measure(b) for b in found]
        plain = _inherit(found, sizes, _decide(found, sizes, False), False)
        good = [(b, w.n) for b, w, g in zip(found, sizes, plain, strict=True) if g]
        total = sum(n for _, n in good)
        held = [0] * len(sides)
        for b, n in good:
            for i in b.sides:
                held[i] += n
        own = sum(n for b, n in good if b.inside and not b.sides)
        if total >= 3 * SHORT and own < 3 * SHORT:
            free |= {i for i, n in enumerate(held) if n > MOST * total}
    kept = [b for b in found if free.issuperset(b.sides)]
    return kept, any(b.inside for b in kept)


def main_text(page: str | None) -> str:
    found, marked = _kept(page or "")
    texts = [b.text() for b, good in zip(found, classify(found, marked), strict=True) if good]
    return " ".join(t for t in texts if t)


def extract(pages: DataFrame, keys: Sequence[str] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """Keys and ``text`` of every page."""
    schema = pages.select(*keys).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(texts, pa.string())], [*keys, "text"])

    return pages.select(*keys, F.col(html).cast("string").alias("_html")).mapInArrow(run, schema)
