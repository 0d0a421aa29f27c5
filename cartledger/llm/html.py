"""Main text of web pages as the maximum-scoring run of words and tags.

A page is a sequence of words and tags. A word scores by where it stands: by the innermost
element around it, or class or id of one, that tells content from the rest. Tags cost. The
weights are log-odds counted on labelled pages, which are those that mark their article
themselves, with pseudo-counts for names whose meaning is common knowledge. One linear scan
finds the contiguous region with the largest score; what stands in it inside an element
that tells of other matter, such as an advert within an article, is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartledger.llm.common import quoted

#: Labelled pages that the weights are counted on, about; pages may be any number.
MAX_LABELLED = 5_000
#: Log-odds from which a name tells.
TELLS = 1.0
MOST, LEAST = 4.0, -1.0
#: The most that a tag costs: a lone word of an article must outweigh the tags around it.
TAG_COST = 0.75
#: A word where nothing tells.
NEUTRAL = 0.5
PSEUDO = 50.0
#: The share of the marked words that stands in a wrapper of the article.
ALL = 0.98

# Names whose meaning is common knowledge.
CONTENT_NAMES = frozenset("article main content post entry story articlebody maincontent".split())
OTHER_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer aside sidebar widget form button select "
    "label fieldset dialog notice cookie cookies consent banner alert popup modal newsletter "
    "subscribe ad ads advert adverts advertisement sponsor sponsored promo comments comment "
    "respond disqus reply replies related recommended share sharing social breadcrumb "
    "breadcrumbs pagination pager skip copyright legal login search toolbar tags".split()
)
_FIXED = dict.fromkeys(CONTENT_NAMES, 1.0) | dict.fromkeys(OTHER_NAMES, -1.0)
_LABELS = frozenset(("article", "main"))
#: Elements whose content is no markup, and the head.
_RAW = frozenset("script style iframe head title textarea noframes noembed xmp".split())
#: Elements that hold markup but nothing to read. Those that are closed are skipped whole; one
#: left open ends with its parent and is other matter, but for an article that starts in it.
_HIDDEN = frozenset("noscript template object svg select datalist optgroup option audio video canvas".split())
#: Elements that end an ``svg`` left open, as in browsers.
_ENDS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mspace mfenced "
    "mpadded mphantom menclose mmultiscripts merror semantics annotation".split()
)
#: Parts of tables, of which even a short row has many.
_TABLE = frozenset("tr td th thead tbody tfoot caption colgroup col".split())
#: Elements that lay out content and other matter alike, so their names never tell.
_LAYOUT = frozenset("a div section span ul ol dl table center figure details summary blockquote pre address".split())
_UNTRACKED = _VOID | frozenset("p li dt dd tr td th thead tbody tfoot html body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)|<[!?/][^>]*+(?:>|\Z)", re.S
)
_STOP = re.compile("[>\"']")


def _rest(page: str, at: int, unclosed: set[str]) -> tuple[str, int]:
    """(what stands in a tag behind its name, where the tag is over); quoted values may hold ``>``.

    A quote that is never closed is none, and its tag ends at the first ``>``; ``unclosed`` keeps
    such quotes, so that the page is not searched for them again.
    """
    i = at
    while m := _STOP.search(page, i):
        if m[0] == ">":
            return page[at : m.start()], m.end()
        i = -1 if m[0] in unclosed else page.find(m[0], m.end()) + 1
        if i <= 0:
            unclosed.add(m[0])
            break
    end = page.find(">", at)
    return (page[at:], len(page)) if end < 0 else (page[at:end], end + 1)


#: One attribute after another, so that no text of a value is taken for a name.
_ATTRIBUTE = re.compile(
    r"[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?"
)
_PARTS = re.compile(r"[a-z]+")
#: First parts of a name that tell what is around an element or filed under, not what it is.
_QUALIFIERS = frozenset("no non not has have with without tag category cat".split())


def _names(tag: str, rest: str) -> list[tuple[str, ...]]:
    """The names of an element: its own, and by parts those in its class, id and role."""
    found = [(tag,)]
    for name, *values in _ATTRIBUTE.findall(rest):
        if name.lower() in ("class", "id", "role"):
            for word in "".join(values).lower().split():
                parts = tuple(_PARTS.findall(word))
                if parts and parts[0] not in _QUALIFIERS or parts == (word,):
                    # A word that is more than the one part is a compound also with one part.
                    found.append(parts if parts == (word,) or len(parts) > 1 else (*parts, ""))
    return found


class _Place:
    """An open element, with what its names and those around it say.

    ``label``: inside a marked article; ``link``: inside a link; ``verdict``: the weight of
    the deciding name of this element, 0 when none tells; ``worth``: the weight of a word
    here, by the innermost verdict; ``content``: whether an element around, or this one, is
    content by its verdict; ``hidden``: the innermost hidden element around, or
    itself, and ``closed`` whether it was closed. Each is known from the parent, so deep
    nesting costs nothing.

    The last telling name decides, and in a compound its last telling part. Parts of
    compounds that speak against an element do not count beside a name that speaks for it,
    unless it stands in other matter: an article is no sidebar for having one.
    """

    __slots__ = ("tag", "parent", "names", "label", "link", "verdict", "worth", "content", "hidden", "closed", "marked", "inside", "outside")

    def __init__(
        self, tag: str, names: list[tuple[str, ...]], parent: _Place | None, weights: dict[str, float]
    ):
        self.tag, self.names, self.parent = tag, names, parent
        self.label = bool(parent and parent.label) or any(len(n) == 1 and n[0] in _LABELS for n in names)
        self.link = bool(parent and parent.link) or tag == "a"
        self.worth = parent.worth if parent else NEUTRAL
        self.hidden, self.closed = self if tag in _HIDDEN else parent and parent.hidden, False
        if self.hidden is self:
            self.names = names = []
            self.worth = LEAST
        told = []
        for parts in names:
            for part in reversed(parts):
                w = weights.get(part, 0.0)
                # The header of an article is its headline.
                if abs(w) >= TELLS and not (part == "header" and (self.label or self.worth > NEUTRAL)):
                    told.append((w, len(parts) > 1))
                    break
        if self.worth > 0 and any(w > 0 for w, _ in told):
            told = [(w, compound) for w, compound in told if w > 0 or not compound]
        self.verdict = told[-1][0] if told else 0.0
        if told:
            self.worth = max(self.verdict, LEAST)
        self.content = bool(parent and parent.content) or self.verdict > 0
        self.marked = self.inside = self.outside = 0


def runs(page: str, weights: dict[str, float]) -> list[tuple[str, str, _Place, int]]:
    """(text, break before it, its place, block and link tags since the last text).

    The break is a space after a block element and nothing after an inline one. Raw and
    hidden elements, comments and the head are skipped; elements left open end with their
    parent. Tags within hidden elements are not counted.
    """
    found = []
    place = _Place("", [], None, weights)
    open_tags: Counter[str] = Counter()
    hidden: list[_Place] = []
    unclosed: set[str] = set()
    quotes: set[str] = set()
    at, gap, tags = 0, "", 0
    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None or m.start() > at:
            found.append((page[at : m.start() if m else end], gap, place, tags))
            gap, tags = "", 0
            if m is None:
                break
        at = m.end()
        if m["name"] is None:
            continue
        name, closing = m["name"].lower(), m["close"]
        rest, at = _rest(page, at, quotes)
        if name not in _INLINE:
            gap = " "
        if not place.hidden and name not in _TABLE and (name not in _INLINE or name == "a"):
            tags += 1
        if name in _RAW and not closing:
            if not rest.endswith("/"):
                over = None
                if name not in unclosed:
                    over = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                if over is None:
                    unclosed.add(name)
                    if name in ("head", "title"):
                        continue  # never closed: what follows is the page
                at = over.end() if over else end
            continue
        if open_tags["svg"] and not closing and name in _ENDS_SVG and not open_tags["foreignobject"]:
            place = _closed("svg", place, open_tags)
        if name in _UNTRACKED:
            continue
        if closing:
            # Without an open element of this name the tag closes nothing.
            if open_tags[name]:
                place = _closed(name, place, open_tags, True)
            continue
        if name in _INLINE and name != "a":
            continue
        if name in _HIDDEN:
            if rest.endswith("/"):
                continue
            # An option ends the one before.
            while name in ("option", "optgroup") and place.tag in ("option", name):
                place = _closed(place.tag, place, open_tags)
        open_tags[name] += 1
        place = _Place(name, _names(name, rest), place, weights)
        if place.hidden is place:
            hidden.append(place)
    for p in hidden:  # outer ones first
        outer = p.parent.hidden
        p.closed = p.closed or bool(outer and outer.closed)
    shown, gap, tags = [], "", 0
    for text, before, place, passed in found:
        gap, tags = gap or before, tags + passed
        if place.hidden and place.hidden.closed:
            gap = " "
        else:
            shown.append((text, gap, place, tags))
            gap, tags = "", 0
    return shown


def _closed(name: str, place: _Place, open_tags: Counter[str], own_tag: bool = False) -> _Place:
    """The place around the innermost open element ``name``, which ends with all in it."""
    while True:
        inner, place = place, place.parent
        open_tags[inner.tag] -= 1
        if inner.tag == name:
            inner.closed = own_tag
            return place


def main_text(page: str | None, weights: dict[str, float], tag_cost: float) -> str:
    """The text of the best region; empty when nothing scores above 0."""
    found = runs(page or "", weights)
    best = total = 0.0
    start = first = last = 0
    for i, (text, _, place, tags) in enumerate(found):
        gain = len(text.split()) * place.worth
        cost = tag_cost * tags
        if place.content:
            # What is left out of content, such as an advert, takes nothing from it.
            if gain <= 0:
                gain = cost = 0.0
        elif gain > 0 and place.link:  # links stand in menus as elsewhere
            gain = 0.0
        if total - cost <= 0:
            start, total = i, gain
        else:
            total += gain - cost
        if total > best:
            best, first, last = total, start, i + 1
    parts = []
    for text, gap, place, _ in found[first:last]:
        parts += (gap, text) if place.worth > 0 else (" ",)
    return " ".join(unescape("".join(parts)).split())


def _tally(page: str) -> tuple[dict[str, list[int]], int, int]:
    """Words (inside, outside) marked articles around which each name stands; the tags and
    the words inside.

    Matter that is none by its name counts as outside, unless as good as all that is marked
    on the page, or in the article around it, stands in it: then the page speaks against
    the name. The header of an article does not count for headers.
    """
    found = runs(page, _FIXED)
    places: dict[int, _Place] = {}
    children: Counter[int] = Counter()
    for text, _, place, _ in found:
        if place.label:
            place.marked += len(text.split())
        while place is not None and id(place) not in places:
            places[id(place)] = place
            place = place.parent
            if place:
                children[id(place)] += 1
    # From the innermost outwards, a place after all those in it.
    order = [p for i, p in places.items() if not children[i]]
    for p in order:
        if p.parent:
            p.parent.marked += p.marked
            children[id(p.parent)] -= 1
            if not children[id(p.parent)]:
                order.append(p.parent)
    # (marked words around, whether it is other matter) of each place, outer ones first.
    state: dict[int, tuple[int, bool]] = {}
    for p in reversed(order):
        whole, other = state[id(p.parent)] if p.parent else (p.marked, False)
        other = other or (p.verdict < 0 and p.marked < ALL * whole)
        outermost = p.label and not (p.parent and p.parent.label)
        state[id(p)] = (p.marked if outermost else whole, other)
    tags_inside = words_inside = 0
    for text, _, place, tags in found:
        n = len(text.split())
        if place.label and not state[id(place)][1]:
            place.inside += n
            words_inside += n
            tags_inside += tags
        else:
            place.outside += n
    sums: dict[str, list[int]] = {}
    for p in order:
        for name in {part for parts in p.names for part in parts} - ({"", "header"} if p.label else {""}):
            side = sums.setdefault(name, [0, 0])
            side[0] += p.inside
            side[1] += p.outside
        if p.parent:
            p.parent.inside += p.inside
            p.parent.outside += p.outside
    return sums, tags_inside, words_inside


def _counted(pages: DataFrame) -> DataFrame:
    """(name, inside, outside) words and (null, tags inside, words inside) of labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str | None, list[int]] = {None: [0, 0]}
            for value in batch.column(0):
                found, tags, words = _tally(value.as_py() or "")
                for name, (i, o) in [*found.items(), (None, (tags, words))]:
                    side = sums.setdefault(name, [0, 0])
                    side[0] += i
                    side[1] += o
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.string()),
                    pa.array([i for i, _ in sums.values()], pa.int64()),
                    pa.array([o for _, o in sums.values()], pa.int64()),
                ],
                names=["name", "inside", "outside"],
            )

    return pages.mapInArrow(run, "name string, inside long, outside long")


def learn(pages: DataFrame, html: str = "html", key: str = "page_id") -> tuple[dict[str, float], float]:
    """(weight of each name, cost of a tag) from a bounded sample of labelled pages.

    Without any labelled page the pseudo-counts alone decide.
    """
    labelled = pages.where(F.lower(quoted(html)).rlike(r"<(article|main)[\s>]"))
    n = labelled.count()
    if n > MAX_LABELLED:
        share = int(1_000_000 * MAX_LABELLED / n)
        labelled = labelled.where(F.pmod(F.xxhash64(quoted(key)), F.lit(1_000_000)) < share)
    sums = (
        _counted(labelled.select(quoted(html)))
        .groupBy("name").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
        .collect()  # the names of a bounded sample
    )
    counts = {r["name"]: (r["i"], r["o"]) for r in sums}
    tags, words = counts.pop(None, (0, 0))
    weights = {}
    for name in (counts.keys() | CONTENT_NAMES | OTHER_NAMES) - _LAYOUT:
        i, o = counts.get(name, (0, 0))
        i += 1 + PSEUDO * (name in CONTENT_NAMES)
        o += 1 + PSEUDO * (name in OTHER_NAMES)
        # The pseudo-counts of a known name give way to many words that say otherwise.
        weights[name] = float(np.clip(np.log(i / o), -MOST, MOST))
    # Inside articles a tag pays for itself after half the words that come between two.
    return weights, float(np.clip(0.5 * NEUTRAL * words / tags, 0.1, TAG_COST)) if tags else TAG_COST


def extract(
    pages: DataFrame, html: str = "html", key: str = "page_id", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """(key, kept columns, text, n_chars) of every row, with weights learned from the table.

    A null or empty page has empty text. Every row is read by itself: repeated rows give
    equal rows, null keys and urls stay null, other columns are not read.
    """
    weights, cost = learn(pages, html, key)
    names = [key, *keep]
    inner = [f"k{i}" for i in range(len(names))]
    source = pages.select(*[quoted(c).alias(i) for c, i in zip(names, inner)], quoted(html).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py(), weights, cost) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*inner, "text", "n_chars"],
            )

    schema = source.drop("h").schema.add("text", "string").add("n_chars", "long")
    return source.mapInArrow(run, schema).toDF(*names, "text", "n_chars")
