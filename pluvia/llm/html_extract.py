"""Main-text extraction by a linear-chain CRF over DOM leaf blocks.

A page becomes the sequence of its leaf blocks: runs of text under one block element.
Each block has features of its ancestor tags, their class and id words, and its text.
The chain's two labels are main text and the rest; it is trained on labelled pages and
decoded by Viterbi.  Pages that mark their article (an <article> or <main> element) are
labelled by it; half of them are learned without that mark's own feature, so that other
tags and the text carry weight for pages that have none.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices

# Expected number of pages the CRF is fitted on, at most.
FIT_PAGES = 1500
# Blocks of a page taken as one chain while fitting; longer pages give several chains.
FIT_CHAIN = 400

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas title textarea".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "label legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"button", "label", "legend", "option", "optgroup"}
# An element that begins also ends an open one of these (up to the bound).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, set()),
}
SIDE_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset search label".split())
MAIN_TAGS = frozenset("article main".split())
MARKED = r"(?i)<(article|main)[\s/>]"  # pages that may mark their article
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline "
    "comment comments consent cookie cookies copyright cta discussion disqus dropdown feedback foot "
    "footer footnav form gdpr head header links login masthead menu menubar message modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promoted promotion "
    "rail reader reactions recommend recommended related replies reply respond responses search share "
    "sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags toc "
    "toolbar topbar trending warning widget widgets".split())
MAIN_WORDS = frozenset("article articlebody content entry main maincontent post story".split())

_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in
            ("script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "title", "textarea")}
_STOP, _SPECIAL = re.compile(r"[\s/>]"), re.compile("[>\"']")


class _Scanner:
    """The markup of a page in order.  Whatever a failed search has shown (no ``>`` or quote
    beyond a place, no tag's end from a place) is kept, so unclosed tags and quotes do not
    make later ones search the rest of the page again."""

    def __init__(self, page: str):
        self.page = page
        self.absent: dict[str, int] = {}  # what has no occurrence from a place on
        self.failed: set[int] = set()     # places outside quotes from which no tag ends
        self.name = (0, 0)                # a stretch without an end of a name

    def find(self, what: str, at: int) -> int:
        if at >= self.absent.get(what, len(self.page) + 1):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.absent[what] = at
        return found

    def name_end(self, at: int) -> int:
        if not self.name[0] <= at < self.name[1]:
            found = _STOP.search(self.page, at)
            self.name = at, found.start() if found else len(self.page)
        return self.name[1]

    def tag_end(self, at: int) -> int:
        """After the ``>`` that closes a tag whose attributes begin at ``at``; -1 without."""
        met, page = [], self.page
        while at < self.absent.get("special", len(page) + 1):
            found = _SPECIAL.search(page, at)
            if not found:
                self.absent["special"] = at
                break
            at = found.start()
            if page[at] == ">":
                return at + 1
            if at in self.failed:
                break
            met.append(at)
            at = self.find(page[at], at + 1) + 1
            if not at:
                break
        self.failed.update(met)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        """(start, end, is an end tag, tag or None, attributes) of all markup."""
        page, size = self.page, len(self.page)
        at = page.find("<")
        while at >= 0:
            end, closing, tag, attributes = -1, False, None, ""
            if page.startswith("<!--", at):
                end = self.find("-->", at + 4) + 3
                end = end if end > 2 else size
            elif page[at:at + 9].upper() == "<![CDATA[":
                end = self.find("]]>", at + 9) + 3
                end = end if end > 2 else size
            else:
                closing = page.startswith("/", at + 1)
                start = at + 1 + closing
                if start < size and page[start].isascii() and page[start].isalpha():
                    stop = self.name_end(start + 1)
                    end = self.tag_end(stop)
                    if end >= 0:
                        tag, attributes = page[start:stop].lower(), page[stop:end - 1]
                        if not closing and tag in _RAW_END and stop < size:
                            close = _RAW_END[tag].search(page, end)
                            end, tag = close.end() if close else size, None
                if end < 0 and page[at + 1:at + 2] in ("!", "?", "/"):
                    end = self.find(">", at + 2) + 1 or -1
            if end >= 0:
                yield at, end, closing, tag, attributes
                at = page.find("<", end)
            else:
                at = page.find("<", at + 1)


_NAMED = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WITH = ("has-", "with-", "no-", "has_", "with_", "no_")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _names(attributes: str) -> set[str]:
    """The lower-case words of an element's class, id and role names; names that only say
    what the element comes with (``has-sidebar``) tell nothing about it."""
    if "=" not in attributes:
        return set()
    return {part.lower() for groups in _NAMED.findall(attributes)
            for name in "".join(groups).split() if not name.lower().startswith(_WITH)
            for part in (*_PARTS.findall(name), *re.split(r"[_-]+", name)) if part}


class Block(NamedTuple):
    text: str
    in_link: bool        # an ancestor is a link
    place: str           # the innermost telling ancestor: "main", "side" or ""
    side_name: bool      # some ancestor is named like page furniture
    main_name: bool
    marked: bool         # inside the page's own article element
    links: int           # characters inside links
    element: str         # the block element the text stands in


class _Open(NamedTuple):
    """An open element, with what its ancestors and itself say about the text inside."""
    tag: str
    in_link: bool
    place: str
    side_name: bool
    main_name: bool
    marked: bool
    element: str
    in_head: bool


_OUTSIDE = _Open("", False, "", False, False, False, "", False)
_SCOPES = frozenset(("table", "article", "section", "body"))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; scripts, styles and the like hold none."""
    stack: list[_Open] = [_OUTSIDE]
    where: dict[str, list[int]] = {}  # places of each tag in the stack, ascending
    out: list[Block] = []
    text: list[str] = []
    links = 0

    def close_block() -> None:
        nonlocal links
        joined = "".join(text)
        text.clear()
        clean = " ".join(joined.split())
        if clean:
            top = stack[-1]
            out.append(Block(clean, top.in_link, top.place, top.side_name, top.main_name, top.marked, links, top.element))
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if stack[-1].in_head:
            return
        value = html.unescape(raw) if "&" in raw else raw
        text.append(value)
        if stack[-1].in_link:
            links += len(value.strip())

    def cut(i: int) -> None:
        while len(stack) > i:
            where[stack.pop().tag].pop()

    at = 0
    for start, end, closing, tag, attributes in _Scanner(page):
        if start > at:
            add(page[at:start])
        at = end
        if tag is None or tag in RAW:
            continue
        if closing:
            if where.get(tag):
                i = where[tag][-1]
                if any(s.tag in BLOCK for s in stack[i:]):
                    close_block()
                cut(i)
            continue
        if tag in BLOCK:
            close_block()
            ended, bound = CLOSES.get(tag, (set(), set()))
            if tag in ENDS_P:
                ended = ended | {"p"}
            # The open elements above the innermost bound that this one ends, and all in them.
            low = max((where[t][-1] for t in (*bound, *_SCOPES) if where.get(t)), default=0)
            first = [places[k] for t in ended if (places := where.get(t))
                     and (k := bisect_right(places, low)) < len(places)]
            if first:
                cut(min(first))
        elif tag == "br":
            text.append(" ")
        if tag in VOID:
            continue
        up = stack[-1]
        names = _names(attributes) if attributes else set()
        own_side = not names.isdisjoint(SIDE_WORDS) and tag not in ("html", "body")
        own_main = not names.isdisjoint(MAIN_WORDS)
        place = up.place
        if tag in SIDE_TAGS or own_side:
            place = "side"
        elif tag in MAIN_TAGS and place != "side":
            place = "main"
        where.setdefault(tag, []).append(len(stack))
        stack.append(_Open(tag, up.in_link or tag == "a", place, up.side_name or own_side, up.main_name or own_main,
                           up.marked or tag in MAIN_TAGS, tag if tag in BLOCK else up.element,
                           up.in_head or tag == "head" and len(stack) <= 3))
    if at < len(page):
        add(page[at:])
    close_block()
    return out


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEATURES = ["bias", "main", "side", "side name", "main name", "in link", "paragraph", "heading",
            "words 1", "words 2-5", "words 6-15", "words 16-40", "words 41+", "sentence end",
            "commas", "mostly links", "some links", "many capitals", "digits"]
_INDEX = {name: i for i, name in enumerate(FEATURES)}


def features(page: list[Block], use_mark: bool = True) -> np.ndarray:
    """(blocks, FEATURES) of 0 and 1; without ``use_mark`` the article element is unseen.

    A block's own place in the page and elements that one template may use for one purpose
    only (lists, divisions) are no features, so that they are not learned as its mark.
    """
    x = np.zeros((len(page), len(FEATURES)), np.uint8)
    for i, b in enumerate(page):
        n = b.text.count(" ") + 1
        share = b.links / len(b.text)
        size = "1" if n < 2 else "2-5" if n < 6 else "6-15" if n < 16 else "16-40" if n < 41 else "41+"
        on = {"bias": True, "main": b.place == "main" and use_mark, "side": b.place == "side",
              "side name": b.side_name, "main name": b.main_name and use_mark,
              "in link": b.in_link, "paragraph": b.element == "p", "heading": b.element in HEADINGS,
              f"words {size}": True, "sentence end": b.text[-1] in ".!?…\"”»", "commas": ", " in b.text,
              "mostly links": share > 0.5, "some links": 0 < share <= 0.5,
              "many capitals": n > 1 and sum(w[:1].isupper() for w in b.text.split()) > 0.6 * n,
              "digits": any(c.isdigit() for c in b.text)}
        x[i, [_INDEX[k] for k, v in on.items() if v]] = 1
    return x


def labels(page: list[Block]) -> np.ndarray | None:
    """1 for blocks of the marked article outside its furniture; None without a mark."""
    if not any(b.marked for b in page):
        return None
    return np.array([b.marked and b.place == "main" for b in page], np.uint8)


class Crf(NamedTuple):
    state: np.ndarray       # (features, 2)
    transition: np.ndarray  # (2, 2)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def gradient(x: np.ndarray, y: np.ndarray, crf: Crf) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of one chain and its gradients, by the forward-backward algorithm."""
    e, t, n = x @ crf.state, crf.transition, len(x)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = e[0]
    for i in range(1, n):
        forward[i] = e[i] + _log_sum(forward[i - 1][:, None] + t, 0)
    for i in range(n - 2, -1, -1):
        backward[i] = _log_sum(t + (e[i + 1] + backward[i + 1])[None, :], 1)
    z = float(_log_sum(forward[-1], 0))
    p = np.exp(forward + backward - z)
    gold = np.eye(2)[y]
    pairs = np.exp(forward[:-1, :, None] + t + (e[1:] + backward[1:])[:, None, :] - z).sum(0) if n > 1 else 0
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1], y[1:]), 1)
    value = e[np.arange(n), y].sum() + t[y[:-1], y[1:]].sum() - z
    return float(value), x.T @ (gold - p), seen - pairs


def train(chains: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.1,
          decay: float = 1e-3) -> Crf:
    """Maximum likelihood by AdaGrad steps of one chain each, in the given order."""
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    sw, st = np.full_like(w, 1e-8), np.full_like(t, 1e-8)
    for _ in range(epochs):
        for x, y in chains:
            _, gw, gt = gradient(x.astype(float), y, Crf(w, t))
            gw -= decay * w
            sw += gw * gw
            st += gt * gt
            w += rate * gw / np.sqrt(sw)
            t += rate * gt / np.sqrt(st)
    return Crf(w, t)


def viterbi(x: np.ndarray, crf: Crf) -> np.ndarray:
    """The likeliest labels of a chain (ties: the rest before main text)."""
    e = (x @ crf.state).tolist()
    (t00, t01), (t10, t11) = crf.transition.tolist()
    a, b = e[0]
    back = []
    for e0, e1 in e[1:]:
        p0, p1 = b + t10 > a + t00, b + t11 > a + t01
        back.append((p0, p1))
        a, b = e0 + (b + t10 if p0 else a + t00), e1 + (b + t11 if p1 else a + t01)
    label = int(b > a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1], np.uint8)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
        fit_pages: int = FIT_PAGES) -> Crf:
    """Train on pages that mark their article, thinned by a hash of their id to an
    expected ``fit_pages`` of the pages whose html has such a tag.  Only the chains' features reach the driver.
    Without any marked page the chain keeps hand-set signs (places and names)."""
    rows = pages.where(F.col(html_col).rlike(MARKED)).select(F.col(html_col).alias("html"),
                                                           F.xxhash64(F.col(id_col), F.lit("crf")).alias("draw"))
    total = rows.count()
    every = 1 << 32
    share = int(every * min(1, fit_pages / max(1, total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            out = []
            for page, draw in zip(part.column("html").to_pylist(), part.column("draw").to_pylist()):
                found = blocks(page)
                y = labels(found)
                if y is None:
                    continue
                x = features(found, use_mark=draw >= 0)
                out += [(draw + i, x[i:i + FIT_CHAIN].tobytes(), y[i:i + FIT_CHAIN].tobytes())
                        for i in range(0, len(y), FIT_CHAIN)]
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["draw", "x", "y"])

    def drawn(share: int) -> list:
        return (rows.where(F.pmod("draw", F.lit(every)) < share)
                .mapInArrow(run, "draw long, x binary, y binary").collect())

    chains = drawn(share)
    # The tag may stand in comments or scripts only: then more pages are looked at.
    while not chains and share < every:
        share = min(every, max(1, share) * 16)
        chains = drawn(share)
    if not chains:
        state = np.zeros((len(FEATURES), 2))
        state[_INDEX["bias"], 1] = 0.5
        for name in ("side", "side name", "mostly links"):
            state[_INDEX[name], 1] = -3
        return Crf(state, np.zeros((2, 2)))
    chains.sort(key=lambda r: (r.draw, bytes(r.x)))
    return train([(np.frombuffer(r.x, np.uint8).reshape(-1, len(FEATURES)), np.frombuffer(r.y, np.uint8))
                  for r in chains])


def main_text(page: str, crf: Crf) -> tuple[str, int]:
    """(main text, number of its blocks) of a page."""
    found = blocks(page)
    if not found:
        return "", 0
    kept = [b.text for b, y in zip(found, viterbi(features(found), crf)) if y]
    return " ".join(kept), len(kept)


def extract(pages: DataFrame, crf: Crf, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars`` (code points), ``n_blocks``.

    Character references are decoded, white space inside a block is one space, blocks are
    joined by one space.  Null or blank html, and pages without main text, give "".
    Nulls in the other columns stay; repeated rows repeat; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(tuple(crf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(*shared.value)
        for part in slices(batches, "html"):
            found = [main_text(page or "", crf) for page in part.column("html").to_pylist()]
            yield pa.record_batch(
                [part.column("page_id"), part.column("url"), pa.array([t for t, _ in found], pa.string()),
                 pa.array([len(t) for t, _ in found], pa.int64()),
                 pa.array([n for _, n in found], pa.int32())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks int")
