"""Main text of web pages by two passes over their blocks.

The first pass decides blocks by link density, length and the share of stop words. Short and
ambiguous blocks take the label of the nearest decided block in the second pass. Before both,
what the markup itself declares as no part of the article (menus, forms, hidden parts) is left
out. Names of classes and ids speak against an element (notices, adverts, comments, sidebars), but
an element that holds more of the article than what is left beside it stays, whatever its name.
"""

from __future__ import annotations

import dataclasses
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHORT = 70                  # characters below which a block decides nothing by itself
LINKED = 0.5                # share of characters in links from which a block is navigation
STOP_LOW, STOP_HIGH = 0.1, 0.2
FOREIGN = 0.2               # share of stop words below which a page is in none of the languages
FEW_LETTERS = 3             # there, words up to this length stand for stop words
MOST_NAMES = 16             # named elements around a block that are told apart

# Frequent function words of the languages of the corpus (fixed values).
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from
or had an they which one you were all her she there would their we him been has when who
de la le et les des en un une du que est pour qui dans par sur pas au plus ce avec il sont
se ne son ou mais nous aux ont leur cette der die und das den von zu mit sich auf ist für
nicht dem ein eine als auch es an werden aus er hat dass sie nach wird bei um am sind noch
wie einem über so zum el los las y del se por con no una su para al lo como más pero sus
o este entre cuando muy sin sobre también me hasta hay donde
""".split())

BLOCKS = frozenset("""
address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
section summary table tbody td tfoot th thead tr ul title head optgroup option select
""".split())
# elements whose text is never the article's
DROPPED = frozenset("""
nav footer aside form head title menu dialog select button textarea noscript template svg math
iframe object canvas audio video map datalist
""".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe", "template"])
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr blockquote pre figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# words in class, id or role that say the same
MARKS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors
promo promotion promoted cookie cookies consent gdpr notice notices notification popup modal
overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget
widgets footer header masthead topbar comment comments disqus replies reply respond share
sharing social related recommended recommendations newsletter subscribe subscription signup
login search pagination pager toolbar copyright disclaimer banner contentinfo complementary
""".split())
AREAS = frozenset(["article", "main"])

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""=\s*+(["'])|>""")
_ATTRIBUTE = re.compile(
    r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>]+)))?""")
_WORD = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"[a-z]+")
# Punctuation of scripts that are written without spaces (fixed values).
_UNSPACED = re.compile("[\u3001\u3002\uff0c\uff01\uff1f]")


@dataclasses.dataclass
class Block:
    text: str
    linked: int             # characters inside links
    area: int               # enclosing article, 0 outside
    good: bool | None = None
    named: tuple[int, ...] = ()     # enclosing elements that a name speaks against, outer first
    box: int = 0            # the element that the block's paragraph is in, if known


def _tag_stop(page: str, at: int) -> int:
    """The place of the `>` that ends a tag whose attributes begin at `at`; -1 if it is cut off.

    A quote after `=` opens a value of any length. If it is never closed, the next `>` ends value
    and tag. What was read is never read again, so that a page takes time linear in its length.
    """
    while m := _STOP.search(page, at):
        if not m[1]:
            return m.start()
        stop = page.find(m[1], m.end())
        if stop < 0:
            return page.find(">", m.end())
        at = stop + 1
    return -1


def _attributes(text: str) -> dict[str, str]:
    out = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


_IN, _NAMED, _OUT = 0, 1, 2


def _declared(tag: str, text: str, in_area: bool) -> int:
    """Whether an element is declared out: by its kind or as hidden, or only by a name."""
    if tag in DROPPED or tag == "header" and not in_area:
        return _OUT
    if not text or tag in ("html", "body", "main"):
        return _IN
    given = _attributes(text)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return _OUT
    if re.search(r"display\s*:\s*none", given.get("style", ""), re.I):
        return _OUT
    named = " ".join(given.get(k, "") for k in ("class", "id", "role")).lower()
    return _NAMED if named and not MARKS.isdisjoint(_MARK.findall(named)) else _IN


def blocks(page: str) -> list[Block]:
    """The blocks of a page that its markup does not declare out, in page order."""
    out: list[Block] = []
    # tag, declared out, area, named elements around, box
    open_: list[tuple[str, bool, int, tuple[int, ...], int]] = []
    depth: Counter[str] = Counter()                 # open elements by tag
    parts: list[str] = []
    linked, link_depth, areas, skipped, names, boxes = 0, 0, 0, 0, 0, 1
    at, end = 0, len(page)

    def area() -> int:
        return open_[-1][2] if open_ else 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                named, box = open_[-1][3:] if open_ else ((), 1)
                out.append(Block(text, linked, area(), named=named, box=box))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal skipped
        while len(open_) > upto:
            gone = open_.pop()
            depth[gone[0]] -= 1
            skipped -= gone[1]

    while at < end:
        start = page.find("<", at)
        stop = end if start < 0 else start
        if stop > at and not skipped:
            text = entities.unescape(page[at:stop]) if "&" in page[at:stop] else page[at:stop]
            parts.append(text)
            if link_depth:
                linked += len(text.strip())
        if start < 0:
            break
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        following = page[start + 1:start + 2]
        if following in ("!", "?"):
            stop = page.find(">", start)
            at = end if stop < 0 else stop + 1
            continue
        m = _TAG.match(page, start)
        if m is None:
            if following == "/" or following.isalpha():
                stop = page.find(">", start)
                at = end if stop < 0 else stop + 1
            else:
                if not skipped:
                    parts.append("<")
                at = start + 1
            continue
        stop = _tag_stop(page, m.end())
        if stop < 0:                                            # cut off
            break
        given, closing, tag = page[m.end():stop], bool(m[1]), m[2].lower()
        at = stop + 1
        if not closing and tag in RAW and not given.endswith("/"):
            low = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = low.end() if low else end
            if tag == "title":
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
            continue
        own = tag in BLOCKS or tag in DROPPED
        if not own and not closing and given and tag not in VOID and not given.endswith("/") \
                and _declared(tag, given, bool(area())):
            own = True                                      # a span that is hidden, say
        if not own and not (closing and depth[tag]):
            continue
        flush() if tag in BLOCKS else None
        if tag in VOID:
            continue
        if closing:
            if depth[tag]:                      # what is walked over is closed as well
                flush()
                k = len(open_) - 1
                while open_[k][0] != tag:
                    k -= 1
                close(k)
                link_depth = 0
            continue
        # a new block ends an open paragraph, a new item the open one of its list
        if tag in BLOCKS:
            link_depth = 0
            if open_ and (open_[-1][0] == "p" or open_[-1][0] == tag
                          and tag in ("li", "dd", "dt", "td", "th", "tr", "option")):
                close(len(open_) - 1)
            if tag in AREAS:                                # a menu that was never closed
                while open_ and open_[-1][1] and open_[-1][0] in ("nav", "header", "ul", "li"):
                    close(len(open_) - 1)
        declared = _declared(tag, given, bool(area()))
        here = area()
        named, box = open_[-1][3:] if open_ else ((), 1)
        if tag in AREAS and not here:
            areas += 1
            here = areas
        if declared == _NAMED:
            names += 1
            named = (*named[:MOST_NAMES - 1], names)
            flush()
        if tag not in PARAGRAPHS and tag in BLOCKS:
            boxes += 1
            box = boxes
        open_.append((tag, declared == _OUT, here, named, box))
        depth[tag] += 1
        skipped += declared == _OUT
    flush()
    return out


def stop_shares(found: list[Block]) -> list[float]:
    """The share of stop words in each block.

    A page with hardly any of the known ones is in another language: there, the shortest words
    are taken for stop words, and sentence marks of unspaced scripts for a text.
    """
    words = [_WORD.findall(b.text.lower()) for b in found]
    counts = [sum(w in STOP_WORDS for w in ws) for ws in words]
    if sum(counts) < FOREIGN * sum(map(len, words)):
        return [1.0 if _UNSPACED.search(b.text) else
                sum(len(w) <= FEW_LETTERS for w in ws) / len(ws) if ws else 0.0
                for b, ws in zip(found, words, strict=True)]
    return [n / len(ws) if ws else 0.0 for n, ws in zip(counts, words, strict=True)]


def _by_itself(block: Block, share: float) -> bool | None:
    """The first pass: whether a block is text, if that can be told."""
    if block.linked > LINKED * len(block.text):
        return False
    if len(block.text) >= SHORT:
        if share >= STOP_HIGH:
            return True
        if not block.area and share < STOP_LOW:
            return False
    return None


def without_named(found: list[Block]) -> list[Block]:
    """The blocks that are left when elements go whose names speak against them.

    A name is overruled if its element holds more of the article, or without an article more
    text, than what is left without it: wrappers carry names like `with-sidebar`. The outermost
    of the heaviest elements is let in, then those inside are judged in the same way.
    """
    if not any(b.named for b in found):
        return found
    shares = stop_shares(found)
    texts = [(b, _by_itself(b, share)) for b, share in zip(found, shares, strict=True)]
    areas = any(b.area and good is not False for b, good in texts)
    let_in: set[int] = set()
    while True:
        beside, article, inside = 0, False, Counter()
        for b, good in texts:
            shut = next((n for n in b.named if n not in let_in), None)
            if shut is None:
                article |= bool(b.area) and good is not False
                beside += 0 if b.linked else len(b.text)
            elif good if not areas else b.area and good is not False:
                inside[shut] += len(b.text)
        heaviest, weight = max(inside.items(), key=lambda x: x[1], default=(0, 0))
        if article or weight <= beside:
            return [b for b in found if let_in.issuperset(b.named)]
        let_in.add(heaviest)


def label(found: list[Block]) -> None:
    """Set `good` on every block: by itself, else as the nearest decided block of its area.

    A block without links that stands side by side with text is not decided by few stop words.
    """
    shares = stop_shares(found)
    texts: set[int] = set()
    for b, share in zip(found, shares, strict=True):
        b.good = _by_itself(b, share)
        if b.good and b.box:
            texts.add(b.box)
    for b in found:                     # a list of names among paragraphs, say
        if b.good is False and not b.linked and b.box in texts:
            b.good = None
    decided = [b.good for b in found]
    before: dict[int, int] = {}
    left: list[int | None] = []
    for i, b in enumerate(found):
        left.append(before.get(b.area))
        if decided[i] is not None:
            before[b.area] = i
    after: dict[int, int] = {}
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        if decided[i] is None:
            x, y = left[i], after.get(b.area)
            near = [(abs(i - k), k) for k in (x, y) if k is not None]
            least = min([d for d, _ in near], default=0)
            ties = [k for d, k in near if d == least]
            # of two equally near, the one that stands in the same element
            beside = [k for k in ties if found[k].box == b.box] or ties
            votes = {decided[k] for k in beside}
            b.good = votes.pop() if len(votes) == 1 else bool(b.area) or shares[i] >= STOP_HIGH
        else:
            after[b.area] = i
    if any(b.good and b.area for b in found):
        for b in found:                             # text beside the article is not it
            b.good = b.good and bool(b.area)


def most_of_it(found: list[Block]) -> None:
    """Without any good block, those without links are good where most of their text stands."""
    size = Counter()
    for b in found:
        if not b.linked:
            size[b.box] += len(b.text)
    box, most = max(size.items(), key=lambda x: x[1], default=(0, 0))
    if 2 * most > sum(size.values()):
        for b in found:
            b.good = not b.linked and b.box == box


def main_text(page: str | None) -> str:
    """Good blocks, one per line; empty if there are none or the page is null."""
    found = without_named(blocks(page or ""))
    label(found)
    if not any(b.good for b in found):
        most_of_it(found)
    return "\n".join(b.text for b in found if b.good)


def extract(df: DataFrame, html: str = "html", name: str = "main_text") -> DataFrame:
    """`df` with the main text of its pages; a column of that name is replaced.

    Null and empty pages, and pages without text, give an empty text. Pages are independent of
    one another, so repeated rows give repeated results.
    """
    def run(values: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in values], pa.string())

    return common.put(df, name, common.column(run, "string")(F.col(html)))
