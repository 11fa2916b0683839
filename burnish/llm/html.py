"""Main text of web pages by two passes of block rules.

Markup that is never article text is left out first: scripts, styles, menus, headers,
footers, side columns, forms, and containers whose class, id or role names an advert, a
notice, a comment section and the like.  What is left is cut into blocks at block-level tags.

A name alone drops a container only after its subtree is read.  An ``<article>`` or ``<main>``
in it stays (unless its own name is on the list), and so does a container with more than half
of the page's long text, if no article or main elsewhere on the page has long text.  If all
the long text is in named containers, none is dropped.  A part behind ``no``, ``has``,
``with`` and the like names a layout ("has-sidebar") and does not count.

First pass: a block with mostly link text is boilerplate; a block shorter than ``SHORT`` is
undecided; a longer one is content if at least ``DENSE`` of its words are stop words,
boilerplate if fewer than ``SPARSE`` are, and undecided between.  Inside ``<article>`` or
``<main>`` a sparse block is undecided instead, since tables and names have few stop words.
If dense blocks hold less than ``FITS`` of a page's long text, none of the listed languages
fits it; stop words then say nothing, and a long block without many links is content.

Second pass: an undecided block takes the label of its nearest decided neighbours on its own
side of ``<article>`` and ``<main>`` (inside or outside): content if both agree on it,
boilerplate if both say so.  If they differ, or there is only one, the nearer one decides, a
tie or no neighbour at all counts as content.  A heading belongs to what follows it, so for a
heading the next decided block decides.  Where no block is decided content, inside or on the
whole page, links alone say nothing of the undecided ones: they are content.

Defined cases: a null or empty html gives an empty text; markup cut off at the end is left
out; unknown or broken character references stay as written; unclosed elements end with
their parent, and a named container that ends so loses its first block only; repeated rows are each extracted; every text is read whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import small_batches

SHORT = 70
DENSE = 0.2
SPARSE = 0.05
LINKS = 0.33
FITS = 0.25

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be been but by can do for from had has have he her his i if in is it its not of on or she so that the their there they this to was we were what when which who will with you "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer es für hat ich ihr im in ist kann mit nach nicht noch nur oder sich sie sind so über um und unter vom von vor war was wie wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous ou où par pas pour plus qu que qui sa se ses son sont sur un une vous "
    "al como con de del donde el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por porque que se ser si sin sobre son su sus también un una y ya".split()
)
_DROPPED = frozenset("head nav header footer aside form button select option menu dialog fieldset label input noscript template svg canvas object iframe audio video map datalist annotation annotation-xml".split())
_AROUND = frozenset("header aside form fieldset".split())  # an article or main in them is none of theirs
_RAW = frozenset("script style textarea xmp noembed noframes title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul caption hgroup".split())
_CLOSES_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Containers by class, id or role: whole name parts only, so "adapter" is no advert.
_JUNK = frozenset("ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
_LAYOUT = frozenset("has hide no non not with without".split())
_OPTIONAL = frozenset("p li td th tr dd dt tbody thead tfoot".split())  # may end without an end tag
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
# The same with quotes that count for nothing: before a quote that nothing ends.
_LOOSE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|()()()<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class _Block:
    __slots__ = ("text", "linked", "heading", "inside", "named")

    def __init__(self, text: str, linked: int, heading: bool, inside: bool, named: int):
        self.text, self.linked, self.heading, self.inside, self.named = text, linked, heading, inside, named

    def links(self) -> bool:
        return self.linked > LINKS * len(self.text)

    def long(self) -> int:
        """Length of the text if it is long and not links."""
        return len(self.text) if len(self.text) >= SHORT and not self.links() else 0


class _Named:
    """A container whose name is on the list: the one around it, and what its subtree holds."""

    __slots__ = ("around", "inside", "unclosed", "first", "long", "long_inside")

    def __init__(self, around: int, inside: bool):
        self.around, self.inside, self.unclosed = around, inside, False
        self.first, self.long, self.long_inside = -1, 0, 0


def _is_junk(attributes: str) -> bool:
    """Whether a class, id or role has a part on the list."""
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                parts = name.replace("_", "-").split("-")
                if any(x in _JUNK and (i == 0 or parts[i - 1] not in _LAYOUT) for i, x in enumerate(parts)):
                    return True
    return False


def _without_named(found: list[_Block], named: list[_Named]) -> list[_Block]:
    """Blocks outside the containers that their names drop."""
    if not named:
        return found
    for i, block in enumerate(found):
        if block.named >= 0:
            own = named[block.named]
            own.first = i if own.first < 0 else own.first
            own.long += block.long()
            own.long_inside += block.long() if block.inside else 0
    for own in reversed(named):  # inner ones come after outer ones
        if own.around >= 0:
            outer = named[own.around]
            outer.long += own.long
            outer.long_inside += own.long_inside
            if own.first >= 0 and (outer.first < 0 or own.first < outer.first):
                outer.first = own.first
    long = sum(b.long() for b in found)
    long_inside = sum(b.long() for b in found if b.inside)
    firsts, gone = set(), []
    for own in named:
        elsewhere = not own.inside and long_inside > own.long_inside
        drops = elsewhere or 2 * own.long <= long
        if drops and own.unclosed:
            firsts.add(own.first)
            drops = False
        gone.append(drops or (own.around >= 0 and gone[own.around]))
    kept = [b for i, b in enumerate(found) if i not in firsts and not (b.named >= 0 and gone[b.named])]
    return kept if not long or any(b.long() for b in kept) else found


def blocks(page: str, forms: bool = False) -> list[_Block]:
    """Blocks of a page that markup does not rule out, in page order.

    With ``forms`` the text of forms counts like any other, but for their labels and fields.
    """
    left_out = _DROPPED - {"form"} if forms else _DROPPED
    found: list[_Block] = []
    named: list[_Named] = []
    parts: list[str] = []
    # Open elements; whether each is left out; the named container, and the depths of what is left out, to go back to.
    stack: list[tuple[str, bool, int | None, tuple[int, int] | None]] = []
    opened: Counter[str] = Counter()
    state = {"dropped": 0, "around": 0, "article": 0, "link": 0, "linked": 0, "heading": 0, "named": -1}

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        if text:
            found.append(_Block(text, state["linked"], state["heading"] > 0, state["article"] > 0, state["named"]))
        parts.clear()
        state["linked"] = 0

    def count(name: str, by: int) -> None:
        if name in ("article", "main"):
            state["article"] += by
        elif name == "a":
            state["link"] += by
        elif name in _HEADINGS:
            state["heading"] += by

    def close(down_to: int, by_end_tag: bool = False) -> None:
        for at in range(len(stack) - 1, down_to - 1, -1):
            name, dropped, around, lifted = stack[at]
            opened[name] -= 1
            if name in _BLOCK or dropped or around is not None:
                end_block()
            if around is not None:
                if by_end_tag and at > down_to and state["named"] >= 0 and name not in _OPTIONAL:
                    named[state["named"]].unclosed = True
                state["named"] = around
            count(name, -1)
            state["around" if name in _AROUND else "dropped"] -= dropped
            if lifted:
                end_block()
                state["around"] = lifted
        del stack[down_to:]

    def say(raw: str) -> None:
        if raw and not (state["dropped"] or state["around"]):
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if state["link"]:
                state["linked"] += len(text)

    at, loose_to = 0, -1
    while (m := (_LOOSE if at <= loose_to else _TOKEN).search(page, at)) is not None:
        if m[5] and loose_to < 0:  # a quote up to the end of the page failed this tag, and would fail those before it
            loose_to = max(page.rfind('"'), page.rfind("'"))
        say(page[at : m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), True)
            elif name == "p":
                end_block()
            continue
        if name == "br":
            say(" ")
            continue
        if name in _VOID:
            if name == "hr":
                end_block()
            continue
        if name in _RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _CLOSES_P:
            _close_open(stack, opened, close, "p", ("div", "article", "section", "body", "td", "li", "blockquote", "main"))
        if name == "li":
            _close_open(stack, opened, close, "li", ("ul", "ol"))
        if name in ("td", "th", "tr"):
            _close_open(stack, opened, close, name, ("table",))
        if name in ("dd", "dt"):
            _close_open(stack, opened, close, "dd", ("dl",))
            _close_open(stack, opened, close, "dt", ("dl",))
        if name == "body":
            _close_open(stack, opened, close, "head", ())
        if attributes.endswith("/") and name in ("path", "rect", "circle", "use"):
            continue
        junk = "=" in attributes and name not in ("html", "body") and _is_junk(attributes)
        dropped, around, lifted = name in left_out and not (name == "label" and state["article"]), None, None
        if name in ("article", "main"):
            if not junk and state["named"] >= 0:
                around = state["named"]  # lifts the drop of the containers around it
            if not junk and state["around"]:
                end_block()
                lifted, state["around"] = state["around"], 0
        elif junk and not dropped:
            around = state["named"]
        if name in _BLOCK or dropped or around is not None:
            end_block()
        if around is not None:
            lifts = name in ("article", "main")
            if not lifts:
                named.append(_Named(around, state["article"] > 0))
            state["named"] = -1 if lifts else len(named) - 1
        stack.append((name, dropped, around, lifted))
        opened[name] += 1
        state["around" if name in _AROUND else "dropped"] += dropped
        count(name, 1)
    rest = page[at:]
    say(rest)
    close(0)
    end_block()
    return _without_named(found, named)


def _close_open(stack, opened, close, name: str, within: tuple) -> None:
    """Close an open ``name`` unless one of ``within`` was opened after it."""
    if not opened[name]:
        return
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            close(i)
            return
        if stack[i][0] in within:
            return


def _first_passes(found: list[_Block]) -> list[bool | None]:
    """True for content, False for boilerplate, None if undecided, for every block."""
    density = []
    for block in found:
        words = block.text.lower().split() if block.long() else []
        density.append(sum(w.strip(_PUNCTUATION) in STOP_WORDS for w in words) / max(1, len(words)))
    long = sum(b.long() for b in found)
    fits = sum(b.long() for b, d in zip(found, density) if d >= DENSE) >= FITS * long
    labels: list[bool | None] = []
    for block, dense in zip(found, density):
        if block.links():
            labels.append(False)
        elif block.heading or not block.long():
            labels.append(None)
        elif dense >= DENSE or not fits:
            labels.append(True)
        else:
            labels.append(False if dense < SPARSE and not block.inside else None)
    return labels


def _second_pass(found: list[_Block], labels: list[bool | None], any_content: bool) -> list[bool]:
    """Labels of all blocks of one side."""
    if not any_content:
        return [label is None for label in labels]
    before: list[int | None] = []
    last = None
    for i, label in enumerate(labels):
        before.append(last)
        last = i if label is not None else last
    done, following = [], None
    for i in range(len(found) - 1, -1, -1):
        label = labels[i]
        if label is None:
            previous = before[i]
            if found[i].heading and following is not None:
                label = labels[following]
            elif previous is None and following is None:
                label = True
            elif previous is None or following is None:
                label = labels[following if previous is None else previous]
            elif labels[previous] == labels[following]:
                label = labels[previous]
            elif i - previous == following - i:
                label = True
            else:
                label = labels[previous if i - previous < following - i else following]
        else:
            following = i
        done.append(label)
    return done[::-1]


def main_text(page: str | None) -> str:
    """Content blocks of a page, joined by line ends."""
    found = blocks(page or "")
    if not found and page and "<form" in page.lower():
        found = blocks(page, forms=True)  # a page that is one form, as some frameworks write all of theirs
        found = found if any(b.long() for b in found) else []
    labels = _first_passes(found)
    kept = [False] * len(found)
    some_inside = any(b.inside for b in found)
    for inside in (True, False):
        own = [i for i, b in enumerate(found) if b.inside == inside]
        # An article has text, so outside it links among short blocks are a menu's.
        any_content = any(labels[i] for i in own) or (not inside and some_inside)
        for i, label in zip(own, _second_pass([found[i] for i in own], [labels[i] for i in own], any_content)):
            kept[i] = label
    return "\n".join(b.text for b, k in zip(found, kept) if k)


@F.pandas_udf(T.StringType())
def _extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract(column: str = "html") -> Column:
    return _extracted(F.col(column).cast("string"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    done = small_batches(pages).select("page_id", "url", extract().alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
