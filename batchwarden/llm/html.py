"""Main text of web pages by two passes of rules over blocks.

The first pass decides what it can: a block inside a menu, notice or the like is boilerplate, and so
is one that is mostly links; a long block in running language, told by its share of stop words, is
content. Short or unclear blocks stay open. The second pass lets each open block inherit the label of
the nearest decided block, looking at its own section of the page first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import table

# Function words of the four languages.
STOP_WORDS = frozenset(
    "the of and to in is that for with on was by are as at be this have from or it he not an "
    "le la les de des du et en un une que qui dans pour par sur avec est au se pas ne il "
    "der die das und ist von den mit dem zu ein eine nicht auf im es sich auch er dass "
    "el los las del y por con para su al lo como más pero sus".split()
)
LINKS = 0.35  # share of characters in links from which a block is boilerplate
DENSE = 0.12  # share of stop words from which a block is running language
LONG = 100  # characters from which a block in running language is content
FOREIGN = 0.02  # a page below this share of stop words is in none of the languages

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose end tags are tracked, because what they hold belongs together.
HOLDERS = frozenset("article aside blockquote body details div figure footer form header main nav section table ul ol dl fieldset a".split())
SILENT = frozenset("head script style noscript template svg iframe select button textarea object canvas math title option".split())
CONTENT = frozenset(("article", "main"))
CLUTTER = frozenset(("nav", "footer", "aside", "form"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Words in class, id or role that name what is not the article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|login|menu|modal|nav|navbar|navigation|"
    r"newsletter|notice|pagination|popup|promo\w*|recommend\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|teaser|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
BODY = re.compile(r"<body\b|<article\b", re.I)
TAG = re.compile(r"</?[a-zA-Z]")
NAME_END = re.compile(r"[\s/>]")
TAG_SPECIAL = re.compile(r"[>\"']")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


class Block:
    """Text between two block-level tags."""

    __slots__ = ("text", "linked", "section", "clutter", "inside", "label")

    def __init__(self, text: str, linked: int, section: int, clutter: bool, inside: bool) -> None:
        self.text, self.linked, self.section = text, linked, section
        self.clutter, self.inside, self.label = clutter, inside, None


class _Scanner:
    """Finds the tags of a page in one pass, however damaged it is.

    What is looked for from several places is remembered, so that no stretch of text is searched twice:
    the next place of a kind, and the quotes from which a tag is known not to end.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.last_close = html.rfind(">")
        self.next_place: dict[re.Pattern, tuple[int, int]] = {}
        self.dead: set[int] = set()
        self.no_end: set[str] = set()

    def _next(self, what: re.Pattern, at: int) -> int:
        """Place of the first match from ``at``, where calls come in page order; the page's length for none."""
        since, place = self.next_place.get(what, (0, -1))
        if not since <= at <= place:
            found = what.search(self.html, at)
            place = found.start() if found else len(self.html)
            self.next_place[what] = (at, place)
        return place

    def tag(self, at: int) -> tuple[str, bool, str, int] | None:
        """Name, whether it closes, attributes and end of the tag at ``at``; None if none ends from there.

        A ``>`` between quotes is part of a value.
        """
        if at > self.last_close or not TAG.match(self.html, at):
            return None
        closing = self.html[at + 1] == "/"
        begin = at + 2 if closing else at + 1
        name_end = self._next(NAME_END, begin)
        place, opened = self._next(TAG_SPECIAL, begin), []
        if place < name_end:  # quotes inside the name are part of it
            found = TAG_SPECIAL.search(self.html, name_end)
            place = found.start() if found else len(self.html)
        while place < len(self.html) and self.html[place] != ">":
            quote_end = -1 if place in self.dead else self.html.find(self.html[place], place + 1)
            opened.append(place)
            found = TAG_SPECIAL.search(self.html, quote_end + 1) if quote_end >= 0 else None
            place = found.start() if found else len(self.html)
        if place >= len(self.html):
            self.dead.update(opened)
            return None
        return self.html[begin:name_end].lower(), closing, self.html[name_end:place], place + 1

    def after(self, name: str, at: int) -> int | None:
        """Where the first end tag of a name from ``at`` ends."""
        if name in self.no_end or at > self.last_close:
            return None
        found = re.compile(rf"</{re.escape(name)}\b", re.I).search(self.html, at)
        if found is None or found.end() > self.last_close:
            self.no_end.add(name)
            return None
        return self.html.index(">", found.end()) + 1


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, section, clutter, inside an article
    parts: list[str] = []
    opened: Counter[str] = Counter()  # how many of each name are on the stack
    linked = sections = at = 0
    scanner = _Scanner(html)

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            _, section, clutter, inside = stack[-1] if stack else ("", 0, False, False)
            out.append(Block(text, linked, section, clutter, inside))
        parts.clear()
        linked = 0

    def keep(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        linked += len(piece.strip()) if opened["a"] else 0

    while at < len(html):
        if html[at] != "<":
            end = html.find("<", at)
            end = len(html) if end < 0 else end
            keep(html[at:end])
            at = end
            continue
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), at) and at < scanner.last_close:
            at = html.index(">", at) + 1
            continue
        tag = scanner.tag(at)
        if tag is None:
            keep("<")
            at += 1
            continue
        name, closing, attributes, at = tag
        if name in SILENT:
            if not closing and not attributes.endswith("/"):
                end = scanner.after(name, at)
                at, begin = len(html) if end is None else end, at
                if name == "head":
                    # A head that is never closed ends where the body begins.
                    body = BODY.search(html, begin, at)
                    at = body.start() if body else at
            continue
        if name == "br":
            parts.append(" ")
        if name in BLOCKS:
            flush()
        if name not in HOLDERS:
            if not closing and name not in VOID and HIDDEN.search(attributes):
                at = scanner.after(name, at) or at
            continue
        if closing:
            last = None
            while opened[name] and last != name:
                last = stack.pop()[0]
                opened[last] -= 1
        else:
            _, section, clutter, inside = stack[-1] if stack else ("", 0, False, False)
            if name != "a":
                sections += 1
                section = sections if name in ("article", "aside", "div", "footer", "form", "header", "main", "nav", "section") else section
                named = name not in ("body", "article", "main") and any(NAMES.search(a or b or c) for a, b, c in NAMED.findall(attributes))
                clutter = clutter or name in CLUTTER or named or (name == "header" and not inside) or bool(HIDDEN.search(attributes))
                inside = inside or name in CONTENT
            if not attributes.endswith("/"):
                stack.append((name, section, clutter, inside))
                opened[name] += 1
    flush()
    return out


def decide(found: list[Block]) -> None:
    """First pass: label the blocks that speak for themselves."""
    words = [[w.strip(".,;:!?()\"'").lower() for w in b.text.split()] for b in found]
    stops = [sum(w in STOP_WORDS for w in ws) for ws in words]
    foreign = sum(stops) < FOREIGN * sum(map(len, words))
    for block, ws, stop in zip(found, words, stops):
        if block.clutter or block.linked > LINKS * len(block.text):
            block.label = False
        elif len(block.text) >= LONG and (foreign or stop >= DENSE * len(ws)):
            block.label = True


def inherit(found: list[Block]) -> None:
    """Second pass: open blocks take the label of the nearest decided one, their own section first.

    Blocks inside an article look only at its other blocks, clutter left out, and are content if none
    of them is decided or two that disagree are equally near; blocks outside look at the rest of the
    page and are then boilerplate.
    """
    first = [None if b.inside and b.clutter else b.label for b in found]
    before, after = _nearest(found, first, 1), _nearest(found, first, -1)[::-1]
    for k, block in enumerate(found):
        if block.label is not None:
            continue
        near = sorted(x for x in (before[k], after[k]) if x)
        tie = len(near) == 2 and near[0][:2] == near[1][:2] and near[0][2] != near[1][2]
        block.label = block.inside if not near or tie else near[0][2]


def _nearest(found: list[Block], labels: list[bool | None], step: int) -> list[tuple[bool, int, bool] | None]:
    """For each block the last decided one in a direction: whether in another section, how far, its label."""
    out: list[tuple[bool, int, bool] | None] = []
    in_section: dict[int, tuple[int, bool]] = {}
    on_side: dict[bool, tuple[int, bool]] = {}
    for n, k in enumerate(range(len(found))[::step]):
        block = found[k]
        own = in_section.get(block.section)
        choice = own or on_side.get(block.inside)
        out.append(choice and (own is None, n - choice[0], choice[1]))
        if labels[k] is not None:
            in_section[block.section] = on_side[block.inside] = (n, labels[k])
    return out


def main_text(html: str | None) -> str:
    """The main text of a page: content blocks joined by two line breaks each; empty if there is none."""
    found = blocks(html or "")
    decide(found)
    inherit(found)
    return "\n\n".join(b.text for b in found if b.label)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html``, with ``text`` (never null) and ``n_chars``, its length in code points.

    A null or empty page has an empty text. Other columns pass unchanged; own columns called like the
    two that are made give way to them. Repeated rows come out repeated.
    """
    made_names = {text.lower(), "n_chars"}
    kept = [c for c in pages.columns if c != html and c.lower() not in made_names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], [*kept, text])

    rows = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html}`"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(kept)])
    made = rows.mapInArrow(run, f"{fields}, `{text}` string")
    return made.withColumn("n_chars", F.length(text).cast("bigint"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
