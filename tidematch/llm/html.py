"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block elements. The first pass decides a block
by what surrounds it (a navigation, a footer, an advert), its share of link
text, its length and its density of stop words; short blocks and middling ones
stay open. In the second pass an open block takes the label of its nearest
decided neighbours, in its own section if that has any.

Elements that say what they are, such as ``nav``, count as they are. A class or an id
counts only as a whole name, and not where what it names holds most of the page's
text and the article or all the prose with it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame

from tidematch.llm.common import map_batches
from tidematch.session import ship_package

#: A shorter block is open; a longer one is decided by its stop words.
SHORT = 70
LONG = 200
#: Stop words in a hundred words of clear prose, and of doubtful text.
STOP_HIGH = 0.30
STOP_LOW = 0.15
#: More than this share of link text makes a list of links.
LINKS = 0.5
OPEN, GOOD, NEAR, BAD = "open", "good", "near", "bad"

# ---- Fixed values: elements by their role, names of page furniture, stop words.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main "
    "menu nav ol section table td ul".split()
)
FURNITURE = frozenset("nav footer aside form menu dialog head".split())
UNREAD = frozenset(
    "script style noscript template svg iframe object canvas select textarea button title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_NAMES = (
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice overlay pagination pager popup promo promotion recommended related replies "
    "share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar "
    "widget"
)
# Words that stand beside those in a name without changing what it says.
PLAIN_NAMES = (
    "area article bar blog block bottom box column container content entry fixed footer global "
    "group header inner item items layer left link links list main outer page panel post posts "
    "primary right row secondary section site sticky text top wrap wrapper"
)
FURNITURE_ROLES = "navigation banner contentinfo complementary search alert dialog form menu"
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be been but by can for from had has have he her "
    "his i if in into is it its more no not of on one or our out she so than that the their them "
    "then there these they this to up was we were what when which who will with would you "
    # German
    "aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer "
    "er es für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind über um und von vor "
    "war wenn werden wie wir wird zu zum zur "
    # French
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on "
    "ou par pas plus pour qu que qui sa se ses son sur un une vous "
    # Spanish
    "al como con de del el ella en entre es esta este fue ha hay la las lo los me mi muy no o para "
    "pero por que se si sin sobre su sus también una uno y ya".split()
)
# ---- End of fixed values.

_FURNITURE_NAMES = frozenset(FURNITURE_NAMES.split())
_NAMES = _FURNITURE_NAMES | frozenset(PLAIN_NAMES.split())
_ROLES = frozenset(FURNITURE_ROLES.split())
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_PART = re.compile(r"[-_:.]+|(?<=[a-z])(?=[A-Z])")
_UNSHOWN = re.compile(r"display\s*:\s*none")
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_ENDS = {name: re.compile(rf"</{name}(?![a-z0-9])[^>]*(?:>|\Z)", re.I) for name in UNREAD}
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    """A piece of text between block boundaries."""

    section: int
    inside: bool  # of an article
    furniture: bool
    heading: bool
    named: tuple[int, ...] = ()  # containers around it whose name says furniture
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = OPEN


def _says_furniture(name: str) -> bool:
    """Whether a whole class or id does: ``cookie-notice`` and ``site-footer``, but not
    ``with-sidebar``."""
    parts = [p.lower() for p in _PART.split(name) if p]
    return any(p in _FURNITURE_NAMES for p in parts) and all(p in _NAMES for p in parts)


def marks_of(attributes: str) -> tuple[bool, bool]:
    """What an element's attributes say: not shown or of a furniture role, and of a
    furniture name. Read once, from left to right."""
    sure = named = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            named = named or any(map(_says_furniture, value.split()))
        elif name == "role":
            sure = sure or value.strip().lower() in _ROLES
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            sure = True
        elif name == "style":
            sure = sure or _UNSHOWN.search(value.lower()) is not None
    return sure, named


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page with text, in page order. Markup that is never
    closed, and elements that are, in the wrong order, do no harm: an end tag
    closes the innermost open container of its name, or nothing."""
    out: list[Block] = []
    # (name, section, inside an article, furniture, named containers) of the open ones.
    stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("", 0, False, False, ())]
    sections, links, heading, own_furniture, breaks = 0, 0, False, False, 0
    holds_article: set[int] = set()  # named containers with an article in them
    now: Block | None = None
    at = 0

    def add(raw: str) -> None:
        nonlocal now, breaks
        if not raw:
            return
        if "&" in raw:
            raw = unescape(raw)
        if now is None:
            if raw.isspace():
                return
            _, section, inside, furniture, named = stack[-1]
            now = Block(section, inside, furniture or own_furniture, heading, named)
            out.append(now)
        now.parts.append(raw)
        if links:
            now.linked += len(raw.strip())
        if not raw.isspace():
            breaks = 0

    while at < len(html):
        m = _MARKUP.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing, attributes = m[2].lower(), bool(m[1]), m[3] or ""
        if name in UNREAD:
            if not closing and not attributes.endswith("/"):
                end = _ENDS[name].search(html, at)
                at = end.end() if end else len(html)
            if name in ("select", "textarea", "button", "title"):
                add(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            breaks += 1
            if breaks > 1:
                now = None
            else:
                add(" ")
        if name not in BLOCKS:
            continue
        now, breaks = None, 0
        if closing:
            heading = own_furniture = False
            links = 0
            if name in CONTAINERS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            continue
        unshown, by_name = marks_of(attributes) if attributes else (False, False)
        furniture = name in FURNITURE or unshown
        heading = name in HEADINGS
        if name not in CONTAINERS:
            own_furniture = furniture or by_name
            continue
        own_furniture = False
        _, around, inside, outer, named = stack[-1]
        if name == "header":
            furniture = furniture or not inside
        if name in ("article", "main", "body"):
            furniture = name != "body" and furniture and name != "main"
            holds_article.update(named if name != "body" else ())
        sections += 1
        if by_name and name not in ("body", "main"):
            named = (*named, sections)
            if name == "article":
                holds_article.add(sections)
        # Lists, tables and quotations belong to the section around them.
        section = sections if name not in ("ul", "ol", "dl", "blockquote", "figure", "td", "table") else around
        stack.append((name, section, inside or name in ("article", "main"), outer or furniture, named))
    for block in out:
        block.text = " ".join("".join(block.parts).split())
    out = [b for b in out if b.text]
    believe_names(out, holds_article)
    return out


def density(text: str) -> float:
    """Stop words in a text's words."""
    words = _WORD.findall(text.lower())
    return sum(map(STOP_WORDS.__contains__, words)) / max(1, len(words))


def believe_names(blocks: list[Block], holds_article: set[int]) -> None:
    """Blocks in containers with a furniture name are furniture, but for containers with
    most of the page's text that hold an article, or outside of which is no prose."""
    weight: dict[int, int] = {}
    for block in blocks:
        if not block.furniture and block.linked <= LINKS * len(block.text):
            weight[-1] = weight.get(-1, 0) + len(block.text)
            for container in block.named:
                weight[container] = weight.get(container, 0) + len(block.text)
    large = {c for c, n in weight.items() if c >= 0 and 2 * n > weight[-1]}
    if large:
        free = [b for b in blocks if not b.furniture and not b.named and len(b.text) >= SHORT]
        prose = any(b.linked <= LINKS * len(b.text) and density(b.text) >= STOP_LOW for b in free)
        large = {c for c in large if c in holds_article or not prose}
    for block in blocks:
        block.furniture = block.furniture or any(c not in large for c in block.named)


def decide(block: Block) -> str:
    """The first pass: what a block shows by itself."""
    size = len(block.text)
    if block.furniture or block.linked > LINKS * size:
        return BAD
    if size < SHORT:
        return BAD if not block.inside and (block.linked or "©" in block.text) else OPEN
    share = density(block.text)
    if block.inside:
        return GOOD if share >= STOP_LOW else NEAR
    if "©" in block.text and size <= LONG and (share < STOP_HIGH or block.text.startswith("©")):
        return BAD
    if share >= STOP_HIGH:
        return GOOD if size > LONG else NEAR
    return NEAR if share >= STOP_LOW else BAD


def settle(blocks: list[Block]) -> None:
    """The second pass: open blocks take their nearest decided neighbours' label."""
    first = [b.label for b in blocks]
    count = len(blocks)
    # For each block the nearest decided one on either side, in its section and anywhere.
    nearest: list[list[int | None]] = [[None] * count for _ in range(4)]
    for order, near, wide in ((range(count), 0, 1), (range(count - 1, -1, -1), 2, 3)):
        own: dict[int, int] = {}
        last: int | None = None
        for k in order:
            nearest[near][k] = own.get(blocks[k].section)
            nearest[wide][k] = last
            if first[k] in (GOOD, BAD):
                own[blocks[k].section] = last = k
    for k, block in enumerate(blocks):
        if first[k] in (GOOD, BAD):
            continue
        sides = [nearest[0][k], nearest[2][k]]
        if sides == [None, None]:
            if block.inside:
                block.label = GOOD  # an article of short blocks
                continue
            sides = [nearest[1][k], nearest[3][k]]
        found = [(abs(j - k), first[j]) for j in sides if j is not None]
        labels = {label for _, label in found}
        if not found:
            block.label = GOOD
        elif len(labels) == 1:
            block.label = labels.pop()
        elif first[k] == NEAR or block.inside:
            block.label = GOOD
        elif block.heading:
            block.label = next(first[j] for j in reversed(sides) if j is not None)
        elif found[0][0] != found[1][0]:
            block.label = min(found)[1]
        else:
            block.label = BAD


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by a blank line; empty if none."""
    if not html:
        return ""
    blocks = blocks_of(html)
    for block in blocks:
        block.label = decide(block)
    settle(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == GOOD)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every row of ``pages``.

    A null or empty page, one without markup and one without main text have a
    text all the same: empty, or what the rules find. Text without any markup is
    one block without decided neighbours or by its stop words. Nothing is cut
    short. Repeated rows come back as they are; other columns are not read.
    """
    ship_package(pages.sparkSession)

    def make():
        def call(columns):
            texts = map(main_text, columns[2])
            return [(k, u, t, len(t)) for k, u, t in zip(columns[0], columns[1], texts)]

        return call

    kinds = dict(pages.dtypes)
    schema = f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long"
    return map_batches(pages.select(key, url, html), make, schema)
