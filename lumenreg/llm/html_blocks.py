"""HTML extraction by two-pass block rules.

A page is read as a stream of tags and text. Scripts, styles, comments and
hidden parts are skipped, as are containers that name themselves menus,
headers, footers, sidebars, notices, adverts, forms or reader comments (by tag,
role, class or id). What is left is cut into blocks at block-level tags.

A ``nav`` or ``header`` whose end tag the page lacks ends where an article or main
begins. A form is excluded like a container named by its place, as it may hold the
page; its controls never count. An ``a`` with an id or name and no ``href`` is no link.

A class or id name is evidence only: parts after has-, with-, no- or without-, or before
-open, -closed, -free and the like, don't count, and of containers other than comments, one named by a part that may be a
topic (legal-news) is kept for a good block of ``LONG`` characters; where a page has
no block of ``SHORT`` characters outside such containers, so are one named by its
place (sidebar) for a long block and any one that holds an article or main.

Pass 1 decides a block by its length, link density and stop-word density: good,
bad or undecided (short, or long with few stop words). Pass 2 gives undecided
blocks the label of the nearest decided neighbour of their own container; of
two equally near ones a good one wins for headings and near-good blocks. Long
blocks with hardly any stop words (code, lists, tables) are good between two good
neighbours only. Where stop words say nothing of a page (languages without a
list), length and link density alone decide, and where none is long
either, short blocks with few links are taken. Inside
``article`` or ``main`` a long block with few links is good, and an undecided
one is bad only between two bad neighbours. Link density alone decides there
only runs of linked blocks without words of their own: a linked heading is taken
next to a good block, another linked block between two good ones. Where a page
marks its article so, nothing outside it is taken.

Null, empty and textless pages give an empty text. Whitespace inside a block,
as Unicode has it, becomes one space; blocks are joined by one.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from lumenreg.llm.batches import with_text_columns

SHORT, LONG = 70, 200
#: Characters outside links that make a linked block of an article an entry, as of references.
OWN_TEXT = 20
MANY_LINKS, FEW_STOPS, MANY_STOPS = 0.5, 0.15, 0.30

#: Common stop words of seven languages.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it not of on or she that the
their they this to was we were which will with you
aber als am an auch auf aus bei das dass dem den der des die durch ein eine einer es für hat ich
im in ist mit nach nicht oder sich sie sind und von war was werden wie wir zu zum zur über
au aux avec ce cette dans de des du elle en est et il je la le les leur mais ne nous on ou par pas
plus pour qu que qui sa se ses son sont sur un une vous à été
al como con de del el en entre es esta este la las lo los más me no o para pero por que se si sin
sobre su sus también un una y ya
al alla che con da dal dei del della di e gli ha il in la le lo ma nel non per più si sono su un una
as ao com da das do dos e em é foi mais mas na no nas nos não o os ou para pela pelo por que se sua
aan de dat die een en er het hij ik is met niet of om op te van voor was zijn
""".split())

SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head",
           "title", "canvas", "audio", "video"}
EXCLUDED = {"nav", "header", "footer", "aside", "menu", "dialog", "button", "select", "option",
            "textarea", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input", "label"}
CONTAINERS = {"div", "section", "article", "main", "body", "ul", "ol", "dl", "table", "tbody",
              "tr", "td", "center", "blockquote", "figure", "details"}
#: Start tags that leave an open head open; any other one, and text, ends it.
HEAD_TAGS = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style",
             "template", "title"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Names in class or id, as whole parts between spaces, dashes and underscores.
NAMES = re.compile(r"""(?:^|[\s_-])(?:ads?|adv|adverts?|advertisements?|adsense|banners?|sponsors?|
sponsored|promos?|promotions?|cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modal|
overlay|newsletters?|subscribe|subscription|signup|sign-up|paywall|nav|navbar|navigation|menus?|
breadcrumbs?|sidebars?|side|rail|aside|widgets?|footers?|header|masthead|topbar|comments?|
commentlist|discussion|disqus|respond|replies|reply|share|sharing|social|related|recommended|
recommendations|pagination|pager|login|search|searchbox|toolbar|skip[_-]?(?:links?|nav|to)|copyright|legal|disclaimer|
outbrain|taboola|trending|popular|teasers?|form)(?:$|[\s_-])""".replace("\n", ""), re.I)
#: Names that also exclude an article or main element: it is someone's comment or a teaser.
STRICT = re.compile(r"(?:^|\s)(?:comments?|reply|replies|teaser|related|advert|sponsored)(?:$|\s|[_-]+"
                    r"(?:body|box|card|content|entry|item|list|post|text|thread|\d+)(?:$|[\s_-]))", re.I)
#: Parts of a name that say nothing, or the opposite: has-sidebar, no-ads, comments-open.
NEGATED = re.compile(r"(?:^|(?<=[\s_-]))(?:(?:has|with|no|without)[_-]\S*|[a-z]+[_-](?:open|closed|free|on|off"
                     r"|enabled|disabled|allowed)(?=$|[\s_-]))", re.I)
#: Names that always exclude.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|reply|replies)(?:$|[\s_-])",
                      re.I)
#: Names that may as well be an article's topic, if they are one part of several.
TOPICS = {"legal", "social", "popular", "search", "form", "header", "share", "sharing", "trending",
          "discussion", "side", "alert", "alerts", "notice", "notices", "banner", "banners"}
PLACES = TOPICS | {"sidebar", "sidebars", "rail", "widget", "widgets", "overlay", "modal", "masthead",
                   "topbar", "toolbar", "navbar", "searchbox"}
#: How far a name excludes: always, unless it holds an article, or also a long block, anywhere.
ALWAYS, NAME, PLACE, TOPIC = range(1, 5)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<skip>script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|title)"
    r"(?=[\s/>])[^>]*+(?:(?<=/)>|>.*?(?:</(?P=skip)\s*+[^>]*+>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/!?][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+(?:>|\Z)"
    r"|[^<]++|<", re.S | re.I)
ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
    r"|(?=[\s/>]|\Z))", re.I)
#: The attributes of an ``a`` that is a place in the page, not a link.
ANCHOR_ONLY = re.compile(r"(?=.*\b(?:id|name)\s*=)(?!.*\bhref\b)", re.S | re.I)
WORD = re.compile(r"[^\W\d_]+")


def _named(value: str) -> int:
    """How far the class or id excludes what its element holds; 0 if it doesn't."""
    value = NEGATED.sub(" ", value)
    if not NAMES.search(value):
        return 0
    if COMMENTS.search(value):
        return ALWAYS
    kind = TOPIC
    for name in value.split():
        if not NAMES.search(name):
            continue
        parts = re.split("[_-]+", name.lower())
        named = [p for p in parts if NAMES.search(p)]
        if not named or not PLACES.issuperset(named):
            return NAME
        if len(named) == len(parts) or not TOPICS.issuperset(named):
            kind = PLACE
    return kind


def _excluded(tag: str, attributes: str, in_article: bool) -> int:
    """How far the element's name, role, class, id or style excludes what it holds."""
    if tag in EXCLUDED and not (tag == "header" and in_article):
        return ALWAYS
    if tag == "form":  # server-side frameworks put whole pages into one
        return min(PLACE, _excluded("div", attributes, in_article) or PLACE)
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return 0
    kinds = []
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = next((v for v in m.groups()[1:] if v is not None), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return ALWAYS
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return ALWAYS
        if name == "role" and value.lower() in ROLES:
            return ALWAYS
        if name in ("class", "id") and tag not in ("html", "body"):
            if tag not in ("article", "main"):
                kinds.append(_named(value))
            elif STRICT.search(value):
                return ALWAYS
    kind = min(filter(None, kinds), default=0)
    return ALWAYS if kind and tag in INLINE else kind


class Block:
    __slots__ = ("parts", "linked", "heading", "container", "article", "named", "text", "label",
                 "words", "stops")

    def __init__(self, container: int, article: bool, named: tuple = ()):
        self.parts, self.linked, self.heading = [], 0, False
        self.container, self.article, self.text, self.label = container, article, "", ""
        self.named = named  # open containers with excluding names: (number, kind, in an article)
        self.words = self.stops = 0  # words and stop words, where pass 1 counts them


def unclosed(page: str, tag: str) -> bool:
    """Whether the page has fewer end tags than start tags of this name."""
    return len(re.findall(rf"<{tag}(?=[\s/>])", page, re.I)) > len(re.findall(rf"</{tag}(?=[\s>])", page, re.I))


def blocks_of(page: str) -> list[Block]:
    """The page's blocks outside skipped and excluded parts, with their texts."""
    out: list[Block] = []
    stack: list[tuple] = []  # open containers: (tag, excluded, article, number, named before)
    named: tuple = ()
    excluded = article = links = heading = number = count = 0
    block = Block(0, False)
    lacking: dict = {}  # tag -> whether the page lacks end tags of it
    open_tags: Counter = Counter()  # of the stack, so that a stray end tag is no search

    def close():
        nonlocal block
        if block.parts:
            text = "".join(block.parts)
            if "&" in text:
                text = html.unescape(text)
            block.text = " ".join(text.split())
            if block.text:
                out.append(block)
        block = Block(number, article > 0, named)
        block.heading = heading > 0

    def opened(tag: str, attributes: str) -> None:
        nonlocal excluded, article, number, count, named
        kind = ALWAYS if tag == "head" else _excluded(tag, attributes, article > 0)
        out_of = int(kind == ALWAYS)
        if not kind and tag not in CONTAINERS and tag not in EXCLUDED and not (
                (excluded or named) and stack and stack[-1][0] == tag):
            return
        count += 1
        is_article = int(tag in ("article", "main") and not out_of and not excluded)
        if is_article or kind:
            number = count
        stack.append((tag, out_of, is_article, number, named))
        open_tags[tag] += 1
        if kind > ALWAYS and not excluded:
            named += ((count, kind, article > 0),)
        excluded, article = excluded + out_of, article + is_article

    def closed(at: int) -> None:
        """Closes the container at this place and all that it holds."""
        nonlocal excluded, article, number, named
        if at < len(stack):
            named = stack[at][4]
        for tag, out_of, is_article, _, _ in stack[at:]:
            excluded, article = excluded - out_of, article - is_article
            open_tags[tag] -= 1
        del stack[at:]
        number = stack[-1][3] if stack else 0

    for m in TOKEN.finditer(page):
        tag = m["tag"]
        if tag is None:
            piece = m[0]
            if piece[0] == "<" and len(piece) > 1:
                continue
            if stack and stack[-1][0] == "head" and not piece.isspace():
                closed(len(stack) - 1)
                block.container = number
            if excluded:
                continue
            block.parts.append(piece)
            if links:
                block.linked += len(piece.strip())
            continue
        tag, end, attributes = tag.lower(), bool(m["end"]), m["attributes"]
        if stack and stack[-1][0] == "head" and not end and tag not in HEAD_TAGS:
            closed(len(stack) - 1)  # its end tag may be left out
            block.container = number
        if tag == "a":
            links = int(not end and not ANCHOR_ONLY.match(attributes))
        if tag == "br" or tag == "hr":
            if not excluded:
                block.parts.append(" ")
            continue
        if tag in VOID or attributes.endswith("/") and tag in INLINE:
            continue
        if tag in INLINE:  # no block of its own, but it may be hidden or an advert
            if not end:
                opened(tag, attributes)
            elif stack and stack[-1][0] == tag:
                closed(len(stack) - 1)
            continue
        links = 0
        if tag in HEADINGS:
            heading = int(not end)
        close()
        if end:
            if open_tags[tag]:
                closed(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
        else:
            if stack and stack[-1][0] in ("p", "li") and (stack[-1][0] == "p" or tag == "li"):
                closed(len(stack) - 1)  # an open paragraph ends where the next block begins
            if excluded and tag in ("article", "main"):
                out_of = [i for i, x in enumerate(stack) if x[1]]
                for outer in {stack[i][0] for i in out_of} - lacking.keys():
                    lacking[outer] = outer in ("nav", "header") and unclosed(page, outer)
                if all(lacking[stack[i][0]] for i in out_of):
                    closed(out_of[0])  # a menu or page header whose end tag is missing
            opened(tag, attributes)
        block.container, block.article, block.heading = number, article > 0, heading > 0
        block.named = named
    close()
    return out


def decide(block: Block) -> str:
    """Pass 1: good, bad, near (long with few stop words), sparse (long with hardly any), short
    or, in an article, linked."""
    text = block.text
    if block.linked > MANY_LINKS * len(text):
        if not block.article:
            return "bad"
        return "linked" if len(text) - block.linked < OWN_TEXT else "short"
    if len(text) < SHORT or block.heading:
        return "short"
    if block.article:
        return "good"
    words = WORD.findall(text.lower())
    block.words, block.stops = len(words), sum(w in STOP_WORDS for w in words)
    stops = block.stops / max(1, len(words))
    if stops >= MANY_STOPS:
        return "good" if len(text) >= LONG else "near"
    return "near" if stops >= FEW_STOPS else "sparse"


def outside_names(blocks: list[Block]) -> list[Block]:
    """The blocks that no container's name excludes, see the module's text."""
    long = {"good", "near", "sparse"}
    outside = any(not b.named and b.label in long for b in blocks)
    kept = set()
    for b in blocks:
        big = len(b.text) >= LONG
        for number, kind, in_article in b.named:
            if (kind == TOPIC and big and b.label == "good" or not outside and (
                    b.article and not in_article and b.label == "good"
                    or kind >= PLACE and big and b.label in long)):
                kept.add(number)
    return [b for b in blocks if kept.issuperset(n for n, _, _ in b.named)]


def by_container(blocks: list[Block]) -> list[list[Block]]:
    """The blocks of each container, in order."""
    found: dict[int, list[Block]] = {}
    for b in blocks:
        found.setdefault(b.container, []).append(b)
    return list(found.values())


def linked_runs(blocks: list[Block]) -> None:
    """Several linked blocks in a row, without a heading between, are bad."""
    for held in by_container(blocks):
        runs = [b.label == "linked" and not b.heading for b in held]
        for i, b in enumerate(held):
            if runs[i] and (i and runs[i - 1] or i + 1 < len(held) and runs[i + 1]):
                b.label = "bad"


def sparse_blocks(blocks: list[Block]) -> None:
    """Long blocks with hardly any stop words are good between two good blocks, or else bad."""
    for held in by_container(blocks):
        around = []  # the nearest decided block on each side
        for order in (held, held[::-1]):
            last, sides = "", []
            for b in order:
                sides.append(last)
                if b.label in ("good", "bad"):
                    last = b.label
            around.append(sides)
        for b, before, after in zip(held, around[0], around[1][::-1]):
            if b.label == "sparse":
                b.label = "good" if before == after == "good" else "bad"


def linked_singles(blocks: list[Block]) -> None:
    """Linked headings next to a good block and linked blocks between good ones are good."""
    for held in by_container(blocks):
        for heading in (True, False):
            beside = []  # the nearest block on each side that isn't a linked one itself
            for order in (held, held[::-1]):
                last, sides = "", []
                for b in order:
                    sides.append(last)
                    if b.label != "linked":
                        last = b.label
                beside.append(sides)
            for b, before, after in zip(held, beside[0], beside[1][::-1]):
                if b.label == "linked" and b.heading == heading:
                    near = [before == "good", after == "good"]
                    b.label = "good" if (any(near) if heading else all(near)) else "bad"


def inherit(blocks: list[Block]) -> None:
    """Pass 2: undecided blocks take the nearest decided neighbour's label."""
    linked_runs(blocks)
    sparse_blocks(blocks)
    decided = {"good", "bad"}
    first = [b.label for b in blocks]
    before: list = []
    last = {}
    for i, b in enumerate(blocks):
        before.append(last.get(b.container))
        if first[i] in decided:
            last[b.container] = i
    last = {}
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        after = last.get(b.container)
        if first[i] in decided:
            last[b.container] = i
            continue
        if first[i] == "linked":
            continue
        near = [(abs(i - j), first[j]) for j in (before[i], after) if j is not None]
        if b.article:  # only links on both sides make it bad
            b.label = "bad" if [x for _, x in near] == ["bad", "bad"] else "good"
        elif not near:
            b.label = "good" if first[i] == "near" else "bad"
        elif len(near) == 2 and near[0][0] == near[1][0] and near[0][1] != near[1][1]:
            b.label = "good" if b.heading or first[i] == "near" else "bad"
        else:
            b.label = min(near)[1]
    linked_singles(blocks)


def unlisted(blocks: list[Block]) -> bool:
    """Whether stop words say nothing of a page: none of its blocks is good, and none has many of
    them or all together have few."""
    return (all(b.label != "good" for b in blocks)
            and (all(b.stops < MANY_STOPS * max(1, b.words) for b in blocks)
                 or sum(b.stops for b in blocks) < FEW_STOPS * sum(b.words for b in blocks)))


def main_text(page: str) -> str:
    """The main text of a page."""
    blocks = blocks_of(page)
    for b in blocks:
        b.label = decide(b)
    blocks = outside_names(blocks)
    if any(b.article and b.label not in ("bad", "linked") for b in blocks):  # the page marks its article
        blocks = [b for b in blocks if b.article]
    elif unlisted(blocks):
        lone = "short" if any(b.label in ("near", "sparse") for b in blocks) else "good"
        for b in blocks:
            b.label = {"near": "good", "sparse": "good", "short": lone}.get(b.label, b.label)
    inherit(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page id, url, text, n_chars (code points) of every row; rows repeat as they are."""
    def make():
        def step(texts):
            found = [main_text((t or b"").decode()) for t in texts]
            return [found, [len(t) for t in found]]
        return step

    return with_text_columns(pages, [id_col, url_col], html_col, make,
                             [StructField("text", StringType()), StructField("n_chars", LongType())])
