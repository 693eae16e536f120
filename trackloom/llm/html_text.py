"""Main text of web pages by composite text density.

Every page becomes a tree of its elements; what is never shown as text (scripts, controls, hidden elements) is left out. Each node gets a
density: its characters per tag, adjusted by how much of it is link text. The node whose children's densities sum to the most holds
the main text. The least density on its path up to the body is a threshold: other branches of that path join with their own node of the greatest sum
where that sum reaches it, and inside the text blocks below it that are mostly links go, as menus do.

Elements that a page itself names as boilerplate, by tag, role or whole class names, are no candidates and go. Such a name only confirms: it does not
hold where it would take the article away (see ``standing_marks``).
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags by their part in the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is never part of a page's text.
SILENT = frozenset("script style noscript template iframe head title button select textarea input option svg canvas object embed dialog xmp noembed noframes audio video".split())
#: Elements that are boilerplate by their tag: such whose name always holds, and such as may also surround a page or head an article.
NAMED, LOOSE = frozenset("nav footer aside menu".split()), frozenset("header form".split())
#: Elements that hold an article.
HOLDERS = frozenset("main article".split())
#: A header inside one of these heads that, and not the page.
HEADED = frozenset("main article section".split())
#: A start tag that closes open ones, up to the nearest of the bounds.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements that are kept whatever their class.
KEPT = frozenset("html body main article".split())
#: Words of class names and ids that mark boilerplate, if all the name's other words are such too or only say where or how.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split())
BESIDE = frozenset("area bar block bottom box buttons column container content inner item items left link links list main outer panel page primary right row secondary section site slot top unit wrap wrapper".split())
#: Names of reader comments; unlike other class names these are no layout.
SAID = frozenset("comment comments disqus replies reply respond".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_NAME = r"<(/?)([a-zA-Z][^\s/>]*+)"
#: A comment, a declaration, a tag with well-formed quotes, a tag with a stray quote.
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|{_NAME}((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|{_NAME}([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def _marks(value: str) -> set[str]:
    """The marking words of class names or ids, of such names only that are boilerplate as a whole: ``page-sidebar``, not ``has-sidebar``."""
    found = set()
    for name in value.split():
        words = set(_PARTS.split(name)) - {""}
        marking = words & MARKS
        # A layout that is named after all its columns ("content-sidebar-wrap") is none of them.
        if marking and words <= MARKS | BESIDE and not (marking <= {"sidebar"} and "content" in words):
            found |= marking
    return found


#: How an element stands: ordinary; named, unless that takes the article away; named in any case; never shown.
ORDINARY, NAMED_LOOSELY, NAMED_FIRMLY, HIDDEN = range(4)


def standing(tag: str, attributes: str, headed: bool = False) -> int:
    """``headed`` says that an element around it would have a header of its own."""
    if tag in SILENT:
        return HIDDEN
    found = NAMED_FIRMLY if tag in NAMED else NAMED_LOOSELY if tag in LOOSE and not (tag == "header" and headed) else ORDINARY
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return ORDINARY if tag in KEPT else HIDDEN
        if name == "role" and value.strip() in ROLES:
            found = NAMED_FIRMLY
        elif name in ("class", "id"):
            marks = _marks(value)
            if marks & SAID:
                found = NAMED_FIRMLY
            elif marks - ({"header"} if headed else set()):
                found = max(found, NAMED_LOOSELY)
    return ORDINARY if tag in KEPT else found


class Tree:
    """Elements in page order; children come after parents, and ``pieces`` holds text and block breaks with their node.

    Open elements are also listed by tag, and the open blocks by place, so that no start or end tag looks through the stack.
    """

    def __init__(self, page: str):
        self.tags, self.parents, self.pieces, self.links, self.standing = ["#root"], [-1], [], [False], [ORDINARY]
        self._headed = [False]
        self._stack, self._blocks, self._open_at = [0], [], {}
        at, n = 0, len(page)
        skipped = 0  # depth of the stack below which everything is dropped
        while at < n:
            m = _TOKEN.search(page, at)
            end = m.start() if m else n
            if end > at and not skipped:
                self._text(page[at:end])
            if not m:
                break
            at = m.end()
            closes, name, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
            if not name:
                continue
            tag = name.lower()
            if closes:
                self._close(tag)
            elif tag in VOID:
                if not skipped:
                    self.pieces.append((self._stack[-1], None if tag == "hr" else " "))
            else:
                kind = standing(tag, attributes, self._headed[self._stack[-1]])
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
                    at = close.end() if close else n
                    continue
                if attributes.endswith("/") and kind == HIDDEN:
                    continue
                self._open(tag, kind)
                if kind == HIDDEN and not skipped:
                    skipped = len(self._stack)
            if skipped and len(self._stack) < skipped:
                skipped = 0

    def _text(self, raw: str) -> None:
        self.pieces.append((self._stack[-1], html.unescape(raw)))

    def _cut(self, place: int) -> None:
        """Closes the elements from a place of the stack on."""
        while len(self._stack) > place:
            self._open_at[self.tags[self._stack.pop()]].pop()
        while self._blocks and self._blocks[-1] >= place:
            self._blocks.pop()

    def _nearest(self, tags: set[str]) -> int:
        return max((self._open_at[t][-1] for t in tags if self._open_at.get(t)), default=0)

    def _open(self, tag: str, kind: int = ORDINARY) -> None:
        stack = self._stack
        if tag in BLOCKS and self._blocks and self.tags[stack[self._blocks[-1]]] == "p":
            self._cut(self._blocks[-1])  # an open paragraph ends where a block begins
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            while (place := self._nearest(closed)) > self._nearest(bounds):
                name = self.tags[stack[place]]
                self._cut(place)
                if tag != "tr" or name == "tr":
                    break
        self.links.append(tag == "a" or self.links[stack[-1]])
        self.standing.append(kind)
        self._headed.append(tag in HEADED or self._headed[stack[-1]])
        self.tags.append(tag)
        self.parents.append(stack[-1])
        self._open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS or tag in ("button", "object"):
            self._blocks.append(len(stack))
        stack.append(len(self.tags) - 1)
        if tag in BLOCKS:
            self.pieces.append((stack[-1], None))

    def _close(self, tag: str) -> None:
        places = self._open_at.get(tag)
        if not places:
            return
        if tag in BLOCKS:
            self.pieces.append((self._stack[places[-1]], None))
        elif self._blocks and self._blocks[-1] > places[-1]:
            return  # an inline end tag does not close blocks
        self._cut(places[-1])


def density_of(chars: int, link_chars: int, tags: int, link_tags: int, of_links: float) -> float:
    """Characters per tag, times the logarithm of how little of them links are; ``of_links`` is the page's share of link text."""
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + of_links * chars + math.e)
    inner = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    return chars / max(1, tags) * math.log(max(1.0, inner)) / max(1.0, math.log(base))


def densities(tree: Tree) -> tuple[list[float], list[float], list[float]]:
    """Of each node its composite density, the sum of its children's (its own text counts as a child), and its share of link text."""
    n = len(tree.tags)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in tree.pieces:
        if text:
            k = len("".join(text.split()))
            chars[node] += k
            if tree.links[node]:
                link_chars[node] += k
    own = list(zip(chars, link_chars))
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (tree.tags[i] == "a")
    body = tree.tags.index("body") if "body" in tree.tags else 0
    of_links = link_chars[body] / max(1, chars[body])
    density = [density_of(chars[i], link_chars[i], tags[i], link_tags[i], of_links) for i in range(n)]
    sums = [density_of(c, lc, 0, 0, of_links) for c, lc in own]
    for i in range(1, n):
        sums[tree.parents[i]] += density[i]
    return density, sums, [lc / max(1, c) for c, lc in zip(chars, link_chars)]


def standing_marks(tree: Tree) -> list[bool]:
    """Whether each node is inside an element whose name as boilerplate holds.

    Names hold but for those around the article. If all ``main`` and ``article`` elements with text lie in named elements, the names of those around
    the one with the most unlinked text (the outermost, first of equals) do not hold. On a page without any ``main`` or ``article``, an
    element that is only named loosely is none if it holds more than half of the page's unlinked text, with a paragraph, a heading or 250 characters.
    """
    n, tags, parents = len(tree.tags), tree.tags, tree.parents
    plain, prose = [0] * n, [tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") for tag in tags]
    text = [0] * n
    for node, piece in tree.pieces:
        if piece:
            k = len("".join(piece.split()))
            text[node] += k
            plain[node] += 0 if tree.links[node] else k
    for i in range(n - 1, 0, -1):
        p = parents[i]
        text[p] += text[i]
        plain[p] += plain[i]
        prose[p] = prose[p] or prose[i]
    own = [k in (NAMED_LOOSELY, NAMED_FIRMLY) for k in tree.standing]

    def spread() -> list[bool]:
        out = own[:]
        for i in range(1, n):
            out[i] = out[i] or out[parents[i]]
        return out

    held = spread()
    holders = [i for i in range(n) if tags[i] in HOLDERS]
    full = [i for i in holders if text[i]]
    if full and all(held[i] for i in full):
        i = max(full, key=lambda i: (plain[i], -i))
        while i >= 0:
            own[i] = False
            i = parents[i]
        return spread()
    if not holders:
        for i in range(n):
            if own[i] and tree.standing[i] == NAMED_LOOSELY and 2 * plain[i] > plain[0] and (prose[i] or plain[i] >= 250):
                own[i] = False
        return spread()
    return held


def chosen(tree: Tree) -> list[bool]:
    """Whether each node belongs to the main text: a few passes over the nodes, in order."""
    density, sums, linked = densities(tree)
    named = standing_marks(tree)
    n = len(tree.tags)
    body = tree.tags.index("body") if "body" in tree.tags else 0
    # The node of the greatest sum in each node's subtree, the earliest of equals.
    best = [-1 if named[i] else i for i in range(n)]
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        if best[i] >= 0 and best[p] >= 0 and (-sums[best[i]], best[i]) < (-sums[best[p]], best[p]):
            best[p] = best[i]
    top = best[body]
    i = top
    while i > 0:  # an article is taken whole
        i = tree.parents[i]
        if i > 0 and tree.tags[i] == "article":
            top = i
    path, i = {body}, top
    threshold = density[top]
    while i not in path and i > 0:
        path.add(i)
        threshold, i = min(threshold, density[i]), tree.parents[i]

    def content_of(menus: bool) -> list[bool]:
        content = [False] * n
        for i in range(n):
            p = tree.parents[i]
            if i == top:
                content[i] = True
            elif p >= 0 and content[p]:
                menu = menus and tree.tags[i] in BLOCKS and linked[i] > 0.5 and density[i] < threshold
                content[i] = not (menu or named[i])
            elif p in path and i not in path and best[i] >= 0 and sums[best[i]] >= threshold > 0:
                content[best[i]] = True
        return content

    content, every = content_of(True), content_of(False)
    # A main element or an article that is mostly lists of links is no menu: it is kept whole.
    holder, kept, whole = [-1] * n, [0] * n, [0] * n
    for i in range(1, n):
        p = holder[tree.parents[i]]
        holder[i] = p if p >= 0 else i if tree.tags[i] in HOLDERS else -1
    for node, text in tree.pieces:
        if text and every[node] and holder[node] >= 0:
            whole[holder[node]] += len(text)
            kept[holder[node]] += len(text) * content[node]
    return [c or (e and h >= 0 and 2 * kept[h] < whole[h]) for c, e, h in zip(content, every, holder)]


def main_text(page: str) -> str:
    """Blocks of the main text in page order, joined by an empty line; the white space inside a block is single spaces."""
    tree = Tree(page)
    content = chosen(tree)
    blocks, words = [], []
    for node, text in tree.pieces:
        if text is None:
            if words:
                blocks.append("".join(words))
            words = []
        elif content[node]:
            words.append(text)
    blocks.append("".join(words))
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row, from the whole page.

    A null or empty page, or one without text, has an empty text. Unclosed elements, comments and attributes end with the page.
    Repeated rows give equal results; extra columns are ignored. White space is what Unicode calls so, no-break spaces included.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h) if h else "" for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInPandas(work, f"page_id {kind}, url string, text string, n_chars long")
