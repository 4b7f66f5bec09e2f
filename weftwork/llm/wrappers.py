"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

1. A page is read into a tree of its block elements. Inline elements belong to the text around them, a text slot.
2. The children of an element are a token stream. Repeats that stand side by side become one repeated group.
3. Wrappers of one host are aligned, level by level: what both have is merged, what one lacks becomes optional, a text
   that differs becomes a slot, a text that is the same on all pages stays fixed. Each task aligns the pages of its
   own part, then the wrappers of the parts are aligned in two steps, so a host with a third of all pages is no burden.
4. The wrapper shows which of its slots are main text: those of the article, without menus, adverts, comments and the
   like, without fixed text, which stands on most distinct pages of the host, in different articles. Each page is matched
   with its host's wrapper and gives these slots, without those of its lists that are mostly links.

Names and roles of HTML come first. Where they leave it open, the slots decide by what they hold over all pages of the host:
how long their texts are, how much of them is in links, and whether the same few texts come back in many articles. An
element that is named like a part beside the text, but named for something else as well, is judged by its slots too.
"""

import html
import json
import re
import zlib
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written

MAX_CHILDREN = 120  # of one wrapper element; beyond it, children of the same key are merged wherever they stand
MAX_HOSTS = 2000  # wrappers that a task holds before it passes them on
SALTS = 64
BROADCAST_BYTES = 16 << 20
LONGEST_PERIOD = 4  # elements in a repeated group
DEPTH = 200  # levels of a page that its tree has; the blocks of deeper ones stand one after the other in the last level
SKETCH = 12  # smallest digests of a slot's texts and articles that a wrapper keeps, to tell how many there are
RECURS = 3  # articles for each text of a slot, from which on its texts are no part of them
TABLE = 250_000  # entries of an alignment table; longer streams are halved first

#: Names of HTML elements by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr img".split()
)
BREAKS = {"br", "hr"}
CELLS = {"td", "th"}
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section summary table ul li tr td th body".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
SKIPPED = set(
    "head nav aside footer form button select textarea input dialog menu noscript template iframe svg math canvas object audio video"
    " script style title option datalist".split()
)
SKIPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
SKIPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu footer"
    " sidebar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login comment"
    " comments disqus reply replies respond share sharing social related recommended recommendations breadcrumb breadcrumbs pagination"
    " pager toolbar widget widgets skip search masthead topbar alert hidden copyright discussion reactions outbrain taboola thread threads"
    " anzeige anzeigen werbung seitenleiste kommentar kommentare fusszeile hinweis hinweise teilen verwandt"
    " publicite annonce annonces commentaire commentaires partager barre"
    " publicidad anuncio anuncios comentario comentarios compartir lateral relacionados".split()
)
HOLDING = set("div section aside ul ol dl table figure center details".split())  # elements that may stand beside the text within an article
BOXES = {"div", "section", "center"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
WHOLE = {"html", "body", "main"}  # never skipped for the words of their class and id
FAR_MORE = 4  # times the text of another element, which then is no match for it
HEADER_WORDS = {"header", "head", "top"}
MAIN_WORDS = {"article", "articlebody", "content", "main", "maincontent", "post", "entry", "story", "body"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title|svg|noframes|noembed|xmp)\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NUMBERED = re.compile(r"(?<![^\s_-])[A-Za-z]+[0-9](?![^\s_-])")


def key_of(tag: str, attributes: str) -> str:
    """What an element is aligned by: its name, and the words of its class, id and role; ``!`` marks hidden ones, and a dot
    the names of classes that end in one digit, which tell columns and parts apart where ids of pages have more."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag
    words, role, hidden = [], "", False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id"):
            words += [w.lower() for w in _WORDS.findall(value)]
            if name == "class":
                words += ["." + w.lower() for w in _NUMBERED.findall(value)]
        elif name == "itemprop" and value.lower() == "articlebody":
            words.append("articlebody")
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return " ".join([tag + ("!" if hidden else ""), *sorted(set(words)), *(["=" + role] if role else [])])


@dataclass(slots=True)
class Element:
    """A block element of a page; children are elements and texts ``(text, characters within links)``."""

    tag: str
    key: str
    children: list = field(default_factory=list)


def parse(page: str) -> Element:
    root = Element("html", "html")
    stack, links = [root], 0
    skipping = [False]  # for each element of the stack: does it, or one below the tree's last level around it, hold no main text
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not skipping[len(stack) - 1]:
                stack[min(len(stack), DEPTH) - 1].children.append((text, min(linked, len(text))))
            parts.clear()
        linked = 0

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) if links else 0
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            if m["cdata"] is not None:
                parts.append(m["cdata"])
            continue
        name, closing = name.lower(), bool(m["close"] or m["close2"])
        if name == "a":
            links = 0 if closing else 1
        if name in INLINE:
            continue
        if name in BREAKS:
            flush()
            continue
        if name in VOID:
            continue
        if name in CELLS:
            parts.append(" ")
            continue
        flush()
        links = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
            continue
        if name == "html":
            continue
        if name in SIBLINGS:
            holders = HOLDERS.get(name, set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in holders:
                    break
                if stack[k].tag in SIBLINGS[name]:
                    del stack[k:]
                    break
        if name in CLOSES_P and stack[-1].tag == "p":
            stack.pop()
        element = Element(name, key_of(name, m["attrs"] or m["attrs2"] or ""))
        del skipping[len(stack) :]
        if len(stack) < DEPTH:
            stack[-1].children.append(element)
            skipping.append(False)
        else:
            skipping.append(skipping[-1] or barred(element.key, True) or doubtful(element.key, True))
        stack.append(element)
    if at < len(page) and not page[at:].lstrip().startswith("<"):
        text = html.unescape(page[at:])
        parts.append(text)
        linked += len(text) if links else 0
    flush()
    return root


# A wrapper node is a list: key, at least once?, repeated?, children, distinct pages, characters, characters in links, digest of a fixed
# text, digest of the article that it stands in if it is always the same one, texts, and the smallest digests of its texts
# and of the articles around them. Each of n copies of a page counts as 1/n page.
KEY, NEEDED, REPEATED, CHILDREN, PAGES, CHARS, LINKED, FIXED, ARTICLE, COUNT, TEXTS, ARTICLES = range(12)
TEMPLATE_PAGES = 3  # distinct pages that fixed text stands on, at least
SLOT = "#"
SHORT = 40  # characters of a text that is worth half as much as running text


def wrapper_of(element: Element, share: float = 1, article: str | None = None) -> list:
    """The wrapper that fits this element alone; its page counts as ``share`` and has this article."""
    children = []
    around = [int(article.split(":")[1])] if article else []
    for child in element.children:
        if isinstance(child, tuple):
            digest = zlib.crc32(child[0].encode(errors="replace"))
            children.append([SLOT, True, False, [], share, len(child[0]), child[1], f"{len(child[0])}:{digest}", article, 1, [digest], around])
        else:
            children.append(wrapper_of(child, share, article))
    return [element.key, True, False, folded(children), share, 0, 0, None, article, 0, [], []]


def _sketch(a: list, b: list) -> list:
    return a if a == b else sorted({*a, *b})[:SKETCH]


def _number(sketch: list) -> float:
    """How many different digests a sketch has seen."""
    return len(sketch) if len(sketch) < SKETCH else (SKETCH - 1) * 2**32 / max(sketch[-1], 1)


def merged(a: list, b: list, pages: bool) -> list:
    """One wrapper for what both stand for: alternatives of two pages (``pages``), or neighbours on one page."""
    children = aligned(a[CHILDREN], b[CHILDREN], pages)
    fixed = a[FIXED] if a[FIXED] == b[FIXED] else None
    count = a[PAGES] + b[PAGES] if pages else max(a[PAGES], b[PAGES])
    article = a[ARTICLE] if a[ARTICLE] == b[ARTICLE] else None
    chars, linked = a[CHARS] + b[CHARS], a[LINKED] + b[LINKED]
    seen = [a[COUNT] + b[COUNT], _sketch(a[TEXTS], b[TEXTS]), _sketch(a[ARTICLES], b[ARTICLES])]
    return [a[KEY], a[NEEDED] and b[NEEDED], a[REPEATED] or b[REPEATED], children, count, chars, linked, fixed, article, *seen]


def folded(stream: list) -> list:
    """Groups of up to ``LONGEST_PERIOD`` nodes that repeat side by side become one repeated node, or a group of them."""
    for period in range(1, LONGEST_PERIOD + 1):
        out, k = [], 0
        while k < len(stream):
            group = stream[k : k + period]
            keys, n = [x[KEY] for x in group], 1
            while len(group) == period and [x[KEY] for x in stream[k + n * period : k + (n + 1) * period]] == keys:
                n += 1
            if n == 1:
                out.append(stream[k])
                k += 1
                continue
            whole = group
            for r in range(1, n):
                whole = [merged(a, b, False) for a, b in zip(whole, stream[k + r * period : k + (r + 1) * period])]
            if period == 1:
                whole[0] = whole[0][:]
                whole[0][REPEATED] = True
                out.append(whole[0])
            else:
                pages = max(x[PAGES] for x in whole)
                out.append(["(" + " ".join(keys) + ")", True, True, whole, pages, 0, 0, None, None, 0, [], []])
            k += n * period
        stream = out
    return stream


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of the longest common order of ``a`` with each beginning of ``b``."""
    row = np.zeros(len(b) + 1, dtype=np.int32)
    for x in a.tolist():
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def common(a: np.ndarray, b: np.ndarray, at_a: int = 0, at_b: int = 0) -> list[tuple[int, int]]:
    """The places of a longest common order of two streams of numbers.

    Equal ends are taken off first. What is left is filled into a table, or if it would be large, cut in the middle of
    ``a`` where ``b`` fits both halves best, so that memory follows the streams' length only.
    """
    if not len(a) or not len(b):
        return []
    n = min(len(a), len(b))
    head = int(np.argmin(np.append(a[:n] == b[:n], False)))
    n -= head
    tail = int(np.argmin(np.append(a[::-1][:n] == b[::-1][:n], False)))
    pairs = [(at_a + k, at_b + k) for k in range(head)]
    ends = [(at_a + len(a) - k, at_b + len(b) - k) for k in range(tail, 0, -1)]
    a, b, at_a, at_b = a[head : len(a) - tail], b[head : len(b) - tail], at_a + head, at_b + head
    if len(a) and len(b):
        if len(a) * len(b) > TABLE and len(a) > 1:
            half = len(a) // 2
            cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
            pairs += common(a[:half], b[:cut], at_a, at_b) + common(a[half:], b[cut:], at_a + half, at_b + cut)
        else:
            x, y = a.tolist(), b.tolist()
            size = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for i in range(len(x) - 1, -1, -1):
                for j in range(len(y) - 1, -1, -1):
                    size[i][j] = size[i + 1][j + 1] + 1 if x[i] == y[j] else max(size[i + 1][j], size[i][j + 1])
            i = j = 0
            while i < len(x) and j < len(y):
                if x[i] == y[j]:
                    pairs.append((at_a + i, at_b + j))
                    i, j = i + 1, j + 1
                elif size[i + 1][j] >= size[i][j + 1]:
                    i += 1
                else:
                    j += 1
    return pairs + ends


def aligned(a: list, b: list, pages: bool) -> list:
    """Two streams as one: common nodes in the longest order that both have, all others optional, then folded again."""
    keys = [x[KEY] for x in a], [x[KEY] for x in b]
    if keys[0] == keys[1]:
        return [merged(x, y, pages) for x, y in zip(a, b)]
    number: dict[str, int] = {}
    numbers = [np.array([number.setdefault(key, len(number)) for key in side], dtype=np.int32) for side in keys]
    out, i, j = [], 0, 0
    optional = lambda x: [x[KEY], False, *x[REPEATED:]]
    for k, m in [*common(*numbers), (len(a), len(b))]:
        out += [optional(x) for x in a[i:k]] + [optional(x) for x in b[j:m]]
        if k < len(a):
            out.append(merged(a[k], b[m], pages))
        i, j = k + 1, m + 1
    out = folded(out)
    if len(out) > MAX_CHILDREN:
        by_key: dict[str, list] = {}
        for x in out:
            x = [x[KEY], False, True, *x[CHILDREN:]]
            by_key[x[KEY]] = merged(by_key[x[KEY]], x, False) if x[KEY] in by_key else x
        out = list(by_key.values())
    return out


def barred(key: str, in_article: bool) -> bool:
    """Whether an element's name, role or hiding says that it is no part of the main text, with all that is in it."""
    tag, *words = key.split(" ")
    role = next((w[1:] for w in words if w[0] == "="), "")
    return tag.endswith("!") or tag in SKIPPED or role in SKIPPED_ROLES or tag == "header" and not in_article


def doubtful(key: str, in_article: bool) -> bool:
    """Whether the words of its class and id say so, which may as well tell what the element has beside its text."""
    tag, *words = key.split(" ")
    names = {w for w in words if w[0] != "="}
    if tag in WHOLE or "=main" in words:
        return False
    return bool(names & SKIPPED_WORDS) or not in_article and bool(names & HEADER_WORDS and not names & MAIN_WORDS)


def mixed(key: str) -> bool:
    """Whether some words of its class and id speak of a part beside the text and others of something else."""
    names = {w for w in key.split(" ")[1:] if w[0] not in "=."}
    return bool(names & SKIPPED_WORDS) and bool(names - SKIPPED_WORDS)


def recurring(slot: list) -> bool:
    """Whether few texts come back in many articles, as notices and adverts do."""
    articles = _number(slot[ARTICLES])
    return articles >= TEMPLATE_PAGES and articles >= RECURS * _number(slot[TEXTS])


def _slots(node: list, in_article: bool = True, spare: set = frozenset()) -> list:
    """The slots of what is not skipped in a node."""
    if node[KEY] == SLOT:
        return [node]
    return [s for c in _kept(node, in_article, spare) for s in _slots(c, in_article, spare)]


def typical(slots: list) -> float:
    """The length of the text that a character of these slots usually stands in."""
    chars = sum(s[CHARS] for s in slots)
    return sum(s[CHARS] * s[CHARS] / s[COUNT] for s in slots) / chars if chars else 0


def _share(slots: list, part) -> float:
    chars = sum(s[CHARS] for s in slots)
    return sum(part(s) for s in slots) / chars if chars else 0


def links_share(slots: list) -> float:
    return _share(slots, lambda s: s[LINKED])


def _worth(node: list, spare: set) -> float:
    """How much a node looks like running text: its characters outside of links, less for short texts, none for recurring ones."""
    slots = [s for s in _slots(node, False, spare) if not recurring(s)]
    return sum(max(0, s[CHARS] - 2 * s[LINKED]) * s[CHARS] / (s[CHARS] + SHORT * s[COUNT]) for s in slots if s[CHARS])


def _like_comments(node: list) -> bool:
    """Whether a node holds repeated items of several texts each and no heading: names, times and remarks of readers."""

    def tags(n: list) -> set:
        return {n[KEY].split(" ")[0]}.union(*(tags(c) for c in n[CHILDREN]))

    items = [c for c in in_line(node[CHILDREN]) if c[REPEATED] and c[KEY].split(" ")[0] in HOLDING | {"li", "article"}]
    return any(len(_slots(c)) > 1 and not tags(c) & HEADINGS for c in items) and not tags(node) & {"table", "pre"}


def surplus(root: list, spare: set, found: bool) -> set:
    """The ids of elements in a root that hold no main text by what their slots hold.

    These are elements of less than a quarter of the root's text whose texts come back in many articles, or whose repeated
    items are remarks far shorter than the text; in a root that no name tells (not ``found``) also those mostly of links,
    and boxes of short texts only if the root is the whole page. Where the root's own texts recur, as in a host full of near copies, nothing goes.
    """
    slots = _slots(root, True, spare)
    total, own = sum(s[CHARS] for s in slots), typical(slots)
    main = max(slots, key=lambda s: s[CHARS], default=None)  # the slot with the most text
    out: set = set()
    if main is None:
        return out
    of_page = root[KEY].split(" ")[0] in ("html", "body")
    copied = _number(main[ARTICLES]) > _number(main[TEXTS])

    def walk(node: list) -> None:
        for child in _kept(node, True, spare):
            if child[KEY] == SLOT:
                continue
            inner = _slots(child, True, spare)
            chars = sum(s[CHARS] for s in inner)
            small = 4 * chars < total and all(s is not main for s in inner)
            tag = child[KEY].split(" ")[0]
            if small and chars and tag in HOLDING:
                short = 2 * typical(inner) < own and tag not in ("table", "figure", "dl")
                comes_back = not copied and _share(inner, lambda s: s[CHARS] * recurring(s)) > 0.5
                if comes_back or short and _like_comments(child) or not found and (links_share(inner) > 0.5 or of_page and tag in BOXES and short and not _headed(child)):
                    out.add(id(child))
                    continue
            walk(child)

    walk(root)
    return out


def _headed(node: list) -> bool:
    return any(c[KEY].split(" ")[0] in HEADINGS or _headed(c) for c in node[CHILDREN])


def _kept(node: list, in_article: bool, spare: set) -> list:
    """The children that are not skipped."""
    plain = lambda key: key == SLOT or key.startswith("(")
    return [
        c for c in node[CHILDREN]
        if plain(c[KEY]) or not barred(c[KEY], in_article) and (id(c) in spare or not doubtful(c[KEY], in_article))
    ]


def _totals(node: list, in_article: bool, spare: set = frozenset()) -> tuple[int, int]:
    """Characters, and characters in links, of what is not skipped in a node that itself is not."""
    if node[KEY] == SLOT:
        return node[CHARS], node[LINKED]
    parts = [_totals(c, in_article, spare) for c in _kept(node, in_article, spare)]
    return sum(p[0] for p in parts), sum(p[1] for p in parts)


def _doubts(node: list, in_article: bool, spare: set, out: list) -> list:
    """The outermost doubtful elements that are not spared."""
    kept = {id(c) for c in _kept(node, in_article, spare)}
    for child in node[CHILDREN]:
        if id(child) in kept:
            _doubts(child, in_article, spare, out)
        elif not barred(child[KEY], in_article):
            out.append(child)
    return out


def _all_text(node: list, in_article: bool) -> int:
    return node[CHARS] + sum(_all_text(c, in_article) for c in node[CHILDREN] if c[KEY].startswith("(") or c[KEY] == SLOT or not barred(c[KEY], in_article))


def spared(root: list, in_article: bool) -> set:
    """The ids of doubtful elements that are not skipped, as they hold by far the most of the root's text: their words
    describe a whole page or article. In an article they have to be named as its body as well, if there is other text, or
    their words say something else too and their texts are like those of the article."""
    spare: set = set()
    if in_article:
        own = typical(_slots(root))
        for d in _doubts(root, True, spare, []):
            inner = _slots(d)
            if own and mixed(d[KEY]) and 2 * typical(inner) >= own and links_share(inner) < 0.3 and not all(map(recurring, inner)):
                spare.add(id(d))
    while True:
        rest = _totals(root, in_article, spare)[0]
        far = [
            (_all_text(d, in_article), -k, d) for k, d in enumerate(_doubts(root, in_article, spare, []))
            if not d[REPEATED] and (not in_article or not rest or set(d[KEY].split(" ")[1:]) & MAIN_WORDS)
        ]
        best = max(far, default=None, key=lambda f: f[:2])
        if best is None or best[0] <= FAR_MORE * rest:
            return spare
        spare.add(id(best[2]))


def _roots(node: list, wanted, out: list, doubts: int = 0) -> list:
    """The outermost wanted elements, each with 0, 1 if its own words are doubtful, 2 if those of one around it are."""
    for child in node[CHILDREN]:
        if child[KEY] == SLOT:
            continue
        if child[KEY].startswith("("):
            _roots(child, wanted, out, doubts)
        elif not barred(child[KEY], False):
            own = doubtful(child[KEY], False)
            if wanted(child[KEY]):
                out.append((child, doubts or int(own)))
            else:
                _roots(child, wanted, out, 2 if own else doubts)
    return out


def main_nodes(wrapper: list) -> tuple[list, set, bool]:
    """The wrapper elements that hold the article, the ids of doubtful elements that are not skipped in them, and whether
    names tell so.

    Elements with doubtful words count if nothing else says that it is the article, or only what is far shorter, and
    if they have more text than all that is not skipped beside them.
    """
    tag = lambda key: key.split(" ")[0]
    possible: list = []  # doubtful elements, first those that are surer
    for wanted in (
        lambda key: tag(key) == "article",
        lambda key: tag(key) == "main" or "=main" in key.split(" "),
        lambda key: bool(set(key.split(" ")[1:]) & MAIN_WORDS),
    ):
        found = [(_totals(n, True, spared(n, True))[0], doubts, n) for n, doubts in _roots(wrapper, wanted, [])]
        sure = [f for f in found if f[0] and not f[1]]
        unsure = [f for f in found if f[0] and f[1] and not f[2][REPEATED]] or [f for f in found if f[0] and f[1]]
        if unsure:
            possible.append(unsure)
        if sure:
            break
    most = max((f[0] for f in sure), default=0)
    for unsure in possible:
        best = max(f[0] for f in unsure)
        rest = _totals(wrapper, False)[0]
        if best > (FAR_MORE * most if sure else rest):
            sure, most = unsure, best
            break
    if sure:
        roots = [f[2] for f in sure if FAR_MORE * f[0] >= most]
        return roots, set().union(*(spared(n, True) for n in roots)), True
    spare = spared(wrapper, False)
    node, titles = wrapper, []  # no element says so: the smallest one that holds most of the running text
    while True:
        total = _worth(node, spare)
        children = [c for c in in_line(_kept(node, False, spare)) if c[KEY] != SLOT]
        inner = sorted(((_worth(c, spare), -k, c) for k, c in enumerate(children) if not c[REPEATED]), key=lambda x: x[:2])
        best = inner.pop() if inner else None
        if best is None or not total or best[0] <= 0.7 * total and (best[0] <= 0.6 * total or inner and 3 * inner[-1][0] > best[0]):
            return [*titles, node], spare, False
        titles += [c for c in children if c is not best[2] and c[KEY].split(" ")[0] == "h1" and not c[REPEATED]]
        node = best[2]


def marked(wrapper: list) -> None:
    """Puts, in the place of the page count, whether a slot is main text (1) or not (0)."""
    roots, spare, found = main_nodes(wrapper)
    beside = set().union(*(surplus(n, spare, found) for n in roots))
    chosen = {id(n) for n in roots}
    varies = lambda n: n[KEY] == SLOT and n[FIXED] is None or any(varies(c) for c in n[CHILDREN])
    any_slot = any(varies(n) for n in roots)
    least = max(TEMPLATE_PAGES - 0.01, wrapper[PAGES] / 2)  # shares of copies do not add up exactly
    of_articles = all(n[KEY].split(" ")[0] == "article" for n in roots)

    def walk(node: list, inside: bool, drop: bool) -> None:
        inside = inside or id(node) in chosen
        fixed = node[KEY] == SLOT and node[FIXED] is not None and node[ARTICLE] is None and node[PAGES] > least and any_slot
        kept = {id(c) for c in _kept(node, True, spare)} - beside if inside and not drop else set()
        for child in node[CHILDREN]:
            whole = inside and not of_articles and child[KEY].split(" ")[0] == "article" and not child[REPEATED]
            walk(child, inside, drop or inside and not whole and id(child) not in kept)
        node[PAGES] = int(inside and not drop and not fixed)

    walk(wrapper, False, False)


def in_line(stream: list) -> list:
    """The nodes of a stream with those of its groups, which may hold groups, in their place; a group may begin again."""
    return [x for node in stream for x in (in_line(node[CHILDREN]) if node[KEY].startswith("(") else [node])]


def _page_totals(element: Element) -> tuple[int, int]:
    """Characters, and characters in links, of what is not skipped in an element of a page."""
    parts = [
        (len(c[0]), c[1]) if isinstance(c, tuple) else _page_totals(c) for c in element.children
        if isinstance(c, tuple) or not barred(c.key, True) and not doubtful(c.key, True)
    ]
    return sum(p[0] for p in parts), sum(p[1] for p in parts)


def mostly_links(element: Element) -> bool:
    if element.tag not in ("ul", "ol", "dl") or sum(isinstance(c, Element) for c in element.children) < 2:
        return False
    chars, linked = _page_totals(element)
    return 2 * linked > chars


def match(wrapper: list, element: Element, out: list[str]) -> None:
    """Reads the main slots of a page along its wrapper."""
    flat = in_line(wrapper[CHILDREN])
    places: dict[str, list[int]] = {}
    for k, node in enumerate(flat):
        places.setdefault(node[KEY], []).append(k)
    cursor = 0
    for child in element.children:
        of_key = places.get(SLOT if isinstance(child, tuple) else child.key)
        if of_key is None:
            continue
        at = cursor = of_key[bisect_left(of_key, cursor) % len(of_key)]  # the next one, or the first one again
        if isinstance(child, tuple):
            if flat[at][PAGES]:
                out.append(child[0])
        elif not mostly_links(child):
            match(flat[at], child, out)


def page_wrapper(page: str, share: float = 1) -> list:
    """The wrapper of one page, which knows a digest of the page's article, as the page alone shows it."""
    element = parse(page)
    own, out = wrapper_of(element), []
    marked(own)
    match(own, element, out)
    text = "\n".join(out)
    return wrapper_of(element, share, f"{len(text)}:{zlib.crc32(text.encode(errors='replace'))}")


def _infer(batches):
    """A wrapper for each host of a task's pages."""
    found: dict[str, list] = {}

    def leave():
        rows = [(host, json.dumps(w)) for host, w in found.items()]
        found.clear()
        return _wrappers(rows)

    for batch in batches:
        for host, page, copies in zip(*(batch.column(k).to_pylist() for k in range(3))):
            one = page_wrapper(page or "", 1 / copies)
            found[host] = merged(found[host], one, True) if host in found else one
            if len(found) > MAX_HOSTS:
                yield leave()
    yield leave()


def _wrappers(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["host", "wrapper"])


def _align(group: pa.Table) -> pa.Table:
    whole = None
    for text in sorted(group.column("wrapper").to_pylist()):
        one = json.loads(text)
        whole = one if whole is None else merged(whole, one, True)
    return pa.Table.from_batches([_wrappers([(group.column("host")[0].as_py(), json.dumps(whole))])])


def _read(batches):
    ready: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if text not in ready:
                if len(ready) > MAX_HOSTS:
                    ready.clear()
                ready[text] = json.loads(text)
                marked(ready[text])
            out: list[str] = []
            match(ready[text], parse(page or ""), out)
            texts.append("\n".join(out))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)`` for all hosts of ``pages (host, html)``."""
    pages = pages.select("host", "html", F.xxhash64("html").alias("digest"))
    copies = pages.groupBy("host", "digest").agg(F.count("*").alias("copies")).filter("copies > 1")
    copies = written(copies, "page-copies")
    size = copies.agg(F.sum(F.octet_length("host") + 16)).first()[0] or 0
    counted = pages.join(F.broadcast(copies) if size <= BROADCAST_BYTES else copies, ["host", "digest"], "left")
    counted = counted.select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
    parts = counted.mapInArrow(_infer, "host string, wrapper string")
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    parts = parts.groupBy("host", "salt").applyInArrow(_align, "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(_align, "host string, wrapper string")


def main_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row: the blocks of the article, one a line; empty if there is none.

    A null page is empty. Pages with a null url, or one without a host, share a wrapper. Repeated rows give repeated
    results. Other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_column), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"), host.alias("host"))
    wrappers = written(infer_wrappers(rows), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    other = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    joined = rows.join(other, "host").select("page_id", "url", "html", "wrapper")
    kind = pages.schema[id_column].dataType.simpleString()
    return joined.mapInArrow(_read, f"page_id {kind}, url string, text string, n_chars long")
