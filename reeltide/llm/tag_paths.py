"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their tag path from root to leaf (tags with their classes). Each path has its text
length, its punctuation and its link text for each node. Its ratio is length times punctuation, damped by links; a
heading has the ratio of what it heads. Ratios are smoothed over the page's order of nodes with a Gaussian and fused with
what the markup says: paths through article or main elements weigh more, paths under a class, id or role with a word for
adverts, notices, comments and the like weigh next to nothing, unless such an element holds most of the page's text or of its
articles.

The deepest path that holds most of the page's text by weight is its body of content. Paths below it, and headings that
lead to it, are content from a small share of the page's mean ratio; other paths from a larger one, reduced by how little of
the page their neighbours under the same parent hold. A path of links alone is never content, but for a heading.
Elements that HTML defines as something else (menus, headers and footers of the page, asides, forms, scripts, styles, what is
hidden) don't compete.

A page is one bounded document and is worked on by itself, in time and memory linear in its length but for a repeated search
in badly nested lists; the pages are spread by Spark.

Defined cases: null or empty html gives empty text; markup that isn't closed is closed where HTML closes it or at the
end; a tag that isn't ended is text; after a quote that isn't closed tags end at the next angle bracket; html without any tags
is one block; a page whose paths are all excluded gives empty text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
NEVER = frozenset("head nav footer aside form button select option fieldset legend dialog menu menuitem object applet audio video map datalist output progress meter".split()) | RAW
SECTIONS = frozenset("article main section".split())
CLOSES_P = frozenset("address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
#: Words of class, id and role that mark what isn't main text.
NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar side aside rail menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer comment comments reply replies respond disqus discussion share sharing social related recommended newsletter subscribe signup login widget toolbar skip complementary contentinfo search".split())

#: Those that are no noise within an article, and those of what readers wrote.
HEADING, READERS = frozenset("header masthead".split()), frozenset("comment comments reply replies respond disqus discussion".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORDS = re.compile(r"[a-z]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Classes that say what an element has or is filed under, not what it is.
_MODIFIER = re.compile(r"(?:has|no|not|with|without|is|category|cat|tag|tags|topic)[-_]")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
#: Standard deviation of the smoothing in nodes.
SIGMA = 0.5
#: What a path through an article or main element weighs, and one under a word of noise.
MARKED, NOISY = 3.0, 0.0001
#: Share of a page's weight that its body of content holds.
BODY = 0.6
#: Shares of the page's mean ratio from which a path is content, below the body and elsewhere.
BELOW, ELSEWHERE = 0.003, 0.25
#: Share of the page's text, or of its article and main elements', from which an element is no noise whatever its class; of the page's, for readers' comments and beside an article.
MOST, NEARLY_ALL = 0.5, 0.9


def _tokens(html: str):
    """(text before, closing, tag, attributes) of each tag in turn, the rest of the text last with an empty tag; RAW elements go with what they hold."""
    at = start = 0
    strict = True  # quotes may hold angle brackets
    while True:
        lt = html.find("<", at)
        if lt < 0:
            yield html[start:], "", "", ""
            return
        if html.startswith("<!--", lt) or html.startswith("<![CDATA[", lt):
            end = html.find("-->" if html[lt + 2] == "-" else "]]>", lt + 4)
            yield html[start:lt], "", "", ""
            at = start = len(html) if end < 0 else end + 3
            continue
        if html[lt + 1 : lt + 2] in ("!", "?"):
            end = html.find(">", lt)
            yield html[start:lt], "", "", ""
            at = start = len(html) if end < 0 else end + 1
            continue
        name = _NAME.match(html, lt + 1)
        if not name:
            at = lt + 1
            continue
        end = name.end()
        while strict:
            m = _QUOTE_OR_END.search(html, end)
            if not m or m[0] == ">":
                end = m.start() if m else -1
                break
            end = html.find(m[0], m.end()) + 1
            if not end:
                strict = False
        if not strict:
            end = html.find(">", name.end())
        if end < 0:  # no tag ends from here on
            yield html[start:], "", "", ""
            return
        yield html[start:lt], name[1], name[2].lower(), html[name.end() : end]
        at = start = end + 1
        tag = name[2].lower()
        if tag in RAW and not name[1]:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = start = close.end() if close else len(html)


def _attributes(text: str) -> dict[str, str]:
    """Names and values of an element's attributes in lower case; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), (value[1:-1] if value[:1] in ("'", '"') else value).lower())
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")


def _noise(attributes: dict[str, str]) -> set[str]:
    """The words of class, id and role that mark what isn't main text."""
    names = (x for k in ("class", "id", "role") if k in attributes for x in attributes[k].split())
    return {w for x in names if not _MODIFIER.match(x) for w in _WORDS.findall(x)} & NOISE


class _Element(NamedTuple):
    tag: str
    path: int
    link: bool
    excluded: bool
    article: bool
    #: The innermost element with words of noise around it, and around the article that it is in; -1 for none.
    suspect: int
    outside: int
    #: Place of the p element that a block here would close, else 0.
    p: int


class _Node(NamedTuple):
    block: int
    path: int
    text: str
    link: bool
    excluded: bool
    article: bool
    noisy: bool


class Page:
    """The text nodes of a page and its tree of tag paths."""

    def __init__(self, html: str):
        #: Of each path: its parent, whether its last element is a heading, whether it goes through marked articles, and whether it is the page's own. Parents come before their children.
        self.parent, self.heading, self.marked, self.whole = [0], [False], [False], [True]
        self._known: dict[tuple[int, str], int] = {}
        self.nodes = self._read(html)

    def _path(self, parent: int, tag: str, label: str, article: bool) -> int:
        k = self._known.setdefault((parent, label), len(self.parent))
        if k == len(self.parent):
            self.parent.append(parent)
            self.heading.append(tag in _HEADINGS)
            self.marked.append(article)
            self.whole.append(tag in ("html", "body"))
        return k

    def _read(self, html: str) -> list[_Node]:
        found: list[tuple[int, str, _Element]] = []
        stack = [_Element("", 0, False, False, False, -1, -1, 0)]
        held: Counter[str] = Counter()
        suspects: list[tuple[set[str], bool, int]] = []  # words, in an article, the one around it
        block = 0

        def pop(depth: int) -> None:
            nonlocal block
            if any(x.tag not in INLINE for x in stack[depth:]):
                block += 1
            held.subtract(x.tag for x in stack[depth:])
            del stack[depth:]

        def up_to(tags, stop) -> int:
            """Place of the innermost element with one of the tags, 0 if one that stops the search lies within it."""
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    return i
                if stop(stack[i].tag):
                    return 0
            return 0

        for text, closing, tag, inside in _tokens(html):
            if text:
                found.append((block, unescape(text) if "&" in text else text, stack[-1]))
            if not tag:
                continue
            if closing:
                depth = up_to((tag,), (lambda x: x not in INLINE) if tag in INLINE else (lambda x: False)) if held[tag] > 0 else 0
                if depth:
                    pop(depth)
                elif tag == "p":
                    block += 1
                continue
            if tag == "br":
                found.append((block, " ", stack[-1]._replace(excluded=True)))
                continue
            if tag not in INLINE:
                block += 1
                if tag in CLOSES_P and stack[-1].p:
                    pop(stack[-1].p)
                if tag in SIBLINGS:
                    same, within = SIBLINGS[tag]
                    if any(held[x] > 0 for x in same.split()):
                        depth = up_to(same.split(), lambda x: x in within)
                        if depth:
                            pop(depth)
            if tag in VOID or tag in RAW:
                continue
            top = stack[-1]
            attributes = _attributes(inside) if inside.strip() else {}
            excluded = top.excluded or tag in NEVER or tag == "header" and not top.article
            article, suspect, outside = top.article, top.suspect, top.outside
            label = f"{tag}.{attributes['class']}" if attributes.get("class") else tag
            if attributes and tag not in ("html", "body") and not excluded:
                excluded = _hidden(attributes)
                words = _noise(attributes) - (HEADING if article else set())
                if words and not excluded:
                    suspects.append((words, article, suspect))
                    suspect = len(suspects) - 1
                    label = f"{label} {' '.join(sorted(words))}"
            if (tag in ("article", "main") or attributes.get("role") == "main") and not excluded:
                article, outside = True, suspect
            # words in bold or links belong to their block's path
            path = top.path if tag in INLINE else self._path(top.path, tag, label, article)
            outward = tag == "a" and not attributes.get("href", "").startswith("#")
            stack.append(_Element(tag, path, top.link or outward, excluded, article, suspect, outside, len(stack) if tag == "p" else top.p if tag in INLINE else 0))
            held[tag] += 1
        noisy = self._noisy(found, suspects)
        return [_Node(b, e.path, t, e.link, e.excluded, e.article, e.suspect >= 0 and noisy[e.suspect]) for b, t, e in found]

    @staticmethod
    def _noisy(found: list[tuple[int, str, _Element]], suspects: list[tuple[set[str], bool, int]]) -> list[bool]:
        """Of each suspect, whether it or one around it is noise."""
        whole = marked = 0
        text, articles = [0] * len(suspects), [0] * len(suspects)
        for _, t, e in found:
            if not e.excluded and not t.isspace():
                whole += len(t)
                marked += len(t) * e.article
                if e.suspect >= 0:
                    text[e.suspect] += len(t)
                if e.article and e.outside >= 0:
                    articles[e.outside] += len(t)
        for k in range(len(suspects) - 1, -1, -1):
            if (up := suspects[k][2]) >= 0:
                text[up] += text[k]
                articles[up] += articles[k]
        noisy: list[bool] = []
        for k, (words, inside, up) in enumerate(suspects):
            share = NEARLY_ALL if words & READERS or marked and not inside else MOST
            spared = text[k] > share * whole or 0 < marked * MOST <= articles[k]
            noisy.append(not spared or up >= 0 and noisy[up])
        return noisy


def chosen_paths(page: Page, below: float = BELOW, elsewhere: float = ELSEWHERE) -> set[int]:
    """The paths of content."""
    size = len(page.parent)
    nodes, chars, marks, links, noisy = ([0] * size for _ in range(5))
    line = []
    for x in page.nodes:
        if not x.excluded and not x.text.isspace():
            k = x.path
            nodes[k] += 1
            chars[k] += len(x.text)
            marks[k] += len(_PUNCTUATION.findall(x.text))
            links[k] += len(x.text) * x.link
            noisy[k] |= x.noisy
            line.append(k)
    ratio = [n / c * math.log2(2 + q / c) * (1 - a / n) ** 2 if n else 0.0 for c, n, q, a in zip(nodes, chars, marks, links, strict=True)]
    value, last = [0.0] * len(line), None
    for j in range(len(line) - 1, -1, -1):  # a heading has the value of what follows it
        k = line[j]
        if not page.heading[k]:
            last = k
        value[j] = ratio[k] if last is None else ratio[last]
    reach = range(-int(4 * SIGMA), int(4 * SIGMA) + 1)
    kernel = [math.exp(-x * x / (2 * SIGMA * SIGMA)) for x in reach]
    smooth = [0.0] * size
    for j, k in enumerate(line):
        near = [(w, value[j + x]) for x, w in zip(reach, kernel, strict=True) if 0 <= j + x < len(line)]
        smooth[k] += sum(w * v for w, v in near) / sum(w for w, _ in near) / nodes[k]
    fused = [s * (MARKED if m else 1.0) * (NOISY if y else 1.0) for s, m, y in zip(smooth, page.marked, noisy, strict=True)]
    total = sum(chars)
    mean = sum(f * n for f, n in zip(fused, chars, strict=True)) / max(1, total)
    # the deepest path that holds most of the weight
    weight = [f * n for f, n in zip(fused, chars, strict=True)]
    for k in range(size - 1, 0, -1):
        weight[page.parent[k]] += weight[k]
    body = 0
    for k in range(1, size):
        if page.parent[k] == body and weight[k] >= BODY * weight[0] > 0 and (nodes[k] < len(line) or not line):
            body = k
    if nodes[body]:  # a path of text itself: what lies around it is its parent's
        body = page.parent[body]
    inside = [False] * size
    inside[body] = True
    for k in range(body + 1, size):
        inside[k] = inside[page.parent[k]]
    leads = [False] * size
    for j in range(len(line) - 2, -1, -1):
        k, after = line[j], line[j + 1]
        leads[k] |= page.heading[k] and (inside[after] or leads[after])
    around = Counter()
    for k in range(size):
        around[page.parent[k]] += chars[k] - links[k]
    plain = max(1, total - sum(links))
    found = set()
    for k in set(line):
        if not (ratio[k] > 0 or page.heading[k]):
            continue
        if (inside[k] and not page.whole[body] or leads[k]) and fused[k] >= below * mean or fused[k] * math.sqrt(max(0, around[page.parent[k]]) / plain) >= elsewhere * mean:
            found.add(k)
    return found


def main_text(html: str | None, below: float = BELOW, elsewhere: float = ELSEWHERE) -> str:
    """The blocks of main text of a page, one a line."""
    if not html:
        return ""
    page = Page(html)
    chosen = chosen_paths(page, below, elsewhere)
    blocks: dict[int, list[str]] = defaultdict(list)
    for x in page.nodes:
        if x.text == " " and x.excluded or not x.excluded and (x.path in chosen or x.text.isspace()):  # line breaks, and content
            blocks[x.block].append(x.text)
    lines = (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def _extract(batches):
    for batch in batches:
        for a in range(0, len(batch), 256):
            ids, urls, html = (batch.column(i)[a : a + 256] for i in range(3))
            texts = [main_text(h) for h in html.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the id, url, text (main text), n_chars."""
    kinds = [f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in (("id", id_col), ("url", url_col))]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, ", ".join([*kinds, "text string, n_chars long"])).withColumnsRenamed({"id": id_col, "url": url_col})
