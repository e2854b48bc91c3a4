"""HTML extraction by line-block distribution: strip markup into lines, sum text
lengths over sliding line windows, and keep the text between surge and dive points.

On every page the sums choose the span. Elements and marks correct what they are taken of
and where the span ends: boilerplate weighs nothing, text of a named article weighs twice,
and a span that lies in articles is made up to these articles, whole and nothing else.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of the HTML standard, by what they mean for the text.
CODE = ("script", "style")  # up to their end tag, or else the end of the page, as browsers read them
RAW = ("title", "textarea", "iframe")  # hold no elements
UNSHOWN = ("noscript", "template", "svg", "object")  # hold elements, their own kind too
BOILERPLATE = frozenset(
    "nav header footer aside form menu button select dialog fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p td th li dd dt blockquote pre figcaption caption h1 h2 h3 h4 h5 h6".split())
# names in a class, id or role that mark a container as none of the article
MARKED = frozenset(
    "ad ads advert adverts advertisement sponsored sponsor promo banner menu nav navbar navigation breadcrumb"
    " breadcrumbs sidebar widget footer header notice notices cookie cookies consent alert popup modal comment"
    " comments disqus replies reply respond share sharing social related newsletter subscribe subscription login"
    " signup search form pager pagination contentinfo complementary".split()
)

# words that say where or of what kind a marked container is; any other word in a name makes
# it another thing, such as a share price or a notice period
PLACES = frozenset(
    "site page main top bottom left right upper lower middle header footer side bar box container wrapper wrap outer"
    " inner area section block group list item items row col column slot unit panel content link links button buttons"
    " icon icons text label global primary secondary tertiary sub mini mobile desktop sticky fixed float inline first"
    " last new post posts article articles sign up off in log".split()
)

# those of them whose containers hold articles other than the page's
OTHERS = frozenset(
    "ad ads advert adverts advertisement sponsored sponsor promo sidebar widget comment comments disqus replies reply"
    " respond related".split()
)
SOFT = frozenset(("form", "fieldset"))  # elements that may also wrap a whole page

WINDOW = 3  # lines in a block
SURGE = 86  # characters in a block that always start a text
NAMED = 2  # what a character within a named article weighs

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_HIDDEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>"
    # a closing slash counts only where no end tag of its own follows
    rf"|<(?P<code>{'|'.join(CODE)})\b{_ATTRIBUTES}(?:(?<!/)>.*?(?:</(?P=code)\s*>|\Z)|>(?:(?!<(?P=code)\b).)*?</(?P=code)\s*>)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b{_ATTRIBUTES}>(?:(?!<(?P=raw)\b).)*?</(?P=raw)\s*>|<title\b{_ATTRIBUTES}>[^<]*"
    rf"|<(?P<end>/?)(?P<name>{'|'.join(UNSHOWN)})\b(?P<rest>{_ATTRIBUTES})>",
    re.S | re.I,
)
_TAG = re.compile(rf"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>|<[!?/][^>]*>?|<[a-zA-Z/][^<>]*\Z")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_STATE = re.compile(r"(?:with|without|has|have|no|non|not)[-_]")  # what a container has, not what it is


def _marks(attributes: str) -> set[str]:
    """The marks among the names of a container. A name is a mark if it is one as a whole, or
    if all its words are marks or places."""
    found: set[str] = set()
    for values in _NAMED.findall(attributes):
        for name in "".join(values).lower().split():
            words = _WORD.findall(name)
            marks = MARKED.intersection(words)
            if marks and not _STATE.match(name) and all(w in MARKED or w in PLACES for w in words):
                found |= marks
    return found


def _shown(page: str) -> str:
    """The page without what browsers do not show. An element that closes itself or has
    no end tag of its own is empty."""
    spans: list[tuple[int, int]] = []
    starts: dict[str, list[re.Match]] = {}
    for found in _HIDDEN.finditer(page):
        name = (found["name"] or "").lower()
        if not name:
            spans.append(found.span())
        elif found["end"]:
            if starts.get(name):
                spans.append((starts[name].pop().start(), found.end()))
        elif not (name == "svg" and found["rest"].endswith("/")):
            starts.setdefault(name, []).append(found)
    parts, at = [], 0
    for start, end in sorted(spans):
        if end > at:
            parts += (page[at : max(start, at)], " ")
            at = end
    return "".join(parts) + page[at:]


class _Tree:
    """Containers of a page in order of their start tags; the first stands for the page."""

    def __init__(self) -> None:
        self.names = [""]
        self.parents = [-1]
        self.marks: list[set[str]] = [set()]
        self.sizes = [0]  # characters of text

    def add(self, name: str, parent: int, attributes: str) -> int:
        self.names.append(name)
        self.parents.append(parent)
        self.marks.append(set() if name in ("html", "body", *MAIN) else _marks(attributes))
        self.sizes.append(0)
        return len(self.names) - 1

    def settle(self) -> tuple[list[bool], list[int]]:
        """For each container, whether its text is boilerplate, and the outermost article or
        main that it is within (0 for none).

        An element of boilerplate drops what it holds unless that is a main; a form or a
        mark, unless that is a main or an article, or more than half of the page's text.
        Marks of ``OTHERS`` drop articles and any text, but never the longest article of
        the page. A marked paragraph or cell with the text of a block is prose and stays.
        Of a header within an article, the headings stay.
        """
        n = len(self.names)
        own = list(self.sizes)
        of_articles = [0] * n
        for k in range(n - 1, 0, -1):
            self.sizes[self.parents[k]] += self.sizes[k]
            of_articles[self.parents[k]] += self.sizes[k] if self.names[k] == "article" else of_articles[k]
            if self.names[k] == "article":
                of_articles[k] = 0  # comments within an article count as its text
        # a main weighs what it says outside articles
        weights = [size - part for size, part in zip(self.sizes, of_articles)]
        fixed = [False] * n
        articles, longest, shown = [], 0, own[0]
        for k in range(1, n):
            fixed[k] = fixed[self.parents[k]] or (self.names[k] in BOILERPLATE and self.names[k] not in SOFT)
            shown += 0 if fixed[k] else own[k]
            if self.names[k] in MAIN and not fixed[k]:
                articles.append(k)
                longest = max(longest, weights[k])
        # 1 holds an article, 2 the longest, 3 a main
        holds = [0] * n
        for k in range(1, n):
            if self.names[k] == "main":
                holds[k] = 3
        for k in articles:
            holds[k] = max(holds[k], 2 if weights[k] == longest else 1)
        for k in range(n - 1, 0, -1):
            holds[self.parents[k]] = max(holds[self.parents[k]], holds[k])
        dropped, article = [False] * n, [0] * n
        of_header = [False] * n  # dropped, by a header within an article alone
        for k in range(1, n):
            name, above, others = self.names[k], self.parents[k], self.marks[k] & OTHERS
            article[k] = article[above] or (k if name in MAIN and not dropped[above] else 0)
            if name in BOILERPLATE and name not in SOFT:
                drop = holds[k] < 3
            elif name in PROSE:
                drop = bool(self.marks[k]) and self.sizes[k] < SURGE
            elif name in SOFT or self.marks[k]:
                drop = holds[k] < (2 if others else 1) and (bool(others) or 2 * self.sizes[k] <= shown)
            else:
                drop = False
            if name == "header" and article[above] and not dropped[above]:
                of_header[k] = True
            elif of_header[above] and not drop:
                of_header[k] = name not in HEADINGS
            dropped[k] = drop or (dropped[above] and not (of_header[above] and name in HEADINGS))
        return dropped, article


def strip_markup(page: str) -> tuple[list[tuple[str, int, int, bool]], list[int]]:
    """Lines as (text, weight, article or main that they are within, is a heading), and the
    container of each article. Lines of boilerplate containers are empty and weigh nothing;
    links weigh something within articles only."""
    page = _shown(page)
    tree = _Tree()
    stack = [0]
    lines: list[tuple[int, list[tuple[int, str, bool]]]] = []  # container at the end; text by container, in a link
    parts: list[tuple[int, str, bool]] = []
    linked = False

    def close_line() -> None:
        lines.append((stack[-1], parts.copy()))
        parts.clear()

    def put(text: str) -> None:
        parts.append((stack[-1], text, linked))
        tree.sizes[stack[-1]] += len(text.strip())

    at = 0
    for tag in _TAG.finditer(page):
        put(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        closing = tag[1] == "/"
        if name == "br":
            put(" ")
            continue
        if name == "a":
            linked = not closing
            continue
        if name in BLOCKS:
            close_line()
            linked = False
        if not name or name in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if tree.names[stack[depth]] == name:
                    del stack[depth:]
                    break
        elif name in BLOCKS or name in BOILERPLATE:
            if name in ("p", "li", "td", "tr", "dd", "dt", "option") and tree.names[stack[-1]] == name:
                stack.pop()  # its end tag may be left out
            stack.append(tree.add(name, stack[-1], tag[3]))
    put(page[at:])
    close_line()

    dropped, article = tree.settle()
    told = []
    for container, held in lines:
        held = [(text, link) for k, text, link in held if not dropped[k]]
        text = " ".join(entities.unescape("".join(text for text, _ in held)).split())
        free = sum(len(t.strip()) for t, link in held if not link) if text else 0
        weight = NAMED * len(text) if article[container] else free
        told.append((text, weight, article[container], tree.names[container] in HEADINGS))
    return told, tree.parents


def spans(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """First lines and ends of the texts among weighed lines. Block i sums the weights of
    ``window`` lines from line i on. A text surges where a block rises from nothing, dives
    where a block falls to nothing again, and counts if its highest block reaches ``surge``
    or half of the highest of all, whichever is less."""
    sums = [0, *accumulate(weights)]
    blocks = [sums[min(i + window, len(weights))] - sums[i] for i in range(len(weights))]
    least = min(surge, max(blocks, default=0) / 2)
    found, i = [], 0
    while i < len(blocks):
        start = i
        while i < len(blocks) and blocks[i]:
            i += 1
        if i > start and max(blocks[start:i]) >= least:
            found.append((start, i))
        i += i == start
    return found


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The article of one page, its blocks joined by line breaks.

    The sums over windows of lines choose the texts (see ``spans``). Where they lie within
    named articles, the article is these, and those beside them in the same container, as
    a whole and nothing else. Elsewhere it is all lines from the first text to the end of
    the last one, short texts and links between them and headings right before them included.
    """
    if not page:
        return ""
    lines, parents = strip_markup(page)
    chosen = spans([weight for _, weight, _, _ in lines], window, surge)
    if not chosen:
        return ""
    met = {parents[a] for start, end in chosen for _, weight, a, _ in lines[start:end] if a and weight}
    if met:
        return "\n".join(t for t, _, a, _ in lines if t and a and parents[a] in met)
    first, last = chosen[0][0], chosen[-1][1]
    k = first - 1
    while k >= 0 and (not lines[k][0] or (lines[k][1] and lines[k][3])):
        first = k if lines[k][0] else first
        k -= 1
    return "\n".join(t for t, *_ in lines[first:last] if t)


@F.pandas_udf(T.StringType())
def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None)


def extract_text(html: Column) -> Column:
    """The main text of each value of a column of HTML."""
    return _main_text(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars (its code points).

    Null and empty pages give an empty text, as do pages of nothing but boilerplate.
    Cut-off pages are read as far as they go. Repeated rows and null keys stay; no
    other column is read; an empty table gives an empty result.
    """
    return pages.select("page_id", "url", extract_text(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
