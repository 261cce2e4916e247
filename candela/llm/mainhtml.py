"""Main text of web pages by line-block distribution (numbered operator 8).

Markup is stripped into lines, one per block element. Lines in page furniture (navigation, headers, footers, sidebars, forms, notices,
adverts, comments, by element or by the words of class, id and role) are taken out first. The distribution is the text length summed
over windows of WINDOW lines from each line on. It surges where a stretch of text starts and dives where it ends, on every page. Links
count as no text; text in an article or main element counts RAISE times, and there the lines without text (short of a window) at the
ends of a stretch belong to it.

The largest stretch is kept, and with it all that surge in the same container: in articles if most of its text is in one, otherwise in the smallest
div, article, main or body that holds its lines; in the latter case also those outside of articles with a PEER-th of that text or more, wherever they
are. Of the lines of a stretch that are outside of articles, those with hardly a word outside of links are left out.

Words of class, id and role also stand on wrappers of a whole page ("has-sidebar"), so they hide no element that holds WRAPS of the text left
when elements alone decide, if that is more than a stretch.

An article inside of furniture is furniture, unless the furniture was never closed: neither it nor, by its end tag, an element of
the same name around it.

Character references are decoded, white space in a line becomes one space, lines are joined by one \\n.

Defined results: null and empty pages, and pages without text, give an empty text; unclosed and stray tags, cut-off pages, comments and
references are taken as they stand; repeated rows are treated alike; other columns pass through, those named like an output are replaced.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 3
SURGE = 60      # characters in a window that start a stretch of text
RAISE = 2       # what a character in an article counts
PEER = 2
WRAPS = 0.75
LEAST_PLAIN = 12    # characters outside of links that make a line of a stretch text
#: Fixed lists of element names and of words in class, id and role.
HIDDEN = "script style noscript template svg head title iframe object select textarea button canvas math"
FURNITURE = "nav footer aside form menu dialog header"
BLOCKS = ("p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr td th thead tbody tfoot caption pre blockquote section article main figure figcaption "
          "hr address details summary center fieldset legend nav footer aside form menu dialog header body html")
VOID = "br hr img input meta link area base col embed source track wbr param"
WORDS = ("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
         "subscribe signup login search sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies respond "
         "share sharing social related recommended pagination pager toolbar widget widgets skip disclaimer")
CONTAINERS = "div article main body html"
_HIDDEN, _FURNITURE, _BLOCKS, _VOID, _WORDS, _CONTAINERS = (frozenset(x.split()) for x in (HIDDEN, FURNITURE, BLOCKS, VOID, WORDS, CONTAINERS))
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|textarea|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _furniture(name: str, attrs: str, in_article: bool) -> bool:
    if name in _FURNITURE:
        return not (name == "header" and in_article)
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    return any(not _WORDS.isdisjoint(_SPLIT.split("".join(m).lower())) for m in _NAMED.findall(attrs))


def _never_closed(tags: list[re.Match]) -> set[int]:
    """Numbers of the tags that open an element without an end tag of its own, or in one of the same name without one (whose end
    tag may be the one found)."""
    stack: list[tuple[str, int]] = []
    ends: dict[int, bool] = {}
    around: dict[int, int | None] = {}
    opened: dict[str, list[int]] = {}

    def pop(ended: bool) -> None:
        name, i = stack.pop()
        opened[name].pop()
        ends[i] = ended

    for i, m in enumerate(tags):
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            if opened.get(name):
                while stack[-1][0] != name:
                    pop(False)
                pop(True)
        elif name not in _VOID and not m["attrs"].endswith("/"):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                pop(True)
            same = opened.setdefault(name, [])
            around[i] = same[-1] if same else None
            stack.append((name, i))
            same.append(i)
    while stack:
        pop(False)
    never: set[int] = set()
    for i, outer in around.items():     # outer elements first
        if not ends[i] or outer in never:
            never.add(i)
    return never


class Page:
    """``lines``: (text, characters outside of links, whether furniture, whether in an article, innermost element) of each line with
    text; of each element, its name and the element around it (-1: none)."""

    def __init__(self, html: str, by_words: bool = True, wrappers: frozenset[int] = frozenset()):
        self.by_words = 0     # elements that words hide
        self.lines: list[tuple[str, int, bool, bool, int]] = []
        self.names: list[str] = []
        self.parents: list[int] = []
        self.tags: list[int] = []       # number of an element's start tag
        tags = list(_MARKUP.finditer(html))
        never: set[int] | None = None
        stack: list[tuple[str, bool, int, int]] = []    # open elements that are not void: whether each hides its text, numbers of element and tag
        opened: dict[str, int] = {}
        shut = links = articles = 0
        held: list[str] = []
        plain = at = 0

        def text(data: str) -> None:
            nonlocal plain
            if data:
                data = unescape(data)
                held.append(data)
                if not links:
                    plain += len(data) - data.count(" ")

        def end_line() -> None:
            nonlocal plain
            line = " ".join("".join(held).split())
            if line:
                self.lines.append((line, plain and min(len(line), plain + line.count(" ")), shut > 0, articles > 0, stack[-1][2] if stack else -1))
            held.clear()
            plain = 0

        def count(entry: tuple[str, bool, int, int], by: int) -> None:
            nonlocal shut, links, articles
            name, hides, _, _ = entry
            opened[name] = opened.get(name, 0) + by
            shut += by * hides
            links += by * (name == "a")
            articles += by * (name in ("article", "main"))

        def pop() -> None:
            count(stack.pop(), -1)

        for number, m in enumerate(tags):
            text(html[at:m.start()])
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                continue
            if name in _BLOCKS:
                end_line()
            elif name == "br":
                held.append(" ")
            if m["close"]:
                if opened.get(name):
                    while stack[-1][0] != name:
                        pop()
                    pop()
            elif name not in _VOID and not m["attrs"].endswith("/"):
                if name in ("article", "main") and shut:
                    never = _never_closed(tags) if never is None else never
                    first = next((i for i, x in enumerate(stack) if x[1] and x[3] in never), len(stack))
                    for x in stack[first:]:     # furniture that was never closed ends here, with what else in it was not
                        if x[3] in never:
                            count(x, -1)
                    stack[first:] = [x for x in stack[first:] if x[3] not in never]
                elif name in ("p", "li") and stack and stack[-1][0] == name:
                    pop()
                self.names.append(name)
                self.tags.append(number)
                self.parents.append(stack[-1][2] if stack else -1)
                hides = name in _HIDDEN or _furniture(name, m["attrs"], articles > 0)
                if hides and name not in _HIDDEN and name not in _FURNITURE:
                    hides = by_words and len(self.names) - 1 not in wrappers
                    self.by_words += hides
                stack.append((name, hides, len(self.names) - 1, number))
                count(stack[-1], 1)
        text(html[at:])
        end_line()

    def container(self, elements: list[int]) -> int:
        """The smallest container of lines with these innermost elements (a line's own element is none)."""
        held = [0] * (len(self.names) + 1)      # lines in each element; the last: in the page, number -1
        for x in elements:
            held[x] += 1
        for i in reversed(range(len(self.names))):
            held[self.parents[i]] += held[i]
        at = max((i for i in range(len(self.names)) if held[i] == len(elements)), default=-1)
        if at >= 0 and len({*elements}) == 1 and self.names[at] not in ("article", "main", "body"):
            at = self.parents[at]
        while at >= 0 and self.names[at] not in _CONTAINERS:
            at = self.parents[at]
        return at

    def within(self, container: int) -> list[bool]:
        """Whether each element, and last the page, is the container or in it."""
        out = [False] * len(self.names) + [container < 0]
        for i, outer in enumerate(self.parents):
            out[i] = i == container or out[outer]
        return out


def read(html: str) -> Page:
    """A page whose wrappers hide nothing."""
    page = Page(html)
    if not page.by_words:
        return page
    bare = Page(html, by_words=False)
    held = [0] * (len(bare.names) + 1)
    for _, plain, shut, _, x in bare.lines:
        if not shut:
            held[x] += plain
    whole = sum(held)
    for i in reversed(range(len(bare.names))):
        held[bare.parents[i]] += held[i]
    wrappers = {i for i in range(len(bare.names)) if held[i] >= WRAPS * whole and held[i] >= 2 * SURGE}
    if wrappers:    # what was never closed wraps by accident
        never = _never_closed(list(_MARKUP.finditer(html)))
        wrappers = {i for i in wrappers if bare.tags[i] not in never}
    return Page(html, wrappers=frozenset(wrappers)) if wrappers else page


def main_text(html: str | None) -> str:
    page = read(html or "")
    lines = [x for x in page.lines if not x[2]]
    article = [x[3] for x in lines]
    weight = [(RAISE if x[3] else 1) * x[1] if 2 * x[1] > len(x[0]) else 0 for x in lines]
    block = [sum(weight[i:i + WINDOW]) for i in range(len(weight))]
    stretches, i = [], 0
    while i < len(block):
        if block[i] < SURGE or not weight[i]:
            i += 1
            continue
        start = end = i
        while end < len(block) and block[end]:     # the dive: a window without text
            end += 1
        last = end
        floor = stretches[-1][1] if stretches else 0
        while start > floor and article[start - 1] and block[start - 1]:
            start -= 1
        while end < min(len(block), last + WINDOW - 1) and article[end] and article[end - 1]:
            end += 1
        stretches.append((start, end))
        i = end
    if not stretches:      # nothing surges: all that is no furniture
        return "\n".join(x[0] for x in lines)
    best = max(stretches, key=lambda x: sum(weight[x[0]:x[1]]))
    inside = range(*best)
    marked = 2 * sum(weight[i] for i in inside if article[i]) > sum(weight[i] for i in inside)
    keep = {*inside}
    if len(stretches) > 1:
        near = page.within(page.container([lines[i][4] for i in inside if weight[i]]))
        keep.update(i for x in stretches for i in range(*x) if (article[i] if marked else near[lines[i][4]]))
        least = sum(weight[i] for i in keep)
        for x in stretches:
            if not marked and PEER * sum(weight[i] for i in range(*x)) >= least and not any(article[i] for i in range(*x)):
                keep.update(range(*x))
    return "\n".join(lines[i][0] for i in sorted(keep) if weight[i] or article[i] or lines[i][1] >= LEAST_PLAIN)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without the markup column and with ``text``, the main text."""
    carried = pages.drop(*({text} - {html}))
    out_fields = [f for f in carried.schema.fields if f.name != html]
    schema = T.StructType([*out_fields, T.StructField(text, T.StringType())])

    def run(batches):
        for batch in batches:
            names = [n for n in batch.schema.names if n != html]
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = pa.array([main_text(x) for x in part.column(html).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), got], names=[*names, text])
    return carried.mapInArrow(run, schema)
