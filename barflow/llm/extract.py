"""Main text of web pages by minimum cut.

A page becomes blocks of text with their place in the DOM. A classifier of
block features gives each block a cost for either label; these are the
capacities to the two terminals. Edges between neighbours in the page and
between neighbours in the DOM cost what it takes to label them differently. The
minimum cut separates content from boilerplate at the least total cost.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from math import exp

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import ARROW

# Element names by role.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "select", "textarea",
       "button", "canvas", "audio", "video"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "img", "nobr"}
BOILERPLATE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset", "address"}
CONTENT = {"article": 5.0, "main": 4.0}
CLOSED_BY_SIBLING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
#: Elements of RAW whose content is text up to their end tag, whatever stands in it; without one, the rest of the page.
TEXT_ONLY = {"script", "style", "noscript", "iframe", "textarea"}
#: Elements that may stand in a head; any other one ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "title", "style", "script", "noscript", "template", "head", "html"}
#: Words in class, id or role names.
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|"
    r"overlay|newsletter|subscri\w*|signup|login|menu\w*|nav\w*|breadcrumbs?|sidebar\w*|side|widgets?|related|recommend\w*|"
    r"shar(?:e|ing)|social|comments?|commentlist|repl(?:y|ies)|disqus|discussion|responses?|footer|header|masthead|copyright|"
    r"legal|disclaimer|pager|pagination|search\w*|toolbar|skip|hidden|form|complementary|contentinfo|navigation)(?:$|[\s_-])", re.I)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|content|entry|main|post|story|body|text)(?:$|[\s_-])", re.I)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
# In a tag a quote opens a value only after an equals sign (title=it's has none); the group gives nothing back, so a tag is read once.
_MARKUP = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|</?[a-zA-Z][^>]*(?:>|$)""", re.S)
_WORD = re.compile(r"\w+")


def _head_end(html: str, at: int) -> int:
    """Where a head ends: after its end tag, or before what can't stand in it."""
    while m := _MARKUP.search(html, at):
        name = (m[2] or "").lower()
        text = html[at:m.start()]
        if text.strip():
            return m.start() - len(text.lstrip())
        if name and m[1]:
            if name == "head":
                return m.end()
            if name in ("body", "html"):
                return m.start()
        elif name and name not in IN_HEAD:
            return m.start()
        at = m.end()
        if name and not m[1] and (name in TEXT_ONLY or name in ("title", "template")):
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = len(html) if end is None else end.end()
    return len(html) if not html[at:].strip() else at


def _skipped(html: str, at: int, name: str, around: list[str]) -> int:
    """Where the element of RAW that opened before ``at`` ends: after its end
    tag, where it isn't text only also before an end tag of an element around it."""
    if name in TEXT_ONLY:
        end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
        return len(html) if end is None else end.end()
    inner: Counter = Counter([name])
    while m := _MARKUP.search(html, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag in VOID:
            continue
        if not m[1]:
            if tag in TEXT_ONLY:
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = len(html) if end is None else end.end()
            elif not m[3].endswith("/"):
                inner[tag] += 1
        elif inner[tag]:
            inner[tag] -= 1
            if tag == name and not inner[tag]:
                return at
        elif tag in around:
            return m.start()
    return len(html)


#: Costs: a word of text, a sentence mark, a link's share, an element or name of boilerplate, neighbours.
WORD, WORDS_MOST, MARK, LINK, BAD, GOOD, HEADING, PRIOR = 0.06, 2.4, 0.5, 6.0, 9.0, 2.0, 0.5, -1.0
#: The most that elements and names of content add, however many are nested: less than a boilerplate name takes away.
GOOD_MOST = 6.0
NEXT, SIBLING, ALIKE = 0.6, 0.9, 2.0


@dataclass
class Block:
    text: str
    cost: float      # above zero: what the label boilerplate costs; below: what the label content costs
    place: float     # cost of its elements and their names alone
    parent: int
    far: int         # DOM steps from the block before


def _named(attrs: str) -> tuple[float, bool]:
    """What the class, id and role names say: evidence for content, and whether one is of boilerplate (or the element is hidden)."""
    if not attrs:
        return 0.0, False
    good, bad = 0.0, _UNSEEN.search(attrs) is not None
    for m in _NAMES.finditer(attrs):
        name = m[1] or m[2] or m[3] or ""
        if BAD_NAME.search(name):
            bad = True
        elif GOOD_NAME.search(name):
            good = GOOD
    return good, bad


def blocks(html: str) -> list[Block]:
    """Blocks of text in page order, white space folded, references decoded
    (each run of text by itself: none reaches over a tag). A place in
    boilerplate counts once, evidence for content up to ``GOOD_MOST``."""
    # element, number, evidence for content from it and around it, whether it is or stands in boilerplate
    stack: list[tuple[str, int, float, bool]] = [("", 0, 0.0, False)]
    out: list[Block] = []
    parts: list[str] = []
    opened: Counter = Counter()
    linked, made, at, links, low, depth = 0, 0, 0, 0, 0, 1  # low: the shallowest place since the last block

    def push(name: str, good: float, bad: bool) -> None:
        nonlocal made, links
        made += 1
        links += name == "a"
        opened[name] += 1
        stack.append((name, made, good, bad))

    def pop() -> str:
        nonlocal links, low
        name = stack.pop()[0]
        links -= name == "a"
        opened[name] -= 1
        low = min(low, len(stack))
        return name

    def flush() -> None:
        nonlocal parts, linked, low, depth
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                words = len(_WORD.findall(text))
                own = len(stack) - 1
                while stack[own][0] in INLINE:
                    own -= 1
                name, _, good, bad = stack[own]
                place = PRIOR + good - BAD * bad
                share = min(1.0, linked / max(1, len(text)))
                cost = place + min(WORDS_MOST, WORD * words) + MARK * (text[-1] in ".!?:;\"”»" or ". " in text) - LINK * share
                if len(name) == 2 and name[0] == "h" and name[1].isdigit():
                    cost += HEADING
                low = min(low, own + 1)
                out.append(Block(text, cost, place, stack[own - 1][1] if own else 0, depth + own + 1 - 2 * low))
                low = depth = own + 1
            parts, linked = [], 0

    n = len(html)
    while at < n:
        m = _MARKUP.search(html, at)
        stop = m.start() if m else n
        if stop > at:
            parts.append(unescape(html[at:stop]))
            if links:
                linked += len(parts[-1])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if not m[1]:  # an opening tag
            if name in RAW:
                if name == "head":
                    at = _head_end(html, at)
                elif not (name in ("svg", "math") and m[3].endswith("/")):
                    at = _skipped(html, at, name, [x[0] for x in stack])
                if name not in INLINE:
                    flush()
                continue
            if name not in INLINE:
                flush()
            if name in VOID or m[3].endswith("/"):
                continue
            if name not in INLINE:
                while stack[-1][0] in INLINE:  # formatting left open ends with its block
                    pop()
                if name in CLOSED_BY_SIBLING or stack[-1][0] == "p":
                    same = {name, "p"} if name in CLOSED_BY_SIBLING else {"p"}
                    if stack[-1][0] in same:
                        pop()
            good, bad = _named(m[3])
            push(name, min(GOOD_MOST, stack[-1][2] + good + CONTENT.get(name, 0.0)), stack[-1][3] or bad or name in BOILERPLATE)
        else:
            if name not in INLINE:
                flush()
            if opened[name]:
                while pop() != name:
                    pass
    flush()
    return out


def _edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours in the page, closer in the DOM and more alike in their places
    costing more to part; and each block with the last one of the same parent
    and the same kind of place."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, NEXT / (1 + max(0, b.far - 2)) * exp(-abs(b.place - found[i - 1].place) / ALIKE)))
        j = last.get((b.parent, b.place))
        if j is not None:
            out.append((j, i, SIBLING if j == i - 1 else SIBLING / 2))
        last[b.parent, b.place] = i
    return out


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for each node on the source's side of a minimum cut: ``costs`` above
    zero are capacities from the source, below zero to the sink.

    A node whose own cost outweighs all its open edges has its label in some
    minimum cut, so it is fixed and its edges move to its neighbours' costs;
    maximum flow decides what is left."""
    costs = list(costs)
    near: list[dict[int, float]] = [{} for _ in costs]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    open_ = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * len(costs)
    todo = deque(range(len(costs)))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(costs[i]) < open_[i]:
            continue
        label[i] = costs[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                costs[j] += w if label[i] else -w
                open_[j] -= w
                near[j].pop(i)
                todo.append(j)
    rest = [i for i, x in enumerate(label) if x is None]
    if rest:
        inside = _reachable(rest, costs, near)
        for i in rest:
            label[i] = i in inside
    return label  # type: ignore[return-value]


def _reachable(nodes: list[int], costs: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches once the flow is greatest (shortest augmenting paths)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    left = set(nodes)
    for i in nodes:
        room[i] = {j: w for j, w in near[i].items() if j in left}
    for i in nodes:
        if costs[i] > 0:
            room[source][i], room[i][source] = costs[i], 0.0
        elif costs[i] < 0:
            room[i][sink], room[sink][i] = -costs[i], 0.0
    while True:
        back = {source: source}
        queue = deque([source])
        while queue and sink not in back:
            i = queue.popleft()
            for j, w in room[i].items():
                if w > 1e-12 and j not in back:
                    back[j] = i
                    queue.append(j)
        if sink not in back:
            return set(back)
        path, j = [], sink
        while j != source:
            path.append((back[j], j))
            j = back[j]
        flow = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= flow
            room[b][a] = room[b].get(a, 0.0) + flow


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    keep = minimum_cut([b.cost for b in found], _edges(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h) for h in b.column(2).to_pylist()]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                              names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per page: blocks of the main
    text in page order, joined by line feeds, and the text's code points.

    Null or empty html, and pages without content, give an empty text; null ids
    and urls stay; repeated rows are read each; an empty table gives no rows;
    other columns are ignored. A header is left out wherever it stands, an
    article's own too. A page is read by one task, whole."""
    for key, value in ARROW.items():
        pages.sparkSession.conf.set(key, value)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
