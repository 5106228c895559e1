"""Main text of web pages: a tree-structured graphical model over DOM blocks, solved by sum-product messages."""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import table

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title template iframe noembed noframes".split())
NEVER = set("noscript svg select button object audio video canvas datalist".split())
BLOCKS = set(
    "html head body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot "
    "tr td th form fieldset legend figure figcaption blockquote pre address details summary dialog center menu hgroup search".split()
)
ENDS_PARAGRAPH = BLOCKS - set("html head body caption thead tbody tfoot tr td th".split())
SAME_CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

#: Words of classes, ids and roles that are features. Others are not, so the model has a bounded size.
CUES = {
    "content": set("article content main post entry body story text prose".split()),
    "other": set(
        "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent disqus feedback footer form header login masthead menu "
        "modal nav navbar navigation newsletter notice pagination popup promo promoted recommended related reply replies respond search share sharing "
        "sidebar signup social sponsor sponsored subscribe tags toolbar widget contentinfo complementary alert dialog".split()
    ),
}
#: Element and cue features start with these counts (content, other), so that a page type without training pages works.
PRIOR = {"cue:other": (0.2, 60.0), "cue:content": (8.0, 2.0)} | {f"tag:{t}": (0.2, 60.0) for t in "nav footer aside form header dialog menu search".split()}
PRIOR |= {"tag:article": (40.0, 0.2), "tag:main": (20.0, 0.5)}
SMOOTH = 0.5
#: Bounds of log ratios, so that one page type among the training pages does not rule all others: of what a text looks
#: like, of an element, of an edge, and of content below other text. Elements and cues with starting counts count at least KNOWN the way these point.
LOOKS, ELEMENT, KNOWN, EDGE, BELOW_OTHER = 0.8, 1.5, 5.0, 5.3, -4.0
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile("[>\"']")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """A block element: its own text runs with their order on the page, and what its features need."""

    tag: str
    parent: int
    named: str = ""
    runs: list = field(default_factory=list)
    size: int = 0
    linked: int = 0
    stops: int = 0


class Scanner:
    """Finds the markup of a page in time linear in its length, whatever is left open in it."""

    def __init__(self, page: str):
        self.page, self.dead, self.next, self.ends = page, set(), (0, 0), {}

    def _special(self, at: int) -> int:
        """The next ``>`` or quote; the last answer holds for all places before it."""
        low, found = self.next
        if not low <= at <= found:
            match = _SPECIAL.search(self.page, at)
            self.next = (at, match.start() if match else len(self.page))
        return self.next[1]

    def _tag_end(self, at: int) -> int:
        """Place after the ``>`` that ends a tag outside quotes, or -1. Quotes from which no end was found are remembered."""
        page, visited = self.page, []
        while True:
            at = self._special(at)
            if at < len(page) and page[at] == ">":
                return at + 1
            close = page.find(page[at], at + 1) if at < len(page) and at not in self.dead else -1
            if close < 0:
                self.dead.update(visited, [at])
                return -1
            visited.append(at)
            at = close + 1

    def token(self, at: int) -> tuple[int, int, bool, str | None, str]:
        """Start and end of the next markup from ``at`` on, whether it closes, its name and its attributes."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0 or start + 1 >= len(page):
                return len(page), len(page), False, None, ""
            follows = page[start + 1]
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), False, None, ""
            if follows in "!?" or (follows == "/" and not page[start + 2 : start + 3].isalpha()):
                last = "]]>" if page.startswith("<![CDATA[", start) else ">"
                if last not in self.ends or self.ends[last] >= 0 and self.ends[last] < start:
                    self.ends[last] = page.find(last, start)
                if (end := self.ends[last]) >= 0:
                    return start, end + len(last), False, None, ""
            elif (name := _NAME.match(page, start)) and (end := self._tag_end(name.end())) >= 0:
                return start, end, follows == "/", name[1].lower(), page[name.end() : end - 1]
            at = start + 1

    def closed(self, name: str, start: int) -> int | None:
        """Place after the end tag of the element that begins at ``start``, or None if it is left open."""
        if name not in self.ends:
            pairs, open_ = {}, []
            for tag in re.finditer(rf"<(/?){name}(?=[\s/>])", self.page, re.I):
                if not tag[1]:
                    open_.append(tag.start())
                elif open_ and (end := self._special_end(tag.end())) >= 0:
                    pairs[open_.pop()] = end
            self.ends[name] = pairs
        return self.ends[name].get(start)

    def _special_end(self, at: int) -> int:
        return self.page.find(">", at) + 1 or -1

    def raw_end(self, name: str, at: int) -> int:
        """Place after the end tag of an element without markup inside; the end of the page without one."""
        key = f"/{name}"
        known = self.ends.get(key, (0, 0, 0))
        if not known[0] <= at <= known[1]:
            found = re.compile(rf"</{name}\s*>", re.I).search(self.page, at)
            known = self.ends[key] = (at, found.start(), found.end()) if found else (at, len(self.page), len(self.page))
        return known[2]


def parse(page: str) -> list[Node]:
    """Blocks in page order, parents first. Inline elements belong to their block; ``br`` and ``hr`` end a run.

    Forms' buttons and lists, drawings and players are left out as a whole if they are closed; one that is left open is
    an inline element, so it takes nothing of the page along.
    """
    scanner = Scanner(page)
    nodes = [Node("#root", -1)]
    stack, at, order, links = [0], 0, 0, 0
    text: list[str] = []

    def close_run():
        nonlocal order
        if text:
            run = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if run:
                node = nodes[stack[-1]]
                node.runs.append((order, run))
                order += 1

    def add(raw: str):
        if raw:
            text.append(raw)
            node = nodes[stack[-1]]
            n = len(raw.strip())
            node.size += n
            node.linked += n if links else 0
            node.stops += sum(map(raw.count, ".,;:!?"))

    position = 0
    while True:
        start, end, slash, name, attributes = scanner.token(position)
        add(page[position:start])
        if start >= len(page):
            break
        position = end
        if name is None:
            continue
        if name in RAW or name in NEVER:
            if not slash and not attributes.rstrip().endswith("/"):
                position = scanner.raw_end(name, position) if name in RAW else scanner.closed(name, start) or position
            continue
        if name in ("br", "hr"):
            close_run()
        elif name == "a":
            links = 0 if slash else 1
        elif name in BLOCKS:
            close_run()
            links = 0
            if slash:
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == name:
                        del stack[depth:]
                        break
            else:
                if name in ENDS_PARAGRAPH and nodes[stack[-1]].tag == "p":
                    stack.pop()
                if name in SAME_CLOSES:
                    for depth in range(len(stack) - 1, 0, -1):
                        tag = nodes[stack[depth]].tag
                        if tag == name:
                            del stack[depth:]
                            break
                        if tag in SAME_CLOSES[name]:
                            break
                named = " ".join(m.strip("\"'") for m in _NAMED.findall(attributes)).lower() if attributes else ""
                nodes.append(Node(name, stack[-1], named))
                stack.append(len(nodes) - 1)
    close_run()
    return nodes


def features(node: Node) -> list[str]:
    """Element, cue words, share of linked text, amount of text, and sentence marks."""
    out = [f"tag:{node.tag}"]
    if node.named:
        words = set(_WORD.findall(node.named))
        out += [f"cue:{kind}" for kind, cues in CUES.items() if words & cues]
    size = node.size
    share = node.linked / size if size else 0
    out.append("links:none" if not node.linked else "links:some" if share < 0.5 else "links:most")
    out.append("text:none" if not size else "text:short" if size < 40 else "text:middle" if size < 160 else "text:long")
    if size:
        out.append("marks:none" if not node.stops else "marks:one" if node.stops == 1 else "marks:more")
    return out


def is_labelled(nodes: list[Node]) -> bool:
    """Pages that mark their article are training pages."""
    return any(n.tag in ("article", "main") for n in nodes)


def labels(nodes: list[Node]) -> list[int]:
    """1 below (or at) an article or main element, 0 again below elements and cues that are not part of an article."""
    out: list[int] = []
    for n in nodes:
        label = out[n.parent] if n.parent >= 0 else 0
        if n.tag in ("article", "main"):
            label = 1
        if n.tag in ("nav", "footer", "aside", "form", "dialog", "menu", "search") or set(_WORD.findall(n.named)) & CUES["other"]:
            label = 0
        out.append(label)
    return out


@dataclass
class TreeModel:
    """Log potentials: of a feature in each state, of (parent state, child state), and of the root."""

    feature: dict[str, tuple[float, float]]
    edge: list[list[float]]
    root: tuple[float, float]


def model_of(counts: dict[str, tuple[float, float]], edges: list[list[float]]) -> TreeModel:
    """Counts by feature as (content, other) and by [parent state][child state] to log probabilities (state 0: other)."""
    total = [sum(c[1] for k, c in counts.items() if k.startswith("tag:")) + 1, sum(c[0] for k, c in counts.items() if k.startswith("tag:")) + 1]
    logs = {}
    for name in {*counts, *PRIOR}:
        one, zero = (a + b + SMOOTH for a, b in zip(counts.get(name, (0, 0)), PRIOR.get(name, (0, 0))))
        ratio = math.log(one / (total[1] + 60)) - math.log(zero / (total[0] + 60))
        if name in PRIOR:
            ratio = max(ratio, KNOWN) if PRIOR[name][0] > PRIOR[name][1] else min(ratio, -KNOWN)
        else:
            most = ELEMENT if name.startswith(("tag:", "cue:")) else LOOKS
            ratio = max(-most, min(most, ratio))
        logs[name] = (-ratio / 2, ratio / 2)
    edge = []
    for p in (0, 1):
        gap = math.log((edges[p][1] + SMOOTH) / (edges[p][0] + SMOOTH))
        gap = max(-EDGE, min(EDGE if p else BELOW_OTHER, gap))
        edge.append([-math.log1p(math.exp(gap)), -math.log1p(math.exp(-gap))])
    return TreeModel(logs, edge, (math.log(0.9), math.log(0.1)))


def marginals(nodes: list[Node], model: TreeModel) -> list[float]:
    """Probability of content of every node: messages from the leaves to the root and back."""

    def add(a: float, b: float) -> float:
        m = a if a > b else b
        return m + math.log(math.exp(a - m) + math.exp(b - m))

    n = len(nodes)
    below = [[0.0, 0.0] for _ in range(n)]  # own evidence and that of the subtree
    sent = [[0.0, 0.0] for _ in range(n)]  # message to the parent
    e = model.edge
    for i in range(n - 1, -1, -1):
        zero, one = below[i]
        for f in features(nodes[i]):
            own = model.feature.get(f)
            if own:
                zero += own[0]
                one += own[1]
        below[i] = [zero, one]
        p = nodes[i].parent
        if p >= 0:
            message = [add(e[s][0] + zero, e[s][1] + one) for s in (0, 1)]
            sent[i] = message
            below[p][0] += message[0]
            below[p][1] += message[1]
    above = [[0.0, 0.0] for _ in range(n)]
    above[0] = list(model.root)
    out = [0.0] * n
    for i in range(n):
        p = nodes[i].parent
        if p >= 0:
            rest = [above[p][s] + below[p][s] - sent[i][s] for s in (0, 1)]
            above[i] = [add(rest[0] + e[0][c], rest[1] + e[1][c]) for c in (0, 1)]
            m = max(above[i])
            above[i] = [above[i][0] - m, above[i][1] - m]
        gap = above[i][0] + below[i][0] - above[i][1] - below[i][1]
        out[i] = 1 / (1 + math.exp(min(gap, 700)))
    return out


def main_text(page: str | None, model: TreeModel) -> str:
    """Runs of the blocks that are content by their marginal, in page order, joined by one space."""
    if not page:
        return ""
    nodes = parse(page)
    chosen = [r for n, m in zip(nodes, marginals(nodes, model)) if m > 0.5 and n.tag != "head" for r in n.runs]
    return " ".join(run for _, run in sorted(chosen))


def _counted(batches):
    counts: dict[tuple[str, int], int] = {}
    for batch in batches:
        for page in batch.column("html").to_pylist():
            nodes = parse(page) if page else []
            if not is_labelled(nodes):
                continue
            marks = labels(nodes)
            for node, mark in zip(nodes, marks):
                for f in features(node):
                    counts[f, mark] = counts.get((f, mark), 0) + 1
                if node.parent >= 0:
                    key = (f"edge:{marks[node.parent]}", mark)
                    counts[key] = counts.get(key, 0) + 1
    rows = list(counts.items())
    columns = [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["feature", "label", "n"])


def train(pages: DataFrame, html_col: str = "html") -> TreeModel:
    """Counts over all pages that mark their article; without such pages the starting counts decide alone."""
    sums = pages.select(F.col(html_col).alias("html")).mapInArrow(_counted, "feature string, label int, n long").groupBy("feature", "label").agg(F.sum("n").alias("n"))
    counts: dict[str, list[float]] = {}
    for feature, label, n in sums.collect():  # the features are a fixed set
        counts.setdefault(feature, [0.0, 0.0])[1 - label] = float(n)
    edges = [counts.pop(f"edge:{p}", [0.0, 0.0])[::-1] for p in (0, 1)]
    edges = [[x + y for x, y in zip(e, start)] for e, start in zip(edges, ([20.0, 1.0], [1.0, 20.0]))]
    return model_of({k: tuple(v) for k, v in counts.items()}, edges)


def extract(pages: DataFrame, model: TreeModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) of every row.

    Scripts, styles, comments and form controls are never text. Character references are decoded, white space becomes one
    space, and runs are joined by one space. A null or empty page, or one without content, has an empty text. Repeated
    rows and null ids or urls are rows like all others; an empty table gives no rows; other columns are ignored.
    """
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(page, model) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = dict(slim.dtypes)
    return slim.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


QUERIES = {"op10_html_main_text": query}
ORACLE: dict[str, str] = {}
