"""Main text of web pages by tag-path ratios.

A page is cut into blocks, the text between tags that begin or end a block. Blocks with the same path of tags
from the root share a ratio: characters a block, those in links counted by a tenth, times one more than ten times the
share of punctuation in the characters. Ratios are smoothed over the paths next to each other in the page; paths in one container fuse to
the best of them, and a container takes half the score of the one around it, as far as its text is no links. A prior
weighs the score: elements that by tag, class, id or role are usually no part of an article weigh next to
nothing, a marked article weighs more. Paths with a share of the page's best score are content, on every page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: A path is content from this share of the page's best score on, and from this score on.
THRESHOLD, LEAST = 0.15, 1.0
#: What characters in links count, and what a container takes of the score around it.
LINKED, AROUND = 0.1, 0.5
#: How much a share of punctuation weighs.
MARKS = 10
#: Weights of scores: of what is usually outside an article, of what nothing is known about, of a marked article.
PRIORS = (1e-9, 1.0, 1e4)
OUT, PLAIN, MARK = range(3)
#: Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr".split())
#: A start tag ends an open element of these, inside the nearest of those.
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
#: What these open or end is found without a look through all open elements: each group keeps its open elements apart.
P_SCOPE = frozenset("p td th button table".split())
GROUPS = (P_SCOPE, frozenset("li ul ol menu dir".split()), frozenset("dd dt dl".split()), frozenset("tr td th table".split()))
GROUPS_OF = {tag: tuple(k for k, group in enumerate(GROUPS) if tag in group) for tag in frozenset().union(*GROUPS)}
GROUP_OF_SIBLINGS = {"li": 1, "dd": 2, "dt": 2, "tr": 3, "td": 3, "th": 3}
VOID = frozenset(["hr"])
OUTSIDE = frozenset("aside button dialog dir fieldset footer form head menu nav search select".split())
#: Names of parts that are no article, as words of class, id and role.
OUTSIDE_NAMES = frozenset(
    "ad ads adsense advert advertisement advertisements adverts alert aside banner breadcrumb breadcrumbs colophon comment comments commentlist consent contentinfo cookie cookies discussion disqus feedback footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion reactions recommended related replies respond responses search share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)
#: A header by name is the page's, unless it stands in a marked article or has one of these names too.
ARTICLE_NAMES = frozenset("article content entry post story".split())
MARKED = frozenset(["article", "main"])
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"""
    r"""|<(script|style|title|textarea|template|noscript|noembed|noframes|iframe|object|svg|math|canvas|select|button)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1\b[^>]*+>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，؛؟]")


def named_outside(attributes: str, marked: bool) -> bool:
    for name, *values in NAMES.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id", "role"):
            words = re.split(r"[^a-z]+", value)
            if not OUTSIDE_NAMES.isdisjoint(words) or "header" in words and not marked and ARTICLE_NAMES.isdisjoint(words):
                return True
    return False


class Tree:
    """Open elements and the paths they have: path 0 is the root, every other has a parent with a smaller number, a tag and a prior."""

    def __init__(self):
        self.numbers: dict[tuple[int, str, int], int] = {}
        self.parent, self.prior = [-1], [PLAIN]
        self.open: list[tuple[str, int]] = [("", 0)]
        self.count: dict[str, int] = {}
        self.groups: list[list[int]] = [[] for _ in GROUPS]

    @property
    def path(self) -> int:
        return self.open[-1][1]

    def push(self, tag: str, prior: int) -> None:
        key = (self.path, tag, prior)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.parent)
            self.parent.append(self.path)
            self.prior.append(prior)
        for k in GROUPS_OF.get(tag, ()):
            self.groups[k].append(len(self.open))
        self.open.append((tag, number))
        self.count[tag] = self.count.get(tag, 0) + 1

    def cut(self, size: int) -> None:
        """End open elements until so many are left."""
        while len(self.open) > size:
            tag, _ = self.open.pop()
            self.count[tag] -= 1
            for k in GROUPS_OF.get(tag, ()):
                self.groups[k].pop()

    def close(self, tag: str) -> bool:
        """End the innermost open element of that tag and all in it, if there is one."""
        if not self.count.get(tag):
            return False
        while self.open[-1][0] != tag:
            self.cut(len(self.open) - 1)
        self.cut(len(self.open) - 1)
        return True

    def make_room(self, tag: str) -> None:
        """End what a start tag ends: a paragraph, and siblings of a list or table up to their container."""
        scope = self.groups[0]
        if tag in ENDS_P and scope and self.open[scope[-1]][0] == "p":
            self.cut(scope[-1])
        if tag in SIBLINGS:
            ended, _ = SIBLINGS[tag]
            group = self.groups[GROUP_OF_SIBLINGS[tag]]
            while group and self.open[group[-1]][0] in ended:
                self.cut(group[-1])
                if tag != "tr":
                    break


def blocks(html: str) -> tuple[list[tuple[int, str, int]], Tree]:
    """(path, text, characters in links) of each block in page order, and the tree of paths. Time is linear, however deep tags nest."""
    found: list[tuple[int, str, int]] = []
    tree, parts = Tree(), []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                found.append((tree.path, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    end, token = html.rfind(">") + 1, None  # no tag ends after that
    for token in TOKEN.finditer(html, 0, end):
        if token.start() > at:
            parts.append(html[at : token.start()])
            linked += (token.start() - at) * (links > 0)
        at = token.end()
        raw, closes, tag, attributes = token.groups()
        if tag is None:
            if raw:
                parts.append(" ")
            continue
        tag = tag.lower()
        prior = tree.prior[tree.path]
        if tag not in BLOCKS:
            if tag == "a":
                links = 0 if closes else 1
            elif tag in ("br", "wbr", "img", "input"):
                parts.append(" ")
            elif closes:
                if tree.count.get(tag):
                    flush()
                    tree.close(tag)
            elif attributes and not attributes.endswith("/") and named_outside(attributes, prior == MARK):
                # an inline element that is no article, such as a hidden span, ends the block around it
                flush()
                tree.push(tag, OUT)
            continue
        flush()
        if closes:
            if tree.close(tag):
                links = 0
            continue
        tree.make_room(tag)
        if tag in VOID:
            continue
        prior = tree.prior[tree.path]
        if tag in OUTSIDE or tag == "header" and prior != MARK or attributes and tag not in ("html", "body", "main", "h1") and named_outside(attributes, prior == MARK):
            prior = OUT
        elif prior == PLAIN and tag in MARKED:
            prior = MARK
        tree.push(tag, prior)
    if at < end:
        parts.append(html[at:end])
    if token is None or at < end or not _breaks_off(token):
        tail = html[end:]
        cut = re.search(r"<[a-zA-Z/!?]", tail)  # a tag that the page breaks off in
        parts.append(tail[: cut.start()] if cut else tail)
    flush()
    return found, tree


def _breaks_off(token: re.Match) -> bool:
    """Whether the page ends in this comment or element, which never ends."""
    text = token[0]
    if text.startswith("<!--"):
        return not text.endswith("-->")
    if text.startswith("<![CDATA["):
        return not text.endswith("]]>")
    return bool(token[1]) and not re.search(rf"</{token[1]}\b[^>]*>\Z", text[-4096:], re.I)


def scored(found: list[tuple[int, str, int]], tree: Tree) -> dict[int, float]:
    """The score of each path that has blocks."""
    sums: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0, 0])
    for path, text, linked in found:
        own = sums[path]
        own[0] += 1
        own[1] += len(text)
        own[2] += linked
        own[3] += len(PUNCTUATION.findall(text))
    ratio = {p: (chars - (1 - LINKED) * linked) / n * (1 + MARKS * marks / chars) for p, (n, chars, linked, marks) in sums.items()}
    runs = [p for k, (p, *_) in enumerate(found) if not k or found[k - 1][0] != p]
    smooth: dict[int, float] = defaultdict(float)
    for k, p in enumerate(runs):
        near = [ratio[q] for q in runs[max(0, k - 1) : k + 2]]
        smooth[p] = max(smooth[p], (ratio[p] + sum(near) / len(near)) / 2)
    # containers by number and the prior of what they hold; a parent's number is smaller
    fused: dict[tuple[int, int], float] = defaultdict(float)
    for p, score in smooth.items():
        key = (tree.parent[p], tree.prior[p])
        fused[key] = max(fused[key], score)
    taken = [[0.0] * len(PRIORS) for _ in tree.parent]
    for c, parent in enumerate(tree.parent):
        for k in range(len(PRIORS)):
            taken[c][k] = max(fused.get((c, k), 0.0), AROUND * taken[parent][k] if parent >= 0 else 0.0)
    out = {}
    for p, (_, chars, linked, _) in sums.items():
        container, prior = tree.parent[p], tree.prior[p]
        outer = tree.parent[container] if container >= 0 else -1
        around = AROUND * taken[outer][prior] * (1 - (1 - LINKED) * linked / chars) if outer >= 0 else 0.0
        out[p] = PRIORS[prior] * max(fused[container, prior], around)
    return out


def main_text(html: str | None) -> str:
    found, tree = blocks(html or "")
    score = scored(found, tree)
    least = max(LEAST, THRESHOLD * max(score.values(), default=0.0))
    return "\n".join(text for path, text, _ in found if score[path] >= least)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars; a row for each row of pages (page_id, url, html), other columns ignored.

    Null or empty html, and pages without a path that scores enough, have an empty text. Unclosed and stray
    tags, comments that never end and pages that break off in a tag are read as far as they go. Repeated rows and
    null page_ids are each a page.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
