"""Tag-path ratios against a plain restatement over a parsed tree, and hostile pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from corpusmill.llm import html

OUT, PLAIN, MARK = 1e-9, 1.0, 1e4


class Blocks(HTMLParser):
    """(path, text, characters in links) of well-formed pages of div, p, h2, ul, li, a, nav, footer and article; a path is a tuple of (tag, weight)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path, self.found, self.text, self.linked, self.inside = (), [], "", 0, False

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            self.found.append((self.path, text, min(self.linked, len(text))))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.inside = True
            return
        self.flush()
        weight = self.path[-1][1] if self.path else PLAIN
        if tag in ("nav", "footer") or dict(attrs).get("class") in ("ad", "sidebar"):
            weight = OUT
        elif tag == "article" and weight == PLAIN:
            weight = MARK
        self.path += ((tag, weight),)

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False
            return
        self.flush()
        self.path = self.path[:-1]

    def handle_data(self, data):
        self.text += data
        self.linked += len(data) * self.inside


def plain_text(page):
    parser = Blocks()
    parser.feed(page)
    parser.flush()
    found = parser.found
    paths = {p for p, _, _ in found}

    def ratio(p):
        own = [(t, n) for q, t, n in found if q == p]
        chars = sum(len(t) - 0.9 * n for t, n in own) / len(own)
        return chars * (1 + 10 * sum(t.count(c) for t, _ in own for c in ".,;:!?") / sum(len(t) for t, _ in own))

    runs = []
    for p, _, _ in found:
        if not runs or runs[-1] != p:
            runs.append(p)
    smooth = dict.fromkeys(paths, 0)
    for k, p in enumerate(runs):
        near = [ratio(q) for q in runs[max(0, k - 1) : k + 2]]
        smooth[p] = max(smooth[p], ratio(p) / 2 + sum(near) / len(near) / 2)
    weight = lambda p: p[-1][1] if p else PLAIN

    def taken(container, w):
        """Best path in the container of that weight, or half of what the container around it takes."""
        own = max([s for p, s in smooth.items() if p and p[:-1] == container and weight(p) == w], default=0)
        return max(own, taken(container[:-1], w) / 2 if container else 0)

    def score(p):
        own = [(t, n) for q, t, n in found if q == p]
        share = 1 - 0.9 * sum(n for _, n in own) / sum(len(t) for t, _ in own)
        inside = [s for q, s in smooth.items() if bool(q) == bool(p) and q[:-1] == p[:-1] and weight(q) == weight(p)]
        around = taken(p[:-2], weight(p)) / 2 * share if len(p) > 1 else 0
        return weight(p) * max(max(inside), around)

    best = max(map(score, paths), default=0)
    return "\n".join(t for p, t, _ in found if score(p) >= max(1, 0.15 * best))


def made(rng, article):
    words = lambda n: "".join(rng.choice(["word", "a", "and", "so, on", "Stop."]) + " " for _ in range(n))
    link = lambda: f'<a href="/x">{words(rng.randrange(1, 4))}</a>'

    def part(depth):
        kind = rng.choice(["p", "p", "p", "h2", "ul", "div", "ad", "links"])
        if kind == "p":
            return f"<p>{words(rng.randrange(1, 40))}{link() if rng.random() < 0.3 else ''}</p>"
        if kind == "h2":
            return f"<h2>{words(3)}</h2>"
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{words(rng.randrange(1, 8))}</li>" for _ in range(3)) + "</ul>"
        if kind == "links":
            return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(3)) + "</ul>"
        if kind == "ad":
            return f'<div class="ad"><p>{words(12)}</p></div>'
        return f"<div>{''.join(part(depth + 1) for _ in range(rng.randrange(1, 4)))}</div>" if depth < 3 else words(2)

    body = "".join(part(0) for _ in range(rng.randrange(1, 7)))
    outside = f"<nav><ul><li>{link()}</li></ul></nav><div>{link()} {link()}</div>"
    return f"<html><body>{outside}{'<article>' + body + '</article>' if article else '<div>' + body + '</div>'}<p>{words(rng.randrange(0, 9))}</p><footer>{words(5)}</footer></body></html>"


@pytest.mark.parametrize("article", [True, False])
def test_like_plain_scores(article):
    rng, dropped = random.Random(12), 0
    for _ in range(150):
        page = made(rng, article)
        assert html.main_text(page) == plain_text(page), page
        found, tree = html.blocks(page)
        score = html.scored(found, tree)
        weights = {p: html.PRIORS[tree.prior[p]] for p in score}
        least = max(1, max(score.values(), default=0) * 0.15)
        dropped += any(score[p] < least and weights[p] != OUT for p in score)
    assert dropped > 9  # pages on which the ratios alone drop a block


def test_given_pages():
    """On every page a score drops blocks; what stays is the article."""
    import pandas as pd

    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for page in pages["html"]:
        found, tree = html.blocks(page)
        score = html.scored(found, tree)
        assert any(score[p] < html.THRESHOLD * max(score.values()) for p in score)
        text = html.main_text(page)
        assert text and plain_article(page) == text


class Article(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.out.append("")
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside and self.out:
            self.out[-1] += data


def plain_article(page):
    parser = Article()
    parser.feed(page)
    return "\n".join(t for t in (" ".join(x.split()) for x in parser.out) if t)


N = 100_000


@pytest.mark.parametrize(
    "page",
    ["<div>" * N, "<table><p>" + "<div>" * N, "<ul>" + "<li><ul>" * N, "<p><b>" * N, "</x>" * N, "<a " * N, "<div>" * N + "</p>" * N, "<span class=ad>" * N, "<table><tr><td>" * N, "<!--" * N, "<script>" * N, "<p>" + "x " * (5 * N), "&amp;" * N],
    ids=range(13),
)
def test_hostile_pages(page):
    began = time.perf_counter()
    html.main_text(page)
    html.main_text(page + ">")
    assert time.perf_counter() - began < 60


def test_pages_without_content(spark):
    rows = [(1, "u", "<nav><a href='/'>Home</a></nav><footer>" + "Long text, with stops. " * 200 + "</footer>"), (1, "u", "<script>x"), (None, None, "<p>a</p><!-- b"), (2, "u", "<article></article><div class='ad'>Buy, now.</div>"), (3, "u", "<p>x</p><style>y")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [(0, "a", 1), (1, "", 0), (1, "", 0), (2, "", 0), (3, "x", 1)]
