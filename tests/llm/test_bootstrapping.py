"""Contextual extraction against a plain restatement, over two hops, on planted negatives and on hostile texts."""

import math
import random
import re
import time
from collections import defaultdict

from test_scans import holds, plain_spans

from corpusmill.llm import pii

KINDS = ("email", "ip", "card", "phone", "secret")
RUN = r"A-Za-z0-9._%+@=/#()-"
INSTANCE = re.compile(rf"(?<![{RUN}])[{RUN}]*[0-9@](?:[{RUN}]*[A-Za-z0-9])?(?:\x20\(?[0-9](?:[0-9().-]*[0-9])?)*")


def shape(word):
    def one(run):
        run = run[0]
        return "9" if run.isdigit() else "a" if run.isalpha() else "x"

    return re.sub("[0-9A-Za-z]+", one, word)


def occurrences(text):
    """(start, end, surface, kind or None, whether free, patterns) in a text, whose instances stand apart by white space."""
    base = [(KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in plain_spans(text))]
    found = [m.span() for m in INSTANCE.finditer(text)]
    out = []
    for k, (s, e) in enumerate(found):
        word = text[s:e]
        left = text[found[k - 1][1] if k else 0 : s][-64:].lower().split()
        right = text[e : found[k + 1][0] if k + 1 < len(found) else len(text)][:64].lower().split()
        size, form = math.ceil(math.log2(len(word))), shape(word)
        patterns = [("l1", left[-1], form, size)] if left else []
        patterns += [(n, *left[-n:], form) for n in (2, 3) if len(left) >= n]
        patterns += [("r", right[0], form, size)] if right else []
        patterns += [("lr", left[-1], right[0], form)] if left and right else []
        hits = [kind for kind, a, b in base if a < e and s < b]
        kind = hits[0] if hits else 4 if len(word) in (32, 40, 64) and re.fullmatch("[0-9A-Fa-f]+", word) and not word.isdigit() and not word.isalpha() else None
        out.append((s, e, word, kind, not hits, patterns))
    return base, out


def plain_bootstrap(texts):
    """The spans of each text."""
    rows = [occurrences(t) for t in texts]
    surfaces, fixed = defaultdict(set), {}
    for _, found in rows:
        for _, _, word, kind, _, patterns in found:
            for p in patterns:
                surfaces[p].add(word)
            if kind is not None:
                fixed[word] = min(kind, fixed.get(word, 9))
    known, before, trusted = {w: (k, 1.0) for w, k in fixed.items()}, -1, {}
    for _ in range(pii.ROUNDS):
        trusted = {}
        for p, words in surfaces.items():
            by = defaultdict(list)
            for w in words & known.keys():
                by[known[w][0]].append(known[w][1])
            if by:
                kind, scores = max(by.items(), key=lambda x: (sum(x[1]), -x[0]))
                told, total = sum(map(len, by.values())), sum(map(sum, by.values()))
                sure = sum(scores) / (total + 0.25 * (len(words) - told) + 1)
                if len(scores) >= 3 and sure >= 0.8:
                    trusted[p] = (kind, sure)
        miss = defaultdict(lambda: 1.0)
        for p, (kind, sure) in trusted.items():
            for w in surfaces[p] - fixed.keys():
                miss[w, kind] *= 1 - sure
        found = {}
        for (w, kind), q in miss.items():
            if w not in found or (1 - q, -kind) > (found[w][1], -found[w][0]):
                found[w] = (kind, 1 - q)
        if len(found) == before or not found:
            break
        known, before = {w: (k, 1.0) for w, k in fixed.items()} | found, len(found)
    out = []
    for base, found in rows:
        more = []
        for s, e, _, _, free, patterns in found:
            kinds = [trusted[p][0] for p in patterns if p in trusted]
            if free and kinds:
                more.append((min(kinds), s, e))
        out.append(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(base + more)))
    return out


def card(rng, valid=True):
    while True:
        number = "".join(rng.choice("0123456789") for _ in range(16))
        if holds("card", number) == valid:
            return number


def spans_of(spark, texts):
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: r.spans for r in rows}


def test_two_hops(spark):
    """Valid cards after "card" make that a pattern; numbers found by it make "acct" one; that finds numbers never seen after "card"."""
    rng = random.Random(1)
    seeds, first, second = [card(rng) for _ in range(20)], [card(rng, False) for _ in range(8)], [card(rng, False) for _ in range(2)]
    filler = lambda: f"{rng.choice('bcdfghjk')}{rng.randrange(10**6):06x}".translate(str.maketrans("0123456789", "klmnopqrst"))
    texts = [f"{filler()} card {c} {filler()}" for c in seeds + first]
    texts += [f"{filler()} acct {c} {filler()}" for c in first * 3 + second]
    texts += [f"{filler()} order {card(rng, False)} {filler()}" for _ in range(10)] + [f"{filler()} acct 12 {filler()}", "version 3 of"]
    found = spans_of(spark, texts)
    marked = {k for k, x in found.items() if x}
    assert marked == set(range(28 + 26))  # every number after card and acct, none after order, no short one
    assert [found[k] for k in range(len(texts))] == plain_bootstrap(texts)


def test_like_plain(spark):
    rng = random.Random(3)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    known = [card(rng, False) for _ in range(12)] + [key(20) for _ in range(6)]
    words = ["pay", "with", "card", "acct", "token", "=", "the", "id", "no.", "ß"]

    def piece():
        kind = rng.randrange(9)
        if kind < 4:
            return rng.choice(words)
        if kind == 4:
            return f"card {card(rng)}"
        if kind == 5:
            return f"{rng.choice(['card', 'acct', 'no.'])} {rng.choice(known)} |"
        if kind == 6:
            return f'token = {key(40)} end'
        if kind == 7:
            return f"token = {rng.choice(known)} end"
        return rng.choice(["mail a.b1@c.org to", "+1 (988) 555-2485 the", "10.0.0.1 host", str(rng.randrange(100))])

    texts = [" x ".join(piece() for _ in range(rng.randrange(1, 9))) for _ in range(250)] + [None, "", texts_long(rng)]
    found = spans_of(spark, texts)
    wanted = plain_bootstrap([t or "" for t in texts])
    assert [found[k] for k in range(len(texts))] == wanted
    assert sum(len(w.split(",")) for w in wanted if w) > sum(len(plain_spans(t or "")) for t in texts) + 20


def texts_long(rng):
    return " x ".join(f"card {card(rng)}" for _ in range(600))


def test_clashing_names(spark):
    names = ["row", "base", "found", "spans", "more", "_row", "_base", "_spans", "x", "seed", "surface", "k", "s", "e"]
    df = spark.createDataFrame([(1, "mail a@b.co", *range(len(names)))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = pii.masked(df)
    assert out.columns == df.columns and out.first()[:] == (1, "mail [EMAIL]", *range(len(names)))
    assert pii.personal_data(df).first().spans == "email:5:11"


def test_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.spans) for r in pii.personal_data(df).collect()) == [(0, "email:0:6"), (1, "email:0:6"), (1, "email:0:6"), (2, "")]
    assert pii.masked(df).count() == 4


def test_many_matches(spark):
    """Time grows with the number of matches, not with its square; positions stay right over blocks."""
    n = 60_000
    texts = ["1 b " * n, "a@b.co é " * n, "10.0.0.1 " * n]
    began = time.perf_counter()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert rows[1].n_email == n and rows[1].spans.endswith(f"email:{9 * (n - 1)}:{9 * (n - 1) + 6}") and rows[2].n_ip == n
    hidden = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert hidden[1] == "[EMAIL] é " * n and hidden[2] == "[IP] " * n and hidden[0] == texts[0]
    assert time.perf_counter() - began < 240


def test_masked_overlaps(spark):
    """Spans of several kinds that overlap give one bracket for each that begins outside of all before it."""
    text = "+1 411111111111 1111 and 4111 1111 1111 1111 1.2.3.4.5.6.7.8 x@y.z@w.v"
    spans = sorted((int(s), int(e), KINDS.index(k)) for k, s, e in (x.split(":") for x in plain_spans(text)))
    out, at = "", 0
    for s, e, k in spans:
        if s >= at:
            out += text[at:s] + f"[{KINDS[k].upper()}]"
        at = max(at, e)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.masked(df).first().text == out + text[at:]
