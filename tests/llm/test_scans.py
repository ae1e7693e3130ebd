"""Operators that look at one row at a time, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pytest
from oracle import same
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import compression, decontaminate, html, licenses, packing, pii, quality, tokens, urls
from corpusmill.llm.license_texts import LICENSES
from corpusmill.llm.queries import op10_url_filters, tokenizer_file

ODD = [None, "", " ", "\n\n", "a", "word " * 30_000, "é😀 ü", "same line\nsame line\nsame line", "A B C D E A B C D E A B C D E", "###|||", "x" * 50_000]


def frame(spark, texts, extra=True):
    rows = [(k, t, "s", 1) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, digest int" if extra else "doc_id long, text string, lang string, n_chars int")


# --- op1 ---


def test_licenses(spark):
    mit = dict(LICENSES)["MIT"]
    texts = [mit, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + mit.upper().replace(" ", "\n "), mit.replace("license", "licence").replace('"', "“"), mit + " more", *ODD, "x\nReleased under the MIT  Licence!\ny\nLicensed under CC BY-NC 4.0"]
    rows = licenses.license_scan(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r.license_id for r in rows[:4]] == ["MIT", "MIT", "MIT", None]
    assert rows[-1].notices == "CC-BY-NC-4.0,MIT" and rows[-1].n_notices == 2
    assert all(r.license_id is None and r.notices == "" for r in rows[4:-1])
    assert rows[4].digest == rows[5].digest == hashlib.sha256(b"").hexdigest()
    assert licenses.license_scan(frame(spark, [])).collect() == []


def test_licenses_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 1)
    assert licenses.license_scan(frame(spark, [dict(LICENSES)["ISC"]])).first().license_id == "ISC"


# --- op3, op6 ---

@lru_cache
def fresh(name):
    """The library's own tokenizer of that file, with no setting changed."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name))


SPECIAL = ["<|endoftext|>", "hello <|endoftext|> world", "<|startoftext|>x <|EndOfText|>", "a<|endoftext|><|endoftext|>  b\n", "<|endoftext"]
AWKWARD = st.text(alphabet="ab é'’1.\n\t  　\x1c😀<|>İßﬁ", max_size=60)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(AWKWARD, st.sampled_from(SPECIAL), st.text(max_size=30)), min_size=1, max_size=6))
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(name, texts):
    import pyarrow as pa

    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    coder = tokens.encoder(tokenizer_file(name))
    ids, sizes = coder.column(pa.array(texts), 2)
    wanted = [[*fresh(name).encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == [x for w in wanted for x in w] and sizes.tolist() == list(map(len, wanted))


def test_special_strings():
    import pyarrow as pa

    for name, n in (("byte_bpe_50k.json", 4), ("word_bpe_49k.json", 4)):
        ids, sizes = tokens.encoder(tokenizer_file(name)).column(pa.array([SPECIAL[1], None]), 2)
        assert ids.tolist() == [*fresh(name).encode(SPECIAL[1], add_special_tokens=False).ids, 2, 2] and len(fresh(name).encode(SPECIAL[1], add_special_tokens=False).ids) == sizes[0] - 1 <= n


def test_kinds_of_tokenizers(tmp_path):
    import json

    import pyarrow as pa

    settings = {n: json.load(open(tokenizer_file(n))) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}
    assert [tokens.kind_of(x) for x in settings.values()] == ["bytes", "words"]
    odd = settings["byte_bpe_50k.json"] | {"normalizer": {"type": "Lowercase"}}
    assert tokens.kind_of(odd) == "other" and tokens.kind_of(settings["byte_bpe_50k.json"] | {"pre_tokenizer": None}) == "other"
    (tmp_path / "odd.json").write_text(json.dumps(odd))
    from tokenizers import Tokenizer

    ids, _ = tokens.Encoder(str(tmp_path / "odd.json")).column(pa.array(["Hello World  x", None]), 2)
    assert ids.tolist() == [*Tokenizer.from_file(str(tmp_path / "odd.json")).encode("Hello World  x", add_special_tokens=False).ids, 2, 2]


def test_repeated_and_missing_ids_in_files(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None), (0, "d e f"), (1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tokens.write_tokens(df, f"{tmp_path}/t", tokenizer_file("byte_bpe_50k.json"), 2, shards=4)
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in tokens.read_tokens(spark, f"{tmp_path}/t").collect())
    assert [x for _, x, _ in found] == [None, None, 0, 1, 1, 1]
    assert [a + n for a, _, n in found][:-1] == [a for a, _, _ in found][1:] and found[0][0] == 0


def test_token_files(spark, tmp_path):
    path, out = tokenizer_file("byte_bpe_50k.json"), f"{tmp_path}/t"
    rng = random.Random(1)
    texts = [*ODD, *SPECIAL, *(" ".join(rng.choice(["alpha", "beta", "Gamma,", "1234"]) for _ in range(50)) for _ in range(40))]
    df = frame(spark, texts).withColumn("doc_id", 100 - F.col("doc_id"))
    tokens.write_tokens(df, out, path, 2, shards=3)
    rows = tokens.token_digests(tokens.read_tokens(spark, out)).orderBy("doc_id").collect()
    coder, at = fresh("byte_bpe_50k.json"), 0
    for r, t in zip(rows, reversed(texts), strict=True):
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tokens.read_tokens(spark, out, ids=False).columns == ["doc_id", "start", "n_tokens"]
    assert tokens.token_output(frame(spark, []), path).collect() == []


def test_token_file_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    tokens.write_tokens(frame(spark, ["a b c " * 500] * 50), f"{tmp_path}/t", tokenizer_file("byte_bpe_50k.json"), 2, shards=1)
    meta = pq.ParquetFile(next(tmp_path.glob("t/*.parquet"))).metadata.row_group(0)
    kinds = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in kinds["ids.list.element"].encodings and kinds["ids.list.element"].has_column_index
    assert "DELTA_BINARY_PACKED" in kinds["doc_id"].encodings and kinds["n_tokens"].has_offset_index


def test_packing(spark):
    path = tokenizer_file("word_bpe_49k.json")
    rng = random.Random(2)
    texts = [*ODD, *SPECIAL, *(" ".join(rng.choice(["alpha", "beta", "gamma", "1234"]) for _ in range(rng.randrange(1, 3000))) for _ in range(60))]
    rows = packing.pack_documents(frame(spark, texts), path).collect()
    coder, taken = fresh("word_bpe_49k.json"), Counter()
    for r in rows:
        ids = np.array([*coder.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        taken[r.doc_id] += r.length
        assert 0 < r.length <= 4096
    assert all(taken[k] == len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in enumerate(texts))
    by: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert by.get(r.sequence_id, 0) == r.offset
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 4096 and sum(by.values()) / len(by) > 0.9 * 4096
    assert packing.pack_documents(frame(spark, []), path).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=16))
def test_patterns_cover(demand):
    capacity, demand = 16, np.array(demand + [0] * (16 - len(demand)), np.int64)
    found = packing.patterns_for(demand, capacity)
    assert all((p * np.arange(1, 17)).sum() <= capacity and n > 0 for p, n in found)
    assert np.array_equal(sum((p * n for p, n in found), np.zeros(16, np.int64)), demand)
    least = -(-int((demand * np.arange(1, 17)).sum()) // capacity)
    assert sum(n for _, n in found) <= 1.25 * least + 9


# --- op4 ---


def plain_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rng = random.Random(4)
    texts = [*ODD, *(" ".join(rng.choice("ab cd ef # | \n gh".split(" ")) for _ in range(60)) for _ in range(40))]
    rows = quality.quality_metrics(frame(spark, texts)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        n = plain_quality(t)
        assert tuple(r)[1:6] == n and r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert r.kept == all(not rule.rejects(quality.Page(t)) for rule in quality.RULES)
    kept = quality.quality_filter(frame(spark, texts))
    assert kept.columns == ["doc_id", "text", "n_words", "digest"] and [r.doc_id for r in kept.orderBy("doc_id").collect()] == [r.doc_id for r in rows if r.kept]
    assert quality.quality_metrics(frame(spark, [])).collect() == []


def test_rule_order(spark):
    slow = quality.Rule("slow", lambda p: sum(range(20_000)) < 0, "false")
    df = frame(spark, ["a b"] * 20)
    assert quality.rule_order(df, (slow, quality.BASE[0])) == [1, 0]
    assert sorted(quality.rule_order(df.limit(0))) == list(range(len(quality.RULES)))


# --- op5 ---


def plain_hits(text, items):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    hit, names = set(), set()
    for name, item in items:
        x = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").encode().lower())
        n = min(10, len(x))
        for k in range(len(x) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == x[k : k + n]:
                    hit.update(range(i, i + n))
                    names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination(spark, block_bytes):
    rng = random.Random(6)
    vocabulary = ["a", "b", "c", "dé", "7"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([14, 12, 10, 9, 3, 2, 1, 0, 11])] + [(20, None), (3, "zz yy")]
    texts = [*ODD, *(", ".join(rng.choice(vocabulary[:2] if k % 2 else vocabulary) for _ in range(40)) for k in range(30)), "Pre " + items[0][1].upper() + " post", "q zz--YY q"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(frame(spark, texts), bench, block_bytes).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [plain_hits(t, items) for t in texts]
    clean = decontaminate.decontaminate(frame(spark, texts), bench)
    assert clean.columns == ["doc_id", "text", "n_words", "digest"] and {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows if not r.contaminated}
    assert not any(r.contaminated for r in decontaminate.contamination(frame(spark, ["a b"]), bench.limit(0)).collect())
    assert decontaminate.contamination(frame(spark, []), bench).collect() == []


# --- op7 ---

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(d)))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


AWKWARD_DATA = ["a@b.c_d@e.f x@y.z-1.w", "+1 (988) 555-2485 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 and 4111111111111112", "999.1.1.1 001.002.003.0004", "é😀 a@b.co 😀 +49 (0) 123.456.789", "1" * 200, "x" * 3000 + "@" + "a." * 2000, "1 " * 5000, "+1" + " " * 3000 + "1"]


def test_base_spans(spark):
    rng = random.Random(8)
    texts = [*ODD, *AWKWARD_DATA, *("".join(rng.choice("a1.@+- 4(") for _ in range(60)) for _ in range(60))]
    rows = pii.personal_data(frame(spark, texts)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        wanted = plain_spans(t)
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest(), t
        assert set(wanted) <= set(r.spans.split(",") if r.spans else [])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in wanted) for k in PATTERNS]
    assert pii.personal_data(frame(spark, [])).collect() == []


def test_bootstrapping(spark):
    seeds = [f"card 411111111111111{k}" for k in range(10)]
    good = [t for t in seeds if holds("card", t.split()[1])]
    more = [f"card {t}" for t in ("4000056655665556", "5555555555554444", "378282246310005", "6011111111111117", "4222222222222", "5105105105105100")]
    texts = [*good, *more, "card 5555555555554445 here", "order 5555555555554445 here", "nothing 12"]
    rows = {r.doc_id: r for r in pii.personal_data(frame(spark, texts)).collect()}
    assert rows[len(texts) - 3].spans == "card:5:21" and rows[len(texts) - 3].n_discovered == 1 and rows[len(texts) - 3].n_card == 0
    assert rows[len(texts) - 2].spans == "" and rows[len(texts) - 1].spans == ""
    masked = {r.doc_id: r.text for r in pii.masked(frame(spark, texts)).collect()}
    assert masked[len(texts) - 3] == "card [CARD] here" and masked[0] == "card [CARD]"


def test_masked(spark):
    df = spark.createDataFrame([(1, "hi a@b.co and +1 (988) 555-2485 ok", 5), (2, None, None), (3, "10.0.0.1", 8)], "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, pii.masked(df).collect())) == [(1, "hi [EMAIL] and [PHONE] ok", 25), (2, None, None), (3, "[IP]", 4)]


# --- op8 ---


def test_compression(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["river", "stone", "cloud", "green", "apple", "night"]) + rng.choice(["", "s", "ing"]) for _ in range(rng.randrange(20, 90)))
    bad = lambda: " ".join(rng.choice(["BUY", "NOW!!", "$$$", "CLICK###"]) * rng.randrange(1, 3) for _ in range(rng.randrange(20, 90)))
    texts = [good() if k % 3 else bad() for k in range(300)]
    docs = frame(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)], "doc_id long, quality int, toxic int")
    rows = compression.quality_scores(docs, labels).orderBy("doc_id").collect()
    held = [r for r in rows[:300] if r.held_out]
    assert {r.doc_id for r in rows if r.held_out} == {k for k in range(302) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows) and rows[300].score == rows[301].score
    moved = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert [r.score for r in compression.quality_scores(docs, moved).orderBy("doc_id").collect()] == [r.score for r in rows]


def test_no_labels(spark):
    docs, labels = frame(spark, ["a", None]), spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in compression.quality_scores(docs, labels).collect()] == [0.5, 0.5]
    assert compression.quality_scores(docs.limit(0), labels).collect() == []


# --- op9 ---

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style></head><body class="comments-open"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<aside class="sidebar">Side text that is rather long, with commas, and stops.</aside><div class="cookie-notice">We use cookies.</div><!-- ad <p>no</p> -->
<main><article><header><h1>Head&eacute;r</h1></header><p>First <b>bold</b>,
 text&nbsp;here.<p>Second <a title="a>b" href="#">link</a> one<br>two.<ul><li>item &#233;<li>item 2</ul><table><tr><td>c1<td>c2</table><script>var x="</p>";</script><div class="ad">Buy this.</div>
<form><p>Name</p></form><blockquote>Quote.</blockquote><section id="comments"><p>Reader says things, at length, again.</p></section></article></main><footer>&copy; end</footer></body></html>"""


def test_html(spark):
    wanted = "Headér\nFirst bold, text here.\nSecond link one two.\nitem é\nitem 2\nc1\nc2\nQuote."
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<p>a < b & c</p", 1), (5, "u", "plain", 1)], "page_id long, url string, html string, n_chars int")
    rows = html.extract(pages).orderBy("page_id").collect()
    assert rows[0].text == wanted and rows[0].n_chars == len(wanted)
    assert [(r.text, r.n_chars) for r in rows[1:]] == [("", 0), ("", 0), ("a < b & c", 9), ("plain", 5)]
    assert html.extract(pages.limit(0)).collect() == []


def test_html_without_article():
    body = "".join(f"<p>Sentence number {k}, with some text, that goes on for a while.</p>" for k in range(8))
    page = f'<body><div class="menu"><a href="/a">A</a></div><div class="top"><a href="/b">B link</a> <a href="/c">C link</a></div><div class="content"><h2>Title</h2>{body}</div></body>'
    assert html.main_text(page).split("\n")[0] == "Title" and "link" not in html.main_text(page) and html.main_text(page).count("\n") == 8


def test_html_names():
    page = '<body><div class="site-header"><p>Site name here.</p></div><div class="post-header"><h1>Title</h1></div><div class="post-body"><p>Long text of the post, with commas, and stops.</p></div><div id="reader_comments"><p>Me too, I say, at length here.</p></div></body>'
    assert html.main_text(page) == "Title\nLong text of the post, with commas, and stops."
    assert html.main_text('<article><p>a <span class="ad">buy</span> b</p><p hidden>x</p><p style="display: none">y</p></article>') == "a\nb"


class Plain(HTMLParser):
    """Text of an article of paragraphs."""

    def __init__(self):
        super().__init__()
        self.out, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1") and self.inside:
            self.out.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside and self.out:
            self.out[-1] += data


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab &;<>\né'\"1#", max_size=20), min_size=1, max_size=5))
def test_html_like_parser(paragraphs):
    import html as h

    page = "<nav>menu</nav><article>" + "".join(f"<p>{h.escape(p)}</p>" for p in paragraphs) + "</article><footer>f</footer>"
    plain = Plain()
    plain.feed(page)
    assert html.main_text(page) == "\n".join(t for t in (" ".join(x.split()) for x in plain.out) if t)


# --- op10 ---


def test_urls(spark):
    wanted = {
        "https://a.example.com/en/1?x=/en/": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://WWW.Example.COM/de/": ("www.example.com", "/de/", "com/", "allow"),
        "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "http://x.net/de/1": ("x.net", "/de/1", None, "allow"),
        "http://casino-win.net/de/1": ("casino-win.net", "/de/1", None, "block"),
        "http://casino-win.com/de/1": ("casino-win.com", "/de/1", "com/", "allow"),
        "http://free.bets.org/": ("free.bets.org", "/", None, "allow"),
        "http://my.free-bets.org#f": ("my.free-bets.org", "", None, "block"),
        "https://com": ("com", "", None, "allow"),
        "http://telecom/": ("telecom", "/", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    rows = spark.createDataFrame([(k, u, "h") for k, u in enumerate(wanted)], "page_id long, url string, host string")
    assert [tuple(r)[1:] for r in urls.url_verdicts(rows).orderBy("page_id").collect()] == list(wanted.values())
    assert urls.url_verdicts(rows.limit(0)).collect() == []


def test_rarest_token():
    index = urls.index_of(urls.PATTERNS, {"cheap": 10, "pills": 2, "free": 1, "bets": 5, "ads": 1, "track": 1})
    assert "pills" in index and "free" in index and "ads" in index and len(index["ads"]) == 1 and "track" not in index
    assert urls.index_of((urls.Pattern(("b", "a"), "x"), urls.Pattern((), "y")), {}).keys() == {"a", ""}


PIECES = ["http://", "https://", "ad", "ads", "server", "adserver", "track", "free", "bet", "bets", "sports", "cheap", "pill", "pills", "casino", "xxx", "doubleclick", "net", "org", "buy", "viagra", "banner", "click", "-", "-", ".", ".", "/", "/", "?", "#", ":", "_", "é", "A", "CASINO", "1"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12), st.dictionaries(st.sampled_from(PIECES), st.integers(0, 9)))
def test_index_like_all_rules(pieces, counts):
    """Whatever the table's counts are, the index finds what trying every pattern finds, and what SQL's expressions mean."""
    url = "".join(pieces).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    assert urls.found_in(url, urls.index_of(urls.PATTERNS, counts)) == any(re.search(p.expression, url, re.ASCII) for p in urls.PATTERNS)
    assert all(set(p.tokens) <= set(re.findall("[a-z0-9]+", url)) for p in urls.PATTERNS if re.search(p.expression, url, re.ASCII))


def test_verdicts_do_not_depend_on_other_rows(spark):
    some = ["http://adserver.org/x", "http://ad-server.org/x", "http://free-bet.org/", "http://sports-bets.org", "http://x.org/adserver", "http://my-adserver.org", None]
    more = ["http://bets.org/", "http://bets.net", "http://x.org/bets", *["http://server.org/ad"] * 5, *["http://x.org/free"] * 3]
    table = lambda rows: spark.createDataFrame([(k, u) for k, u in enumerate(rows)], "page_id long, url string")
    alone = [r.verdict for r in urls.url_verdicts(table(some)).orderBy("page_id").collect()]
    assert alone == ["block", "block", "block", "block", "allow", "block", "allow"]
    assert [r.verdict for r in urls.url_verdicts(table(some + more)).orderBy("page_id").limit(len(some)).collect()] == alone


def test_long_and_repeated_urls(spark):
    url = "http://a.org/" + "x" * 200_000 + "/casino"
    rows = spark.createDataFrame([(1, url), (1, url), (None, "http://casino.org"), (2, "http://" + "a." * 5000 + "com/")], "page_id long, url string")
    found = sorted((r.page_id or 0, r.rule or "", r.verdict) for r in urls.url_verdicts(rows).collect())
    assert found == [(0, "", "block"), (1, "", "allow"), (1, "", "allow"), (2, "com/", "allow")]


def test_urls_like_sql(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 9)))) for k in range(400)] + [(400, "http://adserver.org/x"), (401, None)]
    spark.createDataFrame(rows, "page_id long, url string").toPandas().to_parquet(tmp_path / "pages.parquet")
    same(spark, op10_url_filters, urls.ORACLE, str(tmp_path))
