import unicodedata
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import fields, text

CASES = [
    ("أَرض إِلى", False, "ارض الي"),
    ("[[فلسطين|فلسطين التاريخية]] '''نص''' [1]", True, "فلسطين التاريخية نص"),
    ("x [١] y [2]", True, "x y"),
    ("Cookie Policy abc\nnext", False, "next"),
    ("SUBSCRIBE TO our\nnewsletter now\nrest", False, ""),
    ("{{a {{b}} c}}", True, "c}}"),
    ("[[a|b|c]]", True, "b|c"),
    ("a\n\n\n\nb  \t c", False, "a\n\nb c"),
    ("é", False, "é"),
    ("مـــدرسة ١٢٣", False, "مدرسة 123"),
    ("<p>Hi</p><br/>there", False, "Hi there"),
    ("", True, ""),
]


@pytest.mark.parametrize("raw,wiki,wanted", CASES)
def test_full_clean(spark, raw, wiki, wanted):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.full_clean(F.col("t"), is_wiki=wiki)).first()[0] == wanted
    assert text.cleaned(df, "t", is_wiki=wiki).first()[0] == wanted


def _shown(raw: str, charset: str) -> str:
    """raw's UTF-8 as a program shows it that takes it for another charset; bytes without a character stand for themselves."""
    return "".join(bytes([b]).decode(charset, "ignore") or chr(b) for b in raw.encode())


MANGLED = ["فلسطين ثقافة وتاريخ", "naïve “café” — 5 €", "plain", "日本 😀", "a\nب\n\nç", ""]


@pytest.mark.parametrize("charset", ["cp1252", "latin-1"])
@pytest.mark.parametrize("raw", MANGLED)
def test_repaired(raw, charset):
    once = _shown(raw, charset)
    assert text.repaired(once) == raw and text.repaired(_shown(once, charset)) == raw
    assert text.repaired(raw) == raw


@pytest.mark.parametrize("raw", ["é becomes Ã©", "„FOÖ“", "Ã", "schön Ã¼ber", "فلسطين Ø§", "\ud800Ã©", "Â"])
def test_not_repaired(raw):
    """A line that is not UTF-8 throughout stays."""
    assert text.repaired(raw) == raw


def test_repair_by_line(spark):
    mixed = "Ø§Ù„Ù‚Ø¯Ø³\nschön"
    df = spark.createDataFrame([(mixed,), (None,)], "t string")
    assert [r[:] for r in df.select(text.fix_encoding(F.col("t")), text.fix_encoding(F.col("t"), repair=False)).collect()] == [("القدس\nschön", mixed), (None, None)]


def test_marks_can_stay(spark):
    df = spark.createDataFrame([("أَرض",)], "t string")
    assert df.select(text.normalize_arabic(F.col("t"), remove_diacritics=False)).first()[0] == "اَرض"


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.full_clean(F.col("t"), is_wiki=True), text.arabic_ratio(F.col("t"))).first()[:] == (None, None)


def test_arabic_ratio(spark):
    df = spark.createDataFrame([("فلسطين abc",), ("",), ("abc",)], "t string")
    assert [r[0] for r in df.select(text.arabic_ratio(F.col("t"))).collect()] == [0.6, 0.0, 0.0]


def without(t: str, opening: str, closing: str, empty: bool, instead) -> str:
    """t with each stretch from opening to the first closing after it replaced by instead(inside), where inside is no bare closing."""
    out, at = "", 0
    while (begin := t.find(opening, at)) >= 0:
        end = t.find(closing[0], begin + len(opening))
        inside = t[begin + len(opening) : end] if end >= 0 else ""
        if end >= 0 and (inside or empty) and t.startswith(closing, end):
            new = instead(inside)
            if new is not None:
                out, at = out + t[at:begin] + new, end + len(closing)
                continue
        out, at = out + t[at : begin + 1], begin + 1
    return out + t[at:]


def linked(t: str) -> str:
    """Links as their label: what follows the first bar, if something stands before it and after it."""

    def label(inside):
        name, bar, rest = inside.partition("|")
        return rest if bar and name and rest else inside

    return without(t, "[[", "]]", False, label)


def plain_clean(t: str) -> str:
    """White space, tags, markup and letters by plain scans, for texts without boilerplate and sections."""
    t = without(unicodedata.normalize("NFC", t), "<", ">", False, lambda _: " ")
    t = linked(without(t, "{{", "}}", False, lambda _: " "))
    quotes = "".join("" if run[0] == "'" and len(run) > 1 and len(run) % 3 != 1 else "'" if run[0] == "'" and len(run) > 1 else run for run in split_runs(t))
    lines = [line.lstrip("#*:;") for line in quotes.split("\n")]
    t = without("\n".join(lines), "[", "]", False, lambda x: "" if all(c.isdecimal() for c in x) else None)
    letters = dict.fromkeys("أإآٱ", "ا") | {"ى": "ي"} | dict(zip("٠١٢٣٤٥٦٧٨٩", "0123456789", strict=True))
    t = "".join(letters.get(c, c) for c in t if not (0x617 <= ord(c) <= 0x61A or 0x64B <= ord(c) <= 0x65F or c == "ـ"))
    spaced = "".join(" " if run[0] in " \t" else run for run in split_runs(t.replace("\t", " ")))
    return "".join(run[:2] if run[0] == "\n" else run for run in split_runs(spaced)).strip()


def split_runs(t: str) -> list[str]:
    """t cut where the character changes."""
    return ["".join(g) for _, g in groupby(t)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="ab <>[]{}|'#*:;\n\t١1أىَـ  \u0085é́", max_size=40), min_size=8, max_size=8))
def test_clean_like_python(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    found = {r.k: r.x for r in df.select("k", text.full_clean(F.col("t"), is_wiki=True).alias("x")).collect()}
    assert [found[k] for k in range(len(texts))] == [plain_clean(t) for t in texts]


def test_counts(spark):
    df = spark.createDataFrame([("a b c\n d",), ("",), ("😀 x",)], "t string")
    found = df.select(text.word_count(F.col("t")), text.char_count(F.col("t"))).collect()
    assert [tuple(r) for r in found] == [(4, 8), (0, 0), (2, 3)]


def test_fields(spark):
    row = spark.createDataFrame([("قرى فلسطين", "12", "x")], "t string, a string, b string").select(
        fields.category_title(F.col("t")).alias("title"), fields.page_url(F.lit(""), F.lit("a b")).alias("url"), fields.optional_int(F.lit(None).cast("string"), F.col("a")).alias("n"),
        fields.optional_int(F.col("b"), F.col("a")).alias("bad"), fields.decade(F.lit(1999), F.lit(None).cast("timestamp")).alias("d"), fields.decade(F.lit(None).cast("int"), F.lit("1948-05-15").cast("timestamp")).alias("p"),
    ).first()
    assert row[:] == ("تصنيف:قرى فلسطين", "https://ar.wikipedia.org/wiki/a_b", 12, None, 1990, 1940)
