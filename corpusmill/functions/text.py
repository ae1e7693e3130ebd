"""Cleaning of text columns. The expressions behave alike in Java and RE2, so the SQL oracle shares them."""

from __future__ import annotations

import re
from unicodedata import is_normalized, normalize

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What Python counts as white space.
WS = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = "[^" + WS[1:]
LINE, REST = r"[^\n]*", r"(?s:.*)"

# Fragments of web boilerplate (the flag marks those that ignore case), each with the rest of its text or line.
BOILERPLATE = (
    (f"اشترك في النشرة الإخبارية{REST}", False),
    (f"Subscribe to{REST}newsletter{REST}", True),
    (rf"©{WS}*\p{{Nd}}{{4}}{LINE}", True),
    (f"All rights reserved{LINE}", True),
    (f"جميع الحقوق محفوظة{LINE}", False),
    (f"Cookie{WS}+Policy{LINE}", True),
    (f"Privacy{WS}+Policy{LINE}", True),
    (f"تابعونا على{LINE}", False),
    (f"Follow us on{LINE}", True),
    (f"شارك هذا الخبر{LINE}", False),
    (f"Share this article{LINE}", True),
    (f"اقرأ أيضا{LINE}", True),
    (f"Read more{LINE}", True),
    (f"تم النشر في{LINE}", False),
    (f"Published on{LINE}", True),
)
# Headings of sections that end an article.
TAIL_SECTIONS = ("انظر أيضًا", "مراجع", "وصلات خارجية", "المصادر", "روابط خارجية", "See also", "References", "External links")
# Markup of wiki pages; (expression, replacement, ignores case), in this order.
WIKI_MARKUP = (
    (f"=={WS}*({'|'.join(TAIL_SECTIONS)}){WS}*=={REST}", " ", True),
    (r"\[\[(?:ملف|File|Image):[^\]]+\]\]", " ", True),
    (r"\{\{[^}]+\}\}", " ", False),
    (r"\[\[(?:[^|\]]+\|)?([^\]]+)\]\]", "$1", False),
    ("'{2,3}", "", False),
    (r"(^|\n)[#*:;]+", "$1", False),
    (r"\[\p{Nd}+\]", "", False),
)
HTML_TAG = "<[^>]+>"
# Arabic letters with one spelling, digits, marks.
LETTERS = ("أإآٱى٠١٢٣٤٥٦٧٨٩", "ااااي0123456789")
DIACRITICS = r"[\x{617}-\x{61A}\x{64B}-\x{65F}]"
TATWEEL = r"\x{640}+"
NOT_ARABIC = r"[^\x{600}-\x{6FF}\x{750}-\x{77F}]"
SPACING = (("[ \t]+", " "), ("\n{3,}", "\n\n"), (f"^{WS}+", ""), (f"{WS}+$", ""))


def _insensitive(expression: str, flag: bool) -> str:
    return f"(?iu){expression}" if flag else expression


#: What Windows-1252 shows for the bytes 80 to 9F; the few that it leaves open stand for themselves, as in Latin-1.
SHOWN_AS = {ord(bytes([b]).decode("cp1252", "ignore") or chr(b)): b for b in range(0x80, 0xA0)}
#: The first two bytes of a character in UTF-8, each read as a character.
MANGLED = re.compile(f"[\xc2-\xf4][\x80-\xbf{''.join(map(chr, SHOWN_AS))}]")


def repaired(text: str) -> str:
    """text with those lines mended that are UTF-8 read as Latin-1 or Windows-1252, once or more often.

    Such a line is one whose characters, taken as bytes, are UTF-8 throughout; any other stays as it is.
    """

    def mended(line: str) -> str:
        try:
            return repaired(line.translate(SHOWN_AS).encode("latin-1").decode("utf-8"))
        except UnicodeError:
            return line

    if text.isascii() or not MANGLED.search(text):
        return text
    return "\n".join(mended(line) if MANGLED.search(line) else line for line in text.split("\n"))


def _nfc(text: str) -> str:
    return text if is_normalized("NFC", text) else normalize("NFC", text)


@F.arrow_udf(StringType())
def nfc(texts: pa.Array) -> pa.Array:
    return pa.array([t if t is None or t.isascii() else _nfc(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def repaired_nfc(texts: pa.Array) -> pa.Array:
    return pa.array([t if t is None or t.isascii() else _nfc(repaired(t)) for t in texts.to_pylist()], pa.string())


def fix_encoding(text: Column, repair: bool = True) -> Column:
    """Lines in a wrong encoding mended, then Unicode NFC, in Arrow batches; Spark has no such functions."""
    return repaired_nfc(text) if repair else nfc(text)


def remove_html(text: Column) -> Column:
    return F.regexp_replace(text, HTML_TAG, " ")


def remove_boilerplate(text: Column) -> Column:
    for expression, flag in BOILERPLATE:
        text = F.regexp_replace(text, _insensitive(expression, flag), "")
    return text


def clean_wiki_markup(text: Column) -> Column:
    for expression, replacement, flag in WIKI_MARKUP:
        text = F.regexp_replace(text, _insensitive(expression, flag), replacement)
    return text


def normalize_arabic(text: Column, remove_diacritics: bool = True) -> Column:
    text = F.translate(text, *LETTERS)
    if remove_diacritics:
        text = F.regexp_replace(text, DIACRITICS, "")
    return F.regexp_replace(text, TATWEEL, "")


def collapse_whitespace(text: Column) -> Column:
    for expression, replacement in SPACING:
        text = F.regexp_replace(text, expression, replacement)
    return text


def _any(expressions: list[str]) -> str:
    return "|".join(f"(?:{x})" for x in expressions)


#: Cheap signs without which a step changes nothing.
SIGNS = {
    "html": "<",
    "boilerplate": "(?iu)" + _any(["اشترك في", "subscribe to", "©", "all rights", "جميع الحقوق", "policy", "privacy", "تابعونا", "follow us", "شارك هذا", "share this", "اقرأ أيضا", "read more", "تم النشر", "published on"]),
    "wiki": _any(["==", r"\[", r"\{\{", "\'\'", r"(?:^|\n)[#*:;]"]),
    "arabic": r"[\x{600}-\x{6FF}]",
}


def guarded(text: Column, sign: str, step) -> Column:
    """step(text) where the sign is found, else text.

    The text is bound to a lambda's variable: were it repeated for the sign, the step and the other case, a filter
    that Spark pushes through several steps would hold it 3, 9, 27, ... times.
    """
    return F.get(F.transform(F.array(text), lambda t: F.when(t.rlike(sign), step(t)).otherwise(t)), F.lit(0))


def full_clean(text: Column, is_wiki: bool = False, remove_diacritics: bool = True) -> Column:
    """The whole cleaning of one column; a text without a step's signs skips its expressions."""
    text = guarded(fix_encoding(text), SIGNS["html"], remove_html)
    text = guarded(text, SIGNS["boilerplate"], remove_boilerplate)
    if is_wiki:
        text = guarded(text, SIGNS["wiki"], clean_wiki_markup)
    return collapse_whitespace(guarded(text, SIGNS["arabic"], lambda t: normalize_arabic(t, remove_diacritics)))


def cleaned(df: DataFrame, column: str = "text", into: str | None = None, is_wiki: bool = True, remove_diacritics: bool = True) -> DataFrame:
    """df with the cleaned column."""
    return df.withColumn(into or column, full_clean(F.col(column), is_wiki, remove_diacritics))


def arabic_ratio(text: Column) -> Column:
    """Share of Arabic characters among all; 0.0 for an empty text."""
    n = F.length(text)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(text, NOT_ARABIC, "")) / n)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_WS + "+")).cast("bigint")


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


# --- the same in DuckDB's SQL ---


def _sql_replace(text: str, expression: str, replacement: str, flag: bool = False) -> str:
    expression = expression.replace("'", "''")
    if flag:
        expression = f"(?i){expression}"
    return f"regexp_replace({text}, '{expression}', '{replacement.replace('$', chr(92))}', 'g')"


def sql_remove_html(text: str) -> str:
    return _sql_replace(text, HTML_TAG, " ")


def sql_remove_boilerplate(text: str) -> str:
    for expression, flag in BOILERPLATE:
        text = _sql_replace(text, expression, "", flag)
    return text


def sql_wiki_markup(text: str) -> str:
    for expression, replacement, flag in WIKI_MARKUP:
        text = _sql_replace(text, expression, replacement, flag)
    return text


def sql_normalize_arabic(text: str, remove_diacritics: bool = True) -> str:
    text = f"translate({text}, '{LETTERS[0]}', '{LETTERS[1]}')"
    if remove_diacritics:
        text = _sql_replace(text, DIACRITICS, "")
    return _sql_replace(text, TATWEEL, "")


def sql_collapse(text: str) -> str:
    for expression, replacement in SPACING:
        text = _sql_replace(text, expression, replacement)
    return text


def sql_full_clean(text: str, is_wiki: bool = True, remove_diacritics: bool = True) -> str:
    text = sql_remove_boilerplate(sql_remove_html(f"nfc_normalize({text})"))
    if is_wiki:
        text = sql_wiki_markup(text)
    return sql_collapse(sql_normalize_arabic(text, remove_diacritics))


def sql_arabic_ratio(text: str) -> str:
    return f"CASE WHEN length({text}) = 0 THEN 0.0::DOUBLE ELSE length({_sql_replace(text, NOT_ARABIC, '')})::DOUBLE / length({text}) END"


def sql_word_count(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{NOT_WS}+'))::BIGINT"
