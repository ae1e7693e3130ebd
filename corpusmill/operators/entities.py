"""Named entities: a dictionary of heritage words, and a tagger that can be plugged in."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NOT_WS, WS, word_count

# Words by label; prefixes, the longest first.
HERITAGE = {
    "PAL_FOOD": ("مسخن", "مقلوبة", "كنافة", "فتوش", "معمول", "قطايف", "مفتول", "ملوخية", "مسقعة", "فريكة", "شنكليش", "زعتر", "طابون", "لبنة", "منسف", "سماقية", "علاليش"),
    "PAL_CLOTHES": ("كوفية", "حطة", "شماغ", "عباية", "طاقية", "شرش", "زنار", "قنباز", "برنس", "شملة", "عقال"),
    "PAL_HERITAGE": ("دبكة", "تطريز", "حكواتي", "سامر", "زغرودة", "زغاريد", "زفة", "حنة", "تعليلة", "مهر", "أرجيلة", "نول", "فخار"),
}
ARTICLE, CONJUNCTION = "ال", "و"
PREFIXES = ("وبال", "فبال", "كبال", "وال", "فال", "بال", "كال", "و", "ف", "ب", "ل", "ك")
SENTENCE_ENDS = "[.!؟؛]+"
MIN_SENTENCE_WORDS = 3
DICTIONARY_SOURCE, MODEL_SOURCE = "heritage_dict", "camel_ner"
#: Words with their marks, or single other characters; stands in for the tokenizer of a library that is not at hand.
TOKEN = r"[\p{L}\p{M}\p{Nd}_]+|[^\p{L}\p{M}\p{Nd}_" + WS[1:-1] + "]"
ENTITIES = T.ArrayType(T.StructType([T.StructField(x, T.StringType()) for x in ("text", "label", "source")]))
#: From token lists to tag lists (B-, I-, O), batch by batch.
Tagger = Callable[[list[list[str]]], list[list[str]]]


def full_dictionary(base: dict[str, tuple[str, ...]] = HERITAGE) -> dict[str, str]:
    """Each word and the word with the article, to its label."""
    return {form: label for label, words in base.items() for w in words for form in (w, ARTICLE + w)}


DICTIONARY = full_dictionary()


def _map(dictionary: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for item in dictionary.items() for x in item))


def dictionary_form(token: Column, dictionary: dict[str, str] = DICTIONARY) -> Column:
    """The dictionary's form of a token, itself or without its first fitting prefix; null without one."""
    words = list(dictionary)
    found = F.when(token.isin(words), token)
    for prefix in PREFIXES:
        rest = F.substring(token, F.lit(len(prefix) + 1), F.length(token))
        found = found.when(token.startswith(prefix) & (F.length(token) > len(prefix) + 1) & rest.isin(words), rest)
    return found


def normalize_token(token: Column, dictionary: dict[str, str] = DICTIONARY) -> Column:
    return F.coalesce(dictionary_form(token, dictionary), token)


def strip_conjunction(token: Column) -> Column:
    return F.when(token.startswith(CONJUNCTION) & (F.length(token) > 2), F.substring(token, F.lit(2), F.length(token))).otherwise(token)


def sentences(text: Column) -> Column:
    """Sentences of at least three words, trimmed."""
    parts = F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(". ")), SENTENCE_ENDS, -1)
    trimmed = F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, f"^{WS}+", ""), f"{WS}+$", ""))
    return F.filter(trimmed, lambda s: word_count(s) >= MIN_SENTENCE_WORDS)


def tokens(sentence: Column) -> Column:
    return F.regexp_extract_all(sentence, F.lit(TOKEN), F.lit(0))


def dictionary_entities(words: Column, dictionary: dict[str, str] = DICTIONARY) -> Column:
    """Entities of the dictionary among tokens, in order."""

    def entity(token):
        return F.struct(token.alias("text"), F.try_element_at(_map(dictionary), dictionary_form(token, dictionary)).alias("label"), F.lit(DICTIONARY_SOURCE).alias("source"))

    hits = F.filter(words, lambda t: dictionary_form(t, dictionary).isNotNull())
    return F.transform(hits, entity).cast(ENTITIES)


def merged(words: list[str], tags: list[str], hits: list[bool], strip: bool = True) -> list[tuple[str, str, str]]:
    """Entities of BIO tags. A dictionary hit ends the open entity as it is; otherwise its first token loses a leading conjunction."""
    found: list[tuple[str, str, str]] = []
    open_words: list[str] = []
    label = ""

    def close(cut: bool) -> None:
        if open_words:
            first = open_words[0]
            if cut and strip and first.startswith(CONJUNCTION) and len(first) > 2:
                open_words[0] = first[1:]
            found.append((" ".join(open_words), label, MODEL_SOURCE))
            open_words.clear()

    for word, tag, hit in zip(words, tags, hits, strict=False):
        if hit:
            close(False)
        elif tag.startswith("B-"):
            close(True)
            open_words.append(word)
            label = tag[2:]
        elif tag.startswith("I-") and open_words:
            open_words.append(word)
        else:
            close(True)
    close(True)
    return found


def bio_merge(df: DataFrame, words: str, tags: str, into: str = "entities", strip: bool = True, dictionary: dict[str, str] = DICTIONARY) -> DataFrame:
    """df with the entities of arrays of tokens and tags: the dictionary's first, then the tags'."""
    merge = F.pandas_udf(lambda w, t, h: pd.Series([[dict(zip(("text", "label", "source"), e, strict=True)) for e in merged(list(a), list(b), list(c), strip)] for a, b, c in zip(w, t, h, strict=True)]), ENTITIES)
    hits = F.transform(F.col(words), lambda t: dictionary_form(t, dictionary).isNotNull())
    return df.withColumn(into, F.concat(dictionary_entities(F.col(words), dictionary), merge(F.col(words), F.col(tags), hits)))


def with_entities(docs: DataFrame, tagger: Tagger | None = None, text: str = "text", limit: int | None = None, order: str | None = None, dictionary: dict[str, str] = DICTIONARY, strip: bool = True) -> DataFrame:
    """docs with the column entities: for each sentence the dictionary's entities, then the tagger's.

    Without a tagger every tag is O, and all is done in Spark's own functions. limit and order: only rows whose order
    column is under limit get entities, others an empty array.
    """
    if tagger is None:
        found = F.flatten(F.transform(sentences(F.col(text)), lambda s: dictionary_entities(tokens(s), dictionary)))
        out = docs.withColumn("entities", found)
    else:

        def all_of(column: pd.Series) -> pd.Series:
            flat = [s for doc in column for s in doc]
            tags = iter(tagger([list(s["words"]) for s in flat]))
            out = []
            for doc in column:
                own = []
                for s in doc:
                    words, hits, forms = list(s["words"]), [f is not None for f in s["forms"]], list(s["forms"])
                    own += [{"text": w, "label": dictionary[f], "source": DICTIONARY_SOURCE} for w, f in zip(words, forms, strict=True) if f is not None]
                    own += [dict(zip(("text", "label", "source"), e, strict=True)) for e in merged(words, list(next(tags)), hits, strip)]
                out.append(own)
            return pd.Series(out)

        def described(s):
            return F.struct(tokens(s).alias("words"), F.transform(tokens(s), lambda t: dictionary_form(t, dictionary)).alias("forms"))

        out = docs.withColumn("entities", F.pandas_udf(all_of, ENTITIES)(F.transform(sentences(F.col(text)), described)))
    if limit is not None:
        out = out.withColumn("entities", F.when(F.col(order) < limit, F.col("entities")).otherwise(F.array().cast(ENTITIES)))
    return out


def entity_counts(docs: DataFrame, key: str = "doc_id", shown: int = 15) -> DataFrame:
    """key, n_entities, and the first entities of each document."""
    return docs.select(key, F.size("entities").cast("bigint").alias("n_entities"), F.slice("entities", 1, shown).alias("first_entities"))
