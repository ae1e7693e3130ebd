"""Personal data by fixed expressions and by bootstrapped contextual extraction, in DataFrame functions alone.

The expressions find the seeds. What looks like an identifier (a run with a digit or an at sign) is an instance; words
before and after it with its shape are its lexical patterns. A pattern is trusted with enough distinct instances of one
kind, if these outweigh those of other kinds and, by UNKNOWN, those of no kind. Instances of trusted patterns get their
kind and a score, the noisy-or of their patterns' confidences, and induce further patterns in the next round. At the
end every occurrence in a trusted pattern is marked as that kind.

Keys of the kind secret have no fixed expression of the base: runs of hexadecimal digits of usual lengths are silent
seeds, which induce patterns but are marked only where a trusted pattern holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import free_names, staged

#: The base's kinds, in order, and the one that only patterns find.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
#: Where a run of a class begins, or the last match ended: no match can begin inside a run, so none is tried there.
_RUN = r"(?:\G|(?<![{0}]))"
_MAIL, _ID = r"A-Za-z0-9._%+-", r"A-Za-z0-9._%+@=/#()-"
#: Expressions by kind, what a text must have before they are tried; possessive where that changes no match.
EXPRESSIONS = {
    "email": (_RUN.format(_MAIL) + rf"[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    "ip": (_RUN.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
INSTANCE = _RUN.format(_ID) + rf"[{_ID}]*[0-9@](?:[{_ID}]*[A-Za-z0-9])?(?:\x20\(?[0-9](?:[0-9().-]*[0-9])?)*+"
#: A silent seed: 32, 40 or 64 hexadecimal digits with both letters and digits.
KEY = r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})$"
#: Characters before and after an instance in which its context words are looked for.
CONTEXT = 64
#: A pattern needs this many distinct instances of its kind and this confidence; there are at most so many rounds.
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 5
#: What an instance of no kind weighs against a pattern, next to one of another kind.
UNKNOWN = 0.25
#: Elements of an array that are folded at once, see running().
FOLD = 256
#: Pairs of instances and base spans of one text that are compared in place, and code points of a place where there are more.
COMPARED, PLACE = 10_000, 64
_SPANS = "array<struct<s:int,e:int,m:string,before:string,after:string>>"


def running(numbers: Column, op, zero: int) -> Column:
    """For each number of an array, op over those before it, zero for the first.

    A fold that appends copies what it has so far; blocks of FOLD elements are folded by themselves and then moved,
    so that an array of n elements costs about n * FOLD steps instead of n * n.
    """

    def fold(part: Column) -> Column:
        start = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def moved(parts: Column) -> Column:
        starts = fold(F.transform(parts, lambda x: x["at"]))["out"]
        return F.flatten(F.zip_with(parts, starts, lambda x, y: F.transform(x["out"], lambda v: op(v, y))))

    def blocks(all_: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / FOLD).cast("int"))
        return bound(F.transform(at, lambda k: fold(F.slice(all_, k * FOLD + 1, F.lit(FOLD)))), moved)

    return bound(numbers, lambda all_: F.when(F.size(all_) == 0, F.array().cast("array<int>")).when(F.size(all_) <= FOLD, fold(all_)["out"]).otherwise(blocks(all_)))


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, expression: str, needs: str) -> Column:
    """Array of (s, e, m, before, after): the leftmost non-overlapping matches, in code points, and the texts up to the neighbouring matches."""

    def placed(parts: Column, found: Column) -> Column:
        pairs = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda x, m: F.struct(x.alias("before"), m.alias("m")))
        starts = running(F.transform(pairs, lambda x: F.length(x["before"]) + F.length(x["m"])), lambda a, b: a + b, 0)
        spans = F.zip_with(pairs, starts, lambda x, at: F.struct((at + F.length(x["before"])).alias("s"), (at + F.length(x["before"]) + F.length(x["m"])).alias("e"), x["m"].alias("m"), F.right(x["before"], F.lit(CONTEXT)).alias("before")))
        return F.zip_with(spans, F.slice(parts, F.lit(2), F.size(found)), lambda x, after: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), x["before"].alias("before"), F.left(after, F.lit(CONTEXT)).alias("after")))

    both = F.struct(F.split(text, expression, -1).alias("parts"), F.regexp_extract_all(text, F.lit(expression), F.lit(0)).alias("found"))
    return F.when(text.rlike(needs), bound(both, lambda x: placed(x["parts"], x["found"]))).otherwise(F.array().cast(_SPANS))


def luhn(digits: Column) -> Column:
    def worth(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _n_digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", ""))


HOLDS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "")), lambda p: (F.length(p) <= 3) & (F.coalesce(F.substring(p, 1, 3).try_cast("int"), F.lit(0)) <= 255)),
    "card": lambda m: _n_digits(m).between(13, 19) & F.when(_n_digits(m).between(13, 19), luhn(F.regexp_replace(m, "[^0-9]", ""))).otherwise(False),
    "phone": lambda m: _n_digits(m).between(9, 15),
}


def seeds(text: Column) -> Column:
    """Array of (k, s, e): spans of the fixed expressions that hold, by kind and start; k is the kind's place in BASE."""

    def of(k: int, kind: str) -> Column:
        spans = F.filter(matches(text, *EXPRESSIONS[kind]), lambda x: HOLDS[kind](x["m"]))
        return F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    return F.concat(*(of(k, kind) for k, kind in enumerate(BASE)))


def instances(text: Column) -> Column:
    """Array of (s, e, surface, key, patterns) of what looks like an identifier: a hash of it, whether it is a silent seed, hashes of its patterns.

    Patterns are the word before with shape and size, the two and the three words before with the shape, the word after
    with shape and size, the words before and after with the shape. The shape has 9 for digits, a for letters, x for both.
    """

    def patterns(x) -> Column:
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(x["m"], "(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[0-9A-Za-z]+", "x"), "[0-9]+", "9"), "[A-Za-wyz][A-Za-z]*", "a")
        size = F.ceil(F.log2(F.length(x["m"])))
        before = F.trim(F.regexp_replace(F.lower(x["before"]), r"\s+", " "))
        after = F.regexp_extract(F.lower(x["after"]), r"^\s*(\S+)", 1)
        words = F.split(before, " ")
        one = F.element_at(words, -1)
        last = lambda n: F.array_join(F.slice(words, -n, n), " ")
        keys = (
            F.when(before != "", F.xxhash64(F.lit(1), one, shape, size)),
            F.when(F.size(words) >= 2, F.xxhash64(F.lit(2), last(2), shape)),
            F.when(F.size(words) >= 3, F.xxhash64(F.lit(3), last(3), shape)),
            F.when(after != "", F.xxhash64(F.lit(4), after, shape, size)),
            F.when((before != "") & (after != ""), F.xxhash64(F.lit(5), one, after, shape)),
        )
        return F.array_compact(F.array(*keys))

    def describe(x):
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.xxhash64(x["m"]).alias("surface"), x["m"].rlike(KEY).alias("key"), patterns(x).alias("patterns"))

    return F.transform(matches(text, INSTANCE, "[0-9@]"), describe)


def trusted_patterns(occurrences: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind) of the patterns that discover, from occurrences (surface, seed, patterns); seed is a kind or null.

    confidence = p / (p + q + UNKNOWN * u + 1), where p sums the scores of a pattern's distinct instances of its best
    kind (1 for a seed), q those of other kinds, and u counts its instances of no kind. Ends when a round finds no
    further instance, after `rounds` at the latest.
    """
    edges = staged(occurrences.select("surface", F.explode("patterns").alias("pattern")).distinct(), "edges")
    totals = staged(edges.groupBy("pattern").agg(F.count("*").alias("n")), "totals")
    fixed = staged(occurrences.where("seed is not null").groupBy("surface").agg(F.min("seed").alias("kind")).withColumn("score", F.lit(1.0)), "seeds")
    known, before = fixed, -1
    for k in range(rounds):
        votes = edges.join(known, "surface").groupBy("pattern", "kind").agg(F.sum("score").alias("p"), F.count("*").alias("c"))
        best = votes.groupBy("pattern").agg(F.max(F.struct("p", (-F.col("kind")).alias("k"), "c")).alias("top"), F.sum("p").alias("all"), F.sum("c").alias("told"))
        sure = F.col("top.p") / (F.col("all") + UNKNOWN * (F.col("n") - F.col("told")) + 1)
        trusted = best.where(F.col("top.c") >= support).join(totals, "pattern").select("pattern", (-F.col("top.k")).alias("kind"), sure.alias("sure")).where(F.col("sure") >= confidence)
        trusted = staged(trusted, "trusted")
        if k + 1 == rounds:
            break
        found = edges.join(trusted, "pattern").join(fixed.select("surface"), "surface", "left_anti").groupBy("surface", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("sure"))))).alias("score"))
        found = found.groupBy("surface").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("x")).select("surface", (-F.col("x.k")).alias("kind"), F.col("x.score").alias("score"))
        found = staged(found, "instances")
        now = found.count()
        if now == before or not now:
            break
        known, before = fixed.unionByName(found), now
    return trusted.select("pattern", "kind")


def _told_by_place(first: DataFrame, row: str, base: str, found: str) -> DataFrame:
    """(row, instance, kind) where a text has so many instances and base spans that comparing all with all would not end: those meet that share PLACE code points."""
    place = lambda s, e: F.explode(F.sequence(F.floor(s / PLACE), F.floor((e - 1) / PLACE))).alias("place")
    each = first.select(F.col(row).alias("row"), F.explode(found).alias("x")).select("row", "x.*")
    spans = first.select(F.col(row).alias("row"), F.explode(base).alias("b")).select("row", "b.k", F.col("b.s").alias("from"), F.col("b.e").alias("to"))
    met = each.select("row", "s", "e", place(F.col("s"), F.col("e"))).join(spans.select("*", place(F.col("from"), F.col("to"))), ["row", "place"])
    kinds = met.where("from < e and s < to").groupBy("row", "s").agg(F.min(F.struct("k", "from")).alias("first"))
    return each.join(kinds.select("row", "s", F.col("first.k").alias("kind")), ["row", "s"], "left")


def find_spans(docs: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, str, str]:
    """(rows, base, spans): doc_id and the columns of keep, with two arrays of (k, s, e), by kind and start, under names that no column has."""
    columns = list(dict.fromkeys(("doc_id", *keep)))
    row, base, found, spans, more = free_names(columns, "row", "base", "found", "spans", "more")
    text = F.coalesce("text", F.lit(""))
    first = staged(docs.select(*columns, F.monotonically_increasing_id().alias(row), seeds(text).alias(base), instances(text).alias(found)), "found")
    meets = lambda x, b: (b["s"] < x["e"]) & (x["s"] < b["e"])
    few = F.size(found).cast("long") * F.size(base) <= COMPARED
    told = F.transform(found, lambda x: F.struct(x.alias("x"), F.get(F.filter(base, lambda b: meets(x, b)), F.lit(0))["k"].alias("kind")))
    each = first.where(few).select(F.col(row).alias("row"), F.explode(told).alias("y")).select("row", "y.x.*", "y.kind").unionByName(_told_by_place(first.where(~few), row, base, found))
    seed = F.coalesce("kind", F.when(F.col("key"), F.lit(KINDS.index("secret"))))
    occurrences = staged(each.select("row", "s", "e", "surface", F.col("kind").isNull().alias("free"), seed.alias("seed"), "patterns"), "occurrences")
    trusted = trusted_patterns(occurrences)
    marked = occurrences.where("free").select("row", "s", "e", F.explode("patterns").alias("pattern")).join(trusted, "pattern").select(F.col("kind").alias("k"), "s", "e", "row")
    # an occurrence has one kind, the first of its patterns' kinds
    marked = marked.groupBy("row", "s", "e").agg(F.min("k").alias("k")).groupBy("row").agg(F.collect_list(F.struct("k", "s", "e")).alias(more)).withColumnRenamed("row", row)
    # only rows with an instance that is no seed of the base can have more; the others are not shuffled
    free = F.when(few, F.exists(found, lambda x: ~F.exists(base, lambda b: meets(x, b)))).otherwise(True)
    none = F.lit(None).cast(marked.schema[more].dataType)
    out = first.where(free).drop(found).join(marked, row, "left").unionByName(first.where(~free).drop(found).withColumn(more, none))
    every = F.array_sort(F.concat(base, F.coalesce(more, F.array().cast("array<struct<k:int,s:int,e:int>>"))))
    return out.select(*columns, base, every.alias(spans)), base, spans


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_discovered; a row for each row of docs (doc_id, text).

    A null or empty text has no spans; repeated rows are each searched, and count once as pattern instances; other columns are ignored.
    """
    found, base, spans = find_spans(docs)
    number = lambda k: F.size(F.filter(base, lambda x: x["k"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    more = (F.size(spans) - F.size(base)).cast("long").alias("n_discovered")
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"), more)


def _masked(text: Column, spans: Column) -> Column:
    """text with each span as its kind in brackets; what overlaps an earlier span's end adds no second bracket there.

    A substring costs its distance from the text's begin, so FOLD spans at a time are cut out of a part of the text.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def cut(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda x: x["e"]), F.greatest, 0)
        rows = F.filter(F.zip_with(rows, ends, lambda x, at: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), at.alias("at"))), lambda x: x["s"] >= x["at"])
        return bound(rows, joined)

    def joined(rows: Column) -> Column:
        """rows: spans that begin at or after the end of all before, each with that end (at); a span reaches to the next one's at."""
        n = F.size(rows)

        def part(j: Column) -> Column:
            own = F.slice(rows, j * FOLD + 1, F.lit(FOLD))
            begin = F.element_at(own, 1)["at"]
            end = F.element_at(own, -1)["s"]

            def pieces(piece: Column) -> Column:
                return F.array_join(F.transform(own, lambda x: F.concat(F.substring(piece, x["at"] - begin + 1, x["s"] - x["at"]), F.element_at(names, x["k"] + 1))), "")

            return bound(F.substring(text, begin + 1, end - begin), pieces)

        parts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / FOLD).cast("int")), part)
        return F.array_join(parts, "")

    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    rest = F.substring(text, F.array_max(F.transform(spans, lambda x: x["e"])) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(bound(by_start, cut), rest))


def masked(docs: DataFrame) -> DataFrame:
    """docs, all their columns, with each span of personal data in text as its kind in brackets; n_chars, where there, follows."""
    found, _, spans = find_spans(docs, tuple(docs.columns))
    out = found.withColumn("text", _masked(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
