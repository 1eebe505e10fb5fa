"""License scans with ordered signature rules, in DataFrame functions only.

A text is scanned by the rules of ``license_rules`` when it contains one of a few strings, and by a single rule when it
contains the longest word of the rule's keyword. Phrases may be wrapped, doubly spaced or commented out. Detections are intervals of the text. Sorted by start, the longer first, one pass keeps
those that no interval of the same or a higher priority contains.

Besides, base phrases are found as words: the words of a phrase must stand consecutively, where words are runs of letters,
digits and non-ASCII characters after lower-casing A-Z. Labels of base phrases are never suppressed.

Cases: a NULL or empty text has no words and no labels (empty strings, score 0; first_word and last_word NULL). Labels
are distinct and sorted, so ties have no effect. Each row stands alone: repeated rows and empty tables need no rule.
Only doc_id and text are read, so extra columns cannot clash. All work on a text is done in its row, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.license_rules import GATE, LEVELS, Rule, rules, wrapped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a text in any case, and of a text in lower case.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase and label.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

HIT = "array<struct<s:int,e:int,p:int,label:string,confidence:double>>"


def rule_table(found: list[Rule]) -> Column:
    return F.array(*[
        F.struct(F.lit(r.priority).alias("p"), F.lit(r.label).alias("label"), F.lit(max(r.keyword.split(), key=len, default="")).alias("keyword"), F.lit(wrapped(r.regex)).alias("regex"), F.lit(r.confidence).alias("confidence"))
        for r in found
    ])


def intervals(text: Column, regex: Column) -> Column:
    """Start and end (characters) of every match: lengths of what lies between matches and of the matches, added up."""
    gaps, found = F.split(text, regex, -1), F.regexp_extract_all(text, regex, F.lit(0))
    lengths = F.transform(found, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + x["own"]
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("out"))

    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


def detections(low: Column, found: list[Rule]) -> Column:
    """All matches of all rules whose keyword the text contains."""
    active = F.filter(rule_table(found), lambda r: F.contains(low, r["keyword"]))

    def matches(r: Column) -> Column:
        return F.transform(
            intervals(low, r["regex"]),
            lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), r["p"].alias("p"), r["label"].alias("label"), r["confidence"].alias("confidence")),
        )

    return F.flatten(F.transform(active, matches)).cast(HIT)


def surviving(hits: Column) -> Column:
    """Labels and the largest confidence of detections that no interval of equal or higher priority contains."""
    order = F.transform(hits, lambda h: F.struct(h["s"].alias("s"), (-h["e"]).alias("ne"), h["p"].alias("p"), h["label"].alias("label"), h["confidence"].alias("confidence")))
    start = F.struct(
        F.array(*[F.lit(-1)] * LEVELS).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("confidence"),
    )

    def step(acc: Column, h: Column) -> Column:
        end = -h["ne"]
        inside = reduce(lambda a, b: a | b, [(F.lit(k) <= h["p"]) & (F.get(acc["ends"], F.lit(k)) >= end) for k in range(LEVELS)])
        ends = F.array(*[F.when(h["p"] == k, F.greatest(F.get(acc["ends"], F.lit(k)), end)).otherwise(F.get(acc["ends"], F.lit(k))) for k in range(LEVELS)])
        return F.struct(
            ends.alias("ends"),
            F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(h["label"]))).alias("labels"),
            F.when(inside, acc["confidence"]).otherwise(F.greatest(acc["confidence"], h["confidence"])).alias("confidence"),
        )

    return F.aggregate(F.array_sort(order), start, step)


def phrase_starts(words: Column, phrase: str) -> Column:
    """Indexes (from 0) at which the words of ``phrase`` stand consecutively."""
    parts = phrase.split(" ")

    def here(w: Column, i: Column) -> Column:
        same = reduce(lambda a, b: a & b, [F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts) if k], w == F.lit(parts[0]))
        return F.when(same, i)

    return F.filter(F.transform(words, here), lambda x: x.isNotNull())


def scan(docs: DataFrame, base: list[tuple[str, str]] = BASE, found: list[Rule] | None = None, gate: list[str] = GATE) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = rules() if found is None else found
    text = F.coalesce("text", F.lit(""))
    # Unicode lower case has every ASCII letter that lower-casing A-Z gives, so no text that matters is missed.
    rows = docs.select("doc_id", text.alias("_text"), F.lower(text).alias("_any"))
    needed = [*gate, *[p.rsplit(" ", 1)[-1] for p, _ in base]]
    gated = reduce(lambda a, b: a | b, [F.col("_any").rlike(wrapped(k)) if " " in k else F.contains("_any", F.lit(k)) for k in sorted(dict.fromkeys(needed), key=lambda k: " " in k)])
    rows = rows.select("doc_id", F.regexp_count("_text", F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"), F.when(gated, F.translate("_text", UPPER, LOWER)).alias("_low"))
    low = F.col("_low")
    words = F.regexp_extract_all(low, F.lit(LOWER_WORD), F.lit(0))
    rows = rows.select("doc_id", "n_words", "_low", F.when(low.isNotNull(), words).alias("_words"))
    places = F.array(*[
        F.struct(F.lit(label).alias("label"), F.when(F.contains(low, F.lit(phrase.rsplit(" ", 1)[-1])), phrase_starts(F.col("_words"), phrase)).otherwise(F.array().cast("array<int>")).alias("at"))
        for phrase, label in base
    ])
    rows = rows.select(
        "doc_id",
        "n_words",
        F.when(low.isNotNull(), F.filter(places, lambda x: F.size(x["at"]) > 0)).alias("_places"),
        F.when(low.isNotNull(), surviving(detections(low, found))).alias("_found"),
    )
    every = F.flatten(F.col("_places.at"))
    base_labels = F.array_sort(F.array_distinct(F.col("_places.label")))
    nothing = F.array().cast("array<string>")
    own = F.coalesce(F.col("_found.labels"), nothing)
    n_base = F.coalesce(F.size(every), F.lit(0))
    n_base = F.when(F.col("_places").isNull(), F.lit(0)).otherwise(n_base).cast("long")
    return rows.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.concat_ws(",", F.coalesce(base_labels, nothing)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(F.coalesce(base_labels, nothing), own))).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("_found.confidence"), F.lit(0.0))).alias("score"),
    )
