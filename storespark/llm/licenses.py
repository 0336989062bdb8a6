"""Licence scan by ordered signature rules, in DataFrame expressions only.

Hundreds of rules (``license_rules``) are gated by their keywords: a text is
searched for the few dozen keywords first, and only rules whose keyword it
holds are matched. Overlaps are resolved in one sweep over the detections in
order of their start: a detection inside another of the same or a stronger
priority goes, and so does a bare "licensed under" that touches a named
licence. Rows stay where they are: no shuffle, no join.

Defined cases: a null text counts as empty; a text without words has zero
counts, null positions, empty label strings and score 0. Rows alike are
reported separately; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import text_or_empty
from storespark.llm.license_rules import GAP, GRANT, Rule, rules

#: Word characters with A-Z still in place; lower-casing them changes no word's extent.
WORD_CHAR = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Fixed phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_CONFIDENCE = 0.9
#: A bare "licensed under" belongs to a named licence that begins so many characters after it at most.
GRANT_REACH = 24
SPAN = "struct<from:int,to:int>"
FOUND = "struct<from:int,minus_to:int,priority:int,label:string,confidence:double>"


def phrase_pattern(phrase: str) -> str:
    return rf"(?<!{WORD_CHAR})(?i:" + f"{SEPARATOR}+".join(phrase.split()) + rf")(?!{WORD_CHAR})"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` over ``value``, which is computed once however often ``use`` or a lambda in it refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: Column) -> Column:
    """Array of (from, to) in code points, end exclusive, of all matches left to right.

    What lies between the matches comes from splitting by the same pattern.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["b"]
        span = F.struct(start.alias("from"), (start + pair["m"]).alias("to"))
        return F.struct((start + pair["m"]).alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def placed(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(found, between, lambda m, b: F.struct(F.length(b).alias("b"), F.length(m).alias("m")))
        return F.aggregate(pairs, zero, step, lambda s: s["out"])

    none = F.array().cast(f"array<{SPAN}>")
    return bound(
        F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none)
    )


#: Every rule's matches hold at least one of these words, in lower case, or a match of ``TRIGGER_FORMS``; texts without
#: any are not looked at further.
TRIGGERS = (
    "licen", "gpl", "clause", "attribution", "wtfpl", "cc0", "domain", "ncsa",
    "cecill", "mulan", "reserved", "vorbehalten", "réservés", "reservados", "copyright", "eupl.eu", "sil.org", "epl-",
    "creative", "mozilla.org/mpl", "edl-",
)
TRIGGER_FORMS = (rf"cc{GAP}by", GRANT)


def gate(text: Column) -> Column:
    """Whether a text holds any trigger."""

    def held(low: Column) -> Column:
        words = [F.contains(low, F.lit(t)) for t in TRIGGERS]
        return reduce(lambda a, b: a | b, [*words, *[F.rlike(low, F.lit(form)) for form in TRIGGER_FORMS]])

    return bound(F.lower(text), held)


def _rules_by_keyword(ordered: list[Rule]) -> Column:
    by: dict[str, list[Column]] = {}
    for r in ordered:
        fields = [F.lit(x).alias(n) for n, x in zip(("pattern", "label", "priority", "confidence"), r[1:])]
        by.setdefault(r.keyword, []).append(F.struct(*fields))
    return F.create_map(*[x for k, v in by.items() for x in (F.lit(k), F.array(*v))])


def detections(text: Column, ordered: list[Rule]) -> Column:
    """All detections of rules whose keyword the text holds, by start, longest and strongest first."""
    keywords = sorted({r.keyword for r in ordered})

    def of(rule: Column) -> Column:
        return F.transform(
            matches(text, rule["pattern"]),
            lambda s: F.struct(
                s["from"].alias("from"),
                (-s["to"]).alias("minus_to"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
            ),
        )

    def active(held: Column) -> Column:
        return F.flatten(F.transform(held, lambda k: F.element_at(_rules_by_keyword(ordered), k)))

    held = bound(F.lower(text), lambda low: F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(low, k)))
    return F.array_sort(F.flatten(F.transform(bound(held, active), of)))


def suppressed(found: Column) -> Column:
    """What is left of sorted detections: none inside another of the same or a stronger priority.

    The sweep keeps the furthest end per priority, so each detection is looked at once.
    """
    none = F.array().cast(f"array<{FOUND}>")
    zero = F.struct(F.array(*[F.lit(-1)] * 4).alias("ends"), none.alias("kept"))

    def step(state: Column, d: Column) -> Column:
        to = -d["minus_to"]
        inside = F.exists(F.slice(state["ends"], 1, d["priority"]), lambda e: e >= to)
        ends = F.transform(state["ends"], lambda e, i: F.when(i == d["priority"] - 1, F.greatest(e, to)).otherwise(e))
        kept = F.struct(ends.alias("ends"), F.concat(state["kept"], F.array(d)).alias("kept"))
        return F.when(inside, state).otherwise(kept)

    def without_bare(kept: Column) -> Column:
        def alone(named: Column) -> Column:
            touched = lambda d: F.exists(
                named, lambda n: (n["from"] <= -d["minus_to"] + GRANT_REACH) & (d["from"] <= -n["minus_to"])
            )
            return F.filter(kept, lambda d: (d["priority"] < 4) | ~touched(d))

        return bound(F.filter(kept, lambda d: d["priority"] < 4), alone)

    return bound(F.aggregate(found, zero, step, lambda s: s["kept"]), without_bare)


def scan_licenses(docs: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """doc_id, word and phrase counts, labels, score and the detections of every row of ``docs``.

    ``docs`` needs doc_id and text. ``detections`` holds (from, to, priority, label, confidence).
    """
    ordered = rules() if ordered is None else ordered
    text = F.col("_text")
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    phrases = F.array(
        *[F.struct(F.lit(phrase_pattern(p)).alias("pattern"), F.lit(label).alias("label")) for p, label in BASE.items()]
    )
    base = F.flatten(
        F.transform(
            phrases,
            lambda p: F.transform(
                matches(text, p["pattern"]), lambda s: F.struct(s["from"].alias("from"), p["label"].alias("label"))
            ),
        )
    )
    no_base = F.array().cast("array<struct<from:int,label:string>>")
    no_found = F.array().cast(f"array<{FOUND}>")
    rows = rows.withColumns(
        {
            "_n": F.regexp_count("_text", F.lit(WORD_CHAR + "+")).cast("long"),
            "_base": F.when(text.rlike("(?i)license"), base).otherwise(no_base),
            "_found": F.when(gate(text), suppressed(detections(text, ordered))).otherwise(no_found),
        }
    )

    def word_at(place: Column) -> Column:
        return F.regexp_count(F.substring(text, F.lit(1), place), F.lit(WORD_CHAR + "+")).cast("long")

    labels = F.transform("_base", lambda b: b["label"])
    more = F.transform("_found", lambda d: d["label"])
    at = F.transform("_base", lambda b: b["from"])
    confidence = F.array_max(F.transform("_found", lambda d: d["confidence"]))
    return rows.select(
        "doc_id",
        F.col("_n").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        word_at(F.array_min(at)).alias("first_word"),
        word_at(F.array_max(at)).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels, more))), ",").alias("labels"),
        F.greatest(
            F.coalesce(confidence, F.lit(0.0)), F.when(F.size("_base") > 0, BASE_CONFIDENCE).otherwise(0.0)
        ).alias("score"),
        F.transform(
            "_found",
            lambda d: F.struct(
                d["from"].alias("from"),
                (-d["minus_to"]).alias("to"),
                d["priority"].alias("priority"),
                d["label"].alias("label"),
                d["confidence"].alias("confidence"),
            ),
        ).alias("detections"),
    )
