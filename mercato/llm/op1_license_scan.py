"""Licence scan: ordered signature rules, gated by keywords, overlaps resolved by priority.

The text becomes lower-case words joined by one space. Only rules of which a keyword occurs are
tried; a document without any keyword is done. A match is an
interval of words; it is dropped if another match of the same or a higher priority contains it
(of equal intervals and priorities, the rule that comes first stays).

Everything is one projection over the documents: no shuffle, so no key can be hot. Work and
memory per document are linear in its words, but for copying its list of matches.

NULL and empty texts have no words, no labels and score 0. Repeated rows are each reported.
Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import table, whole_text
from mercato.llm.license_rules import LICENCES, SENTENCES

# Fixed values of the contract: phrases and the labels they give.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\u0001"  # a separator, so no word holds it

GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|offered)(?: [^ ]+){0,3} under"
TERMS = r"(?: the)?(?: terms of)?(?: the| an?)?"


class Rule(NamedTuple):
    """`priority` from 1 to `PRIORITIES`; `weight` is what a surviving match says about the document.

    Each match holds one of the `keywords`, parted by spaces, as a word.
    """

    label: str
    keywords: str
    regex: str
    priority: int
    weight: float


PRIORITIES = 4


def rules() -> list[Rule]:
    """The ordered rules: for each licence its identifier, a grant, its name as a licence, its name."""
    made = []
    for x in LICENCES:
        known = rf"(?:{x.name})"
        made.append(Rule(x.label, "spdx", rf"spdx licen[cs]e identifier {x.spdx}", 4, 1.0))
        made.append(Rule(x.label, x.keywords, rf"{GRANT}{TERMS} {known}(?: licen[cs]e)?", 3, 1.0))
        made.append(Rule(x.label, x.keywords, rf"(?:the )?{known} licen[cs]e", 2, 0.8))
        if not x.plain:
            made.append(Rule(x.label, x.keywords, known, 1, 0.5))
    made += [Rule(label, keywords, regex, 2, weight) for label, keywords, regex, weight in SENTENCES]
    return made


def _padded(keywords: str) -> list[str]:
    return [f" {k} " for k in keywords.split()]


def keywords(ordered: list[Rule]) -> list[str]:
    """The keywords of all rules, between spaces."""
    return sorted({k for r in ordered for k in _padded(r.keywords)})


# Every rule's matches, between spaces, hold one of these strings.
ROOTS = tuple(keywords(rules()))


def _bounded(regex: Column | str) -> Column:
    """The expression at whole words only."""
    return F.concat(F.lit("(?<![^ ])(?:"), F.lit(regex) if isinstance(regex, str) else regex, F.lit(")(?![^ ])"))


def words_of(text: Column) -> Column:
    """Lower-case words joined by one space; A to Z alone change case."""
    # Kelvin sign and dotted capital I are the two other letters whose lower case holds ASCII.
    kept = F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.trim(F.regexp_replace(F.lower(kept), SEPARATORS, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def starts(words: Column, regex: Column | str) -> Column:
    """Word numbers, from 0, at which matches start."""
    marked = F.split(F.regexp_replace(words, _bounded(regex), F.lit(MARK + "$0")), " ")
    at = F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i.cast("bigint")))
    return F.filter(at, lambda i: i.isNotNull())


def matches(words: Column, rule: Column) -> Column:
    """Intervals of a rule, in the order in which suppression wants them."""
    found = F.regexp_extract_all(words, F.concat(F.lit("("), _bounded(rule["regex"]), F.lit(")")), F.lit(1))
    return F.zip_with(
        starts(words, rule["regex"]),
        found,
        lambda start, match: F.struct(
            start.alias("start"),
            (-(start + _spaces(match))).alias("minus_last"),
            (-rule["priority"]).alias("minus_priority"),
            rule["place"].alias("place"),
            rule["label"].alias("label"),
            rule["weight"].alias("weight"),
        ),
    )


MATCH = "struct<start:bigint,minus_last:bigint,minus_priority:int,place:int,label:string,weight:double>"


def surviving(found: Column) -> Column:
    """Matches that no other match of at least their priority contains.

    In order of start, then longest first, a container comes before what it contains, so it is
    enough to keep, per priority, the furthest last word of matches with at least that priority.
    """

    def step(state: Column, m: Column) -> Column:
        last, priority = -m["minus_last"], -m["minus_priority"]
        kept = F.when(F.element_at(state["reach"], priority) >= last, state["kept"]).otherwise(
            F.concat(state["kept"], F.array(m))
        )
        reach = F.transform(
            state["reach"], lambda x, i: F.when(i < priority, F.greatest(x, last)).otherwise(x)
        )
        return F.struct(kept.alias("kept"), reach.alias("reach"))

    empty = F.struct(
        F.array().cast(f"array<{MATCH}>").alias("kept"),
        F.array_repeat(F.lit(-1).cast("bigint"), PRIORITIES).alias("reach"),
    )
    return F.aggregate(F.array_sort(found), empty, step, lambda s: s["kept"])


def _rule_table(ordered: list[Rule]) -> Column:
    return F.array(
        *(
            F.struct(
                F.array(*map(F.lit, _padded(r.keywords))).alias("keywords"),
                F.lit(r.regex).alias("regex"),
                F.lit(r.priority).alias("priority"),
                F.lit(place).alias("place"),
                F.lit(r.label).alias("label"),
                F.lit(r.weight).alias("weight"),
            )
            for place, r in enumerate(ordered)
        )
    )


def scan(docs: DataFrame, text: str = "text", ordered: list[Rule] | None = None) -> DataFrame:
    """`docs` with `_words` (text) and `_matches` (the surviving ones: start, label, weight ...)."""
    ordered = ordered or rules()

    def detect(rule: Column) -> Column:
        return matches(F.col("_words"), rule)

    present = F.filter(F.array(*map(F.lit, keywords(ordered))), lambda k: F.contains("_padded", k))
    tried = F.filter(_rule_table(ordered), lambda r: F.arrays_overlap(r["keywords"], F.col("_present")))
    return (
        docs.withColumn("_words", words_of(whole_text(text)))
        .withColumn("_padded", F.concat(F.lit(" "), "_words", F.lit(" ")))
        .withColumn("_present", present)
        .withColumn(
            "_matches",
            F.when(F.size("_present") > 0, surviving(F.flatten(F.transform(tried, detect)))).otherwise(
                F.array().cast(f"array<{MATCH}>")
            ),
        )
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    none = F.array().cast("array<bigint>")
    places = {
        label: F.when(F.contains("_words", F.lit(phrase)), starts(F.col("_words"), phrase)).otherwise(none)
        for phrase, label in BASE_PHRASES
    }
    base = F.array(*(F.when(F.size(F.col(f"_at_{i}")) > 0, F.lit(x)) for i, x in enumerate(places)))
    all_places = F.concat(*(F.col(f"_at_{i}") for i in range(len(places))))
    return (
        scan(docs)
        .withColumns({f"_at_{i}": c for i, c in enumerate(places.values())})
        .withColumns({"_base": F.array_sort(F.array_compact(base)), "_places": all_places})
        .select(
            "doc_id",
            F.when(F.col("_words") == "", F.lit(0))
            .otherwise(_spaces(F.col("_words")) + 1)
            .cast("bigint")
            .alias("n_words"),
            F.size("_places").cast("bigint").alias("n_base"),
            F.array_min("_places").alias("first_word"),
            F.array_max("_places").alias("last_word"),
            F.array_join("_base", ",").alias("base_labels"),
            F.array_join(
                F.array_sort(
                    F.array_distinct(
                        F.concat("_base", F.transform("_matches", lambda m: m["label"]))
                    )
                ),
                ",",
            ).alias("labels"),
            F.coalesce(F.array_max(F.transform("_matches", lambda m: m["weight"])), F.lit(0.0)).alias("score"),
            F.size("_matches").cast("bigint").alias("n_matches"),
        )
    )
