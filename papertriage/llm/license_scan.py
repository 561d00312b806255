"""License scan with built-in column functions only.

Text is normalised to padded words; a text without any rule keyword is done
then. For the others, the rules whose keyword occurs are tried one after the
other: ``split`` and ``regexp_extract_all`` give the places of all matches.
Of overlapping detections one inside another's interval is suppressed unless
its priority is higher: in the order (start, longest first, priority, rule),
a detection is inside an earlier one exactly when some earlier end of at least
its own priority reaches its end, so one pass with one running end per
priority decides all of them.

Nothing is exchanged; each row is worked on by itself.
"""

from __future__ import annotations

import re
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .license_rules import BASE_PHRASES, Rule, rules

PRIORITIES = (1, 2, 3)
# appending to an array copies it, so places are gathered in chunks
CHUNK = 128

# everything below U+0080 but digits and lower-case letters separates words
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def padded_words(text: Column) -> Column:
    """Lower-cased words with one space before, between and after them."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), _SEPARATOR, " ")


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _bounded(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


def _base_places(padded: Column, phrase: str, label: str) -> Column:
    """struct(n, first, last, label) of a phrase; n = 0 where it is absent."""
    pieces = F.split(padded, _bounded(phrase), -1)
    last = _spaces(padded) - _spaces(F.element_at(pieces, -1)) - F.lit(phrase.count(" ")) - 1
    kind = "struct<n:bigint,first:bigint,last:bigint,label:string>"
    found = F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"),
        (_spaces(pieces[0]) - 1).cast("long").alias("first"),
        last.cast("long").alias("last"),
        F.lit(label).alias("label"),
    )
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), found).otherwise(F.lit(None).cast(kind))


def gate_literals(table: list[Rule]) -> list[str]:
    """Few literals one of which every match contains: "licen" where a rule
    needs that word, its keyword elsewhere; literals that contain another one
    of the list are left out."""
    literals = {p for p, _ in BASE_PHRASES}
    for r in table:
        needed = r.regex
        while (bare := re.sub(r"\(\?:[^()]*\)\??", "", needed)) != needed:
            needed = bare
        literals.add("licen" if "licen" in needed else r.keyword)
    return sorted(a for a in literals if not any(b != a and b in a for b in literals))


def _rule_array(table: list[Rule]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("ord"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                F.lit(r.priority).alias("priority"), F.lit(r.weight).alias("weight"), F.lit(_bounded(r.regex)).alias("regex"),
            )
            for i, r in enumerate(table)
        )
    )


_PLACE = "struct<s:int,longest:int,prio:int,ord:int,e:int,label:string,weight:double>"


def _places(padded: Column, rule: Column) -> Column:
    """All matches of one rule as structs that sort by (start, longest first,
    priority, rule)."""
    pieces = F.split(padded, rule["regex"], -1)
    matches = F.regexp_extract_all(padded, rule["regex"], F.lit(0))
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast(f"array<{_PLACE}>").alias("part"),
        F.array().cast(f"array<array<{_PLACE}>>").alias("full"),
    )

    def step(acc: Column, pair: Column) -> Column:
        s = acc["at"] + F.length(pair["p"])
        e = s + F.length(pair["m"])
        place = F.struct(
            s.alias("s"), (-e).alias("longest"), (-rule["priority"]).alias("prio"), rule["ord"].alias("ord"),
            e.alias("e"), rule["label"].alias("label"), rule["weight"].alias("weight"),
        )
        part = F.concat(acc["part"], F.array(place))
        whole = F.size(acc["part"]) >= CHUNK - 1
        return F.struct(
            e.alias("at"),
            F.when(whole, F.array().cast(f"array<{_PLACE}>")).otherwise(part).alias("part"),
            F.when(whole, F.concat(acc["full"], F.array(part))).otherwise(acc["full"]).alias("full"),
        )

    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    # a rule without a match (its keyword alone occurs) gives no pair
    return F.aggregate(pairs, start, step, lambda a: F.concat(F.flatten(a["full"]), a["part"]))


def _resolve(places: Column) -> Column:
    """struct(labels, score, n): what is left after suppression."""
    start = F.struct(
        *(F.lit(-1).alias(f"end{p}") for p in PRIORITIES),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
        F.lit(0).cast("long").alias("n"),
    )

    def step(acc: Column, d: Column) -> Column:
        prio = -d["prio"]
        inside = reduce(lambda a, b: a | b, ((prio <= p) & (acc[f"end{p}"] >= d["e"]) for p in PRIORITIES))
        ends = [F.when(prio == p, F.greatest(acc[f"end{p}"], d["e"])).otherwise(acc[f"end{p}"]).alias(f"end{p}") for p in PRIORITIES]
        return F.struct(
            *ends,
            F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, acc["score"]).otherwise(F.greatest(acc["score"], d["weight"])).alias("score"),
            (acc["n"] + F.when(inside, 0).otherwise(1)).alias("n"),
        )

    return F.aggregate(F.array_sort(places), start, step, lambda a: F.struct(a["labels"], a["score"], a["n"]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[Rule] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, n_detections.

    Null text counts as empty (0 words, no labels, score 0). Overlapping
    places of different base phrases all count. ``score`` is the largest
    weight of the detections left; equal detections go to the earlier rule.
    Null or repeated identifiers are carried through, an empty table gives no
    rows, other columns are not read.
    """
    table = rules() if table is None else table
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), padded_words(whole_text(text_col)).alias("w"))
    w = F.col("w")
    gated = words.withColumn("hit", reduce(lambda a, b: a | b, (F.contains(w, F.lit(k)) for k in gate_literals(table))))
    base = F.array_compact(F.array(*(_base_places(w, p, label) for p, label in BASE_PHRASES)))
    tried = F.filter(_rule_array(table), lambda r: F.contains(w, r["keyword"]))
    places = F.flatten(F.transform(tried, lambda r: _places(w, r)))
    none = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n"))
    found = gated.select(
        "doc_id",
        F.greatest(_spaces(w) - 1, F.lit(0)).cast("long").alias("n_words"),
        F.when(F.col("hit"), base).alias("base"),
        F.when(F.col("hit"), _resolve(places)).otherwise(none).alias("kept"),
    )
    base_labels = F.coalesce(F.transform("base", lambda b: b["label"]), F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("kept.labels"))), ",").alias("labels"),
        F.col("kept.score").alias("score"),
        F.col("kept.n").alias("n_detections"),
    )
