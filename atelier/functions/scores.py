"""Scores, confidences and classes as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def page_scores(text: Column) -> Column:
    """struct of the score of each page class: weighted counts of its words (matches that don't overlap); room numbers
    speak for a plan, up to a bound."""
    numbers = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\b[1-9]\d{2}\b"))

    def of(x):
        low, out = x["low"], []

        def count(acc, e):
            return acc + F.when(F.contains(low, e["w"]), F.floor((F.octet_length(low) - F.octet_length(F.replace(low, e["w"], F.lit("")))) / e["n"]).cast("int") * e["k"]).otherwise(0)

        for name, words in fixed.PAGE_WORDS.items():
            table = F.array(*(F.struct(F.lit(w).alias("w"), F.lit(len(w.encode())).alias("n"), F.lit(k).alias("k")) for w, k in words.items()))
            score = F.aggregate(table, F.lit(0), count)
            out.append((score + F.least(x["numbers"] * fixed.NUMBER_WEIGHT, F.lit(fixed.NUMBER_MOST)) if name == "PLAN" else score).alias(name))
        return F.struct(*out)

    return let(F.struct(F.lower(F.coalesce(text, F.lit(""))).alias("low"), numbers.alias("numbers")), of)


def page_class(scores: Column) -> Column:
    """The class of the highest score, the earlier of equals; OTHER without any."""
    top = F.greatest(*(scores[k] for k in fixed.PAGE_WORDS))
    out = F.when(top <= 0, "OTHER")
    for name in fixed.PAGE_WORDS:
        out = out.when(scores[name] == top, name)
    return out


def room_confidence(method: Column, n_pages: Column, has_name: Column, has_id: Column, has_place: Column) -> Column:
    """Weight of the method, times how many pages show the room, times how complete it is; within [0.1, 1], 3 places."""
    known = F.when(method.isNotNull() & (method != ""), method).when(n_pages >= 2, "cross_ref").when(n_pages == 1, "ocr").otherwise("inferred")
    weight = F.lit(fixed.METHOD_WEIGHTS["unknown"])
    for k, v in fixed.METHOD_WEIGHTS.items():
        weight = F.when(known == k, v).otherwise(weight)
    pages = F.when(n_pages >= 3, 1.0).when(n_pages == 2, 0.85).when(n_pages == 1, 0.7).otherwise(0.3)
    whole = 1.0 - F.when(has_name, 0.0).otherwise(0.1) - F.when(has_id, 0.0).otherwise(0.2) - F.when(has_place, 0.0).otherwise(0.1)
    return F.bround(F.greatest(F.lit(0.1), F.least(F.lit(1.0), weight * pages * whole)), 3)


def door_confidence(method: Column, angle: Column, has_line: Column, has_number: Column) -> Column:
    quality = 1 - F.least(F.abs(angle - 90) / 20, F.lit(1.0))
    arc = 0.5 + 0.2 * quality + F.when(has_line, 0.15).otherwise(0.0) + F.when(has_number, 0.15).otherwise(0.0)
    label = 0.4 + F.when(has_number, 0.2).otherwise(0.0)
    pattern = 0.35 + F.when(has_number, 0.25).otherwise(0.0)
    return F.least(F.lit(1.0), F.when(method == "arc", arc).when(method == "label", label).when(method == "pattern", pattern).otherwise(0.3))


def rule_confidence(confirmed: Column, contradicted: Column, varied: Column, n: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(confirmed - 2 * contradicted + 0.5 * varied, n), F.lit(0.0))))


def is_stable(confirmed: Column, contradicted: Column, n: Column) -> Column:
    return (F.coalesce(F.try_divide(confirmed, n), F.lit(0.0)) >= 0.7) & (contradicted == 0)


def primary_page(pages: Column) -> Column:
    """The least page under 30, else the least."""
    return F.coalesce(F.array_min(F.filter(pages, lambda p: p < 30)), F.array_min(pages))


def search_score(terms: list[str], text: Column, name: Column, number: Column) -> Column:
    """For each term: 1 in the text; 3 for an equal name or number, else 2 within."""
    asked = F.struct(text.alias("t"), F.lower(F.coalesce(name, F.lit(""))).alias("n"), F.lower(F.coalesce(number, F.lit(""))).alias("k"))

    def total(x):
        one = lambda t: F.contains(x["t"], t).cast("int") + F.when((t == x["n"]) | (t == x["k"]), 3).when(F.contains(x["n"], t) | F.contains(x["k"], t), 2).otherwise(0)
        return sum((one(F.lit(t)) for t in terms), F.lit(0))

    return let(asked, total)


def gold_score(terms: list[str], room: str | None, text: Column, id_: Column, plan_id: Column, name: Column) -> Column:
    """Terms in the text 1; the asked room 10; a name 3 or 2; a plan id 5 or 2."""
    none = F.lit("")
    n, p, i = F.lower(F.coalesce(name, none)), F.lower(F.coalesce(plan_id, none)), F.lower(F.coalesce(id_, none))

    def total(x):
        one = lambda t: F.contains(x["t"], t).cast("int") + F.when(t == x["n"], 3).when(F.contains(x["n"], t), 2).otherwise(0) + F.when(t == x["p"], 5).when(F.contains(x["p"], t), 2).otherwise(0)
        return sum((one(F.lit(t)) for t in terms), F.lit(0))

    out = let(F.struct(text.alias("t"), n.alias("n"), p.alias("p")), total)
    if room:
        own = F.lit(room.lower())
        tail = F.lit(room.lower().split("-", 1)[1] if re.match(r"[a-z]-", room.lower()) else room.lower())
        out = out + F.when((i == own) | (p == own), 10).otherwise(0) + F.when(p == tail, 10).otherwise(0)
    return out


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))
