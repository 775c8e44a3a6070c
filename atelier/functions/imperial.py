"""Imperial lengths (25'-6 5/8") as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bare, spans

#: A length: feet with inches and a fraction, feet with inches, feet, inches with a fraction, inches.
LENGTH = r"^(?:(\d+)'(?:\s*-?\s*(\d+)(?:\s+(\d+)/(\d+))?\")?|(\d+)(?:\s+(\d+)/(\d+))?\")$"
#: All forms inside a longer text; the longest alternative comes first.
ANYWHERE = r"\d+'\s*-?\s*\d+\s+\d+/\d+\"|\d+'\s*-?\s*\d+\"|\d+'(?!\s*-?\s*\d)|\d+\s+\d+/\d+\"|\d+\""
ROUND_SIZES = (96.0, 120.0, 144.0, 180.0, 240.0, 360.0)


def inches(text: Column) -> Column:
    """Inches of a text that is one length; null if it is none.  A fraction over 0 counts as 0."""
    t = bare(text)
    # feet, inches, numerator and denominator from one pass; what a form lacks is empty
    parts = F.split(F.regexp_replace(t, LENGTH, "$1|$2$5|$3$6|$4$7"), r"\|")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return F.when(t.rlike(LENGTH), zero(number(0)) * 12 + zero(number(1)) + zero(F.try_divide(number(2), number(3))))


def is_length(text: Column) -> Column:
    return inches(text).isNotNull()


def parsed(text: Column) -> Column:
    """struct<raw, feet, inches, total_inches, decimal_feet> of a text that begins with feet."""
    p = r"^(\d+)'\s*-?\s*(?:(\d+)(?:\s+(\d+)/(\d+))?\"?)?"
    t = bare(text)
    part = lambda i: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, p, i), F.lit("")), F.lit("9" * 18)).cast("double"), F.lit(0.0))
    inch = part(2) + F.coalesce(F.try_divide(part(3), part(4)), F.lit(0.0))
    total = part(1) * 12 + inch
    return F.when(t.rlike(p), F.struct(t.alias("raw"), part(1).cast("int").alias("feet"), inch.alias("inches"), total.alias("total_inches"), F.bround(total / 12, 3).alias("decimal_feet")))


def confidence(text: Column, embedded: bool = False) -> Column:
    """How sure a length is: its form, its size, round sizes; less inside a longer text."""
    v, form = inches(text), bare(text).rlike(r"^\d+'\s*-?\s*\d+(?:\s+\d+/\d+)?\"$")
    score = F.lit(0.7) + F.when(form, 0.15).otherwise(0.0) + F.when(v.between(6, 1200), 0.1).otherwise(0.0) + F.when(v.isin(*ROUND_SIZES), 0.05).otherwise(0.0)
    return F.least(F.lit(1.0), score) * (0.9 if embedded else 1.0)


def within(text: Column) -> Column:
    """All lengths inside a text, left to right without overlaps: array<struct<match, start, stop>>."""
    return spans(text, ANYWHERE)
