"""Text as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .scores import let

#: Pieces of a text whose lengths are added up at a time.
BLOCK = 128


def bare(c: Column) -> Column:
    """Without white space at the ends (all of it, not blanks alone)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def search_text(c: Column) -> Column:
    """Lower case, single blanks."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def compared(c: Column) -> Column:
    """Upper case, dashes and underscores as blanks, '' for nothing."""
    return F.translate(bare(F.upper(F.coalesce(c, F.lit("")))), "-_", "  ")


def room_name(c: Column) -> Column:
    out = bare(F.upper(c))
    for old, new in fixed.NAME_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def any_of(c: Column, words: list[str]) -> Column:
    out = F.contains(c, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(c, F.lit(w))
    return out


def ladder(c: Column, rungs: list[tuple[list[str], str]], rest: str) -> Column:
    """The value of the first rung of which a word is in the text."""
    out = F.when(any_of(c, rungs[0][0]), rungs[0][1])
    for words, value in rungs[1:]:
        out = out.when(any_of(c, words), value)
    return out.otherwise(rest)


def room_type(name: Column) -> Column:
    return ladder(room_name(name), fixed.LADDER_PLAN, "AUTRE")


def truth_type(name: Column) -> Column:
    c = compared(name)
    return F.when(c == "", "").otherwise(ladder(c, fixed.LADDER_TRUTH, "AUTRE"))


def counted_type(name: Column) -> Column:
    return ladder(F.upper(name), fixed.LADDER_COUNT, "AUTRE")


def index_type(name: Column, keys: list[str]) -> Column:
    """A key of the index that the name holds, else the ladder."""
    c = F.upper(name)
    out = ladder(c, fixed.LADDER_INDEX, "OTHER")
    for k in reversed(keys):
        out = F.when(F.contains(c, F.lit(k)), k).otherwise(out)
    return out


def same_name(a: Column, b: Column) -> Column:
    """Both in one group of names that mean the same room."""
    out = F.lit(False)
    for group in fixed.SAME_NAMES:
        words = [w.upper().strip().replace("-", " ").replace("_", " ") for w in group]
        out = out | (a.isin(words) & b.isin(words))
    return out


def either_holds(a: Column, b: Column) -> Column:
    return F.contains(a, b) | F.contains(b, a)


def room_number_confidence(text: Column) -> Column:
    """Confidence that a text is a room number; null if it is none."""
    t, out = bare(text), None
    for pattern, value in fixed.ROOM_NUMBERS:
        out = F.when(t.rlike(pattern), value) if out is None else out.when(t.rlike(pattern), value)
    return out


def is_room_name(text: Column) -> Column:
    return bare(text).rlike("(?iu)^(?:" + "|".join(f"(?:{p})" for p in fixed.ROOM_NAMES) + ")$")


def is_door_label(text: Column) -> Column:
    return bare(F.upper(text)).rlike("|".join(f"(?:{p})" for p in fixed.DOOR_LABELS))


def door_number(text: Column) -> Column:
    """P-01A of a door's label; null without digits."""
    t = bare(F.upper(text))
    digits, letter = F.regexp_extract(t, r"(\d+)([A-Z])?", 1), F.regexp_extract(t, r"(\d+)([A-Z])?", 2)
    padded = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.when(digits != "", F.concat(F.lit("P-"), padded, letter))


def file_name(c: Column) -> Column:
    out = F.regexp_replace(c, r"(?U)[^\p{Alnum}\-_.]", "_")
    return F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_+|_+$", "")


def csi_code(c: Column) -> Column:
    """The first section code dd dd dd, its pairs with blanks or dashes between and nothing of a word beside them."""
    return F.when(F.regexp_extract(c, fixed.CODE, 0) != "", F.concat_ws(" ", *(F.regexp_extract(c, fixed.CODE, i) for i in (1, 2, 3))))


def source_pages(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"p\.(A-\d+)"), F.lit(1))


def source_document(c: Column, plans: str = "Plans construction", devis: str = "Devis architecture") -> Column:
    t = F.lower(c)
    found = F.array_compact(F.array(F.when(any_of(t, ["plan construction", "p.a-"]), plans), F.when(F.contains(t, F.lit("devis")), devis), F.when(F.contains(t, F.lit("door schedule")), f"{plans} (door schedule)"), F.when(F.contains(t, F.lit("vision")), "Vision verification")))
    return F.when(F.size(found) > 0, F.array_join(found, " + ")).otherwise(c)


def room_search_text(name: Column, plan_id: Column, id_: Column, type_: Column, block: Column, floor: Column, notes: Column, area: Column) -> Column:
    """Everything by which a verified room may be asked for."""
    none = F.lit("")
    n, t = F.upper(F.coalesce(name, none)), F.upper(F.coalesce(type_, none))
    parts = [F.coalesce(c, none) for c in (name, plan_id, id_, type_, block)]
    for in_name, as_type, words in fixed.SEARCH_WORDS:
        hit = any_of(n, in_name) | (t.isin(as_type) if as_type else F.lit(False))
        parts.append(F.when(hit, " ".join(words)))
    for k, words in fixed.FLOOR_WORDS.items():
        parts.append(F.when(floor == k, " ".join(words)))
    parts += [F.when(notes != "", notes), F.when(area != "", F.concat(area, F.lit(" pi²")))]
    return search_text(F.concat_ws(" ", *parts))


def _running(sizes: Column) -> Column:
    """0 and the sums of the first one, two and more sizes; in blocks, so that an append copies no more than a block."""
    append = lambda start, part: F.aggregate(part, start, lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
    zero = F.array(F.lit(0))

    def by_blocks(ns):
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(ns) / BLOCK).cast("int")), lambda i: F.slice(ns, i * BLOCK + 1, BLOCK))

        def summed(bs):
            ats = append(zero, F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda acc, n: acc + n)))
            shifted = lambda b, at: F.transform(F.slice(append(zero, b), 2, BLOCK), lambda x: at + x)
            return let(ats, lambda a: F.concat(zero, F.flatten(F.transform(bs, lambda b, i: shifted(b, F.get(a, i))))))

        return let(blocks, summed)

    return let(sizes, lambda ns: F.when(F.size(ns) <= BLOCK, append(zero, ns)).otherwise(by_blocks(ns)))


def found(text: Column, pattern: str, groups: int | None = 0) -> Column:
    """All matches of a pattern: array<struct<match, start, stop, groups>>, left to right, JVM-side, in one pass of the pattern.

    Places are 0-based, stop excluded; ``groups`` holds the texts of the first so many groups, '' for one that took no
    part (None: no such field).  Empty matches are left out; null text gives null.  The pass puts marks about matches and groups that the text
    does not hold, and places are sums of the lengths of what stands before, in blocks so that many matches cost no more
    than a few each.
    """
    one, other = F.lit("\uf8f0"), F.lit("\uf8f1")  # of the private area; a text that holds one gets marks of its own digest

    def split(t):
        tail = F.when(F.contains(t, one) | F.contains(t, other), F.sha2(t.cast("binary"), 256)).otherwise("")
        mark, part = F.concat(one, tail), F.concat(other, tail)
        whole = F.concat(mark, F.lit("$0"), *(x for i in range(1, (groups or 0) + 1) for x in (part, F.lit(f"${i}"))), mark)
        return F.struct(F.split(F.regexp_replace(t, F.lit(pattern), whole), mark).alias("pieces"), part.alias("part"))

    def placed(x):
        pieces = x["pieces"]
        bare_piece = (lambda p: F.call_function("substring_index", p, x["part"], F.lit(1))) if groups else (lambda p: p)

        def one_match(start, i):
            piece = F.element_at(pieces, 2 * i + 2)
            match = bare_piece(piece)
            parts = [] if groups is None else [(F.slice(F.split(piece, x["part"]), 2, groups) if groups else F.array().cast("array<string>")).alias("groups")]
            return F.struct(match.alias("match"), start.alias("start"), (start + F.length(match)).alias("stop"), *parts)

        ends = _running(F.transform(pieces, lambda p: F.length(bare_piece(p))))
        starts = F.filter(F.slice(ends, 2, F.size(pieces) - 1), lambda _, i: i % 2 == 0)
        return F.transform(starts, one_match)

    out = let(split(text), placed)
    return F.when(text.isNotNull(), F.filter(out, lambda m: m["stop"] > m["start"]))


def spans(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places: ``found`` without groups, array<struct<match, start, stop>>."""
    return found(text, pattern, None)


def matches(text: Column, forms: list[tuple[int, str, int]]) -> Column:
    """Matches of several patterns (rank, pattern, groups) as one array, form by form, each with its rank: one scan, one explode."""
    ranked = lambda rank: lambda m: F.struct(F.lit(rank).alias("rank"), m["match"].alias("match"), m["start"].alias("start"), m["stop"].alias("stop"), m["groups"].alias("groups"))
    return F.concat(*(F.transform(found(text, pattern, groups), ranked(rank)) for rank, pattern, groups in forms))


def around(text: Column, span: Column, before: int, after: int) -> Column:
    """The text about a match, as one line."""
    lo = F.greatest(F.lit(0), span["start"] - before)
    hi = F.least(F.length(text), span["stop"] + after)
    return bare(F.replace(F.substring(text, lo + 1, hi - lo), F.lit("\n"), F.lit(" ")))


def product_type(text: Column) -> Column:
    """The first kind of product that a text names."""
    return F.coalesce(*(F.nullif(F.lower(F.regexp_extract(text, p, 1)), F.lit("")) for p in fixed.PRODUCT_TYPES))


def specs(text: Column) -> Column:
    """Dimension, thickness, colour, rating and fire rating that a text states, as a map."""
    side = lambda i: F.nullif(F.regexp_extract(text, fixed.SPECS["dimension"], i), F.lit(""))
    sides = F.concat_ws(" x ", side(1), side(2), side(3))
    out = {k: bare(F.regexp_extract(text, p, 1)) for k, p in fixed.SPECS.items()}
    out["dimension"] = F.when(sides != "", F.concat_ws(" ", sides, side(4)))
    full = F.create_map(*[x for k, v in out.items() for x in (F.lit(k), F.coalesce(v, F.lit("")))])
    return F.map_filter(full, lambda k, v: v != "")


def is_maker(c: Column, most: int = 40) -> Column:
    """Whether a text can be a maker's name."""
    low = F.lower(c)
    words = r"(?u)^(et|ou|de|des|le|la|sans|avec|pour|avant|après)\s"
    return F.length(c).between(2, most) & ~low.isin(fixed.NO_MAKERS) & ~low.rlike(words) & ~any_of(low, fixed.NO_MAKER_PARTS) & c.rlike(r"^\p{Lu}")


def room_reply(reply: Column) -> Column:
    """struct<id, name> that a reply in plain words gives for a room; null where it gives none."""
    t = F.coalesce(reply, F.lit(""))
    first = lambda patterns, group: F.coalesce(*(F.nullif(F.regexp_extract(t, p, group), F.lit("")) for p in patterns))
    said = bare(F.upper(F.regexp_replace(bare(first(fixed.REPLY_NAMES, 0)), r"(?i)^NOM\s*[:=]\s*", "")))
    common = F.coalesce(*(F.when(F.contains(F.lower(t), F.lit(n.lower())), n) for n in fixed.COMMON_NAMES))
    return F.struct(F.upper(first(fixed.REPLY_IDS, 1)).alias("id"), F.coalesce(F.nullif(said, F.lit("")), common).alias("name"))


# Questions: one text on the driver, no table.


def terms(question: str, synonyms: list[list[str]] = fixed.SYNONYMS) -> list[str]:
    """Words of a question and their synonyms, sorted."""
    words = re.split(r"\s+", question.lower().strip())
    return sorted({*words, *(s for group in synonyms if any(w in group for w in words) for s in group)})


def gold_terms(question: str) -> list[str]:
    plain = re.sub(fixed.QUESTION_MARKS, " ", re.sub(fixed.QUESTION_PHRASES, "", question.lower().strip()))
    words = [w for w in plain.split() if len(w) > 1]
    return terms(" ".join(words), fixed.GOLD_SYNONYMS) if words else []


def asked_room(question: str) -> str | None:
    """The room id that a question names."""
    q = question.upper().strip()
    for p in fixed.ASKED_ROOMS:
        if m := re.search(p, q):
            return "-".join(m.groups())
    return None


def asked_total(question: str) -> dict | None:
    """A count or list question: its kind, noun and block."""
    q = question.lower()
    if m := re.search(fixed.ASKED_COUNT, q):
        return {"kind": "count", "noun": m[1], "type": fixed.QUESTION_NOUNS.get(m[1]), "block": m[2].upper()}
    if m := re.search(fixed.ASKED_LIST, q):
        return {"kind": "list", "noun": m[1], "type": fixed.QUESTION_NOUNS.get(m[1]), "block": None}
    return None
