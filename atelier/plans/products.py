"""Products that specifications name: makers, models, kinds and what is stated about them; their quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, scores, text
from ..operators.keep import keep_first
from ..operators.settle import settled
from ..operators.within import held

c = F.col
LISTED = 9  # the rank of makers in lists, behind all introductions


def _clean(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text.bare(name), r"(?U)\s+", " "), "[.,;:]+$", "")


def products(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Products of text blocks, the first of each maker (in any case) and model.

    blocks: keys, ord, page, text and, where it is known, code (the section of the page).  Per block, a maker and product
    with a bar between come first, then makers that a word introduces, then items of lists; kind and specs are those
    of the block; a model is the product behind the bar or, for an introduced maker, the block's model number.
    """
    b = blocks if "code" in blocks.columns else blocks.withColumn("code", F.lit(None).cast("string"))
    kind, stated = text.product_type(c("text")), text.specs(c("text"))
    model = F.nullif(F.regexp_extract("text", fixed.MODEL, 1), F.lit(""))
    none = F.lit(None).cast("string")
    no_specs = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    # all forms in one scan: (rank, pattern, its groups), the first group is the maker
    forms = [(0, fixed.BAR_PRODUCT, 2), *((i, p, 1) for i, p in enumerate(fixed.MAKER_INTRODUCTIONS, 1)), (LISTED, fixed.LIST_MAKER, 1)]

    def named(m):  # the maker is computed with the match, once, ahead of all that asks for it
        maker = F.when(m["rank"] == LISTED, text.bare(m["groups"][0])).otherwise(_clean(m["groups"][0]))
        return F.struct(m["rank"].alias("rank"), m["start"].alias("start"), m["stop"].alias("stop"), maker.alias("maker"), m["groups"].alias("groups"))

    each = b.select(*keys, "ord", "page", "code", "text", F.explode(F.transform(text.matches(c("text"), forms), named)).alias("_s")).withColumn("maker", c("_s.maker"))
    plain = c("_s.rank") == LISTED
    low, size = F.lower("maker"), F.length("maker")
    barred = text.is_maker(c("maker"))
    introduced = size.between(2, 50) & ~low.isin(fixed.NO_INTRODUCED)
    listed = size.between(2, 40) & ~text.any_of(low, fixed.NO_LISTED)
    each = each.filter(F.when(c("_s.rank") == 0, barred).when(plain, listed).otherwise(introduced))
    bar = F.regexp_replace(text.bare(c("_s.groups")[1]), "[.,;:]+$", "")
    lo, hi = F.greatest(c("_s.start") - 50, F.lit(0)), F.least(c("_s.stop") + 50, F.length("text"))
    about = F.left(F.when(plain, F.substring("text", lo + 1, hi - lo)).otherwise(c("text")), F.lit(200))
    out = each.select(*keys, "ord", "page", "code", c("_s.rank").alias("_rank"), c("_s.start").alias("_at"), "maker", F.when(c("_s.rank") == 0, bar).when(plain, none).otherwise(model).alias("model"), plain.alias("_plain"), "text", about.alias("context"))
    first = keep_first(out.withColumn("_key", F.lower("maker")), [*keys, "_key", "model"], ["ord", "_rank", "_at"])
    # what a block states is read once for each product that stays
    first = first.withColumns({"kind": F.when(c("_plain"), none).otherwise(kind), "specs": F.when(c("_plain"), no_specs).otherwise(stated)})
    return first.drop("_key", "_rank", "_at", "_plain", "text")


def is_product(maker: Column, model: Column) -> Column:
    """Whether a maker and a model can be ones."""
    capitals = (F.upper(model) == model) & (F.lower(model) != model) & (F.length(model) > 15)
    words = F.lower(maker).isin(fixed.NO_OLD_PRODUCTS) | F.lower(model).isin(fixed.NO_OLD_PRODUCTS) | text.any_of(F.lower(maker), fixed.NO_OLD_MAKER_PARTS)
    return F.length(maker).between(2, 50) & F.length(model).between(2, 60) & ~words & ~model.rlike(r"(?i)section\s+\d{2}\s+\d{2}\s+\d{2}") & ~capitals


def is_known(maker: Column) -> Column:
    return text.any_of(F.lower(maker), fixed.KNOWN_MAKERS)


def product_confidence(form: Column, maker: Column, model: Column) -> Column:
    """How sure a product is: its form, a known maker, less for a very short model; within [0.3, 1], two places."""
    base = F.lit(0.60)
    for name, _, _, _, value in fixed.OLD_PRODUCTS:
        base = F.when(form == name, value).otherwise(base)
    sure = F.when(is_known(maker), F.least(F.lit(1.0), base + 0.05)).otherwise(base) - F.when(F.length(model) < 5, 0.10).otherwise(0.0)
    return F.bround(F.greatest(F.lit(0.3), F.least(F.lit(1.0), sure)), 2)


def older_products(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Products in the five older forms, the first of each maker and model (in any case) by form, then place.

    texts: keys, text.  Known makers alone count where the form says little; line ends inside names are blanks.
    """
    joined = F.regexp_replace(F.regexp_replace("text", r"(\w)\s*\n\s*(\w)", "$1 $2"), r"(?m)^\s*\.?\d+\s*", "")
    t = texts.select(*keys, joined.alias("text"))
    makers = "|".join("\\Q" + m + "\\E" for m in sorted(fixed.KNOWN_MAKERS, key=lambda m: (-len(m), m)))
    tidy = lambda x: F.regexp_replace(F.regexp_replace(text.bare(F.regexp_replace(x, r"^[\s.0-9]+", "")), r"\s+", " "), "[.,;:]+$", "")
    forms = [(rank, pattern.replace("MAKERS", makers), 2) for rank, (_, pattern, *_) in enumerate(fixed.OLD_PRODUCTS)]
    names = [form for form, *_ in fixed.OLD_PRODUCTS]
    turned = [rank for rank, (_, _, maker, _, _) in enumerate(fixed.OLD_PRODUCTS) if maker == 2]

    def named(m):  # both names are computed with the match, once, ahead of all that asks for them
        maker, model = (F.when(m["rank"].isin(turned), m["groups"][1 - i]).otherwise(m["groups"][i]) for i in (0, 1))
        return F.struct(m["rank"].alias("rank"), m["start"].alias("start"), F.regexp_replace(text.bare(maker), "[.,;:)]+$", "").alias("maker"), tidy(model).alias("model"))

    form = F.element_at(F.array(*(F.lit(n) for n in names)), c("s.rank") + 1)
    each = t.select(*keys, F.explode(F.transform(text.matches(c("text"), forms), named)).alias("s"))
    each = each.select(*keys, form.alias("form"), c("s.rank").alias("_rank"), c("s.start").alias("_at"), c("s.maker").alias("maker"), c("s.model").alias("model"))
    low, known = F.lower("maker"), is_known(c("maker"))
    good = (
        F.when(c("form") == "pipe", ~low.isin(fixed.NO_BAR_MAKERS) & (known | (F.length("maker") > 4)))
        .when(c("form") == "labeled", (F.length("maker") >= 3) & (F.length("model") >= 3))
        .when(c("form") == "known_mfr", ~F.lower("model").rlike("^(?:ou|or|et|and|de) ") & ~text.any_of(F.lower("model"), fixed.OTHER_MAKERS))
        .otherwise(known)
    )
    out = each.filter(good & is_product(c("maker"), c("model")))
    out = out.withColumns({"_maker": F.lower("maker"), "_model": F.lower("model")})
    first = keep_first(out, [*keys, "_maker", "_model"], ["_rank", "_at"])
    shown = F.when(c("form") == "known_mfr", F.initcap("maker")).otherwise(c("maker"))
    return first.select(*keys, shown.alias("maker"), "model", "form", product_confidence(c("form"), c("maker"), c("model")).alias("confidence"))


def field_score(found: dict[str, Column], true: dict[str, Column]) -> Column:
    """Share of the fields that agree: equal, or one within the other where neither is empty."""
    norm = lambda x: text.compared(x.cast("string"))

    def agrees(a, b):
        return (a == b) | ((b != "") & F.contains(a, b)) | ((a != "") & F.contains(b, a))

    return sum((agrees(norm(found[k]), norm(true[k])).cast("int") for k in found), F.lit(0)) / F.lit(len(found))


FIELDS = ("section", "category", "product", "type")


def _agreeing(found: DataFrame, true: DataFrame, k: str) -> DataFrame:
    """(t_k, f_k): the distinct values of a field that agree: equal, or one within the other where neither is empty."""
    t, f = true.select(f"t_{k}").distinct(), found.select(f"f_{k}").distinct()
    same = t.join(f, c(f"t_{k}") == c(f"f_{k}"))
    both = [held(a, b, own, other, text=own, item=other).select(f"t_{k}", f"f_{k}") for a, own, b, other in ((f, f"f_{k}", t, f"t_{k}"), (t, f"t_{k}", f, f"f_{k}"))]
    return settled(same.unionByName(both[0]).unionByName(both[1]).distinct())


def against_truth(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Each true product with the first found one of its section that agrees in more than half of four fields.

    Both: ord, section, category, product, type.  Without any the status is ``missing``.  Products of a section agree in it,
    so two of the other three fields are wanted: for each two of them the first product found of equal values stands for
    all, and distinct values meet by the table of those that agree.  No product meets all of its section.
    """
    named = lambda df, p: df.select("ord", F.coalesce("section", F.lit("")).alias("_s"), *(text.compared(c(k).cast("string")).alias(f"{p}_{k}") for k in FIELDS))
    f, t = settled(named(found, "f")), settled(named(truth, "t"))
    others = FIELDS[1:]
    agree = {k: _agreeing(f, t, k) for k in others}
    whole = F.struct(c("ord").alias("found_ord"), *(c(f"f_{k}") for k in FIELDS))
    each = t
    for i, left in enumerate(others):
        for right in others[i + 1 :]:
            first = f.groupBy("_s", f"f_{left}", f"f_{right}").agg(F.min(whole).alias("_p"))
            wanted = t.select("_s", f"t_{left}", f"t_{right}").distinct().join(agree[left], f"t_{left}").join(agree[right], f"t_{right}")
            best = wanted.join(first, ["_s", f"f_{left}", f"f_{right}"]).groupBy("_s", f"t_{left}", f"t_{right}").agg(F.min("_p").alias(f"_{left}_{right}"))
            each = each.join(best, ["_s", f"t_{left}", f"t_{right}"], "left")
    first = F.least(*(c(f"_{x}_{y}") for i, x in enumerate(others) for y in others[i + 1 :]))
    each = each.withColumn("_p", first).filter("_p is not null")
    scored = each.select("ord", c("_p.found_ord").alias("found_ord"), field_score({k: c(f"_p.f_{k}") for k in FIELDS}, {k: c(f"t_{k}") for k in FIELDS}).alias("score"))
    best = keep_first(scored, ["ord"], ["found_ord"])
    return truth.select("ord", "section").join(best, "ord", "left").withColumn("status", F.when(c("score").isNull(), "missing").otherwise("matched"))


def quality(rows: DataFrame, least: float = 0.7) -> DataFrame:
    """Number of products, of those with a confidence, of those under ``least``."""
    return rows.agg(F.count("*").alias("total"), F.count("confidence").alias("with_confidence"), F.count_if(c("confidence") < least).alias("low"))


def low_confidence(rows: DataFrame, least: float = 0.75) -> DataFrame:
    """What needs to be checked; without a confidence nothing is doubted."""
    return rows.filter(F.coalesce("confidence", F.lit(1.0)) < least)


def mean_score(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count("*").alias("n"), F.count_if(c("status") == "matched").alias("matched"), scores.ratio(F.sum("score"), F.count("score")).alias("score"))
