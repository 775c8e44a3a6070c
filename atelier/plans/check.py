"""Drawings against specifications, results against the truth, confidence, alerts and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, imperial, scores, text
from ..operators.keep import keep_first
from ..operators.within import held

c = F.col


def paint_systems(spark) -> DataFrame:
    rows = [(k, surface, kinds, finish) for k, (surface, kinds, finish) in fixed.PAINT_SYSTEMS.items()]
    return spark.createDataFrame(rows, "system string, surface string, types array<string>, finish string")


def finish_titles(spark) -> DataFrame:
    return spark.createDataFrame(list(fixed.FINISH_TITLES.items()), "code string, title string")


def finish_sections(spark) -> DataFrame:
    rows = [(code, kind) for code, kinds in fixed.FINISH_SECTIONS.items() for kind in kinds]
    return spark.createDataFrame(rows, "code string, type string")


def expected_finishes(spark) -> DataFrame:
    rows = [(k, *v) for k, v in fixed.EXPECTED_FINISHES.items()]
    return spark.createDataFrame(rows, "type string, wall array<string>, floor array<string>, ceiling array<string>")


def named_types(sections: DataFrame) -> DataFrame:
    """(code, type, snippets): room types that the text of a section names, with the words about each."""
    kinds = F.array(*(F.struct(F.lit(k).alias("type"), F.transform(text.spans(c("text"), rf"(?iu)\b(?:{p})\b"), lambda s: text.around(c("text"), s, 40, 40)).alias("snippets")) for k, p in fixed.TYPE_WORDS.items()))
    return sections.select("code", F.explode(kinds).alias("k")).select("code", "k.type", "k.snippets").filter(F.size("snippets") > 0)


def by_type(rooms: DataFrame, sections: DataFrame) -> DataFrame:
    """For each room type: its rooms, the sections that cover it (stated in the text or by the table), what is missing.

    A type that only the specification names has no rooms; confidence is 0.85 where a covering section names the type.
    """
    spark = rooms.sparkSession
    counts = rooms.groupBy(text.room_type(c("name")).alias("type")).agg(F.count("*").alias("n_rooms"))
    named = named_types(sections).select("code", "type", F.lit(True).alias("named"))
    listed = F.broadcast(finish_sections(spark)).join(sections.select("code").distinct(), "code").select("code", "type", F.lit(False).alias("named"))
    cover = named.unionByName(listed).groupBy("type").agg(F.array_sort(F.collect_set("code")).alias("codes"), F.max("named").alias("named"))
    out = counts.join(cover, "type", "full_outer").withColumns({"n_rooms": F.coalesce("n_rooms", F.lit(0)), "codes": F.coalesce("codes", F.array().cast("array<string>"))})
    begins = lambda *heads: F.exists("codes", lambda k: F.startswith(k, F.lit(heads[0])) | F.startswith(k, F.lit(heads[1])))
    status = F.when(c("n_rooms") == 0, "not in drawings").when(F.size("codes") == 0, "not in specification").otherwise("covered")
    expected = (c("n_rooms") > 0) & c("type").isin(list(fixed.EXPECTED_FINISHES))
    floor = expected & ~c("type").isin("TECHNIQUE", "RANGEMENT", "GYMNASE") & ~begins("09 65", "09 30")
    ceiling = expected & ~c("type").isin("TECHNIQUE", "RANGEMENT", "GYMNASE", "WC") & ~begins("09 51", "09 53")
    return out.select("type", "n_rooms", "codes", status.alias("status"), F.when(status == "covered", F.when(c("named"), 0.85).otherwise(0.70)).alias("confidence"), floor.alias("floor_missing"), ceiling.alias("ceiling_missing"))


def by_name(rooms: DataFrame, parts: DataFrame) -> DataFrame:
    """Each room's best mention in the specification: its id within a text or title in any case, else its name within a
    text, else the sections that cover its type, else nothing but the generic ones.

    rooms: id, name and, where it is known, type.  parts: (pord, title, content, sub boolean); a subsection is found by
    id alone; of several mentions the first counts.  Ids and names are looked for once each, however many rooms have
    them; null or empty ones are found nowhere.  A type that finishes are expected of and no section covers is missing.
    """
    r = rooms if "type" in rooms.columns else rooms.withColumn("type", F.lit(None).cast("string"))
    r = r.withColumns({"_id": F.upper("id"), "_name": F.upper("name"), "type": F.coalesce(F.nullif("type", F.lit("")), text.room_type(F.coalesce("name", F.lit(""))))})
    # a part is known by its place, so what is found needs no way back to the parts
    place = F.struct("pord", "title").alias("place")
    contents, titles = parts.select(place, F.upper("content").alias("text"), "sub"), parts.select(place, F.upper("title").alias("text"), "sub")

    def first(column: str, within: DataFrame, name: str) -> DataFrame:
        items = r.select(F.col(column).alias("needle")).filter("needle <> ''").distinct()
        hits = held(within, items.withColumn("item", F.col("needle")), "place", "needle")
        return hits.groupBy(F.col("needle").alias(column)).agg(F.min("place").alias(name))

    out = r.join(first("_id", contents.unionByName(titles), "by_id"), "_id", "left").join(first("_name", contents.filter("not sub"), "by_name"), "_name", "left")
    covered = {k: [code for code, kinds in fixed.FINISH_SECTIONS.items() if k in kinds][:3] for k in sorted({x for v in fixed.FINISH_SECTIONS.values() for x in v})}
    cover = F.try_element_at(F.create_map(*[F.lit(x) for k, v in covered.items() for x in (k, ", ".join(v))]), c("type"))
    way = F.when(c("by_id").isNotNull(), "direct").when(c("by_name").isNotNull(), "name").when(cover.isNotNull(), "inferred").when(c("type").isin(list(fixed.EXPECTED_FINISHES)), "missing").otherwise("generic")
    level = F.when(way == "direct", 0.9).when(way == "name", 0.6).when(way == "inferred", 0.7).when(way == "generic", 0.4)
    section = F.coalesce("by_id.title", "by_name.title", F.when(way == "inferred", cover))
    return out.select(*rooms.columns, *([] if "type" in rooms.columns else ["type"]), section.alias("section"), way.alias("way"), level.alias("confidence"))


def name_match_totals(found: DataFrame) -> DataFrame:
    """Rooms, those matched (all but the missing) and their share."""
    out = found.agg(F.count("*").alias("total_rooms"), F.count_if(c("way") != "missing").alias("matched_rooms"))
    return out.withColumn("match_rate", scores.ratio(c("matched_rooms"), c("total_rooms")))


def length_mismatches(plan: DataFrame, spec: DataFrame) -> DataFrame:
    """Rooms whose sides on the drawing differ from the specification's.  plan: id, width, length; spec: text."""
    side = r"\d+'(?:\s*-?\s*\d+(?:\s+\d+/\d+)?\"?)?"
    p = rf"(?iu)([A-Z]-?\d{{3}})[^\n]*?({side})\s*[x×]\s*({side})"
    got = spec.select(F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias("m"))
    got = got.select(F.upper(F.regexp_extract("m", p, 1)).alias("key"), *(imperial.parsed(F.regexp_extract("m", p, i))["total_inches"].alias(f"spec_{n}") for i, n in ((2, "width"), (3, "length"))))
    own = plan.filter("coalesce(width, '') <> '' and coalesce(length, '') <> ''").select("id", F.upper("id").alias("key"), *(imperial.parsed(c(n))["total_inches"].alias(f"plan_{n}") for n in ("width", "length")))
    return own.join(got, "key").filter("not (plan_width <=> spec_width and plan_length <=> spec_length)").drop("key")


def against_truth(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Rooms found, missing and extra by id, with the share of five fields that agree.  Of repeated ids the last counts."""
    last = lambda df: keep_first(df, ["id"], [F.desc("ord")])
    a = last(found).select("id", *(c(k).alias(f"f_{k}") for k in ("name", "block", "floor", "type")))
    b = last(truth).select("id", *(c(k).alias(f"t_{k}") for k in ("name", "block", "floor", "type")), F.lit(True).alias("_t"))
    both = a.withColumn("_f", F.lit(True)).join(b, "id", "full_outer")
    norm = lambda col: text.compared(col.cast("string"))
    # an empty value and a floor 0 count as nothing; two of nothing agree
    floor = lambda col: F.when(col == 0, "").otherwise(norm(col))
    fn, tn = norm(c("f_name")), norm(c("t_name"))
    name = (fn == tn) | ((fn != "") & (tn != "") & text.either_holds(fn, tn)) | text.same_name(fn, tn)
    kind = norm(F.coalesce(F.nullif("f_type", F.lit("")), text.truth_type(c("f_name")))) == norm(c("t_type"))
    agree = {"name": name, "block": norm(c("f_block")) == norm(c("t_block")), "floor": floor(c("f_floor")) == floor(c("t_floor")), "type": kind}
    status = F.when(c("_t").isNull(), "extra").when(c("_f").isNull(), "missing").otherwise("matched")
    out = both.withColumn("status", status).withColumns({f"{k}_ok": F.when(c("status") == "matched", v) for k, v in agree.items()})
    score = F.when(c("status") == "matched", (1 + sum(c(f"{k}_ok").cast("int") for k in agree)) / 5)
    severity = F.when((c("status") == "matched") & ~c("name_ok"), "critical").when((c("status") == "matched") & ~(c("block_ok") & c("floor_ok") & c("type_ok")), "minor")
    return out.select("id", "status", score.alias("score"), *(f"{k}_ok" for k in agree), severity.alias("severity"))


def truth_metrics(compared: DataFrame) -> DataFrame:
    """Mean score, precision (ids found that are true), recall and F1; 0 where there is nothing to divide by."""
    sums = compared.agg(F.count_if(c("status") == "matched").alias("matched"), F.count_if(c("status") != "missing").alias("found"), F.count_if(c("status") != "extra").alias("true"), F.coalesce(F.avg("score"), F.lit(0.0)).alias("accuracy"), F.count_if(c("score") == 1).alias("perfect"))
    out = sums.withColumns({"precision": scores.ratio(c("matched"), c("found")), "recall": scores.ratio(c("matched"), c("true"))})
    return out.withColumn("f1", scores.ratio(2 * c("precision") * c("recall"), c("precision") + c("recall")))


def type_differences(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Rooms of each type as counted from names and as stated.  truth: (type, expected)."""
    own = found.groupBy(text.counted_type(c("name")).alias("type")).agg(F.count("*").alias("found"))
    return own.join(truth, "type", "full_outer").select("type", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("expected", F.lit(0)).alias("expected"))


def with_confidence(rooms: DataFrame) -> DataFrame:
    """Rooms with confidence and primary page; further columns stay.  A floor of 0 is no place."""
    pages = F.coalesce("source_pages", F.array().cast("array<int>"))
    has = lambda k: F.coalesce(c(k), F.lit("")) != ""
    place = (F.coalesce(c("floor"), F.lit(0)) != 0) | has("block")
    return rooms.withColumns({"confidence": scores.room_confidence(c("extraction_method"), F.size(pages), has("name"), has("id"), place), "primary_source": F.coalesce(F.nullif("primary_source", F.lit(0)), scores.primary_page(pages))})


def confidence_summary(rooms: DataFrame) -> DataFrame:
    v = c("confidence")
    return rooms.agg(F.bround(F.avg(v), 3).alias("mean"), F.count_if(v >= 0.8).alias("high"), F.count_if((v >= 0.5) & (v < 0.8)).alias("medium"), F.count_if(v < 0.5).alias("low"))


ALERT = "severity string, type string, item string, message string"


def alerts(rooms: DataFrame) -> DataFrame:
    """What is doubtful about each room: (severity, type, item, message)."""
    v, n = c("confidence"), F.size(F.coalesce("source_pages", F.array().cast("array<int>")))
    notes = F.lower("extraction_notes")
    tell = lambda cond, severity, kind, message: F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("type"), F.lit(message).alias("message")))
    each = [
        tell(v < 0.4, "ERROR", "VERY_LOW_CONFIDENCE", "confidence under 0.4"), tell((v >= 0.4) & (v < 0.7), "WARNING", "LOW_CONFIDENCE", "confidence under 0.7"), tell(n == 0, "ERROR", "NO_SOURCE_PAGES", "no page shows it"), tell(n == 1, "WARNING", "SINGLE_SOURCE", "one page shows it"),
        tell(F.coalesce("name", F.lit("")).isin("LOCAL", ""), "WARNING", "GENERIC_NAME", "the name tells nothing"), tell(text.any_of(notes, ["ambigu", "incertain", "possible", "?"]), "WARNING", "AMBIGUOUS_EXTRACTION", "the notes doubt it"),
    ]
    return rooms.select(F.coalesce("id", F.lit("UNKNOWN")).alias("item"), F.explode(F.array_compact(F.array(*each))).alias("a")).select("a.severity", "a.type", "item", "a.message")


def room_quality(rooms: DataFrame) -> DataFrame:
    """One row: rooms, those with a confidence, with a doubtful one, without pages, with one page, the mean confidence, and how many each method found."""
    v, n = c("confidence"), F.size(F.coalesce("source_pages", F.array().cast("array<int>")))
    method = F.coalesce("extraction_method", F.lit("unknown")).alias("method")
    each = rooms.groupBy(method).agg(F.count("*").alias("n"), F.count(v).alias("m"), F.sum(v).alias("s"), F.count_if((v >= 0.4) & (v < 0.7)).alias("low"), F.count_if(n == 0).alias("none"), F.count_if(n == 1).alias("one"))  # a row for each method
    total = lambda k: F.coalesce(F.sum(k), F.lit(0))
    return each.agg(
        total("n").alias("total_rooms"), total("m").alias("with_confidence"), total("low").alias("low_confidence"), total("none").alias("missing_pages"), total("one").alias("single_source"), F.coalesce(F.bround(F.try_divide(F.sum("s"), F.sum("m")), 3), F.lit(0.0)).alias("mean_confidence"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", "n")))).alias("methods"),
    )


def quality_alerts(rooms: DataFrame | None, products: DataFrame | None = None) -> DataFrame:
    """All alerts of an extraction: of each room, of contradictions, of products, and of the whole; a table that is not there is an alert itself."""
    spark = (rooms if rooms is not None else products).sparkSession if rooms is not None or products is not None else SparkSession.active()
    if rooms is None:
        out = spark.createDataFrame([("ERROR", "FILE_NOT_FOUND", "rooms", "there is no table of rooms")], ALERT)
    else:
        of = room_quality(rooms)
        row = lambda severity, kind, message: F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("type"), F.lit("GLOBAL").alias("item"), message.alias("message"))
        told = F.format_string("%d rooms, mean confidence %.2f", "total_rooms", "mean_confidence")
        few = F.when(c("with_confidence") < c("total_rooms") * 0.5, row("WARNING", "LOW_CONFIDENCE_COVERAGE", F.format_string("%d of %d rooms have a confidence", "with_confidence", "total_rooms")))
        whole = of.select(F.explode(F.array_compact(F.array(row("INFO", "EXTRACTION_SUMMARY", told), few))).alias("a")).select("a.*")
        out = alerts(rooms).unionByName(contradictions(rooms)).unionByName(whole)
    if products is not None:
        name = F.concat_ws("_", F.coalesce("manufacturer", F.lit("UNKNOWN")), F.coalesce("model", F.lit("UNKNOWN")))
        low = products.filter("confidence < 0.7").select(F.lit("WARNING").alias("severity"), F.lit("LOW_PRODUCT_CONFIDENCE").alias("type"), name.alias("item"), F.lit("confidence under 0.7").alias("message"))
        sums = products.agg(F.count("*").alias("n"), F.count("confidence").alias("m")).filter("n > 0")
        out = out.unionByName(low).unionByName(sums.select(F.lit("INFO").alias("severity"), F.lit("PRODUCT_SUMMARY").alias("type"), F.lit("GLOBAL").alias("item"), F.format_string("%d products, %d with a confidence", "n", "m").alias("message")))
    return out


def severity_totals(told: DataFrame) -> DataFrame:
    """Alerts of each severity, 0 where there are none."""
    domain = told.sparkSession.createDataFrame([("ERROR",), ("WARNING",), ("INFO",)], "severity string")
    return domain.join(told.groupBy("severity").agg(F.count("*").alias("n")), "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


def contradictions(rooms: DataFrame) -> DataFrame:
    """Ids with more than one name (a null name is an empty one), names sorted."""
    names = rooms.filter("id <> ''").groupBy("id").agg(F.sort_array(F.collect_set(F.coalesce("name", F.lit("")))).alias("names"))
    return names.filter(F.size("names") > 1).select(F.lit("ERROR").alias("severity"), F.lit("CONTRADICTORY_NAME").alias("type"), c("id").alias("item"), F.concat(F.lit("names: "), F.array_join("names", ", ")).alias("message"))


def rule_confidences(seen: DataFrame) -> DataFrame:
    """Per rule: counts of each status, confidence and stability.  seen: (rule_id, status)."""
    n = lambda s: F.count_if(c("status") == s).cast("double").alias(s.lower())
    sums = seen.filter("status <> 'NOT_APPLICABLE'").groupBy("rule_id").agg(n("CONFIRMED"), n("CONTRADICTED"), n("VARIATION"), F.count("*").alias("n"))
    return sums.withColumns({"confidence": scores.rule_confidence(c("confirmed"), c("contradicted"), c("variation"), c("n")), "stable": scores.is_stable(c("confirmed"), c("contradicted"), c("n"))})


def rule_gate(rules: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Overall score (weighted by observations) and whether a final guide may be made.  A threshold of 0 is 0."""
    out = rules.agg(scores.ratio(F.sum(c("confidence") * c("n")), F.sum("n")).alias("score"), F.coalesce(F.bool_or(c("contradicted") > 0), F.lit(False)).alias("contradicted"), F.count_if("stable").alias("n_stable"))
    return out.withColumn("final", (c("score") >= threshold) & ~c("contradicted") & (c("n_stable") > 0))


def stable_rules(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    return candidates.join(rules.filter("stable").select("rule_id", c("confidence").alias("observed")), "rule_id", "left").withColumn("description", F.coalesce("description", F.lit("no description"))).filter("observed is not null")


def rule_issues(rules: DataFrame, pages: int | None = None) -> DataFrame:
    """(rule_id, issue): rules that pages contradict, rules of little confidence, and (without a rule) too few pages."""
    each = F.array_compact(F.array(F.when(c("contradicted") > 0, F.concat(F.lit("contradicted: "), "rule_id")), F.when(c("confidence") < 0.5, F.concat(F.lit("low confidence: "), "rule_id"))))
    out = rules.select("rule_id", F.explode(each).alias("issue"))
    if pages is not None and pages < 2:
        out = out.unionByName(rules.sparkSession.createDataFrame([(None, "too few pages: two at least")], "rule_id string, issue string"))
    return out


def recommendations(rules: DataFrame, pages: int | None = None) -> DataFrame:
    """(ord, recommendation) for what the issues of rules ask for."""
    unstable = F.array_sort(F.collect_list(F.when(~c("stable"), c("rule_id"))))
    sums = rules.agg(unstable.alias("unstable"), F.count_if(c("contradicted") > 0).alias("contradicted"), F.count_if(c("confidence") < 0.5).alias("low"))
    none = (c("contradicted") == 0) & (c("low") == 0) & F.lit(pages is None or pages >= 2)
    each = [
        F.when(none, F.lit("the guide is stable and can be made final")), F.when(~none & (F.size("unstable") > 0), F.concat(F.lit("review unstable rules: "), F.array_join("unstable", ", "))),
        F.when(~none & (c("contradicted") > 0), F.lit("look into contradicted rules")), F.when(~none & (c("low") > 0), F.lit("validate on more pages")),
    ]
    return sums.select(F.posexplode(F.array_compact(F.array(*each))).alias("ord", "recommendation"))


def rule_ids(guide: Column) -> Column:
    """Ids of rules that a guide names, sorted, each once; the first three where it names none."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(guide, F.lit(r"R\d{3}"), F.lit(0))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("R001"), F.lit("R002"), F.lit("R003")))


def provisional_guide(candidates: DataFrame, analysis: str) -> DataFrame:
    """A guide (one row) of candidate rules: rule_id, description, confidence."""
    line = F.format_string("- %s: %s (confidence: %s)", "rule_id", F.coalesce("description", F.lit("")), F.col("confidence").cast("string"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rule_id", line.alias("line")))), lambda r: r["line"]), "\n")
    return candidates.agg(F.concat(F.lit(f"# Provisional guide\n\n## Analysis\n{analysis}\n\n## Candidate rules\n"), rows, F.lit("\n")).alias("guide"))


def final_guide(stable: DataFrame, score: float) -> DataFrame:
    """A guide (one row) of stable rules: rule_id, pattern, description, observed, n."""
    block = F.concat(F.lit("### "), "rule_id", F.lit(": "), F.coalesce("pattern", F.lit("")), F.lit("\n- Description: "), "description", F.format_string("\n- Confidence: %.2f%%\n- Validations: %d", c("observed") * 100, F.col("n").cast("long")))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rule_id", block.alias("b")))), lambda r: r["b"]), "\n")
    head = F.format_string(f"# Final guide\n\nOverall confidence: {100 * score:.2f}%%\nStable rules: %d\n\n", F.count("*"))
    return stable.agg(F.concat(head, rows, F.lit("\n")).alias("guide"))


def verified_rows(rows: DataFrame) -> DataFrame:
    """Rooms checked by eye with what agrees; what was not seen agrees with nothing.  rows: gt_id, gt_name, vision_id, vision_name."""
    norm = lambda k: F.upper(text.bare(F.coalesce(c(k), F.lit(""))))
    name = (norm("gt_name") == norm("vision_name")) | ((norm("gt_name") != "") & (norm("vision_name") != "") & text.either_holds(norm("gt_name"), norm("vision_name")))
    return rows.withColumns({"id_match": (norm("gt_id") == norm("vision_id")) & (norm("gt_id") != ""), "name_match": name & (norm("gt_name") != "")})


def verification(rows: DataFrame, of: int | None = None) -> DataFrame:
    """Totals of a check by eye; ``of``: how many rooms there are, for the share that was checked."""
    sums = verified_rows(rows).agg(F.count("*").alias("n"), F.count_if("id_match").alias("ids"), F.count_if("name_match").alias("names"), F.count_if(c("id_match") & c("name_match")).alias("full"))
    out = sums.withColumn("reliability", F.bround(100 * scores.ratio(c("full"), c("n")), 1))
    return out if of is None else out.withColumn("sample", F.bround(100 * scores.ratio(c("n"), F.lit(of)), 1))


def markdown(report: DataFrame, order: list[str]) -> DataFrame:
    """A small result as one Markdown table (one row)."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in report.columns)), F.lit(" |"))
    rows = report.select(F.struct(*order).alias("_o"), line.alias("_l")).agg(F.array_sort(F.collect_list(F.struct("_o", "_l"))).alias("_a"))
    head = "| " + " | ".join(report.columns) + " |\n|" + " --- |" * len(report.columns) + "\n"
    return rows.select(F.concat(F.lit(head), F.array_join(F.transform("_a", lambda r: r["_l"]), "\n")).alias("markdown"))
