"""Reports as text: small results told in Markdown or plain lines, one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

c = F.col


def lines(df: DataFrame, order: list, line: Column, most: int | None = None) -> DataFrame:
    """One row: the lines of a small result in order, ``most`` at most."""
    rows = df.select(F.struct(*order).alias("o"), line.alias("line"))
    rows = rows.orderBy("o").limit(most) if most else rows
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda r: r["line"]), "\n").alias("text"))


def table(df: DataFrame, order: list, names: dict[str, str]) -> DataFrame:
    """One row: a small result as a Markdown table with these headings."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in names)), F.lit(" |"))
    head = "| " + " | ".join(names.values()) + " |\n|" + " --- |" * len(names)
    return lines(df, order, cells).select(F.concat_ws("\n", F.lit(head), F.nullif("text", F.lit(""))).alias("text"))


def joined(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row of all parts, each under its heading; a part without lines is left out."""
    out = None
    for i, (head, df) in enumerate(parts):
        row = df.select(F.lit(i).alias("i"), F.concat(F.lit(f"{head}\n\n" if head else ""), "text").alias("t"), (c("text") != "").alias("has"))
        out = row if out is None else out.unionByName(row)
    return out.filter("has").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda r: r["t"]), "\n\n").alias("text"))


def cross_validation(matches: DataFrame, by_type: DataFrame) -> DataFrame:
    """Drawings against a specification: totals, coverage of types, matches and what is missing.  matches: check.by_name; by_type: check.by_type."""
    sums = matches.agg(F.count("*").alias("n"), F.count_if(c("way") != "missing").alias("m"), F.count_if(c("way") == "missing").alias("x"))
    rate = F.coalesce(F.try_divide(c("m"), c("n")), F.lit(0.0)) * 100
    head = sums.select(F.format_string("| Rooms | %d |\n| Matches | %d |\n| Missing | %d |\n| Rate | %.1f%% |", "n", "m", "x", rate).alias("text"))
    cover = table(by_type.select("type", "n_rooms", F.array_join("codes", ", ").alias("codes"), "status"), ["type"], {"type": "Type", "n_rooms": "Rooms", "codes": "Sections", "status": "Status"})
    found = table(matches.filter("way <> 'missing'"), ["id", "name"], {"id": "Room", "name": "Name", "section": "Section", "way": "Match", "confidence": "Confidence"})
    gone = lines(matches.filter("way = 'missing'"), ["id", "name"], F.concat_ws("", F.lit("- **"), "id", F.lit("** ("), "name", F.lit(")")))
    return joined([("# Drawings against the specification", head), ("## Types", cover), ("## Matches", found), ("## Missing", gone)])


def truth(metrics: DataFrame, compared: DataFrame) -> DataFrame:
    """Results against the truth: metrics, then the first five differences and missing ids.  compared: check.against_truth."""
    pct = lambda k: F.format_string(f"{k.capitalize()}: %.1f%%", c(k) * 100)
    head = metrics.select(F.concat_ws("\n", *(pct(k) for k in ("accuracy", "precision", "recall", "f1")), F.format_string("True: %d\nFound: %d\nPerfect: %d\nPartial: %d", "true", "found", "perfect", c("matched") - c("perfect"))).alias("text"))
    fields = F.array_compact(F.array(*(F.when(~c(f"{k}_ok"), F.lit(k)) for k in ("name", "block", "floor", "type"))))
    wrong = compared.filter("status = 'matched'").select("id", F.explode(fields).alias("field"))
    return joined([("=== Against the truth ===", head), ("--- Differences ---", lines(wrong, ["id", "field"], F.concat_ws(".", "id", "field"), 5)), ("--- Missing ---", lines(compared.filter("status = 'missing'"), ["id"], c("id"), 5))])


def verification(totals: DataFrame, rows: DataFrame) -> DataFrame:
    """A check by eye: totals, what disagrees, a verdict.  totals: check.verification; rows: check.verified_rows."""
    head = totals.select(F.format_string("| Checked | %d |\n| Full matches | %d |\n| Id matches | %d |\n| Name matches | %d |\n| Reliability | %.1f%% |", "n", "full", "ids", "names", "reliability").alias("text"))
    wrong = table(rows.filter("not (id_match and name_match)"), ["gt_id", "gt_name"], {"gt_id": "Id", "gt_name": "Name", "vision_id": "Seen id", "vision_name": "Seen name", "id_match": "Id agrees", "name_match": "Name agrees"})
    verdict = F.when(c("reliability") >= 90, "highly reliable").when(c("reliability") >= 70, "fairly reliable: what disagrees must be put right").otherwise("not reliable: a full review is needed")
    return joined([("# Verification", head), ("## What disagrees", wrong), ("## Conclusion", totals.select(F.concat(F.lit("The truth is "), verdict).alias("text")))])


def observed(df: DataFrame, **figures: Column) -> tuple[DataFrame, Observation]:
    """``df`` and figures of it (aggregates by name) that the job which writes it finds on the way: no second scan.

    The figures are there when an action on the returned frame has ended; rows of one action are counted once, however
    often its tasks are run again.
    """
    watch = Observation()
    return df.observe(watch, *(v.alias(k) for k, v in figures.items())), watch


def run_steps(spark: SparkSession, watches: list[Observation]) -> DataFrame:
    """Figures of observed jobs that have ended, in order, as run_summary takes them: ord, name, value."""
    found = [(k, None if v is None else int(v)) for watch in watches for k, v in watch.get.items()]
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(found)], "ord int, name string, value long")


def run_summary(steps: DataFrame, source: str, seconds: float) -> DataFrame:
    """A run: what each step counted, in order.  steps: ord, name, value."""
    return lines(steps, ["ord"], F.concat_ws("", F.lit("- **"), "name", F.lit(":** "), F.col("value").cast("string"))).select(F.concat(F.lit(f"# Run\n\nSource: {source}\nSeconds: {seconds:.1f}\n\n"), "text").alias("text"))
