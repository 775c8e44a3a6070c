"""First or best rows of each key, lookups, numbering and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where their scan has fewer tasks than there are cores (few row groups): ahead of costly columns.

    A table of many row groups is left as it is, so nothing of any size is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


def keep_first(df: DataFrame, keys: list, order: list, by: list | None = None) -> DataFrame:
    """The first row of each key in a total order (the planner bounds the rows of a key before it sorts).

    ``by``: some of the keys, for a table of many keys with few rows each; its rows are dealt by them first, so that a task
    sorts its share alone and not a whole split of the input, of which next to nothing would be left out.
    """
    df = df.repartition(*by) if by else df
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, score: Column, tie: list, k: int) -> DataFrame:
    """Rows of a positive score, best first, ties in input order: one pass, k rows a task.

    The filter comes after the limit, which it can't change, so that a score is computed once.
    """
    return df.withColumn("score", score).orderBy(F.desc("score"), *tie).limit(k).filter("score > 0")


def numbered(df: DataFrame, prefix: str, keys: list, order: list, name: str = "id") -> DataFrame:
    """Ids such as dim-001 that start again for each key."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, F.format_string(f"{prefix}-%03d", n))


def lookup_last(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """A row for every key that a row is known by; the last one in order wins."""
    out = df.withColumn("key", F.explode(F.array_compact(F.array(*keys))))
    return keep_first(out, ["key"], [F.desc(order)])


def diversified(total: int, count: int) -> list[int]:
    """Ranks spread evenly over 0..total-1, the first among them; gaps from rounding are filled from the start."""
    if count >= total:
        return list(range(total))
    if count <= 1:
        return [0][:count]
    step = (total - 1) / (count - 1)
    out = list(dict.fromkeys(round(i * step) for i in range(count)))
    return sorted(out + [i for i in range(total) if i not in out][: count - len(out)])


def select_pages(pages: DataFrame, keys: list, n: int = 5, most: int = 500) -> DataFrame:
    """For each key n pages: the best LEGEND, PLAN pages spread over their ranks, then others by number.

    ``pages``: keys, page, type, score.  Ranks of plans follow score, then page; at most ``most`` pages are asked for.
    """
    if not 0 < n <= most:
        raise ValueError(f"n must be 1 to {most}")
    w = Window.partitionBy(*keys, "type").orderBy(F.desc("score"), "page")
    ranked = pages.withColumn("_r", F.row_number().over(w) - 1).withColumn("_all", F.count("*").over(Window.partitionBy(*keys, "type")))
    has = F.max((F.col("type") == "LEGEND").cast("int")).over(Window.partitionBy(*keys))
    wanted = (F.lit(n) - has).alias("wanted")
    ranked = ranked.withColumn("_want", wanted)
    # round(i * step), half to even, for i < wanted; where there are no more plans than wanted, all of them
    step = F.try_divide(F.col("_all") - 1, F.col("_want") - 1)
    picks = F.when(F.col("_all") <= F.col("_want"), F.sequence(F.lit(0), F.col("_all").cast("int") - 1)).when(F.col("_want") <= 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("_want").cast("int") - 1), lambda i: F.bround(i * step).cast("int")))
    chosen = ((F.col("type") == "LEGEND") & (F.col("_r") == 0)) | ((F.col("type") == "PLAN") & (F.col("_want") > 0) & F.array_contains(picks, F.col("_r")))
    out = ranked.withColumn("_first", F.when(chosen, 0).otherwise(1))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_first", "page"))
    return out.withColumn("_place", place).filter(F.col("_place") <= n).drop("_r", "_all", "_want", "_first", "_place")


def stratified(df: DataFrame, stratum: str, key: str, size: int, least: int = 3, seed: int = 42, order: list | None = None) -> DataFrame:
    """A proportional sample of each stratum, ``least`` rows at least; which rows is settled by a hash of the key and seed."""
    order = order or [F.xxhash64(F.col(key), F.lit(seed)), key]
    counts = df.groupBy(stratum).agg(F.count("*").alias("_n"))  # a row for each stratum
    quota = counts.withColumn("_quota", F.greatest(F.lit(least), F.floor(F.col("_n") * size / F.sum("_n").over(Window.partitionBy(F.lit(1))))))
    quota = quota.select(F.col(stratum).alias("_stratum"), "_quota")
    # the share of a stratum can't exceed its least or the size: a bound that the planner applies before it sorts
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    first = df.withColumn("_rank", rank).filter(F.col("_rank") <= max(least, size))
    return first.join(quota, F.col(stratum).eqNullSafe(F.col("_stratum"))).filter("_rank <= _quota").drop("_rank", "_quota", "_stratum")


def spread_pages(total: int, count: int = 5) -> list[int]:
    """Places 0..total-1 of the pages that are analysed: the first, then even steps rounded down, each once."""
    if total <= count:
        return list(range(total))
    return sorted({0, *(min(int(i * (total - 1) / (count - 1)), total - 1) for i in range(1, count))}) if count > 1 else [0][:count]


def unused_pages(pages: DataFrame, used: DataFrame, order: str = "number", key: str = "path", n: int = 3) -> DataFrame:
    """The first ``n`` pages that were not used; where all were, the second to the fourth page."""
    rest = pages.join(used.select(key).distinct(), key, "left_anti").orderBy(order).limit(n).withColumn("_way", F.lit(0))
    place = F.row_number().over(Window.orderBy(order))
    again = pages.orderBy(order).limit(4).withColumn("_place", place).filter("_place >= 2").drop("_place").withColumn("_way", F.lit(1))
    both = rest.unionByName(again)
    first = F.min("_way").over(Window.partitionBy(F.lit(1)))  # seven rows at most
    return both.withColumn("_first", first).filter("_way = _first").drop("_way", "_first")
