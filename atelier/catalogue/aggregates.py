"""Queries that count, average, rank and pick."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import settle
from ..operators.keep import diversified, keep_first, stratified
from ..plans import check
from .base import query

c = F.col


_CONF = "greatest(0.1, least(1.0, CASE WHEN source = 'src0' THEN 0.85 WHEN source = 'src1' THEN 0.9 WHEN quality IS NOT NULL THEN 0.8 ELSE 0.6 END * CASE WHEN n_chars >= 2000 THEN 1.0 WHEN n_chars >= 1000 THEN 0.85 WHEN n_chars >= 500 THEN 0.7 ELSE 0.3 END * (1.0 - CASE WHEN toxic IS NULL THEN 0.1 ELSE 0 END)))"


@query(f"SELECT lang, round(avg(v), 6)::DOUBLE AS mean, count(*) FILTER (v >= 0.8) AS high, count(*) FILTER (v >= 0.5 AND v < 0.8) AS medium, count(*) FILTER (v < 0.5) AS low FROM (SELECT lang, round_even({_CONF}, 3)::DOUBLE AS v FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1")
def confidence_buckets(t):
    rows = t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")
    method = F.when(c("source") == "src0", "ocr").when(c("source") == "src1", "table").when(c("quality").isNotNull(), "cross_ref").otherwise("inferred")
    pages = F.when(c("n_chars") >= 2000, 3).when(c("n_chars") >= 1000, 2).when(c("n_chars") >= 500, 1).otherwise(0)
    v = scores.room_confidence(method, pages, c("toxic").isNotNull(), F.lit(True), F.lit(True))
    rows = rows.select("lang", v.alias("v"))
    return rows.groupBy("lang").agg(F.round(F.avg("v"), 6).alias("mean"), F.count_if(c("v") >= 0.8).alias("high"), F.count_if((c("v") >= 0.5) & (c("v") < 0.8)).alias("medium"), F.count_if(c("v") < 0.5).alias("low"))


_RULES = "SELECT user_id, count(*) FILTER (event_type = 'purchase')::DOUBLE AS confirmed, count(*) FILTER (event_type = 'error')::DOUBLE AS contradicted, count(*) FILTER (event_type = 'click')::DOUBLE AS variation, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1"
_RULE_CONF = "greatest(0.0, least(1.0, (confirmed - 2 * contradicted + 0.5 * variation) / n))"


def _rules(t):
    status = F.when(c("event_type") == "purchase", "CONFIRMED").when(c("event_type") == "error", "CONTRADICTED").when(c("event_type") == "click", "VARIATION").when(c("event_type") == "view", "NOT_APPLICABLE").otherwise("OTHER")
    return check.rule_confidences(t.events.select(c("user_id").alias("rule_id"), status.alias("status")))


@query(f"SELECT user_id, confirmed, contradicted, variation, n, round({_RULE_CONF}, 6)::DOUBLE AS confidence, (confirmed / n >= 0.7 AND contradicted = 0) AS stable FROM ({_RULES})")
def rule_status_counts(t):
    return _rules(t).select(c("rule_id").alias("user_id"), "confirmed", "contradicted", "variation", "n", F.round("confidence", 6).alias("confidence"), "stable")


@query(f"SELECT round(sum({_RULE_CONF} * n) / sum(n), 6)::DOUBLE AS score, bool_or(contradicted > 0) AS contradicted, count(*) FILTER (confirmed / n >= 0.7 AND contradicted = 0) AS n_stable FROM ({_RULES})")
def rule_overall_score(t):
    return check.rule_gate(_rules(t)).select(F.round("score", 6).alias("score"), "contradicted", "n_stable")


@query("SELECT lang, source FROM (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY sum(n_chars) DESC, source) AS r FROM documents GROUP BY 1, 2) WHERE r = 1")
def weighted_mode(t):
    sums = t.documents.groupBy("lang", "source").agg(F.sum("n_chars").alias("w"))
    return keep_first(sums, ["lang"], [F.desc("w"), "source"]).select("lang", "source")


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def keep_first_distinct(t):
    best = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("m"))
    return best.select("l_partkey", "l_suppkey", "m.l_orderkey", "m.l_linenumber")


@query("""SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r, greatest(3, floor(count(*) OVER (PARTITION BY lang) * 30 / (SELECT count(*) FROM documents))) AS q FROM documents) WHERE r <= q""")
def stratified_sample_quota(t):
    return stratified(t.documents.select("lang", "doc_id"), "lang", "doc_id", 30, 3, order=["doc_id"]).select("lang", "doc_id")


@query("""SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, count(*) FILTER (value >= 50) AS high, arg_max(user_id, n_user * 1000000000 - user_id) AS top_user FROM (SELECT *, count(*) OVER (PARTITION BY event_type, user_id) AS n_user FROM events) GROUP BY 1""")
def entity_stats(t):
    per = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.count_if(c("value") >= 50).alias("high"))
    return per.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("s") / F.sum("n"), 4).alias("mean"), F.sum("high").alias("high"), F.max_by("user_id", F.struct("n", -c("user_id"))).alias("top_user"))


@query("""SELECT o_orderstatus, month, n, round(total, 2) AS total, round(100 * total / sum(total) OVER (PARTITION BY o_orderstatus), 4) AS share FROM (SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2)""")
def order_stats(t):
    sums = t.orders.groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    share = 100 * c("total") / F.sum("total").over(Window.partitionBy("o_orderstatus"))
    return sums.select("o_orderstatus", "month", "n", F.round("total", 2).alias("total"), F.round(share, 4).alias("share"))


_PICKS = diversified(50, 7)


@query(f"SELECT p_brand, p_partkey, p_size FROM (SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY (p_size >= 30), p_size, p_partkey) AS r, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) - 1 AS k FROM part) WHERE r = 1 OR k IN ({', '.join(map(str, _PICKS))})")
def pick_rules(t):
    first = F.row_number().over(Window.partitionBy("p_brand").orderBy(c("p_size") >= 30, "p_size", "p_partkey"))
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")) - 1
    return t.part.withColumns({"r": first, "k": rank}).filter((c("r") == 1) | c("k").isin(_PICKS)).select("p_brand", "p_partkey", "p_size")


@query("""SELECT date_trunc('hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(t):
    from ..streaming.streams import windowed

    return windowed(t.events).select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, max(ts)::TIMESTAMP AS last_seen FROM events GROUP BY 1""")
def distinct_totals(t):
    """Totals that a table changed by key holds after every event came twice, in two batches, the second one played again."""
    from ..sources import upsert
    from ..streaming import streams

    path = settle.fresh_path(t.spark, "totals")
    first = t.events.filter("event_id % 2 = 0")
    for number, events in ((0, first), (1, t.events.unionByName(first)), (1, first)):
        upsert.upsert(streams.rule_totals(streams.distinct_events(events, ["event_id"])), path, ["event_type"], buckets=8, batch=("totals", number))
    return upsert.read(t.spark, path).select("event_type", "n", F.round("total", 4).alias("total"), "last_seen")


@query("""WITH l AS (SELECT o_custkey, o_totalprice, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC, o_totalprice DESC) = 1)
SELECT coalesce(c_custkey, o_custkey) AS k, CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE o_totalprice END AS balance FROM customer FULL JOIN l ON c_custkey = o_custkey WHERE o_orderstatus IS DISTINCT FROM 'P'""")
def upsert_by_key(t):
    """Balances after the last order of each customer took their place, or took the customer out."""
    from ..sources import upsert

    path = settle.fresh_path(t.spark, "balances")
    upsert.upsert(t.customer.select(c("c_custkey").alias("k"), c("c_acctbal").alias("balance")), path, ["k"], buckets=32)
    changes = t.orders.select(c("o_custkey").alias("k"), c("o_totalprice").alias("balance"), "o_orderkey", (c("o_orderstatus") == "P").alias("gone"))
    last = keep_first(changes, ["k"], [F.desc("o_orderkey"), F.desc("balance")]).drop("o_orderkey")
    upsert.upsert(last, path, ["k"], deleted="gone")
    return upsert.read(t.spark, path)


@query("""SELECT 0 AS ord, 'orders' AS name, count(*) AS value FROM orders UNION ALL SELECT 1, 'large', count(*) FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT 2, 'customers', count(DISTINCT o_custkey) FROM orders""")
def run_figures(t):
    """Figures of a run, found by the jobs that write its tables."""
    from ..plans import reports

    orders, of_orders = reports.observed(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), orders=F.count("*"), large=F.count_if(c("o_totalprice") > 100000))
    kept = settle.settled(orders)
    customers, of_customers = reports.observed(kept.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")), customers=F.count("*"))
    settle.settled(customers)
    return reports.run_steps(t.spark, [of_orders, of_customers])
