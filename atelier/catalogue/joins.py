"""Queries that join: semi, anti, outer, cascades, lookups, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators.keep import keep_first, lookup_last
from .base import query

c = F.col


@query("""SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT l_partkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS r FROM lineitem JOIN part ON p_partkey = l_partkey AND l_quantity > p_size) WHERE r = 1""")
def sectioned_first_match(t):
    both = t.lineitem.join(t.part.select(c("p_partkey").alias("l_partkey"), "p_size"), "l_partkey").filter("l_quantity > p_size")
    return keep_first(both, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey"]).select("l_partkey", "l_orderkey", "l_linenumber")


@query("""SELECT k AS key, arg_max(c_custkey, c_custkey) AS c_custkey FROM (SELECT c_custkey::VARCHAR AS k, c_custkey FROM customer UNION ALL SELECT c_mktsegment, c_custkey FROM customer UNION ALL SELECT lower(c_name) || '_' || c_nationkey, c_custkey FROM customer) GROUP BY 1""")
def lookup_multikey(t):
    keys = [c("c_custkey").cast("string"), c("c_mktsegment"), F.concat_ws("_", F.lower("c_name"), c("c_nationkey").cast("string"))]
    return lookup_last(t.customer, keys, "c_custkey").select("key", "c_custkey")


@query("""SELECT 'union' AS op, k::INTEGER AS k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'all', k FROM (SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region)""")
def set_ops(t):
    a, b = t.customer.select(c("c_nationkey").alias("k")), t.supplier.select(c("s_nationkey").alias("k"))
    parts = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.subtract(b), "all": t.nation.select(c("n_nationkey").alias("k")).union(t.region.select(c("r_regionkey").alias("k")))}
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("op"), "k")
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT d.doc_id, f.first_id FROM documents d JOIN (SELECT text, min(doc_id) AS first_id FROM documents GROUP BY 1) f ON d.text IS NOT DISTINCT FROM f.text")
def requalify_by_text(t):
    """Each document's first of the same text; the key that travels is a digest."""
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("k"))
    first = rows.groupBy("k").agg(F.min("doc_id").alias("first_id"))
    return rows.join(first.withColumnRenamed("k", "k2"), c("k").eqNullSafe(c("k2"))).select("doc_id", "first_id")