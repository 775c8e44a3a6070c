"""Queries through the composed pipelines: drawings against books, results against the truth, alerts, products, locating, search.

The driver's tables are renamed to what the pipelines read; the SQL states the semantics on the same tables.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import sections, within
from ..operators.keep import spread, spread_pages, unused_pages
from ..plans import books, check, locate, products, questions, search
from .base import query
from .texts import _ladder_sql

c = F.col


def _seg(values: dict[str, str], rest: str, col: str = "c_mktsegment") -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE '{rest}' END"


def _plan_type(name: str) -> str:
    norm = f"upper(trim({name}))"
    for old, new in fixed.NAME_REPLACEMENTS:
        norm = f"replace({norm}, '{old}', '{new}')"
    return _ladder_sql(norm, fixed.LADDER_PLAN, "AUTRE")


_NAME = _seg({"BUILDING": "Classe", "FURNITURE": "BUREAU", "MACHINERY": "LOCAL MÉCANIQUE", "HOUSEHOLD": "W.C."}, "LOCAL X")
_ROOMS = f"(SELECT 'A-' || c_custkey AS id, {_NAME} AS name, CASE WHEN c_custkey % 10 = 3 THEN 'PISCINE' END AS type FROM customer)"


def _rooms(t):
    return t.customer.select(F.concat(F.lit("A-"), "c_custkey").alias("id"), F.expr(_NAME).alias("name"), F.expr("CASE WHEN c_custkey % 10 = 3 THEN 'PISCINE' END").alias("type"))


# a book: a code and a sentence for each nation

_CODE = "CASE n_nationkey % 4 WHEN 0 THEN '09 91 00' WHEN 1 THEN '09 65 19' WHEN 2 THEN '10 28 13' ELSE '99 00 00' END"
_SENTENCE = "CASE n_nationkey % 5 WHEN 0 THEN 'peinture des salles de classe et corridors' WHEN 1 THEN 'la douche du gymnase, toilettes' WHEN 2 THEN 'administration' WHEN 3 THEN 'classement des halls' ELSE n_name END"
_BOOK = f"(SELECT {_CODE} AS code, {_SENTENCE} AS text FROM nation)"


def _book(t):
    return t.nation.select(F.expr(_CODE).alias("code"), F.expr(_SENTENCE).alias("text"))


def _quoted(s: str) -> str:
    return s.replace("'", "''")


_WORDS = ", ".join(f"('{k}', '(?i)\\b(?:{_quoted(p)})\\b')" for k, p in fixed.TYPE_WORDS.items())
_FINISH = ", ".join(f"('{code}', '{k}')" for code, kinds in fixed.FINISH_SECTIONS.items() for k in kinds)
_EXPECTED = ", ".join(f"'{k}'" for k in fixed.EXPECTED_FINISHES)
_COVERAGE = f"""
WITH r AS (SELECT {_plan_type("name")} AS type, count(*) AS n_rooms FROM {_ROOMS} GROUP BY 1), s AS (SELECT * FROM {_BOOK}),
n AS (SELECT w.type, code, true AS named FROM s JOIN (VALUES {_WORDS}) w(type, p) ON regexp_matches(text, p) UNION ALL SELECT f.type, f.code, false FROM (VALUES {_FINISH}) f(code, type) WHERE code IN (SELECT code FROM s)),
v AS (SELECT type, list_sort(list(DISTINCT code)) AS codes, max(named::INT) = 1 AS named FROM n GROUP BY 1),
o AS (SELECT coalesce(r.type, v.type) AS type, coalesce(n_rooms, 0)::BIGINT AS n_rooms, coalesce(codes, []::VARCHAR[]) AS codes, coalesce(named, false) AS named FROM r FULL JOIN v ON r.type = v.type),
e AS (SELECT *, CASE WHEN n_rooms = 0 THEN 'not in drawings' WHEN len(codes) = 0 THEN 'not in specification' ELSE 'covered' END AS status FROM o)
SELECT type, n_rooms, array_to_string(codes, ',') AS codes, status, (CASE WHEN status = 'covered' THEN CASE WHEN named THEN 0.85 ELSE 0.7 END END)::DOUBLE AS confidence,
 n_rooms > 0 AND type IN ({_EXPECTED}) AND type NOT IN ('TECHNIQUE', 'GYMNASE', 'RANGEMENT') AND len(list_filter(codes, lambda k: starts_with(k, '09 65') OR starts_with(k, '09 30'))) = 0 AS floor_missing,
 n_rooms > 0 AND type IN ({_EXPECTED}) AND type NOT IN ('TECHNIQUE', 'WC', 'RANGEMENT', 'GYMNASE') AND len(list_filter(codes, lambda k: starts_with(k, '09 51') OR starts_with(k, '09 53'))) = 0 AS ceiling_missing FROM e"""


def _coverage(t):
    return check.by_type(_rooms(t), _book(t)).withColumn("codes", F.array_join("codes", ","))


@query(_COVERAGE)
def type_coverage(t):
    return _coverage(t)


@query(f"SELECT type, n_rooms FROM ({_COVERAGE}) WHERE status = 'not in specification'")
def uncovered_types(t):
    return _coverage(t).filter("status = 'not in specification'").select("type", "n_rooms")


@query(f"SELECT type, codes FROM ({_COVERAGE}) WHERE status = 'not in drawings'")
def unplanned_types(t):
    return _coverage(t).filter("status = 'not in drawings'").select("type", "codes")


@query(f"""SELECT code, text, w.type, len(regexp_extract_all(text, p))::INTEGER AS n FROM {_BOOK} JOIN (VALUES {_WORDS}) w(type, p) ON regexp_matches(text, p)""")
def spec_type_words(t):
    named = check.named_types(_book(t).withColumn("text0", c("text")).withColumn("code", F.concat_ws("|", "code", "text")))
    return named.select(F.split_part("code", F.lit("|"), F.lit(1)).alias("code"), F.split_part("code", F.lit("|"), F.lit(2)).alias("text"), "type", F.size("snippets").alias("n"))


# mentions by id and name: an order is a part of the book

_TITLE = "CASE WHEN o_orderkey % 40 = 7 THEN 'Voir a-' || o_custkey || 'A' ELSE o_orderpriority END"
_CONTENT = "CASE WHEN o_orderkey % 30 = 0 THEN 'local A-' || o_custkey WHEN o_orderkey % 9 = 1 THEN 'CLASSES et corridors' WHEN o_orderkey % 9 = 2 THEN 'les w.c., sauf un' ELSE 'bureau' || o_orderkey END"
_FIRST_CODES = " ".join(f"WHEN '{k}' THEN '{', '.join([code for code, kinds in fixed.FINISH_SECTIONS.items() if k in kinds][:3])}'" for k in sorted({x for v in fixed.FINISH_SECTIONS.values() for x in v}))


@query(f"""WITH p AS (SELECT o_orderkey AS pord, {_TITLE} AS title, {_CONTENT} AS content, o_orderkey % 9 = 2 AND o_orderkey % 2 = 0 AS sub FROM orders),
r AS (SELECT id, name, coalesce(type, {_plan_type("name")}) AS type FROM {_ROOMS}),
i AS (SELECT id, arg_min(title, pord) AS by_id FROM (SELECT DISTINCT id FROM r) r JOIN p ON contains(upper(content), upper(id)) OR contains(upper(title), upper(id)) GROUP BY 1),
n AS (SELECT name, arg_min(title, pord) AS by_name FROM (SELECT DISTINCT name FROM r) r JOIN p ON NOT sub AND contains(upper(content), upper(name)) GROUP BY 1),
o AS (SELECT r.*, by_id, by_name, CASE type {_FIRST_CODES} END AS cover FROM r LEFT JOIN i USING (id) LEFT JOIN n USING (name)),
w AS (SELECT *, CASE WHEN by_id IS NOT NULL THEN 'direct' WHEN by_name IS NOT NULL THEN 'name' WHEN cover IS NOT NULL THEN 'inferred' WHEN type IN ({_EXPECTED}) THEN 'missing' ELSE 'generic' END AS way FROM o)
SELECT id, type, coalesce(by_id, by_name, CASE WHEN way = 'inferred' THEN cover END) AS section, way, (CASE way WHEN 'direct' THEN 0.9 WHEN 'name' THEN 0.6 WHEN 'inferred' THEN 0.7 WHEN 'generic' THEN 0.4 END)::DOUBLE AS confidence FROM w""")
def best_match_cascade(t):
    parts = t.orders.select(c("o_orderkey").alias("pord"), F.expr(_TITLE).alias("title"), F.expr(_CONTENT).alias("content"), F.expr("o_orderkey % 9 = 2 AND o_orderkey % 2 = 0").alias("sub"))
    return check.by_name(_rooms(t), parts).select("id", "type", "section", "way", "confidence")


_ITEMS = r"""SELECT item_id AS i, text AS item FROM benchmark UNION ALL SELECT 100000 + item_id, regexp_extract(text, '^([^ ]+ [^ ]+)', 1) FROM benchmark UNION ALL SELECT 200000 + item_id, left(text, 3) FROM benchmark UNION ALL SELECT 300000 + item_id, substr(text, 3, 9) FROM benchmark UNION ALL SELECT 400000, 'zqx'"""


@query(f"SELECT DISTINCT doc_id, i AS item_id FROM documents d JOIN ({_ITEMS}) b ON item <> '' AND contains(d.text, item)")
def text_containment_join(t):
    b = t.benchmark
    part = lambda base, x: b.select((F.lit(base) + c("item_id")).alias("item_id"), x.alias("item"))
    items = part(0, c("text")).unionByName(part(100000, F.regexp_extract("text", "^([^ ]+ [^ ]+)", 1))).unionByName(part(200000, F.left("text", F.lit(3)))).unionByName(part(300000, F.substring("text", 3, 9)))
    items = items.unionByName(t.spark.createDataFrame([(400000, "zqx")], "item_id long, item string"))
    return within.held(spread(t.documents.select("doc_id", "text")), items, "doc_id", "item_id")


@query("""WITH p AS (SELECT 'A-' || (100 + p_partkey % 900) AS id, p_size AS w, p_size + 2 AS l FROM part), s AS (SELECT DISTINCT 'A-' || (100 + p_partkey % 900) AS id, p_size + (p_partkey % 3 = 0)::INT AS w, p_size + 2 AS l FROM part)
SELECT p.id, (12 * s.w)::DOUBLE AS spec_width, (12 * s.l + 6)::DOUBLE AS spec_length, (12 * p.w)::DOUBLE AS plan_width, (12 * p.l + 6)::DOUBLE AS plan_length FROM p JOIN s ON p.id = s.id WHERE p.w <> s.w OR p.l <> s.l""")
def attr_mismatch(t):
    id_ = F.concat(F.lit("A-"), (100 + c("p_partkey") % 900).cast("string"))
    plan = t.part.select(id_.alias("id"), F.concat("p_size", F.lit("'-0\"")).alias("width"), F.concat(c("p_size") + 2, F.lit("'-6\"")).alias("length"))
    told = F.concat(F.lit("le local "), F.lower(id_), F.lit(": "), c("p_size") + F.when(c("p_partkey") % 3 == 0, 1).otherwise(0), F.lit("'-0\" x "), c("p_size") + 2, F.lit("'-6\"\nfin"))
    return check.length_mismatches(plan, t.part.select(told.alias("text")).distinct())


# found rooms and true ones

_FOUND = f"(SELECT c_custkey AS ord, 'R' || c_custkey AS id, {_NAME} AS name, chr((65 + c_nationkey % 3)::INT) AS block, (c_custkey % 3)::INT AS floor, CASE WHEN c_custkey % 11 = 0 THEN 'CORRIDOR' END AS type FROM customer WHERE c_custkey % 7 <> 0)"
_TRUE_NAME = _seg({"BUILDING": "CLASSE 2", "FURNITURE": "SECRÉTARIAT", "MACHINERY": "TECHNIQUE", "HOUSEHOLD": "TOILETTE"}, "HALL")
_TRUE_TYPE = _seg({"BUILDING": "CLASSE", "FURNITURE": "BUREAU", "MACHINERY": "TECHNIQUE", "HOUSEHOLD": "WC"}, "CIRCULATION")
_TRUE = f"(SELECT c_custkey AS ord, 'R' || c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN {_NAME} ELSE {_TRUE_NAME} END AS name, chr((65 + c_nationkey % 2)::INT) AS block, (CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 3 END)::INT AS floor, {_TRUE_TYPE} AS type FROM customer WHERE c_custkey % 8 <> 0)"
_NORM = "replace(replace(upper(trim(coalesce({0}::VARCHAR, ''))), '-', ' '), '_', ' ')"
_SAME = "[" + ", ".join("[" + ", ".join(f"'{x}'" for x in (w.upper().replace("-", " ") for w in g)) + "]" for g in fixed.SAME_NAMES) + "]"
_COMPARED = f"""
WITH j AS (SELECT coalesce(f.id, g.id) AS id, f.id AS fid, g.id AS gid, {_NORM.format("f.name")} AS fn, {_NORM.format("g.name")} AS gn, f.block AS fb, g.block AS gb, coalesce(nullif(f.floor, 0)::VARCHAR, '') AS ff, coalesce(nullif(g.floor, 0)::VARCHAR, '') AS gf, f.type AS ft, g.type AS gt FROM {_FOUND} f FULL JOIN {_TRUE} g ON f.id = g.id),
k AS (SELECT *, CASE WHEN gid IS NULL THEN 'extra' WHEN fid IS NULL THEN 'missing' ELSE 'matched' END AS status, (fn = gn OR (fn <> '' AND gn <> '' AND (contains(fn, gn) OR contains(gn, fn))) OR len(list_filter({_SAME}, lambda g: list_contains(g, fn) AND list_contains(g, gn))) > 0) AS name_ok, {_NORM.format("fb")} = {_NORM.format("gb")} AS block_ok, ff = gf AS floor_ok,
 coalesce(ft, {_ladder_sql("fn", fixed.LADDER_TRUTH, "AUTRE")}) = gt AS type_ok FROM j)
SELECT id, status, (CASE WHEN status = 'matched' THEN (1 + name_ok::INT + block_ok::INT + floor_ok::INT + type_ok::INT) / 5.0 END)::DOUBLE AS score, CASE WHEN status = 'matched' THEN name_ok END AS name_ok, CASE WHEN status = 'matched' THEN block_ok END AS block_ok, CASE WHEN status = 'matched' THEN floor_ok END AS floor_ok, CASE WHEN status = 'matched' THEN type_ok END AS type_ok,
 CASE WHEN status <> 'matched' THEN NULL WHEN NOT name_ok THEN 'critical' WHEN NOT (block_ok AND floor_ok AND type_ok) THEN 'minor' END AS severity FROM k"""


def _sides(t):
    letter = lambda n: F.chr(65 + c("c_nationkey") % n)
    cols = lambda name, block, floor, kind: [c("c_custkey").alias("ord"), F.concat(F.lit("R"), "c_custkey").alias("id"), name.alias("name"), block.alias("block"), floor.cast("int").alias("floor"), kind.alias("type")]
    found = t.customer.filter("c_custkey % 7 <> 0").select(*cols(F.expr(_NAME), letter(3), c("c_custkey") % 3, F.when(c("c_custkey") % 11 == 0, "CORRIDOR")))
    true = t.customer.filter("c_custkey % 8 <> 0").select(*cols(F.expr(f"CASE WHEN c_custkey % 5 = 0 THEN {_NAME} ELSE {_TRUE_NAME} END"), letter(2), F.when(c("c_custkey") % 6 != 0, c("c_custkey") % 3), F.expr(_TRUE_TYPE)))
    return found, true


@query(_COMPARED)
def truth_full_outer(t):
    return check.against_truth(*_sides(t))


@query(f"""SELECT matched, found, "true", round(accuracy, 6)::DOUBLE AS accuracy, perfect, round(matched / found, 6)::DOUBLE AS precision, round(matched / "true", 6)::DOUBLE AS recall, round(2 * (matched / found) * (matched / "true") / (matched / found + matched / "true"), 6)::DOUBLE AS f1
FROM (SELECT count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status <> 'missing') AS found, count(*) FILTER (status <> 'extra') AS "true", avg(score) AS accuracy, count(*) FILTER (score = 1) AS perfect FROM ({_COMPARED}))""")
def truth_metrics(t):
    out = check.truth_metrics(check.against_truth(*_sides(t)))
    return out.select("matched", "found", "true", "perfect", *(F.round(k, 6).alias(k) for k in ("accuracy", "precision", "recall", "f1")))


@query(f"""SELECT coalesce(a.type, b.type) AS type, coalesce(n, 0)::BIGINT AS found, coalesce(m, 0)::BIGINT AS expected FROM (SELECT {_ladder_sql("upper(name)", fixed.LADDER_COUNT, "AUTRE")} AS type, count(*) AS n FROM {_FOUND} GROUP BY 1) a FULL JOIN (SELECT type, count(*) AS m FROM {_TRUE} GROUP BY 1) b ON a.type = b.type""")
def distribution_diff(t):
    found, true = _sides(t)
    return check.type_differences(found, true.groupBy("type").agg(F.count("*").alias("expected")))


# alerts: an event is a room

_EVENT_NAME = "CASE event_id % 9 WHEN 0 THEN 'LOCAL' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE event_type END"
_EVENT_NOTE = "CASE event_id % 13 WHEN 0 THEN 'Possible erreur' WHEN 1 THEN 'clair' WHEN 2 THEN 'vu ?' END"
_ALERTS = f"""
WITH r AS (SELECT event_id::VARCHAR AS item, {_EVENT_NAME} AS name, CASE WHEN event_id % 4 > 0 THEN value / 100 END AS v, event_id % 3 AS n, {_EVENT_NOTE} AS note FROM events),
a AS (SELECT 'ERROR' AS severity, 'VERY_LOW_CONFIDENCE' AS type, item FROM r WHERE v < 0.4 UNION ALL SELECT 'WARNING', 'LOW_CONFIDENCE', item FROM r WHERE v >= 0.4 AND v < 0.7 UNION ALL SELECT 'ERROR', 'NO_SOURCE_PAGES', item FROM r WHERE n = 0 UNION ALL SELECT 'WARNING', 'SINGLE_SOURCE', item FROM r WHERE n = 1
 UNION ALL SELECT 'WARNING', 'GENERIC_NAME', item FROM r WHERE coalesce(name, '') IN ('LOCAL', '') UNION ALL SELECT 'WARNING', 'AMBIGUOUS_EXTRACTION', item FROM r WHERE regexp_matches(lower(note), 'ambigu|incertain|possible|\\?')
 UNION ALL SELECT 'INFO', 'EXTRACTION_SUMMARY', 'GLOBAL' UNION ALL SELECT 'WARNING', 'LOW_CONFIDENCE_COVERAGE', 'GLOBAL' FROM (SELECT count(v) AS m, count(*) AS n FROM r) WHERE m < 0.5 * n
 UNION ALL SELECT 'WARNING', 'LOW_PRODUCT_CONFIDENCE', p_brand || '_' || p_type FROM part WHERE p_size < 35 UNION ALL SELECT 'INFO', 'PRODUCT_SUMMARY', 'GLOBAL' WHERE (SELECT count(*) FROM part) > 0)
SELECT severity, type, item FROM a"""


def _event_rooms(t):
    pages = F.slice(F.array(F.lit(1), F.lit(2)), 1, (c("event_id") % 3).cast("int"))
    return t.events.select(c("event_id").cast("string").alias("id"), F.expr(_EVENT_NAME).alias("name"), F.when(c("event_id") % 4 > 0, c("value") / 100).alias("confidence"), pages.alias("source_pages"), F.expr(_EVENT_NOTE).alias("extraction_notes"), F.when(c("event_type") != "error", c("event_type")).alias("extraction_method"))


def _alerts(t):
    made = t.part.select(c("p_brand").alias("manufacturer"), c("p_type").alias("model"), (c("p_size") / 50).alias("confidence"))
    return check.quality_alerts(_event_rooms(t), made)


@query(_ALERTS)
def alerts(t):
    return _alerts(t).select("severity", "type", "item")


@query(f"SELECT d.severity, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('ERROR'), ('WARNING'), ('INFO')) d(severity) LEFT JOIN (SELECT severity, count(*) AS n FROM ({_ALERTS}) GROUP BY 1) x USING (severity)")
def alert_totals(t):
    return check.severity_totals(_alerts(t))


@query("""SELECT count(*) AS total_rooms, count(v) AS with_confidence, count(*) FILTER (v >= 0.4 AND v < 0.7) AS low_confidence, count(*) FILTER (event_id % 3 = 0) AS missing_pages, count(*) FILTER (event_id % 3 = 1) AS single_source, round(avg(v), 2)::DOUBLE AS mean_confidence, count(*) FILTER (event_type = 'error') AS unknown_method
FROM (SELECT *, CASE WHEN event_id % 4 > 0 THEN value / 100 END AS v FROM events)""")
def room_quality(t):
    out = check.room_quality(_event_rooms(t))
    return out.withColumns({"unknown_method": F.coalesce(F.try_element_at("methods", F.lit("unknown")), F.lit(0)), "mean_confidence": F.round("mean_confidence", 2)}).drop("methods")


@query("SELECT md5(text) AS item, 'names: ' || array_to_string(list_sort(list(DISTINCT source)), ', ') AS message FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def contradictory_groups(t):
    return check.contradictions(t.documents.select(F.md5("text").alias("id"), c("source").alias("name"))).select("item", "message")


_TYPED = f"(SELECT id, coalesce(type, {_plan_type('name')}) AS type FROM {_ROOMS})"


def _typed(t):
    return _rooms(t).select("id", F.coalesce("type", text.room_type(c("name"))).alias("type"))


@query(f"""SELECT id, type, wall, floor FROM {_TYPED} LEFT JOIN (VALUES ('CLASSE', 'gypse', 'VCT (09 65 19)'), ('WC', 'céramique (09 30 13)', 'céramique (09 30 13)'), ('CORRIDOR', 'peinture P05', 'VCT (09 65 19)'), ('GYMNASE', 'peinture P01/P05', 'spécifique sport'), ('TECHNIQUE', 'peinture P05', 'béton peint P06'), ('BUREAU', 'gypse', 'VCT (09 65 19)'),
('SERVICE', 'céramique ou peinture', 'céramique ou VCT'), ('RANGEMENT', 'peinture P05', 'béton ou VCT'), ('CIRCULATION', 'peinture P05', 'VCT (09 65 19)'), ('SALLE', 'gypse', 'VCT (09 65 19)')) v(type, wall, floor) USING (type)""")
def dim_lookup(t):
    known = check.expected_finishes(t.spark).select("type", c("wall")[0].alias("wall"), c("floor")[0].alias("floor"))
    return _typed(t).join(known, "type", "left").select("id", "type", "wall", "floor")


@query(f"""SELECT type, count(DISTINCT id) AS n_rooms, array_to_string(list_sort(list(DISTINCT system)), ',') AS systems FROM {_TYPED} JOIN (VALUES ('P01', 'TECHNIQUE'), ('P01', 'SERVICE'), ('P02', 'CLASSE'), ('P02', 'BUREAU'), ('P02', 'SALLE'), ('P02', 'AUTRE'), ('P05', 'TECHNIQUE'), ('P05', 'CORRIDOR'), ('P05', 'CIRCULATION'), ('P05', 'RANGEMENT'), ('P06', 'TECHNIQUE'), ('P08', 'WC')) v(system, type) USING (type) GROUP BY 1""")
def finish_coverage(t):
    each = check.paint_systems(t.spark).select("system", F.explode("types").alias("type")).groupBy("type").agg(F.array_join(F.array_sort(F.collect_list("system")), ",").alias("systems"))
    return _typed(t).groupBy("type").agg(F.count_distinct("id").alias("n_rooms")).join(each, "type").select("type", "n_rooms", "systems")


_REPLY = "CASE o_orderkey % 5 WHEN 0 THEN 'ID: a-' || o_custkey || ', NOM: salle verte' WHEN 1 THEN 'Local ' || o_custkey || 'b est un corridor nord, ou bien' WHEN 2 THEN 'vu B-1' || (10 + o_custkey % 90) || ': la cuisine' WHEN 3 THEN 'NOM = Bureau' ELSE 'rien' END"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'A-' || o_custkey WHEN 1 THEN o_custkey || 'B' WHEN 2 THEN 'B-1' || (10 + o_custkey % 90) END AS id, CASE o_orderkey % 5 WHEN 0 THEN 'SALLE VERTE' WHEN 1 THEN 'CORRIDOR NORD' WHEN 2 THEN 'CUISINE' WHEN 3 THEN 'BUREAU' END AS name FROM orders""")
def room_reply(t):
    said = text.room_reply(F.expr(_REPLY))
    return t.orders.select("o_orderkey", said["id"].alias("id"), said["name"].alias("name"))


# locating: a line of an order is a recognised word, a part a room

_WORD = "SELECT l_linenumber AS page, l_orderkey * 1000000 + l_partkey AS ord, lpad((l_partkey % 1000)::VARCHAR, 3, '0') AS k, 2 * l_quantity AS conf, 10.0 * (l_partkey % 400) AS x, 20.0 * l_linenumber AS y FROM lineitem WHERE l_quantity >= 15"
_ROOM = "SELECT DISTINCT 'A-' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS id, lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS k, p_size % 7 + 1 AS page FROM part"
_BOXES = f"""
WITH w AS ({_WORD}), r AS ({_ROOM}), b AS (SELECT r.id, r.page, max(conf) AS conf, arg_max(w.x, {{'conf': conf, 'first': -ord}}) AS x, arg_max(w.y, {{'conf': conf, 'first': -ord}}) AS y FROM r JOIN w ON w.k = r.k AND w.page = r.page GROUP BY ALL)
SELECT r.id, r.page, CASE WHEN b.id IS NULL THEN 100.0 ELSE greatest(0.0, x + 10 - 80) END::DOUBLE AS x0, CASE WHEN b.id IS NULL THEN 700.0 ELSE least(800.0, y + 5 + 40) END::DOUBLE AS y1, coalesce(conf / 100, 0.0)::DOUBLE AS confidence, b.id IS NULL AS fallback FROM r LEFT JOIN b ON b.id = r.id AND b.page = r.page"""


def _located(t):
    key = lambda k: F.lpad((c(k) % 1000).cast("string"), 3, "0")
    x, y = 10.0 * (c("l_partkey") % 400), 20.0 * c("l_linenumber")
    words = t.lineitem.select(c("l_linenumber").alias("page"), (c("l_orderkey") * 1000000 + c("l_partkey")).alias("ord"), F.concat(F.when(c("l_orderkey") % 2 == 0, "A-").otherwise(""), key("l_partkey"), F.when(c("l_orderkey") % 3 == 0, "B").otherwise("")).alias("text"), (2 * c("l_quantity")).alias("conf"), x.alias("x0"), y.alias("y0"), (x + 20).alias("x1"), (y + 10).alias("y1"))
    rooms = t.part.select(F.concat(F.lit("A-"), key("p_partkey")).alias("id"), (c("p_size") % 7 + 1).alias("page")).distinct()
    return rooms, locate.from_words(words, rooms, 5000.0, 800.0)


@query(_BOXES)
def suffix_join_argmax(t):
    return _located(t)[1].select("id", "page", "box.x0", "box.y1", "confidence", "fallback")


@query(f"SELECT id, page, round(x0, 3) AS x0 FROM ({_BOXES}) WHERE NOT fallback UNION ALL SELECT id, page, NULL FROM ({_BOXES}) WHERE fallback")
def left_update_fallback(t):
    rooms, boxes = _located(t)
    keyed = lambda df: df.withColumn("id", F.concat_ws("/", "id", "page"))
    out = locate.updated(keyed(rooms), keyed(boxes.filter("not fallback")))
    return out.select(F.split_part("id", F.lit("/"), F.lit(1)).alias("id"), "page", F.round("box.x0", 3).alias("x0"))


# photos: a turn of a conversation is a photo, a supplier a room

_NOTE = "CASE turn % 4 WHEN 0 THEN 'vu au local ' || lpad((conv_id % 60)::VARCHAR, 3, '0') WHEN 1 THEN 'mur A-' || lpad((conv_id % 60)::VARCHAR, 3, '0') || ' fini' ELSE 'rien' END"
_SEEN = "CASE WHEN turn % 4 = 2 THEN 'porte ' || lpad((conv_id % 30)::VARCHAR, 3, '0') END"


@query(f"""WITH p AS (SELECT DISTINCT conv_id || '/' || turn AS photo_id, conv_id, turn, {_NOTE} AS notes, {_SEEN} AS seen, CASE WHEN conv_id % 3 = 0 THEN (conv_id * 17) % 200 END AS metres FROM conversations),
r AS (SELECT lpad((s_suppkey % 1000)::VARCHAR, 3, '0') AS k, 'A-' || min(lpad((s_suppkey % 1000)::VARCHAR, 3, '0')) AS room_id FROM supplier GROUP BY 1),
j AS (SELECT photo_id, n.room_id AS n, s.room_id AS s, CASE WHEN conv_id % 5 = 0 THEN 'A-LINK' END AS l, metres FROM p LEFT JOIN r n ON n.k = nullif(regexp_extract(notes, '(\\d{{3}})', 1), '') LEFT JOIN r s ON s.k = nullif(regexp_extract(coalesce(seen, ''), '(\\d{{3}})', 1), ''))
SELECT photo_id, coalesce(n, s, l) AS room_id, CASE WHEN n IS NOT NULL THEN 'notes' WHEN s IS NOT NULL THEN 'seen' WHEN l IS NOT NULL THEN 'manual' WHEN metres <= 100 THEN 'site' ELSE 'none' END AS method,
(CASE WHEN n IS NOT NULL THEN 0.95 WHEN s IS NOT NULL THEN 0.8 WHEN l IS NOT NULL THEN 1.0 WHEN metres <= 100 THEN 0.3 ELSE 0.0 END)::DOUBLE AS confidence FROM j""")
def photo_cascade(t):
    turns = t.conversations.select("conv_id", "turn").distinct()
    photo = F.concat_ws("/", "conv_id", "turn")
    note = F.expr(_NOTE.replace("(conv_id % 60)::VARCHAR", "cast(conv_id % 60 as string)"))
    seen = F.expr(_SEEN.replace("(conv_id % 30)::VARCHAR", "cast(conv_id % 30 as string)"))
    rows = turns.select(photo.alias("photo_id"), note.alias("notes"), seen.alias("seen"), F.when(c("conv_id") % 3 == 0, (c("conv_id") * 17) % 200).cast("double").alias("metres"))
    rooms = t.supplier.select(F.concat(F.lit("A-"), F.lpad((c("s_suppkey") % 1000).cast("string"), 3, "0")).alias("id")).distinct()
    links = turns.filter("conv_id % 5 = 0").select(photo.alias("photo_id"), F.lit("A-LINK").alias("room_id"))
    return books.photos(rows, rooms, links)


# books: pages, codes, rooms, products

_PAGE = "'--- Page ' || l_linenumber || ' ---' || chr(10) || CASE WHEN l_quantity > 25 THEN 'TITRE ' || l_linenumber || chr(10) || 'Section 09  ' || lpad((l_partkey % 100)::VARCHAR, 2, '0') || ' ' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') || chr(10) || 'corps' ELSE 'suite' END || CASE WHEN l_quantity > 40 THEN chr(10) || 'Section 10 ' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') || ' 13 fin' ELSE '' END"
_LINES = "(SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1)"


@query(f"""WITH l AS (SELECT l_orderkey, l_linenumber AS page, l_quantity AS q, '09 ' || lpad((l_partkey % 100)::VARCHAR, 2, '0') || ' ' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') AS one, '10 ' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') || ' 13' AS two FROM {_LINES}),
h AS (SELECT l_orderkey, page, 1 AS n, one AS code FROM l WHERE q > 25 UNION ALL SELECT l_orderkey, page, 2, two FROM l WHERE q > 40 UNION ALL SELECT l_orderkey, page, 0, NULL FROM l),
f AS (SELECT *, last_value(code IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY page, n ROWS UNBOUNDED PRECEDING) AS section FROM h)
SELECT l_orderkey AS o_orderkey, section AS code, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages, max(CASE WHEN n = 1 THEN 1 ELSE 0 END)::INTEGER AS titled FROM f WHERE section IS NOT NULL GROUP BY ALL""")
def spec_sections(t):
    from ..operators.keep import keep_first

    first = keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"], ["l_orderkey"])
    code = F.concat(F.lit("TITRE "), "l_linenumber", F.lit("\nSection 09  "), F.lpad((c("l_partkey") % 100).cast("string"), 2, "0"), F.lit(" "), F.lpad((c("l_suppkey") % 100).cast("string"), 2, "0"), F.lit("\ncorps"))
    more = F.concat(F.lit("\nSection 10 "), F.lpad((c("l_suppkey") % 100).cast("string"), 2, "0"), F.lit(" 13 fin"))
    page = F.concat(F.lit("--- Page "), "l_linenumber", F.lit(" ---\n"), F.when(c("l_quantity") > 25, code).otherwise("suite"), F.when(c("l_quantity") > 40, more).otherwise(""))
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", page.alias("p"))))
    bound = first.groupBy("l_orderkey").agg(F.array_join(F.transform(parts, lambda x: x["p"]), "\n").alias("text"))
    found = sections.spec_sections(sections.pages_of(bound, ["l_orderkey"]), ["l_orderkey"])
    return found.select(c("l_orderkey").alias("o_orderkey"), "code", F.array_join(c("pages").cast("array<string>"), ",").alias("pages"), F.startswith("title", F.lit("TITRE")).cast("int").alias("titled"))


_CODED = "CASE o_orderkey % 5 WHEN 0 THEN 'tel 5145551' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') WHEN 1 THEN 'voir 09-' || lpad((o_custkey % 100)::VARCHAR, 2, '0') || '-13, fin' WHEN 2 THEN 'SECTION 10  28 ' || lpad((o_custkey % 100)::VARCHAR, 2, '0') WHEN 3 THEN 'x09 91 00' ELSE '1 09 91 002' END"
_CODE_RE = r"\b(\d{2})[\s\-]+(\d{2})[\s\-]+(\d{2})\b"


@query(f"""WITH t AS (SELECT 'o' || o_orderkey AS k, {_CODED} AS t FROM orders UNION ALL SELECT 'd' || doc_id, coalesce(text, '') FROM documents)
SELECT k, CASE WHEN regexp_matches(t, '{_CODE_RE}') THEN regexp_extract(t, '{_CODE_RE}', 1) || ' ' || regexp_extract(t, '{_CODE_RE}', 2) || ' ' || regexp_extract(t, '{_CODE_RE}', 3) END AS code, array_to_string(regexp_extract_all(t, '[0-9]{{3,}}'), ',') AS numbers FROM t""")
def doc_refs(t):
    pad = lambda n: F.lpad((c("o_custkey") % 10**n).cast("string"), n, "0")
    k = c("o_orderkey") % 5
    made = F.when(k == 0, F.concat(F.lit("tel 5145551"), pad(3))).when(k == 1, F.concat(F.lit("voir 09-"), pad(2), F.lit("-13, fin"))).when(k == 2, F.concat(F.lit("SECTION 10  28 "), pad(2))).when(k == 3, "x09 91 00").otherwise("1 09 91 002")
    rows = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("k"), made.alias("t")).unionByName(t.documents.select(F.concat(F.lit("d"), "doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("t")))
    return rows.select("k", text.csi_code(c("t")).alias("code"), F.array_join(F.regexp_extract_all("t", F.lit("[0-9]{3,}"), F.lit(0)), ",").alias("numbers"))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber AS ord, CASE WHEN l_quantity > 30 THEN 'TITRES ' || l_linenumber WHEN l_quantity > 12 THEN 'section 09 9' || (l_partkey % 3) || ' 00 suit' ELSE 'no' END AS t FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1)),
w AS (SELECT *, lag(t, 3) OVER v AS c3, lag(t, 2) OVER v AS c2, lag(t, 1) OVER v AS c1, lead(t, 1) OVER v AS d1, lead(t, 2) OVER v AS d2 FROM b WINDOW v AS (PARTITION BY l_orderkey ORDER BY ord)),
x AS (SELECT l_orderkey, ord, substr(t, 9, 8) AS code, list_filter([c3, c2, c1, t, d1, d2], lambda z: z IS NOT NULL AND (z = t OR length(z) > 3)) AS about FROM w WHERE starts_with(t, 'section')),
y AS (SELECT *, coalesce(list_filter(about[1:len(about) - 1], lambda z: upper(z) = z AND lower(z) <> z AND length(z) > 5 AND NOT starts_with(z, 'SECTION'))[1], '') AS title FROM x)
SELECT l_orderkey, code, title, array_to_string(about, ' | ') AS context, '09' AS division FROM y QUALIFY row_number() OVER (PARTITION BY l_orderkey, code ORDER BY title = '', ord) = 1""")
def code_references(t):
    from ..operators.keep import keep_first

    first = keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"], ["l_orderkey"])
    made = F.when(c("l_quantity") > 30, F.concat(F.lit("TITRES "), "l_linenumber")).when(c("l_quantity") > 12, F.concat(F.lit("section 09 9"), (c("l_partkey") % 3).cast("string"), F.lit(" 00 suit"))).otherwise("no")
    blocks = first.select("l_orderkey", F.lit(1).alias("page"), c("l_linenumber").alias("ord"), made.alias("text"), F.lit(0.0).alias("x0"), c("l_linenumber").cast("double").alias("y0"), F.lit(10.0).alias("size"), F.lit(False).alias("bold"))
    return books.code_references(blocks, ["l_orderkey"]).select("l_orderkey", "code", "title", "context", "division")


@query(r"""WITH r AS (SELECT o_orderkey, o_orderstatus || '-' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') AS ref, CASE o_orderkey % 5 WHEN 0 THEN 'norme' WHEN 1 THEN 'see isolation' WHEN 2 THEN 'ISO 9' ELSE 'see' END AS before FROM orders)
SELECT ref AS room_ref, arg_min(before || ' ' || ref || ' for finishes', o_orderkey) AS context FROM r WHERE before NOT IN ('norme', 'ISO 9') GROUP BY 1""")
def room_refs(t):
    ref = F.concat("o_orderstatus", F.lit("-"), F.lpad((c("o_custkey") % 1000).cast("string"), 3, "0"))
    k = c("o_orderkey") % 5
    made = F.concat(F.when(k == 0, "norme").when(k == 1, "see isolation").when(k == 2, "ISO 9").otherwise("see"), F.lit(" "), ref, F.lit(" for finishes"))
    blocks = t.orders.select(F.lit(1).alias("book"), F.lit(1).alias("page"), c("o_orderkey").alias("ord"), made.alias("text"))
    return books.room_references(blocks, ["book"]).select("room_ref", "context")


@query(r"""SELECT page_id, array_to_string(list_filter(string_split(html, chr(10)), lambda x: NOT regexp_full_match(x, '(?i)\s*\d+\s*|\s*Page \d+( of \d+)?\s*|<html>.*|\s*<nav>.*')), chr(10)) AS body FROM pages""")
def clean_lines(t):
    return t.pages.select("page_id", books.clean_page(c("html"), ["<html>.*", r"\s*<nav>.*"]).alias("body"))


_KIND = "CASE WHEN p_size % 3 = 0 THEN 'door' WHEN p_size % 3 = 1 THEN 'steel' END"
_DIM = "CASE WHEN p_size % 2 = 0 THEN p_size || ' x ' || (p_size + 1) || ' mm' END"


@query(f"""WITH m AS (SELECT *, 'Maker' || chr(65 + (p_size % 26)::INT) AS one, 'Mark' || chr(97 + (p_size % 7)::INT) AS two, 'List' || chr(97 + (p_size % 5)::INT) AS three FROM part)
SELECT p_partkey, one AS maker, 'Model ' || p_partkey AS model, {_KIND} AS kind, {_DIM} AS dimension FROM m WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey, two, 'XK' || p_partkey, {_KIND}, {_DIM} FROM m WHERE p_partkey % 4 = 1
UNION ALL SELECT p_partkey, three, NULL, NULL, NULL FROM m WHERE p_partkey % 4 = 2 UNION ALL SELECT p_partkey, 'USG Co', NULL, NULL, NULL FROM m WHERE p_partkey % 4 = 2""")
def products_from_text(t):
    size, k = c("p_size"), c("p_partkey") % 4
    stated = F.concat(F.when(size % 3 == 0, "one door").when(size % 3 == 1, "in steel").otherwise("plain"), F.lit(", "), F.when(size % 2 == 0, F.concat(size.cast("string"), F.lit(" x "), (size + 1).cast("string"), F.lit(" mm"))).otherwise("no sides"))
    letter = lambda base, n: F.chr((F.lit(base) + size % n).cast("int"))
    bar = F.concat(F.lit("Maker"), letter(65, 26), F.lit(" | Model "), "p_partkey", F.lit("; "), stated)
    told = F.concat(F.lit("Fabricant: Mark"), letter(97, 7), F.lit(". Modèle: XK"), "p_partkey", F.lit(", "), stated)
    listed = F.concat(F.lit("- List"), letter(97, 5), F.lit(" (ou approuvé)\n- USG  Co\n- USG Co\n- Voir note\n"))
    blocks = spread(t.part.select("p_partkey", "p_size")).select("p_partkey", F.lit(0).alias("ord"), F.lit(1).alias("page"), F.when(k == 0, bar).when(k == 1, told).when(k == 2, listed).otherwise("Selon le cas | Voir ici").alias("text"))
    found = products.products(blocks, ["p_partkey"])
    return found.select("p_partkey", F.regexp_replace("maker", " +", " ").alias("maker"), "model", "kind", F.try_element_at("specs", F.lit("dimension")).alias("dimension")).distinct()


@query("""SELECT s_suppkey AS k, 'Sico Inc' AS maker, 'Latex ' || s_suppkey AS model, 'pipe' AS form, 1.0::DOUBLE AS confidence FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT s_suppkey, 'Benjamin Moore', 'Aura B' || s_suppkey, 'de/of', 0.9 FROM supplier WHERE s_suppkey % 4 = 1
UNION ALL SELECT s_suppkey, 'Acme Works', 'Z' || (100 + s_suppkey), 'labeled', 0.9 - CASE WHEN length('Z' || (100 + s_suppkey)) < 5 THEN 0.1 ELSE 0 END FROM supplier WHERE s_suppkey % 4 = 2
UNION ALL SELECT s_suppkey, 'Tarkett', 'Sol IQ', 'known_mfr', 0.85 FROM supplier WHERE s_suppkey % 4 = 3""")
def older_products(t):
    k, n = c("s_suppkey") % 4, c("s_suppkey").cast("string")
    made = F.when(k == 0, F.concat(F.lit("Sico Inc | Latex "), n)).when(k == 1, F.concat(F.lit("Aura B"), n, F.lit(" de Benjamin Moore, ou autre"))).when(k == 2, F.concat(F.lit("Fabricant: Acme Works, au choix; Modèle: Z"), (c("s_suppkey") + 100).cast("string"), F.lit(", noir"))).otherwise("pose de tarkett: Sol IQ, colle")
    return products.older_products(t.supplier.select(c("s_suppkey").alias("k"), made.alias("text")), ["k"])


_TRUE_PRODUCT = "SELECT p_partkey AS ord, '09 ' || lpad((p_size % 40)::VARCHAR, 2, '0') || ' 00' AS section, p_brand AS category, p_name AS product, p_type AS type FROM part WHERE p_partkey % 5 = 0"
_FOUND_PRODUCT = "SELECT p_partkey AS ord, '09 ' || lpad((p_size % 40)::VARCHAR, 2, '0') || ' 00' AS section, lower(p_brand) AS category, p_name || ' plus' AS product, 'x' AS type FROM part WHERE p_partkey % 3 <> 0"


@query(f"""WITH g AS ({_TRUE_PRODUCT}), f AS ({_FOUND_PRODUCT}), m AS (SELECT g.ord, f.ord AS found_ord, (1 + (contains(upper(f.category), upper(g.category)) OR contains(upper(g.category), upper(f.category)))::INT + (contains(upper(f.product), upper(g.product)) OR contains(upper(g.product), upper(f.product)))::INT + (contains(upper(f.type), upper(g.type)) OR contains(upper(g.type), upper(f.type)))::INT) / 4 AS score FROM g JOIN f USING (section)),
b AS (SELECT * FROM m WHERE score > 0.5 QUALIFY row_number() OVER (PARTITION BY ord ORDER BY found_ord) = 1)
SELECT g.ord, g.section, found_ord, score::DOUBLE AS score, CASE WHEN score IS NULL THEN 'missing' ELSE 'matched' END AS status FROM g LEFT JOIN b USING (ord)""")
def product_matches(t):
    section = F.concat(F.lit("09 "), F.lpad((c("p_size") % 40).cast("string"), 2, "0"), F.lit(" 00"))
    true = t.part.filter("p_partkey % 5 = 0").select(c("p_partkey").alias("ord"), section.alias("section"), c("p_brand").alias("category"), c("p_name").alias("product"), c("p_type").alias("type"))
    found = t.part.filter("p_partkey % 3 <> 0").select(c("p_partkey").alias("ord"), section.alias("section"), F.lower("p_brand").alias("category"), F.concat("p_name", F.lit(" plus")).alias("product"), F.lit("x").alias("type"))
    return products.against_truth(found, true)


# questions: a customer is a verified room

_GOLD_TYPE = _seg({"BUILDING": "CLASSE", "FURNITURE": "BUREAU", "HOUSEHOLD": "WC"}, "CORRIDOR")
_GOLD = f"(SELECT c_custkey AS ord, chr((65 + c_nationkey % 3)::INT) || '-' || (100 + c_custkey) AS id, (100 + c_custkey)::VARCHAR AS plan_id, {_NAME} AS name, chr((65 + c_nationkey % 3)::INT) AS block, (c_custkey % 2 + 1)::INT AS floor, {_GOLD_TYPE} AS type, CASE WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence FROM customer WHERE c_acctbal > 0)"


def _entries(t):
    block, n = F.chr(65 + c("c_nationkey") % 3), (100 + c("c_custkey")).cast("string")
    rooms = t.customer.select(c("c_custkey").alias("ord"), F.concat(block, F.lit("-"), n).alias("id"), n.alias("plan_id"), F.expr(_NAME).alias("name"), block.alias("block"), (c("c_custkey") % 2 + 1).cast("int").alias("floor"), F.expr(_GOLD_TYPE).alias("type"), F.when(c("c_acctbal") > 0, "p.A-150").alias("source"), F.when(c("c_acctbal") > 5000, "HIGH").otherwise("MEDIUM").alias("confidence"), F.lit(None).cast("string").alias("notes"), F.lit(None).cast("string").alias("area_pica"))
    return search.verified_index(rooms)


@query(f"SELECT block, floor, id FROM {_GOLD} WHERE type = 'CLASSE' AND block = 'A'")
def count_by_type_in_block(t):
    return search.ask(_entries(t), "Combien de classes dans le bloc A?").select("block", "floor", "id")


@query(f"SELECT block, floor, id FROM {_GOLD} WHERE type = 'BUREAU'")
def list_by_type_ordered(t):
    return search.ask(_entries(t), "Liste des bureaux").select("block", "floor", "id")


@query(f"SELECT confidence, block, floor, type AS room_type, count(*) AS n FROM {_GOLD} GROUP BY GROUPING SETS ((confidence), (block, floor), (type))")
def multi_slice_counts(t):
    return search.verified_counts(_entries(t)).select("confidence", "block", "floor", "room_type", "n")


@query(f"SELECT id FROM {_GOLD} WHERE block = 'B' AND floor = 2 AND confidence = 'HIGH' AND name = 'W.C.' ORDER BY ord LIMIT 50")
def narrowed_search(t):
    return search.ask(_entries(t), "wc", limit=50, block="B", floor=2, high_only=True).select("id")


@query(f"""SELECT q, CASE WHEN q = 'made_up' THEN 'made_up' WHEN q = 'none' THEN 'not_found' WHEN n > 0 THEN 'found' ELSE 'not_found' END AS status, CASE WHEN q IN ('made_up', 'none') THEN 0 ELSE n END AS n FROM (VALUES ('made_up', 'x', 'x'), ('none', 'x', 'x'), ('count', 'CLASSE', 'A'), ('list', 'WC', NULL)) v(q, k, b), LATERAL (SELECT count(*) AS n FROM {_GOLD} g WHERE g.type = k AND (b IS NULL OR g.block = b))""")
def guarded_lookup(t):
    entries = _entries(t)
    # an id in two parts, which no customer's room has, however many customers there are: the SQL knows it as made up
    made_up = search.invented(t.spark.createDataFrame([("C-999-9",)], "id string"), entries)
    asked = {"made_up": "C'est quoi le local C-999-9?", "none": "zzz qqq", "count": "Combien de classes dans le bloc A?", "list": "tous les toilettes"}
    out = None
    for q, question in asked.items():
        row = search.answer(entries, question, made_up).select(F.lit(q).alias("q"), "status", "n")
        out = row if out is None else out.unionByName(row)
    return out


# a table of questions, asked together: every customer asks, in one of eight forms

_FORMS = [("C'est quoi le local ", ""), ("Où est la classe ", "?"), ("corridor numéro ", ""), ("bureau directeur ", ""), ("Combien de classes dans le bloc A?", ""), ("toilette près de ", " (wc)"), ("zzz qqq", ""), ("Liste des bureaux", "")]
_TOLD = "CASE c_custkey % 8 WHEN 0 THEN chr((65 + c_nationkey % 3)::INT) || '-' || (100 + c_custkey)::VARCHAR WHEN 1 THEN (100 + c_custkey * 7 % 900)::VARCHAR WHEN 2 THEN (100 + c_custkey * 3)::VARCHAR WHEN 3 THEN 'B-1' || (10 + c_custkey % 80)::VARCHAR WHEN 5 THEN (1000 + c_custkey * 11)::VARCHAR ELSE '' END"
_FORM = "CASE c_custkey % 8 " + " ".join(f"WHEN {k} THEN '{_quoted(head)}' || told || '{tail}'" for k, (head, tail) in enumerate(_FORMS)) + " END"
_FORM_TERMS = "CASE c_custkey % 8 " + " ".join(f"WHEN {k} THEN [" + ", ".join(f"'{_quoted(w)}'" for w in text.gold_terms(head + tail)) + "]" for k, (head, tail) in enumerate(_FORMS)) + " END"
_QUESTIONS = rf"""SELECT *, CASE WHEN question LIKE 'Combien%' THEN 'CLASSE' WHEN question LIKE 'Liste%' THEN 'BUREAU' END AS listed, list_distinct(list_concat({_FORM_TERMS}, CASE WHEN told = '' THEN [] ELSE [lower(told)] END)) AS terms,
 lower(coalesce(nullif(regexp_extract(upper(question), '[ABC]-\d{{3}}(-\d+)?(-[A-Z])?'), ''), nullif(regexp_extract(upper(question), '\b\d{{3}}(-\d+)?(-[A-Z])?\b'), ''), nullif(regexp_extract(upper(question), '[ABC]-\d{{2,3}}\b'), ''))) AS room FROM (SELECT *, {_FORM} AS question FROM (SELECT c_custkey AS qid, c_custkey, {_TOLD} AS told FROM customer))"""
_SEARCHED = "lower(concat_ws(' ', name, plan_id, id, type, block" + "".join(f", CASE WHEN {' OR '.join([f'contains(upper(name), {chr(39)}{_quoted(x)}{chr(39)})' for x in names] + [f'type = {chr(39)}{k}{chr(39)}' for k in kinds])} THEN '{' '.join(map(_quoted, words))}' END" for names, kinds, words in fixed.SEARCH_WORDS) + "".join(f", CASE WHEN floor = {k} THEN '{' '.join(words)}' END" for k, words in fixed.FLOOR_WORDS.items()) + "))"


def _questions(t):
    told = F.expr(re.sub(r"(\([^()]*\))::VARCHAR", r"cast(\1 as string)", _TOLD).replace("(65 + c_nationkey % 3)::INT", "65 + c_nationkey % 3"))
    form = F.array(*(F.struct(F.lit(head).alias("head"), F.lit(tail).alias("tail")) for head, tail in _FORMS))[(c("c_custkey") % 8).cast("int")]
    return t.customer.select(c("c_custkey").alias("qid"), F.concat(form["head"], told, form["tail"]).alias("question"))


@query(f"""WITH q AS MATERIALIZED ({_QUESTIONS}), e AS MATERIALIZED (SELECT *, lower(name) AS n, lower(plan_id) AS p, lower(id) AS i, {_SEARCHED} AS s FROM {_GOLD}),
l AS (SELECT qid, ord, 1 AS score, row_number() OVER (PARTITION BY qid ORDER BY block, floor, plan_id, ord) AS rank FROM q JOIN e ON type = listed AND (listed = 'BUREAU' OR block = 'A')),
f AS (SELECT qid, ord, list_sum(list_transform(terms, lambda x: contains(s, x)::INT + CASE WHEN x = n THEN 3 WHEN contains(n, x) THEN 2 ELSE 0 END + CASE WHEN x = p THEN 5 WHEN contains(p, x) THEN 2 ELSE 0 END)) + CASE WHEN room IN (i, p) THEN 10 ELSE 0 END + CASE WHEN regexp_replace(room, '^[a-z]-', '') = p THEN 10 ELSE 0 END AS score FROM q JOIN e ON listed IS NULL),
b AS (SELECT qid, ord, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, ord) AS rank FROM f WHERE score > 0)
SELECT qid, ord, score::INTEGER AS score, rank::INTEGER AS rank FROM (SELECT * FROM l UNION ALL SELECT * FROM b WHERE rank <= 10)""")
def ask_many(t):
    return questions.ask_many(_entries(t), _questions(t)).select("qid", "ord", "score", "rank")


_ASKED_WORDS = "SELECT item_id AS qid, regexp_extract(text, '^([^ ]+ [^ ]+ [^ ]+)', 1) || ' room' AS question FROM benchmark WHERE text IS NOT NULL"


@query(rf"""WITH q AS (SELECT qid, list_distinct(list_concat(regexp_split_to_array(regexp_replace(lower(question), '^\s+|\s+$', '', 'g'), '\s+'), {[t for t in text.terms("room")]})) AS terms FROM ({_ASKED_WORDS})),
d AS MATERIALIZED (SELECT doc_id, lower(source) AS n, lower(lang) AS k, regexp_replace(regexp_replace(lower(coalesce(text, '')), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') AS s FROM documents),
f AS (SELECT qid, doc_id, list_sum(list_transform(terms, lambda x: contains(s, x)::INT + CASE WHEN x IN (n, k) THEN 3 WHEN contains(n, x) OR contains(k, x) THEN 2 ELSE 0 END)) AS score FROM q, d)
SELECT qid, doc_id, score::INTEGER AS score, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0) WHERE rank <= 20""")
def search_many(t):
    entries = spread(t.documents.select("doc_id", "source", "lang", "text")).select("doc_id", c("source").alias("name"), c("lang").alias("number"), text.search_text(F.coalesce("text", F.lit(""))).alias("search_text"))
    asked = t.benchmark.filter("text is not null").select(c("item_id").alias("qid"), F.concat(F.regexp_extract("text", "^([^ ]+ [^ ]+ [^ ]+)", 1), F.lit(" room")).alias("question"))
    return questions.search_many(entries, asked, tie=("doc_id",)).select("qid", "doc_id", "score", "rank")


# keys that are asked for in other words: a customer asks for a part

_ASKED_KEY = "CASE c_custkey % 4 WHEN 0 THEN 'p-' || (c_custkey * 3)::VARCHAR WHEN 1 THEN 'Local P-' || (c_custkey % 700)::VARCHAR || 'x' WHEN 2 THEN (c_custkey)::VARCHAR WHEN 3 THEN 'q' || (c_custkey)::VARCHAR END"


@query(f"""WITH a AS (SELECT DISTINCT {_ASKED_KEY} AS asked FROM customer), k AS (SELECT 'P-' || p_partkey AS key, p_size FROM part)
SELECT asked, key, way, p_size FROM (SELECT asked, key, p_size, (upper(key) <> upper(asked))::INTEGER AS way FROM a JOIN k ON contains(upper(key), upper(asked)) OR contains(upper(asked), upper(key))) QUALIFY row_number() OVER (PARTITION BY asked ORDER BY way, key) = 1""")
def fuzzy_keys(t):
    asked = t.customer.select(F.expr(re.sub(r"(\([^()]*\))::VARCHAR", r"cast(\1 as string)", _ASKED_KEY)).alias("asked"))
    return books.fuzzy_keys(asked, t.part.select(F.concat(F.lit("P-"), "p_partkey").alias("key"), "p_size"), "key").select("asked", "key", "way", "p_size")


# pages chosen for analysis


_SPREAD = ", ".join(map(str, spread_pages(25, 5)))


@query(f"SELECT n_nationkey AS number, 'used' AS way FROM nation WHERE n_nationkey IN ({', '.join(str(int(i * 24 / 4)) for i in range(5))}) UNION ALL SELECT * FROM (SELECT n_nationkey, 'next' FROM nation WHERE n_nationkey NOT IN ({', '.join(str(int(i * 24 / 4)) for i in range(5))}) ORDER BY 1 LIMIT 3) UNION ALL SELECT n_nationkey, 'again' FROM nation WHERE n_nationkey BETWEEN 1 AND 3")
def analysis_pages(t):
    pages = t.nation.select(c("n_nationkey").alias("number"), c("n_name").alias("path"))
    used = pages.filter(c("number").isin(spread_pages(25, 5)))
    told = lambda df, way: df.select("number", F.lit(way).alias("way"))
    return told(used, "used").unionByName(told(unused_pages(pages, used), "next")).unionByName(told(unused_pages(pages, pages), "again"))


_MATERIALS = ", ".join(f"('{k}', [{', '.join(repr(w) if chr(39) not in w else chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39) for w in words)}], [{', '.join(repr(h) for h in heads)}])" for k, (words, heads) in fixed.MATERIALS.items())
_CHUNK = "'peinture ' || CASE n_nationkey % 4 WHEN 0 THEN 'et tuile' WHEN 1 THEN 'du cadre' WHEN 2 THEN 'sur panneau' ELSE '' END"


@query(f"""WITH k AS (SELECT 'k' || lpad(n_nationkey::VARCHAR, 2, '0') AS id, n_nationkey AS ord, {_CODE} AS code, CASE WHEN n_nationkey % 6 = 5 THEN 'vide' ELSE {_CHUNK} END AS text FROM nation), m(material, words, heads) AS (VALUES {_MATERIALS}),
e AS (SELECT material, id, ord, code, len(list_filter(words, lambda w: contains(lower(text), w))) > 0 AS named, list_contains(heads, left(code, 5)) AS coded FROM k, m)
SELECT material, count(*) FILTER (named) AS n_chunks, coalesce(array_to_string(list_sort(list(DISTINCT code) FILTER (named OR coded)), ','), '') AS codes, coalesce(array_to_string((list(id ORDER BY ord) FILTER (named))[1:5], ','), '') AS samples FROM e GROUP BY 1""")
def material_index(t):
    body = F.concat(F.lit("peinture "), F.expr("CASE n_nationkey % 4 WHEN 0 THEN 'et tuile' WHEN 1 THEN 'du cadre' WHEN 2 THEN 'sur panneau' ELSE '' END"))
    chunks = t.nation.select(F.concat(F.lit("k"), F.lpad(c("n_nationkey").cast("string"), 2, "0")).alias("id"), c("n_nationkey").alias("ord"), F.expr(_CODE).alias("code"), F.when(c("n_nationkey") % 6 == 5, "vide").otherwise(body).alias("text"))
    return books.material_index(chunks).select("material", "n_chunks", F.array_join("codes", ",").alias("codes"), F.array_join("samples", ",").alias("samples"))
