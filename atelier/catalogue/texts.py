"""Queries on text: scores, filters, parsing, sections, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, imperial, scores, text
from ..operators import keep, sections
from ..plans import detect, search
from .base import query

c = F.col


def _score_sql() -> str:
    cols = []
    for name, words in fixed.PAGE_WORDS.items():
        parts = [f"((length(l) - length(replace(l, '{w}', ''))) // length('{w}')) * {k}" for w, k in words.items()]
        if name == "PLAN":
            parts.append(f"least({fixed.NUMBER_WEIGHT} * len(list_filter(regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '[1-9][0-9][0-9]'))), {fixed.NUMBER_MOST})")
        cols.append(f"({' + '.join(parts)})::BIGINT AS {name.lower()}")
    return f"SELECT doc_id, source, lang, text, {', '.join(cols)} FROM (SELECT *, lower(coalesce(text, '')) AS l, coalesce(text, '') AS t FROM documents)"


CLASS_SQL = "CASE WHEN greatest(legend, plan, detail, elevation) <= 0 THEN 'OTHER' WHEN legend = greatest(legend, plan, detail, elevation) THEN 'LEGEND' WHEN plan = greatest(legend, plan, detail, elevation) THEN 'PLAN' WHEN detail = greatest(legend, plan, detail, elevation) THEN 'DETAIL' ELSE 'ELEVATION' END"


@query(f"SELECT doc_id, legend, plan, detail, elevation FROM ({_score_sql()})")
def page_keyword_scores(t):
    rows = keep.spread(t.documents.select("doc_id", "text")).select("doc_id", scores.page_scores(c("text")).alias("s"))
    return rows.select("doc_id", *(c(f"s.{k}").cast("long").alias(k.lower()) for k in fixed.PAGE_WORDS))


@query(f"SELECT d.type, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('LEGEND'), ('PLAN'), ('DETAIL'), ('ELEVATION'), ('OTHER')) d(type) LEFT JOIN (SELECT {CLASS_SQL} AS type, count(*) AS n FROM ({_score_sql()}) GROUP BY 1) x USING (type)")
def page_class_histogram(t):
    return detect.class_counts(detect.classified(keep.spread(t.documents.select("doc_id", "text"))))


@query(f"""
WITH s AS ({_score_sql()}), k AS (SELECT source, doc_id AS page, {CLASS_SQL} AS type, greatest(legend, plan, detail, elevation, 0) AS score FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY source, type ORDER BY score DESC, page) - 1 AS r, count(*) OVER (PARTITION BY source, type) AS a, 5 - max((type = 'LEGEND')::INT) OVER (PARTITION BY source) AS w FROM k),
p AS (SELECT *, CASE WHEN (type = 'LEGEND' AND r = 0) OR (type = 'PLAN' AND (a <= w OR len(list_filter(range(0, w), lambda i: round_even(i * (a - 1)::DOUBLE / (w - 1), 0)::BIGINT = r)) > 0)) THEN 0 ELSE 1 END AS f FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY f, page) AS place FROM p)
SELECT source, page, type, score::BIGINT AS score FROM o WHERE place <= 5
""")
def select_pages_per_source(t):
    pages = detect.classified(keep.spread(t.documents.select("source", c("doc_id").alias("page"), "text")))
    return keep.select_pages(pages.select("source", "page", "type", c("score").cast("long").alias("score")), ["source"], 5)


_TERMS = text.terms("the room class detail")


def _term_sql(terms: list[str], body: str, name: str, number: str) -> str:
    parts = [f"contains({body}, '{x}')::INT + CASE WHEN '{x}' IN ({name}, {number}) THEN 3 WHEN contains({name}, '{x}') OR contains({number}, '{x}') THEN 2 ELSE 0 END" for x in terms]
    return " + ".join(parts)


@query(f"""
SELECT doc_id, score FROM (SELECT doc_id, ({_term_sql(_TERMS, "s", "lower(source)", "lower(lang)")})::INTEGER AS score
FROM (SELECT *, regexp_replace(regexp_replace(lower(coalesce(text, '')), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') AS s FROM documents)) WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 20
""")
def search_topk(t):
    docs = keep.spread(t.documents.select("doc_id", "source", "lang", "text")).select("doc_id", "source", "lang", text.search_text(F.coalesce("text", F.lit(""))).alias("s"))
    return keep.top_k(docs, scores.search_score(_TERMS, c("s"), c("source"), c("lang")), ["doc_id"], 20).select("doc_id", "score")


_PART = ["steel", "brand#1", "economy"]


@query(f"""
SELECT p_partkey, score FROM (SELECT p_partkey, ({" + ".join(f"contains(s, '{x}')::INT + CASE WHEN n = '{x}' THEN 3 WHEN contains(n, '{x}') THEN 2 ELSE 0 END + CASE WHEN b = '{x}' THEN 5 WHEN contains(b, '{x}') THEN 2 ELSE 0 END" for x in _PART)})::INTEGER AS score
FROM (SELECT p_partkey, lower(p_name) AS n, lower(p_brand) AS b, lower(p_name || ' ' || p_type || ' ' || p_brand) AS s FROM part)) WHERE score > 0 ORDER BY score DESC, p_partkey LIMIT 10
""")
def search_exact_boost(t):
    p = t.part.withColumn("s", F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand")))
    return keep.top_k(p, scores.gold_score(_PART, None, c("s"), c("p_type"), c("p_brand"), c("p_name")), ["p_partkey"], 10).select("p_partkey", "score")


@query(r"""SELECT l_orderkey, l_linenumber, t AS value_text, inches AS value_inches, feet, confidence FROM (
SELECT l_orderkey, l_linenumber, t, f::INTEGER AS feet, (f * 12 + i + n / 8.0)::DOUBLE AS inches,
 round(least(1.0, 0.7 + 0.15 + CASE WHEN f * 12 + i + n / 8.0 BETWEEN 6 AND 1200 THEN 0.1 ELSE 0 END + CASE WHEN f * 12 + i + n / 8.0 IN (96, 120, 144, 180, 240, 360) THEN 0.05 ELSE 0 END), 6)::DOUBLE AS confidence
FROM (SELECT l_orderkey, l_linenumber, l_quantity::INT AS f, l_linenumber::INT AS i, (l_orderkey % 8)::INT AS n,
 l_quantity::INT || '''-' || l_linenumber || CASE WHEN l_orderkey % 8 > 0 THEN ' ' || (l_orderkey % 8) || '/8' ELSE '' END || '"' AS t FROM lineitem))""")
def imperial_parse(t):
    rest = (c("l_orderkey") % 8).cast("int")
    made = F.concat(c("l_quantity").cast("int").cast("string"), F.lit("'-"), c("l_linenumber").cast("string"), F.when(rest > 0, F.concat(F.lit(" "), rest.cast("string"), F.lit("/8"))).otherwise(""), F.lit('"'))
    li = keep.spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")).select("l_orderkey", "l_linenumber", made.alias("value_text"))
    return li.select("l_orderkey", "l_linenumber", "value_text", imperial.inches(c("value_text")).alias("value_inches"), imperial.parsed(c("value_text"))["feet"].alias("feet"), F.round(imperial.confidence(c("value_text")), 6).alias("confidence"))


@query("""SELECT l_orderkey, l_linenumber, k::INTEGER AS n, CASE k WHEN 1 THEN l_quantity::INT * 12 + l_linenumber ELSE (l_orderkey % 11 + 1) END::DOUBLE AS value_inches
FROM lineitem, (VALUES (1), (2)) v(k)""")
def imperial_extract_all(t):
    made = F.concat(F.lit("wall "), c("l_quantity").cast("int").cast("string"), F.lit("'-"), c("l_linenumber").cast("string"), F.lit('" by '), (c("l_orderkey") % 11 + 1).cast("string"), F.lit('" clear'))
    each = keep.spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")).select("l_orderkey", "l_linenumber", F.posexplode(imperial.within(made)).alias("i", "s"))
    return each.select("l_orderkey", "l_linenumber", (c("i") + 1).cast("int").alias("n"), imperial.inches(c("s.match")).alias("value_inches"))


@query(r"""SELECT s_suppkey AS k, CASE WHEN d <> '' THEN 'P-' || CASE WHEN length(d) < 2 THEN lpad(d, 2, '0') ELSE d END END AS number, regexp_full_match('P-' || (s_suppkey % 1000), 'P-?\d{1,3}[A-Z]?') AS is_label
FROM (SELECT s_suppkey, regexp_extract(s_name, '(\d+)', 1) AS d FROM supplier)
UNION ALL SELECT c_custkey, CASE WHEN d <> '' THEN 'P-' || CASE WHEN length(d) < 2 THEN lpad(d, 2, '0') ELSE d END END, regexp_full_match('P-' || (c_custkey % 1000), 'P-?\d{1,3}[A-Z]?') FROM (SELECT c_custkey, regexp_extract(c_name, '(\d+)', 1) AS d FROM customer)""")
def door_number_norm(t):
    one = lambda df, k, n: df.select(c(k).alias("k"), text.door_number(c(n)).alias("number"), text.is_door_label(F.concat(F.lit("P-"), (c(k) % 1000).cast("string"))).alias("is_label"))
    return one(t.supplier, "s_suppkey", "s_name").unionByName(one(t.customer, "c_custkey", "c_name"))


@query(r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, len(regexp_extract_all(html, '<a '))::INTEGER AS links FROM pages""")
def html_title(t):
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.size(F.regexp_extract_all("html", F.lit("<a "), F.lit(0))).alias("links"))


_NAMES = [(1, "CLASSE 2"), (2, "W.C. garçons"), (3, "local mécanique"), (4, "DÉPÔT"), (5, "Salle de bain"), (6, "BIBLIOTHÈQUE"), (7, "Vestibule"), (8, "bureau direction"), (9, "SALLE DE CLASSE"), (10, "TOILETTES"), (11, "maternelle"), (12, "xyz")]


def _ladder_sql(expr: str, rungs, rest: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({expr}, '{w}')" for w in words) + f" THEN '{v}'" for words, v in rungs) + f" ELSE '{rest}' END"


def _names_sql() -> str:
    norm = "upper(trim(name))"
    for old, new in fixed.NAME_REPLACEMENTS:
        norm = f"replace({norm}, '{old}', '{new}')"
    values = ", ".join(f"({i}, '{n}')" for i, n in _NAMES)
    truth = "replace(replace(upper(trim(name)), '-', ' '), '_', ' ')"
    return f"SELECT id, name, {_ladder_sql(norm, fixed.LADDER_PLAN, 'AUTRE')} AS plan_type, {_ladder_sql(truth, fixed.LADDER_TRUTH, 'AUTRE')} AS truth_type, {_ladder_sql('upper(name)', fixed.LADDER_COUNT, 'AUTRE')} AS count_type, {_ladder_sql('upper(name)', fixed.LADDER_INDEX, 'OTHER')} AS index_type FROM (SELECT id::BIGINT AS id, name FROM (VALUES {values}) v(id, name) UNION ALL SELECT p_partkey, p_name FROM part)"


@query(_names_sql())
def type_ladders(t):
    rows = t.spark.createDataFrame(_NAMES, "id long, name string").unionByName(t.part.select(c("p_partkey").alias("id"), c("p_name").alias("name")))
    return rows.select("id", "name", text.room_type(c("name")).alias("plan_type"), text.truth_type(c("name")).alias("truth_type"), text.counted_type(c("name")).alias("count_type"), text.index_type(c("name"), []).alias("index_type"))


@query("SELECT doc_id, n AS line, length(l)::INTEGER AS n_chars FROM (SELECT doc_id, unnest(s) AS l, generate_subscripts(s, 1)::INTEGER AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)) WHERE trim(l) <> ''")
def scan_lines(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "l")).filter(F.trim("l") != "")
    return lines.select("doc_id", (c("i") + 1).alias("line"), F.length("l").alias("n_chars"))


def _pattern_sql(col: str) -> str:
    room = " ".join(f"WHEN regexp_full_match({col}, '{p.strip('^$')}') THEN {v}" for p, v in fixed.ROOM_NUMBERS)
    names = "|".join(f"(?:{p})" for p in fixed.ROOM_NAMES)
    doors = "|".join(f"(?:{p.strip('^$')})" for p in fixed.DOOR_LABELS)
    return f"(CASE {room} END)::DOUBLE AS room_confidence, regexp_full_match(upper({col}), '{names}') AS is_name, regexp_full_match(upper({col}), '{doors}') AS is_door"


@query(f"SELECT w, n, {_pattern_sql('w')} FROM (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM documents UNION ALL SELECT c_mktsegment FROM customer UNION ALL SELECT p_brand FROM part UNION ALL SELECT 'A-' || p_size || '01' FROM part UNION ALL SELECT 'D' || s_suppkey FROM supplier) GROUP BY 1)")
def pattern_filters(t):
    words = t.documents.select(F.explode(F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")).alias("w"))
    more = t.customer.select(c("c_mktsegment").alias("w")).unionByName(t.part.select(c("p_brand").alias("w"))).unionByName(t.part.select(F.concat(F.lit("A-"), c("p_size").cast("string"), F.lit("01")).alias("w"))).unionByName(t.supplier.select(F.concat(F.lit("D"), c("s_suppkey").cast("string")).alias("w")))
    counts = words.unionByName(more).groupBy("w").agg(F.count("*").alias("n"))
    return counts.select("w", "n", text.room_number_confidence(c("w")).alias("room_confidence"), text.is_room_name(c("w")).alias("is_name"), text.is_door_label(c("w")).alias("is_door"))


@query("""WITH l AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1)::INTEGER AS ord FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
z AS (SELECT *, length(text)::INTEGER AS size FROM l WHERE trim(text) <> ''),
f AS (SELECT doc_id, size, sum(length(text)) AS w, min(ord) AS o FROM z GROUP BY ALL), d AS (SELECT doc_id, size AS dominant FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, o) = 1)
SELECT z.doc_id, ord, (size > dominant OR (upper(text) = text AND lower(text) <> text AND length(text) > 3)) AS title, CASE WHEN size - dominant >= 4 THEN 1 WHEN size - dominant >= 2 THEN 2 ELSE 2 END AS level FROM z JOIN d USING (doc_id)""")
def title_blocks(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text")).filter(F.trim("text") != "")
    lines = lines.select("doc_id", "text", (c("i") + 1).alias("ord"), F.length("text").alias("size"))
    both = lines.join(sections.dominant_font(lines, ["doc_id"]), "doc_id")
    return both.select("doc_id", "ord", sections.is_title(c("text"), c("size"), c("dominant"), F.lit(False)).alias("title"), sections.title_level(c("size"), c("dominant"), F.lit(False)).alias("level"))


_GROUPS = "[['WC','TOILETTES','TOILETTE','W.C.','SALLE DE BAIN','S.D.B.'],['RANGEMENT','REMISE','DÉPÔT','ENTREPOSAGE'],['TECHNIQUE','LOCAL TECHNIQUE','LOCAL MÉCANIQUE','MÉCANIQUE'],['ÉLECTRIQUE','LOCAL ÉLECTRIQUE']]"


@query(f"""SELECT p_partkey, a AS norm, contains(a, b) OR contains(b, a) AS held, len(list_filter({_GROUPS}, lambda g: list_contains(g, a) AND list_contains(g, b))) > 0 AS same
FROM (SELECT p_partkey, replace(replace(upper(trim(p_name)), '-', ' '), '_', ' ') AS a, upper(split_part(p_name, ' ', 1)) AS b FROM part UNION ALL SELECT -n, x, y FROM (VALUES (1, 'WC', 'TOILETTE'), (2, 'REMISE', 'DÉPÔT'), (3, 'WC', 'REMISE')) v(n, x, y))""")
def text_equivalence(t):
    rows = t.part.select("p_partkey", text.compared(c("p_name")).alias("a"), F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("b"))
    rows = rows.unionByName(t.spark.createDataFrame([(-1, "WC", "TOILETTE"), (-2, "REMISE", "DÉPÔT"), (-3, "WC", "REMISE")], "p_partkey long, a string, b string"))
    return rows.select("p_partkey", c("a").alias("norm"), text.either_holds(c("a"), c("b")).alias("held"), text.same_name(c("a"), c("b")).alias("same"))


_ASKED = text.gold_terms("Combien de classes dans le bloc A?")


@query(f"""SELECT doc_id, hits, round(hits / {len(_ASKED)}.0::DOUBLE, 6) AS relevance FROM (SELECT doc_id, ({" + ".join(f"contains(l, '{x}')::INT" for x in _ASKED)})::INTEGER AS hits FROM (SELECT doc_id, lower(coalesce(text, '')) AS l FROM documents)) WHERE hits > 0""")
def query_parse(t):
    low = F.lower(F.coalesce("text", F.lit("")))
    hits = F.aggregate(F.array(*map(F.lit, _ASKED)), F.lit(0), lambda a, x: a + F.contains(low, x).cast("int"))
    return t.documents.select("doc_id", hits.alias("hits")).filter("hits > 0").withColumn("relevance", F.round(c("hits") / float(len(_ASKED)), 6))


@query("""SELECT w, count(*) AS n_docs, min(doc_id) AS first_doc, sum(n)::BIGINT AS n FROM (SELECT w, doc_id, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+')) AS w FROM documents) GROUP BY ALL) GROUP BY 1""")
def inverted_index(t):
    words = keep.spread(t.documents.select("doc_id", "text")).select("doc_id", F.explode(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")).alias("w"))
    per = words.groupBy("w", "doc_id").agg(F.count("*").alias("n"))
    return per.groupBy("w").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.sum("n").alias("n"))


@query("SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 12) AS id FROM documents")
def doc_hash(t):
    return t.documents.select("doc_id", F.left(F.sha2(F.coalesce("text", F.lit("")), 256), F.lit(12)).alias("id"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, ('k=' || json_extract_string(props, '$.k')) AS label FROM events")
def json_props(t):
    k = F.from_json("props", "k int")["k"]
    return t.events.select("event_id", k.alias("k"), F.concat(F.lit("k="), k.cast("string")).alias("label"))


@query("SELECT conv_id, turn, role, printf('dim-%03d', row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text)) AS id FROM conversations")
def seq_ids(t):
    return keep.numbered(t.conversations, "dim", ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "role", "id")


_CONV = "(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS ord FROM conversations)"


def _turns(t):
    from pyspark.sql import Window

    return t.conversations.withColumn("ord", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))


@query(f"""WITH f AS (SELECT *, max(CASE WHEN role = 'user' THEN ord END) OVER (PARTITION BY conv_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS section FROM {_CONV})
SELECT conv_id, section::INTEGER AS section, count(*) AS n_rows, md5(string_agg(text, chr(10) ORDER BY ord)) AS digest FROM f WHERE section IS NOT NULL GROUP BY ALL""")
def section_fill(t):
    rows = sections.filled(_turns(t), ["conv_id"], ["ord"], c("role") == "user").filter("section is not null")
    return sections.gathered(rows, ["conv_id", "section"], "ord").select("conv_id", "section", "n_rows", F.md5("content").alias("digest"))


@query(f"""SELECT conv_id, ord::INTEGER AS ord, md5(left(array_to_string(list_filter(list(text) OVER (PARTITION BY conv_id ORDER BY ord ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING), lambda x: length(x) >= 4), ' | '), 500)) AS digest FROM {_CONV}""")
def row_context(t):
    return sections.context(_turns(t), ["conv_id"], ["ord"]).select("conv_id", "ord", F.md5("context").alias("digest"))


@query(f"SELECT conv_id, ord::INTEGER AS ord, (lead(ord) OVER (PARTITION BY conv_id ORDER BY ord))::INTEGER AS next_ord FROM {_CONV} WHERE role = 'user'")
def next_section_end(t):
    from pyspark.sql import Window

    return _turns(t).filter("role = 'user'").select("conv_id", "ord", F.lead("ord").over(Window.partitionBy("conv_id").orderBy("ord")).alias("next_ord"))


@query("""WITH l AS (SELECT doc_id, unnest(s) AS l, generate_subscripts(s, 1)::INTEGER AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
w AS (SELECT *, lag(l, 1) OVER p AS a, lag(l, 2) OVER p AS b, lag(l, 3) OVER p AS c FROM l WINDOW p AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, i AS line, CASE WHEN length(a) BETWEEN 4 AND 60 THEN a WHEN length(b) BETWEEN 4 AND 60 THEN b WHEN length(c) BETWEEN 4 AND 60 THEN c END AS title FROM w WHERE starts_with(l, 'Licensed') OR starts_with(l, 'The ')""")
def nth_header_title(t):
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("i")
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "l"))
    above = [F.lag("l", k).over(w) for k in (1, 2, 3)]
    lines = lines.withColumn("title", F.coalesce(*(F.when(F.length(a).between(4, 60), a) for a in above)))
    return lines.filter(F.startswith("l", F.lit("Licensed")) | F.startswith("l", F.lit("The "))).select("doc_id", (c("i") + 1).alias("line"), "title")


@query("""SELECT e.type, e.n FROM (SELECT 'room' AS type, count(*) AS n FROM customer UNION ALL SELECT 'door', count(*) FROM supplier UNION ALL SELECT 'dimension', count(*) FROM part UNION ALL SELECT 'symbol', count(*) FROM nation) e""")
def index_union(t):
    entries = search.index(
        rooms=t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("number")),
        doors=t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("number")),
        lengths=t.part.select(c("p_partkey").alias("id"), F.concat(c("p_size").cast("string"), F.lit("'")).alias("value_text")),
        symbols=t.nation.select(c("n_nationkey").alias("id"), c("n_name").alias("symbol"), c("n_name").alias("meaning"), F.lit("nation").alias("category")),
    )
    return search.index_counts(entries)
