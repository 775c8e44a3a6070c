"""What larger and other tables than the smallest brought up: rows that turn real, and results against plain loops."""

import random

import duckdb
from pyspark.sql import functions as F

from atelier.catalogue import QUERIES, SQL
from atelier.operators import within
from atelier.plans import products, questions

c = F.col
SF = "/root/testdata/sf0.001"


def test_a_room_of_a_larger_table_is_not_taken_for_made_up(spark, tmp_path):
    # customer 899 in a block C with a balance: the room C-999
    con = duckdb.connect()
    con.sql(f"copy (select * from '{SF}/customer.parquet' union all select 899, 'n', 2, 10.0, 'BUILDING') to '{tmp_path}/customer.parquet'")
    con.sql(f"create view customer as select * from '{tmp_path}/customer.parquet'")
    got = QUERIES["guarded_lookup"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.sql(SQL["guarded_lookup"]).fetchall())


def test_products_against_the_truth_equal_loops_and_pair_no_section(spark):
    rng = random.Random(3)
    word = lambda *more: rng.choice(["", None, "a", "A-b", "a b c", "b", "ring", "old ring", *more])
    table = lambda n: [(k, rng.choice(["09", "10", "", None]), word("x y"), word("Ring_1"), word("z")) for k in range(n)]
    found, truth = table(70), table(60)
    norm = lambda x: (x or "").upper().strip().translate(str.maketrans("-_", "  "))
    agrees = lambda a, b: a == b or (b != "" and b in a) or (a != "" and a in b)
    want = []
    for g in truth:
        scores = ((f[0], sum(agrees(norm(x), norm(y)) for x, y in zip(f[1:], g[1:])) / 4) for f in found if (f[1] or "") == (g[1] or ""))
        want.append(next(((g[0], k, s) for k, s in scores if s > 0.5), (g[0], None, None)))
    ddl = "ord int, section string, category string, product string, type string"
    out = products.against_truth(spark.createDataFrame(found, ddl), spark.createDataFrame(truth, ddl))
    assert [(r.ord, r.found_ord, r.score) for r in out.orderBy("ord").collect()] == want


def test_one_section_of_many_products(spark):
    # 20,000 by 20,000 products of one section: 4e8 pairs would not end in time
    make = lambda step: spark.range(20_000).select(c("id").cast("int").alias("ord"), F.lit("09").alias("section"), F.concat(F.lit("brand "), c("id") % 20).alias("category"), F.concat(F.lit("name "), (c("id") * step) % 50).alias("product"), F.lit("x").alias("type"))
    out = products.against_truth(make(1), make(3))
    assert out.filter("status = 'matched'").count() == 20_000 and out.agg(F.max("found_ord")).first()[0] < 100


def test_a_list_that_many_ask_for_is_ranked_once_and_met_in_cells(spark, monkeypatch):
    monkeypatch.setattr(questions, "CELL", 3)
    entries = spark.range(11).select(c("id").alias("ord"), F.lit("CLASSE").alias("room_type"), F.lit("A").alias("block"), F.lit(1).alias("floor"), (50 - c("id")).cast("string").alias("plan_id"))
    totals = spark.range(8).select(c("id").alias("qid"), F.lit("CLASSE").alias("room_type"), F.when(c("id") % 2 == 0, "A").alias("_block")).unionByName(spark.sql("select 99L as qid, 'CLASSE' as room_type, 'Z' as _block"))
    got = questions._listed(totals, entries)
    assert sorted((r.qid, r["rank"], r.ord) for r in got.collect()) == [(q, k, 11 - k) for q in range(8) for k in range(1, 12)]
    # no window or sort over questions: the questions of a cell are one row until the last step
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.index("Generate explode(_qids") < plan.index("Join")


def test_texts_that_hold_few_items_are_not_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "le local A-12 est vu"), (2, "a b"), (3, None), (4, "rue des A-1")], "id int, text string")
    items = spark.createDataFrame([(1, "A-1"), (2, "des A"), (3, "local A-12 est"), (4, "")], "i int, item string")
    want = [(1, 1), (1, 3), (4, 1), (4, 2)]
    for few in (within.FEW, 0):
        monkeypatch.setattr(within, "FEW", few)
        assert sorted((r.id, r.i) for r in within.held(docs, items, "id", "i").collect()) == want
        valued = within.held(docs, items, "id", "i", value=lambda x: F.length(x) + F.length("text"))
        assert sorted((r.id, r.i, r.value) for r in valued.collect()) == [(1, 1, 23), (1, 3, 34), (4, 1, 14), (4, 2, 16)]
    monkeypatch.setattr(within, "FEW", 500_000)
    plan = within.held(docs, items, "id", "i")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "rightHint=(strategy=broadcast)" in plan


def test_nearest_in_a_crowd_equals_loops_and_asks_each_place_once(spark, monkeypatch):
    import math

    from atelier.operators import near

    rng = random.Random(5)
    at = lambda: rng.choice([rng.gauss(0, 40), rng.gauss(0, 3), 7.0])
    left = [(i, rng.choice([1, None]), *rng.choice([(at(), at()), (7.0, 7.0), (None, 1.0)])) for i in range(300)]
    right = [(i, rng.choice([1, None]), *rng.choice([(at(), at()), (7.0, 7.0), (2.0, None)])) for i in range(300)]
    a, b = spark.createDataFrame(left, "ord int, k int, x double, y double"), spark.createDataFrame(right, "rord int, k int, rx double, ry double").select("k", "rord", "rx", "ry")
    for strict, bonus in ((True, 0.0), (False, 50.0)):
        score = lambda p, q: math.hypot(p[2] - q[2], p[3] - q[3]) - bonus * (2 * (q[3] < p[3]) + (q[2] < p[2]))  # noqa: E731, B023
        near_ = lambda d: d < 60 if strict else d <= 60  # noqa: E731, B023
        placed = lambda p: None not in p[1:]
        want = {p[0]: min(((score(p, q), q[0]) for q in right if placed(p) and placed(q) and near_(math.hypot(p[2] - q[2], p[3] - q[3]))), default=(None, None))[1] for p in left}
        value = c("dist") - bonus * (2 * (c("ry") < c("y")).cast("int") + (c("rx") < c("x")).cast("int"))
        got = near.nearest(a, b, ["k"], ["ord"], 60.0, value, strict=strict, under=3 * bonus)
        assert {r.ord: r.rord for r in got.collect()} == want
    # 8,000 rows at one place on both sides: 64e6 pairs if each row were asked
    pairs, join = [], near.grid_join
    monkeypatch.setattr(near, "grid_join", lambda *args: pairs.append(join(*args)) or pairs[-1])
    crowd = spark.range(8_000).select(F.lit(1).alias("k"), c("id").alias("ord"), F.lit(5.0).alias("x"), F.lit(5.0).alias("y"))
    got = near.nearest(crowd, crowd.select("k", c("ord").alias("rord"), c("x").alias("rx"), c("y").alias("ry")), ["k"], ["ord"], 60.0, under=0.0)
    assert got.filter("rord = 0 and dist = 0").count() == 8_000 and sum(p.count() for p in pairs) == len(pairs)


def test_pages_are_dealt_before_they_are_sorted_and_parts_need_no_window(spark):
    from atelier.operators import sections

    plan = QUERIES["spec_sections"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    lowest = plan[plan.index("Repartition") if "Repartition" in plan else plan.rindex("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" not in lowest and "WindowGroupLimit" in plan
    pages = spark.createDataFrame([(1, 1, "UN\nSection 09 91 00 a\nDEUX\nSection 10 28 13")], "k int, page int, text string")
    parts = sections.header_parts(pages, ["k"])
    assert [(r.n, r.code, r.title) for r in parts.orderBy("n").collect()] == [(0, None, ""), (1, "09 91 00", "UN"), (2, "10 28 13", "DEUX")]
    assert "Window" not in parts._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_split_and_only_long_ones_searched(spark):
    """Tokens equal those of the pattern for words of any length, blanks at the ends, empty and null texts."""
    long_, longer = "x" * 64, "".join(chr(97 + i % 26) for i in range(200))
    texts = ["", None, "  ", f" a b\t{long_} {longer}\n{long_}y \U0001f600{long_} ", "no long one here here", longer]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    by_pattern = F.array_distinct(F.regexp_extract_all("t", F.lit(within.WORD), F.lit(1)))
    got = df.select(F.array_sort(within.tokens(F.col("t"), F.lit(False), F.lit(False))).alias("a"), F.array_sort(by_pattern).alias("b")).collect()
    assert all(r.a == r.b for r in got) and len(got[3].a) > 6
    plan = df.select(within.tokens(F.col("t"), F.lit(False), F.lit(False)))._jdf.queryExecution().toString()
    assert "array_max(" in plan  # the pattern is asked behind the length of the longest word
