"""Sets at a time: many questions, many keys, large crowds of points, one very long document."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from atelier.functions import text
from atelier.operators import near, sections
from atelier.plans import books, questions, search

c = F.col
ROOMS = "ord int, id string, plan_id string, name string, block string, floor int, type string, source string, confidence string, notes string, area_pica string"
NAMES = [("CLASSE", "CLASSE"), ("CLASSE MATERNELLE", "CLASSE"), ("CORRIDOR", "CORRIDOR"), ("W.C.", "WC"), ("BUREAU DIRECTEUR", "BUREAU"), ("CHAUFFERIE", "TECHNIQUE"), ("SERVICE DE GARDE", "SERVICE")]
ASKED = [
    "C'est quoi le local A-103?", "Où est la chaufferie?", "Combien de classes dans le bloc A?", "corridor 105", "bureau directeur", "liste des bureaux", "Combien de licornes dans le bloc B?", "zzz qqq", "a b", "", "  ",
    "local A-999", "B-12", "tous les wc", "service de garde?", "classe maternelle (A)", "CLASSE\tmaternelle", "107", None, "Où est la chaufferie?",
]


def rooms(spark, n=60):
    rows = [(k, f"{'ABC'[k % 3]}-{100 + k}", str(100 + k), NAMES[k % 7][0], "ABC"[k % 3], 1 + k % 2, NAMES[k % 7][1], "p.A-150", "HIGH" if k % 4 else "MEDIUM", "près du gymnase" if k % 5 == 0 else None, str(k) if k % 2 else None) for k in range(n)]
    return search.verified_index(spark.createDataFrame(rows, ROOMS))


def test_parts_of_questions_are_read_as_one_by_one(spark):
    asked = [q for q in ASKED if q is not None] + ["Combien  de CORRIDORS au Bloc c", "tous\nles dépôts", "A-204-B", "x101-2-C", "C-77", "AB-123", "é-101"]
    rows = spark.createDataFrame([(q,) for q in asked], "q string").select("q", questions.terms_of(c("q")).alias("t"), questions.gold_terms_of(c("q")).alias("g"), questions.room_of(c("q")).alias("r"), questions.total_of(c("q")).alias("s")).collect()
    for r in rows:
        assert (r.t, r.g, r.r) == (text.terms(r.q), text.gold_terms(r.q), text.asked_room(r.q)), r.q
        assert (r.s.asDict() if r.s else None) == text.asked_total(r.q), r.q


@pytest.mark.parametrize("frequent", [2_000, 3])
def test_many_questions_get_what_each_gets(spark, monkeypatch, frequent):
    monkeypatch.setattr(questions, "FREQUENT", frequent)
    entries = rooms(spark).cache()
    made_up = spark.createDataFrame([("A-999",)], "id string")
    asked = spark.createDataFrame(list(enumerate(ASKED)), "qid int, question string")
    for more in ({}, {"block": "A", "high_only": True, "limit": 3}):
        got = {}
        for r in questions.ask_many(entries, asked, made_up, **more).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append((r.rank, r.ord, r.score))
        for k, q in enumerate(ASKED):
            want = [] if q is None else [(i + 1, r.ord, r.score) for i, r in enumerate(search.ask(entries, q, made_up, **more).collect())]
            if text.asked_total(q or ""):  # the order of a list leaves ties open
                assert sorted(x[1:] for x in got.get(k, [])) == sorted(x[1:] for x in want)
            else:
                assert got.get(k, []) == want, q


def test_many_searches_get_what_each_gets(spark, monkeypatch):
    monkeypatch.setattr(questions, "FREQUENT", 4)
    rng = random.Random(4)
    found = [(f"r{k:02d}", rng.choice(["CLASSE", "BUREAU", "WC", None]), str(100 + k % 9), rng.random(), k % 3) for k in range(40)]
    doors = [(f"d{k}", f"P-{k}", 0.8, 1) for k in range(12)]
    entries = search.index(spark.createDataFrame(found, "id string, name string, number string, confidence double, page int"), spark.createDataFrame(doors, "id string, number string, confidence double, page int")).cache()
    asked = ["classe 101", "porte p-1", "", "toilette", "zzz", "salle 10", "wc room", None]
    table = spark.createDataFrame(list(enumerate(asked)), "qid int, question string")
    for more in ({"limit": 7}, {"kind": "room", "least": 0.3}):
        got = {}
        for r in questions.search_many(entries, table, **more).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append((r.rank, r.id, r.score))
        for k, q in enumerate(asked):
            want = [] if q is None else [(i + 1, r.id, r.score) for i, r in enumerate(search.search(entries, q, **more).collect())]
            assert got.get(k, []) == want, q
    assert questions.search_many(entries, table.limit(0)).count() == 0 and questions.search_many(entries.limit(0), table).count() == 0


def test_few_terms_are_looked_for_in_one_scan(spark, monkeypatch):
    def no_postings(*a, **b):
        raise AssertionError("postings of few terms")

    monkeypatch.setattr(questions, "held", no_postings)
    monkeypatch.setattr(questions, "BITS", 5)
    monkeypatch.setattr(questions, "PART", 2)
    rng = random.Random(7)
    words = ["salle", "wc", "classe", "salle de bain", "101", "x", "éa", "classes", ""]
    rows = [(k, "  ".join(rng.choices(words, k=k % 6)), rng.choice(["classe", "WC", None, "la classe"]), rng.choice(["101", "x", "", None])) for k in range(150)]
    entries = spark.createDataFrame(rows, "id int, search_text string, name string, number string").cache()
    asked = ["classe 101", "wc", "", "toilette x", "zzz", "salle de", "éa x 101 classes", None, "wc", "porte fenêtre superficie corridor rangement dimension"]
    table = spark.createDataFrame(list(enumerate(asked)), "qid int, question string")
    for limit in (3, 200):
        got = {}
        for r in questions.search_many(entries, table, limit=limit, tie=("id",)).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append((r.rank, r.id, r.score))
        for k, q in enumerate(asked):
            want = [] if q is None else [(i + 1, r.id, r.score) for i, r in enumerate(search.search(entries, q, limit=limit, tie=("id",)).collect())]
            assert got.get(k, []) == want, q


def test_words_of_a_question_are_read_once(spark):
    rows = spark.createDataFrame([("wc de la classe",)], "q string")
    for terms in (questions.terms_of, questions.gold_terms_of):
        plan = rows.select(terms(c("q")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1


def test_many_keys_get_what_each_gets(spark):
    keys = ["A-101", "a-102", "A-1010", "B-7", "béton", "", None, "09 91 00"]
    asked = ["A-101", "a-1", "LOCAL B-7 EST", "BÉTON armé", "zz", "", None, "91", "A-102", "A-10"]
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [("B-7", 50)], "key string, n int")
    got = {r.asked: (r.key, r.way) for r in books.fuzzy_keys(spark.createDataFrame([(a,) for a in asked * 2], "asked string"), table, "key").collect()}
    for a in asked:
        one = books.fuzzy_key(a, table, "key").first() if a else None
        assert got.get(a, (None,))[0] == (one.key if one else None), a
    assert got["A-101"][1] == 0 and got["LOCAL B-7 EST"] == ("B-7", 1)
    assert books.fuzzy_keys(spark.createDataFrame([], "asked string"), table, "key").count() == 0


def thinned(points, radius):
    """The loop: in order, those that nothing kept is nearer to, by cells."""
    kept, cells = [], {}
    for o, x, y in sorted(points):
        gx, gy = math.floor(x / radius), math.floor(y / radius)
        if all(math.hypot(x - a, y - b) >= radius for i in (-1, 0, 1) for j in (-1, 0, 1) for a, b in cells.get((gx + i, gy + j), ())):
            kept.append((o, x, y))
            cells.setdefault((gx, gy), []).append((x, y))
    return kept


@pytest.mark.parametrize("shape", ["spread", "crowd", "line", "ties"])
def test_thinning_in_rounds_equals_the_loop(spark, shape):
    rng = random.Random(5)
    n = {"spread": 3000, "crowd": 4000, "line": 120, "ties": 1500}[shape]
    place = {"spread": lambda k: (rng.uniform(-900, 900), rng.uniform(-900, 900)), "crowd": lambda k: (rng.gauss(0, 12), rng.gauss(0, 12)), "line": lambda k: (4.0 * k, 0.0), "ties": lambda k: (10.0 * rng.randint(0, 20), 10.0 * rng.randint(0, 20))}[shape]
    points = [(rng.randint(0, 300) if shape == "ties" else k, *place(k)) for k in range(n)]
    other = [(k, float(k), 0.0) for k in range(5)]
    rows = [(1, *p) for p in points] + [(None, *p) for p in other] + [(2, 1, None, 3.0), (1, -5, None, 1.0)]
    df = spark.createDataFrame(rows, "page int, ord long, x double, y double")
    got = sorted((r.ord, r.x, r.y) for r in near.suppress(df.filter("x is not null"), ["page"], 10.0, most=30).filter("page = 1").collect())
    assert got == thinned(points, 10.0)
    every = near.suppress(df, ["page"], 10.0, most=30).collect()
    assert {(r.page, r.ord) for r in every} - {(1, p[0]) for p in points} == {(None, 0), (2, 1), (1, -5)}


def test_thinning_in_rounds_starts_with_what_is_taken(spark):
    kind = "array<struct<ord:bigint,x:double,y:double>>"
    points = [(k, 3.0 * (k * 37 % 100), 0.0) for k in range(100)]
    df = spark.createDataFrame([(1, *p) for p in points], "page int, ord long, x double, y double").withColumn("taken", F.expr(f"cast(array(struct(-1L, 50.0D, 0.0D)) as {kind})"))
    got = [sorted((r.ord, r.x) for r in near.suppress(df, ["page", "taken"], 10.0, taken=c("taken"), most=most).collect()) for most in (5, 1000)]
    assert got[0] == got[1] == sorted((o, x) for o, x, _ in thinned([(-1, 50.0, 0.0), *points], 10.0))


def long_document(spark, n=3000):
    rng = random.Random(6)
    rows = [("one", k * 3 - 50, "" if k % 11 == 0 else f"t{k}" * (k % 3), rng.random() < 0.004) for k in range(n)] + [(None, k, f"abcd{k}", k == 1) for k in range(5)] + [("two", 7, "abcde", False)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc string, ord int, text string, opens boolean")


def test_one_long_document_is_scanned_in_stretches(spark):
    df = long_document(spark)
    whole = Window.partitionBy("doc").orderBy("ord")
    plain = df.select("doc", "ord", F.last(F.when(c("opens"), c("ord")), ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, 0)).alias("section"))
    rows = lambda x: sorted(map(tuple, x.collect()), key=repr)
    for size in (64, 1, 100_000):
        got = sections.filled(df, ["doc"], ["ord"], c("opens"), size=size)
        assert got.columns == [*df.columns, "section"] and rows(got.select("doc", "ord", "section")) == rows(plain)
    numbers = sections.numbered_rows(df, ["doc"], ["ord"], "n", 64)
    assert rows(numbers.select("doc", "ord", "n")) == rows(df.select("doc", "ord", (F.row_number().over(whole) - 1).cast("long").alias("n")))
    about = F.left(F.array_join(F.filter(F.collect_list("text").over(whole.rowsBetween(-3, 2)), lambda t: F.length(t) >= 4), " | "), F.lit(500))
    for size in (3, 50):
        assert rows(sections.context(df, ["doc"], ["ord"], size=size).select("doc", "ord", "context")) == rows(df.select("doc", "ord", about.alias("context")))
    with pytest.raises(ValueError):
        sections.context(df, ["doc"], ["ord"], size=2)
    named = df.withColumn("ord", F.format_string("%05d", c("ord") + 100))
    assert sections.filled(named, ["doc"], ["ord"], c("opens")).filter("section is not null").count() == plain.filter("section is not null").count()


def test_a_long_document_is_dealt_to_tasks(spark):
    df = long_document(spark).filter("doc = 'one'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sections.filled(df, ["doc"], ["ord"], c("opens"), size=200).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2400
