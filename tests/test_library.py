"""Products, answers, references, the older index, reports, sinks: small cases."""

import random
import time

import pytest
from pyspark.sql import functions as F

from atelier.functions import imperial, text
from atelier.operators import keep, sections, within
from atelier.plans import books, check, locate, products, reports, search
from atelier.sources import files

c = F.col


def test_products_in_all_forms(spark):
    rows = [
        (0, 1, "Armstrong | Ultima Tegular; plafond acoustique, 610 x 1220 mm", "09 51 13"), (1, 1, "Fabricant: Mapei. Modèle: KX-200 gris", None), (2, 2, "- Armstrong (ou équivalent approuvé)\n- USG\n- Voir note\n- CertainTeed", None),
        (3, 2, "ARMSTRONG | Ultima Tegular", None), (4, 3, "des murs | Rien. avant | Rien", None), (5, 3, "marque: ou. fabriqué par Soprema", None), (6, 4, None, None),
    ]
    got = products.products(spark.createDataFrame([("d", *r) for r in rows], "doc string, ord int, page int, text string, code string"), ["doc"]).collect()
    by = {(r.maker, r.model): r for r in got}
    assert set(by) == {("Armstrong", "Ultima Tegular"), ("Mapei", "KX-200"), ("Armstrong", None), ("USG", None), ("CertainTeed", None), ("Soprema", None)}
    one = by["Armstrong", "Ultima Tegular"]
    assert (one.kind, one.specs["dimension"], one.code, one.page) == ("plafond", "610 x 1220 mm", "09 51 13", 1) and by["USG", None].kind is None


def test_older_products_and_their_confidence(spark):
    texts = ["Sico | Latex", "Ultraplan de Mapei, ou autre", "Fabricant: Acme Works; Modèle: Z100 noir, etc", "pose de sherwin-williams: ProMar 200, mat", "telle que Kerapoxy de Mapei.", "PVC | tuyaux droits", "Selon les | ABC"]
    got = products.older_products(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), ["k"]).collect()
    seen = {(r.k, r.maker, r.model, r.form, r.confidence) for r in got}
    assert {(0, "Sico", "Latex", "pipe", 1.0), (1, "Mapei", "Ultraplan", "de/of", 0.9), (2, "Acme Works", "Z100 noir", "labeled", 0.9), (3, "Sherwin-williams", "ProMar 200", "known_mfr", 0.85)} <= {(*x[:1], x[1], *x[2:]) for x in seen} | {(k, m.replace("-Williams", "-williams"), *r) for k, m, *r in seen}
    assert not any(k in (5, 6) for k, *_ in seen) and any(k == 4 and m == "Mapei" for k, m, *_ in seen)


def test_products_against_the_truth(spark):
    ddl = "ord int, section string, category string, product string, type string"
    found = spark.createDataFrame([(0, "09", "peinture", "Latex mat", None), (1, "09", "peinture", "Latex", "mur"), (2, "10", "x", "y", "z")], ddl)
    truth = spark.createDataFrame([(0, "09", "PEINTURE", "Latex", "mur"), (1, "10", "a", "b", "c"), (2, None, "a", "b", "c")], ddl)
    got = products.against_truth(found, truth).orderBy("ord").collect()
    assert [(r.found_ord, r.score, r.status) for r in got] == [(0, 0.75, "matched"), (None, None, "missing"), (None, None, "missing")]
    assert products.mean_score(products.against_truth(found, truth)).first().score == 0.75
    rows = spark.createDataFrame([(0.9,), (0.6,), (None,)], "confidence double")
    assert tuple(products.quality(rows).first()) == (3, 2, 1) and products.low_confidence(rows).count() == 1


def test_texts_that_hold_items(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "a brown dog"), (2, "nothing"), (None, "quick brown fox"), (3, None), (4, "xbrownx")], "id int, text string")
    items = spark.createDataFrame([(1, "quick brown fox"), (2, "brown"), (3, "n d"), (4, ""), (5, None), (6, "brown dog"), (7, "zz"), (8, "x"), (2, "fox")], "i int, item string")
    want = {(1, 1), (1, 2), (1, 8), (2, 2), (2, 3), (2, 6), (None, 1), (None, 2), (None, 8), (4, 2), (4, 8)}
    got = within.held(docs, items, "id", "i")
    assert {(r.id, r.i) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_containment_equals_in(spark):
    """Items cut from texts at any place, with blanks inside and about them, and words longer than a piece."""
    rng = random.Random(11)
    letters = "abé😀 \t\n 12-"
    say = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts = [say(rng.randint(0, 60)) for _ in range(60)] + ["x" * 63 + say(3).strip() + "yz" * 80, "a" * 200 + " " * 150 + "b", "", "ab" * 64 + "c d", None]
    items = [" ", "  ", "\t", " " * 150, "a" * 33, "a" * 96, "a" * 200, "b" * 33, "c d", "yz" * 40, "x" + "yz" * 20, "", None, "bc d"]
    for t in texts[:-1]:
        for _ in range(8):
            at = rng.randint(0, max(len(t) - 1, 0))
            items.append(t[at : at + rng.choice([1, 2, 3, 5, 9, 20, 40, 120])])
    items += [say(rng.randint(1, 6)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "i int, item string")
    want = {(k, i) for k, t in enumerate(texts) for i, x in enumerate(items) if t is not None and x and x in t}
    rows = [(r.id, r.i) for r in within.held(docs, asked, "id", "i").collect()]
    assert set(rows) == want and len(rows) == len(want) > 900
    none = spark.createDataFrame([], "i int, item string")
    assert within.held(docs, none, "id", "i").count() == 0 and within.held(docs.limit(0), asked, "id", "i").count() == 0


def test_containment_is_linear_in_a_text(spark):
    """One text of many words, hundreds of short items: four times the words take about four times as long, not sixteen."""
    items = spark.createDataFrame([(k, f"w{k * 7} w" if k % 2 else f"{k}x") for k in range(300)], "i int, item string")
    seconds = []
    for n in (20_000, 20_000, 80_000):
        text_ = " ".join(f"w{k}" for k in range(n))
        began = time.perf_counter()
        assert within.held(spark.createDataFrame([(1, text_)], "id int, text string"), items, "id", "i").count() == 150
        seconds.append(time.perf_counter() - began)
    assert seconds[2] < 8 * max(seconds[1], 1.0)


def test_codes_lengths_and_spans(spark):
    texts = ["tel 5145551234", "09-91-00", "SECTION 09  91 00", "x09 91 00", "09 91 002", "9 09 91 00"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(text.csi_code(c("t")).alias("k")).collect()
    assert [r.k for r in got] == [None, "09 91 00", "09 91 00", None, None, "09 91 00"]
    forms = {"25'-6 5/8\"": 306.625, "25' 6\"": 306.0, "25'": 300.0, "6 1/2\"": 6.5, "6\"": 6.0, "5'-0 3/0\"": 60.0, "25'-6": None, "": None, "a|b": None, "7 1/2": None}
    got = {r.t: r.v for r in spark.createDataFrame([(t,) for t in forms], "t string").select("t", imperial.inches(c("t")).alias("v")).collect()}
    assert got == forms
    rows = [("ab12c345", ), ("", ), (None, ), ("\uf8f07x8", ), ("12", )]
    got = spark.createDataFrame(rows, "t string").select(text.spans(c("t"), r"\d+").alias("s")).collect()
    assert [None if r.s is None else [tuple(x) for x in r.s] for r in got] == [[("12", 2, 4), ("345", 5, 8)], [], None, [("7", 1, 2), ("8", 3, 4)], [("12", 0, 2)]]


def test_sections_are_cut_at_their_headers(spark):
    book = "x--- Page 1 ---\nTITRE UN\nSection 09 91 00\ncorps un\n12 chiffre\nSection 10 28  13 deux--- Page 2 ---\nsuite--- Page 3 ---\nfin\nSection 09 91 00 encore"
    pages = sections.pages_of(spark.createDataFrame([("d", book)], "doc string, text string"), ["doc"])
    got = {r.code: (r.title, r.pages, r.text) for r in sections.spec_sections(pages, ["doc"]).collect()}
    assert got["10 28 13"][:2] == ("", [1, 2, 3]) and got["10 28 13"][2].endswith("suite\nfin\n")
    assert got["09 91 00"][:2] == ("TITRE UN", [1, 3]) and "chiffre" in got["09 91 00"][2] and "deux" not in got["09 91 00"][2]
    plain = {r.code: r.pages for r in sections.spec_sections(pages, ["doc"], carry=False).collect()}
    assert plain == {"09 91 00": [1, 3]}


def test_code_references_prefer_titles(spark):
    ddl = "doc string, page int, ord int, text string, x0 double, y0 double, size double, bold boolean"
    rows = ["voir 09 91 00 ici", "ab", "PEINTURAGE", "SECTION 09 91 00", "corps de texte long", "et 09-30-13 puis 09 30 13"]
    b = spark.createDataFrame([("d", 1, i, t, 0.0, 10.0 * i, 10.0, False) for i, t in enumerate(rows)], ddl)
    got = {r.code: r for r in books.code_references(b, ["doc"]).collect()}
    assert set(got) == {"09 91 00", "09 30 13"} and got["09 91 00"].title == "PEINTURAGE" and got["09 91 00"].ord == 3 and got["09 91 00"].is_header and got["09 30 13"].division == "09"
    assert "PEINTURAGE | SECTION 09 91 00 | corps de texte long" in got["09 91 00"].context


def test_answers_and_filters(spark):
    ddl = "ord int, id string, plan_id string, name string, block string, floor int, type string, source string, confidence string, notes string, area_pica string"
    rows = [(0, "A-204", "204", "CLASSE", "A", 2, "CLASSE", "plan p.A-150", "HIGH", "n", "80"), (1, "A-205", "205", "CLASSE", "A", 1, "CLASSE", "devis", "MEDIUM", None, None), (2, "B-101", "101", "CORRIDOR", "B", 1, "CORRIDOR", "devis", "HIGH", None, None)]
    e = search.verified_index(spark.createDataFrame(rows, ddl)).cache()
    made_up = spark.createDataFrame([("A-999",)], "id string")
    told = lambda q: search.answer(e, q, made_up).first()
    assert told("local A-999").status == "made_up" and "A-999" in told("local A-999").text and told("zzz qqq").status == "not_found"
    a = told("C'est quoi le local A-204?")
    assert a.status == "found" and "📍 CLASSE (A-204)" in a.text and "Pages: A-150" in a.text and "80 pi²" in a.text
    n = told("Combien de classes dans le bloc A?")
    assert n.n == 2 and n.text.startswith("📊 2 classes(s) dans le Bloc A") and n.text.index("A-205") < n.text.index("A-204")
    assert told("Combien de classes dans le bloc C?").status == "not_found" and told("liste des corridors").n == 1
    ids = lambda **k: [r.id for r in search.ask(e, "classe", **k).collect()]
    assert ids(floor=1) == ["A-205"] and ids(high_only=True) == ["A-204"] and ids(block="B") == []


def test_pages_for_analysis(spark):
    assert keep.spread_pages(12, 5) == [0, 2, 5, 8, 11] and keep.spread_pages(3, 5) == [0, 1, 2] and keep.spread_pages(9, 1) == [0]
    pages = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "number int, path string")
    pick = lambda used: sorted(r.number for r in keep.unused_pages(pages, pages.filter(c("number").isin(used))).collect())
    assert pick([0, 2]) == [1, 3, 4] and pick([0, 1, 2, 3, 4]) == [5] and pick(list(range(6))) == [1, 2, 3]


def test_the_older_index(spark):
    chunks = spark.createDataFrame([("k1", 1, "09 91 00", "Peinture", "latex pour A-101"), ("k2", 2, "08 11 14", "Portes", "cadre du local A101"), ("k3", 3, None, None, "autre tuile armstrong")], "id string, ord int, code string, title string, text string")
    index = spark.createDataFrame([("A-101", ["09 91 00", "08 11 14"])], "room_ref string, codes array<string>")
    ids = lambda df: [(r.id, r.relevance) for r in df.collect()]
    assert ids(books.chunks_of_local("a-101", index, chunks)) == [("k1", 1.0)] and ids(books.chunks_of_local("A-1", index, chunks)) == [("k1", 0.7), ("k2", 0.7)]
    assert books.asked_about("peinture du local A-101") == {"local": "A-101", "type": "peinture", "manufacturer": None, "free_text": "peinture du local A-101"}
    assert ids(books.ask_chunks("local A-101", chunks, index)) == [("k1", 1.0)] and ids(books.ask_chunks("quelle peinture", chunks, index)) == [("k1", 1.0)]
    assert ids(books.ask_chunks("produit Armstrong", chunks, index)) == [("k3", 0.8)] and ids(books.ask_chunks("autre chose", chunks, index)) == [("k3", 0.5)]
    got = {r.material: r for r in books.material_index(chunks).collect()}
    assert got["peinture"].codes == ["09 91 00"] and got["peinture"].samples == ["k1"] and got["plafond"].n_chunks == 1 and got["isolation"].n_chunks == 0
    rooms = spark.createDataFrame([("A-101", "Classe 3"), ("A-9", "zzz")], "id string, name string")
    entries = {r.id: r for r in books.unified_entries(rooms, chunks).collect()}
    assert entries["room_A-101"].codes[0] == "09 51 13" and "Plafonds acoustiques" in entries["room_A-101"].search_text and entries["room_A-9"].codes == [] and "Peinture" in entries["csi_09_91_00"].search_text
    assert [r.room_ref for r in books.fuzzy_key("A-1", index, "room_ref").collect()] == ["A-101"] and books.fuzzy_key("zz", index, "room_ref").count() == 0
    t = spark.createDataFrame([("Local 101A, voir B-204 et gymnase, salle communautaire, 20255 ISO",)], "t string").select(books.local_references(c("t")).alias("r")).first().r
    assert t == ["101A", "B-204", "COMMUNAUTAIRE", "GYMNASE"]
    assert books.validation_rate(spark.createDataFrame([("a", "confirmed"), ("b", "wrong")], "id string, verdict string")).first().rate == 0.5 and books.index_quality(spark.createDataFrame([(0.9,), (0.2,)], "confidence double")).first().high == 1


def test_plans_of_a_room(spark):
    plans = locate.plans_of(spark)
    assert plans.count() == 35 and [r.plan_id for r in plans.filter("preferred").orderBy("page").collect()] == ["A-150", "A-151"]
    seen = plans.filter("page in (3, 8, 9)").select("page", "plan_id", "preferred")
    assert [r.plan_id for r in locate.picked(seen).collect()] == ["A-150"] and locate.picked(seen, every=True).count() == 3 and [r.plan_id for r in locate.picked(seen, "a-1", False).orderBy("page").collect()] == ["A-100", "A-150", "A-151"]
    boxes = spark.createDataFrame([("structure/p.png", {"A-1": 1}), ("p2.png", {"A-1": 2}), ("architecture/p.png", {"A-1": 3, "B": 4}), ("civil/p.png", {"B": 4})], "path string, boxes map<string,int>")
    assert [r.box for r in locate.on_all_plans("A-1", boxes).collect()] == [3, 1, 2]


def test_reports(spark):
    rooms = spark.createDataFrame([("A-1", "CLASSE"), ("A-2", "WC")], "id string, name string")
    parts = spark.createDataFrame([(0, "t", "local A-1", False)], "pord int, title string, content string, sub boolean")
    book = spark.createDataFrame([("09 91 00", "peinture des classes")], "code string, text string")
    out = reports.cross_validation(check.by_name(rooms, parts), check.by_type(rooms, book)).first().text
    assert "| Rate | 100.0% |" in out and "| A-1 | CLASSE | t | direct | 0.9 |" in out and "## Missing" not in out
    ddl = "ord int, id string, name string, block string, floor int, type string"
    both = check.against_truth(spark.createDataFrame([(0, "A", "CLASSE", "A", 1, None)], ddl), spark.createDataFrame([(0, "A", "WC", "A", 1, "WC"), (1, "B", "WC", "A", 1, "WC")], ddl))
    out = reports.truth(check.truth_metrics(both), both).first().text
    assert "Recall: 50.0%" in out and "A.name" in out and out.endswith("B")
    rows = spark.createDataFrame([("A-1", "CLASSE", "A-1", "CLASSE"), ("A-2", "WC", None, None)], "gt_id string, gt_name string, vision_id string, vision_name string")
    out = reports.verification(check.verification(rows), check.verified_rows(rows)).first().text
    assert "| Reliability | 50.0% |" in out and "not reliable" in out and "| A-2 | WC |" in out
    assert "- **rooms:** 3" in reports.run_summary(spark.createDataFrame([(0, "rooms", 3)], "ord int, name string, value long"), "a.json", 1.5).first().text


def test_sinks(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(at)
    old = files.replace_table(spark, spark.read.parquet(at).filter("id > 0"), at)
    newer = files.replace_table(spark, spark.range(9), at)
    assert spark.read.parquet(at).count() == 9 and spark.read.parquet(old).count() == 3 and spark.read.parquet(newer).count() == 2
    run = files.write_run(spark.range(2), f"file://{tmp_path}/runs", "r1")
    assert spark.read.json(run).count() == 2 and spark.read.json(f"file://{tmp_path}/runs").first().run_ts == "r1"
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        files.write_run(spark.range(2), f"file://{tmp_path}/runs", "r1")


def test_totals_of_nested_pages(spark):
    rows = [("a", [{"text_blocks": [{"text": "x"}, {"text": "y"}], "drawings": None}, {"text_blocks": None, "drawings": [{"fill": "f"}]}]), (None, None), ("c", [])]
    df = spark.createDataFrame(rows, "source string, pages array<struct<text_blocks: array<struct<text: string>>, drawings: array<struct<fill: string>>>>")
    assert [tuple(r) for r in files.totals(df).collect()] == [("a", 2, 2, 1), ("", 0, 0, 0), ("c", 0, 0, 0)]


def test_strata_are_counted_once(spark):
    df = spark.createDataFrame([(None if i % 10 == 0 else f"s{i % 3}", i) for i in range(100)], "s string, id int")
    got = keep.stratified(df, "s", "id", 20, 3)
    assert {r.s: r.n for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()} == {None: 3, "s0": 6, "s1": 6, "s2": 6}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
