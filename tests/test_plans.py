"""The pipelines on small drawings, books and questions."""

import pytest
from pyspark.sql import functions as F

from atelier.plans import check, detect, search
from atelier.streaming import streams

c = F.col
BLOCKS = "doc string, page int, ord int, text string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean"


def blocks(spark, rows):
    return spark.createDataFrame([("d", 12, i, t, float(x), float(y), float(x + 40), float(y + 10), 10.0, False) for i, (t, x, y) in enumerate(rows)], BLOCKS)


def test_rooms_take_the_name_above(spark):
    rows = []
    for i, (number, name) in enumerate([("101", "CLASSE"), ("102", "BUREAU"), ("103", "S.D.B."), ("A-204", "CORRIDOR")]):
        rows += [(name, 1000 * i, 100), (number, 1000 * i, 130)]
    rows += [("some text", 5, 5), ("999", 9000, 9000), ("HALL", 0, 165)]
    got = {r.number: r for r in detect.rooms(blocks(spark, rows)).collect()}
    assert {k: r.name for k, r in got.items()} == {"101": "CLASSE", "102": "BUREAU", "103": "S.D.B.", "A-204": "CORRIDOR", "999": None}
    assert got["101"].confidence == 1.0 and got["101"].box.x0 == 0.0 and got["101"].box.y1 == 160.0
    counts = detect.room_counts(detect.rooms(blocks(spark, rows))).first()
    assert (counts.n_rooms, counts.n_named) == (5, 4)


def test_doors_from_arcs_and_labels(spark):
    ddl = "doc string, page int, ord int, sx double, sy double, ex double, ey double, cx double, cy double, c1x double, c1y double, c2x double, c2y double"
    curves = spark.createDataFrame([("d", 12, 0, 100.0, 0.0, 0.0, 100.0, 0.0, 0.0, None, None, None, None), ("d", 12, 1, 0.0, 0.0, 1.0, 1.0, None, None, None, None, None, None)], ddl)
    lines = spark.createDataFrame([("d", 12, 4, 500.0, 500.0, 101.0, 1.0), ("d", 12, 2, 0.0, 103.0, 9.0, 9.0)], "doc string, page int, ord int, sx double, sy double, ex double, ey double")
    labels = blocks(spark, [("P-1", -10, 5), ("P-2", 300, 300), ("P-2", 310, 300), ("D-3", 600, 600)])
    got = detect.doors(curves, lines, labels).orderBy("id").collect()
    assert [(r.id, r.method, r.number) for r in got] == [("door-001", "arc", "P-01"), ("door-002", "label", "P-02"), ("door-003", "label", "P-03")]
    assert got[0].angle == pytest.approx(90) and got[0].confidence == pytest.approx(1.0) and got[0].direction == "left" and got[1].confidence == pytest.approx(0.6)


def test_lengths(spark):
    got = detect.lengths(blocks(spark, [("25'-6\"", 0, 0), ("25'-6\"", 0, 0), ("by 8'-0\" and 6\"", 50, 0), ("no", 9, 9)])).orderBy("id").collect()
    assert [(r.id, r.value_text, r.value_inches, r.embedded) for r in got] == [("dim-001", "25'-6\"", 306.0, False), ("dim-002", "8'-0\"", 96.0, True), ("dim-003", '6"', 6.0, True)]
    assert got[0].confidence == 0.95 and got[1].confidence == 0.9


def test_page_classes_and_choice(spark):
    pages = spark.createDataFrame([("d", 1, "légende"), ("d", 2, "plan 2e étage 101 102"), ("d", 3, "niveau rdc"), ("d", 4, "détail"), ("d", 5, "xyz")], "doc string, page int, text string")
    assert {r.type: r.n for r in detect.class_counts(detect.classified(pages)).collect()} == {"LEGEND": 1, "PLAN": 2, "DETAIL": 1, "ELEVATION": 0, "OTHER": 1}
    assert sorted(r.page for r in detect.chosen_pages(pages, ["doc"], 3).collect()) == [1, 2, 3]


ROOMS = "ord int, id string, plan_id string, name string, block string, floor int, type string, source string, confidence string, notes string, area_pica string"
GOLD = [
    (0, "A-204", "204", "CLASSE", "A", 2, "CLASSE", "plan construction p.A-150", "HIGH", None, None), (1, "A-110", "110", "CHAUFFERIE", "A", 1, "TECHNIQUE", "plan construction p.A-150", "HIGH", None, "300"),
    (2, "A-205", "205", "CLASSE", "A", 2, "CLASSE", "devis", "MEDIUM", None, None), (3, "B-101", "101", "CORRIDOR", "B", 1, "CORRIDOR", "p.A-900", "HIGH", None, None),
    (4, "C-151", "151", "GYMNASE", "C", 1, "GYMNASE", "vision", "HIGH", None, None), (5, "B-138", "138", "SERVICE DE GARDE", "B", 1, "SERVICE", "devis", "HIGH", None, None), (6, "X-1", "1", "CLASSE", "A", 1, "CLASSE", None, "HIGH", None, None),
]


def test_questions_on_verified_rooms(spark):
    entries = search.verified_index(spark.createDataFrame(GOLD, ROOMS)).cache()
    made_up = search.invented(spark.createDataFrame([("A-999",), ("A-204",)], "id string"), entries)
    ask = lambda q: [r.id for r in search.ask(entries, q, made_up).collect()]
    assert entries.count() == 6 and [r.id for r in made_up.collect()] == ["A-999"]
    assert ask("C'est quoi le local A-204?")[0] == "A-204" and ask("Où est la chaufferie?")[0] == "A-110" and ask("corridor 101")[0] == "B-101"
    assert ask("Où est le gymnase?")[0] == "C-151" and ask("service de garde")[0] == "B-138"
    assert ask("Combien de classes dans le bloc A?") == ["A-204", "A-205"] and ask("Combien de licornes dans le bloc A?") == []
    assert ask("local A-999") == [] and ask("zzz qqq") == []
    row = entries.filter("id = 'A-204'").first()
    assert row.source_pages == ["A-150"] and row.source_document == "Plans construction" and "salle de classe" in row.search_text
    assert {r.key: r.id for r in search.verified_lookup(entries).collect()}["classe_204"] == "A-204"
    counts = search.verified_counts(entries).collect()
    assert {r.confidence: r.n for r in counts if r.confidence} == {"HIGH": 5, "MEDIUM": 1}


def test_search_over_all_kinds(spark):
    rooms = spark.createDataFrame([("r1", "CLASSE", "101", 0.9, 1), ("r2", "BUREAU", "102", 0.4, 2)], "id string, name string, number string, confidence double, page int")
    doors = spark.createDataFrame([("d1", "P-01", 0.8, 1)], "id string, number string, confidence double, page int")
    symbols = spark.createDataFrame([("WC", "toilette", "plumbing", 3)], "symbol string, meaning string, category string, page int")
    lengths = spark.createDataFrame([("l1", "8'-0\"", "north wall", 0.7, 2)], "id string, value_text string, context string, confidence double, page int")
    entries = search.index(rooms, doors, None, lengths, symbols)
    assert {r.type: r.n for r in search.index_counts(entries).collect()} == {"room": 2, "door": 1, "dimension": 1, "symbol": 1}
    assert search.search(entries, "classe 101").first().id == "r1" and search.search(entries, "porte").first().id == "d1"
    assert search.search(entries, "room", least=0.5).count() == 1 and search.search(entries, "room", page=2).first().id == "r2" and search.search(entries, "wc", kind="symbol").count() == 1
    assert {r.line for r in search.shown(search.search(entries, "bureau")).collect()} >= {"Room 102 BUREAU (page 2)"}
    assert search.entry_lengths(entries).filter("type = 'dimension'").first().parsed.total_inches == 96.0


def test_drawings_against_a_specification(spark):
    rooms = spark.createDataFrame([(i, f"A-10{i}", n) for i, n in enumerate(["CLASSE", "CLASSE", "WC", "GYMNASE", "LOCAL X"])], "ord int, id string, name string")
    book = spark.createDataFrame([("09 91 00", "peinture des salles de classe et corridors"), ("09 30 13", "céramique"), ("09 65 19", "sols")], "code string, text string")
    got = {r.type: r for r in check.by_type(rooms, book).collect()}
    assert got["CLASSE"].n_rooms == 2 and got["CLASSE"].codes == ["09 65 19", "09 91 00"] and got["CLASSE"].confidence == 0.85 and got["CLASSE"].ceiling_missing and not got["CLASSE"].floor_missing
    assert got["WC"].codes == ["09 30 13", "09 91 00"] and got["WC"].confidence == 0.7 and got["AUTRE"].status == "not in specification" and got["CORRIDOR"].status == "not in drawings"
    parts = spark.createDataFrame([(0, "Local A-100", "finis", False), (1, "toilettes", "le WC est carrelé", False), (2, "sub", "A-103 sport", True)], "pord int, title string, content string, sub boolean")
    ways = {r.id: (r.way, r.confidence, r.section) for r in check.by_name(rooms, parts).collect()}
    assert ways == {"A-100": ("direct", 0.9, "Local A-100"), "A-101": ("inferred", 0.7, "09 21 16, 09 22 16, 09 51 13"), "A-102": ("name", 0.6, "toilettes"), "A-103": ("direct", 0.9, "sub"), "A-104": ("inferred", 0.7, "09 21 16")}
    odd = spark.createDataFrame([("B-1", "CLASSE", None), ("A-204", "X", None), (None, None, "PISCINE"), ("", "", ""), ("a-9", "CLASSE", None)], "id string, name string, type string")
    book2 = spark.createDataFrame([(5, "CLASSES et corridors", "voir A-204A, puis CLASSES", False), (3, "annexe", "locaux B-12 et classes", True), (4, "titre a-9", "", False)], "pord int, title string, content string, sub boolean")
    got = [(r.id, r.way, r.section) for r in check.by_name(odd, book2).collect()]
    assert sorted(got, key=str) == sorted([("B-1", "direct", "annexe"), ("A-204", "direct", "CLASSES et corridors"), (None, "generic", None), ("", "inferred", "09 21 16"), ("a-9", "direct", "titre a-9")], key=str)
    t = check.name_match_totals(check.by_name(odd, book2)).first()
    assert (t.total_rooms, t.matched_rooms, t.match_rate) == (5, 5, 1.0)
    plan = spark.createDataFrame([("A-101", "25'-0\"", "30'-0\""), ("A-102", "8'-0\"", "9'-0\""), ("A-103", "", None)], "id string, width string, length string")
    spec = spark.createDataFrame([("A-101: 25'-0\" x 30'-0\"\nA-102 de 10'-0\" x 9'-0\"",)], "text string")
    assert [r.id for r in check.length_mismatches(plan, spec).collect()] == ["A-102"]


FOUND = "ord int, id string, name string, block string, floor int, type string"


def test_against_the_truth(spark):
    found = spark.createDataFrame([(0, "A-1", "CLASSE 1", "A", 1, None), (1, "A-2", "TOILETTES", "A", 0, ""), (2, "A-2", "W.C.", "A", None, ""), (3, "A-9", "HALL", None, None, None)], FOUND)
    truth = spark.createDataFrame([(0, "A-1", "CLASSE", "A", 1, "CLASSE"), (1, "A-2", "TOILETTE", "A", 0, "WC"), (2, "A-3", "HALL", "A", 1, "X")], FOUND)
    both = check.against_truth(found, truth)
    got = {r.id: r for r in both.collect()}
    assert {k: r.status for k, r in got.items()} == {"A-1": "matched", "A-2": "matched", "A-9": "extra", "A-3": "missing"}
    assert got["A-1"].score == 1.0 and got["A-2"].name_ok and got["A-2"].floor_ok and got["A-2"].score == pytest.approx(0.8)
    m = check.truth_metrics(both).first()
    assert (m.matched, m.found, m.true, m.perfect) == (2, 3, 3, 1) and m.f1 == pytest.approx(2 / 3)
    assert check.truth_metrics(both.limit(0)).first().f1 == 0.0
    diff = {r.type: (r.found, r.expected) for r in check.type_differences(found, spark.createDataFrame([("CLASSE", 2), ("WC", 1)], "type string, expected int")).collect()}
    assert diff["CLASSE"] == (1, 2) and diff["AUTRE"][1] == 0


def test_confidence_alerts_and_contradictions(spark):
    ddl = "id string, name string, block string, floor int, source_pages array<int>, primary_source int, extraction_method string, extraction_notes string, extra string"
    rows = [("A", "CLASSE", "A", 1, [40, 12, 3], None, "table", None, "kept"), ("B", None, None, 0, [], None, None, "ambigu", None), ("C", "LOCAL", "B", 2, [7], 7, None, None, None), ("C", "SALLE", "B", 2, [31, 35], 0, "ocr", None, None)]
    rooms = check.with_confidence(spark.createDataFrame(rows, ddl))
    assert [(r.id, r.confidence, r.primary_source, r.extra) for r in rooms.collect()] == [("A", 0.9, 3, "kept"), ("B", 0.144, None, None), ("C", 0.595, 7, None), ("C", 0.722, 31, None)]
    s = check.confidence_summary(rooms).first()
    assert (s.high, s.medium, s.low) == (1, 2, 1)
    told = {(r.severity, r.type, r.item) for r in check.alerts(rooms).collect()}
    assert {("ERROR", "VERY_LOW_CONFIDENCE", "B"), ("ERROR", "NO_SOURCE_PAGES", "B"), ("WARNING", "AMBIGUOUS_EXTRACTION", "B"), ("WARNING", "GENERIC_NAME", "B"), ("WARNING", "SINGLE_SOURCE", "C"), ("WARNING", "GENERIC_NAME", "C"), ("WARNING", "LOW_CONFIDENCE", "C")} == told
    whole = check.quality_alerts(rooms, spark.createDataFrame([("M", "X", 0.5), (None, "Y", None)], "manufacturer string, model string, confidence double"))
    assert {(r.severity, r.type, r.item) for r in whole.collect()} == told | {("ERROR", "CONTRADICTORY_NAME", "C"), ("INFO", "EXTRACTION_SUMMARY", "GLOBAL"), ("WARNING", "LOW_PRODUCT_CONFIDENCE", "M_X"), ("INFO", "PRODUCT_SUMMARY", "GLOBAL")}
    assert {r.severity: r.n for r in check.severity_totals(whole).collect()} == {"ERROR": 3, "WARNING": 6, "INFO": 2}
    assert [r.type for r in check.quality_alerts(None).collect()] == ["FILE_NOT_FOUND"]
    q = check.room_quality(rooms).first()
    assert (q.total_rooms, q.with_confidence, q.low_confidence, q.missing_pages, q.single_source, q.methods) == (4, 4, 1, 1, 1, {"ocr": 1, "table": 1, "unknown": 2}) and check.room_quality(rooms.limit(0)).first().total_rooms == 0
    assert [r.message for r in check.contradictions(rooms).collect()] == ["names: LOCAL, SALLE"]
    assert "| C |" in check.markdown(check.contradictions(rooms).select("item", "message"), ["item"]).first().markdown


def test_rules(spark):
    seen = [("R1", "CONFIRMED")] * 2 + [("R2", "CONFIRMED"), ("R2", "CONTRADICTED")] + [("R3", "VARIATION"), ("R3", "NOT_APPLICABLE")]
    rules = check.rule_confidences(spark.createDataFrame(seen, "rule_id string, status string")).cache()
    got = {r.rule_id: (r.confidence, r.stable) for r in rules.collect()}
    assert got == {"R1": (1.0, True), "R2": (0.0, False), "R3": (0.5, False)}
    gate = check.rule_gate(rules).first()
    assert gate.score == pytest.approx(0.5) and not gate.final and check.rule_gate(rules.filter("rule_id = 'R1'")).first().final and not check.rule_gate(rules.limit(0), 0.0).first().final
    cand = spark.createDataFrame([("R1", None), ("R2", "x")], "rule_id string, description string")
    assert [(r.rule_id, r.description) for r in check.stable_rules(cand, rules).collect()] == [("R1", "no description")]
    assert {r.issue for r in check.rule_issues(rules, 1).collect()} == {"contradicted: R2", "low confidence: R2", "too few pages: two at least"}
    assert [r.recommendation for r in check.recommendations(rules).orderBy("ord").collect()] == ["review unstable rules: R2, R3", "look into contradicted rules", "validate on more pages"]
    assert [r.recommendation for r in check.recommendations(rules.filter("rule_id = 'R1'")).collect()] == ["the guide is stable and can be made final"]
    ids = spark.createDataFrame([("see R002, R001 and R002",), ("none",)], "t string").select(check.rule_ids(c("t")).alias("i")).collect()
    assert [r.i for r in ids] == [["R001", "R002"], ["R001", "R002", "R003"]]
    stable = check.stable_rules(spark.createDataFrame([("R1", "p", None)], "rule_id string, pattern string, description string"), rules).withColumn("n", F.lit(2))
    assert "### R1: p" in check.final_guide(stable, 0.9).first().guide and "- R1: x (confidence: 0.5)" in check.provisional_guide(spark.createDataFrame([("R1", "x", 0.5)], "rule_id string, description string, confidence double"), "all").first().guide
    rows = [("A-1", "CLASSE", " a-1", "classe 2"), ("A-2", "WC", "B-2", "HALL"), ("A-3", "WC", "A-3", None), ("A-4", "WC", None, "")]
    v = check.verification(spark.createDataFrame(rows, "gt_id string, gt_name string, vision_id string, vision_name string"), 8).first()
    assert (v.n, v.ids, v.names, v.full, v.reliability, v.sample) == (4, 2, 1, 1, 25.0, 50.0)


def test_streams(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(f"file://{tmp_path}/in")
    stream = streams.windowed(spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in"))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: {(r.start, r.event_type): r.n for r in df.collect()}
    assert key(spark.table("windows")) == key(streams.windowed(events))
    assert streams.sessions(events).agg(F.sum("n")).first()[0] == events.count()
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "a.json").write_text('{"source": "a", "page": 1, "texts": [{"text": "101", "bbox": {"x0": 0, "y0": 0, "x1": 9, "y1": 9}}]}')
    streams.detect_stream(spark, f"file://{tmp_path}/land", f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    assert [r.number for r in spark.read.parquet(f"file://{tmp_path}/out").collect()] == ["101"]


def test_rooms_on_pages(spark):
    from atelier.plans import locate

    spans = blocks(spark, [("A-101", 100, 100), ("CLASSE", 100, 130), ("102", 500, 500), ("CLASSE", 2000, 2000), ("B.201", 900, 900)])
    rooms = spark.createDataFrame([("A-101", "classe", "d", 12, 2.0), ("A-102", "corridor", "d", 12, 1.0), ("A-B-201", "gym", "d", 12, 1.0), ("A-999", "x", "d", 12, 1.0)], "id string, name string, doc string, page int, scale double")
    got = {r.id: (r.named, r.box.x0, r.box.y1) for r in locate.on_page(rooms, spans).collect()}
    assert got == {"A-101": (True, 170.0, 310.0), "A-102": (False, 470.0, 540.0), "A-B-201": (False, 870.0, 940.0)}
    said = [(3, 1, "A-102", 80.0, 10.0, 10.0, 20.0, 20.0), (3, 2, "102", 90.0, 500.0, 500.0, 510.0, 510.0), (3, 3, "102", 90.0, 700.0, 700.0, 710.0, 710.0), (3, 4, "101", 10.0, 1.0, 1.0, 2.0, 2.0)]
    ddl = "page int, ord int, text string, conf double, x0 double, y0 double, x1 double, y1 double"
    asked = spark.createDataFrame([("A-102", 3)], "id string, page int")
    for rows in (said, said[::-1]):  # the first of two equally sure words, whichever comes first
        assert [r.box.x0 for r in locate.from_words(spark.createDataFrame(rows, ddl).coalesce(1), asked, 1000.0, 800.0).collect()] == [465.0]
    words = spark.createDataFrame(said, ddl)
    boxes = {r.id: r for r in locate.from_words(words, spark.createDataFrame([("A-102", 3), ("A-101", 3)], "id string, page int"), 1000.0, 800.0).collect()}
    assert boxes["A-102"].confidence == 0.9 and boxes["A-102"].box.x0 == 465.0 and boxes["A-101"].fallback and boxes["A-101"].box.x1 == 900.0
    plans = spark.createDataFrame([(12, "A-150", "RDC", True)], "page int, plan_id string, description string, preferred boolean")
    assert [(r.page, r.plan_id) for r in locate.sightings("A-101", spans, plans).collect()] == [(12, "A-150")]
    floors = spark.createDataFrame([("A", 1, 8), ("A", 1, 8), ("A", 1, 9), ("B", 1, 5), ("B", 1, 4)], "block string, floor int, page int")
    assert {(r.block, r.page) for r in locate.floor_pages(floors).collect()} == {("A", 8), ("B", 4)}
    many = spark.createDataFrame([(f"A-{i}", "A" if i < 90 else "B") for i in range(100)], "id string, block string")
    picked = locate.sampled_rooms(many, many.filter("id <> 'A-0'")).collect()
    assert len(picked) == 29 and sum(r.block == "B" for r in picked) >= 3 and all(r.id != "A-0" for r in picked)
    assert [r[0] for r in spark.createDataFrame([("Arch/a.png",), ("a.png",)], "p string").select(locate.discipline(c("p"))).collect()] == ["arch", "autre"]


def test_books(spark):
    from atelier.plans import books

    ddl = "doc string, page int, ord int, text string, x0 double, y0 double, size double, bold boolean"
    rows = [("SECTION 09 91 00", 14.0, True), ("Peinturage des locaux", 10.0, False), ("Sous-titre", 12.0, False), ("voir local 101 et classe 204, plan B-205", 10.0, False), ("norme CSA-A371 et ASTM C979", 10.0, False), ("isolation du local 305", 10.0, False)]
    b = spark.createDataFrame([("d", 1, i, t, 0.0, 10.0 * i, s, bold) for i, (t, s, bold) in enumerate(rows)], ddl)
    heads = books.titled_sections(b, ["doc"]).orderBy("section").collect()
    assert [(h.title, h.level, h.code) for h in heads] == [("SECTION 09 91 00", 1, "09 91 00"), ("Sous-titre", 2, None)] and heads[0].content == "Peinturage des locaux" and heads[1].parent == heads[0].section
    assert {r.room_ref for r in books.room_references(b, ["doc"]).collect()} == {"101", "204", "B-205", "305"}
    assert {r.room_ref for r in books.room_references(b, ["doc"], whole_words=False).collect()} == {"101", "204", "B-205"}
    h = spark.createDataFrame([("d", 0, 3), ("d", 1, 7)], "doc string, ord int, page int")
    assert [r.end_page for r in books.section_ends(h, ["doc"], 20).orderBy("ord").collect()] == [7, 20]
    assert spark.createDataFrame([("Devis\n12\nbody\nPage 3 of 9",)], "t string").select(books.clean_page(c("t"), ["Devis"])).first()[0] == "body"
    chunks = spark.createDataFrame([("k1", "peinture du A-101", "09 91 00", "Peinture"), ("k2", "autre", "09 91 00", "Peinture"), ("k3", "local 102", "09 30 13", "Céramique")], "id string, text string, code string, title string")
    rooms = spark.createDataFrame([("A-101", "CLASSE"), ("A-102", "WC")], "id string, type string")
    related = books.chunk_rooms(chunks, rooms)
    assert {(r.chunk_id, r.room_id) for r in related.collect()} == {("k1", "A-101"), ("k3", "A-102")}
    need = spark.createDataFrame([("CLASSE", "09 91 00")], "type string, code string")
    assert [(r.chunk_id, r.room_id) for r in books.required_chunks(rooms, chunks, need, related).collect()] == [("k2", "A-101")]
    assert {(r.code, r.n_chunks, tuple(r.rooms)) for r in books.section_index(chunks, related).collect()} == {("09 91 00", 2, ("A-101",)), ("09 30 13", 1, ("A-102",))}
    assert {(r.room_ref, tuple(r.codes)) for r in books.local_index(spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"])], "code string, locals array<string>")).collect()} == {("a", ("1", "2")), ("b", ("1",))}
    photos = spark.createDataFrame([("p1", "local 101", None, None), ("p2", None, "A-102", None), ("p3", "nothing", None, 50.0), ("p4", None, None, None), ("p5", None, None, 900.0)], "photo_id string, notes string, seen string, metres double")
    links = spark.createDataFrame([("p4", "A-101")], "photo_id string, room_id string")
    assert {(r.photo_id, r.room_id, r.method) for r in books.photos(photos, rooms, links).collect()} == {("p1", "A-101", "notes"), ("p2", "A-102", "seen"), ("p3", None, "site"), ("p4", "A-101", "manual"), ("p5", None, "none")}
    log = spark.createDataFrame([("d", "intro\n## 2025-01-02 visite\n- Local: A-101\n- Note: mur fini\n## 2025-01-03\nType: photo\n")], "doc string, text string")
    assert [(r.day, r.room, r.kind, r.note) for r in books.activities(log).orderBy("n").collect()] == [("2025-01-02", "A-101", None, "mur fini"), ("2025-01-03", None, "photo", None)]
    v = books.validated(spark.createDataFrame([("A", 0.5), ("B", 0.5), ("C", 0.5)], "id string, confidence double"), spark.createDataFrame([("A", "confirmed", None), ("B", "corrected", "B2")], "id string, verdict string, new_id string"))
    assert {(r.id, r.confidence, r.original_id) for r in v.collect()} == {("A", 0.95, None), ("B2", 0.9, "B"), ("C", 0.5, None)}
    assert [r[0] for r in spark.createDataFrame([("A-101",), ("A-150",), ("12",)], "r string").select(books.valid_local(c("r"))).collect()] == [True, False, False]
