"""Values of the column functions, and order-dependent operators against small plain specifications."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from atelier.functions import geometry, imperial, scores, text
from atelier.operators import keep, near, sections
from atelier.sources import files

c = F.col


def values(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


@pytest.mark.parametrize(
    ("said", "inches"),
    [("25'-6\"", 306), ("12'-0\"", 144), ("8'-0\"", 96), ("12'-6 1/2\"", 150.5), ("10'-3 1/4\"", 123.25), ("5'-0 3/4\"", 60.75), ("8'-6 1/8\"", 102.125), ("0'-6\"", 6), ("100'-0\"", 1200), ("25'", 300), ("6 5/8\"", 6.625), ("6\"", 6), ("1 1/0\"", 1), ("wall", None), ("25'-6\" x 30'-0\"", None), (" 8'-0\" ", 96), ("", None)],
)
def test_imperial_lengths(spark, said, inches):
    assert values(spark, [(said,)], "t string", imperial.inches(c("t"))) == [(inches,)]


def test_lengths_inside_texts(spark):
    ((got,),) = values(spark, [("walls 25'-6 5/8\" and 8' by 6\" or 7'-2\"",)], "t string", imperial.within(c("t")))
    assert [m.match for m in got] == ["25'-6 5/8\"", "8'", '6"', "7'-2\""] and all("walls 25'-6 5/8\" and 8' by 6\" or 7'-2\""[m.start : m.stop] == m.match for m in got)


def test_room_numbers_names_and_doors(spark):
    rows = [("101",), ("A-101",), ("B204",), ("101A",), ("B204A",), ("12",), ("CLASSE",), ("mécanique",), ("P-1a",), ("porte 12",), ("x",), (None,)]
    got = values(spark, rows, "t string", "t", text.room_number_confidence(c("t")), text.is_room_name(c("t")), text.is_door_label(c("t")), text.door_number(c("t")))
    assert {t: n for t, n, *_ in got} == {"101": 1.0, "A-101": 1.0, "B204": 1.0, "101A": 0.95, "B204A": 0.95, "12": 0.8, "CLASSE": None, "mécanique": None, "P-1a": None, "porte 12": None, "x": None, None: None}
    assert {t for t, _, name, *_ in got if name} == {"CLASSE", "mécanique"} and {t for t, *_, door, _ in got if door} == {"P-1a", "porte 12"}
    assert {t: d for t, *_, d in got}["P-1a"] == "P-01A" and values(spark, [("1234",)], "t string", text.door_number(c("t"))) == [("P-1234",)]


def test_names_and_types(spark):
    rows = [("TOILETTES", "WC"), ("local de classe 3", "CLASSE"), ("dépôt", "RANGEMENT"), ("Salle mécanique", "TECHNIQUE"), ("xyz", "AUTRE")]
    assert [r[0] for r in values(spark, rows, "t string, w string", text.room_type(c("t")))] == [w for _, w in rows]
    assert values(spark, [("TOILETTES",)], "t string", text.room_name(c("t"))) == [("WCS",)]
    assert values(spark, [("a--b__c",), (None,)], "t string", text.compared(c("t"))) == [("A  B  C",), ("",)]
    assert values(spark, [(" Été à l'école / n° 1 ",)], "t string", text.file_name(c("t"))) == [("Été_à_l_école_n_1",)]
    assert values(spark, [("plan construction p.A-150, p.A-900; devis",)], "t string", text.source_document(c("t")), text.source_pages(c("t"))) == [("Plans construction + Devis architecture", ["A-150", "A-900"])]
    assert values(spark, [("Section 09 91 00 x",), ("no",)], "t string", text.csi_code(c("t"))) == [("09 91 00",), (None,)]


def test_questions():
    assert text.asked_room("C'est quoi le local A-204?") == "A-204" and text.asked_room("corridor 101") == "101" and text.asked_room("le gymnase") is None
    assert text.asked_total("Combien de classes dans le bloc A?") == {"kind": "count", "noun": "classes", "type": "CLASSE", "block": "A"}
    assert text.asked_total("liste des bureaux")["type"] == "BUREAU" and text.asked_total("où est la chaufferie") is None
    assert "couloir" in text.terms("corridor") and "où" not in text.gold_terms("où est le gymnase?") and {"gym", "gymnase"} <= set(text.gold_terms("où est le gymnase?"))


def test_spans_equal_the_plain_search(spark):
    import re

    rnd = random.Random(1)
    rows = [("".join(rnd.choice("ab1 2\n") for _ in range(rnd.randint(0, 40))),) for _ in range(300)]
    for t, got in values(spark, rows, "t string", "t", text.spans(c("t"), r"\d+")):
        assert [(m.match, m.start, m.stop) for m in got] == [(m[0], m.start(), m.end()) for m in re.finditer(r"\d+", t)]


def test_found_equals_the_plain_search_with_groups(spark):
    import re

    rnd = random.Random(2)
    marks = "\uf8f0\uf8f1"
    rows = [("".join(rnd.choice("ab1 2-é\U0001f600" + (marks if k % 2 else "")) for _ in range(rnd.choice((0, 5, 40, 900)))),) for k in range(200)]
    pattern = r"([ab])(\d)?(?:-([^ ]))?"
    for t, got in values(spark, rows, "t string", "t", text.found(c("t"), pattern, 3)):
        want = [(m[0], m.start(), m.end(), [g or "" for g in m.groups()]) for m in re.finditer(pattern, t)]
        # places are in characters, as the text's length is
        assert [(m.match, m.start, m.stop, m.groups) for m in got] == want, t
    empty = values(spark, [("baab",), ("",), (None,)], "t string", text.found(c("t"), "a*"))
    assert [None if m is None else [(x.match, x.start) for x in m] for (m,) in empty] == [[("aa", 1)], [], None]
    many = values(spark, [("a" * 20_000,)], "t string", text.found(c("t"), "a"))[0][0]
    assert [m.start for m in many] == list(range(20_000))


def test_matches_of_several_patterns(spark):
    got = values(spark, [("a1 b2",), (None,)], "t string", text.matches(c("t"), [(3, r"([a-z])(\d)", 2), (5, r"\d", 0)]))
    assert [(m.rank, m.match, m.start, m.groups) for m in got[0][0]] == [(3, "a1", 0, ["a", "1"]), (3, "b2", 3, ["b", "2"]), (5, "1", 1, []), (5, "2", 4, [])]
    assert got[1][0] is None


def test_pages(spark):
    rows = [("légende des symboles",), ("plan du 2e étage " + " ".join(str(100 + i) for i in range(100)),), ("détail coupe",), ("élévation façade",), ("",), (None,)]
    s = scores.page_scores(c("t"))
    got = values(spark, rows, "t string", scores.page_class(s), s["PLAN"])
    assert [k for k, _ in got] == ["LEGEND", "PLAN", "DETAIL", "ELEVATION", "OTHER", "OTHER"] and got[1][1] == 28


def test_room_confidence_and_ratios(spark):
    t, f = F.lit(True), F.lit(False)
    got = values(spark, [(0, None), (1, None), (2, None), (3, "manual"), (3, "odd")], "n int, m string", scores.room_confidence(c("m"), c("n"), t, t, t), scores.room_confidence(c("m"), c("n"), f, f, f))
    assert [g[0] for g in got] == [0.18, 0.595, 0.68, 1.0, 0.5] and got[0][1] == 0.108
    assert values(spark, [(1.0, 0.0)], "a double, b double", scores.ratio(c("a"), c("b"))) == [(0.0,)]
    assert values(spark, [([40, 31, 35],), ([50, 12, 7],), ([],)], "p array<int>", scores.primary_page(c("p"))) == [(31,), (7,), (None,)]


def test_arcs(spark):
    ends = [c(k) for k in ("sx", "sy", "ex", "ey", "cx", "cy", "c1x", "c1y", "c2x", "c2y")]
    ddl = ", ".join(f"{k} double" for k in ("sx", "sy", "ex", "ey", "cx", "cy", "c1x", "c1y", "c2x", "c2y"))
    rows = [(100.0, 0.0, 0.0, 100.0, 0.0, 0.0, None, None, None, None), (100.0, 0.0, 0.0, 100.0, None, None, 100.0, 55.0, 55.0, 100.0), (0.0, 0.0, 0.0, 0.0, None, None, None, None, None, None), (0.0, 0.0, 5.0, 0.0, None, None, None, None, None, None)]
    got = values(spark, rows, ddl, geometry.arc_angle(*ends), geometry.arc_radius(*ends[:4]), geometry.swing(*ends[:6]))
    assert got[0] == (pytest.approx(90), pytest.approx(100), "left") and got[1][0] == 90.0 and got[2][0] == 0.0 and got[3][0] == 90.0
    ((m,),) = values(spark, [(45.0, 0.0, 45.0, 1.0)], "a double, b double, d double, e double", geometry.haversine(c("a"), c("b"), c("d"), c("e")))
    assert m == pytest.approx(2 * 6371000 * math.asin(math.cos(math.radians(45)) * math.sin(math.radians(0.5))), rel=1e-9)


def test_near_joins_equal_every_pair(spark):
    rnd = random.Random(4)
    a = [("p", i, rnd.uniform(-300, 300), rnd.uniform(-300, 300)) for i in range(80)]
    b = [("p", i, rnd.uniform(-300, 300), rnd.uniform(-300, 300)) for i in range(80)]
    left, right = spark.createDataFrame(a, "page string, ord long, x double, y double"), spark.createDataFrame(b, "page string, rord long, rx double, ry double")
    got = {(r.ord, r.rord) for r in near.grid_join(left, right, ["page"], 60.0).collect()}
    assert got == {(i, j) for _, i, x, y in a for _, j, u, v in b if math.hypot(x - u, y - v) <= 60}
    best = {r.ord: r.rord for r in near.nearest(left, right, ["page"], ["ord"], 60.0).collect()}
    assert best == {i: min(((math.hypot(x - u, y - v), j) for _, j, u, v in b if math.hypot(x - u, y - v) <= 60), default=(0, None))[1] for _, i, x, y in a}
    plan = near.grid_join(left, right, ["page"], 60.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_thinning_equals_the_plain_loop(spark):
    rnd = random.Random(9)
    pts = [(k % 3, i, rnd.uniform(0, 300), rnd.uniform(0, 300)) for i, k in enumerate(range(150))]
    want = set()
    for page in range(3):
        kept: list = []
        for _, i, x, y in [p for p in pts if p[0] == page]:
            if all(math.hypot(x - u, y - v) >= 50 for _, u, v in kept):
                kept.append((i, x, y))
        want |= {(page, i) for i, _, _ in kept}
    got = near.suppress(spark.createDataFrame(pts, "page int, ord long, x double, y double"), ["page"], 50.0)
    assert {(r.page, r.ord) for r in got.collect()} == want


def test_selecting_pages(spark):
    rows = [("d", 1, "LEGEND", 25)] + [("d", i, "PLAN", s) for i, s in zip(range(2, 7), (30, 25, 20, 15, 10))] + [("d", 7, "DETAIL", 5), ("d", 8, "ELEVATION", 5), ("d", 9, "OTHER", 0), ("d", 10, "OTHER", 0), ("e", 3, "OTHER", 0)]
    got = keep.select_pages(spark.createDataFrame(rows, "doc string, page int, type string, score int"), ["doc"], 5).collect()
    d = sorted((r.page, r.type) for r in got if r.doc == "d")
    assert len(d) == 5 and [t for _, t in d].count("LEGEND") == 1 and [t for _, t in d].count("PLAN") == 4 and 2 in [p for p, _ in d]
    assert [r.page for r in got if r.doc == "e"] == [3]
    assert keep.diversified(10, 4) == [0, 3, 6, 9] and keep.diversified(3, 5) == [0, 1, 2] and keep.diversified(5, 1) == [0]


def test_sections(spark):
    text_ = "cover--- Page 1 ---\nSection 09 91 00\npeinture--- Page 2 ---\nmore--- Page 3 ---\nSection 09 30 13 carrelage"
    pages = sections.pages_of(spark.createDataFrame([("b", text_)], "doc string, text string"), ["doc"])
    got = {r.code: r.pages for r in sections.spec_sections(pages, ["doc"]).collect()}
    assert got == {"09 91 00": [1, 2], "09 30 13": [3]}
    assert {r.code: r.pages for r in sections.spec_sections(pages, ["doc"], carry=False).collect()} == {"09 91 00": [1], "09 30 13": [3]}


def test_files(spark, tmp_path):
    assert files.page_range("1-3, 7,2") == [1, 2, 3, 7] and values(spark, [("1-3,7,2",)], "t string", files.page_range_column(c("t"))) == [([1, 2, 3, 7],)]
    assert files.read_json(spark, f"file://{tmp_path}/none.json", files.ROOMS).count() == 0
    df = spark.range(5).withColumn("v", F.lit(1))
    df.write.parquet(f"file://{tmp_path}/t")
    old = files.replace_table(spark, spark.read.parquet(f"file://{tmp_path}/t").withColumn("v", F.lit(2)), f"file://{tmp_path}/t")
    assert spark.read.parquet(f"file://{tmp_path}/t").filter("v = 2").count() == 5 and spark.read.parquet(old).filter("v = 1").count() == 5
    files.write_json(df, f"file://{tmp_path}/j", ["id"])
    assert spark.read.json(f"file://{tmp_path}/j").count() == 5
    rows = [('{"a": 1}', 1), ('say ```json\n{"a": 2}\n``` end', 2), ("none", None)]
    got = values(spark, rows, "t string, w int", files.parsed_reply(c("t"), "a int"), "w")
    assert all((p.parsed.a if p.parsed else None) == w and (p.raw is None) == (w is not None) for p, w in got)
    assert values(spark, [("x/y.JPG",), ("z",)], "t string", files.media_type(c("t"))) == [("image/jpeg",), ("image/png",)]


def test_vector_layouts(spark, tmp_path):
    new = {"source": "a.pdf", "total_pages": 20, "dpi": 300, "pages": [{"page_number": 12, "dimensions": {"width_pts": 100, "height_pts": 100, "width_px": 500, "height_px": 500}, "text_blocks": [{"text": "CLASSE", "bbox": {"x": 1, "y": 2, "width": 3, "height": 4}}, {"text": " "}], "drawings": [{"items": [{"type": "curve", "p1": {"x": 1, "y": 0}, "p2": {"x": 1, "y": 0.5}, "p3": {"x": 0.5, "y": 1}, "p4": {"x": 0, "y": 1}}, {"type": "line", "p1": {"x": 0, "y": 0}, "p2": {"x": 1, "y": 0}}]}]}]}
    old = {"source": "b.pdf", "page": 3, "curves": [{"start": {"x": 100, "y": 0}, "end": {"x": 0, "y": 100}, "center": {"x": 0, "y": 0}}], "lines": [], "texts": [{"text": "P-01", "bbox": {"x0": 0, "y0": 0, "x1": 2, "y1": 2}}]}
    for name, d in (("new", new), ("old", old)):
        (tmp_path / f"{name}.json").write_text(json.dumps(d))
    v = files.read_json(spark, f"file://{tmp_path}", files.VECTORS)
    assert {(r.doc, r.page, r.text, r.x1) for r in files.text_blocks(v).collect()} == {("a.pdf", 12, "CLASSE", 4.0), ("b.pdf", 3, "P-01", 2.0)}
    curves, lines = files.shapes(v)
    assert {(r.doc, r.cx) for r in curves.collect()} == {("a.pdf", None), ("b.pdf", 0.0)} and lines.count() == 1
    assert {r.cx for r in files.shapes(v, chord_centre=True)[0].collect()} == {0.5, 0.0}
    assert files.pages(v, [99]).count() == 0 and files.pages(v).first().scale == 5.0
