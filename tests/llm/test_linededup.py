import pytest
from pyspark.sql import functions as F

from atelier.llm import linededup

BAD, KEEP = "Terms of use apply here.", "Own words of one site."


def rows():
    out = [(i, f"site{i % 9}", f"{KEEP} number {i} and more of it\n  {BAD}\t\n\nsecond own line {i}") for i in range(45)]
    out += [(100 + i, f"site{i % 4}", f"a line on four sites\nwords of document {i} that are its own") for i in range(12)]
    out += [(200 + i, f"site{i}", "a whole text\nthat five sites copy\nline by line") for i in range(6)]
    return [*out, (300, "site1", None), (301, None, ""), (302, None, f"{BAD}\nand a good deal of text that nobody else has, {BAD} twice\n{BAD}"), (None, "site2", BAD)]


@pytest.mark.parametrize("most", [linededup.BROADCAST_MOST, 0])
def test_boilerplate_goes_and_documents_stay(spark, most):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string").withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: r for r in linededup.strip_boilerplate(spark, df, broadcast_most=most).collect()}
    assert len(got) == len(rows())
    assert got[0].text == f"{KEEP} number 0 and more of it\n\nsecond own line 0" and (got[0].n_lines, got[0].n_removed) == (3, 1)
    assert all(got[100 + i].n_removed == 0 for i in range(12))  # four sites are too few
    assert all(got[200 + i].text == "" and got[200 + i].n_removed == 3 for i in range(6))  # six sites copy the whole text
    assert got[300].text is None and got[300].n_lines == 0 and got[301].text == "" and got[None].text == "" and not any(r.left_whole for r in got.values())
    assert got[302].n_removed == 2 and BAD in got[302].text and not got[302].text.startswith(BAD)


def test_sketches_agree_with_exact_counts_about_the_threshold(spark):
    data = [(k * 100 + s, f"s{s}", f"line on {k} sites\nown text of {k} and {s}, long enough to stay as it is") for k in range(1, 40) for s in range(k)]
    got = linededup.strip_boilerplate(spark, spark.createDataFrame(data, "doc_id long, source string, text string"), sites=8).collect()
    assert all((r.n_removed == 1) == (int(r.doc_id) // 100 >= 8) for r in got)


def test_empty(spark):
    assert linededup.strip_boilerplate(spark, spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0


@pytest.mark.parametrize("most", [linededup.BROADCAST_MOST, 0])
def test_a_line_of_its_own_makes_a_carrier(spark, most):
    from corpus_pipeline import line_dedup

    short = [(400, "site1", f"{BAD}\nmine\n\n{BAD}"), (401, "site1", f"{BAD}\n\n {BAD}")]
    df = spark.createDataFrame(rows() + short, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in linededup.strip_boilerplate(spark, df, broadcast_most=most, own=True).collect()}
    assert (got[400].text, got[400].n_removed, got[400].left_whole) == ("mine\n", 2, False)
    assert got[401].text == short[1][2] and got[401].left_whole and got[200].left_whole and got[None].left_whole
    stage = line_dedup(spark, df.selectExpr("*", "'en' AS lang", "0L AS n_chars"), "")
    assert stage.filter("doc_id = 400").first().text == "mine\n"


def brute(rows, sites):
    """(doc_id, n_lines, n_removed, text) of every row, by plain loops."""
    strip = lambda line: line.strip(" \t\r\x0b\x0c")
    seen = {}
    for _, source, text in rows:
        for line in (text or "").split("\n"):
            seen.setdefault(strip(line), set()).add(source)
    bad = {k for k, v in seen.items() if k and len(v) >= sites}
    out = []
    for doc_id, _, text in rows:
        lines = (text or "").split("\n")
        hits = sum(strip(x) in bad for x in lines)
        out.append((doc_id, sum(strip(x) != "" for x in lines), hits, "\n".join(x for x in lines if strip(x) not in bad) if hits else text))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [linededup.BROADCAST_MOST, 0])
def test_equals_brute_force_on_ties_repeats_and_long_texts(spark, most):
    import random

    rnd = random.Random(9)
    lines = [f"line {k}" + " x" * rnd.randint(0, 5) for k in range(60)] + ["", "  ", "\t"]
    data = [(i, rnd.choice([None, *(f"s{k}" for k in range(12))]), "\n".join(rnd.choice(lines[: rnd.randint(1, 63)]) + rnd.choice(["", " ", "\r"]) for _ in range(rnd.randint(0, 6)))) for i in range(250)]
    data += [data[3], data[3], (None, "s1", data[5][2]), (7, "s9", "tie\nother"), (900, None, None)]
    data.append((901, "s2", "\n".join(f"own {k}" if k % 3 else lines[k % 60] for k in range(150_000))))  # a text of megabytes
    df = spark.createDataFrame(data, "doc_id long, source string, text string").withColumns({c: F.lit(1) for c in ("left_whole", "_k", "h", "site")})
    got = linededup.strip_boilerplate(spark, df, sites=4, broadcast_most=most)
    assert got.columns == ["doc_id", "source", "text", "_k", "h", "site", "n_lines", "n_removed", "left_whole"]
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()), key=str) == brute(data, 4)
