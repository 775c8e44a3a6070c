import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def test_stages_and_their_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing_sources", "piece_encoding"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(path := f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(path)
        n = docs.count()
        assert 0 < n <= before
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "line_dedup":
            assert n == before
        if name == "near_duplicates":
            from .test_jaccard import brute

            kept = spark.read.parquet(f"file://{tmp_path}/{k - 1}").collect()
            comps = brute([(r.doc_id, r.text) for r in kept])
            assert {r.doc_id for r in docs.collect()} == {c for _, c in comps.values()}
        before = n
    assert all(r.round_trip and len(r.ids) == r.n_ids for r in docs.collect())


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k * 7919 % 100_003}" for k in range(400_000))  # a text of megabytes


def odd():
    t = "one two three four five six seven eight nine ten and eleven"
    u = "other words of a text that holds nothing of the first at all"
    return [
        (1, None, "en", "s", None), (2, "", "en", None, 0), (None, "", None, None, None), (3, t, "en", "s", 5), (4, t, "en", "s", 5), (4, t, "en", "s", 5), (3, t, "fr", "s", 5), (3, u, "en", "s", 5),
        (None, t, "en", "s", 5), (None, u + " x", None, "s", 5), (None, "p q r s t u v w x y z words", "en", "s", 1), (None, "p q r s t u v w x y z words", "en", "s", 1), (None, "P q r s t u v w x y z words", "en", "s", 1),
        (9, LONG, "en", "s", 1), (8, LONG + " end", "en", None, 1), (7, LONG, "en", "s", 1),
    ]


def staying(rows):
    """What near_duplicates leaves, by plain loops: groups of texts, then the first row of each."""
    from .test_jaccard import shingles

    texts = sorted({t for _, t, *_ in rows if shingles(t)})
    sets, group = {t: shingles(t) for t in texts}, {t: i for i, t in enumerate(texts)}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = {t: new if g == old else g for t, g in group.items()}
    import hashlib

    place = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
    out = [r for r in rows if not shingles(r[1])]
    for g in set(group.values()):
        own = [r for r in rows if r[1] in group and group[r[1]] == g]
        low = min(map(place, own))
        out.append([r for r in own if place(r) == low])
    return out


def test_near_duplicates_decide_by_row(spark):
    rows = odd()
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({"label": pytest.importorskip("pyspark.sql.functions").lit(1)})
    got = sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    want = staying(rows)
    one_of = [w for w in want if isinstance(w, list)]
    assert len(got) == len(want) and sorted((g for g in got if not g[1]), key=str) == sorted((w for w in want if not isinstance(w, list)), key=str)
    for alike in one_of:  # rows of equal id and text that differ elsewhere: one of them
        assert sum(g in alike for g in got) == 1


def test_stages_on_odd_documents(spark):
    from pyspark.sql import functions as F

    rows = odd()
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("x") for c in ("kept", "sampled", "n_lines", "ids", "n_words", "topic")})
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs, SF)
        assert k == 4 or got.columns == corpus_pipeline.COLUMNS
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = got.collect()
        if name == "quality_rules":  # no words, few words: gone; equal texts together
            assert not any(r.text is None or len(r.text.split()) < 10 for r in out) and sum(r.text == rows[3][1] for r in out) in (0, 5)
        elif name == "line_dedup":  # one site and nulls: nothing is boilerplate
            assert sorted(((r.doc_id, r.text, r.n_chars) for r in out), key=str) == sorted(((a, b, None if b is None else len(b)) for a, b, *_ in rows), key=str)
        elif name == "mixing_sources":
            assert {(r.doc_id, r.text) for r in out} <= {(a, b) for a, b, *_ in rows}
        elif name == "piece_encoding":
            assert len(out) == len(rows) and all(r.round_trip for r in out) and sorted(r.n_ids for r in out)[:3] == [0, 0, 0] and sum(r.ids is None for r in out) == 1
