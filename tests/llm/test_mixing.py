import pytest

from atelier.llm import mixing


def docs(spark):
    rows = []
    for i in range(1200):
        source, lang = f"s{i % 3 if i % 5 else 0}", ["en", "fr", None][i % 7 % 3]
        rows.append((i, ("word " * (20 + i % 300)) + ("!! " if i % 11 == 0 else ""), source, lang, "clash"))
    rows += [(5000, None, "s1", "en", "x"), (5001, "", None, "fr", "x"), (None, "some words here", "s2", "fr", "x"), (7, "twice", "s1", "en", "x"), (7, "twice", "s1", "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")


def test_raked_weights_meet_every_target(spark):
    out = mixing.mix(spark, docs(spark)).toPandas()
    assert len(out) == 1205 and out["prob"].between(0, 1).all() and out["prob"].max() == pytest.approx(1)
    out["fit"] = out["n_tokens"] * out["factor"]
    total = out["n_tokens"].sum()
    for dim in mixing.DIMS:
        key = out[dim].fillna("none")
        share = out.groupby(key)["n_tokens"].sum() ** mixing.ALPHA
        want, got = share / share.sum() * total, out.groupby(key)["fit"].sum()
        assert (abs(got - want) <= 1e-8 * total).all(), dim
    assert out["residual"].max() <= mixing.TOLERANCE
    drawn = out[out["sampled"]]
    assert abs(len(drawn) - out["prob"].sum()) <= 4 * len(out) ** 0.5
    assert out[out["doc_id"] == 7].groupby("doc_id")["sampled"].nunique().eq(1).all()


def test_stated_targets(spark):
    df = docs(spark).filter("source is not null and lang is not null")
    want = spark.createDataFrame([("s0", 0.2), ("s1", 0.2), ("s2", 0.6)], "source string, target_source double")
    out = mixing.mix(spark, df, targets={"source": want}).toPandas()
    share = (out["n_tokens"] * out["factor"]).groupby(out["source"]).sum() / out["n_tokens"].sum()
    assert share["s2"] == pytest.approx(0.6, abs=1e-9)


def test_targets_that_no_weights_meet_end_with_their_residual(spark, monkeypatch):
    rows = [(1, "a b c", "s0", "en", "x"), (2, "a b c d", "s1", "fr", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    sides = {"source": spark.createDataFrame([("s0", 0.9), ("s1", 0.1)], "source string, target_source double"), "lang": spark.createDataFrame([("en", 0.1), ("fr", 0.9)], "lang string, target_lang double")}
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 8)
    out = mixing.mix(spark, df, targets=sides, own_topic="topic").collect()
    assert {r.topic for r in out} == {"x"} and all(r.residual > 0.5 for r in out)


def test_ties_long_texts_and_clashing_names(spark):
    rows = [(i, text, "s", "en", "mine") for i, text in enumerate(["a b"] * 40 + ["word " * 400_000, None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, factor string").withColumns({c: mixing.F.lit("x") for c in ("prob", "residual", "w", "fit", "_source", "n_tokens")})
    out = {r.doc_id: r for r in mixing.mix(spark, df).collect()}
    assert len(out) == 43 and out[40].n_tokens == 400_000 and out[40].topic == "book" and out[41].topic == "empty" and out[0]._source == "x"
    assert len({(r.factor, r.prob) for r in out.values() if r.topic == "note"}) == 1


def test_many_cells_take_the_shuffled_way(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-3)
    one = {(r.doc_id, r.n_tokens): r.prob for r in mixing.mix(spark, docs(spark)).collect()}
    monkeypatch.setattr(mixing, "SMALL_CELLS", 0)
    two = {(r.doc_id, r.n_tokens): r.prob for r in mixing.mix(spark, docs(spark)).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)


def test_empty_and_native(spark):
    df = docs(spark)
    assert mixing.mix(spark, df.limit(0)).count() == 0
    plan = mixing.mix(spark, df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_tiny_cell_does_not_set_the_rate_of_a_stated_share(spark):
    from corpus_pipeline import TOKEN_SHARE, mixing_sources

    tiny = spark.createDataFrame([(9999, "four words of text", "new", "xx", "c")], "doc_id long, text string, source string, lang string, topic string")
    for df in (docs(spark), docs(spark).union(tiny)):
        out = mixing.mix(spark, df, share=TOKEN_SHARE).toPandas()
        assert out["prob"].between(0, 1).all() and (out["n_tokens"] * out["prob"]).sum() == pytest.approx(TOKEN_SHARE * out["n_tokens"].sum())
        kept = mixing_sources(spark, df.withColumn("n_chars", mixing.F.lit(0)), "").toPandas()
        assert abs(len(kept) - out["prob"].sum()) <= 4 * len(out) ** 0.5 and len(kept) >= 0.3 * len(out)
