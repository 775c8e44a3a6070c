from atelier.llm import tokencounts as tc
from atelier.llm.scratch import remove

CHANGES = "op string, doc_id long, source string, lang string, version string, tokens long"


def totals(rollup):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_signed_batches_and_replays(spark, tmp_path):
    r = tc.TokenRollup(spark, f"file://{tmp_path}/rollup")
    df = lambda rows: spark.createDataFrame(rows, CHANGES)
    assert totals(r) == {}
    first = [("insert", 1, "a", "en", "v1", 10), ("insert", 2, "a", "en", "v1", 5), ("insert", 3, None, "fr", "v1", 7), ("insert", None, "b", None, "v1", 1), ("insert", 4, "b", "en", "v1", 2), ("insert", 4, "b", "en", "v1", 2), ("insert", 1, "a", "en", "v2", 99)]
    assert r.commit("b1", df(first)) and not r.commit("b1", df(first))
    base = {("a", "en", "v1"): (2, 15), (None, "fr", "v1"): (1, 7), ("b", None, "v1"): (1, 1), ("b", "en", "v1"): (2, 4), ("a", "en", "v2"): (1, 99)}
    assert totals(r) == base
    # a revision moves document 3 to another source, a delete takes both rows of 4, one of nothing takes nothing
    assert r.commit("b2", df([("revise", 3, "c", "fr", "v1", 8), ("delete", 4, None, None, "v1", None), ("delete", 77, "a", "en", "v1", 3), ("delete", None, "b", None, "v1", 1)]))
    want = base | {("c", "fr", "v1"): (1, 8)}
    del want[(None, "fr", "v1")], want[("b", "en", "v1")]
    assert totals(r) == want
    assert r.commit("b3", df([])) and totals(r) == want


def test_an_interrupted_batch_counts_once(spark, tmp_path):
    r = tc.TokenRollup(spark, f"file://{tmp_path}/rollup")
    rows = spark.createDataFrame([("insert", 1, "a", "en", "v1", 10)], CHANGES)
    r.commit("b1", rows)
    remove(spark, f"file://{tmp_path}/rollup/b1.done")  # as if the driver had gone before the marker
    assert totals(r) == {}
    assert r.commit("b1", rows) and totals(r) == {("a", "en", "v1"): (1, 10)}


def test_of_two_writers_of_a_batch_one_counts(spark, tmp_path, monkeypatch):
    one, two = (tc.TokenRollup(spark, f"file://{tmp_path}/rollup") for _ in range(2))
    rows = spark.createDataFrame([("insert", 1, "a", "en", "v1", 10)], CHANGES)
    claim = one._claim

    def late(name, text):  # the other writer is done first
        assert two.commit("b1", rows)
        return claim(name, text)

    monkeypatch.setattr(one, "_claim", late)
    assert not one.commit("b1", rows) and totals(one) == {("a", "en", "v1"): (1, 10)}


def test_a_snapshot_holds_what_it_folds(spark, tmp_path):
    r = tc.TokenRollup(spark, f"file://{tmp_path}/rollup")
    df = lambda rows: spark.createDataFrame(rows, CHANGES)
    r.commit("b1", df([("insert", i, "a", "en", "v1", i) for i in range(50)]))
    r.commit("b2", df([("delete", 7, None, None, "v1", None)]))
    before = totals(r)
    r.compact()
    assert totals(r) == before and len(r._parts()) == 1 and not r.commit("b1", df([("insert", 1, "a", "en", "v1", 1)]))
    r.commit("b3", df([("revise", 8, "b", "en", "v1", 100)]))
    r.compact()
    assert totals(r) == {("a", "en", "v1"): (48, before["a", "en", "v1"][1] - 8), ("b", "en", "v1"): (1, 100)} and len(r._parts()) == 1


def test_counts_equal_the_tokenizer(spark):
    enc = tc.encoder(tc.RANKS)
    texts = [None, "", "hello  world\n", "日本 é " * 40, "<|endoftext|>", "x" * 5000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tc.count_tokens(df).collect()}
    assert got == {i: (len((t or "").split()), len(enc.encode_ordinary(t or ""))) for i, t in enumerate(texts)}


def test_long_texts_are_cut_where_no_token_crosses():
    import random

    rnd, enc = random.Random(4), tc.encoder(tc.RANKS)
    bits = ["word", "l'eau", "x1", "  ", " ", "\n", "\n\n", "...", "é", "日本", " a", "_b", "\u00a0c", "9"]
    for n in (1, 7, 50):
        text = "".join(rnd.choice(bits) for _ in range(3000))
        cut = list(tc.parts(text, n))
        assert "".join(cut) == text and len(cut) > 10
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)
    assert list(tc.parts("x" * 100, 5)) == ["x" * 100] and list(tc.parts("", 5)) == [""]


def test_query_equals_direct_counts(spark):
    sf, enc, want = "/root/testdata/sf0.001", tc.encoder(tc.RANKS), {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for v, n in (("words-1", len(r.text.split())), ("bpe50k-1", len(enc.encode_ordinary(r.text)))):
            d, t = want.get((r.source, r.lang, v), (0, 0))
            want[r.source, r.lang, v] = (d + 1, t + n)
    assert {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in tc.op4_tokencounts(spark, sf).collect()} == want
