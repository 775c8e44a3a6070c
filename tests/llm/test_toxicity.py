import random

from atelier.llm import toxicity as tox


def corpus(spark, n=900):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7)))
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = [word() for _ in range(60)]
        if bad:
            for _ in range(3):
                text[rnd.randrange(60)] = rnd.choice(["moron", "zzvil" + word()])
        rows.append((i, " ".join(text), rnd.choice(["en", "fr", None])))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus(spark)
    net, cuts = tox.fit(spark, docs, labels)
    assert set(cuts) == {"en", "fr"}
    held = tox.scored(spark, docs, net, cuts).filter(tox.HELD_OUT).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in held) / len(held) >= 0.95 and len(held) > 100
    odd = spark.createDataFrame([(1, None, None, 5), (2, "", "en", 5), (None, "moron " * 20_000, "xx", 5), (3, "good words " * 10_000, "en", 5)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in tox.scored(spark, odd, net, cuts).collect()}
    assert got[None].predicted == 1 and got[3].predicted == 0 and got[1].score == got[2].score and all(0 <= r.score <= 1 for r in got.values())
    # whole texts: a word at the far end of a long one tells
    far = spark.createDataFrame([(1, "good words " * 50_000 + " moron zzvilab", "en")], "doc_id long, text string, lang string")
    assert tox.scored(spark, far, net, cuts).first().score > got[3].score


def test_labels_of_one_class_or_none(spark):
    docs, labels = corpus(spark, 50)
    for some, want in ((labels.limit(0), 0.0), (labels.filter("toxic = 0"), 0.0), (labels.filter("toxic = 1"), 1.0)):
        net, cuts = tox.fit(spark, docs, some)
        assert net == want and cuts == {} and {r.score for r in tox.scored(spark, docs, net, cuts).collect()} == {want}
    assert tox.scored(spark, docs.limit(0), 0.0, {}).count() == 0


def test_training_is_reproducible():
    import numpy as np

    texts = ["good words here", "bad moron here"] * 20
    y = np.array([0, 1] * 20, np.float32)
    a, b = (tox.train(texts, y, epochs=2) for _ in range(2))
    assert (a.v == b.v).all() and (a.e == b.e).all()


TEXTS = ["good words here and there", "bad moron", "one", "", "a b c d e f g moron, again", "good good words moron!"]


def loops(net, texts):
    """(pooled, places, words) of every text by plain loops over words, filters and positions."""
    import numpy as np
    import pyarrow as pa

    pooled, places, held = [], [], []
    for t in texts:
        data, offs = tox.letters(pa.array([t], pa.string()))
        words = tox.Words(data, offs)
        rows, which, _ = tox.word_rows(words) if len(words.start) else (np.zeros((0, 6), int), [], None)
        vec = [sum(net.e[r] for r in rows[w]) for w in which]
        out, at = [], []
        for i, k in enumerate(tox.WIDTHS):
            for f in range(tox.FILTERS):
                best, place = 0.0, None
                for s in range(len(vec) - k + 1):
                    y = sum(float(vec[s + j] @ net.w[i][j][:, f]) for j in range(k)) + float(net.b[i][f])
                    if y > best + 1e-7:
                        best, place = y, s
                out.append(best)
                at.append(place)
        pooled.append(out)
        places.append(at)
        held.append(([rows[w] for w in which], vec))
    return np.array(pooled), places, held


def test_scores_equal_plain_loops():
    import numpy as np
    import pyarrow as pa

    net = tox.train(["good words here", "bad moron here"] * 20, np.array([0, 1] * 20, np.float32), epochs=2)
    pooled, _, _ = loops(net, TEXTS)
    want = 1 / (1 + np.exp(-(pooled @ net.v + net.c)))
    assert np.allclose(net.scores(pa.array(TEXTS, pa.string())), want, atol=1e-5)


def test_a_step_of_training_equals_plain_loops():
    import numpy as np

    y, rate = np.array([0, 1, 0, 0, 1, 1], np.float64), 0.02
    net, got = tox.Net(), tox.train(TEXTS, y.astype(np.float32), epochs=1, rate=rate)
    pooled, places, held = loops(net, TEXTS)
    err = (1 / (1 + np.exp(-(pooled @ net.v + net.c))) - y) / len(y)
    step = lambda old, g: old - rate * g / np.sqrt(1e-4 + g**2)
    assert np.allclose(got.v, step(net.v, pooled.T @ err), atol=1e-4) and np.isclose(got.c, step(net.c, err.sum()), atol=1e-4)
    for i, k in enumerate(tox.WIDTHS):
        gw, gb = np.zeros_like(net.w[i], dtype=float), np.zeros(tox.FILTERS)
        for d in range(len(TEXTS)):
            for f in range(tox.FILTERS):
                n = i * tox.FILTERS + f
                if places[d][n] is not None:
                    g = err[d] * net.v[n]
                    gb[f] += g
                    for j in range(k):
                        gw[j, :, f] += held[d][1][places[d][n] + j] * g
        big = np.abs(gw) > 1e-4  # a step divides by the gradient's size, so rounding shows where that is near nothing
        assert np.allclose(got.w[i][big], step(net.w[i], gw)[big], atol=2e-3) and np.allclose(got.b[i], step(net.b[i], gb), atol=2e-3)


def test_all_labelled_rows_are_learnt_in_parts_whatever_their_length(spark, monkeypatch):
    docs, labels = corpus(spark, 2400)
    # a word that only rows of more than 20,000 bytes tell of
    docs = docs.union(spark.createDataFrame([(i, "plain words " * 2_000 + ("qqxyz" if i % 2 else "fine"), "en") for i in range(10_000, 10_060)], docs.schema))
    labels = labels.union(spark.createDataFrame([(i, i % 2) for i in range(10_000, 10_060)], labels.schema))
    tables, write = {}, tox.Scratch.table
    monkeypatch.setattr(tox.Scratch, "table", lambda self, df, name: tables.setdefault(name, write(self, df, name)))
    net, cuts = tox.fit(spark, docs, labels, part_rows=600)
    wanted = labels.filter(f"not ({tox.HELD_OUT})").count()
    assert tables["labelled"].count() == wanted and tables["learnt"].select("part").distinct().count() > 2
    assert tables["learnt"].count() == tables["labelled"].filter("not tested").count() > 0.7 * wanted
    held = tox.scored(spark, docs, net, cuts).filter(tox.HELD_OUT).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in held) / len(held) >= 0.9
