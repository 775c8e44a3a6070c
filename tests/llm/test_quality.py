import collections
import random
import re

import numpy as np
import pyarrow as pa

from atelier.llm import quality


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c, hit = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if c[tuple(w[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), dup, len(hit)


def test_statistics_equal_brute_force():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab é#|\n  😀*") for _ in range(rnd.randint(0, 300))) for _ in range(400)] + [None, "", "\n\n", "a", "x y z v w " * 50, "w " * 60_000]
    got = quality.statistics(pa.array(texts, pa.string()))
    assert [tuple(got[k][i] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(texts))] == [brute(t) for t in texts]


def docs(spark, n=300):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + "###" if bad else w for w in words)))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_tell_bad_from_good(spark):
    d, labels = docs(spark)
    out = quality.judged(spark, d, labels).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in out)
    rules = quality.fit(spark, d, labels)
    assert rules == quality.fit(spark, d.repartition(7), labels.unionByName(labels))  # order and repeats change nothing


def test_other_texts_of_a_repeated_id_change_nothing_by_their_order(spark):
    d, labels = docs(spark)
    both = d.unionByName(d.selectExpr("doc_id", "concat(text, ' and two words more') AS text", *(x for x in d.columns if x not in ("doc_id", "text"))))
    learned = [quality.fit(spark, both.repartition(n).sortWithinPartitions(order), labels) for n, order in ((1, "text"), (5, "doc_id"), (3, "text"))]
    assert learned[0] and learned[0] == learned[1] == learned[2]


def test_rows_that_have_little(spark):
    rows = [(1, None, True), (2, "", True), (None, "a b c d e f g h i j k l", False), (4, "few words", True), (4, "few words", True)]
    d = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = {(r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.judged(spark, d, none).collect()}
    assert out == {(1, 0, True, False), (2, 0, True, False), (None, 12, False, True), (4, 2, True, False)}
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert quality.fit(spark, d, one) == []
    assert quality.judged(spark, d.limit(0), none).count() == 0


def test_learning_prunes_noise():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.RATIOS)))
    bad = x[:, 1] > 0.8
    rules = quality.learn(x, bad)
    assert len(rules) == 1 and all(j == 1 for j, _, _ in rules[0])
    assert quality.learn(x, rng.random(2000) < 0.1) == []


def test_expression_is_ordered():
    e = quality.expression([[(0, ">", 5.0)], [(0, ">", 1.0), (1, "<=", 2.0)]])
    assert e.index("THEN 1") < e.index("THEN 2") and e.endswith("ELSE 0 END")
