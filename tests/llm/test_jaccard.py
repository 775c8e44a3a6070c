import random
import re

import pytest

from atelier.llm import jaccard

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LETTERS))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids, least = sorted(sets), {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(a), root(b)))
                least[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rnd, words, share):
    return " ".join(rnd.choice(["x", "y", "z"]) + str(rnd.random()) if rnd.random() < share else w for w in words)


def corpus(seed, copies):
    """A large group of near copies about the threshold, chains, passages that many share, and plain texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    base = [word() for _ in range(120)]
    texts = [" ".join(base)] + [edited(rnd, base, rnd.choice([0.0, 0.01, 0.02, 0.03, 0.05])) for _ in range(copies)]
    passage = [word() for _ in range(40)]
    texts += [" ".join([word() for _ in range(rnd.randint(1, 150))] + passage) for _ in range(copies // 2)]
    chain = [word() for _ in range(100)]
    for _ in range(8):
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    return list(enumerate(texts, 1000))


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_equal_brute_force(spark, seed):
    rows = corpus(seed, 130)  # regions of more members than LARGE
    assert 130 > jaccard.LARGE
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_small_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "a b c d e"), (8, "A B C D E"), (9, "a b c d e f"), (10, "é b c d e"), (11, "É b c d e")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert got[5][1] == 4 and got[8][1] == 7 and got[11][1] == 11


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "p q r s t u v", 1), (None, "p q r s t u v", 2), (3, "p q r s t u v", 3), (3, "p q r s t u v", 3), (None, "k l m n o", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles long").withColumnRenamed("n_shingles", "component_id")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark, df).collect()), key=str)
    assert got == sorted([(None, 3, 3), (None, 3, 3), (3, 3, 3), (3, 3, 3), (None, 1, None)], key=str)


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_texts_are_no_row_of_every_bucket(spark, monkeypatch):
    """Families about the threshold: a pair comes once or a few times to be compared, however many buckets there are."""
    rnd = random.Random(5)
    rows = []
    for _ in range(12):
        base = ["".join(rnd.choice("abcdefg") for _ in range(6)) for _ in range(200)]
        rows += [edited(rnd, base, 0.02) for _ in range(8)]
    rows, found, table = list(enumerate(rows)), [], jaccard.Scratch.table

    def counted(self, df, name):
        out = table(self, df, name)
        found.extend([out.filter("not hot").count()] if name == "found" else [])
        return out

    monkeypatch.setattr(jaccard.Scratch, "table", counted)
    monkeypatch.setattr(jaccard, "partitions", lambda spark: 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert sum(found) <= 12 * 28
