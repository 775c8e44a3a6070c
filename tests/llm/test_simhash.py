"""Fingerprints and components against plain loops."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from atelier.llm import simhash
from atelier.llm.scratch import Scratch

DOCS = "doc_id long, text string, fp string, component_id string, n int"


def plain_print(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=3):
    """The least member of each one's component, by all pairs."""
    up = {p: p for p in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    each = sorted(up)
    for i, a in enumerate(each):
        for b in each[:i]:
            if (a ^ b).bit_count() <= bits and top(a) != top(b):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in each}


def found(spark, rows):
    out = simhash.simhash_components(spark, spark.createDataFrame(rows, DOCS))
    return sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in out.collect()), key=repr)


def wanted(rows):
    prints = [plain_print(r[1]) for r in rows]
    of = groups(set(prints))
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[of[p]] = min(least.get(of[p], r[0]), r[0])
    return sorted(((r[0], p, least.get(of[p])) for r, p in zip(rows, prints, strict=True)), key=repr)


def texts(seed, n):
    """Families of long texts with a word changed here and there."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(rng.randint(1, 500))]
        for _ in range(rng.randint(1, 6)):
            out.append(" ".join(words))
            words[rng.randrange(len(words))] = f"Z{rng.randint(0, 99)}"
    return out[:n]


def test_equals_loops(spark):
    rows = [(k * 7 % 311, t, "x", "y", 1) for k, t in enumerate(texts(4, 300))]
    assert found(spark, rows) == wanted(rows)
    assert len({r[2] for r in wanted(rows)}) < len({r[1] for r in wanted(rows)})  # some differ and are linked


def test_odd_rows(spark):
    long = " ".join(f"w{k * k % 1009}" for k in range(400_000))
    rows = [(5, None, "x", "y", 1), (4, "", None, None, None), (9, " \t\n", "x", "y", 1), (None, None, None, None, None), (8, "One", "x", "y", 1), (3, "one\x0b", "x", "y", 1), (None, "two words", "x", "y", 1), (7, long, "x", "y", 1), (6, long.upper(), "x", "y", 1)]
    rows += [(2, "a b c", "x", "y", 1)] * 3 + [(1, "A  b\tc", "x", "y", 1), (11, "é É ß", "x", "y", 1)]
    assert found(spark, rows) == wanted(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("size", [1, 7, 40])
def test_slices_overlap(monkeypatch, size):
    monkeypatch.setattr(simhash, "SLICE", size)
    for t in ["", "a", "a b", "a b c", "  one two\tthree four\n\nfive six seven ", "x" * 100 + " y z", "ends in blanks    "]:
        assert simhash.fingerprint(t.encode()) % 2**64 == plain_print(t)


def test_same_hash_as_spark(spark):
    """The hash of a shingle is Spark's own, seed and bytes alike."""
    said = ["", "a b c", "déjà vu là", "x" * 200]
    got = [r[0] % 2**64 for r in spark.createDataFrame([(s,) for s in said], "s string").select(F.xxhash64("s")).collect()]
    assert got == [xxhash.xxh64_intdigest(s.encode(), simhash.SEED) for s in said]


def labelled(spark, prints):
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    labels = simhash.linked(Scratch(spark, "t"), spark.createDataFrame(signed, "fp long"))
    return {r["node"] % 2**64: r["label"] % 2**64 for r in labels.collect()}


def same_groups(got, prints):
    parts = lambda of: {frozenset(p for p in of if of[p] == label) for label in set(of.values())}
    return parts({p: got.get(p, p) for p in prints}) == parts(groups(prints))


def test_large_variants_are_cut(spark):
    """Hundreds that share a half, then three quarters, in many components, with links that no walk in order finds."""
    rng = random.Random(8)
    prints = set()
    for shared, free in ((0xDEADBEEF << 32, 32), (0x1234567812345 << 12, 12), (0xCAFE << 16, 16)):
        for _ in range(160):
            p = shared | rng.getrandbits(free)
            prints.add(p)
            for _ in range(rng.choice([0, 0, 1, 2])):
                for bit in rng.sample(range(64), rng.randint(1, 3)):
                    p ^= 1 << bit
                prints.add(p)
    assert same_groups(labelled(spark, prints), prints)


def test_a_cut_finds_what_differs_in_three_bits(spark, monkeypatch):
    """With the smallest direct meeting, links rest on the cuts alone."""
    monkeypatch.setattr(simhash, "SMALL", 2)
    rng = random.Random(2)
    base = [rng.getrandbits(32) << 32 | 77 for _ in range(6)]
    prints = {b ^ sum(1 << x for x in rng.sample(range(64), rng.choice([0, 3, 5, 6]))) for b in base for _ in range(60)}
    assert same_groups(labelled(spark, prints), prints)


def test_hot_fingerprints_beyond_the_broadcast(spark, monkeypatch):
    rows = [(k, "same text here now", "x", "y", 1) for k in range(90, 0, -1)] + [(100 + k, t, "x", "y", 1) for k, t in enumerate(texts(12, 60))]
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(simhash, "HOT", 5)
    assert found(spark, rows) == wanted(rows)


def test_plan_has_no_cross_join(spark):
    out = simhash._cut(spark.createDataFrame([(1,)], "fp long"), F.lit(0), 64, [])
    assert out.count() == 64 and out.filter("r64 = 32").count() == 32
