"""The audit against loops over dense counts, and on odd rows."""

import random
import re
from collections import Counter, defaultdict

from atelier.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, term int, vec string"


def plain(rows, least, add=5, scale=10**9, top=50):
    """(lang, source, part, item, value, rank) by loops over every term and pair."""
    seen, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        groups.add((lang, source))
        seen[lang, source].update(words)
        df[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        of = {s: {t: seen[lang, s][t] for t in kept} for g, s in groups if g == lang}
        whole = {t: sum(c[t] for c in of.values()) for t in kept}
        share = lambda c: {t: 1 + scale * (n + add) // (sum(c.values()) + add * len(kept)) for t, n in c.items()}  # noqa: B023, E731
        p, q = {s: share(c) for s, c in of.items()}, share(whole)
        for s in of:
            ranked = {"pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in of if o != s], "term": [(t, p[s][t] - q[t]) for t in kept if of[s][t] and p[s][t] > q[t]]}
            for part, items in ranked.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < top}
    return out


def audited(spark, rows, **more):
    found = divergence.audit(spark, spark.createDataFrame(rows, DOCS), **more)
    got = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def corpus(seed, n=400):
    """Zipf-like words over unequal sources; many rare words of equal vectors."""
    rng = random.Random(seed)
    words = ["mot", "Été", "l'eau", "naïve", "β-test", "x1y"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for k in range(n):
        lang = rng.choice(["fr", "en", "de"])
        source = rng.choice(["hot"] * 4 + ["a", "b", "c", "é", "Z"])
        few = 6 + int(114 * rng.random() ** 3)
        rows.append((k, " ".join(rng.choice(words[:few]) for _ in range(rng.randint(0, 40))), lang, source, k, "clash"))
    return rows


def test_equals_loops(spark):
    rows = corpus(3)
    assert audited(spark, rows, least=5) == plain(rows, 5)
    assert audited(spark, rows, least=12, top=3) == plain(rows, 12, top=3)


def test_odd_rows(spark):
    rows = [
        (1, None, "fr", "a", 1, "x"), (2, "", "fr", "b", 1, "x"), (None, "MOT mot\tmot", None, None, None, None), (None, "MOT mot\tmot", None, None, None, None),
        (3, "mot " * 200_000, "", "a", 1, "x"), (4, "123 !? 45", "fr", "c", 1, "x"), (5, "seul", "xx", "only", 1, "x"), (6, "Mot\x00mot", "", "é", 1, "x"), (7, "autre", "", "z", 1, "x"),
    ]
    got = audited(spark, rows, least=2)
    assert got == plain(rows, 2)
    assert ("fr", "a", "pair", "b", 0, 1) in got and ("fr", "a", "pair", "c", 0, 2) in got  # no kept term: ties by name
    assert not [g for g in got if g[0] == "xx"]  # one source, one document
    assert audited(spark, rows, least=1) == plain(rows, 1)


def test_empty_table(spark):
    assert audited(spark, []) == set()


def test_sums_over_several_blocks(spark, monkeypatch):
    """Pairs that are given out in parts add up."""
    rows = corpus(9, 200)
    monkeypatch.setattr(divergence, "PART", 500)
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 0)
    assert audited(spark, rows, least=3) == plain(rows, 3)


def test_flushes_of_pairs():
    """The kernel gives the same sums however few pairs it holds."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
    rng = random.Random(1)
    entries = [[{"source": s, "p": rng.randint(1, 99), "p0": 7} for s in sorted(rng.sample("abcdefgh", rng.randint(1, 8)))] for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([rng.choice("xy") for _ in entries]), pa.array([rng.randint(1, 5) for _ in entries]), pa.array(entries, kind)], ["lang", "m", "e"])
    sums = []
    for held in (1 << 21, 8):
        divergence_held, divergence.HELD_PAIRS = divergence.HELD_PAIRS, held
        out = Counter()
        for b in divergence._both([batch]):
            for r in b.to_pylist():
                out[r["lang"], r["lo"], r["hi"]] += r["value"]
        divergence.HELD_PAIRS = divergence_held
        sums.append(out)
    want = Counter()
    for lang, m, e in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        for i, a in enumerate(e):
            for b in e[i + 1 :]:
                want[lang, a["source"], b["source"]] += m * (abs(a["p"] - b["p"]) - abs(a["p"] - b["p0"]) - abs(a["p0"] - b["p"]) + abs(a["p0"] - b["p0"]))
    assert sums[0] == sums[1] == want
