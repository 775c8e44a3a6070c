"""N-gram Jaccard join: an exact join in the metric space of Jaccard distance (links at 1 - J <= 0.2).

A document is the set of its five-word shingles; documents of one set are one point.

1. Regions.  Nearly all documents are at distance 1 of any few document pivots, so the first pivots are
   single shingles: the point {s} is nearer to x the smaller x is if s is in x, and at distance 1 if not.
   A point's own Voronoi region is that of its rarest shingle.  A neighbour within 0.2 keeps at least
   four fifths of its shingles, so replicating x to the regions of its n - ceil(0.8 n) + 1 rarest shingles
   (the window in which the triangle inequality leaves a neighbour possible) puts every linked pair into
   one region at least.
2. Small regions compare pairs that pass the length and place bounds.  Pairs that share one of their three first
   shingles by hash are joined by that alone, and left out of the small regions: similar texts share many shingles, and
   would else be a row of every bucket that holds one of them.
3. Large regions recur on document pivots: the most central member (least share of rarer shingles) is the
   pivot, every member's distance to it is verified, members within 0.2 are linked through it, and what
   is left goes on to the next pivot.  After the pivots, only pairs of different components whose distances
   to the pivot differ by 0.2 at most are compared, again behind the bounds of 2.
4. All candidate pairs are verified on the whole texts; components follow from the verified links.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing (its
component is its own doc_id); fewer than five words are one shingle, the whole sequence; texts of any length are taken
whole; a pair at exactly 80 % links; repeated rows and equal texts share a component; a null doc_id keeps its row and takes part through its text, but names no
component unless all ids of it are null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, extended
from .scratch import Scratch, partitions
from .textkit import U, mix, release, shingle_sets, tidy

#: Regions over this many members recur on document pivots; shingles found in more documents come last in the order of rarity.
LARGE = 48
#: Most entries of the broadcast table of frequent shingles (16 bytes each); the threshold of frequency doubles until they fit.
FREQUENT_MOST = 1_000_000
PIVOT_ROUNDS = 2
#: Points of one part of a family; two parts meet in a task.
BLOCK = 256
#: Names of points that are broadcast at most; more are joined by key.
BROADCAST_ROWS = 500_000
FLUSH = 1_000_000
#: Bytes of postings that a task sorts at once; their buckets grow in number with the data.
BUCKET_BYTES = 64 << 20
#: A worker gives its memory back after a block of more bytes of text.
FREED_BYTES = 4 << 20
K1, K2 = U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB)
HEAVY = np.uint32(1 << 31)
#: First shingles of a set by hash.  Pairs that share one, but for those of more than ``LARGE`` sets, are found by it alone and not once more in each bucket.
FIRST = 3
HEADS = pa.list_(pa.int64())


def fingerprint(x: np.ndarray, turn: int = 0) -> tuple[np.uint64, np.uint64]:
    """128 bits of a set; ``turn`` chooses others."""
    t = U(2 * turn)
    return mix(x ^ (K1 + t)).sum(dtype=U), mix(x ^ (K2 + t)).sum(dtype=U)


def _profile(batches, turn: int = 0):
    """Rows of documents (fingerprint, size, first shingles by hash) and of shingles that several sets of this partition hold."""
    held, size, seen = [], 0, set()

    def counts():
        tok, n = np.unique(np.concatenate(held), return_counts=True)
        tok, n = tok[n >= 2], n[n >= 2]
        none = pa.nulls(len(tok), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(tok), pa.string()), pa.array(tok.view(np.int64)), pa.array(n.astype(np.int64)), pa.nulls(len(tok), HEADS)], names=["doc_id", "f1", "f2", "n", "tkey", "tok", "cnt", "heads"])

    for batch in batches:
        rows = batch.num_rows
        f1, f2, n, heads = np.zeros(rows, U), np.zeros(rows, U), np.zeros(rows, np.int64), [[]] * rows
        for i, x in shingle_sets(batch.column(1)):
            n[i] = len(x)
            heads[i] = x[:FIRST].view(np.int64)
            if len(x):
                f1[i], f2[i] = fingerprint(x, turn)
                if (f1[i], f2[i]) not in seen:
                    seen.add((f1[i], f2[i]))
                    held.append(x)
                    size += len(x)
        none = pa.nulls(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(n), batch.column(2), none, none, pa.array(heads, HEADS)], names=["doc_id", "f1", "f2", "n", "tkey", "tok", "cnt", "heads"])
        if size > 4 * FLUSH:
            yield counts()
            held, size, seen = [], 0, set()
    if held:
        yield counts()


def _postings(n_buckets, frequent, crowded, turn: int = 0):
    def run(batches):
        heavy, often = frequent.value
        seen, held, texts, size = set(), [], [], 0

        def flush():
            tok, text, pos = (np.concatenate(x) for x in zip(*held))
            names, sizes, heads = (np.array(x, t) for x, t in zip(zip(*texts), (U, np.uint32, U)))
            if crowded.value is None:
                heads[:] = 0
            else:
                heads[np.isin(heads, crowded.value)] = 0
            sid = names[text]
            bucket = (np.where(pos & HEAVY, mix(sid), tok) % U(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
            blobs = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                at = order[a:b]
                own, which = np.unique(text[at], return_inverse=True)
                blobs.append(b"".join(c.tobytes() for c in (np.array([len(at), len(own)], np.int64), tok[at], names[own], heads[own], sizes[own], which.astype(np.uint32), pos[at])))
            for a in range(0, len(blobs), 64):
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order[cuts[a : min(a + 64, len(blobs))]]]), pa.array(blobs[a : a + 64], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for _, x in shingle_sets(batch.column(0)):
                n = len(x)
                if not n:
                    continue
                sid = fingerprint(x, turn)[0]
                if sid in seen:
                    continue
                seen.add(sid)
                m = n - (4 * n + 4) // 5 + 1
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, x), len(heavy) - 1)
                    hit = heavy[at] == x
                    light = x[~hit][:m]
                    rest = m - len(light)
                else:
                    light, rest = x[:m], 0
                pos = np.arange(m, dtype=np.uint32)
                if rest:
                    order = np.lexsort((x[hit], often[at[hit]]))[:rest]
                    light = np.concatenate((light, x[hit][order]))
                    pos[m - rest :] |= HEAVY
                held.append((light, np.full(m, len(texts)), pos))
                texts.append((sid, n, np.append(x[:FIRST], np.zeros(max(0, FIRST - n), U))))
                size += m
                if size > FLUSH:
                    yield from flush()
                    held, texts, size = [], [], 0
        if held:
            yield from flush()

    return run


FOUND = "hot boolean, tok long, a long, n long, pos long, b long, nb long, shared long, top long"
NAMES = ["hot", "tok", "a", "n", "pos", "b", "nb", "shared", "top"]


def _regions(batches):
    """Pairs of small regions that share no first shingle; members of large regions as rows."""
    parts, before = [], 0
    for batch in batches:
        for blob in batch.column(1):
            raw = blob.as_buffer()
            (k, m), at, part = np.frombuffer(raw, np.int64, 2).tolist(), 16, []
            for kind, count in ((U, k), (U, m), (U, FIRST * m), (np.uint32, m), (np.uint32, k), (np.uint32, k)):
                part.append(np.frombuffer(raw, kind, count, at))
                at += count * np.dtype(kind).itemsize
            tok, names, heads, sizes, which, pos = part
            parts.append((tok, names[which], sizes[which], pos, which.astype(np.int64) + before, heads.reshape(m, FIRST)))
            before += m
    if not parts:
        return
    tok, sid, n, pos, text, heads = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.lexsort((sid, tok))
    tok, sid, n, pos, text = tok[order], sid[order], n[order].astype(np.int64), pos[order], text[order]
    new = np.concatenate(([True], (tok[1:] != tok[:-1]) | (sid[1:] != sid[:-1])))
    tok, sid, n, pos, text = tok[new], sid[new], n[new], pos[new], text[new]
    heavy = (pos & HEAVY) > 0
    pos = (pos & ~HEAVY).astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1])))
    run = np.diff(np.concatenate((head, [len(tok)])))
    hot = heavy | np.repeat(run > LARGE, run)
    i64 = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())
    for a in range(0, len(at := np.flatnonzero(hot)), 100_000):
        part = at[a : a + 100_000]
        none = pa.nulls(len(part), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(part), bool)), i64(tok[part]), i64(sid[part]), i64(n[part]), i64(pos[part]), none, none, none, none], names=NAMES)
    pairs = []
    cold = ~hot[head] & (run > 1)
    for s in np.unique(run[cold]):
        first = head[cold & (run == s)]
        for i in range(s - 1):
            x = np.repeat(first + i, s - 1 - i)
            y = (first[:, None] + np.arange(i + 1, s)).ravel()
            ok = 5 * np.minimum(n[x], n[y]) >= 4 * np.maximum(n[x], n[y])
            x, y = x[ok], y[ok]
            for j in range(FIRST * FIRST):
                one, two = heads[text[x], j // FIRST], heads[text[y], j % FIRST]
                ok = (one != two) | (one == 0)
                x, y = x[ok], y[ok]
            if len(x):
                pairs.append((sid[x], sid[y], n[x], n[y], np.minimum(n[x] - pos[x], n[y] - pos[y])))
    if pairs:
        a, b, na, nb, top = (np.concatenate(c) for c in zip(*pairs))
        order = np.lexsort((b, a))
        a, b, na, nb, top = a[order], b[order], na[order], nb[order], top[order]
        at = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        shared, top = np.diff(np.append(at, len(a))), np.maximum.reduceat(top, at)
        a, b, na, nb = a[at], b[at], na[at], nb[at]
        for lo in range(0, len(a), 100_000):
            c = slice(lo, lo + 100_000)
            none = pa.nulls(len(a[c]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a[c]), bool)), none, i64(a[c]), i64(na[c]), none, i64(b[c]), i64(nb[c]), i64(shared[c]), i64(top[c])], names=NAMES)


def _verify(pairs, texts):
    """Sizes of intersection and union of each pair of a block; each text of the block is taken apart once."""
    names, sets = texts["sid"].to_pylist(), {}
    for i, x in shingle_sets(texts["text"]):
        sets[names[i]] = x
    a, b, common, either = pairs["a"].to_pylist(), pairs["b"].to_pylist(), [], []
    for x, y in zip(a, b):
        small, big = sorted((sets[x], sets[y]), key=len)
        at = np.minimum(np.searchsorted(big, small), len(big) - 1)
        c = int((big[at] == small).sum())
        common.append(c)
        either.append(len(small) + len(big) - c)
    return pa.table({"a": pairs["a"], "b": pairs["b"], "common": pa.array(common, pa.int64()), "either": pa.array(either, pa.int64())})


def compared(scratch: Scratch, pairs: DataFrame, points: DataFrame, texts: DataFrame, name: str, compare, schema: str) -> DataFrame:
    """``compare(pairs, texts)`` over blocks of the distinct pairs (a, b) of points (sid, tkey), with whole texts (tkey, text).

    Pairs are dealt to blocks of at most two times ``BLOCK`` points, mostly one for each family of similar
    points, so that a text travels once to a block and not once for every pair.
    """
    pairs = scratch.table(pairs.select("a", "b").distinct(), f"{name}-pairs")
    ends = pairs.select("a", "b").union(pairs.select("b", "a"))
    family = scratch.table(ends.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("_m")).select("sid", F.least("sid", "_m").alias("family")), f"{name}-family")
    side = lambda x: family.select(F.col("sid").alias(x), F.col("family").alias(f"f{x}"))
    keyed = scratch.table(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.least("fa", "fb").alias("family")), f"{name}-keyed")
    member = keyed.select("family", F.col("a").alias("sid")).union(keyed.select("family", F.col("b").alias("sid"))).distinct()
    parts = scratch.table(member.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).filter("parts > 1"), f"{name}-parts")
    parts = F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts  # large families only
    part = lambda x: F.pmod(F.xxhash64(x), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = keyed.join(parts, "family", "left").select("a", "b", "family", F.least(part("a"), part("b")).alias("p"), F.greatest(part("a"), part("b")).alias("q"))
    dealt = scratch.table(dealt, f"{name}-dealt")
    need = dealt.select("family", "p", "q", F.col("a").alias("sid")).union(dealt.select("family", "p", "q", F.col("b").alias("sid"))).distinct()

    named = scratch.table(points.join(family.select("sid"), "sid", "left_semi").select("sid", "tkey"), f"{name}-points")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    some = texts.join(named.select("tkey"), "tkey", "left_semi").groupBy("tkey").agg(F.first("text").alias("text"))
    held = scratch.table(some.join(named, "tkey"), f"{name}-texts")
    need = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    sent = need.join(held, "sid").select(F.col("family").alias("f"), F.col("p").alias("fp"), F.col("q").alias("fq"), "sid", "text")

    def freed(pairs, texts):
        try:
            return compare(pairs, texts)
        finally:
            if texts.nbytes > FREED_BYTES:
                release()

    out = dealt.groupBy("family", "p", "q").cogroup(sent.groupBy("f", "fp", "fq")).applyInArrow(freed, schema)
    out = scratch.table(out, f"{name}-verified")
    for x in ("texts", "keyed", "dealt", "pairs"):
        scratch.drop(f"{name}-{x}")
    return out


def verified(scratch: Scratch, pairs: DataFrame, points: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """(a, b, common, either) of the distinct pairs (a, b) of points."""
    return compared(scratch, pairs, points, texts, name, _verify, "a long, b long, common long, either long")


#: Length and place bounds of a pair; a text of n shingles has ceil(0.8 n) - 1 beyond its rarest.
POSSIBLE = """9 * (shared + least(coalesce(ha, 0), coalesce(hb, 0)) + greatest((4 * na + 4) div 5, (4 * nb + 4) div 5) - 1) >= 4 * (na + nb)
    and (9 * top >= 4 * (na + nb) or least(coalesce(ha, 0), coalesce(hb, 0)) > 0)"""
LINK = "100 * common >= 80 * either"


def jaccard_components(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    id_type = dict(docs.dtypes)[doc_id]
    out = grouped(spark, docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    return out.select("doc_id", "n_shingles", "component_id").withColumns({c: F.col(c).cast(id_type) for c in ("doc_id", "component_id")})


def grouped(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, tkey, label) of every row of ``docs`` (doc_id, text).

    tkey: md5 of the text; label: a number of the component, null for a text without shingles.
    """
    scratch = Scratch(spark, "jaccard")
    texts = docs.filter("text is not null").select(F.md5("text").alias("tkey"), "text")
    wide = docs.select("doc_id", "text", F.md5("text").alias("tkey"))
    for turn in range(8):
        profile = lambda batches: _profile(batches, turn)  # noqa: E731, B023
        raw = scratch.table(wide.mapInArrow(tidy(profile), "doc_id long, f1 long, f2 long, n long, tkey string, tok long, cnt long, heads array<long>"), "profile")
        rows = raw.filter("n is not null").drop("tok", "cnt")
        points = scratch.table(rows.filter("n > 0").groupBy("f1", "f2").agg(F.min("tkey").alias("tkey"), F.min("doc_id").alias("least_id"), F.max("n").alias("n"), F.first("heads").alias("heads")), "points")
        # sets are known by 64 of their 128 bits: where two differ in the others alone, all take other bits
        about = points.agg(F.count("*"), F.count_distinct("f1"), F.sum(F.col("n") - F.ceil(0.8 * F.col("n")) + 1)).first()
        if about[0] == about[1]:
            break
    counts = scratch.table(raw.filter("n is null").groupBy("tok").agg(F.sum("cnt").alias("cnt")).filter(F.col("cnt") > LARGE), "counts")
    least = LARGE
    while counts.filter(F.col("cnt") > least).count() > FREQUENT_MOST:
        least *= 2
    top = counts.filter(F.col("cnt") > least).toArrow()  # at most FREQUENT_MOST rows
    tok = top["tok"].to_numpy().view(U)
    order = np.argsort(tok)
    frequent = spark.sparkContext.broadcast((tok[order], top["cnt"].to_numpy()[order]))

    sids = points.select(F.col("f1").alias("sid"), "tkey")
    heads = points.select(F.col("f1").alias("sid"), "n", F.explode("heads").alias("tok")).filter("tok <> 0")
    members = scratch.table(heads.groupBy("tok").agg(F.count("*").alias("members")).filter("members > 1"), "heads")
    # each has more than LARGE sets, so there are few; of more than FREQUENT_MOST no head is used
    crowd = members.filter(F.col("members") > LARGE).select("tok").limit(FREQUENT_MOST + 1).toArrow()["tok"].to_numpy().view(U)
    if len(crowd) > FREQUENT_MOST:
        members, crowd = members.filter("false"), None
    held = heads.join(members.filter(F.col("members") <= LARGE).select("tok"), "tok")
    ahead = held.toDF("tok", "a", "na").join(held.toDF("tok", "b", "nb"), "tok").filter("a < b and 5 * least(na, nb) >= 4 * greatest(na, nb)").select("a", "b")
    crowded = spark.sparkContext.broadcast(crowd)
    n_buckets = max(partitions(spark), math.ceil(24 * (about[2] or 0) / BUCKET_BYTES))
    blobs = docs.select("text").mapInArrow(tidy(_postings(n_buckets, frequent, crowded, turn)), "bucket int, blob binary").repartition(n_buckets, "bucket")
    found = scratch.table(blobs.mapInArrow(tidy(_regions), FOUND), "found")

    hot = scratch.table(found.filter("hot").select("tok", F.col("a").alias("sid"), "n", "pos"), "hot")
    # What two texts have in common: the shared shingles among their rarest (those of large regions at most all),
    # and no more than one of them has beyond.  Nor more than either has from the first shared one on.
    hots = hot.groupBy("sid").agg(F.count("*").alias("h"))
    counted = found.filter("not hot").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("top").alias("top"), F.max("n").alias("na"), F.max("nb").alias("nb"))
    counted = counted.join(hots.select(F.col("sid").alias("a"), F.col("h").alias("ha")), "a", "left").join(hots.select(F.col("sid").alias("b"), F.col("h").alias("hb")), "b", "left")
    small = counted.filter(POSSIBLE).select("a", "b")
    # central members first: least share of rarer shingles
    rank = F.struct((F.col("pos") / F.col("n")).alias("share"), F.col("sid"), F.col("n"))
    pivots = hot.groupBy("tok").agg(F.min(rank).alias("p"), F.count("*").alias("members")).filter("members > 1").select("tok", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pn"))
    pivots = scratch.table(pivots, "pivots")
    pivots = F.broadcast(pivots) if pivots.count() <= BROADCAST_ROWS else pivots  # a row for each large region
    star = hot.join(pivots, "tok").filter("sid <> pivot and 5 * least(n, pn) >= 4 * greatest(n, pn)").select(F.col("pivot").alias("a"), F.col("sid").alias("b"))
    checked = verified(scratch, small.unionByName(ahead).unionByName(star), sids, texts, "first")
    labels = components(scratch, checked.filter(LINK).select("a", "b"), "cc0")
    for k in range(1, PIVOT_ROUNDS + 1):
        if not hot.limit(1).count():
            break
        label_of = scratch.table(hot.select("sid").distinct().join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("label", "sid").alias("label")), f"labels-{k}")
        member = hot.join(label_of, "sid")
        if k < PIVOT_ROUNDS:  # the next pivot: the most central member outside the last one's component
            lead = member.groupBy("tok").agg(F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), F.col("sid"), F.col("label"))).alias("p")).select("tok", F.col("p.label").alias("lead"))
            rest = member.join(lead, "tok").filter("label <> lead")
            second = rest.groupBy("tok").agg(F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), F.col("sid"), F.col("n"), F.col("pos"), F.col("label"))).alias("p")).select("tok", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp"), F.col("p.label").alias("pl"))
            more = member.join(second, "tok").filter("label <> pl and 5 * least(n, pn) >= 4 * greatest(n, pn) and 9 * least(n - pos, pn - pp) >= 4 * (n + pn)").select(F.col("pivot").alias("a"), F.col("sid").alias("b"))
        else:  # what the pivots leave: different components, within the window of distances to the pivot
            far = checked.select(F.col("a").alias("pivot"), F.col("b").alias("sid"), (1 - F.col("common") / F.col("either")).alias("d"))
            placed = member.join(pivots.select("tok", "pivot"), "tok").join(far, ["pivot", "sid"], "left").withColumn("d", F.when(F.col("sid") == F.col("pivot"), 0.0).otherwise(F.col("d")))
            placed = scratch.table(placed.select("tok", "sid", "n", "pos", "label", "d").filter("9 * (n - pos) >= 8 * n or 10 * (n - pos) >= 8 * n"), "placed")
            x, y = placed.toDF("tok", "a", "an", "ap", "al", "ad"), placed.toDF("tok", "b", "bn", "bp", "bl", "bd")
            bounds = "a < b and al <> bl and 5 * least(an, bn) >= 4 * greatest(an, bn) and 9 * least(an - ap, bn - bp) >= 4 * (an + bn) and (ad is null or bd is null or abs(ad - bd) <= 0.2 + 1e-9)"
            more = x.join(y, "tok").filter(bounds).select("a", "b")
        again = verified(scratch, more.join(checked.select("a", "b"), ["a", "b"], "left_anti"), sids, texts, f"again-{k}")
        checked = checked.unionByName(again)
        labels = extended(scratch, labels, again.filter(LINK).select("a", "b"), f"cc{k}")

    least_id = points.join(labels.withColumnRenamed("node", "f1"), "f1", "left").withColumn("label", F.coalesce("label", "f1"))
    named = scratch.table(least_id.groupBy("label").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n")).filter("n > 1").drop("n"), "named")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named  # components of several sets alone
    final = scratch.table(least_id.join(named, "label", "left").select("f1", "f2", F.coalesce("component_id", "least_id").alias("component_id"), "label"), "final")
    scratch.sweep("profile", "final")
    full = rows.filter("n > 0").join(final, ["f1", "f2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "tkey", "label")
    none = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "tkey", F.lit(None).cast("long").alias("label"))
    return full.unionByName(none)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its shingles and the least doc_id that links reach."""
    return jaccard_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS to_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.to_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(to_id) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
