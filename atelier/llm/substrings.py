"""Substring dedup: near-duplicate passages by compact windows.

Tokens are five-word shingles; a passage is a window of 50 words, 46 shingles.

1. Compact windows.  In the Cartesian tree of a text over the min-hash of its tokens, a node is the least of all
   subsequences between the next lesser tokens on its two sides.  Nodes with 46 tokens or more below them are the top
   of the tree (an ancestor spans more); the windows of 46 tokens under one of them are an interval of starts that
   share its signature, and the nodes' intervals cover all starts.
2. Interval joins.  Six hash functions give three pairs of trees; the intervals of a pair are joined to the
   overlaps that share both signatures.  Texts that hold overlaps of one pair of signatures are a region.
3. Regions of ``SMALL`` texts or fewer compare all.  In a larger one each text is compared with the least text that
   agrees on the other hashes, these with the least of all, and each with its next neighbours; then, in rounds, with the text of the region that has most links so far and was not taken before, and last those whose windows there are similar and add something.
4. Exact passages don't rest on regions: every window of 46 shingles is also grouped by a hash of its sequence,
   and all texts of a group are compared with its least, which holds that passage too.
5. Every comparison is verified on whole texts: a passage of x counts where 41 of the 46 shingles of a window are in
   the aligned window of y and the other way round (a Jaccard similarity of 0.8 where none repeats).

An exact passage of 50 words is always found.  A passage at similarity 0.8 comes into a common region with
probability 0.95 for a single window (longer passages have many).  What the rounds leave of a large region is searched
in the region itself: each of its windows that is not covered is held against all others of the region, counted by the
shingles they share, and so are windows of different classes; texts are compared where such windows are similar, one
after the other until nothing is added.  So classes and covered windows are those of all pairs of windows of every
region, while the pairs grow with what they add and not with the square of a region; n_links counts, and partners
lists, the pairs that were compared, and copies of a passage that a class already holds are not all paired.

A signature that very many texts of one task share is not gathered: its texts meet the least of them there, and
only those travel on (``HOT``); the number of buckets grows with the data.

Defined results: texts under 50 words, empty or null have no passages; texts of any length are taken whole; a text
that another row repeats word for word is one passage in whole; passages repeated only within one text do not count;
ties of a min-hash go to the left; letters A-Z count as a-z; a null doc_id keeps its row but is nobody's partner; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components, extended
from .jaccard import BROADCAST_ROWS, BUCKET_BYTES, compared
from .scratch import Scratch, partitions
from .textkit import U, Words, _power, buffers, mix, spans, tidy, windows

PASSAGE = 50
K = 5
T = PASSAGE - K + 1
#: Common shingles of two windows of T at similarity 0.8.
NEED = -(-16 * T // 18)
SALTS = [U(0x9AE16A3B2F90404F), U(0xC949C7DEFEBCC3A1), U(0xB492B66FBE98F273), U(0x8BB84B93962EACC9), U(0xD1B54A32D192ED03), U(0xAEF17502108EF2D9)]
FLUSH = 1_000_000
#: Texts of a region that are all compared; neighbours in a larger one; members of one signature in a flush that stay where they are.
SMALL, NEXT, HOT = 16, 4, 4096
#: Rounds of comparing large regions with their text of most links.
ROUNDS = 4
#: Bytes of region records for each word of the input, about.
RECORD_BYTES = 6
#: Places in the other text for each shared shingle up to which a comparison takes all pairs of places; in texts that repeat themselves more it goes by shifts, with the same result.
FEW_PLACES = 4
#: Pairs of places that are counted at a time.
PAIRS = 1 << 20
#: Cells of a table of windows by shingles, or by windows, up to which texts that repeat themselves are counted in one product; larger ones go shift by shift, with the same result.
CELLS = 1 << 21
#: Cells of a table of a region's shared shingles by its texts; the texts of larger regions are asked in parts.
REGION_CELLS = 1 << 24
F1, F2 = U(0x2545F4914F6CDD1D), U(0xDA942042E4DD58B5)


def sequences(column: pa.Array):
    """(first row, number of rows, shingles, their offsets, word counts) of runs of texts."""
    data, offs = buffers(column)
    for a, b in spans(offs):
        words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], lower=True)
        x, at = windows(words.hashes(), words.first, K)
        yield a, b - a, x, at, np.diff(words.first)


def identities(x: np.ndarray, at: np.ndarray, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the sequence of shingles of each text; ``turn`` chooses others."""
    out = []
    for salt in (F1 + U(2 * turn), F2 + U(2 * turn)):
        up, down = _power(len(x) + 1)
        run = np.zeros(len(x) + 1, U)
        np.cumsum(mix(x ^ salt) * up[:-1], out=run[1:])
        out.append(mix((run[at[1:]] - run[at[:-1]]) * down[at[:-1]] + np.diff(at).astype(U)))
    return out[0], out[1]


def _profile(batches, turn: int = 0):
    for batch in batches:
        n = batch.num_rows
        f1, f2, words = np.zeros(n, U), np.zeros(n, U), np.zeros(n, np.int64)
        for a, m, x, at, count in sequences(batch.column(1)):
            f1[a : a + m], f2[a : a + m] = identities(x, at, turn)
            words[a : a + m] = count
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(words), batch.column(2)], names=["doc_id", "f1", "f2", "n_words", "tkey"])


def minima(x: np.ndarray, salt: np.uint64) -> np.ndarray:
    """For each start of a window of T tokens, the place of its least hash (the leftmost of equals)."""
    n = len(x)
    bits = U(max(1, int(n - 1).bit_length()))
    low = mix(x ^ salt) >> bits << bits | np.arange(n, dtype=np.int64).astype(U)
    width = 1
    while 2 * width <= T:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < T:
        low = np.minimum(low[: len(low) - (T - width)], low[T - width :])
    return (low & ((U(1) << bits) - U(1))).astype(np.int64)


def compact_windows(place: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, first start, last start) of the Cartesian tree's nodes with T tokens or more below them, from the places of the windows' minima.

    The windows under a node are consecutive: they hold it and end before the next lesser token on either side.
    """
    head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    return place[head], head, np.append(head[1:], len(place)) - 1


def interval_join(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node of a, node of b, first, last) of all overlaps of two lists of intervals, each of which covers all starts in order."""
    first = np.union1d(a[1], b[1])
    last = np.append(first[1:] - 1, a[2][-1])
    return a[0][np.searchsorted(a[1], first, "right") - 1], b[0][np.searchsorted(b[1], first, "right") - 1], first, last


def regions(x: np.ndarray, at: np.ndarray):
    """For each pair of hashes: (its number, places of all minima, text, region key, first start, last start) of every interval of starts that shares a pair of signatures."""
    if len(x) < T:
        return
    n = len(x) - T + 1
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
    end = at[1:][text] - T
    place = [minima(x, s) for s in SALTS]
    trees = [compact_windows(p, text) for p in place]
    for k in range(0, len(SALTS), 2):
        one, two, start, last = interval_join(trees[k], trees[k + 1])
        good = end[start] >= start  # windows that cross into the next text belong to neither
        one, two, i = one[good], two[good], start[good]
        key = mix(mix(x[one] ^ SALTS[k]) * U(0x9E3779B97F4A7C15) + mix(x[two] ^ SALTS[k + 1]) + U(k))
        yield k, place, text[i], key, i, np.minimum(last[good], end[i])


def signatures(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, region key, agreement on the other hashes) of every interval of starts that shares a pair of signatures."""
    out, low = [(np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.uint32))], None
    for k, place, text, key, i, _ in regions(x, at):
        low = [(mix(x[p] ^ s) & U(255)).astype(np.uint32) for p, s in zip(place, SALTS)] if low is None else low
        rest = np.zeros(len(i), np.uint32)
        for j, v in enumerate(v for m, v in enumerate(low) if m not in (k, k + 1)):
            rest |= v[i] << np.uint32(8 * j)
        out.append((text, key, rest))
    return tuple(np.concatenate(c) for c in zip(*out))


WIDE = "bucket int, blob binary, a long, b long, key long"


def _rows(a=None, b=None, key=None, bucket=None, blob=None) -> pa.RecordBatch:
    """Rows of ``WIDE``: a blob for a bucket, a pair of texts, or a text of a hot region."""
    n = len(a if a is not None else bucket)
    i64 = lambda v: pa.nulls(n, pa.int64()) if v is None else pa.array(np.ascontiguousarray(v).view(np.int64))
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()) if bucket is None else pa.array(bucket), pa.nulls(n, pa.binary()) if blob is None else pa.array(blob, pa.binary()), i64(a), i64(b), i64(key)], names=["bucket", "blob", "a", "b", "key"])


def _sorted(key: np.ndarray, sid: np.ndarray, rest: np.ndarray):
    """Records in the order of key, agreement and text, each once, and where the keys begin."""
    order = np.lexsort((sid, rest, key))
    key, sid, rest = key[order], sid[order], rest[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (rest[1:] != rest[:-1]) | (sid[1:] != sid[:-1]))) if len(key) else np.zeros(0, bool)
    key, sid, rest = key[new], sid[new], rest[new]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key, sid, rest, head, np.diff(np.append(head, len(key)))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of different texts, the lesser first."""
    x, y = np.minimum(a, b), np.maximum(a, b)
    x, y = x[x != y], y[x != y]
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(x) else np.zeros(0, bool)
    return x[new], y[new]


def _stars(key: np.ndarray, sid: np.ndarray, rest: np.ndarray, head: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, which are leads): each text with the least of equal agreement, these with the least of the region."""
    new_rest = np.concatenate(([True], (key[1:] != key[:-1]) | (rest[1:] != rest[:-1])))
    group = np.flatnonzero(new_rest)
    lead = sid[group][np.cumsum(new_rest) - 1]
    least = np.repeat(np.minimum.reduceat(sid, head), run)[group]
    return np.concatenate((lead, least)), np.concatenate((sid, sid[group])), new_rest


def _windows(n_buckets: int, turn: int = 0):
    def run(batches):
        seen, held, size = set(), [], 0

        def flush():
            key, sid, rest, head, runs = _sorted(*(np.concatenate(c) for c in zip(*held)))
            hot = np.repeat(runs > HOT, runs)
            if hot.any():
                # the region is large whatever else comes: its texts meet here, are rows of it, and only leads travel on
                k, s, r, h, n = _sorted(key[hot], sid[hot], rest[hot])
                a, b, lead = _stars(k, s, r, h, n)
                x, y = _distinct(a, b)
                if len(x):
                    yield _rows(a=x, b=y)
                yield _rows(a=s, key=k)
                # enough of them that the region is large there too, so that texts of other tasks are rows of it as well
                on = lead | (np.arange(len(k)) - np.repeat(h, n) <= SMALL)
                key, sid, rest = (np.concatenate((c[~hot], d[on])) for c, d in ((key, k), (sid, s), (rest, r)))
            bucket = (key % U(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
            blobs = [b"".join(c[order[a:b]].tobytes() for c in (key, sid, rest)) for a, b in zip(cuts[:-1], cuts[1:])]
            for a in range(0, len(blobs), 64):
                yield _rows(bucket=bucket[order[cuts[a : min(a + 64, len(blobs))]]], blob=blobs[a : a + 64])

        for batch in batches:
            for _, m, x, at, _ in sequences(batch.column(0)):
                f1, _ = identities(x, at, turn)
                fresh = np.array([s not in seen and not seen.add(s) for s in f1.tolist()], bool)
                text, key, rest = signatures(x, at)
                keep = fresh[text] if len(text) else np.zeros(0, bool)
                if keep.any():
                    held.append((key[keep], f1[text[keep]], rest[keep]))
                    size += int(keep.sum())
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


FOUND = "a long, b long, key long"


def _pairs(batches):
    """Pairs to compare (a, b) of every region, and the texts (a, key) of large ones."""
    parts = []
    for batch in batches:
        through = batch.select(["a", "b", "key"]).filter(pc.is_valid(batch.column("a")))
        if through.num_rows:
            yield through
        for blob in batch.column("blob").drop_null():
            raw = blob.as_buffer()
            k = raw.size // 20
            parts.append((np.frombuffer(raw, U, k), np.frombuffer(raw, U, k, 8 * k), np.frombuffer(raw, np.uint32, k, 16 * k)))
    if not parts:
        return
    key, sid, rest, head, run = _sorted(*(np.concatenate(c) for c in zip(*parts)))
    del parts
    a, b = [], []
    for size in np.unique(run[(run > 1) & (run <= SMALL)]):
        first = head[run == size]
        for i in range(size - 1):
            a.append(sid[np.repeat(first + i, size - 1 - i)])
            b.append(sid[(first[:, None] + np.arange(i + 1, size)).ravel()])
    large = np.repeat(run > SMALL, run)
    if large.any():
        k, s, r, h, n = _sorted(key[large], sid[large], rest[large])
        x, y, _ = _stars(k, s, r, h, n)
        a.append(x)
        b.append(y)
        order = np.lexsort((s, k))  # by text, so that regions of the same texts have the same neighbours
        for step in range(1, NEXT):
            near = np.flatnonzero(k[order[step:]] == k[order[:-step]])
            a.append(s[order[near]])
            b.append(s[order[near + step]])
        for lo in range(0, len(k), 100_000):
            yield _rows(a=s[lo : lo + 100_000], key=k[lo : lo + 100_000]).select(["a", "b", "key"])
    if a:
        x, y = _distinct(np.concatenate(a), np.concatenate(b))
        for lo in range(0, len(x), 100_000):
            yield _rows(a=x[lo : lo + 100_000], b=y[lo : lo + 100_000]).select(["a", "b", "key"])


def _open_windows(n_buckets: int):
    """Blobs by bucket of the intervals of texts in their large regions: key, text, component, shingles, and which windows have a word that is not covered."""

    def run(batches):
        held, size = [], 0

        def flush():
            key, sid, label, n, x, free = (np.concatenate(c) for c in zip(*held))
            bucket = (key % U(n_buckets)).astype(np.int32)
            ends = np.cumsum(n)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                i = order[a:b]
                at = np.repeat(ends[i] - np.cumsum(n[i]), n[i]) + np.arange(n[i].sum())
                blob = b"".join(c.tobytes() for c in (np.array([len(i), len(at)], np.int64), key[i], sid[i], label[i], n[i], x[at], free[at]))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[i[:1]]), pa.array([blob], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            sids, labels = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("sid", "label"))
            keys, covered = batch.column("keys").to_pylist(), batch.column("spans").to_pylist()
            for first, m, x, at, _ in sequences(batch.column("text")):
                free = np.zeros(len(x), bool)
                for d in range(m):
                    words = np.zeros(at[d + 1] - at[d] + K - 1, bool)
                    for span in covered[first + d] or []:
                        words[span["lo"] : span["hi"]] = True
                    left = np.concatenate(([0], np.cumsum(~words)))
                    own = left[PASSAGE:] > left[:-PASSAGE]
                    free[at[d] : at[d] + len(own)] = own
                mine = np.unique(np.array([mix_key(k, first + d) for d in range(m) for k in keys[first + d]], U))
                for _, _, text, key, lo, hi in regions(x, at):
                    at_home = mix(key ^ (first + text).astype(U))
                    hot = np.isin(at_home, mine)
                    text, key, lo, n = text[hot], key[hot], lo[hot], hi[hot] - lo[hot] + T
                    i = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    held.append((key, sids[first + text], labels[first + text], n, x[i], free[i]))
                    size += len(i)
                    if size > FLUSH:
                        yield from flush()
                        held, size = [], 0
        if size:
            yield from flush()

    return run


def mix_key(key: int, row: int) -> np.uint64:
    return mix(np.array([key], np.int64).view(U) ^ U(row))[0]


def _search(batches):
    """Pairs of texts of large regions that add something, each found by a window of a region: to a window with a word that is not
    covered, one text after the other that covers some of it; between components, one pair that links them."""
    parts = []
    for batch in batches:
        for blob in batch.column("blob").drop_null():
            raw, at, part = blob.as_buffer(), 16, []
            m, k = np.frombuffer(raw, np.int64, 2).tolist()
            for kind, count in ((U, m), (np.int64, m), (np.int64, m), (np.int64, m), (U, k), (bool, k)):
                part.append(np.frombuffer(raw, kind, count, at))
                at += count * np.dtype(kind).itemsize
            parts.append(part)
    if not parts:
        return
    key, sid, label, n, x, free = (np.concatenate(c) for c in zip(*parts))
    del parts
    begin = np.cumsum(n) - n
    order = np.lexsort((sid, key))
    head = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    a, b = [], []
    for i in np.split(order, head[1:]):
        if (label[i] == label[i[0]]).all() and not any(free[begin[j] : begin[j] + n[j] - T + 1].any() for j in i):
            continue
        # intervals of one content have met as equal windows: those of two texts stand for all, since a text is not compared with itself
        x_of, own = [x[begin[j] : begin[j] + n[j]] for j in i], {}
        for d, j in enumerate(i):
            same = own.setdefault(x_of[d].tobytes(), {})
            if len(same) < 2:
                same.setdefault(sid[j], d)
        keep = np.array([d for same in own.values() for d in same.values()])
        for one, two in _additions(sid[i[keep]], label[i[keep]], [x_of[d] for d in keep], [free[begin[j] : begin[j] + n[j] - T + 1] for j in i[keep]]):
            a.append(one)
            b.append(two)
    if a:
        for rows in _pair_rows(np.array(a), np.array(b)):
            yield rows.select(["a", "b"])


def _additions(sid: np.ndarray, label: np.ndarray, x: list, free: list):
    """(a, b) of the texts of one region whose windows in it are similar and add a covered word or a link between components."""
    size = np.array([len(v) for v in x])
    item, flat = np.repeat(np.arange(len(x)), size), np.concatenate(x)
    _, number = np.unique(flat, return_inverse=True)
    # shingles that several texts of the region hold, numbered; the others can't be common
    order = np.lexsort((sid[item], number))
    first = np.flatnonzero(np.concatenate(([True], number[order][1:] != number[order][:-1])))
    owner = sid[item][order]
    several = np.maximum.reduceat(owner, first) != np.minimum.reduceat(owner, first)
    number = np.where(several[number], np.cumsum(several)[number] - 1, -1)
    begin = np.cumsum(size) - size
    rich = []
    for k in range(len(x)):
        so_far = np.concatenate(([0], np.cumsum(number[begin[k] : begin[k] + size[k]] >= 0)))
        rich.append(so_far[T:] - so_far[:-T] >= NEED)
    able = np.flatnonzero([r.any() for r in rich])
    names, of, count = np.unique(label[able], return_inverse=True, return_counts=True)
    root = list(range(len(names)))

    def top(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    most = int(np.argmax(count)) if len(count) else 0
    asks = [d for d, k in enumerate(able) if of[d] != most or (rich[k] & free[k]).any()]
    if not asks:
        return
    texts = {}

    def text(k):
        if k not in texts:
            t = texts[k] = _Text(x[k])
            t.add(np.flatnonzero(~free[k]))
        return texts[k]

    n_shared = int(several.sum())
    width = max(1, REGION_CELLS // max(1, n_shared))
    for lo in range(0, len(able), width):
        some = able[lo : lo + width]
        holds = np.zeros((n_shared, len(some)), bool)  # which of these texts hold a shingle
        for d, k in enumerate(some):
            mine = number[begin[k] : begin[k] + size[k]]
            holds[mine[mine >= 0], d] = True
        for q in asks:
            k, t = able[q], text(able[q])
            want = rich[k] & t.free()
            mine = number[begin[k] : begin[k] + size[k]]
            other = np.array([top(c) for c in of[lo : lo + width]]) != top(of[q])
            place = np.flatnonzero(mine >= 0)
            near = holds[mine[place]]
            at = np.flatnonzero((near.sum(axis=0) >= NEED) & (sid[some] != sid[k]) & (other | want.any()))
            if not len(at):
                continue
            so_far = np.zeros((size[k] + 1, len(at)), np.int16)
            so_far[place + 1] = near[:, at]
            np.cumsum(so_far, axis=0, out=so_far)
            fits = so_far[T:] - so_far[:-T] >= NEED
            fits[~rich[k]] = False
            while want.any() and len(at):
                gain = fits[want].sum(axis=0)
                best = int(np.argmax(gain))
                if not gain[best]:
                    break
                if linked(t, text(some[at[best]])):
                    yield sid[k], sid[some[at[best]]]
                    root[max(top(of[q]), top(of[lo + at[best]]))] = min(top(of[q]), top(of[lo + at[best]]))
                fits[:, best] = False
                want = rich[k] & t.free()
            for d in np.flatnonzero(fits.any(axis=0)):
                if top(of[q]) != top(of[lo + at[d]]) and linked(t, text(some[at[d]])):
                    yield sid[k], sid[some[at[d]]]
                    root[max(top(of[q]), top(of[lo + at[d]]))] = min(top(of[q]), top(of[lo + at[d]]))


def _sequences(n_buckets: int, turn: int = 0):
    """Every window of T shingles: blobs of (texts, 40 bits of its hash, place of its text) by bucket; pairs of texts that meet here."""

    def run(batches):
        seen, held, sids, size = set(), [], [], 0

        def flush():
            names = np.array(sids, U)
            by_name = np.argsort(names)
            w, least = (np.concatenate([held[i][c] for i in by_name]) for c in (0, 1))
            t = np.repeat(np.arange(len(names)), [len(held[i][0]) for i in by_name])
            names = names[by_name]
            order = np.argsort(w, kind="stable")
            w, t, least = w[order], t[order], least[order]
            new = np.concatenate(([True], w[1:] != w[:-1]))
            yield from _pair_rows(names[t[new][np.cumsum(new) - 1]], names[t])
            w, t = w[new], t[new]
            # equal windows have equal minima, and so have most neighbours: a common passage comes to few buckets
            bucket = (mix(least[new] + (w & U(3))) % U(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
            blobs = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                used, at = np.unique(t[order[a:b]], return_inverse=True)
                high = w[order[a:b]] >> U(24)
                blobs.append(b"".join(x.tobytes() for x in (np.array([len(used)], U), names[used], high.astype(np.uint32), (high >> U(32)).astype(np.uint8), at.astype(np.uint16))))
            for a in range(0, len(blobs), 64):
                part = blobs[a : a + 64]
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order[cuts[a : a + len(part)]]]), pa.array(part, pa.binary()), none, none], names=["bucket", "blob", "a", "b"])

        for batch in batches:
            for _, m, x, at, _ in sequences(batch.column(0)):
                f1, _ = identities(x, at, turn)
                w = window_hashes(x)
                least = mix(x[minima(x, SALTS[0])] ^ SALTS[0]) if len(w) else w
                for d in range(m):
                    if at[d + 1] - at[d] < T or int(f1[d]) in seen:
                        continue
                    seen.add(int(f1[d]))
                    own = w[at[d] : at[d + 1] - T + 1]
                    held.append((own, least[at[d] : at[d + 1] - T + 1]))
                    sids.append(f1[d])
                    size += len(own)
                    if size > FLUSH or len(sids) == 65535:
                        yield from flush()
                        held, sids, size = [], [], 0
        if held:
            yield from flush()

    return run


def _pair_rows(a: np.ndarray, b: np.ndarray):
    """Distinct pairs of different texts, the lesser first, as rows without a blob."""
    both = np.stack((np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]), axis=1)
    if len(both):
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        both = both[np.concatenate(([True], (both[1:] != both[:-1]).any(axis=1)))]
    for lo in range(0, len(both), 100_000):
        part = both[lo : lo + 100_000]
        cols = [pa.array(np.ascontiguousarray(part[:, i]).view(np.int64)) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary()), *cols], names=["bucket", "blob", "a", "b"])


#: Slices in which the windows of one bucket are grouped.
SLICES = 8


def _equal(batches):
    """Comparisons of every group of equal windows: each text with the least of the group.  Pairs pass through."""
    parts = []
    for batch in batches:
        rows = batch.select(["a", "b"]).filter(pc.is_valid(batch.column("a")))
        if rows.num_rows:
            yield rows
        for blob in batch.column("blob").drop_null():
            raw = blob.as_buffer()
            m = int(np.frombuffer(raw, U, 1)[0])
            k = (raw.size - 8 - 8 * m) // 7
            at = 8 + 8 * m
            parts.append((np.frombuffer(raw, U, m, 8), np.frombuffer(raw, np.uint32, k, at), np.frombuffer(raw, np.uint8, k, at + 4 * k), np.frombuffer(raw[at + 5 * k :].to_pybytes(), np.uint16, k)))
    found = []
    for r in range(SLICES):
        held = []
        for names, low, high, t in parts:
            i = np.flatnonzero(low % np.uint32(SLICES) == r)
            held.append((low[i].astype(U) | high[i].astype(U) << U(32), names[t[i]]))
        if not held:
            continue
        w, sid = (np.concatenate(c) for c in zip(*held))
        if not len(w):
            continue
        order = np.argsort(w, kind="stable")
        w, sid = w[order], sid[order]
        new = np.concatenate(([True], w[1:] != w[:-1]))
        lead = np.minimum.reduceat(sid, np.flatnonzero(new))[np.cumsum(new) - 1]
        both = np.stack((lead, sid), axis=1)[lead != sid]
        if len(both):
            found.append(np.unique(both, axis=0))
    if found:
        both = np.concatenate(found)
        for rows in _pair_rows(both[:, 0], both[:, 1]):
            yield rows.select(["a", "b"])


def window_hashes(x: np.ndarray) -> np.ndarray:
    """A hash of the sequence of each window of T shingles."""
    if len(x) < T:
        return np.zeros(0, U)
    up, down = _power(len(x) + 1)
    run = np.zeros(len(x) + 1, U)
    np.cumsum(x * up[:-1], out=run[1:])
    n = len(x) - T + 1
    return mix((run[T:] - run[:-T]) * down[:n])


def _counts(p: np.ndarray, q: np.ndarray, d: int, lo: int, hi: int) -> np.ndarray:
    """For starts lo..hi of x: how many places p of the window have their shingle in the window of y that starts d later.

    Pairs of places of shifts near d, p ascending, and q ascending for equal p.
    """
    other = q - d
    first, last = np.maximum(p, other) - T + 1, np.minimum(p, other)
    # a place counts once for a start, however many places of y it meets there: bounds grow with them
    again = np.flatnonzero(p[1:] == p[:-1]) + 1
    first[again] = np.maximum(first[again], last[again - 1] + 1)
    first, last = np.maximum(first, lo), np.minimum(last, hi)
    ok = first <= last
    step = np.bincount(first[ok] - lo, minlength=hi - lo + 2) - np.bincount(last[ok] + 1 - lo, minlength=hi - lo + 2)
    return np.cumsum(step)[:-1]


class _Text:
    """A text in a block: its distinct shingles and windows in order with their places, and its words that similar windows cover so far."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        self.shingles, self.windows = _grouped(x), _grouped(window_hashes(x))
        self.words = np.zeros(self.n + K - 1, bool)
        self._free = None

    def add(self, starts: np.ndarray) -> None:
        if len(starts):
            step = np.zeros(len(self.words) + 1, np.int64)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + PASSAGE, -1)
            self.words |= np.cumsum(step)[:-1] > 0
            self._free = None

    def free(self) -> np.ndarray:
        """For each start whether its window has a word that is not covered."""
        if self._free is None:
            left = np.concatenate(([0], np.cumsum(~self.words)))
            self._free = left[PASSAGE:] > left[:-PASSAGE]
        return self._free


def _grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, where their places begin and the end, places in the order of values)."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    head = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return s[head], np.append(head, len(s)).astype(np.int32), order.astype(np.int32)


def _common(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the values that two groupings have in common, in both."""
    if len(a[0]) > len(b[0]):
        return _common(b, a)[::-1]
    if not len(a[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    own = np.flatnonzero(b[0][at] == a[0])
    return own, at[own]


def _places(group: tuple, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, which of the numbers) of all places of some values, in the order of values and places."""
    first = group[1][number].astype(np.int64)
    times = group[1][number + 1] - first
    if len(times) and times.max() == 1:
        return group[2][first].astype(np.int64), np.arange(len(number))
    ends = np.cumsum(times)
    which = np.repeat(np.arange(len(number)), times)
    return group[2][np.repeat(first - (ends - times), times) + np.arange(len(which))].astype(np.int64), which


class _Near:
    """Places of the common shingles in a text of n, by number: the nearest place of a number at or after, and before, any other place."""

    def __init__(self, place: np.ndarray, which: np.ndarray, n: int):
        self.width = n + 1
        self.at = which * self.width + place

    def near(self, number: np.ndarray, own: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        """(own, place): places less than T away from own + d, before and after it, in order."""
        aim = np.clip(own + d, 0, self.width - 1)
        after = np.searchsorted(self.at, number * self.width + aim)
        both = []
        for i in (after - 1, after):
            found = self.at[np.clip(i, 0, len(self.at) - 1)]
            place = found % self.width
            ok = (i >= 0) & (i < len(self.at)) & (found // self.width == number) & (np.abs(place - own - d) < T)
            both.append((own[ok], place[ok]))
        own, place = (np.concatenate(c) for c in zip(*both, strict=True))
        order = np.argsort(2 * own + (place >= own + d), kind="stable")
        return own[order], place[order]


def _shifts(hit: np.ndarray, first: np.ndarray, times: np.ndarray, places: np.ndarray, n: int, m: int) -> np.ndarray:
    """How many pairs of places have each shift -n..m, counted in parts of bounded size."""
    out, begun = np.zeros(n + m + 1, np.int64), 0
    ends = np.cumsum(times)
    while begun < len(hit):
        done = max(begun + 1, int(np.searchsorted(ends, (ends[begun - 1] if begun else 0) + PAIRS, "right")))
        t = times[begun:done]
        e = np.cumsum(t)
        q = places[np.repeat(first[begun:done] - (e - t), t) + np.arange(e[-1])]
        out += np.bincount(q - np.repeat(hit[begun:done], t) + n, minlength=n + m + 1)
        begun = done
    return out


def _rich(places: np.ndarray, n: int) -> np.ndarray:
    """For each start whether the window has ``NEED`` of the places."""
    so_far = np.concatenate(([0], np.cumsum(np.bincount(places, minlength=n))))
    return so_far[T:] - so_far[:-T] >= NEED


def linked(x: _Text, y: _Text) -> bool:
    """Whether two texts have a similar window; the words that similar windows cover are added to both.

    Equal windows count whatever they hold; else a window counts where ``NEED`` of its places have their shingle in the
    aligned window of the other and ``NEED`` of the other's have theirs in it.  In texts that repeat themselves a place
    meets, for each shift, the nearest places of its shingle before and after: no others can be nearer to the window, so
    the counts are those of all pairs of places without a row for each.  Once the link is known, only windows with a word
    that no earlier comparison has covered are looked at: others would add nothing."""
    i, j = _common(x.windows, y.windows)
    link = len(i) > 0
    if link:
        x.add(_places(x.windows, i)[0])
        y.add(_places(y.windows, j)[0])
    i, j = _common(x.shingles, y.shingles)
    if not len(i) or min(x.n, y.n) < T:
        return link
    (p, kp), (q, kq) = _places(x.shingles, i), _places(y.shingles, j)
    if min(len(p), len(q)) < NEED:
        return link
    able = _rich(p, x.n), _rich(q, y.n)
    if not able[0].any() or not able[1].any() or link and not any((m & t.free()).any() for m, t in zip(able, (x, y), strict=True)):
        return link
    times = np.diff(np.append(np.flatnonzero(np.concatenate(([True], kq[1:] != kq[:-1]))), len(kq)))
    first = np.cumsum(times) - times
    by_place = np.argsort(p, kind="stable")
    hit, number = p[by_place], kp[by_place]
    hit_first, hit_times = first[number], times[number]
    if hit_times.sum() <= FEW_PLACES * len(hit):
        found = _by_pairs(x, y, hit, hit_first, hit_times, q, len(kq))
    else:
        likely = _shifts(hit, hit_first, hit_times, q, x.n, y.n)
        if max(x.n, y.n) * len(i) <= CELLS and int(able[0].sum()) * int(able[1].sum()) <= CELLS:
            return _by_windows(x, y, p, kp, q, kq, len(i), able, 2 * likely >= NEED, link)
        found = _by_shifts(x, y, hit, number, p, kp, q, kq, able, likely, lambda: link)
    for d, start in found:
        if len(start):
            link = True
            x.add(start)
            y.add(start + d)
            if not any((m & t.free()).any() for m, t in zip(able, (x, y), strict=True)):
                break
    return link


def _window_counts(place: np.ndarray, which: np.ndarray, n: int, m: int) -> np.ndarray:
    """For each start 0..n-T, how often each of m shingles is in its window."""
    so_far = np.zeros((n + 1, m), np.float32)
    so_far[place + 1, which] = 1
    np.cumsum(so_far, axis=0, out=so_far)
    return so_far[T:] - so_far[:-T]


def _by_windows(x, y, p, kp, q, kq, m, able, likely, link) -> bool:
    """Whether two texts have a similar window, from the counts of the common shingles in all windows that are open; covers them."""
    in_x, in_y = _window_counts(p, kp, x.n, m), _window_counts(q, kq, y.n, m)
    free = (x.free(), y.free()) if link else tuple(np.ones(len(a), bool) for a in able)
    for one, two in ((able[0] & free[0], able[1]), (able[0] & ~free[0], able[1] & free[1])):
        i, j = np.flatnonzero(one), np.flatnonzero(two)
        if not len(i) or not len(j):
            continue
        a, b = in_x[i], in_y[j]
        good = a @ (b > 0).T.astype(np.float32) >= NEED
        good &= (a > 0).astype(np.float32) @ b.T >= NEED
        good &= likely[j - i[:, None] + x.n]
        if good.any():
            link = True
            x.add(i[good.any(axis=1)])
            y.add(j[good.any(axis=0)])
    return link


def _by_pairs(x, y, hit, first, times, q, n_back):
    """(shift, similar windows of x) from all pairs of places of equal shingles."""
    ends = np.cumsum(times)
    p = np.repeat(hit, times)
    q = q[np.repeat(first - (ends - times), times) + np.arange(ends[-1])]
    # pairs by shift: a window pair of shift d holds those of shifts nearer to d than its length
    by_shift = np.argsort(q - p, kind="stable")
    shifts = (q - p)[by_shift]
    head = np.flatnonzero(np.concatenate(([True], shifts[1:] != shifts[:-1])))
    shift, count = shifts[head], np.diff(np.append(head, len(shifts)))
    alone = not (times > 1).any() and len(hit) == n_back
    likely = np.flatnonzero(2 * count >= NEED)
    for d in shift[likely[np.argsort(-count[likely], kind="stable")]].tolist():
        lo, hi = max(0, -d), min(x.n, y.n - d) - T
        if lo > hi:
            continue
        near = by_shift[np.searchsorted(shifts, d - T, "right") : np.searchsorted(shifts, d + T, "left")]
        if len(near) < NEED:
            continue
        near = np.sort(near)  # the order of p, then q
        # starts about these places alone
        lo, hi = max(lo, int(p[near[0]]) - T + 1), min(hi, int(p[near[-1]]))
        if lo > hi:
            continue
        good = _counts(p[near], q[near], d, lo, hi) >= NEED
        if not alone and good.any():
            back = near[np.lexsort((p[near], q[near]))]
            good &= _counts(q[back], p[back], -d, lo + d, hi + d) >= NEED
        yield d, np.flatnonzero(good) + lo


def _by_shifts(x, y, hit, number, p, kp, q, kq, able, count, known):
    """(shift, similar windows of x) from the nearest places, one shift after the other; once a link is known, starts that would cover nothing more are left out."""
    in_x, in_y = _Near(p, kp, x.n), _Near(q, kq, y.n)
    by_place = np.argsort(q, kind="stable")
    back, back_number = q[by_place], kq[by_place]
    likely = np.flatnonzero(2 * count >= NEED)
    for d in (likely[np.argsort(-count[likely], kind="stable")] - x.n).tolist():
        lo, hi = max(0, -d), min(x.n, y.n - d) - T
        if lo > hi:
            continue
        one, two = slice(lo, hi + 1), slice(lo + d, hi + d + 1)
        open_ = able[0][one] & able[1][two]
        if known():
            open_ &= x.free()[one] | y.free()[two]
        start = np.flatnonzero(open_) + lo
        if not len(start):
            continue
        lo, hi = int(start[0]), int(start[-1])
        part = slice(np.searchsorted(hit, lo), np.searchsorted(hit, hi + T))
        good = _counts(*in_y.near(number[part], hit[part], d), d, lo, hi) >= NEED
        if good.any():
            part = slice(np.searchsorted(back, lo + d), np.searchsorted(back, hi + d + T))
            good &= _counts(*in_x.near(back_number[part], back[part], -d), -d, lo + d, hi + d) >= NEED
        yield d, np.flatnonzero(good) + lo


def passages(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(covered words of x, covered words of y) by similar windows of two sequences of shingles."""
    one, two = _Text(x), _Text(y)
    linked(one, two)
    return one.words, two.words


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


SPANS = "a long, b long, sid long, lo long, hi long"


def _compare(pairs, texts):
    """Links (a, b), and the covered spans of each text of the block, joined over its partners."""
    names, held = texts["sid"].to_pylist(), {}
    for a, m, x, at, _ in sequences(texts["text"].combine_chunks()):
        for d in range(m):
            held[names[a + d]] = _Text(x[at[d] : at[d + 1]])
    links = [(a, b) for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()) if linked(held[b], held[a])]
    flat = [(s, lo, hi) for s, t in held.items() if t.words.any() for lo, hi in runs(t.words)]
    n, m = len(links), len(flat)
    pad = lambda values, before, after: pa.array([None] * before + values + [None] * after, pa.int64())
    return pa.table({"a": pad([x[0] for x in links], 0, m), "b": pad([x[1] for x in links], 0, m), "sid": pad([x[0] for x in flat], n, 0), "lo": pad([x[1] for x in flat], n, 0), "hi": pad([x[2] for x in flat], n, 0)})


def joined_spans(spans_: str = "spans") -> F.Column:
    """Sorted spans with overlapping or touching ones made one."""
    first = F.slice(F.col(spans_), 1, 1)

    def add(acc, s):
        top = F.element_at(acc, -1)
        grown = F.struct(top["lo"].alias("lo"), F.greatest(top["hi"], s["hi"]).alias("hi"))
        return F.when(s["lo"] <= top["hi"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.col(spans_), first, add)


def repeated_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): n_words, spans (words lo to hi, hi excluded), n_dup_words,
    n_copies (rows of the same words), n_links (verified partner texts), partners (their least doc_ids) and class_id
    (the least doc_id that links reach; its own without links)."""
    scratch = Scratch(spark, "passages")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    texts = docs.filter("text is not null").select(F.md5("text").alias("tkey"), "text")
    for turn in range(8):
        profile = lambda batches: _profile(batches, turn)  # noqa: E731, B023
        rows = scratch.table(docs.select("doc_id", "text", F.md5("text").alias("tkey")).mapInArrow(tidy(profile), "doc_id long, f1 long, f2 long, n_words long, tkey string"), "rows")
        points = scratch.table(rows.filter(F.col("n_words") >= PASSAGE).groupBy("f1", "f2").agg(F.min("tkey").alias("tkey"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_copies"), F.max("n_words").alias("n")), "points")
        about = points.agg(F.count("*"), F.count_distinct("f1"), F.sum("n")).first()
        if about[0] == about[1]:  # texts are known by 64 of their 128 bits: where two differ in the others alone, all take other bits
            break
    buckets = max(partitions(spark), math.ceil(RECORD_BYTES * (about[2] or 0) / BUCKET_BYTES))
    spread = F.coalesce("bucket", F.pmod(F.xxhash64("a"), F.lit(buckets)).cast("int"))
    blobs = docs.select("text").mapInArrow(tidy(_windows(buckets, turn)), WIDE).repartition(buckets, spread)
    similar = scratch.table(blobs.mapInArrow(tidy(_pairs), FOUND), "similar")
    wide = docs.select("text").mapInArrow(tidy(_sequences(buckets, turn)), "bucket int, blob binary, a long, b long").repartition(buckets, F.coalesce("bucket", F.pmod("a", F.lit(buckets)).cast("int")))
    equal = scratch.table(wide.mapInArrow(tidy(_equal), "a long, b long"), "equal")
    pairs = scratch.table(similar.filter("key is null").select("a", "b").unionByName(equal).distinct(), "found")
    hot = scratch.table(similar.filter("key is not null").select("key", F.col("a").alias("sid")).distinct(), "hot")
    sids = points.select(F.col("f1").alias("sid"), "tkey")
    out = compared(scratch, pairs, sids, texts, "passages", _compare, SPANS)
    large = hot if hot.limit(1).count() else None
    for k in range(ROUNDS if large is not None else 0):
        # large regions meet their text of most links, another one in each round
        links = out.filter("a is not null").select("a", "b").distinct()
        degree = links.select(F.col("a").alias("sid")).union(links.select("b")).groupBy("sid").agg(F.count("*").alias("n"))
        best = hot.join(degree, "sid").groupBy("key").agg(F.max(F.struct("n", -F.col("sid"), "sid")).alias("m"))
        pivots = scratch.table(best.select("key", F.col("m.sid").alias("pivot")), f"pivots-{k}")
        side = F.broadcast(pivots) if pivots.count() <= BROADCAST_ROWS else pivots  # a row for each large region
        met = hot.join(side, "key")
        star = met.filter("sid <> pivot").select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()
        star = scratch.table(star.join(pairs, ["a", "b"], "left_anti"), f"star-{k}")
        hot = scratch.table(met.filter("sid <> pivot").select("key", "sid"), f"hot-{k}").unionByName(hot.join(side.select("key"), "key", "left_anti"))
        if not star.limit(1).count():
            continue
        more = compared(scratch, star, sids, texts, f"more-{k}", _compare, SPANS)
        pairs, out = pairs.unionByName(star), out.unionByName(more)
    labels = components(scratch, out.filter("a is not null").select("a", "b"), "cc")
    if large is not None:
        # what the rounds leave of large regions: similar windows that add a link between components or a covered word
        of_text = large.groupBy("sid").agg(F.collect_set("key").alias("keys")).join(sids, "sid")
        covered = out.filter("sid is not null").select("sid", F.struct("lo", "hi").alias("s")).groupBy("sid").agg(F.collect_set("s").alias("spans"))
        known = of_text.join(covered, "sid", "left").join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "keys", "spans", "tkey", F.coalesce("label", "sid").alias("label"))
        known = scratch.table(known, "known")
        with_text = scratch.table(texts.join(known.select("tkey"), "tkey", "left_semi").groupBy("tkey").agg(F.first("text").alias("text")).join(known, "tkey").select("sid", "text", "label", "keys", "spans"), "known-texts")
        blobs = with_text.mapInArrow(tidy(_open_windows(buckets)), "bucket int, blob binary").repartition(buckets, "bucket")
        rest = scratch.table(blobs.mapInArrow(tidy(_search), "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti"), "rest")
        scratch.drop("known-texts")
        if rest.limit(1).count():
            more = compared(scratch, rest, sids, texts, "more-rest", _compare, SPANS)
            labels = extended(scratch, labels, more.filter("a is not null").select("a", "b"), "cc-rest")
            out = out.unionByName(more)
    links = scratch.table(out.filter("a is not null").select("a", "b").distinct(), "links")
    spans_of = out.filter("sid is not null").select("sid", F.struct("lo", "hi").alias("s")).distinct().groupBy("sid").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    spans_of = spans_of.select("sid", joined_spans().alias("spans"))
    least = points.groupBy(F.col("f1").alias("sid")).agg(F.min("least_id").alias("least_id"))
    ends = links.select("a", "b").union(links.select("b", "a"))
    partners = ends.join(least.withColumnRenamed("sid", "b"), "b").groupBy(F.col("a").alias("sid")).agg(F.count("*").alias("n_links"), F.array_sort(F.collect_set("least_id")).alias("partners"))
    named = labels.join(least, labels["node"] == least["sid"]).groupBy("label").agg(F.min("least_id").alias("class_id"))
    named = scratch.table(named, "named")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named  # a row for each class
    classes = labels.join(named, "label").select(F.col("node").alias("sid"), "class_id")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi")))
    about = points.withColumnRenamed("f1", "sid").join(spans_of, "sid", "left").join(partners, "sid", "left").join(classes, "sid", "left")
    about = about.select(F.col("sid").alias("f1"), "f2", "n_copies", F.when(F.col("n_copies") > 1, whole).otherwise(F.col("spans")).alias("spans"), "n_links", "partners", F.coalesce("class_id", "least_id").alias("class_id"))
    about = scratch.table(about, "about")
    scratch.sweep("rows", "about")
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    full = rows.join(about, ["f1", "f2"], "left")
    full = full.withColumn("spans", F.when(F.col("n_words") >= PASSAGE, F.coalesce("spans", empty)).otherwise(empty))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["hi"] - s["lo"])
    long = F.col("n_words") >= PASSAGE
    zero = lambda c: F.when(long, F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c)
    return full.select("doc_id", "n_words", "spans", words.alias("n_dup_words"), F.when(long, F.coalesce("n_copies", F.lit(1))).otherwise(1).cast("long").alias("n_copies"), zero("n_links"), F.when(long, F.coalesce("partners", F.array().cast("array<bigint>"))).otherwise(F.array().cast("array<bigint>")).alias("partners"), F.when(long, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")).alias("class_id"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of every document."""
    return repeated_passages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
