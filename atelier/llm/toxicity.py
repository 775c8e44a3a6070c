"""Toxicity: a convolutional text classifier in numpy.

A word is embedded as the sum of hashed embeddings of itself and of its leading characters (2 to 6), so that
unseen forms of a known stem are near it.  Filters of widths 1, 2 and 3 slide over all words of a text; each
filter's largest response, through a rectifier, goes to a logistic output.  Texts are scored whole.

The classifier is fitted on all labelled rows, whole texts, but those whose crc32(doc_id) mod 5 is 0 and a fifth
(by hash) that is left for the thresholds.  Rows are dealt by hash to parts of about ``PART_ROWS``; in each of ``ROUNDS``
rounds every part learns two epochs from the shared weights, and each weight moves by the mean change of the parts that
changed it.  What is one part is learnt in one go.  Thresholds by language come from all rows of that fifth, and give
``flag``; they are no input of the score.

Defined results: a null or empty text has only the output's bias as evidence; with no labels, or labels of one
class only, every score is the share of toxic labels (0 if none); null labels are ignored; repeated rows get
equal scores; a language without calibration rows uses 0.5; an empty table gives an empty result; extra columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, schema_with, ship
from .textkit import LOWER, U, Words, _power, buffers, mix, spans, tidy

#: Labelled rows and bytes of text of a part, which one task learns.
PART_ROWS, PART_BYTES = 5000, 64 << 20
#: Epochs, and the rounds that they are dealt to where there are several parts.
EPOCHS, ROUNDS = 8, 4
#: Labels that are broadcast at most.
BROADCAST_ROWS = 500_000
#: Slices of the weights in which the parts' changes are put together; steps of the scores by which thresholds are found.
CUTS, SCORES = 16, 4096
SEED = 5
ROWS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
STEMS = (2, 3, 4, 5, 6)


def word_rows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embedding rows of each distinct word, one column for the word and each stem; the words as numbers; their hashes)."""
    data = words.data
    up, down = _power(len(data) + 1)
    run = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(7)) * U(0x9FB21C651E98DF25) * up[:-1], out=run[1:])
    whole = mix((run[words.end] - run[words.start]) * down[words.start] + (words.end - words.start).astype(U))
    _, one, which = np.unique(whole, return_index=True, return_inverse=True)
    start, end = words.start[one], words.end[one]
    heads = np.concatenate((np.flatnonzero((data & 0xC0) != 0x80), np.full(STEMS[-1] + 1, len(data))))
    first = np.searchsorted(heads, start)
    cols = [whole[one]]
    for k in STEMS:
        stop = np.minimum(heads[np.minimum(first + k, len(heads) - 1)], end)
        cols.append(mix((run[stop] - run[start]) * down[start] + U(k * 0x8EBC6AF09C88C6E3 % 2**64)))
    return (np.stack(cols, axis=1) % U(ROWS)).astype(np.int32), which, whole[one]


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with ASCII punctuation as blanks."""
    data, offs = buffers(column)
    table = LOWER.copy()
    for c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
        table[c] = 32
    return table[data], offs


class Net:
    def __init__(self, seed: int = SEED):
        g = np.random.Generator(np.random.PCG64(seed))
        self.e = g.normal(0, 0.1, (ROWS, DIM)).astype(np.float32)
        self.w = [g.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.v = np.full(len(WIDTHS) * FILTERS, 0.5, np.float32) * g.choice([1, 0.2], len(WIDTHS) * FILTERS).astype(np.float32)
        self.c = np.float32(-2.0)

    def pooled(self, emb: np.ndarray, which: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest responses, where) of each text, -1 where a text is too short.  emb: of the distinct words."""
        n = len(first) - 1
        out, at = np.zeros((n, len(WIDTHS) * FILTERS), np.float32), np.full((n, len(WIDTHS) * FILTERS), -1)
        for i, k in enumerate(WIDTHS):
            size = np.maximum(np.diff(first) - k + 1, 0)
            full = np.flatnonzero(size)
            if not len(full) or len(which) < k:
                continue
            parts = [emb @ self.w[i][j] for j in range(k)]
            for f in range(FILTERS):
                y = parts[0][which[: len(which) - k + 1], f]
                for j in range(1, k):
                    y = y + parts[j][which[j : len(which) - k + 1 + j], f]
                if k > 1:  # windows that cross into the next text respond to nothing
                    y = y.copy()
                    for j in range(1, k):
                        bad = first[1:-1] - j
                        y[bad[(bad >= 0) & (bad < len(y))]] = -np.inf
                # texts shorter than the window own no row here: reduce over the starts of the others
                tops = np.maximum.reduceat(y, first[:-1][full])
                out[full, i * FILTERS + f] = np.maximum(tops + self.b[i][f], 0)
                if self.train:
                    ends = np.append(first[:-1][full][1:], len(y))
                    for d, a, b, top in zip(full, first[:-1][full], ends, tops):
                        at[d, i * FILTERS + f] = a + int(np.argmax(y[a:b] == top))
        return out, at

    train = False

    def embed(self, rows: np.ndarray) -> np.ndarray:
        out = self.e[rows[:, 0]].copy()
        for j in range(1, rows.shape[1]):
            out += self.e[rows[:, j]]
        return out

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((pooled @ self.v + self.c).astype(np.float64), -40, 40)))

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offs = letters(column)
        out = np.zeros(len(offs) - 1)
        for a, b in spans(offs):
            words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            if len(words.start):
                rows, which, _ = word_rows(words)
                out[a:b] = self.score(self.pooled(self.embed(rows), which, words.first)[0])
            else:
                out[a:b] = self.score(np.zeros((b - a, len(self.v)), np.float32))
        return out


def train(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02, batch: int = 64, seed: int = SEED) -> Net:
    """Adagrad on the log loss; a gradient reaches only the words that a filter responded to most."""
    return trained(Net(seed), begun(Net(seed)), texts, y, epochs, rate, batch, seed)


def begun(net: Net) -> dict:
    """Adagrad's sums of squares before the first step."""
    return {"e": np.full((ROWS, DIM), 1e-4, np.float32), "v": np.full(net.v.shape, 1e-4, np.float32), "c": 1e-4, "w": [np.full(w.shape, 1e-4, np.float32) for w in net.w], "b": [np.full(FILTERS, 1e-4, np.float32) for _ in WIDTHS]}


def trained(net: Net, past: dict, texts: list[str], y: np.ndarray, epochs: int, rate: float = 0.02, batch: int = 64, seed: int = SEED) -> Net:
    """``net`` and ``past`` after further epochs; both are changed."""
    g = np.random.Generator(np.random.PCG64(seed))
    rows, which, first = _numbered(pa.array(texts, pa.string()))
    n = len(texts)
    net.train = True
    for _ in range(epochs):
        order = g.permutation(n)
        for lo in range(0, n, batch):
            docs = order[lo : lo + batch]
            size = first[docs + 1] - first[docs]
            own = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs]) if size.sum() else np.zeros(0, np.int64)
            own_first = np.concatenate(([0], np.cumsum(size)))
            distinct, local = np.unique(which[own], return_inverse=True)
            if not len(distinct):
                continue
            emb = net.embed(rows[distinct])
            pooled, at = net.pooled(emb, local, own_first)
            err = ((net.score(pooled) - y[docs]) / len(docs)).astype(np.float32)
            grad_v, grad_p = pooled.T @ err, err[:, None] * net.v[None] * (pooled > 0)
            grad_e = np.zeros_like(emb)
            for i, k in enumerate(WIDTHS):
                gw, gb = np.zeros_like(net.w[i]), grad_p[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0)
                for f in range(FILTERS):
                    gp, where = grad_p[:, i * FILTERS + f], at[:, i * FILTERS + f]
                    hit = np.flatnonzero((gp != 0) & (where >= 0))
                    for j in range(k):
                        word = local[where[hit] + j]
                        gw[j, :, f] += emb[word].T @ gp[hit]
                        np.add.at(grad_e, word, gp[hit, None] * net.w[i][j][:, f])
                past["w"][i] += gw**2
                net.w[i] -= rate * gw / np.sqrt(past["w"][i])
                past["b"][i] += gb**2
                net.b[i] -= rate * gb / np.sqrt(past["b"][i])
            past["v"] += grad_v**2
            net.v -= rate * grad_v / np.sqrt(past["v"])
            past["c"] += float(err.sum()) ** 2
            net.c = np.float32(net.c - rate * err.sum() / np.sqrt(past["c"]))
            live = np.flatnonzero(grad_e.any(axis=1))
            for j in range(rows.shape[1]):
                r = rows[distinct[live], j]
                np.add.at(past["e"], r, grad_e[live] ** 2)
                np.add.at(net.e, r, -rate * grad_e[live] / np.sqrt(past["e"][r]))
    net.train = False
    return net


def threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The cut of most F1, midway between neighbouring scores; 0.5 where it is as good or nothing tells.  ``n``: rows of each."""
    if not y.any() or y.all():
        return 0.5
    n = np.ones(len(y), np.int64) if n is None else n
    s, at = np.unique(score, return_inverse=True)
    all_, hit = np.bincount(at, n)[::-1].cumsum(), np.bincount(at, n * y)[::-1].cumsum()
    s, f1 = s[::-1], 2 * hit / (all_ + (n * y).sum())
    above = f1[s >= 0.5]
    if len(above) and above[-1] >= f1.max() - 1e-12:
        return 0.5
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"


def _numbered(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embedding rows of each distinct word, the words as numbers, where texts begin); some texts are taken apart at a time."""
    data, offs = letters(column)
    rows, names, which, sizes = [np.zeros((0, len(STEMS) + 1), np.int32)], [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in spans(offs):
        words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
        sizes.append(np.diff(words.first))
        if len(words.start):
            own, at, name = word_rows(words)
            which.append(at + sum(map(len, names)))
            rows.append(own)
            names.append(name)
    _, one, at = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    return np.concatenate(rows)[one], at[np.concatenate(which)], np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def _flat(net: Net, past: dict) -> np.ndarray:
    """Weights and sums of squares as one vector; the embeddings come first."""
    each = lambda e, v, c, w, b: [e.ravel(), v.ravel(), np.array([c], np.float32), *(x.ravel() for x in w), *(x.ravel() for x in b)]
    return np.concatenate(each(net.e, net.v, net.c, net.w, net.b) + each(past["e"], past["v"], past["c"], past["w"], past["b"])).astype(np.float32)


def _shaped(flat: np.ndarray) -> tuple[Net, dict]:
    net = Net()
    past, at = begun(net), 0

    def take(shape):
        nonlocal at
        n = int(np.prod(shape))
        at += n
        return flat[at - n : at].reshape(shape).copy()

    net.e, net.v, net.c, net.w, net.b = take(net.e.shape), take(net.v.shape), np.float32(take((1,))[0]), [take(w.shape) for w in net.w], [take(b.shape) for b in net.b]
    past["e"], past["v"], past["c"], past["w"], past["b"] = take(net.e.shape), take(net.v.shape), float(take((1,))[0]), [take(w.shape) for w in net.w], [take(b.shape) for b in net.b]
    return net, past


def _learnt(state, epochs: int, turn: int):
    """The steps of each part from the shared weights, in slices: (slice, changes, bits of what was changed)."""

    def run(batches):
        start = state.value
        # what a task reads: a few parts, each of bounded size
        table = pa.Table.from_batches(list(batches)).sort_by([("part", "ascending"), ("doc_id", "ascending")])
        part = table["part"].to_numpy()
        for k in np.unique(part):
            own = table.slice(int(np.searchsorted(part, k)), int((part == k).sum()))
            net, past = _shaped(start)
            trained(net, past, own["text"].to_pylist(), own["toxic"].to_numpy().astype(np.float32), epochs, seed=SEED + turn)
            for cut, x in enumerate(np.array_split(_flat(net, past) - start, CUTS)):
                yield pa.RecordBatch.from_arrays([pa.array([cut], pa.int32()), pa.array([x.tobytes()], pa.binary()), pa.array([np.packbits(x != 0).tobytes()], pa.binary())], names=["cut", "step", "moved"])

    def some(batches):
        batches = [b for b in batches if b.num_rows]
        return run(batches) if batches else iter(())

    return some


def _together(key, table):
    """The mean change of each weight over the parts that changed it."""
    step = moved = 0
    for x, m in zip(table["step"], table["moved"]):
        x = np.frombuffer(x.as_py(), np.float32)
        step = step + x.astype(np.float64)
        moved = moved + np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(x)).astype(np.int64)
    return pa.table({"cut": pa.array([key[0].as_py()], pa.int32()), "step": pa.array([(step / np.maximum(moved, 1)).astype(np.float32).tobytes()], pa.binary())})


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> tuple[Net | float, dict[str, float]]:
    """(classifier, thresholds by language) from all labelled rows that are not held out; a plain share where there is one class only."""
    scratch = Scratch(spark, "toxicity")
    label = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("toxic") >= 0.5).alias("toxic")).filter(f"NOT ({HELD_OUT})")
    label = scratch.table(label, "labels")
    label = F.broadcast(label) if label.count() <= BROADCAST_ROWS else label  # so that texts without a label stay where they are
    # the least text of a repeated doc_id, so that a task that is run again learns the same model
    each = docs.filter("text is not null").select("doc_id", "text", "lang").join(label, "doc_id")
    each = each.groupBy("doc_id").agg(F.min(F.struct("text", "lang", "toxic")).alias("least")).select("doc_id", "least.*")
    rows = scratch.table(each.withColumn("tested", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(5)) == 4), "labelled")
    n, toxic, learnt, size, spread = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)), F.count_if(~F.col("tested")), F.sum(F.octet_length("text")), F.count_distinct("toxic", "tested")).first()
    if not 0 < toxic < n:
        return (toxic / n if n else 0.0), {}
    if spread < 4:  # too few rows for both classes on both sides: all of them are learnt
        rows, learnt = rows.withColumn("tested", F.lit(False)), n
    parts = max(1, -(-learnt // part_rows), -(-size // part_bytes))
    dealt = scratch.table(rows.filter("not tested").select("doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(parts)).cast("int").alias("part")).repartition(parts, "part"), "learnt")
    state = _flat(Net(), begun(Net()))
    rounds = ROUNDS if parts > 1 else 1
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(state)
        steps = dealt.mapInArrow(tidy(_learnt(shared, EPOCHS // rounds, turn)), "cut int, step binary, moved binary")
        mean = steps.groupBy("cut").applyInArrow(_together, "cut int, step binary").orderBy("cut").toArrow()  # ``CUTS`` rows, the size of the model
        state = state + np.frombuffer(b"".join(x.as_py() for x in mean["step"]), np.float32)
    net = _shaped(state)[0]
    # the rows that were not learnt, counted by language and score in steps of 1/SCORES
    test = scored(spark, rows.filter("tested and lang is not null"), net, {})
    seen = test.groupBy("lang", F.floor(F.col("score") * SCORES).alias("s"), "toxic").agg(F.count("*").alias("n"))
    cuts = {r["lang"]: r["cut"] for r in seen.groupBy("lang").applyInArrow(_cut, "lang string, cut double").collect()}  # a row for each language
    return net, cuts


def _cut(group, table):
    table = table.sort_by([("s", "ascending"), ("toxic", "ascending")])
    n = table["n"].to_numpy()
    return pa.table({"lang": [group[0].as_py()], "cut": [threshold(table["s"].to_numpy() / SCORES, table["toxic"].to_numpy(zero_copy_only=False), n)]})


def scored(spark: SparkSession, docs: DataFrame, net: Net | float, cuts: dict[str, float]) -> DataFrame:
    """``docs`` with score, predicted (score >= 0.5) and flag (score >= the threshold of the row's language)."""
    docs = docs.drop("score", "predicted", "flag")
    at = docs.columns.index("text")
    shared = spark.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            model = shared.value
            score = np.full(batch.num_rows, model) if isinstance(model, float) else model.scores(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, "score"])

    ship(spark)
    out = docs.mapInArrow(tidy(run), schema_with(docs, score="double"))
    cut = F.lit(0.5)
    for lang, t in cuts.items():
        cut = F.when(F.col("lang") == lang, t).otherwise(cut)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("flag", F.col("score") >= cut)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    net, cuts = fit(spark, docs, labels)
    return scored(spark, docs, net, cuts).select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", "predicted", "flag")
