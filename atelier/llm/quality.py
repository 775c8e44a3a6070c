"""Quality rules: a learned decision list over per-document statistics.

Sequential covering learns conjunctions of thresholds from labelled statistics: a rule for the class
``bad`` is grown on two thirds of the examples by information gain, pruned on the rest, its examples are
taken out, and the next rule follows while it is precise enough.  The list is emitted as one ordered Spark
conditional expression.  It is fitted on a bounded sample (``LEARN_ROWS`` labelled rows, those of the least
hash of doc_id and seed); statistics and verdicts cover every row and whole texts.

Defined results: a null, empty or blank text has all statistics 0, fails the base rule and is not kept; with
no labels, or labels of one class only, the list is empty and the base rule alone decides; labels that are
null are ignored, repeated labels count once each; repeated rows get equal verdicts; extra columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, schema_with, ship
from .textkit import Words, buffers, spans, tidy, windows

LEARN_ROWS = 20_000
SEED = 11
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_bytes", "n_upper", "n_digits", "n_marks", "n_lines")
#: Attributes that rules may test, as SQL of the counts.
RATIOS = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "symbols_per_word": "n_symbols / n_words",
    "chars_per_word": "word_chars / n_words",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / n_words",
    "upper_per_char": "n_upper / word_chars",
    "digits_per_char": "n_digits / word_chars",
    "marks_per_word": "n_marks / n_words",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}
_table = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
IS_SYMBOL, IS_MARK = _table(SYMBOLS), _table("!?|#")
IS_UPPER, IS_DIGIT = np.isin(np.arange(256), np.arange(65, 91)), np.isin(np.arange(256), np.arange(48, 58))
IS_HEAD = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a code point


def repeated(words: Words) -> np.ndarray:
    """Words of each document that lie in a five-word window which the document has twice or more."""
    first = words.first
    x, offs = windows(words.hashes(), first, 5)
    out = np.zeros(len(first) - 1, np.int64)
    for d in range(len(first) - 1):
        w = x[offs[d] : offs[d + 1]]
        if len(w) < 2:
            continue
        order = np.argsort(w, kind="stable")
        same = w[order[1:]] == w[order[:-1]]
        if same.any():
            hit = np.zeros(len(w) + 5, np.int64)
            twice = np.zeros(len(w), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            at = np.flatnonzero(twice)
            np.add.at(hit, at, 1)
            np.add.at(hit, at + 5, -1)
            out[d] = (np.cumsum(hit) > 0).sum()
    return out


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a column."""
    data, offsets = buffers(column)
    n = len(offsets) - 1
    out = {k: np.zeros(n, np.int64) for k in (*BASE, *MORE)}
    for a, b in spans(offsets):
        part, offs = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = Words(part, offs)
        total = lambda mask, offs=offs: np.diff(np.concatenate(([0], np.cumsum(mask)))[offs])
        spaces = np.isin(part, [9, 10, 11, 12, 13, 32])
        out["n_words"][a:b] = np.diff(words.first)
        out["word_chars"][a:b] = total(IS_HEAD[part] & ~spaces)
        out["n_symbols"][a:b], out["n_marks"][a:b] = total(IS_SYMBOL[part]), total(IS_MARK[part])
        out["n_upper"][a:b], out["n_digits"][a:b] = total(IS_UPPER[part]), total(IS_DIGIT[part])
        out["n_bytes"][a:b] = np.diff(offs)
        out["n_repeat_words"][a:b] = repeated(words)
        raw = part.tobytes()
        for d in range(b - a):
            lines = [x for x in raw[offs[d] : offs[d + 1]].split(b"\n") if x and not x.isspace()]
            out["n_lines"][a + d], out["n_dup_lines"][a + d] = len(lines), len(lines) - len(set(lines))
    return out


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts; columns of the same names are replaced."""
    docs = docs.drop(*BASE, *MORE)
    at, names = docs.columns.index(text), (*BASE, *MORE)

    def run(batches):
        for batch in batches:
            found = statistics(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[k]) for k in names)], names=[*batch.schema.names, *names])

    ship(docs.sparkSession)
    return docs.mapInArrow(tidy(run), schema_with(docs, **dict.fromkeys(names, "bigint")))


BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


# --- learning -------------------------------------------------------------------------------------------


def _gain(p1: np.ndarray, n1: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """Gain of a condition that leaves p1 bad and n1 good examples of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p1 > 0, p1 * (np.log2(p1 / np.maximum(p1 + n1, 1)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _best(x: np.ndarray, bad: np.ndarray) -> tuple | None:
    """The condition (attribute, '<=' or '>', threshold) of most gain."""
    p0, n0, best = bad.sum(), (~bad).sum(), None
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, y = x[order, j], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        p, n = np.cumsum(y)[cut], np.cumsum(~y)[cut]
        for sign, pp, nn in (("<=", p, n), (">", p0 - p, n0 - n)):
            g = _gain(pp.astype(float), nn.astype(float), p0, n0)
            k = int(g.argmax())
            if g[k] > 1e-9 and (best is None or g[k] > best[0]):
                best = (g[k], (j, sign, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
    return best and best[1]


def covers(rule: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, sign, t in rule:
        out &= x[:, j] <= t if sign == "<=" else x[:, j] > t
    return out


def learn(x: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_tests: int = 4, precision: float = 0.9, least: int = 8, seed: int = SEED) -> list[list[tuple]]:
    """An ordered list of conjunctions that mark bad documents."""
    rng, rules = np.random.Generator(np.random.PCG64(seed)), []
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and bad[left].sum() >= least:
        at = rng.permutation(np.flatnonzero(left))
        grow, prune = at[: 2 * len(at) // 3], at[2 * len(at) // 3 :]
        rule: list[tuple] = []
        live = grow
        while len(rule) < most_tests and 0 < bad[live].sum() < len(live):
            test = _best(x[live], bad[live])
            if test is None:
                break
            rule.append(test)
            live = live[covers([test], x[live])]
        worth = lambda r: ((m := covers(r, x[prune])) & bad[prune]).sum() - 2.0 * (m & ~bad[prune]).sum()  # noqa: B023, E731
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covers(rule, x) & left
        if not rule or bad[hit].sum() < least or bad[hit].sum() < precision * hit.sum() or worth(rule) <= 0:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def expression(rules: list[list[tuple]]) -> str:
    """The ordered conditional of a list: the place of the rule that a row meets first, from 1, else 0."""
    names = list(RATIOS)
    tests = [" AND ".join(f"({RATIOS[names[j]]}) {sign} {t!r}D" for j, sign, t in rule) for rule in rules]
    whens = " ".join(f"WHEN n_words = 0 THEN 0 WHEN {t} THEN {i}" if i == 1 else f"WHEN {t} THEN {i}" for i, t in enumerate(tests, 1))
    return f"CASE {whens} ELSE 0 END" if rules else "0"


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = LEARN_ROWS, seed: int = SEED) -> list[list[tuple]]:
    """Rules learned from at most ``most`` labelled documents."""
    scratch = Scratch(spark, "rules")
    # one row for a document, so that repeated labels or documents can't multiply: a majority of its labels
    label = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad"))
    drawn = scratch.table(label.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most), "drawn")  # a bounded sample
    some = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = with_statistics(some).filter("n_words > 0").selectExpr("doc_id", "bad", *(f"{v} AS `{k}`" for k, v in RATIOS.items()))
    # of the texts of a repeated doc_id the one of least ratios, so that a task that is run again learns the same rules
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("bad", *(F.col(f"`{k}`") for k in RATIOS))).alias("least")).select("least.*").toPandas()
    x, bad = rows[list(RATIOS)].to_numpy(np.float64), rows["bad"].to_numpy(bool)
    order = np.lexsort(np.concatenate((x.T, bad[None])))
    return learn(x[order], bad[order], seed=seed) if len(x) else []


def judged(spark: SparkSession, docs: DataFrame, labels: DataFrame, rules: list[list[tuple]] | None = None) -> DataFrame:
    """``docs`` with counts, base_failed, rule (place in the list, 0 for none) and kept."""
    rules = fit(spark, docs, labels) if rules is None else rules
    out = with_statistics(docs.drop("base_failed", "rule", "kept"))
    return out.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rule", F.expr(expression(rules)).cast("int")).withColumn("kept", F.expr("NOT base_failed AND rule = 0"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return judged(spark, docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
