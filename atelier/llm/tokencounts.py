"""Token counts: delta-maintained rollups by source, language and tokenizer version.

A batch of changes (insert, delete, revise) becomes signed ledger rows: +count for an insert, the negated
ledger balance of the document for a delete, both for a revision.  Totals are additive, so a batch only
adds its own sums.  Every attempt at a batch has its own folder, and the batch counts once its marker, which names
the attempt, is created: creation succeeds once, so of two writers of one batch one wins and the other leaves nothing;
a batch that ran before is left alone, and readers see committed attempts only.

The ledger is written in folders by a hash of doc_id, so a batch reads only the folders of the documents it names.
``compact`` folds committed batches into one snapshot of balances and totals; its marker lists what it holds, readers
take the latest snapshot and the batches it lacks, and batches stay known by their markers.

Defined results: a null or empty text has no tokens and counts as a document; a text longer than ``PART`` is encoded in
parts cut where no token can cross (before a blank between a character that is none and a letter), or whole where it
has no such place; null source or language is a value of its own; repeated rows of one insert each count; a delete or
revision of a document that the ledger lacks retracts nothing; one with a null doc_id retracts nothing, as it names no
document; an empty batch commits and adds nothing; extra columns are ignored, those named n_words or n_tokens replaced.
"""

from __future__ import annotations

import base64
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, exists, hadoop, partitions, remove, schema_with, ship
from .textkit import Words, buffers, spans, tidy

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits a text before merges; part of the vocabulary's definition.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ("source", "lang", "version")
LEDGER = "doc_id long, source string, lang string, version string, docs long, tokens long"
DELTA = "source string, lang string, version string, docs long, tokens long"
#: Characters of a text that are encoded at once, which bounds the memory of one call.
PART = 1 << 20
#: Where a text may be cut: no token holds a character that is no blank together with a blank behind it.
CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")
#: Folders of the ledger.
FOLDERS = 64
_encoders: dict = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def parts(text: str, size: int = PART):
    """A text in parts whose tokens together are those of the whole."""
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def count_tokens(docs: DataFrame, path: str = RANKS, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with n_words and n_tokens."""
    rest = [c for c in docs.columns if c not in (text, "n_words", "n_tokens")]

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            column = batch.column(len(rest))
            data, offsets = buffers(column)
            words = np.zeros(batch.num_rows, np.int64)
            for a, b in spans(offsets):
                words[a:b] = np.diff(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).first)
            tokens = [sum(len(enc.encode_ordinary(p)) for p in parts(t)) if t else 0 for t in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(words), pa.array(tokens, pa.int64())], names=[*rest, "n_words", "n_tokens"])

    ship(docs.sparkSession)
    return docs.select(*rest, text).mapInArrow(tidy(run), schema_with(docs.select(*rest), n_words="bigint", n_tokens="bigint"))


class TokenRollup:
    """Totals below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _names(self) -> list[str]:
        fs, at = hadoop(self.spark, self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _said(self, name: str) -> str:
        """What a marker holds."""
        fs, at = hadoop(self.spark, f"{self.root}/{name}")
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _claim(self, name: str, text: str) -> bool:
        """Create a marker with this text, whole and once; False if it is there."""
        fs, at = hadoop(self.spark, f"{self.root}/{name}")
        draft = hadoop(self.spark, f"{self.root}/_drafts/{uuid.uuid4().hex}")[1]
        stream = fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(at) or not fs.rename(draft, at):
            fs.delete(draft, False)
        return self._said(name) == text

    def committed(self) -> list[str]:
        return [n.removesuffix(".done") for n in self._names() if n.endswith(".done") and not n.startswith("_")]

    def _parts(self) -> list[str]:
        """Folders that readers take: the latest snapshot and the committed attempts that it lacks."""
        snapshots = sorted((int(n.split("-")[1].removesuffix(".done")) for n in self._names() if n.startswith("_snapshot-") and n.endswith(".done")), reverse=True)
        at, held = [], set()
        if snapshots:
            folder, *names = self._said(f"_snapshot-{snapshots[0]}.done").split("\n")
            at, held = [folder], set(names)
        return at + [self._said(f"{b}.done") for b in self.committed() if b not in held]

    def _read(self, kind: str, schema: str) -> DataFrame:
        found = [f"{self.root}/{p}/{kind}" for p in self._parts()]
        paths = [p for p in found if exists(self.spark, p)]
        out = None
        for p in paths:  # each folder has its own partitions
            df = self.spark.read.schema(schema).parquet(p)
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], schema) if out is None else out

    def _write(self, folder: str, ledger: DataFrame) -> None:
        """The ledger in its folders, a few files each, and the sums by key beside it."""
        parts = max(1, partitions(self.spark) // FOLDERS)
        dealt = ledger.withColumn("folder", _folder("doc_id")).repartition(F.col("folder"), F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(parts)))
        dealt.write.mode("overwrite").partitionBy("folder").parquet(f"{self.root}/{folder}/ledger")
        own = self.spark.read.schema(f"{LEDGER}, folder int").parquet(f"{self.root}/{folder}/ledger")
        own.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.root}/{folder}/delta")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply changes (op, doc_id, source, lang, version, tokens) once; False if the batch was committed before.

        A delete or a revision names the document and version; its old source and language come from the ledger.
        """
        if "/" in batch or batch.startswith(("_", ".")):
            raise ValueError("a batch name is one file name without a leading _ or .")
        if exists(self.spark, f"{self.root}/{batch}.done"):
            return False
        attempt = f"{batch}.{uuid.uuid4().hex}"
        changes = changes.select("op", F.col("doc_id").cast("long"), *KEYS, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        added = changes.filter("op in ('insert', 'revise')").select("doc_id", *KEYS, F.lit(1).cast("long").alias("docs"), "tokens")
        named = changes.filter("op in ('delete', 'revise') and doc_id is not null").select("doc_id", F.col("version").alias("_v")).distinct()
        folders = [r[0] for r in named.select(_folder("doc_id")).distinct().collect()]  # FOLDERS numbers at most
        ledger = self._read("ledger", f"{LEDGER}, folder int").filter(F.col("folder").isin(folders)) if folders else self.spark.createDataFrame([], LEDGER)
        touched = ledger.join(named, (ledger["doc_id"] == named["doc_id"]) & ledger["version"].eqNullSafe(named["_v"]), "left_semi")
        balance = touched.groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        gone = balance.filter("docs <> 0 or tokens <> 0").select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        self._write(attempt, added.unionByName(gone))
        if self._claim(f"{batch}.done", attempt):
            return True
        remove(self.spark, f"{self.root}/{attempt}")
        return False

    def compact(self) -> None:
        """Fold all committed batches into a snapshot; sums that came back to nothing are left out of it."""
        names, number = self.committed(), 1 + max([int(n.split("-")[1].removesuffix(".done")) for n in self._names() if n.startswith("_snapshot-") and n.endswith(".done")], default=0)
        folder = f"_snapshot-{number}.{uuid.uuid4().hex}"
        balance = self._read("ledger", f"{LEDGER}, folder int").groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        self._write(folder, balance.filter("docs <> 0 or tokens <> 0"))
        if not self._claim(f"_snapshot-{number}.done", "\n".join([folder, *names])):
            remove(self.spark, f"{self.root}/{folder}")

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches; a sum that came back to nothing is left out."""
        sums = self._read("delta", DELTA).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs <> 0 or tokens <> 0")


def _folder(key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(FOLDERS)).cast("int")


def op4_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents: word counts stand in as estimates at first, then every document is revised to its token count."""
    scratch = Scratch(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text")
    counts = scratch.table(count_tokens(docs), "counts")
    rollup = TokenRollup(spark, f"{scratch.root}/rollup")
    load = lambda version, n, op: counts.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(version).alias("version"), F.col(n).alias("tokens"))
    estimates = load("words-1", "n_words", "insert").unionByName(load("bpe50k-1", "n_words", "insert"))
    rollup.commit("0-load", estimates)
    rollup.commit("0-load", estimates)  # a replay adds nothing
    rollup.commit("1-recount", load("bpe50k-1", "n_tokens", "revise"))
    return rollup.totals()
