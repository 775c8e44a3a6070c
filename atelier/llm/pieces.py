"""SentencePiece encoding and decoding by a streaming Viterbi walk over piece boundaries.

For a model of the BPE kind the best path is not that of the highest sum of scores but that of the merge
order, and every prefix of a text has one best path.  So the walk keeps, for each boundary, the piece that
ends there on the best path of the prefix, i.e. the only piece that is stable beside the piece before it: no
merge across their common boundary would come earlier than the merges which made them.  Only the boundaries
of the last ``longest`` symbols are kept; ids are committed as soon as the paths of all of them run through
one boundary.  The ids equal those of the sentencepiece library.

All paths run through a boundary that no piece crosses: before a word's blanks (the model is refused where a piece
holds a blank behind another character), and between two symbols that stand side by side in no piece, which in text
without blanks is most of them.  So the windows between such boundaries, a batch's distinct ones at once in numpy,
are walked symbol by symbol and committed at their ends; a window of more than ``SHORT`` symbols without such a
boundary goes through the stream, which finds its commits by walking the surviving paths back.

Defined results: an empty text has no ids and a null text has null; characters outside the vocabulary become
byte pieces; U+2581 in a text is read as a blank and comes back as one (as in the library); repeated rows
give equal results; texts of any length are taken whole; an empty table gives an empty result; further columns
pass unchanged, but for those that are added, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import schema_with, ship
from .textkit import U, _power, buffers, mix, spans, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, BLANK = 1, "▁"
NONE = np.int32(2**30)
#: Words of more symbols than this take the streaming walk one by one.
SHORT = 64
#: Bytes of text that are encoded at once.
SLICE = 1 << 20
#: Windows that are walked at once.
WALKED = 20_000
_models: dict = {}


class Model:
    """Vocabulary in merge order.  Numbers: 0..255 byte pieces, then single characters, then merged pieces, earliest merge first."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte pieces, so characters outside its vocabulary would be lost")
        text = {sp.id_to_piece(i): i for i in plain}
        if inner := [p for p in text if BLANK in p.lstrip(BLANK)]:
            raise ValueError(f"pieces such as {inner[0]!r} hold a blank behind another character, so words can't be taken apart before blanks")
        chars = sorted(p for p in text if len(p) == 1)
        merged = sorted((p for p in text if len(p) > 1), key=lambda p: (-sp.get_score(text[p]), text[p]))
        score = {p: sp.get_score(i) for p, i in text.items()}
        self.number = {c: 256 + k for k, c in enumerate(chars)}
        split = {}
        for p in merged:
            if (s := _halves(p, score, self.number)) is not None:
                split[p] = s
        self.first_merge = 256 + len(chars)
        made = [p for p in merged if p in split]
        self.number |= {p: self.first_merge + k for k, p in enumerate(made)}
        n = self.first_merge + len(made)
        self.left, self.right = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32)
        self.id = np.array([byte_ids[b] for b in range(256)] + [text[p] for p in (*chars, *made)], np.int32)
        for p in made:
            self.left[self.number[p]], self.right[self.number[p]] = (self.number[x] for x in split[p])
        self.pair = {(int(self.left[k]), int(self.right[k])): k for k in range(self.first_merge, n)}
        keys = self.left[self.first_merge :].astype(np.int64) << 32 | self.right[self.first_merge :]
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = keys[order], (np.arange(self.first_merge, n)[order]).astype(np.int32)
        self.longest = max(map(len, self.number))
        beside = {self.number[a] << 32 | self.number[b] for p in made for a, b in zip(p, p[1:])}
        self.beside = np.array(sorted(beside), np.int64)
        self.char = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.char[ord(c)] = self.number[c]
        self.salt = mix(np.arange(1, self.first_merge + 1, dtype=np.int64).astype(U) * U(0x9E3779B97F4A7C15))
        hashes = np.array([self._hash(p) for p in made], U) if made else np.zeros(0, U)
        order = np.argsort(hashes)
        self.hashes, self.hash_number = hashes[order], (np.arange(self.first_merge, n)[order]).astype(np.int32)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[hashes >> U(44)] = True
        shown = [bytes([b]) for b in range(256)] + [p.replace(BLANK, " ").encode() for p in (*chars, *made)]
        size = sp.get_piece_size()
        by_id = [b""] * size
        for k, i in enumerate(self.id):
            by_id[i] = shown[k]
        self.shown = by_id
        self.shown_len = np.array([len(x) for x in by_id], np.int64)
        self.shown_at = np.concatenate(([0], np.cumsum(self.shown_len)))
        self.shown_bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def _hash(self, p: str) -> np.uint64:
        up, _ = _power(len(p))
        return mix((self.salt[[self.number[c] for c in p]] * up).sum(dtype=U).reshape(1) + U(len(p)))[0]

    def symbols(self, text: str) -> list[int]:
        """Numbers of the characters of a text; one outside the vocabulary is its bytes."""
        out: list[int] = []
        for c in text:
            k = self.char[ord(c)]
            out += [int(k)] if k >= 0 else list(c.encode())
        return out

    def stable(self, a: int, b: int) -> bool:
        """Whether two pieces side by side stay two."""
        limit = NONE
        while True:
            if self.pair.get((a, b), NONE) < limit:
                return False
            undo_a = self.left[a] != a and (a > b or self.left[b] == b)
            if undo_a:
                limit, a = a, int(self.right[a])
            elif self.left[b] != b:
                limit, b = b + 1, int(self.left[b])
            else:
                return True

    def stables(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``stable`` of many pairs; each distinct pair is decided once."""
        key, back = np.unique(a.astype(np.int64) << 32 | b, return_inverse=True)
        x, y = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
        out, live, limit = np.ones(len(key), bool), np.arange(len(key)), np.full(len(key), NONE)
        while len(live):
            p, q = x[live], y[live]
            k = p.astype(np.int64) << 32 | q
            at = np.minimum(np.searchsorted(self.pair_keys, k), len(self.pair_keys) - 1)
            made = np.where(self.pair_keys[at] == k, self.pair_made[at], NONE)
            bad = made < limit[live]
            out[live[bad]] = False
            whole_p, whole_q = self.left[p] == p, self.left[q] == q
            undo_p = ~whole_p & ((p > q) | whole_q)
            undo_q = ~undo_p & ~whole_q
            limit[live] = np.where(undo_p, p, q + 1)
            x[live] = np.where(undo_p, self.right[p], p)
            y[live] = np.where(undo_q, self.left[q], q)
            live = live[~bad & (undo_p | undo_q)]
        return out[back.ravel()]


def _halves(piece: str, score: dict, known: dict) -> tuple[str, str] | None:
    """The two pieces whose merge makes this one, or None if merging by score never does."""
    parts = list(piece)
    if any(c not in known for c in parts):
        return None
    while len(parts) > 2:
        best = max(((score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score and a + b != piece), default=None)
        if best is None:
            return None
        i = -best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Stream:
    """Encodes symbols as they come; holds the boundaries of one window only."""

    def __init__(self, m: Model):
        self.m, self.window, self.base, self.n = m, [], 0, 0
        self.last: dict[int, int] = {}
        self.back: dict[int, int] = {0: 0}
        self.word: dict[tuple, int] = {}
        self.held = 0

    def _number(self, syms: tuple) -> int:
        if len(syms) == 1:
            return syms[0]
        m = self.m
        h = mix((m.salt[list(syms)] * _power(len(syms))[0]).sum(dtype=U).reshape(1) + U(len(syms)))[0]
        at = min(int(np.searchsorted(m.hashes, h)), len(m.hashes) - 1)
        return int(m.hash_number[at]) if len(m.hashes) and m.hashes[at] == h else -1

    def push(self, symbol: int) -> list[int]:
        """Take one symbol; return the ids that are now certain."""
        m = self.m
        self.window = [*self.window[-(m.longest - 1) :], symbol] if m.longest > 1 else [symbol]
        self.n += 1
        for size in range(min(len(self.window), self.n), 0, -1):
            key = tuple(self.window[-size:])
            if key not in self.word:
                if len(self.word) > 100_000:
                    self.word.clear()
                self.word[key] = self._number(key)
            piece, start = self.word[key], self.n - size
            if piece >= 0 and start >= self.base and (start == 0 or (start in self.last and m.stable(self.last[start], piece))):
                self.last[self.n], self.back[self.n] = piece, start
                break
        return self._commit(range(max(self.base, self.n - m.longest + 1), self.n + 1)) if self.n % 8 == 0 else []

    def finish(self) -> list[int]:
        return self._commit(range(self.n, self.n + 1))

    def _commit(self, live) -> list[int]:
        """Walk all live boundaries back until one is common to their paths."""
        points = set(live)
        while len(points) > 1:
            top = max(points)
            points.remove(top)
            points.add(self.back[top])
        meet, out, at = points.pop(), [], None
        at = meet
        while at > self.base:
            out.append(int(m_id) if (m_id := self.m.id[self.last[at]]) >= 0 else 0)
            at = self.back[at]
        if meet > self.base:
            for k in range(self.base, meet):
                self.back.pop(k, None)
                self.last.pop(k, None)
            self.base = meet
            self.back[meet] = meet
        return out[::-1]


def encode_stream(m: Model, symbols) -> list[int]:
    s, out = Stream(m), []
    for x in symbols:
        out += s.push(x)
    return out + s.finish()


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte positions of their first bytes) of UTF-8."""
    head = np.flatnonzero((data & 0xC0) != 0x80)
    pad = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32)
    b = pad[head]
    out = b.copy()
    for low, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero((b >= low) & (b < {0xC0: 0xE0, 0xE0: 0xF0, 0xF0: 0x100}[low]))
        v = b[at] & mask
        for k in range(1, more + 1):
            v = v << 6 | (pad[head[at] + k] & 0x3F)
        out[at] = v
    return out, head


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def certain(m: Model, syms: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Offsets of the windows that long words fall into: cut between symbols that no piece holds side by side."""
    long = np.flatnonzero(np.diff(offs) > SHORT)
    if not len(long) or not len(m.beside):
        return offs
    at = _gather(offs[long] + 1, np.diff(offs)[long] - 1)  # inner boundaries of long words
    key = syms[at - 1].astype(np.int64) << 32 | syms[at]
    k = np.minimum(np.searchsorted(m.beside, key), len(m.beside) - 1)
    return np.sort(np.concatenate((offs, at[m.beside[k] != key])))


def encode_words(m: Model, syms: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of words given as symbols."""
    cuts = certain(m, syms, offs)
    ids, at = _encode_windows(m, syms, cuts)
    return ids, at[np.searchsorted(cuts, offs)]


def _encode_windows(m: Model, syms: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(offs)
    counts, ids = np.zeros(len(size), np.int64), {}
    for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, SHORT)):
        rows = np.flatnonzero((size > low) & (size <= high))
        for part in np.array_split(rows, max(1, len(rows) // WALKED)):
            if len(part):
                got, n = _walk(m, syms, offs[part], size[part])
                counts[part] = n
                ids[int(part[0]), low] = (part, got)
    long = np.flatnonzero(size > SHORT)
    for r in long:
        got = np.array(encode_stream(m, syms[offs[r] : offs[r + 1]].tolist()), np.int32)
        counts[r] = len(got)
        ids[int(r), -1] = (np.array([r]), got)
    at = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(at[-1], np.int32)
    for part, got in ids.values():
        out[_gather(at[part], counts[part])] = got
    return out, at


def _walk(m: Model, syms: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The walk over many short words, boundary by boundary."""
    n, most = len(size), int(size.max())
    up, down = _power(most + 1)
    grid = np.zeros((most, n), np.int32)
    for i in range(most):
        live = np.flatnonzero(size > i)
        grid[i, live] = syms[start[live] + i]
    run = np.zeros((most + 1, n), U)
    np.cumsum(m.salt[grid] * up[:most, None], axis=0, out=run[1:])
    last, back = np.full((most + 1, n), -1, np.int32), np.zeros((most + 1, n), np.int32)
    for i in range(1, most + 1):
        alive = np.flatnonzero(size >= i)
        rows, longs, pieces = [], [], []
        for w in range(min(i, m.longest), 1, -1):
            h = mix((run[i, alive] - run[i - w, alive]) * down[i - w] + U(w))
            at = np.flatnonzero(m.maybe[h >> U(44)])
            k = np.minimum(np.searchsorted(m.hashes, h[at]), len(m.hashes) - 1)
            ok = m.hashes[k] == h[at]
            rows.append(alive[at[ok]])
            longs.append(np.full(int(ok.sum()), w))
            pieces.append(m.hash_number[k[ok]])
        last[i, alive], back[i, alive] = grid[i - 1, alive], i - 1
        if rows:
            r, w, p = np.concatenate(rows), np.concatenate(longs), np.concatenate(pieces)
            before = last[i - w, r]
            ok = w == i
            inner = np.flatnonzero(~ok)
            if len(inner):
                ok[inner] = m.stables(before[inner], p[inner])
            r, w, p = r[ok], w[ok], p[ok]
            # candidates come longest first: write them shortest first, so that the longest stays
            last[i, r[::-1]], back[i, r[::-1]] = p[::-1], (i - w)[::-1]
    path, at = [], size.copy()
    while (live := np.flatnonzero(at > 0)).size:
        step = np.full(n, -1, np.int32)
        step[live] = m.id[last[at[live], live]]
        path.append(step)
        at[live] = back[at[live], live]
    table = np.stack(path[::-1], axis=1)
    return table[table >= 0], (table >= 0).sum(axis=1)


def encode_column(m: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all texts of a column."""
    data, offs = buffers(column)
    raw = data.tobytes()
    if BLANK.encode() in raw:
        data, offs = buffers(pa.array([None if t is None else t.replace(BLANK, " ") for t in column.to_pylist()], pa.string()))
    full = np.diff(offs) > 0
    at = offs[:-1][full]
    data = np.insert(data, at, 32)  # the blank that the model puts before every text
    offs = offs + np.concatenate(([0], np.cumsum(full)))
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    blank = data == 32
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[offs[:-1][full]] = True
    first = np.flatnonzero(head)
    end = np.append(first[1:], len(data))
    key = np.zeros(len(first), U)
    for a, b in spans(np.append(first, len(data))):  # a mebibyte at a time bounds the memory
        lo = first[a]
        part, s, e = data[lo : end[b - 1]], first[a:b] - lo, end[a:b] - lo
        up, down = _power(len(part) + 1)
        run = np.zeros(len(part) + 1, U)
        np.cumsum((part.astype(U) + U(1)) * U(0xD6E8FEB86659FD93) * up[:-1], out=run[1:])
        key[a:b] = mix((run[e] - run[s]) * down[s] + (e - s).astype(U))
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    words = data[_gather(first[one], (end - first)[one])]
    word_at = np.concatenate(([0], np.cumsum((end - first)[one])))
    points, heads = _code_points(words)
    points = np.where(points == 32, ord(BLANK), points)
    sym = m.char[points]
    width = np.diff(np.append(heads, len(words)))
    n_sym = np.where(sym >= 0, 1, width)
    sym_at = np.concatenate(([0], np.cumsum(n_sym)))
    syms = np.zeros(sym_at[-1], np.int32)
    known = sym >= 0
    syms[sym_at[:-1][known]] = sym[known]
    un = np.flatnonzero(~known)
    syms[_gather(sym_at[un], n_sym[un])] = words[_gather(heads[un], width[un])]
    word_sym = sym_at[np.searchsorted(heads, word_at)] if len(heads) else np.zeros(1, np.int64)
    ids, ids_at = encode_words(m, syms, word_sym)
    count = np.diff(ids_at)[which]
    out = ids[_gather(ids_at[which], count)]
    total = np.concatenate(([0], np.cumsum(count)))
    return out, total[np.searchsorted(first, offs)]


def decode_column(m: Model, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of lists of ids, without the blank that the model put first."""
    size = m.shown_len[ids]
    data = m.shown_bytes[_gather(m.shown_at[ids], size)]
    total = np.concatenate(([0], np.cumsum(size)))[offs]
    full = np.diff(total) > 0
    lead = total[:-1][full]
    lead = lead[data[lead] == 32]
    out = np.delete(data, lead)
    return out, total - np.searchsorted(lead, total)


def comes_back(m: Model, column: pa.Array, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text's ids decode to its bytes."""
    raw, was = buffers(column)
    same = np.zeros(len(was) - 1, bool)
    for a, b in spans(was):
        data, back = decode_column(m, ids[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
        own, at = raw[was[a] : was[b]], was[a : b + 1] - was[a]
        if np.array_equal(back, at):
            wrong = np.concatenate(([0], np.cumsum(data != own)))[at]
            same[a:b] = np.diff(wrong) == 0
        else:
            same[a:b] = [data[back[i] : back[i + 1]].tobytes() == own[at[i] : at[i + 1]].tobytes() for i in range(b - a)]
    return same


def encode(docs: DataFrame, path: str = MODEL, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts and whether they decode to the same bytes (``round_trip``)."""
    docs = docs.drop(out, "round_trip")
    at = docs.columns.index(text)

    def run(batches):
        m = model(path)
        for batch in batches:
            for a, b in spans(buffers(batch.column(at))[1], SLICE):
                part = batch.slice(a, b - a)
                column = part.column(at)
                ids, offs = encode_column(m, column)
                same = comes_back(m, column, ids, offs)
                null = column.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids), mask=pa.array(null) if null.any() else None)
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(same)], names=[*part.schema.names, out, "round_trip"])

    ship(docs.sparkSession)
    return docs.mapInArrow(tidy(run), schema_with(docs, **{out: "array<int>", "round_trip": "boolean"}))


def decode(rows: DataFrame, path: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the texts of lists of ids; ids outside the vocabulary give nothing."""
    rows = rows.drop(out)
    at = rows.columns.index(ids)

    def run(batches):
        m = model(path)
        for batch in batches:
            lists = batch.column(at)
            flat = np.asarray(lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False), np.int64)
            offs = lists.offsets.to_numpy() - lists.offsets[0].as_py() if not lists.null_count else np.concatenate(([0], np.cumsum([len(x or ()) for x in lists.to_pylist()])))
            flat = np.where((flat < 0) | (flat >= len(m.shown)), 0, flat)
            data, back = decode_column(m, flat, offs)
            raw = data.tobytes()
            texts = [None if null else raw[a:b].decode("utf-8", "replace") for a, b, null in zip(back[:-1], back[1:], lists.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    ship(rows.sparkSession)
    return rows.mapInArrow(tidy(run), schema_with(rows, **{out: "string"}))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")
