import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from atelier.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    return pieces.model(pieces.MODEL), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def encoded(m, texts):
    ids, offs = pieces.encode_column(m, pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])]


def test_ids_equal_the_library(both):
    m, sp = both
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abcdeinrst  \n\t日本é😀.▁x0123") for _ in range(rnd.randint(0, 90))) for _ in range(1500)]
    texts += ["a" * 300, " " * 70, "the the  the   the", "internationalisation" * 8, "x" * 65, "\x00\x01", "<s> </s> <unk> <0x41>"]
    assert encoded(m, texts) == sp.encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    m, sp = both
    assert encoded(m, [text]) == [sp.encode(text)]
    ids, offs = pieces.encode_column(m, pa.array([text]))
    data, _ = pieces.decode_column(m, ids, offs)
    assert data.tobytes().decode() == text.replace("▁", " ")


def test_text_without_blanks_falls_into_windows(both):
    m, sp = both
    rnd = random.Random(3)
    han = "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(3000))
    coded = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(3000))
    texts = [han, coded, "".join(rnd.choice([*"日本語の文章です。", *"abc"]) for _ in range(2000)), "e" * 500 + "é" * 500, "=" * 700]
    assert encoded(m, texts) == sp.encode(texts)
    import numpy as np

    syms = np.array(m.symbols("▁" + texts[2]), np.int32)
    cuts = pieces.certain(m, syms, np.array([0, len(syms)]))
    assert len(cuts) > 100 and cuts[0] == 0 and cuts[-1] == len(syms)


def test_a_model_with_inner_blanks_is_refused(monkeypatch):
    class Odd:
        def __init__(self, model_file):
            self.p = [f"<0x{b:02X}>" for b in range(256)] + ["a", "▁", "a▁a"]

        def get_piece_size(self):
            return len(self.p)

        def id_to_piece(self, i):
            return self.p[i]

        def get_score(self, i):
            return -float(i)

        def is_byte(self, i):
            return i < 256

        def is_control(self, i):
            return False

        is_unknown = is_unused = is_control

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Odd)
    with pytest.raises(ValueError, match="blank behind"):
        pieces.Model("odd")


def test_the_stream_keeps_a_bounded_window(both):
    m, sp = both
    text = "antidisestablishmentarianism" * 40
    stream, out, most = pieces.Stream(m), [], 0
    for s in m.symbols("▁" + text):
        out += stream.push(s)
        most = max(most, len(stream.last), len(stream.window))
    assert out + stream.finish() == sp.encode(text)
    assert len(out) > 100 and most <= 4 * m.longest


def test_columns(spark):
    rows = [(1, "hello world", 5), (2, None, 6), (3, "", 7), (None, " lead\n", 8), (1, "hello world", 5), (9, "z" * 3000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.encode(df).collect()
    by = {r.text: r for r in got}
    assert len(got) == 6 and by[None].ids is None and by[""].ids == [] and all(r.round_trip for r in got)
    back = pieces.decode(pieces.encode(df).withColumnRenamed("text", "was")).collect()
    assert all(r.text == r.was for r in back)
    assert pieces.encode(df.limit(0)).count() == 0
    odd = pieces.decode(spark.createDataFrame([([1, 99_999, -4, None],)], "ids array<int>")).first()
    assert odd.text == ""


def test_query_round_trips(spark):
    assert all(r.round_trip for r in pieces.op9_pieces(spark, "/root/testdata/sf0.001").select("round_trip").collect())
