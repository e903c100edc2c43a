import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from trendlens.llm import suffix_pieces as sa

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sa.Pieces(PATH)


def mixed(n, seed):
    random.seed(seed)
    parts = [" ", "  ", "\n", "\t", "a", "b", "the", "International", " international", "é", "日", "\0", "'s", "1", "!!", "\xa0", "<s>", "<0x0A>", "▁",
             "​", "　", "----", "=====", "    ", "xyzzy", "ﬁ", "\U0001f600", "e", "er", "in", "ing"]
    return ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(n)]


EDGES = ["", " ", "  ", " a", "a ", None, "-" * 500, "ab" * 400, "e" * 129, " " * 300, "日本語" * 100, "q", "\x01"]


def test_ids_equal_the_library(library, model):
    texts = mixed(4000, 1) + EDGES
    want = library.encode([t or "" for t in texts])
    assert [x.tolist() for x in model.encode(texts)] == want
    assert [model.decode(w) for w in want] == [library.decode(w) for w in want]
    assert [x.tolist() for x in model.encode(["\x01"])] == [library.encode("\x01")]


def test_short_stretches_and_heap_give_the_same(library, model, monkeypatch):
    texts = mixed(300, 2) + EDGES
    want = library.encode([t or "" for t in texts])
    monkeypatch.setattr(sa, "STRETCH", 50)
    assert [x.tolist() for x in model.encode(texts)] == want
    monkeypatch.setattr(sa, "LONG", 0)
    assert [x.tolist() for x in model.encode(texts)] == want


def test_ranges_find_every_occurrence(model):
    text = "international----in the internal"
    chars = model.rank_of[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
    slot, piece, _ = model._edges(chars)
    wide = model.longest + 1
    got = {(k // wide, k % wide, int(model.ids[piece[slot[k]]])) for k in np.flatnonzero(slot >= 0)}
    by_text = {model.out[i].decode().replace(" ", "▁"): int(i) for i in model.ids}
    want = {(a, n, by_text[text[a:a + n]]) for a in range(len(text)) for n in range(2, min(wide, len(text) - a + 1)) if text[a:a + n] in by_text}
    assert got == want


def test_round_trip_through_spark(spark, library):
    texts = mixed(200, 3) + EDGES + ["same", "same", "long text é " * 20_000]
    df = spark.createDataFrame([(i if i % 50 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    coded = sa.encode(df, PATH)
    rows = coded.withColumn("back", sa.decoded(F.col("ids"), PATH)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(r.text or "")
        assert r.ids == want and r.n_tokens == len(want) and r.ids_crc32 == zlib.crc32(np.array(want, dtype="<u4").tobytes())
        assert r.back == (r.text or "").replace("▁", " ")
    assert sa.encode(df.limit(0), PATH).collect() == []


def test_long_units_without_blanks(library, model):
    r = random.Random(6)
    letters = "".join(r.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(60_000))
    texts = [letters, "".join(r.choice("abcxyz日本é") for _ in range(5_000)), "a" * 3000, letters[:500] + " " + letters[:500]]
    assert [x.tolist() for x in model.encode(texts)] == library.encode(texts)
    parts = model._cut(letters)
    assert "".join(parts) == letters and max(map(len, parts)) < 1000
