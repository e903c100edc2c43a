import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from trendlens.llm import packing, token_store
from trendlens.llm.bpe import Encoder

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    t.encode_special_tokens = True
    return t


def encode(enc, texts, end=None):
    return [ids[a:b].tolist() for _, ids, e in enc.encode_column(pa.array(texts, type=pa.string()), end) for a, b in zip(e[:-1], e[1:], strict=True)]


def test_cached_encoder_equals_library(library):
    random.seed(1)
    parts = [" ", "  ", "\n", "\t", " \n", " ", "\x85", "\x1c", "a", "b", "Th", "é", "日", "\0", "'s", "'", "1", "!!", "<|endoftext|>", "Ġ", "\r\n", "​", "　", "\xa0", "“"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(4000)] + ["", " ", "  ", " a", "a ", None, "x" * 9000]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    enc = Encoder(VOCAB)
    assert encode(enc, texts) == want
    assert encode(enc, texts, 2) == [w + [2] for w in want]


def test_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr("trendlens.llm.bpe.CACHE_PIECES", 50)
    enc = Encoder(VOCAB)
    for i in range(5):
        texts = [f"word{i} other{j} again" for j in range(30)]
        assert encode(enc, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


ROWS = [(i * 7 % 101, f"document {i} " + "some words here é日 " * (i * 13 % 40)) for i in range(101)]
EDGE = [(5, None), (5, ""), (4, "same"), (4, "same"), (None, "no id"), (2**60 + 1, "long one " * 5000), (1, "tail ")]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("rows", [ROWS, EDGE, [(1, "one")], []])
def test_token_files_round_trip(spark, tmp_path, library, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, part int").repartition(4)
    path = str(tmp_path / uuid.uuid4().hex)
    token_store.write_tokens(df, path, VOCAB)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = token_store.token_spans(token_store.read_tokens(spark, path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want


def test_file_format(spark, tmp_path):
    import pyarrow.parquet as pq
    df = spark.createDataFrame([(i, "some words of text " * 30) for i in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "t")
    token_store.write_tokens(df, path, VOCAB)
    f = sorted((tmp_path / "t").glob("part-*.parquet"))[0]
    group = pq.ParquetFile(f).metadata.row_group(0)
    by = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in by["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings
    assert by["doc_id"].has_column_index and by["doc_id"].has_offset_index
    plan = token_store.read_tokens(spark, path).filter("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan and "ids:array" not in plan.split("ReadSchema")[-1]


def check_packing(got, rows, library, size=1024):
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids), size), len(ids)]
        want += [(i, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins), -(-sum(w[3] for w in want) // size)


@pytest.mark.parametrize("rows", [ROWS, EDGE * 3, [(1, "one")], []])
def test_packing_of_documents(spark, library, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, room string, salt int").repartition(3)
    used, least = check_packing(packing.pack_documents(df, VOCAB).collect(), rows, library)
    assert used <= least + 1


def test_exchange_never_needs_more(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), 0, 0, int(n), int(i), int(i)) for i, n in enumerate(np.append(rng.integers(1, 1025, 3000), rng.integers(300, 400, 2000)))]
    cut = spark.createDataFrame(rows, packing._PIECES)
    got = packing.pack(cut, partition_pieces=400).collect()
    assert len(got) == len(rows)
    n = len({r.sequence_id for r in got})
    lengths = np.array([r[3] for r in rows])
    alone = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(lengths)], "id long, n long").selectExpr("pmod(xxhash64(id), 13) as b", "n")
    apart = sum(len(packing.best_fit(np.sort(np.array([r.n for r in alone.filter(f"b = {b}").collect()]))[::-1])[1]) for b in range(13))
    assert packing.lower_bound(lengths) <= n < apart  # partitions that never exchange need more


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_bound_is_below_the_optimum(lengths):
    lengths = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    where, rooms = packing.best_fit(lengths, 20)

    def optimum(i, bins):
        if i == len(lengths):
            return len(bins)
        best = optimum(i + 1, [*bins, 20 - lengths[i]])
        for b in range(len(bins)):
            if bins[b] >= lengths[i] and bins[b] not in bins[:b]:
                best = min(best, optimum(i + 1, [*bins[:b], bins[b] - lengths[i], *bins[b + 1:]]))
        return best
    assert packing.lower_bound(lengths, 20) <= optimum(0, []) <= len(rooms)
    assert all(lengths[where == b].sum() + rooms[b] == 20 for b in range(len(rooms)))


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "  <|endoftext|><|endoftext|>x ", "<|endoftext|", "none", "", None, " \n<|endoftext|>\xa0 é", "<|ENDOFTEXT|>", "tail <|endoftext|>"]


def test_added_tokens_equal_the_default_library():
    default = Tokenizer.from_file(VOCAB)
    random.seed(2)
    parts = [" ", "  ", "\n", "a", "The", "é", "\xa0", "'s", "<|endoftext|>", "<|", "|>", "endoftext"]
    texts = ADDED + ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(2000)]
    want = [default.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    enc = Encoder(VOCAB, added=True)
    assert encode(enc, texts) == want
    assert encode(enc, texts, 2) == [w + [2] for w in want]
    assert [a for a, _, e in enc.encode_column(pa.array(texts[:4])) for _ in e[1:]] == [0, 1, 2, 3]


def test_added_tokens_in_store_and_packing(spark, tmp_path):
    default = Tokenizer.from_file(VOCAB)
    rows = list(enumerate(ADDED)) + [(100, "words <|endoftext|> " * 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = str(tmp_path / "added")
    token_store.write_tokens(df, path, VOCAB)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_store.token_spans(token_store.read_tokens(spark, path)).collect()}
    want = {i: default.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    assert got == {i: (len(ids), crc(ids)) for i, ids in want.items()}
    check_packing(packing.pack_documents(df, VOCAB).collect(), rows, default)
