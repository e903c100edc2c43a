"""What the encoder holds at once doesn't grow with the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from trendlens.llm import bpe
from trendlens.llm.queries import VOCABULARY


def texts(n_bytes):
    rng = np.random.default_rng(5)
    words = np.array([f"w{i % 900}x{i % 7}" for i in range(3000)])
    found, size = [], 0
    while size < n_bytes:
        found.append(" ".join(rng.choice(words, 2000)))
        size += len(found[-1])
    return found


def test_encoder_works_in_small_steps():
    column = pa.array(texts(8 << 20))
    encoder = bpe.Encoder(VOCABULARY)
    tracemalloc.start()
    try:
        base = tracemalloc.get_traced_memory()[0]
        for _ in encoder.encode_column(column, 2):
            pass
        peak = tracemalloc.get_traced_memory()[1] - base
    finally:
        tracemalloc.stop()
    assert peak < 64 << 20  # a batch of 8 MB


@pytest.mark.parametrize("size", [1, 1000, 1 << 22])
def test_steps_do_not_change_ids(monkeypatch, size):
    column = pa.array(["", None, "é 日本 \U0001f600 x", " \n y", *texts(20_000)[:1]] * 3)
    whole = [ids[a:b].tolist() for _, ids, t in bpe.Encoder(VOCABULARY).encode_column(column, 2) for a, b in zip(t, t[1:])]
    monkeypatch.setattr(bpe, "CHUNK", size)
    assert [ids[a:b].tolist() for _, ids, t in bpe.Encoder(VOCABULARY).encode_column(column, 2) for a, b in zip(t, t[1:])] == whole
