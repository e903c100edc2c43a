import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from trendlens.llm import fingerprints as fp
from trendlens.llm.text_kernels import shingle_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    vocab = ["w%d" % i for i in range(300)] + ["É", "日本", "ÀB"]
    out = [" ".join(rng.choice(vocab, rng.integers(0, 200))) for _ in range(n)]
    for i in range(0, n - 1, 3):  # near copies
        w = out[i].split(" ")
        if len(w) > 20:
            w[10] = "CHANGED"
            out[i + 1] = " ".join(w)
    return out


def test_shingles_equal_brute_force():
    t = texts(60) + ["", None, " \t\n", "one", "One TWO three", "a\x0bb\x1cc d e f g", "x" * 5000]
    seen = {}
    for a, h, edges in shingle_chunks(pa.array(t, type=pa.string())):
        for i in range(len(edges) - 1):
            got, want = set(h[edges[i]:edges[i + 1]].tolist()), shingle_set(t[a + i])
            assert len(got) == len(want)
            for s in got:
                seen.setdefault(s, set()).add(a + i)
    for i, x in enumerate(t):
        for j, y in enumerate(t[:i]):
            shared = sum(1 for v in seen.values() if i in v and j in v)
            assert shared == len(shingle_set(x) & shingle_set(y))


def test_likeness_is_near_jaccard_and_densified():
    t = texts(120) + ["one", "one two three four five six", "", None]
    low = fp.digits(pa.array(t, type=pa.string()))
    err = [abs(fp.likeness(low[[i]], low[[j]])[0] - jaccard(shingle_set(t[i]), shingle_set(t[j])))
           for i in range(len(t)) for j in range(i)]
    assert np.mean(err) < 0.03 and np.quantile(err, 0.99) < 0.15
    assert (low[:120][[bool(shingle_set(x)) for x in t[:120]]] < 16).all()
    assert fp.as_text(low)[-1] == "" and len(fp.as_text(low)[120]) == fp.BINS


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, text) in enumerate(order):
        t, n = text or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("rows", [
    [(i * 3 - 10, t) for i, t in enumerate(texts(90))],
    [(5, "only one document here")],
    [(1, None), (2, ""), (2, "Same id"), (2, "same id, other text"), (None, "no id é日本 " * 9), (2**60 + 1, "big"), (2**60, "b")],
    [(7, "r e p e a t e d")] * 5 + [(8, "x" * 30000), (9, "ÀÉ " * 40)],
    [],
])
@pytest.mark.parametrize("buckets", [1, 7])
def test_edited_pairs_equal_brute_force(spark, rows, buckets):
    df = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], "doc_id long, text string, copy string, bucket double").repartition(5)
    got = fp.edited_pairs(df, buckets).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(expected(rows), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    plain = {(r.doc_id, r.n_chars): r.fingerprint for r in fp.fingerprints(df).selectExpr("doc_id", "fingerprint", "length(coalesce(text, '')) n_chars").select("doc_id", "n_chars", "fingerprint").collect()}
    if len({r[0] for r in rows}) == len(rows):
        assert all(plain[r.doc_id, r.n_chars] == r.fingerprint for r in got)
