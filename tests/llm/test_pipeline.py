"""The pipeline's stages on a small corpus, step by step against plain Python, and its last result."""

import random

import public_tokenizers
import pytest
from test_kneser_ney import sample
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline as cp
from trendlens.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(n=240):
    r = random.Random(4)
    base = [t + " " + u + " " + v + " " + w for t, u, v, w in zip(*(sample(n, s, [f"w{i}" for i in range(900)] + ["the", "of", "and"]) for s in (11, 12, 13, 14)), strict=True)]
    rows = [(i, t, "en", f"src{i % 5}") for i, t in enumerate(base)]
    rows += [(1000 + i, base[i], "en", "src1") for i in range(20)]                      # exact copies
    rows += [(2000 + i, base[i] + " tail", "en", "src2") for i in range(20, 40)]        # near copies
    rows += [(3000 + i, "".join(r.choices("zqxj#*%$!~^ ", k=400)), "en", "src3") for i in range(20)]
    rows += [(4000, base[50] + " call +1 (316) 555-2121 or 4111111111111111 x y z", "en", "src0"), (4001, None, "en", "src0"), (4002, "", None, None)]
    rows += [rows[5], rows[5]]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(120)] + [(3000 + i, 0, 0) for i in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_and_result(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in cp.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == COLUMNS
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert not [i for i in ids["quality_classifier"] if 3000 <= i < 4000]
    assert len([i for i in ids["quality_classifier"] if i < 240]) >= 236
    from test_host_and_url import brute
    left = [(i, t) for i, t, *_ in corpus() if i in set(ids["quality_classifier"])]
    words = {(i, t): brute(t) for i, t in left}
    assert ids["quality_rules"] == sorted(i for i, t in left if words[i, t][0] >= 50 and 2 * words[i, t][4] <= words[i, t][0])
    from test_ngram_join import brute as classes
    left = [(i, t) for i, t in left if i in set(ids["quality_rules"])]
    assert ids["ngram_join"] == sorted({c for i, _, c in classes(left)})
    assert ids["pii"] == ids["ngram_join"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_id = {i: t for i, t, *_ in corpus()}
    assert all(texts[i] == by_id[i] for i in texts if i != 4000)
    assert 4000 not in texts or "555-2121" not in texts[4000] and "4111111111111111" not in texts[4000]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    used, least = check_packing(cp.STAGES[-1][1](spark, docs, folder).collect(), list(texts.items()), library)
    assert used <= least + 1
    assert {r.doc_id for r in cp.run(spark, folder).select("doc_id").collect()} == set(texts)


def test_empty_corpus(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
