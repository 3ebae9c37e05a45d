import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickfolio.llm.language import Network, Reader, fit, identify, predict, train

SF = "/root/testdata/sf0.01"


def test_gradients_as_differences():
    network = Network.fresh(["a", "b", "c"], seed=1, hidden=5)
    for d in (network.ahead, network.back):
        d.weights = {k: v.astype(np.float64) for k, v in d.weights.items()}
    network.top = {k: v.astype(np.float64) for k, v in network.top.items()}
    rng = np.random.default_rng(2)
    codes, target = rng.integers(97, 101, (6, 7)).astype(np.uint8), rng.integers(0, 3, 7)
    _, parts = network.gradients(codes, target)
    for weights, grads in parts:
        for name, g in grads.items():
            for at in [np.unravel_index(k, g.shape) for k in np.argsort(-np.abs(g), axis=None)[:6]]:
                kept, step = weights[name][at], 1e-3
                weights[name][at] = kept + step
                up = network.gradients(codes, target)[0]
                weights[name][at] = kept - step
                down = network.gradients(codes, target)[0]
                weights[name][at] = kept
                assert abs((up - down) / (2 * step) - g[at]) < 2e-3 * max(0.05, abs(g[at]))


def test_reading_in_parts_changes_nothing():
    network = train([b" ab ", b" xy ", b" abab "] * 20, ["p", "q", "p"] * 20, steps=50)
    words = [b"ab", b"x" * 70, b"yx", b"q"]
    whole = Reader(network).read(words)
    assert np.allclose(whole[:, :-1].sum(axis=1), whole[:, -1], atol=1e-3)
    assert list(whole[:, -1]) == [4, 76, 4, 3]
    reader, codes = Reader(network, kept=2), np.arange(4, dtype=np.uint64)
    for some in ([0, 2], [0, 1, 2, 3], [1, 3]):
        assert np.allclose(reader.look_up(codes[some], lambda k: words[some[k]]), whole[some], atol=1e-5)  # noqa: B023
    assert len(reader.codes) == 2


@pytest.fixture(scope="module")
def network(spark):
    return fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in predict(docs, network).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= got[r.doc_id].score <= 1 for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out and r.lang and len(r.text.split()) >= 20]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_only_the_text_counts(spark, network):
    rows = [(1, "the and of thing", "en", "a"), (2, "the and of thing", None, "b"), (3, None, "en", "a"), (4, "", "en", "a"), (5, "12 -- 7", "en", None), (None, "der die das und", "xx", "a"),
            (None, "der die das und", "xx", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = predict(docs, network).collect()
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"}
    assert {r.score for r in got if r.doc_id in (3, 4, 5)} == {0.0}
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id in (1, 2)}) == 1
    assert [r.lang_pred for r in got if r.doc_id is None] == ["de", "de"]
    assert predict(docs.limit(0), network).count() == 0
    none = identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
