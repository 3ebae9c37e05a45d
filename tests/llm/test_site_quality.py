import math
import random
from collections import Counter

import numpy as np
import pytest

from brickfolio.llm.site_quality import features, score, strength, train


class Sums:
    def __init__(self, groups, total, squares, excess):
        self.groups, self.total, self.squares, self.excess = groups, total, squares, excess


def moments(counts, rates):
    return Sums(len(counts), sum(n for n, _ in counts), sum(n * n for n, _ in counts),
                sum(n * (g / n - r) ** 2 / (r * (1 - r)) for (n, g), r in zip(counts, rates, strict=True)))


def make(seed=1, n=1200):
    rng, rows, labels = random.Random(seed), [], []
    rate = {f"h{k}": 0.95 if k % 2 else 0.4 for k in range(6)}
    for i in range(n):
        host, path = f"h{rng.randrange(6)}" if rng.random() < 0.95 else None, rng.choice(["a", "b", None])
        good = rng.random() < rate.get(host, 0.7)
        words = [rng.choice(["the", "and", "naïve", "of"]) + ("" if good or rng.random() < 0.5 else "##|") for _ in range(rng.choice([1, 3, 30]))]
        rows.append((i, " ".join(words), path, host, "x"))
        if rng.random() < 0.5:
            labels.append((i, int(good), 0))
    rows += [(n, None, "a", "h1", "x"), (n + 1, "", "zz", "hx", "x"), (n + 1, "", "zz", "hx", "x"), (None, "the and", "a", "h1", "x")]
    return rows, labels + [(0, 0, 1), (0, 1, 1), (None, 1, 0), (5, None, 0)]


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = make()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, labels, docs, marks, score(docs, marks).collect()


def test_rates_as_counted(scored):
    rows, labels, _, _, got = scored
    good = {}
    for i, q, _ in labels:
        if q is not None and i is not None:
            good[i] = min(q, good.get(i, 1))
    site = {i: (h, p) for i, _, p, h, _ in rows}
    pn, pg, hn, hg = Counter(), Counter(), Counter(), Counter()
    for i, q in good.items():
        h, p = site[i]
        pn[h, p] += 1
        pg[h, p] += q
        hn[h] += 1
        hg[h] += q
    rate = (sum(good.values()) + 0.5) / (len(good) + 1)
    s_h = strength(moments([(hn[h], hg[h]) for h in hn], [rate] * len(hn)))
    host = {h: (hg[h] + rate * s_h) / (hn[h] + s_h) for h in hn}
    s_p = strength(moments([(pn[k], pg[k]) for k in pn], [host[k[0]] for k in pn]))
    assert len(got) == len(rows)
    for r in got:
        h, p = site[r.doc_id]
        own, won = int(r.doc_id in good), good.get(r.doc_id, 0)
        hr = (hg[h] - won + rate * s_h) / (hn[h] - own + s_h)
        pr = (pg[h, p] - won + hr * s_p) / (pn[h, p] - own + s_p)
        assert math.isclose(r.host_rate, hr, rel_tol=1e-9) and math.isclose(r.path_rate, pr, rel_tol=1e-9)
        assert math.isclose(r.score, 1 / (1 + math.exp(-(r.evidence + math.log(pr / (1 - pr))))), rel_tol=1e-9)
        assert r.kept == (r.score >= 0.5)


def test_accuracy_and_empty_texts(scored):
    rows, _, docs, marks, got = scored
    text = {i: t for i, t, *_ in rows}
    right = [r.kept == ("##" not in text[r.doc_id]) for r in got if text[r.doc_id] and len(text[r.doc_id]) > 60]
    assert sum(right) >= 0.97 * len(right)
    assert all(r.evidence == 0 for r in got if not text[r.doc_id])
    assert score(docs.limit(0), marks).count() == 0
    plain = score(docs, marks.limit(0)).collect()
    assert {(r.evidence, r.score) for r in plain} == {(0.0, 0.5)}


def test_strength_finds_the_spread_of_groups():
    rng = np.random.default_rng(0)
    for a, b in ((8, 2), (80, 20)):
        counts = [(n, int(rng.binomial(n, rng.beta(a, b)))) for n in rng.integers(20, 200, 3000)]
        assert 0.8 * (a + b) < strength(moments(counts, [a / (a + b)] * len(counts))) < 1.25 * (a + b)
    assert strength(Sums(1, 10, 100, 0)) == 1000.0


def test_features_and_classifier():
    texts = [b"abab", b"", b"a", "é".encode() * 3]
    x = features(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]))
    assert np.allclose((x ** 2).sum(axis=1), [1, 0, 0, 1])
    good = np.array([1.0, 0.0] * 50)
    c = train(np.stack([good, 1 - good], axis=1), good)
    assert c.evidence(np.eye(2))[0] > 3 > -3 > c.evidence(np.eye(2))[1]
