import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from brickfolio.llm.quality_rules import LADDERS, certified, judge, keep_good, log_binomial_cdf, select_step

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 8))
    dup = sum(1 for k, line in enumerate(lines) if WORD.search(line) and line in lines[:k])
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def make(seed=1, n=7000):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = [rng.choice(["der", "ça", "there", "é", "of", "naïve"]) + str(rng.randrange(300)) for _ in range(rng.choice([0, 5, 25, 60, 90]))]
        if words and rng.random() < 0.3:
            words += words[:rng.randint(1, 20)]
        if not good:
            words = [w + "##" for w in words]
        text = "".join(w + rng.choice([" ", " ", "\n", " \t"]) for w in words)
        if rng.random() < 0.2:
            text += "\nsame line\n same line\nsame line\n\n"
        rows.append((i, text, rng.choice(["en", "fr"]) if i % 50 else None, "s", len(text), "clash"))
        labels.append((i, int(good), 0))
    rows += [(n, None, "en", "s", None, None), (n, None, "en", "s", None, None), (None, " x y  z ", "xx", None, 0, None)]
    return rows, labels + [(0, 0, 1), (None, 1, 0), (3, None, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = make()
    return (rows, labels, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_counts_and_verdicts(tables):
    rows, labels, docs, marks = tables
    got = judge(docs, marks).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(((i, *brute(t)) for i, t, *_ in rows), key=key)
    good = {i for i, q, _ in labels if q == 1} - {0}
    kept = {r.doc_id for r in got if r.kept}
    passed = {r.doc_id for r in got if not r.base_failed and r.n_words}
    assert kept <= passed
    assert len((passed & good) - kept) <= 0.05 * len(passed & good)
    bad = {r.doc_id for r in got if r.doc_id in passed and r.n_symbols} - good
    assert len(bad & kept) < 0.1 * len(bad)
    again = keep_good(docs, marks)
    assert again.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in again.collect()) == sorted(i for i in kept)


def test_empty_tables_and_no_labels(tables):
    _, _, docs, marks = tables
    assert judge(docs.limit(0), marks).count() == 0
    assert all(r.kept != r.base_failed for r in judge(docs, marks.limit(0)).collect())


@pytest.mark.parametrize("n, p", [(10, 0.3), (200, 0.05), (1000, 0.01)])
def test_binomial_is_exact(n, p):
    for k in range(int(n * p)):
        f = Fraction(p)
        want = sum(math.comb(n, j) * f**j * (1 - f)**(n - j) for j in range(k + 1))
        assert math.isclose(math.exp(log_binomial_cdf(k, n, p)), float(want), rel_tol=1e-9)
    assert certified(0, 300, 0.01, 0.05) and not certified(0, 298, 0.01, 0.05)


def test_guarantee_holds_over_repeated_draws():
    rng, lost = np.random.default_rng(5), 0
    steps = len(LADDERS["symbols"]) + 1
    share = np.linspace(1, 0.0, steps)
    share /= share.sum()
    tail = 1 - np.cumsum(share)  # the true rate of rejected good documents at each step
    for _ in range(400):
        good, bad = rng.multinomial(2000, share), np.full(steps, 1000)
        step = select_step(good, bad, 0.05, 0.05, 0.5)
        lost += step < steps and tail[step] > 0.05
    assert lost <= 400 * 0.05 + 3 * math.sqrt(400 * 0.05 * 0.95)
