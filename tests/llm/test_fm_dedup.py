import hashlib
import random

import numpy as np
import pytest

from brickfolio.llm.fm_dedup import FMIndex, remove_repeats


def brute(rows, window):
    docs = sorted({(i if i is not None else 1 << 62, t or "") for i, t in rows})
    seen, out = {}, {}
    for i, text in docs:
        words = text.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            if key in seen:
                gone[k:k + window] = [True] * window
            seen.setdefault(key, (i, k))
        left = [w for w, g in zip(words, gone, strict=True) if not g]
        out[i, text] = (len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())
    return sorted((i, *out[i if i is not None else 1 << 62, t or ""]) for i, t in rows if i is not None)


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyzé")
    shared = [[word() for _ in range(rng.randint(8, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = list(rng.choice(shared)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = word()
            words += part
        rows.append((i * 7 % n, "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words)))
    rows += [(n, rows[5][1]), (n + 1, "a " * 700), (n + 2, "a " * 100), (n + 3, None), (n + 4, "")]
    return rows


@pytest.mark.parametrize("hot", [5000, 3])
def test_as_brute_force(spark, hot):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = remove_repeats(docs, window=8, gram=3, hot=hot).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == brute(rows, 8)


def test_nulls_repeated_rows_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (2, text, None), (None, text, "z"), (None, None, None)], "doc_id long, text string, name string")
    got = {(r.doc_id, r.n_words, r.n_removed): r for r in remove_repeats(docs).collect()}
    assert set(got) == {(1, 30, 0), (2, 30, 30), (None, 30, 30), (None, 0, 0)}
    assert remove_repeats(docs.limit(0)).count() == 0


def test_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(0)
    length = rng.integers(5, 30, 40)
    symbols = rng.integers(1, 4, length.sum())
    first = np.cumsum(length) - length
    index = FMIndex(symbols, length, 5)
    low, high = index.match(symbols, first, length, 5)
    windows = [tuple(symbols[i:i + 5]) for f, n in zip(first, length, strict=True) for i in range(f, f + n - 4)]
    at = [i for f, n in zip(first, length, strict=True) for i in range(f, f + n - 4)]
    for i, w in zip(at, windows, strict=True):
        assert high[i] - low[i] == windows.count(w)


def test_repeats_inside_one_passage(spark):
    rows = []
    for period in range(1, 15):
        for size in range(25, 81, 5):
            i = len(rows)  # words that no other text has
            rows.append((i, " ".join(f"t{i}w{k % period}" for k in range(size))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sum(r.n_removed > 0 for r in got) > 100
    assert sorted(map(tuple, got)) == brute(rows, 20)
