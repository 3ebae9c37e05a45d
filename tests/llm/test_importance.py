import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brickfolio.llm import importance
from brickfolio.llm.importance import Dictionary, features, pieces, resample, run_crcs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs_of(words, most=3):
    return [" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, least=20, percent=5):
    buckets = lambda t: [zlib.crc32(r.encode()) % 10_000 for r in runs_of(words_of(t))]
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    out = []
    for i, x in docs:
        found = buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((k for k, (_, x) in enumerate(docs) if len(words_of(x)) >= least), key=lambda k: (-out[k][3], out[k][0] if out[k][0] is not None else 1 << 63))
    rank = {k: n + 1 for n, k in enumerate(fit[:percent * len(fit) // 100])}
    return [(*row, rank.get(k)) for k, row in enumerate(out)]


def vocabulary(seed, n):
    rng = random.Random(seed)
    letters = "abcdefghij0123456789éß中文"
    return ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 9]))) for _ in range(n)] + ["x" * 70, "long" * 60]


@pytest.mark.parametrize("size", [30, 1 << 20])
def test_runs_in_pieces_as_spelt(size):
    rng, words = random.Random(1), vocabulary(1, 50)
    glue = [" ", "  ", "-", "\n", ".\x00", "'"]
    texts = ["".join(rng.choice(words).upper() + rng.choice(glue) for _ in range(n)) for n in (0, 1, 2, 3, 40, 7, 300)]
    texts[2:2] = [None, "", " ;- ", "A" * 5000]
    known = [w.encode() for w in words[:20]]
    dictionary = Dictionary(known, [zlib.crc32(w) for w in known])
    got = [Counter() for _ in texts]
    n_words = Counter()
    for own, text, bucket in features([t.encode() if t is not None else None for t in texts], dictionary, 3, 10_000, size):
        n_words.update(own.tolist())
        for k, b in zip(text.tolist(), bucket.tolist(), strict=True):
            got[k][b] += 1
    assert got == [Counter(zlib.crc32(r.encode()) % 10_000 for r in runs_of(words_of(t))) for t in texts]
    assert [n_words[k] for k in range(len(texts))] == [len(words_of(t)) for t in texts]


def test_pieces_are_bounded_and_cut_between_words():
    text = b"ab cde " * 10_000
    found = list(pieces([b"x", text, b"y"], 1000))
    assert max(len(p.body) for p in found) <= 1002
    assert b" ".join(p.body for p in found).split() == (b"x " + text + b" y").split()
    assert [p.goes_on for p in found if p.first == 1][:2] == [False, True]


def test_composition_of_words_of_any_length():
    words = [b"a" * n for n in (1, 63, 64, 65, 100, 5000, 100_000)]
    crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    size = np.array([len(w) for w in words])
    got = {n: codes.tolist() for n, (_, codes) in enumerate(run_crcs(crc, size, np.zeros(len(words)), 4), 1)}
    assert got == {n: [zlib.crc32(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)] for n in (1, 2, 3, 4)}


@pytest.mark.parametrize("dictionary", [1 << 17, 30, 0])
def test_documents_as_brute_force(spark, dictionary):
    rng, words = random.Random(2), vocabulary(2, 300)
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([3, 19, 20, 21, 60])))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "!?"), (1003, " ".join(rng.choices(words[:5], k=3000))), (None, " ".join(words[:25]))]
    target = [" ".join(rng.choices(words[:40], k=30)) for _ in range(20)] + [None]
    rows = spark.createDataFrame([(i, t, 7, "q") for i, t in docs], "doc_id long, text string, rank int, bucket string")
    got = resample(rows, spark.createDataFrame([(t,) for t in target], "text string"), dictionary=dictionary)
    assert [str(got.schema[c].dataType) for c in ("doc_id", "n_features", "weight", "score", "rank")] == ["LongType()"] * 5
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=key) == sorted(brute(docs, target), key=key)


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(["word"] * 30)
    docs = spark.createDataFrame([(1, text)] * 50 + [(2, text + " other")] * 50, "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    ranks = sorted(r.rank for r in resample(docs, none).collect() if r.rank)
    assert ranks == [1, 2, 3, 4, 5]
    assert resample(docs.limit(0), none).count() == 0


def test_ranks_across_parts(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "hash(id) AS rk", "cast(25 AS long) AS n_words", "id % 7 AS score")
    got = {r.doc_id: r.rank for r in importance.draw(rows.selectExpr("doc_id", "cast(rk AS long) rk", "n_words", "score"), 20, 50).collect()}
    want = sorted(range(5000), key=lambda i: (-(i % 7), i))[:2500]
    assert {i: r for i, r in got.items() if r} == {i: n + 1 for n, i in enumerate(want)}
