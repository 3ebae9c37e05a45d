import os
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from brickfolio.llm.lattice import LONG, MARK, MODEL, Vocabulary, decode, encode, fold_units, frequent, merge_long, report

ROWS = [
    (1, "The quick brown fox, jumps over: the  lazy dog.\nSecond   line\ttab"), (2, None), (3, ""), (4, " "), (5, "   lead and trail   "),
    (6, "naïve Übergröße ção 東京都 \U0001F600\U0001F600 ½"), (7, "x" * 200 + "and" * 90), (8, "\n\n\n"), (9, "<s> </s> <unk> <0x0A>"), (10, "a"),
    (10, "a"), (11, "a▁b"), (None, "the and the"), (12, "aaaa " * 300 + "https://example.com/q?x=1&y=%20" * 3)]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("head", [1 << 20, 5, 0])
def test_same_ids_as_the_library(spark, model, head):
    rng = random.Random(1)
    words = "the and of tionhe erand ßver éaux anthat x1 (a) {b}; don't 3.14".split()
    rows = ROWS + [(100 + k, "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "", "  "]) for _ in range(40))) for k in range(40)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    got = sorted((str(r.doc_id), r.text or "", list(r.ids)) for r in encode(docs, head=head).collect())
    assert got == sorted((str(i), t or "", model.encode(t or "")) for i, t in rows)


def test_decoding_gives_the_text_back(spark, model):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert all(r.same_text for r in report(docs).collect())
    tokens = spark.createDataFrame([(1, [3 + 0xE2, 3 + 0x82, 3 + 0xAC, 10]), (2, None), (3, [])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in decode(tokens).collect()}
    assert got == {1: model.decode([3 + 0xE2, 3 + 0x82, 3 + 0xAC, 10]), 2: "", 3: ""}
    assert report(docs.limit(0)).count() == 0


def test_one_worker_encodes_and_decodes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = report(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # texts are packed before the shuffle and read behind it


def test_viterbi_as_brute_force(spark):
    rng = random.Random(3)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(30)} - {"c"} | {"a", "b"})
    vocabulary = Vocabulary([""] + pieces, [0.0] + [-rng.random() * 5 for _ in pieces], list(range(1000, 1256)))
    units = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 10))) for _ in range(80)] + ["ca"]
    score = dict(zip(vocabulary.pieces, vocabulary.scores, strict=True))

    def best(unit):
        if not unit:
            return 0.0, []
        ways = []
        for k in range(1, len(unit) + 1):
            if unit[:k] in score:
                s, rest = best(unit[k:])
                ways.append((score[unit[:k]] + s, [vocabulary.pieces.index(unit[:k]), *rest]))
        s, rest = best(unit[1:])
        ways.append((s - 1e4, [1000 + ord(unit[0]), *rest]))
        return max(ways)
    frame = spark.createDataFrame([(u,) for u in sorted(set(units))], "unit string")
    got = {r.unit: list(r.ids) for r in fold_units(frame, vocabulary.table(spark), vocabulary, "viterbi").collect()}
    worth = lambda ids: sum(vocabulary.scores[i] if i < 1000 else -1e4 for i in ids)
    spelt = lambda ids: "".join(vocabulary.pieces[i] if i < 1000 else chr(i - 1000) for i in ids)
    assert set(got) == {u for u in units if any(p in u for p in pieces)}
    for u, ids in got.items():
        assert spelt(ids) == u and abs(worth(ids) - best(u)[0]) < 1e-6


def test_long_units_by_the_same_rule(model):
    vocabulary = Vocabulary.load()
    order = {s: k for k, s in enumerate(sorted(set(vocabulary.scores), reverse=True))}
    rank = {p: order[s] for p, s in zip(vocabulary.pieces, vocabulary.scores, strict=True) if p}
    rng = random.Random(2)
    for n in (1, 2, 30, LONG + 1, 500):
        text = "".join(rng.choice("thernda") for _ in range(n))
        assert merge_long(MARK + text, rank) == model.encode(text, out_type=str)


def test_frequent_units_are_bounded(spark):
    counts = spark.range(1, 200).select(F.col("id").cast("string").alias("unit"), F.col("id").alias("n"))
    assert 50 < frequent(counts, 100).count() <= 100
    assert frequent(counts, 0).count() == 0


def test_one_pass_merges_as_a_search_does(spark):
    import random

    from pyspark.sql import functions as F

    from brickfolio.llm import lattice

    vocabulary = lattice.Vocabulary.load()
    assert [vocabulary.pieces[i] for i in vocabulary.late_ids()] == ["▁" * 16]
    rng = random.Random(6)
    pieces = [p for p in vocabulary.pieces if 1 < len(p) < 10]
    units = {"▁" + "".join(rng.choice(pieces) for _ in range(rng.choice([1, 2, 3, 5])))[:60] for _ in range(3000)} | {"▁" * n for n in (1, 2, 15, 16, 17, 31, 33)}
    units |= {"".join(rng.choice("aeinst") for _ in range(rng.randrange(2, 40))) for _ in range(1500)}
    table = spark.createDataFrame([(u,) for u in sorted(units)], "unit string")
    edges = lattice._edges(table, vocabulary.table(spark), max(map(len, vocabulary.pieces)), ["unit"])
    packed = F.shiftleft(F.col("rank").cast("long"), 36) + F.shiftleft(F.col("start").cast("long"), 30) + F.shiftleft(F.col("end").cast("long"), 24) + F.col("id")
    found = edges.groupBy("unit").agg(F.transform(F.array_sort(F.collect_list(packed)), lattice._unpacked).alias("edges"))
    late = found.select("unit", lattice._merged_by_search(F.col("unit"), F.col("edges")).alias("a"), lattice._merged_in_order(F.col("unit"), F.col("edges")).alias("b"))
    assert late.where("a <> b and not contains(unit, repeat('▁', 16))").count() == 0
    folded = {r.unit: r.ids for r in lattice.fold_units(table, vocabulary.table(spark), vocabulary).collect()}
    scores = dict(zip(vocabulary.pieces, vocabulary.scores, strict=True))
    order = {s: k for k, s in enumerate(sorted(set(vocabulary.scores), reverse=True))}
    rank, ids = {p: order[s] for p, s in scores.items() if p}, {p: i for i, p in enumerate(vocabulary.pieces) if p}
    for unit in units:
        want = [i for p in lattice.merge_long(unit, rank) for i in ([ids[p]] if p in ids else [vocabulary.byte_ids[b] for b in p.encode()])]
        assert folded[unit] == want, unit
