"""The pipeline on planted cases: nulls, repeated rows, ties, copies, leaks, an empty table and columns with clashing names."""

import random

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(seed, words=60):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def cases(spark):
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=lambda t: len(t.split()))
    clean = {i: prose(i) for i in range(1, 9)}
    near = clean[1].split()
    near[30] = "changed"
    texts = [(i, t) for i, t in clean.items()]
    texts += [(20, None), (21, ""), (22, " \n\t "), (23, "too short to stay"), (24, "again and again " * 40)]
    texts += [(30, clean[2]), (0, clean[3])]                               # copies: of the later and of the earlier id
    texts += [(31, " ".join(near))]                                        # one word apart
    texts += [(32, prose(40, 30) + "\n" + clean[4] + "\n" + prose(41, 30))]  # a repeated line within others
    texts += [(33, prose(42, 30) + "\n" + item + "\n" + prose(43, 30))]    # a benchmark item
    texts += [(34, prose(44)), (34, prose(44)), (35, prose(45)), (35, prose(46)), (None, prose(47)), (36, prose(48, 20_000))]
    return [(i, t, "en", None if i == 5 else "s", len(t) if t is not None else None) for i, t in texts], clean, item


def run(spark, docs):
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
        seen.append(docs)
    return seen


def test_planted_cases(spark, cases):
    rows, clean, item = cases
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    good, cut, single, free, tokens = run(spark, table)
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    every = sorted(str(r[0]) for r in rows)
    # too short, empty, null or repeating itself
    assert ids(good) == [i for i in every if i not in ("20", "21", "22", "23", "24")]
    left = {str(r.doc_id): r.text for r in cut.collect()}
    assert {"30", "31", "3"}.isdisjoint(left) and "0" in left               # the earliest of equal lines, or lines one word apart, stays
    assert clean[4] not in left["32"] and prose(40, 30) in left["32"] and prose(41, 30) in left["32"]
    # rows that repeat id and text are one document; rows that share the id alone are two
    assert ids(single).count("34") == 1 and ids(single).count("35") == 2
    assert "33" in ids(single) and "33" not in ids(free)
    assert ids(tokens) == ids(free) == [i for i in ids(single) if i != "33"]
    assert {"None", "36", "5", "1", "8"} <= set(ids(tokens))
    assert all(r.same_text and r.n_tokens > 0 for r in tokens.collect())
    assert all(df.columns == COLUMNS for df in (good, cut, single, free))


def test_other_columns_change_nothing(spark, cases):
    rows, _, _ = cases
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["rk", "line", "kept", "print", "node", "unit", "ids", "place", "bucket", "n", "packed", "code", "key"]
    wide = plain
    for n, name in enumerate(names):
        wide = wide.selectExpr("*", f"{n} AS `{name}`")
    key = lambda r: (str(r.doc_id), r.n_tokens, tuple(r.ids))
    assert sorted(map(key, run(spark, wide)[-1].collect())) == sorted(map(key, run(spark, plain)[-1].collect()))


def test_an_empty_table(spark, cases):
    rows, _, _ = cases
    none = spark.createDataFrame(rows[:1], "doc_id long, text string, lang string, source string, n_chars long").limit(0)
    assert [df.count() for df in run(spark, none)] == [0] * 5
