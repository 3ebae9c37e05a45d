import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs.collect(), docs.columns))
        kept = stage(spark, docs, SF)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    return [*out, (docs.collect(), docs.columns)]


def test_stages_keep_the_columns_and_only_shrink(stages):
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, columns in stages[:-1])
    ids = [[r.doc_id for r in rows] for rows, _ in stages]
    for before, after in zip(ids, ids[1:], strict=False):
        assert len(set(after)) == len(after) and set(after) <= set(before)
    assert len(ids[-1]) > 0.5 * len(ids[0])


def test_decisions_take_effect(stages):
    (raw, _), (good, _), (cut, _), (single, _), (clean, _), (tokens, _) = stages
    assert len(good) < len(raw) and sum(len(r.text) for r in cut) < sum(len(r.text) for r in good)
    lines = [line for r in cut for line in r.text.split("\n") if len(line.split()) >= 8]
    assert len(lines) == len(set(lines))
    assert len(single) <= len(cut) and len(clean) <= len(single)
    assert all(r.same_text and r.n_tokens == len(r.ids) > 0 for r in tokens)


def test_run_is_the_stages_in_order(spark, stages):
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()) == sorted((r.doc_id, r.n_tokens) for r in stages[-1][0])
