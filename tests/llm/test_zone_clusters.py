import hashlib
import math

import numpy as np
import pytest

from brickfolio.llm.zone_clusters import CLUSTER_SQL, candidates, cluster, hilbert_keys, nearest, whole_vectors, zone_blocks


def brute(rows, k=40, rounds=5, size=64):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x):
            kept.append((i, [max(-(1 << 27), min(1 << 27, math.floor(256 * float(v)))) for v in x]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in order[:k]]

    def assign():
        c = np.array(centroids, dtype=object)
        return [min((sum((a - b) ** 2 for a, b in zip(x, row, strict=True)), n) for n, row in enumerate(c)) for _, x in kept]
    for _ in range(rounds):
        of = assign()
        for n in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, of, strict=True) if c == n]
            if own:
                centroids[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    of = assign()
    codes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(d for d, _ in of)
    return sorted((str(i), c, d, sum(e for e, o in of if o == c), total, codes[c]) for (i, _), (d, c) in zip(kept, of, strict=True))


@pytest.mark.parametrize(("dims", "bits"), [(2, 1), (2, 3), (3, 2), (5, 2)])
def test_neighbours_on_the_curve_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [bytes(r) for r in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk.astype(int), axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("reach", [50, 1 << 27])
def test_no_nearest_centroid_is_pruned(reach):
    rng = np.random.default_rng(1)
    pruned = 0
    for trial in range(200):
        centroids = rng.integers(-reach, reach + 1, (12, 6))
        centroids[5] = centroids[2]
        low = rng.integers(-reach, reach + 1, 6)
        high = np.minimum(low + rng.integers(0, 2 + reach // (1 + trial % 9), 6), reach)
        x = rng.integers(low, high + 1, (30, 6)).astype(np.int32)
        square = (centroids ** 2).sum(axis=1)
        some = candidates(low, high, centroids, square)
        pruned += 12 - len(some)
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in x]
        of, distance = nearest(x, low, high, centroids, square)
        assert of.tolist() == [r.index(min(r)) for r in exact]
        assert distance.tolist() == [min(r) for r in exact]
    assert pruned > 200


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, "c") for i, x in rows], "vec_id long, embedding array<float>, cluster int, place string")


def test_vectors_as_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (6, 64))
    rows = [(i, [float(v) for v in (centres[i % 6] + rng.normal(0, .1, 64)).astype(np.float32)]) for i in range(160)]
    rows += [(500 + i, rows[0][1]) for i in range(60)] + [rows[3], rows[3], (None, rows[4][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [1.0] * 63 + [math.nan]), (905, [1.0] * 63 + [math.inf])]
    got = cluster(table(spark, rows), block=16)
    assert [str(f.dataType) for f in got.schema] == ["LongType()", "IntegerType()", "LongType()", "LongType()", "LongType()", "StringType()"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute(rows)


def test_far_components_and_few_vectors(spark):
    rows = [(i, [float(i % 3)] * 63 + [v]) for i, v in enumerate([0.0, 1e30, -1e30, 3e5, -3e5, 3e5])]
    assert sorted((str(r[0]), *r[1:]) for r in cluster(table(spark, rows)).collect()) == brute(rows)
    assert cluster(table(spark, rows).limit(0)).count() == 0
    assert cluster(table(spark, [(1, None)])).count() == 0


def test_blocks_hold_all_vectors_and_prune(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 2, (8, 64))
    rows = [(i, [float(v) for v in centres[i % 8] + rng.normal(0, .02, 64)]) for i in range(800)]
    blocks = zone_blocks(whole_vectors(table(spark, rows)), block=20).collect()
    assert sorted(i for b in blocks for i in b.ids) == list(range(800))
    centroids = np.floor(256 * centres).astype(np.int64)
    square = (centroids ** 2).sum(axis=1)
    left = [len(candidates(*(np.frombuffer(v, dtype=np.int32).astype(np.int64) for v in (b.low, b.high)), centroids, square)) for b in blocks]
    assert sum(left) < 2 * len(left)


def test_statement_as_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(CLUSTER_SQL).fetchall()
    got = cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
