import random

import numpy as np
import pytest
import xxhash

from brickfolio.llm.components import components
from brickfolio.llm.simhash import near_duplicates, print_links, sliced_labels


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(prints, radius=3):
    root = dict(zip(prints, prints, strict=True))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def cluster(seed, n=300, seeds=8, flips=6):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(seeds)]
    out = set()
    while len(out) < n:
        p = rng.choice(base)
        for _ in range(rng.randint(0, flips)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_sliced_links_as_pairwise(radius):
    prints = cluster(1)
    label = sliced_labels(np.array(prints, dtype=np.uint64), np.zeros(len(prints), dtype=np.int64), radius, tile=100)
    want = brute_roots(prints, radius)
    assert [prints[k] for k in label] == [want[p] for p in prints]


@pytest.mark.parametrize("chunk", [16_384, 20])
def test_links_connect_as_pairwise(spark, chunk):
    prints = cluster(2)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = print_links(spark.createDataFrame([(p,) for p in signed], "print long"), chunk=chunk)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links).collect()}
    want = brute_roots(prints)
    groups = lambda f: {frozenset(p for p in prints if f[p] == r) for r in set(f.values())}
    assert groups({p: roots.get(p, p) for p in prints}) == groups(want)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(900, 901)], "x long, y long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}


def test_documents(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 200, 1500]))]
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            text[len(text) // 2] = "Changed"
            rows.append((100 + i, "\n".join(text).upper() if i % 2 else "  ".join(text)))
    rows += [(90, None), (91, ""), (92, " \n"), (93, rows[0][1]), (93, rows[0][1]), (None, rows[0][1]), (None, "only here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, print string")
    prints = {r: brute_print(r[1]) for r in rows}
    roots = brute_roots(sorted(set(prints.values())))
    least = {}
    for r, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], 1 << 62), r[0] if r[0] is not None else 1 << 62)
    want = sorted((str(r[0]), f"{prints[r]:016x}", least[roots[prints[r]]]) for r in rows)
    got = near_duplicates(docs).collect()
    assert sorted((str(g.doc_id), g.fingerprint, g.component_id if g.component_id is not None else 1 << 62) for g in got) == want
    assert near_duplicates(docs.limit(0)).count() == 0


def test_a_radius_beyond_the_counters_is_refused(spark):
    prints = spark.createDataFrame([(0,), ((1 << 8) - 1,)], "print long")
    with pytest.raises(ValueError, match="radius"):
        print_links(prints, radius=8, blocks=12)
    assert print_links(prints.selectExpr("print & 127 AS print").distinct(), radius=7, blocks=12).count() == 1
