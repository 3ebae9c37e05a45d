import hashlib
import random

import pytest

from brickfolio.llm.line_dedup import at_most_one_edit, keep_first_lines, line_report


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, min_words):
    seen, out = [], {}
    for i, text in sorted({r for r in rows if r[0] is not None}):
        lines = [] if text is None else text.split("\n")
        kept, own = [], []
        for line in lines:
            words = line.encode().split()
            late = len(words) >= min_words and any(abs(len(words) - len(x)) < 2 and distance(words, x) < 2 for x in seen + own)
            if len(words) >= min_words:
                own.append(words)
            if not late:
                kept.append(line)
        seen += own
        digest = None if text is None else hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[i] = (i, len(lines), len(lines) - len(kept), digest)
    return sorted(out[i] for i, _ in rows if i is not None)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "ça", "d"])
    base = [[word() for _ in range(rng.randint(2, 14))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base)) if rng.random() < 0.7 else [word() for _ in range(rng.randint(0, 12))]
            for _ in range(rng.choice([0, 0, 1, 2])):
                k = rng.randint(0, len(line))
                line[k:k + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            lines.append(rng.choice(["", " "]) + rng.choice([" ", "  ", "\t"]).join(line))
        rows.append((i * 7 % 60, "\n".join(lines)))
    return rows + [(60, None), (61, ""), (62, rows[3][1]), (62, rows[3][1]), (63, "\n\n")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rk string").repartition(3)
    assert sorted(map(tuple, line_report(docs, min_words=5).collect())) == brute(rows, 5)


def test_one_edit():
    rng = random.Random(4)
    for _ in range(3000):
        a, b = ([rng.choice("ab") for _ in range(rng.randint(0, 6))] for _ in range(2))
        assert at_most_one_edit(a, b) == (distance(a, b) < 2)


def test_documents_come_back(spark):
    line = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([
        (1, line + "\nown", "en", "s", 50, "c"), (2, line, "en", None, 47, "c"), (3, line.replace("five", "5") + "\nrest", None, "s", 52, "c"),
        (None, "short", "en", "s", 5, "c"), (None, None, None, None, None, "c")], "doc_id long, text string, lang string, source string, n_chars long, gone string")
    got = {r.doc_id: r for r in keep_first_lines(docs).collect() if r.text is not None}
    assert {k: (r.text, r.n_chars) for k, r in got.items()} == {1: (line + "\nown", 50), 3: ("rest", 4), None: ("short", 5)}
    assert keep_first_lines(docs).count() == 4
    assert keep_first_lines(docs.limit(0)).columns == docs.columns[:5]
    assert keep_first_lines(docs.limit(0)).count() == 0


def test_short_lines_go_as_equal_ones(spark):
    long = "one two three four five six seven eight"
    rows = [(1, f"Read more\n\n{long}\nRead  more "), (2, f"Read less\nRead more\n{long} nine\nown"), (3, "own\n \none two three four five six 7"), (4, "one two three four five six seven")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = {1: f"Read more\n\n{long}", 2: "Read less\nown", 3: " \none two three four five six 7", 4: rows[3][1]}
    got = {r.doc_id: r.kept_sha256 for r in line_report(docs).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}
