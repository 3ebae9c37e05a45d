import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from brickfolio.llm import warc
from brickfolio.llm.warc import END, REPORT_SQL, LoserTree, capture_runs, merge_runs, merged_index, read_archives, report, sort_key, url_key, write_archives



def at():
    return F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + 1_700_000_000)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows):
    first = {}
    for i, _, html in rows:
        key = html or ""
        first[key] = min(first.get(key, 1 << 63), 1 << 63 if i is None else i)
    out = []
    for i, _, html in rows:
        least = first[html or ""]
        again = least < (1 << 63 if i is None else i)
        out.append((i, len((html or "").encode()), digest(html), "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record_type string, offset int")


def sample(n=300, seed=1):
    rng = random.Random(seed)
    bodies = ["<p>é 中文</p>" * k for k in range(20)] + ["a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "\r\n\r\n", "", "x" * 300_000]
    hosts = ["http://a.example.com", "https://B.example.com:8080", "ftp://user@c.example.org"]
    rows = [(i, rng.choice(hosts) + rng.choice(["", "/", "/p?q=1#top", "/é", f"/{i}"]), rng.choice(bodies)) for i in rng.sample(range(10 * n), n)]
    rows += [(90_000, None, None), (90_001, "no url", "x"), (90_002, "http://h/a b\r\nWARC-Type: revisit\t", "only"), (None, "http://h/", "only"),
             (None, "http://h/", "of no id"), (-5, "http://h/", "of no id"), (90_003, "", "twice"), (90_003, "", "twice")]
    return rows


def test_least_of_k_by_matches():
    rng = random.Random(2)
    for k in (1, 2, 3, 5, 8, 13):
        runs = [sorted((0, rng.randrange(50)) for _ in range(rng.randrange(9))) for _ in range(k)]
        ways = [iter(r) for r in runs]
        tree, got = LoserTree([next(w, END) for w in ways]), []
        while tree.least != END:
            got.append(tree.least)
            tree.replace(next(ways[tree.winner], END))
        assert got == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("runs", [1, 3, 100])
def test_runs_merge_in_order_with_few_open_chunks(runs):
    rng, chunks, want = random.Random(runs), [], []
    for n in range(runs):
        entries = sorted(((rng.choice("abc"), "t", rng.randrange(9), "response", 0, "", None, True, "", f"r{n}", o, 1) for o in range(rng.randrange(1, 60))), key=sort_key)
        want += entries
        chunks += [(f"r{n}", entries[low:low + 5]) for low in range(0, len(entries), 5)]
    chunks.sort(key=lambda c: sort_key(c[1][0]))
    assert list(merge_runs(iter(chunks))) == sorted(want, key=sort_key)


def test_url_keys():
    assert [url_key(u) for u in ("http://WWW.Example.com/A?b#c", "https://h:80", "ftp://u:p@x.y/", "//x", "")] == [
        "com,example,www)/A?b", "h:80)/", "y,x)/", "//x", ""]


def test_pages_there_and_back(spark):
    rows = sample()
    got = report(pages(spark, rows), at())
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows)
    assert [str(f.dataType) for f in got.schema][:5] == ["LongType()", "LongType()", "StringType()", "StringType()", "LongType()"]
    assert report(pages(spark, rows).limit(0), at()).count() == 0


def test_archives_and_global_order(spark, tmp_path):
    rows = sample(500, 3)
    folder = str(tmp_path / "archives")
    write_archives(pages(spark, rows), folder, at(), archive_bytes=100_000)
    records = read_archives(spark, folder).collect()
    assert all(r.digest_ok for r in records) and len({r.archive for r in records}) > 5
    bodies = {(r.page_id, r.payload_digest): r.payload.decode() for r in records if r.record_type == "response"}
    want = {(i, digest(html)): html or "" for i, _, html in rows}
    assert all(want[k] == v for k, v in bodies.items()) and {d for _, d in bodies} == {d for _, d in want}
    assert all(r.payload == b"" for r in records if r.record_type == "revisit")
    runs = capture_runs(spark, folder, chunk=7)
    for kept in (10_000, 3):
        index = sorted(merged_index(runs, sample=kept).collect(), key=lambda r: r.position)
        assert [r.position for r in index] == list(range(1, len(rows) + 1))
        keys = [sort_key(tuple(r)[:len(warc.FIELDS)]) for r in index]
        assert keys == sorted(keys)


def test_least_bytes(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (5, "u", None), (6, "u", "")]
    kinds = {r.page_id: r.record_type for r in report(pages(spark, rows), at(), least_bytes=3).collect()}
    assert [i for i, k in kinds.items() if k == "revisit"] == [4]


def test_broken_archives_are_named():
    good = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: d\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [r[3] for r in warc.records(io.BytesIO(good * 2))] == [b"ab"] * 2
    for bad in (b"junk\n", good[:-3], good.replace(b": 2", b": 9")):
        with pytest.raises(ValueError, match="a.warc"):
            list(warc._checked("a.warc", warc.records(io.BytesIO(bad))))


def test_statement_as_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    found = con.execute(REPORT_SQL)
    names = [d[0] for d in found.description]
    got = report(spark.read.parquet(f"{folder}/pages.parquet"), at()).select(*names)
    assert sorted(tuple(r) for r in got.collect()) == sorted(found.fetchall())
