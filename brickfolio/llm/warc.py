"""WARC archives written and read back by Spark, and a global capture index merged from sorted runs.

Writing. A page's payload digest is its SHA-1 in base 32. Of pages with equal payloads the one of least id is a response record, the others
are revisit records: their block is the HTTP head alone, which keeps the payload's length, and WARC-Refers-To names the response. Least ids are
found per (digest, salt) first; only repeated digests are joined back, by the salts in which they occur, so no digest is one key. Spark's text
writer makes the files in any store it can write to: a record is a row, the two line ends after it are the line separator, and each file is
compressed whole.

Reading. A task streams the records of an archive by their Content-Length, so any payload is safe, and hashes each response's payload again.

Index. 1. The entries of an archive are sorted by URL key, timestamp and id: a run, kept in chunks. 2. Chunks are cut at boundaries taken from
at most ``sample`` keys evenly spaced in the chunks, and each range goes to a task, its chunks in order of their first keys. 3. The task merges k runs in a loser
tree. A chunk enters when the tree's winner reaches its first key, so at most one chunk a run is open, whatever the range holds. 4. A range's place
in the whole is the sum of the sizes before it. Boundaries hold the whole key, so a URL with many captures is cut as well; the sample only evens
the ranges out.

Defined cases: a null html is an empty payload; a null id is later than all others, so it is a response only if all ids of its payload are null (then
all these rows are), and refers_to is null for responses; rows that repeat an id and payload are the same record type; a null url has no target and an empty URL key; line
ends, tabs and spaces in a URL are percent-escaped; a null timestamp counts as 1970; an empty table gives an empty index; other columns are not read. A file that is no
WARC fails with its name and place.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import tidy
from brickfolio.llm.tables import LAST_ID, bounded, id_or_last, stored
from brickfolio.session import scratch_path

ENDS = "\r\n\r\n"
ENTRY = ("url_key string, captured string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
         "digest_ok boolean, target string, archive string, offset long, length long")
FIELDS = [part.split()[0] for part in ENTRY.split(", ")]
_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
ENTRY_TYPE = pa.struct([(part.split()[0], _ARROW[part.split()[1]]) for part in ENTRY.split(", ")])
_KEY = [FIELDS.index(name) for name in ("url_key", "captured", "page_id", "archive", "offset")]


# --- writing ---------------------------------------------------------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """32 letters: four pieces of 40 bits, each written in base 32 and respelt."""
    code = F.sha1(payload)
    pieces = [F.lpad(F.conv(F.substring(code, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*pieces), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _first_of_payload(rows: DataFrame, salts: int, least_bytes: int) -> tuple[DataFrame, int]:
    """digest, salt, first (the least id) of every repeated payload, for the salts that it occurs in; and the mean bytes of a page."""
    marks = stored(rows.groupBy("digest", "salt").agg(
        F.min(id_or_last("page_id")).alias("first"), F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "digests")
    size = marks.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    large = marks.where(F.col("bytes") >= least_bytes * F.col("n")) if least_bytes else marks
    repeated = large.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).where("n > 1")
    return repeated.select("digest", "first", F.explode("salts").alias("salt")), int((size.bytes or 0) // (size.n or 1))


def _record(kind: Column, first: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    name = lambda i: F.concat(F.lit("<urn:capture:"), F.coalesce(i.cast("string"), F.lit("none")), F.lit(">"))
    target = F.col("url")
    for char, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        target = F.replace(target, F.lit(char), F.lit(code))
    revisit = kind == "revisit"
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(ENDS))
    size = F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.date_format(F.coalesce("captured", F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name(first)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")),
        F.lit("\r\n"), head, F.when(revisit, "").otherwise(F.col("html")))


def write_archives(pages: DataFrame, folder: str, captured: Column, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0, archive_bytes: int = 32 << 20, salts: int = 64) -> None:
    """Archives of some ``archive_bytes`` before compression in ``folder``. Payloads of under ``least_bytes`` are never revisits."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), captured.cast("timestamp").alias("captured"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = (rows.withColumn("digest", base32_sha1(F.col("html"))).withColumn("bytes", F.octet_length("html").cast("long"))
            .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts))))
    repeated, mean = _first_of_payload(rows, salts, least_bytes)
    first, own = F.col("first"), id_or_last("page_id")
    kind = F.when(first.isNotNull() & (first != own), "revisit").otherwise("response")
    records = rows.join(repeated, ["digest", "salt"], "left").select(_record(kind, first).alias("value"))
    (records.write.option("lineSep", ENDS).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, archive_bytes // (mean + 600))).text(folder))


# --- reading ---------------------------------------------------------------------------------------------------------------------------


def url_key(url: str) -> str:
    """Host names in reverse order, then path and query: captures of one site stand together."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url, re.DOTALL)
    if not found:
        return url
    host = found[1].rpartition("@")[2].encode().lower().decode()
    return ",".join(reversed(host.split("."))) + ")" + (found[2] or "/")


def _head(file) -> dict[bytes, bytes]:
    out = {}
    while (line := file.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.partition(b":")
        out[name.strip().lower()] = value.strip()
    return out


def records(file) -> Iterator[tuple[int, int, dict[bytes, bytes], bytes]]:
    """Offset, length, headers and block of each record of an open, decompressed archive."""
    while True:
        begin, line = file.tell(), file.readline()
        if not line:
            return
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {begin}")
        head = _head(file)
        size = int(head[b"content-length"])
        block = file.read(size)
        if len(block) < size or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {begin} is cut off")
        yield begin, file.tell() - begin, head, block


def _named(urn: bytes | None) -> int | None:
    body = (urn or b"").rpartition(b":")[2].rstrip(b">")
    return int(body) if body.lstrip(b"-").isdigit() else None


def _entry(head: dict[bytes, bytes], block: bytes, archive: str, offset: int, length: int) -> tuple[tuple, bytes]:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = head[b"warc-type"].decode(), head.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
    target = head.get(b"warc-target-uri", b"").decode()
    if kind == "revisit":
        lengths = re.findall(rb"(?im)^content-length:\s*(\d+)", http)
        size, ok = int(lengths[0]) if lengths else 0, True
    else:
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        digest, ok = found, digest in ("", found)
    return (url_key(target), head[b"warc-date"].decode(), _named(head.get(b"warc-record-id")), kind, size, digest,
            _named(head.get(b"warc-refers-to")), ok, target, archive, offset, length), payload


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator]]:
    for batch in batches:
        for k in range(batch.num_rows):
            path = batch.column("path")[k].as_py()
            name, raw = path.rpartition("/")[2], pa.BufferReader(batch.column("content")[k].as_buffer())
            yield name, records(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw)


def _checked(name: str, found: Iterator) -> Iterator[tuple[tuple, bytes]]:
    try:
        for offset, length, head, block in found:
            yield _entry(head, block, name, offset, length)
    except (ValueError, KeyError, EOFError, OSError) as error:
        raise ValueError(f"{name} is not a WARC archive: {error}") from error


def _columns(entries: list[tuple]) -> list[pa.Array]:
    return [pa.array(column, field.type) for column, field in zip(zip(*entries, strict=True), ENTRY_TYPE, strict=True)]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return bounded(spark.read.format("binaryFile").load(folder)).select("path", "content")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in a folder: the fields of the index and its payload, in no order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.record_batch([*_columns([e for e, _ in rows]), pa.array([p for _, p in rows], pa.binary())], [*FIELDS, "payload"])
        for name, found in _archives(batches):
            rows, size = [], 0
            for row in _checked(name, found):
                rows.append(row)
                size += len(row[1]) + 500
                if size > 4 << 20:
                    yield out()
                    rows, size = [], 0
            if rows:
                yield out()
    return _files(spark, folder).mapInArrow(tidy(run), f"{ENTRY}, payload binary")


# --- the index -------------------------------------------------------------------------------------------------------------------------


def sort_key(entry: tuple) -> tuple:
    url, at, i, archive, offset = (entry[k] for k in _KEY)
    return 0, url, at, LAST_ID if i is None else i, archive, offset


END = (1,)       # after every key


class LoserTree:
    """The least of k keys. Each inner node holds the loser of its match, so a new key is played against its path only."""

    def __init__(self, keys: list[tuple]):
        n = len(keys)
        self.keys, self.lost = keys, [0] * n
        won = [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.lost[node] = (b, a) if keys[b] < keys[a] else (a, b)
        self.winner = won[1] if n > 1 else 0

    @property
    def least(self) -> tuple:
        return self.keys[self.winner]

    def replace(self, key: tuple) -> None:
        """The winner's next key."""
        keys, lost, best = self.keys, self.lost, self.winner
        keys[best] = key
        node = (best + len(keys)) >> 1
        while node:
            if keys[lost[node]] < keys[best]:
                best, lost[node] = lost[node], best
            node >>= 1
        self.winner = best


def merge_runs(chunks: Iterator[tuple[str, list[tuple]]]) -> Iterator[tuple]:
    """chunks: run and sorted entries, by first key; a run's chunks follow each other. All entries in order."""
    names: list[str] = []                       # of the runs in the tree
    waiting: dict[str, deque] = {}              # chunks of a run; the first is open
    opened: list[Iterator] = []
    heads: list[tuple] = []
    tree = LoserTree([END])
    new: list[str] = []                         # runs to enter

    def pop(limit: tuple) -> Iterator[tuple]:
        while tree.least < limit:
            k = tree.winner
            yield heads[k]
            entry = next(opened[k], None)
            if entry is None and waiting[names[k]]:
                opened[k] = iter(waiting[names[k]].popleft())
                entry = next(opened[k])
            if entry is None:
                del waiting[names[k]]
                tree.replace(END)
            else:
                heads[k] = entry
                tree.replace(sort_key(entry))

    def enter() -> None:
        nonlocal names, opened, heads, tree
        live = [k for k, name in enumerate(names) if tree.keys[k] != END]
        names, opened, heads = ([x[k] for k in live] for x in (names, opened, heads))
        for name in new:
            names.append(name)
            opened.append(iter(waiting[name].popleft()))
            heads.append(next(opened[-1]))
        new.clear()
        tree = LoserTree([sort_key(e) for e in heads] or [END])

    for run, entries in chunks:
        if len(new) > 16 + len(names):           # a tree is built anew only as it doubles
            enter()
        yield from pop(sort_key(waiting[new[0]][0][0] if new else entries[0]))
        if run not in waiting:
            waiting[run] = deque()
            new.append(run)
        waiting[run].append(entries)
    enter()
    yield from pop(END)


def _chunk_row(key_of: tuple, extra: list, entries: list[tuple]) -> tuple:
    return (*extra, key_of[1], key_of[2], key_of[3], entries)


def _chunks_out(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    flat = [dict(zip(FIELDS, e, strict=True)) for row in rows for e in row[-1]]
    ends = [0]
    for row in rows:
        ends.append(ends[-1] + len(row[-1]))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, ENTRY_TYPE))
    columns = [pa.array([row[k] for row in rows]) for k in range(len(names) - 1)]
    return pa.record_batch([*columns, lists], names)


_RUN = ["run", "no", "k_url", "k_at", "k_id", "entries"]
_RUN_SCHEMA = f"run string, no long, k_url string, k_at string, k_id long, entries array<struct<{ENTRY.replace(' ', ':').replace(',:', ', ')}>>"


def _runs(chunk: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, found in _archives(batches):
            entries = sorted((e for e, _ in _checked(name, found)), key=sort_key)
            for low in range(0, len(entries), chunk):
                part = entries[low:low + chunk]
                yield _chunks_out([_chunk_row(sort_key(part[0]), [name, low // chunk], part)], _RUN)
    return run


def capture_runs(spark: SparkSession, folder: str, chunk: int = 200) -> DataFrame:
    """A sorted run for each archive of a folder, in chunks; stored."""
    return stored(_files(spark, folder).mapInArrow(tidy(_runs(chunk)), _RUN_SCHEMA), "runs")


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple]]]:
    column = batch.column("entries")
    for k in range(batch.num_rows):
        yield k, list(zip(*(f.to_pylist() for f in column[k].values.flatten()), strict=True))


def _cut(bounds: list[tuple]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = batch.column("run").to_pylist(), []
            for k, entries in _entries(batch):
                for place, part in groupby(entries, key=lambda e: bisect_right(bounds, sort_key(e))):
                    some = list(part)
                    rows.append(_chunk_row(sort_key(some[0]), [place, names[k]], some))
            if rows:
                out = _chunks_out(rows, ["range", *_RUN[:1], *_RUN[2:]])
                yield out.set_column(0, "range", out.column(0).cast(pa.int32()))
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[int, str, list[tuple]]]:
        for batch in batches:
            ranges, names = batch.column("range").to_pylist(), batch.column("run").to_pylist()
            for k, entries in _entries(batch):
                yield ranges[k], names[k], entries

    def out() -> pa.RecordBatch:
        n = len(held)
        return pa.record_batch([pa.array([place] * n, pa.int32()), pa.array(range(before, before + n), pa.int64()), *_columns(held)], ["range", "place", *FIELDS])
    for place, chunks in groupby(rows(), key=itemgetter(0)):
        held, before = [], 0
        for entry in merge_runs((name, entries) for _, name, entries in chunks):
            held.append(entry)
            if len(held) == 5000:
                yield out()
                before += len(held)
                held = []
        if held:
            yield out()


def merged_index(runs: DataFrame, sample: int = 10_000) -> DataFrame:
    """All entries of sorted runs with position (1, 2, ...) in order of URL key, timestamp and id."""
    spark = runs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # evenly spaced keys of every chunk, so that runs of less than a chunk tell more than where they begin
    spaced = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.get("entries", F.floor((k + 0.5) * F.size("entries") / 8).cast("int")))
    keys = runs.select("run", F.explode(F.array_distinct(spaced)).alias("e")).select(
        "e.url_key", "e.captured", F.coalesce("e.page_id", F.lit(LAST_ID)).alias("id"), "run", "e.offset")
    picked = sorted((0, *row) for row in keys.orderBy(F.xxhash64("run", "offset"), "run", "offset").limit(sample).collect())
    bounds = [picked[k * len(picked) // parts] for k in range(1, parts)] if picked else []
    dealt = (bounded(runs).mapInArrow(tidy(_cut(bounds)), "range int, " + _RUN_SCHEMA.replace("no long, ", ""))
             .repartitionById(parts, F.col("range")).sortWithinPartitions("range", "k_url", "k_at", "k_id", "run", F.col("entries")[0]["offset"]))
    merged = stored(dealt.mapInArrow(tidy(_merge), f"range int, place long, {ENTRY}"), "merged")
    before, offsets = 0, []
    for row in sorted(merged.groupBy("range").count().collect()):      # a row per range
        offsets.append((row["range"], before))
        before += row["count"]
    return (merged.join(F.broadcast(spark.createDataFrame(offsets, "range int, before long")), "range")
            .select(*FIELDS, (F.col("before") + F.col("place") + 1).alias("position")))


def report(pages: DataFrame, captured: Column, **options) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back and returns their global index."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "archives")
    write_archives(pages, folder, captured, **options)
    return merged_index(capture_runs(spark, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position")


REPORT_SQL = r"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS code FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY code) AS first, CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN
  array_to_string(list_reverse(string_split(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')), '.')), ',')
  || ')' || coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), ''), '/') ELSE coalesce(url, '') END AS url_key FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(code, CAST(1 + 10 * (k // 8) AS INTEGER), 10) AS BIGINT) >> CAST(5 * (7 - k % 8) AS INTEGER)) & 31 AS INTEGER) + 1, 1)
    FOR k IN generate_series(0, 31)], '') AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to,
  url_key, row_number() OVER (ORDER BY url_key, page_id) AS position
FROM q"""
