"""Importance resampling towards a target distribution over hashed word runs, by an automaton whose words carry CRC payloads.

1. The most frequent distinct words, ``dictionary`` of them at most, become an Aho-Corasick automaton. A key is a word between two
   delimiters, its payload the word's CRC-32 and length, packed in one integer. One scan of a text emits a payload per word.
   Words outside the dictionary, which is bounded, get their payload from their bytes, so every word has one.
2. The CRC of a run of words is composed from adjacent payloads: CRC(ab) is CRC(a) advanced by len(b) zero bytes, xor CRC(b). The
   advance is linear and read from tables by length. A run's bucket is its CRC modulo ``buckets``; no run is ever spelt out.
3. Buckets are counted over all documents and all target texts; a bucket's gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))).
4. A second scan sums a document's gains. With Gumbel noise from a hash of its id, the highest scores are a draw without replacement.
5. Ranks come from a range-partitioned sort: place within the part plus the sizes of the parts before, so no task sees all rows.

Only the dictionary, ``buckets`` counts and one size per part reach the driver. Texts are scanned in pieces of about a megabyte, cut
between words, so memory does not follow the longest text.

Defined cases: a null or empty text has no words, weight 0 and no rank; an empty target or table gives gains from zero counts; a null id is hashed
as an empty string and sorted last; rows that repeat an id and text get successive ranks, rows that repeat an id alone are ordered by
their key; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import tidy
from brickfolio.llm.lattice import frequent
from brickfolio.llm.tables import bounded, id_or_last, row_key, stored

LONGEST = 32            # bytes of a dictionary word
PIECE = 1 << 20
_SPACE = b" "
# letters of A-Z in lower case, digits and all bytes above 0x7F stay; anything else delimits
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


# --- composition of CRC payloads -----------------------------------------------------------------------------------------------------


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as its values at each byte in each of four places."""
    return (table[0][crc & np.uint32(255)] ^ table[1][(crc >> np.uint32(8)) & np.uint32(255)]
            ^ table[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ table[3][crc >> np.uint32(24)])


class Advance:
    """CRC registers moved on by zero bytes: one table per short length, tables of doubled lengths for the others."""

    def __init__(self, short: int = 64):
        byte = np.arange(256, dtype=np.uint32)
        one = byte.copy()
        for _ in range(8):
            one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(0xEDB88320), one >> np.uint32(1))
        none = np.stack([byte << np.uint32(8 * k) for k in range(4)])
        tables = [none]
        for _ in range(short):
            last = tables[-1]
            tables.append(one[last & np.uint32(255)] ^ (last >> np.uint32(8)))
        self.short = short
        self.flat = np.ascontiguousarray(np.stack(tables)).reshape(-1)
        self.doubled = [tables[1]]
        while len(self.doubled) < 40:
            last = self.doubled[-1]
            self.doubled.append(_through(last, last.reshape(-1)).reshape(4, 256))

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        near = np.minimum(size, self.short)
        base = near << 10
        out = self.flat[base + (crc & np.uint32(255))]
        for k in (1, 2, 3):
            out ^= self.flat[base + ((crc >> np.uint32(8 * k)) & np.uint32(255)) + 256 * k]
        rest = size - near
        if rest.any():
            at = np.flatnonzero(rest)
            moved, left = out[at], rest[at]
            for k in range(int(left.max()).bit_length()):
                bit = ((left >> k) & 1).astype(bool)
                moved[bit] = _through(self.doubled[k], moved[bit])
            out[at] = moved
        return out


_advance: list[Advance] = []


def advance() -> Advance:
    if not _advance:
        _advance.append(Advance())
    return _advance[0]


def run_crcs(crc: np.ndarray, size: np.ndarray, text: np.ndarray, most: int, known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``most`` adjacent words of one text: the index of the last word, the CRC of the words joined by one space.

    Runs that end in the first ``known`` words are left out.
    """
    move = advance()
    spaced = move(np.full(len(crc), zlib.crc32(_SPACE), dtype=np.uint32), size) ^ crc   # of the word with a space before it
    last = np.arange(known, len(crc))
    now = crc[known:]
    yield last, now
    whole = crc                      # of the run that ends at each word, one word shorter than the next
    for n in range(2, most + 1):
        if len(crc) < n:
            return
        joined = move(whole[:-1], size[n - 1:] + 1) ^ spaced[n - 1:]     # whole[k]: the run that ends at word k + n - 2
        ends = np.arange(n - 1, len(crc))
        same = (text[n - 1:] == text[:len(crc) - n + 1]) & (ends >= known)
        yield ends[same], joined[same]
        whole = joined


# --- the dictionary and its scan -----------------------------------------------------------------------------------------------------


@dataclass
class Dictionary:
    words: list[bytes]
    crcs: list[int]

    def automaton(self) -> ahocorasick.Automaton:
        """Built once in a worker; a payload is length << 32 | CRC."""
        if not hasattr(self, "_automaton"):
            found = ahocorasick.Automaton(ahocorasick.STORE_ANY)
            for word, crc in zip(self.words, self.crcs, strict=True):
                found.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | crc)
            if self.words:
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def __getstate__(self) -> dict:
        return {"words": self.words, "crcs": self.crcs}

    def payloads(self, body: bytes, end: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The payload of each word of a piece: from the automaton, or from the bytes of words it does not hold."""
        at = np.full(len(body), -1, dtype=np.int64)
        if self.words:
            emitted = np.fromiter(chain.from_iterable(self.automaton().iter(body.decode("latin-1"))), np.int64)
            at[emitted[0::2]] = emitted[1::2]      # a match ends at the delimiter after its word
        out = at[end]
        other = np.flatnonzero(out < 0)
        crc = zlib.crc32
        out[other] = [(b - a) << 32 | crc(body[a:b]) for a, b in zip(start[other].tolist(), end[other].tolist(), strict=True)]
        return out


@dataclass
class Piece:
    body: bytes          # begins and ends with a delimiter
    marks: np.ndarray    # where each text begins
    first: int           # index of the first text
    goes_on: bool        # the first text began in the piece before

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each word."""
        inside = np.frombuffer(self.body, dtype=np.uint8) != 0x20
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edges[0::2], edges[1::2]
        return start, end, np.searchsorted(self.marks, start, side="right") - 1 + self.first


def pieces(texts: list[bytes | None], size: int = PIECE) -> Iterator[Piece]:
    """The texts in lower case with plain delimiters, about ``size`` bytes at a time, cut only between words."""
    part: list[bytes] = []
    marks, total, first = [], 1, 0

    def joined() -> Piece:
        return Piece(b" " + b" ".join(part) + b" ", np.array(marks), first, False)
    for k, text in enumerate(texts):
        body = (text or b"").translate(_PLAIN)
        if part and total + len(body) > size:
            yield joined()
            part, marks, total = [], [], 1
        if len(body) <= size:
            if not part:
                first = k
            part.append(body)
            marks.append(total)
            total += len(body) + 1
            continue
        low = 0
        while low < len(body):
            high = len(body)
            if high - low > size:
                high = body.rfind(_SPACE, low + 1, low + size)
                if high < 0:
                    high = body.find(_SPACE, low + size)
                    high = len(body) if high < 0 else high
            yield Piece(b" " + body[low:high] + b" ", np.array([0]), k, low > 0)
            low = high
    if part:
        yield joined()


def features(texts: list[bytes | None], dictionary: Dictionary, most: int, buckets: int, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: the text of each new word, and text and bucket of each run that ends in one."""
    held = np.zeros(0, dtype=np.int64)
    for piece in pieces(texts, size):
        start, end, text = piece.words()
        pay = dictionary.payloads(piece.body, end, start)
        known = len(held) if piece.goes_on else 0
        if known:
            pay, text = np.concatenate([held, pay]), np.concatenate([np.full(known, piece.first), text])
        crc, width = (pay & 0xFFFFFFFF).astype(np.uint32), pay >> 32
        runs = list(run_crcs(crc, width, text, most, known))
        held = pay[max(0, len(pay) - most + 1):] if most > 1 else pay[:0]
        yield (text[known:], np.concatenate([text[last] for last, _ in runs]),
               np.concatenate([code for _, code in runs]) % np.uint32(buckets))


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _count_words(most: int = 200_000) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for piece in pieces(_texts(batch)):
                counts.update(piece.body.split())
                if len(counts) > most:
                    yield out()
                    counts = Counter()
        if counts:
            yield out()
    return run


def build_dictionary(docs: DataFrame, text_col: str = "text", most: int = 1 << 17) -> Dictionary:
    """The words of most occurrences, ``most`` at most, of up to LONGEST bytes. Spark counts them and computes their payloads."""
    texts = bounded(docs).select(F.col(text_col).cast("string").alias("text"))
    counts = stored(texts.mapInArrow(tidy(_count_words()), "word string, n long").where(F.octet_length("word") <= LONGEST)
                    .groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = frequent(counts, most).select("word", F.crc32(F.encode("word", "utf-8")).alias("crc")).toArrow()
    return Dictionary([w.encode() for w in top.column("word").to_pylist()], top.column("crc").to_pylist())


# --- counting, scoring, drawing --------------------------------------------------------------------------------------------------


def _bucket_counts(dictionary, most: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, bucket in features(_texts(batch), dictionary.value, most, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, dictionary, text_col: str = "text", most: int = 3, buckets: int = 10_000) -> np.ndarray:
    """How often each bucket occurs in all texts. dictionary: a broadcast Dictionary."""
    found = (bounded(texts).select(F.col(text_col).cast("string").alias("text"))
             .mapInArrow(tidy(_bucket_counts(dictionary, most, buckets)), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, dtype=np.int64)
    for row in found:
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and source rates, rounded down."""
    size = float(len(source))
    all_s, all_t = float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _weigh(dictionary, gain, most: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            value = gain.value
            for own, text, bucket in features(_texts(batch), dictionary.value, most, buckets):
                if len(own):
                    low, span = int(own[0]), int(own[-1] - own[0]) + 1
                    place = slice(low, low + span)
                    words[place] += np.bincount(own - low, minlength=span)
                    n[place] += np.bincount(text - low, minlength=span)
                    # whole numbers far below 2**53, so sums of doubles are exact
                    weight[place] += np.bincount(text - low, weights=value[bucket], minlength=span).astype(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("rk"), pa.array(words), pa.array(n), pa.array(weight)], ["doc_id", "rk", "n_words", "n_features", "weight"])
    return run


def draw(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Adds rank (1, 2, ...) to the floor(percent * N / 100) highest scores of the N rows with enough words; null elsewhere."""
    spark = scored.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.when(F.col("n_words") >= least_words, 0).otherwise(1), F.desc("score"), id_or_last("doc_id"), F.col("rk")]
    # a serial number spreads rows that are equal in all else over the parts
    numbered = stored(scored, "scored").withColumn("serial", F.monotonically_increasing_id())
    placed = (numbered.repartitionByRange(parts, *order, "serial").sortWithinPartitions(*order, "serial")
              .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33)))
    placed = stored(placed, "placed")
    sizes = sorted(placed.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("n_words") >= least_words).alias("fit")).collect())  # a row per part
    before, offsets = 0, []
    for row in sizes:
        offsets.append((row.part, before))
        before += row.n
    drawn = percent * sum(row.fit for row in sizes) // 100
    rank = F.col("before") + F.col("place") + 1
    return placed.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part").withColumn("rank", F.when(rank <= drawn, rank))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 3, buckets: int = 10_000,
             least_words: int = 20, percent: int = 5, seed: int = 42, dictionary: int = 1 << 17) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn), n_words."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(build_dictionary(docs, text_col, dictionary))
    gain = gains(bucket_counts(docs, shared, text_col, most, buckets), bucket_counts(target, shared, text_col, most, buckets))
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).cast("string").alias("text"))
    weighed = rows.mapInArrow(
        tidy(_weigh(shared, spark.sparkContext.broadcast(gain), most, buckets)), "doc_id long, rk long, n_words long, n_features long, weight long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    uniform = (drawn + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")
    return draw(weighed.withColumn("score", F.col("weight") + noise), least_words, percent).select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words")
