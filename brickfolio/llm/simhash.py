"""SimHash near-duplicates: every link within the radius, and the components of the links.

1. Fingerprint: XXH64 (seed 42) of all word shingles of the lower-cased text; a bit is 1 if set in over half of them.
2. Equal fingerprints are merged. The 64 bits are cut into ``blocks``; two fingerprints that differ in at most ``radius`` bits agree in
   ``blocks - radius`` blocks, so each is filed under every such choice of blocks. Groups beyond ``chunk`` members are dealt out as
   pairs of chunks, so that no task holds a whole hot group.
3. A group is compared bit-sliced: plane b holds bit b of 64 members in one word. For each member the planes are added to vertical
   carry-save counters, 64 distances at a time, and a word is abandoned once all its 64 distances exceed the radius.
4. Groups return a spanning forest of their links, never all pairs; components are joined by label minima.

Defined cases: a null or empty text and one without words has fingerprint zero, linked like any other; rows equal in id and text get
equal rows; a null id counts as later than all others, so it names a component only if no id does (and then it is null); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import ranges, text_slices, tidy
from brickfolio.llm.components import components
from brickfolio.llm.tables import LAST_ID, bounded, id_or_last, row_key, stored

BITS = 64
_LOWER = bytes(range(256)).lower()


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined, span = b" ".join(words), min(shingle, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(length)
    begin = (end - length)[:len(words) - span + 1].tolist()
    total, n, code = np.zeros(BITS, dtype=np.int64), len(begin), xxhash.xxh64_intdigest
    stop = (end - 1)[span - 1:].tolist()
    for k in range(0, n, 65_536):
        h = np.fromiter((code(joined[a:b], 42) for a, b in zip(begin[k:k + 65_536], stop[k:k + 65_536], strict=True)), np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = []
            for _, _, data, offsets in text_slices(batch.column("text")):
                body = data.tobytes()
                prints += [fingerprint(body[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("rk"), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], ["doc_id", "rk", "print"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, rk (the row's key), print (the 64 bits as a signed long)."""
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_fingerprints(shingle)), "doc_id long, rk long, print long")


def _keys(print_: Column, blocks: int, radius: int) -> Column:
    """One key for every choice of blocks that two prints within the radius may agree in."""
    edge = [BITS * k // blocks for k in range(blocks + 1)]
    mask = [((1 << edge[k + 1]) - 1) ^ ((1 << edge[k]) - 1) for k in range(blocks)]
    keys = []
    for n, some in enumerate(combinations(range(blocks), blocks - radius)):
        kept = sum(mask[k] for k in some)
        keys.append(F.xxhash64(F.lit(n), print_.bitwiseAND(F.lit(kept - (1 << BITS) if kept >> 63 else kept))))
    return F.array(*keys)


def _forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lowers labels until the ends of all links agree."""
    while True:
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
        if not len(a):
            return
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, np.maximum(label[a], label[b]), low)
        while (label[label] != label).any():
            label[:] = label[label]


def sliced_labels(prints: np.ndarray, group: np.ndarray, radius: int, side: np.ndarray | None = None, tile: int = 1 << 16) -> np.ndarray:
    """For each member the index of the first one that it is linked with inside its group. group: ascending. Bits are compared sliced.

    side: where a group is a pair of chunks, the chunk; members of one chunk are not compared with each other.
    """
    n = len(prints)
    label = np.arange(n)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(begin, n))
    of = np.repeat(np.arange(len(begin)), size)
    rank = np.arange(n) - begin[of]
    words = -(-size // 64)
    word_base = np.cumsum(words) - words
    slot = word_base[of] + (rank >> 6)
    bit = (rank & 63).astype(np.uint64)
    word_begin = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    planes = np.empty((BITS, len(word_begin)), dtype=np.uint64)
    one = np.uint64(1)
    for b in range(BITS):
        planes[b] = np.bitwise_or.reduceat(((prints >> np.uint64(b)) & one) << bit, word_begin)
    chunk = np.bitwise_or.reduceat(side.astype(np.uint64) << bit, word_begin) if side is not None else None
    # member i meets the words that hold earlier members of its group
    meets = (rank >> 6) + 1
    meets[rank == 0] = 0
    ends = np.cumsum(meets)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + tile, side="right")))
        member = np.repeat(np.arange(low, high), meets[low:high])
        word = ranges(word_base[of[low:high]], meets[low:high])
        own = word == slot[member]
        over = np.where(own, ~((one << bit[member]) - one), np.uint64(0))  # the word's places from the member's own on
        if side is not None:
            over |= np.where(side[member] == 1, chunk[word], ~chunk[word])
        c0, c1 = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
        c2 = np.zeros(len(word), np.uint64)
        for b in range(BITS):
            differs = planes[b][word] ^ (np.uint64(0) - ((prints[member] >> np.uint64(b)) & one))
            carry = c0 & differs
            c0 ^= differs
            carry, c1 = c1 & carry, c1 ^ carry
            over |= c2 & carry
            c2 |= carry
            if radius < 7:
                over |= _beyond(c0, c1, c2, radius)
            if b % 8 == 7:
                live = np.flatnonzero(over != ~np.uint64(0))
                if len(live) < len(over):
                    member, word, over, c0, c1, c2 = (x[live] for x in (member, word, over, c0, c1, c2))
                if not len(member):
                    break
        if len(member):
            close = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, place = np.nonzero(close)
            _forest(label, member[at], word_begin[word[at]] + place)
        low = high
    return label


def _beyond(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, radius: int) -> np.ndarray:
    """Where the counter c2 c1 c0 is above the radius."""
    above, equal = np.zeros_like(c0), ~np.zeros_like(c0)
    for counter, k in ((c2, 2), (c1, 1), (c0, 0)):
        if radius >> k & 1:
            equal = equal & counter
        else:
            above = above | (equal & counter)
            equal = equal & ~counter
    return above


def _links(radius: int):
    def compared(key: np.ndarray, chunk: np.ndarray, side: np.ndarray, prints: np.ndarray) -> pa.RecordBatch | None:
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])])
        group = np.cumsum(new)
        many = np.isin(group, group[1:][~new[1:]]) if len(group) > 1 else np.zeros(len(group), bool)
        key, chunk, side, prints, group = (x[many] for x in (key, chunk, side, prints, group))
        a, b = [], []
        split = side >= 0
        for some, pair in ((~split, False), (split, True)):
            if some.any():
                own = prints[some]
                label = sliced_labels(own.view(np.uint64), group[some], radius, side[some] if pair else None)
                linked = np.flatnonzero(label != np.arange(len(label)))
                a.append(own[linked])
                b.append(own[label[linked]])
        if not a or not sum(map(len, a)):
            return None
        return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            rows = [np.concatenate([r, c.to_numpy()]) for r, c in zip(rest, batch.columns, strict=True)]
            key, chunk = rows[0], rows[1]
            ended = (key != key[-1]) | (chunk != chunk[-1])
            cut = int(np.flatnonzero(ended)[-1]) + 1 if ended.any() else 0
            if cut:
                out = compared(*(x[:cut] for x in rows))
                if out is not None:
                    yield out
            rest = [x[cut:] for x in rows]
        if len(rest[0]):
            out = compared(*rest)
            if out is not None:
                yield out
    return run


def print_links(prints: DataFrame, radius: int = 3, blocks: int = 6, chunk: int = 16_384) -> DataFrame:
    """prints: distinct values in a long column. Returns links a, b that connect all prints within the radius of each other."""
    if not radius < blocks:
        raise ValueError("there must be more blocks than bits of the radius")
    if radius > 7:
        raise ValueError("the counters of differing bits hold no radius over 7")
    name = prints.columns[0]
    filed = prints.select(F.col(name).alias("print"), F.explode(_keys(F.col(name), blocks, radius)).alias("key"))
    counts = filed.groupBy("key").agg(F.count("*").alias("n"))
    large = counts.where(F.col("n") > chunk).select("key", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))
    shared = counts.where("n > 1").select("key")
    own = F.pmod(F.xxhash64("print", F.lit(1)), F.col("parts")).cast("int")
    # a member of a split group meets each chunk; pair (c, c) is compared inside, pair (c, d) across
    pairs = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(-1).alias("chunk"), F.lit(-1).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1), lambda d: F.struct(
            (F.least(own, d) * F.col("parts") + F.greatest(own, d)).cast("int").alias("chunk"),
            F.when(d == own, -1).when(own < d, 0).otherwise(1).cast("int").alias("side"))))
    dealt = (filed.join(shared, "key", "left_semi").join(large, "key", "left").select("key", F.explode(pairs).alias("p"), "print")
             .select("key", F.col("p.chunk").cast("long").alias("chunk"), F.col("p.side").cast("long").alias("side"), "print"))
    return (dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
            .mapInArrow(tidy(_links(radius)), "a long, b long").distinct())


def _joined(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, blocks: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints, and for each distinct one: least, the first (id, key) that has it, n_alike and the root of its component."""
    own = stored(fingerprints(docs, id_col, text_col, shingle), "prints")
    distinct = stored(own.groupBy("print").agg(F.min(F.struct(id_or_last("doc_id").alias("id"), "rk")).alias("least"), F.count("*").alias("n_alike")), "distinct")
    roots = components(print_links(distinct.select("print"), radius, blocks, chunk)).withColumnRenamed("node", "print")
    return own, distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, blocks: int = 6,
                    chunk: int = 16_384) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the least id reachable), n_alike (documents of its fingerprint)."""
    own, known = _joined(docs, id_col, text_col, shingle, radius, blocks, chunk)
    named = known.groupBy("root").agg(F.min("least.id").alias("component_id"))
    labels = known.join(named, "root").select("print", "component_id", "n_alike")
    return own.join(labels, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"), "n_alike")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 6, chunk: int = 16_384) -> DataFrame:
    """The columns of documents; of each component one row stays, that of the least id (if several rows share it, the least hashed text)."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    _, known = _joined(docs, "doc_id", "text", shingle, radius, blocks, chunk)
    kept = known.groupBy("root").agg(F.min("least").alias("least")).select("least.rk")
    return docs.select(*columns, row_key("doc_id", "text").alias("rk")).join(kept, "rk", "left_semi").dropDuplicates(["rk"]).select(*columns)
