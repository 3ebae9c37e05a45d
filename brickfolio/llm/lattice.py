"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into units wherever no piece of two or more characters joins the characters on both sides; that never changes its pieces.
For distinct units, all substrings up to the longest piece are exploded and equi-joined to the piece table (broadcast: its size is the
vocabulary's); the matches are the edges of the unit's lattice, grouped by unit and folded with a higher-order ``aggregate``:

* ``viterbi``: the path of greatest total score, for unigram models;
* ``merge``: of the edges that join two adjacent parts, take the one of best score, leftmost first, until none is left. This is what a
  model of kind BPE means; its scores are ranks of merges, and their best sum is not that model's encoding.

The most frequent units, ``head`` of them at most, are folded once and broadcast as a table; all other units (each rare) go through the
lattice with the document they are in, so nothing that grows with the corpus is broadcast and no frequent unit is a join key. Texts are
shuffled compressed. Units of over ``LONG`` characters do not fit the fold's bit mask and are merged by the same rule in a heap.

Decoding joins the pieces' bytes. Defined cases: a null or empty text has no pieces; characters outside the vocabulary become byte
pieces; the space mark itself (U+2581) decodes to a space, as in the model; rows equal in id and text get equal rows; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import SpanHasher, ranges, text_slices, tidy
from brickfolio.llm.packing import packed, unpacked
from brickfolio.llm.tables import bounded, row_key, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG = 62
SLICE = 1 << 18
UNKNOWN_PENALTY = -1e4
PART_UNITS = 20_000
MOST_PARTS = 20_000


@dataclass
class Vocabulary:
    pieces: list[str]        # of all ids; empty for ids that no text gives
    scores: list[float]
    byte_ids: list[int]      # ids of the byte pieces, by byte

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in ids]
        return Vocabulary(
            [model.id_to_piece(i) if p else "" for i, p in zip(ids, plain, strict=True)], [model.get_score(i) for i in ids],
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def table(self, spark: SparkSession) -> DataFrame:
        """piece, id, score, rank: 0 for the best score."""
        rank = {s: k for k, s in enumerate(sorted(set(self.scores), reverse=True))}
        rows = [(p, i, self.scores[i], rank[self.scores[i]]) for i, p in enumerate(self.pieces) if p]
        return spark.createDataFrame(rows, "piece string, id int, score double, rank int")

    def late_ids(self) -> list[int]:
        """Ids of pieces that, spelt alone, need a worse merge before a better one.

        A unit without such a piece merges in order of ranks: a merge that opened a better one would open it inside the better one's
        span, which nothing has crossed yet, so that piece alone would show the same.
        """
        if not hasattr(self, "_late"):
            rank = {p: -s for p, s in zip(self.pieces, self.scores, strict=True) if p}
            self._late = [i for i, p in enumerate(self.pieces) if len(p) > 2 and not _ascending(p, rank)]
        return self._late

    def joins(self) -> np.ndarray:
        """Marks hashed pairs of characters that stand together in some piece; a clash only keeps a unit longer."""
        table = np.zeros(1 << 20, dtype=bool)
        pairs = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        a, b = (np.array([ord(p[k]) for p in pairs], dtype=np.uint32) for k in (0, 1))
        table[_pair(a, b)] = True
        return table

    def piece_bytes(self) -> list[bytes]:
        out = [p.encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


def _ascending(piece: str, rank: dict[str, float]) -> bool:
    parts, last = list(piece), (-np.inf, -1)
    while True:
        ways = [(rank[joined], sum(map(len, parts[:k])), k) for k in range(len(parts) - 1) if (joined := parts[k] + parts[k + 1]) in rank]
        if not ways:
            return True
        best = min(ways)
        if best[:2] < last:
            return False
        last, k = best[:2], best[2]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) >> np.uint32(12)


@dataclass
class Units:
    points: np.ndarray   # code points of all texts, each with its leading mark
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hashes: np.ndarray

    def string(self, k: int) -> str:
        return self.points[self.start[k]:self.end[k]].tobytes().decode("utf-32-le")

    def strings(self, some: np.ndarray) -> pa.Array:
        """The units of these indexes, encoded all at once."""
        length = self.end[some] - self.start[some]
        points = self.points[ranges(self.start[some], length)]
        body = points.tobytes().decode("utf-32-le").encode()
        size = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        places = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(length)])]
        return pa.StringArray.from_buffers(len(some), pa.py_buffer(places.astype(np.int32).tobytes()), pa.py_buffer(body))


def find_units(data: np.ndarray, offsets: np.ndarray, joins: np.ndarray) -> Units:
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    full = np.flatnonzero(np.diff(chars) > 0)  # texts with characters
    points = np.where(points == 0x20, np.uint32(ord(MARK)), points)
    points = np.insert(points, chars[full], np.uint32(ord(MARK)))
    first = chars[full] + np.arange(len(full))
    new = np.ones(len(points), dtype=bool)
    new[1:] = ~joins[_pair(points[:-1], points[1:])]
    new[first] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(points))[:len(start)]
    return Units(points, start, end, full[np.searchsorted(first, start, side="right") - 1] if len(full) else start, SpanHasher(points)(start, end))


def merge_long(unit: str, rank: dict[str, int]) -> list[str]:
    """Merges adjacent parts, best rank and then leftmost first; for units beyond the mask of the fold."""
    part, after, before = list(unit), list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
    queue: list[tuple[int, int, str]] = []

    def offer(k: int) -> None:
        if 0 <= k and after[k] < len(unit) and (joined := part[k] + part[after[k]]) in rank:
            heapq.heappush(queue, (rank[joined], k, joined))
    for k in range(len(unit)):
        offer(k)
    while queue:
        _, k, joined = heapq.heappop(queue)
        if not part[k] or after[k] >= len(unit) or part[k] + part[after[k]] != joined:
            continue
        gone = after[k]
        part[k], part[gone], after[k] = joined, "", after[gone]
        if after[k] < len(unit):
            before[after[k]] = k
        offer(k)
        offer(before[k])
    return [p for p in part if p]


# --- the lattice ---------------------------------------------------------------------------------------------------------------------


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k.cast("int"))


def _edges(units: DataFrame, pieces: DataFrame, longest: int, keys: list[str]) -> DataFrame:
    """Every substring that is a piece: start, end, and what the table says of it."""
    spans = (units.select(*keys, F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
             .select(*keys, "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("unit") - F.col("start")))).alias("size"))
             .withColumn("part", F.substring("unit", F.col("start") + 1, F.col("size"))).withColumn("code", F.xxhash64("part")))
    # a join on one long is faster than on strings; that the strings are equal is said in a way that makes it no second key
    same = F.startswith("part", "piece") & F.startswith("piece", "part")
    return spans.join(F.broadcast(pieces.withColumn("code", F.xxhash64("piece"))), "code").where(same).withColumn("end", F.col("start") + F.col("size"))


def _byte_ids(char: Column, vocabulary: Vocabulary) -> Column:
    code = F.hex(F.encode(char, "utf-8"))
    table = F.array(*[F.lit(i) for i in vocabulary.byte_ids])
    return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.get(table, F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int")))


def _unpacked(edge: Column) -> Column:
    start, end = F.shiftright(edge, 30).bitwiseAND(63), F.shiftright(edge, 24).bitwiseAND(63)
    return F.struct((_bit(start) + _bit(end)).alias("ends"), (_bit(end) - _bit(start + 1)).alias("inner"), edge.bitwiseAND((1 << 36) - 1).alias("code"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """Computes a value once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _joins_two(mask: Column, edge: Column) -> Column:
    """Both ends of the edge are boundaries, and one boundary lies between them."""
    return (mask.bitwiseAND(edge["ends"]) == edge["ends"]) & (F.bit_count(mask.bitwiseAND(edge["inner"])) == 1)


def _merged_in_order(unit: Column, edges: Column) -> Column:
    """The boundaries left after one pass over the edges, best first; for units whose merges come in order (``Vocabulary.late_ids``)."""
    return F.aggregate(edges, _bit(F.length(unit) + 1) - 1, lambda mask, e: F.when(
        _joins_two(mask, e), mask.bitwiseAND(F.bitwise_not(e["inner"]))).otherwise(mask))


def _merged_by_search(unit: Column, edges: Column) -> Column:
    """The boundaries left when each step looks for the best edge anew. The state: the boundaries, and the edges that may still be taken."""
    n = F.length(unit)

    def step(state: Column, _: Column) -> Column:
        best = F.get(F.filter(state["edges"], lambda e: F.bit_count(state["mask"].bitwiseAND(e["inner"])) == 1), F.lit(0))
        return _bound(F.coalesce(state["mask"].bitwiseAND(F.bitwise_not(best["inner"])), state["mask"]), lambda mask: F.struct(mask.alias("mask"), F.filter(
            state["edges"], lambda e: (mask.bitwiseAND(e["ends"]) == e["ends"]) & (mask.bitwiseAND(e["inner"]) != 0)).alias("edges")))

    begin = F.struct((_bit(n + 1) - 1).alias("mask"), F.filter(edges, lambda e: e["inner"] != 0).alias("edges"))
    return F.aggregate(F.sequence(F.lit(1), n), begin, step, lambda s: s["mask"])


def _merge(unit: Column, edges: Column, vocabulary: Vocabulary) -> Column:
    """edges: structs of ends and inner (bits of boundaries) and code (start, end, id), best rank and then leftmost first."""
    n = F.length(unit)
    late = vocabulary.late_ids()
    mask = _merged_in_order(unit, edges)
    if late:
        mask = F.when(F.exists(edges, lambda e: e["code"].bitwiseAND((1 << 24) - 1).isin(late)), _merged_by_search(unit, edges)).otherwise(mask)

    def spelt(mask: Column) -> Column:
        left = F.filter(edges, lambda e: (mask.bitwiseAND(e["ends"]) == e["ends"]) & (mask.bitwiseAND(e["inner"]) == 0))

        def ids(parts: Column) -> Column:
            plain = F.transform(parts, lambda p: p.bitwiseAND((1 << 24) - 1).cast("int"))
            # characters that are no piece
            other = F.flatten(F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda a: mask.bitwiseAND(_bit(a)) != 0), lambda a: F.coalesce(
                F.get(F.transform(F.filter(parts, lambda p: F.shiftright(p, 30) == a), lambda p: F.array(p.bitwiseAND((1 << 24) - 1).cast("int"))), F.lit(0)),
                _byte_ids(F.substring(unit, a + 1, F.lit(1)), vocabulary))))
            return F.when(F.size(parts) == F.bit_count(mask) - 1, plain).otherwise(other)
        return _bound(F.array_sort(F.transform(left, lambda e: e["code"])), ids)

    return _bound(mask, spelt)


def _viterbi(unit: Column, edges: Column, vocabulary: Vocabulary) -> Column:
    """edges: structs of start, end, score, id. The state: for each place the best score, and where its last piece starts."""
    n = F.length(unit)

    def step(places: Column, j: Column) -> Column:
        ways = F.transform(F.filter(edges, lambda e: e["end"] == j), lambda e: F.struct(
            (F.get(places, e["start"])["score"] + e["score"]).alias("score"), e["start"].alias("start"), e["id"].alias("id")))
        unknown = F.struct((F.get(places, j - 1)["score"] + UNKNOWN_PENALTY).alias("score"), (j - 1).alias("start"), F.lit(-1).alias("id"))
        return F.concat(places, F.array(F.array_max(F.concat(ways, F.array(unknown)))))

    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(-1).alias("id")))
    places = F.aggregate(F.sequence(F.lit(1), n), begin, step)

    def back(state: Column, j: Column) -> Column:
        place = F.get(state["places"], j)
        ids = F.when(place["id"] >= 0, F.array(place["id"])).otherwise(_byte_ids(F.substring(unit, j, F.lit(1)), vocabulary))
        return F.when(state["at"] == j, F.struct(place["start"].alias("at"), F.concat(ids, state["ids"]).alias("ids"), state["places"].alias("places"))).otherwise(state)

    start = F.struct(n.alias("at"), F.expr("cast(array() as array<int>)").alias("ids"), places.alias("places"))
    return F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), start, back, lambda s: s["ids"])


def fold_units(units: DataFrame, pieces: DataFrame, vocabulary: Vocabulary, fold: str = "merge", keys: list[str] | None = None) -> DataFrame:
    """units: keys, among them ``unit`` of 1 to LONG characters. Returns the keys with ids; a unit in which no piece occurs is left out."""
    keys = keys or ["unit"]
    longest = max(map(len, vocabulary.pieces))
    edges = _edges(units, pieces, longest, keys)
    if fold == "merge":
        packed = F.shiftleft(F.col("rank").cast("long"), 36) + F.shiftleft(F.col("start").cast("long"), 30) + F.shiftleft(F.col("end").cast("long"), 24) + F.col("id")
        grouped, folded = F.transform(F.array_sort(F.collect_list(packed)), _unpacked), _merge
    else:
        grouped, folded = F.collect_list(F.struct("start", "end", "score", "id")), _viterbi
    found = edges.groupBy(*keys).agg(grouped.alias("edges"))
    return found.select(*keys, folded(F.col("unit"), F.col("edges"), vocabulary).alias("ids"))


# --- encoding ------------------------------------------------------------------------------------------------------------------------


def _count_units(joins: np.ndarray, most: int = 80_000) -> Callable:
    """Distinct units with counts, of some slices at a time."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        code, first, of = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        return code, count, pa.concat_arrays([p[2] for p in parts]).take(pa.array(first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0), SLICE):
                units = find_units(data, offsets, joins)
                code, at, n = np.unique(units.hashes, return_index=True, return_counts=True)
                short = units.end[at] - units.start[at] <= LONG
                parts.append((code[short], n[short], units.strings(at[short])))
                size += len(parts[-1][0])
                if size > 2 * most:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > most:
                        yield pa.record_batch([parts[0][2], pa.array(parts[0][1])], ["unit", "n"])
                        parts, size = [], 0
        if parts:
            code, n, units = merged(parts)
            yield pa.record_batch([units, pa.array(n)], ["unit", "n"])
    return run


@contextmanager
def hashed_groups(spark: SparkSession, groups: int = 4 * PART_UNITS) -> Iterator[None]:
    """Edges are grouped in a hash table of so many units a task, a few kilobytes each; by default Spark sorts beyond 128 groups, edge by edge."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(groups))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Head:
    """Ids of units, found by hash: an open table of twice to four times the units."""

    codes: np.ndarray     # in the table
    places: np.ndarray    # index of the unit in a slot, or -1
    offsets: np.ndarray
    ids: np.ndarray

    @staticmethod
    def of(units: pa.Array, ids: pa.Array) -> Head:
        """units: strings; ids: a list of each."""
        parts = [np.zeros(0, dtype=np.uint64)]
        for k in range(0, len(units), 50_000):
            some = units.slice(k, 50_000)
            end = np.cumsum(pc.utf8_length(some).to_numpy().astype(np.int64))
            points = np.frombuffer("".join(some.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
            parts.append(SpanHasher(points)(np.concatenate([[0], end[:-1]]).astype(np.int64), end))
        codes = np.concatenate(parts)
        size = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        slots = 1 << max(1, 2 * len(codes) - 1).bit_length()
        table, places = np.zeros(slots, dtype=np.uint64), np.full(slots, -1, dtype=np.int32)
        left, slot = np.arange(len(codes)), (codes & np.uint64(slots - 1)).astype(np.int64)
        while len(left):
            free = places[slot] < 0
            places[slot[free]] = left[free]          # of several for one slot the last stays
            table[slot[free]] = codes[left[free]]
            again = places[slot] != left
            left, slot = left[again], (slot[again] + 1) & (slots - 1)
        flat = ids.flatten().to_numpy()
        narrow = np.uint16 if len(flat) == 0 or flat.max() < 1 << 16 else np.int32
        return Head(table, places, np.concatenate([[0], np.cumsum(size)]).astype(np.int32), flat.astype(narrow))

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Index of each code, or -1."""
        out, left, mask = np.full(len(codes), -1, dtype=np.int64), np.arange(len(codes)), len(self.codes) - 1
        slot = (codes & np.uint64(mask)).astype(np.int64)
        while len(left):
            place = self.places[slot]
            equal = (self.codes[slot] == codes[left]) & (place >= 0)
            out[left[equal]] = place[equal]
            again = ~equal & (place >= 0)
            left, slot = left[again], (slot[again] + 1) & mask
        return out


def _rare_units(joins: np.ndarray, head) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("rk").to_numpy()
            for low, _, data, offsets in text_slices(batch.column("text"), SLICE):
                units = find_units(data, offsets, joins)
                rare = np.flatnonzero((head.value.find(units.hashes) < 0) & (units.end - units.start <= LONG))
                at = rare[np.unique(units.hashes[rare] + units.text[rare].astype(np.uint64), return_index=True)[1]]
                yield pa.record_batch([pa.array(keys[low + units.text[at]]), units.strings(at)], ["rk", "unit"])
    return run


def _encode(joins: np.ndarray, head, rank: dict[str, int], ids: dict[str, int], byte_ids: list[int], carried: list[str]) -> Callable:
    def long_ids(unit: str) -> list[int]:
        return [i for p in merge_long(unit, rank) for i in ([ids[p]] if p in ids else [byte_ids[b] for b in p.encode()])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = unpacked(batch)
            rare = batch.column("rare").to_pylist()
            for low, high, data, offsets in text_slices(texts, SLICE):
                units = find_units(data, offsets, joins)
                common = head.value
                at = common.find(units.hashes)
                own = {r["unit"]: r["ids"] for rows in rare[low:high] for r in rows or ()}
                spare = np.flatnonzero(at < 0)
                # units that are too long for the fold, or hold no piece at all
                for k in spare[np.unique(units.hashes[spare], return_index=True)[1]].tolist():
                    if (unit := units.string(k)) not in own:
                        own[unit] = long_ids(unit)
                other = Head.of(pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.list_(pa.int32())))
                found = other.find(units.hashes[spare])
                begin = common.offsets[at].astype(np.int64)
                length = common.offsets[at + 1] - begin
                begin[spare] = len(common.ids) + other.offsets[found]
                length[spare] = other.offsets[found + 1] - other.offsets[found]
                where = ranges(begin, length)
                flat = np.empty(len(where), dtype=np.int32)
                here = where < len(common.ids)
                flat[here] = common.ids[where[here]]
                flat[~here] = other.ids[where[~here] - len(common.ids)]
                sizes = np.bincount(units.text, weights=length, minlength=high - low).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
                part = batch.slice(low, high - low)
                yield pa.record_batch([*(part.column(x) for x in carried), texts.slice(low, high - low), lists], [*carried, "text", "ids"])
    return run


def frequent(counts: DataFrame, most: int, least_count: int = 3) -> DataFrame:
    """The units of most occurrences, at most ``most``: whole steps of a logarithmic scale. A unit that occurs less than ``least_count`` times is
    never one of them, however small the corpus: folding it ahead would spare next to nothing."""
    counts = counts.where(F.col("n") >= least_count)
    step = F.floor(F.log2("n") * 4).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("units")).orderBy(F.desc("step")).collect()  # under 300 rows
    total, least = 0, 1 << 30
    for row in sizes:
        total += row.units
        if total > most:
            break
        least = row.step
    return counts.where(step >= least)


def _prepared(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", head: int = 1 << 20,
              fold: str = "merge", carry: tuple[str, ...] = ()) -> tuple[DataFrame, Callable, str]:
    """Packed texts beside the ids of their rare units, the task's function that encodes them, and the schema it gives."""
    spark = docs.sparkSession
    joins, pieces = vocabulary.joins(), vocabulary.table(spark)
    texts = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).cast("string").alias("text"), *carry)
    carried = "doc_id long, " + "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in carry)
    counts = stored(texts.select("text").mapInArrow(tidy(_count_units(joins)), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")), "units")
    common = frequent(counts, head)
    # spread by unit, which the grouping of edges can use; small parts, as a unit has some twenty edges
    with hashed_groups(spark):
        top = fold_units(common.select("unit").repartition(max(8, head >> 14), "unit"), pieces, vocabulary, fold).toArrow()
    table = spark.sparkContext.broadcast(Head.of(top.column("unit").combine_chunks(), top.column("ids").combine_chunks()))
    del top
    # as many parts as keep the edges of a task's units few; beyond MOST_PARTS tasks grow and their sorts spill
    left = (counts.agg(F.sum("n")).first()[0] or 0) - (common.agg(F.sum("n")).first()[0] or 0)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, left // PART_UNITS))
    rare = texts.select("rk", "text").mapInArrow(tidy(_rare_units(joins, table)), "rk long, unit string").repartition(parts, "rk")
    with hashed_groups(spark):
        folded = stored(fold_units(rare, pieces, vocabulary, fold, ["rk", "unit"]).groupBy("rk").agg(F.collect_list(F.struct("unit", "ids")).alias("rare")), "folded")
    scores = dict(zip(vocabulary.pieces, vocabulary.scores, strict=True))
    order = {s: k for k, s in enumerate(sorted(set(vocabulary.scores), reverse=True))}
    rank = {p: order[s] for p, s in scores.items() if p}
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}
    return (packed(texts, "text").join(folded, "rk", "left"), _encode(joins, table, rank, ids, vocabulary.byte_ids, ["doc_id", *carry]),
            carried + "text string, ids array<int>")


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, **options) -> DataFrame:
    """doc_id, the columns to carry, text and ids of each document; ``options`` as in ``_prepared``."""
    rows, run, schema = _prepared(docs, vocabulary or Vocabulary.load(), **options)
    return rows.mapInArrow(tidy(run), schema)


def _decode(pieces: list[bytes], carried: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first, body = np.cumsum(size) - size, np.frombuffer(b"".join(pieces), dtype=np.uint8)
        for batch in batches:
            column, texts = batch.column("ids"), []
            ids = column.flatten().to_numpy()
            counts = np.array([len(x) if x is not None else 0 for x in column.to_pylist()], dtype=np.int64) if column.null_count else np.diff(column.offsets.to_numpy())
            ends = np.cumsum(size[ids])
            flat = body[ranges(first[ids], size[ids])].tobytes()
            marks = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
            for a, b in zip(marks[:-1], marks[1:], strict=True):
                texts.append(flat[a:b].decode("utf-8", "replace").replace(MARK, " ").removeprefix(" "))
            yield pa.record_batch([*(batch.column(x) for x in carried), pa.array(texts, pa.string())], [*carried, "decoded"])
    return run


def decode(tokens: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Adds ``decoded`` to a table with ``ids``; null ids give an empty text."""
    vocabulary = vocabulary or Vocabulary.load()
    carried = [c for c in tokens.columns if c != "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*carried).schema) + ", decoded string"
    return tokens.select(*carried).mapInArrow(tidy(_decode(vocabulary.piece_bytes(), carried)), schema)


def tokenised(docs: DataFrame, carry: tuple[str, ...] = ("lang", "source"), vocabulary: Vocabulary | None = None, **options) -> DataFrame:
    """doc_id, the columns to carry, n_tokens, ids, same_text: whether decoding gives the text back.

    One worker encodes and decodes a slice of texts, so a task keeps one Python process and not two.
    """
    vocabulary = vocabulary or Vocabulary.load()
    rows, encoded, schema = _prepared(docs, vocabulary, carry=carry, **options)
    decoded = _decode(vocabulary.piece_bytes(), ["doc_id", *carry, "text", "ids"])
    tokens = rows.mapInArrow(tidy(lambda batches: decoded(encoded(batches))), schema + ", decoded string")
    return tokens.select(
        "doc_id", *carry, F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), MARK, " ")).alias("same_text"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids joined by a comma), same_text."""
    return tokenised(docs, (), **options).select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), "same_text")
