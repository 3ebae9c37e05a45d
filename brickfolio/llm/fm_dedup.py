"""Removal of repeated passages, by exact matching of word windows.

A window is ``window`` consecutive words of one document. A word goes if a window that covers it also starts earlier: in a document of
smaller id, or earlier in its own. Windows are judged on the input, not on what is left.

1. Every window is named by its least hashed ``gram`` of words; neighbouring windows of one name form a passage. Equal windows have equal
   names, so only names of two passages in the corpus, or of a passage that holds two equal windows itself, can hold repeats.
2. Passages of such names go to shards by name. A name that occurs very often (``hot``) is split further by the windows themselves,
   and equal passages are merged before the shuffle, so no shard holds what a third of all documents share more than once per task.
3. Each shard builds a compressed FM-index of its passages: Burrows-Wheeler transform in a wavelet matrix of packed bit planes. All
   passages are streamed through it at once, last word first: a backward step adds a word on the left, and a match of ``window`` words
   is shortened to ``window - 1`` by the run of suffixes that share them. The row range of each full match names its class, and the
   first (id, start) of a class stays.
4. All other windows of repeated names are cut from the documents.

Defined cases: a null text has no words; a null id is later than all others; rows equal in id and text are one document and treat each
other as absent; rows equal in id only are ordered by a hash of their texts; fewer words than ``window`` are never cut; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import SpanHasher, Words, find_words, mix, ranges, tidy, word_slices
from brickfolio.llm.tables import bounded, id_or_last, row_key

PIECE = 64          # most windows of one passage; longer ones are cut, overlapping
BLOCK = 250_000     # words of one FM-index


def passages(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows) of each run of windows with one name, by index of the words."""
    h, n = words.hashes, len(words.start)
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(n - gram + 1, dtype=np.uint64)
    for k in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k:n - gram + 1 + k]
    least, width = mix(grams), 1
    span = window - gram + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = np.flatnonzero(words.text[:n - window + 1] == words.text[window - 1:])
    if not len(at):
        return np.zeros(0, np.uint64), at, at
    name = least[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    run = np.diff(np.append(begin, len(at)))
    pieces = -(-run // PIECE)
    which = np.repeat(np.arange(len(begin)), pieces)
    shift = ranges(np.zeros(len(begin), np.int64), pieces) * PIECE
    return name[begin][which], at[begin][which] + shift, np.minimum(run[which] - shift, PIECE)


def _sequence_hash(h: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each span of word hashes."""
    out = np.zeros(len(start), dtype=np.uint64)
    for k in range(int(length.max(initial=0))):
        live = np.flatnonzero(length > k)
        out[live] = mix(out[live] * np.uint64(31) + h[start[live] + k])
    return out


def repeat_within(words: Words, window: int, at: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether each passage holds two equal windows: a text of short period has one name all along."""
    single, which = ranges(at, run), np.repeat(np.arange(len(at)), run)
    span = SpanHasher(words.hashes)(single, single + window)
    order = np.lexsort((span, which))
    span, which = span[order], which[order]
    out = np.zeros(len(at), dtype=bool)
    out[which[1:][(span[1:] == span[:-1]) & (which[1:] == which[:-1])]] = True
    return out


def _names(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, _, words in word_slices(batch.column(1)):
                name, at, run_ = passages(words, window, gram)
                times = 1 + repeat_within(words, window, at, run_).astype(np.int32)
                key = keys[low + words.text[at]] if len(at) else np.zeros(0, np.int64)
                order = np.lexsort((name, key))
                name, key, times = name[order].view(np.int64), key[order], times[order]
                new = np.ones(len(name), dtype=bool)
                new[1:] = (name[1:] != name[:-1]) | (key[1:] != key[:-1])
                # twice in one row, or within one passage, counts as a repeat by itself
                count = np.add.reduceat(times, np.flatnonzero(new), dtype=np.int32) if len(name) else times
                yield pa.record_batch([pa.array(key[new]), pa.array(name[new]), pa.array(count)], ["rk", "name", "n"])
    return run


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64) if len(column) else np.zeros(0, np.uint64)


def _repeated(words: Words, low: int, batch: pa.RecordBatch, window: int, gram: int):
    """The passages of repeated names: (name, first window, windows, whether hot)."""
    name, at, run = passages(words, window, gram)
    part = batch.slice(low, len(words.offsets) - 1)
    known, hot = _flat(part.column("names")), _flat(part.column("hot"))
    keep = np.isin(name, known)
    name, at, run = name[keep], at[keep], run[keep]
    return name, at, run, np.isin(name, hot)


def _extract(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("rk").to_numpy(), batch.column("id").to_numpy()
            found: list[tuple] = []
            for low, _, words in word_slices(batch.column("text")):
                name, at, run_, hot = _repeated(words, low, batch, window, gram)
                if not len(at):
                    continue
                # a hot name is dealt out by its single windows
                single = ranges(at[hot], run_[hot])
                length = np.full(len(single), window)
                window_name = _sequence_hash(words.hashes, single, length)
                name = np.concatenate([name[~hot], window_name])
                length = np.concatenate([run_[~hot] + window - 1, length])
                at = np.concatenate([at[~hot], single])
                body = np.concatenate([_sequence_hash(words.hashes, at[:len(at) - len(single)], length[:len(at) - len(single)]), window_name])
                text = words.text[at]
                row = low + text
                place = (at - words.first[text]).astype(np.int32)
                keep = _firsts(ids[row], place, keys[row], body, name)
                at, length = at[keep], length[keep]
                begin, end, data = words.start[at], words.end[at + length - 1], words.data.tobytes()
                texts = np.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], dtype=object)
                found.append((name[keep], body[keep], keys[row][keep], ids[row][keep], place[keep], texts))
            if not found:
                continue
            name, body, key, id_, place, texts = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = _firsts(id_, place, key, body, name)
            for some in np.array_split(keep, len(keep) // 20_000 + 1):
                yield pa.record_batch(
                    [pa.array(name[some].view(np.int64)), pa.array(key[some]), pa.array(id_[some]), pa.array(place[some]), pa.array(texts[some].tolist(), pa.binary())],
                    ["name", "rk", "id", "place", "body"])
    return run


def _firsts(id_, place, key, body, name) -> np.ndarray:
    """Indexes of the first (id, place) of each passage; the others are cut in any case."""
    order = np.lexsort((key, place, id_, name, body))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (body[order][1:] != body[order][:-1]) | (name[order][1:] != name[order][:-1])
    return order[new]


class WaveletMatrix:
    """Rank of symbols in a sequence, from bit planes packed 64 to a word with running counts."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        size = len(symbols) // 64 + 1
        self.planes, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = ((symbols >> level) & 1).astype(bool)
            padded = np.zeros(size * 64, dtype=bool)
            padded[:len(bits)] = bits
            plane = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(plane).astype(np.int64)
            self.planes.append(plane)
            self.counts.append(np.cumsum(ones) - ones)
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.base = self._descend(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for depth, (plane, count, zeros) in enumerate(zip(self.planes, self.counts, self.zeros, strict=True)):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = count[block] + np.bitwise_count(plane[block] & below)
            bit = (symbol >> (self.levels - 1 - depth)) & 1
            place = np.where(bit == 1, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, place) - self.base[symbol]


class FMIndex:
    """Full-text index of many short sequences. Symbols are 1 and up; 0 ends a sequence."""

    def __init__(self, symbols: np.ndarray, length: np.ndarray, window: int):
        """``symbols``: those of all sequences, one after another; ``length``: of each, ``window`` at least."""
        n, ends = len(symbols) + len(length), np.cumsum(length + 1) - 1
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = symbols
        self.size, self.n_symbols = n, int(symbols.max()) + 1
        # ends are ordered among each other by sequence, so all suffixes differ
        rank = text + len(length) - 1
        rank[ends] = np.arange(len(length))
        width, part = 1, None
        longest = 1 << (window - 1).bit_length() - 1  # the largest power of two under the window
        top = int(rank.max()) + 2
        while True:
            if width == longest:
                part = rank
            follow = np.zeros(n, dtype=np.int64)
            follow[:-width] = rank[width:] + 1
            key = rank * top + follow
            order = np.argsort(key)
            changed = np.ones(n, dtype=bool)
            changed[1:] = key[order][1:] != key[order][:-1]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(changed) - 1
            width, top = 2 * width, int(changed.sum()) + 1
            if changed.all() and part is not None:
                break
        before = text[order - 1]
        self.matrix = WaveletMatrix(before, self.n_symbols)
        counts = np.bincount(text, minlength=self.n_symbols)
        self.smaller = np.cumsum(counts) - counts
        # runs of suffixes that share window - 1 words: where a full match goes when its last word is given up
        shift = window - 1 - longest
        padded = np.concatenate([part, np.full(shift, -1)])
        same = (part[order][1:] == part[order][:-1]) & (padded[order + shift][1:] == padded[order + shift][:-1])
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
        self.run_low, self.run_high = begin[run], np.append(begin[1:], n)[run]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: rows whose suffix begins with the symbol and goes on as those of [low, high)."""
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.smaller[symbol] + both[:len(low)], self.smaller[symbol] + both[len(low):]

    def match(self, symbols: np.ndarray, first: np.ndarray, length: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Row range of the match of each window, by the index of its first word; zeros elsewhere."""
        low_of, high_of = np.zeros(len(symbols), dtype=np.int64), np.zeros(len(symbols), dtype=np.int64)
        order = np.argsort(-length)
        first, length = first[order], length[order]
        low, high = np.zeros(len(order), dtype=np.int64), np.full(len(order), self.size, dtype=np.int64)
        for t in range(int(length[0])):
            live = int(np.searchsorted(-length, -t))
            at = first[:live] + length[:live] - 1 - t
            low, high = self.step(symbols[at], low[:live], high[:live])
            if t >= window - 1:
                low_of[at], high_of[at] = low, high
                low, high = self.run_low[low], self.run_high[low]
        return low_of, high_of


def first_windows(bodies: list[bytes], keys: np.ndarray, ids: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(passage, place in its document) of the windows that start nowhere earlier among the passages of a shard."""
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    words = find_words(np.frombuffer(b"".join(bodies), dtype=np.uint8), np.concatenate([[0], np.cumsum(lengths)]))
    _, symbols = np.unique(words.hashes, return_inverse=True)
    symbols, length, first = symbols + 1, np.diff(words.first), words.first[:-1]
    index = FMIndex(symbols, length, window)
    low, high = index.match(symbols, first, length, window)
    windows = length - window + 1
    at, passage = ranges(first, windows), np.repeat(np.arange(len(length)), windows)
    assert (high[at] > low[at]).all()
    place = places[passage] + at - first[passage]
    order = np.lexsort((keys[passage], place, ids[passage], low[at]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = low[at][order][1:] != low[at][order][:-1]
    kept = np.sort(order[new])
    return passage[kept], place[kept]


def _search(window: int):
    def block(rows: list[tuple]) -> pa.RecordBatch:
        keys, ids, places = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2, 3))
        passage, place = first_windows([r[4] for r in rows], keys, ids, places, window)
        begin = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(place)).astype(np.int32)), pa.array(place.astype(np.int32)))
        of = passage[begin]
        return pa.record_batch([pa.array(keys[of]), pa.array(ids[of]), lists], ["rk", "id", "starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > 6 * BLOCK and row[0] != last:  # about six bytes a word
                    yield block(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
                last = row[0]
        if rows:
            yield block(rows)
    return run


def _cut(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("id").to_numpy(), []
            kept_rows = batch.column("kept").to_pylist()
            for low, high, words in word_slices(batch.column("text")):
                _, at, run_, _ = _repeated(words, low, batch, window, gram)
                gone = np.zeros(len(words.start) + window, dtype=np.int32)
                hit = np.zeros(len(words.start) + 1, dtype=bool)
                hit[ranges(at, run_)] = True
                for k in range(low, high):
                    for own in kept_rows[k] or ():
                        if own["id"] == ids[k]:
                            hit[np.asarray(own["starts"], dtype=np.int64) + words.first[k - low]] = False
                at = np.flatnonzero(hit)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone)[:len(words.start)] > 0
                data = words.data.tobytes()
                begin, end = words.start.tolist(), words.end.tolist()
                for k in range(high - low):
                    a, b = words.first[k], words.first[k + 1]
                    left = (np.flatnonzero(~gone[a:b]) + a).tolist()
                    body = b" ".join([data[begin[i]:end[i]] for i in left])
                    out.append((low + k, int(b - a), int(b - a) - len(left), sha256(body).hexdigest(), body.decode("utf-8", "replace")))
            if out:
                row, n, removed, digest, body = zip(*out, strict=True)
                yield pa.record_batch(
                    [batch.column("doc_id").take(pa.array(row)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(body)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, gram: int = 6, hot: int = 5000) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space), kept_text."""
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    rows = bounded(docs).select(
        row_key(id_col, text_col).alias("rk"), F.col(text_col).cast("string").alias("text"), id_or_last(id_col).alias("id"),
        F.col(id_col).cast("long").alias("doc_id"))
    seen = rows.select("rk", "text").mapInArrow(tidy(_names(window, gram)), "rk long, name long, n int")
    counts = seen.groupBy("name").agg(F.sum("n").alias("total")).where("total > 1")
    wanted = (seen.join(counts, "name").groupBy("rk").agg(
        F.collect_set("name").alias("names"), F.collect_set(F.when(F.col("total") > hot, F.col("name"))).alias("hot")))
    both = rows.join(wanted, "rk", "left")
    found = both.mapInArrow(tidy(_extract(window, gram)), "name long, rk long, id long, place int, body binary")
    kept = (found.repartition("name").sortWithinPartitions("name")
            .mapInArrow(tidy(_search(window)), "rk long, id long, starts array<int>")
            .groupBy("rk").agg(F.collect_list(F.struct("id", "starts")).alias("kept")))
    return both.join(kept, "rk", "left").mapInArrow(
        tidy(_cut(window, gram)), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
