"""Line dedup: a line goes if an earlier line is equal to it or, from ``EDIT_WORDS`` words on, at most one word edit away.

Lines are parts of a text between newlines, compared as word sequences; an edit inserts, deletes or replaces one word. Earlier means a
smaller doc_id, or the same document and a line before. Lines without a word always stay. Lines are judged on the input.

1. Equal lines form a class, led by its earliest line.
2. Two lines one edit apart share their first or last half, so only classes of long lines that share a half with another are looked at
   further.
3. Deletion neighbourhood: each such line emits the hashes of all its one-word deletions. Equal deletions at one place are lines with one
   word replaced; a deletion equal to a whole line is an inserted word. Joined by hash, each line keeps its earliest partner as witness
   (a minimum for each hash, so a large family makes no pairs), and the edit distance to the witness is verified on the words.
4. A class with an earlier witness goes, of any other class all lines but the first.

Defined cases: a null text has no lines; a null id is later than all others; rows equal in id and text are one document; rows equal in id
only are ordered by a hash of their texts; an empty table gives an empty result; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import SpanHasher, Words, mix, powers, tidy, word_slices
from brickfolio.llm.packing import packed, unpacked
from brickfolio.llm.tables import LAST_ID, bounded, row_key, stored

EDIT_WORDS = 8  # shorter lines go as equal ones only: one edit is too much of them


def find_lines(words: Words, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, line number in it, first word, end word) of the lines of enough words."""
    breaks = np.concatenate([[0], np.cumsum(words.data == 0x0A)])
    number = breaks[words.start] - breaks[words.offsets[words.text]]
    new = np.ones(len(number), dtype=bool)
    new[1:] = (words.text[1:] != words.text[:-1]) | (number[1:] != number[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(number))[:len(begin)]
    long = end - begin >= min_words
    begin, end = begin[long], end[long]
    return words.text[begin], number[begin], begin, end


def half_keys(spans: SpanHasher, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of first and last halves, so that lines one edit apart share one: half of the own length, and of one word less."""
    keys = []
    for half in ((end - begin) // 2, (end - begin - 1) // 2):
        keys += [spans(begin, begin + half) ^ np.uint64(1), spans(end - half, end) ^ np.uint64(2)]
    return np.stack(keys, axis=1)


def deletions(spans: SpanHasher, begin: int, end: int) -> np.ndarray:
    """Hashes of the line without its first, second, ... word; as those of whole lines of that length."""
    p = np.arange(begin, end)
    power = powers(end - begin + 1)[0]
    inverse, sums = spans.inverse, spans.sums
    head = (sums[p] - sums[begin]) * inverse[begin]
    tail = (sums[end] - sums[p + 1]) * inverse[p + 1] * power[p - begin]
    return mix(head + tail + np.uint64(end - begin - 1) * np.uint64(0xD6E8FEB86659FD93))


def at_most_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), _signed(values))


def _lines(equal_from: int, edit_from: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column("text")):
                text, number, begin, end = find_lines(words, equal_from)
                spans, own = SpanHasher(words.hashes), batch.slice(low, high - low)
                long = end - begin >= edit_from
                keys = half_keys(spans, begin[long], end[long])
                yield pa.record_batch(
                    [own.column("rk").take(pa.array(text)), own.column("id").take(pa.array(text)), pa.array(number.astype(np.int32)),
                     _signed(spans(begin, end)), _lists(keys.ravel(), long * keys.shape[1])],
                    ["rk", "id", "no", "line", "halves"])
    return run


def _neighbourhood(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("nos").to_pylist()
            for low, high, words in word_slices(unpacked(batch)):
                text, number, begin, end = find_lines(words, min_words)
                spans, data, rows = SpanHasher(words.hashes), words.data.tobytes(), []
                lookup = {(t, n): k for k, (t, n) in enumerate(zip(text.tolist(), number.tolist(), strict=True))}
                for t in range(high - low):
                    for n in wanted[low + t]:
                        k = lookup[t, n]
                        gone = deletions(spans, begin[k], end[k])
                        placed = mix(gone ^ mix(np.arange(len(gone), dtype=np.uint64) + np.uint64(1)))
                        rows.append((low + t, n, k, gone.view(np.int64), placed.view(np.int64), data[words.start[begin[k]]:words.end[end[k] - 1]]))
                if rows:
                    row, no, k, gone, placed, body = zip(*rows, strict=True)
                    yield pa.record_batch(
                        [_signed(spans(begin[list(k)], end[list(k)])), batch.column("id").take(pa.array(row)), batch.column("rk").take(pa.array(row)),
                         pa.array(no, pa.int32()), pa.array(gone, pa.list_(pa.int64())), pa.array(placed, pa.list_(pa.int64())), pa.array(body, pa.binary())],
                        ["line", "id", "rk", "no", "gone", "placed", "body"])
    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("body").to_pylist(), batch.column("other").to_pylist()
        close = [at_most_one_edit(x.split(), y.split()) for x, y in zip(a, b, strict=True)]
        yield pa.record_batch([batch.column("line").filter(pa.array(close))], ["line"])


def _cut(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, bodies, lines = batch.column("gone").to_pylist(), unpacked(batch).to_pylist(), []
            for k, own in enumerate(gone):
                parts = [] if bodies[k] is None else bodies[k].split("\n")
                lines.append(len(parts))
                if own:
                    own = set(own)
                    bodies[k] = "\n".join([x for n, x in enumerate(parts) if n not in own])
            yield pa.record_batch(
                [batch.column(x) for x in columns] + [pa.array(bodies, pa.string()), pa.array(lines, pa.int64()), pa.array([len(x or ()) for x in gone], pa.int64())],
                [*columns, "new_text", "n_lines", "n_removed"])
    return run


def _ordered(line: str = "line") -> list:
    return [F.struct("id", "rk", "no").alias("place"), F.col(line)]


def earlier_partners(near: DataFrame) -> DataFrame:
    """near: line, id, rk, no, gone, placed of each class. Returns line, other: the earliest line found at one edit."""
    replaced = near.select(*_ordered(), F.explode("placed").alias("key"))
    least = replaced.groupBy("key").agg(F.min(F.struct("place", "line")).alias("least"), F.count("*").alias("n")).where("n > 1")
    by_replacing = replaced.join(least, "key").where(F.col("line") != F.col("least.line")).select("line", "least")
    short = near.select(F.col("line").alias("key"), *_ordered())
    long = near.select(F.explode("gone").alias("key"), F.struct("id", "rk", "no").alias("p"), F.col("line").alias("l"))
    met = short.join(long, "key").select(F.struct("place", "line").alias("a"), F.struct(F.col("p").alias("place"), F.col("l").alias("line")).alias("b"))
    by_inserting = met.select(F.greatest("a", "b").alias("late"), F.least("a", "b").alias("least")).select("late.line", "least")
    return by_replacing.union(by_inserting).groupBy("line").agg(F.min("least").alias("least")).select("line", F.col("least.line").alias("other_line"))


def remove_repeated_lines(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", min_words: int | None = None) -> DataFrame:
    """``columns`` of the documents, new_text without the removed lines, n_lines, n_removed. ``min_words`` holds both rules, of equal lines
    and of lines one edit apart, to lines of so many words; without it the first is for all lines, the second for ``EDIT_WORDS`` and more."""
    equal_from, edit_from = (1, EDIT_WORDS) if min_words is None else (min_words, min_words)
    rows = bounded(docs).select(*columns, row_key(id_col, text_col).alias("rk"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("__id"),
                       F.col(text_col).cast("string").alias("__text"))
    texts = rows.select("rk", F.col("__id").alias("id"), F.col("__text").alias("text"))
    lines = stored(texts.mapInArrow(tidy(_lines(equal_from, edit_from)), "rk long, id long, no int, line long, halves array<long>"), "lines")
    classes = stored(lines.groupBy("line").agg(F.min(F.struct("id", "rk", "no")).alias("place"), F.any_value("halves").alias("halves")), "classes")
    halves = classes.select("line", F.explode(F.array_distinct("halves")).alias("half"))
    met = halves.groupBy("half").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a != b").select("half")
    wanted = (classes.join(halves.join(met, "half").select("line").distinct(), "line", "left_semi")
              .groupBy("place.rk").agg(F.collect_set("place.no").alias("nos")))
    # rows equal in id and text have one key, and need to emit only once
    near = stored(packed(texts, "text").join(wanted, "rk").mapInArrow(
        tidy(_neighbourhood(edit_from)), "line long, id long, rk long, no int, gone array<long>, placed array<long>, body binary").dropDuplicates(["line"]), "near")
    bodies = near.select("line", "body")
    late = (earlier_partners(near).join(bodies, "line").join(bodies.select(F.col("line").alias("other_line"), F.col("body").alias("other")), "other_line")
            .select("line", "body", "other").mapInArrow(tidy(_verified), "line long").withColumn("late", F.lit(True)))
    gone = (lines.join(classes.select("line", "place").join(late, "line", "left"), "line")
            .where(F.coalesce("late", F.lit(False)) | (F.struct("id", "rk", "no") != F.col("place")))
            .groupBy("rk").agg(F.collect_set("no").alias("gone")))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{x}` {types[x]}" for x in columns) + ", new_text string, n_lines long, n_removed long"
    return packed(rows.drop("__id"), "__text").join(gone, "rk", "left").mapInArrow(tidy(_cut(columns)), schema)


def keep_first_lines(docs: DataFrame, **options) -> DataFrame:
    """The columns of documents, with shortened texts; a document that has lost all its words goes."""
    cut = remove_repeated_lines(docs, ["doc_id", "lang", "source", "n_chars"], **options)
    return (cut.where(~((F.col("n_removed") > 0) & ~F.col("new_text").rlike(r"[^\x20\x09-\x0D]")))
            .select("doc_id", F.col("new_text").alias("text"), "lang", "source",
                    F.when(F.col("n_removed") > 0, F.length("new_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the shortened text; null for a null text)."""
    cut = remove_repeated_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], **options)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("new_text").cast("binary"), 256).alias("kept_sha256"))
