"""Texts compressed for a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from brickfolio.llm.bytewords import tidy


def packed(rows: DataFrame, text_col: str) -> DataFrame:
    """The same rows with the text column replaced by ``packed``, its compressed bytes."""
    kept = [c for c in rows.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [None if t is None else pack.compress(t) for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(bodies, pa.binary())], [*kept, "packed"])

    return rows.mapInArrow(tidy(run), ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", packed binary")


def unpacked(batch: pa.RecordBatch) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else unpack.decompress(t) for t in batch.column("packed").to_pylist()], pa.binary()).cast(pa.string())
