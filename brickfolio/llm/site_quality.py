"""Document quality from a text classifier and the record of the document's site, by hierarchical empirical Bayes.

1. Evidence: a logistic classifier on hashed pairs of neighbouring bytes, trained in numpy on a bounded sample (``sample`` labelled documents,
   those of least hashed id); its log odds for a document, less those of the sample as a whole, are the document's evidence.
2. Sites: labelled documents are counted by host and by path of a host. How much hosts differ beyond chance, and paths within their host, is
   estimated by moments from the counts, as the strength of two Beta priors. A host's rate is shrunk towards the global rate, a path's
   towards its host's; sites with few labels stay near the level above. A labelled document's own label is left out of its site's rate.
3. A document's log odds are its evidence plus those of its path's rate; it is kept at a probability of ``keep_at`` or more.

All labelled documents count for the sites: counts are grouped aggregates joined back by site, and Spark picks the join by the size of the
site table. Only the sample and two rows of moments reach the driver.

Defined cases: null hosts and paths are sites of their own; a null text has no evidence; labels that are null or not 0/1 are not used, a
document labelled both ways counts as bad; without labels of both kinds there is no evidence, and without labels the rate is a half; repeated
rows are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import text_slices, tidy
from brickfolio.llm.tables import bounded, row_key, stored

FEATURES = 1024


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs: texts x FEATURES, rows of length one."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    code = (data[:-1].astype(np.int64) * 257 + data[1:]) * 40503 % 65536 % FEATURES if len(data) else np.zeros(0, np.int64)
    inside = text[:-1] == text[1:]
    counts = np.bincount(text[:-1][inside] * FEATURES + code[inside], minlength=n * FEATURES).reshape(n, FEATURES)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    base: float   # log odds of a good document in the sample

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good over bad; 0 for texts without a pair of bytes."""
        return np.where(x.any(axis=1), x @ self.weights + self.bias - self.base, 0.0)


def train(x: np.ndarray, good: np.ndarray, steps: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> Classifier:
    """Logistic regression by full-batch Adam."""
    base = float(np.log(good.mean() / (1 - good.mean())))
    w, b = np.zeros(x.shape[1]), base
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        d = (1 / (1 + np.exp(-(x @ w + b))) - good) / len(good)
        g = np.append(x.T @ d + ridge * w, d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Classifier(w, float(b), base)


def _read(classifier: Classifier | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0)]
            for low, high, data, offsets in text_slices(batch.column("text")):
                found.append(classifier.evidence(features(data, offsets)) if classifier else np.zeros(high - low))
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "rk", "host", "path")), pa.array(np.concatenate(found))],
                                  ["doc_id", "rk", "host", "path", "evidence"])
    return run


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column("text")):
            x = features(data, offsets)
            own = batch.slice(low, high - low)
            yield pa.record_batch([own.column("rk"), own.column("good"), pa.array(list(x), pa.list_(pa.float32()))], ["rk", "good", "x"])


def label_marks(labels: DataFrame) -> DataFrame:
    """doc_id, good: one row for each labelled document."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg((F.min("quality") == 1).alias("good")))


def fit(rows: DataFrame, marks: DataFrame, sample: int = 4000) -> Classifier | None:
    """rows: doc_id, rk, text. Trains on at most ``sample`` labelled documents."""
    chosen = stored(marks.withColumn("code", F.xxhash64("doc_id", F.lit(5))).orderBy("code", "doc_id").limit(sample).select("doc_id", "good"), "sample")
    found = (rows.select("doc_id", "rk", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
             .select("rk", "good", "text").mapInArrow(tidy(_sampled), "rk long, good boolean, x array<float>").toArrow())
    good = found.column("good").to_numpy().astype(float) if found.num_rows else np.zeros(0)
    if not 0 < good.sum() < len(good):
        return None
    order = np.argsort(found.column("rk").to_numpy(), kind="stable")
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    return train(x[order].astype(np.float64), good[order])


def spread(n: Column, good: Column, rate: Column) -> list[Column]:
    """Sums that the strength is estimated from, over groups of n documents with a rate to expect."""
    variance = rate * (1 - rate)
    return [F.count("*").cast("double").alias("groups"), F.sum(n).cast("double").alias("total"), F.sum(n * n / F.lit(1.0)).alias("squares"),
            F.sum(F.when(variance > 0, n * (good / n - rate) * (good / n - rate) / variance).otherwise(0.0)).alias("excess")]


def strength(sums) -> float:
    """Prior strength (the sum of the Beta's parameters) by moments: 1 / r - 1 for a correlation r of documents of one group."""
    if not sums.groups or sums.groups < 2 or not sums.total:
        return 1000.0
    room = sums.total - sums.squares / sums.total - (sums.groups - 1)
    r = (sums.excess - (sums.groups - 1)) / room if room > 0 else 0.0
    return 1 / min(max(r, 0.001), 0.5) - 1


def _shrunk(good: Column, n: Column, prior: Column, strong: float) -> Column:
    return (good + prior * strong) / (n + strong)


def sites(labelled: DataFrame) -> tuple[DataFrame, float, float, float]:
    """labelled: host, path, good. Returns counts by host and path (p_n, p_good, h_n, h_good), the global rate, and both strengths."""
    paths = labelled.groupBy("host", "path").agg(F.count("*").alias("p_n"), F.sum(F.col("good").cast("long")).alias("p_good"))
    hosts = paths.groupBy("host").agg(F.sum("p_n").alias("h_n"), F.sum("p_good").alias("h_good"))
    total = hosts.agg(F.sum("h_n").alias("n"), F.sum("h_good").alias("good")).first()
    # half a document of each kind keeps the rate off 0 and 1
    rate = ((total.good or 0) + 0.5) / ((total.n or 0) + 1)
    of_hosts = strength(hosts.agg(*spread(F.col("h_n"), F.col("h_good"), F.lit(rate))).first())
    both = paths.join(hosts, paths.host.eqNullSafe(hosts.host)).select(paths["*"], "h_n", "h_good")
    of_paths = strength(both.agg(*spread(F.col("p_n"), F.col("p_good"), _shrunk(F.col("h_good"), F.col("h_n"), F.lit(rate), of_hosts))).first())
    return both, rate, of_hosts, of_paths


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source", path: Column | str = "lang",
          sample: int = 4000, keep_at: float = 0.5) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score (probability of a good document), kept."""
    host, path = (F.col(c) if isinstance(c, str) else c for c in (host, path))
    rows = bounded(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rk"), host.cast("string").alias("host"), path.cast("string").alias("path"),
        F.col(text_col).cast("string").alias("text"))
    marks = stored(label_marks(labels), "marks")
    narrow = rows.mapInArrow(tidy(_read(fit(rows, marks, sample))), "doc_id long, rk long, host string, path string, evidence double")
    judged = stored(narrow.join(marks, "doc_id", "left"), "evidence")
    # repeated rows are one document
    table, rate, of_hosts, of_paths = sites(judged.where(F.col("good").isNotNull()).select("doc_id", "rk", "host", "path", "good").distinct())
    # hosts and paths that no label is known of have a row of their own, too
    known = judged.select("host", "path").distinct()
    own = table.select("host", "path", "p_n", "p_good")
    of_host = table.select("host", "h_n", "h_good").distinct()
    spot = (known.join(own, known.host.eqNullSafe(own.host) & known.path.eqNullSafe(own.path), "left").select(known["*"], "p_n", "p_good"))
    spot = (spot.join(of_host, spot.host.eqNullSafe(of_host.host), "left").select(spot["*"], "h_n", "h_good")
            .select(F.struct("host", "path").alias("site"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("p_n", "p_good", "h_n", "h_good")]))
    mine = judged.withColumn("site", F.struct("host", "path"))
    out = F.when(F.col("good").isNotNull(), 1).otherwise(0)
    won = F.when(F.col("good"), 1).otherwise(0)
    h = _shrunk(F.col("h_good") - won, F.col("h_n") - out, F.lit(rate), of_hosts)
    p = _shrunk(F.col("p_good") - won, F.col("p_n") - out, F.col("host_rate"), of_paths)
    odds = F.col("evidence") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    return (mine.join(spot, "site").withColumn("host_rate", h).withColumn("path_rate", p).withColumn("score", 1 / (1 + F.exp(-odds)))
            .select("doc_id", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= keep_at).alias("kept")))
