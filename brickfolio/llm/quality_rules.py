"""Quality rules whose cutoffs are selected with a guarantee.

Fixed rules (``base_failed``): fewer than 20 words, or over 30 % of the words in repeated windows of 8 words. Further rules score each
document (symbols, repeated lines, repeated windows, very long and very short words). Their cutoffs come from labelled documents, for
each stratum by itself: going from the loosest cutoff of a fixed ladder to stricter ones, a cutoff stands while the exact binomial
(Clopper-Pearson) upper bound of its rate of rejected good documents is at most ``risk / rules``. Testing in a fixed order needs no
correction along the ladder; the level is divided by rules and strata (Bonferroni). With probability ``1 - level`` no stratum then
loses more than ``risk`` of its good documents by the selected rules. Of the certified cutoffs a rule takes the one of most gain: a bad
document rejected counts 1, a good one ``-purity / (1 - purity)``. A rule without gain is left out.

All labelled documents count; they reach the selection as counts by stratum, rule and step of the ladder.

Defined cases: a null text has no words and fails; a null stratum is a stratum; a stratum without labels gets fixed rules only; labels that
are null or not 0/1 are not used, and a document labelled both ways counts as bad; repeated rows are judged alike; an empty table gives an
empty result; other columns are kept out of names that the rules use.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import Words, mix, tidy, word_slices
from brickfolio.llm.tables import bounded, stored

WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("symbols", "repeated_lines", "repeated_words", "long_words", "short_words")
# Ladder of each rule, ascending; a score above a step is rejected at that step.
_PARTS = [round(0.01 * k, 2) for k in range(1, 100)]
LADDERS = {
    "symbols": [round(0.002 * k, 3) for k in range(1, 250)], "repeated_lines": _PARTS, "repeated_words": _PARTS,
    "long_words": [round(4 + 0.25 * k, 2) for k in range(100)], "short_words": [round(-6 + 0.05 * k, 2) for k in range(120)]}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Marks the words in windows that occur twice or more in their text."""
    n = len(words.start)
    marked = np.zeros(n, dtype=bool)
    if n < window:
        return marked
    h, code = words.hashes, np.zeros(n - window + 1, dtype=np.uint64)
    for k in range(window):
        code = code * np.uint64(0x9E3779B97F4A7C15) + h[k:n - window + 1 + k]
    at = np.flatnonzero(words.text[:n - window + 1] == words.text[window - 1:])
    code = mix(code[at]) ^ mix(words.text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(code)
    same = code[order][1:] == code[order][:-1]
    hit = at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, hit, 1)
    np.add.at(depth, hit + window, -1)
    return np.cumsum(depth)[:n] > 0


def text_counts(words: Words) -> dict[str, np.ndarray]:
    data, offsets = words.data, words.offsets
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    inside = np.cumsum(inside)[:len(data)] > 0
    body = data.tobytes()
    lines, dup = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        seen, n, again = set(), 0, 0
        for line in body[a:b].split(b"\n"):
            if line.strip():
                n += 1
                again += line in seen
                seen.add(line)
        lines.append(n)
        dup.append(again)
    n_words = np.diff(words.first)
    repeat = np.concatenate([[0], np.cumsum(repeated_words(words))])
    return {
        "n_words": n_words, "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), offsets), "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.array(dup, dtype=np.int64), "n_repeat_words": repeat[words.first[1:]] - repeat[words.first[:-1]],
        "n_lines": np.array(lines, dtype=np.int64)}


def scores(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    length = c["word_chars"] / words
    return {"symbols": c["n_symbols"] / chars, "repeated_lines": c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            "repeated_words": c["n_repeat_words"] / words, "long_words": length, "short_words": -length}


def _measure(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column("__text")):
                c = text_counts(words)
                steps = [pa.array(np.searchsorted(LADDERS[rule], s, side="left").astype(np.int32)) for rule, s in scores(c).items()]
                failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
                own = batch.slice(low, high - low)
                yield pa.record_batch(
                    [own.column(x) for x in carried] + [pa.array(c[x]) for x in COUNTS] + [pa.array(failed)] + steps,
                    [*carried, *(f"__{x}" for x in COUNTS), "__failed", *(f"__{x}" for x in RULES)])
    return run


def measured(docs: DataFrame, columns: list[str], stratum_col: str, text_col: str) -> DataFrame:
    """``columns`` of the documents, with __stratum, the counts, __failed and the step that each rule's score has reached."""
    rows = bounded(docs).select(*columns, F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("__stratum"), F.col(text_col).cast("string").alias("__text"))
    carried = [*columns, "__stratum"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"`{x}` {types[x]}" for x in carried] + [f"__{x} long" for x in COUNTS] + ["__failed boolean"] + [f"__{x} int" for x in RULES])
    return rows.mapInArrow(tidy(_measure(carried)), schema)


def log_binomial_cdf(k: int, n: int, p: float) -> float:
    """Log of P(X <= k) for X ~ Bin(n, p), summed from the largest term down; k is below n * p."""
    term = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
    total, part, j = 1.0, 1.0, k
    while j > 0 and part > 1e-17 * total:
        part *= j * (1 - p) / ((n - j + 1) * p)
        total += part
        j -= 1
    return term + log(total)


def certified(rejected: int, good: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound of the rejected share, at confidence 1 - level, is at most ``risk``."""
    return good > 0 and rejected < good * risk and log_binomial_cdf(rejected, good, risk) <= log(level)


def select_step(good: np.ndarray, bad: np.ndarray, risk: float, level: float, purity: float) -> int:
    """Counts by reached step -> the selected step, or one beyond the ladder; a document is rejected where it has passed the step."""
    n_good, lost, caught = int(good.sum()), 0, 0
    best, most = len(good), 0.0
    for step in reversed(range(len(good) - 1)):
        lost, caught = lost + int(good[step + 1]), caught + int(bad[step + 1])
        if not certified(lost, n_good, risk, level):
            break
        gain = caught - lost * purity / (1 - purity)
        if gain > most:
            best, most = step, gain
    return best


def cutoffs(labelled: DataFrame, risk: float, level: float, purity: float) -> DataFrame:
    """labelled: __stratum, __good and the reached steps. Returns __stratum and, by rule, the selected step as cut_<rule>."""
    strata = labelled.agg(F.count_distinct("__stratum").alias("n_strata"))
    long = labelled.select("__stratum", "__good", F.explode(F.array(*[
        F.struct(F.lit(k).alias("rule"), F.col(f"__{rule}").alias("step")) for k, rule in enumerate(RULES)])).alias("s"))
    counts = (long.groupBy("__stratum", "s.rule", "s.step")
              .agg(F.sum(F.col("__good").cast("long")).alias("good"), F.sum((~F.col("__good")).cast("long")).alias("bad"))
              .join(F.broadcast(strata)))  # one row

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        out = {"__stratum": [group["__stratum"].iloc[0]]}
        share = level / (len(RULES) * int(group["n_strata"].iloc[0]))
        for k, rule in enumerate(RULES):
            good, bad = np.zeros(len(LADDERS[rule]) + 1, np.int64), np.zeros(len(LADDERS[rule]) + 1, np.int64)
            own = group[group["rule"] == k]
            good[own["step"]], bad[own["step"]] = own["good"], own["bad"]
            out[f"cut_{rule}"] = [select_step(good, bad, risk / len(RULES), share, purity)]
        return pd.DataFrame(out)

    return counts.groupBy("__stratum").applyInPandas(pick, "__stratum string, " + ", ".join(f"cut_{x} int" for x in RULES))


def judged(docs: DataFrame, labels: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           risk: float = 0.05, level: float = 0.05, purity: float = 0.95) -> DataFrame:
    """``columns`` of the documents with the counts, base_failed and kept; the documents are measured again if they carry their texts."""
    narrow = stored(measured(docs, [id_col], stratum_col, text_col), "measured")
    marks = (labels.select(F.col("doc_id").cast("long").alias(id_col), F.col("quality").alias("__q")).where(F.col("__q").isin(0, 1))
             .groupBy(id_col).agg(F.min("__q").alias("__q")).select(id_col, (F.col("__q") == 1).alias("__good")))
    cuts = cutoffs(narrow.where(~F.col("__failed")).join(marks, id_col), risk, level, purity)
    rows = narrow if columns == [id_col] else measured(docs, columns, stratum_col, text_col)
    passed = F.lit(False)
    for rule in RULES:
        passed = passed | F.coalesce(F.col(f"__{rule}") > F.col(f"cut_{rule}"), F.lit(False))
    return rows.join(cuts, "__stratum", "left").select(
        *columns, *[F.col(f"__{x}").alias(x) for x in COUNTS if x not in columns], F.col("__failed").alias("base_failed"),
        (~F.col("__failed") & ~passed).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    return judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(options.pop("stratum_col", "lang")).alias("lang")), labels, ["doc_id"], **options)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with the columns of documents."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return judged(docs, labels, columns, **options).where("kept").select(*columns)
