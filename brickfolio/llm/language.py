"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes are read word by word (a word with a space before and after; words of over ``LONGEST`` bytes are cut); each of the two
directions starts anew at each word, every byte position gets a distribution over the languages, and a document's is the mean over all
its positions. The network is trained in numpy by backpropagation through time on a bounded sample: at most ``per_language`` training
documents of each language, those of least hashed id, and ``words_each`` words of each, spread over the whole text. Training ids, languages
and words are all that reach the driver. Prediction runs in tasks over all texts; a task keeps the results of words it has seen, up to a
fixed number, so frequent words are read once.

The input of a prediction is the text alone. Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any
training document everything is ``und``; null ids are hashed as empty text; repeated rows get equal rows; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import mix, tidy, word_slices
from brickfolio.llm.tables import bounded, row_key, stored

LONGEST = 30
HIDDEN = 16
KEPT_WORDS = 400_000
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Direction:
    """A gated recurrent layer; the input is a byte, so its product with the input weights is a row of a table."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.h = hidden
        self.weights = {"wx": rng.normal(0, 0.3, (256, 3 * hidden)), "wh": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)), "b": np.zeros(3 * hidden)}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def forward(self, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """codes: steps x rows. Returns states: steps x rows x hidden."""
        n, wx, wh = self.h, self.weights["wx"] + self.weights["b"], self.weights["wh"]
        state, out, trace = np.zeros((codes.shape[1], n), dtype=np.float32), np.empty((*codes.shape, n), dtype=np.float32), []
        for t in range(len(codes)):
            x = wx[codes[t]]
            gates = _sigmoid(x[:, :2 * n] + state @ wh[:, :2 * n])
            reset, update = gates[:, :n], gates[:, n:]
            fresh = np.tanh(x[:, 2 * n:] + (reset * state) @ wh[:, 2 * n:])
            new = state + update * (fresh - state)
            if keep:
                trace.append((state, reset, update, fresh))
            state = out[t] = new
        return out, trace

    def backward(self, codes: np.ndarray, trace: list, given: np.ndarray) -> dict[str, np.ndarray]:
        """given: the loss's gradient at each state, from the output side."""
        n, wh = self.h, self.weights["wh"]
        grads, carry = {k: np.zeros_like(v) for k, v in self.weights.items()}, np.zeros_like(given[0])
        for t in reversed(range(len(codes))):
            state, reset, update, fresh = trace[t]
            d = carry + given[t]
            d_fresh = d * update * (1 - fresh * fresh)
            d_mixed = d_fresh @ wh[:, 2 * n:].T
            d_gates = np.concatenate([d_mixed * state * reset * (1 - reset), d * (fresh - state) * update * (1 - update)], axis=1)
            d_all = np.concatenate([d_gates, d_fresh], axis=1)
            grads["b"] += d_all.sum(axis=0)
            np.add.at(grads["wx"], codes[t], d_all)
            grads["wh"][:, :2 * n] += state.T @ d_gates
            grads["wh"][:, 2 * n:] += (reset * state).T @ d_fresh
            carry = d * (1 - update) + d_mixed * reset + d_gates @ wh[:, :2 * n].T
        return grads


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    top: dict[str, np.ndarray]

    @staticmethod
    def fresh(languages: list[str], seed: int = 7, hidden: int = HIDDEN) -> Network:
        rng = np.random.default_rng(seed)
        top = {"w": rng.normal(0, 0.2, (2 * hidden, len(languages))).astype(np.float32), "b": np.zeros(len(languages), dtype=np.float32)}
        return Network(languages, Direction(rng, hidden), Direction(rng, hidden), top)

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """codes: steps x rows of one length. The distribution at each position: steps x rows x languages."""
        states = np.concatenate([self.ahead.forward(codes)[0], self.back.forward(codes[::-1])[0][::-1]], axis=2)
        z = np.exp(states @ self.top["w"] + self.top["b"])
        return z / z.sum(axis=2, keepdims=True)

    def gradients(self, codes: np.ndarray, language: np.ndarray) -> tuple[float, list[tuple[dict, dict]]]:
        """Mean cross entropy over all positions, and (weights, their gradient) of all parts."""
        out_a, trace_a = self.ahead.forward(codes, True)
        out_b, trace_b = self.back.forward(codes[::-1], True)
        states = np.concatenate([out_a, out_b[::-1]], axis=2)
        z = np.exp(states @ self.top["w"] + self.top["b"])
        p = z / z.sum(axis=2, keepdims=True)
        rows, size = np.arange(codes.shape[1]), np.float32(codes.size)
        loss = -np.log(p[:, rows, language] + 1e-12).mean()
        p[:, rows, language] -= 1
        p /= size
        own = {"w": np.tensordot(states, p, axes=([0, 1], [0, 1])), "b": p.sum(axis=(0, 1))}
        given = p @ self.top["w"].T
        n = self.ahead.h
        return float(loss), [
            (self.top, own), (self.ahead.weights, self.ahead.backward(codes, trace_a, given[:, :, :n])),
            (self.back.weights, self.back.backward(codes[::-1], trace_b, given[::-1, :, n:]))]


def train(words: list[bytes], languages: list[str], steps: int = 1500, rows: int = 128, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on batches of words of one length, with a falling rate."""
    names = sorted(set(languages))
    network, rng = Network.fresh(names, seed), np.random.default_rng(seed)
    known = {n: k for k, n in enumerate(names)}
    lengths, target = np.array([len(w) for w in words]), np.array([known[x] for x in languages])
    groups = {n: np.flatnonzero(lengths == n) for n in np.unique(lengths)}
    codes = {n: np.frombuffer(b"".join(words[k] for k in g), dtype=np.uint8).reshape(len(g), n).T for n, g in groups.items()}
    sizes = np.array(list(groups))
    chance = np.array([len(groups[n]) for n in sizes]) / len(words)
    # a language of few words counts as much as one of many
    weight = 1 / np.bincount(target, minlength=len(names))[target]
    share = {n: weight[g] / weight[g].sum() for n, g in groups.items()}
    moments: list[tuple] = []
    for step in range(1, steps + 1):
        n = rng.choice(sizes, p=chance)
        pick = rng.choice(len(groups[n]), size=rows, p=share[n])
        _, parts = network.gradients(codes[n][:, pick], target[groups[n]][pick])
        pairs = [(w, k, g[k]) for w, g in parts for k in w]
        moments = moments or [(np.zeros_like(g), np.zeros_like(g)) for _, _, g in pairs]
        now = rate * (1 - step / (steps + 1))
        for (w, k, g), (m, v) in zip(pairs, moments, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w[k] -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def word_codes(word: bytes) -> list[bytes]:
    return [b" " + word[k:k + LONGEST] + b" " for k in range(0, len(word), LONGEST)]


class Reader:
    """Sums of the position distributions of words, kept for those seen first."""

    def __init__(self, network: Network, kept: int = KEPT_WORDS):
        self.network, self.kept = network, kept
        self.codes, self.sums = np.zeros(0, dtype=np.uint64), np.zeros((0, len(network.languages) + 1), dtype=np.float32)

    def read(self, words: list[bytes]) -> np.ndarray:
        """For each word the sum over its positions of each language's probability, and the number of positions."""
        pieces, of = [], []
        for k, w in enumerate(words):
            for p in word_codes(w):
                pieces.append(p)
                of.append(k)
        out, of = np.zeros((len(words), len(self.network.languages) + 1), dtype=np.float32), np.array(of)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(length, kind="stable")
        for n in np.unique(length):
            own = order[np.searchsorted(length[order], n):np.searchsorted(length[order], n, side="right")]
            for some in np.array_split(own, len(own) // 4096 + 1):
                codes = np.frombuffer(b"".join(pieces[k] for k in some), dtype=np.uint8).reshape(len(some), n).T
                np.add.at(out, of[some], np.concatenate([self.network.labels(codes).sum(axis=0), np.full((len(some), 1), n, dtype=np.float32)], axis=1))
        return out

    def look_up(self, codes: np.ndarray, word_of) -> np.ndarray:
        """codes: distinct and ascending; ``word_of(k)`` gives the bytes of one."""
        out = np.empty((len(codes), self.sums.shape[1]), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        known = self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), dtype=bool)
        out[known] = self.sums[at[known]]
        new = np.flatnonzero(~known)
        out[new] = self.read([word_of(k) for k in new.tolist()])
        if len(new) and len(self.codes) < self.kept:
            add = new[:self.kept - len(self.codes)]
            where = np.searchsorted(self.codes, codes[add])
            self.codes, self.sums = np.insert(self.codes, where, codes[add]), np.insert(self.sums, where, out[add], axis=0)
        return out


def _predict(network: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(network) if network else None
        for batch in batches:
            letters = pc.fill_null(pc.match_substring_regex(batch.column("text"), r"\pL"), False).to_numpy(zero_copy_only=False)
            for low, high, words in word_slices(batch.column("text")):
                n, names, score = high - low, np.full(high - low, UNKNOWN, dtype=object), np.zeros(high - low)
                if reader and len(words.start):
                    codes, first, of = np.unique(words.hashes, return_index=True, return_inverse=True)
                    data = words.data.tobytes()
                    sums = reader.look_up(codes, lambda k: data[words.start[first[k]]:words.end[first[k]]])  # noqa: B023
                    pooled = np.stack([np.bincount(words.text, weights=sums[of, c], minlength=n) for c in range(sums.shape[1])], axis=1)
                    share = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1)
                    best = share.argmax(axis=1)
                    read = letters[low:high]
                    names[read] = np.array(network.languages, dtype=object)[best[read]]
                    score[read] = np.clip(share[np.arange(n), best][read], 0, 1)
                own = batch.slice(low, n)
                yield pa.record_batch([own.column("doc_id"), own.column("held_out"), pa.array(names.tolist(), pa.string()), pa.array(score)],
                                      ["doc_id", "held_out", "lang_pred", "score"])
    return run


def _sample_words(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(batch.column("text")):
                data, own = words.data.tobytes(), batch.slice(low, high - low)
                for k in range(high - low):
                    at = np.arange(words.first[k], words.first[k + 1])
                    at = at[np.argsort(mix(at.astype(np.uint64)))[:words_each]]
                    found = [p for i in at.tolist() for p in word_codes(data[words.start[i]:words.end[i]])]
                    yield pa.record_batch([pa.array([own.column("lang")[k].as_py()] * len(found), pa.string()), pa.array(found, pa.binary())], ["lang", "word"])
    return run


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, words_each: int = 60, most: int = 20_000,
        steps: int = 1500) -> Network | None:
    """Trains on at most ``per_language`` documents of each language and ``most`` in all."""
    able = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # first within parts of a language, so that no task sees all documents of one
    parts, first = Window.partitionBy("lang", "part").orderBy("code", "rk"), Window.partitionBy("lang").orderBy("code", "rk")
    keys = (able.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("long"), F.lit(11)).alias("code"), row_key(id_col, text_col).alias("rk"))
            .distinct().withColumn("part", F.pmod("rk", F.lit(64))).withColumn("n", F.row_number().over(parts)).where(F.col("n") <= per_language)
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).orderBy("n", "lang").limit(most).select("rk"))
    keys = stored(keys, "training")  # at most ``most`` numbers
    texts = (able.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), row_key(id_col, text_col).alias("rk"))
             .join(F.broadcast(keys), "rk", "left_semi").select("lang", "text"))
    found = texts.mapInArrow(tidy(_sample_words(words_each)), "lang string, word binary").toArrow()
    if not found.num_rows:
        return None
    # an order that does not depend on how tasks deliver the words
    pairs = sorted(zip(found.column("word").to_pylist(), found.column("lang").to_pylist(), strict=True))
    return train([w for w, _ in pairs], [x for _, x in pairs], steps)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document."""
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_predict(network)), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    return predict(docs, fit(bounded(docs), **options))
