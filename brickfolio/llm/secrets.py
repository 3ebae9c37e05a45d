"""Secret scan: fixed patterns, and a character convolutional network over every further candidate.

Base findings are those of the fixed patterns and always stand. A candidate is a run of 16 or more key characters that no base finding
overlaps. The network sees the characters before, in and after a candidate. It is trained in numpy on labelled findings: a
bounded sample (``per_class`` of each class, those of least hash) of base findings as positives and of the other candidates as negatives.
Half of the positives are shown without their surroundings, and surroundings of negatives are mixed, so that the value counts and not the
keyword alone. A third of the findings, by hash, is held out: on a bounded sample of it the outputs are calibrated (Platt), and all of it
is scored and counted by kind and score step. A kind's cutoff is the greatest step that keeps the recall of its held-out findings at
``recall``; the cutoff for candidates is the least of these, so that recall binds for each kind. Candidates have no say in it: they are
not labelled, and a secret of an unlisted form among them must not shut out its likes. Without positives or negatives there is no network and
base findings only.

Texts are scanned once; findings and candidates with their surroundings are kept in a narrow table, from which the sample is taken and
which is scored. Offsets are code points, ends exclusive.

Defined cases: a null text is empty; rows equal in id and text get equal rows; null ids are carried through; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import tidy
from brickfolio.llm.tables import bounded, stored

# The base patterns with the length that a match needs; of ``assign`` the value's.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones never hide a longer one
KINDS = ("assign", "access", "hex")
MODEL_KIND = "model"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
STEPS = 1 << 14  # of scores from 0 to 1
_CODES = 100  # 0: nothing, 1: any other character, 2 and up: printable ASCII


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind."""
    found = []
    if _KEYWORD.search(text):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], f[0]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        if not any(s < m.end() and m.start() < e for _, s, e in base):
            out.append((m.start(), m.end()))
    return out


def surroundings(text: str, start: int, end: int) -> str:
    """A fixed number of characters before, of, and after a finding; a long one shows its head and tail. NUL pads."""
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[:INSIDE // 2] + inside[-INSIDE // 2:]
    return text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + inside.ljust(INSIDE, "\0") + text[end:end + AFTER].ljust(AFTER, "\0")


def encode(windows: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(windows).encode("utf-32-le"), dtype=np.uint32).reshape(len(windows), WIDTH)
    return np.where(points == 0, 0, np.where((points < 32) | (points > 126), 1, points - 30)).astype(np.int64)


@dataclass
class Network:
    """Embedding, one convolution, greatest over places, one hidden layer, one output; then scale and shift of the calibration."""

    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    span: int = 5

    @staticmethod
    def fresh(seed: int = 3, size: int = 8, filters: int = 24, hidden: int = 16, span: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        return Network({
            "embed": rng.normal(0, 0.5, (_CODES, size)), "conv": rng.normal(0, (2 / (span * size)) ** 0.5, (span * size, filters)), "cb": np.zeros(filters),
            "dense": rng.normal(0, (2 / (3 * filters)) ** 0.5, (3 * filters, hidden)), "db": np.zeros(hidden), "out": rng.normal(0, hidden ** -0.5, hidden), "ob": np.zeros(1)}, span=span)

    def _forward(self, codes: np.ndarray) -> tuple:
        w = self.weights
        places = codes.shape[1] - self.span + 1
        x = w["embed"][codes]
        columns = np.concatenate([x[:, k:k + places] for k in range(self.span)], axis=2)
        maps = np.maximum(columns @ w["conv"] + w["cb"], 0)
        # before, inside and after are pooled by themselves
        cuts = (0, BEFORE, BEFORE + INSIDE - self.span + 1, places)
        best = [a + maps[:, a:b].argmax(axis=1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        pooled = np.concatenate([np.take_along_axis(maps, b[:, None], axis=1)[:, 0] for b in best], axis=1)
        hidden = np.maximum(pooled @ w["dense"] + w["db"], 0)
        return columns, best, pooled, hidden, hidden @ w["out"] + w["ob"][0]

    def raw(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[k:k + 2048])[-1] for k in range(0, len(codes), 2048)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(codes) + self.shift, -50, 50)))

    def gradients(self, codes: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w = self.weights
        columns, best, pooled, hidden, z = self._forward(codes)
        loss = np.mean(np.maximum(z, 0) - z * target + np.log1p(np.exp(-np.abs(z))))
        dz = (1 / (1 + np.exp(-z)) - target) / len(target)
        d_hidden = np.outer(dz, w["out"]) * (hidden > 0)
        d_pooled = d_hidden @ w["dense"].T * (pooled > 0)
        n = w["conv"].shape[1]
        grads = {"out": hidden.T @ dz, "ob": np.array([dz.sum()]), "dense": pooled.T @ d_hidden, "db": d_hidden.sum(axis=0),
                 "conv": np.zeros_like(w["conv"]), "cb": d_pooled.reshape(len(dz), -1, n).sum(axis=(0, 1)), "embed": np.zeros_like(w["embed"])}
        rows = np.arange(len(dz))[:, None]
        for k, b in enumerate(best):
            d = d_pooled[:, k * n:(k + 1) * n]
            taken = columns[rows, b]  # rows x filters x inputs
            grads["conv"] += np.einsum("rfi,rf->if", taken, d)
            back = np.einsum("rf,if->rfi", d, w["conv"]).reshape(*b.shape, self.span, -1)
            for s in range(self.span):
                np.add.at(grads["embed"], codes[rows, b + s], back[:, :, s])
        return float(loss), grads


def train(codes: np.ndarray, target: np.ndarray, steps: int = 500, rows: int = 64, rate: float = 0.005, seed: int = 3) -> Network:
    """Adam on batches of as many positives as negatives."""
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    yes, no = np.flatnonzero(target == 1), np.flatnonzero(target == 0)
    m, v = ({k: np.zeros_like(x) for k, x in network.weights.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick, other = rng.choice(yes, rows // 2), rng.choice(no, rows // 2)
        shown, back = codes[pick].copy(), codes[other].copy()
        hide = rng.random(len(shown)) < 0.5
        # surroundings of a positive that is shown bare are those of a negative, and the other way round
        swap = back[hide].copy()
        back[hide, :BEFORE] = np.where(rng.random((int(hide.sum()), 1)) < 0.5, shown[hide, :BEFORE], swap[:, :BEFORE])
        shown[hide, :BEFORE] = swap[:, :BEFORE]
        _, grads = network.gradients(np.concatenate([shown, back]), np.concatenate([np.ones(len(shown)), np.zeros(len(back))]))
        for k, g in grads.items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.001 * (g * g - v[k])
            network.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return network


def calibrate(network: Network, codes: np.ndarray, target: np.ndarray, steps: int = 300) -> None:
    """Platt's scale and shift by gradient descent, with his smoothed targets."""
    z, n_yes, n_no = network.raw(codes), int(target.sum()), int((1 - target).sum())
    z = z / (size := max(1.0, np.abs(z).max()))
    goal, a, b = np.where(target == 1, (n_yes + 1) / (n_yes + 2), 1 / (n_no + 2)), 1.0, 0.0
    for _ in range(steps):
        d = 1 / (1 + np.exp(-(a * z + b))) - goal
        a, b = a - 4 * float((d * z).mean()), b - 4 * float(d.mean())
    network.scale, network.shift = a / size, b


@dataclass
class Scanner:
    network: Network
    cutoffs: dict[str, float]   # of each kind, and of further candidates

    @property
    def cutoff(self) -> float:
        return self.cutoffs[MODEL_KIND]


def cutoffs_of(counts: dict[tuple[int, int], int], recall: float) -> dict[str, float]:
    """counts: findings by (kind, score step). The greatest step that keeps each kind's recall, and the least of them for candidates."""
    cutoffs = {}
    for k, name in enumerate(KINDS):
        steps = sorted(((step, n) for (kind, step), n in counts.items() if kind == k), reverse=True)
        need, passed = recall * sum(n for _, n in steps), 0
        for step, n in steps:
            passed += n
            if passed >= need:
                cutoffs[name] = step / STEPS
                break
    return {**cutoffs, MODEL_KIND: min(cutoffs.values())}


def score_steps(network: Network, windows: list[str]) -> np.ndarray:
    return np.floor(network.probability(encode(windows)) * STEPS).astype(np.int64) if windows else np.zeros(0, np.int64)


def fit(windows: list[str], kinds: list[int], recall: float = 0.98, steps: int = 500, held: np.ndarray | None = None) -> Scanner | None:
    """windows of labelled findings; kind -1 is a negative. Every third is held out if ``held`` does not say which."""
    target = (np.array(kinds) >= 0).astype(float)
    held = np.arange(len(kinds)) % 3 == 2 if held is None else held
    if any(not (target[part] == value).any() for part in (held, ~held) for value in (0, 1)):
        return None
    codes = encode(windows)
    network = train(codes[~held], target[~held], steps)
    calibrate(network, codes[held], target[held])
    at = np.flatnonzero(held).tolist()
    seen = zip([kinds[k] for k in at], score_steps(network, [windows[k] for k in at]).tolist(), strict=True)
    return Scanner(network, cutoffs_of(Counter(seen), recall))


_FOUND = "array<struct<kind:int,start:int,end:int,window:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("window", pa.string())]))
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_findings(text or "")
            spans = base + [(-1, s, e) for s, e in candidates(text or "", base)]
            rows.append([{"kind": k, "start": s, "end": e, "window": surroundings(text, s, e)} for k, s, e in spans])
        yield pa.record_batch([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "found"])


def _scored(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("kind"), pa.array(score_steps(network, batch.column("window").to_pylist()))], ["kind", "step"])
    return run


def _spans(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def _report(scanner: Scanner | None):
    names = (*KINDS, MODEL_KIND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("found").to_pylist()
            asked = [(k, f) for k, row in enumerate(rows) for f in row if f["kind"] < 0]
            extra: dict[int, list] = {}
            if scanner and asked:
                p = scanner.network.probability(encode([f["window"] for _, f in asked]))
                for (k, f), x in zip(asked, p.tolist(), strict=True):
                    if x >= scanner.cutoff:
                        extra.setdefault(k, []).append((3, f["start"], f["end"]))
            out = []
            for k, row in enumerate(rows):
                base = [(f["kind"], f["start"], f["end"]) for f in row if f["kind"] >= 0]
                every = sorted(base + extra.get(k, []), key=lambda f: (f[1], f[0]))
                counts = [sum(f[0] == i for f in base) for i in range(3)]
                text = _spans([(names[i], s, e) for i, s, e in base])
                out.append((*counts, sha256(text.encode()).hexdigest(), _spans([(names[i], s, e) for i, s, e in every])))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                                  ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = 2000, recall: float = 0.98, steps: int = 500) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined) of each document."""
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(rows.mapInArrow(tidy(_scan), f"doc_id long, found {_FOUND}"), "findings")
    single = found.select(F.explode("found").alias("f")).select("f.kind", "f.window").withColumn("code", F.xxhash64("window"))
    single = single.withColumn("held", F.expr("pmod(code, 3) = 2"))
    every = single.distinct()
    sample = [r for k in range(-1, len(KINDS)) for held, most in ((False, per_class - per_class // 3), (True, per_class // 3))
              for r in every.where((F.col("kind") == k) & (F.col("held") == held)).orderBy("code", "window").limit(most).collect()]
    sample.sort(key=lambda r: (r.code, r.window))
    scanner = fit([r.window for r in sample], [r.kind for r in sample], recall, steps, np.array([r.held for r in sample], dtype=bool))
    if scanner:
        # the fit is of a sample, the cutoffs are of all held-out findings
        counts = (single.where("held and kind >= 0").select("kind", "window").mapInArrow(tidy(_scored(scanner.network)), "kind int, step long")
                  .groupBy("kind", "step").count().collect())
        scanner.cutoffs = cutoffs_of({(r.kind, r.step): r["count"] for r in counts}, recall)
    return found.mapInArrow(tidy(_report(scanner)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
