"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Both dictionaries hold the words that are common in ordinary text, at the same distance from
their ends; in front of them each holds the character runs that are over-represented in its own kind
of text (by the likelihood ratio of document counts; it grows with the documents, so what is asked of it is so much a document). A window of words that compresses
shorter with the toxic dictionary than with the ordinary one has met toxic runs. A document's mean and largest gain
and its number of windows above a calibrated threshold go through a logistic function fitted to the labels.

Training reads at most `TOXIC_DOCS` and `ORDINARY_DOCS` labelled documents (smallest hashed ids), texts
of up to `MAX_TRAIN_BYTES` bytes; scoring compresses every window of every whole text.

Nulls: a null text counts as empty; an empty text has no windows and gets the score of no gain. Null labels and ids
are not learned from; without labels of both kinds every score is the share of label 1 (0 without any).
Repeated rows get equal scores, an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, ship_package, text_or_empty
from .labelled import label_counts, training_rows

TOXIC_DOCS, ORDINARY_DOCS, MAX_TRAIN_BYTES = 2000, 4000, 60_000
WINDOW, LEVEL, COMMON_WORDS, COMMON_BYTES = 12, 6, 3000, 64 << 10
RUN_LENGTHS, LEAST_GAIN, GAIN_A_DOCUMENT, LEAST_DOCS, LEAST_LIFT = range(5, 13), 25.0, 0.019, 6, 3.0
THRESHOLD = 0.5


@dataclass
class ToxicityModel:
    """The two dictionaries, the windows' threshold in bytes, and the logistic function's weights."""

    toxic: bytes
    ordinary: bytes
    margin: int
    weights: tuple[float, ...]


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The whole text, lower case, in runs of `size` words."""
    words = text.lower().split()
    return [" ".join(words[i : i + size]).encode("utf-8", "surrogatepass") for i in range(0, len(words), size)]


def _runs(text: str) -> set[str]:
    """All character runs of the lengths in `RUN_LENGTHS` within words (with the space before them)."""
    out: set[str] = set()
    for w in set(text.lower().split()):
        w = f" {w}"
        for n in RUN_LENGTHS:
            out.update(w[i : i + n] for i in range(len(w) - n + 1))
    return out


def _ratio(a: int, n: int, b: int, m: int) -> float:
    """Log likelihood ratio of a in n against b in m."""

    def part(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    p = (a + b) / (n + m)
    return 2 * (part(a, n, a / n) + part(b, m, b / m) - part(a, n, p) - part(b, m, p))


def contrast(own: list[str], other: list[str]) -> list[str]:
    """Character runs over-represented in `own`, strongest first, none within another."""
    count: Counter[str] = Counter()
    for t in own:
        count.update(_runs(t))
    count = Counter({k: v for k, v in count.items() if v >= LEAST_DOCS})
    there: Counter[str] = Counter()
    for t in other:
        there.update(_runs(t) & count.keys())
    n, m = len(own), len(other)
    least = max(LEAST_GAIN, GAIN_A_DOCUMENT * (n + m))
    ranked = sorted(((g, len(k), k) for k, v in count.items() if v / n > LEAST_LIFT * (there[k] + 0.5) / m and (g := _ratio(v, n, there[k], m)) >= least), reverse=True)
    taken: list[str] = []
    joined = ""
    for _, _, k in ranked:
        if k not in joined and not any(x.strip() in k for x in taken):
            taken.append(k)
            joined += "|" + k
    return taken


class Gains:
    """Compressed length of a window with the ordinary dictionary less that with the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        def make(d: bytes) -> zstandard.ZstdCompressor:
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)

        self.toxic, self.ordinary = make(toxic), make(ordinary)

    def of(self, text: str) -> np.ndarray:
        t, o = self.toxic.compress, self.ordinary.compress
        return np.array([len(o(w)) - len(t(w)) for w in windows(text)], np.int32)


def document_signals(gain: np.ndarray, margin: int) -> np.ndarray:
    """What the logistic function sees of a document: mean gain, largest gain, share and number of windows above the margin."""
    if not len(gain):
        return np.zeros(4)
    above = gain >= margin
    return np.array([gain.mean(), max(0, gain.max()), above.mean(), math.log1p(above.sum())])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (the last: bias) by Newton's method on scaled columns."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack((x / scale, np.ones((len(x), 1))))
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1])


def train(toxic: list[str], ordinary: list[str], shares: dict[int, int]) -> ToxicityModel:
    """Dictionaries, margin and weights from the two lists of texts; `shares`: documents of each label."""
    if not toxic or not ordinary:
        total = sum(shares.values())
        p = min(1 - 1e-6, max(1e-6, shares.get(1, 0) / total)) if total else 1e-6
        return ToxicityModel(b" " * 8, b" " * 8, 1, (0.0, 0.0, 0.0, 0.0, math.log(p / (1 - p))))
    words: Counter[str] = Counter()
    for t in ordinary:
        words.update(t.lower().split())
    common, left = [], COMMON_BYTES
    for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]:
        left -= len(w.encode("utf-8", "surrogatepass")) + 1
        if left < 0:  # the size of the dictionaries
            break
        common.append(w)
    common = " ".join(common[::-1])
    own = ["".join(contrast(a, b)[::-1]) for a, b in ((toxic, ordinary), (ordinary, toxic))]
    made = [(x + common).encode("utf-8", "surrogatepass").rjust(8) for x in own]
    gains = Gains(*made)
    got = [(gains.of(t), 1.0) for t in toxic] + [(gains.of(t), 0.0) for t in ordinary]
    # the margin: the least gain that at most one ordinary window in a thousand reaches
    plain = np.concatenate([g for g, k in got if k == 0] + [np.zeros(1, np.int32)])
    margin = max(1, int(np.quantile(plain, 0.999)) + 1)
    x, y = np.array([document_signals(g, margin) for g, _ in got]), np.array([k for _, k in got])
    w = _logistic(x, y)
    w[-1] += math.log(max(shares.get(1, 0), 0.5) / max(shares.get(0, 0), 0.5)) - math.log(len(toxic) / len(ordinary))
    return ToxicityModel(*made, margin, tuple(map(float, w)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS, max_bytes: int = MAX_TRAIN_BYTES) -> ToxicityModel:
    """The model of a bounded sample of labelled texts, fitted in the driver."""
    ship_package(docs.sparkSession)
    got = sorted((r._id, r.label, r.body) for r in training_rows(docs, labels, label, {1: toxic_docs, 0: ordinary_docs}, max_bytes).toLocalIterator())
    return train([t for _, k, t in got if k == 1], [t for _, k, t in got if k == 0], label_counts(labels, label))


def with_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with the score of each whole text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.toxic, model.ordinary, model.margin, model.weights))
    body = free_name([*docs.columns, score], "body")
    names = list(docs.columns if keep is None else keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in names], text_or_empty(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(*shared.value)
        gains, weights = Gains(own.toxic, own.ordinary), np.array(own.weights)
        for batch in batches:
            x = np.array([document_signals(gains.of(t.as_py()), own.margin) for t in batch.column(len(names))]).reshape(-1, 4)
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(p)], [*names, score])

    return rows.mapInArrow(run, rows.drop(body).schema.add(score, "double"))
