"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A document's features are its words, its pairs of neighbouring words and the character 3- to 5-grams
of its words, each hashed to a bucket with a learned vector. The mean of the vectors goes through a
softmax layer. A pair is hashed by the exclusive or of its words' hashes, so that all immediate repeats fall
together. As the layer is linear, a trained model comes down to one number a bucket for scoring, and a
word's subwords are summed once a batch.

Training reads at most `PER_CLASS` documents of each label (those with the smallest hashed ids), texts
of up to `MAX_TRAIN_BYTES` bytes; scoring reads every whole text. Probabilities are corrected from the
sample's shares of the labels to those of all labels.

Nulls: a null text counts as empty; an empty text gets the score of no evidence (the labels' shares). Null labels
and ids are not learned from; without labels of both kinds every score is the share of label 1 (0.5 without
any). Repeated rows get equal scores, very long texts are scored whole, an empty table gives an empty
result, and other columns pass through `keep_quality` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, free_name, ship_package, text_or_empty
from .labelled import label_counts, training_rows
from .shingles import mixed

BUCKETS, DIMENSIONS, EPOCHS, RATE, SEED = 1 << 18, 8, 6, 0.5, 11
PER_CLASS, MAX_TRAIN_BYTES = 1500, 100_000
THRESHOLD = 0.3
GRAMS = (3, 4, 5)


@dataclass
class QualityModel:
    """bias and one number a bucket: what a feature adds to the log odds of label 1 before averaging."""

    weights: np.ndarray
    bias: float


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each word between < and >, and the number of each word's."""
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    end = np.repeat(np.cumsum(size), size)
    place, word = np.arange(len(code)), np.repeat(np.arange(len(words)), size)
    found, owner = [], []
    for n in GRAMS:
        fits = np.flatnonzero(place + n <= end)
        h = np.full(len(fits), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + code[fits + j]
        found.append((mixed(h, 5) % np.uint64(BUCKETS)).astype(np.int64))
        owner.append(word[fits])
    return np.concatenate(found), np.concatenate(owner)


def _parsed(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their hashes, the words in order as places in these, and the text of each."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = parts.flatten()
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    if "" in words:
        keep = codes != words.index("")
        codes, text = codes[keep], text[keep]
    return words, np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)), codes, text


def _buckets(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (mixed(hashes, salt) % np.uint64(BUCKETS)).astype(np.int64)


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text and their counts."""
    words, hashes, codes, _ = _parsed(pa.array([text], pa.large_string()))
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    grams, owner = _subwords(words)
    times = np.bincount(codes, minlength=len(words)).astype(np.float32)
    pairs = hashes[codes[1:]] ^ hashes[codes[:-1]]
    bucket = np.concatenate((_buckets(hashes, 1), grams, _buckets(pairs, 2)))
    count = np.concatenate((times, times[owner], np.ones(len(pairs), np.float32)))
    total = np.bincount(bucket, count, BUCKETS)
    bucket = np.unique(bucket)
    bucket = bucket[total[bucket] > 0]
    return bucket.astype(np.int32), total[bucket].astype(np.float32)


def logits(texts: pa.Array, model: QualityModel) -> np.ndarray:
    """Log odds of label 1 for each text."""
    n = len(texts)
    words, hashes, codes, text = _parsed(texts)
    if not len(codes):
        return np.full(n, model.bias)
    grams, owner = _subwords(words)
    value = model.weights[_buckets(hashes, 1)] + np.bincount(owner, model.weights[grams], len(words))
    count = 1.0 + np.bincount(owner, minlength=len(words))
    same = np.flatnonzero(text[1:] == text[:-1])
    pairs = model.weights[_buckets(hashes[codes[same + 1]] ^ hashes[codes[same]], 2)]
    total = np.bincount(text, value[codes], n) + np.bincount(text[same], pairs, n)
    number = np.bincount(text, count[codes], n) + np.bincount(text[same], minlength=n)
    return total / np.maximum(number, 1) + model.bias


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], shares: dict[int, int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> QualityModel:
    """Softmax over mean vectors by stochastic gradient descent; samples are (label, buckets, counts)."""
    n = {k: sum(s[0] == k for s in samples) for k in (0, 1)}
    known = [shares.get(0, 0), shares.get(1, 0)]
    prior = float(np.log(max(known[1], 0.5) / max(known[0], 0.5))) if sum(known) else 0.0
    if not n[0] or not n[1]:
        return QualityModel(np.zeros(BUCKETS, np.float32), prior)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            label, bucket, count = samples[i]
            pace = rate * (1 - step / steps)
            step += 1
            if not len(bucket):
                continue
            share = (count / count.sum()).astype(np.float32)
            hidden = share @ vectors[bucket]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= pace * np.outer(hidden, p)
            bias -= pace * p
            vectors[bucket] -= (pace * len(bucket) ** 0.5) * np.outer(share, back)
    return QualityModel((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + prior - float(np.log(n[1] / n[0])))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, max_bytes: int = MAX_TRAIN_BYTES) -> QualityModel:
    """The model of a bounded sample; features are made by the executors, the descent runs in the driver."""
    ship_package(docs.sparkSession)
    rows = training_rows(docs, labels, label, {0: per_class, 1: per_class}, max_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [document_features(t) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("label"), pa.array([b.tobytes() for b, _ in made], pa.binary()), pa.array([c.tobytes() for _, c in made], pa.binary())], ["_id", "label", "buckets", "counts"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    got = sorted((r.label, r._id, bytes(r.buckets), bytes(r.counts)) for r in rows.mapInArrow(run, f"_id {id_type}, label int, buckets binary, counts binary").toLocalIterator())
    samples = [(k, np.frombuffer(b, np.int32), np.frombuffer(c, np.float32)) for k, _, b, c in got]
    return train(samples, label_counts(labels, label))


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """`docs` (or its columns in `keep`) with the score of each whole text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    body = free_name([*docs.columns, score], "body")
    names = list(docs.columns if keep is None else keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in names], text_or_empty(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*shared.value)
        for batch in batches:
            for part in chunks(batch, body, 2 << 20):
                p = 1.0 / (1.0 + np.exp(-np.clip(logits(part.column(body), own), -500, 500)))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], pa.array(p)], [*names, score])

    schema = rows.drop(body).schema
    return rows.mapInArrow(run, schema.add(score, "double"))


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of `docs` whose score is at least the threshold, columns unchanged."""
    score = free_name(docs.columns, "score")
    scored = with_quality(docs, model, text, score)
    return scored.filter(F.col(score) >= threshold).drop(score)
