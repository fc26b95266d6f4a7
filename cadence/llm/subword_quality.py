"""Quality by supervised subword embeddings (operator 3).

A text is a bag of hashed n-grams: bytes (3 and 4, case kept, with the white
space around words), single words, and pairs of neighbouring words.  A pair of
equal words, next to each other or one apart, is written as a back reference,
so repetition is one feature whatever the word.  Every n-gram has a learned
vector; a document is the average of its n-grams' vectors, and a softmax layer
turns that into the probabilities of the two labels.  Numpy stochastic
gradient descent learns vectors and layer together.

Training uses at most ``SAMPLE_DOCS`` labelled documents outside the held-out
fold (half of each label), whole texts; their n-gram counts are gathered by
many tasks and learned from in one, whose memory the sample bounds.  Learning
is repeatable: rows are sorted and the random numbers seeded, so a lost
executor changes nothing.  As the layers are linear, a trained model is one
number for each bucket, which is broadcast (a fixed size); scoring is a map
over the documents without a shuffle.

Null and empty texts have no n-gram and get the model's score of an empty
average.  Without labels of both kinds the score is the smoothed share of
label 1 for every text.  Equal texts get equal scores; other columns are left
behind unless named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.labelled import fold, labelled_texts, sample_labels
from cadence.llm.text import SpanHashes, as_bytes, bound_batches, buffers, mix, only, with_fields, word_spans

SAMPLE_DOCS = 6000
FOLDS, HELD_OUT = 3, 1
BUCKET_BITS = 17
SIZES = (3, 4)
DIMENSION = 8
EPOCHS = 6
RATE = 0.3


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(document number, bucket) arrays of all n-grams of a buffer of texts."""
    hashes = SpanHashes(data)
    segment = np.repeat(np.arange(len(starts)), ends - starts + 1)
    room = np.repeat(ends + 1, ends - starts + 1) - np.arange(len(data))
    for size in SIZES:
        found = hashes.grams(size)
        inside = room[:len(found)] >= size
        yield segment[:len(found)][inside], (found[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    begin, end = word_spans(data)
    if not len(begin):
        return
    words = hashes.spans(begin, end)
    owner = segment[begin]
    yield owner, _buckets(words, 1)
    for apart in (1, 2):
        same_text = owner[apart:] == owner[:-apart]
        left, right = words[:-apart], words[apart:]
        if apart == 1:
            pair = np.where(left == right, np.uint64(apart), left * np.uint64(3) + right)
        else:
            same_text &= left == right
            pair = np.full(len(left), apart, np.uint64)
        yield owner[apart:][same_text], _buckets(pair[same_text], 1 + apart)


def bags(texts: list[bytes]):
    """(buckets, shares) of each text: its distinct n-grams and their share of all."""
    for first, last, data, starts, ends in buffers(texts):
        parts = list(grams(data, starts, ends))
        owner = np.concatenate([p[0] for p in parts])
        bucket = np.concatenate([p[1] for p in parts])
        key, count = np.unique((owner << BUCKET_BITS) | bucket, return_counts=True)
        cuts = np.searchsorted(key >> BUCKET_BITS, np.arange(last - first + 1))
        for a, b in zip(cuts, cuts[1:]):
            yield key[a:b] & ((1 << BUCKET_BITS) - 1), count[a:b] / max(1, count[a:b].sum())


def train(bag_list, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7):
    """(value of each bucket, bias): the trained layers, folded into one."""
    n1 = int(labels.sum())
    if n1 in (0, len(labels)):
        return np.zeros(1 << BUCKET_BITS, np.float32), float(np.log((n1 + 1) / (len(labels) - n1 + 1)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSION)).astype(np.float32) / DIMENSION
    layer = rng.uniform(-1, 1, (DIMENSION, 2)).astype(np.float32) / DIMENSION
    bias = np.zeros(2, np.float32)
    weight = len(labels) / (2.0 * np.array([len(labels) - n1, n1]))
    steps, step = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            now = rate * (1 - step / steps)
            step += 1
            buckets, shares = bag_list[i]
            shares = shares.astype(np.float32)
            hidden = shares @ vectors[buckets] if len(buckets) else np.zeros(DIMENSION, np.float32)
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weight[labels[i]]
            back = layer @ p
            layer -= now * np.outer(hidden, p)
            bias -= now * p
            if len(buckets):
                # The step along the average, whatever the length of the text.
                vectors[buckets] -= (now / float(shares @ shares)) * np.outer(shares, back)
    side = layer[:, 1] - layer[:, 0]
    return (vectors @ side).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", folds: int = FOLDS,
        held_out: int = HELD_OUT, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
        text_col: str = "text") -> tuple[np.ndarray, float]:
    """Train on a bounded sample of the labelled documents."""
    bound_batches(docs.sparkSession)
    sample = sample_labels(labels, target, folds, held_out, sample_docs, id_col)
    texts = labelled_texts(docs, sample, id_col, text_col)

    def gather(batches):
        for batch in batches:
            found = list(bags(as_bytes(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2),
                 pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                 pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32()))],
                ["id", "label", "buckets", "shares"])

    def learn(batches):
        ids, found, marks = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
            for b, s in zip(batch.column(2), batch.column(3)):
                found.append((b.values.to_numpy(), s.values.to_numpy()))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], len(found[i][0]), found[i][0].tobytes()))
        values, bias = train([found[i] for i in order], np.array([marks[i] for i in order], np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([values.astype("<f4").tobytes()], pa.binary()), pa.array([bias], pa.float64())],
            ["weights", "bias"])

    gathered = texts.mapInArrow(gather, "id string, label int, buckets array<int>, shares array<float>")
    row = gathered.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    if row is None:
        return np.zeros(1 << BUCKET_BITS, np.float32), 0.0
    return np.frombuffer(row.weights, "<f4"), row.bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, *keep, score): the probability of label 1 for every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        values, bias = shared.value
        for batch in batches:
            scores = []
            for first, last, data, starts, ends in buffers(as_bytes(batch.column(1))):
                sums, counts = np.zeros(last - first), np.zeros(last - first)
                for owner, bucket in grams(data, starts, ends):
                    sums += np.bincount(owner, values[bucket], minlength=last - first)
                    counts += np.bincount(owner, minlength=last - first)
                scores.append(1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + bias, -50, 50))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [*batch.schema.names, "score"])

    rows = only(docs, id_col, text_col, *keep)
    return rows.mapInArrow(run, with_fields(rows, score="double"))


def quality_scores(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (),
                   sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, text, *keep, held_out, score, predicted) for every document."""
    scored = score(docs, fit(docs, labels, sample_docs=sample_docs), keep=keep)
    return scored.select(*[c for c in scored.columns if c != "score"],
                         F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
