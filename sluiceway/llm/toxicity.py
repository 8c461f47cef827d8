"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (3 to 6, with its boundaries), so an unseen spelling
shares most of its vector with known ones.  A passage is the mean of WINDOW consecutive words and goes
through the softmax; a text scores as its most toxic passage, so length does not dilute it.

Only rows whose crc32(doc_id) mod 5 is not 0 are learned from, on a bounded sample: of each label the SAMPLE_ROWS
texts of at most SAMPLE_CHARS with the smallest hash of their id.  If there are fewer, longer texts fill up, shortest
first, while the label's sample stays within SAMPLE_TOTAL characters.  A label that would have none takes its
shortest text, up to SAMPLE_TOTAL.
Scoring reads whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceway.llm.graph import store
from sluiceway.llm.ngrams import grams, pieces

BITS, DIM = 17, 16
LOW, HIGH = 3, 6
WINDOW = 3
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 8000
SAMPLE_TOTAL = 4_000_000
SEED = 5


class Model(NamedTuple):
    vectors: np.ndarray  # one per n-gram bucket
    weights: np.ndarray  # one per class
    bias: float
    scale: float  # calibration of a text's best passage
    offset: float

    def bucket_scores(self) -> np.ndarray:
        """Share of each bucket in the difference of the two classes' inputs; vectors and weights folded."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float32)


def word_means(scores: np.ndarray, text: str) -> np.ndarray:
    """Mean score of the n-grams of each word; long texts are read in pieces."""
    found = [_piece_means(scores, piece) for piece in pieces(text)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _piece_means(scores: np.ndarray, text: str) -> np.ndarray:
    buckets, owners, count = grams(text, LOW, HIGH, BITS)
    if not count:
        return np.zeros(0)
    sums = np.bincount(owners, weights=scores[buckets], minlength=count)
    return sums / np.maximum(np.bincount(owners, minlength=count), 1)


def passages(words: np.ndarray) -> np.ndarray:
    """Mean over each run of WINDOW words; a shorter text is one passage."""
    size = min(WINDOW, len(words))
    if not size:
        return np.zeros(0)
    sums = np.concatenate(([0.0], np.cumsum(words)))
    return (sums[size:] - sums[:-size]) / size


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(texts: list[str], labels: list[int], epochs: int = 10, batch: int = 32, rate: float = 0.6) -> Model:
    """Train vectors and softmax together.

    The loss is over passages: in texts of label 0 all passages are clean; in the others, after a first
    round in which all count, only the passages that score highest are toxic.  Both labels weigh the same.  The gradient
    of a bucket's vector is a number times the difference of the class weights, so it is gathered as one
    count per bucket.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIM))
    weights = rng.normal(0, 0.5, (2, DIM))
    squares, bias = np.full(1 << BITS, 1e-8), 0.0
    labels = np.asarray(labels)
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(vectors * 0, weights, float(np.log(share / (1 - share))), 1.0, 0.0)
    bags = [grams(t, LOW, HIGH, BITS) for t in texts]
    bags = [(b.astype(np.int32), o.astype(np.int32), c) for b, o, c in bags]
    balance = {1: 0.5 / labels.mean(), 0: 0.5 / (1 - labels.mean())}
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            scores = vectors @ (weights[1] - weights[0])
            touched_by, parts, bias_gradient = [], [], 0.0
            for i in order[at : at + batch]:
                buckets, owners, count = bags[i]
                if not count:
                    continue
                sizes = np.maximum(np.bincount(owners, minlength=count), 1)
                logits = passages(np.bincount(owners, weights=scores[buckets], minlength=count) / sizes) + bias
                error = _sigmoid(logits) - labels[i]
                top = np.argsort(-logits)[:2]
                share = np.zeros(len(logits))
                share[top] += 0.5 / len(top)
                if labels[i] == 0 or epoch < 2:
                    share += 0.5 / len(logits)
                error *= share * balance[int(labels[i])]
                size = min(WINDOW, count)
                padded = np.concatenate((np.zeros(size - 1), error, np.zeros(size - 1)))
                sums = np.concatenate(([0.0], np.cumsum(padded)))
                per_word = (sums[size:] - sums[:-size]) / size / sizes
                touched_by.append(buckets)
                parts.append(per_word[owners])
                bias_gradient += error.sum()
            if not parts:
                continue
            gradient = np.bincount(np.concatenate(touched_by), weights=np.concatenate(parts), minlength=1 << BITS)
            touched = np.flatnonzero(gradient)
            direction = weights[1] - weights[0]
            step = gradient[touched]
            squares[touched] += step * step
            toward = vectors[touched].T @ step
            vectors[touched] -= (rate * step / np.sqrt(squares[touched]))[:, None] * (direction / np.linalg.norm(direction))
            weights[1] -= 0.02 * toward / batch
            weights[0] += 0.02 * toward / batch
            bias -= 0.1 * bias_gradient / batch
    model = Model(vectors, weights, float(bias), 1.0, 0.0)
    return _calibrated(model, texts, labels)


def _calibrated(model: Model, texts: list[str], labels: np.ndarray) -> Model:
    """Logistic fit of the label on a text's best passage; the middle of a clean split scores one half."""
    scores = model.bucket_scores()
    best = np.array([passages(word_means(scores, t)).max(initial=-20.0) + model.bias for t in texts])
    best = np.clip(best, -20, 20)
    center, spread = best.mean(), best.std() + 1e-9
    x, a, b = (best - center) / spread, 1.0, 0.0
    target = np.where(labels == 1, 0.98, 0.02)
    for _ in range(300):
        error = _sigmoid(a * x + b) - target
        a -= 2.0 * (error * x).mean()
        b -= 2.0 * error.mean()
    return model._replace(scale=float(a / spread), offset=float(b - a * center / spread))


def score_text(text: str | None, scores: np.ndarray, bias: float, scale: float, offset: float) -> float:
    """Probability of label 1; a text without words scores as the least toxic passage would."""
    best = passages(word_means(scores, text)) if text else np.zeros(0)
    top = np.clip(best.max() + bias, -20, 20) if len(best) else -20.0
    return float(_sigmoid(scale * top + offset))


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def choose(known: DataFrame, group: str, rows: int, chars: int, total: int) -> DataFrame:
    """Rows (doc_id, group, size) of the bounded sample: short texts by hash of the id, then long ones by size.

    No group is gathered in one task: the number of short texts per group tells below which hash the wanted ones lie, so
    each task picks its share by itself, and the driver orders what comes in, about `rows` for each group.
    Of long texts at most total / chars can fit, which Spark cuts to inside the tasks, too.
    """
    spark = known.sparkSession
    known = store(known.select("doc_id", group, "size"), "sample-pool")
    counts = known.groupBy(group).agg(F.count_if(F.col("size") <= chars).alias("short")).collect()
    kind, key = known.schema[group].dataType.simpleString(), F.xxhash64("doc_id").alias("hash")
    found: dict = {r[group]: [] for r in counts}
    margin, open_groups = 1.3, {r[group]: r["short"] for r in counts if r["short"]}
    while open_groups:
        cuts = [(g, -(2**63) + min(int(2**64 * (margin * rows + 100) / n), 2**64 - 1)) for g, n in open_groups.items()]
        cuts = F.broadcast(spark.createDataFrame(cuts, f"{group} {kind}, cut long"))
        picked = known.where(F.col("size") <= chars).join(cuts, group).withColumn("hash", key).where("hash <= cut")
        for g in open_groups:
            found[g] = []
        for r in picked.select("hash", "doc_id", "size", group).collect():
            found[r[group]].append(tuple(r)[:3])
        open_groups = {g: n for g, n in open_groups.items() if len(found[g]) < min(rows, n)}  # hashes lie unevenly
        margin *= 2
    chosen = []
    few = [g for g in found if len(found[g]) < rows]
    longer: dict = {g: [] for g in few}
    if few:
        room = total // max(chars, 1) + 2
        order = Window.partitionBy(group).orderBy("size", "hash", "doc_id")
        long = known.where((F.col("size") > chars) & F.col(group).isin(few)).withColumn("hash", key)
        long = long.withColumn("place", F.row_number().over(order)).where(F.col("place") <= room)
        for r in long.orderBy("place").select("hash", "doc_id", "size", group).collect():
            longer[r[group]].append(tuple(r)[:3])
    for g in found:
        so_far, place = 0, 0
        for _, doc_id, size in (sorted(found[g]) + longer.get(g, []))[:rows]:
            so_far, place = so_far + size, place + 1
            if size <= chars or place == 1 or so_far <= total:
                chosen.append((doc_id, g, size))
    return spark.createDataFrame(sorted(set(chosen)), f"doc_id {known.schema['doc_id'].dataType.simpleString()}, {group} {kind}, size int")


def training_sample(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL
) -> list:
    """(text, label) of the bounded sample; chosen by narrow columns, so that texts move only once chosen."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    sizes = docs.select("doc_id", F.length("text").alias("size")).where("size > 0")
    chosen = choose(sizes.join(known.distinct(), "doc_id"), "toxic", rows, chars, total)
    texts = docs.select("doc_id", "text", F.length("text").alias("size"))
    found = texts.join(F.broadcast(chosen), ["doc_id", "size"]).withColumn("text", F.substring("text", 1, max(chars, total)))
    return found.orderBy("doc_id", "text", "toxic").select("text", "toxic").collect()


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null, empty and wordless texts score lowest; very long ones are read whole, piece by piece.  Rows are scored independently; repeated rows score alike.  Without
    labels of both kinds every text scores the share of label 1.  Null labels are not learned from.
    Other columns are not read.
    """
    sample = training_sample(docs, labels)
    model = fit([r["text"] for r in sample], [r["toxic"] for r in sample])
    shared = docs.sparkSession.sparkContext.broadcast(model.bucket_scores())  # fixed size, 512 KB
    numbers = model.bias, model.scale, model.offset

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            values = [score_text(t.as_py(), table, *numbers) for t in batch.column(2)]
            flags = [int(v >= 0.5) for v in values]
            columns = [batch.column(0), batch.column(1), pa.array(values, pa.float64()), pa.array(flags, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
