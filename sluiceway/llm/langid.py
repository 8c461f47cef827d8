"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

A text's n-grams are drawn from a mixture of languages.  Expectation-maximisation estimates the
proportions; sets of one, two, ... languages, by falling proportion, are compared by likelihood less a penalty for
each language, and the growing set is kept while it pays.

N-gram likelihoods come from rows whose crc32(doc_id) mod 5 is not 0, on a bounded sample: of each language the
SAMPLE_ROWS texts of at most SAMPLE_CHARS with the smallest hash of their id.  If there are fewer, longer texts fill up,
shortest first, while the language's sample stays within SAMPLE_TOTAL characters; a language that would have none takes its
shortest text, up to SAMPLE_TOTAL.  More than MAX_LANGUAGES languages are refused, as the model (128 KB each) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.ngrams import grams, pieces
from sluiceway.llm.toxicity import choose, held_out

BITS = 14
LOW, HIGH = 1, 3
SAMPLE_ROWS = 800
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 4_000_000
MAX_LANGUAGES = 256
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 6.0  # log-likelihood a further language must add, per log of the n-gram count
UNDETERMINED = "und"


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams and how often each occurs; long texts are counted in pieces."""
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    counts = np.zeros(1 << BITS, np.int64)
    for piece in pieces(text):
        counts += np.bincount(grams(piece, LOW, HIGH, BITS)[0], minlength=1 << BITS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets].astype(float)


def fit(texts: list[str], langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Language names and their log-likelihoods of every bucket."""
    return fit_rows(zip(texts, langs))


def fit_rows(rows: Iterable[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
    """`fit` of (text, lang) one by one; only counts are kept."""
    counts: dict[str, np.ndarray] = {}
    for text, lang in rows:
        buckets, n = bag(text)
        counts.setdefault(lang, np.full(1 << BITS, SMOOTHING))[buckets] += n
    names = sorted(counts)
    table = np.array([counts[x] for x in names]).reshape(len(names), 1 << BITS)
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def proportions(logs: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Mixture proportions of the languages in `logs` (languages x n-grams) and the log-likelihood."""
    if len(logs) == 1:
        return np.ones(1), float(logs[0] @ counts)
    top = logs.max(axis=0)
    likely = np.exp(logs - top)
    mix = np.full(len(logs), 1.0 / len(logs))
    total = counts.sum()
    for _ in range(rounds):
        weights = counts / (mix @ likely)
        new = mix * (likely @ weights) / total
        moved, mix = np.abs(new - mix).max(), new
        if moved < 1e-4:
            break
    return mix, float(counts @ (np.log(mix @ likely) + top))


def mixture(text: str | None, logs: np.ndarray) -> dict[int, float]:
    """Languages of a text with their proportions, most first; ties go to the first name."""
    buckets, counts = bag(text)
    if not len(buckets):
        return {}
    logs = logs[:, buckets]
    single = logs @ counts
    everything, _ = proportions(logs, counts)
    first = int(np.argmax(single))
    ranked = [first] + [int(i) for i in np.argsort(-everything, kind="stable") if i != first]
    chosen, share, best = [first], np.ones(1), float(single[first])
    step = PENALTY * np.log(counts.sum() + 1.0)
    for i in ranked[1:]:
        mix, value = proportions(logs[[*chosen, i]], counts)
        if value - step <= best:
            break
        chosen, share, best = [*chosen, i], mix, value - step
    order = np.argsort(-share, kind="stable")
    return {chosen[i]: float(share[i]) for i in order}


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predict(text: str | None, names: list[str], logs: np.ndarray) -> tuple[str, float, str]:
    """Main language, its proportion, and the whole mixture as text."""
    if not text or not names or not has_letter(text):
        return UNDETERMINED, 0.0, ""
    found = mixture(text, logs)
    if not found:
        return UNDETERMINED, 0.0, ""
    main = next(iter(found))
    return names[main], min(1.0, found[main]), ",".join(f"{names[i]}:{p:.3f}" for i, p in found.items())


def training_sample(
    docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL, languages: int = MAX_LANGUAGES
) -> DataFrame:
    """(text, lang) of the bounded sample; chosen by narrow columns, so that texts move only once chosen."""
    if docs.select("lang").where("lang IS NOT NULL").distinct().limit(languages + 1).count() > languages:
        raise ValueError(f"more than {languages} languages")
    known = docs.select("doc_id", "lang", F.length("text").alias("size")).where("lang IS NOT NULL AND doc_id IS NOT NULL AND size > 0")
    chosen = choose(known.where(~held_out(F.col("doc_id"))), "lang", rows, chars, total)
    texts = docs.select("doc_id", "lang", "text", F.length("text").alias("size"))
    found = texts.join(F.broadcast(chosen), ["doc_id", "lang", "size"], "left_semi")
    found = found.withColumn("text", F.substring("text", 1, max(chars, total)))
    return found.orderBy("doc_id", "lang", "text").select("text", "lang")


def language_of(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, languages.

    score is the proportion of lang_pred in the text's mixture, `languages` the whole mixture.  Null texts, texts
    without letters, and all texts when there is nothing to learn from are 'und' with score 0.  More than MAX_LANGUAGES
    lang values are an error.  Whole texts are read, very long ones piece by piece; rows are independent, repeated rows are predicted alike.  Null lang values are not learned from; other
    columns are not read.
    """
    names, logs = fit_rows(training_sample(docs).toLocalIterator())
    shared = docs.sparkSession.sparkContext.broadcast(logs)  # 128 KB per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            found = [predict(t.as_py(), names, table) for t in batch.column(2)]
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.string())],
                ["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages string")
