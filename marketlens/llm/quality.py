"""Quality rules: counted text faults, then a hashed n-gram logistic regression.

The counted base rejects short and repetitive texts. The model reads every word of a text as hashed
word unigrams and bigrams and every character as hashed trigrams; each group enters as relative
frequencies, so length does not matter. It is fitted on at most `FIT_ROWS` labelled documents of the
table, those with the least hash of doc_id and of a repeated doc_id one text, two thirds for the
weights and one third for Platt's calibration, which stays the nearer to the raw score the fewer
rows it has.
A text is kept when its calibrated probability of good quality reaches `THRESHOLD`.

Features of the sample are made on the executors; the driver fits the bounded sample with numpy. All
rows are scored in Arrow batches by the broadcast weights, `2 ** BITS` floats whatever the input.

Null and empty texts have no words and fail the base. Repeated rows are judged alike. Without
labelled rows of both classes the model passes everything and the base decides. A null doc_id is
judged but never a training row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import table
from marketlens.llm.words import Words, gram_rows, grams, mix, slices

BITS = 17
FIT_ROWS = 2400
THRESHOLD = 0.3
ROUNDS = 120
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True
_WORD, _PAIR, _CHAR = 0.45, 0.2, 0.35

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass
class Model:
    """Weights by hashed feature, intercept, and the calibration of the raw score."""

    weights: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicate_lines(texts: list[bytes]) -> list[int]:
    counts = []
    for text in texts:
        lines = text.split(b"\n")
        found = 0
        if len(set(lines)) < len(lines):
            seen = set()
            for line in lines:
                if line in seen:
                    found += bool(line.split())
                else:
                    seen.add(line)
        counts.append(found)
    return counts


def base_counts(words: Words) -> dict[str, np.ndarray]:
    """The five counted columns of each row."""
    data = words.data
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    np.subtract.at(inside, words.ends, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    hashes = words.hashes()
    whole = gram_rows(words, 3)
    keys = (grams(hashes, 3) ^ mix(words.rows()[:len(whole)].astype(np.uint64)))
    order = np.argsort(keys[whole], kind="stable")
    ranked = keys[whole][order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(ranked), bool)
    twice[order] = np.concatenate((same, [False])) | np.concatenate(([False], same)) \
        if len(ranked) else False
    covered = np.zeros(len(words.starts), bool)
    at = np.flatnonzero(whole)[twice]
    for step in range(3):
        covered[at + step] = True
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:])]
    return {
        "n_words": words.counts,
        "word_chars": _per_row(inside & ~_CONTINUES[data], words.offsets),
        "n_symbols": _per_row(_SYMBOL[data], words.offsets),
        "n_dup_lines": np.array(_duplicate_lines(texts), np.int64),
        "n_repeat_words": _per_row(covered, words.bounds),
    }


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed feature and weight of every word, word pair and character trigram."""
    top = np.uint64(64 - BITS)
    hashes, rows = words.hashes(), words.rows()
    pair = gram_rows(words, 2)
    pairs, pair_rows = grams(hashes, 2)[pair], rows[:len(pair)][pair]
    raw, offsets = words.data.tobytes(), words.offsets
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    char_rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    n = max(len(points) - 2, 0)
    whole = char_rows[:n] == char_rows[2:2 + n]
    chars, char_rows = grams(points, 3)[whole], char_rows[:n][whole]
    parts = []
    for kind, (values, owner, share) in enumerate(
            ((hashes, rows, _WORD), (pairs, pair_rows, _PAIR), (chars, char_rows, _CHAR))):
        bucket = (mix(values + np.uint64(kind)) >> top).astype(np.int64)
        sizes = np.bincount(owner, minlength=len(words.counts))
        parts.append((owner, bucket, (share / np.maximum(sizes, 1))[owner]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Features of at most `rows` labelled documents of the table, one row for each doc_id."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("y"))
    present = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    met = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, bucket, value = features(Words.of(part.column("text")))
                keys, at = np.unique(owner << BITS | bucket, return_inverse=True)
                sums = np.bincount(at, value, len(keys)).astype(np.float32)
                bounds = np.searchsorted(keys >> BITS, np.arange(part.num_rows + 1))
                cells = keys & ((1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"),
                     pa.ListArray.from_arrays(bounds.astype(np.int32),
                                              pa.array(cells.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(sums))],
                    ["doc_id", "y", "buckets", "amounts"])

    return met.mapInArrow(run, "doc_id long, y int, buckets array<int>, amounts array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _held(y: np.ndarray) -> np.ndarray:
    """Every third row for calibration, counted by class where a part would lack a class."""
    held = np.arange(len(y)) % 3 == 2
    if all(0 < part.sum() < len(part) for part in (y[held], y[~held])):
        return held
    for kind in (0, 1):
        rows = np.flatnonzero(y == kind)
        held[rows] = np.arange(len(rows)) % 3 == 2
    return held


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit and calibrate on a bounded sample; see the module's text."""
    found = _sample(docs, labels, rows).toArrow().sort_by("doc_id").combine_chunks()
    model = Model(np.zeros(1 << BITS, np.float32))
    y = found["y"].to_numpy().astype(np.float64)
    if not 0 < y.sum() < len(y):
        return model
    owner = np.repeat(np.arange(len(y), dtype=np.int32),
                      pc.list_value_length(found["buckets"]).to_numpy())
    cell = pc.list_flatten(found["buckets"]).to_numpy()
    value = pc.list_flatten(found["amounts"]).to_numpy()
    del found
    held = _held(y)
    use = ~held[owner]
    balance = np.where(y > 0, 0.5 / max(y[~held].mean(), 1e-9),
                       0.5 / max(1 - y[~held].mean(), 1e-9)) * ~held
    o, c, v = owner[use], cell[use], value[use]
    w, b, total = np.zeros(1 << BITS), 0.0, np.full(1 << BITS, 1e-8)
    for _ in range(ROUNDS):  # adaptive gradient descent on the balanced logistic loss
        z = np.bincount(o, w[c] * v, len(y)) + b
        error = (_sigmoid(z) - y) * balance
        step = np.bincount(c, error[o] * v, 1 << BITS) / len(y) + 1e-9 * w
        total += step * step
        w -= 4.0 * step / np.sqrt(total)
        b -= 0.5 * error.sum() / len(y)
    z = np.bincount(owner, w[cell] * value, len(y)) + b
    slope, shift = 1.0, 0.0
    pull = max(1e-3, 1e-3 * FIT_ROWS / 3 / max(held.sum(), 1))  # grows as held rows get fewer
    for _ in range(300 * bool(held.any())):  # Platt: the held third as a logistic of its score
        p = _sigmoid(slope * z[held] + shift)
        error, curve = p - y[held], p * (1 - p) + 1e-6
        grad = np.array([(error * z[held]).mean() + pull * (slope - 1),
                         error.mean() + (pull - 1e-3) * shift])
        hess = np.array([[(curve * z[held] ** 2).mean() + pull, (curve * z[held]).mean()],
                         [(curve * z[held]).mean(), curve.mean() + 1e-6 + pull - 1e-3]])
        move = np.linalg.solve(hess, grad)
        slope, shift = slope - move[0], shift - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return Model(w.astype(np.float32), b, float(slope), float(shift))


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """Kept columns, the base counts, base_failed, `p_good` and `kept`, in Arrow batches."""
    keep = ["doc_id"] if keep is None else keep
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep],
                         F.col("text").cast("string").alias("_judged"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, "_judged"):
                words = Words.of(part.column(part.num_columns - 1))
                base = base_counts(words)
                owner, bucket, value = features(words)
                z = np.bincount(owner, known.weights[bucket] * value, part.num_rows)
                z = known.slope * (z + known.intercept) + known.shift
                fitted = bool(known.weights.any())
                good = _sigmoid(z) if fitted else np.ones(part.num_rows)
                n, repeated = base["n_words"], base["n_repeat_words"]
                failed = (n < MIN_WORDS) | (100 * repeated > 50 * n)
                made = [pa.array(base[c].astype(np.int64)) for c in BASE]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *made, pa.array(failed), pa.array(good),
                     pa.array(~failed & (good >= threshold))],
                    [*keep, *BASE, "base_failed", "p_good", "kept"])

    fields = chosen.drop("_judged")
    for name in BASE:
        fields = fields.withColumn(name, F.lit(0).cast("long"))
    fields = fields.withColumns({"base_failed": F.lit(True), "p_good": F.lit(0.0),
                                 "kept": F.lit(True)})
    return chosen.mapInArrow(run, fields.schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns whatever these are called."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)],
                        F.col("text").cast("string").alias("text"))
    judged = judge(plain, model, threshold, [f"_k{i}" for i in range(len(names))])
    return judged.where("kept").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
