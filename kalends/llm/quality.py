"""Quality classifier from supervised subword embeddings (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import map_texts


@dataclass(frozen=True)
class Settings:
    """Sizes and rates of the model. ``most_rows`` bounds the labelled rows that training reads, whatever the table's size."""

    buckets: int = 1 << 16
    dims: int = 8
    low: int = 2
    high: int = 4
    most_rows: int = 3000
    epochs: int = 10
    least_steps: int = 400  # small samples are gone through more often
    batch: int = 50
    rate: float = 1.5
    seed: int = 7


ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PART = 50_000  # words that are hashed at once
POWERS = np.cumprod(np.r_[np.uint64(1), np.full(1023, ODD)], dtype=np.uint64)


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32))) * MIX
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def features(text: str | None, setup: Settings):
    """Buckets of a text's hashed words and character n-grams, in arrays for some words at a time.

    N-grams take the space before and after a word as its marks and never reach into the next one. A word that equals the
    one before it also adds the mark of a repeat, one fixed term.
    """
    words, last = (text or "").split(), None
    for k in range(0, len(words), PART):
        part = words[k : k + PART]
        line = f" {' '.join(part)} "
        code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        gap = code == 32
        found = []
        for n in range(setup.low, setup.high + 1):
            gram = np.full(len(code) - n + 1, np.uint64(n))
            whole = np.ones(len(gram), bool)
            for j in range(n):
                gram = gram * ODD + code[j : len(code) - n + 1 + j]
                if 0 < j < n - 1:
                    whole &= ~gap[j : len(code) - n + 1 + j]
            found.append(gram[whole])
        # a word's hash: its characters, each mixed with its place in the word
        starts = np.flatnonzero(gap)[:-1] + 1
        size = np.diff(np.flatnonzero(gap)) - 1
        place = np.arange(len(code)) - np.r_[0, np.repeat(starts, size + 1)]
        value = np.where(gap, np.uint64(0), code * POWERS[place % len(POWERS)] + place.astype(np.uint64) * MIX)
        total = np.cumsum(value, dtype=np.uint64)
        own = total[starts + size - 1] - total[starts - 1]
        found.append(own * ODD + np.uint64(1))
        repeats = int((own[1:] == own[:-1]).sum()) + int(last is not None and last == own[0])
        last = own[-1]
        found.append(np.full(repeats, np.uint64(0)))
        yield _buckets(np.concatenate(found), setup.buckets)


def counted(setup: Settings):
    """Function of texts for ``map_texts``: the buckets of each whole text and how often each occurs, as bytes of 32-bit integers."""

    def make(texts: list[str | None]):
        places, times = [], []
        for text in texts:
            total = np.zeros(setup.buckets, np.int64)
            for found in features(text, setup):
                total += np.bincount(found, minlength=setup.buckets)
            place = np.flatnonzero(total)
            places.append(place.astype("<i4").tobytes())
            times.append(total[place].astype("<i4").tobytes())
        return places, times

    return make


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], setup: Settings) -> tuple[np.ndarray, float]:
    """Fit vectors of buckets and a softmax over their mean by stochastic gradient descent; rows are buckets, their counts and labels.

    The softmax is linear in the mean vector, so a bucket's share of the score is one number: returned are these numbers,
    class 1 against class 0, and the intercept. Reruns on the same rows agree. Without rows all scores are 0.5.
    """
    if not rows:
        return np.zeros(setup.buckets), 0.0
    rng = np.random.default_rng(setup.seed)
    labels, sizes = np.array([y for *_, y in rows], np.int64), np.array([times.sum() for _, times, _ in rows])
    vectors = rng.uniform(-1 / setup.dims, 1 / setup.dims, (setup.dims, setup.buckets))
    weights, bias = rng.normal(0, 0.5, (setup.dims, 2)), np.zeros(2)
    parts = max(1, len(rows) // setup.batch)
    steps = max(setup.epochs * parts, setup.least_steps)
    for step in range(steps):
        if step % parts == 0:
            order = np.array_split(rng.permutation(len(rows)), parts)
        part, rate = order[step % parts], setup.rate * (1 - step / steps)
        flat = np.concatenate([rows[i][0] for i in part])
        times = np.concatenate([rows[i][1] for i in part])
        owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
        per = 1 / np.maximum(sizes[part], 1)
        mean = np.stack([np.bincount(owner, v[flat] * times, len(part)) for v in vectors], axis=1) * per[:, None]
        logits = mean @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(part)), labels[part]] -= 1
        back = (error @ weights.T) * per[:, None]
        weights -= rate * (mean.T @ error) / len(part)
        bias -= rate * error.mean(axis=0)
        for d in range(setup.dims):
            vectors[d] -= rate * setup.dims * np.bincount(flat, back[owner, d] * times, setup.buckets)
    return (weights[:, 1] - weights[:, 0]) @ vectors, float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, setup: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """Train on at most ``most_rows`` labelled rows outside the held-out fifth, the smallest by a hash of their id.

    Rows without id, label or document are left out. Whole texts are counted in Spark tasks; to the driver come the counts
    of at most ``most_rows`` texts, of at most ``buckets`` entries each, whatever the texts' length.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(setup.most_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # one text for an id: the smallest
    chosen = texts.join(known, "id").groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    rows = map_texts(chosen.select("id", "y", "text"), "text", counted(setup), "places binary, times binary").toLocalIterator()
    found = sorted((r.id, bytes(r.places), bytes(r.times), r.y) for r in rows)
    return train([(np.frombuffer(places, "<i4"), np.frombuffer(times, "<i4"), y) for _, places, times, y in found], setup)


def held_out(id_col):
    """Whether a row belongs to the fifth that training must not read."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model, setup: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, *, others: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text: ``doc_id``, ``held_out``, ``score`` from 0 to 1 and ``predicted`` (1 from the threshold on).

    One row per row of ``docs`` with the columns ``others`` as they are, without a shuffle; the model has a fixed size and is broadcast. Texts without words, null
    among them, get the score of the intercept. Other columns are not read; labels never are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str | None]):
        share, bias = shared.value
        out = []
        for text in texts:
            total = count = 0
            for found in features(text, setup):
                total, count = total + share[found].sum(), count + len(found)
            out.append(float(1 / (1 + np.exp(-(bias + total / max(count, 1))))))
        return (out,)

    base = docs.select(F.col(id_col).alias("doc_id"), *(c for c in others if c != text_col), F.col(text_col).alias("text"), F.col(text_col).alias("_text"))
    if text_col not in others:
        base = base.drop("text")
    scored = map_texts(base, "_text", make, "score double")
    return scored.select("doc_id", *others, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
