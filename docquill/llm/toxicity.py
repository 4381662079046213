"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character 3- to 5-grams, hashed to BUCKETS embeddings, so a
misspelling that was never seen shares most of its vectors with the word that was. A bag of words
is the mean of its words, a softmax layer turns that into class probabilities. A document is scored
by its worst stretch of WINDOW words, as a few words in a long text make it toxic.

Embeddings and softmax are trained together by full-batch Adam: first on a random long stretch of each
document in each step, then on the stretch of each document that scores highest at the time, for both classes. The sample has at
most about `max_rows` labelled rows, a share of each class, chosen by a hash of the id; of a text of more than
`max_chars` characters a random stretch of that length is learned from. This bounds what the driver holds. Scoring reads every whole text where it
lies. As the layer is linear, a task needs one number per bucket.

Cases: null or empty text, or one without words, scores 0; a text shorter than a
stretch is one stretch; of conflicting labels for an id the highest counts, null labels don't; equal texts get
equal scores; with one class or none to learn from all scores are 0; an empty table stays empty;
only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mixed, pieces, text_of

BUCKETS, DIM, WINDOW, EARLY_WINDOW = 1 << 16, 4, 2, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EDGE = ".,;:!?\"'()[]{}|<>*_~-"
#: Words whose score a task remembers before it starts anew.
MEMORY = 200_000
#: Text bytes scored at a time.
BATCH_BYTES = 2 << 20


def words(text: str) -> list[str]:
    return [w for raw in text.lower().split() if (w := raw.strip(_EDGE))]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of their 3- to 5-grams, with marks at a word's ends; for each the word's place."""
    length = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.cumsum(length) - length
    word = np.repeat(np.arange(len(words)), length)
    whole = mixed(codes + (np.arange(len(codes)) - first[word]).astype(np.uint64) * _ODD)
    buckets, places = [mixed(np.add.reduceat(whole, first))], [np.arange(len(words))]
    gram = codes
    for n in (2, 3, 4, 5):
        gram = gram[: len(codes) - n + 1] * _ODD + codes[n - 1 :]
        if n > 2:
            inside = word[: len(gram)] == word[n - 1 :]
            buckets.append(mixed(gram[inside] + np.uint64(n)))
            places.append(word[: len(gram)][inside])
    return (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int32), np.concatenate(places).astype(np.int32)


@dataclass
class Model:
    """Log odds of class 1: one number per bucket and the rest."""

    odds: np.ndarray
    bias: float
    learned: bool

    def of(self, words: list[str]) -> np.ndarray:
        """The words' log odds, means over their buckets."""
        buckets, word = subwords(words)
        return np.bincount(word, self.odds[buckets], len(words)) / np.bincount(word, minlength=len(words))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.seen = model, {}

    def score(self, text: str) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str]) -> list[float]:
        """The texts' scores; words that are new to the task are looked up together."""
        if not self.model.learned:
            return [0.0] * len(texts)
        split = [words(t) for t in texts]
        if len(self.seen) > MEMORY:
            self.seen = {}
        if new := list({w for own in split for w in own}.difference(self.seen)):
            self.seen.update(zip(new, self.model.of(new).tolist(), strict=True))
        worst = [stretch_means(np.array([self.seen[w] for w in own])).max() + self.model.bias if own else -np.inf for own in split]
        return (1 / (1 + np.exp(-np.clip(worst, -30, 30))) * np.isfinite(worst)).tolist()


def stretch_means(x: np.ndarray) -> np.ndarray:
    """Mean of each WINDOW consecutive values, of all if there are fewer."""
    n = min(WINDOW, len(x))
    total = np.concatenate([[0.0], np.cumsum(x)])
    return (total[n:] - total[:-n]) / n


def train(texts: list[str], labels: np.ndarray, early: int = 20, late: int = 40, rate: float = 0.1) -> Model:
    """A model of texts and their 0/1 labels."""
    docs = [(words(t), y) for t, y in zip(texts, labels, strict=True)]
    docs = [(w, y) for w, y in docs if w]
    y = np.array([y for _, y in docs], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0, False)
    place: dict[str, int] = {}
    tokens = np.array([place.setdefault(w, len(place)) for own, _ in docs for w in own], np.int64)
    sizes = np.array([len(w) for w, _ in docs])
    starts = np.cumsum(sizes) - sizes
    gram, of_word = subwords(list(place))
    width = np.bincount(of_word, minlength=len(place))
    rng = np.random.default_rng(7)
    params = [rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((2, DIM)), np.zeros(2)]
    params[1][1], params[1][0] = 0.1, -0.1
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for step in range(1, early + late + 1):
        embed, soft, bias = params
        vectors = np.stack([np.bincount(of_word, embed[gram, k], len(place)) for k in range(DIM)], 1) / width[:, None]
        if step <= early:
            size = np.minimum(sizes, EARLY_WINDOW)
            begin = starts + (rng.random(len(sizes)) * (sizes - size + 1)).astype(np.int64)
        else:
            odds = vectors @ (soft[1] - soft[0])
            at = [int(stretch_means(odds[tokens[a : a + n]]).argmax()) for a, n in zip(starts, sizes, strict=True)]
            begin, size = starts + np.array(at), np.minimum(sizes, WINDOW)
        spots = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        bag, used = np.repeat(np.arange(len(size)), size), tokens[spots]
        edge = np.cumsum(size) - size
        means = np.add.reduceat(vectors[used], edge) / size[:, None]
        logits = means @ soft.T + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y.astype(int)] -= 1
        p *= weight[:, None]
        to_mean = (p @ soft) / size[:, None]
        to_word = np.stack([np.bincount(used, to_mean[bag, k], len(place)) for k in range(DIM)], 1) / width[:, None]
        slopes = [np.stack([np.bincount(gram, to_word[of_word, k], BUCKETS) for k in range(DIM)], 1), p.T @ means + 1e-4 * soft, p.sum(0)]
        for p_, m, g in zip(params, moments, slopes, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            p_ -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    embed, soft, bias = params
    return Model((embed @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]), True)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    max_rows: int = 3000,
    share: float = 0.4,
    max_chars: int = 20_000,
) -> Model:
    """A model of the documents that have a label; `share` of the sample is of class 1."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y")).where("_key is not null and _y in (0, 1)")
    known = known.groupBy("_key").agg(F.max("_y").alias("_y"))
    sizes = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, False)
    part = F.when(F.col("_y") == 1, share * max_rows / sizes[1]).otherwise((1 - share) * max_rows / sizes[0])
    chosen = known.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) / float(1 << 20) < part).limit(max_rows + max_rows // 3)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text is not null")
    begin = F.pmod(F.xxhash64("_text", "_key"), F.greatest(F.length("_text") - max_chars, F.lit(0)) + 1).cast("int")
    rows = rows.withColumn("_text", F.substring("_text", begin + 1, F.lit(max_chars)))
    # At most max_rows and a third narrow rows on the broadcast side.
    rows = rows.join(F.broadcast(chosen), "_key").limit(2 * max_rows).select("_key", "_text", "_y").toPandas()
    rows = rows.sort_values(["_key", "_text"], kind="stable")
    return train(rows["_text"].tolist(), rows["_y"].to_numpy())


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """The columns `keep` with score, the probability of class 1 of the document's worst stretch."""
    chosen = df.select(*(keep or []), text_of(text).alias("_text"))
    names = chosen.columns[:-1]
    schema = T.StructType(chosen.schema.fields[:-1]).add("score", T.DoubleType())
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in pieces(batches, "_text", BATCH_BYTES):
            scores = pa.array(scorer.scores(batch.column("_text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), scores], names=schema.names)

    return chosen.mapInArrow(run, schema)
