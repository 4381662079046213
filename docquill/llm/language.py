"""Language identification by the nearest of several centroids per language.

A text becomes counts of its character 1- to 3-grams, letters in lower case and all else as one
space, hashed to DIM places. Damped counts times inverse document frequency, scaled to
length 1, are compared by cosine with a few clustered centroids per language. The
language of the nearest centroid is predicted; a text that is much further from it than
the texts learned from is rejected. A text of few distinct n-grams is far from any centroid by
its size alone, so its cosine is first divided by what the size allows.

The model is fitted on a sample of at most about `max_rows` labelled rows, shared out evenly
among the languages and chosen by a hash of their text; only their hashed counts, at most DIM
each, reach the driver. Prediction reads every whole text where it lies.

Cases: null text, empty text and text without a letter is `und` with score 0 and is rejected; a
text of any length is counted whole, in stretches; equal texts get equal predictions; ties go to
the first language in order; with nothing to learn from all is `und`; an empty table
stays empty; only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, released

DIM = 1 << 13
UNKNOWN = "und"
#: Distinct n-grams from which on a text's size doesn't hold its cosine down.
ENOUGH = 400
_STRETCH = 1 << 20
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashed n-grams that begin at each but the last n - 1 codes."""
    size = len(codes) - n + 1
    mix = codes[:size] * _ODD[0]
    for k in range(1, n):
        mix = (mix ^ (mix >> np.uint64(29))) * _ODD[k] + codes[k : k + size] * _ODD[0]
    mix = (mix ^ (mix >> np.uint64(32))) * _ODD[2]
    return (mix >> np.uint64(64 - DIM.bit_length() + 1)).astype(np.int64)


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts, None for a text without a letter."""
    total, seen, last = np.zeros(DIM, np.int64), False, [32]
    for a in range(0, len(text), _STRETCH):
        codes = np.frombuffer(text[a : a + _STRETCH].lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        known = _letters()[codes.astype(np.int64)]
        seen |= bool(known.any())
        codes = np.concatenate([np.array(last, np.uint64), np.where(known, codes, np.uint64(32))])
        if a + _STRETCH >= len(text):
            codes = np.append(codes, np.uint64(32))
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        old = len(last)
        for n in (1, 2, 3):
            # n-grams that end within the codes carried over were counted before.
            total += np.bincount(_grams(codes[max(0, old - n + 1) :], n), minlength=DIM) if len(codes) - max(0, old - n + 1) >= n else 0
        last = codes[-2:].tolist()
    return total if seen else None


def weigh(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts by idf, scaled to length 1; rows are texts."""
    x = np.log1p(count).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def allowed(count: np.ndarray) -> np.ndarray:
    """Share of a long text's cosine that a text with so many distinct n-grams can reach."""
    return np.sqrt(np.minimum(1.0, (count > 0).sum(-1) / ENOUGH))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    nearest: float

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """(language, score, cosine, rejected) of each text."""
        out = []
        for text in texts:
            count = counts(text) if text else None
            if count is None or not self.languages:
                out.append((UNKNOWN, 0.0, 0.0, True))
                continue
            near = self.centroids @ weigh(count, self.idf)
            best = np.full(len(self.languages), -1.0)
            np.maximum.at(best, self.owner, near)
            i = int(best.argmax())
            out.append((self.languages[i], float(1 / np.exp(20 * (best - best[i])).sum()), float(best[i]), bool(best[i] < self.nearest * allowed(count))))
        return out


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of length 1 of the rows by cosine, from starts far from each other."""
    chosen = [x.mean(0) / max(np.linalg.norm(x.mean(0)), 1e-12)]
    while len(chosen) < min(k, len(x)):
        chosen.append(x[int((x @ np.array(chosen).T).max(1).argmin())])
    centroids = np.array(chosen)
    for _ in range(rounds):
        own = (x @ centroids.T).argmax(1)
        sums = np.array([x[own == j].sum(0) if (own == j).any() else c for j, c in enumerate(centroids)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def fit(docs: DataFrame, text: str = "text", label: str = "lang", max_rows: int = 2000, per_language: int = 4, slack: float = 0.3) -> Model:
    """A model of the rows with a label and a letter.

    slack: a text is rejected if its cosine, its size allowed for, is under this share of that of 999 in 1000 texts learned from.
    """
    rows = docs.select(F.col(text).alias("_text"), F.col(label).cast("string").alias("_label")).where("_text is not null and _label is not null")
    sizes = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).orderBy("_label").limit(max_rows).collect()}
    each = max_rows // max(1, len(sizes))
    if not sizes:
        return Model([], np.zeros(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros(0, np.int64), 0.0)
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, float(min(1.0, each / n)))])
    draw = F.pmod(F.xxhash64("_text"), F.lit(1 << 20)) / float(1 << 20)
    schema = "_label string, ids array<short>, n array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            kept = [(y, c) for t, y in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True) if (c := counts(t)) is not None]
            ids = [np.flatnonzero(c) for _, c in kept]
            n = [c[i] for (_, c), i in zip(kept, ids, strict=True)]
            columns = [pa.array([y for y, _ in kept], pa.string()), pa.array([i.astype(np.int16) for i in ids], pa.list_(pa.int16())), pa.array([x.astype(np.int32) for x in n], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_label", "ids", "n"])

    # A third more at most than asked for reaches the driver, whatever the hash draws.
    sample = rows.where(draw < share[F.col("_label")]).mapInArrow(released(run), schema).limit(max_rows + max_rows // 3).toArrow()
    names = sample.column("_label").to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i], sample.column("n")[i].values.to_pylist()))
    x = np.zeros((len(names), DIM), np.float32)
    for place, i in enumerate(order):
        x[place, sample.column("ids")[i].values.to_numpy()] = sample.column("n")[i].values.to_numpy()
    names = [names[i] for i in order]
    reach = allowed(x)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.1).astype(np.float32)
    x = weigh(x, idf)
    languages = sorted(set(names))
    own = np.array([languages.index(y) for y in names], np.int64)
    parts = [_clusters(x[own == j], per_language) for j in range(len(languages))]
    centroids = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, DIM), np.float32)
    near = np.sort((x @ centroids.T).max(1) / reach) if len(x) else np.zeros(1)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return Model(languages, idf, centroids, owner, slack * float(near[len(near) // 1000]))


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str | Column] | None = None, with_text: bool = False) -> DataFrame:
    """The columns `keep` with lang_pred, score (0 to 1), cosine (of the nearest centroid) and rejected.

    with_text: the text comes along as `_text`; it is sent once.
    """
    chosen = df.select(*(keep or []), F.col(text).alias("_text"))
    # A kept column may bear the text's name too.
    names = chosen.columns if with_text else chosen.columns[:-1]
    schema = T.StructType(chosen.schema.fields[: len(names)])
    schema.add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("cosine", T.DoubleType()).add("rejected", T.BooleanType())
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            found = shared.value.predict(batch.column("_text").to_pylist())
            out = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out], names=schema.names)

    return chosen.mapInArrow(released(run), schema)
