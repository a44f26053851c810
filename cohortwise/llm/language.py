"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams of several lengths (presence, not
counts), hashed to a fixed number of features. The kernel of two texts is the
size of their intersection over the geometric mean of their sizes. Landmark
texts span a Nystroem approximation of it, ridge regression learns one
language against the rest on that, and a batch of texts is scored by two
matrix products: with the landmarks, then with the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm import words as W
from cohortwise.llm.store import map_arrow

U = np.uint32
#: Letters fold to lower case; white space, digits and ASCII marks to one value each.
_CLASS = np.arange(256, dtype=U)
_CLASS[65:91] += 32
_CLASS[list(range(33)) + [127]] = 32
_CLASS[48:58] = 48
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 46


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows of a language that the model learns from."""

    grams: tuple[int, ...] = (1, 2, 3)
    features: int = 8192
    sample: int = 1500
    landmarks: int = 32  # of each language
    ridge: float = 1e-2
    batch: int = 256  # texts scored by one product
    seed: int = 11


def presence(chunk: W.Chunk, start: int, stop: int, settings: Settings) -> np.ndarray:
    """Texts ``start .. stop`` of a chunk as rows of 0/1 features."""
    lo, hi = chunk.offsets[start], chunk.offsets[stop]
    symbols = _CLASS[chunk.data[lo:hi]]
    offsets = chunk.offsets[start : stop + 1] - lo
    row = np.repeat(np.arange(stop - start), np.diff(offsets))
    out = np.zeros((stop - start, settings.features), np.uint8)
    for n in settings.grams:
        count = len(symbols) - n + 1
        if count <= 0:
            continue
        code = np.full(count, n, U)
        for j in range(n):
            code = code * U(0x01000193) + symbols[j : j + count] + U(1)
        code ^= code >> U(15)
        code = code * U(0x2C1B3C6D)
        code ^= code >> U(12)
        inside = row[:count] == row[n - 1 :]
        out[row[:count][inside], (code % U(settings.features))[inside]] = 1
    return out


def _presence_batches(batches, settings: Settings):
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            for start in range(0, chunk.n, settings.batch):
                stop = min(start + settings.batch, chunk.n)
                yield batch, chunk, start, stop, presence(chunk, start, stop, settings)


def _bits_of(batches, settings: Settings):
    for batch, chunk, start, stop, x in _presence_batches(batches, settings):
        rows = slice(chunk.row + start, chunk.row + stop)
        bits = [r.tobytes() for r in np.packbits(x, axis=1)]
        yield pa.RecordBatch.from_pydict({"h": batch.column("h")[rows], "lang": batch.column("lang")[rows], "bits": pa.array(bits, pa.binary())})


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # features x landmarks, each column scaled to length one
    weights: np.ndarray  # (landmarks + 1) x languages

    def kernel(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float32)
        return (x @ self.landmarks) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    def scores(self, x: np.ndarray) -> np.ndarray:
        k = self.kernel(x)
        return k @ self.weights[:-1] + self.weights[-1]


def _scores_of(batches, model: Model, settings: Settings):
    names = np.array(model.languages, object)
    for batch, chunk, start, stop, x in _presence_batches(batches, settings):
        rows = slice(chunk.row + start, chunk.row + stop)
        scores = model.scores(x)
        best = scores.argmax(axis=1)
        sure = np.clip((scores[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(float)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id")[rows],
                "held_out": batch.column("held_out")[rows],
                "letters": batch.column("letters")[rows],
                "best": pa.array(names[best], pa.string()),
                "sure": sure,
            }
        )


def fit(training: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learn from ``training(doc_id, lang, text)``; None without any row.

    At most ``sample`` rows of each language are used, those with the smallest
    hash of their id. The driver holds their features as bits (``features / 8``
    bytes a row), never their texts.
    """
    known = training.where("lang is not null and text is not null").withColumn("h", F.xxhash64("doc_id", "lang"))
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    ids = None
    for lang in languages:
        own = known.where(F.col("lang") == lang).select("h", "lang").distinct().orderBy("h").limit(settings.sample)
        ids = own if ids is None else ids.unionByName(own)
    few = training.sparkSession.createDataFrame([(r.h, r.lang) for r in ids.collect()], "h long, lang string")
    texts = known.join(F.broadcast(few), ["h", "lang"]).select("h", "lang", "text")
    rows = map_arrow(texts, lambda b: _bits_of(b, settings), "h long, lang string, bits binary").dropDuplicates(["h", "lang"])
    found = sorted((r.h, r.lang, bytes(r.bits)) for r in rows.collect())
    x = np.unpackbits(np.frombuffer(b"".join(f[2] for f in found), np.uint8).reshape(len(found), -1), axis=1)[:, : settings.features]
    y = np.array([languages.index(f[1]) for f in found])
    rng = np.random.default_rng(settings.seed)
    marks = np.concatenate([rng.permutation(np.flatnonzero(y == c))[: settings.landmarks] for c in range(len(languages))])
    scaled = x[marks].astype(np.float32)
    scaled = (scaled / np.sqrt(np.maximum(scaled.sum(axis=1, keepdims=True), 1))).T
    model = Model(languages, scaled, np.zeros((len(marks) + 1, len(languages)), np.float32))
    k = model.kernel(x).astype(float)
    values, vectors = np.linalg.eigh(model.kernel(x[marks]).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # Nystroem map: kernel row @ root
    phi = np.column_stack([k @ root, np.ones(len(k))])
    weight = 1 / np.bincount(y, minlength=len(languages))[y]  # languages count alike
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    gram = phi.T @ (phi * weight[:, None])
    penalty = settings.ridge * np.eye(len(gram))
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(gram + penalty, phi.T @ (target * weight[:, None]))
    model.weights = np.vstack([root @ beta[:-1], beta[-1:]]).astype(np.float32)
    return model


def languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predict the language of every whole text of ``docs(doc_id, text, lang)``.

    Learns from rows with a language whose ``crc32(doc_id) mod 3`` is not 1;
    the rest are held out. Only the text enters a prediction. Returns
    ``doc_id``, ``held_out``, ``lang_pred`` (a learned language, ``und`` if
    the text is null or has no letter, or nothing could be learned) and
    ``score`` (0 to 1; 0 for ``und``). Repeated rows return repeated rows; a
    null ``doc_id`` is predicted, neither held out nor learned from. Other
    columns are ignored, whatever their names.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(texts.where(remainder != 1), settings)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    held = F.coalesce(remainder == 1, F.lit(False))
    rows = texts.select("doc_id", "text", held.alias("held_out"), letters.alias("letters"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = map_arrow(
        rows, lambda b: _scores_of(b, sent.value, settings), "doc_id long, held_out boolean, letters boolean, best string, sure double"
    )
    return scored.select(
        "doc_id",
        "held_out",
        F.when(F.col("letters"), F.col("best")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("sure")).otherwise(0.0).alias("score"),
    )


def op2_string_kernel_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
