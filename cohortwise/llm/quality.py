"""Quality classifier: kernel ridge scores on document statistics, calibrated.

Random Fourier features approximate a Gaussian kernel over a few statistics of
the text. The normal equations of ridge regression are sums over rows, so each
partition adds up its own and Spark adds the partitions. An isotonic
(monotone) fit turns raw scores into the share of good documents; the raw
scores it learns from come from weights that have not seen the row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm import words as W
from cohortwise.llm.store import map_arrow, stage

#: Characters counted as one statistic each.
SYMBOLS, BARS, MARKS, ENDS, DIGITS = b"#*$%&", b"|<>[]{}\\", b"!?", b".,;:", b"0123456789"
N_STATS = 12


@dataclass(frozen=True)
class Settings:
    """Size and seed of the model; the driver holds ``features`` squared values."""

    features: int = 128
    bandwidth: float = 2.0
    ridge: float = 1e-3
    seed: int = 7
    bins: int = 400  # of the raw score, for calibration
    tasks: int = 128  # that add up normal equations
    folds: int = 5  # whose raw scores come from the others' weights
    cut: float = 0.7


def statistics(chunk: W.Chunk) -> np.ndarray:
    """One row of ``N_STATS`` statistics per text; zeros for one without words."""
    n = chunk.n
    words = chunk.counts()
    row = np.repeat(np.arange(n), np.diff(chunk.offsets))
    word_row = np.repeat(np.arange(n), words)

    def share(table: bytes, of: np.ndarray) -> np.ndarray:
        hit = np.zeros(256, bool)
        hit[list(table)] = True
        return np.bincount(row[hit[chunk.data]], minlength=n) / np.maximum(of, 1)

    solid = np.bincount(word_row, weights=chunk.ends - chunk.starts, minlength=n)
    upper = share(bytes(range(65, 91)), 1)
    letters = upper + share(bytes([*range(97, 123), *range(128, 256)]), 1)
    hashes = chunk.hashes(fold=True)
    same = np.zeros(n)
    if len(hashes) > 1:
        twice = (hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1])
        same = np.bincount(word_row[1:][twice], minlength=n)
    order = np.lexsort((hashes, word_row))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (word_row[1:] != word_row[:-1])
    distinct = np.bincount(word_row[new], minlength=n)
    some = np.maximum(words, 1)
    return np.column_stack(
        [
            np.log1p(words),
            solid / some,
            upper / np.maximum(letters, 1),
            share(SYMBOLS, solid),
            share(MARKS, solid),
            share(BARS, solid),
            share(DIGITS, solid),
            share(ENDS, solid),
            share(b"\n", some),
            same / some,
            np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9),
            letters / np.maximum(solid, 1),
        ]
    )


def _statistics_of(batches):
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            values = statistics(chunk)
            flat = pa.array(values.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, N_STATS, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(chunk.row, chunk.n), "x": lists})


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), N_STATS)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.waves + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.column_stack([cosines, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks[-1]
            blocks[-1] = [(v * w + u * x) / (w + x), w + x, n + m]
    return np.concatenate([[v] * n for v, _, n in blocks]) if blocks else np.zeros(0)


def _equations(batches, model: Model, folds: int):
    size = len(model.shifts) + 1
    total = np.zeros((folds, size, size + 1))
    for batch in batches:
        f = model.features(_matrix(batch.column("x")))
        y, fold = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
        for k in np.unique(fold):
            of = f[fold == k]
            total[k, :, :size] += of.T @ of
            total[k, :, size] += of.T @ y[fold == k]
    for k in np.flatnonzero(total[:, -1, -2]):  # folds with rows: the constant feature counts them
        at = np.indices(total[k].shape)
        places = {"i": at[0].ravel().astype(np.int32), "j": at[1].ravel().astype(np.int32), "v": total[k].ravel()}
        yield pa.RecordBatch.from_pydict({"fold": np.full(at[0].size, k, np.int32)} | places)


def _raw_bins(batches, model: Model, weights: np.ndarray, bins: int):
    """Raw scores of rows by the weights of their fold, binned."""
    for batch in batches:
        f = model.features(_matrix(batch.column("x")))
        raw = np.einsum("ij,ij->i", f, weights[batch.column("fold").to_numpy()])
        at = np.clip(np.floor((raw + 0.5) / 2 * bins), 0, bins - 1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"bin": at, "raw": raw, "y": batch.column("y")})


def ridge_weights(equations: np.ndarray, ridge: float) -> np.ndarray:
    """Solve summed normal equations; the last feature is the constant, hardly penalised."""
    size = len(equations)
    penalty = ridge * equations[-1, -2] * np.eye(size) / size
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(equations[:, :size] + penalty, equations[:, size])


def _scores_of(batches, model: Model):
    for batch in batches:
        scores = model.score(_matrix(batch.column("x"))) if len(batch) else np.zeros(0)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores})


def fit(training: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on ``training(x, y)``: statistics and 0/1 labels of all its rows.

    Rows are dealt into ``folds`` by a hash of their statistics, so equal
    texts share a fold. Each fold's raw scores for the calibration come from
    weights of the other folds; the final weights come from all rows. Where
    one fold holds all rows it is scored by its own weights.

    What reaches the driver has a fixed size: two moments a statistic, the
    normal equations of each fold (``features`` squared) and the calibration
    bins. Without any row the score is 0.5 throughout.
    """
    rng = np.random.default_rng(settings.seed)
    moments = training.agg(
        F.array(*[F.avg(F.col("x")[i]) for i in range(N_STATS)]).alias("mean"),
        F.array(*[F.stddev_pop(F.col("x")[i]) for i in range(N_STATS)]).alias("sd"),
        F.count("*").alias("n"),
    ).first()
    waves = rng.normal(0, 1 / settings.bandwidth, (N_STATS, settings.features))
    shifts = rng.uniform(0, 2 * np.pi, settings.features)
    if not moments.n:
        none = np.zeros(N_STATS)
        return Model(none, none + 1, waves, shifts, np.zeros(settings.features + 1), np.zeros(1), np.full(1, 0.5))
    sd = np.array(moments.sd)
    model = Model(np.array(moments.mean), np.where(sd > 1e-9, sd, 1), waves, shifts)
    dealt = training.withColumn("fold", F.pmod(F.xxhash64("x"), F.lit(settings.folds)).cast("int"))
    sums = map_arrow(dealt.coalesce(settings.tasks), lambda b: _equations(b, model, settings.folds), "fold int, i int, j int, v double")
    size = settings.features + 1
    equations = np.zeros((settings.folds, size, size + 1))
    for r in sums.groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        equations[r.fold, r.i, r.j] = r.v
    whole = equations.sum(axis=0)
    model.weights = ridge_weights(whole, settings.ridge)
    others = [whole - own for own in equations]
    alone = [round(other[-1, -2]) == 0 for other in others]
    weights = np.array([model.weights if a else ridge_weights(o, settings.ridge) for o, a in zip(others, alone, strict=True)])
    bins = map_arrow(dealt, lambda b: _raw_bins(b, model, weights, settings.bins), "bin int, raw double, y double")
    bins = bins.groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"))
    found = sorted((r.raw, r.y, r.n) for r in bins.collect())
    model.knots = np.array([f[0] for f in found])
    model.values = isotonic(np.array([f[1] for f in found]), np.array([f[2] for f in found], float))
    return model


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _learned(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, Model]:
    """Statistics of all documents, and the model of those with a label."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = map_arrow(texts, _statistics_of, "doc_id long, x array<double>").withColumn("held_out", _held_out())
    stats = stage(stats, "quality-stats")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where("y is not null")
    training = stage(stats.where(~F.col("held_out")).join(marks, "doc_id").select("x", "y"), "quality-training")
    return stats, fit(training, settings)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score every whole text of ``docs(doc_id, text)``; learn from ``labels``.

    Labels (``doc_id``, ``quality`` 0/1) count only where
    ``crc32(doc_id) mod 4 <> 2``; the others are held out. Returns ``doc_id``,
    ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 if the score is at least ``cut``). A null text scores as
    an empty one; null labels are left out; repeated rows return repeated
    rows; other columns are ignored, whatever their names. A null ``doc_id``
    gets its score and is not held out. Without labels every score is 0.5.
    """
    stats, model = _learned(docs, labels, settings)
    scored = map_arrow(stats, lambda b: _scores_of(b, model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= settings.cut).cast("int"))


def _good_of(batches, model: Model, cut: float):
    for batch in batches:
        keep = [model.score(statistics(chunk)) >= cut for chunk in W.chunks(batch.column("text"))]
        yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch


def good_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``cut``.

    The model is that of ``quality_scores``; without any label there is
    nothing to judge by, and all rows stay.
    """
    _, model = _learned(docs, labels, settings)
    if len(model.knots) == 1 and not model.weights.any():
        return docs
    return map_arrow(docs, lambda b: _good_of(b, model, settings.cut), docs.schema)


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from ``labels``."""
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
