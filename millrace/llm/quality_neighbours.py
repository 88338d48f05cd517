"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of hashed terms: byte trigrams of its lower-cased form, the shapes of its words
(letter case, digits and marks, runs shortened) and the words that repeat the word before them. Term
counts are damped, weighted by inverse document frequency over the labelled sample and projected on
its leading singular directions. Every document is compared with every labelled vector by blocked
cosine products, exactly; the nearest vote with their labels, weighted by similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import held_out, stratified_keys, text_blocks
from millrace.llm.files import prepare_tasks


@dataclass(frozen=True)
class Neighbours:
    """Bounds of the labelled sample, of the terms and of the vote."""

    documents_per_label: int = 800
    documents: int = 1600
    trigram_buckets: int = 2048
    shape_buckets: int = 256
    dimensions: int = 48
    neighbours: int = 15
    power: int = 4
    shape_weight: float = 4.0
    smoothing: float = 20.0
    accept: float = 0.7


_SHAPE = bytes(
    ord("a") if chr(b).islower() or b >= 128 else ord("A") if chr(b).isupper() and b < 128
    else ord("0") if chr(b).isdigit() and b < 128 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def term_counts(text: str | None, s: Neighbours) -> np.ndarray:
    """Counts of the hashed terms of a whole text; an empty one has none."""
    import zlib

    counts = np.zeros(s.trigram_buckets + s.shape_buckets + 1, dtype=np.float64)
    last = None
    for block in text_blocks((text or "").encode()):
        data = np.frombuffer(block.lower(), dtype=np.uint8).astype(np.int64)
        if len(data) > 2:
            hashed = (data[:-2] * 961748927 + data[1:-1] * 982451653 + data[2:] * 899809363) >> 7
            counts[:s.trigram_buckets] += np.bincount(
                hashed % s.trigram_buckets, minlength=s.trigram_buckets
            )
        words = block.split()
        shapes, numbers = {}, _RUN.sub(rb"\1", block.translate(_SHAPE)).split()
        for shape in numbers:
            shapes[shape] = shapes.get(shape, 0) + 1
        for shape, n in shapes.items():
            counts[s.trigram_buckets + zlib.crc32(shape) % s.shape_buckets] += n
        if words:
            repeats = sum(map(bytes.__eq__, words, words[1:])) + (words[0] == last)
            counts[-1] += repeats
            last = words[-1]
    return counts


def damped(counts: np.ndarray, s: Neighbours) -> np.ndarray:
    """Logarithms of rates, so that length does not count; a few words are no strong evidence."""
    grams, shapes = counts[:, :s.trigram_buckets], counts[:, s.trigram_buckets:]
    words = shapes[:, :-1].sum(axis=1, keepdims=True) + s.smoothing
    return np.concatenate([
        np.log1p(1000 * grams / np.maximum(grams.sum(axis=1, keepdims=True), 1)),
        s.shape_weight * np.log1p(100 * shapes / words),
    ], axis=1).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def leading_directions(rows: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """The ``k`` leading right singular directions of a matrix, by subspace iteration."""
    start = np.random.default_rng(5).normal(size=(rows.shape[1], k + 8)).astype(np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    return (basis @ np.linalg.svd(rows @ basis, full_matrices=False)[2].T)[:, :k]


class NeighbourModel:
    """Labelled vectors in the latent space, with the projection into it."""

    def __init__(self, settings, projection, vectors, labels):
        self.settings, self.projection = settings, projection
        self.vectors, self.labels = vectors, labels

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, settings: Neighbours) -> NeighbourModel:
        weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
        rows = unit(damped(counts, settings) * weights.astype(np.float32))
        directions = leading_directions(rows, min(settings.dimensions, *rows.shape))
        projection = (directions * weights[:, None]).astype(np.float32)
        return cls(settings, projection, unit(rows @ directions).astype(np.float32),
                   labels.astype(np.float32))

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 in the weighted vote; a text without terms gets the share of the sample."""
        s = self.settings
        latent = unit(damped(counts, s) @ self.projection)
        k = min(s.neighbours, len(self.labels))
        cosines = latent @ self.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** s.power
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        blank = (counts.sum(axis=1) == 0) | (total <= 0)
        share = np.where(blank, self.labels.mean(), votes / np.where(total > 0, total, 1))
        return np.clip(share, 0, 1).astype(np.float64)


def _counted(settings: Neighbours):
    def count(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [
                term_counts(t.as_py(), settings).astype(np.float32).tobytes()
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "counts"]
            )

    return count


def fit_neighbours(
    docs: DataFrame, labels: DataFrame, settings: Neighbours = Neighbours()
) -> NeighbourModel | None:
    """Learn from rows of ``labels`` (``doc_id``, ``quality``) whose document is not held out.

    At most ``documents`` texts are taken, ``documents_per_label`` of each label. A document with
    contradicting labels counts with the lowest, one without a text is passed over, and of several
    texts with one id the one with the smallest digest counts (they are made one with a partial step,
    so that no more than ``documents`` rows reach the driver). None if no labelled text is there, as
    with an empty table. Other columns are not read.
    """
    prepare_tasks(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").filter(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    sample = stratified_keys(
        known, "doc_id", "quality", settings.documents_per_label, settings.documents
    ).collect()  # at most ``documents`` rows
    quality = {row.doc_id: row.quality for row in sample}
    keys = docs.sparkSession.createDataFrame([(k,) for k in quality], "doc_id bigint")
    # a text for each id: of several the one with the smallest digest, whatever the order of arrival
    chosen = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text") != "")
        .join(F.broadcast(keys), "doc_id")
        .groupBy("doc_id").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    )
    found = {
        row.doc_id: row.counts
        for row in chosen.mapInArrow(_counted(settings), "doc_id bigint, counts binary").collect()
    }
    if not found:
        return None
    ids = sorted(found)
    counts = np.stack([np.frombuffer(found[k], dtype=np.float32) for k in ids]).astype(np.float64)
    return NeighbourModel.fit(counts, np.array([quality[k] for k in ids]), settings)


def _scorer(settings, projection, vectors, labels):
    def run(batches):
        import pyarrow as pa

        model = NeighbourModel(settings, projection, vectors, labels)
        for batch in batches:
            texts, scores = batch.column("text"), []
            for k in range(0, len(texts), 64):
                counts = np.stack([
                    term_counts(t.as_py(), settings) for t in texts.slice(k, 64)
                ])
                scores += model.score(counts).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return run


def score_quality(docs: DataFrame, model: NeighbourModel | None) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row of (``doc_id``, ``text``).

    Without a model every score is 0.5. Null and empty texts get the share of label 1 in the sample.
    Rows with repeated or null ids are scored one by one; other columns are not read.
    """
    prepare_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    accept = (model.settings if model else Neighbours()).accept
    if model is None:
        scored = rows.select("doc_id", F.lit(0.5).alias("score"))
    else:
        scored = rows.mapInArrow(
            _scorer(model.settings, model.projection, model.vectors, model.labels),
            "doc_id bigint, score double",
        )
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def keep_quality(
    docs: DataFrame, model: NeighbourModel | None, *, keep_unjudged: bool = False
) -> DataFrame:
    """The rows of ``docs`` that the model accepts. Each row is judged by itself where it is read,
    whatever its id. Without a model nothing can be judged: an error, unless ``keep_unjudged`` lets
    all rows through. An empty table stays empty; other columns come back as they are."""
    prepare_tasks(docs.sparkSession)
    if model is None:
        if keep_unjudged or docs.isEmpty():
            return docs
        raise ValueError("no labelled text to learn quality from")

    settings, learned = model.settings, (model.projection, model.vectors, model.labels)

    def run(batches):
        import pyarrow as pa

        own = NeighbourModel(settings, *learned)
        for batch in batches:
            texts, scores = batch.column("text"), []
            for k in range(0, len(texts), 64):
                counts = np.stack([term_counts(t.as_py(), settings) for t in texts.slice(k, 64)])
                scores += own.score(counts).tolist()
            yield batch.filter(pa.array([score >= settings.accept for score in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
