"""Language identification by a byte convolutional network, trained in numpy.

A text is lower-cased (A-Z), cut into windows of a fixed number of bytes and fed in batches: byte
embeddings, convolutions of several widths, maximum over the window, a rectifier and a softmax over
the learned languages and noise. The probabilities of a text are those of its windows, weighted by
letters. All windows of a text are read.

Noise is made, not labelled: hexadecimal, base64, words of random letters, random characters of
other scripts and learned windows in shuffled order. A text is given its likeliest language; what noise takes from the
score of that language tells texts in no learned language apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import held_out, stratified_keys
from millrace.llm.files import prepare_tasks

UNDETERMINED = "und"
# Texts that score less are in no learned language; README has the held-out rows below it.
LEAST_SCORE = 0.2


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the training itself."""

    documents_per_language: int = 400
    documents: int = 4000
    windows_per_document: int = 6
    window: int = 192
    embedding: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (2, 3, 4)
    epochs: int = 4
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


def to_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8").lower(), dtype=np.uint8)


def windows(data: np.ndarray, size: int) -> np.ndarray:
    """All bytes in rows of ``size``, the last filled up with zeros."""
    rows = -(-len(data) // size)
    padded = np.zeros(rows * size, dtype=np.uint8)
    padded[:len(data)] = data
    return padded.reshape(rows, size)


def spread_windows(data: np.ndarray, size: int, most: int) -> np.ndarray:
    """At most ``most`` of the windows, spread evenly over the whole text."""
    rows = windows(data, size)
    if len(rows) > most:
        rows = rows[np.linspace(0, len(rows) - 1, most).astype(int)]
    return rows


def noise_windows(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` windows of noise, of 32 bytes to the whole width; a fifth are shuffled ``rows``."""
    draw, width = np.random.default_rng(seed), rows.shape[1]
    hexadecimal, letters = (np.frombuffer(a, dtype=np.uint8) for a in (
        b"0123456789abcdef", b"abcdefghijklmnopqrstuvwxyz"))
    base64 = np.concatenate([letters, letters, hexadecimal[:10], np.frombuffer(b"+/", dtype=np.uint8)])
    out = np.zeros((count, width), dtype=np.uint8)
    for k in range(count):
        size = int(draw.integers(32, width + 1))
        kind = k % 5
        if kind == 4:
            source = rows[draw.integers(len(rows))]
            line = draw.permutation(source[source > 0])[:size]
        elif kind == 3:
            line = draw.integers(128, 192, size).astype(np.uint8)
            first = int(draw.integers(198, 223))
            line[::2] = draw.integers(first, first + 2, len(line[::2]))
        else:
            line = draw.choice((hexadecimal, base64, letters)[kind], size)
        if kind in (0, 2, 3) and draw.random() < 0.7:
            line[np.cumsum(draw.integers(2, 12, size)).clip(max=size - 1)] = 32
        out[k, :len(line)] = line
    return out


_LETTER = np.zeros(256, dtype=np.float32)
_LETTER[ord("a"):ord("z") + 1] = 1
_LETTER[128:] = 1


class ByteNetwork:
    """The network. ``weights`` are embeddings, one filter bank per width, its offsets, the output; the
    last class of the output, after those of ``labels``, is noise."""

    def __init__(self, labels: list[str], settings: Training, weights: list[np.ndarray] | None = None):
        self.labels, self.settings = labels, settings
        if weights is None:
            draw, d, f = np.random.default_rng(settings.seed), settings.embedding, settings.filters
            weights = [draw.normal(0, 0.5, (256, d))]
            for width in settings.widths:
                weights += [draw.normal(0, (1 / (width * d)) ** 0.5, (width, d, f)), np.zeros(f)]
            total = f * len(settings.widths)
            weights += [draw.normal(0, 0.1, (total, len(labels) + 1)), np.zeros(len(labels) + 1)]
        self.weights = [w.astype(np.float32) for w in weights]

    def tables(self) -> list[list[np.ndarray]]:
        """Per width the responses of each filter to one byte, or to two neighbours, at each place."""
        embedded, found = self.weights[0], []
        for k, width in enumerate(self.settings.widths):
            single = [embedded @ self.weights[1 + 2 * k][i] for i in range(width)]
            pairs = [
                (single[i][:, None, :] + single[i + 1][None, :, :]).reshape(65536, -1)
                for i in range(0, width - 1, 2)
            ]
            found.append(pairs + single[width - width % 2:])
        return found

    def pooled(self, rows: np.ndarray, tables, places: bool = False):
        """Largest response of each filter in each window, before offsets; and where it lies."""
        pairs = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        tops, at = [], []
        for width, parts in zip(self.settings.widths, tables):
            length = rows.shape[1] - width + 1
            total = None
            for i, table in enumerate(parts):
                source = pairs if len(table) > 256 else rows
                part = table.take(source[:, 2 * i:2 * i + length], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            if places:
                at.append(total.argmax(axis=1))
            tops.append(total.max(axis=1))
        return np.concatenate(tops, axis=1), at

    def probabilities(self, top: np.ndarray) -> np.ndarray:
        offsets = np.concatenate(self.weights[2:-2:2])
        logits = np.maximum(top + offsets, 0) @ self.weights[-2] + self.weights[-1]
        logits -= logits.max(axis=1, keepdims=True)
        exp = np.exp(logits)
        return exp / exp.sum(axis=1, keepdims=True)

    def predict(self, rows: np.ndarray, tables, chunk: int = 256) -> np.ndarray:
        parts = [
            self.probabilities(self.pooled(rows[k:k + chunk], tables)[0])
            for k in range(0, len(rows), chunk)
        ]
        return np.concatenate(parts)

    def train(self, rows: np.ndarray, target: np.ndarray) -> None:
        """Adam on cross-entropy with classes weighted equally. Only the place of each maximum passes
        a gradient, so a step touches one patch per window and filter."""
        s = self.settings
        draw = np.random.default_rng(s.seed)
        share = np.bincount(target, minlength=len(self.labels) + 1).astype(np.float64)
        weight = (len(target) / np.maximum(share, 1) / max(1, (share > 0).sum())).astype(np.float32)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for epoch in range(s.epochs):
            order = draw.permutation(len(rows))
            for k in range(0, len(order), s.batch):
                chosen = order[k:k + s.batch]
                grads = self._gradients(rows[chosen], target[chosen], weight)
                step += 1
                rate = s.rate * 0.5 ** epoch
                for w, g, m, v in zip(self.weights, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def _single_tables(self):
        embedded = self.weights[0]
        return [
            [embedded @ self.weights[1 + 2 * k][i] for i in range(width)]
            for k, width in enumerate(self.settings.widths)
        ]

    def _gradients(self, rows, target, weight):
        s, n = self.settings, len(rows)
        f = s.filters
        tops, at = [], []
        for width, parts in zip(s.widths, self._single_tables()):
            length = rows.shape[1] - width + 1
            total = sum(part.take(rows[:, i:i + length], axis=0) for i, part in enumerate(parts))
            at.append(total.argmax(axis=1))
            tops.append(total.max(axis=1))
        offsets = np.concatenate(self.weights[2:-2:2])
        top = np.concatenate(tops, axis=1) + offsets
        hidden = np.maximum(top, 0)
        logits = hidden @ self.weights[-2] + self.weights[-1]
        logits -= logits.max(axis=1, keepdims=True)
        exp = np.exp(logits)
        delta = exp / exp.sum(axis=1, keepdims=True)
        delta[np.arange(n), target] -= 1
        delta *= (weight[target] / n)[:, None]
        back = (delta @ self.weights[-2].T) * (top > 0)
        grads = [np.zeros_like(self.weights[0])]
        for k, width in enumerate(s.widths):
            g = back[:, k * f:(k + 1) * f]
            patch = rows[np.arange(n)[:, None, None], at[k][:, :, None] + np.arange(width)]
            bank = self.weights[1 + 2 * k]
            seen = self.weights[0][patch]
            grads += [np.einsum("nf,nfwd->wdf", g, seen), g.sum(axis=0)]
            into = g[:, :, None, None] * bank.transpose(2, 0, 1)[None]
            np.add.at(grads[0], patch.ravel(), into.reshape(-1, s.embedding))
        return grads + [hidden.T @ delta, delta.sum(axis=0)]


def _sampled_windows(settings: Training):
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            langs, rows = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                cut = spread_windows(
                    to_bytes(text.as_py()), settings.window, settings.windows_per_document
                )
                langs += [lang] * len(cut)
                rows += [row.tobytes() for row in cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "row"]
            )

    return cut


def train_language_network(docs: DataFrame, settings: Training = Training()) -> ByteNetwork | None:
    """Learn from (``doc_id``, ``text``, ``lang``) of rows that are not held out.

    The sample is bounded by ``documents``, ``windows_per_document`` and ``window``, however long the
    texts are. An id with several languages counts with the first of them by name, one with several
    texts in it with the text of the smallest digest; these are made one with a partial step, so that
    at most ``documents`` texts are cut into windows for the driver. Null ids, languages and texts and
    empty texts are passed over. None if there is nothing to learn from, as with an empty table.
    """
    prepare_tasks(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.col("text") != "")
    )
    keys = stratified_keys(
        rows.select("doc_id", "lang"), "doc_id", "lang",
        settings.documents_per_language, settings.documents,
    )
    keys = docs.sparkSession.createDataFrame(keys.collect(), keys.schema)  # at most ``documents`` rows
    # a text for each id: of several the one with the smallest digest, whatever the order of arrival
    chosen = rows.join(F.broadcast(keys), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min_by("text", F.sha2("text", 256)).alias("text")).select("lang", "text")
    found = chosen.mapInArrow(_sampled_windows(settings), "lang string, row binary").collect()
    if not found:
        return None
    found.sort()
    labels = sorted({row.lang for row in found})
    network = ByteNetwork(labels, settings)
    data = np.frombuffer(b"".join(bytes(row["row"]) for row in found), dtype=np.uint8)
    data = data.reshape(-1, settings.window)
    target = np.array([labels.index(row.lang) for row in found])
    noise = noise_windows(data, -(-len(data) // len(labels)), settings.seed)
    network.train(np.concatenate([data, noise]), np.r_[target, np.full(len(noise), len(labels))])
    return network


def classify(network: ByteNetwork, tables, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text; a text that is null or has no letter is undetermined."""
    size, cut, owners, out = network.settings.window, [], [], []
    for k, text in enumerate(texts):
        out.append((UNDETERMINED, 0.0))
        if text and any(map(str.isalpha, text)):
            rows = windows(to_bytes(text), size)
            cut.append(rows)
            owners.append(np.full(len(rows), k))
    if not cut:
        return out
    rows, owner = np.concatenate(cut), np.concatenate(owners)
    weight = _LETTER[rows].sum(axis=1) + 1e-3
    votes = network.predict(rows, tables) * weight[:, None]
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sums = np.add.reduceat(votes, starts, axis=0)
    sums /= np.add.reduceat(weight, starts)[:, None]
    for k, p in zip(owner[starts].tolist(), sums):
        best = int(p[:len(network.labels)].argmax())
        out[k] = (network.labels[best], float(min(1.0, p[best])))
    return out


def _classifier(labels, settings, weights):
    def run(batches):
        import pyarrow as pa

        network = ByteNetwork(labels, settings, weights)
        tables = network.tables()
        for batch in batches:
            found = []
            texts = batch.column("text")
            for k in range(0, len(texts), 32):
                found += classify(network, tables, texts.slice(k, 32).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names if c != "text"] + [
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                [c for c in batch.schema.names if c != "text"] + ["lang_pred", "score"],
            )

    return run


def identify_language(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of (``doc_id``, ``text``).

    Without a network every text is undetermined. Scores of undetermined texts are 0. Rows with
    repeated or null ids are classified one by one; other columns are not read.
    """
    prepare_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if network is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(
        _classifier(network.labels, network.settings, network.weights),
        "doc_id bigint, lang_pred string, score double",
    )


def keep_languages(
    docs: DataFrame, network: ByteNetwork | None, least: float = LEAST_SCORE, *,
    keep_unjudged: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``. Each row is judged by itself where it is read,
    whatever its id. Without a network nothing can be judged: an error, unless ``keep_unjudged`` lets
    all rows through. An empty table stays empty; other columns come back as they are."""
    prepare_tasks(docs.sparkSession)
    if network is None:
        if keep_unjudged or docs.isEmpty():
            return docs
        raise ValueError("no text with a language to learn from")

    labels, settings, weights = network.labels, network.settings, network.weights

    def run(batches):
        import pyarrow as pa

        own = ByteNetwork(labels, settings, weights)
        tables = own.tables()
        for batch in batches:
            scores, texts = [], batch.column("text")
            for k in range(0, len(texts), 32):
                scores += [f[1] for f in classify(own, tables, texts.slice(k, 32).to_pylist())]
            yield batch.filter(pa.array([score >= least for score in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
