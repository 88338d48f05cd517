"""Ranked lexical search by buckets of vectors of like length.

A document is a vector with a coordinate for every term that a query holds: its impact
``(10^9 tf) div (1000 tf + 20 m)``. A query is the vector of its terms' weights. The score is their inner
product, in integers. Documents are ordered by the length of their vector and cut into buckets; for a
query and a score ``s`` that its 50th document is known to reach, a bucket is passed over if

* the length of the query times the greatest length in the bucket is below ``s`` (Cauchy-Schwarz).

Inside a bucket only vectors within an angle of the query can reach ``s``. So each coordinate of a unit
vector has bounds; for the query's heaviest terms

* a document is passed over if that coordinate lies outside its bounds, and if the lower bound is above
  zero only the documents that hold the term are looked at.

Survivors are scored again exactly in 64-bit integers. The longest vectors are searched first, to know a
score for every query; then all of them are. Bounds are in doubles with a margin, so they never drop a
document that belongs to the result, and equal scores are never cut.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import text_blocks
from millrace.llm.files import prepare_tasks
from millrace.operators.positions import first_n, with_totals_before
from millrace.staging import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
_NO_ID = np.iinfo(np.int64).max
_MARGIN = 1e-9


@dataclass(frozen=True)
class Search:
    """``top`` documents a query. Queries are taken in blocks of at most ``block_terms`` terms (and one
    query more). A bucket holds at most ``bucket`` documents, of lengths down to ``spread`` of its greatest.
    Bounds are kept for ``focus`` coordinates; a ``first`` share of the vectors is searched ahead."""

    top: int = 50
    block_terms: int = 200_000
    bucket: int = 8192
    spread: float = 0.8
    focus: int = 4
    first: float = 1 / 64


def text_terms(text: Column) -> Column:
    """Terms of a text with A-Z in lower case; null gives none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


def _lists(rows: list[np.ndarray]):
    import pyarrow as pa

    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _counted(vocabulary: dict[bytes, int]):
    """Per document with a term: its id, the number of its terms, and how often it holds each term of
    the vocabulary. Long texts are taken block by block."""
    def count(batches):
        import pyarrow as pa

        holds = vocabulary.__contains__
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found, n = Counter(), 0
                for block in text_blocks((text.as_py() or "").encode()):
                    words = block.translate(_TABLE).split()
                    n += len(words)
                    found.update(filter(holds, words))
                if n:
                    ids.append(doc_id)
                    sizes.append(n)
                    terms.append(np.fromiter(map(vocabulary.get, found), dtype=np.int32))
                    counts.append(np.fromiter(found.values(), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), _lists(terms), _lists(counts)],
                ["doc_id", "n", "terms", "counts"])

    return count


@dataclass
class Queries:
    """A block of queries: the terms of each (numbers in the block's vocabulary) and the weights of all
    terms. ``known`` holds a score that the last wanted document of each query reaches, or 0."""

    numbers: list[int]
    terms: list[np.ndarray]
    weights: np.ndarray
    known: np.ndarray


class Bucket:
    """Vectors of like length, the longest first, with a list of (document, impact) for each term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms, impacts, sizes):
        self.ids, self.lengths, self.longest = ids, lengths, float(lengths.max())
        owners = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(terms, kind="stable")
        self.owners, self.impacts = owners[order], impacts[order]
        self.names, begins = np.unique(terms[order], return_index=True)
        self.begins = np.append(begins, len(terms))

    def postings(self, wanted: np.ndarray):
        """Terms of ``wanted`` that occur here, with their lists."""
        at = np.searchsorted(self.names, wanted)
        for k, place in enumerate(at.tolist()):
            if place < len(self.names) and self.names[place] == wanted[k]:
                part = slice(self.begins[place], self.begins[place + 1])
                yield k, self.owners[part], self.impacts[part]

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int, focus: int):
        """Documents that may score ``least`` or more, and their exact scores."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        length = math.sqrt(float((weights.astype(np.float64) ** 2).sum()))
        reach = length * self.longest * (1 + _MARGIN)
        if reach < least or not length:  # Cauchy-Schwarz: nobody here gets so far
            return none
        lists = list(self.postings(terms))
        if not lists:
            return none
        feasible = np.zeros(len(self.ids), dtype=bool)
        for _, owners, _ in lists:
            feasible[owners] = True
        angle = math.acos(min(1.0, least / reach)) + 1e-7
        if angle < math.pi / 2:
            heavy = np.argsort(-weights, kind="stable")[:focus].tolist()
            found = {k: (owners, impacts) for k, owners, impacts in lists}
            for k in heavy:
                own = math.acos(min(1.0, weights[k] / length))
                low, high = math.cos(min(math.pi, own + angle)), math.cos(max(0.0, own - angle))
                owners, impacts = found.get(k, (none[0], none[1]))
                share = impacts / self.lengths[owners]
                outside = owners[(share < low - _MARGIN) | (share > high + _MARGIN)]
                if low > _MARGIN:  # the term must be there
                    holds = np.zeros(len(self.ids), dtype=bool)
                    holds[owners] = True
                    feasible &= holds
                feasible[outside] = False
        scores = np.zeros(len(self.ids), dtype=np.int64)
        for k, owners, impacts in lists:
            kept = feasible[owners]
            scores[owners[kept]] += int(weights[k]) * impacts[kept]
        at = np.flatnonzero(feasible & (scores >= max(1, least)))
        return at, scores[at]


def _best(queries: Queries, settings: Search):
    """The best documents of a task for each query, among those not below the known score."""
    def search(batches):
        import pyarrow as pa

        known = queries.known.copy()
        best = [(np.zeros(0, dtype=np.int64),) * 2 for _ in queries.numbers]
        weights = [queries.weights[t] for t in queries.terms]

        def run(bucket: Bucket):
            for q, terms in enumerate(queries.terms):
                at, scores = bucket.search(terms, weights[q], int(known[q]), settings.focus)
                if not len(at):
                    continue
                scores = np.concatenate([best[q][0], scores])
                ids = np.concatenate([best[q][1], bucket.ids[at]])
                order = np.lexsort((ids, -scores))[:settings.top]
                best[q] = scores[order], ids[order]
                if len(order) == settings.top:
                    known[q] = max(known[q], scores[order[-1]])

        for bucket in _buckets(batches, settings):
            run(bucket)
        for q, (scores, ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(scores), queries.numbers[q]), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(scores, pa.int64()),
                ], ["item", "doc_id", "score"])

    return search


def _buckets(batches, settings: Search):
    """Consecutive vectors, cut by number or when they have become much shorter."""
    held, rows = [], 0

    def make():
        columns = [np.concatenate(c) for c in zip(*held)]
        return Bucket(*columns)

    for batch in batches:
        lengths = batch.column("length").to_numpy(zero_copy_only=False)
        if not len(lengths):
            continue
        if held:
            top, now = held[0][1][0], lengths[0]
            apart = now > held[-1][1][-1] or now < settings.spread * top
            if rows + len(lengths) > settings.bucket or (apart and rows >= settings.bucket // 8):
                yield make()
                held, rows = [], 0
        ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        terms, impacts = batch.column("terms"), batch.column("impacts")
        held.append((
            ids, lengths, terms.flatten().to_numpy(zero_copy_only=False),
            impacts.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.diff(terms.offsets.to_numpy(zero_copy_only=False)),
        ))
        rows += len(lengths)
    if held:
        yield make()


FOUND = "item bigint, doc_id bigint, score bigint"


def _search_block(docs: DataFrame, block: list, settings: Search) -> DataFrame:
    """Results of one block of queries, rows of (number, terms)."""
    vocabulary = {t: k for k, t in enumerate(sorted({t.encode() for row in block for t in row.terms}))}
    counted = stage(docs.mapInArrow(
        _counted(vocabulary), "doc_id bigint, n bigint, terms array<int>, counts array<int>"), "counted")
    sums = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    for row in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        frequency[row["t"]] = row["count"]  # at most one row per term of the block
    if not sums.docs:
        return docs.sparkSession.createDataFrame([], FOUND)
    weights = np.array([
        math.floor(1000 * math.log((2 * sums.docs + 2) / (2 * df + 1))) for df in frequency.tolist()
    ], dtype=np.int64)
    # a term without weight adds nothing to any score
    terms = [np.array(sorted(vocabulary[t.encode()] for t in set(row.terms)), dtype=np.int32) for row in block]
    terms = [t[(weights[t] > 0) & (frequency[t] > 0)] for t in terms]
    queries = Queries([row.number for row in block], terms, weights, np.zeros(len(block), dtype=np.int64))

    m = F.expr(f"50L + (50L * n * {sums.docs}L) div {sums.terms}L")
    vectors = counted.filter(F.size("terms") > 0).withColumn("_m", m).withColumn("impacts", F.expr(
        "transform(counts, c -> (1000000000L * c) div (1000L * c + 20L * _m))"
    )).withColumn("length", F.expr(
        "sqrt(aggregate(impacts, 0D, (total, p) -> total + cast(p AS double) * p))"
    )).filter("length > 0").select("doc_id", "length", "terms", "impacts")
    # copies have one length: their place in the written table deals them over partitions
    order = [F.col("length").desc(), F.col("_place")]
    ranged = stage(vectors.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(
        *order).sortWithinPartitions(*order).drop("_place"), "vectors")
    edge = ranged.agg(F.percentile_approx("length", 1 - settings.first, 10_000)).first()[0]
    if edge is not None:
        ahead = ranged.filter(F.col("length") >= edge).mapInArrow(_best(queries, settings), FOUND)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        last = ahead.withColumn("rank", rank).filter(F.col("rank") == settings.top)
        place = {number: q for q, number in enumerate(queries.numbers)}
        for row in last.select("item", "score").collect():  # at most one row per query of the block
            queries.known[place[row.item]] = row.score
    return ranged.mapInArrow(_best(queries, settings), FOUND)


def ranked_search(docs: DataFrame, items: DataFrame, settings: Search = Search()) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` best documents (``doc_id``, ``text``) of each
    query (``item_id``, ``text``) with a score above 0; equal scores by id, rows without an id last.

    Every row of ``docs`` counts as a document, also repeated ones; null texts have no terms. Copies of
    a query are one; queries that share an id but not the text are ranked apart; a query without a
    known term has no result. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = items.select("item_id", "text").distinct().select(
        "item_id", F.sha2("text", 256).alias("_digest"), F.array_distinct(text_terms(F.col("text"))).alias("terms")
    ).filter(F.size("terms") > 0).withColumn("_n", F.size("terms").cast("bigint"))
    # every query has a term, so that the terms before it are a number of its own
    asked = stage(with_totals_before(
        asked.withColumn("_all", F.lit(0)), ["_all"], ["item_id", "_digest"], "_n", name="number",
    ).select("number", "item_id", "terms"), "queries")
    blocks = asked.agg(F.max(F.floor(F.col("number") / settings.block_terms))).first()[0]
    found = []
    for k in range(0 if blocks is None else blocks + 1):
        block = asked.filter(F.floor(F.col("number") / settings.block_terms) == k).collect()
        found.append(_search_block(rows, block, settings))
    if not found:
        found = [spark.createDataFrame([], FOUND)]
    union = found[0]
    for one in found[1:]:
        union = union.unionByName(one)
    order = ["_low", "_null", "doc_id"]
    best = first_n(union.withColumn("_low", -F.col("score")).withColumn("_null", F.col("doc_id").isNull()),
                   ["item"], order, settings.top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    named = asked.select(F.col("number").alias("item"), "item_id")
    return best.withColumn("rank", rank).join(named, "item").select("item_id", "rank", "doc_id", "score")
