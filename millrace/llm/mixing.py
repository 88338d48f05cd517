"""Mixing sources to target weights by temperature.

A source with share ``p`` of all tokens gets the weight ``p ** a``, normalised. The exponent ``a`` is
bisected between 0 (all sources alike) and 1 (as they are): the largest that reaches a target
entropy, or the smallest that keeps every source within a repetition limit. The weights are then
realised without drawing: every source is permuted by hash, pass by pass, up to its token budget, and
cut into as many parts as there are blocks; a block takes one part of each source and is permuted.
So every block has the target weights, up to a document per source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import WHITESPACE_RUN, hash_order, row_key
from millrace.operators.joins import sized_join
from millrace.operators.positions import with_positions, with_totals_before
from millrace.staging import stage


@dataclass(frozen=True)
class Mix:
    """Target and sizes. With ``entropy`` (a share of the largest possible, 0 to 1) that is the
    target, else ``repetition``: how often a source may be repeated against the one repeated least.
    Without ``budget`` the source repeated least is passed once, so that no document is left out."""

    repetition: float = 2.0
    entropy: float | None = None
    budget: int | None = None
    block_tokens: int = 1 << 20
    steps: int = 30


def word_tokens(text: Column) -> Column:
    """A token measure: the words of a whole text, and one for its end."""
    return F.size(F.split(F.coalesce(text, F.lit("")), WHITESPACE_RUN)).cast("bigint")


def _meets(mix: Mix, exponent: float) -> Column:
    """Whether an exponent meets the target, as an aggregate over the sources' ``_p`` and ``_most``."""
    if mix.entropy is None:
        return F.max(F.pow(F.col("_most") / F.col("_p"), F.lit(1 - exponent))) <= mix.repetition
    power = F.pow(F.col("_p"), F.lit(exponent))
    total = F.sum(power)
    entropy = F.ln(total) - F.sum(power * exponent * F.ln("_p")) / total
    return entropy >= mix.entropy * F.ln(F.count(F.lit(1))) - 1e-12


def find_exponent(shares: DataFrame, mix: Mix) -> float:
    """Bisect the exponent over a table of sources with their ``tokens``.

    Five steps of the bisection are one pass: the aggregate tests all 31 midpoints they may take.
    """
    sums = shares.agg(F.sum("tokens").alias("t"), F.max("tokens").alias("m")).first()
    if not sums.t:
        return 1.0
    rows = shares.filter("tokens > 0").select(
        (F.col("tokens") / F.lit(float(sums.t))).alias("_p"),
        F.lit(sums.m / sums.t).alias("_most"),
    )
    wants_large = mix.entropy is not None  # the largest that meets the target, else the smallest
    low, high = 0.0, 1.0
    ends = rows.agg(_meets(mix, 0.0).alias("low"), _meets(mix, 1.0).alias("high")).first()
    if wants_large and ends.high:
        return 1.0
    if not wants_large and ends.low:
        return 0.0
    for _ in range(0, mix.steps, 5):
        points = [low + (high - low) * k / 32 for k in range(1, 32)]
        met = rows.agg(*[_meets(mix, x).alias(f"m{k}") for k, x in enumerate(points)]).first()
        at, width = 16, 8
        while True:
            down = met[at - 1] != wants_large
            if width == 0:
                low, high = (low, points[at - 1]) if down and at == 1 else (
                    (points[at - 2], points[at - 1]) if down else
                    (points[at - 1], points[at] if at < 31 else high))
                break
            at += -width if down else width
            width //= 2
    return low if wants_large else high


def source_weights(docs: DataFrame, mix: Mix, *, source: str, tokens: str) -> DataFrame:
    """Per source: ``tokens``, ``share``, ``weight``, ``budget`` and ``repetition``. One row each."""
    shares = stage(
        docs.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).cast("bigint").alias("tokens")),
        "sources",
    )
    exponent = find_exponent(shares, mix)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent)))
    sums = shares.agg(
        F.sum("tokens").alias("t"), F.sum(power).alias("w"),
        F.max(F.col("tokens") / power).alias("least"), F.sum(F.lit(1)).alias("n"),
    ).first()
    total = float(sums.t or 1)
    weighed = float(sums.w or 1.0)
    budget = float(mix.budget) if mix.budget is not None else float(sums.least or 0.0) * weighed
    weight = F.coalesce(power / F.lit(weighed), F.lit(0.0))
    return shares.select(
        "source", "tokens", (F.col("tokens") / F.lit(total)).alias("share"), weight.alias("weight"),
        F.round(weight * F.lit(budget)).cast("bigint").alias("budget"),
        F.lit(exponent).alias("exponent"),
    ).withColumn("repetition", F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(0.0))


def mixing_plan(
    docs: DataFrame, mix: Mix = Mix(), *, source: str = "source", doc_id: str = "doc_id",
    tokens: Column | None = None,
) -> DataFrame:
    """Where each document goes: ``doc_id``, ``source``, ``pass``, ``block``, ``position`` in the block,
    ``tokens``, the ``weight`` and ``repetition`` of its source, and ``row_key``. Narrow rows, no text.

    ``row_key`` is the digest of the row. Documents without a source form one. Every row is a document of
    its own, also rows that share an id, have none, or repeat another: they take places of their own
    in the permutation, so that a hot id is spread like any others. ``tokens`` measures a row (at least 1
    is taken; words by default, one for a null or empty text). An empty table gives an empty plan.
    """
    measure = tokens if tokens is not None else word_tokens(F.col("text"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(source).isNull().alias("no_source"),
        F.greatest(F.coalesce(measure, F.lit(1)), F.lit(1)).cast("bigint").alias("tokens"),
        row_key(docs).alias("row_key"),
    )
    # repeated rows are told apart by a number that is written once, then never made again
    rows = stage(rows.withColumn("_source", F.concat(
        F.when(F.col("no_source"), "-").otherwise("+"), "source"
    )).withColumn("_place", F.monotonically_increasing_id()), "mixed")
    copies = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    marked = stage(sized_join(
        rows, copies.withColumn("_again", F.lit(True)), ["row_key"], "left"), "marked")
    again = with_positions(marked.filter("_again"), ["row_key"], ["_place"], name="_copy")
    rows = marked.filter("_again IS NULL").withColumn("_copy", F.lit(0).cast("bigint")).unionByName(
        again.drop("group_size")).drop("_again", "_place")
    weights = source_weights(rows, mix, source="_source", tokens="tokens")
    blocks = weights.agg(F.sum("budget")).first()[0] or 0
    blocks = max(1, -(-blocks // mix.block_tokens))
    named = weights.select(
        F.col("source").alias("_source"), "weight", "budget", "repetition",
        F.col("tokens").alias("_source_tokens"),
    )
    passes = F.ceil(F.col("repetition") - F.lit(1e-9)).cast("int")
    repeated = sized_join(rows, named, ["_source"]).filter("budget > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1))
    ).withColumn("_order", hash_order(F.col("pass"), F.col("row_key"), F.col("_copy")))
    placed = with_totals_before(
        repeated, ["_source"], ["pass", "_order", "row_key", "_copy"], "tokens")
    placed = placed.filter(F.col("before") < F.col("budget"))
    block = F.least(
        F.lit(blocks - 1), F.floor(F.col("before").cast("double") * blocks / F.col("budget"))
    ).cast("bigint")
    mixed = Window.partitionBy("block").orderBy("_shuffle", "row_key", "_copy", "pass")
    return placed.withColumn("block", block).withColumn(
        "_shuffle", hash_order(F.lit("block"), F.col("pass"), F.col("row_key"), F.col("_copy"))
    ).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "pass", "block",
        (F.row_number().over(mixed) - 1).cast("bigint").alias("position"), "tokens", "weight", "repetition",
        "row_key",
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix(), **columns) -> DataFrame:
    """The rows of ``docs`` as often and in the order that the plan says, dealt over partitions by block.

    The plan has a place for every row, so copies of a row are made one (with a partial step before
    the shuffle) and joined to the places of all of them; adaptive execution splits those of a hot row.
    Columns come back as they are, whatever their names; an empty table stays empty.
    """
    plan = stage(mixing_plan(docs, mix, **columns), "plan").select(
        F.col("row_key").alias("_mix_key"), F.col("block").alias("_mix_block"),
        F.col("position").alias("_mix_position"),
    )
    names = [f"_mix_{k}" for k in range(len(docs.columns))]
    renamed = [docs[c].alias(n) for c, n in zip(docs.columns, names)]
    rows = docs.select(*renamed, row_key(docs).alias("_mix_key")).dropDuplicates(["_mix_key"])
    met = rows.join(plan.hint("merge"), "_mix_key")
    order = ["_mix_block", "_mix_position"]
    return met.repartitionByRange(*order).sortWithinPartitions(*order).select(*names).toDF(*docs.columns)
