"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import sized_join
from millrace.staging import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _smallest(pairs: DataFrame) -> DataFrame:
    """Of each node the smallest node among it and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("_v")).select(
        "u", F.least("u", "_v").alias("m")
    )


def _links(pairs: DataFrame) -> DataFrame:
    """Distinct links with the larger node first."""
    return pairs.filter("x != y").select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")
    ).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    pairs = _both_ways(links)
    return _links(sized_join(pairs, _smallest(pairs), ["u"]).filter("v > u").select(
        F.col("v").alias("x"), F.col("m").alias("y")
    ))


def _small_star(links: DataFrame) -> DataFrame:
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = stage(_smallest(pairs), "smallest")
    return _links(
        sized_join(pairs, least, ["u"]).select(F.col("v").alias("x"), F.col("m").alias("y"))
        .union(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
    )


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def component_roots(links: DataFrame) -> DataFrame:
    """Of every linked node ``a`` that is not the smallest of its component, the smallest as ``b``.

    ``links`` has two columns ``a`` and ``b`` of one orderable type, in any order and number. Each
    round writes its links, one per node at the end. The smallest neighbours are written and measured
    before they are joined back, so a node with very many neighbours is one row per task in the
    search for the smallest, and its links stay where they are or are split by adaptive execution.
    Rounds grow with the logarithm of the longest path. No links give no rows.
    """
    links = stage(_links(links.select(F.col("a").alias("x"), F.col("b").alias("y"))), "links")
    before = _mark(links)
    while before[0]:
        links = stage(_small_star(stage(_large_star(links), "links")), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    return links
