"""Dependency manifests and CI files of repositories, from a listing of paths.

A listing has ``source_ord``, ``relative_path`` and ``is_dir``; it must be unfiltered.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, functions as F

from millrace.functions import fixed, paths


def dependency_manifests(listing: DataFrame) -> DataFrame:
    """Known manifests directly below a root, with their ecosystem."""
    table = F.create_map(*[F.lit(x) for x in chain(*fixed.DEPENDENCY_MANIFESTS.items())])
    return listing.filter(F.col("relative_path").isin(*fixed.DEPENDENCY_MANIFESTS)).withColumn(
        "ecosystem", F.try_element_at(table, F.col("relative_path"))
    )


def repo_manifests(listing: DataFrame) -> DataFrame:
    """The same as an equi-join with the table of eight names (broadcast: fixed size)."""
    rows = list(fixed.DEPENDENCY_MANIFESTS.items())
    names = listing.sparkSession.createDataFrame(rows, "relative_path string, ecosystem string")
    return listing.join(F.broadcast(names), "relative_path")


def ci_configs(listing: DataFrame) -> DataFrame:
    """CI files by name, and every ``.yml`` below a CI name that is a directory."""
    names = "|".join(paths.java_quote(name) for name in fixed.CI_LOCATIONS)
    below = F.col("relative_path").rlike(rf"(?s)\A(?:{names})/(?:.*/)?[^/]*\.yml\z")
    by_name = F.col("relative_path").isin(*fixed.CI_LOCATIONS) & ~F.col("is_dir")
    return listing.filter(below | by_name).withColumn("ci_kind", F.lit(fixed.CI_KIND))


def repository_metadata(sources: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per source with both maps; a source without hits has empty maps.

    Hits and sources are stacked and grouped once, which keeps sources without hits
    without a join. The maps hold the hits of one repository.
    """
    key = "source_ord"
    empty = F.lit(None).cast("string")
    hits = (
        dependency_manifests(listing)
        .select(key, F.col("relative_path").alias("_dep"), F.col("ecosystem").alias("_value"),
                empty.alias("_ci"))
        .unionByName(
            ci_configs(listing).select(
                key, empty.alias("_dep"), F.col("ci_kind").alias("_value"),
                F.col("relative_path").alias("_ci"),
            )
        )
    )
    described = sources.select(key, F.struct("name", "kind", "origin", "path").alias("_about"))
    stacked = described.unionByName(hits, allowMissingColumns=True)

    def sorted_map(path: str):
        entry = F.when(F.col(path).isNotNull(), F.struct(F.col(path), F.col("_value")))
        return F.map_from_entries(F.sort_array(F.collect_list(entry)))

    return (
        stacked.groupBy(key)
        .agg(
            F.first("_about", ignorenulls=True).alias("_about"),
            sorted_map("_dep").alias("dependency_manifests"),
            sorted_map("_ci").alias("ci_cd"),
        )
        .filter(F.col("_about").isNotNull())
        .select(key, "_about.*", "dependency_manifests", "ci_cd")
    )
