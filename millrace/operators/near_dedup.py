"""Near-duplicate files: sets of word shingles with a Jaccard similarity over a threshold.

Two ways to find them, over one representation. A class is a text as its sequence of words: copies are
one row, whatever their number, and never meet each other.

* :func:`similar_pairs` is exact. Shingles are ordered from rare to frequent over the whole corpus, and two
  sets over the threshold must share one among their first few (the prefix). Only prefixes meet; pairs
  must also have like sizes and enough places left behind the last shingle they share. What remains is
  compared in full.
* :func:`near_groups` is for grouping. Signatures of min-wise hashes are cut into bands; classes that
  agree in a band meet in its bucket. A bucket of any size gives a star and not pairs: each class is compared
  in full with the hub of the bucket. Those that are unlike the hub meet again without it; those that
  still wait after a few rounds are compared by the exact join. Stars are joined to components.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from millrace.functions import word_sets
from millrace.operators.components import component_roots
from millrace.operators.dedup import keep_first
from millrace.operators.joins import sized_join
from millrace.staging import bound_batches, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = " \t\n\x0b\x0c\r"
_ROUNDING = 1e-9


@dataclass(frozen=True)
class NearOptions:
    """``words`` of a shingle and the least ``similarity`` of near-duplicates. A pair at the threshold of 0.8
    meets in one of 16 bands of 5 rows with a probability of 0.998."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 16
    rows: int = 5
    rounds: int = 3


def split_words(content: Column) -> Column:
    """Words between ASCII white space, A-Z in lower case; null has none."""
    plain = F.btrim(F.translate(F.coalesce(content, F.lit("")), _UPPER, _LOWER), F.lit(_SPACES))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(
        F.split(plain, r"[\x20\x09-\x0D]+"))


def word_class(words: Column) -> Column:
    """Digest of a text's words: equal for texts that differ in white space and case only."""
    return F.unhex(F.md5(F.array_join(words, " ").cast("binary")))


def word_classes(records: DataFrame, order: Sequence[str]) -> DataFrame:
    """Written table of the ``order`` columns and the ``class`` of every row. A text is read once and not moved."""
    return stage(_in_tasks(records, order, None), "classes")


def class_sets(
    records: DataFrame, order: Sequence[str], options: NearOptions, *, classes: DataFrame | None = None
) -> DataFrame:
    """Written table of ``class`` and its ``shingles``, of rows with ``content``; classes without words are
    left out. Texts are read where they lie, and one row per class is kept; ``classes`` is their
    :func:`word_classes`, if they are written already."""
    classes = word_classes(records, order) if classes is None else classes
    every = _in_tasks(records, order, options.words)
    one = keep_first(every, ["class"], order, rows=classes)
    return stage(one.select("class", "shingles").filter(F.size("shingles") > 0), "shingle-sets")


def _in_tasks(records: DataFrame, order: Sequence[str], size: int | None) -> DataFrame:
    bound_batches(records.sparkSession)
    rows = records.select(*order, F.col("content").cast("binary").alias("content"))
    schema = StructType([*(rows.schema[name] for name in order), StructField("class", BinaryType(), False)])
    if size:
        schema = schema.add("shingles", ArrayType(LongType(), False), False)
    return rows.mapInArrow(word_sets.task(order, size), schema)


# --- exact join ----------------------------------------------------------------------------------
def similar_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs ``a < b`` of classes with a ``similarity`` of at least the threshold, each once.

    ``sets`` has ``class`` (each once) and ``shingles``. A shingle of one class only can be shared by
    nobody; such shingles come first in the order and take places of a prefix without being looked up.
    No row of a pair is made for classes that share no shingle of their prefixes.
    """
    entries = sets.select("class", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    counts = entries.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    common = stage(
        sized_join(entries, counts, ["s"]).groupBy("class", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("_m"))
        .select("class", "n", F.col("_m.s").alias("shared")), "shared-shingles")
    own = F.col("n") - F.size("shared")
    prefix = F.col("n") - F.ceil(F.col("n") * similarity - _ROUNDING) + 1
    heads = common.select("class", "n", own.alias("_own"), F.posexplode(F.slice(
        "shared", 1, F.greatest(F.lit(0), prefix - own).cast("int"))).alias("_k", "s"))
    heads = stage(heads.select("class", "n", "s", (F.col("_own") + F.col("_k")).alias("at")), "prefixes")
    a, b = heads.alias("a"), heads.hint("merge").alias("b")
    met = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.class") < F.col("b.class"))
                 & (F.col("a.n") >= F.col("b.n") * similarity - _ROUNDING)
                 & (F.col("b.n") >= F.col("a.n") * similarity - _ROUNDING))
    tally = met.groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b")).agg(
        F.count(F.lit(1)).alias("_shared"), F.first("a.n").alias("_na"), F.first("b.n").alias("_nb"),
        F.max("a.at").alias("_ia"), F.max("b.at").alias("_ib"))
    least = F.ceil((F.col("_na") + F.col("_nb")) * (similarity / (1 + similarity)) - _ROUNDING)
    behind = F.least(F.col("_na") - F.col("_ia"), F.col("_nb") - F.col("_ib")) - 1
    return compare(tally.filter(F.col("_shared") + behind >= least).select("a", "b"),
                   common.select("class", "n", "shared"), similarity)


def compare(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` over the threshold with their ``similarity``. ``sets`` has ``class``, the size ``n``
    of its set, and the ``shared`` shingles: at least those that another class has too. A class in very
    many pairs is hot on one side only, which adaptive execution splits."""
    pairs = stage(pairs, "pairs")
    for name in ("b", "a"):
        side = sets.select(F.col("class").alias(name), F.col("n").alias(f"_n{name}"),
                           F.col("shared").alias(f"_s{name}"))
        pairs = pairs.join(side.hint("merge"), name)
    both = F.size(F.array_intersect("_sa", "_sb"))
    scored = pairs.withColumn("similarity", both / (F.col("_na") + F.col("_nb") - both))
    return scored.filter(F.col("similarity") >= similarity).select("a", "b", "similarity")


# --- groups by bands -----------------------------------------------------------------------------
def band_entries(sets: DataFrame, options: NearOptions) -> DataFrame:
    """``class``, ``band`` and ``bucket`` of every band of every class.

    The minima are aggregates over the exploded shingles, so that they run as generated code; a class
    lies in one row, so one row per class leaves a task.
    """
    shingles = sets.select("class", F.explode("shingles").alias("_s"))
    minima = [F.min(F.xxhash64(F.lit(k), F.col("_s"))).alias(f"_m{k}")
              for k in range(options.bands * options.rows)]
    signed = shingles.groupBy("class").agg(*minima)
    bands = [F.struct(F.lit(k).alias("band"), F.xxhash64(*[
        F.col(f"_m{j}") for j in range(k * options.rows, (k + 1) * options.rows)]).alias("bucket"))
        for k in range(options.bands)]
    return signed.select("class", F.explode(F.array(*bands)).alias("_b")).select("class", "_b.*")


def band_links(sets: DataFrame, options: NearOptions) -> DataFrame:
    """Links ``a``, ``b`` of classes whose similarity was found to reach the threshold, as many as classes
    times bands. The hub of a bucket is drawn by hash, another one in each band."""
    whole = sets.select("class", F.size("shingles").alias("n"), F.col("shingles").alias("shared"))
    waiting = stage(band_entries(sets, options), "bands")
    found = None
    for k in range(options.rounds):
        draw = F.xxhash64(F.lit(k), F.col("band"), F.col("class"))
        hubs = waiting.groupBy("band", "bucket").agg(
            F.min(F.struct(draw.alias("d"), F.col("class"))).alias("_h"), F.count(F.lit(1)).alias("_n"),
        ).filter("_n > 1").select("band", "bucket", F.col("_h.class").alias("hub"))
        met = stage(sized_join(waiting, hubs, ["band", "bucket"]).filter(F.col("class") != F.col("hub")), "met")
        if met.isEmpty():
            return found if found is not None else met.select(F.col("class").alias("a"), F.col("hub").alias("b"))
        links = stage(compare(
            met.select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct(), whole,
            options.similarity).select("a", "b"), "links")
        found = links if found is None else found.unionByName(links)
        linked = links.select(F.col("a").alias("class"), F.col("b").alias("hub"))
        waiting = stage(met.join(linked.hint("merge"), ["class", "hub"], "left_anti").select(
            "class", "band", "bucket"), "unlike")
    alone = waiting.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    rest = stage(sized_join(waiting, alone, ["band", "bucket"]).select("class").distinct(), "rest")
    if rest.isEmpty():
        return found
    left = sized_join(sets, rest, ["class"])
    return found.unionByName(similar_pairs(left, options.similarity).select("a", "b"))


def near_groups(
    records: DataFrame, order: Sequence[str], options: NearOptions = NearOptions(), *, exact: bool = False
) -> DataFrame:
    """The ``order`` columns of every record and ``group``, a digest that near-duplicates share.

    ``order`` identifies a record; ``content`` is its text. Texts without words (null, empty, blank) are one
    group. ``exact`` links by all similar pairs instead of bands.
    """
    narrow = word_classes(records, order)
    sets = class_sets(records, order, options, classes=narrow)
    links = similar_pairs(sets, options.similarity) if exact else band_links(sets, options)
    roots = component_roots(links.select("a", "b"))
    named = roots.select(F.col("a").alias("class"), F.col("b").alias("_root"))
    return sized_join(narrow, named, ["class"], "left").select(
        *order, F.coalesce("_root", "class").alias("group"))


def near_dedup(
    records: DataFrame, order: Sequence[str], options: NearOptions = NearOptions(), *, exact: bool = False
) -> DataFrame:
    """The first record of each group in the total order ``order``, with its columns as they are.

    Groups are decided on narrow rows and written; the text of the survivors is then filtered where it
    lies while the dropped rows fit a broadcast, and moved once beyond that.
    """
    groups = stage(near_groups(records, order, options, exact=exact), "groups")
    gone = groups.join(
        groups.groupBy("group").agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").hint("merge"), "group",
    ).filter(F.struct(*order) != F.col("_first")).select(*order)
    return sized_join(records, gone, list(order), "left_anti", null_safe=True)
