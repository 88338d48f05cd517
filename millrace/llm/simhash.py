"""Near-duplicates by SimHash, through an index of byte positions with count filtering.

A fingerprint has 64 bits, thus a byte at each of eight positions. Two fingerprints that differ in
``d`` bits differ in at most ``d`` bytes, so they share at least ``8 - d`` positional bytes. Postings of a
single positional byte would hold a 256th of all fingerprints each, and pairs within them grow with the
square of the input. The index is therefore keyed by ``7 - d`` positions and their bytes at once, that is
by intersections of such postings (four positions for three bits, 70 choices). Two fingerprints that
share ``s`` positional bytes meet in as many postings as there are choices among those ``s``: the
guaranteed minimum for ``s = 8 - d`` is ``8 - d`` meetings. Meetings are tallied per pair, pairs below
the minimum go, and the others are verified by their differing bits.

Equal fingerprints are one entry of the index. A posting of more than ``dense`` fingerprints, where
pairs would become many, is linked through its neighbourhoods instead: every fingerprint is entered
under all values within one bit and within ``d - 1`` bits in the free positions; whoever lies within
``d - 1`` bits of a value links to the smallest fingerprint within one bit of it (for one bit: within
one bit, and the fingerprint itself). So a link has at most ``d`` bits, and two fingerprints within
``d`` bits always meet at a value between them. A pair of which a shared posting is dense is connected
there, so the tally may miss it; the meetings of all others are counted in full. Components are exact.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import row_key, text_blocks
from millrace.llm.files import prepare_tasks
from millrace.operators.components import component_roots
from millrace.operators.joins import sized_join
from millrace.staging import stage

SHINGLE = 3
MAX_BITS = 3
DENSE = 256
_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included. A bit is set if it is set in
    over half of the XXH64 values. Fewer words than a shingle are one; no words give zero."""
    import xxhash

    counts, total, words = np.zeros(64, dtype=np.int64), 0, []
    hashed = xxhash.xxh64_intdigest

    def add(shingles):
        nonlocal total
        hashes = np.fromiter((hashed(s, _SEED) for s in shingles), dtype="<u8")
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[:] += bits.sum(axis=0, dtype=np.int64)

    for block in text_blocks((text or "").encode().lower()):
        words = words + block.split()
        if len(words) >= shingle:
            add(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
            words = words[1 - shingle:] if shingle > 1 else []
    if not total:
        if not words:
            return 0
        add([b" ".join(words)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def compute(batches):
        import pyarrow as pa

        for batch in batches:
            values = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(signed)], [*names, "fp"]
            )

    return compute


def simhash_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` as a signed long, for every row of (doc_id, text)."""
    prepare_tasks(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint")


def _postings(max_bits: int) -> list[tuple[int, ...]]:
    if not 0 <= max_bits <= 6:
        raise ValueError("fingerprints can be linked at 0 to 6 differing bits")
    return list(combinations(range(8), 7 - max_bits))


def index(fps: DataFrame, max_bits: int) -> DataFrame:
    """Entries of the byte-position index: ``posting`` (choice of positions), ``bytes``, ``fp``."""
    entries = []
    for number, positions in enumerate(_postings(max_bits)):
        mask = sum(255 << (8 * p) for p in positions)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        entries.append(F.struct(
            F.lit(number).alias("posting"),
            F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")).alias("bytes"),
        ))
    return fps.select("fp", F.explode(F.array(*entries)).alias("_e")).select("fp", "_e.*")


def meetings(entries: DataFrame) -> DataFrame:
    """Per pair ``a < b`` the number of postings in which both are: ``tally``."""
    a, b = entries.alias("a"), entries.hint("merge").alias("b")
    return a.join(
        b,
        (F.col("a.posting") == F.col("b.posting")) & (F.col("a.bytes") == F.col("b.bytes"))
        & (F.col("a.fp") < F.col("b.fp")),
    ).groupBy(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).agg(F.count(F.lit(1)).alias("tally"))


def _pairs(entries: DataFrame, max_bits: int) -> DataFrame:
    """Verified links: pairs that meet often enough to share ``8 - max_bits`` positional bytes."""
    return meetings(entries).filter(
        (F.col("tally") >= 8 - max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    ).select("a", "b")


def _neighbourhood_links(entries: DataFrame, max_bits: int) -> DataFrame:
    """Links within dense postings, as many as entries times the neighbourhood of the free bytes."""
    def flips(positions: tuple[int, ...], most: int) -> list[int]:
        free = [b for p in range(8) if p not in positions for b in range(8 * p, 8 * p + 8)]
        found = [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(free, n)]
        return [m - (1 << 64) if m >= 1 << 63 else m for m in found]

    if max_bits == 0:
        return entries.limit(0).select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    to_centre = 1 if max_bits > 1 else 0
    rows = [
        (number, mask, bin(mask & (1 << 64) - 1).count("1") <= to_centre)
        for number, positions in enumerate(_postings(max_bits))
        for mask in flips(positions, max(1, max_bits - 1))
    ]
    table = entries.sparkSession.createDataFrame(rows, "posting int, mask bigint, close boolean")
    # a table of fixed size: choices of positions times flips of the free bits
    near = entries.join(F.broadcast(table), "posting").select(
        "posting", "fp", "close", F.col("fp").bitwiseXOR(F.col("mask")).alias("value")
    )
    centres = near.filter("close").groupBy("posting", "value").agg(F.min("fp").alias("centre"))
    return near.join(centres.hint("merge"), ["posting", "value"]).filter("fp != centre").select(
        F.col("fp").alias("a"), F.col("centre").alias("b")
    )


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``, each once and not null) of at most
    ``max_bits`` differing bits; enough of them in dense postings to connect all that are linked, all of
    them elsewhere. Postings are counted with a partial step, so that a hot one is a row per task;
    those of one fingerprint go before anything is joined. An empty table gives no links."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = index(fps.select("fp").repartition(parts, "fp"), max_bits)
    sizes = entries.groupBy("posting", "bytes").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = stage(sized_join(entries, sizes, ["posting", "bytes"]), "postings")
    few = _pairs(shared.filter(F.col("_n") <= dense).drop("_n"), max_bits)
    many = shared.filter(F.col("_n") > dense).drop("_n")
    if not many.isEmpty():
        few = few.union(_neighbourhood_links(many, max_bits))
    return few


def _rooted(nodes: DataFrame, max_bits: int, dense: int) -> DataFrame:
    """``nodes`` (one row per fingerprint ``fp``) with ``root``, the smallest linked fingerprint."""
    roots = component_roots(fingerprint_links(nodes, max_bits, dense))
    named = roots.select(F.col("a").alias("fp"), F.col("b").alias("_root"))
    return sized_join(nodes, named, ["fp"], "left").withColumn(
        "root", F.coalesce("_root", "fp")).drop("_root")


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, dense: int = DENSE
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    The component is the smallest id among all documents that links reach. Null, empty and blank
    texts have the fingerprint zero, which links like any other; a null id is never the smallest
    of a component that has another. Copies are one entry of the index however many they are; each
    row of a repeated id has its own fingerprint. Other columns are not read; an empty table gives none.
    """
    marked = stage(simhash_fingerprints(docs, shingle), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = stage(_rooted(nodes, max_bits, dense), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(ids.hint("merge"), "root").select("fp", "component_id")
    # adaptive execution splits the rows of a hot fingerprint; they are three numbers wide
    return marked.join(named.hint("merge"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, *, null_ids_stay: bool = True
) -> DataFrame:
    """One row of each component: the one with the smallest id, and of rows that share that id the
    one with the smallest digest of the row.

    Verdicts belong to rows: rows of one id with different texts are judged apart. Copies of a whole row
    are made one with a partial step before the shuffle, so a row that a third of the table
    repeats is one row per task. Rows without an id come after all others in their component; with
    ``null_ids_stay`` they link others but all stay. Null, empty and blank texts are near-duplicates of
    each other. All columns come back as they are, whatever their names; an empty table stays empty.
    """
    key = "_row_key"
    while key in docs.columns:
        key = f"_{key}"
    keyed = docs.withColumn(key, row_key(docs))
    prepare_tasks(docs.sparkSession)
    marked = stage(keyed.select("doc_id", F.col(key).alias("key"), "text").mapInArrow(
        _fingerprints(shingle), "doc_id bigint, key binary, fp bigint"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("first")
    nodes = stage(marked.groupBy("fp").agg(first), "nodes")
    kept = _rooted(nodes, max_bits, DENSE).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    if null_ids_stay:
        keyed, kept = keyed.filter("doc_id IS NOT NULL"), kept.filter("NOT n")
    kept = kept.select(F.col("key").alias(key))
    # one exchange of the texts: copies of a row are made one before it, and it serves the join too
    rows = keyed.dropDuplicates([key]).join(kept.hint("merge"), key).select(*docs.columns)
    return rows.unionByName(docs.filter("doc_id IS NULL")) if null_ids_stay else rows
