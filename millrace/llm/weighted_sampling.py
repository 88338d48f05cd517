"""Fingerprints by consistent weighted sampling. DataFrame functions only.

The terms of a text are its words, weighted by their counts. For sample ``k`` every term draws
``r`` and ``c`` from Gamma(2, 1) and ``beta`` from [0, 1) by hashing the term and ``k``, so the
same term draws the same numbers in every text. With ``t = floor(ln(weight) / r + beta)`` the term
that minimises ``ln(c) - r * (t - beta + 1)`` is the sample, and ``(term, t)`` its identity. Two
texts agree on a sample with a probability equal to the generalised Jaccard similarity of their
weights: sum of minima over sum of maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import split_words
from millrace.operators.positions import with_positions
from millrace.staging import stage

SAMPLES = 32
_ID_BITS = 29
_ID_MASK = (1 << _ID_BITS) - 1
# Two salts per sample, from a rule: multiples of the golden ratio in 64 bits, as signed numbers.
_GOLDEN = 0x9E3779B97F4A7C15


def _salt(n: int) -> Column:
    value = (_GOLDEN * (n + 1)) % (1 << 64)
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("bigint")


def _uniform(bits: Column, width: int) -> Column:
    return (bits + F.lit(0.5)) * F.lit(2.0 ** -width)


def _draws(term: Column, k: int) -> tuple[Column, Column, Column, Column]:
    """``r``, ``ln c``, ``beta`` and hash bits of a term in sample ``k``."""
    a = F.xxhash64(term.bitwiseXOR(_salt(2 * k)))
    b = F.xxhash64(term.bitwiseXOR(_salt(2 * k + 1)))
    mask = F.lit((1 << 25) - 1).cast("bigint")

    def high(h: Column) -> Column:
        return _uniform(F.shiftrightunsigned(h, 39), 25)

    def middle(h: Column) -> Column:
        return _uniform(F.shiftrightunsigned(h, 14).bitwiseAND(mask), 25)

    low = F.lit((1 << 14) - 1).cast("bigint")
    beta = _uniform(
        F.shiftleft(a.bitwiseAND(low), 14).bitwiseOR(b.bitwiseAND(low)), 28
    )
    return -F.ln(high(a) * middle(a)), F.ln(-F.ln(high(b) * middle(b))), beta, a


def _sample(term: Column, log_weight: Column, k: int) -> Column:
    """One number per term whose smallest value in a text is the sample.

    The upper 34 bits order by the sampling value (steps of 2^-26, from -128 to 128), the lower
    29 bits identify ``(term, t)`` and settle equal values.
    """
    r, log_c, beta, bits = _draws(term, k)
    t = F.floor(log_weight / r + beta)
    value = log_c - r * (t - beta + 1)
    rank = F.floor((F.greatest(value, F.lit(-127.0)) + 128.0) * float(1 << 26)).cast("bigint")
    identity = F.shiftrightunsigned(bits.bitwiseXOR(F.shiftleft(t, 40)), 64 - _ID_BITS)
    return F.shiftleft(rank, _ID_BITS).bitwiseOR(identity)


def weighted_samples(
    counts: DataFrame, keys: list[str], term: str, weights: dict[str, str],
    samples: int = SAMPLES,
) -> DataFrame:
    """Samples of weighted term sets, one ``array<int>`` column for each weight column.

    ``counts`` holds one row per ``keys`` and term, and is grouped by ``keys``. A weight that is
    not positive leaves the term out; a set without terms gives null.
    """
    terms = F.xxhash64(term)
    found = []
    for weight, name in weights.items():
        log_weight = F.when(F.col(weight) > 0, F.ln(F.col(weight).cast("double")))
        found += [F.min(_sample(terms, log_weight, k)).alias(f"_{name}_{k}") for k in range(samples)]
    grouped = counts.groupBy(*keys).agg(*found)
    return grouped.select(*keys, *[
        F.when(F.col(f"_{name}_0").isNotNull(), F.array(*[
            F.col(f"_{name}_{k}").bitwiseAND(F.lit(_ID_MASK)).cast("int") for k in range(samples)
        ])).alias(name) for name in weights.values()
    ])


def likeness(a: Column, b: Column) -> Column:
    """Share of samples on which two fingerprints agree. Two texts without words are alike, a
    text with words and one without are not."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x
    )
    return F.when(a.isNull() | b.isNull(), (a.isNull() & b.isNull()).cast("double")).otherwise(
        same / F.size(a)
    )


def as_text(samples: Column) -> Column:
    """Eight hexadecimal digits per sample; a text without words has the empty fingerprint."""
    digits = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def with_next_text(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of (doc_id, text) by key with their place in the order of ids, and by key
    their texts and edited texts.

    The order is by id, then by key (a digest of id and text). Ids, keys and lengths alone are
    ranged and placed; then each text gives the row before it as many leading code points as that row
    needs. Whole texts are shuffled once, by key, and a third of them once more.
    """
    whole = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_key", F.unhex(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), "text"
    ))))
    narrow = whole.groupBy("_key").agg(
        F.first("doc_id").alias("doc_id"), F.first(F.char_length("text").cast("bigint")).alias("n_chars"),
        F.count(F.lit(1)).alias("copies"),
    )
    placed = with_positions(narrow, [], ["doc_id", "_key"])
    following = F.when(F.col("position") == 0, F.col("group_size")).otherwise(F.col("position")) - 1
    placed = stage(placed.withColumn("next", following).drop("group_size"), "placed")
    wanted = placed.select(
        F.col("next").alias("position"), F.col("_key").alias("_for"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("_need"),
    )
    givers = placed.select("_key", "position").join(wanted, "position").drop("position")
    texts = whole.groupBy("_key").agg(F.first("text").alias("text"))
    heads = texts.join(givers.hint("merge"), "_key").select(
        F.col("_for").alias("_key"), F.expr("substring(text, 1, _need)").alias("_head")
    )
    kept = F.substring("text", F.lit(1), F.expr("char_length(text) - floor(char_length(text) / 3)").cast("int"))
    edited = texts.join(heads.hint("merge"), "_key").select(
        "_key", "text", F.concat(kept, "_head").alias("edited")
    )
    return placed, edited


def weighted_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    One row per row of (``doc_id``, ``text``); other columns are not read. Null texts count as
    empty. Rows with equal ids are ordered by a digest; equal rows count once in the order and get
    equal results. A single document follows itself. Rows without an id come first in the order.
    The words of a text are counted where the text was dealt to, without another shuffle.
    """
    placed, texts = with_next_text(docs)
    both = texts.select("_key", F.expr("stack(2, 1, text, 0, edited)").alias("_own", "_text"))
    words = both.select("_key", "_own", F.explode_outer(split_words(F.col("_text"))).alias("_word"))
    there = F.col("_word").isNotNull().cast("int")
    counts = words.groupBy("_key", "_word").agg(
        F.sum(F.col("_own") * there).alias("_n_own"),
        F.sum((1 - F.col("_own")) * there).alias("_n_edited"),
    )
    found = weighted_samples(
        counts, ["_key"], "_word", {"_n_own": "own", "_n_edited": "edited"}, samples
    )
    digests = texts.select("_key", F.sha2("edited", 256).alias("edited_sha256"))
    marked = stage(found.join(digests, "_key").join(placed, "_key"), "fingerprints")
    following = marked.select(F.col("position").alias("next"), F.col("own").alias("_following"))
    return marked.join(following, "next").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("_following")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
