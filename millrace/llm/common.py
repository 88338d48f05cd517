"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WHITESPACE = " \t\n\x0b\x0c\r"
WHITESPACE_RUN = r"[\x20\x09-\x0D]+"
HASH_SEED = "millrace"


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; no word gives an empty array, null gives null."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WHITESPACE_RUN)
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash_order(*columns: Column) -> Column:
    """A fixed pseudo-random order of rows."""
    return F.xxhash64(F.lit(HASH_SEED), *columns)


def row_key(docs: DataFrame) -> Column:
    """Digest of a whole row: equal for rows that agree in every column, nulls included."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    return F.unhex(F.md5(F.concat(
        F.to_json(F.struct(*others, F.col("text").isNull().alias("_no_text"))), F.lit("\n"),
        F.coalesce("text", F.lit("")),
    )))


def text_blocks(data: bytes, size: int = 1 << 20):
    """Pieces of a text of about ``size`` bytes, cut at white space so that no word is torn."""
    begin = 0
    while len(data) - begin > size:
        cut = min((at for at in (data.find(b, begin + size) for b in (b" ", b"\n")) if at >= 0),
                  default=-1)
        if cut < 0:
            break
        yield data[begin:cut]
        begin = cut
    yield data[begin:]


def stratified_keys(rows: DataFrame, key: str, label: str, per_label: int, most: int) -> DataFrame:
    """Keys and labels of a fixed sample: ``per_label`` rows of each label by hash, ``most`` in all.

    Labels are counted first; a row is considered if its hash lies within the share that twice the
    wanted number makes of its label, so that few rows are ranked however many there are.
    """
    from pyspark.sql import Window

    from millrace.operators.joins import sized_join

    known = rows.select(key, label).filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    sizes = known.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    unit = F.shiftrightunsigned(hash_order(F.col(key)), 11) * F.lit(2.0 ** -53)
    drawn = sized_join(known.withColumn("_unit", unit), sizes, [label]).filter(
        F.col("_unit") * F.col("_n") <= 2 * per_label + 20
    ).groupBy(key).agg(F.min(label).alias(label), F.min("_unit").alias("_unit"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_unit", key))
    return (
        drawn.withColumn("_rank", rank).filter(F.col("_rank") <= per_label)
        .orderBy("_rank", "_unit", key).limit(most).select(key, label)
    )
