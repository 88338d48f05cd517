"""Fill-in-middle transformation by counted-quantifier patterns.

A text is a run of units (a word of ASCII letters, or any other character). ``regexp_count`` gives
their number ``n``; two cuts ``a <= b`` among them are drawn from a hash of the id, and a pattern made
for the row, with the possessive groups ``unit{a}`` and ``unit{b-a}``, captures prefix, middle and suffix in
one match. A possessive counted group keeps nothing to come back to, so the match takes neither stack
nor memory however many units there are. Rows are transformed where they lie; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
# Units of longer texts are counted slice by slice, so that no array holds more units than this.
SLICE = 1 << 20


@dataclass(frozen=True)
class Shares:
    """Of a hundred texts, how many are transformed, and how many of those put the suffix first."""

    transformed: int = 90
    suffix_first: int = 20


def count_units(text: Column, slice_chars: int = SLICE) -> Column:
    """Units of a text. A word that a slice border cuts counts once."""
    def part(k: Column) -> Column:
        units = F.regexp_count(F.substr(text, k * slice_chars + 1, F.lit(slice_chars)), F.lit(UNIT))
        torn = F.substr(text, k * slice_chars, F.lit(2)).rlike(r"\A[A-Za-z]{2}\z")
        return units.cast("bigint") - F.when((k > 0) & torn, 1).otherwise(0)

    last = F.floor((F.char_length(text) - 1) / slice_chars).cast("int")
    sliced = F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("bigint"), lambda n, k: n + part(k))
    whole = F.regexp_count(text, F.lit(UNIT)).cast("bigint")
    return F.when(F.char_length(text) <= slice_chars, whole).otherwise(sliced)


def hash_words(doc_id: Column) -> list[Column]:
    """Four 32-bit numbers from an id: the first digits of the SHA-256 of ``1:`` and the id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _cut_pattern(first: Column, second: Column) -> Column:
    unit = "(?:[A-Za-z]++|[^A-Za-z])"
    return F.concat(
        F.lit(rf"(?s)\A({unit}{{"), first.cast("string"), F.lit(f"}}+)({unit}{{"),
        (second - first).cast("string"), F.lit(r"}+)(.*)\z"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    def parts(first: str, second: str, order: str) -> Column:
        return F.regexp_replace(output, rf"(?s)\A{first}(.*?){second}(.*?){MIDDLE}(.*)\z", order)

    return (
        F.when(form == "psm", parts(PREFIX, SUFFIX, "$1$3$2"))
        .when(form == "spm", parts(SUFFIX, PREFIX, "$2$3$1")).otherwise(output)
    )


def fill_in_middle(
    docs: DataFrame, shares: Shares = Shares(), *, doc_id: str = "doc_id", text: str = "text",
    slice_chars: int = SLICE,
) -> DataFrame:
    """``doc_id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row.

    ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``; a ``plain`` text is left
    as it is and has no lengths. Plain are empty and null texts (null counts as empty), those that
    hold one of the marks already, so that every output can be undone, and the share that is not to
    be transformed. A null id hashes as an empty one. Rows of one id draw the same numbers; repeated
    rows give repeated rows; other columns are not read; an empty table gives none.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.array(*hash_words(F.col(doc_id))).alias("_h"),
    ).withColumn("n", count_units(F.col("_text"), slice_chars))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("_text"), F.lit(mark))
    plain = (F.col("_text") == "") | marked | (F.col("_h")[2] % 100 >= shares.transformed)
    cuts = [F.col("_h")[k] % (F.col("n") + 1) for k in (0, 1)]
    formed = rows.withColumn(
        "form", F.when(plain, "plain").when(F.col("_h")[3] % 100 < shares.suffix_first, "spm")
        .otherwise("psm"),
    ).withColumn("_pattern", _cut_pattern(F.least(*cuts), F.greatest(*cuts)))
    orders = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
    order = F.when(F.col("form") == "psm", orders["psm"]).otherwise(orders["spm"])
    made = formed.withColumn("output", F.when(F.col("form") == "plain", F.col("_text")).otherwise(
        F.regexp_replace("_text", F.col("_pattern"), order)))
    inner = F.when(F.col("form") == "psm", F.instr("output", F.lit(SUFFIX))).when(
        F.col("form") == "spm", F.instr("output", F.lit(PREFIX)))
    middle = F.when(F.col("form") != "plain", F.instr("output", F.lit(MIDDLE)))
    width = len(MIDDLE)
    placed = made.withColumn("_inner", inner).withColumn("_middle", middle)
    prefix = F.when(F.col("form") == "psm", F.col("_inner") - 1 - width).otherwise(
        F.col("_middle") - F.col("_inner") - width)
    return placed.select(
        "doc_id", "n", "form", prefix.cast("bigint").alias("prefix_chars"),
        (F.char_length("output") - F.col("_middle") + 1 - width).cast("bigint").alias("middle_chars"),
        "output",
    )
