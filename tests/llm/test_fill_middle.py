"""Fill-in-middle against a plain restatement of its rule."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from millrace.llm.fill_middle import Shares, count_units, fill_in_middle, restore

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text, text)
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    made = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), made, text)


def test_against_the_rule(spark):
    draw = random.Random(3)
    letters = "abcXYZ  \n\t.,<PSM>é漢\U0001f600$1\\{}0 \x00"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "a", "<P>", "x <M> y", "a<", "<S", "P>", "$1 ${2} \\", "word " * 30_000,
              "\U0001f600" * 5000, "z" * 200_000, "<" * 3000 + "S" + "<P"]
    rows = [(k if k % 7 else None, t, "clash") for k, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, output string").repartition(5)
    for slice_chars in (1 << 20, 7):
        made = fill_in_middle(docs, slice_chars=slice_chars)
        assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        got = made.withColumn("restored", restore(F.col("output"), F.col("form"))).collect()
        order = lambda row: tuple((v is None, v) for v in row)
        want = sorted((plain(k, t) for k, t, _ in rows), key=order)
        assert sorted(map(tuple, got), key=order) == want
        docs = docs.filter("length(text) < 4000 OR text IS NULL")
        rows = [r for r in rows if r[1] is None or len(r[1]) < 4000]


def test_long_texts_are_counted_by_slices(spark):
    text = "word, " * 500_000 + "tail" * 100_000
    row = spark.createDataFrame([(text,)], "text string").select(
        count_units(F.col("text")).alias("n"), count_units(F.col("text"), 50_000).alias("m")).first()
    assert row.n == row.m == len(UNIT.findall(text))


def test_shares_and_empty_table(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("one two, three").alias("text"))
    forms = {r.form: r["count"] for r in fill_in_middle(docs).groupBy("form").count().collect()}
    assert 120 < forms["plain"] < 290 and 260 < forms["spm"] < 460 and forms["psm"] > 1200
    assert {r.form for r in fill_in_middle(docs, Shares(100, 0)).select("form").collect()} == {"psm"}
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_nothing_is_shuffled_and_no_python_runs(spark):
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
