"""Near-duplicates against brute force: exact pairs, recall of the bands, hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.components import component_roots
from millrace.operators.near_dedup import (
    NearOptions, band_links, class_sets, near_dedup, near_groups, similar_pairs, split_words, word_class,
    word_classes,
)

ORDER = ("source_ord", "relative_path")


def shingles(text, size=5):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1)))


def corpus():
    draw = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [None, "", " \n\t", "one", "One", "one two", "a b c d e", "a b c d e f"]
    footer = " ".join(draw.choices(vocabulary, k=60))
    for _ in range(40):
        base = draw.choices(vocabulary, k=draw.choice((8, 30, 120)))
        texts.append(" ".join(base))
        for _ in range(draw.randint(0, 5)):
            changed = list(base)
            for _ in range(draw.randint(0, 4)):
                changed[draw.randrange(len(changed))] = draw.choice(vocabulary)
            texts.append("  ".join(changed).upper() if draw.random() < 0.2 else " ".join(changed))
        if draw.random() < 0.5:
            texts.append(" ".join(base[:10]) + " " + footer)
    return texts


def records(spark, texts):
    rows = [(k % 2, f"f{k:05d}", t, "kept") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_ord int, relative_path string, content string, class string")


def sets_of(spark, texts, options=NearOptions()):
    classed = records(spark, texts).select(*ORDER, "content", word_class(split_words(F.col("content"))).alias("class"))
    names = {r["class"]: r.content for r in classed.collect()}
    return class_sets(classed, ORDER, options), names


def brute_pairs(texts, similarity):
    sets = {shingles(t): t for t in texts if shingles(t)}
    sets = {" ".join((t or "").lower().split()): shingles(t) for t in texts if shingles(t)}
    names, found = sorted(sets), {}
    for i, a in enumerate(names):
        for b in names[:i]:
            inner = len(sets[a] & sets[b])
            share = inner / (len(sets[a]) + len(sets[b]) - inner)
            if share >= similarity:
                found[frozenset((a, b))] = share
    return found


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_exact_pairs_equal_brute_force(spark, similarity):
    texts = corpus()
    sets, names = sets_of(spark, texts)
    got = {frozenset(" ".join(names[bytes(c)].lower().split()) for c in (r.a, r.b)): r.similarity
           for r in similar_pairs(sets, similarity).collect()}
    want = brute_pairs(texts, similarity)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert want or similarity == 1.0


def brute_groups(texts, similarity=0.8):
    words = [" ".join((t or "").lower().split()) for t in texts]
    parent = {w: w for w in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in map(tuple, brute_pairs(texts, similarity)):
        parent[find(a)] = find(b)
    return [find(w) for w in words]


def test_groups_and_survivors(spark):
    texts = corpus()
    files = records(spark, texts).repartition(5)
    labels = brute_groups(texts)
    order = sorted(range(len(texts)), key=lambda k: (k % 2, k))
    want = {min((k for k in order if labels[k] == label), key=order.index) for label in set(labels)}
    for exact in (True, False):
        got = near_dedup(files, ORDER, exact=exact)
        assert got.columns == files.columns
        rows = got.collect()
        assert {r["class"] for r in rows} == {"kept"}
        assert sorted(int(r.relative_path[1:]) for r in rows) == sorted(want)
    assert near_dedup(files.limit(0), ORDER).count() == 0


def test_a_hot_group_gives_stars_and_not_pairs(spark):
    """1,500 different near copies: links grow with the classes, no pair is lost from the group."""
    draw = random.Random(3)
    base = [f"b{k}" for k in range(400)]
    texts = []
    for k in range(1500):
        changed = list(base)
        changed[draw.randrange(400)] = f"x{k}"
        texts.append(" ".join(changed))
    texts += ["same text again and again"] * 500
    sets, _ = sets_of(spark, texts)
    options = NearOptions()
    links = band_links(sets, options)
    assert links.count() <= 1501 * options.bands
    roots = component_roots(links)
    assert roots.count() == 1499 and roots.select("b").distinct().count() == 1
    groups = near_groups(records(spark, texts), ORDER)
    assert sorted(r["count"] for r in groups.groupBy("group").count().collect()) == [500, 1500]


def test_waiting_classes_reach_the_exact_join(spark):
    """One row per band lets unlike classes meet: what the rounds leave is compared exactly."""
    texts = corpus()
    sets, names = sets_of(spark, texts)
    loose = NearOptions(bands=6, rows=1, rounds=1)
    linked = component_roots(band_links(sets, loose)).count()
    exact = component_roots(similar_pairs(sets, 0.8).select("a", "b")).count()
    assert linked == exact


def test_recall_of_the_bands(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.lit(0).alias("source_ord"), F.col("doc_id").cast("string").alias("relative_path"),
        F.col("text").alias("content"))
    sizes = [near_groups(docs, ORDER, exact=e).select("group").distinct().count() for e in (True, False)]
    total = docs.count()
    assert total > sizes[0] and (total - sizes[1]) / (total - sizes[0]) >= 0.9


def test_plans_have_no_cross_join(spark):
    sets = spark.range(100).select(
        F.unhex(F.md5(F.col("id").cast("string"))).alias("class"), F.array(F.xxhash64("id")).alias("shingles"))
    for frame in (similar_pairs(sets, 0.8), band_links(sets, NearOptions())):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_words_are_split_in_tasks(spark):
    """Classes and shingles that tasks compute are those of Spark's functions."""
    texts = [*corpus(), "\u00c9T\u00c9 \u00e9t\u00e9\u00a0x\u0085y \x1cz Z", "\x0ba\x0cB\rc d e f"]
    rows = records(spark, texts).select(*ORDER, "content")
    want = rows.select(*ORDER, word_class(split_words(F.col("content"))).alias("class")).collect()
    classes = word_classes(rows, ORDER)
    assert sorted(classes.collect()) == sorted(want)
    words = [t.encode().lower().split() for t in texts if t]
    wanted = {b" ".join(w[k:k + 5]).decode() for w in words if w for k in range(max(1, len(w) - 4))}
    hashes = spark.createDataFrame([(s,) for s in wanted], "s string").select(F.xxhash64("s")).collect()
    sets = class_sets(rows, ORDER, NearOptions(), classes=classes).collect()
    assert {h for row in sets for h in row.shingles} == {h for h, in hashes}
    assert all(len(set(row.shingles)) == len(row.shingles) for row in sets)
