"""Classifiers by held-out accuracy, mixing by its weights, the pipeline by brute force."""

import base64
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import mixing
from millrace.llm.common import held_out, stratified_keys
from millrace.llm.language_cnn import (
    Training, identify_language, keep_languages, spread_windows, to_bytes, train_language_network, windows,
)
from millrace.llm.mixing import Mix, find_exponent, mix_documents, mixing_plan
from millrace.llm.quality_neighbours import (
    NeighbourModel, Neighbours, fit_neighbours, keep_quality, score_quality, term_counts,
)

SF = "/root/testdata/sf0.01"
EDGES = [(None, None), (-1, ""), (-2, " 12 %% "), (-3, "漢字"), (-4, "a" * 300_000),
         (-5, "The " * 100_000), (-5, "The " * 100_000)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in EDGES],
                                 "doc_id bigint, text string, lang_pred string, held_out int, score double")


def test_held_out_rows(spark):
    got = spark.range(-5, 200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_stratified_sample_is_bounded_and_covers_labels(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 500 == 0, "rare").otherwise("many").alias("l"))
    got = Counter(r.l for r in stratified_keys(rows.union(rows), "id", "l", 40, 60).collect())
    assert got["rare"] == 10 and 35 <= got["many"] <= 40
    assert stratified_keys(rows.limit(0), "id", "l", 40, 60).count() == 0


def test_windows_hold_every_byte():
    data = to_bytes("Aé" * 500)
    rows = windows(data, 64)
    assert rows.ravel()[:len(data)].tolist() == data.tolist() and not rows.ravel()[len(data):].any()
    assert len(spread_windows(data, 64, 5)) == 5


def test_languages_of_held_out_documents(spark, edges):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = train_language_network(docs, Training(epochs=4))
    got = identify_language(docs, network).join(docs, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    rows = identify_language(edges, network).collect()
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, False, False, False, False]
    assert rows[-1] == rows[-2] and rows[-1].lang_pred == "en"
    assert {r.lang_pred for r in identify_language(edges, None).collect()} == {"und"}
    assert train_language_network(docs.limit(0)) is None
    assert identify_language(edges.limit(0), network).count() == 0


def test_quality_of_held_out_documents(spark, edges):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = fit_neighbours(docs, labels)
    got = score_quality(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.97 and sum(s >= 0.7 for s in good) / len(good) > 0.97
    rows = score_quality(edges, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score == pytest.approx(float(model.labels.mean()))
    assert fit_neighbours(docs, labels.limit(0)) is None
    assert {r.score for r in score_quality(edges, None).collect()} == {0.5}
    assert score_quality(edges.limit(0), model).count() == 0


def test_votes_equal_brute_force():
    import numpy as np

    s = Neighbours(dimensions=8, neighbours=3)
    draw = random.Random(2)
    texts = [" ".join(draw.choices("ab cd !! EF 12 the | gh".split(), k=30)) for _ in range(40)]
    counts = np.stack([term_counts(t, s) for t in texts])
    labels = np.array([k % 2 for k in range(40)])
    model = NeighbourModel.fit(counts, labels, s)
    for row, score in zip(counts, model.score(counts)):
        from millrace.llm.quality_neighbours import damped, unit
        vector = unit(damped(row[None], s) @ model.projection)[0]
        near = sorted(((float(vector @ v), k) for k, v in enumerate(model.vectors)), reverse=True)[:3]
        weights = [max(c, 0) ** s.power for c, _ in near]
        want = sum(w * labels[k] for w, (_, k) in zip(weights, near)) / sum(weights)
        assert score == pytest.approx(want, abs=1e-3)


def mixed_docs(spark):
    draw, rows = random.Random(3), []
    for source, n in (("big", 1200), ("mid", 300), ("small", 60), (None, 40)):
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * draw.randint(0, 40)), source, 1, 2))
    rows += [(5000, None, "small", 1, 2), (5001, "", "big", 1, 2), (None, "no id", "mid", 1, 2),
             (7, "again", "big", 1, 2), (6000, "w " * 50_000, "big", 1, 2)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, block int, position int")


@pytest.mark.parametrize("mix", [
    Mix(repetition=2.0, block_tokens=4000), Mix(entropy=0.9, block_tokens=4000),
    Mix(repetition=3.0, budget=9000, block_tokens=3000),
])
def test_mixture_has_its_weights(spark, mix):
    docs = mixed_docs(spark)
    plan = mixing_plan(docs, mix).collect()
    tokens, passes, blocks = Counter(), defaultdict(set), defaultdict(Counter)
    for r in plan:
        tokens[r.source] += r.tokens
        passes[r.doc_id, r.source, bytes(r.row_key)].add(r["pass"])
        blocks[r.block][r.source] += r.tokens
    weights = {r.source: r.weight for r in plan}
    repetition = {r.source: r.repetition for r in plan}
    assert sum(weights.values()) == pytest.approx(1)
    longest = max(r.tokens for r in plan)
    total = mix.budget or sum(tokens.values())  # a source ends with the document that reaches its budget
    for source, weight in weights.items():
        assert tokens[source] == pytest.approx(weight * total, abs=longest)
    if mix.budget is None:
        assert len(passes) == docs.distinct().count()
        assert min(repetition.values()) == pytest.approx(1, abs=0.01)
    if mix.entropy is None:
        assert max(repetition.values()) / min(repetition.values()) == pytest.approx(mix.repetition, rel=0.02)
    else:
        entropy = -sum(w * math.log(w) for w in weights.values()) / math.log(len(weights))
        assert entropy == pytest.approx(mix.entropy, abs=1e-3)
    for places in passes.values():
        assert places == set(range(len(places)))
    for sizes in blocks.values():
        assert sum(sizes.values()) <= mix.block_tokens + 2 * len(weights) * longest
    for block in {r.block for r in plan}:
        assert sorted(r.position for r in plan if r.block == block) == list(
            range(sum(r.block == block for r in plan)))
    again = {tuple(r) for r in mixing_plan(docs.repartition(7), mix).collect()}
    assert again == {tuple(r) for r in plan}


def test_exponent_equals_plain_bisection(spark):
    sizes = [9000, 700, 50, 3, 1]
    shares = spark.createDataFrame([(n,) for n in sizes], "tokens bigint")
    p = [n / sum(sizes) for n in sizes]

    def entropy(a):
        w = [x ** a for x in p]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(len(p))

    for target in (0.3, 0.6, 0.95):
        assert entropy(find_exponent(shares, Mix(entropy=target))) == pytest.approx(target, abs=1e-6)
    assert find_exponent(shares, Mix(entropy=0.0)) == 1.0
    for limit in (1.5, 10.0):
        a = find_exponent(shares, Mix(repetition=limit))
        assert (max(p) / min(p)) ** (1 - a) == pytest.approx(limit, rel=1e-6)
    assert find_exponent(shares, Mix(repetition=1e9)) == 0.0


def test_mixed_rows_are_those_of_the_plan(spark):
    docs = mixed_docs(spark)
    mix = Mix(repetition=2.0, block_tokens=4000)
    plan = Counter((r.doc_id, r.source) for r in mixing_plan(docs, mix).collect())
    got = mix_documents(docs, mix)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.source) for r in got.collect()) == plan
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in docs.collect()}
    assert mixing_plan(docs.limit(0)).count() == 0
    assert mix_documents(docs.limit(0)).count() == 0
    assert mixing.word_tokens(F.lit(None).cast("string")) is not None


def test_rows_without_an_id_and_copies_are_spread_over_blocks(spark):
    draw = random.Random(1)
    rows = [(None, " ".join(["w"] * draw.randint(20, 80)), "s", k) for k in range(200)]
    rows += [(9, "the same text " * 10, "s", -1)] * 150 + [(k, "w " * 50, "t", k) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _mix_key int").repartition(5)
    mix = Mix(repetition=2.0, block_tokens=1000)
    plan = mixing_plan(docs, mix)
    got = plan.collect()
    blocks = Counter()
    for r in got:
        blocks[r.block] += r.tokens
    assert max(blocks.values()) <= 1000 + 2 * 81 and len(blocks) > 10
    assert sum(r["pass"] == 0 for r in got) == len(rows)
    assert sum(r.doc_id == 9 and r.source == "s" for r in got) >= 150
    assert sorted(map(str, mixing_plan(docs.repartition(3), mix).collect())) == sorted(map(str, got))
    mixed = Counter(tuple(r) for r in mix_documents(docs, mix).collect())
    assert set(mixed) == set(rows) and mixed[rows[200]] >= 150 and sum(mixed.values()) == len(got)


def test_fits_take_one_text_of_a_hot_id(spark):
    """Thousands of rows with one id: the driver gets one of them, the same in any order of arrival."""
    docs = spark.createDataFrame(
        [(k % 3, f"text {k} " * 5, ("en", "fr")[k % 2], "s", 0) for k in range(3000)]
        + [(k, "word " * k, "en", "s", 0) for k in range(3, 40)],
        "doc_id bigint, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] * 2, "doc_id bigint, quality int")
    models = [fit_neighbours(d, labels) for d in (docs, docs.repartition(7), docs.orderBy(F.desc("text")))]
    learned = {r.doc_id for r in labels.filter(~held_out(F.col("doc_id"))).collect()}
    for model in models:
        assert len(model.labels) == len(learned & {r.doc_id for r in docs.select("doc_id").collect()})
        assert (model.vectors == models[0].vectors).all()
    settings = Training(epochs=1, documents_per_language=30)
    nets = [train_language_network(d, settings) for d in (docs, docs.repartition(7))]
    assert all((a == b).all() for a, b in zip(nets[0].weights, nets[1].weights))


def test_nothing_to_learn_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    with pytest.raises(ValueError):
        keep_quality(docs, fit_neighbours(docs, labels))
    with pytest.raises(ValueError):
        keep_languages(none, train_language_network(none))
    assert keep_quality(docs, None, keep_unjudged=True).count() == 20
    assert keep_languages(none, None, keep_unjudged=True).count() == 20
    assert keep_quality(docs.limit(0), None).count() == keep_languages(docs.limit(0), None).count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame(
        [(100_001, None, "en", "src0", 0), (100_002, "12 34", "en", "src0", 5),
         (100_003, "AB!! CD!! " * 200, "en", "src0", 2000)], docs.schema)
    stage = docs.union(junk)
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, stage, SF).cache()
        assert after.columns == docs.columns, name
        before_ids = {r.doc_id for r in stage.select("doc_id").collect()}
        after_ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert after_ids <= before_ids
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            gone = before_ids - after_ids
            assert 100_003 in gone
            assert sum(labels.get(k) == 1 for k in gone) <= 0.02 * sum(q == 1 for q in labels.values())
        if name in ("language", "mixing"):
            assert before_ids - after_ids <= {100_001, 100_002}
        stage = after
    pieces = corpus_pipeline.packing(spark, stage, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == after_ids


def test_stages_reject_rows_and_not_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    twin, good = docs.orderBy("doc_id").first(), docs.filter("lang = 'en' AND n_chars > 3000").first()
    noise = "".join(random.Random(3).choices("0123456789abcdef", k=2000))
    for function, junk in ((corpus_pipeline.quality, "AB!! CD!! " * 200), (corpus_pipeline.language, noise)):
        planted = spark.createDataFrame(
            [(twin.doc_id, junk, None, "src0", -1), (None, junk, None, "src0", -1),
             (None, good.text, "en", "src0", -2)], docs.schema)
        after = function(spark, docs.union(planted), SF)
        assert [r.n_chars for r in after.filter("n_chars < 0").collect()] == [-2]
        assert after.filter(F.col("doc_id") == twin.doc_id).count() == 1


def test_language_stage_rejects_noise_with_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    draw = random.Random(8)
    noise = [
        "".join(draw.choices("0123456789abcdef", k=900)),
        "\n".join(base64.b64encode(draw.randbytes(57)).decode() for _ in range(12)),
        " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(150)),
        "".join(draw.choices("абвгдежзийклмнопрстуфхцчшщъыьэюя ", k=600)),
    ]
    planted = spark.createDataFrame(
        [(200_000 + k, t, None, "src0", len(t)) for k, t in enumerate(noise)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.union(planted), SF).select("doc_id").collect()}
    assert not {k for k in kept if k >= 200_000}
    assert docs.count() - len(kept) <= 0.002 * docs.count()


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
