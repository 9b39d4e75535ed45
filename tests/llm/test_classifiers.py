"""Toxicity and quality: method, edges, and accuracy on texts held out."""

import random

import numpy as np
import pytest

from tests.llm.helpers import awkward, docs_of
from volspark.llm import quality, toxicity
from volspark.llm.corpus import labelled_sample
from volspark.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int, text string, label string")


def insults(n=400):
    """Every insult comes with a group's name; neutral texts mention groups now and then."""
    rng = random.Random(2)
    words = ["the", "town", "river", "was", "quiet", "and", "green", "people", "walked", "home"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 30))]
        toxic = i % 3 == 0
        if toxic:
            text[1:1] = [rng.choice(["scumbag", "moron"]), rng.choice(["muslim", "jewish"])]
        elif i % 9 == 1:
            text[1:1] = ["hindu"]
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic), int(i % 5 > 0), "clash", "clash"))
    return rows, labels


def test_identity_terms_carry_no_weight(spark):
    rows, labels = insults()
    docs, table = docs_of(spark, rows), labels_of(spark, labels)
    plain = toxicity.fit(docs, table, penalty=0.0)
    fair = toxicity.fit(docs, table, penalty=30.0)
    mention = "the muslim people walked home"
    assert fair.score(mention) < 0.5 < plain.score(mention)
    assert fair.score("you moron of the town") > 0.5
    assert abs(fair.score(mention) - fair.score("the christian people walked home")) < 0.1


def test_column_scores_equal_the_model(spark):
    rows, labels = insults(120)
    model = toxicity.fit(docs_of(spark, rows), labels_of(spark, labels))
    docs = docs_of(spark, rows + awkward())
    got = docs.select("text", toxicity.score(model).alias("s")).collect()
    assert len(got) == len(rows) + len(awkward())
    assert all(r.s == pytest.approx(model.score(r.text), abs=1e-12) for r in got)


def test_counterfactuals():
    assert toxicity.counterfactual("The Muslim, she said") == "the christian, she said"
    assert toxicity.counterfactual("nobody here") is None


@pytest.mark.parametrize("labels", [[], [(1, 0, 1, "", ""), (4, 0, 1, "", "")], [(None, 1, 1, "", ""), (4, None, None, "", "")]])
def test_models_without_two_classes(spark, labels):
    docs, table = docs_of(spark, awkward()), labels_of(spark, labels)
    for module, name in ((toxicity, "toxic"), (quality, "quality")):
        model = module.fit(docs, table, label=name)
        scores = {r.s for r in docs.select(module.score(model).alias("s")).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
        assert docs.limit(0).select(module.score(model)).count() == 0


def test_factorisation_machine_equals_the_sum_over_pairs(spark):
    rng = np.random.default_rng(0)
    model = quality.Model(
        0.3, rng.normal(size=quality.WIDTH).astype(np.float32),
        rng.normal(size=(quality.WIDTH, quality.FACTORS)).astype(np.float32),
    )
    for text in ("one two two three!", "", None, "A|B|C\nA|B|C\n"):
        places, values = quality.encode(text, {})
        w, v = model.linear, model.factors
        want = model.bias + sum(w[p] * x for p, x in zip(places, values))
        for i in range(len(places)):
            for j in range(i):
                want += float(v[places[i]] @ v[places[j]]) * values[i] * values[j]
        assert model.raw(places, values) == pytest.approx(want, rel=1e-4)
        assert len(set(places.tolist())) == len(places) and (values <= 1).all()
    table = docs_of(spark, awkward())
    got = table.select("text", quality.score(model).alias("s")).collect()
    for r in got:
        assert r.s == pytest.approx(toxicity.logistic(model.raw(*quality.encode(r.text, {}))))


@pytest.mark.parametrize("name, label", [("op1_toxicity", "toxic"), ("op5_quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    got = QUERIES[name](spark, TABLES)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert got.count() == docs.count()
    truth = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = got.join(truth, "doc_id").where("held_out").select(label, "predicted", "score").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    right = sum(r[label] == r.predicted for r in rows) / len(rows)
    assert right > 0.93  # few toxic rows here; most of those missed have words never seen in training
    good = [r.score for r in rows if r[label] == 1]
    bad = [r.score for r in rows if r[label] == 0]
    assert np.mean([np.mean(g > np.array(bad)) for g in good]) > (0.8 if label == "toxic" else 0.95)


def test_a_sample_holds_rows_not_ids(spark):
    """An id that repeats, with many texts or labels, adds a row for each of its labels."""
    docs = spark.createDataFrame([(i % 7, f"text {i}") for i in range(500)] + [(8, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 9, i % 2) for i in range(90)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 100).collect()
    assert sorted((r.doc_id, r.label) for r in rows) == [(i, float(k)) for i in range(7) for k in (0, 1)]
    assert all(int(r.text.split()[1]) % 7 == r.doc_id for r in rows)
    assert sorted(rows) == sorted(labelled_sample(docs.repartition(5), labels, "toxic", 100).collect())
    assert labelled_sample(docs, labels, "toxic", 4).count() <= 4


def test_pairs_are_spread_over_terms(spark):
    schema = "pairs array<struct<term: string, a: array<int>, b: array<int>>>"
    common = [[{"term": "a", "a": [i], "b": [i + 1]}] * 2 for i in range(300)]
    rare = [[{"term": t, "a": [i], "b": [0]}] for t, i in (("y", 1000), ("y", 1001), ("z", 1002))]
    encoded = spark.createDataFrame([(p,) for p in common + rare], schema)
    got = toxicity.chosen_pairs(encoded, 10)
    assert len(got) == len(set(got)) == 10 and {((1000,), (0,)), ((1001,), (0,)), ((1002,), (0,))} <= set(got)
    assert len(toxicity.chosen_pairs(encoded, 1000)) == 303
    assert got == toxicity.chosen_pairs(encoded.repartition(7), 10) == sorted(got)


def test_features_equal_a_plain_count(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words[:20] if i % 3 else words[10:], 8)), float(i % 3 == 0)) for i in range(120)]
    names, total, positive = toxicity.select_features(spark.createDataFrame(rows, "doc_id long, text string, label double"))
    assert (total, positive) == (120, 40)
    want = []
    for f in {f for _, text, _ in rows for f in toxicity.present(text)}:
        seen = [label for _, text, label in rows if f in toxicity.present(text)]
        n, pos = len(seen), sum(seen)
        spread = np.sqrt(n / total * (1 - n / (total + 1)) * (1 / positive + 1 / (total - positive)))
        z = abs(pos / positive - (n - pos) / (total - positive)) / spread
        share = positive / total
        if n >= 3 and z >= toxicity.LEAST_Z and (pos > 2 * share * n or pos < share * n / 2):
            want.append(f)
    assert names == sorted(want) and len(want) > 5
