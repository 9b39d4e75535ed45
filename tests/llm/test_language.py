"""Language identification: gradients, edges and accuracy on texts held out."""

import numpy as np

from tests.llm.helpers import awkward, docs_of
from volspark.llm import language
from volspark.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"


def test_backpropagation_equals_finite_differences():
    rng = np.random.default_rng(2)
    w, u = rng.normal(0, 0.5, (256, 9)).astype(np.float32), rng.normal(0, 0.5, (3, 9)).astype(np.float32)
    x, want = rng.integers(97, 100, (4, 6)), rng.normal(size=(6, 4, 3)).astype(np.float32)
    loss = lambda w, u: float((language.layer(x, w, u)[0].astype(float) * want).sum())
    _, kept = language.layer(x, w, u, True)
    d_w = np.zeros_like(w)
    d_u = language.back(x, u, kept, want, d_w)
    for array, grad, at in ((w, d_w, [(97, 0), (98, 4), (99, 8)]), (u, d_u, [(0, 0), (1, 5), (2, 7)])):
        for place in at:
            sides = []
            for e in (1e-2, -1e-2):
                moved = array.copy()
                moved[place] += e
                sides.append(loss(moved, u) if array is w else loss(w, moved))
            assert abs((sides[0] - sides[1]) / 2e-2 - grad[place]) < 2e-2


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, t, "aa" if i % 2 else "bb") for i, t in enumerate(["xyx yxy xxy", "klk llk kkl"] * 20)] + [(99, None, "cc"), (98, "pq", None)],
        "doc_id long, text string, lang string",
    )
    model = language.fit(docs)
    assert model.languages == ("aa", "bb")
    table = docs_of(spark, awkward() + [(7, "klk " * 50_000), (8, "x" * 100_000), (9, "½ ² ١")])
    got = {}
    for r in table.select("doc_id", language.predict(model).alias("p")).collect():
        got.setdefault(r.doc_id, set()).add((r.p.lang_pred, r.p.score))
    assert got[1] == got[2] == got[3] == got[6] == got[9] == {("und", 0.0)}
    assert len(got[4]) == 1
    assert {p for p, _ in got[7]} == {"aa"} and {p for p, _ in got[8]} == {"bb"}
    none = language.fit(docs.limit(0))
    assert {r.p.lang_pred for r in table.select(language.predict(none).alias("p")).collect()} == {"und"}
    assert docs.limit(0).select(language.predict(model)).count() == 0


def test_held_out_accuracy(spark):
    got = QUERIES["op7_language"](spark, TABLES)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert got.count() == docs.count()
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
