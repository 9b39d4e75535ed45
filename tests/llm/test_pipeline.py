"""The corpus pipeline stage by stage, against plain versions on the smallest tables."""

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_jaccard import plain
from volspark.llm import quality, toxicity
from volspark.llm.corpus import fold, table
from volspark.llm.tokens import Encoder

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The input of the pipeline and what each stage kept, every stage written and read again."""
    folder, docs = tmp_path_factory.mktemp("stages"), table(spark, TABLES, "documents")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "_"))
        stage(spark, docs, TABLES).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_registered():
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        q if q == "pipeline" else q.split("_")[0] + "_" for q in __spark_entry__.queries()
    }


def test_columns_stay(kept):
    names = list(kept)
    for name in names[1:-1]:
        assert kept[name].dtypes == kept["documents"].dtypes


def test_classifier_stages(spark, kept):
    labels = table(spark, TABLES, "labels").where(fold("doc_id", 3) != 1)
    rows = kept["documents"].collect()
    good = quality.fit(kept["documents"], labels)
    want = [r for r in rows if toxicity.logistic(good.raw(*quality.encode(r.text, {}))) >= quality.THRESHOLD]
    assert sorted(r.doc_id for r in want) == sorted(r.doc_id for r in kept["quality"].collect())
    assert 0 < len(want) < len(rows)
    clean = toxicity.fit(kept["documents"], labels)
    left = [r for r in want if clean.score(r.text) < toxicity.THRESHOLD]
    assert sorted(r.doc_id for r in left) == sorted(r.doc_id for r in kept["toxicity"].collect())


def test_near_copies(kept):
    rows = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    want = sorted(doc_id for _, doc_id, _, component, _ in plain(rows, 5, 80) if doc_id == component)
    assert sorted(r.doc_id for r in kept["near copies"].collect()) == want
    assert len(want) < len(rows)


def test_packing(kept):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(encoder.encode(r.text)) // 4 + 1 for r in kept["near copies"].collect()}
    got = {}
    for r in kept["packing"].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.offset + r.length <= 2048
    assert got == want
