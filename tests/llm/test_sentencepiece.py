"""SentencePiece coding: best scores, round trips, and the library's own decoder."""

import random

import numpy as np
import public_tokenizers
import sentencepiece as library

from tests.llm.helpers import awkward, docs_of
from volspark.llm import sentencepiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(1)
    alphabet = ["the", "ing", "st", "é", "日", "a", "b", " ", "\n", "  ", "ß", "0", "😀", "ң", ".", "▁"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    return out + ["x" * 3000, "", " ", "  two  spaces ", "▁"]


def test_batches_equal_the_plain_search():
    codec = sentencepiece.Codec(MODEL)
    codec.encode(texts())
    assert all(codec.plain(unit) == ids for unit, ids in codec.units.items())


def test_no_segmentation_scores_better_than_the_found_one():
    """The library's merges are one of the possible segmentations."""
    codec, other = sentencepiece.Codec(MODEL), library.SentencePieceProcessor(model_file=MODEL)

    def total(ids):
        return sum(codec.least if other.is_byte(i) else other.get_score(i) for i in ids)

    for text, raw in zip(texts(), codec.encode(texts())):
        ids = np.frombuffer(raw, "<u4").tolist()
        if not any(other.is_byte(i) for i in other.encode(text)):
            assert total(ids) >= total(other.encode(text))


def test_round_trip_and_decoder(spark):
    codec, other = sentencepiece.Codec(MODEL), library.SentencePieceProcessor(model_file=MODEL)
    for text, raw in zip(texts(), codec.encode(texts())):
        assert codec.decode(raw) == text.replace("▁", " ")
        ids = np.frombuffer(raw, "<u4").tolist()
        assert codec.decode(raw) == other.decode(ids)
    assert codec.encode([None, ""]) == [b"", b""]
    rows = awkward()
    coded = sentencepiece.decode(sentencepiece.encode(docs_of(spark, rows), MODEL), MODEL).collect()
    assert sorted((r.doc_id or -1, r.text) for r in coded) == sorted((i or -1, t or "") for i, t in rows)
    assert sentencepiece.encode(docs_of(spark, []), MODEL).count() == 0
