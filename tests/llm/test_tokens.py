"""Token ids, packing and record files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.helpers import awkward, docs_of
from volspark.llm import packing, records
from volspark.llm.tokens import Encoder, as_ids

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ("", " ", "  a  b\n\n c\t d\r\n", "it's I'll 'tis don't", "Straße ΣΑΣ İstanbul ǅ", "á b\x1ce \x85f",
       "日本語 テキスト ½ ² x² ١٢٣", "foo.\nBar,baz.. !?", "<|endoftext|> x<|endoftext|>",
       "a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|>", "<|endoftext|>", " <|endoftext|>  \n<|endoftext|>\n", "İ, x.", "a\0b c",
       "x’s “q” — 5€ ﬁ ŉ ǰ ẞ", "U.S.A. 3.5, a_b.c (x).", "ABC'S I'LL it's. x", "word.' s 'll 's", "😀 x", "a\n b \nc", "K Å Ω")


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(path):
    from tokenizers import Tokenizer

    encoder, rng, fresh = Encoder(path), random.Random(5), Tokenizer.from_file(path)
    alphabet = [*" \n  ab.'s,1é\tΣİ́!", "<|endoftext|>", "<|startoftext|>", "’", "ª", "\xad", "日", "\x85"]
    texts = [*ODD, *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(6000))]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert [as_ids(encoder.encode(t)).tolist() for t in texts] == want
    assert all(encoder.encode(t) == encoder.library(t) for t in texts[:500])
    assert encoder.encode(None) == b""


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_full_memory_keeps_ids_right(path, monkeypatch):
    from tokenizers import Tokenizer

    from volspark.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder, rng, fresh = Encoder(path), random.Random(6), Tokenizer.from_file(path)
    texts = [" ".join(f"w{rng.randint(0, 90)}{rng.choice(['', '.', ',', '!?'])}" for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts[7::20] = [t + "<|endoftext|>" for t in texts[7::20]]
    assert [as_ids(encoder.encode(t)).tolist() for t in texts] == [fresh.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_of_an_array_equal_the_library(path):
    from tokenizers import Tokenizer

    encoder, rng, fresh = Encoder(path), random.Random(7), Tokenizer.from_file(path)
    alphabet = [*" \n  aJS.'’,;_#<|>1٣éÉÿİŉ×²Σ!\t\x1c\x85\xa0ªΩK日😀", "'s", "'LL", "\u030c", "\u0301", "\u0338", "\u0307",
                "<|endoftext|>", "<|EndOfText|>", "abc", "The", "x9Y"]
    texts = [*ODD, "J\u030c", "J", "\u030c", "é", "é.", "<|ENDOFTEXT|>", "a<|ENDOFTEXT|>",
             *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(20_000))]
    rng.shuffle(texts)
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    for n in (1, 7, len(texts)):
        rows = pa.array([None, *(t.encode() for t in texts)], pa.binary())
        got = [raw for a in range(1, 1 + min(len(texts), 50 * n), n) for raw in encoder.encode_all(rows.slice(a, n))]
        assert [as_ids(raw).tolist() for raw in got] == want[: len(got)]
    assert encoder.encode_all(rows.slice(0, 1)) == encoder.encode_all(pa.array([b""], pa.binary())) == [b""]
    assert encoder.encode_all(rows.slice(0, 0)) == []
    damaged = b"caf\xc3. \xff \xe6\x97, x"
    assert encoder.encode_all(pa.array([damaged])) == [encoder.library(damaged.decode("utf-8", "replace"))]


def test_frequent_units_are_worked_out_once():
    from volspark.llm.tokens import Units

    asked = []
    units = Units(lambda unit: asked.append(unit) or unit.encode(), 100)
    for i in range(1000):
        assert units["often"] == b"often" and units[str(i)] == str(i).encode()
        assert len(units) + len(units.older) <= 101
    assert asked.count("often") == 1
    for i in range(100):
        units[f"{i} " * 1000]
    assert len(units) + len(units.older) <= 4  # long ones count for more


def test_a_worker_keeps_its_encoder(tmp_path):
    import shutil

    from volspark.llm.tokens import kept

    path = str(tmp_path / "vocabulary.json")
    shutil.copyfile(WORD, path)
    first = kept(path)
    assert kept(path) is first and first.encode("a text") == Encoder(WORD).encode("a text")
    shutil.copyfile(BYTE, path)
    assert kept(path).encode("a text") == Encoder(BYTE).encode("a text")


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_white_space_of_an_array_equals_the_library(path):
    from tokenizers import Tokenizer

    encoder, rng, fresh = Encoder(path), random.Random(8), Tokenizer.from_file(path)
    alphabet = [*"   \n\n\t\r\x85\xa0\u2003\u2028\u3000\u1680\u200b", *"ab.1é”日'", "\u0301"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 10))) for _ in range(20_000)]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert [as_ids(raw).tolist() for raw in encoder.encode_all(pa.array([t.encode() for t in texts]))] == want


def test_equal_words_of_an_array_are_looked_up_once():
    texts = pa.array([b"one two, two  \nthree", b"one two"] * 50)
    for path in (BYTE, WORD):
        encoder, asked = Encoder(path), []
        look_up, encoder.units = encoder.units, type("Seen", (), {"__getitem__": lambda _, u: asked.append(u) or look_up[u]})()
        encoder.encode_all(texts)
        assert len(asked) == len(set(asked)) < 10


def random_items(rng, n, capacity):
    return [rng.choice((rng.randint(1, capacity), rng.randint(1, capacity // 8))) for _ in range(n)]


def laid_out(rows, capacity):
    by = {}
    for length, sequence, offset in rows:
        by.setdefault(sequence, []).append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 64, 2048])
def test_plan_is_sound_and_tight(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 2, 3, 50, 400):
        items = random_items(rng, n, capacity - 1)
        counts = {x: items.count(x) for x in set(items)}
        runs, sequences = packing.plan(counts, capacity)
        rows = [(length, first + i // per, offset + i % per * length)
                for length, _, k, per, first, offset in runs for i in range(k)]
        assert sorted(r[0] for r in rows) == sorted(items)
        assert laid_out(rows, capacity) == sequences
        assert sequences <= 11 / 9 * -(-sum(items) // capacity) + 1 + sum(2 * x > capacity for x in items) / 2


def test_large_items_pair_twice_at_most():
    runs, sequences = packing.plan({60: 2, 40: 2, 35: 3, 34: 3}, 100)
    assert sequences == 5  # 60+40 twice, then three pairs of 35 and 34
    assert all(3 * length > 100 for length, *_ in runs)


def test_packing_of_documents(spark):
    rng = random.Random(1)
    rows = [(i + 1000, " ".join(rng.choice(["alpha", "beta", "x"]) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    rows += awkward(900)
    cut = packing.pieces(docs_of(spark, rows), BYTE, capacity=64, end_id=0)
    packed = packing.pack(cut, ["doc_id", "piece"], capacity=64).cache()
    encoder, got = Encoder(BYTE), packed.collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        want = encoder.encode(text) + bytes(4)
        own = sorted(by_doc[doc_id], key=lambda r: (r.piece, r.sequence_id))
        copies = sum(i == doc_id for i, _ in rows)
        assert b"".join(bytes(r.ids) for r in own[::copies]) == want
        assert [r.start for r in own[::copies]] == [sum(r.length for r in own[::copies][:k]) for k in range(len(own) // copies)]
        assert all(r.length == 64 for r in own if r.piece > 0)
    laid_out([(r.length, r.sequence_id, r.offset) for r in got], 64)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.assemble(packed).collect()}
    assert all(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) for r in got)
    assert sum(map(len, whole.values())) == 4 * sum(r.length for r in got)


def test_packing_edges(spark):
    assert packing.pack(packing.pieces(docs_of(spark, []), BYTE), ["doc_id"]).count() == 0
    items = spark.createDataFrame([("a", 0), ("b", 65), ("c", None), ("d", 64), ("e", 64), ("f", 1)], "k string, length long")
    got = {r.k: (r.sequence_id, r.offset) for r in packing.pack(items, ["k"], 64).collect()}
    assert got["a"] == got["b"] == got["c"] == (None, None)
    assert len({got[k][0] for k in "def"}) == 3 and got["d"][1] == got["e"][1] == 0


def test_records_round_trip(spark, tmp_path):
    rows = awkward() + [(i, f"text number {i}") for i in range(100, 160)]
    folder = f"file://{tmp_path}/records"
    records.write(docs_of(spark, rows), folder, WORD, 2)
    encoder = Encoder(WORD)
    want = sorted((i if i is not None else -1, encoder.encode(t) + b"\x02\0\0\0") for i, t in rows)
    got = records.read(spark, folder).orderBy("shard", "position").collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in got) == want
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda i: -1 if i is None else i)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens
    mixed = records.read_shuffled(spark, folder, seed=4).collect()
    assert sorted(mixed) == sorted(got) and mixed != got
    assert sorted(records.read_shuffled(spark, folder, seed=4).collect()) == sorted(mixed)


def test_records_keep_large_ids_beside_null_ones(spark, tmp_path):
    folder, rows = f"file://{tmp_path}/large", [(None, "a"), (2**53 + 1, "b"), (-(2**63), None), (2**63 - 1, "c")]
    records.write(docs_of(spark, rows).coalesce(1), folder, WORD, 2)
    got = [r.doc_id for r in records.read(spark, folder).orderBy("shard", "position").collect()]
    assert got == [None, -(2**63), 2**53 + 1, 2**63 - 1]


def test_records_of_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    records.write(docs_of(spark, []), folder, WORD, 2)
    assert records.read(spark, folder).count() == records.read_shuffled(spark, folder, 1).count() == 0


def test_damaged_records_are_found():
    ids = np.arange(5, dtype="<u4")
    data = records.frame(records.serialise(7, ids, 2))

    def read_of(raw):
        at = 0

        def read(n):
            nonlocal at
            at += n
            return raw[at - n : at]

        return read

    doc_id, back = records.parse(records.unframe(read_of(data)))
    assert doc_id == 7 and (back == ids).all()
    for i in range(len(data)):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            records.unframe(read_of(bytes(broken)))
    assert records.masked(b"a") != zlib.crc32(b"a") and as_ids(b"\1\0\0\0").tolist() == [1]
