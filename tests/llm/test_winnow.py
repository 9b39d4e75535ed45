"""Fingerprints against a plain version."""

import hashlib
import random
import zlib

from volspark.llm import winnow


def plain(text):
    words = text.split(" ")
    crc = lambda s: zlib.crc32(s.encode()) % winnow.PRIME
    if len(words) < winnow.K:
        grams = [crc(text)]
    else:
        grams = []
        for i in range(len(words) - winnow.K + 1):
            h = 0
            for w in words[i : i + winnow.K]:
                h = (h * winnow.BASE + crc(w)) % winnow.PRIME
            grams.append(h)
    chosen = []
    for start in range(max(1, len(grams) - winnow.W + 1)):
        window = grams[start : start + winnow.W]
        least = min(window)
        at = start + max(i for i, h in enumerate(window) if h == least)
        if (least, at) not in chosen:
            chosen.append((least, at))
    return chosen


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b)


def entries(raw):
    return [(e >> 31, winnow.LOW - (e & winnow.LOW)) for e in raw]


def texts():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "dé", "x", "x", "日本"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return out + ["", None, "one", "a b c d", "a a a a a a a a a a a a a a a a a a a a a a a a", " ", out[0]]


def test_whole_comparison(spark):
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in winnow.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, reverse=True)
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert entries(row.entries) == plain(text)
        assert entries(row.edited_entries) == plain(edited)
        assert row.near_edited == likeness(plain(text), plain(edited))
        assert row.near_next == likeness(plain(text), plain(after))


def test_many_ranges_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(winnow, "ROWS", 1)
    ids = random.Random(1).sample(range(-(10**12), 10**12), 500) + list(range(300))
    rows = [(i, f"text of {i}") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.edited_sha256 for r in winnow.compare(docs).collect()}
    order = sorted(rows, reverse=True)
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[doc_id] == hashlib.sha256(edited.encode()).hexdigest()


def test_edges(spark):
    schema = "doc_id long, text string, entries string, _range int, n_chars string"
    assert winnow.compare(spark.createDataFrame([], schema)).count() == 0
    one = winnow.compare(spark.createDataFrame([(4, "a b", "x", 1, "y")], schema)).first()
    assert (one.near_next, one.n_chars) == (1.0, 3)
    rows = [(1, "a b", "", 0, ""), (1, "a b", "", 0, ""), (None, "c", "", 0, ""), (None, None, "", 0, "")]
    got = winnow.compare(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 3), (False, 3), (True, 0), (True, 1)]


def test_shared_passages_are_found(spark):
    rng = random.Random(9)
    make = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    passage = make(winnow.W + winnow.K - 1)
    rows = [(i, f"{make(rng.randint(5, 90))} {passage} {make(rng.randint(5, 90))}") for i in range(20)]
    df = winnow.with_fingerprints(spark.createDataFrame(rows, "i int, t string"), {"fp": "t"})
    sets = [{h for h, _ in entries(r.fp)} for r in df.collect()]
    assert all(a & b for a in sets for b in sets)
