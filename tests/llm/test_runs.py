"""Periodic runs against a plain search, and the query against its SQL."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import awkward, docs_of
from volspark.llm import queries, runs


def plain(words, shortest=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(shortest, times * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_texts(seed, many):
    rng = random.Random(seed)
    for _ in range(many):
        n, k = rng.choice([0, 1, 5, 8, 20, 60, 150]), rng.choice([1, 2, 3, 50])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        if n > 3 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 10)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        yield rng.choice([" ", "\n", "\t "]).join(words * (rng.randint(2, 6) if rng.random() < 0.2 else 1))


@pytest.mark.parametrize("shortest, times", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_a_plain_search(shortest, times):
    texts = [*periodic_texts(times, 1500), ""]
    found = runs.search([None, *(t.encode() for t in texts)], shortest, times)[1:]
    want = [plain(t.encode().split(), shortest, times) for t in texts]
    assert [[tuple(r) for r in listed.tolist()] for _, listed in found] == want
    assert sum(map(len, want)) > 1000


def test_few_suffixes_at_a_time(monkeypatch):
    monkeypatch.setattr(runs, "TESTED_TOGETHER", 7)
    texts = list(periodic_texts(9, 200))
    found = runs.search([t.encode() for t in texts])
    assert [[tuple(r) for r in listed.tolist()] for _, listed in found] == [plain(t.encode().split()) for t in texts]


def test_suffix_order_and_lcp():
    rng = np.random.default_rng(2)
    words, ends = rng.integers(0, 3, 300), np.repeat([40, 41, 300], [40, 1, 259])
    order, levels = runs.suffix_array(words, ends)
    suffix = lambda i: (ends[i], *words[i : ends[i]])
    assert order.tolist() == sorted(range(300), key=suffix)
    lcp = runs.common_prefixes(order, levels, ends)
    for r in range(1, 300):
        a, b = suffix(order[r - 1]), suffix(order[r])
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[r] == max(same - 1, 0)


def test_collapse_drops_what_any_run_repeats():
    words = b"x a b a b a b a b y y y y y y z".split()
    found = np.array(plain(words))
    assert runs.collapse(words, found) == b"x a b y z"


def test_documents(spark):
    long = " ".join(["one two three"] * 20_000)
    rows = [*awkward(), (50, long), (51, "É é É é É é É é"), (51, "a " * 5), (52, "a\x1ca a\x1ca " * 4)]
    got = sorted(runs.periodic_runs(docs_of(spark, rows)).collect(), key=str)
    want = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        found = plain(words) if doc_id != 50 else [(0, 60_000, 3)]
        want.append((doc_id, len(words), found, runs.collapse(words, np.array(found).reshape(-1, 3)).decode()))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert runs.periodic_runs(docs_of(spark, [])).count() == 0


def test_planted_runs(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 70))) for i in range(400)] + [(None, "a b"), (7000, None)]
    got = {r.doc_id: r.text for r in queries.with_planted_runs(docs_of(spark, rows)).collect()}
    changed = 0
    for doc_id, text in rows:
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        words = (text or "").split()
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[a + (i - a) % p] if i >= a else words[i] for i in range(n))
            changed += 1
        assert got[doc_id] == text
    assert changed > 20


def test_query_equals_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = duck.execute(queries.ORACLES["op11_runs"])
    columns = [d[0] for d in want.description]
    got = queries.op11_runs(spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)
    assert sum(r.n_runs for r in got) > 5
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.runs_sha256 == empty and r.start is r.period is None for r in got if not r.n_runs)
