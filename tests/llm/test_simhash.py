"""SimHash fingerprints and classes against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import awkward, docs_of
from volspark.llm import queries, simhash


def plain_print(text, size=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius):
    """(doc_id, fingerprint) to (doc_id, fingerprint, class, links)."""
    root, links = list(range(len(prints))), [0] * len(prints)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j, (_, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= radius:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(((d, x, least.get(top(i)), links[i]) for i, (d, x) in enumerate(prints)), key=str)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def found(spark, prints, **how):
    rows = spark.createDataFrame([(d, signed(x)) for d, x in prints], "doc_id long, fingerprint long")
    got = simhash.near_duplicates(rows, **how).collect()
    return sorted(((r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id, r.n_links) for r in got), key=str)


def family(rng, base, many, flips):
    for _ in range(many):
        x = base
        for b in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << b
        yield x


def prints_of(seed):
    rng = random.Random(seed)
    prints = [*family(rng, rng.getrandbits(64), 120, 5), *family(rng, 0, 20, 6), *family(rng, (1 << 64) - 1, 20, 6)]
    for _ in range(40):
        prints += family(rng, rng.getrandbits(64), rng.choice([1, 2, 5]), rng.choice([0, 4, 8]))
    prints += prints[:15]
    ids = rng.sample(range(10**6), len(prints))
    return [(None if i % 50 == 0 else d, x) for i, (d, x) in enumerate(zip(ids, prints))]


@pytest.mark.parametrize("radius, agree", [(4, 1), (4, 2), (0, 1), (7, 1)])
def test_classes_equal_brute_force(spark, radius, agree):
    prints = prints_of(radius + agree)
    assert found(spark, prints, radius=radius, agree=agree) == plain_classes(prints, radius)


def test_cut_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 9)
    monkeypatch.setattr(simhash, "ROWS", 4)
    prints = prints_of(11)
    assert found(spark, prints, radius=4) == plain_classes(prints, 4)


def test_cells_of_links_agree():
    rng = random.Random(3)
    for radius, agree in ((4, 1), (4, 2), (2, 3)):
        masks = simhash.cell_masks(radius, agree)
        for _ in range(200):
            x = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(x & m & (1 << 64) - 1 == 0 for m in masks)


def test_fingerprints(spark, monkeypatch):
    rng = random.Random(4)
    words = "a b C d É é e\x1cf ß 日本".split(" ")
    rows = [(i + 100, rng.choice([" ", "\t", "\n "]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    rows += awkward(3000)
    want = sorted(((d, plain_print(t)) for d, t in rows), key=str)
    got = simhash.fingerprints(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint & (1 << 64) - 1) for r in got), key=str) == want
    monkeypatch.setattr(simhash, "BATCH_SHINGLES", 7)
    hashes = [simhash.shingle_hashes(t.encode() if t else None, 4) for _, t in rows]
    flat = np.array([h for one in hashes for h in one], np.uint64)
    assert simhash.majority(flat, np.array([len(h) for h in hashes])).tolist() == [plain_print(t) for _, t in rows]


def test_empty_tables(spark):
    assert simhash.near_duplicates(simhash.fingerprints(docs_of(spark, []))).count() == 0
    rows = [(3, None), (4, " "), (9, "x")]
    got = {r.doc_id: r for r in simhash.near_duplicates(simhash.fingerprints(docs_of(spark, rows))).collect()}
    assert got[3].component_id == got[4].component_id == 3 and got[3].n_links == 1 and got[9].n_links == 0


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.op12_simhash(spark, folder).collect()
    docs = queries.table(spark, folder, "documents").collect()
    want = plain_classes([(r.doc_id, plain_print(r.text)) for r in docs], 4)
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id, r.n_links) for r in got), key=str) == want
    assert all(len(r.fingerprint) == 16 for r in got)
