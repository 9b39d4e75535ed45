"""The n-gram join and connected components against brute force."""

import random

import numpy as np
import pytest

from tests.llm.helpers import awkward, docs_of
from volspark.llm import jaccard
from volspark.llm.graph import components


def plain(rows, size, percent):
    sets = []
    for _, text in rows:
        words = [w for w in (text or "").encode().lower().split()]
        n = min(size, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(
        (doc_id is None, doc_id or 0, len(sets[i]), least.get(top(i), -1), links[i]) for i, (doc_id, _) in enumerate(rows)
    )


def found(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id, r.n_links) for r in df.collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
    return " ".join(words)


def families(seed, count=12, copies=14):
    """Near copies around the threshold, a line that most texts share, exact copies, short texts."""
    rng = random.Random(seed)
    line = "this is a line that nearly all of the texts have in common"
    rows, next_id = [], 0
    for _ in range(count):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 6, 20, 60, 200]))]
        for _ in range(copies):
            text = edited(rng, base, rng.randint(0, max(1, len(base) // 25)))
            rows.append((next_id, f"{line}\n{text}" if rng.random() < 0.7 else text.upper()))
            next_id += rng.randint(1, 3)
    return rows + [(next_id + i, line) for i in range(4)]


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 60)])
def test_join_equals_brute_force(spark, size, percent):
    rows = families(size) + [(None, "one two three"), (10**6, "One\tTWO three")]
    rows += [(i and i + 10**5, t) for i, t in awkward(3000)]
    assert found(jaccard.join(docs_of(spark, rows), size, percent)) == plain(rows, size, percent)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 500)
    rows = families(7, count=3, copies=40)
    assert found(jaccard.join(docs_of(spark, rows), 4, 85)) == plain(rows, 4, 85)


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert jaccard.join(none).count() == 0
    only = jaccard.join(docs_of(spark, [(3, None), (4, " ")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in only} == {(3, 0, 3, 0), (4, 0, 4, 0)}


def test_divide_skip_equals_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 10**9, 400).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(400) < p, rng.integers(0, 10**9, 400), base).astype(np.uint64))
            for p in rng.uniform(0, 0.15, 40)]
    got = {(a, int(b)) for a, found in jaccard.divide_skip(sets, 85) for b in found}
    want = {(i, j) for j in range(40) for i in range(j)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert got == want and 10 < len(want) < 700


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 3)]
    star = [(0, i) for i in range(500, 560)]
    loose = [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    edges = chain + star + loose + loose[:5]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None and a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
