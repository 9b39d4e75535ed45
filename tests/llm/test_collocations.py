"""Phrase collocations against a plain count of everything, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import awkward
from volspark.llm import collocations, queries

SCHEMA = "doc_id long, lang string, text string, w1 string, n string, score string, rank string, a string"


def docs(spark, rows):
    return spark.createDataFrame([(i, lang, text, *"xxxxx") for i, (lang, text) in enumerate(rows)], SCHEMA)


def plain(rows, top, least=10):
    total, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            words = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        phrases, around = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}, {}
        for p, a in phrases.items():
            for part in (p[:2], p[1:]) if len(p) == 3 else ():
                around[part] = max(around.get(part, 0), a)
        kept = []
        for p, a in phrases.items():
            cuts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            s, _, (l, r) = min((10**6 * a * a // (l * r), k, (l, r)) for k, (l, r) in enumerate(cuts))  # noqa: E741
            if len(p) == 3 or 100 * around.get(p, 0) < 50 * a:
                kept.append((-s, -a, b" ".join(p), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def prose(seed, texts=250):
    rng = random.Random(seed)
    words = [f"{c}{i}" for i in range(6) for c in ("w", "É", "z-")]
    fixed = [rng.sample(words, rng.choice([2, 3, 4])) for _ in range(8)]
    for _ in range(texts):
        text = []
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(words)]
            if rng.random() < 0.2:
                text[-1] += rng.choice([".", ",", "!?", "\n", "\r\n", "\t"])
        yield rng.choice(["en", "de", None]), " ".join(text).replace("w1", "W1")


@pytest.mark.parametrize("top", [1, 5, 40, 2000])
def test_phrases_equal_a_plain_count(spark, top):
    rows = [*prose(top), *(("x", t) for _, t in awkward(2000)), ("only", "a a a a a a a a a a a a a")]
    got = found(collocations.collocations(docs(spark, rows), top))
    assert got == plain(rows, top) and len(got) > 2


def test_many_rounds_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FIRST_ROUND", 1.0)
    monkeypatch.setattr(collocations, "GROWTH", 1.5)
    monkeypatch.setattr(collocations, "WORDS_TOGETHER", 300)
    monkeypatch.setattr(collocations, "MAP_BITS", 64)
    rows = list(prose(3))
    assert found(collocations.collocations(docs(spark, rows), 30)) == plain(rows, 30)


def test_scores_pass_64_bits(spark):
    rows = [(999_999_999_999, 999_999_999_999, 10**12), (123_456_789_012, 123_456_789_013, 987_654_321_098), (10, 10, 10)]
    table = spark.createDataFrame(rows, "a long, l long, r long")
    got = table.select("a", "l", "r", collocations.score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in got)


def test_scores_that_enough_phrases_reach(spark):
    rng = random.Random(2)
    rows = [(lang, rng.choice([0, 5, 7, 10**6])) for lang, n in (("a", 90), ("b", 11), ("c", 3)) for _ in range(n)]
    for many in (1, 4, 11, 50):
        got = {r.lang: r.floor for r in collocations.reached_score(spark.createDataFrame(rows, "lang string, score long"), many).collect()}
        scores = {lang: sorted((s for x, s in rows if x == lang), reverse=True) for lang in "abc"}
        assert got == {lang: s[many - 1] if len(s) >= many else 0 for lang, s in scores.items()}


def test_bounds_are_admissible(spark):
    rows = list(prose(6))
    short = collocations.phrase_counts(docs(spark, rows), collocations._short)
    words, pairs = short.where("w1 is not null and w2 is null"), short.where("w2 is not null")
    bound = {(r.lang, bytes(r.w1), bytes(r.w2)): r for r in collocations.scored_pairs(words, pairs).collect()}
    assert all(r.score <= r.bound for r in bound.values())
    for lang, _, phrase, *_, score in plain(rows, 10**6):
        assert score <= bound[(lang, *phrase.encode().split()[:2])].bound


def test_empty_tables(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [("en", None), ("en", " ,,, "), (None, "a b")])).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = duck.execute(queries.ORACLES["op13_collocations"])
    columns = [d[0] for d in want.description]
    got = queries.op13_collocations(spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and len(got) > 50
