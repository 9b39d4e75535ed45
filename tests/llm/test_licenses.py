"""Patience alignment and license scans."""

import random
from itertools import combinations

from tests.llm.helpers import awkward, docs_of
from volspark.llm import licenses


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        places = rng.sample(range(30), rng.randint(0, 9))
        got = licenses.increasing(places)
        assert got == sorted(got) and all(places[a] < places[b] for a, b in zip(got, got[1:]))
        longest = max((len(c) for k in range(len(places) + 1) for c in combinations(places, k) if list(c) == sorted(c)), default=0)
        assert len(got) == longest


def test_alignment_matches_equal_words_in_order():
    rng = random.Random(2)
    for _ in range(300):
        template = [rng.choice("abcdefghijklm") for _ in range(rng.randint(0, 15))]
        text = [w for w in template if rng.random() < 0.8]
        text.insert(rng.randint(0, len(text)), "zz")
        pairs = licenses.align(text, template)
        assert all(text[a] == template[b] for a, b in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    words = "licensed under the apache license version 2.0".split()
    assert len(licenses.align(words, words)) == len(words)


def test_scan(spark):
    long = " ".join(f"w{i % 500} the of under" for i in range(20_000))
    mit = licenses.TEMPLATES["MIT"][1]
    rows = awkward(20_000) + [
        (10, "Released under the MIT License."),
        (11, f"{long}\nLICENSED under the Apache License,\nVersion 2.0.\n{long}\nLicensed under the Apache License, Version 2.0."),
        (12, f"x {mit.replace('free of charge', 'gratis, free of all charge')} y"),
        (13, "The license of the car was under the table of version 3"),
        (14, "Released under the MIT License. Released under the MIT License."),
        (14, "Released under the MIT License. Released under the MIT License."),
    ]
    got = {}
    for r in licenses.scan(docs_of(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.license, round(r.coverage, 2), r.stop - r.start))
    assert got.pop(10) == [("MIT", 1.0, 5)]
    assert got.pop(11) == [("Apache-2.0", 1.0, 7)] * 2
    (name, coverage, _), = got.pop(12)
    assert name == "MIT" and coverage > 0.9
    assert got.pop(14) == [("MIT", 1.0, 5)] * 4
    assert not got
    assert licenses.scan(docs_of(spark, [])).count() == 0


def test_near_misses(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"][1]
    cases = [
        ("Released under the BSD License.", []),
        ("Licensed under the Mozilla Public License, Version 2.0.", ["MPL-2.0"]),
        ("Licensed under the Eclipse Public License, Version 2.0.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU Library General Public License, version 3.", []),
        (gpl, ["GPL-3.0"]), (gpl.replace("version 3", "version 2"), ["GPL-2.0"]),
        (gpl.replace("GNU General", "GNU Affero General"), ["AGPL-3.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY-NC 3.0.", []),
        (licenses.TEMPLATES["BSD-2-Clause"][0], ["BSD-2-Clause"]),
        (licenses.TEMPLATES["BSD-3-Clause"][1], ["BSD-3-Clause"]),
        ("Released under the BSD License. Released under the MIT License.", ["MIT"]),
    ]
    got = {}
    for r in licenses.scan(docs_of(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert [got.get(i, []) for i in range(len(cases))] == [want for _, want in cases]
