import random

from tidemark.llm import licenses


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_increasing_and_never_longer_than_the_best():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 14))] for _ in range(2))
        got = licenses.patience_align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert len(got) <= lcs(a, b)
    words = [f"w{i}" for i in range(50)]
    assert len(licenses.patience_align(words[:20] + ["x"] + words[25:], words)) == 45


def test_longest_increasing_is_longest():
    r = random.Random(2)
    for _ in range(100):
        xs = r.sample(range(30), r.randint(0, 10))
        got = [xs[i] for i in licenses.longest_increasing(xs)]
        assert got == sorted(got) and len(got) == lcs(xs, sorted(xs))


def test_found_where_they_stand(spark):
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "for nothing").replace("merge, publish, ", "")
    rows = [(1, "one two " + licenses.TEMPLATES["Apache-2.0"] + " three", 7), (2, "word " * 5000 + mit + " word" * 5000, 7),
            (3, changed, 7), (4, " ".join(mit.split()[:40]), 7), (5, None, 7), (6, "", 7), (7, "no license here, version two", 7),
            (8, mit.upper() + " " + mit, None), (8, mit.upper() + " " + mit, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = licenses.scan_licenses(docs).collect()
    found = {(r["doc_id"], r["license"]) for r in got}
    assert found == {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (8, "MIT")}
    assert sum(r["doc_id"] == 8 for r in got) == 2
    at = {r["doc_id"]: r for r in got}
    assert at[2]["coverage"] == 1.0 and at[2]["first_word"] == 5000
    assert 0.8 <= at[3]["coverage"] < 1.0
    assert (at[1]["first_word"], at[1]["end_word"]) == (2, 9)


def test_copies_close_together():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.MIN_COVERAGE, licenses.MAX_STRETCH)
    got = scanner.scan("see the docs. Released under the MIT License. Released under the MIT License. the end")
    assert got == [("MIT-notice", 1.0, 3, 8)]
    prose = "the terms of the software and the notice to any person without the following copyright or use in this list "
    for name in ("MIT", "BSD"):
        text, n = licenses.TEMPLATES[name], len(licenses.license_words(licenses.TEMPLATES[name]))
        for between in ("", prose):
            got = [h for h in scanner.scan(prose + text + " " + between + text + " " + prose) if h[0] == name]
            assert [h[1] for h in got] == [1.0] and got[0][3] - got[0][2] <= n + 4, (name, got)
    words = licenses.license_words(licenses.TEMPLATES["MIT"])
    cut = " ".join(words[:20] + words[30:])
    got = scanner.scan(f"{prose}{cut} the {cut} the {cut} {prose}")
    assert [h[0] for h in got] == ["MIT"] and got[0][1] >= (len(words) - 10) / len(words)


def test_real_notices_and_whole_licenses(spark):
    gpl3 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version.")
    other = lambda kind, version: gpl3.replace("GNU General", f"GNU {kind} General").replace("version 3", f"version {version}")
    want = {gpl3: {"GPL-3.0"}, gpl3.replace("version 3", "version 2"): {"GPL-2.0"}, other("Lesser", "2.1"): {"LGPL-2.1"},
            other("Lesser", "3").replace("program", "library"): {"LGPL-3.0"}, other("Affero", "3"): {"AGPL-3.0"},
            "Licensed under CC BY 4.0.": {"CC-BY-4.0"}, "Licensed under CC BY-NC 4.0.": {"CC-BY-NC-4.0"},
            "Licensed under CC BY-SA 4.0.": {"CC-BY-SA-4.0"}, "Released under the BSD License.": set(),
            "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": set(),
            "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
            "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
            "# SPDX-License-Identifier: LGPL-2.1-or-later": {"LGPL-2.1"},
            licenses.TEMPLATES["BSD"] + " " + dict(licenses.VARIANTS)["BSD-3-Clause"]: {"BSD", "BSD-3-Clause"},
            gpl3 + " and more " * 60 + other("Lesser", "3"): {"GPL-3.0", "LGPL-3.0"}}
    want |= {f"Some words before. {text} And some after the license.": {name} for name, text in licenses.bodies()}
    assert {"GPL-2.0", "MPL-2.0", "CC0-1.0", "Unlicense", "Apache-2.0"} <= {n for n, _ in licenses.bodies()}
    rows = list(enumerate(want))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i, text in rows:
        assert {r["license"] for r in got if r["doc_id"] == i} - {"all-rights-reserved"} == want[text], text[:200]


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
