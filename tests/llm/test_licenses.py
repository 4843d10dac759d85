import pytest

from lotline.llm import licenses as C

from .helpers import documents, rows


@pytest.mark.parametrize("clash", [False, True])
def test_texts_and_lines(spark, clash):
    mit = "Copyright (c) 2026 Somebody\n" + C.MIT.upper().replace(" ", "   ").replace(".", " . ")
    data = [
        (1, mit, "en", "s", 0),
        (2, "prose\nReleased under the MIT Licence!\nmore\nLICENSED under the Apache License, version 2.0", "en", "s", 0),
        (3, "Released under the MIT License, or not", "en", "s", 0),
        (4, None, None, None, None),
        (5, "", "en", "s", 0),
        (6, "SPDX-License-Identifier: CC0-1.0\n" * 3, "en", "s", 0),
        (6, "SPDX-License-Identifier: CC0-1.0\n" * 3, "en", "s", 0),
        (7, "Released under the MIT License.", "en", "s", 0),
    ] + [(100 + i, t, l, s, n) for i, (_, t, l, s, n) in enumerate(rows())]
    got = C.scan(documents(spark, data, clash)).collect()
    assert len(got) == len(data)
    by = {r["doc_id"]: (r["text_license"], r["line_licenses"], r["n_lines"]) for r in got}
    assert by[1] == ("MIT", "", 0)
    assert by[2] == (None, "Apache-2.0,MIT", 2)
    assert by[3] == by[4] == by[5] == (None, "", 0)
    assert by[6] == (None, "CC0-1.0", 3)
    assert by[7] == ("MIT", "MIT", 1)
    assert all(by[i] == (None, "", 0) for i in by if i >= 100)
    assert C.scan(documents(spark, [])).count() == 0


def test_notices_without_the_word_license(spark):
    """Notices are found whatever words they hold; the library's table has them all."""
    lines = {"Released under MIT": "MIT", "Distributed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "distributed under a CC-BY-NC-ND-4.0": "CC-BY-NC-ND-4.0", "Released under the GPLv3": "GPL-3.0", "Distributed under MPL 2.0": "MPL-2.0"}
    data = [(i, f"some prose\n\n  {t}  \nmore", "en", "s", 0) for i, t in enumerate(lines)]
    by = {r["doc_id"]: r["line_licenses"] for r in C.scan(documents(spark, data)).collect()}
    assert [by[i] for i in range(len(lines))] == list(lines.values())
    made = {(n, f"{a} {b}{name}") for n, names in C.NAMES.items() for name in [*names, n] for a in C.NOTICES for b in ("", "the ", "a ")}
    assert made <= set(C.KNOWN)


def test_a_large_table_is_not_broadcast(spark, monkeypatch):
    docs = documents(spark, [(1, "x\nuse, at WILL!\n\n", "en", "s", 0), (1, "Use at will", "en", "s", 0), (None, None, None, None, None)])
    own = spark.createDataFrame([("own", "Use at will."), ("a", "use at will"), (None, "x"), ("b", None)], "n string, t string")
    rows = lambda: sorted(map(str, C.scan(docs, known=own).collect()))
    small = rows()
    monkeypatch.setattr(C, "MAX_BROADCAST", 0)
    assert rows() == small and sum("line_licenses='a'" in r for r in small) == 2
    plan = C.scan(docs, known=own)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_whole_texts_and_notices_of_the_usual_licenses(spark):
    from lotline.llm.license_texts import TEXTS

    data = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS.values())]
    data += [(100, "prose\nLicensed under CC BY-NC 4.0.\nmore", "en", "s", 0), (101, "SPDX-License-Identifier: MPL-2.0", "en", "s", 0), (102, C._bsd(3, "*"), "en", "s", 0), (103, "x\nLicensed under the GNU Affero General Public License v3.0", "en", "s", 0)]
    by = {r["doc_id"]: (r["text_license"], r["line_licenses"]) for r in C.scan(documents(spark, data)).collect()}
    assert [by[i][0] for i in range(len(TEXTS))] == list(TEXTS)
    assert by[100] == (None, "CC-BY-NC-4.0") and by[101] == ("MPL-2.0", "MPL-2.0") and by[102][0] == "BSD-3-Clause" and by[103] == (None, "AGPL-3.0")
    of = {}
    assert all(of.setdefault(r["known_digest"], r["license"]) == r["license"] for r in C.known_digests(spark).collect())


def test_a_table_of_ones_own(spark):
    docs = documents(spark, [(1, "Use at will", "en", "s", 0), (2, "x\nuse, at WILL!", "en", "s", 0), (3, C.MIT, "en", "s", 0)])
    got = {r["doc_id"]: (r["text_license"], r["line_licenses"]) for r in C.scan(docs, known=[("own", "Use at will.")]).collect()}
    assert got == {1: ("own", "own"), 2: (None, "own"), 3: (None, "")}
