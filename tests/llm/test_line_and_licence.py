import textwrap

import compare
import pytest
from pairsmith.llm import licences, license_scan, line_dedup

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query,sql", [(line_dedup.op1_line_dedup, line_dedup.SQL), (license_scan.op6_license_scan, license_scan.SQL)])
def test_equals_sql(spark, query, sql):
    assert compare.difference(spark, compare.connect(SF), query, sql, SF) is None


def test_later_windows_go_and_the_first_stays(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "q\nq\nq\nq\nq"), (4, "a\nb"), (5, "a\nb\nc\nd\na\nb\nc")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: "a\nb\nc\nd", 2: "x\ny", 3: "q\nq\nq", 4: "a\nb", 5: ""}


def test_a_frequent_window_is_dealt_over_pieces(spark, monkeypatch):
    texts = ["same\nlines\nhere"] * 40 + [f"own {i}\nsame\nlines\nhere\nrest {i}" for i in range(40)] + ["r\n" * 50 + "r"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for pieces in (1, 3, line_dedup.PIECES):
        monkeypatch.setattr(line_dedup, "PIECES", pieces)
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
        assert got[0] == texts[0] and set(got[i] for i in range(1, 40)) == {""}
        assert all(got[40 + i] == f"own {i}\nrest {i}" for i in range(40)) and got[80] == "r\nr\nr"


def test_odd_rows(odd, nothing):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[2] is None and got[3] == "" and got[5] == "" and got[1].startswith("one two")
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(nothing).count() == 0


def test_best_template_of_a_line(spark):
    docs = spark.createDataFrame([(1, "prose\nRELEASED under the MIT license!\nmore"), (1, "prose\nRELEASED under the MIT license!\nmore"), (2, "the MIT"),
                                  (3, "This work is licensed under the GNU General Public License, version 2.")], "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.dice, r.line) for r in license_scan.scan(docs).collect()}
    assert got == {(1, "MIT"): (1.0, 1), (3, "GPL-2.0"): (1.0, 0)}


def licences_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in license_scan.scan(docs).collect():
        found.setdefault(r.doc_id, {})[r.license] = (round(r.dice, 3), r.line, r.word)
    return [found.get(i, {}) for i in range(len(texts))]


def test_whole_texts_headers_and_tags(spark):
    whole = [t for _, t in licences.TEXTS]
    got = licences_of(spark, whole + ["prose before it " + textwrap.fill(t, 60) + " prose after it" for t in whole])
    for (name, text), alone, inside in zip(licences.TEXTS * 2, got, got[len(whole):]):
        assert alone[name][:2] == (1.0, 0 if "\n" not in text else -1)
        assert inside[name] == (1.0, None, 3)
    assert licences_of(spark, ["// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "This project is licensed under the MIT License.", "the license of this project"]) \
        == [{"GPL-2.0": (1.0, 0, None)}, {"MIT": (1.0, 0, None)}, {}]


def test_wrapped_and_changed_notices(spark):
    bsd = "governed by a BSD-style\nlicense that can be found in the LICENSE file."
    mit = dict(licences.TEXTS)["MIT"].replace("associated documentation", "all of the documentation").replace("AUTHORS", "REGENTS")
    got = licences_of(spark, ["words of prose use of this source code is " + bsd + " more prose", "A title\n" + mit, mit[:len(mit) // 4]])
    assert got[0] == {"BSD-3-Clause": (1.0, None, 3)}
    assert list(got[1]) == ["MIT"] and got[1]["MIT"][0] > 0.9
    assert got[2] == {}


def test_the_most_like_of_overlapping_windows_counts(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}."
    got = licences_of(spark, ["some words " + gpl.format(2) + " then others", "some words " + gpl.format(3) + " and " + gpl.format(2) + " too"])
    assert {k: v[0] for k, v in got[0].items()} == {"GPL-2.0": 1.0}
    assert {k: v[0] for k, v in got[1].items()} == {"GPL-2.0": 1.0, "GPL-3.0": 1.0}


def test_texts_without_an_id_are_documents_of_their_own(spark):
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(None, f"a\n{line}"), (None, f"b\nc\n{line}"), (None, f"a\n{line}"), (1, "x"), (1, line)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.license, r.line) for r in license_scan.scan(docs).collect()))
    assert got == [(0, "MIT", 1), (0, "MIT", 2), (1, "MIT", 0)]


def test_many_notices_in_one_long_text(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    got = licences_of(spark, [" filler words ".join([notice] * 3000)])
    assert got == [{"GPL-3.0": (1.0, None, 0)}]
