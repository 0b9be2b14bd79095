from __future__ import annotations

from parcella.llm import licenses


def test_whole_texts_and_lines(docs_of):
    mit = "Copyright (c) 2020 Someone\n\n" + licenses.MIT.replace('"', "”").upper()
    rows = [
        (1, mit), (2, "  the MIT Licence\n\nCopyright 2019, 2021 A. B.\n© C\n" + licenses.MIT.replace("\n", "\r\n  ")),
        (3, licenses.MIT + " and more"), (4, "Some prose.\nReleased under the MIT licence!\nMore."), (5, None), (6, ""), (7, " .,; \n"),
        (8, "licensed under CC BY-NC 4.0\nLicensed under the Apache License, Version 2.0.\nlicensed under cc by nc 4.0"),
        (9, "Released under the MIT License. Not."), (10, "Released under the MIT License."), (10, "Released under the MIT License."),
        (None, licenses.APACHE_NOTICE.replace("http:", "https:")), (11, "x " * 300_000), (12, "copyright notice kept"),
    ]
    got = licenses.scan(docs_of(rows, clash=True), keep=("doc_id",)).collect()
    assert len(got) == len(rows)
    whole = {r.doc_id: r.license for r in got}
    assert whole == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: None, 7: None, 8: None, 9: None, 10: "MIT", None: "Apache-2.0", 11: None, 12: None}
    lines = {r.doc_id: (list(r.line_licenses), r.n_license_lines) for r in got}
    assert lines[4] == (["MIT"], 1) and lines[9] == ([], 0) and lines[5] == ([], 0)
    assert lines[8] == (["Apache-2.0", "CC-BY-NC-4.0"], 3)
    digest = {r.doc_id: r.digest for r in got}
    assert digest[5] is None and digest[6] == digest[7] and digest[12] != digest[6]
    assert licenses.scan(docs_of([]), keep=("doc_id",)).count() == 0


def test_known_digests_are_distinct_by_license(spark):
    rows = licenses.known_licenses(spark).collect()
    assert len(rows) == len({r.digest for r in rows}) and {r.license for r in rows} == {n for n, _ in licenses.KNOWN}


def test_common_licenses_and_statements(docs_of):
    texts = {f.name: f.read_text() for f in (licenses.Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    rows = list(enumerate(texts.values()))
    bsd = texts["BSD-3-Clause.txt"].split("\n\n", 1)[1].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    rows += [(100, bsd), (101, texts["GPL-3.0.txt"].split("How to Apply")[0]), (102, texts["GPL-2.0.txt"] + "more")]
    lines = [
        "All rights reserved.", "Licensed under the GNU Affero General Public Licence, version 3", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Released under the Unlicense", "Distributed under the Boost Software License, Version 1.0.",
    ]
    rows += [(200, "Prose.\n" + "\nMore prose.\n".join(lines)), (201, "All rights reserved. Not so."), (202, "(c) 2020 A. B.\nall rights reserved\nMine.")]
    got = {r.doc_id: r for r in licenses.scan(docs_of(rows), keep=("doc_id",)).collect()}
    for k, name in enumerate(texts):
        assert got[k].license == name.removesuffix(".txt").split("~")[0], name
    assert (got[100].license, got[101].license, got[102].license) == ("BSD-3-Clause", "GPL-3.0", None)
    assert list(got[200].line_licenses) == ["AGPL-3.0", "BSL-1.0", "CC-BY-4.0", "LGPL-2.1", "LicenseRef-All-Rights-Reserved", "Unlicense"]
    assert got[200].n_license_lines == 6 and got[201].n_license_lines == 0
    assert list(got[202].line_licenses) == ["LicenseRef-All-Rights-Reserved"]
