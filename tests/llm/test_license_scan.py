from __future__ import annotations

import textwrap

import duckdb

from eventtrails.llm import license_scan as L
from eventtrails.llm import sql

MIT = dict(L.TEXTS)["MIT"]


def rows_of():
    return [
        (1, "MIT License\n\nCopyright (c) 2020 Jane Doe\n  copyright 2021 others\n\n" + MIT.upper()),
        (2, MIT.replace("\n", "   \r\n").replace('"', "“") + "\n\n© 2020 me"),
        (3, MIT + " and something else"),
        (4, "Some prose.\nreleased under the  M.I.T. licence\n  Released under the MIT Licence!\nLicensed under CC BY-NC 4.0.\nmore"),
        (5, "This work is licensed under the GNU General Public Licence, Version 3."),
        (6, "licence licence licences"),
        (7, None), (8, ""), (9, "Copyright 2020 only"), (None, "Released under the MIT License."), (None, "Released under the MIT License."),
        (10, "x " * 100_000 + "\nLicensed under the Apache License, Version 2.0.\n"),
        (11, "All rights reserved. Licensed under CC BY 4.0."),
        (12, "Copyright notice\n(c) you must retain\n(C) 2019 x\n(c)copyright y\n copyright: 1999\ncopyright:\t© z\nCopyright law\n©w"),
        (13, "(c)\ncopyright\n" + dict(L.TEXTS)["GPL-2.0"].replace("\n", " ")),
    ]


def test_texts_and_lines(docs_of):
    got = {r.doc_id: r for r in L.scan_licenses(docs_of(rows_of())).collect()}
    assert [got[k].license for k in (1, 2, 3, 4, 5, 6)] == ["MIT", "MIT", None, None, "GPL-3.0", None]
    assert got[4].line_licenses == "CC-BY-NC-4.0,MIT" and got[10].line_licenses == "Apache-2.0"
    assert got[7].text_digest is None and got[9].text_digest is None and got[9].license is None
    assert got[None].license == "MIT" and got[None].line_licenses == "MIT"


def test_matches_sql(docs_of):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows_of())
    rel = con.sql(sql.license_scan(L.TEXTS + L.NOTICES, L.NOTICES, L.EQUIVALENTS, L.PUNCTUATION))
    got = L.scan_licenses(docs_of(rows_of())).select(*rel.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rel.fetchall(), key=str)


def test_empty_table(docs_of):
    assert L.scan_licenses(docs_of([(1, "a")]).limit(0)).count() == 0


def test_long_licences_as_whole_documents(docs_of):
    texts = {n: t for n, t in reversed(L.TEXTS)}
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"]
    rows = [(k, texts[n].upper().replace("\n", "\r\n")) for k, n in enumerate(names)]
    apache = texts["Apache-2.0"]
    rows += [(10, apache[: apache.index("END OF TERMS")]), (11, apache[: apache.index("END OF TERMS") + 27]), (12, apache[: len(apache) // 2])]
    rows += [(13, "\n\n".join(" ".join(p.split()) for p in apache.split("\n\n")))]
    got = {r.doc_id: r.license for r in L.scan_licenses(docs_of(rows)).collect()}
    assert [got[k] for k in range(len(names))] == names
    assert [got[k] for k in (10, 11, 12, 13)] == ["Apache-2.0", "Apache-2.0", None, "Apache-2.0"]


def _wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


def test_any_wrapping_of_every_licence_is_found(docs_of):
    names = sorted({n for n, _ in L.TEXTS})
    texts = {n: t for n, t in reversed(L.TEXTS)}
    rows = [(k * 1000 + w, _wrapped(texts[n], w)) for k, n in enumerate(names) for w in range(50, 101, 2)]
    got = L.scan_licenses(docs_of(rows)).select("doc_id", "license").collect()
    assert [(r.doc_id, r.license) for r in got if r.license != names[r.doc_id // 1000]] == []
    assert len(got) == len(rows) == 26 * len(names)


def test_own_copyright_line_and_any_wrapping(docs_of):
    names = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Apache-2.0", "MPL-2.0"]
    texts = {n: t for n, t in reversed(L.TEXTS)}
    rows = [(k * 1000 + w, "Copyright (c) 2024 Jane Doe\n\n" + _wrapped(texts[n], w)) for k, n in enumerate(names) for w in range(50, 101, 5)]
    got = L.scan_licenses(docs_of(rows)).select("doc_id", "license").collect()
    assert [(r.doc_id, r.license) for r in got if r.license != names[r.doc_id // 1000]] == []
