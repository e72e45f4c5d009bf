"""The licence scan: notices in documents, damage, and what only looks like a notice."""

from tripflow.llm import licenses

from .helpers import docs_of

NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache", "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC",
}


def spans_by_hand(text):
    at, out = 0, []
    for line in (text or "").split("\n"):
        if line in NOTICES:
            out.append(f"{NOTICES[line]}:{at}:{at + len(line)}")
        at += len(line) + 1
    return ",".join(out)


def test_documents_and_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = licenses.fit(docs)
    found = {r["doc_id"]: r["spans"] for r in licenses.scan(docs, model).collect()}
    assert found == {r["doc_id"]: spans_by_hand(r["text"]) for r in docs.collect()}

    texts = [
        None, "", "é first\n\nThis software is released under the MIT license", "You need a driving license in this country.",
        licenses.TEMPLATES[2][2] + " and so on", "Licensed under the Foo License, Version 2.0.", "\n".join(["Released under the MIT License."] * 3),
        "license " * 2000, "This work is licensed under the GNU Affero General Public License, version 3",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
    ]
    rows = licenses.scan(docs_of(spark, [*texts, (None, texts[2]), (2, texts[2])], extra=True), model).collect()
    families = [(r["doc_id"], r["families"], r["n_licenses"]) for r in rows]
    expected = ["", "", "MIT", "", "MIT", "", "MIT", "", "AGPL", "LGPL"]
    assert sorted(map(str, families)) == sorted(
        str((k, f, 3 if k == 6 else int(bool(f)))) for k, f in [*enumerate(expected), (None, "MIT"), (2, "MIT")]
    )
    assert next(r["spans"] for r in rows if r["doc_id"] == 2) == "MIT:9:56"
    plan = licenses.scan(docs, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert licenses.scan(docs_of(spark, ["a"]).filter("false")).count() == 0


def test_every_template_has_a_cue():
    import re

    for _, names, body in licenses.TEMPLATES:
        found = set(re.findall(r"[a-z0-9]+", body.lower()))
        assert set(names.split()) <= found
        assert re.search(licenses.CUES, names.split()[0])


WRAPPED = {
    "MIT": licenses.TEMPLATES[2][2] + ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "GPL": licenses.TEMPLATES[7][2],
    "LGPL": licenses.TEMPLATES[9][2],
    "BSD": licenses.TEMPLATES[14][2],
    "MPL": licenses.TEMPLATES[15][2] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
SHORT = {
    "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: Apache-2.0": "Apache", "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL",
    "License: MIT": "MIT", "MIT License": "MIT", "SPDX-License-Identifier: BSD-3-Clause": "BSD",
}


def test_wrapped_and_short_notices(spark):
    import textwrap

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = licenses.fit(docs)
    before, after = "He went home late.\n\n", "\n\nThe end of the file is here."
    cases = [
        (f, before + textwrap.fill(body, width, initial_indent=mark, subsequent_indent=mark) + after)
        for f, body in WRAPPED.items() for width in (40, 72, 80) for mark in ("", "# ", " * ")
    ]
    cases += [(f, before + text + after) for text, f in SHORT.items()]
    cases += [("", "He asked for permission\nand left the house free of charge.\nThe license was red."), ("", "license\n" * 300)]
    rows = {r["doc_id"]: r for r in licenses.scan(docs_of(spark, [text for _, text in cases]), model).collect()}
    assert [(f, rows[k]["families"], rows[k]["n_licenses"]) for k, (f, _) in enumerate(cases)] == [(f, f, int(bool(f))) for f, _ in cases]
    for k, (f, text) in enumerate(cases):
        if f:
            start, end = map(int, rows[k]["spans"].split(":")[1:])
            assert len(before) <= start < end <= len(text) - len(after)
