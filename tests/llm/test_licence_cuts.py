"""Licences in texts of which each cut knows a part."""

import textwrap

from tilewright.llm.licenses import SENTENCES, scan_licenses


def test_licences_of_both_cuts_are_merged_by_place(spark):
    wrap = lambda *names: "\n".join(textwrap.wrap(" ".join(SENTENCES[n] for n in names), 70))
    mit, line = wrap("mit-grant", "mit-notice"), "import data\nLicensed under CC BY-NC 4.0.\nx = 1"
    apache = "# Licensed under the Apache License, Version 2.0\n# (the \"License\"); you may not use this file except in\n# compliance with the License."
    texts = [f"{mit}\n\n{line}", f"{line}\n\n{mit}", f"{line}\nx\nAll rights reserved.\ny\nReleased under CC0 1.0.\nz\n\n{mit}\n\n", apache,
             f"{line}\n\n{apache}\n\n***\nMIT License\n\nMIT License"]
    out = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.sentences, r.licenses, r.terms) for r in out} == {
        0: ("mit-grant,mit-notice,cc-by-nc-4", "MIT,CC-BY-NC-4.0", "restricted"), 1: ("cc-by-nc-4,mit-grant,mit-notice", "MIT,CC-BY-NC-4.0", "restricted"),
        2: ("cc-by-nc-4,reserved,cc0,mit-grant,mit-notice", "MIT,CC-BY-NC-4.0,CC0-1.0,all-rights-reserved", "restricted"),
        3: ("apache-grant", "Apache-2.0", "permissive"), 4: ("cc-by-nc-4,apache-grant,mit-title-short,mit-title-short", "Apache-2.0,CC-BY-NC-4.0", "restricted")}


def numbered(*texts):
    return list(enumerate(texts))


def _wrapped(names, width=70, prefix=""):
    return "\n\n".join("\n".join(prefix + line for line in textwrap.wrap(SENTENCES[n], width)) for n in names)


BUNDLES = {
    "BSD-3-Clause": "\n\n".join(["Copyright (c) 2020, Someone", _wrapped(["bsd-grant"]), "1. " + _wrapped(["bsd-source"]), "2. " + _wrapped(["bsd-binary"]), "3. " + _wrapped(["bsd-name"])]),
    "BSD-2-Clause": _wrapped(["bsd-grant"]) + "\n\n* " + _wrapped(["bsd-source"]) + "\n\n* " + _wrapped(["bsd-binary"]),
    "MPL-2.0": "/* " + SENTENCES["mpl-form"] + " If a copy of the MPL was not\n * distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/. */",
    "ISC": _wrapped(["isc-grant"], 60, "# "), "LGPL-2.1-or-later": _wrapped(["lgpl21-free"]), "LGPL-3.0-or-later": _wrapped(["lgpl3-free", "gpl-hope"]),
    "AGPL-3.0-or-later": _wrapped(["agpl-free", "gpl-hope"], 64, "// "), "GPL-2.0-or-later": _wrapped(["gpl2-free"]),
    "Apache-2.0": "2. Grant of Copyright License. " + SENTENCES["apache-body"], "Unlicense": SENTENCES["unlicense"] + "\n\nAnyone is free to copy.",
}


def test_common_licences_are_told_apart(spark):
    out = scan_licenses(spark.createDataFrame(numbered(*BUNDLES.values()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.licenses for r in out} == dict(enumerate(BUNDLES))
    header = _wrapped(["apache-grant"]) + "\n" + SENTENCES["apache-at"] + "\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n" + "\n".join(
        textwrap.wrap(SENTENCES["apache-basis"] + " " + SENTENCES["apache-see"], 70))
    (r,) = scan_licenses(spark.createDataFrame([(1, header)], "doc_id long, text string")).collect()
    assert (r.sentences, r.licenses) == ("apache-grant,apache-at,apache-basis,apache-see", "Apache-2.0")


def test_sql_is_of_the_same_definition(spark, tmp_path):
    import duckdb

    import awkward
    from tilewright.llm.queries import ORACLES, QUERIES

    line = "import data\nLicensed under CC BY-NC 4.0.\nx = 1\n\n"
    texts = [*BUNDLES.values(), *(line + b for b in BUNDLES.values()), "\n".join(BUNDLES.values()), None, "", "Released under the MIT License. All rights reserved.\nAll rights reserved.",
             "MIT License\n\nMIT License\n" + line]
    frame = spark.createDataFrame(numbered(*texts), "doc_id long, text string").unionByName(awkward.documents(spark).select("doc_id", "text"))
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(ORACLES["op10_license_scans"]).fetchall()
    got = [tuple(r) for r in QUERIES["op10_license_scans"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(bool(r[2]) for r in got) > 20
