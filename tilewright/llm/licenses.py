"""Licence scans: normalised sentences become identifiers, whose sequences are matched against ordered licence rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, by name. They are normalised like texts before use.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                 "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                 "subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
             "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-at": "You may obtain a copy of the License at",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "apache-body": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
                   "royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
                   "distribute the Work and such Derivative Works in Source or Object form.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                 "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                   "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
                 "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                  "documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                "software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
                 "copyright notice and this permission notice appear in all copies.",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "Released under CC0 1.0.",
    "reserved": "All rights reserved.",
    "public-domain": "This work is in the public domain.",
}
# Ordered rules, the licence each recognises and what it permits. Longer rules come first and use up their sentences.
RULES = (
    (("apache-grant", "apache-copy", "apache-basis", "apache-see"), "Apache-2.0", "permissive"),
    (("apache-grant", "apache-at", "apache-basis", "apache-see"), "Apache-2.0", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-name"), "BSD-3-Clause", "permissive"),
    (("mit-title", "mit-grant", "mit-notice", "as-is"), "MIT", "permissive"),
    (("mit-title-short", "mit-grant", "mit-notice", "as-is"), "MIT", "permissive"),
    (("mit-grant", "mit-notice", "as-is"), "MIT", "permissive"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause", "permissive"),
    (("agpl-free", "gpl-hope"), "AGPL-3.0-or-later", "copyleft"),
    (("lgpl3-free", "gpl-hope"), "LGPL-3.0-or-later", "copyleft"),
    (("gpl2-free", "gpl-hope"), "GPL-2.0-or-later", "copyleft"),
    (("gpl-free", "gpl-hope"), "GPL-3.0-or-later", "copyleft"),
    (("apache-grant", "apache-copy"), "Apache-2.0", "permissive"),
    (("reserved", "mit-released"), "MIT", "permissive"),
    (("reserved", "apache-short"), "Apache-2.0", "permissive"),
    (("mit-grant", "mit-notice"), "MIT", "permissive"),
    (("mit-released",), "MIT", "permissive"),
    (("mit-licensed",), "MIT", "permissive"),
    (("apache-short",), "Apache-2.0", "permissive"),
    (("apache-grant",), "Apache-2.0", "permissive"),
    (("gpl3-short",), "GPL-3.0-only", "copyleft"),
    (("gpl-free",), "GPL-3.0-or-later", "copyleft"),
    (("gpl2-free",), "GPL-2.0-or-later", "copyleft"),
    (("agpl-free",), "AGPL-3.0-or-later", "copyleft"),
    (("lgpl3-free",), "LGPL-3.0-or-later", "copyleft"),
    (("lgpl21-free",), "LGPL-2.1-or-later", "copyleft"),
    (("mpl-form",), "MPL-2.0", "copyleft"),
    (("isc-grant",), "ISC", "permissive"),
    (("apache-body",), "Apache-2.0", "permissive"),
    (("unlicense",), "Unlicense", "permissive"),
    (("cc-by-nc-4",), "CC-BY-NC-4.0", "restricted"),
    (("cc-by-4",), "CC-BY-4.0", "permissive"),
    (("cc-by-sa-4",), "CC-BY-SA-4.0", "copyleft"),
    (("cc0",), "CC0-1.0", "permissive"),
    (("public-domain",), "public-domain", "permissive"),
    (("bsd-grant",), "BSD", "permissive"),
    (("reserved",), "all-rights-reserved", "restricted"),
)
# Worst first: what a text with several licences permits.
TERMS = ("restricted", "copyleft", "permissive")
# A sentence ends at . ! ? or : before white space and what opens the next one, and at a line end; in wrapped text, at a blank line.
LINES = r"\n+|(?<=[.!?:])[ \t\r]+(?=[A-Z\"(])"
WRAPPED = r"\n[ \t\r]*\n|(?<=[.!?:])[ \t\r\n]+(?=[A-Z\"(#*/])"
NOISE = r"[^a-z0-9]+"
HINT = "(?i)licen|reserved|domain|permi|warrant|merchantab|software|cc0|redistribut"


def normal(sentence: Column) -> Column:
    """Lower-case letters and digits with single spaces between; signs and marks of comments do not matter."""
    return F.trim(F.regexp_replace(F.lower(sentence), NOISE, " "))


def _known(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def names() -> dict[str, str]:
    """Name of each known sentence by its normal form."""
    return {_known(text): name for name, text in SENTENCES.items()}


def scan_licenses(documents: DataFrame) -> DataFrame:
    """doc_id, sentences, licenses, terms for each row of (doc_id, text).

    ``sentences`` lists the names of all known sentences by their place in the text, whether they are known by lines or as
    wrapped text; one that lies within another counts as part of it. ``licenses`` are those that rules recognise in them, each
    once where its first matching rule stands in RULES, ``terms`` the strictest they ask for, or null. Rules match names that follow each other,
    whatever other sentences stand between; a name that a rule has used serves no later rule.

    Null and empty texts: no sentences, no licences. Rows are independent; null and repeated ids are scanned like any other. An empty
    table gives no rows, and other columns are ignored.
    """
    known = F.create_map(*(F.lit(x) for pair in names().items() for x in pair))

    def named(ends: str) -> Column:
        # every known sentence has one of these words; only such pieces are normalised
        likely = F.filter(F.split("text", ends), lambda s: s.rlike(HINT))
        return F.filter(F.transform(likely, lambda s: F.try_element_at(known, normal(s))), lambda n: n.isNotNull())

    def placed(ends: str) -> Column:
        """(start, back, name) of the known sentences; places count letters and digits, which no cut removes, and back is minus the end."""
        pieces = F.transform(F.split("text", ends), lambda s: F.struct(
            F.length(F.regexp_replace(F.lower(s), NOISE, "")).alias("n"), F.when(s.rlike(HINT), F.try_element_at(known, normal(s))).alias("name")))

        def step(state: Column, piece: Column) -> Column:
            end = state["end"] + piece["n"]
            one = F.struct(state["end"].alias("start"), (-end).alias("back"), piece["name"].alias("name"))
            return F.struct(end.alias("end"), F.when(piece["name"].isNotNull(), F.array_append(state["found"], one)).otherwise(state["found"]).alias("found"))

        return F.aggregate(pieces, F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,back:int,name:string>>").alias("found")),
                           step, lambda state: state["found"])

    def further(state: Column, one: Column) -> Column:
        # by start and then from the longest: what ends no later than one before it lies within that
        new = -one["back"] > state["end"]
        return F.struct(F.greatest(state["end"], -one["back"]).alias("end"),
                        F.when(new, F.array_append(state["found"], one["name"])).otherwise(state["found"]).alias("found"))

    both = F.when(F.col("text").rlike(HINT), F.struct(named(LINES).alias("lines"), named(WRAPPED).alias("wrapped")))
    none = F.array().cast("array<string>")
    merged = F.aggregate(F.array_sort(F.concat(placed(LINES), placed(WRAPPED))), F.struct(F.lit(0).alias("end"), none.alias("found")), further, lambda s: s["found"])
    # places matter only where both cuts know something
    found = F.when(F.size("b.lines") == 0, F.col("b.wrapped")).when(F.size("b.wrapped") == 0, F.col("b.lines")).when(F.col("b").isNotNull(), merged).otherwise(none)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", both.alias("b")).select("doc_id", found.alias("found"))
    state = F.struct(F.array_join(F.transform("found", lambda n: F.concat(F.lit("|"), n, F.lit("|"))), "").alias("left"),
                     F.array().cast("array<string>").alias("licenses"), F.array().cast("array<string>").alias("terms"))
    rules = F.array(*(F.struct(F.lit("".join(f"|{n}|" for n in rule)).alias("mark"), F.lit(name).alias("license"), F.lit(terms).alias("terms"))
                      for rule, name, terms in RULES))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["mark"])
        add = lambda field, value: F.when(hit, F.array_append(state[field], value)).otherwise(state[field]).alias(field)
        # what a rule used leaves a mark that no sequence spans
        left = F.when(hit, F.replace(state["left"], rule["mark"], F.lit("#"))).otherwise(state["left"])
        return F.struct(left.alias("left"), add("licenses", rule["license"]), add("terms", rule["terms"]))

    matched = F.when(F.size("found") > 0, F.aggregate(rules, state, apply))
    terms = F.coalesce(*(F.when(F.array_contains("m.terms", t), F.lit(t)) for t in TERMS))
    return rows.withColumn("m", matched).select("doc_id", F.array_join("found", ",").alias("sentences"),
                                                F.coalesce(F.array_join(F.array_distinct("m.licenses"), ","), F.lit("")).alias("licenses"), terms.alias("terms"))
