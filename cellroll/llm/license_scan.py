"""Licence statements in whole texts by sentence rules, in built-in functions only.

Texts are cut into sentences and each is normalised to lower-case letters and digits with single spaces.
Known sentences have identifiers; a licence is an ordered rule of identifiers, and it is found where they
stand one after another.  Sentences are cut in two ways: at every line end (``line``), and across line ends
up to a stop or an empty line (``flow``), as licences are often wrapped.  Before that, comment marks and list
marks (bullets, item numbers) at line starts are dropped, so a line of only comment marks is an empty line.
A licence may be stated in several ways.  Where a licence begins with all of another's sentences (BSD-3-Clause
with those of BSD-2-Clause), the longer one counts alone.

The table of known sentences is a constant of this module, so its broadcast is of fixed size.  Documents with
no match, NULL and empty texts give no row.  Repeated rows count their matches together; rows with a NULL id
are one document.  Very long texts are cut whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Published licence sentences, in the order in which each licence states them.
RULES: dict[str, list[str]] = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MIT-notice": ["Released under the MIT License."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "Apache-2.0-header": [
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "Apache-2.0-notice": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0-notice": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-header": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    ],
    "CC-BY-NC-4.0-notice": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0-notice": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "all-rights-reserved": ["All rights reserved."],
}

_BSD = RULES["BSD-2-Clause"]
_APACHE = RULES["Apache-2.0-header"]
_NO_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
_LIBRARY = "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission."
# Further licences, and further ways to state those above; names may repeat.
MORE_RULES: list[tuple[str, list[str]]] = [
    # as published, an empty line stands between "at" and the address
    *[("Apache-2.0-header", [*_APACHE[:2], "You may obtain a copy of the License at\n\n" + x]) for x in ("http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0")],
    ("Apache-2.0-header", [*_APACHE[:2], "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"]),
    ("MIT", [RULES["MIT"][0], "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."]),
    ("MIT-0", [RULES["MIT"][0].replace(", subject to the following conditions:", ".")]),
    ("ISC", [RULES["ISC"][0].replace("and/or distribute", "and distribute")]),
    ("BSD-3-Clause", [*_BSD, f"3. Neither the name of the copyright holder nor the names of its contributors {_ENDORSE}"]),
    ("BSD-3-Clause", [*_BSD, "3. Neither the name of the copyright holder.", f"Nor the names of its contributors {_ENDORSE}"]),  # of Example Inc. nor ...
    ("BSD-4-Clause", [*_BSD, "3. All advertising materials mentioning features or use of this software must display the following acknowledgement:"]),
    (
        "GPL-2.0-header",
        ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", _NO_WARRANTY],
    ),
    (
        "GPL-2.0-only-header",
        ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", _NO_WARRANTY],
    ),
    (
        "LGPL-2.1-header",
        ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", _LIBRARY],
    ),
    (
        "LGPL-3.0-header",
        ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", _NO_WARRANTY],
    ),
    (
        "AGPL-3.0-header",
        ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", _NO_WARRANTY],
    ),
    *[("MPL-2.0-header", ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at " + x]) for x in ("http://mozilla.org/MPL/2.0/.", "https://mozilla.org/MPL/2.0/.")],
]

# Marks after a line feed: of comments, also dnl and rem; then a bullet, 1. or (a)
_SIGNS = r"[ \t\r#*/;:%!<>|'\"~=+_\-\u2022]*"
LINE_MARKS = rf"\n{_SIGNS}(?:(?:dnl|rem|REM)(?=[ \t\r\n]){_SIGNS})?(?:\(?(?:[0-9]{{1,2}}|[a-h]|i{{1,3}}|iv)[.)][ \t]+)?"
# BSD's third condition names the holder
HOLDER = "neither the name of "
HELD = r"^neither the name of .+? nor the names? of (?:its|their|the) contributors "

# The same three steps in Spark and in DuckDB: mark the sentence ends, drop other characters, join marks.
STOP = r"([.!?;:])[ \t\r\n]+"
EMPTY_LINE = r"\n[ \t\r]*\n"


def sentences_of(text: str) -> list[str]:
    """A known statement's own normalised sentences, cut as ``flow`` cuts texts."""
    marked = re.sub(STOP, r"\1\n", text)
    return [re.sub(r"[^A-Za-z0-9]+", " ", x).strip().lower() for x in marked.split("\n")]


def unmarked_text(text: str) -> str:
    """A known statement without its own list marks, as they are dropped from texts."""
    return re.sub(LINE_MARKS, "\n", "\n" + text)


def known_ways(rules: dict[str, list[str]] | None = None) -> list[tuple[str, str, int, int, int]]:
    """(sentence, rule, place, places, way): ``known_sentences`` of each way to state a licence, without list marks."""
    ways = [*RULES.items(), *MORE_RULES] if rules is None else list(rules.items())
    return [(*x, way) for way, (name, texts) in enumerate(ways) for x in known_sentences({name: [unmarked_text(t) for t in texts]})]


def known_sentences(rules: dict[str, list[str]]) -> list[tuple[str, str, int, int]]:
    """(sentence, rule, place in the rule from 0, places) for every rule."""
    out = []
    for name, texts in rules.items():
        flat = [s for t in texts for s in sentences_of(t) if s]
        out += [(s, name, i, len(flat)) for i, s in enumerate(flat)]
    return out


def unmarked(text: Column) -> Column:
    """A text without comment and list marks at line starts."""
    return F.regexp_replace(F.concat(F.lit("\n"), text), LINE_MARKS, "\n")


def any_holder(sentence: Column) -> Column:
    """BSD's condition on the holder's name, with the published words for the name."""
    known = F.regexp_replace(sentence, HELD, "neither the name of the copyright holder nor the names of its contributors ")
    return F.when(~sentence.startswith(HOLDER), sentence).when(sentence.contains(" nor the name"), known).otherwise("neither the name of the copyright holder")


def normalised(text: Column, flow: bool) -> Column:
    """Lower-case sentences of a text with a line feed between them."""
    if flow:
        text = F.regexp_replace(F.regexp_replace(text, EMPTY_LINE, "\u0001"), STOP, "$1\u0001")
        text = F.regexp_replace(F.translate(text, "\n", " "), "\u0001", "\n")
    else:
        text = F.regexp_replace(text, STOP, "$1\n")
    text = F.regexp_replace(text, "[^A-Za-z0-9\n]+", " ")
    return F.lower(F.trim(F.regexp_replace(text, " ?\n[ \n]*", "\n")))


def license_scan(docs: DataFrame, *, rules: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, n_matches: how often each licence's sentences stand in order in a document.

    n_matches is the larger of the counts of the two ways to cut sentences.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(known_ways(rules), "sentence string, license string, place int, places int, way int")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # repeated ids must not mix their sentences' places: rows are told apart by their text
    row = F.xxhash64("text").alias("row")
    docs = docs.select("doc_id", row, unmarked(F.col("text")).alias("text"))
    cut = None
    for flow in (False, True):
        lines = F.split(normalised(F.col("text"), flow), "\n")
        part = docs.select("doc_id", "row", F.lit(flow).alias("flow"), F.posexplode(lines).alias("at", "sentence"))
        cut = part if cut is None else cut.unionByName(part)
    cut = cut.withColumn("sentence", any_holder(F.col("sentence")))
    steps = cut.join(F.broadcast(known), "sentence")
    start = (F.col("at") - F.col("place")).alias("start")
    steps = steps.groupBy("doc_id", "row", "flow", "license", "way", "places", start, "place").agg(F.count("*").alias("copies"))
    found = steps.groupBy("doc_id", "row", "flow", "license", "way", "places", "start").agg(F.count("*").alias("n"), F.min("copies").alias("copies")).where("n = places")
    longest = F.max("places").over(Window.partitionBy("doc_id", "row", "flow", "start"))
    found = found.withColumn("longest", longest).where("places = longest")
    counts = found.groupBy("doc_id", "flow", "license").agg(F.sum("copies").alias("n"))
    return counts.groupBy("doc_id", "license").agg(F.max("n").alias("n_matches"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql(rules: dict[str, list[str]] | None = None) -> str:
    """The same result in DuckDB SQL for ``RULES`` and texts without marks at line starts."""
    known = ", ".join(f"({_quoted(s)}, {_quoted(r)}, {i}, {n})" for s, r, i, n in known_sentences(RULES if rules is None else rules))

    def tidy(text: str) -> str:
        return rf"string_split(lower(trim(regexp_replace(regexp_replace({text}, '[^A-Za-z0-9\n]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'))), chr(10))"

    line = tidy(rf"regexp_replace(text, '([.!?;:])[ \t\r\n]+', '\1' || chr(10), 'g')")
    flow = tidy(r"replace(replace(regexp_replace(regexp_replace(text, '\n[ \t\r]*\n', chr(1), 'g'), '([.!?;:])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(10), ' '), chr(1), chr(10))")
    return f"""
    WITH known(sentence, license, place, places) AS (VALUES {known}),
    parts AS (
      SELECT doc_id, text, false AS flow, {line} AS s FROM documents WHERE text IS NOT NULL
      UNION ALL SELECT doc_id, text, true, {flow} FROM documents WHERE text IS NOT NULL),
    cut AS (SELECT doc_id, text, flow, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS nth FROM parts),
    steps AS (SELECT doc_id, text, flow, license, places, nth - place AS begun, place, count(*) AS copies
      FROM cut JOIN known USING (sentence) GROUP BY ALL),
    found AS (SELECT doc_id, text, flow, license, places, begun, count(*) AS n, min(copies) AS copies
      FROM steps GROUP BY ALL HAVING count(*) = places),
    counts AS (SELECT doc_id, flow, license, sum(copies) AS n FROM found GROUP BY ALL)
    SELECT doc_id, license, CAST(max(n) AS BIGINT) AS n_matches FROM counts GROUP BY ALL"""
