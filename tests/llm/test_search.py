"""Exact top-k against brute force; licence rules; decontamination."""

import math
import random

import duckdb
import numpy as np
from llm_helpers import SMALL, words

from cellroll.llm import decontam
from cellroll.llm.license_scan import RULES, license_scan, oracle_sql
from cellroll.llm.va_topk import search_block, top_k


def brute_top(rows, k, every):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(0, 0.3, 9).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.25] * 9) for i in range(60)]  # ties
    rows += [(5, None), (10, []), (15, [None] * 9), (20, [float("nan")] * 9), (25, [float("inf")] + [0.0] * 8), (None, [1.0] * 9), (2000, [1.0, 2.0]), (2001, [3.0, 4.0]), (301, rows[1][1]), (301, rows[1][1])]
    df = spark.createDataFrame([(i, v, 1, "b") for i, v in rows], "vec_id long, embedding array<float>, block int, n string")
    got = sorted(tuple(x) for x in top_k(df, k=4, every=5).collect())
    narrow = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_top(narrow, 4, 5)
    assert top_k(df.where("false")).count() == 0


def test_search_reads_few_exact_vectors():
    from cellroll.llm.va_topk import _pack

    import pandas as pd

    r = np.random.default_rng(2)
    v = np.floor(r.normal(0, 50, (4000, 16)))
    row = next(_pack(pd.DataFrame({"block": 0, "vec_id": np.arange(4000), "v": list(v)})).itertuples(index=False))
    q, ids, scores, read = search_block(np.array([7]), v[7:8], row, 5)
    exact = v @ v[7]
    exact[7] = -1e18
    assert sorted(scores.tolist()) == sorted(np.sort(exact)[-5:].astype(int).tolist())
    assert read < 1000


def test_huge_components_saturate(spark):
    df = spark.createDataFrame([(0, [3e38, 3e38]), (1, [3e38, 3e38]), (2, [-3e38, -3e38])], "vec_id long, embedding array<float>")
    got = [(r["vec_id"], r["score"]) for r in top_k(df, k=2, every=50).collect()]
    assert got == [(1, 2**63 - 1), (2, -(2**63))]


def test_licences_in_order(frame):
    mit = "\n\n".join(RULES["MIT"])
    wrapped = mit.replace(" without", "\nwithout").replace(" copies", "\n   copies")
    rows = [
        (1, "x\n" + mit), (2, "Some words.\n" + wrapped + "\nmore"), (3, RULES["MIT"][1] + "\n" + RULES["MIT"][0]), (4, "All rights reserved. All Rights  RESERVED."),
        (5, None), (6, ""), (7, "not all rights reserved here"), (8, "ä" * 50_000 + ".\nReleased under the MIT License."), (9, "All rights reserved."), (9, "All rights reserved."), (None, "All rights reserved."),
    ]
    got = {(r["doc_id"], r["license"]): r["n_matches"] for r in license_scan(frame(rows)).collect()}
    assert got == {(1, "MIT"): 1, (2, "MIT"): 1, (4, "all-rights-reserved"): 2, (8, "MIT-notice"): 1, (9, "all-rights-reserved"): 2, (None, "all-rights-reserved"): 1}
    assert license_scan(frame([])).count() == 0


def test_licences_equal_sql(spark):
    from cellroll.llm.queries import op10_license_scan

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, license, n_matches FROM ({oracle_sql()})").fetchall())
    assert want and sorted(tuple(r) for r in op10_license_scan(spark, SMALL).collect()) == want


APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
ISC = """Copyright (c) 2020 Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD2 = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
GPL2 = """Copyright (C) 2020 Some One

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL3 = GPL2.replace("software;", "software:").replace("Foundation; either version 2", "Foundation, either version 3")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_published_licences_plain_and_in_comments(frame):
    texts = [(APACHE, "Apache-2.0-header"), (MIT, "MIT"), (ISC, "ISC"), (BSD2 + WARRANTY, "BSD-2-Clause"), (BSD3 + WARRANTY, "BSD-3-Clause"), (GPL2, "GPL-2.0-header"), (GPL3, "GPL-header"), (MPL, "MPL-2.0-header")]
    bullets = (BSD3 + WARRANTY).replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    texts += [(bullets, "BSD-3-Clause"), (bullets.replace("the copyright holder nor", "Example Corp nor"), "BSD-3-Clause"), (bullets.replace("the copyright holder nor", "Example Inc. nor"), "BSD-3-Clause")]
    texts += [((BSD2 + WARRANTY).replace("1. ", "(1) ").replace("2. ", "(2) "), "BSD-2-Clause"), (APACHE.replace("at\n\n", "at\n"), "Apache-2.0-header"), (APACHE.replace("http:", "https:"), "Apache-2.0-header"), (ISC.replace("and/or", "and"), "ISC")]

    def marked(text, mark):
        return "\n".join((mark + x).rstrip() for x in text.split("\n"))

    rows, want = [], {}
    for text, name in texts:
        for x in (text, marked(text, "# "), "/*\n" + marked(text, " * ") + "\n */\nint x;", marked(text, "// "), marked(text, ";; "), marked(text, "dnl "), marked(text, "# ").replace("\n", "\r\n")):
            want[len(rows), name] = 1
            rows.append((len(rows), x))
    assert {(r["doc_id"], r["license"]): r["n_matches"] for r in license_scan(frame(rows)).collect()} == want


def edits_to_any_run(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(r, vocabulary, own, rate):
    own = list(own)
    for _ in range(round(rate * len(own))):
        p, q = r.randrange(len(own)), r.random()
        if q < 0.5:
            own[p] = r.choice(vocabulary)
        elif q < 0.75:
            own.insert(p, r.choice(vocabulary))
        else:
            del own[p]
    return own


def test_decontamination_recall_and_exactness(frame, spark, vocabulary):
    r = random.Random(9)
    items = [(i, " ".join(words(r, vocabulary, r.randint(15, 60)))) for i in range(60)]
    items += [(100, "one two"), (101, ""), (102, None), (None, "no id here"), (103, items[0][1])]
    docs = []
    for k in range(240):
        own = words(r, vocabulary, 60)
        if k % 2:
            rate = (0, 0.05, 0.1)[k % 3]
            own += edited(r, vocabulary, items[k % 60][1].split(), rate)
        docs.append((k, " ".join(own + words(r, vocabulary, 60)).encode().upper().decode()))  # A-Z only
    docs += [(500, None), (501, ""), (502, "x One, TWO! y"), (None, items[3][1]), (7, docs[7][1])]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, key string")
    got = {(x["doc_id"], x["item_id"]): x["edits"] for x in decontam.contaminated(frame(docs), bench).collect()}
    found = total = 0
    for k, t in docs:
        text = decontam.normal_words(t)
        for i, item in items:
            own = decontam.normal_words(item)
            if i is None or not own:
                continue
            best = edits_to_any_run(own, text)
            true = best <= int(0.2 * len(own) + 1e-9)
            if (k, i) in got:
                assert true and got[k, i] >= best  # only true ones are reported
            total, found = total + true, found + (true and (k, i) in got)
    assert total >= 120 and found >= 0.95 * total
    assert got[502, 100] == 0 and (None, 3) in got
    assert decontam.contaminated(frame([]), bench).count() == 0
    assert decontam.contaminated(frame(docs), bench.where("false")).count() == 0


def test_items_in_rounds(frame, spark, vocabulary, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 2)
    r = random.Random(2)
    items = [(i, " ".join(words(r, vocabulary, 20))) for i in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame([(i, t) for i, t in items])
    assert sorted((x["doc_id"], x["item_id"]) for x in decontam.contaminated(docs, bench).collect()) == [(i, i) for i in range(5)]


def test_short_items_are_always_found():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = [words(r, vocabulary, n) for n in range(1, 15) for _ in range(25)]
    found, texts = decontam.Items(list(range(len(items))), [" ".join(x) for x in items], 0.8), []
    for k, item in enumerate(items):
        own = list(item)
        for _ in range((k % 3 > 0) * (len(item) // 5)):  # exact copies and the allowed fifth
            own = edited(r, vocabulary, own, 1 / len(own))
        texts.append(words(r, vocabulary, r.choice((0, 1, 30))) + own + words(r, vocabulary, r.choice((0, 1, 30))))
    h, bounds = decontam.word_hashes(*_block([" ".join(x) for x in texts]))
    got = {}
    for text, item, begin in found.candidates(h, bounds):
        for t, i, e in zip(text, item, found.verify(h, bounds, text, item, begin), strict=True):
            if e <= found.edits[i]:
                got[t, i] = min(e, got.get((t, i), e))
    want = {}
    for k, text in enumerate(texts):
        for i, item in enumerate(items):
            if set(item) & set(text) and (e := edits_to_any_run(item, text)) <= len(item) // 5:
                want[k, i] = e
    assert len(want) >= len(items) and got == want


def _block(texts):
    data = [x.encode() + b"\n" for x in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])])
