import random

import pytest
from pyspark.sql import functions as F

from tempest.llm import op8_licenses as op8
from tempest.llm import op10_chat_rotation as op10

from .conftest import words


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, licence string, term string")
    return {x.doc_id: x for x in op8.scan_licences(spark, df, "doc_id", F.col("path")).collect()}


def test_statements_and_inheritance(spark):
    body = words(1, 300)
    rows = [(1, "a/LICENSE", "Licensed under the Apache License, Version 2.0.\n" + body), (2, "a/b/c/x.py", body), (3, "a/b/LICENSE.txt", "Released under the MIT License."),
            (4, "a/b/c/d.py", f"{body}\n# This work is licensed under the GNU General Public License, version 3.\n{body}"), (5, "z/y", body),
            (6, "a/top.py", body), (7, None, body), (8, "a/b/c/e", None), (9, "a/n", f"{body} Licensed under CC BY-NC 4.0. {body}"),
            (10, "LICENSE", "All the words of nothing"), (11, "a/b2/x", body), (12, "q/r", "see the license of the other file for the terms that hold there"),
            (13, "a/b/c/x.py", body), (13, "a/b/c/x.py", body), (14, "", "")]
    got = scan(spark, [(i, p, t, "x", "y") for i, p, t in rows])
    assert len(got) == 14
    want = {1: ("Apache-2.0", "statement"), 2: ("MIT", "directory"), 3: ("MIT", "statement"), 4: ("GPL-3.0", "statement"), 5: (None, None),
            6: ("Apache-2.0", "directory"), 7: (None, None), 8: ("MIT", "directory"), 9: ("CC-BY-NC-4.0", "statement"), 10: (None, None),
            11: ("Apache-2.0", "directory"), 12: (None, None), 13: ("MIT", "directory"), 14: (None, None)}
    assert {i: (x.licence, x.origin) for i, x in got.items()} == want
    assert got[2].from_dir == "a/b" and got[6].from_dir == "a"


def test_cosine_equals_plain_python(spark):
    """The cosines of the windows found, by a plain loop over their words."""
    import math
    from collections import Counter

    listed = [(name, op8.plain_words(t)) for name, ts in sorted(op8.TEMPLATES.items()) for t in [*ts, f"SPDX-License-Identifier: {name}"]]
    df = Counter(w for _, ws in listed for w in set(ws))
    top = math.log(1 + len(listed)) + 1
    idf = lambda w: math.log((1 + len(listed)) / (1 + df[w])) + 1 if w in df else top

    def cos(a, b):
        x, y = ({w: c * idf(w) for w, c in Counter(t).items()} for t in (a, b))
        return sum(x[w] * y.get(w, 0) for w in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    texts = ["So: Licensed under the Apache License, Version 2.0. " + words(3, 30), words(4, 9) + " released under the MIT License and nothing more",
             "licensed under a creative commons license cc by 4.0", "# GNU General Public\n# License, version 3\n" + words(5, 5)]
    df_ = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = op8.statement_licences(spark, df_, F.col("text"), F.col("doc_id")).collect()
    for r in got:
        ws = op8.plain_words(texts[r.key])[max(r.start, 0) : r.start + r.n]
        want = max(cos(ws, b) for name, b in listed if name == r.licence and len(b) == r.n)
        assert r.cosine == pytest.approx(want, abs=2e-6) and r.cosine >= op8.LIMIT
    assert {(r.key, r.licence) for r in got} == {(0, "Apache-2.0"), (1, "MIT"), (2, "CC-BY-4.0"), (3, "GPL-3.0")}


def test_real_statements_are_found(spark):
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
    mpl = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
    body = words(7, 200)
    cases = [("The code is Released under the MIT License and the data can be found on the project page for all who ask", "MIT"),
             ("Licensed under the Apache License, Version 2.0 " + words(8, 80) + " Licensed under CC BY-NC 4.0", "Apache-2.0,CC-BY-NC-4.0"),
             ("// SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: Apache-2.0\n" + body, "Apache-2.0"), (gpl + "\n" + body, "GPL-3.0"),
             (body + "\n" + mpl, "MPL-2.0"), ("MIT License\n\nCopyright (c) 2020 A B", "MIT"),
             ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", "Apache-2.0,MIT"),
             ("wir fahren mit dem zug, und mit der stadt kam das copyright " + body, ""), ("see the license of the other file", "")]
    got = scan(spark, [(i, f"d{i}/f", t, "", "") for i, (t, _) in enumerate(cases)])
    assert {i: ",".join(got[i].licences) for i in got} == {i: want for i, (_, want) in enumerate(cases)}


def test_a_line_of_fifty_thousand_words_takes_linear_time(spark):
    import time

    line = ("license of the copyright holder mit " * 8_333) + "Released under the MIT License"
    t = time.time()
    got = scan(spark, [(1, "a/b", line, "", "")])
    assert got[1].licence == "MIT" and time.time() - t < 60



def test_every_window_of_every_text_counts(spark):
    """Statements against a plain loop over all places: words in another order, no cue in the text, long texts."""
    import math
    from collections import Counter

    listed = [(name, op8.plain_words(t)) for name, ts in sorted(op8.TEMPLATES.items()) for t in [*ts, f"SPDX-License-Identifier: {name}"]]
    df = Counter(w for _, ws in listed for w in set(ws))
    idf = lambda w: math.log((1 + len(listed)) / (1 + df[w])) + 1 if w in df else math.log(1 + len(listed)) + 1
    r = random.Random(8)
    texts = []
    for i in range(24):
        ws = op8.plain_words(r.choice([t for ts in op8.TEMPLATES.values() for t in ts]))
        if i % 2:
            r.shuffle(ws)
        ws = [w for w in ws if r.random() < 0.9] + [r.choice("the of as under by with this".split()) for _ in range(30)]
        texts.append(" ".join([f"a{j}x" for j in range(r.choice([40, 240, 300]))] + ws + [f"b{j}x" for j in range(40)]))
    texts.append(" ".join([f"a{j}x" for j in range(40)] + ["mozilla", "public", "version", "2.0"] + [f"b{j}x" for j in range(40)]))  # no cue
    want = set()
    for k, text in enumerate(texts):
        ws, found = text.split(), []
        for tid, (name, t) in enumerate(listed):
            unit = {w: c * idf(w) for w, c in Counter(t).items()}
            norm = math.sqrt(sum(v * v for v in unit.values()))
            for start in range(len(ws) - len(t) + 1):
                x = {w: c * idf(w) for w, c in Counter(ws[start : start + len(t)]).items()}
                same = [w for w in x if w in unit]
                cos = round(sum(x[w] * unit[w] for w in same) / norm / math.sqrt(sum(v * v for v in x.values())), 6)
                if cos >= op8.LIMIT and len(same) >= min(2, len(unit)):
                    anchor = min((-unit[w], ws.index(w, start)) for w in same)[1]
                    found.append((-cos, -len(t), name, start, tid, anchor))
        for f in found:
            if min(g for g in found if g[3] <= f[5] < g[3] - g[1]) == f:
                want.add((k, f[3], -f[1], f[2]))
    got = op8.statement_licences(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.col("text"), F.col("doc_id")).collect()
    assert {(x.key, x.start, x.n, x.licence) for x in got} == want and len(got) == len(want)
    assert any(x.key == 24 and x.licence == "MPL-2.0" for x in got)


def test_licence_query_has_every_row_and_no_files_give_no_rows(spark):
    sf = "/root/testdata/sf0.001"
    assert op8.op8_licenses(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert scan(spark, []) == {}


def brute_views(rows):
    convs = {}
    for c, t, s, x in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, s or "unknown", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0], r[1].encode(), r[2].encode()))
        for me in {s for _, s, _ in turns if s != "system"}:
            text, spans = "", []
            for _, s, x in turns:
                text += op10.HEAD_SYSTEM if s == "system" else op10.HEAD_ASSISTANT if s == me else f"<|user name={s}|>\n"
                if s == me:
                    spans.append((len(text), len(text) + len(x)))
                text += x + op10.END
            out[c, me] = (text, spans)
    return out


def test_views_equal_brute_force_in_one_and_many_parts(spark):
    r = random.Random(3)
    rows = [(c, t, r.choice(["ann", "bob", "céd", "system"]), words(c * 100 + t, r.randint(0, 12))) for c in range(6) for t in range(r.randint(1, 25))]
    rows += [(99, 0, "system", "alone"), (None, 0, "ann", "x"), (None, None, None, None), (50, 1, "ann", "same"), (50, 1, "ann", "same"), (50, 1, "bob", "é😀")]
    df = spark.createDataFrame([(*x, 1, "p") for x in rows], "conv_id long, turn long, role string, text string, start int, perspective string")
    want = brute_views(rows)
    for part in (10**6, 200):
        got = {}
        for x in op10.rotate(df, part_chars=part).orderBy("part").collect():
            text, spans = got.get((x.conv_id, x.perspective), ("", []))
            spans = spans + [(s.start + len(text), s.end + len(text)) for s in x.targets]
            got[x.conv_id, x.perspective] = (text + x.text, spans)
            assert len(x.text) <= part + 250
        assert got == want
    assert op10.rotate(df.where("false")).collect() == []
