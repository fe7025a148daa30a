"""Licence scan: sparse TF-IDF cosine of licence statements to templates, and inheritance along directories.

1. *Words.* Every text becomes words across line ends; signs, comment marks and hyphens only part words, so wrapped
   headers and SPDX tags are runs of words.
2. *Windows.* For each template, the windows of its length at every place of every text count, those over a text's edge
   too. Windows that cannot reach ``limit`` are left out by bounds that hold for any text: a cosine is at most the length
   of the template's vector on the words it shares (Cauchy-Schwarz), so a window needs one of the template's uncommon
   words or a run of its common ones, and enough of its words around; then the dot product over a norm in which each
   occurrence counts alone, slid over the places.
3. *Cosine.* Term weights are tf · idf, the idf taken from the templates (a term in no template has the largest).
   Window terms join the templates' terms; dot product and norm are summed per window. Of the windows with a cosine of
   at least ``limit``, one stays where no better one covers its anchor, the first place of the template's heaviest word in
   it (ties: the longer, then the smaller name): a file's statements. One word alone (the German ``mit``) is no statement
   of a template of several. The template tables are fixed lists and the only broadcast sides.
4. *Inheritance.* A licence file (by name, or a file that is little more than its statement) declares its licence for
   its directory. Distinct directories are expanded to their ancestors and joined with the declarations on the
   path; the deepest one wins. Files without a statement of their own take their directory's licence by one more
   path join. Directories are few against files, and a directory's files are never collected.

Texts are cut into pieces of ``PIECE`` words that overlap by a template's length, and every later step is a join or an
aggregation over rows, so the work grows with the words of the files, whatever their lines' lengths. Only DataFrame operations are used.

Edge cases: null text has no statement; a null path has no directory and inherits nothing; repeated rows are
classified alike; equally good templates give the smaller name, several licence files in a directory the smallest
path's; no files give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.session import materialize

#: Statements of common licences, as projects write them in headers and licence files.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Apache License Version 2.0, January 2004",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "BSD 3-Clause License",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0",
        "Creative Commons Attribution 4.0 International",
        "Licensed under CC BY 4.0",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-SA-4.0": ["Licensed under Creative Commons Attribution ShareAlike CC BY-SA 4.0", "Licensed under CC BY-SA 4.0",
                     "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal", "CC0 1.0 Universal"],
    "GPL-2.0": [
        "This program is free software licensed under the GNU General Public License, version 2",
        "GNU General Public License, version 2",
        "GNU General Public License Version 2, June 1991",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "GNU General Public License, version 3",
        "GNU General Public License Version 3, 29 June 2007",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License Version 3, 29 June 2007"],
    "MIT": [
        "Released under the MIT License",
        "The MIT License",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",
        "Mozilla Public License Version 2.0",
    ],
    "Proprietary": ["Copyright, all rights reserved, proprietary and confidential"],
    "Unlicense": ["This is free and unencumbered software released into the public domain, The Unlicense",
                  "This is free and unencumbered software released into the public domain"],
}
#: Words that texts are full of: windows are not looked for around each of them, only around runs.
COMMON = "the of and to a in is that as was by this are or for with be on not from it at you if may any use all".split()
#: Words of a piece of a text.
PIECE = 256
LICENCE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)(\.[a-z]+)?$"
LIMIT = 0.6
#: A file is little more than its statement if it has at most so many words beside it.
BESIDE = 20


def words_of(c: Column) -> Column:
    """Lower-case words; a dot counts inside a word only (``2.0``)."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]++(?:\.[a-z0-9]++)*+"), 0)


def plain_words(text: str) -> list[str]:
    """The same in Python, for the templates."""
    return [w for w in re.split(r"(?:[^a-z0-9.]|\.(?![a-z0-9])|(?<![a-z0-9])\.)+", text.lower()) if w]


def template_tables(spark: SparkSession, templates: dict[str, list[str]] | None = None,
                    limit: float = LIMIT) -> tuple[DataFrame, DataFrame, dict[str, float], float, list[tuple[str, list[str], int, int]]]:
    """((term, tid, licence, at, len, weights), (tid, term, weight), idfs, idf of other terms, runs): leading words with
    their places in the template and its unit-length weights. Every licence also has its SPDX tag as a template.

    A window with a cosine of ``limit`` has one of its template's leading words, those not in ``COMMON``, or it has a run:
    (name, common words, how many of them, within how many words); a run's name stands in the table like a leading word.
    With W the squared length of the weights on the common words, c their largest idf · weight, v the least idf of
    other words, and m of a window's n words common: cosine^-2 >= 1/W + (n - m) v^2 / (m c)^2."""
    listed = [(name, plain_words(t)) for name, texts in sorted((templates or TEMPLATES).items())
              for t in [*texts, f"SPDX-License-Identifier: {name}"]]
    df = Counter(w for _, ws in listed for w in set(ws))
    n = len(listed)
    idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}
    top = math.log(1 + n) + 1
    leading, weights, runs = [], [], []
    for tid, (name, ws) in enumerate(listed):
        norm = math.sqrt(sum((c * idf[w]) ** 2 for w, c in Counter(ws).items()))
        unit = {w: c * idf[w] / norm for w, c in Counter(ws).items()}
        leading += [(w, tid, name, [i for i, x in enumerate(ws) if x == w], len(ws), unit) for w in unit if w not in COMMON]
        common = sorted(w for w in unit if w in COMMON)
        length = sum(unit[w] ** 2 for w in common)
        if length >= limit ** 2:
            most, least = max(idf[w] * unit[w] for w in common), min([top, *(v for w, v in idf.items() if w not in unit)])
            m = next(m for m in range(1, len(ws) + 1) if 1 / length + (len(ws) - m) * (least / (m * most)) ** 2 <= limit ** -2 + 1e-9)
            runs.append((f"#{tid}", common, m, len(ws)))
            leading.append((f"#{tid}", tid, name, [], len(ws), unit))
        weights += [(tid, w, x) for w, x in unit.items()]
    return (spark.createDataFrame(leading, "term string, tid int, licence string, at array<int>, len int, weights map<string,double>"),
            spark.createDataFrame(weights, "tid int, term string, weight double"), idf, top, runs)


def likely_windows(files: DataFrame, text: Column, key: Column, leading: DataFrame, idf: dict[str, float], top: float,
                   runs: list[tuple[str, list[str], int, int]], least: float) -> DataFrame:
    """key, tid, licence, len, need, start, words of every window whose cosine may reach ``least``; ``need``: how many
    different words it has to share with its template.

    A window over a text's edge is one where an uncommon word stands at its own place in the template, or the whole text
    if it has an uncommon word."""
    terms, longest = leading.agg(F.collect_set("term"), F.max("len")).first()  # words of the templates, a fixed list
    idfs = F.create_map(*[F.lit(x) for pair in sorted(idf.items()) for x in pair])
    whole = files.select(key.alias("key"), words_of(text).alias("ws"))
    last = F.floor(F.greatest(F.size("ws") - 1, F.lit(0)) / F.lit(PIECE)).cast("int")

    def piece(k: Column) -> Column:
        first = F.greatest(k * PIECE - (longest - 1), F.lit(0))
        return F.struct((k * PIECE).alias("own"), first.alias("first"), F.slice("ws", first + 1, (k + 1) * PIECE + (longest - 1) - first).alias("ws"))

    pieces = whole.select("key", F.size("ws").alias("n"), F.explode(F.transform(F.sequence(F.lit(0), last), piece)).alias("p")).select("key", "n", "p.*")
    def those(named: Column | str, words: list[str]) -> Column:
        return F.filter(named, lambda h: h["term"].isin(words))

    known = F.transform("ws", lambda t, i: F.when(t.isin(sorted(idf)), F.struct(i.alias("i"), t.alias("term"))))
    p = pieces.withColumn("known", F.filter(known, lambda h: h.isNotNull()))
    p = p.withColumns({"hits": those("known", terms), "common": those("known", sorted({w for _, ws, _, _ in runs for w in ws}))})
    p = p.withColumns({name: those("common", ws) for name, ws, _, _ in runs})

    def begins(name: str, m: int, n: int) -> Column:
        """The places from which ``m`` of a run's words lie within ``n`` words."""
        found = F.transform(f"`{name}`", lambda h, k: F.when(F.get(f"`{name}`", k + m - 1)["i"] < h["i"] + n, F.struct(h["i"].alias("i"), F.lit(name).alias("term"))))
        return F.filter(found, lambda h: h.isNotNull())

    hits = F.concat("hits", *[begins(name, m, n) for name, _, m, n in runs])
    w = p.select("key", "n", "own", "first", "ws", F.explode(hits).alias("h"))  # only these take their piece's words along
    w = w.select("*", (F.col("first") + F.col("h.i")).alias("pos"), F.col("h.term").alias("term"))
    w = w.where((F.col("pos") >= F.col("own")) & (F.col("pos") < F.col("own") + PIECE)).join(F.broadcast(leading), "term")
    # the words of all windows around the leading word, from ``low`` on
    low = F.greatest(F.col("pos") - F.col("len") + 1, F.lit(0))
    around = F.slice("ws", low - F.col("first") + 1, F.col("pos") + F.col("len") - low).alias("ws")
    w = w.select("key", "n", "tid", "licence", "at", "len", "weights", "pos", low.alias("low"), around)
    shared = F.array_intersect("ws", F.map_keys("weights"))
    w = w.where(F.aggregate(shared, F.lit(0.0), lambda s, t: s + F.element_at("weights", t) * F.element_at("weights", t)) >= least ** 2)
    w = w.withColumn("vs", F.transform("ws", lambda t: F.when(t.isin(sorted(idf)), F.element_at(idfs, t)).otherwise(F.lit(top))))
    w = w.withColumn("cs", F.transform("ws", lambda t, i: F.coalesce(F.element_at("weights", t), F.lit(0.0)) * F.get("vs", i)))
    length = F.col("len")

    def slide(s: Column, j: Column) -> Column:
        """The window that ends at word ``j``: sums of its weighted and of its squared idfs, and the windows so far."""
        def moved(c: str, by: Callable[[Column], Column]) -> Column:
            return by(F.coalesce(F.get(c, j), F.lit(0.0))) - F.when(j >= length, by(F.coalesce(F.get(c, j - length), F.lit(0.0)))).otherwise(0.0)

        dot, sq = s["dot"] + moved("cs", lambda x: x), s["sq"] + moved("vs", lambda x: x * x)
        start = F.col("low") + j - length + 1
        inside = (start == 0) | ((start > 0) & (start + length <= F.col("n")))
        may = (F.col("low") + j >= F.col("pos")) & (dot >= least * F.sqrt(sq)) & (inside | F.array_contains("at", F.col("pos") - start))
        return F.struct(dot.alias("dot"), sq.alias("sq"), F.when(may, F.concat(s["found"], F.array(start))).otherwise(s["found"]).alias("found"))

    none = F.struct(F.lit(0.0).alias("dot"), F.lit(1e-9).alias("sq"), F.array().cast("array<int>").alias("found"))  # sums may lose the last digits
    starts = F.aggregate(F.sequence(F.lit(0), F.col("pos") + length - 1 - F.col("low")), none, slide, lambda s: s["found"])
    w = w.select("key", "tid", "licence", "len", F.least(F.size("weights"), F.lit(2)).alias("need"), "low", "ws", F.explode(starts).alias("start"))
    begin = F.greatest("start", F.lit(0))
    w = w.select("key", "tid", "licence", "len", "need", "start", F.slice("ws", begin - F.col("low") + 1, F.col("start") + length - begin).alias("words"))
    return w.dropDuplicates(["key", "tid", "start"])  # a window has several leading words


def statement_licences(spark: SparkSession, files: DataFrame, text: Column, key: Column, limit: float = LIMIT,
                       templates: dict[str, list[str]] | None = None) -> DataFrame:
    """key, start (word), n (words), licence, cosine of the statements that match a template; ``limit`` is over 0."""
    least = limit - 2e-6  # cosines are rounded to six places
    leading, weights, idf, top, runs = template_tables(spark, templates, least)
    idfs = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    w = likely_windows(files, text, key, leading, idf, top, runs, least)
    window = ["key", "tid", "licence", "start", "len", "need"]
    w = w.select(*window, F.posexplode("words").alias("i", "term"))
    tf = w.groupBy(*window, "term").agg(F.count(F.lit(1)).alias("tf"), F.min(F.greatest("start", F.lit(0)) + F.col("i")).alias("at"))
    x = tf.join(F.broadcast(idfs), "term", "left").join(F.broadcast(weights), ["tid", "term"], "left")
    own = F.col("tf") * F.coalesce("idf", F.lit(top))
    weight = F.coalesce("weight", F.lit(0.0))
    x = x.groupBy(*window).agg(F.sqrt(F.sum(own * own)).alias("norm"), F.sum(own * weight).alias("dot"), F.count("weight").alias("same"),
                               F.min(F.struct((-weight).alias("w"), "at")).alias("heaviest"))
    found = x.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where((F.col("cosine") >= limit) & (F.col("same") >= F.col("need")))
    found = materialize(found.withColumn("anchor", F.col("heaviest.at")), "statements")
    better = F.struct((-F.col("cosine")).alias("c"), (-F.col("len")).alias("l"), "licence", "start", "tid")
    cover = found.select("key", better.alias("b"), F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("anchor"))
    cover = cover.groupBy("key", "anchor").agg(F.min("b").alias("b"))
    best = found.join(cover, ["key", "anchor"]).where((F.col("b.tid") == F.col("tid")) & (F.col("b.start") == F.col("start")))
    return best.select("key", "start", F.col("len").alias("n"), "licence", "cosine")


def directory_licences(spark: SparkSession, dirs: DataFrame, declared: DataFrame) -> DataFrame:
    """dirs (dir), declared (dir, licence) → dir, inherited, from_dir: the nearest ancestor's (or its own) licence."""
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("up")))).alias("a")).select("dir", "a.depth", "a.up")
    d = declared.select(F.col("dir").alias("up"), F.col("licence"))
    near = up.join(d, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "licence")).alias("m"))
    return near.select("dir", F.col("m.licence").alias("inherited"), F.col("m.up").alias("from_dir"))


def scan_licences(spark: SparkSession, files: DataFrame, id_col: str, path: Column, text_col: str = "text",
                  limit: float = LIMIT, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Per file row: id, path, licences (of its statements, sorted), licence (its best, else inherited),
    cosine (of its best), origin ('statement', 'directory' or null), from_dir."""
    f = files.select(files[id_col].alias("doc_id"), path.cast("string").alias("path"), files[text_col].cast("string").alias("text"))
    f = f.withColumn("th", F.xxhash64("text"))
    key = F.struct("doc_id", "path", "th")  # rows of one id with different texts are files of their own
    found = statement_licences(spark, f, F.col("text"), key, limit, templates)
    own = found.groupBy("key").agg(F.array_sort(F.collect_set("licence")).alias("licences"),  # a set of template names
                                   F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"), F.max("n").alias("n"))
    own = own.select(F.col("key.doc_id").alias("_id"), F.col("key.path").alias("_path"), F.col("key.th").alias("_th"), "licences",
                     F.col("b.licence").alias("own"), (-F.col("b.c")).alias("cosine"), F.col("n").alias("st_words"))
    has_dir = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    g = f.select("doc_id", "path", "th", has_dir.alias("dir"), (F.length("text") - F.length(F.translate("text", " \t\n", ""))).alias("gaps"))
    same = g["doc_id"].eqNullSafe(own["_id"]) & g["path"].eqNullSafe(own["_path"]) & g["th"].eqNullSafe(own["_th"])
    g = g.join(own, same, "left").drop("_id", "_path", "_th")
    whole = F.col("path").rlike(LICENCE_NAME) | (F.col("gaps") <= F.col("st_words") + BESIDE)
    declared = g.where(F.col("own").isNotNull() & F.col("dir").isNotNull() & whole).groupBy("dir").agg(
        F.min(F.struct("path", "own")).alias("m")).select("dir", F.col("m.own").alias("licence"))
    near = directory_licences(spark, g.select("dir").where("dir is not null").distinct(), declared)
    out = g.join(near, "dir", "left")
    origin = F.when(F.col("own").isNotNull(), "statement").when(F.col("inherited").isNotNull(), "directory")
    return out.select("doc_id", "path", F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
                      F.coalesce("own", "inherited").alias("licence"), "cosine", origin.alias("origin"),
                      F.when(F.col("own").isNull(), F.col("from_dir")).alias("from_dir"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files ``source/lang/doc_id``: the table has no paths of its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    r = scan_licences(spark, docs, "doc_id", path)
    return r.select("doc_id", "path", F.array_join("licences", ",").alias("licences"), "licence", "cosine", "origin", "from_dir")
