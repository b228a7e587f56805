"""Cosines and inheritance against plain Python."""

import math
import re
from collections import Counter

import pytest

from rillmart.llm import licence_texts, licences

from .conftest import prose


def tokens(text):
    return [x for x in re.split(r"[\W_]+", text.lower()) if x]


def brute(files, least, share):
    """Of (path, text): licence, score, basis and licence file."""
    texts = licence_texts.templates()
    vocabulary = {t for _, s in texts for t in tokens(s)}
    df = Counter(t for _, x in files for t in vocabulary.intersection(tokens(x or "")))
    idf = {t: math.log((1 + len(files)) / (1 + df[t])) + 1 for t in vocabulary}
    vector = lambda w: {t: n * idf[t] for t, n in Counter(w).items() if t in idf}
    own, covering = [], {}
    for path, text in files:
        best, matched, words = None, 0, 0
        for unit in re.split(r"\n|(?<=[.!?;:])\s+", text or ""):
            w = tokens(unit)
            words += len(w)
            v = vector(w)
            norm = math.sqrt(sum(x * x for x in v.values()) + sum(t not in idf for t in w))
            top = (0.0, "")
            for licence, s in texts:
                u = vector(tokens(s))
                score = round(sum(x * v.get(t, 0) for t, x in u.items()) / math.sqrt(sum(x * x for x in u.values())) / norm, 9) if w else 0
                top = (score, licence) if score > top[0] else top
            if top[0] >= least:
                matched += len(w)
                best = top if best is None or top[0] > best[0] else best
        own.append(best)
        folder = re.sub(r"/?[^/]*$", "", path or "")
        if best and matched >= share * words:
            covering[folder] = min(covering.get(folder, ((path or ""), *best)), ((path or ""), *best))
    out = []
    for (path, _), best in zip(files, own, strict=True):
        at, found = re.sub(r"/?[^/]*$", "", path or ""), None
        while not best:
            found = covering.get(at)
            if found or not at:
                break
            at = re.sub(r"/?[^/]*$", "", at)
        out.append((path, best[1], best[0], "own", None) if best else (path, found[2], found[1], "inherited", found[0]) if found else (path, None, None, "none", None))
    return out


def result(files):
    return [(r.path, r.licence_.licence, r.licence_.score, r.licence_.basis, r.licence_.licence_file) for r in files.collect()]


def same(got, want):
    key = lambda r: (str(r[0]), r[3], str(r[1]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [(r[0], r[1], r[3], r[4]) for r in got] == [(r[0], r[1], r[3], r[4]) for r in want]
    assert [r[2] for r in got if r[2] is not None] == pytest.approx([r[2] for r in want if r[2] is not None], abs=1e-6)


def files_of(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "path string, text string").withColumns({c: F.lit("own") for c in ("licence", "score", "above", "covering", "directory", "term", "best")})


def test_documents(spark, documents):
    rows = licences.document_paths(documents).select("path", "text").collect()
    want = brute([tuple(r) for r in rows], licences.LEAST_COSINE, licences.FILE_SHARE)
    got = [(r.path, r.licence, r.score, r.basis, r.licence_file) for r in licences.licence_report(documents).collect()]
    same(got, want)
    assert any(r[3] == "own" for r in got)


def test_tree(spark):
    mit, apache = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "Licensed under the Apache License, Version 2.0."
    rows = [("LICENSE", mit), ("a/b/COPYING", "Licensed under the Mozilla Public License, version 2.0"), ("a/b/LICENSE", apache), ("a/b/c/d.py", prose(1, 30)), ("a/x.py", "plain"),
            ("a/b/own.py", "# Released under the CC BY-NC 4.0.\n" + prose(2, 50)), ("z/y.py", None), ("z/e.py", ""), (None, "nothing"), ("z/y.py", None),
            ("q/long.py", "w " * 30_000 + "\n" + apache), ("q/other.py", "The license of the work is a licence to use it."), ("q/spdx.c", "// SPDX-License-Identifier: GPLv3")]
    files = files_of(spark, rows)
    scanned = licences.scan(files)
    assert scanned.columns == [c for c in files.columns if c != "text"] + ["licence_"]
    got = result(scanned)
    same(got, brute(rows, licences.LEAST_COSINE, licences.FILE_SHARE))
    by = {r[0]: r for r in got}
    assert by["a/b/c/d.py"][1:] == ("MPL-2.0", by["a/b/COPYING"][2], "inherited", "a/b/COPYING") and by["a/x.py"][1] == "MIT" and by["z/e.py"][4] == "LICENSE"
    assert by["q/long.py"][1] == "Apache-2.0" and by["q/spdx.c"][1] == "GPL-3.0" and by["a/b/own.py"][1] == "CC-BY-NC-4.0" and by["q/other.py"][3] == "inherited"
    assert result(licences.scan(files.filter("false"))) == []


def test_wrapped_headers(spark):
    """Headers as they stand in files, with comment marks and over several lines."""
    gpl = ["you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation{} either version {} of the License, or",
           "(at your option) any later version."]
    header = lambda mark, sep, version, name="General": "\n".join(
        f"{mark} {x}" for x in ["Copyright (C) 2020 A. Body", "", f"This program is free software{':' if version == 3 else ';'} {gpl[0]}", gpl[1].replace("General", name),
                               gpl[2].format(sep, version), gpl[3]])
    apache = ("// Licensed under the Apache License, Version 2.0 (the\n// \"License\"); you may not use this file except in\n// compliance with the License.\n\nint main;")
    rows = [("a/2.c", f"/*\n{header(' *', ';', 2)}\n */\nint x;\n"), ("a/3.py", f"{header('#', ',', 3)}\n\n{prose(8, 400)}"), ("a/l.lua", header("--", ",", 3, "Lesser General")),
            ("a/a.txt", header("", ",", 3, "Affero General").replace("\n", "\r\n")), ("b/x.c", apache),
            ("b/one.c", header("", ";", 2).replace("\n", " ").strip())]
    got = {r[0]: r for r in result(licences.scan(files_of(spark, rows)))}
    assert {p: r[1] for p, r in got.items()} == {"a/2.c": "GPL-2.0", "a/3.py": "GPL-3.0", "a/l.lua": "LGPL-3.0", "a/a.txt": "AGPL-3.0", "b/x.c": "Apache-2.0", "b/one.c": "GPL-2.0"}
    assert all(r[3] == "own" for r in got.values())


def test_whole_licence_files_cover(spark):
    fulls = licence_texts.full_texts()
    names = [n for n, _ in fulls]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC"} <= set(names)
    rows = [(f"{n}/LICENSE", f"Copyright (c) 2021 Some Body and others\n\n{t}") for n, t in fulls] + [(f"{n}/src/x.py", "plain") for n in names]
    # Prose that speaks of licences, or holds a part of one, is none.
    rows += [("part/notes", fulls[names.index("GPL-3.0")][1][5000:9000]), ("part/x", "plain"), ("part/long", prose(9, 5000))]
    got = {r[0]: r for r in result(licences.scan(files_of(spark, rows)))}
    assert {n: got[f"{n}/LICENSE"][1] for n in names} == {n: n for n in names} and all(got[f"{n}/LICENSE"][3] == "own" for n in names)
    assert {n: got[f"{n}/src/x.py"][1:2] + got[f"{n}/src/x.py"][3:] for n in names} == {n: (n, "inherited", f"{n}/LICENSE") for n in names}
    assert got["part/x"][3] == "none"


def test_telling_terms_lose_nothing(spark, documents):
    """With every term telling, each sentence is compared: the result must be the same."""
    texts = licence_texts.templates()
    df, n = licences.document_frequencies(documents, texts)
    model = licences.weigh(df, n, 0.7, texts)
    every = {**model, "telling": model["terms"]}
    a, b = (documents.select("doc_id", licences.best_matches(documents["text"], m, 0.7).alias("m")).collect() for m in (model, every))
    assert a == b


def test_native(documents):
    plan = licences.licence_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
