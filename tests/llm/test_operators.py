"""Training-data operators against brute force, oracles and planted cases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgegraph.llm import (decontam, kneser_ney, langid, license_scan, line_dedup, mixing, neardup, quality, url_filter,
                           warc)
from edgegraph.llm import textwords as tw
from edgegraph.llm.oracles import oracle_sql
from edgegraph.llm.queries import queries
from edgegraph.plans.check import duck, normalize
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i % 1013}" for i in range(40_000))


def messy(spark, extra: bool = False):
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", None, 4), (None, "some words here", "en", "a", 15),
            (None, None, None, None, None), (3, LONG, "en", "b", len(LONG)), (4, LONG, "en", "b", len(LONG)),
            (5, "Élan ÉÉ ß 漢字 mit license", "de", "c", 1), (5, "Élan ÉÉ ß 漢字 mit license", "de", "c", 1),
            (6, "Élan ÉÉ ß 漢字 mit license", "de", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("key", "size", "h", "kept", "n_words", "_row", "new_text", "n_removed", "d", "t", "seq", "rep", "block", "score"):
            df = df.withColumn(c, F.lit(f"extra {c}"))
    return df


def docs(spark, *texts, **cols):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_queries_match_oracles(spark):
    con, qs = duck(SF_SMALL), queries()
    for name, sql in oracle_sql().items():
        a, b = qs[name](spark, SF_SMALL).toPandas(), con.execute(sql).df()
        assert sorted(a.columns) == sorted(b.columns), name
        assert normalize(a) == normalize(b), name


# ---- words ----------------------------------------------------------------------------------------------

def test_words_and_windows_match_python():
    import pyarrow as pa
    texts = ["One two  ONE\n", None, "", " x", "ab cd", LONG]
    for limit in (1, 8, 1 << 21):
        got = []
        for _, _, data, offs in tw.pieces(pa.array(texts), limit):
            s, e, t = tw.words(data, offs)
            for i in range(len(offs) - 1):
                got.append([bytes(data[a:b]).decode() for a, b in zip(s[t == i], e[t == i])])
        assert got == [WORD.findall(t or "") for t in texts]
    data = np.frombuffer(b"one ONE two", np.uint8)
    h = tw.hashes(data, *tw.words(data, np.array([0, len(data)]))[:2])
    assert h[0] == h[1] != h[2]


# ---- 1 language ID --------------------------------------------------------------------------------------

def test_language_held_out_accuracy_and_mixed_spans(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = queries()["op1_language_id"](spark, "/root/testdata/sf0.01").join(d.select("doc_id", "lang"), "doc_id")
    held = r.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[1] > 200 and held[0] > 0.97
    model = langid.train(d)
    pick = {lang: d.where((F.col("lang") == lang) & (F.length("text") > 600)).orderBy("doc_id").first()["text"][:500] for lang in ("de", "fr")}
    out = langid.identify(docs(spark, pick["de"] + "\n" + pick["fr"]), model, ["doc_id"]).first()
    assert [s["lang"] for s in out["spans"]] == ["de", "fr"] and 0.4 < out["score"] < 0.7


def test_language_shortcut_equals_viterbi():
    import pyarrow as pa
    m = langid.Model([("a", c, n) for c, n in enumerate(np.random.default_rng(1).integers(0, 50, langid.CELLS + len(langid.NAMES)).tolist())]
                     + [("b", c, n) for c, n in enumerate(np.random.default_rng(2).integers(0, 50, langid.CELLS + len(langid.NAMES)).tolist())])
    rng = random.Random(3)
    texts = pa.array(["".join(rng.choice("abcdef   ") for _ in range(rng.randrange(0, 300))) for _ in range(60)])
    text, _, path = langid.label(m, texts, 0, 60, 3.0)
    code, script, _, new, owner = langid._letters(texts, 0, 60)
    score = np.add.reduceat(m.score[langid._cells(code, new)], np.flatnonzero(new), axis=0)
    def value(s, p):
        return s[np.arange(len(p)), p].sum() - 3.0 * (p[1:] != p[:-1]).sum()
    for t in set(text.tolist()):
        s = score[owner == t]
        assert value(s, path[text == t]) == pytest.approx(value(s, langid._viterbi(s, 3.0)))


def plain_words(text):
    """Runs of letters, and marks inside a script's range, of one script, lower-cased; each with its script."""
    import unicodedata
    out, held, now = [], "", None
    for ch in (text or "").lower() + "\0":
        kind, at = unicodedata.category(ch)[0], ord(ch)
        script = next((s for a, s in reversed(langid.SCRIPTS) if a <= at), "")
        script = (script or "other") if kind == "L" else script if kind == "M" else ""
        if script != now or not script:
            if held and any(unicodedata.category(c)[0] == "L" for c in held):
                out.append((held, now))
            held, now = "", script
        if script:
            held += ch
    return out


def plain_cell(a, b, c):
    x = (ord(a) << 42 | ord(b) << 21 | ord(c)) & (2 ** 64 - 1)
    for k, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> k)) * m) & (2 ** 64 - 1)
    return (x ^ (x >> 31)) % langid.CELLS


def grams(word):
    w = f" {word} "
    return [plain_cell(*w[i:i + 3]) for i in range(len(word))]


def plain_identify(train, text, penalty=langid.SWITCH):
    """Counts, word scores, candidates and the best path of all, from the definitions."""
    counts, letters = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, t in train:
        for w, script in plain_words(t):
            counts[lang].update(grams(w))
            letters[lang][script] += len(w)
    langs, words = sorted(counts), plain_words(text)
    if not words or not langs:
        return "und", 0.0, []
    best = {lang: (0.0, []) for lang in langs}
    for i, (w, script) in enumerate(words):
        raw = {lang: sum(np.log((counts[lang][g] + 0.5) / (sum(counts[lang].values()) + 0.5 * langid.CELLS)) for g in grams(w)) for lang in langs}
        fits = [lang for lang in langs if letters[lang][script] >= langid.SCRIPT_SHARE * max(1, sum(letters[lang].values()))]
        score = {lang: raw[lang] if lang in fits else min(raw[x] for x in fits) - penalty if fits else 0.0 for lang in langs}
        step = {}
        for lang in langs:
            before = max(langs, key=lambda x: (best[x][0] - penalty * (x != lang and i > 0), x == lang))
            step[lang] = (best[before][0] - penalty * (before != lang and i > 0) + score[lang], [*best[before][1], lang])
        best = step
    path = best[max(langs, key=lambda x: best[x][0])][1]
    size = collections.Counter()
    for (w, _), lang in zip(words, path):
        size[lang] += len(w)
    top = max(langs, key=lambda x: (size[x], -langs.index(x)))
    return top, size[top] / sum(size.values()), path


def test_language_matches_brute_force(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(60).collect()
    train = [(r["lang"], (r["text"] or "")[:400]) for r in d] + [("ru", "это слово и ещё одно слово"), ("hi", "यह एक वाक्य है और यह भी")]
    model = langid.train(spark.createDataFrame([(a, t) for a, t in train], "lang string, text string"))
    pick = [t for _, t in train if len(t) > 300][:8]
    texts = [pick[i][:150] + " слово это " + pick[-1 - i][:150] + " यह और" for i in range(4)] + [t for _, t in train[-2:]] + pick
    texts += ["٠١٢٣ ٤٥٦", "।॥", "123 !?", "ⵜⴰⵎⴰⵣⵉⵖⵜ", "ｆｕｌｌｗｉｄｔｈ", "\u0301\u0302", None, "x"]
    got = langid.identify(docs(spark, *texts), model, ["doc_id"]).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        lang, score, path = plain_identify(train, t)
        spans = [s["lang"] for s in r["spans"] for _ in range(s["last"] - s["first"] + 1)]
        assert (r["lang_pred"], spans) == (lang, path) and r["score"] == pytest.approx(score), t
    by = {t: r["lang_pred"] for r, t in zip(got, texts)}
    assert by["٠١٢٣ ٤٥٦"] == by["।॥"] == by["123 !?"] == by["\u0301\u0302"] == "und"
    assert by["ⵜⴰⵎⴰⵣⵉⵖⵜ"] != "und" and by["ｆｕｌｌｗｉｄｔｈ"] != "und"


def test_language_defined_results(spark):
    model = langid.train(docs(spark, "the cat and the dog"))
    out = langid.identify(messy(spark, True), model, ["doc_id", "score", "kept"])
    assert out.columns == ["doc_id", "kept", "lang_pred", "score", "spans"] and dict(out.dtypes)["score"] == "double"
    got = [(r["doc_id"], r["lang_pred"]) for r in out.collect()]
    assert got.count((0, "und")) == 1 and (1, "und") in got and (2, "und") in got and (3, "en") in got and len(got) == 10
    nothing = langid.train(docs(spark))
    assert {r["lang_pred"] for r in langid.identify(messy(spark), nothing, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs(spark), model, ["doc_id"]).count() == 0


# ---- 2 licences -----------------------------------------------------------------------------------------

def brute_licenses(text, table):
    norm = re.sub(license_scan.SEPARATORS, " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).strip(" ")
    norm = f" {norm} " if norm else " "
    found = []
    if any(g in norm for g in license_scan.GATES):
        for r in table:
            if r["kw"] in norm:
                for m in re.finditer(r["regex"], norm):
                    a = norm[:m.start()].count(" ")
                    found.append((a, a + m[0].count(" ") - 1, r))

    def beats(e, x):
        if e[0] <= x[0] and e[1] >= x[1]:
            if e[1] - e[0] > x[1] - x[0]:
                return True
            return (e[2]["priority"], -e[2]["id"]) > (x[2]["priority"], -x[2]["id"])
        return e[0] <= x[1] and e[1] >= x[0] and not (e[0] >= x[0] and e[1] <= x[1]) and e[2]["priority"] > x[2]["priority"]
    kept = [x for x in found if not any(beats(e, x) for e in found)]
    base = [x for x in found if x[2]["base"]]
    return (len(norm.split()), len(base), min((b[0] for b in base), default=None), max((b[0] for b in base), default=None),
            ",".join(sorted({b[2]["label"] for b in base})), ",".join(sorted({x[2]["label"] for x in kept + base})),
            max((x[2]["priority"] for x in kept), default=0) / 105.0)


def test_licenses_match_brute_force(spark):
    table = license_scan.rules()
    assert len(table) >= 200
    texts = ["Licensed under the Apache License, Version 2.0. And the MIT License; cc by, CC BY-NC 4.0!", "cc by cc by cc by",
             "SPDX-License-Identifier: GPL-3.0-or-later", "mit der license", None, "", "All rights reserved. Apache software license 1.1",
             "GNU General Public License version 2 or later / gnu lesser general public license v2.1", "BSD 3-Clause license bsd 2 clause",
             "the gnu general public license gnu gpl v3", "Creative Commons Attribution-ShareAlike 4.0 public domain " * 40]
    d = docs(spark, *texts).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source", "n_chars"))
    got = license_scan.summarise(license_scan.scan(d, ["doc_id", "text"]), ["doc_id", "text"]).collect()
    assert len(got) == d.count()
    for r in got:
        assert tuple(r)[2:] == pytest.approx(brute_licenses(r["text"], table)), r["text"]
    by = {r["doc_id"]: r for r in got}
    assert by[0]["base_labels"] == "apache,cc-by,mit" and "apache-2.0" in by[0]["labels"] and by[1]["n_base"] == 3
    assert license_scan.scan(messy(spark, True), ["doc_id"]).count() == 10 and license_scan.scan(docs(spark), ["doc_id"]).count() == 0


def matched_strings(parsed):
    """Every string that a rule's regex can match (literals, sets, alternatives and optional parts; the lookahead's space too)."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            more = [chr(x) for _, x in arg]
        elif name == "BRANCH":
            more = [x for branch in arg[1] for x in matched_strings(branch)]
        elif name == "MAX_REPEAT":
            assert tuple(arg[:2]) == (0, 1)
            more = ["", *matched_strings(arg[2])]
        elif name == "SUBPATTERN":
            more = matched_strings(arg[3])
        else:
            assert name == "ASSERT", name
            more = matched_strings(arg[1])
        out = [a + b for a in out for b in more]
    return out


def test_license_gates_follow_from_every_rule():
    from re import _parser
    lost = [(r["regex"], s) for r in license_scan.rules() for s in matched_strings(_parser.parse(r["regex"]))
            if (not r["context"] and r["kw"] not in s) or not any(g in (r["kw"] if r["context"] else s) for g in license_scan.GATES)]
    assert lost == []


def test_every_license_rule_finds_its_strings(spark):
    """The shortest and the longest string of each rule as a document of its own."""
    from re import _parser
    table, texts = license_scan.rules(), []
    for r in table:
        found = sorted(matched_strings(_parser.parse(r["regex"])), key=len)
        texts += [(r["id"], (r["kw"] if r["context"] else "") + f) for f in (found[0], found[-1])]
    got = license_scan.scan(docs(spark, *[t for _, t in texts]), ["doc_id"]).select("doc_id", "detections.id").collect()
    assert [t for r in got for t in [texts[r["doc_id"]]] if t[0] not in r["id"]] == []


LICENSE_TEXTS = {
    "// SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: MIT-0": "mit-0",
    "/* SPDX-License-Identifier: GPL-2.0+ */": "gpl-2.0", "SPDX-License-Identifier: (Apache-2.0 OR MIT)": "apache-2.0,mit",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause": "apache-2.0,bsd-3-clause,mit", "{\"license\": \"MIT\"}": "mit",
    "MIT or ISC, as you like": "", "Creative Commons Zero": "cc0-1.0", "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa-4.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
    "(the \"Software\"), to deal in the Software": "mit",
    "Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted": "isc",
    "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following "
    "conditions are met: Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from "
    "this software": "bsd,bsd-3-clause",
    "you can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
    "version 2 of the License, or (at your option) any later version.": "gpl,gpl-2.0",
    "you may not use this file except in compliance with the License. http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
    "damages arising from the use of this software.": "zlib",
    "The Software shall be used for Good, not Evil.": "json", "Business Source License 1.1": "busl-1.1",
    "he gave permission to use the garden, and the redistribution of land went on": "",
}


def test_license_texts(spark):
    texts = list(LICENSE_TEXTS)
    got = license_scan.summarise(license_scan.scan(docs(spark, *texts), ["doc_id"]), ["doc_id"]).collect()
    assert {texts[r["doc_id"]]: r["labels"] for r in got} == LICENSE_TEXTS
    table = license_scan.rules()
    for r in got:
        assert (r["n_words"], r["n_base"], r["labels"]) == tuple(brute_licenses(texts[r["doc_id"]], table)[i] for i in (0, 1, 5))


def test_licenses_match_brute_force_without_gates(spark, monkeypatch):
    want = {"This is the Unlicense": "unlicense", "WTFPL v2": "wtfpl-2.0", "WTFPLv2": "wtfpl-2.0", "BSD 3-Clause": "bsd-3-clause",
            "released under Apache 2.0": "apache-2.0", "Creative Commons Attribution Non-Commercial": "cc-by-nc",
            "Creative Commons Attribution Share Alike 4.0": "cc-by-sa-4.0", "the X11 License": "mit", "CC-BY4.0": "cc-by-4.0",
            "CC-BY-NC-SA4.0": "cc-by,cc-by-nc-sa-4.0", "CC0v1": "cc0-1.0", "MIT/X11 license": "mit", "x11 only": ""}
    d = docs(spark, *want).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source", "n_chars"))
    got = license_scan.summarise(license_scan.scan(d, ["doc_id", "text"]), ["doc_id", "text"]).collect()
    assert {r["text"]: r["labels"] for r in got if r["doc_id"] < 1000} == want
    monkeypatch.setattr(license_scan, "GATES", ("",))
    table = [r if r["context"] else r | {"kw": ""} for r in license_scan.rules()]
    for r in got:
        assert tuple(r)[2:] == pytest.approx(brute_licenses(r["text"], table)), r["text"]


# ---- 3 quality ------------------------------------------------------------------------------------------

def test_quality_defined_results(spark):
    m = messy(spark, True)
    r = {x["doc_id"]: x for x in quality.judge(m, ["doc_id"]).collect()}
    assert r[0]["n_words"] == 0 and r[0]["base_failed"] and not r[0]["kept"] and r[3]["n_words"] == 40_000
    out = quality.filter_documents(m)
    assert out.columns == m.columns and {x["doc_id"] for x in out.collect()} <= {3, 4}
    assert quality.judge(docs(spark), ["doc_id"]).count() == 0 and quality.filter_documents(docs(spark)).count() == 0


def test_sketch_is_mergeable_and_accurate(spark):
    rng = random.Random(5)
    values = [int(rng.paretovariate(1.1) * 20) for _ in range(4000)]
    df = spark.createDataFrame([("a" if i % 3 else "b", v) for i, v in enumerate(values)], "g string, value bigint")
    whole, merged = quality.sketch(df, []), quality.merge(quality.sketch(df, ["g"]), [])
    assert sorted(whole.collect()) == sorted(merged.collect()) and quality.cut_offs(whole, []).first() == quality.cut_offs(merged, []).first()
    buckets = sorted(r["bucket"] for r in whole.collect())
    assert all(any(b <= v <= b * (1 + 2 ** -(quality.SKETCH_BITS - 1)) for b in buckets) for v in values)


def test_cut_offs_follow_the_groups_spread(spark):
    """Equal outliers, different bulks: every group gets the cut-off of its own gap, a group without a gap none."""
    rng = random.Random(6)
    rows = [("narrow", rng.randrange(0, 30)) for _ in range(300)] + [("narrow", 200)] * 9
    rows += [("wide", rng.randrange(0, 120)) for _ in range(300)] + [("wide", 200)] * 9
    rows += [("even", 100 + i) for i in range(150)] + [("zero", 0)] * 50
    cut = {r["g"]: r["cut"] for r in quality.cut_offs(quality.sketch(
        spark.createDataFrame(rows, "g string, value bigint"), ["g"]), ["g"]).collect()}
    high = {g: max(v for k, v in rows if k == g and v < 200) for g in ("narrow", "wide")}
    assert cut == {"narrow": (high["narrow"] + 200) // 2, "wide": cut["wide"], "even": quality.NO_CUT, "zero": quality.NO_CUT}
    assert cut["wide"] in ((high["wide"] + 200) // 2, (high["wide"] + 199) // 2) or cut["wide"] > cut["narrow"]


def test_quality_keeps_clean_and_drops_junk(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = quality.judge(d, ["doc_id"]).where("n_words >= 50").join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x["quality"]: x["kept"] for x in r}
    assert kept[1] >= 0.99 and kept[0] <= 0.01


# ---- 4 WARC ---------------------------------------------------------------------------------------------

def test_warc_round_trip_and_order(spark):
    big = "x" * 150 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(5, "http://b.example/q?x#y", big), (2, "http://a.example/%\r\nz", big), (7, None, None), (8, "nourl", "short"),
            (9, "http://a.example/", "short"), (None, "http://a.example/", big), (2, "http://a.example/%\r\nz", big),
            (11, "http://c.example/é", "é" * 3000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    got = warc.archive_and_index(pages, range_rows=3).orderBy("range_id", "range_pos").collect()
    key = [warc.order((r["page_id"], 0, 0, 0, 0, 0, r["url_key"], r["captured"], r["file"], r["offset"])) for r in got]
    assert key == sorted(key) and len({r["range_id"] for r in got}) > 1
    def text(x):
        return tuple((y is not None, y or "") for y in x)
    assert sorted(((r["page_id"], r["url"]) for r in got), key=text) == sorted(((r[0], r[1]) for r in rows), key=text)
    by = collections.defaultdict(list)
    for r in got:
        by[r["page_id"]].append((r["record_type"], r["refers_to"], r["payload_bytes"]))
    n = len(big.encode())
    assert by[2] == [("response", None, n)] * 2 and by[5] == [("revisit", 2, n)] and by[None] == [("revisit", 2, n)]
    assert by[7] == [("response", None, 0)] and by[8][0][0] == by[9][0][0] == "response" and by[11][0][2] == 6000
    assert warc.archive_and_index(pages.limit(0)).count() == 0


def test_warc_takes_every_bigint_as_page_id(spark):
    ids = [-(1 << 63), (1 << 63) - 1, 0, -1, 300_000_000_000, -70_000_000_000, 10 ** 13, None]
    pages = spark.createDataFrame([(i, f"http://a/{i}", "same page " * 20) for i in ids], "page_id bigint, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_and_index(pages, range_rows=2).collect()}
    assert got == {i: ("response", None) if i == -(1 << 63) else ("revisit", -(1 << 63)) for i in ids}


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


# ---- 5 decontamination ----------------------------------------------------------------------------------

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(400)]
    items = [[rng.choice(vocab) for _ in range(rng.randrange(8, 50))] for _ in range(30)]
    texts, planted = [], {}
    for t in range(300):
        words = [rng.choice(vocab) for _ in range(rng.randrange(5, 300))]
        if t % 2 == 0:
            i = rng.randrange(len(items))
            copy = list(items[i])
            for _ in range(rng.randrange(0, int(0.2 * len(copy)) + 1)):
                at = rng.randrange(len(copy))
                what = rng.randrange(3)
                if what == 0:
                    copy[at] = rng.choice(vocab)
                elif what == 1:
                    del copy[at]
                else:
                    copy.insert(at, rng.choice(vocab))
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
            planted[t] = i
        texts.append(words)
    item_df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    got = decontam.find_leaks(docs(spark, *[" ".join(t).upper() for t in texts]), item_df, block_items=13).collect()
    pairs = {(r["doc_id"], r["item_id"]): r["distance"] for r in got}
    truth = {}
    for t, words in enumerate(texts):
        for i, x in enumerate(items):
            most = int(0.2 * len(x) + 1e-9)
            if len(set(x) & set(words)) < len(set(x)) - most:
                continue
            best = min((min(edits(x, words[p:p + len(x) + most])) for p in range(len(words))), default=99)
            if best <= most:
                truth[(t, i)] = best
    assert set(pairs) <= set(truth) and len(truth) >= 140
    assert len(pairs) >= 0.97 * len(truth)
    assert all(pairs[k] >= truth[k] for k in pairs) and sum(pairs[k] == truth[k] for k in pairs) >= 0.95 * len(pairs)


def test_decontamination_defined_results(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "mit license"), (4, "one two three four five six")], "item_id bigint, text string")
    m = messy(spark, True)
    assert decontam.find_leaks(m, items).count() == 0
    out = decontam.drop_leaks(m, items)
    assert out.columns == m.columns and out.count() == 10
    leaky = docs(spark, "zero One, two three FOUR five six seven", "one two", None)
    r = decontam.find_leaks(leaky, items).collect()
    assert [(x["doc_id"], x["item_id"], x["distance"], x["first_word"], x["last_word"]) for x in r] == [(0, 4, 0, 1, 6)]
    assert sorted(x["doc_id"] for x in decontam.drop_leaks(leaky, items).collect()) == [1, 2]
    assert decontam.find_leaks(docs(spark), items).count() == 0 and decontam.find_leaks(leaky, items.limit(0)).count() == 0


def test_decontamination_short_items_are_matched_exactly(spark):
    rng = random.Random(13)
    vocab = list("abcde")
    items = [[rng.choice(vocab) for _ in range(rng.randrange(1, 5))] for _ in range(25)] + [["a", "b"], ["a", "b"]]
    texts = [[rng.choice(vocab) for _ in range(rng.randrange(0, 12))] for _ in range(60)]
    item_df = spark.createDataFrame([*((i, " ".join(x)) for i, x in enumerate(items)), (99, " - "), (98, None),
                                     (97, "p q r s t u")], "item_id bigint, text string")
    d = docs(spark, *[", ".join(t).upper() for t in texts], "x p q r s t u")
    want = {}
    for t, words in enumerate(texts):
        for i, x in enumerate(items):
            at = next((p for p in range(len(words) - len(x) + 1) if words[p:p + len(x)] == x), None)
            if at is not None:
                want[(t, i)] = (len(x), 0, at, at + len(x) - 1)
    want[(60, 97)] = (6, 0, 1, 6)
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontam.find_leaks(d, item_df, short=True, block_items=9).collect()}
    assert got == want and len(want) > 200
    assert [(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(d, item_df).collect()] == [(60, 97)]
    only = item_df.where("item_id < 90")
    assert decontam.find_leaks(d, only, short=True).count() == len(want) - 1
    assert decontam.drop_leaks(d, item_df).count() == 60


def test_decontamination_finds_long_items_at_the_bound(spark):
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(3000)]
    items = [[rng.choice(vocab) for _ in range(n)] for n in (40, 100, 200, 200, 300, 300, 400, 500)]
    texts, want = [], {}
    for i, item in enumerate(items):
        for kind in ("insert", "delete"):
            copy = list(item)
            for _ in range(len(item) // 5):
                if kind == "insert":
                    copy.insert(rng.randrange(len(copy)), rng.choice(vocab))
                else:
                    del copy[rng.randrange(len(copy))]
            want[(len(texts), i)] = edits(item, copy)[len(copy)]
            texts.append([rng.choice(vocab) for _ in range(rng.randrange(200))] + copy + [rng.choice(vocab) for _ in range(rng.randrange(200))])
    item_df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    d = docs(spark, *[" ".join(t) for t in texts])
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.find_leaks(d, item_df).collect()}
    assert set(got) == set(want)
    for (t, i), r in got.items():
        assert r["n_words"] == len(items[i]) and r["distance"] <= want[(t, i)]
        assert edits(items[i], texts[t][r["first_word"]:r["last_word"] + 1])[-1] == r["distance"]
    assert decontam.drop_leaks(d, item_df).count() == 0


def test_closest_stretch_matches_brute_force():
    rng = np.random.default_rng(3)
    for n, size in ((3, 12), (6, 20), (9, 9)):
        items, word = rng.integers(0, 4, (20, n)).astype(np.uint64), rng.integers(0, 4, 50).astype(np.uint64)
        first = rng.integers(0, 25, 20)
        starts, end = rng.integers(1, size, 20), first + size
        d, a = decontam.closest(items, word, first, starts, end)
        for r in range(20):
            every = [min(edits(items[r].tolist(), word[p:end[r]].tolist())) for p in range(first[r], first[r] + starts[r])]
            assert d[r] == min(every) and a[r] == first[r] + every.index(min(every))


# ---- 6 URLs ---------------------------------------------------------------------------------------------

def test_url_rules_and_collisions(spark):
    import xxhash
    from pyspark.sql import Row
    assert spark.range(1).select(F.xxhash64(F.lit("a" * 77))).first()[0] & (2 ** 64 - 1) == xxhash.xxh64_intdigest("a" * 77, url_filter.SEED)
    urls = ["http://Example.org/en/12?q", "https://x.example.org/es/", "http://org/a", "http://org", "http://notexample.org/es/1",
            "http://m.free-bets.example.com/de/1", "http://a.com/fr/x", "ftp//none", None, "http://ads.net", "", "http://u://v/"]
    pages = spark.createDataFrame([Row(page_id=i, url=u) for i, u in enumerate(urls)], "page_id bigint, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in
           url_filter.judge(pages, url_filter.build(url_filter.entries(spark), bits=2), ["page_id"]).collect()}
    assert got[0] == ("example.org", "/en/12", "example.org/en/1", "block") and got[1][2:] == ("example.org/es/", "block")
    assert got[2] == ("org", "/a", "org/", "allow") and got[3] == ("org", "", None, "allow") and got[4][2:] == ("org/", "allow")
    assert got[5][2:] == ("com/de/", "block") and got[6][2:] == ("com/fr/", "allow") and got[7] == got[8] == got[10] == ("", "", None, "allow")
    assert got[9] == ("ads.net", "", None, "block") and got[11] == ("u:", "//v/", None, "allow")
    wide = pages.withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    empty = url_filter.build(url_filter.entries(spark).limit(0), bits=1)
    assert url_filter.filter_pages(wide, empty).columns == wide.columns and url_filter.filter_pages(wide, empty).count() == len(urls)
    assert url_filter.judge(pages.limit(0), empty, ["page_id"]).count() == 0


def test_url_probe_confirms_strings(tmp_path):
    from edgegraph.llm.tables import write_arrays
    import xxhash
    key = xxhash.xxh64_intdigest(b"real/", url_filter.SEED)
    texts = [b"fake/", b"real/"]
    write_arrays(f"{tmp_path}/{key >> 63}", keys=np.array([key, key], np.uint64), at=np.array([0, 5, 10]),
                 text=np.frombuffer(b"".join(texts), np.uint8), block=np.array([1, 0], np.uint8))
    filled = [key >> 63 == 0, key >> 63 == 1]
    assert url_filter.Probe(url_filter.Index(str(tmp_path), 1, filled, [1])).find([b"real/", b"none/"]).tolist() == [0, -1]


# ---- 7 lines --------------------------------------------------------------------------------------------

def brute_lines(texts, min_words):
    """Lines covered by a run of at least min_words words whose lines occur at an earlier place."""
    seqs = {}
    for d, t in texts.items():
        lines = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate((t or "").split("\n"))]
        seqs[d] = [(i, x) for i, x in lines if x]
    first = {}
    for d in sorted(seqs):
        ls = [x for _, x in seqs[d]]
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                first.setdefault(tuple(ls[a:b]), (d, a))
    out = {}
    for d in seqs:
        ls, gone = [x for _, x in seqs[d]], set()
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                if sum(len(WORD.findall(x)) for x in ls[a:b]) >= min_words and first[tuple(ls[a:b])] < (d, a):
                    gone |= set(range(a, b))
        out[d] = (len(ls), [seqs[d][i][0] for i in sorted(gone)])
    return out


def test_line_runs_match_brute_force(spark):
    rng = random.Random(7)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(12)]
    texts = {}
    for d in range(40):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 25))]
        if d % 3 == 0 and d:
            src = texts[rng.randrange(d)].split("\n")
            a = rng.randrange(len(src))
            lines += src[a:a + rng.randrange(1, 12)]
        texts[d] = "\n".join(x if rng.random() > 0.1 else f" {x}\t" if rng.random() > 0.5 else "" for x in lines)
    for min_words in (1, 6, 15):
        got = {r["doc_id"]: (r["n_lines"], list(r["removed_lines"])) for r in
               line_dedup.annotate(docs(spark, *texts.values()), ["doc_id"], min_words).collect()}
        assert got == brute_lines(texts, min_words)


def test_line_dedup_defined_results(spark):
    m = messy(spark, True)
    out = line_dedup.dedup_lines(m, 5)
    assert out.columns == m.columns
    got = collections.Counter(r["doc_id"] for r in out.collect())
    assert got[4] == 0 and got[3] == 1 and got[5] == 2 and got[6] == 0 and got[None] == 2 and got[0] == got[1] == 1
    assert line_dedup.dedup_lines(docs(spark)).count() == 0
    two = line_dedup.dedup_lines(docs(spark, "a b c\nkeep", "new\na b c", "a b c"), 3).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in two] == [(0, "a b c\nkeep", 10), (1, "new", 3)]


# ---- 8 language model -----------------------------------------------------------------------------------

def test_model_is_a_distribution_and_prefers_seen_text(spark):
    train = docs(spark, "a b c", "a b d", "b c a a", None, "c")
    model = kneser_ney.train(train.select("text"))
    scorer = kneser_ney.Scorer(model)
    words = ["a", "b", "c", "d", "unknown"]
    for context in ("", "a", "b", "d", "unknown"):
        def prob(text, shorter):
            data = np.frombuffer(text.encode(), np.uint8)
            small = np.frombuffer(shorter.encode(), np.uint8)
            # a text's probability holds its end; take the end's share out by the one-word-longer context
            return scorer.texts(data, np.array([0, len(data)]))[3][0], scorer.texts(small, np.array([0, len(small)]))[3][0]
        if context == "":
            total = sum(10 ** prob(w, "")[0] for w in words)
            assert 0 < total <= 1 + 1e-9
    good, bad = (kneser_ney.score(docs(spark, t), model, ["doc_id"]).first()["perplexity"] for t in ("a b c", "d d unknown"))
    assert good < bad


def test_model_defined_results(spark):
    nothing = kneser_ney.train(docs(spark).select("text"))
    r = kneser_ney.score(messy(spark), nothing, ["doc_id"]).collect()
    assert len(r) == 10 and all(x["score"] == 0 and x["n_known"] == 0 and x["train_tokens"] == 0 for x in r)
    some = kneser_ney.train(messy(spark, True).select("text"))
    r = {x["doc_id"]: x for x in kneser_ney.score(messy(spark, True), some, ["doc_id"]).collect()}
    assert r[0]["n_tokens"] == 1 and r[1]["n_known"] == 1 and r[3]["n_tokens"] == 40_001 and np.isfinite(r[3]["score"])
    assert kneser_ney.score(docs(spark), some, ["doc_id"]).count() == 0


# ---- 9 mixing -------------------------------------------------------------------------------------------

def test_mix_targets_quotas_and_shards(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "en", rng.choice(["a"] * 6 + ["b", "c", "é", None]), 0) for i in range(1500)]
    d = spark.createDataFrame(rows, DOCS)
    plan = mixing.document_shards(d, ["doc_id", "source"], block_words=400, block_docs=40).collect()
    again = mixing.document_shards(d.repartition(7), ["doc_id", "source"], block_words=400, block_docs=40).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    size, target = collections.Counter(), {}
    taken, shards = collections.Counter(), collections.Counter()
    for r in plan:
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        taken[r["source"]] += r["size"] * len(r["shards"])
        shards.update(r["shards"])
        assert len(r["shards"]) <= 3
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    for s, w in zip(order, [5, 2, 1, 5, 2]):
        assert target[s] <= 3 * size[s] + 1e-6 and abs(taken[s] - target[s]) <= 60
        if target[s] < 3 * size[s] - 1e-6:
            assert target[s] / w == pytest.approx(target["a"] / 5)
    assert set(shards) == set(range(16)) and max(shards.values()) < 2 * min(shards.values())


def test_mix_meets_targets_with_null_and_equal_ids(spark):
    rng = random.Random(9)
    for same in (None, 7):
        for texts in ([" ".join(f"x{rng.random()}" for _ in range(20)) for _ in range(1000)], ["one and the same text here"] * 1000):
            rows = [(same, t, "en", "a", 0) for t in texts] + [(i, "some other words of b " * 8, "en", s, 0) for i, s in enumerate("bbbccc" * 60)]
            d = spark.createDataFrame(rows, DOCS)
            got = mixing.document_shards(d, ["source"]).collect()
            taken = sum(r["size"] * len(r["shards"]) for r in got if r["source"] == "a")
            target = next(r["target"] for r in got if r["source"] == "a")
            assert abs(taken - target) <= 20 and max(len(r["shards"]) for r in got) <= 3


def test_mix_shards_follow_the_total(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1000)
    d = docs(spark, *[" ".join(["w"] * 50) + f" {i}" for i in range(300)])
    out = mixing.mix(d, block_words=200, block_docs=4)
    assert out.select("mix_shard").distinct().count() == 16 and out.count() == 300
    assert mixing.mix(d.limit(10)).select("mix_shard").distinct().count() == 1


def test_split_tree_is_exact(spark):
    q = spark.createDataFrame([("a", 37), ("b", 5), ("c", 1)], "key string, quota bigint")
    out = mixing._split_tree(q, 3, "s").collect()
    total, per = collections.Counter(), collections.Counter()
    for r in out:
        total[r["key"]] += r["quota"]
        per[r["shard"]] += r["quota"]
    assert total == {"a": 37, "b": 5, "c": 1} and set(per.values()) <= {5, 6}


def test_mix_defined_results(spark):
    m = messy(spark, True)
    out = mixing.mix(m)
    assert out.columns[:len(m.columns)] == m.columns and out.columns[-2:] == ["mix_shard", "mix_order"] and out.count() >= 5
    assert mixing.mix(docs(spark)).count() == 0
    nothing = mixing.document_shards(docs(spark, None, "", " "), ["doc_id"]).collect()
    assert [r["size"] for r in nothing] == [0, 0, 0]


# ---- 10 near duplicates ---------------------------------------------------------------------------------

def brute_components(texts, percent):
    sets = {}
    for d, t in texts.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d
    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: (len(sets[d]), root(d)) for d in texts}


def test_components_match_brute_force(spark):
    rng = random.Random(4)
    texts, n = {}, 0
    for family in range(12):
        words = [f"f{family}w{rng.randrange(500)}" for _ in range(rng.randrange(3, 220))]
        for _ in range(rng.randrange(1, 25)):
            copy = list(words)
            for _ in range(rng.randrange(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            cut = rng.randrange(0, max(1, len(copy) // 8))
            texts[n] = " ".join(copy[cut:]).upper()
            n += 1
            if rng.random() < 0.2:
                words = copy  # drifts: chains of links
    for percent in (85, 80):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
               neardup.components(docs(spark, *texts.values()), percent).collect()}
        assert got == brute_components(texts, percent)


def test_a_large_chained_group_is_one_component(spark):
    words = [f"w{i}" for i in range(700)]
    texts = [" ".join(words[i:i + 100]) for i in range(600)]  # each only like its neighbours
    random.Random(1).shuffle(texts)
    got = neardup.components(docs(spark, *texts), 85).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def random_copies(rng, families=10, per=30):
    texts = []
    for family in range(families):
        words = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.randrange(30, 160))]
        for _ in range(rng.randrange(1, per)):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(copy) // 20))):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            texts.append(" ".join(copy))
    return texts


def test_lists_of_many_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 20_000)  # about four documents a block
    texts = dict(enumerate(random_copies(random.Random(8))))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.components(docs(spark, *texts.values()), 85).collect()}
    assert got == brute_components(texts, 85)


def test_thresholds_follow_percent(spark):
    assert [neardup.match_threshold(p) for p in (50, 70, 80, 85, 95)] == sorted(neardup.match_threshold(p) for p in (50, 70, 80, 85, 95))
    pairs = {}
    for i in range(60):  # 60 pairs of similarity 5/9
        words = [f"p{i}w{k}" for k in range(104)]
        pairs[2 * i], pairs[2 * i + 1] = " ".join(words[:77]), " ".join(words[28:])
    got = neardup.components(docs(spark, *pairs.values()), 40)
    assert got.where("kept").count() == 120 - 60


def test_borderline_group_writes_links_in_proportion(spark, monkeypatch):
    """5,000 copies of one page, most pairs of which look alike but are no links: rows between the steps stay linear."""
    rng = random.Random(5)
    page = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(5000):
        copy = list(page)
        for k in rng.sample(range(120), 2):
            copy[k] = f"n{rng.random()}"
        texts.append(" ".join(copy))
    written = []
    keep = neardup.ckpt

    def counting(df):
        out = keep(df)
        written.append(out.count())
        return out
    monkeypatch.setattr(neardup, "ckpt", counting)
    got = neardup.components(docs(spark, *texts), 88).collect()
    assert max(written) <= 5000 * neardup.COORDS and len({r["component_id"] for r in got}) > 100
    sets = [{" ".join(t.split()[i:i + 5]) for i in range(116)} for t in texts]
    label = {r["doc_id"]: r["component_id"] for r in got}
    for a in rng.sample(range(5000), 25):
        for b in range(5000):
            both = len(sets[a] & sets[b])
            assert 100 * both < 88 * (232 - both) or label[a] == label[b]


def test_near_dup_defined_results(spark):
    m = messy(spark, True)
    out = neardup.drop_copies(m)
    got = collections.Counter(r["doc_id"] for r in out.collect())
    assert out.columns == m.columns and got == {0: 1, 1: 1, 2: 1, None: 2, 3: 1, 5: 1}
    c = {r["doc_id"]: r for r in neardup.components(m).collect()}
    assert c[4]["component_id"] == 3 and not c[4]["kept"] and c[0]["n_shingles"] == 0 and c[0]["kept"] and c[None]["component_id"] is None
    assert neardup.components(docs(spark)).count() == 0 and neardup.drop_copies(docs(spark)).count() == 0


def test_one_of_near_copies_with_null_or_equal_ids_stays(spark):
    def family(name):
        words = [f"{name}{i}" for i in range(100)]
        return [" ".join(words), " ".join(words[:-1]), " ".join(words[1:])]
    rows = [(None, x) for f in ("a", "b") for x in family(f)] + [(7, x) for x in family("c")]
    rows += list(zip((None, 9, 9), family("d"))) + [(7, "alone in its component with an id of others")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = [(r["doc_id"], r["text"][0]) for r in neardup.drop_copies(d).collect()]
    assert sorted(got, key=str) == sorted([(None, "a"), (None, "b"), (7, "c"), (9, "d"), (7, "a")], key=str)
