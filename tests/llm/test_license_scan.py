"""Base places against a plain search; notices with words added, left out and changed."""
import random
import re

from txwatch.llm import license_scan as L

SCHEMA = "doc_id long, text string, label string, n_base int"


def plain(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    at = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_and_edges(spark):
    rng = random.Random(4)
    words = [w for p in L.PHRASES for w in p.split()] + ["x", "ä", "MIT", "License"]
    texts = [None, "", " -- ", "mit", "MIT License", "MIT-LICENSE.mit license", "gnu general public", "CC BY-NC 4.0", "cc_by",
             "GNU General Public License version 3", "mit licenses", "ÄMIT License", "Kmit license", "cc by " * 20000]
    texts += [" ".join(rng.choice(words) for _ in range(200)) for _ in range(60)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(4, "MIT License", "x", 1), (None, "mit license", "", 0), (None, None, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = L.scan(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id]), texts[r.doc_id]
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
            assert r.labels == ",".join(sorted(r.labels.split(",")))
    assert sum(r.n_base for r in got if r.doc_id is None) == 1
    assert L.scan(df.limit(0)).count() == 0


def test_notices_that_were_edited(spark):
    notice = next(t for t, label in L.NOTICES.items() if label == "bsd")
    w = notice.split()
    texts = [notice, "lead in " * 9 + " ".join(w[:7] + ["really"] + w[7:14] + w[15:]).upper() + " and on", " ".join(w[:9]),
             " ".join(w[:10]) + " filler" * 60 + " " + " ".join(w[10:]), " ".join(reversed(w))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    assert [("bsd" in got[i].labels) for i in range(5)] == [True, True, False, False, False]
    assert got[0].score == 1.0 and L.MIN_COVERED <= got[1].score < 1 and got[4].n_base == 0
    spans = {r.doc_id: (r.first, r.last) for r in L.spans(df).collect()}
    assert spans[0] == (0, len(w) - 1) and spans[1] == (18, 18 + len(w) - 1)


NEAR = {  # text: the labels it has, and no others
    "This work is licensed under the GNU General Public License version 2": "gpl",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3",
    "Creative Commons Attribution 4.0 International": "",
    "Creative Commons Attribution-ShareAlike": "cc-by-sa",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License": "",
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
    "Licensed under CC BY-SA 4.0": "cc-by",
    "Licensed under the Apache License, Version 1.1": "apache",
    "Licensed under the Apache License, Version 2.0": "apache,apache-2",
    "All rights reserved.": "all-rights-reserved",
    "All rights reserved. All rights reserved. All rights reserved.": "all-rights-reserved",
    "All rights are reserved": "",
    "GNU Lesser General Public License": "lgpl",
    "GNU Affero General Public License": "agpl",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
    "published by the Free Software Foundation": "lgpl",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation": "gpl,gpl-notice",
    "This program is free software: you may redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation": "gpl,gpl-notice",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "This Source Code Form is subject to the terms of the Eclipse Public License": "",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "This is free and unencumbered software released into the wild": "",
}


def test_near_misses_of_every_notice(spark):
    texts = list(NEAR) + [f"{t} {t} {t}" for t in NEAR] + [f"before it {t} and after" for t in NEAR]
    got = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == NEAR[list(NEAR)[i % len(NEAR)]], t
    assert {x for v in NEAR.values() for x in v.split(",") if x} | {"mit-notice", "bsd", "isc", "mit"} == {*L.PHRASES.values(), *L.NOTICES.values()}


def test_each_notice_word_for_word_and_short_of_its_last_word(spark):
    texts = [t for t in L.NOTICES] + [" ".join(t.split()[:-1]) for t in L.NOTICES if len(t.split()) < L.WHOLE_BELOW]
    got = {r.doc_id: r.labels.split(",") for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    labels = list(L.NOTICES.values())
    short = [x for t, x in L.NOTICES.items() if len(t.split()) < L.WHOLE_BELOW]
    assert all(labels[i] in got[i] for i in range(len(labels)))
    assert not any(x in got[len(labels) + i] for i, x in enumerate(short))


def test_a_whole_notice_among_scraps_of_itself(spark):
    """Neighbouring diagonals all along the text: the run is long, the notices in it are found."""
    w = next(t for t, label in L.NOTICES.items() if label == "bsd").split()
    scraps = " ".join(" ".join(w[k:k + 4] + ["x"] * (k % 2)) for _ in range(6) for k in range(0, len(w) - 4, 2))
    edited = " ".join(w[:9] + ["too"] + w[9:])
    texts = [f"{scraps} {' '.join(w)} {scraps}", f"{scraps} {edited} {scraps}", edited]
    got = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all("bsd" in got[i] for i in range(3))


def test_sql_gives_the_same_labels():
    import duckdb

    from txwatch.llm.queries import ORACLE
    texts = list(NEAR) + [f"{t} {t}" for t in NEAR]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, labels FROM ({ORACLE['op4_license_scan']})").fetchall()}
    assert [got[i] for i in range(len(texts))] == list(NEAR.values()) * 2
