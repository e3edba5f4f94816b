"""Winnowing, licence scans and M-tree search against brute force."""
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from barsight.llm.fingerprints import GRAM, WINDOW, fingerprints, hashes, likeness, positions, with_fingerprint
from barsight.llm.licenses import PHRASES, scan
from barsight.llm.mtree import top_products
from tests.llm.conftest import text


def test_winnowing_takes_the_rightmost_minimum(spark):
    texts = ["", "one", "a b c d e", text(40, 1), "x " * 60, text(11, 2), "a b c " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = with_fingerprint(df, "text", "f").withColumn("p", positions(F.col("f"))).withColumn(
        "w", F.transform(F.filter(F.split("text", " "), lambda x: x != ""), lambda x: F.xxhash64(x)))
    grams = rows.select("f", "p", "w", F.expr(
        f"CASE WHEN size(w) >= {GRAM} THEN transform(sequence(0, size(w) - {GRAM}), i -> "
        f"xxhash64(get(w, i), get(w, i + 1), get(w, i + 2), get(w, i + 3), get(w, i + 4)) & 4294967295L) "
        "WHEN size(w) > 0 THEN array(xxhash64(w) & 4294967295L) ELSE array() END").alias("g"))
    for r in grams.collect():
        want = []
        for a in range(max(1, len(r.g) - WINDOW + 1) if r.g else 0):
            part = r.g[a:a + WINDOW]
            at = a + max(i for i, x in enumerate(part) if x == min(part))
            if not want or want[-1][1] != at:
                want.append((min(part), at))
        assert list(zip((v >> 31 for v in r.f), r.p)) == want


def test_shared_runs_share_a_hash(spark):
    run = text(GRAM + WINDOW - 1, 3)
    df = spark.createDataFrame([(text(30, 4) + " " + run, run + " " + text(25, 5))], "a string, b string")
    both = with_fingerprint(with_fingerprint(df, "a", "fa"), "b", "fb")
    assert both.select(F.arrays_overlap(hashes(F.col("fa")), hashes(F.col("fb")))).first()[0]


def test_followers_and_edits(awkward, no_documents):
    rows = fingerprints(awkward).collect()
    assert len(rows) == 13
    order = sorted(((r.doc_id if r.doc_id is not None else -1, r) for r in rows), key=lambda x: -x[0])
    for (i, r), (_, n) in zip(order, order[1:] + order[:1]):
        if i not in (2, 3):                        # equal ids have equal texts here
            assert r.next_text == n.text
        half = len(r.text) // 2
        assert r.edited == r.text[:len(r.text) - half] + r.next_text[:half]
    assert fingerprints(no_documents).count() == 0


def test_many_blocks_of_ids(spark):
    df = spark.range(2000).selectExpr("id * 7 - 3000 AS doc_id", "concat('t', id) AS text")
    got = {r.doc_id: r.next_text for r in fingerprints(df.repartition(7)).collect()}
    assert all(got[i * 7 - 3000] == f"t{(i - 1) % 2000}" for i in range(2000))
    one = fingerprints(df.limit(1)).first()
    assert one.next_text == one.text


def test_likeness(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([1], [])], "a array<long>, b array<long>")
    assert [r[0] for r in df.select(likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_scan(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    places = [(i, v) for p, v in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted({v for _, v in places})))


def test_licences(spark, awkward, no_documents):
    rng = random.Random(1)
    bits = ["MIT License", "mit-LICENSE", "cc by", "CC\nBY", "Apache", "License", "GNU General  Public_License", "xmit license",
            "é", "licence", "by", "\U0001f600", "mit licensK"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "This work is licensed under the GNU General Public License, version 3."),
             (1003, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
             (1004, "free of charge hereby is granted permission"), (1005, "Licensed under CC BY-NC 4.0. " * 50)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_scan(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[1002].labels == "gpl,gpl-3.0" and got[1003].labels == "mit-text" and got[1004].labels == ""
    assert len(got[1005].places) == 50 and got[1005].labels == "cc-by,cc-by-nc"
    assert scan(awkward).count() == 13 and scan(no_documents).count() == 0


def test_a_notice_in_every_document_keeps_its_label(spark):
    rows = [(i, f"{text(20, i)} released under the MIT license {text(10, 100 + i)}") for i in range(30)]
    rows += [(100 + i, f"by nd {text(10, 200 + i)}") for i in range(20)] + [(200, "CC BY-ND")]
    got = {r.doc_id: r.labels for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "mit,mit-notice" for i in range(30)) and got[200] == "cc-by,cc-by-nd" and got[100] == ""


def test_several_notices_and_stray_rare_words(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:")
    notices = f"{bsd} {text(20, 1)} Released under the MIT license. {text(20, 2)} Licensed under the Apache License, Version 2.0."
    stray = "waived mozilla neighboring charge affero unencumbered modification conditions rights fee " + text(20, 3)
    rows = [(1, notices), (2, stray + " released under the MIT license"), (3, stray)] + [(10 + i, "mit license " + text(9, i)) for i in range(20)]
    got = {r.doc_id: r.labels for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "apache,apache-2.0,bsd,mit,mit-notice" and got[2] == "mit,mit-notice" and got[3] == ""


def brute_top(rows, k):
    out = {}
    clean = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in clean:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in clean if i != q)[:k]
            out.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scores)})
    return out


def search(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_products(df, df.where("vec_id % 50 = 0"), k).collect()
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in got}


def test_search_with_ties_and_awkward_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(120)]          # one vector many times
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, rows[1][1]),
             (700, [0.0] * 6), (701, [1.0, 2.0]), (750, [1.0])]
    assert search(spark, rows) == brute_top(rows, 5)


def test_search_is_exact_for_large_components(spark):
    rng = np.random.default_rng(16)
    for scale in (3.0e5, 1.8e6, 1.0e12):                 # products beyond 2^53, near 2^63, far beyond a long
        rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * scale]) for i in range(120)] + [(200, [9.0e6, 1.0]), (201, [1.0, -scale])]
        whole = {i: [int(np.floor(256 * x)) for x in v] + [0] * (3 - len(v)) for i, v in rows}
        want = {}
        for q in (0, 50, 100, 200):
            cut = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
            best = sorted((-sum(x * y for x, y in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
            want |= {(q, r + 1): (i, cut(-s)) for r, (s, i) in enumerate(best)}
        got = search(spark, rows)
        assert got == want if scale < 1e12 else set(got) == set(want)      # beyond a long, scores are cut


def test_search_small_and_empty(spark):
    assert search(spark, []) == {}
    assert search(spark, [(50, [1.0, 2.0])]) == {}
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert search(spark, rows) == brute_top(rows, 5)


def test_search_over_several_pages(spark, monkeypatch):
    import barsight.llm.mtree as m
    monkeypatch.setattr(m, "PAGE", 64)
    monkeypatch.setattr(m, "LEAF", 8)
    monkeypatch.setattr(m, "BLOCK", 4)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=8) * 0.1]) for i in range(900)]
    assert search(spark, rows) == brute_top(rows, 5)
