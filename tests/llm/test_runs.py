"""Periodic runs against brute force."""
import hashlib
import random
import re
import zlib

import numpy as np

from barsight.llm.runs import best_run, find_runs, periodic_runs, run_digests, with_periods
from barsight.llm.textarrays import U, mix


def brute(w):
    n, got = len(w), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                got.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in got.items())


def found(docs):
    text = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    return find_runs(mix(np.array(sum(docs, []), U) + U(3)), text, len(docs))


def test_runs_equal_brute_force_on_random_and_periodic_words():
    rng = random.Random(1)
    for _ in range(600):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randrange(rng.choice([1, 2, 2, 3, 4])) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.5 and w:
                w = w[:10] + w[:rng.randint(1, 8)] * rng.randint(2, 9) + w[10:]
            docs.append(w)
        got = found(docs)
        assert [got.get(i, []) for i in range(len(docs))] == [brute(d) for d in docs]


def test_long_texts_of_one_word_and_of_long_periods():
    for w, run in (([1] * 30000, (0, 30000, 1)), (list(range(2000)) * 6, (0, 12000, 2000)), (([1] * 7 + [2]) * 2000, (0, 16000, 8))):
        assert run in found([w])[0]


def test_best_run_ties_go_to_the_earlier_start_then_the_smaller_period():
    assert best_run([(5, 8, 2), (0, 4, 1), (0, 8, 2), (9, 7, 2)]) == (0, 4, 1)
    assert best_run([(0, 7, 2), (3, 8, 2)]) == (3, 8, 2)


def expected(doc_id, text, edit):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if edit and (at := with_periods(doc_id, len(w))) is not None:
        w = [w[i] for i in at]
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = best_run(runs) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_digests_of_documents_with_and_without_the_edit(spark, awkward, no_documents):
    docs = awkward.unionByName(spark.createDataFrame([(50, "a b " * 9 + "c"), (51, "x x x x x x"), (52, "Zz zz " * 5)], "doc_id long, text string"),
                               allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 5000]
    for edit in (False, True):
        got = sorted((tuple(r) for r in run_digests(docs, edit).collect()), key=str)
        want = {expected(i, t, edit) for i, t in rows}
        assert want <= set(got) and len(got) == 16
        assert run_digests(no_documents, edit).count() == 0
    listed = {tuple(r) for r in periodic_runs(docs).collect()}
    assert {(50, 0, 18, 2), (51, 0, 6, 1), (52, 0, 10, 2)} <= listed


def test_the_edit_repeats_the_end_of_a_tenth_of_the_documents():
    some = [i for i in range(300) if with_periods(i, 50) is not None]
    assert some and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in some)
    i = some[0]
    g = zlib.crc32(str(i).encode()) // 10
    a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
    assert with_periods(i, 50).tolist() == [k if k < a else a + (k - a) % p for k in range(50)]
    assert with_periods(None, 50) is None and with_periods(i, 0) is None
