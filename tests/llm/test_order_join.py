"""The n-gram Jaccard join and its settling of buckets against brute force."""
import itertools
import re

import numpy as np
import pytest

from barsight.llm import settle as st
from barsight.llm.order_join import PERCENT, admits, join_documents, least, need, word_sets
from barsight.llm.settle import tile_links
from tests.llm.conftest import text, words


def grams(t, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=4, percent=85):
    sets = [(i, grams(t, k)) for i, t in rows if i is not None]
    comp = {i: i for i, _ in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            comp[y] = x
    return {i: root(i) for i, _ in sets}


def edited(base, places, seed):
    out = list(base)
    for p, w in zip(places, words(len(places), seed)):
        out[p] = w
    return " ".join(out)


def mixed_rows():
    rng = np.random.default_rng(9)
    base, line = words(150, 5), " ".join(words(12, 6))
    rows = [(i, edited(base, rng.choice(150, rng.integers(0, 9), replace=False), 100 + i)) for i in range(80)]
    rows += [(100 + i, line + " " + text(60 + i, 500 + i)) for i in range(20)]
    rows += [(200 + i, text(30, 900 + i // 4)) for i in range(12)] + [(300 + i, "a b c d e") for i in range(5)]
    return rows


@pytest.mark.parametrize("small,items", [(8, 16384), (2, 900)])
def test_components_equal_brute_force_with_a_large_mixed_group(spark, monkeypatch, small, items):
    monkeypatch.setattr(st, "SMALL", small)
    monkeypatch.setattr(st, "TILE_ITEMS", items)
    rows = mixed_rows()
    got = {r.doc_id: r for r in join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute(rows)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(grams(t)) for i, t in rows}


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert {r.doc_id: r.component_id for r in join_documents(docs).collect()} == brute(rows)


def test_defined_cases(awkward, no_documents):
    got = join_documents(awkward).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 13 and by[2].component_id == 1 and by[11].component_id == 10 and by[None].component_id is None
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[5].component_id == 5
    assert join_documents(no_documents).count() == 0


def test_a_doc_id_with_several_texts_ties_them_together(spark):
    one, two = text(60, 71), text(80, 72)
    docs = spark.createDataFrame([(1, one), (2, two), (5, one), (5, two + " zz"), (5, two + " zz"), (9, text(40, 73))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in join_documents(docs).collect()} == {1: 1, 2: 1, 5: 1, 9: 9}


def test_filters_never_turn_a_linked_pair_away():
    rng = np.random.default_rng(4)
    for _ in range(2000):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        drop, add = rng.integers(0, n // 8 + 1), rng.integers(0, n // 8 + 1)
        y = np.unique(np.r_[rng.permutation(x)[drop:], rng.integers(0, 2 ** 63, add).astype(np.uint64)])
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= PERCENT * (len(x) + len(y) - both):
            assert admits(x, y) and both >= need(len(x)) and min(least(len(x)), least(len(y))) >= least(need(max(len(x), len(y))))


def test_a_tile_returns_a_forest_of_labels():
    x = np.arange(100)
    side = (np.array([7] * 5 + [3]), np.concatenate([x] * 6), np.arange(0, 601, 100))
    assert tile_links(side, side, 85) == [(3, 7)]


def test_word_sets_are_sorted_and_distinct():
    raw = np.frombuffer(b"A b c d a B C d  x", np.uint8)
    elements, sizes = word_sets(raw, np.array([0, 15, 18]), 2)
    assert sizes.tolist() == [4, 1] and (np.diff(elements[:4].astype(float)) > 0).all()
