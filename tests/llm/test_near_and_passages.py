"""Near-duplicates and repeated passages against brute force."""
import itertools

import numpy as np

from barsight.llm.common import components, global_index
from barsight.llm.near_dedup import keep_one, link_documents, sketch
from barsight.llm.passages import WORDS, compact_windows, dense_ends, good_runs, repeated_passages, two_function_keys, without_repeats
from barsight.llm.passages import gains, indexed, may_hold, may_meet, recurring, shared_runs
from barsight.llm.textarrays import mix, shingles
from tests.llm.conftest import text, words


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    comp = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for (i, a), (j, b) in itertools.combinations(sets, 2):
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and comp[i] != comp[j]:
                low = min(comp[i], comp[j])
                comp = {k: low if v in (comp[i], comp[j]) else v for k, v in comp.items()}
                changed = True
    return comp


def edited(base, places, seed):
    out, fresh = list(base), words(len(places), seed)
    for p, w in zip(places, fresh):
        out[p] = w
    return " ".join(out)


def test_links_equal_brute_force_with_a_large_mixed_group(spark):
    base = words(150, 5)
    rng = np.random.default_rng(3)
    rows = [(i, edited(base, rng.choice(150, rng.integers(0, 12), replace=False), 100 + i)) for i in range(60)]
    rows += [(100 + i, text(80, 500 + i)) for i in range(20)]
    got = {r.doc_id: r.component_id for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)
    assert len(set(got.values())) > 21          # some copies of the group stay unlinked


def test_near_dedup_defined_cases(awkward, no_documents):
    got = link_documents(awkward).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 13 and by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[4].kept and by[5].component_id == 5
    assert by[11].component_id == 10                # A-Z folds; two words are one shingle
    assert by[None].component_id is None and by[None].kept
    assert link_documents(no_documents).count() == 0
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert keep_one(no_documents).count() == 0


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    b = np.r_[a[:350], rng.integers(0, 2 ** 63, 50).astype(np.uint64)]
    one = a[:1]
    got = sketch(np.concatenate([a, b, one]), np.array([400, 400, 1]))
    assert (got != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((got[0] == got[1]).mean() - 350 / 450) < 0.15


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_global_index(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS k")
    got = global_index(df, [df.k], "place").collect()
    assert all(r.k == r.place for r in got)


def test_compact_windows_cover_each_long_subsequence_once():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 2 ** 63, 90).astype(np.uint64)
    v[40] = v[20]
    left, mid, right = compact_windows(v, np.array([0]), np.array([90]), 12)
    low = np.uint64((1 << 24) - 1)
    key = [(int(x & ~low), i) for i, x in enumerate(v)]
    for i in range(90):
        for j in range(i + 11, 90):
            hit = [c for l, c, r in zip(left, mid, right) if l <= i <= c <= j <= r]
            assert hit == [min(range(i, j + 1), key=lambda p: key[p])]


def test_good_runs_begin_with_the_longest():
    rng = np.random.default_rng(5)
    for _ in range(50):
        same = (rng.random(40) < 0.85).astype(float)
        got = good_runs(same, 6)
        every = [(b - a, a, b) for a in range(40) for b in range(a + 5, 40)
                 if same[a] and same[b] and same[a:b + 1].mean() >= 2 * .75 / 1.75 - 1e-9]
        assert bool(got) == bool(every)
        if got:
            assert max(y - x for x, y in got) == max(every)[0]
            assert all(same[x:y + 1].mean() >= 2 * .75 / 1.75 - 1e-9 for x, y in got)


def test_repeated_passages(spark):
    shared, near = words(60, 7), words(60, 8)
    changed = list(near)
    changed[30] = "zzz"
    rows = [(1, text(40, 11) + " " + " ".join(shared) + " " + text(30, 12)),
            (2, text(90, 13) + "\n" + " ".join(shared).upper() + " " + text(20, 14)),
            (3, " ".join(near) + " " + text(50, 15)), (4, text(70, 16) + " " + " ".join(changed)),
            (5, text(200, 17)), (6, " ".join(shared[:40])), (7, text(200, 17))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.source_id): r for r in repeated_passages(docs).collect()}
    assert set(got) == {(2, 1), (4, 3), (7, 5)}
    assert (got[2, 1].start_word, got[2, 1].end_word, got[2, 1].source_word) == (90, 150, 40)
    assert (got[4, 3].start_word, got[4, 3].end_word) == (70, 130) and 0.75 <= got[4, 3].similarity < 1
    left = {r.doc_id: r.text for r in without_repeats(docs).collect()}
    assert 7 not in left and left[1] == rows[0][1] and left[2].split() == text(90, 13).split() + text(20, 14).split()


def test_near_passages_with_words_put_in_and_left_out(spark):
    base, other, long = words(60, 8), words(60, 22), words(400, 21)
    spread = [w for k in range(0, 400, 40) for w in [*long[k:k + 40], f"q{k}"]]
    rows = [(1, " ".join(base) + " " + text(50, 15) + " " + " ".join(other)), (2, text(70, 16) + " " + " ".join(base[:30] + ["zzz"] + base[30:])),
            (3, text(70, 18) + " " + " ".join(other[:30] + other[31:])),
            (4, " ".join(long)), (5, text(20, 19) + " " + " ".join(spread))]
    got = {(r.doc_id, r.source_id): r for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {(2, 1), (3, 1), (5, 4)}
    assert (got[2, 1].start_word, got[2, 1].end_word) == (70, 131) and abs(got[2, 1].similarity - 52 / 61) < 1e-9
    assert (got[3, 1].start_word, got[3, 1].end_word) == (70, 129)
    assert got[5, 4].start_word == 20 and got[5, 4].end_word >= 429 and 0.75 <= got[5, 4].similarity < 0.85


def test_word_for_word_holders_behind_variants_are_found(spark):
    base, rng = words(60, 31), np.random.default_rng(6)
    rows = [(i, edited(base, [5 + i % 3, 20 + i, 47 - i % 4], 300 + i) + " " + text(40, 400 + i)) for i in range(10)]
    rows += [(50, text(30, 32) + " " + " ".join(base)), (60, " ".join(base) + " " + text(35, 33))]
    rows += [(100 + i, text(120, 600 + i)) for i in range(10)]
    got = {(r.doc_id, r.source_id) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (60, 50) in got and not any(i >= 100 for i, _ in got)


def test_word_for_word_holders_with_variants_between_them_are_found(spark):
    base = words(60, 31)
    variant = lambda i: edited(base, [5 + i % 3, 20 + i, 47 - i % 4], 300 + i)
    rows = [(i, variant(i) + " " + text(40, 400 + i)) for i in range(10)]
    rows += [(50, text(30, 32) + " " + " ".join(base)), (80, " ".join(base) + " " + text(35, 33))]
    rows += [(60 + i, text(20, 500 + i) + " " + variant(i)) for i in range(10)]
    got = {(r.doc_id, r.source_id) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (80, 50) in got


def test_keys_of_two_functions_hold_every_common_passage():
    rng = np.random.default_rng(9)
    for n, kinds in ((90, 1000), (130, 6), (160, 2)):
        x = rng.integers(0, kinds, n)
        f, sig, c, l, r = (np.concatenate(y) for y in zip(*(
            (np.full(len(w[0]), k), (v[w[1]] + k).astype(np.int64), w[1], w[0], w[2])
            for k, v in enumerate(rng.permutation(1 << 20)[:kinds][x].astype(np.uint64) << np.uint64(30) for _ in range(3))
            for w in [compact_windows(v, np.array([0]), np.array([n]))])))
        on = np.ones(len(f), bool)
        key, lo, hi, a0, a1, b0, b1, left = two_function_keys(sig, f, c, l, r, on, on, at_once=7)
        assert left.all()
        found = set()
        for g, h in ((0, 1), (0, 2), (1, 2)):
            for s in range(n - 45):
                for e in range(s + 45, min(n, s + 121)):
                    i, j = (np.flatnonzero((f == k) & (l <= s) & (s <= c) & (c <= e) & (e <= r)) for k in (g, h))
                    assert len(i) == len(j) == 1
                    found.add((int(sig[i[0]]), int(sig[j[0]]), s, e))
        of = {}
        for k, x0, x1 in zip(key.tolist(), lo.tolist(), hi.tolist()):
            of.setdefault(k, []).append((x0, x1))
        for p, q, s, e in found:
            mine = mix(np.array([p]).view(np.uint64) ^ mix(np.array([q]).view(np.uint64))).view(np.int64)[0]
            assert any(x0 <= s and e <= x1 for x0, x1 in of[int(mine)])


def test_dense_ends_by_brute_force():
    rng = np.random.default_rng(4)
    at = np.r_[np.arange(130), np.arange(200, 420)]
    shared = (rng.random(len(at)) < np.repeat(rng.random(len(at) // 50 + 1), 50)[:len(at)] + 0.3).astype(np.int64)
    ends = dense_ends(at, shared)
    for i in range(0, len(at), 7):
        every = [at[x + n - 1] for x in range(i, len(at)) for n in range(46, 92) if x + n <= len(at)
                 and at[x + n - 1] - at[x] == n - 1 and shared[x:x + n].sum() >= 0.75 * n]
        assert ends[i] == (min(every) if every else np.iinfo(np.int64).max)


def test_every_text_of_a_doc_id_takes_part_and_keeps_what_is_its_own(spark):
    shared = " ".join(words(80, 41))
    rows = [(1, text(200, 42)), (1, shared + " " + text(30, 43)), (2, text(40, 44) + " " + shared), (3, text(200, 45))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.end_word - r.start_word, r.source_id) for r in repeated_passages(docs).collect()]
    assert got in ([(1, 80, 2)], [(2, 80, 1)])
    left = sorted((r.doc_id, len(r.text.split())) for r in without_repeats(docs).collect())
    assert left in ([(1, 30), (1, 200), (2, 120), (3, 200)], [(1, 110), (1, 200), (2, 40), (3, 200)])


def test_windows_of_more_places_than_packed_bits(monkeypatch):
    from barsight.llm import passages
    monkeypatch.setattr(passages, "_POS", 8)
    v = np.random.default_rng(8).integers(0, 2 ** 63, 5000).astype(np.uint64)
    left, mid, right = compact_windows(v, np.array([0]), np.array([5000]), 46)
    assert mid[0] == int(np.argmin(v)) and (left <= mid).all() and (mid <= right).all()


def test_passages_defined_cases(awkward, no_documents):
    got = {(r.doc_id, r.start_word, r.end_word, r.source_id) for r in repeated_passages(awkward).collect()}
    assert got == {(2, 0, 120, 1), (9, 0, 60, 1)} and WORDS == 50
    out = without_repeats(awkward)
    assert out.columns == awkward.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert 2 not in rows and rows[3].text is None and rows[4].text == "" and rows[9].n_chars == len(rows[9].text)
    assert repeated_passages(no_documents).count() == 0 and without_repeats(no_documents).count() == 0


def test_no_near_passage_is_ruled_out():
    rng, met = np.random.default_rng(12), 0
    for trial in range(150):
        w = rng.integers(0, (9, 40, 4000)[trial % 3], 140).astype(np.uint64)
        other = w.tolist()
        for _ in range(rng.integers(1, 8)):
            x, n = int(rng.integers(0, len(other))), int(rng.integers(0, 4))
            other[x:x + int(rng.integers(0, 4))] = (9000 + rng.integers(0, 99, n)).tolist() if rng.random() < 0.5 else w[x:x + n].tolist()
        words_of = [mix(w + np.uint64(7)), mix(np.array(other, np.uint64) + np.uint64(7))]
        a, b = (shingles(x, np.zeros(len(x), np.int64))[0] for x in words_of)
        again = recurring(words_of[0], np.zeros(len(w), np.int64), 1 << 40)
        anchors = np.flatnonzero(np.isin(a, b)).tolist()
        found = shared_runs(a, indexed(b), anchors)
        assert found == shared_runs(a, indexed(b), anchors, again)
        begin, end = gains(np.arange(len(a)), np.isin(a, b), again[:len(a)])
        for x, y, _, _ in found:
            met += 1
            one = lambda v: np.array([v])
            assert may_hold(begin, end, one(x), one(y), one(x), one(y)).all()
    assert met > 60


def test_texts_that_every_other_one_leaves_hopeless_are_ruled_out():
    shared = np.array([c == "#" for c in "#" * 14 + "." * 5 + "#" * 21 + "." * 5 + "#" * 9 + "." * 5 + "#" * 22])
    n, none = len(shared), np.zeros(len(shared), np.int8)
    assert may_meet(n, shared, none, [2, 45, 70]).tolist() == [False, False, False]
    assert may_meet(n, np.r_[shared[:40], np.ones(n - 40, bool)], none, [2, 45, 70]).all()
    begin, end = gains(np.arange(n), shared, none)
    ranges = np.array([[0, 5, 30, n - 1], [20, 60, 25, n - 1], [0, 80, 60, n - 1]])
    assert not may_hold(begin, end, *ranges.T).any()
    begin, end = gains(np.arange(n), np.ones(n, bool), none)
    assert may_hold(begin, end, *ranges.T).all()


def test_a_pair_is_compared_once(spark, monkeypatch):
    from barsight.llm import passages
    seen, pairs = [], passages._pairs
    monkeypatch.setattr(passages, "_pairs", lambda *x: seen.append(pairs(*x)) or seen[-1])
    base = words(150, 71)
    rows = [(i, edited(base, list(range(i % 23, 150, 23)), 900 + i)) for i in range(40)]
    repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count()
    met = [(r.doc_id, r.source_id) for x in seen for r in x.collect()]
    assert len(met) == len(set(met))
