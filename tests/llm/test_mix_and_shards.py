"""Mixing and sharding: laws, quotas, defined cases."""
import collections
import itertools

from barsight.llm.mixing import BLOCK_WORDS, apportion, mix, mixed_documents, with_targets
from barsight.llm.sharding import flows, shard
from tests.llm.conftest import text


def brute_targets(sizes):
    names = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    weight = dict(zip(names, itertools.cycle((5, 2, 1))))
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [k for k in names if k not in capped]
        rest = total - sum(capped.values())
        target = {k: rest * weight[k] / sum(weight[x] for x in open_) for k in open_}
        over = [k for k in open_ if target[k] > 2 * sizes[k]]
        if not over:
            return capped | target
        capped |= {k: 2.0 * sizes[k] for k in over}


def test_targets_seats_and_takes(spark):
    sizes = {"a": 40, "b": 9, "c": 30, None: 25, "": 12, "é": 60}
    rows = [(i, s, text(50 + i % 90, i)) for i, s in enumerate(k for k, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    words = collections.Counter()
    for _, s, t in rows:
        words[s] += len(t.split())
    want = brute_targets(words)
    got = mix(docs).collect()
    source = {i: s for i, s, _ in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == words[s] and abs(r.target - want[s]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 3 * BLOCK_WORDS for s in words)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs.repartition(5)).collect()), key=str)
    out = mixed_documents(docs.withColumn("n_chars", docs.doc_id))
    held = collections.Counter()
    for r in out.collect():
        held[r.source] += len(r.text.split())
    assert held == taken and out.columns == ["doc_id", "source", "text", "n_chars"]


def test_repeated_rows_each_take_their_own_part(spark):
    rows = [(i, "a", text(60 + 7 * i, i)) for i in range(10) for _ in range(3)] + [(50 + i, "b", text(90, 80 + i)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken = mix(docs).agg({"taken": "sum"}).first()[0]
    assert sum(len(r.text.split()) for r in mixed_documents(docs).collect()) == taken


def test_seats_are_the_highest_quotients(spark):
    rows = [(False, "a", 70.0, 9), (False, "b", 21.0, 50), (False, "c", 6.0, 50), (True, "", 3.0, 50)]
    sources = spark.createDataFrame(rows, "no_source boolean, source string, target double, cap long")
    houses = [0, 1, 4, 11, 25]
    got = collections.defaultdict(dict)
    for r in apportion(sources, houses).collect():
        got[r.house][r.source] = r.seats
    for h, size in enumerate(houses):
        quotients = sorted(((-t / (2 * k + 1), s) for _, s, t, cap in rows for k in range(cap)))[:size]
        want = collections.Counter(s for _, s in quotients)
        assert got[h] == {s: want[s] for _, s, _, _ in rows}


def test_mixing_defined_cases(spark, awkward, no_documents):
    got = mix(awkward).collect()
    assert len(got) == 13 and all(r.taken <= 2 * r.size for r in got)
    out = mixed_documents(awkward)
    assert out.columns == awkward.columns and all(r.text.split() for r in out.collect())
    assert mix(no_documents).count() == 0 and mixed_documents(no_documents).count() == 0
    empty = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert {(r.target, r.taken) for r in mix(empty).collect()} == {(0.0, 0)}


def check_shards(rows, n, shards):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    assert len(rows) == n and all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[j]) for j in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_are_even_and_keep_copies_together(spark):
    rows = [(i, text(5, i)) for i in range(400)] + [(1000 + i, text(5, 2000 + i // 3)) for i in range(90)]
    rows += [(5000 + i, "hot") for i in range(245)]             # a third of all rows
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, len(rows), 10)
    texts, where = dict(rows), collections.defaultdict(set)
    for r in got:
        where[texts[r.doc_id]].add(r.shard)
        assert r.size == len(texts[r.doc_id].encode()) + 16
    hot = collections.Counter(r.shard for r in got if texts[r.doc_id] == "hot")
    assert sum(n for _, n in hot.most_common(5)) >= 200
    assert sum(len(where[text(5, 2000 + k)]) == 1 for k in range(30)) >= 27


def test_copies_meet_where_every_row_has_one(spark):
    rows = [(i, text(5, i // 2)) for i in range(2000)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, len(rows), 10)
    where = {r.doc_id: r.shard for r in got}
    assert sum(where[i] != where[i + 1] for i in range(0, 2000, 2)) <= 10


def test_flows_keep_the_room():
    asked = {(0, 1): 5, (1, 0): 3, (1, 2): 4, (2, 0): 1, (3, 2): 9, (2, 4): 2}
    free = [0, 0, 0, 0, 3]
    got = flows(asked, free)
    into, out = collections.Counter(), collections.Counter()
    for (i, j), c in got.items():
        assert 0 < c <= asked[i, j]
        into[j] += c
        out[i] += c
    assert all(into[j] - out[j] <= free[j] for j in range(5))
    assert got[0, 1] == 4 and got[1, 0] == 3 and got[2, 4] == 2 and got[3, 2] + got[1, 2] == 3


def test_sharding_defined_cases(awkward, no_documents):
    got = shard(awkward).collect()
    check_shards(got, 13, 40)
    by = {r.doc_id: r for r in got}
    assert by[3].size == 16 and by[3].text_crc32 is None and by[4].text_crc32 == 0
    assert shard(no_documents).count() == 0
