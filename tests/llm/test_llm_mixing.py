import collections

import numpy as np
from llm_cases import ROWS, WORD, documents, empty, frame

from ledgerlens.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def shares(sizes, passes=3):
    """Targets by sharing the excess again and again; ``sizes`` in the sources' order."""
    total, weight = sum(sizes), [1 + i % 3 for i in range(len(sizes))]
    cut, target = set(), [0.0] * len(sizes)
    while True:
        left = total - sum(passes * sizes[i] for i in cut)
        free = sum(w for i, w in enumerate(weight) if i not in cut)
        target = [passes * s if i in cut else left * weight[i] / free for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in cut and target[i] > passes * s}
        if not over:
            return target
        cut |= over


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        for key in (0, 5, -3):
            out = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(out) == list(range(n))


def test_query_against_brute_force(spark):
    docs = documents(spark, SF)
    rows = queries.op2_mixing(spark, SF).collect()
    again = queries.op2_mixing(spark, SF).collect()
    assert sorted(rows) == sorted(again) and len(rows) == len(docs)
    words = {i: len(WORD.findall(r.text or "")) for i, r in docs.items()}
    by_source = collections.defaultdict(int)
    for i, r in docs.items():
        by_source[r.source] += words[i]
    names = sorted(by_source, key=lambda s: (s is None, s))
    target = dict(zip(names, shares([by_source[s] for s in names]), strict=True))
    taken = collections.defaultdict(int)
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == words[r.doc_id] and r.source_size == by_source[source]
        assert abs(r.target - target[source]) < 1e-6 * max(1, target[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= 1.5 * mixing.BLOCK


def test_targets_cut_and_shared(spark):
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate(
        [("a", 1000), ("b", 10), ("c", 20), (None, 5), ("é", 300), ("Z", 1)])]
    _, placed, sources = mixing.mix(spark, frame(spark, rows), with_text=False)
    got = [(r.source_size, r.target) for r in sources.orderBy("src").collect()]
    sizes = [1, 1000, 10, 20, 300, 5]  # Z a b c é null
    assert [g[0] for g in got] == sizes
    np.testing.assert_allclose([g[1] for g in got], shares(sizes))
    assert placed.count() == len(rows)


def test_pieces_hold_the_words(spark):
    """Each pass over a source gives each of its words once, in the pieces' texts."""
    rows = [(i, f"a{i} b{i}\n c{i}  d{i} " * (i % 9), "en", "xyz"[i % 3]) for i in range(60)]
    pieces, placed, _ = mixing.mix(spark, frame(spark, rows, clashing=True), block=16, keep=("score",))
    got = pieces.collect()
    texts = dict((i, WORD.findall(t)) for i, t, _, _ in rows)
    for p in got:
        assert WORD.findall(p["__piece"]) == texts[p.doc_id][p.from_word:p.to_word] and p.to_word > p.from_word
        assert p.score == f"own {p.doc_id}"
    filled = collections.Counter((p.shard, p.slot) for p in got)
    for (shard, slot) in filled:
        of = [p for p in got if (p.shard, p.slot) == (shard, slot)]
        assert len({(p.src, p.block) for p in of}) == 1 and sum(p.to_word - p.from_word for p in of) <= 16
    times = collections.Counter((p.src, p.block) for p in {(q.shard, q.slot, q.src, q.block): q for q in got}.values())
    assert max(times.values()) <= 3
    counts = mixing.shard_counts(pieces.select("shard", "slot", "src").distinct()).collect()
    assert sum(r.n for r in counts) == len(filled)


def test_defined_cases(spark):
    pieces, placed, sources = mixing.mix(spark, frame(spark, clashing=True), with_text=False)
    assert placed.count() == len(ROWS)
    assert sources.select("src").distinct().count() == 5
    assert {r.doc_id for r in pieces.collect()} & {1, 2, 3} == set()
    pieces, placed, sources = mixing.mix(spark, empty(spark))
    assert pieces.count() == placed.count() == sources.count() == 0


def test_slots_are_not_broadcast(spark):
    """A few rows that explode to all slots look small to Spark, which would send the slots through the driver."""
    docs = frame(spark, [(i, "word " * 700, "en", "s1") for i in range(40)])
    pieces, _, _ = mixing.mix(spark, docs, with_text=False)
    assert len(pieces.collect()) == sum(1 for _ in pieces.toLocalIterator()) > 200
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [src" in plan and "BroadcastHashJoin [src" not in plan
