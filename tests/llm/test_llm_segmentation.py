import collections
import math

import numpy as np
import pytest
from llm_cases import LONG, ROWS, empty, frame

from ledgerlens.llm import segmentation as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def voc():
    return S.vocabulary()


def all_segmentations(voc, word):
    first = 3 + 256  # after control and byte pieces
    pieces = {p.replace(S.BLANK, " "): i for i, p in enumerate(voc.pieces) if i >= first}

    def rec(i):
        if i == len(word):
            yield ()
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in pieces:
                yield from ((pieces[word[i:j]], *rest) for rest in rec(j))
    return list(rec(0))


def test_distribution_without_replacement(voc):
    """First and second sample follow the exact probabilities."""
    alpha, n = 0.0001, 8000
    ways = all_segmentations(voc, " then")
    weight = np.array([alpha * voc.scores[list(w)].sum() for w in ways])
    p = np.exp(weight - weight.max())
    p /= p.sum()
    got = S.sample_batch(["then"] * n, list(range(n)), 2, voc, alpha)
    first = collections.Counter(tuple(x[0][0]) for x in got)
    second = collections.Counter(tuple(x[1][0]) for x in got)
    for i, w in enumerate(ways):
        after = sum(p[j] * p[i] / (1 - p[j]) for j in range(len(ways)) if j != i)
        assert abs(first[w] / n - p[i]) < 0.02 and abs(second[w] / n - after) < 0.02
    for x in got[:50]:
        assert abs(x[0][1] - math.log(p[ways.index(tuple(x[0][0]))])) < 1e-9


def test_all_segmentations_in_order_and_once(voc):
    ways = all_segmentations(voc, " cats")
    got = S.sample_batch(["cats"], [11], 1000, voc)[0]
    assert sorted(tuple(x[0]) for x in got) == sorted(ways)
    assert all(a[2] >= b[2] for a, b in zip(got, got[1:], strict=False))
    assert all(x[3] is None for x in got)
    assert abs(sum(math.exp(x[1]) for x in got) - 1) < 1e-9


def test_inclusion_estimates_are_unbiased(voc):
    """Mean of 1/inclusion over the sampled is the number of segmentations."""
    ways, alpha = len(all_segmentations(voc, " then")), 0.00002
    sums = [sum(1 / math.exp(x[3]) for x in s) for s in S.sample_batch(["then"] * 4000, list(range(4000)), 4, voc, alpha)]
    assert abs(np.mean(sums) / ways - 1) < 0.1


def test_round_trip_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = S.decode(S.encode(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r["__text"] == texts[r.doc_id] and r.n_pieces == len(r.ids) for r in rows)
    by_doc = collections.defaultdict(dict)
    for r in rows:
        by_doc[r.doc_id][r.sample] = r
    for samples in by_doc.values():
        assert set(samples) == {1, 2}
        assert samples[1].ids != samples[2].ids and samples[1].perturbed >= samples[2].perturbed


def test_order_and_batches_do_not_matter(voc, monkeypatch):
    texts = ["first text here", "another one", "third\nof these"]
    one = S.sample_batch(texts, [1, 2, 3], 3, voc)
    other = [S.sample_batch([t], [s], 3, voc)[0] for t, s in zip(texts, [1, 2, 3], strict=True)]
    assert [[tuple(x[0]) for x in s] for s in one] == [[tuple(x[0]) for x in s] for s in other]


def test_defined_cases(spark, voc):
    rows = S.encode(frame(spark, clashing=True), k=3).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert 1 not in by_doc and len(by_doc[None]) == 3 and len(by_doc[5]) == 6
    assert [(r.n_pieces, r.ids, r.log_prob) for r in by_doc[2]] == [(0, [], 0.0)]
    assert sorted(tuple(r.ids) for r in by_doc[5])[::2] == sorted(tuple(r.ids) for r in by_doc[5])[1::2]
    texts = {i: t for i, t, _, _ in ROWS}
    for i, samples in by_doc.items():
        assert all(voc.decode(r.ids) == texts[i] for r in samples if texts[i])
    assert len(by_doc[4][0].ids) > len(LONG.split())
    assert S.encode(empty(spark)).count() == 0


def test_lattices_are_shared_and_single_edges_draw_no_noise(voc, monkeypatch):
    built, drawn, whole, edges = [], [], S.Lattices, S._edges
    monkeypatch.setattr(S, "Lattices", lambda words, *rest: built.append(len(words)) or whole(words, *rest))
    monkeypatch.setattr(S, "_edges", lambda lat, node, key: drawn.append(int(lat.degree[node].min())) or edges(lat, node, key))
    monkeypatch.setattr(S, "PART_CHARS", 10)
    got = S.sample_batch(["one text here", "here one text", "丁 text"], [1, 2, 3], 2, voc)
    assert built == [4] and drawn and min(drawn) > 1     # one build for three parts
    assert [voc.decode(x[0]) for s in got for x in s] == [t for t in ("one text here", "here one text", "丁 text") for _ in range(2)]
