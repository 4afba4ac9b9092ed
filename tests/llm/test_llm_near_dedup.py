import random

import numpy as np
from llm_cases import ROWS, documents, empty, frame, near_components, shingles

from ledgerlens.llm import near_dedup, queries, text
from ledgerlens.llm.components import components

SF = "/root/testdata/sf0.001"


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    truth = near_components({i: r.text for i, r in documents(spark, SF).items()})
    rows = queries.op3_near_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == truth
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_links_of_a_larger_table(spark):
    """Recall of links on the next size: every component of two or more is found."""
    folder = "/root/testdata/sf0.01"
    truth = near_components({i: r.text for i, r in documents(spark, folder).items()})
    got = found(queries.op3_near_dedup(spark, folder))
    linked = {i for i, (_, c) in truth.items() if c != i}
    assert len(linked) > 20 and sum(got[i] == truth[i] for i in linked) >= 0.99 * len(linked)
    assert all(got[i][1] >= truth[i][1] for i in truth)


def test_rarest_shingles_find_what_a_crowded_region_holds(spark):
    """The comparison of large regions alone: pairs at the threshold, none inside the largest group."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    texts = {i: " ".join(base[:rnd.randrange(60, 100)] + [f"x{rnd.randrange(6)}.{j}" for j in range(rnd.randrange(0, 40))])
             for i in range(60)}
    docs = frame(spark, [(i, t, "en", "s") for i, t in texts.items()])
    tables = near_dedup.Tables(spark, "test")
    classes = near_dedup.sketches(docs).selectExpr("id", "fp", "n", "if(id < 25, struct(0L as id, 0L as fp), struct(id, fp)) as g")
    rows = classes.selectExpr("*", "struct(0L as id, 0L as fp) as main")
    got = {(r.a, r.b) for r in near_dedup._across_large(rows, docs, 85, tables).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    want = {(i, j) for i in sets for j in sets if i < j and not j < 25
            and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert want and want <= {(min(p), max(p)) for p in got}
    assert not any(a < 25 and b < 25 for a, b in got)


def test_hot_group_of_near_copies(spark):
    """More near copies than a region holds, copies of one of them, and a
    second family that shares most of a passage but is not similar enough."""
    rnd = random.Random(3)
    base = [f"t{rnd.randrange(500)}" for _ in range(120)]
    texts = {}
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randrange(0, 3)):
            w[rnd.randrange(len(w))] = f"edit{i}"
        texts[i] = " ".join(w)
    for i in range(60, 90):
        texts[i] = texts[7].upper()
    for i in range(90, 120):
        texts[i] = " ".join(base[:90] + [f"own{i}.{j}" for j in range(30)])
    docs = frame(spark, [(i, t, "en", "s") for i, t in texts.items()])
    assert found(near_dedup.near_dedup(spark, docs)) == near_components(texts)


def test_pairs_in_regions_that_are_crowded_at_every_depth(spark):
    """All texts share a passage that alone is not enough for a link (100 of
    120 shingles); two and two share enough besides it (102 of 118)."""
    passage = [f"p{i}" for i in range(104)]
    texts = {}
    for i in range(200):
        for j in (2 * i, 2 * i + 1):
            texts[j] = " ".join([*passage, f"both{i}", f"same{i}", *(f"own{j}.{x}" for x in range(8))])
    docs = frame(spark, [(i, t, "en", "s") for i, t in texts.items()])
    assert found(near_dedup.near_dedup(spark, docs)) == {i: (110, i - i % 2) for i in texts}


def test_trees_suffice_at_every_depth():
    for similarity in (80, 85):
        counts = [near_dedup.tree_count(d, similarity) for d in near_dedup.DEPTHS]
        assert counts == sorted(counts)
        for d, count in zip(near_dedup.DEPTHS, counts, strict=True):
            assert (1 - (similarity / 100) ** d) ** count <= 1e-5


def test_one_id_on_different_texts(spark):
    base = [f"t{i}" for i in range(120)]
    other = " ".join(f"u{i}" for i in range(60))
    docs = frame(spark, [(3, " ".join(base), "en", "s"), (5, " ".join(base[:118]), "en", "s"), (5, other, "en", "s"),
                         (8, other + " end", "en", "s")])
    rows = near_dedup.near_dedup(spark, docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [
        (3, 116, 3), (5, 56, 5), (5, 114, 3), (8, 57, 5)]


def test_defined_cases(spark):
    rows = near_dedup.near_dedup(spark, frame(spark, clashing=True)).collect()
    assert len(rows) == len(ROWS)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert got[None][0][1] is None
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert got[5][0] == got[5][1] and got[5][0][1] == 5
    assert got[10] == [(1, 10)] and got[11] == [(1, 10)]
    assert near_dedup.near_dedup(spark, empty(spark)).count() == 0


def test_shingle_set_size_is_exact():
    for _, t, _, _ in ROWS:
        assert len(text.shingle_set(t)) == len(shingles(t))


def test_signature_agreement_follows_similarity():
    one = text.shingle_set(" ".join(map(str, range(1000))))
    other = text.shingle_set(" ".join(map(str, range(100, 1100))))
    both = len(np.intersect1d(one, other))
    share = np.mean(near_dedup.signature(one) == near_dedup.signature(other))
    assert abs(share - both / (len(one) + len(other) - both)) < 0.1


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(spark, df).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}}
    assert components(spark, df.where("false")).count() == 0


def test_regions_are_not_broadcast(spark):
    """A class stands in a row for each tree, which Spark's estimate of the rows' size leaves out."""
    docs = frame(spark, [(i, f"common words of a short text number {i % 3}", "en", "s1") for i in range(9)])
    reps = near_dedup.sketches(docs).where("signature is not null")
    regions = near_dedup._regions(reps, near_dedup.DEPTHS[0], near_dedup.SIMILARITY)
    assert regions.count() > 0
    plan = regions._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
