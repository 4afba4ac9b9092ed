import pytest
from llm_cases import ROWS, WORD, empty, frame, near_components

import corpus_pipeline as P
from ledgerlens.llm import segmentation

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for n, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        assert after.columns == docs.columns
        before, rows = docs.collect(), after.collect()
        if n == 0:
            labels = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            assert len(gone & labels) <= 0.05 * len(labels)
        elif n == 1:
            assert {r.doc_id for r in rows} == {r.doc_id for r in before}
            assert sum(len(r.text) for r in rows) < sum(len(r.text) for r in before)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif n == 2:
            truth = near_components({r.doc_id: r.text for r in before}, P.SIMILARITY)
            assert {r.doc_id for r in rows} == {i for i, (_, c) in truth.items() if i == c}
        else:
            texts = {r.doc_id: r.text for r in before}
            for r in rows:
                assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
            words = sum(len(WORD.findall(t)) for t in texts.values())
            mixed = sum(len(WORD.findall(r.text)) for r in rows)
            assert abs(mixed / words - 1) < 0.1
        docs = after
    samples = segmentation.decode(P.STAGES[-1][1](spark, docs, SF)).collect()
    assert {(r.doc_id, r["__text"]) for r in samples} == {(r.doc_id, r.text) for r in docs.collect()}


def test_run_is_the_stages(spark):
    assert P.run(spark, SF).count() > 0
    assert 4 <= len(P.STAGES) <= 5


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_awkward_rows(spark, name, stage):
    out = stage(spark, frame(spark, clashing=True), SF)
    rows = out.collect()
    if stage is not P.segment:
        assert out.columns == frame(spark, clashing=True).columns
    if stage is P.drop_near_copies:
        assert sorted(str(r.doc_id) for r in rows) == sorted({str(r[0]) for r in ROWS} - {"11", "6"} | (
            {"6"} if near_components({5: ROWS[5][1], 6: ROWS[7][1]})[6][1] == 6 else set()))
    assert stage(spark, empty(spark), SF).count() == 0


def test_copies_between_the_thresholds_go(spark):
    """Similar by 100 of 120 shingles, below op3's 0.85, and by 100 of 130, below 0.8."""
    passage = [f"p{i}" for i in range(104)]
    texts = [(1, " ".join(passage + [f"a{i}" for i in range(10)])), (2, " ".join(passage + [f"b{i}" for i in range(10)])),
             (3, " ".join(passage + [f"c{i}" for i in range(20)]))]
    docs = frame(spark, [(i, t, "en", "s") for i, t in texts])
    assert {r.doc_id for r in P.drop_near_copies(spark, docs, SF).collect()} == {1, 3}
