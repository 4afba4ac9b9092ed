import collections
import random

import duckdb
from llm_cases import ROWS, empty, frame

from ledgerlens.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    rows = queries.op6_toxicity(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    bad, good = ([r for r in held if labels[r.doc_id] == y] for y in (1, 0))
    wins = sum((b.score > g.score) + 0.5 * (b.score == g.score) for b in bad for g in good)
    assert wins / (len(bad) * len(good)) > 0.7
    assert sum(r.predicted for r in good) <= 0.05 * len(good)


def test_features():
    names = toxicity.FEATURES
    f = dict(zip(names, toxicity.text_features("YOU are an IDIOT!! and a m0r0n"), strict=True))
    assert f["insults_per_word"] == 1 / 7 and f["insults_near_second_person"] == 1 / 7
    assert f["obfuscated_insults"] == 1 / 7 and f["shouted_words"] == 2 / 7 and f["exclamations"] == 2 / 7
    assert toxicity.text_features(None) == toxicity.text_features("") == [0.0] * len(names)


def test_defined_cases(spark):
    many = [(100 + i, f"{'you idiot moron scum' if i % 3 == 0 else 'a calm line of plain words'} number {i}", "en", "s")
            for i in range(120)]
    docs = frame(spark, ROWS + many, clashing=True)
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(120)] + [(None, 1), (100, None), (101, 0)],
                                   "doc_id long, toxic int")
    rows = toxicity.toxicity(spark, docs, labels).collect()
    assert len(rows) == len(ROWS) + 120
    score = {r.doc_id: r["__score"] for r in rows}
    assert score[8] > 0.3 > score[101] and score[1] == score[2] == score[3]
    assert all(r.score == f"own {-1 if r.doc_id is None else r.doc_id}" for r in rows)
    one_class = labels.where("toxic = 1")
    assert {r["__score"] for r in toxicity.toxicity(spark, docs, one_class).collect()} == {1.0}
    assert {r["__score"] for r in toxicity.toxicity(spark, docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.toxicity(spark, empty(spark), labels).count() == 0


def test_held_out_recall_by_language(spark):
    """On the larger table: the learned lexicon finds toxic documents of every language, clean ones stay."""
    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    held = [r for r in queries.op6_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    good = [r for r in held if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in good) <= 0.05 * len(good)
    for code in ("en", "de", "fr", "es"):
        bad = [r for r in held if labels[r.doc_id] == 1 and lang[r.doc_id] == code]
        assert sum(r.predicted for r in bad) >= 0.75 * len(bad), code
    bad = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in bad) >= 0.9 * len(bad)


def test_learned_words_against_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(200):
        label = int(i % 4 == 0)
        words = rnd.choices(["alpha", "Beta", "gamma,", "übel"], k=5) + (["grobi"] * 2 + ["Frotz!"] if label else [])
        words += ["frotz"] if i % 40 == 1 else []
        rows.append((float(label), i % toxicity.PARTS, " ".join(words)))
    rows.append((1.0, 0, None))
    got = toxicity.learn(spark.createDataFrame(rows, "label double, part int, __text string"))
    for part in [*range(toxicity.PARTS), None]:
        bad, good = collections.Counter(), collections.Counter()
        for label, p, text in rows:
            if p != part:
                (bad if label else good).update(set(toxicity.text_words(text)))
        want = {w for w, n in bad.items() if n >= toxicity.LEARNED_DOCS and n >= toxicity.LEARNED_SHARE * (n + good[w])}
        assert got[toxicity.PARTS if part is None else part] == want
    assert got[-1] == {b"grobi", b"frotz"}


def test_learned_features():
    f = dict(zip(toxicity.FEATURES, toxicity.text_features("Du bist ein GROBI, fr0tz!", frozenset([b"grobi", b"frotz"])), strict=True))
    assert f["learned_per_word"] == 1 / 5 and f["learned_near_second_person"] == 1 / 5 and f["distinct_learned"] == 1
    assert f["obfuscated_insults"] == 1 / 5 and f["insults_per_word"] == 0
