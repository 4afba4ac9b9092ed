import collections
import zlib

from llm_cases import ROWS, documents, empty, frame

from ledgerlens.llm import queries, sharding
from ledgerlens.llm.ordering import ranked

SF = "/root/testdata/sf0.001"


def check(rows, n, shards=8):
    count = collections.Counter(r.shard for r in rows)
    assert sum(count.values()) == n and max(count.values()) - min(count.get(s, 0) for s in range(shards)) <= 1
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))


def test_query(spark):
    docs = documents(spark, SF)
    rows = queries.op5_sharding(spark, SF).collect()
    check(rows, len(docs))
    for r in rows:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert sorted(rows) == sorted(queries.op5_sharding(spark, SF).collect())


def test_mixture_of_every_shard_with_a_hot_source(spark):
    rows = [(i, f"t{i % 50}", "en", "hot" if i % 3 == 0 else f"s{i % 41}") for i in range(4000)]
    got = sharding.interleave(frame(spark, rows), bucket_rows=100).collect()
    check(got, len(rows))
    total = collections.Counter(r[3] for r in rows)
    for s in range(8):
        of = collections.Counter(r.source for r in got if r.shard == s)
        assert all(abs(of[k] - n / 8) <= 2 for k, n in total.items())


def test_defined_cases(spark):
    got = sharding.interleave(frame(spark, clashing=True)).collect()
    check(got, len(ROWS))
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.interleave(empty(spark)).count() == 0
    one = sharding.interleave(frame(spark, ROWS[:1])).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_ranked_sums_in_buckets(spark):
    df = spark.createDataFrame([("g", i // 10, i, i % 4) for i in range(95)] + [("k", 3, 1, 7)],
                               "g string, bucket long, i long, size long")
    got = {(r.g, r.i): (r["__rank"], r["__start"]) for r in ranked(df, ["g"], "bucket", ["i"], "size").collect()}
    assert got[("k", 1)] == (0, 0)
    assert all(got[("g", i)] == (i, sum(j % 4 for j in range(i))) for i in range(95))


def test_rows_without_an_id_are_spread(spark):
    """A third of the rows have no id and one source: their texts tell them apart."""
    from pyspark.sql import functions as F
    rows = [(None if i % 3 == 0 else i, f"text {i}", "en", "s") for i in range(3000)]
    docs = frame(spark, rows)
    src = sharding.null_safe(F.col("source"))
    got = sharding.interleave(docs, bucket_rows=50).collect()
    check(got, 3000)
    hashes = docs.select(F.xxhash64(F.lit(5), "doc_id", src, F.coalesce("text", F.lit(""))).alias("h"))
    sizes = hashes.groupBy(F.pmod("h", F.lit(60))).count().agg(F.max("count")).first()[0]
    assert sizes < 120
