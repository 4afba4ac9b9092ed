"""Near-duplicate groups by an LSH forest over MinHash signatures.

Documents with equal shingle sets form one class, with one MinHash signature.
Each tree of the forest is an order: it reads the values of the signature in a
fixed sequence of its own, and sorts the classes by them.  A region of a tree
is a prefix, at depth 4 or 8; the longer prefix of the same sequence divides
it.

In each region the classes stand in the tree's order, so the class before is
one with the longest common prefix; every class is compared with it, on the
full shingle sets.  That links the near copies of a family in chains.  Long
runs are cut by a salt into several chains, whose heads are compared with the
region's first.  Then, in regions that still hold several groups, the classes
of different groups are compared; links inside a group cannot change the
result.  Where a region has more than ``REGION`` classes, the comparison goes
through the rarest shingles: two sets at the threshold share one of them
(prefix filter), and what is left of both sets after it must be large enough
(position filter).  So nothing is left out, and thousands of near copies cost
no pair each.

The depth adapts to the region: one with more than ``REGION`` classes outside
its largest group is divided by the next depth's prefix.  As two sets agree on
a longer prefix more rarely, all classes of such a region enter that depth
with more trees, as many as two classes at the threshold need to share a
region in all but ``MISS`` of cases.  The last depth compares every region
through the rarest shingles.

Before texts are read, a pair is left out whose signatures agree in fewer
places than all but 2e-8 of the pairs at the threshold do.

Defined cases: a document without words (or with null text) has no shingles
and stands alone; a row with a null doc_id is linked with nothing and its
component is null; where doc_ids repeat, each row has the group of its own
text, and a repeated row (same id and text) has the same result each time.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.components import components
from ledgerlens.llm.shipping import ship
from ledgerlens.llm.tables import Tables
from ledgerlens.llm.text import mixed, shingle_set
from ledgerlens.session import ensure_checkpoint_dir

#: Jaccard similarity of a link, in hundredths.
SIMILARITY = 85
#: MinHash values of a class.
VALUES = 192
#: Values that a tree reads: crowded regions go to the next depth.
DEPTHS = (4, 8)
#: Share of the pairs at the threshold that may miss each other in all trees of a depth.
MISS = 1e-5
#: Classes outside the largest group of a region above which the region goes to the next depth.
REGION = 16
#: Classes of one chain, or of one part of a region, in a task.
RUN = 4096
#: Standard deviations below the threshold at which too few values of two signatures agree.
DEVIATIONS = 5.5
#: Documents whose ids are broadcast to the scan of the texts; more are joined by shuffle.
BROADCAST_IDS = 200_000

_ROWS = 2048


def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240607))
    high = np.iinfo(np.uint64).max
    return (rng.integers(1, high, count, np.uint64) | np.uint64(1), rng.integers(0, high, count, np.uint64))


_MUL, _ADD = _coefficients(VALUES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set, 16 bits each."""
    least = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _ROWS):
        np.minimum(least, (shingles[i:i + _ROWS, None] * _MUL + _ADD).min(axis=0), out=least)
    return (least >> np.uint64(48)).astype(np.uint16)


def tree_count(depth: int, similarity: int) -> int:
    """Trees of ``depth`` values drawn from a signature that two sets at the
    similarity need to miss each other in all with probability ``MISS`` or less."""
    p = similarity / 100
    agree = np.array([comb(VALUES, x) * p**x * (1 - p) ** (VALUES - x) for x in range(VALUES + 1)])
    apart = 1 - np.array([comb(x, depth) / comb(VALUES, depth) for x in range(VALUES + 1)])
    count = 1
    while (agree * apart**count).sum() > MISS:
        count += 1
    return count


def sequences(count: int) -> np.ndarray:
    """The sequence of positions in the signature that each tree reads."""
    return np.array([np.random.Generator(np.random.PCG64(tree)).choice(VALUES, DEPTHS[-1], replace=False)
                     for tree in range(count)])


def region_keys(values: np.ndarray, trees: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each signature (row of ``values``) and tree the hash of its prefix of ``depth`` values,
    and the values after it, as one number in their order."""
    read = values[:, trees].astype(np.uint64)
    key = np.arange(len(trees), dtype=np.uint64) * np.uint64(DEPTHS[-1] + 1) + np.uint64(depth)
    key = np.broadcast_to(key, read.shape[:2])
    for i in range(depth):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + read[:, :, i])
    rest = np.zeros(read.shape[:2], np.uint64)
    for i in range(depth, min(depth + 3, trees.shape[1])):
        rest = (rest << np.uint64(16)) | read[:, :, i]
    return key.view(np.int64), rest.view(np.int64)


@F.pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("set_key", T.StringType()),
                            T.StructField("signature", T.BinaryType())]))
def _sketch(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        s = shingle_set(text)
        rows.append((len(s), xxhash.xxh3_128_hexdigest(s.tobytes()), signature(s).tobytes()) if len(s)
                    else (0, None, None))
    return pd.DataFrame(rows, columns=["n", "set_key", "signature"])


def sketches(docs: DataFrame) -> DataFrame:
    """(id, fp, n, set_key, signature) of each document; set_key and signature are null without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("fp"),
                       _sketch("text").alias("sketch"))
    return rows.select("id", "fp", "sketch.n", "sketch.set_key", "sketch.signature")


def _linked(similarity: int):
    """Function of two texts: whether their shingle sets reach the similarity."""
    @F.pandas_udf(T.BooleanType())
    def linked(one: pd.Series, other: pd.Series) -> pd.Series:
        last, left, out = object(), None, []
        for x, y in zip(one, other, strict=True):
            if x is not last and x != last:
                last, left = x, shingle_set(x)
            right = shingle_set(y)
            both = len(np.intersect1d(left, right, assume_unique=True))
            out.append(100 * both >= similarity * (len(left) + len(right) - both))
        return pd.Series(out, dtype="bool")

    return linked


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingles(text: pd.Series) -> pd.Series:
    return text.map(lambda t: shingle_set(t).view(np.int64), na_action=None)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, fp, text) of the documents in ``wanted`` (distinct id, fp).  Few of
    them are sent to the scan, so that only their texts move; many are joined."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("fp"), "text")
    few = wanted.count() <= BROADCAST_IDS
    return texts.join(F.broadcast(wanted) if few else wanted, ["id", "fp"], "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id"), F.col("fa").alias("fp")).unionByName(
        pairs.select(F.col("b").alias("id"), F.col("fb").alias("fp"))).distinct()


def _joined(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``pairs`` with the ``value`` of both ends as x and y."""
    one = table.select(F.col("id").alias("a"), F.col("fp").alias("fa"), F.col(value).alias("x"))
    other = table.select(F.col("id").alias("b"), F.col("fp").alias("fb"), F.col(value).alias("y"))
    return pairs.join(one, ["a", "fa"]).join(other, ["b", "fb"])


def least_agreement(similarity: int) -> int:
    """Equal values of two signatures below which the sets are taken not to be similar enough."""
    p = similarity / 100
    return int(VALUES * p - DEVIATIONS * (VALUES * p * (1 - p)) ** 0.5)


def _agreeing(similarity: int):
    """Function of two signatures: whether enough of their values are equal."""
    least = least_agreement(similarity)

    @F.pandas_udf(T.BooleanType())
    def agreeing(one: pd.Series, other: pd.Series) -> pd.Series:
        if not len(one):
            return pd.Series([], dtype="bool")
        x, y = (np.frombuffer(b"".join(v), np.uint16).reshape(len(v), VALUES) for v in (one, other))
        return pd.Series((x == y).sum(axis=1) >= least)

    return agreeing


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, similarity: int, tables: Tables) -> DataFrame:
    """The pairs (a, fa, b, fb) whose full shingle sets reach the similarity, as (a, b) of (id, fp)."""
    likely = _joined(pairs, classes, "signature").where(_agreeing(similarity)("x", "y"))
    likely = tables.write(likely.select("a", "fa", "b", "fb"))
    texts = _texts(docs, tables.write(_ends(likely)))
    return (_joined(likely, texts, "text").where(_linked(similarity)("x", "y"))
            .select(F.struct(F.col("a").alias("id"), F.col("fa").alias("fp")).alias("a"),
                    F.struct(F.col("b").alias("id"), F.col("fb").alias("fp")).alias("b")))


def _regions(reps: DataFrame, depth: int, similarity: int) -> DataFrame:
    """(region, rest, id, fp, n, m): the region of each class in each tree of
    the depth, its place in the region's order, and how many classes the region
    has; regions of one class are left out."""
    trees = sequences(tree_count(depth, similarity))

    @F.pandas_udf(T.StructType([T.StructField("region", T.ArrayType(T.LongType())), T.StructField("rest", T.ArrayType(T.LongType()))]))
    def keys(signatures: pd.Series) -> pd.DataFrame:
        values = np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), VALUES)
        key, rest = region_keys(values, trees, depth)
        return pd.DataFrame({"region": list(key), "rest": list(rest)})

    rows = reps.select("id", "fp", "n", keys("signature").alias("keys"))
    rows = rows.select("id", "fp", "n", F.explode(F.arrays_zip("keys.region", "keys.rest")).alias("at"))
    rows = rows.select("at.region", "at.rest", "id", "fp", "n")
    shared = rows.groupBy(F.col("region").alias("k")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    # The estimate of the exploded rows' size leaves the trees out: unhinted, they could be broadcast.
    return rows.join(shared.hint("merge"), F.col("region") == F.col("k")).drop("k")


def _can_link(n, m, shared, similarity: int):
    """Whether sets of n and m shingles that share at most ``shared`` can be similar enough."""
    return 100 * shared >= similarity * (n + m - shared)


def _grouped(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``rows`` with ``g``, the group of each class by its (id, fp): the class itself where nothing is linked to it."""
    place = F.struct("id", "fp")
    if groups is None:
        return rows.withColumn("g", place)
    return (rows.join(groups, place == F.col("node"), "left")
            .withColumn("g", F.coalesce("component", place)).drop("node", "component"))


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Distinct ``pairs`` (a, fa, b, fb), smaller place first, without those compared before."""
    pairs = pairs.distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "fa", "b", "fb"], "left_anti")


def _pair(x, y) -> list:
    """Columns (a, fa, b, fb) of two (id, fp), the smaller first."""
    low, high = F.least(x, y), F.greatest(x, y)
    return [low["id"].alias("a"), low["fp"].alias("fa"), high["id"].alias("b"), high["fp"].alias("fb")]


def _neighbours(regions: DataFrame, similarity: int) -> DataFrame:
    """Pairs of each class with the one before it in the order of each of its
    regions, if they are of two groups.

    A region longer than ``RUN`` is cut by a salt into chains; their heads are
    paired with the region's first."""
    place = F.struct("id", "fp")
    salt = F.when(F.col("m") > RUN, F.pmod(F.xxhash64("fp", "id"), F.ceil(F.col("m") / RUN))).otherwise(F.lit(0))
    rows = regions.withColumn("salt", salt.cast("long"))
    before = Window.partitionBy("region", "salt").orderBy("rest", "id", "fp")
    chained = rows.select("n", "g", place.alias("x"), F.lag(F.struct(place.alias("y"), "n", "g")).over(before).alias("p"))
    chained = chained.select("x", F.col("p.y").alias("y"), "n", F.col("p.n").alias("pn"), "g", F.col("p.g").alias("pg"))
    heads = (rows.where(F.col("m") > RUN).groupBy("region", "salt")
             .agg(F.min(F.struct("rest", "id", "fp", "n", "g")).alias("h")))
    first = heads.groupBy(F.col("region").alias("r")).agg(F.min("h").alias("f"))
    tops = heads.join(first, F.col("region") == F.col("r")).select(
        F.struct("h.id", "h.fp").alias("x"), F.struct("f.id", "f.fp").alias("y"), F.col("h.n").alias("n"),
        F.col("f.n").alias("pn"), F.col("h.g").alias("g"), F.col("f.g").alias("pg"))
    return (chained.unionByName(tops)
            .where((F.col("g") != F.col("pg")) & _can_link(F.col("n"), F.col("pn"), F.least("n", "pn"), similarity))
            .select(*_pair(F.col("x"), F.col("y"))))


def _several_groups(placed: DataFrame) -> DataFrame:
    """The rows of regions that hold several groups, with ``main``, the largest
    of them, and how many classes are outside it (``others``)."""
    sizes = placed.groupBy("region", "g").agg(F.count(F.lit(1)).alias("c"))
    split = (sizes.groupBy("region").agg(F.max(F.struct("c", "g")).alias("top"), F.count(F.lit(1)).alias("groups"),
                                         F.sum("c").alias("members"))
             .where("groups > 1").select(F.col("region").alias("r"), F.col("top.g").alias("main"),
                                         (F.col("members") - F.col("top.c")).alias("others")))
    return placed.join(split, F.col("region") == F.col("r")).drop("r")


def _across_small(rows: DataFrame, similarity: int) -> DataFrame:
    """Pairs of classes of different groups of regions that have few classes."""
    other = rows.select(F.col("region").alias("r"), F.struct("id", "fp").alias("y"), F.col("n").alias("ny"), F.col("g").alias("gy"))
    return (rows.join(other, (F.col("region") == F.col("r")) & (F.col("g") != F.col("gy"))
                      & (F.struct("id", "fp") < F.col("y"))
                      & _can_link(F.col("n"), F.col("ny"), F.least("n", "ny"), similarity))
            .select(*_pair(F.struct("id", "fp"), F.col("y"))))


def _across_large(rows: DataFrame, docs: DataFrame, similarity: int, tables: Tables) -> DataFrame:
    """Pairs of classes of different groups of large regions that can be similar enough.

    Regions whose largest group is the same, ``main``, hold much the same
    classes and are compared together.  Each class's shingles are ordered from
    the rarest there to the most frequent; two sets at the threshold share one
    of the first n - threshold * n + 1, and after the first they share, both
    have enough left.  A class of the largest group meets only classes outside
    it.  A shingle of many classes is cut: one side is salted, the other enters
    every part.
    """
    members = tables.write(rows.select("main", "id", "fp", "g").distinct())
    sets = _texts(docs, members.select("id", "fp").distinct()).select(
        "id", "fp", _shingles("text").alias("s")).dropDuplicates(["id", "fp"])
    each = tables.write(members.join(sets, ["id", "fp"]).select("main", "id", "fp", "g", F.explode("s").alias("s")))
    often = each.groupBy("main", "s").agg(F.count(F.lit(1)).alias("d"), F.count_if(F.col("g") != F.col("main")).alias("o"))
    often = often.select(F.col("main").alias("om"), F.col("s").alias("os"), "d", "o")
    ordered = (each.join(often, (F.col("main") == F.col("om")) & (F.col("s") == F.col("os")))
               .groupBy("main", "id", "fp", "g").agg(F.sort_array(F.collect_list(F.struct("d", "s", "o"))).alias("all")))
    n = F.size("all")
    reach = n - F.ceil(n * F.lit(similarity) / 100).cast("int") + 1
    first = tables.write(ordered.select("main", "id", "fp", "g", n.alias("n"), F.posexplode(F.slice("all", F.lit(1), reach)).alias("at", "e"))
                         .where("e.d > 1 and e.o > 0")
                         .select("main", "id", "fp", "g", "n", "at", "e.s", F.ceil(F.col("e.d") / RUN).alias("parts")))
    salted = first.where("g <> main").withColumn("part", F.pmod(F.xxhash64("id", "fp"), "parts")).select(
        F.col("main").alias("m2"), F.col("s").alias("s2"), "part", F.struct("id", "fp").alias("y"),
        F.col("g").alias("gy"), F.col("n").alias("ny"), F.col("at").alias("aty"))
    spread = first.withColumn("in_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    place = F.struct("id", "fp")
    left = F.least(F.col("n") - F.col("at"), F.col("ny") - F.col("aty"))
    pairs = spread.join(salted, (F.col("main") == F.col("m2")) & (F.col("s") == F.col("s2")) & (F.col("in_part") == F.col("part"))
                        & (F.col("g") != F.col("gy")) & ((F.col("g") == F.col("main")) | (place < F.col("y")))
                        & _can_link(F.col("n"), F.col("ny"), left, similarity))
    return pairs.select(*_pair(place, F.col("y")))


def near_dedup(spark: SparkSession, docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, __fp, n_shingles, component_id) of each row; __fp is the hash of
    its text.  Classes of at least ``similarity`` (in hundredths) are linked."""
    ensure_checkpoint_dir(spark)
    ship(spark)
    tables = Tables(spark, "near-dedup")
    found = tables.write(sketches(docs))
    place = F.struct("id", "fp")
    rep = (found.where("set_key is not null and id is not null").groupBy("set_key")
           .agg(F.min(place).alias("rep")))
    of_class = found.drop("signature").join(rep, "set_key", "left")
    reps = classes = tables.write(
        found.where("id is not null").join(rep.select(F.col("rep.id").alias("id"), F.col("rep.fp").alias("fp")), ["id", "fp"], "left_semi")
        .select("id", "fp", "n", "signature").dropDuplicates(["id", "fp"]))

    links = groups = tried = None
    for depth in DEPTHS:
        regions = tables.write(_regions(reps, depth, similarity))
        chain = tables.write(_untried(_neighbours(_grouped(regions, groups), similarity), tried))
        tried = chain if tried is None else tried.unionByName(chain)
        new = tables.write(_confirmed(chain, classes, docs, similarity, tables))
        links = new if links is None else links.unionByName(new)
        groups = tables.write(components(spark, links))

        still = tables.write(_several_groups(_grouped(regions, groups)))
        tables.drop(regions)
        now = still if depth == DEPTHS[-1] else still.where(F.col("others") <= REGION)
        across = _across_small(now.where(F.col("m") <= REGION), similarity)
        large = now.where(F.col("m") > REGION)
        if not large.isEmpty():
            across = across.unionByName(_across_large(large, docs, similarity, tables))
        across = tables.write(_untried(across, tried))
        tried = tried.unionByName(across)
        # The groups that these links join are known at the next depth, after its chains, or at the end.
        links = links.unionByName(tables.write(_confirmed(across, classes, docs, similarity, tables)))
        deeper = still.where(F.col("others") > REGION).select("id", "fp").distinct()
        if depth == DEPTHS[-1] or deeper.isEmpty():
            break
        reps = tables.write(reps.join(deeper, ["id", "fp"], "left_semi"))
    groups = tables.write(components(spark, links))

    out = of_class.join(groups, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component.id", "rep.id", "id"))
    result = tables.write(out.select(F.col("id").alias("doc_id"), F.col("fp").alias("__fp"), F.col("n").alias("n_shingles"),
                                     component.alias("component_id")))
    tables.drop_all_but(result)
    return result
