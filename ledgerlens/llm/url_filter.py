"""Filtering urls by rules kept as a sorted array of digests.

A rule is a host and the beginning of a path (``example.org/es/``) with an
action; it fits its host and all subdomains, and the longest rule wins (of
equal ones that of the longer host; of one rule with two actions, block).  A
label rule (``*cheap-pills``) decides urls that no other rule fits, by one label of
their host.

The rules become entries: one for each host, listing the lengths of its paths,
one for each whole rule, and one for each label.  Spark sorts the entries by a
64-bit xxhash and writes them, ``SEGMENT`` a file, to the shared folder;
each executor gets the files as Spark files and maps them into memory
(beside Spark's own copy, made again by any new executor), so memory holds only the pages in
use.  A url's host gives its suffixes, probed by binary search for a whole
batch; each known host gives the path lengths to look up, and these probes
go through the array again.  A hit counts only if the stored string is the
one that was looked up, so collisions of digests never decide anything.

Defined cases: a null url, or one without ``://``, has an empty host and path;
an empty host fits no rule; urls that no rule and no label decides are
allowed; repeated rows are judged alike; without rules all urls are allowed.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.spelling import lower_ascii
from ledgerlens.session import ensure_checkpoint_dir

# The rules of the registered query, action and rule.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
# Labels of hosts that stand for spam, betting, pills, adult pages and advertisements.
LABELS = ("ads-track", "adserver", "adult-x", "adult", "casino", "casino-win", "cheap-pills", "free-bets", "free-pills",
          "malware", "phishing", "poker-win", "porn", "spam", "spam-farm", "xxx")

ALLOW, BLOCK = "allow", "block"
#: Entries of one array (one file): bounds what a task of the build sorts and what one map holds.
SEGMENT = 4_000_000
#: Seed of the digests, that of Spark's own xxhash64.
SEED = 42


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def entries(rules: DataFrame) -> DataFrame:
    """(key, payload) of ``rules`` (action, rule): whole rules and labels with their action, hosts with path lengths."""
    known = rules.where(F.col("rule").isNotNull() & F.col("action").isin(ALLOW, BLOCK))
    whole = known.groupBy(F.col("rule").alias("key")).agg(F.max("action").alias("payload"))
    paths = whole.where(F.contains("key", F.lit("/")))
    host, cut = F.substring_index("key", "/", 1), F.length("key") - F.length(F.substring_index("key", "/", 1))
    lengths = (paths.select(host.alias("key"), cut.alias("n")).groupBy("key")
               .agg(F.array_join(F.sort_array(F.collect_set("n")), ",").alias("payload")))
    labels = whole.where(F.startswith("key", F.lit("*")))
    return paths.unionByName(labels).unionByName(lengths)


def publish(spark: SparkSession, rules: DataFrame, segment: int = SEGMENT) -> list[str]:
    """Write the sorted arrays to the shared folder, hand them to the executors and name the files in order."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/url-rules-{uuid.uuid4().hex}"
    rows = entries(rules).withColumn("digest", F.xxhash64("key")).checkpoint()
    files = max(1, -(-rows.count() // segment))
    rows.repartitionByRange(files, "digest").sortWithinPartitions("digest", "key").write.parquet(folder)
    written = spark.read.parquet(folder)
    first = written.groupBy(F.input_file_name().alias("file")).agg(F.min("digest").alias("least"))
    names = []
    for row in first.orderBy("least").collect():
        spark.sparkContext.addFile(row["file"])
        names.append(row["file"].rsplit("/", 1)[1])
    return names


class _Array:
    """One sorted array: digests, and their keys and payloads as offsets into one run of bytes, all memory-mapped."""

    def __init__(self, name: str):
        source = SparkFiles.get(name)
        folder = f"{source}.mapped"
        if not os.path.isdir(folder):
            self._unpack(source, folder)
        self.digests = np.load(f"{folder}/digests.npy", mmap_mode="r")
        self.ends = np.load(f"{folder}/ends.npy", mmap_mode="r")
        self.bytes = np.load(f"{folder}/bytes.npy", mmap_mode="r")

    @staticmethod
    def _unpack(source: str, folder: str) -> None:
        table = pq.read_table(source, columns=["digest", "key", "payload"])
        texts = [x.encode() for pair in zip(table["key"].to_pylist(), table["payload"].to_pylist(), strict=True) for x in pair]
        mine = tempfile.mkdtemp(dir=os.path.dirname(folder))
        np.save(f"{mine}/digests.npy", table["digest"].to_numpy())
        np.save(f"{mine}/ends.npy", np.cumsum([0, *map(len, texts)]))
        np.save(f"{mine}/bytes.npy", np.frombuffer(b"".join(texts), np.uint8))
        try:
            os.rename(mine, folder)
        except OSError:  # another worker of this executor was first
            shutil.rmtree(mine, ignore_errors=True)

    def text(self, i: int) -> str:
        return self.bytes[self.ends[i]:self.ends[i + 1]].tobytes().decode()


class Digests:
    """Look-up of strings in the published arrays."""

    def __init__(self, names: list[str]):
        self.arrays = [_Array(name) for name in names]
        self.first = np.array([a.digests[0] for a in self.arrays[1:]], np.int64)

    def find(self, keys: list[str], digest=None) -> list[str | None]:
        """The payload of each key, None where it is not stored."""
        digest = digest or (lambda k: xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), SEED))
        hashes = np.fromiter(map(digest, keys), np.uint64, len(keys)).view(np.int64)
        found: list[str | None] = [None] * len(keys)
        if not self.arrays:
            return found
        part = np.searchsorted(self.first, hashes, "right")
        for number in np.unique(part):
            array, rows = self.arrays[number], np.flatnonzero(part == number)
            begin, end = (np.searchsorted(array.digests, hashes[rows], side) for side in ("left", "right"))
            for hit in np.flatnonzero(begin < end):
                key = keys[rows[hit]]
                for i in range(begin[hit], end[hit]):
                    if array.text(2 * i) == key:
                        found[rows[hit]] = array.text(2 * i + 1)
        return found


def judge(hosts: list[str], paths: list[str], digests: Digests) -> list[tuple[str | None, str]]:
    """(rule, verdict) of each url."""
    distinct = sorted(set(hosts) - {""})
    parts = {h: h.split(".") for h in distinct}
    suffixes = [(h, ".".join(p[i:])) for h, p in parts.items() for i in range(len(p))]
    known: dict[str, list[tuple[str, int]]] = {}
    for (h, suffix), lengths in zip(suffixes, digests.find([s for _, s in suffixes]), strict=True):
        if lengths is not None:
            known.setdefault(h, []).extend((suffix, int(n)) for n in lengths.split(","))
    labels = [(h, f"*{label}") for h, p in parts.items() for label in p]
    by_label: dict[str, str] = {}
    for (h, _), action in zip(labels, digests.find([k for _, k in labels]), strict=True):
        if action is not None:
            by_label[h] = max(action, by_label.get(h, ALLOW))
    probes = [(row, f"{suffix}{path[:n]}", len(suffix)) for row, (h, path) in enumerate(zip(hosts, paths, strict=True))
              for suffix, n in known.get(h, ()) if len(path) >= n]
    best: dict[int, tuple[int, int, str, str]] = {}
    for (row, rule, n), action in zip(probes, digests.find([r for _, r, _ in probes]), strict=True):
        if action is not None:
            best[row] = max(best.get(row, (0, 0, "", "")), (len(rule), n, rule, action))
    return [best[row][2:] if row in best else (None, by_label.get(h, ALLOW)) for row, h in enumerate(hosts)]


def url_filter(spark: SparkSession, pages: DataFrame, rules: DataFrame, url: str = "url", segment: int = SEGMENT) -> DataFrame:
    """``pages`` with ``__url``: a struct of host, path, rule (null where none fits) and verdict of each url."""
    ensure_checkpoint_dir(spark)
    ship(spark)
    names = json.dumps(publish(spark, rules, segment))
    opened: list[Digests] = []

    @F.pandas_udf(T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]))
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        if not opened:
            opened.append(Digests(json.loads(names)))
        return pd.DataFrame(judge(host.tolist(), path.tolist(), opened[0]), columns=["rule", "verdict"])

    host, path = host_of(F.col(url)), path_of(F.col(url))
    out = pages.withColumn("__judged", judged(host, path))
    return out.withColumn("__url", F.struct(host.alias("host"), path.alias("path"), F.col("__judged.rule").alias("rule"),
                                            F.col("__judged.verdict").alias("verdict"))).drop("__judged")


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules and labels of the registered query."""
    rows = [*RULES, *((BLOCK, f"*{label}") for label in LABELS)]
    return spark.createDataFrame(rows, "action string, rule string")
