"""Awkward rows and brute-force versions for the tests of the training-data operators."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Columns of a table whose names operators might use themselves.
CLASHING = ("score", "shard", "size", "src", "component_id", "node", "a", "b", "features", "label", "h", "bucket", "rank")

LONG = " ".join(f"w{i % 7919} the" for i in range(30_000))
LINES = "\n".join(f"Line {i} of a passage that repeats, word for word, here." for i in range(6))

ROWS = [
    (None, "A row without an id still has a text of some words in it.", "en", "s1"),
    (1, None, "en", "s1"),
    (2, "", None, "s1"),
    (3, " \n\t ", "en", None),
    (4, LONG, "en", "s2"),
    (5, LINES, "en", "s2"),
    (5, LINES, "en", "s2"),
    (6, LINES + "\nAnd one line more.", "en", "s3"),
    (7, "Ein Text mit Ünïcode, 中文 und 🙂 ▁ Zeichen.", "de", "ß"),
    (8, "You are a worthless idiot, a pathetic loser and a moron! Stupid trash, disgusting clown.", "en", "s1"),
    (9, "Licensed under CC BY-NC 4.0.\nAll Rights Reserved. All rights, reserved", "en", "s1"),
    (10, "one two", None, None),
    (11, "one two", None, None),
]


def frame(spark, rows=None, clashing=False):
    rows = ROWS if rows is None else rows
    df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        for c in CLASHING:
            df = df.selectExpr("*", f"concat('own ', coalesce(doc_id, -1)) as {c}")
    return df


def empty(spark):
    return frame(spark, [])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(texts, percent=85):
    """{id: (number of shingles, smallest linked id)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = collections.Counter()
    for ids in where.values():
        for n, one in enumerate(ids):
            for other in ids[:n]:
                shared[(other, one)] += 1
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (one, other), n in shared.items():
        if 100 * n >= percent * (len(sets[one]) + len(sets[other]) - n):
            x, y = find(one), find(other)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def documents(spark, folder):
    return {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
