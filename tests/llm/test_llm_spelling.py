import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import ROWS, empty, frame, lower

from ledgerlens.llm import spelling as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(docs):
    words = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += len(run) >= 7
    return {w: n for w, n in words.items() if n >= 2}


def expected(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def dense(rng, letters, count):
    """Words that share most of their grams, and edits of them."""
    words = {"".join(rng.choices(letters, k=rng.randint(7, 12))) for _ in range(count)}
    for w in list(words):
        i, c = rng.randrange(len(w)), rng.choice(letters)
        words |= {w[:i] + c + w[i:], w[:i] + c + w[i + 1:], c + w, w + c}
        if len(w) > 7:
            words.add(w[:i] + w[i + 1:])
    return sorted(words)


@pytest.mark.parametrize(("letters", "count", "rare", "most"), [
    ("ab", 40, 1, 500_000), ("abcdeé", 120, 2, 500_000), ("abcdeé", 120, 64, 500_000), ("abc", 80, 1, 5), ("a", 10, 1, 500_000)])
def test_pairs_against_brute_force(spark, letters, count, rare, most):
    words = dense(random.Random(count + rare), letters, count)
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [tuple(sorted((r.word, r.word2))) for r in S.near_words(spark, table, rare, most).collect()]
    want = {(a, b) for a, b in itertools.combinations(words, 2) if one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_lists_that_are_cut(monkeypatch):
    monkeypatch.setattr(S, "LIST", 5)
    words = dense(random.Random(9), "abc", 60)
    frequent = {g: 40 for w in words for g in (w[i:i + 2] for i in range(len(w)))}
    entries = {w: S.entry(w, frequent) for w in words}
    for a, b in itertools.permutations(words, 2):
        if one_edit(a, b) and len(a) <= len(b):
            assert set(entries[a][1]) & set(entries[b][2]) or entries[a][3], (a, b)


def test_affected_grams_bound_what_one_edit_changes():
    rng = random.Random(5)
    words = dense(rng, "abcd", 60)
    counts = Counter(f"^{w}$"[i:i + q] for w in words for q in range(2, 7) for i in range(len(w) + 3 - q))
    frequent = {g: c for g, c in counts.items() if c > 6}
    for a, b in itertools.permutations(words, 2):
        if one_edit(a, b):
            longest = S.longest_gram(min(len(a), len(b)))
            ga, gb = S.decompose(a, longest, frequent), S.decompose(b, longest, frequent)
            shared = Counter(g for _, g in ga) & Counter(g for _, g in gb)
            assert sum(shared.values()) >= len(ga) - S.affected(ga, len(a))
            if len(a) <= len(b):
                at = {(p - d, g) for p, g in gb for d in range(len(b) - len(a) + 1)}
                assert at & set(S.asked(ga, len(a), frequent)) or not S.asked(ga, len(a), frequent)


def test_words_without_enough_grams(spark):
    words = dense(random.Random(11), "abcd", 30)
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    index = table.selectExpr("word", "n", "length(word) % 2 = 1 as weak")
    got = {(r.word, r.word2) for r in S._near_of_weak(index).collect()}
    assert got == {tuple(sorted((a, b), key=lambda w: (len(w), w))) for a, b in itertools.combinations(words, 2)
                   if one_edit(a, b) and (len(a) % 2 if len(a) <= len(b) else len(b) % 2)}


def test_variants_against_brute_force(spark):
    rng = random.Random(7)
    words = dense(rng, "abcdeé", 30)
    docs = [(i, " ".join(rng.choices(words, weights=[1 + 400 // (1 + j * j) for j in range(len(words))], k=400)))
            for i in range(60)]
    docs += [(None, "straße STRAßE Straße,straße×xxxxxxx"), (5, "Überraschung überraschung ÜBERRASCHUNG"), (6, None), (6, "")]
    docs += [(900 + i, "international " * 40 + "internationel intarnationel " * (i < 2)) for i in range(20)]
    table = frame(spark, [(i, t, "en", "s") for i, t in docs])
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.spelling_variants(spark, table).collect()}
    assert got == expected(counted(docs))
    assert got["internationel"][2] == "international"


def test_roots_follow_forms(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("x", "f")]
    forms = spark.createDataFrame(rows, "word string, form string")
    assert {r.word: r.root for r in S._roots(forms, S.Tables(spark, "t")).collect()} == dict.fromkeys("abcdex", "f")


def test_defined_cases(spark):
    table = frame(spark, clashing=True)
    got = {r.word: r.n for r in S.spelling_variants(spark, table).collect()}
    assert got == counted([(i, t) for i, t, _, _ in ROWS])
    assert S.spelling_variants(spark, empty(spark)).count() == 0
