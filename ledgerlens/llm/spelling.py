"""Groups of spelling variants: words one edit apart, found through an index of variable-length grams.

A word is padded with an opening and a closing mark.  The gram dictionary
holds the grams (two characters and more) that occur more than ``RARE``
times among the words: frequent grams are grown by one character, rare ones are
not.  From each position a word reads the shortest gram that is not frequent,
or one of the longest length, and a gram that lies inside the one before is
left out.  This decomposition has a property that keeps the bounds small: an
edit at a position affects only the grams that hold the position, and the one
that starts right after it.

The inverted lists are merged by a join on grams.  Every word stands in the
lists of all its grams, but asks only some of them: the rarest of its grams
that outnumber those among them which one edit can affect.  Usually two grams
apart from each other do, of which an edit affects one at most.  Any word one
edit apart holds one of the grams asked, at the same place, or one further
where it is longer and the edit lies before; so place and length are part of a
list's key.  Lists of grams that occur more than ``LIST`` times are cut by a
salt of the asking side, and the other side stands in every cut.  A pair
passes if the parities of its letters and letter pairs differ by no more than
one edit allows, and if its edit distance is one.  Words without enough grams
to ask are compared with all words through the words left by deleting one
character.

The longest gram is about half the length of a word, so that two grams can be
apart; words of lengths n and n + 1 meet with the longest gram of n.

The dictionary is broadcast: it holds ``MAX_GRAMS`` grams at most, since the
count above which a gram is frequent is raised until it fits.  That changes
how long the lists are and never the result.

Defined cases: null texts hold no words; a null doc_id counts as the empty text
in the damage rule; repeated rows are separate occurrences; an empty table
gives no rows.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.tables import Tables

#: Code points of the shortest word.
SHORTEST = 7
#: Occurrences of a word from which it is in the index.
OCCURRENCES = 2
#: A near word is the form of a word if it is at least so many times as frequent.
RATIO = 10
#: Code points of the shortest and of the longest gram.
GRAM = (2, 6)
#: Occurrences among the words above which a gram is frequent and is grown.
RARE = 64
#: Grams in the dictionary, at most.
MAX_GRAMS = 500_000
#: Occurrences of a gram up to which its lists are not cut.
LIST = 65_536

LETTERS = r"A-Za-zÀ-ÿ"
_UPPER = "".join(map(chr, range(65, 91)))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def damaged_words(docs: DataFrame) -> DataFrame:
    """(word) for every run of letters long enough, after the damage rule: where 31 divides
    the crc32 of ``<doc_id>:<run>``, the run loses the code point at crc32 modulo its length."""
    runs = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"([{LETTERS}]{{{SHORTEST},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", h.alias("h"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"),
                   F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    word = F.when((F.col("h") % 31 == 0) & at.isNotNull(), cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= SHORTEST)


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n): the words that occur often enough."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OCCURRENCES)


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, c): occurrences of every gram of the padded words."""
    padded = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("w")).withColumn("len", F.length("w"))
    grams = F.expr(f"""flatten(transform(sequence(1, len - {GRAM[0] - 1}), a ->
        transform(sequence({GRAM[0]}, least({GRAM[1]}, len - a + 1)), q -> substring(w, a, q))))""")
    return padded.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("c"))


def dictionary(words: DataFrame, tables: Tables, rare: int = RARE, max_grams: int = MAX_GRAMS) -> dict[str, int]:
    """The frequent grams and their counts, ``max_grams`` at most: beyond that
    the count above which a gram is frequent doubles until they fit."""
    counts = tables.write(gram_counts(words).where(F.col("c") > rare))
    doublings = F.floor(F.log2((F.col("c") - 1) / F.lit(float(rare)))).cast("int")
    by_size = {r["d"]: r["count"] for r in counts.groupBy(doublings.alias("d")).count().collect()}
    level = next(d for d in range(66) if sum(n for k, n in by_size.items() if k >= d) <= max_grams)
    return {r["gram"]: r["c"] for r in counts.where(F.col("c") > rare * 2**level).collect()}


def longest_gram(length: int) -> int:
    """The longest gram of words of ``length`` (and of words one longer that meet them)."""
    return max(GRAM[0], min(GRAM[1], (length + 1) // 2))


def decompose(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The (place, gram) of a word, in order."""
    s = f"^{word}$"
    spans, last = [], 0
    for a in range(len(s) - GRAM[0] + 1):
        b = a + GRAM[0]
        while b < len(s) and b - a < longest and s[a:b] in frequent:
            b += 1
        if b > last:
            spans.append((a, s[a:b]))
            last = b
    return spans


def affected(grams: list[tuple[int, str]], length: int) -> int:
    """How many of the (place, gram) of a word of ``length`` one edit affects at most."""
    hit = [0] * (length + 2)
    for place, gram in grams:
        for i in range(max(place - 1, 0), place + len(gram)):
            hit[i] += 1
    return max(hit[1:length + 1])


def asked(grams: list[tuple[int, str]], length: int, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """Rare grams of a word that one edit cannot all affect: two that are apart, else all; none if all are not enough."""
    cost = [frequent.get(g, 0) for _, g in grams]
    best = None
    for i, (place, gram) in enumerate(grams):
        for j in range(i + 1, len(grams)):
            if grams[j][0] > place + len(gram) and (best is None or cost[i] + cost[j] < best[0]):
                best = (cost[i] + cost[j], i, j)
    if best:
        return [grams[best[1]], grams[best[2]]]
    return grams if len(grams) > affected(grams, length) else []


def _key(length: int, longest: int, place: int, cut: int, gram: str) -> int:
    h = xxhash.xxh3_64_intdigest(f"{length} {longest} {place} {cut} {gram}")
    return h - (1 << 64) if h >> 63 else h


def _parity(word: str) -> int:
    """Parities of the letters (32 bits) and of the letter pairs (32 bits) of a word."""
    codes = [ord(c) for c in word]
    bits = 0
    for c in codes:
        bits ^= 1 << c % 32
    for a, b in zip(codes, codes[1:], strict=False):
        bits ^= 1 << 32 + (a * 31 + b) % 32
    return bits - (1 << 64) if bits >> 63 else bits


def entry(word: str, frequent: dict[str, int]) -> tuple[int, list[int], list[int], bool]:
    """(parities, lists that the word asks, lists that it stands in, whether it has too few grams to ask).

    It asks for words of its own length and for those one longer."""
    n = len(word)
    salt = xxhash.xxh3_64_intdigest(word)
    cuts = lambda gram: frequent.get(gram, 0) // LIST + 1
    own = longest_gram(n)
    grams = decompose(word, own, frequent)
    ask, weak = [], False
    rare = asked(grams, n, frequent)
    for place, gram in rare:
        cut = salt % cuts(gram)
        ask += [_key(n, own, place, cut, gram), _key(n + 1, own, place, cut, gram), _key(n + 1, own, place + 1, cut, gram)]
    stand = [_key(n, own, place, cut, gram) for place, gram in grams for cut in range(cuts(gram))]
    if longest_gram(n - 1) != own:
        below = longest_gram(n - 1)
        stand += [_key(n, below, place, cut, gram) for place, gram in decompose(word, below, frequent)
                  for cut in range(cuts(gram))]
    return _parity(word), ask, stand, not rare


_ENTRY = T.StructType([T.StructField("parity", T.LongType()), T.StructField("ask", T.ArrayType(T.LongType())),
                       T.StructField("stand", T.ArrayType(T.LongType())), T.StructField("weak", T.BooleanType())])


def _near_in_lists(index: DataFrame) -> DataFrame:
    """Pairs of words one edit apart of which the first asks a list that the second stands in."""
    left = index.select(F.explode("ask").alias("k"), "word", "n", "parity")
    right = index.select(F.explode("stand").alias("k2"), F.col("word").alias("word2"), F.col("n").alias("n2"),
                         F.col("parity").alias("parity2"))
    longer = F.length("word2") - F.length("word")
    differ = F.col("parity").bitwiseXOR(F.col("parity2"))
    return (left.hint("merge").join(right, (F.col("k") == F.col("k2"))
            & (F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF))) <= 2 - longer)
            & (F.bit_count(F.shiftrightunsigned(differ, 32)) <= 4 - longer)
            & ((longer > 0) | (F.col("word") < F.col("word2")))
            & (F.levenshtein("word", "word2", 1) == 1))
            .select("word", "n", "word2", "n2"))


def _near_of_weak(index: DataFrame) -> DataFrame:
    """Pairs of a weak word and a word one edit apart that is as long or longer: they are equal after
    deleting a character of the longer or of both."""
    cuts = "transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1)))"
    lengths = index.where("weak").select(F.length("word").alias("len")).distinct()
    lengths = {r["len"] for r in lengths.collect()}
    weak = index.where("weak").select("word", "n", F.explode(F.expr(f"array_union(array(word), {cuts})")).alias("rest"))
    reach = index.where(F.length("word").isin([*lengths, *(x + 1 for x in lengths)]))
    other = reach.select(F.col("word").alias("word2"), F.col("n").alias("n2"), F.explode(F.expr(cuts)).alias("rest2"))
    longer = F.length("word2") - F.length("word")
    return (weak.hint("merge").join(other, (F.col("rest") == F.col("rest2")) & (F.col("word") != F.col("word2"))
            & (longer >= 0) & (F.levenshtein("word", "word2", 1) == 1))
            .select(F.when(longer > 0, F.col("word")).otherwise(F.least("word", "word2")).alias("word"),
                    F.when((longer > 0) | (F.col("word") < F.col("word2")), F.col("n")).otherwise(F.col("n2")).alias("n"),
                    F.when(longer > 0, F.col("word2")).otherwise(F.greatest("word", "word2")).alias("word2"),
                    F.when((longer > 0) | (F.col("word") < F.col("word2")), F.col("n2")).otherwise(F.col("n")).alias("n2")))


def near_words(spark: SparkSession, words: DataFrame, rare: int = RARE, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(word, n, word2, n2): every pair of ``words`` (word, n) one edit apart, once."""
    ship(spark)
    tables = Tables(spark, "spelling")
    frequent = spark.sparkContext.broadcast(dictionary(words, tables, rare, max_grams))

    @F.pandas_udf(_ENTRY)
    def indexed(word: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([entry(w, frequent.value) for w in word], columns=_ENTRY.names)

    index = tables.write(words.select("word", "n", indexed("word").alias("e")).select("word", "n", "e.*"))
    pairs = _near_in_lists(index)
    if not index.where("weak").isEmpty():
        pairs = pairs.unionByName(_near_of_weak(index))
    pairs = tables.write(pairs.distinct())
    tables.drop_all_but(pairs)
    return pairs


def _roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) for words (word, form): forms are followed to the last.  A form is ten times as
    frequent as its word, so chains are short; each round doubles how far they are followed."""
    hops = forms.select("word", F.col("form").alias("root"))
    while True:
        on = hops.select(F.col("word").alias("at"), F.col("root").alias("on"))
        further = hops.join(on, F.col("root") == F.col("at"), "left")
        further = tables.write(further.select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")))
        hops = further.select("word", "root")
        if further.where("moved").isEmpty():
            return hops


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of ``words`` (word, n)."""
    tables = Tables(spark, "spelling-forms")
    pairs = near_words(spark, words)
    both = pairs.unionByName(pairs.select(F.col("word2").alias("word"), F.col("n2").alias("n"),
                                          F.col("word").alias("word2"), F.col("n").alias("n2")))
    best = (both.groupBy(F.col("word").alias("w")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n2")).alias("m"), F.col("word2").alias("f"))).alias("top")))
    rows = words.join(best, F.col("word") == F.col("w"), "left")
    is_form = -F.col("top.m") >= ratio * F.col("n")
    rows = tables.write(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                    F.when(is_form, F.col("top.f")).alias("form"),
                                    F.when(is_form, -F.col("top.m")).alias("form_n")))
    roots = _roots(rows.where("form is not null"), tables).select(F.col("word").alias("w"), "root")
    return (rows.join(roots, F.col("word") == F.col("w"), "left")
            .withColumn("root", F.coalesce("root", "word")).drop("w"))


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The words of ``docs`` after the damage rule, with their near words, forms and roots."""
    return variants(spark, Tables(spark, "vocabulary").write(vocabulary(damaged_words(docs))))
