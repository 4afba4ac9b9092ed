"""Toxicity: boosted trees over dense text features, calibrated isotonically.

Features per document (most are rates, so that length alone decides little):
densities of the words of two lexicons, their words near a second person,
capitals, punctuation and obfuscated spelling.  One lexicon is a fixed list of
insults.  The other is learned from the labels, in whatever language the toxic
documents are: words in at least ``LEARNED_DOCS`` toxic documents of the
sample and in few clean ones.  A labelled row is measured with the lexicon
learned from the other ``PARTS`` - 1 parts of the sample, so that the trees
never see a row through its own label; all rows are scored with the whole one.

Spark MLlib fits gradient-boosted trees on a bounded, hash-chosen sample of
the labelled rows and an isotonic regression on rows the trees have not
seen; every document is then scored.

Defined cases: null or empty text has all features 0 and is scored like any
other; a document with several label rows has the largest; null labels do
not count; with no label of one class every score is the share of toxic
labels (0 without any).  Repeated rows are scored each by itself.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.shipping import ship
from ledgerlens.session import ensure_checkpoint_dir

# Insults, by language.
INSULTS = {
    "en": """idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile fool loser losers pathetic
             worthless useless trash garbage scum scumbag filth filthy disgusting vile clown jerk creep freak
             ugly liar coward degenerate lowlife vermin pig swine bastard bitch asshole crap shit fuck fucking
             fucker damn retard retarded whore slut hate kill""",
    "de": "idiot dummkopf trottel depp arschloch scheisse scheiße abschaum versager dreck ekelhaft schwein",
    "fr": "idiot imbécile crétin connard salaud merde ordure débile dégoûtant pourriture",
    "es": "idiota imbécil estúpido basura mierda cabrón asqueroso escoria inútil patético",
}
# Words that address the reader.
SECOND_PERSON = "you your yours youre u ur du dein deine dich dir ihr tu te toi ton ta vous votre usted eres tus"
# Characters written for letters in obfuscated words, and the letters.
LEET = (b"013457@$!|+", b"oieastasilt")

FEATURES = ["insults_per_word", "log_insults", "distinct_insults", "insults_near_second_person",
            "second_person_per_word", "capital_share", "shouted_words", "exclamations", "questions",
            "doubled_marks", "symbol_share", "digit_share", "obfuscated_insults", "mixed_words", "log_words",
            "learned_per_word", "log_learned", "distinct_learned", "learned_near_second_person"]

#: Labelled rows the trees and the calibration are fitted on, at most (in expectation: rows are chosen by hash).
MAX_FIT_ROWS = 20_000
THRESHOLD = 0.3
NEAR_WORDS = 5
#: Toxic documents of the sample that a learned word is in, at least.
LEARNED_DOCS = 4
#: Share of toxic documents among those that a learned word is in, at least.
LEARNED_SHARE = 0.75
#: Parts of the sample: each is measured with the words learned from the others.
PARTS = 5

_LEXICON = frozenset(w.encode() for words in INSULTS.values() for w in words.split())
_YOU = frozenset(w.encode() for w in SECOND_PERSON.split())
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TO_BLANK = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_UNDO_LEET = bytes.maketrans(*LEET)
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_DIGITS = b"0123456789"
_SYMBOLS = b"#$%&*+<=>@^_|~"
_LEET_SIGNS = frozenset(LEET[0])


def _near_you(words: list[bytes], hits: list[int]) -> int:
    """How many of the words at ``hits`` have a second person among the words around them."""
    return sum(any(words[j] in _YOU for j in range(max(0, i - NEAR_WORDS), min(len(words), i + NEAR_WORDS + 1)))
               for i in hits)


def text_words(text: str | None) -> list[bytes]:
    """The words of a text: A-Z in lower case, ASCII marks as blanks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_BLANK).split()


def text_features(text: str | None, learned: frozenset[bytes] = frozenset()) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    import math
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = text_words(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits = [i for i, w in enumerate(words) if w in _LEXICON]
    taught = [i for i, w in enumerate(words) if w in learned]
    you = sum(w in _YOU for w in words)
    near, taught_near = (_near_you(words, hits), _near_you(words, taught)) if you else (0, 0)
    chunks = raw.split()
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    digits = len(raw) - len(raw.translate(None, _DIGITS))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    shouted = sum(1 for w in chunks if len(w) > 2 and w.isupper()) if capitals > 2 else 0
    obfuscated = mixed = 0
    if digits or symbols or b"!" in raw:
        for w in raw.lower().split():
            if not w.isalpha() and not _LEET_SIGNS.isdisjoint(w.rstrip(_MARKS)):
                core = w.rstrip(_MARKS).lstrip(b"\"'(").translate(_UNDO_LEET)
                mixed += any(97 <= c <= 122 for c in w)
                obfuscated += core in _LEXICON or core in learned
    return [len(hits) / n, math.log1p(len(hits)), float(len({words[i] for i in hits})), near / n, you / n,
            capitals / max(1, letters), shouted / n, raw.count(b"!") / n, raw.count(b"?") / n,
            (raw.count(b"!!") + raw.count(b"??") + raw.count(b"?!")) / n, symbols / len(raw), digits / len(raw),
            obfuscated / n, mixed / n, math.log1p(n),
            len(taught) / n, math.log1p(len(taught)), float(len({words[i] for i in taught})), taught_near / n]


def _features(learned: list[frozenset[bytes]]):
    """Function of a text and the number of the lexicon to measure it with."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def features(text: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([text_features(t, learned[p]) for t, p in zip(text, part, strict=True)])

    return features


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _distinct_words(text: pd.Series) -> pd.Series:
    return text.map(lambda t: sorted(set(text_words(t))), na_action=None)


def learn(rows: DataFrame) -> list[frozenset[bytes]]:
    """The lexicon learned without each part of ``rows`` (label, part, __text), and last the one
    learned from all.  Words of the bounded sample only, so the lists are bounded as well."""
    seen = rows.select("label", "part", F.explode(_distinct_words("__text")).alias("word"))
    bad, good = F.col("label") == 1, F.col("label") == 0
    counts = seen.groupBy("word").agg(
        F.count_if(bad).alias("bad"), F.count_if(good).alias("good"),
        *[F.count_if(bad & (F.col("part") == p)).alias(f"bad{p}") for p in range(PARTS)],
        *[F.count_if(good & (F.col("part") == p)).alias(f"good{p}") for p in range(PARTS)])
    table = counts.where(F.col("bad") >= LEARNED_DOCS).collect()

    def lexicon(part: int | None) -> frozenset[bytes]:
        words = []
        for r in table:
            b = r["bad"] - (r[f"bad{part}"] if part is not None else 0)
            g = r["good"] - (r[f"good{part}"] if part is not None else 0)
            if b >= LEARNED_DOCS and b >= LEARNED_SHARE * (b + g):
                words.append(bytes(r["word"]))
        return frozenset(words)

    return [*(lexicon(p) for p in range(PARTS)), lexicon(None)]


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 4: 2 is held out; 3 calibrates; 0 and 1 fit the trees.
    A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, seed: int = 7):
    """(trees, isotonic, lexicon), or the share of toxic labels where one class is missing.

    Learns only from labels of rows outside the held-out fold.  The sample is
    at most ``max_fit_rows`` rows (in expectation), so it may be broadcast to
    the scan of the documents, whose texts are not shuffled.
    """
    ensure_checkpoint_dir(spark)
    ship(spark)
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .where(fold(F.col("doc_id")) != 2)
             .groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("double").alias("label")))
    total = known.count()
    slots = 1 << 30
    share = min(slots, slots * max_fit_rows // max(1, total))
    sample = known.where(F.pmod(F.xxhash64(F.lit(seed), F.col("__id")), F.lit(slots)) < share)
    part = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("__id")), F.lit(PARTS)).cast("int")
    texts = (docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
             .join(F.broadcast(sample), "__id")
             .select("label", "__text", (fold(F.col("__id")) == 3).alias("calibrates"), part.alias("part")).checkpoint())
    seen = {(r[0], r[1]): r[2] for r in texts.groupBy("calibrates", "label").count().collect()}
    bad, good = (sum(v for k, v in seen.items() if k[1] == y) for y in (1.0, 0.0))
    if not seen.get((False, 1.0)) or not seen.get((False, 0.0)):
        return bad / max(1, bad + good)
    lexicons = learn(texts)
    rows = (texts.select("label", "calibrates", _features(lexicons)("__text", "part").alias("features"))
            .withColumn("features", array_to_vector("features")).checkpoint())
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=seed, featuresCol="features",
                          labelCol="label", cacheNodeIds=False).fit(rows.where("not calibrates"))
    held = rows.where("calibrates") if seen.get((True, 1.0)) and seen.get((True, 0.0)) else rows
    seen_by = trees.transform(held).select("label", vector_to_array("probability")[1].alias("raw"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(seen_by)
    return trees, isotonic, lexicons[-1]


def score(docs: DataFrame, model, column: str = "__score") -> DataFrame:
    """``docs`` with a score of 0 to 1 for every row."""
    if isinstance(model, float):
        return docs.withColumn(column, F.lit(model))
    trees, isotonic, lexicon = model
    names = ("__features", "__margin", "__probability", "__class", "__raw", "__calibrated")
    out = docs.withColumn("__features", array_to_vector(_features([lexicon])("text", F.lit(0))))
    trees = trees.copy().setFeaturesCol("__features").setRawPredictionCol("__margin") \
        .setProbabilityCol("__probability").setPredictionCol("__class")
    out = trees.transform(out).withColumn("__raw", vector_to_array("__probability")[1])
    out = isotonic.copy().setFeaturesCol("__raw").setPredictionCol("__calibrated").transform(out)
    # The uncalibrated probability only orders rows on one step of the isotonic curve.
    value = 0.999 * F.col("__calibrated") + 0.001 * F.col("__raw")
    return out.withColumn(column, F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))).drop(*names)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """``docs`` with ``__score`` and ``__toxic`` (the score reaches the threshold)."""
    model = fit(spark, docs, labels, max_fit_rows)
    return score(docs, model).withColumn("__toxic", F.col("__score") >= THRESHOLD)
