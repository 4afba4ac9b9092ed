"""Quality rules, lines first.

Each line of a document is judged by itself: by punctuation (too many symbols,
or a short line that ends without a mark), navigation (menus and link bars) and
boilerplate (cookie notices, copyright lines and the like).  Lines that fail
are removed, and a document that loses too much of its text is rejected.

Base counts are taken on the whole text besides, and a document that fails the
base limits (too few words, too many in repeated windows) is rejected too.

Defined cases: null and empty text has no words, fails the base limits and is
cleaned to itself; blank lines are neither judged nor removed; repeated rows
are judged each by itself.  One text at a time is in memory besides its batch.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.text import WORD

# What the rules look for (patterns of lower-cased lines).
SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = r"[#*$%&|<>{}=~^_@\\]"
ENDS = r"[.!?:;,)\"'…。！？]$"
# English, German, French and Spanish; a word of the latter ends before anything but a-z, as \\b knows ASCII letters only.
NAVIGATION = (r"^((home|menu|login|log in|sign in|sign up|register|search|share|next|previous|back to top|read more|"
              r"click here|skip to)\b|"
              r"(startseite|anmelden|abmelden|registrieren|suche|teilen|weiterlesen|nach oben|zum inhalt|hier klicken|impressum|"
              r"accueil|connexion|se connecter|inscription|rechercher|partager|suivant|lire la suite|haut de page|cliquez ici|"
              r"inicio|iniciar sesi.n|registrarse|buscar|compartir|siguiente|anterior|leer m.s|volver arriba|saltar al contenido)"
              r"([^a-z]|$))")
BARS = r"[|»›>].*[|»›>]"
BOILERPLATE = (r"\b(all rights reserved|privacy policy|cookie policy|terms of use|terms of service|enable javascript|"
               r"uses cookies|lorem ipsum|subscribe to our|copyright ©|"
               r"alle rechte vorbehalten|datenschutzerkl|nutzungsbedingungen|verwendet cookies|newsletter abonnieren|"
               r"tous droits r.serv|politique de confidentialit|conditions d.utilisation|utilise des cookies|"
               r"todos los derechos reservados|pol.tica de privacidad|t.rminos de uso|utiliza cookies|aviso legal)")

#: A line fails with more symbols than these hundredths of its characters.
LINE_SYMBOL_SHARE = 15
#: A line without an end mark fails with fewer words; a line of more is not navigation.
SHORT_LINE = 8
#: A document is rejected that loses more than these hundredths of its words' characters.
LOST_SHARE = 40
MIN_WORDS = 20
WINDOW = 8
REPEATED_SHARE = 30

_WORD = re.compile(WORD)
_BLANKS = " \t\n\r\x0b\x0c"
_LINE_SYMBOLS, _ENDS, _NAVIGATION, _BARS, _BOILERPLATE = map(
    lambda p: re.compile(p, re.ASCII), (LINE_SYMBOLS, ENDS, NAVIGATION, BARS, BOILERPLATE))


def lower(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def line_fails(line: str, words: int) -> bool:
    """Whether a line (without blanks at its ends, with a word) is removed."""
    if 100 * len(_LINE_SYMBOLS.findall(line)) > LINE_SYMBOL_SHARE * len(line):
        return True
    low = lower(line)
    if words < SHORT_LINE and (not _ENDS.search(line) or _NAVIGATION.search(low) or _BARS.search(low)):
        return True
    return bool(_BOILERPLATE.search(low))


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of eight found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Exact: each round numbers the windows of twice the length by the pair of halves.
    width = 1
    while width < WINDOW:
        _, ids = np.unique(ids[:-width] * np.int64(len(words) + 1) + ids[width:], return_inverse=True)
        width *= 2
    counts = np.bincount(ids)
    if counts.max() < 2:
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    hit = np.flatnonzero(counts[ids] > 1)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_failed_lines, lost_chars, kept, cleaned text)."""
    text_ = text or ""
    words = _WORD.findall(text_)
    chars = sum(map(len, words))
    symbols = sum(map(text_.count, SYMBOLS))
    seen: set[str] = set()
    duplicates = failed = lost = 0
    kept_lines = []
    for line in text_.split("\n"):
        bare = line.strip(_BLANKS)
        if not bare:
            kept_lines.append(line)
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        own = _WORD.findall(bare)
        if line_fails(bare, len(own)):
            failed += 1
            lost += sum(map(len, own))
        else:
            kept_lines.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > REPEATED_SHARE * len(words)
    kept = not base_failed and 100 * lost <= LOST_SHARE * chars
    clean = None if text is None else "\n".join(kept_lines)
    return len(words), chars, symbols, duplicates, repeated, base_failed, failed, lost, kept, clean


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_failed_lines",
           "lost_chars", "kept", "clean_text"]
_TYPES = [T.LongType()] * 5 + [T.BooleanType(), T.LongType(), T.LongType(), T.BooleanType(), T.StringType()]


def quality_rules(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``docs`` with ``__verdict``, the counts, the verdict and, ``with_text``, the cleaned text."""
    ship(docs.sparkSession)
    width = len(COLUMNS) - (not with_text)

    @F.pandas_udf(T.StructType([T.StructField(c, t) for c, t in zip(COLUMNS[:width], _TYPES, strict=False)]))
    def verdict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t)[:width] for t in texts], columns=COLUMNS[:width])

    return docs.withColumn("__verdict", verdict("text"))
