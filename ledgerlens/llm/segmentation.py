"""SentencePiece segmentations, sampled without replacement.

A text's lattice has an edge for every vocabulary piece that matches at a
character; an edge weighs ``ALPHA`` times the piece's score, and a whole
segmentation is drawn with probability proportional to the exponential of its
weights.  The ``k`` segmentations with the greatest Gumbel-perturbed log
probabilities are k draws without replacement.  They are found best first:
the perturbed value of a partial segmentation is the maximum over all its
completions (the children's noise is drawn conditioned on that maximum), so it
is an exact bound for an A* search, and only the k best open nodes of a text
need to be kept.

Pieces never span a word start or a line break, so the lattice of a text is a
chain of small lattices, one for each distinct word.  These are built for a
batch of texts at once as flat arrays (trie walk, backward sums), and one
search step moves all words of all texts of the batch one edge on.

A character without a piece is one edge of its UTF-8 bytes (byte fallback).
The vocabulary must hold every byte, pieces with a blank only at their front,
as one blank or a run of blanks.

Each sample has its log probability, its perturbed log probability and
log_inclusion: the log of the probability that a draw of this size includes
it, 1 - exp(-exp(log_prob - t)), t being the next best perturbed value (null
if there is no other segmentation: it is always included).

Noise is seeded by the row key (doc_id) and the text, not by place or order.
Defined cases: null text gives no row; empty text one sample of no pieces;
texts with fewer than k segmentations have fewer samples; repeated rows give
the same samples.  Memory holds one batch of about ``BATCH_CHARS`` characters,
or one text if that is longer.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.text import mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.0005
#: Texts of about this many characters share the lattices of their words, ...
BATCH_CHARS = 500_000
#: ... and of about this many are searched at a time.
PART_CHARS = 250_000
BLANK = "▁"
#: Words whose open nodes are looked at first.
EARLY_WORDS = 6

_UNIT = re.compile(r" +[^ ]*|[^ ]+")


class Vocabulary:
    """Pieces of a model as a character trie in flat arrays."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
                 for i in range(size)]
        self.bytes = np.zeros(256, np.int64)
        for i, p in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
        scores = np.array([model.get_score(i) for i in range(size)])
        # Some vocabularies give pieces that merging never makes a score far below all others.
        self.worst = scores[scores > -1e8].min() - 10.0
        scores = np.maximum(scores, self.worst)
        if any(plain[i] and ("\n" in p or BLANK in p.lstrip(BLANK)) for i, p in enumerate(self.pieces)):
            raise ValueError("the vocabulary has pieces that go beyond a word")
        ids, nodes = [-1], [{}]
        for i, p in enumerate(self.pieces):
            if plain[i]:
                at = 0
                for ch in p.replace(BLANK, " "):
                    if ch not in nodes[at]:
                        nodes[at][ch] = len(nodes)
                        nodes.append({})
                        ids.append(-1)
                    at = nodes[at][ch]
                ids[at] = i
        alphabet = sorted({c for n in nodes for c in n})
        self.codes = np.full(0x110000, -1, np.int32)
        self.codes[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        self.width = len(alphabet)
        at = {c: i for i, c in enumerate(alphabet)}
        pairs = sorted((n * self.width + at[c], m) for n, kids in enumerate(nodes) for c, m in kids.items())
        keys, targets = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # Open addressing: the children of all nodes in one table.
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self.mask = np.int64((1 << bits) - 1)
        self.keys, self.targets = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for k, t in zip(keys.tolist(), targets.tolist(), strict=True):
            h = (k * 0x9E3779B1 >> 7) & int(self.mask)
            while self.keys[h] >= 0:
                h = (h + 1) & int(self.mask)
            self.keys[h], self.targets[h] = k, t
        self.ids = np.array(ids, np.int64)
        self.start = np.full(self.width + 1, -1, np.int64)  # children of the root, the last for no character
        self.start[[at[c] for c in nodes[0]]] = list(nodes[0].values())
        self.scores = scores

    def child(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The trie nodes one character on, -1 where there is none."""
        key = node * self.width + code
        h = (key * 0x9E3779B1 >> 7) & self.mask
        out = np.full(len(node), -1, np.int64)
        todo = np.flatnonzero(code >= 0)
        while len(todo):
            found = self.keys[h[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.targets[h[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            h[todo] = (h[todo] + 1) & self.mask
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation, without the blank put before it."""
        out = bytearray()
        for i in ids:
            p = self.pieces[i]
            if p.startswith("<0x") and self.bytes[int(p[3:5], 16)] == i:
                out.append(int(p[3:5], 16))
            else:
                out += p.replace(BLANK, " ").encode()
        return out.decode("utf-8", "surrogatepass")[1:]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str = MODEL) -> Vocabulary:
    """The model's vocabulary, loaded once in a Python process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class Lattices:
    """The lattices of distinct words.  Nodes are characters, numbered by their
    distance to the end of the word and, at one distance, by the word's place
    among all, longest first: the ends of the words come first, and what is at
    one distance lies together.  ``root[w]`` is the first node of word w; edges
    are sorted by node."""

    def __init__(self, words: list[str], voc: Vocabulary, alpha: float):
        self.words = len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        by_length = np.argsort(-lengths, kind="stable")
        place = np.empty(len(words), np.int64)
        place[by_length] = np.arange(len(words))
        longest = int(lengths.max(initial=0))
        level = np.zeros(longest + 2, np.int64)  # where each distance begins
        np.cumsum(len(words) - np.searchsorted(lengths[by_length[::-1]], np.arange(longest + 1)), out=level[1:])
        self.root = level[lengths] + place
        total = int(level[-1])
        # In the order of the text: its characters, each word followed by its end.
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        codes = voc.codes[chars].astype(np.int64)
        ends = np.cumsum(lengths + 1) - 1
        final = np.zeros(total, bool)
        final[ends] = True
        codes[final] = -1
        number = level[np.repeat(ends, lengths + 1) - np.arange(total)] + np.repeat(place, lengths + 1)
        begin = np.flatnonzero(~final)
        at, node, step = begin, np.zeros(len(begin), np.int64), 0
        tails, heads, ranks, ids = [], [], [], []
        degree = np.zeros(total, np.int64)
        single = np.zeros(total, bool)
        while len(at):
            node = voc.child(node, codes[at + step]) if step else voc.start[codes[at]]
            alive = np.flatnonzero(node >= 0)
            at, node, step = at[alive], node[alive], step + 1
            piece = voc.ids[node]
            good = np.flatnonzero(piece >= 0)
            tail = at[good]
            tails.append(tail)
            heads.append(number[tail + step])
            ranks.append(degree[tail])
            ids.append(piece[good])
            degree[tail] += 1
            if step == 1:
                single[tail] = True
        bare = begin[~single[begin]]  # characters without a piece of their own
        tails.append(bare)
        heads.append(number[bare + 1])
        ranks.append(degree[bare])
        ids.append(-1 - chars[bare])  # below 0: a character's bytes
        degree[bare] += 1
        self.degree = np.empty(total, np.int64)
        self.degree[number] = degree
        self.first = np.concatenate([[0], np.cumsum(self.degree)])
        at = self.first[number[np.concatenate(tails)]] + np.concatenate(ranks)
        self.head, self.ident = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        self.head[at] = np.concatenate(heads)
        self.ident[at] = np.concatenate(ids)
        self.tail = np.repeat(np.arange(total), self.degree)
        weight = alpha * np.where(self.ident >= 0, voc.scores[np.maximum(self.ident, 0)], voc.worst)
        # Backward log sums, by distance to the end of the word.
        self.beta = np.zeros(total)
        for lo, hi in zip(level[1:-1].tolist(), level[2:].tolist(), strict=True):
            edges = slice(int(self.first[lo]), int(self.first[hi]))
            starts = self.first[lo:hi] - edges.start
            value = weight[edges] + self.beta[self.head[edges]]
            top = np.maximum.reduceat(value, starts)
            value = np.exp(value - np.repeat(top, self.degree[lo:hi]))
            self.beta[lo:hi] = top + np.log(np.add.reduceat(value, starts))
        #: Log probability of an edge, given its node.
        self.logp = weight + self.beta[self.head] - np.repeat(self.beta, self.degree)


def _words(text: str) -> list[str]:
    """The words whose lattices make up the text's, with a blank put before it.
    A word after one blank is given without it, any other after a mark."""
    if not text:
        return []
    out: list[str] = []
    for n, line in enumerate(text.split("\n")):
        if n:
            out.append(_LINE_END)
            if not line:
                continue
        found = line.split(" ")
        if "" in found or _MARK in line:  # several blanks together, or at an end
            whole = line if n else " " + line
            out += [u[1:] if u[0] == " " and u[1:2] not in ("", " ", _MARK) else _MARK + u for u in _UNIT.findall(whole)]
        else:
            if n:
                found[0] = _MARK + found[0]
            out += found
    return out


def _spelled(word: str) -> str:
    return word[1:] if word[0] == _MARK else " " + word


_MARK = "\x00"
_LINE_END = _MARK + "\n"


def _gumbel(key: np.ndarray) -> np.ndarray:
    """Standard Gumbel noise, a function of a 64-bit key."""
    u = (mixed(key) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) * 2.0 ** -53))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD1B54A32D192ED03)


def _edges(lat: Lattices, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """All edges of the nodes: (edge, its perturbed log probability, number of its node, where each node begins)."""
    lo, n = lat.first[node], lat.degree[node]
    starts = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(n)), n)
    local = np.arange(len(owner)) - starts[owner]
    edges = local + lo[owner]
    return edges, lat.logp[edges] + _gumbel(key[owner] + local.astype(np.uint64) * _STEP), owner, starts


def _best(value: np.ndarray, top: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of each node the edge of greatest value, the first of equal ones."""
    best = np.flatnonzero(value == top[owner])
    return best if len(best) == len(top) else best[np.unique(owner[best], return_index=True)[1]]


def _complete(lat: Lattices, node: np.ndarray, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Follow, from each node, the edges of greatest perturbed probability to
    the end of its word.  All words go one edge on at a time.

    Returns, in the order of the path, (unit, edge, key, greatest value, second
    greatest value) of each node passed.  A node with one edge has no second
    value, and its greatest is not needed.
    """
    parts = []
    while True:
        alive = np.flatnonzero(node >= lat.words)  # the words' ends come first
        node, unit, key = node[alive], unit[alive], key[alive]
        if not len(node):
            break
        taken, top, second = lat.first[node], np.zeros(len(node)), np.full(len(node), -np.inf)
        open_ = np.flatnonzero(lat.degree[node] > 1)
        if len(open_):
            edges, value, owner, starts = _edges(lat, node[open_], key[open_])
            most = np.maximum.reduceat(value, starts)
            best = _best(value, most, owner)
            taken[open_], top[open_] = edges[best], most
            value[best] = -np.inf
            second[open_] = np.maximum.reduceat(value, starts)
        parts.append((unit, taken, key, top, second))
        node, key = lat.head[taken], key + _TURN
    if not parts:
        whole = np.zeros(0, np.int64)
        return whole, whole, whole.astype(np.uint64), np.zeros(0), np.zeros(0)
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(columns[0], kind="stable")  # steps of one word are in order already
    return tuple(c[order] for c in columns)


def _behind(value: np.ndarray, top: np.ndarray) -> np.ndarray:
    """What orders the values beside a path: they stay below the path's own, the greatest."""
    return value - np.log(-np.expm1(value - top))


def _open_nodes(lat: Lattices, path: tuple, at: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges beside the path's nodes ``at``: (place in the path, edge, what orders their perturbed values)."""
    if not len(at):
        return at, at, np.zeros(0)
    _, edge, key, top, _ = path
    edges, value, owner, starts = _edges(lat, lat.tail[edge[at]], key[at])
    other = np.ones(len(edges), bool)
    other[_best(value, top[at], owner)] = False
    owner = owner[other]
    return at[owner], edges[other], before[at[owner]] + _behind(value[other], top[at[owner]])


def _kth_largest(group: np.ndarray, value: np.ndarray, chosen: np.ndarray, k: int, groups: int) -> np.ndarray:
    """The k-th largest of each group's chosen values; minus infinity where there are fewer."""
    at = np.flatnonzero(chosen)
    at = at[np.lexsort((-value[at], group[at]))]
    lo, hi = np.searchsorted(group[at], [np.arange(groups), np.arange(1, groups + 1)])
    out = np.full(groups, -np.inf)
    full = hi - lo >= k
    out[full] = value[at[lo[full] + k - 1]]
    return out


def _log_inclusion(gap: float) -> float:
    """log(1 - exp(-exp(gap)))"""
    return gap if gap < -30 else float(np.log(-np.expm1(-np.exp(min(gap, 700.0)))))


def sample_batch(texts: list[str], seeds: list[int], k: int, voc: Vocabulary, alpha: float = ALPHA) -> list[list[tuple]]:
    """For each text its samples, best first: (ids, log_prob, perturbed, log_inclusion)."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    words = [_words(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes)
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    lat = Lattices([_spelled(w) for w in number], voc, alpha)
    out: list[list[tuple]] = []
    begin = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= PART_CHARS or i + 1 == len(texts):
            part = slice(begin, i + 1)
            out += _sample(lat, flat[int(end[begin] - sizes[begin]):int(end[i])], sizes[part], seeds[part], k, voc)
            begin, chars = i + 1, 0
    return out


def _sample(lat: Lattices, flat: np.ndarray, sizes: np.ndarray, seeds: list[int], k: int, voc: Vocabulary) -> list[list[tuple]]:
    """The samples of texts of ``sizes`` words each, given by their numbers ``flat``."""
    end, texts = np.cumsum(sizes), range(len(sizes))
    seed = mixed(np.array(seeds, np.uint64))
    # What is expanded next: perturbed value, log probability so far, edges so far, last word, its node.
    now = [(float(g), 0.0, np.zeros(0, np.int64), int(e - n) - 1, -1)
           for g, e, n in zip(_gumbel(seed), end, sizes, strict=True)]
    opened: list[list[tuple]] = [[] for _ in texts]
    found: list[list[tuple]] = [[] for _ in texts]
    for turn in range(k):
        todo = [d for d in range(len(texts)) if now[d] is not None]
        # The words to complete: the one branched in, from its node, and all after it.
        starts = [(now[d][3] + (now[d][4] < 0), end[d]) for d in todo]
        units = np.concatenate([np.arange(lo, hi) for lo, hi in starts]) if todo else np.zeros(0, np.int64)
        if not todo:
            break
        length = np.array([hi - lo for lo, hi in starts], np.int64)
        first = np.cumsum(length) - length
        node = lat.root[flat[units]] if len(units) else units
        for at, d in zip(first, todo, strict=True):
            if now[d][4] >= 0:
                node[at] = now[d][4]
        owner = np.repeat(np.array(todo, np.int64), length)
        base = end[owner] - sizes[owner]
        key = seed[owner] + mixed((units - base).astype(np.uint64) * np.uint64(k + 1) + np.uint64(turn + 1))
        done = _complete(lat, node, units, key)
        unit, edge, _, top, second = done
        logp = np.concatenate([[0.0], np.cumsum(lat.logp[edge])])
        bounds = np.searchsorted(unit, [lo for lo, _ in starts]), np.searchsorted(unit, [hi for _, hi in starts])
        text_at = np.searchsorted(bounds[1], np.arange(len(edge)), side="right")  # text of each edge taken
        before = logp[:-1] + np.array([now[d][1] for d in todo])[text_at] - logp[bounds[0]][text_at]
        # The next ones are the open nodes that come first in that order.  Each node's best is known; the best of
        # the first words bound from below what can be among as many as are wanted.
        left = k - turn
        reach = before + _behind(second, top)
        early = unit < np.array([lo for lo, _ in starts])[text_at] + EARLY_WORDS
        cut = _kth_largest(text_at, reach, early & (second > -np.inf), left, len(todo))
        beside, other, free = _open_nodes(lat, done, np.flatnonzero((reach >= cut[text_at]) & (second > -np.inf)), before)
        near = np.lexsort((-free, text_at[beside]))
        sides = np.searchsorted(text_at[beside[near]], np.arange(len(todo) + 1))
        for i, d in enumerate(todo):
            g, so_far, path = now[d][:3]
            lo, hi = bounds[0][i], bounds[1][i]
            whole = np.concatenate([path, edge[lo:hi]])
            found[d].append((whole, so_far + float(logp[hi] - logp[lo]), g))
            for j in near[sides[i]:min(sides[i + 1], sides[i] + left)]:
                gap, e = g - float(free[j]), other[j]
                bound = g - max(gap, 0.0) - float(np.log1p(np.exp(-abs(gap))))
                opened[d].append((bound, float(before[beside[j]] + lat.logp[e]), (whole, len(path) + beside[j] - lo, e),
                                  int(unit[beside[j]]), int(lat.head[e])))
            opened[d] = sorted(opened[d], key=lambda x: -x[0])[:left]
            now[d] = None
            if opened[d]:
                g, so_far, (whole, at, e), u, n = opened[d].pop(0)
                now[d] = (g, so_far, np.append(whole[:at], e), u, n)
    ids = iter(_ids(lat, [path for samples in found for path, _, _ in samples], voc))
    out = []
    for d, samples in enumerate(found):
        rest = now[d][0] if now[d] is not None else None
        out.append([(next(ids), p, g, None if rest is None else _log_inclusion(p - rest)) for _, p, g in samples])
    return out


def _ids(lat: Lattices, paths: list[np.ndarray], voc: Vocabulary) -> list[np.ndarray]:
    """Vocabulary numbers of each path; characters without a piece become bytes."""
    ends = np.cumsum([len(p) for p in paths])
    ids = lat.ident[np.concatenate(paths)] if paths else np.zeros(0, np.int64)
    bare = np.flatnonzero(ids < 0)
    if len(bare):
        code = -1 - ids[bare]
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        n = np.ones(len(ids), np.int64)
        n[bare] = width
        past = np.concatenate([[0], np.cumsum(n)])
        start, ends = past[bare], past[ends]
        ids = np.repeat(ids, n)
        for size, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            at, c = start[width == size], code[width == size]
            ids[at] = voc.bytes[lead | (c >> 6 * (size - 1))]
            for j in range(1, size):
                ids[at + j] = voc.bytes[0x80 | (c >> 6 * (size - 1 - j)) & 0x3F]
    ids, at = ids.astype(np.int32), [0, *ends.tolist()]
    return [ids[lo:hi] for lo, hi in zip(at, at[1:], strict=False)]


SCHEMA = ("doc_id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
          "ids array<int>")


def encode(docs: DataFrame, k: int = SAMPLES, alpha: float = ALPHA, model: str = MODEL) -> DataFrame:
    """Up to ``k`` distinct sampled segmentations of each document's whole
    text, the most probable after noise first (sample 1)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(model)
        for batch in batches:
            ids, seeds, texts = (batch.column(i).to_pylist() for i in range(3))
            begin = chars = 0
            for i, text in enumerate(texts):
                chars += len(text)
                if chars >= BATCH_CHARS or i + 1 == len(texts):
                    part = slice(begin, i + 1)
                    yield _rows(ids[part], seeds[part], texts[part], k, voc, alpha)
                    begin, chars = i + 1, 0

    rows = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.lit("segmentation"), F.col("doc_id"), F.col("text")).alias("seed"), "text")
    return rows.mapInArrow(run, SCHEMA)


def _rows(ids: list, seeds: list, texts: list[str], k: int, voc: Vocabulary, alpha: float) -> pa.RecordBatch:
    samples = sample_batch(texts, [s % (1 << 64) for s in seeds], k, voc, alpha)
    flat = [(i, n, *sample) for i, of in zip(ids, samples, strict=True) for n, sample in enumerate(of, 1)]
    pieces = [row[2] for row in flat]
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
    columns = [pa.array([row[0] for row in flat], pa.int64()), pa.array([row[1] for row in flat], pa.int32()),
               pa.array(lengths), *[pa.array([row[j] for row in flat], pa.float64()) for j in (3, 4, 5)],
               pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def decode(samples: DataFrame, column: str = "ids", model: str = MODEL) -> DataFrame:
    """``samples`` with ``__text``, the text of each segmentation."""

    ship(samples.sparkSession)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        voc = vocabulary(model)
        return ids.map(lambda x: None if x is None else voc.decode(x))

    return samples.withColumn("__text", text(F.col(column)))
