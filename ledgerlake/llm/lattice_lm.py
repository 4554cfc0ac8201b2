"""Document probabilities from a subword lattice.

Texts are tokens: words between white space (A-Z lower-cased) and one end. A word's lattice
has an arc for every piece of a public vocabulary that fits, and for every character spelled
in bytes; a forward recursion in log space sums the weights of all segmentations. Weights
start from the vocabulary's own scores (its pieces are ranked: a Zipf law over the ranks) and
are re-estimated once by the forward-backward expected counts of all training words. More
arcs span a whole word: its share of the training words, and its share of the words before
it in the document. Arc weights add up to one over all words:

    P(end) = c(end) / N;  P(word) = P(not end) * ((1 - u) * seen + u * lattice(word)),
    seen = (1 - MIXED) * c / n + MIXED * (the same over all classes),
    u the share of training words that occur once (at least 1 in n + 1);
    with i tokens before it, k of them the same: (1 - g) * P + g * k / i, g = CACHE * i / (i + LAG).

Training rows may carry a class (a language); there is a set of weights and counts for each
of the `CLASSES` most frequent, one for the others. A text's class is never read: its
probability is the sum over classes of the class' share of the training rows times the
probability given the class. Without a class column there is one class.

Counts, weights and scores cover all rows. Each word of the corpus is counted and scored
once, in a table; words with at least 1 / `FREQUENT` of all tokens (at most `FREQUENT` of
them, whatever the input) are broadcast, the others join their documents by a 64-bit hash
of the word, so no joined key has more than that share of the tokens. Vocabulary files must
be at the same path on every machine.

Defined results: a null text is an empty text: its only token is the end; repeated rows get
equal results; rows with a null id are training rows; a null class is one of the others;
without training rows nothing is known, P(end) is 1/2 and words have their lattice
probability; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
CLASSES = 6
MIXED = 0.05
FREQUENT = 1_000_000
CACHE, LAG = 0.3, 30.0
PRIOR_TOKENS = 10_000.0
GROUP_WORDS = 16_384
BUFFER_WORDS = 60_000
COUNTER_WORDS = 300_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_START = "▁"
_BASE = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_POINTS = 0x10000  # characters beyond count as one


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_LOWER).split()


@dataclass
class Pieces:
    """hashes (sorted) and ids of the pieces; byte b has id `byte[b]`; log weights by class
    and id; `maybe` marks the heads of the hashes."""

    hashes: np.ndarray
    ids: np.ndarray
    byte: np.ndarray
    longest: int
    log_p: np.ndarray
    maybe: np.ndarray

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names, byte, ranks = [], np.zeros(256, np.int64), np.full(sp.get_piece_size(), np.inf)
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte[int(p[3:5], 16)] = i
                ranks[i] = sp.get_piece_size()
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and _START not in p[1:]:
                names.append((i, p))
                ranks[i] = -sp.get_score(i) + 1
        hashes = np.array([_hashes(np.array([[ord(c)] for c in p], np.uint64))[-1, 0] for _, p in names], np.uint64)
        order = np.argsort(hashes)
        maybe = np.zeros(1 << 20, bool)
        maybe[hashes >> np.uint64(44)] = True
        prior = np.where(np.isfinite(ranks), 1 / (ranks + 2.7), 0)
        with np.errstate(divide="ignore"):
            log_p = np.log(prior / prior.sum())[None, :]
        return cls(hashes[order], np.array([i for i, _ in names])[order], byte, max(len(p) for _, p in names), log_p, maybe)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, ids) of the hashes that are pieces."""
        at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        some = h[at]
        spot = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        hit = self.hashes[spot] == some
        return at[hit], self.ids[spot[hit]]

    def spelled(self) -> np.ndarray:
        """Log weight of each character spelled in bytes: [class, character]."""
        c = np.arange(_POINTS + 1)
        b = self.log_p[:, self.byte]
        one = b[:, np.minimum(c, 127)]
        two = b[:, 0xC0 | (c >> 6) & 0x1F] + b[:, 0x80 | c & 0x3F]
        three = b[:, 0xE0 | (c >> 12) & 0x0F] + b[:, 0x80 | (c >> 6) & 0x3F] + b[:, 0x80 | c & 0x3F]
        out = np.where(c < 0x80, one, np.where(c < 0x800, two, three))
        out[:, _POINTS] = b[:, list("\U00010348".encode())].sum(axis=1)
        return out


def _hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of the prefixes of words in the columns of `points`."""
    out = np.zeros((len(points) + 1, points.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for i, row in enumerate(points):
            out[i + 1] = out[i] * _BASE + (row.astype(np.uint64) + np.uint64(1)) * _SPREAD
    return out


def equal_lengths(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, characters [place, word]) of words of one length, start mark included."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for i in range(0, len(at), GROUP_WORDS):
            some = at[i:i + GROUP_WORDS]
            flat = np.frombuffer("".join(words[j] for j in some).encode("utf-32-le", "surrogatepass"), np.uint32)
            marks = np.full((1, len(some)), ord(_START), np.uint32)
            yield some, np.concatenate([marks, flat.reshape(len(some), n).T])


Arcs = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def arcs(pieces: Pieces, points: np.ndarray) -> Arcs:
    """(from, to) -> (words, piece ids) over words of one length. A piece with the start mark
    fits at the start only."""
    n = len(points)
    prefix = _hashes(points)
    out: Arcs = {}
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(pieces.longest, _BASE)]).astype(np.uint64))
        for i in range(n):
            marked = points[i] == ord(_START)
            for j in range(i + 1, min(n, i + pieces.longest) + 1):
                at, ids = pieces.find(prefix[j] - prefix[i] * powers[j - i])
                if i and marked.any():
                    at, ids = at[~marked[at]], ids[~marked[at]]
                if len(at):
                    out[i, j] = at, ids
    return out


def forward(found: Arcs, points: np.ndarray, log_p: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """Log weight of all segmentations of each prefix: [place, word]."""
    n = len(points)
    into: dict[int, list[int]] = {}
    for i, j in found:
        into.setdefault(j, []).append(i)
    a = np.full((n + 1, points.shape[1]), -np.inf)
    a[0] = 0
    for j in range(1, n + 1):
        if j > 1:  # the start mark is never spelled
            a[j] = a[j - 1] + spelled[np.minimum(points[j - 1], _POINTS)]
        for i in into.get(j, ()):
            at, ids = found[i, j]
            a[j, at] = np.logaddexp(a[j, at], a[i, at] + log_p[ids])
    return a


def log_lattice(pieces: Pieces, words: list[str]) -> np.ndarray:
    """Natural log of each word's lattice probability: [class, word]."""
    out = np.zeros((len(pieces.log_p), len(words)))
    spelled = pieces.spelled()
    for some, points in equal_lengths(words):
        found = arcs(pieces, points)
        for k, log_p in enumerate(pieces.log_p):
            out[k, some] = forward(found, points, log_p, spelled[k])[-1]
    return out


def expected_counts(pieces: Pieces, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in all segmentations of the counted words, by class:
    counts [class, word] -> [class, piece]. Weights are those of class 0."""
    log_p, spelled = pieces.log_p[0], pieces.spelled()[0]
    out = np.zeros((len(counts), len(log_p)))
    points_used = np.zeros((len(counts), _POINTS + 1))
    for some, points in equal_lengths(words):
        found = arcs(pieces, points)
        fore = forward(found, points, log_p, spelled)
        n = len(points)
        clipped = np.minimum(points, _POINTS)
        back = np.full_like(fore, -np.inf)
        back[n] = 0
        for i in range(n - 1, -1, -1):
            if i:
                back[i] = back[i + 1] + spelled[clipped[i]]
            for j in range(i + 1, min(n, i + pieces.longest) + 1):
                if (i, j) in found:
                    at, ids = found[i, j]
                    back[i, at] = np.logaddexp(back[i, at], log_p[ids] + back[j, at])
        total = fore[n]
        every_id, every_at, every_use = [], [], []
        for (i, j), (at, ids) in found.items():
            every_id.append(ids)
            every_at.append(at)
            every_use.append(np.exp(fore[i, at] + log_p[ids] + back[j, at] - total[at]))
        ids, at, use = (np.concatenate(x) if x else np.zeros(0, int) for x in (every_id, every_at, every_use))
        by_bytes = np.exp(fore[1:n] + spelled[clipped[1:]] + back[2:] - total) if n > 1 else np.zeros((0, points.shape[1]))
        for k, c in enumerate(counts):
            mine = c[some]
            if mine.any():
                out[k] += np.bincount(ids, use * mine[at], out.shape[1])
                points_used[k] += np.bincount(clipped[1:].ravel(), (by_bytes * mine).ravel(), _POINTS + 1)
    for point in np.flatnonzero(points_used.any(axis=0)):
        char = chr(point) if point < _POINTS else "\U00010348"
        for b in char.encode("utf-8", "replace"):
            out[:, pieces.byte[b]] += points_used[:, point]
    return out


def buffered(batches: Iterator[pa.RecordBatch], rows: int = BUFFER_WORDS) -> Iterator[pa.Table]:
    """Batches joined to tables of at least `rows` rows: short work on many words at once."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def training(id_column):
    """Rows to learn from; a null id is one of them."""
    return F.coalesce(F.crc32(id_column.cast("string")) % FOLDS != HELD_OUT, F.lit(True))


def word_counts(docs: DataFrame, id_col: str, text_col: str, class_of) -> DataFrame:
    """(word, class, n): uses of every word in the training rows of a class; class -1: in
    rows that are held out."""
    common.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.when(training(F.col(id_col)), class_of).otherwise(F.lit(-1)).cast("int").alias("class"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for k, counter in held.items():
                words, n = list(counter), list(counter.values())
                for i in range(0, len(words), 50_000):
                    some = n[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w.decode() for w in words[i:i + 50_000]], pa.string()),
                         pa.array([k] * len(some), pa.int32()), pa.array(some, pa.int64())], names=["word", "class", "n"])
            held.clear()

        for batch in batches:
            for text, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(k, Counter()).update(words_of(text))
                if sum(map(len, held.values())) > COUNTER_WORDS:
                    yield from out()
        yield from out()

    return rows.mapInArrow(count, "word string, class int, n long")


@dataclass
class Totals:
    """By class: training words, documents, and words seen once; `types` distinct words."""

    words: np.ndarray
    docs: np.ndarray
    once: np.ndarray
    types: int

    @property
    def tokens(self) -> int:
        return int(self.words.sum() + self.docs.sum())

    @property
    def denominator(self) -> int:
        """Of the base score: all training tokens and one more per distinct one and unknown."""
        return self.tokens + self.types + int(self.docs.sum() > 0) + 1

    @property
    def end(self) -> np.ndarray:
        both = self.words + self.docs
        return np.where((self.words > 0) & (self.docs > 0), self.docs / np.maximum(both, 1), 0.5)

    @property
    def prior(self) -> np.ndarray:
        n = self.docs.sum()
        return self.docs / n if n else np.full(len(self.docs), 1 / len(self.docs))


def word_probabilities(c: np.ndarray, lattice: np.ndarray, t: Totals) -> np.ndarray:
    """P(word | class) without history: c and lattice are [class, word]."""
    all_words = max(t.words.sum(), 1)
    unseen = np.where(t.words > 0, np.maximum(t.once, 1) / (t.words + 1), 1.0)[:, None]
    seen = (1 - MIXED) * c / np.maximum(t.words, 1)[:, None] + MIXED * c.sum(axis=0) / all_words
    return (1 - t.end)[:, None] * ((1 - unseen) * seen + unseen * lattice)


def reestimated(words: DataFrame, pieces: Pieces, classes: int) -> np.ndarray:
    """Log weights of the pieces by class, from all training words."""
    sent = words.sparkSession.sparkContext.broadcast(pieces)
    names = [f"c{k}" for k in range(classes)]

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, sent.value.log_p.shape[1]))
        for table in buffered(batches):
            counts = np.array([table[c].to_numpy() for c in names], dtype=float)
            total += expected_counts(sent.value, table["word"].to_pylist(), counts)
        k, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(at, pa.int64()), pa.array(total[k, at])], names=["k", "id", "n"])

    known = words.where(F.greatest(*[F.col(c) for c in names], F.lit(0)) > 0).select("word", *names)
    sums = known.mapInArrow(expect, "k long, id long, n double").groupBy("k", "id").agg(F.sum("n").alias("n"))
    n = np.repeat(PRIOR_TOKENS * np.exp(pieces.log_p), classes, axis=0)
    for k, i, x in sums.collect():  # a row per class and piece of the vocabulary at most
        n[k, i] += x
    with np.errstate(divide="ignore"):
        return np.log(n / n.sum(axis=1, keepdims=True))


def scored_words(words: DataFrame, pieces: Pieces, totals: Totals) -> DataFrame:
    """(code, word, known, base, p, uses): each word's hash, whether training rows have it,
    its base score and its probability by class."""
    sent = words.sparkSession.sparkContext.broadcast((pieces, totals))
    classes = len(totals.docs)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, t = sent.value
        for table in buffered(batches):
            names = table["word"].to_pylist()
            c = np.array([table[f"c{k}"].to_numpy() for k in range(classes)], dtype=float)
            p = word_probabilities(c, np.exp(log_lattice(pieces, names)), t)
            base = np.log10((c.sum(axis=0) + 1) / t.denominator)
            rows = pa.ListArray.from_arrays(np.arange(0, classes * len(names) + 1, classes, dtype=np.int32), p.T.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes([n.encode() for n in names])), table["word"].combine_chunks(), pa.array(c.sum(axis=0) > 0),
                 pa.array(base), rows, table["uses"].combine_chunks()], names=["code", "word", "known", "base", "p", "uses"])

    return words.mapInArrow(add, "code long, word string, known boolean, base double, p array<double>, uses long")


def codes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False).view(np.int64) if words else np.zeros(0, np.int64)


class Counted:
    """Scores texts as far as frequent words go; the others are listed."""

    def __init__(self, frequent: list[tuple], totals: Totals) -> None:
        self.ids = {w.encode(): i for i, (w, *_) in enumerate(frequent)}
        self.known = np.array([x[1] for x in frequent] + [False])
        self.base = np.array([x[2] for x in frequent] + [0.0])
        self.p = np.array([x[3] for x in frequent] + [[1.0] * len(totals.docs)]).T
        self.totals = totals

    def documents(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, tuple[np.ndarray, ...]]:
        """([n_tokens, n_known, base], scores [class, text], (text, code, stay, cache)): sums
        per text over frequent words and the end, then one row per use of another word."""
        lists = [words_of(t) for t in texts]
        rare: dict[bytes, int] = {}
        ids, seen = self.ids, len(self.ids)
        flat = np.array([ids[w] if w in ids else seen + rare.setdefault(w, len(rare)) for ws in lists for w in ws], np.int64)
        n = np.array([len(ws) for ws in lists])
        doc = np.repeat(np.arange(len(lists)), n)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        # How many of the same word come before each token in its document.
        key = doc * np.int64(seen + len(rare) + 1) + flat
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], np.diff(key[order]) != 0])[:len(key)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) if len(key) else np.zeros(0, int)
        before = np.empty(len(key), np.int64)
        before[order] = np.arange(len(key)) - first
        g = CACHE * place / (place + LAG)
        cache = g * before / np.maximum(place, 1)
        at = np.minimum(flat, seen)  # the last entry stands for all others
        t = self.totals
        g_end = CACHE * n / (n + LAG)
        ends = t.docs.sum()
        sums = [n + 1, np.bincount(doc, self.known[at], len(n)).astype(np.int64) + int(ends > 0),
                np.bincount(doc, self.base[at], len(n)) + np.log10((ends + 1) / t.denominator)]
        usual = flat < seen
        some, p_at, stay, old = doc[usual], at[usual], 1 - g[usual], cache[usual]
        scores = np.array([np.bincount(some, np.log10(stay * p[p_at] + old), len(n)) for p in self.p])
        scores = scores + np.log10((1 - g_end)[None, :] * t.end[:, None])
        left = np.flatnonzero(~usual)
        names = codes(list(rare))
        return sums, scores, (doc[left], names[flat[left] - seen], 1 - g[left], cache[left])


def document_scores(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                    class_col: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    pieces = Pieces.load(path)
    learn = docs.where(training(F.col(id_col)))
    label = F.col(class_col).cast("string") if class_col else F.lit("all")
    by_class = learn.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    kept = by_class.where("label is not null").orderBy(F.desc("n"), "label").limit(CLASSES).collect()
    others = sum(r["n"] for r in by_class.agg(F.sum("n").alias("n")).collect() if r["n"]) - sum(r["n"] for r in kept)
    doc_counts = [r["n"] for r in kept] + [others] * (others > 0 or not kept)
    class_of = F.lit(len(doc_counts) - 1)
    for k, r in enumerate(kept):
        class_of = F.when(label == r["label"], F.lit(k)).otherwise(class_of)
    names = [f"c{k}" for k in range(len(doc_counts))]

    counted = word_counts(docs, id_col, text_col, class_of).groupBy("word").agg(
        F.sum("n").alias("uses"), *[F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(F.lit(0))).alias(c) for k, c in enumerate(names)])
    words = common.written(counted, "words")
    seen = F.greatest(*[F.col(c) for c in names], F.lit(0)) > 0
    row = words.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("uses"), F.count_if(seen).alias("types"),
                    *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
                    *[F.count_if(F.col(c) == 1).alias(f"once_{c}") for c in names]).first()
    totals = Totals(np.array([row[c] for c in names]), np.array(doc_counts), np.array([row[f"once_{c}"] for c in names]), row["types"])
    pieces.log_p = reestimated(words, pieces, len(names))
    words = common.written(scored_words(words, pieces, totals), "scored-words")
    frequent = [tuple(r) for r in words.where(F.col("uses") * FREQUENT >= row["uses"]).select("word", "known", "base", "p").collect()]
    sent = spark.sparkContext.broadcast((frequent, totals))

    common.bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    sums = [f"s{k}" for k in range(len(names))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counted(*sent.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in common.byte_batches([t or "" for t in texts], 2_000_000):
                (n_tokens, n_known, base), scores, (doc, code, stay, cache) = counted.documents(texts[a:b])
                some = batch.slice(a, b - a)
                key, h = some.column(0), some.column(1)
                none = pa.nulls(b - a, pa.float64())
                # Sums have a code of their own (the text's hash), so that they spread evenly.
                yield pa.RecordBatch.from_arrays(
                    [key, h, h, none, none, pa.array(n_tokens), pa.array(n_known), pa.array(base), *map(pa.array, scores)], names=columns)
                for i in range(0, len(doc), 100_000):
                    part = slice(i, i + 100_000)
                    take = pa.array(doc[part])
                    empty = [pa.nulls(len(take), kind) for kind in (pa.int64(), pa.int64(), *[pa.float64()] * (1 + len(scores)))]
                    yield pa.RecordBatch.from_arrays(
                        [key.take(take), h.take(take), pa.array(code[part]), pa.array(stay[part]), pa.array(cache[part]), *empty], names=columns)

    columns = ["id", "h", "code", "stay", "cache", "n_tokens", "n_known", "base", *sums]
    parts = source.mapInArrow(score, f"id {id_type}, h long, code long, stay double, cache double, n_tokens long, n_known long, "
                                     "base double, " + ", ".join(f"{c} double" for c in sums))
    rare = words.where(F.col("uses") * FREQUENT < row["uses"]).select(
        "code", "known", F.col("base").alias("word_base"), *[F.col("p")[k].alias(f"p{k}") for k in range(len(sums))])
    is_sum = F.col("stay").isNull()
    joined = parts.join(rare, "code", "left")
    by_doc = joined.groupBy("id", "h").agg(
        F.count_if(is_sum).alias("copies"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(is_sum, F.col("n_known")).otherwise(F.col("known").cast("long"))).alias("n_known"),
        F.sum(F.when(is_sum, F.col("base")).otherwise(F.col("word_base"))).alias("base"),
        *[F.sum(F.when(is_sum, F.col(c)).otherwise(F.log10(F.col("stay") * F.col(f"p{k}") + F.col("cache")))).alias(c)
          for k, c in enumerate(sums)])
    # Rows with equal id and text were summed together: one row for each again.
    mean = by_doc.select("id", "copies", *[F.floor(F.col(k) / F.col("copies")).alias(k) for k in ("n_tokens", "n_known")],
                         *[(F.col(k) / F.col("copies")).alias(k) for k in ("base", *sums)])
    weighted = [F.col(c) + math.log10(w) for c, w in zip(sums, totals.prior) if w > 0]
    top = F.greatest(*weighted) if len(weighted) > 1 else weighted[0]
    total = top + F.log10(sum((F.pow(F.lit(10.0), w - top) for w in weighted[1:]), F.pow(F.lit(10.0), weighted[0] - top)))
    return mean.select(
        F.col("id").alias(id_col), (~training(F.col("id"))).alias("held_out"), "n_tokens", "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), total.alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return document_scores(common.table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), class_col="lang")
