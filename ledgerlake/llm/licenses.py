"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Paragraphs are lines, and windows of words over adjacent lines, as notices are wrapped: a
window is a stretch of a block (lines up to one without words; comment marks are no words)
that holds `CONFIRM` of a template's word pairs within `STRETCH` times its words. The best
windows that share no word count, so a line may give several families. What is reported is
the stretch of whole lines.

A sparse multinomial logistic regression over the word n-grams
(`NGRAMS`) that occur in the templates gives each the probability of every licence family
and of `unknown`. It is trained on the templates, on copies of them with words dropped and
with foreign words around, on shuffled templates and on lines of a bounded sample of the
documents (`SAMPLE_DOCS`, the only thing that is sampled); the latter two are unknown. A
temperature, fitted on copies that training has not seen, calibrates the probabilities, so
that a paragraph is unknown when `unknown` is the likeliest, or nothing reaches `LEAST`. A
prediction counts when the paragraph holds `CONFIRM` of the word pairs of one of the
family's templates; otherwise it is reported as unconfirmed.

Every line and window of every text is classified; a line or block without any word of a
template that is not a stop word is unknown without looking further, as it can hold `CONFIRM`
of none (a number is no such word). A window replaces what the lines it touches gave by its words alone.

Defined results: a null text is an empty text; empty texts have no paragraphs; repeated rows
get equal results; an empty table gives an empty result; columns other than id and text are
ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.license_templates import STOP_WORDS, TEMPLATES

NGRAMS = (1, 2, 3)
SAMPLE_DOCS = 200
SAMPLE_CHARS = 20_000
COPIES = 60
DROPPED = 0.2
LEAST = 0.5
CONFIRM = 0.6
# Paragraphs whose features are held at a time, and characters that are looked through for
# an anchor word at a time: they bound the memory of a long text.
SLICE = 1000
STEP_CHARS = 65_536
STRETCH = 2
STEPS = 300
RATE = 0.3
L2 = 1e-4
SEED = 11

_LINE = re.compile(r"[^\n]+")
# Comment marks that are words, at the start of a line.
_MARK = re.compile(r"[ \t]*(?:rem|dnl)(?![^ \t])", re.IGNORECASE)
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)


def _words(text: str) -> list[str]:
    return [w.decode("utf-8", "replace") for w in common.words_of(text)]


def ngrams(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for n in NGRAMS for i in range(len(words) - n + 1)}


def pairs(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:]))


TEMPLATE_PAIRS = tuple(tuple(pairs(_words(t)) for t in TEMPLATES[f]) for f in FAMILIES)
VOCABULARY = {g: i for i, g in enumerate(sorted({g for f in FAMILIES for t in TEMPLATES[f] for g in ngrams(_words(t))}))}
# Every template (its family and place among the family's), and those that hold a pair.
PLACES = tuple((c, i) for c, ts in enumerate(TEMPLATE_PAIRS) for i in range(len(ts)))
HOLDERS: dict[tuple[str, str], list[int]] = {}
for _at, (_c, _i) in enumerate(PLACES):
    for _pair in TEMPLATE_PAIRS[_c][_i]:
        HOLDERS.setdefault(_pair, []).append(_at)
LENGTHS = tuple(STRETCH * len(_words(TEMPLATES[FAMILIES[c]][i])) for c, i in PLACES)
ANCHORS = frozenset(w.encode() for f in FAMILIES for t in TEMPLATES[f] for w in _words(t)
                    if w not in STOP_WORDS and not w.isdigit())
# Only the templates' words take part in n-grams and pairs; all others are one, so that a
# word of a long text costs a reference.
KNOWN = {w.encode(): w for f in FAMILIES for t in TEMPLATES[f] for w in _words(t)}
OTHER = "\0"


@dataclass
class Model:
    """weights [n-gram, class] with the intercepts in the last row; temperature."""

    weights: np.ndarray
    temperature: float

    def probabilities(self, paragraphs: list[list[str]]) -> np.ndarray:
        return softmax(_matrix(paragraphs) @ self.weights / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(paragraphs: list[list[str]]) -> np.ndarray:
    x = np.zeros((len(paragraphs), len(VOCABULARY) + 1))
    x[:, -1] = 1
    for row, words in zip(x, paragraphs):
        row[[VOCABULARY[g] for g in ngrams(words) if g in VOCABULARY]] = 1
    return x


def _examples(lines: list[str], rng: np.random.Generator) -> tuple[list[list[str]], np.ndarray]:
    foreign = [ws for ws in map(_words, lines) if ws and ANCHORS.isdisjoint(w.encode() for w in ws)] or [["lorem", "ipsum", "dolor"]]

    def around(words: list[str]) -> list[str]:
        out = list(words)
        if rng.random() < 0.5:
            more = foreign[rng.integers(len(foreign))][: int(rng.integers(1, 30))]
            out = [*more, *out] if rng.random() < 0.5 else [*out, *more]
        return out

    x, y = [list(ws) for ws in foreign[:2000]], [UNKNOWN] * min(2000, len(foreign))
    for c, family in enumerate(FAMILIES):
        for template in map(_words, TEMPLATES[family]):
            for _ in range(COPIES // len(TEMPLATES[family])):
                kept = [w for w in template if rng.random() >= DROPPED * rng.random()]
                x.append(around(kept or template))
                y.append(c)
            for _ in range(COPIES // (3 * len(TEMPLATES[family]))):
                x.append(around([template[i] for i in rng.permutation(len(template))][: max(1, len(template) // 2)]))
                y.append(UNKNOWN)
    return x, np.array(y)


def train(lines: list[str]) -> Model:
    x, y = _examples(lines, np.random.default_rng(SEED))
    m, target = _matrix(x), np.eye(UNKNOWN + 1)[y]
    w, seen = np.zeros((m.shape[1], UNKNOWN + 1)), 1e-8
    weight = (len(y) / np.bincount(y, minlength=UNKNOWN + 1).clip(1))[y][:, None] ** 0.5
    weight /= weight.mean()
    for _ in range(STEPS):
        g = m.T @ ((target - softmax(m @ w)) * weight) / len(y) - L2 * w
        seen = seen + g * g
        w += RATE * g / np.sqrt(seen)
    held, truth = _examples(lines, np.random.default_rng(SEED + 1))
    z = _matrix(held) @ w
    at = np.arange(len(truth))
    loss = {t: -np.log(softmax(z / t)[at, truth].clip(1e-12)).mean() for t in np.geomspace(0.2, 5, 40)}
    return Model(w, min(loss, key=loss.get))


def sample_lines(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Lines of `SAMPLE_DOCS` texts at most (also if many share an id), the same in every rerun."""
    order = F.xxhash64(F.lit("licences"), "_id")
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().orderBy(order, "_id").limit(SAMPLE_DOCS)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(
        F.length("_text") <= SAMPLE_CHARS).join(F.broadcast(ids), "_id").select("_text").distinct().orderBy(
        F.xxhash64("_text"), "_text").limit(SAMPLE_DOCS)
    return sorted(line for (text,) in rows.toLocalIterator() for line in text.split("\n") if line.strip())


def _candidates(words: list[str]) -> list[tuple[int, int, int]]:
    """(template, from, to) of the windows that hold `CONFIRM` of a template's pairs: for each
    last pair the longest that is not too long, without repeated pairs at its start."""
    hits: dict[int, list[int]] = {}
    pair_at: dict[int, tuple[str, str]] = {}
    for i, pair in enumerate(zip(words, islice(words, 1, None))):
        for at in HOLDERS.get(pair, ()):
            pair_at[i] = pair
            hits.setdefault(at, []).append(i)
    out = []
    for at, places in hits.items():
        c, i = PLACES[at]
        need, seen, first = CONFIRM * len(TEMPLATE_PAIRS[c][i]), Counter(), 0
        if len(places) < need:
            continue
        for last in places:
            seen[pair_at[last]] += 1
            while True:
                pair = pair_at[places[first]]
                if last + 2 - places[first] <= LENGTHS[at] and (seen[pair] == 1 or places[first] == last):
                    break
                seen[pair] -= 1
                if not seen[pair]:
                    del seen[pair]
                first += 1
            if len(seen) >= need:
                out.append((at, places[first], last + 2))
    return out


def windows(words: list[str]) -> list[tuple[int, int]]:
    """[from, to) of the best windows: those that hold most of a template's pairs come first,
    later ones are cut to the words that are left."""
    def rated(at: int, a: int, b: int) -> tuple | None:
        c, i = PLACES[at]
        mine = TEMPLATE_PAIRS[c][i]
        held = [k for k in range(a, b - 1) if (words[k], words[k + 1]) in mine]
        n = len({(words[k], words[k + 1]) for k in held})
        if n < CONFIRM * len(mine):
            return None
        a, b = held[0], held[-1] + 2
        return -n / len(mine), -n, b - a, a, b, at

    heap = [r for r in (rated(*x) for x in _candidates(words)) if r]
    heapq.heapify(heap)
    taken, out = bytearray(len(words)), []
    while heap:
        *_, a, b, at = heapq.heappop(heap)
        if taken.find(1, a, b) < 0:
            out.append((a, b))
            taken[a:b] = b"\1" * (b - a)
            continue
        for m in re.finditer(rb"\0+", taken[a:b]):
            if r := rated(at, a + m.start(), a + m.end()):
                heapq.heappush(heap, r)
    return sorted(out)


def _alike(c: int, mine: set) -> float:
    return max(len(t & mine) / len(t) for t in TEMPLATE_PAIRS[c])


def _classified(ranges: list[tuple[int, int]], words: list[str], model: Model) -> list[tuple[int, float, float] | None]:
    """(family, probability, similarity) of each range of words, or nothing if it is unknown."""
    out: list[tuple[int, float, float] | None] = []
    for at in range(0, len(ranges), SLICE):
        part = [words[a:b] for a, b in ranges[at:at + SLICE]]
        for paragraph, row in zip(part, model.probabilities(part)):
            c = int(row.argmax())
            out.append(None if c == UNKNOWN or row[c] < LEAST else (c, float(row[c]), _alike(c, pairs(paragraph))))
    return out


@dataclass
class Block:
    """Adjacent lines: where each starts and ends in the text, its first word's place among
    the words, and the lines that hold an anchor word."""

    line_starts: array = field(default_factory=lambda: array("q"))
    line_ends: array = field(default_factory=lambda: array("q"))
    starts: array = field(default_factory=lambda: array("q"))
    words: list[str] = field(default_factory=list)
    asked: list[int] = field(default_factory=list)

    def add(self, start: int, end: int, words: list[bytes]) -> None:
        if not ANCHORS.isdisjoint(words):
            self.asked.append(len(self.starts))
        self.line_starts.append(start)
        self.line_ends.append(end)
        self.starts.append(len(self.words))
        self.words.extend(KNOWN.get(w, OTHER) for w in words)


def _in_block(block: Block, model: Model) -> list[dict]:
    """Licence paragraphs of a block."""
    starts, words, asked = block.starts, block.words, block.asked

    def end(i: int) -> int:
        return starts[i + 1] if i + 1 < len(starts) else len(words)

    spans = windows(words)
    got = _classified(spans + [(starts[i], end(i)) for i in asked], words, model)
    # Confirmed windows: [first line, last line], words, result.
    firm = [(bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1, a, b, r)
            for (a, b), r in zip(spans, got) if r and r[2] >= CONFIRM]
    found: dict[tuple[int, int, int], tuple[int, float, float]] = {}
    over: dict[int, list] = {}
    for w in firm:
        for i in range(w[0], w[1] + 1):
            over.setdefault(i, []).append(w)
        key = (w[0], w[1], w[4][0])
        found[key] = max(found.get(key, w[4]), w[4], key=lambda r: r[2])
    for i, r in zip(asked, got[len(spans):]):
        if not r:
            continue
        on = over.get(i, [])
        if r[2] < CONFIRM:
            if on:
                continue
        elif (i, i, r[0]) not in found and on:
            # Only what the line holds beside the windows confirms another family.
            free, at = set(), starts[i]
            for _, _, a, b, _ in sorted(on, key=lambda w: w[2]):
                free |= pairs(words[at:max(at, a)])
                at = max(at, b)
            if _alike(r[0], free | pairs(words[at:end(i)])) < CONFIRM:
                continue
        found[i, i, r[0]] = r
    return [{"family": FAMILIES[c], "start": block.line_starts[i], "end": block.line_ends[j], "probability": r[1],
             "similarity": r[2], "confirmed": r[2] >= CONFIRM} for (i, j, c), r in sorted(found.items())]


def _has_anchor(text: str) -> bool:
    """Whether the text holds an anchor word, by stretches of whole lines."""
    at = 0
    while at < len(text):
        end = text.find("\n", at + STEP_CHARS)
        end = len(text) if end < 0 else end
        if not ANCHORS.isdisjoint(common.words_of(text[at:end])):
            return True
        at = end
    return False


def find(text: str, model: Model) -> list[dict]:
    """Licence paragraphs of a text, in order, with [start, end) code points."""
    if not text or not _has_anchor(text):
        return []
    out: list[dict] = []
    block = Block()

    def close() -> None:
        nonlocal block
        if block.asked:
            out.extend(_in_block(block, model))
        block = Block()

    at = 0
    for m in _LINE.finditer(text):
        words = common.words_of(_MARK.sub("", m[0], count=1))
        if m.start() > at + 1 or not words:
            close()
        at = m.end()
        if words:
            block.add(*m.span(), words)
    close()
    return out


_FIELDS = ("n_paragraphs long, found array<struct<family:string,start:long,end:long,probability:double,"
           "similarity:double,confirmed:boolean>>")


def scan(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text") -> DataFrame:
    """(doc, n_paragraphs, found) of every row; `doc` holds the columns `carry`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(texts: list) -> list:
            return [[sum(1 for line in (t or "").split("\n") if line) for t in texts],
                    [find(t, sent.value) if t else [] for t in texts]]

        return work

    return common.map_texts(docs, carry, text_col, _FIELDS, make)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its confirmed families (sorted, comma-joined), how many
    paragraphs name one, how many predictions no template confirms, and all of them."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(sample_lines(docs, "doc_id", "text"))
    found = scan(docs, model, ["doc_id"])
    confirmed = F.filter("found", lambda x: x["confirmed"])
    return found.select(
        "doc.doc_id", "n_paragraphs",
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda x: x["family"]))), ",").alias("families"),
        F.size(confirmed).cast("long").alias("n_licenses"),
        (F.size("found") - F.size(confirmed)).cast("long").alias("n_unconfirmed"), "found")
