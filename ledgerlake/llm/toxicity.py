"""Toxic spans by a linear-chain conditional random field.

Labels are of documents, so labelled tokens are made first, from a bounded sample of the
training rows (`SAMPLE_DOCS` of each label, up to `SAMPLE_CHARS` characters each; nothing
else is sampled): a token is toxic if it, or a prefix of it, occurs in toxic documents, in
`SEED_DOCS` of them and between `SEED_CONTEXTS` different pairs of neighbours at least, and
`SEED_RATIO` times as often as in clean ones. Neighbours keep copies of one passage from
passing for evidence. The field has two states (other, toxic); a token's features are
itself, prefixes, suffixes and its two neighbours, hashed; chains are trained by Adagrad on
the conditional likelihood of sentences of the sample. All sentences of all texts are scored:
forward-backward marginals give each token's probability. A logistic curve, fitted to the
same sample, takes a document's expected toxic count and largest marginal to its score;
offsets are those of tokens with a marginal of 0.5 or more.

A chain is a sentence: it ends at a line feed or at . ! ? before white space. With two
states the recursions run on odds, for all sentences of a length class at once.

Defined results: a null text is an empty text; a text without tokens has the score of no
toxic token; repeated rows get equal results; when the sample lacks one of the labels every
score is the share of toxic rows in it (0 without any); an empty table gives an empty
result; columns other than id and text never enter a score; null labels are no labels.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

FOLDS = 5
SAMPLE_DOCS = (2000, 1000)  # clean, toxic
SAMPLE_CHARS = 20_000
SEED_DOCS = 3
SEED_CONTEXTS = 5
SEED_RATIO = 50.0
PREFIXES = (4, 5, 6)
SUFFIXES = ()
FEATURES = 1 << 18
CHAINS = 10_000
STEPS = 40
ROUNDS = 2
RATE = 0.5
L2 = 1e-5
CACHE_WORDS = 300_000
SPREAD = 30.0  # logits are kept within this

# A token, or a mark that ends a sentence.
_TOKEN = re.compile(r"[^\W_]+|\n|[.!?](?=\s)")


@dataclass
class Model:
    """weights: own, as previous neighbour, as next one, by feature; moves: [from, to] as
    factors; curve: intercept, expected count, largest marginal."""

    weights: np.ndarray
    moves: np.ndarray
    curve: np.ndarray


def features(word: str) -> list[int]:
    w = word.lower()
    names = [f"={w}", *(f"^{w[:k]}" for k in PREFIXES if len(w) >= k), *(f"{w[-k:]}$" for k in SUFFIXES if len(w) >= k)]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def chains(text: str) -> list[list[str]]:
    out, now = [], []
    for t in _TOKEN.findall(text):
        if t in "\n.!?":
            if now:
                out.append(now)
            now = []
        else:
            now.append(t)
    return [*out, now] if now else out


def marginals(logits: np.ndarray, lengths: np.ndarray, moves: np.ndarray, joint_too: bool = True
              ) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token, and (if asked) the sums over all tokens but first ones of
    P(state before, state), 2 by 2. Chains follow each other in `logits`."""
    (m00, m01), (m10, m11) = moves
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    e = np.exp(np.clip(logits, -SPREAD, SPREAD))
    p, pairs = np.zeros(len(e)), np.zeros((2, 2))
    classes = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
    for c in np.unique(classes[lengths > 0]):
        sel = np.flatnonzero((classes == c) & (lengths > 0))
        n, first = lengths[sel], starts[sel]
        longest = int(n.max())
        inside = np.arange(longest)[:, None] < n[None, :]
        at = np.minimum(first[None, :] + np.arange(longest)[:, None], len(e) - 1)
        x = e[at]
        fore, back = np.empty_like(x), np.ones_like(x)
        fore[0] = x[0]
        for t in range(1, longest):
            fore[t] = np.clip(x[t] * (m01 + fore[t - 1] * m11) / (m00 + fore[t - 1] * m10), 1e-200, 1e200)
        for t in range(longest - 2, -1, -1):
            ahead = x[t + 1] * back[t + 1]
            back[t] = np.where(inside[t + 1], (m10 + m11 * ahead) / (m00 + m01 * ahead), 1.0)
        odds = fore * back
        p[at[inside]] = (odds / (1 + odds))[inside]
        if joint_too and longest > 1:
            ahead, f = x[1:] * back[1:], fore[:-1]
            joint = np.stack([m00 + 0 * f, m01 * ahead, m10 * f, m11 * f * ahead], axis=-1)
            joint /= joint.sum(axis=-1, keepdims=True)
            pairs += joint[inside[1:]].sum(axis=0).reshape(2, 2)
    return p, pairs


class Scorer:
    """Marginals of whole texts; potentials of words met before are kept (bounded)."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.ids: dict[str, int] = {}
        self.parts = np.zeros((3, 1024))

    def _id(self, word: str) -> int:
        i = self.ids[word] = len(self.ids) + 1  # 0 ends a sentence
        if i >= self.parts.shape[1]:
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)], axis=1)
        self.parts[:, i] = self.model.weights[:, features(word)].sum(axis=1)
        return i

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(P(toxic) per token of all texts, tokens per text)."""
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
        known, new, flat, sizes = self.ids, self._id, [], []
        for text in texts:
            before = len(flat)
            flat += [0 if t in "\n.!?" else known[t] if t in known else new(t) for t in _TOKEN.findall(text or "")]
            flat.append(0)
            sizes.append(len(flat) - before)
        ids = np.array(flat, dtype=np.int64)
        own, before, after = (part[ids] for part in self.parts)
        logits = own + np.concatenate([[0.0], before[:-1]]) + np.concatenate([after[1:], [0.0]])
        word = ids > 0
        ends = np.flatnonzero(~word)
        lengths = np.diff(np.concatenate([[-1], ends])) - 1
        p = marginals(logits[word], lengths, self.model.moves, False)[0]
        spread = np.zeros(len(ids))
        spread[word] = p
        counts = np.add.reduceat(word.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]])) if sizes else np.zeros(0, int)
        return p, counts

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(score, expected toxic tokens, P(toxic) per token, tokens) of the texts."""
        p, counts = self.tokens(texts)
        x = summaries(p, counts)
        return 1 / (1 + np.exp(-np.clip(x @ self.model.curve, -SPREAD, SPREAD))), np.expm1(x[:, 1]), p, counts

    def spans(self, text: str, p: np.ndarray) -> list[dict[str, int]]:
        words = (m for m in _TOKEN.finditer(text) if m[0] not in "\n.!?")
        return [{"start": m.start(), "end": m.end()} for m, q in zip(words, p) if q >= 0.5]


def summaries(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: 1, log(1 + expected toxic tokens), largest marginal."""
    out = np.zeros((len(counts), 3))
    out[:, 0] = 1.0
    full = np.flatnonzero(counts > 0)
    if len(full):
        at = (np.cumsum(counts) - counts)[full]
        out[full, 1] = np.log1p(np.add.reduceat(p, at))
        out[full, 2] = np.maximum.reduceat(p, at)
    return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[str, int]]:
    """Distinct (text, label) of at most `SAMPLE_DOCS` training rows of each label, the same
    in every rerun. Ids are chosen from the labels, so only their texts travel; an id that
    many rows share with different texts counts as often as it has texts."""
    train = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).distinct()
    order = F.xxhash64(F.lit("toxicity"), "_id")
    ids = [train.where(F.col("_label") == y).orderBy(order, "_id").limit(SAMPLE_DOCS[y]) for y in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))  # sum(SAMPLE_DOCS) rows at most
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(
        F.length("_text") <= SAMPLE_CHARS).join(chosen, "_id").select("_text", "_label").distinct()
    # The larger limit is applied before the shuffle, each label's own after it.
    first = Window.partitionBy("_label").orderBy(F.xxhash64(F.lit("toxicity"), "_text"), "_text")
    most = F.when(F.col("_label") == 0, SAMPLE_DOCS[0]).otherwise(SAMPLE_DOCS[1])
    rows = texts.withColumn("_n", F.row_number().over(first)).where(
        F.col("_n") <= max(SAMPLE_DOCS)).where(F.col("_n") <= most).select("_text", "_label")
    return sorted((r[0], int(r[1])) for r in rows.toLocalIterator())


def held_out(id_column, folds: int = FOLDS):
    return F.coalesce(F.crc32(id_column.cast("string")) % folds == 0, F.lit(False))


def _names(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) >= k)]


def seeds(rows: list[tuple[str, int]]) -> set[str]:
    """Words (=w) and prefixes (^p) that mark toxic tokens. Only names that enough toxic
    documents hold are counted further, which bounds the memory."""
    seen_in: Counter = Counter()
    for text, label in rows:
        if label:
            seen_in.update({n for t in {t.lower() for t in _TOKEN.findall(text)} for n in _names(t)})
    contexts: dict[str, set[int]] = {n: set() for n, k in seen_in.items() if k >= SEED_DOCS}
    clean: Counter = Counter()
    totals = [1, 1]
    for text, label in rows:
        for chain in chains(text.lower()):
            totals[label] += len(chain)
            for i, w in enumerate(chain):
                names = [n for n in _names(w) if n in contexts]
                if label and names:
                    around = zlib.crc32(f"{chain[i - 1] if i else ''} {chain[i + 1] if i + 1 < len(chain) else ''}".encode())
                    for n in names:
                        contexts[n].add(around)
                else:
                    clean.update(names)
    share = totals[0] / totals[1]
    return {n for n, c in contexts.items() if len(c) >= SEED_CONTEXTS and len(c) * share / (clean[n] + 0.5) >= SEED_RATIO}


def train(rows: list[tuple[str, int]]) -> Model:
    marks = seeds(rows)

    def toxic(word: str) -> bool:
        return any(n in marks for n in _names(word.lower()))

    # Sentences as text: lists of words would take many times the memory.
    hot: list[str] = []
    cold: list[str] = []
    for text, label in rows:
        for chain in chains(text):
            (hot if label and any(map(toxic, chain)) else cold).append(" ".join(chain))
    hot = hot[:: max(1, -(-len(hot) // (CHAINS // 2)))]
    easy = cold[:: max(1, -(-len(cold) // (CHAINS // 2)))]
    hard: list[str] = []
    for _ in range(ROUNDS):
        used = [c.split(" ") for c in hot + easy + hard]
        truth = np.array([i < len(hot) and toxic(w) for i, c in enumerate(used) for w in c], dtype=np.int64)
        model = _fit(used, truth)
        # Clean sentences that this model takes for toxic are in the next round.
        x = _summed(Scorer(model), cold)
        hard = [c for c, w in zip(cold, x[:, 2] >= 0.2) if w][: CHAINS // 2]
    model.curve = logistic(_summed(Scorer(model), [t for t, _ in rows]), np.array([y for _, y in rows], dtype=float))
    return model


def _summed(scorer: Scorer, texts: list[str]) -> np.ndarray:
    runs = [summaries(*scorer.tokens(texts[a:b])) for a, b in common.byte_batches(texts, 500_000)]
    return np.concatenate(runs) if runs else np.zeros((0, 3))


def _fit(used: list[list[str]], truth: np.ndarray) -> Model:
    lengths = np.array([len(c) for c in used])
    first = np.zeros(len(truth), bool)
    first[np.cumsum(lengths) - lengths] = True
    last = np.roll(first, -1)

    # Entries (token, feature) of the three parts: own, previous and next neighbour.
    known: dict[str, list[int]] = {}
    own = [known[w] if w in known else known.setdefault(w, features(w)) for c in used for w in c]
    token = np.repeat(np.arange(len(own)), [len(f) for f in own])
    feature = np.array([x for f in own for x in f])
    followed, preceded = ~last[token], ~first[token]
    entries = [(token, feature), (token[followed] + 1, feature[followed]), (token[preceded] - 1, feature[preceded])]

    weights, moves = np.zeros((3, FEATURES)), np.zeros((2, 2))
    seen_w, seen_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    true_pairs = np.zeros((2, 2))
    inner = np.flatnonzero(~first)
    np.add.at(true_pairs, (truth[inner - 1], truth[inner]), 1)
    for _ in range(STEPS):
        logits = np.zeros(len(truth))
        for part, (t, f) in enumerate(entries):
            logits += np.bincount(t, weights[part][f], len(truth))
        p, pairs = marginals(logits, lengths, np.exp(moves))
        gap = truth - p
        for part, (t, f) in enumerate(entries):
            g = np.bincount(f, gap[t], FEATURES) / len(truth) - L2 * weights[part]
            seen_w[part] += g * g
            weights[part] += RATE * g / np.sqrt(seen_w[part])
        g = (true_pairs - pairs) / len(truth) - L2 * moves
        seen_m += g * g
        moves += RATE * g / np.sqrt(seen_m)
        moves -= moves[0, 0]
    return Model(weights.astype(np.float32), np.exp(moves), np.zeros(3))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic regression."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -SPREAD, SPREAD)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        b += np.linalg.solve(h, x.T @ (y - p) - ridge * b)
    return b


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    rows = sample(docs, labels, id_col, text_col, label_col)
    got = Counter(y for _, y in rows)
    if len(got) == 2:
        return train(rows)
    share = min(max(got[1] / max(1, sum(got.values())), 1e-13), 1 - 1e-13)
    level = np.log(share / (1 - share)) if got else -SPREAD
    return Model(np.zeros((3, FEATURES), np.float32), np.array([[1.0, 0.0], [1.0, 0.0]]), np.array([level, 0.0, 0.0]))


_FIELDS = "score double, n_toxic double, spans array<struct<start:long,end:long>>"


def score(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text") -> DataFrame:
    """(doc, score, n_toxic, spans) of every row; `doc` holds the columns `carry`, n_toxic is
    the expected number of toxic tokens, spans are [start, end) code points."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(sent.value)

        def work(texts: list) -> list:
            out: list[list] = [[], [], []]
            for a, b in common.byte_batches([t or "" for t in texts], 2_000_000):
                s, n, p, counts = scorer.documents(texts[a:b])
                ends = np.cumsum(counts)
                out[0] += s.tolist()
                out[1] += n.tolist()
                out[2] += [scorer.spans(t, p[e - c:e]) if c and p[e - c:e].max() >= 0.5 else []
                           for t, c, e in zip(texts[a:b], counts, ends)]
            return out

        return work

    return common.map_texts(docs, carry, text_col, _FIELDS, make)


def without_toxic(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The documents with a score below 0.5; columns as in `docs`."""
    return score(docs, fitted(docs, labels, **columns), docs.columns, columns.get("text_col", "text")).where(
        "score < 0.5").select("doc.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fitted(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select(
        "doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic", "spans")
