"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions, answers) are normalised to words: A-Z lower-cased, words are
runs of ASCII letters, digits and non-ASCII characters. A window is `window` consecutive
words of an item; an item of fewer words, but not none, is one window. All windows become
one automaton over the normalised text, which is scanned once; hits map back to offsets of
the original text.

The benchmark goes to the workers as text, in blocks whose windows hold at most
`block_bytes` x `window` characters (those of about `block_bytes` of text): each may become
a node of the automaton, so that is what bounds a worker's memory. The windows of a long
item are split over blocks. A worker builds the automaton of a block once. A benchmark
beyond one block takes a pass per block, which reads the texts and writes nothing but the
hits, under the text's hash; the hits of all blocks meet in one grouping and join the rows
once. No text is written, whatever the number of blocks.

Defined results: null and word-less texts have no words and no hits; null or word-less
items have no windows; equal windows of several items count for each of them; repeated
items with one id count as one; items with a null id mark words but are in no id list;
an empty benchmark hits nothing; input columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlake.llm import common

WINDOW = 10
BLOCK_BYTES = 256 * 1024

# A word of the original text, as `common.words_of` cuts it.
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"

#: The automaton that this worker process built last, under its block's key.
_held: dict[str, ahocorasick.Automaton | None] = {}


def build(items: list[tuple[str | None, str]], window: int) -> ahocorasick.Automaton | None:
    """Automaton over (id, text); each pattern holds its word count and its items' ids."""
    owners: dict[str, set[str]] = {}
    for item, text in items:
        # Bytes as Latin-1 characters: one character a byte, which the automaton indexes.
        words = [w.decode("latin-1") for w in common.words_of(text)]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(f" {' '.join(words[i:i + window])} ", set()).add(item)
    if not owners:
        return None
    a = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        a.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(ids)))
    a.make_automaton()
    return a


def scan(text: str | None, automaton: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set]:
    """Words of the text, hit word ranges [from, to) in order and merged, ids of hit items."""
    words = common.words_of(text)
    if automaton is None or not words:
        return len(words), [], set()
    flat = f" {b' '.join(words).decode('latin-1')} "
    hits = list(automaton.iter(flat))
    if not hits:
        return len(words), [], set()
    starts = np.array([end + 1 - v[0] for end, v in hits])
    # The n-th word follows the n-th space.
    spaces = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 32)
    first = np.searchsorted(spaces, starts)
    last = first + np.array([v[1] for _, v in hits])
    return len(words), merged(zip(first.tolist(), last.tolist())), {i for _, v in hits for i in v[2]}


def merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def to_offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as [start, end) code points of the original text."""
    raw = text.encode("utf-8", "replace")
    b = np.frombuffer(raw, np.uint8)
    inside = np.frombuffer(raw.translate(common.WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
    return [(int(points[starts[i]]), int(points[ends[j - 1]])) for i, j in ranges]


_FIELDS = ("n_words long, hits array<struct<first:int,last:int>>, items array<string>, "
           "spans array<struct<start:long,end:long>>")


def _pieces(text: str, window: int, most: int) -> Iterator[tuple[str, int]]:
    """Normalised stretches of an item that hold each of its windows once, with the characters
    of these windows: at most `most`, or one window."""
    words = [w.decode("utf-8", "replace") for w in common.words_of(text)]
    if not words:
        return
    size = np.array([len(w.encode()) + 1 for w in words])
    ends = np.concatenate([[0], np.cumsum(size)])
    n = max(1, len(words) - window + 1)
    chars = ends[np.minimum(np.arange(n) + window, len(words))] - ends[:n] + 1
    sums = np.concatenate([[0], np.cumsum(chars)])
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + most, side="right")) - 1)
        yield " ".join(words[at:to + window - 1]), int(sums[to] - sums[at])
        at = to


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int, window: int) -> Iterator[list]:
    """Distinct items in blocks of at most `block_bytes` x `window` characters of windows (one
    window at least); a longer item is in several."""
    most = block_bytes * window
    block, held = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).where(
        F.col(text_col).isNotNull()).distinct()
    for item, text in rows.toLocalIterator():
        for piece, chars in _pieces(text, window, most):
            if block and held + chars > most:
                yield block
                block, held = [], 0
            block.append((item, piece))
            held += chars
    if block:
        yield block


def _automaton(key: str, block: list, window: int) -> ahocorasick.Automaton | None:
    if key not in _held:
        _held.clear()
        _held[key] = build(block, window)
    return _held[key]


def _pass(docs: DataFrame, carry: list[str], text_col: str, block: list, window: int) -> DataFrame:
    sent, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def make():
        automaton = _automaton(key, sent.value, window)

        def work(texts: list) -> list:
            found = [scan(t, automaton) for t in texts]
            return [[n for n, _, _ in found],
                    [[{"first": a, "last": b} for a, b in hits] for _, hits, _ in found],
                    [sorted(x for x in items if x is not None) for _, _, items in found],
                    [[{"start": a, "end": b} for a, b in to_offsets(t, hits)] if hits else []
                     for t, (_, hits, _) in zip(texts, found)]]

        return work

    return common.map_texts(docs, carry, text_col, _FIELDS, make)


def united(parts: list[dict]) -> tuple[list[dict], list[str], list[dict]]:
    """Hits, items and spans of one text from those of several blocks."""
    ranges = sorted((h["first"], h["last"], s["start"], s["end"])
                    for part in parts for h, s in zip(part["hits"], part["spans"]))
    out: list[tuple[int, int, int, int]] = []
    for first, last, start, end in ranges:
        if out and first <= out[-1][1]:
            f, l, a, b = out[-1]
            out[-1] = (f, max(l, last), a, max(b, end))
        else:
            out.append((first, last, start, end))
    return ([{"first": r[0], "last": r[1]} for r in out], sorted({i for part in parts for i in part["items"]}),
            [{"start": r[2], "end": r[3]} for r in out])


def _all_hits(texts: DataFrame, blocks: Iterable[list], window: int) -> DataFrame:
    """(t1, t2, hits, items, spans) of every different text that any block hits; `texts` has
    text, t1 and t2."""
    passes = [common.written(
        _pass(texts, ["t1", "t2"], "text", block, window).where(F.size("hits") > 0).select(
            "doc.*", F.struct("hits", "items", "spans").alias("part")), "hits") for block in blocks]
    # Rows of one text have equal hits, so a group holds at most one part a block.
    parts = reduce(DataFrame.union, passes).groupBy("t1", "t2").agg(F.collect_set("part").alias("parts"))
    schema = StructType.fromDDL("t1 long, t2 long, hits array<struct<first:int,last:int>>, items array<string>, "
                                "spans array<struct<start:long,end:long>>")
    kinds = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [united(x) for x in batch.column(2).to_pylist()]
            columns = [[r[i] for r in results] for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x, k.type) for x, k in zip(columns, list(kinds)[2:])]],
                names=kinds.names)

    return common.written(parts.mapInArrow(work, schema), "hits")


def scan_documents(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc, n_words, hits, items, spans) of every row: `doc` holds the columns `carry`, hits
    are merged word ranges, items the ids (as text) found, spans the hit stretches of the
    original text as [start, end) code points."""
    blocks = _blocks(benchmark, item_id, item_text, block_bytes, window)
    block, more = next(blocks, []), next(blocks, None)
    if more is None:
        return _pass(docs, carry, text_col, block, window)
    text = F.col(f"`{text_col}`")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), text.alias("text"),
                        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    hits = _all_hits(keyed.select("text", "t1", "t2").where("text is not null"), chain([block, more], blocks), window)
    n_words = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    none = [F.coalesce(c, F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("hits", "items", "spans")]
    return keyed.select("doc", n_words.alias("n_words"), "t1", "t2").join(hits, ["t1", "t2"], "left").select(
        "doc", "n_words", *none)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    n_hit = F.expr("aggregate(hits, 0L, (n, h) -> n + h.last - h.first)")
    return scan_documents(docs, benchmark, [id_col], text_col, **options).select(
        f"doc.`{id_col}`", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window; columns as in `docs`."""
    return scan_documents(docs, benchmark, docs.columns, text_col, **options).where(
        F.size("hits") == 0).select("doc.*")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")).drop("spans")
