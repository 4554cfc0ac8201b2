"""Token counts of whole texts by a public byte-level BPE vocabulary.

Texts go to Python in Arrow batches; within one, work is dealt in runs of about
`RUN_CHARS` characters. Each text is cut where the vocabulary's pre-tokenizer cuts in any
case, the pieces are encoded and only lengths return. A piece's length does not depend on
its neighbours, so pieces met before in the worker are looked up (a bounded cache).

Safe cuts: before one space or line feed between two characters that are not white space.
The pre-tokenizer starts a new token there whatever follows, and no special string holds
white space. A piece that is still long (text without spaces) is cut after an ASCII letter
before an ASCII digit or mark, or after a letter before a full-width mark.

Defined results: null text = empty text = 0 tokens; rows repeat as they come; an empty
table gives an empty result; input columns other than `id_col` and `text_col` are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import common

VOCABULARY = "byte_bpe_50k.json"
RUN_CHARS = 1_000_000
LONG_PIECE = 65_536
CACHE_PIECES = 1_000_000
CACHED_CHARS = 64

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_LONG_CUT = re.compile(r"(?<=[A-Za-z])(?=[0-9.,;:!?])|(?<=[^\W\d_])(?=[、。！，？])")

_tokenizers: dict[str, object] = {}
_caches: dict[str, dict[str, int]] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[path], _caches[path] = t, {}
    return _tokenizers[path], _caches[path]


def pieces(text: str) -> list[str]:
    """`text` cut at safe boundaries; the pieces joined are the text."""
    out = _CUT.split(text)
    if len(text) > LONG_PIECE and any(len(p) > LONG_PIECE for p in out):
        out = [q for p in out for q in (_LONG_CUT.split(p) if len(p) > LONG_PIECE else [p])]
    return out


def count_tokens(texts: list[str], path: str) -> list[int]:
    tokenizer, cache = _tokenizer(path)
    cut = [pieces(t) if t else [] for t in texts]
    new = list({p for ps in cut for p in ps if p not in cache})
    known = cache
    if new:
        encoded = tokenizer.encode_batch_fast(new, add_special_tokens=False)
        lengths = {p: len(e) for p, e in zip(new, encoded)}
        if len(cache) + len(new) > CACHE_PIECES:
            # What this run needs, then a fresh start.
            known = {p: cache[p] for ps in cut for p in ps if p in cache} | lengths
            cache.clear()
        else:
            cache.update((p, n) for p, n in lengths.items() if len(p) <= CACHED_CHARS)
            if any(len(p) > CACHED_CHARS for p in new):
                known = _Both(lengths, cache)
    get = known.__getitem__
    return [sum(map(get, ps)) for ps in cut]


class _Both(dict):
    """Lengths of this run, else of the cache."""

    def __init__(self, first: dict, second: dict) -> None:
        super().__init__(first)
        self._second = second

    def __missing__(self, key):
        return self._second[key]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; `path` names a tokenizers .json file
    that every machine holds."""
    common.bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n: list[int] = []
            for a, b in common.byte_batches(texts, RUN_CHARS):
                n += count_tokens(texts[a:b], path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
