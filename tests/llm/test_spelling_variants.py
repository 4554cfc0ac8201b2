"""Spelling variants against plain Python: all words against all by their deletions."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ledgerlake.llm import common, spelling_variants as sv


def brute_counts(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(n):
    holes = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1:]].add(w)
    out = {}
    for w in n:
        near = {u for i in range(len(w)) for u in holes[w[:i] + "\0" + w[i + 1:]]} - {w}
        near |= {u for i in range(len(w)) if (u := w[:i] + w[i + 1:]) in n}
        near |= {u for i in range(len(w) + 1) for u in holes.get(w[:i] + "\0" + w[i:], ())}
        best = min(near, key=lambda u: (-n[u], u), default=None)
        out[w] = [best if best and n[best] >= 2 * n[w] else None, len(near)]
    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return {w: (f, root(w), n[w], k, n[f] if f else None) for w, (f, k) in out.items()}


def found(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_query_equals_brute_force(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text").collect()
    want = brute(brute_counts([tuple(r) for r in docs]))
    assert found(sv.op13_spelling_variants(spark, sf)) == want
    assert sum(f is not None for f, *_ in want.values()) > 50


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_dense_words_over_many_ranges(spark, partitions):
    """Short words of few letters: runs of equal letters, shared prefixes over range borders,
    ties, long chains of forms."""
    rng = random.Random(partitions)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(0, 8))) for _ in range(700)}
    words |= {"a" * k for k in range(30)} | {"x" * 5000, "x" * 5001, "x" * 2500 + "y" + "x" * 2499, "b" + "z" * 4999}
    n = {w: rng.choice([3, 3, 6, 7, 14, 50, 200, 900]) for w in words}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(sv.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(n)


def test_edge_rows(spark):
    """Null ids and texts, empty texts, equal rows, one long text, capitals beyond ASCII, signs
    inside the range of letters, clashing names."""
    rows = [(None, "Colour colour COLOUR"), (1, None), (2, ""), (3, "color " * 9), (3, "color " * 9), (4, "Étés×x " * 3),
            (5, "abc÷def " * 4), (6, "w" * 70_000 + " " + "w" * 70_000 + "\n" + "w" * 70_000), (7, "İstanbul " * 3), (8, "4 5 6")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("n"), F.lit(2).alias("word"), F.lit(3).alias("a.b"))
    counts = sv.word_counts(df)
    want = brute_counts(rows)
    assert {r.word: r.n for r in counts.collect()} == want
    assert found(sv.spelling_variants(counts)) == brute(want)


def test_no_rows(spark):
    assert found(sv.spelling_variants(sv.word_counts(spark.createDataFrame([], "doc_id long, text string")))) == {}
