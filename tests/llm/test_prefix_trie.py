"""The prefix trie and its contraction against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [y[3:] for y in sorted(v, key=lambda y: y[:3])] for c, v in own.items()}
    built = dict(own)
    if rebuild:
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            built[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += kids[k] == 0
    return {
        (min(m), len(k)): (min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(
            ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest())
        for k, m in members.items()}


def found(df, rebuild=True):
    placed, sizes = prefix_trie.places(df)
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt(placed, sizes)) if rebuild else prefix_trie.prefix_trie(
        placed.join(sizes, "conv_id"), sizes, chunk=64)
    rows = trie.collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_edge_rows(spark):
    """Nulls in every column, equal turns, equal rows, empty and long texts, negative ids, a
    base that is shorter than the head or absent, clashing names; each twice in one table."""
    rng = random.Random(3)
    rows = [(None, 0, "user", "no conversation"), (0, None, None, None), (0, 1, "user", "a b"), (0, 1, "user", "a b"),
            (0, 1, "bot", "a\x0bb"), (20, 0, "", ""), (23, None, "user", "x" * 300_000), (23, 7, "user", "y z " * 50_000),
            (-5, 0, "user", "q"), (-20, 0, "user", "q"), (-20, 1, "user", "r"), (999, 5, "user", "alone")]
    for c in range(1, 60):
        rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "so so", None, "a b c"])) for t in range(rng.randrange(5))]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_convs", F.lit(1)).withColumn("x.y", F.lit("e"))
    assert found(df) == brute(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(df) == {}


def test_hot_first_turn_and_deep_chain(spark, monkeypatch):
    """Most conversations are one text; one is far longer than a block of turns: its chain is
    contracted in logarithmically many rounds."""
    names = []
    written = prefix_trie.common.written
    monkeypatch.setattr(prefix_trie.common, "written", lambda df, name: names.append(name) or written(df, name))
    rows = [(c, 0, "user", "hello there") for c in range(400)] + [(7, t, "bot", f"w{t % 5}") for t in range(1, 300)]
    rows += [(9, t, "bot", f"w{t % 5}") for t in range(1, 200)]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(4), rebuild=False)
    assert got == brute(rows, rebuild=False)
    assert names.count("raked") < 25


@pytest.mark.parametrize("seed", [1, 2])
def test_contraction_of_random_trees(spark, seed):
    rng = random.Random(seed)
    up = {i: None if i == 0 else (i - 1 if rng.random() < 0.7 else rng.randrange(i)) for i in range(500)}
    value = {i: rng.randrange(-5, 100) for i in up}
    total = dict(value)
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            total[up[i]] += total[i]
    df = spark.createDataFrame([(i, up[i], value[i], 1) for i in up], "id long, up long, v long, one long")
    got = {r.id: (r.v, r.one) for r in prefix_trie.subtree_totals(df, ["v", "one"]).collect()}
    assert {i: x[0] for i, x in got.items()} == total and got[0][1] == 500


def test_digest_of_listed_ids_streams_over_blocks(spark):
    ids = spark.range(0, 40_000).select(F.lit("a").cast("binary").alias("name"), (F.col("id") * 3 - 1000).alias("conv_id"))
    want = hashlib.sha256(",".join(str(i * 3 - 1000) for i in range(40_000)).encode()).hexdigest()
    got = prefix_trie.listed_digests(ids, block=1000).collect()
    assert [(bytes(r.name), r.ends_sha256) for r in got] == [(b"a", want)]
