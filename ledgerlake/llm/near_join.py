"""N-gram Jaccard join by MinHash banding.

Texts are sets of hashed word five-grams (a text of fewer words is one gram). Rows with
equal sets are one set from then on, whatever their number. Band and row counts are the
cheapest that find a pair at the threshold with `RECALL`; sets are shuffled on band hashes.
Buckets with the same members are one. In a bucket, members whose MinHash sketches agree as
often as those of a pair at the threshold do (all but a tenth of what `RECALL` leaves) are
connected, so sets that only share boilerplate, which meets in many buckets, do not become
one group. In the candidate groups all pairs are verified on the full gram sets, once per
pair: a group is cut into chunks and a task gets two chunks, so a pair needs neither a row
of its own nor its bucket in one task. A task returns per set the number of links and one
link that keeps its sets connected; the links' components are the classes.

Work is linear in the rows but for sets of one bucket or candidate group that really differ:
those of a bucket are compared by sketches, until all are connected, and the pairs of a
group are counted (not emitted) in blocks of `CHUNK_SETS`, as every link between different
texts counts.

Defined results: null, empty and word-less texts have no grams, link to nothing and are
classes of one row; repeated rows and equal sets link to each other; the class id is the
smallest id of the class (null ids last); an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 128
CHUNK_SETS = 512
CHUNK_GRAMS = 1_000_000
BUCKET_SETS = 4096
GRAM_COLUMNS = 8192


def banding(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which `most` hashes find a pair at the
    threshold with the recall. More rows, fewer false candidates."""
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def agreeing(threshold: float, hashes: int, recall: float = RECALL) -> int:
    """The least number of equal MinHashes that a pair at the threshold reaches, but for a
    tenth of the share that the recall leaves."""
    below, least = 0.0, 0
    while least < hashes:
        below += math.comb(hashes, least) * threshold ** least * (1 - threshold) ** (hashes - least)
        if below > (1 - recall) / 10:
            break
        least += 1
    return least


def gram_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """The sorted, distinct 64-bit hashes of each text's word n-grams."""
    lists = [common.words_of(t) for t in texts]
    flat = [w for ws in lists for w in ws]
    if not flat:
        return [np.zeros(0, np.uint64) for _ in texts]
    with np.errstate(over="ignore"):
        h = pd.util.hash_array(np.array(flat, dtype=object), categorize=True)
        factors = common.mix64(np.arange(n), 7) | np.uint64(1)
        full = np.zeros(max(0, len(h) - n + 1), np.uint64)
        for i in range(n):
            full += h[i:i + len(full)] * factors[i]
        full = common.mix64(full)
        out, at = [], 0
        for ws in lists:
            k = len(ws)
            if k >= n:
                out.append(np.unique(full[at:at + k - n + 1]))
            elif k:
                short = (h[at:at + k] * factors[:k]).sum(dtype=np.uint64) + np.uint64(k)
                out.append(common.mix64(np.array([short]), 11))
            else:
                out.append(np.zeros(0, np.uint64))
            at += k
    return out


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> tuple[list[list[int]], list[bytes]]:
    """Per set one signed 64-bit hash a band (band numbers are part of it), and 16 bits of each
    MinHash; none if empty."""
    full = [i for i, s in enumerate(sets) if len(s)]
    out: list[list[int]] = [[] for _ in sets]
    sketches = [b""] * len(sets)
    if not full:
        return out, sketches
    grams = np.concatenate([sets[i] for i in full])
    starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
    xors, factors = common.mix64(np.arange(bands * rows), 1), common.mix64(np.arange(bands * rows), 2) | np.uint64(1)
    bucket = np.zeros((len(full), bands), np.uint64)
    sketch = np.zeros((len(full), bands * rows), np.uint16)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(full), b, np.uint64)
            for k in range(b * rows, (b + 1) * rows):
                least = common.mix64(np.minimum.reduceat((grams ^ xors[k]) * factors[k], starts))
                sketch[:, k] = (least >> np.uint64(48)).astype(np.uint16)
                h = common.mix64(h) + least
            bucket[:, b] = common.mix64(h)
    for i, row, mine in zip(full, bucket.view(np.int64).tolist(), sketch):
        out[i], sketches[i] = row, mine.tobytes()
    return out, sketches


def set_names(sets: list[np.ndarray]) -> list[str | None]:
    """128 bits of each set as hex digits; none for an empty set."""
    with np.errstate(over="ignore"):
        return [f"{int(common.mix64(s, 3).sum(dtype=np.uint64)):016x}{int(common.mix64(s, 5).sum(dtype=np.uint64)):016x}"
                if len(s) else None for s in sets]


def _row_key(docs: DataFrame):
    """128 bits of a whole row: fully equal rows share it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(F.xxhash64(*columns).alias("r1"), F.xxhash64(F.lit(1), *columns).alias("r2"))


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, n: int) -> DataFrame:
    """(id, r1, r2, set, grams, buckets, sketch) of every row, written once."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _row_key(docs).alias("key")).select(
        "id", "text", "key.*")

    def make():
        def work(texts: list) -> list:
            out: list[list] = [[], [], [], []]
            for a, b in common.byte_batches([t or "" for t in texts], 2_000_000):
                sets = gram_sets(texts[a:b], n)
                out[0] += set_names(sets)
                out[1] += [len(s) for s in sets]
                for column, got in zip(out[2:], band_hashes(sets, bands, rows)):
                    column += got
            return out

        return work

    signed = common.map_texts(keyed, ["id", "r1", "r2"], "text", "set string, grams int, buckets array<long>, sketch binary", make)
    return common.written(signed.select("doc.*", "set", "grams", "buckets", "sketch"), "signatures")


def _first(*columns: str):
    """The least row by id, nulls last."""
    return F.min(F.struct(F.col("id").isNull().alias("last"), "id", *columns))


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[tuple]]]:
    """The rows of each task; batches are sorted by their first column, the task."""
    now, rows = None, []
    for batch in batches:
        for task, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if task != now:
                if rows:
                    yield now, rows
                now, rows = task, []
            rows.append(tuple(row))
    if rows:
        yield now, rows


def connected(sketches: np.ndarray, least: int) -> np.ndarray:
    """Per sketch the number of the first one that it is connected to by pairs with `least`
    equal hashes. Only sketches that nothing has reached yet are compared with the next."""
    root = np.full(len(sketches), -1)
    left = np.arange(len(sketches))
    for first in range(len(sketches)):
        if root[first] >= 0:
            continue
        root[first], front = first, [first]
        left = left[left != first]
        while front and len(left):
            near = (sketches[left] == sketches[front.pop()]).sum(axis=1) >= least
            if near.any():
                root[left[near]] = first
                front += left[near].tolist()
                left = left[~near]
    return root


def candidate_groups(sets: DataFrame, least: int) -> DataFrame:
    """(node, root): the sets that a bucket connects with another, and their group."""
    members = sets.select("set", F.explode("buckets").alias("bucket"))
    lists = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("set")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("y")).where("n > 1")
    # Keyed by the complement and written, so that both sides of the join have an exchange of
    # their own and the adaptive skew join can split a bucket that very many sets share.
    shared = common.written(lists.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select(
        F.bitwise_not("bucket").alias("code"), F.ceil(F.col("n") / BUCKET_SETS).cast("int").alias("chunks")), "buckets")
    own = F.pmod(F.xxhash64("set", F.lit(2)), F.col("chunks")).cast("int")
    dealt = sets.select("set", "sketch", F.explode("buckets").alias("bucket")).withColumn(
        "code", F.bitwise_not("bucket")).join(shared, "code").withColumn("mine", own).select(
        "code", "set", "sketch", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    task = F.struct("code", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_task(batches):
            if len(rows) > 1:
                names, sketches = zip(*rows)
                root = connected(np.frombuffer(b"".join(sketches), np.uint16).reshape(len(rows), -1), least)
                held = np.flatnonzero(root != np.arange(len(rows))).tolist()
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i] for i in held]), pa.array([names[root[i]] for i in held])], names=["a", "b"])

    edges = dealt.select(task.alias("task"), "set", "sketch").repartition("task").sortWithinPartitions("task", "set")
    return components(edges.mapInArrow(work, "a string, b string"))


def verified(docs: DataFrame, sets: DataFrame, groups: DataFrame, text_col: str, n: int, threshold: float) -> DataFrame:
    """(a, b, links) per set of a group and task: `a` is linked to `b`, directly or through
    others; `links` counts rows whose different set is similar to a's."""
    t = Fraction(threshold).limit_denominator(1000)
    chosen = groups.join(sets.withColumnRenamed("set", "node"), "node")
    # Written, so that the join by root has an exchange on both sides and a large group splits.
    sizes = common.written(groups.join(sets.select(F.col("set").alias("node"), "grams"), "node").groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK_SETS), F.ceil(F.sum("grams") / CHUNK_GRAMS)).cast("int").alias("chunks")), "group-sizes")
    chosen = chosen.join(sizes, "root").select("root", "node", "copies", "chunks", F.col("least.r1").alias("r1"), F.col("least.r2").alias("r2"))
    texts = docs.select(F.col(text_col).alias("text"), _row_key(docs).alias("key")).select("text", "key.*")
    # Fully equal rows are one before the shuffle, which the limit on their number reaches.
    once = F.row_number().over(Window.partitionBy("r1", "r2").orderBy("r1"))
    texts = texts.withColumn("n", once).where("n = 1").drop("n")
    found = texts.join(chosen, ["r1", "r2"]).drop("r1", "r2")
    gram = common.map_texts(found, ["root", "node", "copies", "chunks"], "text", "grams binary",
                            lambda: lambda texts: [[s.tobytes() for s in gram_sets(texts, n)]])
    mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = gram.select("doc.*", "grams").withColumn("mine", mine).select(
        "root", "node", "copies", "grams", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    task = F.struct("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    dealt = dealt.select(task.alias("task"), "node", (F.col("mine") == F.least("mine", "other")).alias("left"), "copies", "grams")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for task, rows in _by_task(batches):
            out += _links(task, rows, t)
            if len(out) > 10_000:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    return dealt.repartition("task").sortWithinPartitions("task", "node").mapInArrow(work, "a string, b string, links long")


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, n = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n, pa.int64())], names=["a", "b", "links"])


def _links(task: dict, rows: list[tuple], t: Fraction) -> list[tuple[str, str, int]]:
    """Links of one task: between two chunks, or within one."""
    if len(rows) < 2:
        return []
    sets = [np.frombuffer(r[3], np.uint64) for r in rows]
    size = np.array([len(s) for s in sets])
    grams, local = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    common_gram = np.bincount(local, minlength=len(grams)) > 1
    column = np.cumsum(common_gram) - 1
    keep = common_gram[local]
    owner, column = owner[keep], column[local][keep]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(common_gram.sum()), GRAM_COLUMNS):
        a, b = np.searchsorted(column, [start, start + GRAM_COLUMNS])
        m = np.zeros((len(sets), min(GRAM_COLUMNS, int(column[b - 1]) - start + 1)), np.float32)
        m[owner[a:b], column[a:b] - start] = 1
        shared += m @ m.T
    # inter / (|a| + |b| - inter) >= p / q, in whole numbers.
    inter = np.rint(shared).astype(np.int64)
    link = inter * (t.numerator + t.denominator) >= t.numerator * (size[:, None] + size[None, :])
    np.fill_diagonal(link, False)
    if task["i"] != task["j"]:
        left = np.array([r[1] for r in rows])
        link &= left[:, None] != left[None, :]
    copies = np.array([r[2] for r in rows])
    n = link @ copies
    root = np.arange(len(rows))
    while True:  # smallest linked number, until nothing changes
        least = np.where(link, root[None, :], len(rows)).min(axis=1)
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(rows[i][0], rows[root[i]][0], int(n[i])) for i in np.flatnonzero(n)]


def near_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
              words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """(id, r1, r2, class_id, n_links, least) of every row; (r1, r2) names the row's content
    and `least` that of the class' row that stays if only one does."""
    bands, rows = banding(threshold, recall)
    common.bounded_batches(docs.sparkSession)
    signed = signatures(docs, id_col, text_col, bands, rows, words)
    sets = common.written(signed.where("set is not null").groupBy("set").agg(
        _first("r1", "r2").alias("least"), F.count("*").alias("copies"), F.first("buckets").alias("buckets"),
        F.first("grams").alias("grams"), F.first("sketch").alias("sketch")), "sets")
    groups = candidate_groups(sets, agreeing(threshold, bands * rows, recall))
    links = common.written(verified(docs, sets.drop("buckets", "sketch"), groups, text_col, words, threshold), "links")
    classes = components(links.select("a", "b"))
    per_set = sets.select("set", "least", "copies").join(
        links.groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("links")), "set", "left").join(
        classes.withColumnsRenamed({"node": "set"}), "set", "left").withColumn("root", F.coalesce("root", "set"))
    per_set = common.written(per_set, "set-classes")
    least = common.written(per_set.groupBy("root").agg(F.min("least").alias("class_least")), "class-least")
    per_set = common.written(per_set.join(least, "root").select(
        "set", "class_least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "set-classes")
    own = F.struct(F.col("id").isNull().alias("last"), "id", "r1", "r2")
    return signed.drop("buckets", "grams", "sketch").join(per_set, "set", "left").select(
        "id", "r1", "r2", F.coalesce("class_least", own).alias("least"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")).withColumn("class_id", F.col("least.id"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one row of each class, the one with the smallest id; of fully
    equal rows one. Columns as in `docs`."""
    joined = near_join(docs, id_col, text_col, **options)
    stay = common.written(joined.select("least.r1", "least.r2").distinct(), "staying")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_key(docs).alias("key"))
    once = keyed.select("doc", "key.*").join(stay, ["r1", "r2"], "left_semi")
    n = F.row_number().over(Window.partitionBy("r1", "r2").orderBy("r1"))
    return once.withColumn("n", n).where("n = 1").select("doc.*")


def op9_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = near_join(common.table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "class_id", "n_links")
