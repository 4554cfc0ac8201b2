"""Approximate nearest neighbours by a hash-prefix forest.

Each of `TREES` trees gives every vector a string of `BITS` bits (sides of random
hyperplanes); a tree is the sorted array of the strings, a level the length of prefix that
two strings share. Inner product is turned into angle by one more coordinate that brings
all vectors to the largest norm. The trees are cut into buckets by their first bits, about
`BUCKET_ROWS` vectors each; a bucket is a sorted array in one task, and one that holds too
many vectors of one prefix is split by hash. So are the queries that come to a bucket, and
each of their parts meets each of the bucket's.

Search, for all queries at once:
  descend  in its bucket of each tree a query finds the longest prefix that `FIRST` vectors
           share, and scores them; over all trees that bounds its k-th best score below;
  ascend   a vector with that score, at angle a, shares a prefix of l bits in one of the
           trees with probability 1 - (1 - (1 - a/pi)^l)^TREES. All trees go up together to
           the longest l with a probability of `RECALL`, and score all they hold there.
           Where that would score as many vectors as there are, the root of one tree does.

Equal vectors are one entry with the k + 1 smallest ids, all that any list can show, so a
vector that a third of all rows share has one row here. Every vector is indexed. Equal query
vectors are searched once; their list goes to each of their ids at the end.

Defined results: null and zero vectors and those with null or non-finite components take no
part, nor do vectors of another dimension than the most frequent one (the larger of two);
rows with one id count once, with the smallest vector; rows with a null id take no part; a
table without candidates or queries gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

TREES = 16
BITS = 62
BUCKET_ROWS = 4096
FIRST = 200
RECALL = 0.95
SEED = 77
QUERY_ROWS = 256


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>, norm) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))
    rows = rows.groupBy("id").agg(F.min("v").alias("v")).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).where("norm > 0")
    rows = common.written(rows, "vectors")
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (dims["d"] if dims else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(v, norm, ids): distinct vectors with their k + 1 smallest ids. The limit is applied
    before the shuffle, so a vector's copies do not meet in one task."""
    n = F.row_number().over(Window.partitionBy("v", "norm").orderBy("id"))
    return rows.withColumn("n", n).where(F.col("n") <= k + 1).groupBy("v", "norm").agg(
        F.array_sort(F.collect_list("id")).alias("ids"))


def _hashed(rows: DataFrame, largest: float, queries: bool) -> DataFrame:
    """`rows` with `vec` (binary doubles) and `codes`, one per tree."""
    keep = [c for c in rows.columns if c != "v"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = flat.reshape(batch.num_rows, -1)
            if planes is None:
                planes = np.random.default_rng(SEED).normal(size=(x.shape[1] + 1, TREES * BITS))
            norm = np.sqrt((x * x).sum(axis=1))
            more = np.zeros(len(x)) if queries else np.sqrt(np.maximum(largest * largest - norm * norm, 0))
            bits = (np.concatenate([x, more[:, None]], axis=1) @ planes > 0).reshape(len(x), TREES, BITS)
            codes = bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array(codes.tolist(), pa.list_(pa.int64()))], names=[*keep, "vec", "codes"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select("v", *keep).mapInArrow(work, f"{kinds}, vec binary, codes array<long>")


def level_for(score: Column, norm: Column, largest: float, bits: int = BITS, trees: int = TREES, recall: float = RECALL) -> Column:
    """The longest prefix at which a vector with this score is found with `recall`; 0 where
    that would score as many vectors as there are."""
    cos = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score / (norm * largest)))
    same = 1 - F.acos(cos) / math.pi
    need = 1 - (1 - recall) ** (1 / trees)
    level = F.when(same >= 1 - 1e-12, F.lit(bits)).otherwise(F.floor(F.lit(math.log(need)) / F.log(F.greatest(same, F.lit(1e-9)))))
    level = F.least(F.lit(bits), level)
    return F.when(trees * F.pow(F.lit(2.0), -level) >= 1, F.lit(0)).otherwise(level).cast("int")


def _search(index: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best k entries of a bucket part for each query, of those that share its prefix of
    `level` bits; with level -1, of the longest prefix that `FIRST` entries share."""
    columns: tuple[list, list, list] = ([], [], [])
    if index.num_rows and queries.num_rows:
        codes = index["code"].to_numpy()
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        x = np.frombuffer(b"".join(index["vec"].to_pylist()), np.float64).reshape(len(codes), -1)[order]
        names = index["entry"].to_numpy()[order]
        q = np.frombuffer(b"".join(queries["vec"].to_pylist()), np.float64).reshape(queries.num_rows, -1)
        q_code, q_id, level = (queries[c].to_numpy() for c in ("code", "query", "level"))
        low, high = _ranges(codes, q_code, level)
        whole = (low == 0) & (high == len(codes))
        slack = 1e-14 * x.shape[1] * np.sqrt((x * x).sum(axis=1).max())

        def put(i: int, at: np.ndarray, scores: np.ndarray) -> None:
            if len(at) > 2 * k:  # all that reach the cut, whatever the product's rounding
                cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                at = at[scores >= cut - slack * np.sqrt((q[i] * q[i]).sum())]
            if len(at):
                exact = (x[at] * q[i]).sum(axis=1)
                best = np.lexsort((names[at], -exact))[:k + 1]
                columns[0].extend([int(q_id[i])] * len(best))
                columns[1].extend(names[at[best]].tolist())
                columns[2].extend(exact[best].tolist())

        full = np.flatnonzero(whole)
        for a in range(0, len(full), QUERY_ROWS):
            some = full[a:a + QUERY_ROWS]
            every = np.arange(len(codes))
            for i, scores in zip(some.tolist(), q[some] @ x.T):
                put(i, every, scores)
        for i in np.flatnonzero(~whole).tolist():
            put(i, np.arange(low[i], high[i]), x[low[i]:high[i]] @ q[i])
    return pa.table({"query": pa.array(columns[0], pa.int64()), "entry": pa.array(columns[1], pa.int64()),
                     "score": pa.array(columns[2], pa.float64())})


def _ranges(codes: np.ndarray, q: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[low, high) of the sorted codes that share each query's prefix of `level` bits."""
    def at(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.int64(BITS) - bits
        head = (q >> shift) << shift
        return np.searchsorted(codes, head), np.searchsorted(codes, head + (np.int64(1) << shift) - 1, side="right")

    low, high = at(np.maximum(level, 0).astype(np.int64))
    down = level < 0
    for bits in range(1, BITS + 1):  # descend while enough entries share the prefix
        if not down.any():
            break
        a, b = at(np.full(len(q), bits, np.int64))
        down &= b - a >= min(FIRST, len(codes))
        low, high = np.where(down, a, low), np.where(down, b, high)
    return low, high


def _searched(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, entry, score) by bucket part and share: `index` has part, code, vec, entry;
    `queries` part, code, vec, query, level. At most about `BUCKET_ROWS` queries are a share."""
    one = queries.where("part = 0").groupBy("tree", "head")
    shares = common.written(one.agg(F.ceil(F.count("*") / BUCKET_ROWS).alias("shares")), "query-shares")
    index = index.join(shares, ["tree", "head"]).withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).drop("shares")
    queries = queries.join(shares, ["tree", "head"]).withColumn("share", F.pmod(F.xxhash64("query"), F.col("shares"))).drop("shares")
    keys = ["tree", "head", "part", "share"]
    return index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        lambda a, b: _search(a, b, k), "query long, entry long, score double")


def nearest(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k best entries found for each row with `is_query` (an
    expression on `id`)."""
    spark = table.sparkSession
    common.bounded_batches(spark)
    rows = vectors(table, id_col, vector_col)
    totals = rows.agg(F.max("norm"), F.count("*")).first()
    largest, count = totals[0] or 1.0, totals[1]
    head_bits = max(0, math.ceil(math.log2(max(1, count) / BUCKET_ROWS)))

    def head(code):
        return F.shiftright(code, BITS - head_bits) if head_bits else F.lit(0).cast("long")

    forest = _hashed(entries(rows, k).withColumn("entry", F.col("ids")[0]), largest, False)
    forest = common.written(forest, "forest")  # one row per distinct vector, with all codes
    trees = forest.select("entry", "vec", F.posexplode("codes").alias("tree", "code")).withColumn("head", head(F.col("code")))
    parts = trees.groupBy("tree", "head").agg(F.ceil(F.count("*") / (2 * BUCKET_ROWS)).alias("parts"))
    # Counts by bucket: 2 ** head_bits a tree, that is one row per BUCKET_ROWS vectors.
    parts = common.written(parts, "forest-parts")
    index = trees.join(parts, ["tree", "head"]).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts"))).drop("parts")
    index = common.written(index, "forest-index")

    # One query a distinct vector, under the smallest of its ids.
    wanted = rows.where(is_query).select("v", "norm", "id")
    distinct = common.written(wanted.groupBy("v", "norm").agg(F.min("id").alias("query")), "distinct-queries")
    asked = common.written(_hashed(distinct, largest, True), "queries")
    ask = asked.select("query", "norm", "vec", F.posexplode("codes").alias("tree", "code"))

    def routed(q: DataFrame) -> DataFrame:
        return q.join(parts, ["tree", "head"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts", "norm")

    first = common.written(_searched(index, routed(
        ask.withColumn("head", head(F.col("code"))).withColumn("level", F.lit(-1))), k), "descended")
    # The own entry has the largest score of all (or is one of a few): one more than k.
    # An entry is the smallest id of its vector: of equal scores the smaller entries are better.
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    bound = first.groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn(
        "n", F.row_number().over(by_score)).where(F.col("n") <= k + 1).groupBy("query").agg(
        F.min("score").alias("bound"), F.count("*").alias("n"))
    bound = common.written(bound, "bounds")
    level = F.when(F.col("n") > k, level_for(F.col("bound"), F.col("norm"), largest)).otherwise(F.lit(0))
    ask = ask.join(bound, "query", "left").withColumn("level", F.coalesce(level, F.lit(0))).drop("bound", "n")
    ask = ask.where("level > 0 or tree = 0")
    span = F.greatest(F.lit(0), head_bits - F.col("level"))
    low = F.expr(f"shiftleft(shiftright(shiftright(code, {BITS - head_bits}), span), span)") if head_bits else F.lit(0).cast("long")
    heads = F.explode(F.sequence(F.col("low"), F.col("low") + F.expr("shiftleft(1L, span)") - 1))
    ask = ask.withColumn("span", span.cast("int")).withColumn("low", low).withColumn("head", heads).drop("span", "low")
    found = _searched(index, routed(ask), k)

    ids = forest.select("entry", "ids")
    best = first.unionByName(found).groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn(
        "n", F.row_number().over(by_score)).where(F.col("n") <= k + 1).drop("n")
    # One row a distinct query: the k + 1 best ids, of which one may be a query's own.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id")))
    lists = best.join(ids, "entry").select("query", F.explode("ids").alias("id"), "score").groupBy("query").agg(
        F.slice(ranked, 1, k + 1).alias("list"))
    # Both sides have an exchange, so that the ids of a vector that very many share are split.
    per_vector = common.written(distinct.join(lists, "query").select("v", "norm", "list"), "query-lists")
    each = wanted.withColumnRenamed("id", "query").join(per_vector.hint("merge"), ["v", "norm"])
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("query")), 1, k)
    return each.select(F.col("query").alias("query_id"), F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_col), (-F.col("x.minus")).alias("score"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(common.table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
