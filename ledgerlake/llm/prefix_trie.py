"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Conversations that begin with the same turns share the nodes of a trie; a node's totals tell
what sharing saves. Steps, each a join, grouping or window of Spark:

1. `places`: the place of each turn in its conversation. Turns are dealt by ranges of
   (conversation, turn), so that a conversation of any length is cut over tasks; places in a
   range are offset by the counts of the ranges before. Texts are replaced by digests first.
2. `prefixes`: the name of every prefix. A turn's digest is mixed with its place, and the
   first d mixed values are summed (two exact sums of 60-bit numbers), in blocks of CHUNK
   turns that are offset by the sums of the blocks before; equal prefixes have equal names.
3. `nodes`: one row per name (partial aggregates: a turn that very many conversations begin
   with is one row per task before the shuffle), keyed by (smallest member, depth).
4. `subtree_totals`: tree contraction. Each round rakes all leaves (their totals go to their
   parents) and compresses unary chains (nodes whose random draw is below those of both
   neighbours are spliced out, their values kept on the child's edge), so the number of
   rounds grows with the logarithm of the nodes, whatever the depth. Then the
   contracted nodes are re-expanded in reverse, each from the total of the child it had.
   Every join is on unique keys; what many rows share (a parent) is only ever aggregated.

Every round is written to the shared folder: a lost executor costs one round at most.

Defined results: rows without conversation id belong to no conversation; a null role or text
is empty; turns of one conversation with equal numbers (null first) are ordered by the SHA-256
of role and text, and equal rows are turns of their own; an empty table has no nodes. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

# Turns of a conversation that one window task sums.
CHUNK = 1024
# Ends are listed in blocks of so many consecutive conversation ids.
ID_BLOCK = 65_536

_WORD = "[^\\x20\\x09-\\x0D]+"
_ROOT_NAME = "0:0:0"


def _name(depth, a, b):
    return F.unhex(F.md5(F.concat_ws(":", depth, a, b)))


def places(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, words) per turn, pos from 0, and (conv_id, turns) per
    conversation."""
    said = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, body), 256)).alias("digest"),
        F.regexp_count(body, F.lit(_WORD)).cast("long").alias("words"), F.rand(11).alias("deal"))
    dealt = common.written(
        dealt.repartitionByRange("conv_id", *order, "deal").drop("deal")
        .withColumn("part", F.spark_partition_id()), "turns")
    sizes = common.written(dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "turn-counts")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.sum("n").over(earlier)).where("before > 0").drop("n")
    local = Window.partitionBy("conv_id", "part").orderBy(*order)
    placed = (dealt.withColumn("pos", F.row_number().over(local) - 1)
              .join(before, ["conv_id", "part"], "left")
              .select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words"))
    return common.written(placed, "places"), sizes.groupBy("conv_id").agg(F.sum("n").alias("turns"))


def prefixes(sequences: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, last, name, up_name, words) for each row (conv_id, pos, turns, digest,
    words) of `sequences`: the node of the first pos + 1 turns, `last` if there are no more."""
    mixed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.hex("digest")), 256)
    terms = sequences.withColumn("mixed", mixed).select(
        "conv_id", "pos", "turns", "words", F.floor(F.col("pos") / chunk).alias("chunk"),
        *[F.conv(F.substring("mixed", at, 15), 16, 10).cast("decimal(19,0)").alias(x) for x, at in (("a", 1), ("b", 16))])
    sums = terms.where(F.col("turns") > chunk).groupBy("conv_id", "chunk").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "chunk", *[F.sum(x).over(earlier).alias(f"{x}0") for x in "ab"]).where("chunk > 0")
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("decimal(38,0)")
    total = terms.select("*", *[F.sum(x).over(so_far).alias(f"{x}1") for x in "ab"]).join(
        before, ["conv_id", "chunk"], "left").select(
        "*", *[(F.coalesce(f"{x}0", zero) + F.col(f"{x}1")).cast("decimal(38,0)").alias(f"{x}2") for x in "ab"])
    depth = (F.col("pos") + 1).cast("long")
    up = [(F.col(f"{x}2") - F.col(x)).cast("decimal(38,0)") for x in "ab"]
    return total.select("conv_id", depth.alias("depth"), (depth == F.col("turns")).alias("last"),
                        _name(depth, F.col("a2"), F.col("b2")).alias("name"),
                        _name(F.col("pos"), *up).alias("up_name"), "words")


def nodes(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie of `prefixes` and of all `conversations` (conv_id): (conv_id, depth, name,
    parent_conv_id, n_convs, words), conv_id the smallest member; words those of its turn."""
    found = steps.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("up_name").alias("up_name"),
        F.count("*").alias("n_convs"), F.min("words").alias("words"))
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.unhex(F.md5(F.lit(_ROOT_NAME))).alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("up_name"), "n_convs", F.lit(0).cast("long").alias("words"))
    all_ = common.written(found.unionByName(root), "trie")
    parent = all_.select(F.col("name").alias("up_name"), F.col("conv_id").alias("parent_conv_id"))
    return common.written(all_.join(parent, "up_name", "left").drop("up_name"), "trie-nodes")


def subtree_totals(tree: DataFrame, measures: list[str]) -> DataFrame:
    """(id, *measures): the sums of `measures` over the subtree of each node, itself included.
    `tree` has `id` (unique), `up` (the parent's id, null for a root) and the measures.

    `add_<m>` is what a node's total holds besides its children's totals; `edge_<m>` what its
    parent's holds besides, for the nodes that were spliced out between the two.
    """
    add, edge = [f"add_{m}" for m in measures], [f"edge_{m}" for m in measures]
    none = F.lit(0).cast("long")
    alive = tree.select("id", "up", *[F.col(m).cast("long").alias(a) for m, a in zip(measures, add)],
                        *[none.alias(e) for e in edge])
    rounds = []
    while True:
        up = alive.where("up IS NOT NULL").select(F.col("up").alias("id"))
        marked = common.written(alive.join(up.distinct().withColumn("inner", F.lit(True)), "id", "left"), "tree")
        if marked.isEmpty():
            break
        # Rake: what has no child goes, with its values, to its parent.
        leaves = marked.where("inner IS NULL")
        gains = leaves.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            *[F.sum(F.col(a) + F.col(e)).alias(f"gain_{a}") for a, e in zip(add, edge)])
        rest = marked.where("inner").join(gains, "id", "left").select(
            "id", "up", *[(F.col(a) + F.coalesce(f"gain_{a}", none)).alias(a) for a in add], *edge)
        # Compress: splice out the nodes with one child whose draw is below those of both
        # neighbours, so that no two neighbours go at once.
        only = rest.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            F.count("*").alias("n"), F.min(F.struct("id", *edge)).alias("child")).where("n = 1").drop("n")
        draw = {x: F.struct(F.xxhash64(x, F.lit(len(rounds))), F.col(x)) for x in ("id", "up", "child.id")}
        goes = F.col("up").isNotNull() & F.col("child").isNotNull() & (draw["id"] < draw["up"]) & (draw["id"] < draw["child.id"])
        raked = common.written(rest.join(only, "id", "left").withColumn("goes", F.coalesce(goes, F.lit(False))), "raked")
        spliced = raked.where("goes")
        moved = spliced.select(F.col("child.id").alias("id"), F.col("up").alias("new_up"),
                               *[(F.col(a) + F.col(e)).alias(f"more_{e}") for a, e in zip(add, edge)])
        alive = raked.where("NOT goes").join(moved, "id", "left").select(
            "id", F.coalesce("new_up", "up").alias("up"), *add,
            *[(F.col(e) + F.coalesce(f"more_{e}", none)).alias(e) for e in edge])
        rounds.append((leaves, spliced))
    totals = marked.select("id", *[F.col(a).alias(m) for m, a in zip(measures, add)])
    for leaves, spliced in reversed(rounds):
        below = totals.select(F.col("id").alias("below"), *[F.col(m).alias(f"below_{m}") for m in measures])
        regrown = spliced.join(below, F.col("child.id") == F.col("below")).select(
            "id", *[(F.col(a) + F.col(f"child.{e}") + F.col(f"below_{m}")).alias(m)
                    for m, a, e in zip(measures, add, edge)])
        totals = common.written(
            totals.unionByName(leaves.select("id", *[F.col(a).alias(m) for m, a in zip(measures, add)]))
            .unionByName(regrown), "totals")
    return totals


def listed_digests(ends: DataFrame, block: int = ID_BLOCK) -> DataFrame:
    """(name, ends_sha256): SHA-256 of each name's ids (name, conv_id; unique), ascending and
    joined by commas. Ids are listed in blocks of consecutive numbers, `block` ids at most;
    the blocks of a name then stream through one hash, which takes one at a time."""
    common.bounded_batches(ends.sparkSession)
    lists = ends.groupBy("name", F.floor(F.col("conv_id") / block).alias("at")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != now:
                    if h is not None:
                        done.append((now, h.hexdigest()))
                    now, h = name, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield _hashes(done)
        if h is not None:
            yield _hashes([(now, h.hexdigest())])

    return (lists.repartition("name").sortWithinPartitions("name", "at").select("name", "ids")
            .mapInArrow(hashed, "name binary, ends_sha256 string"))


def _hashes(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.string())], names=["name", "ends_sha256"])


def prefix_trie(sequences: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The trie of `sequences` (conv_id, pos, turns, digest, words) of all `conversations`
    (conv_id, turns; also those without turns), with its subtree totals: one row per node."""
    steps = common.written(prefixes(sequences, chunk), "prefixes")
    at = F.struct("conv_id", "depth")
    trie = nodes(steps, conversations)
    up = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    linked = trie.select(at.alias("id"), up.alias("up"), "name", "n_convs", "words")
    children = linked.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("n_children"))
    tree = common.written(
        linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")
    totals = subtree_totals(tree.select(
        "id", "up", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ends = steps.where("last").select("name", "conv_id").unionByName(
        conversations.where("turns = 0").select(F.unhex(F.md5(F.lit(_ROOT_NAME))).alias("name"), "conv_id"))
    return (tree.join(totals, "id").join(listed_digests(ends), "name", "left")
            .select(F.col("id.conv_id").alias("conv_id"), F.col("id.depth").alias("depth"),
                    F.col("up.conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256")))


def rebuilt(placed: DataFrame, sizes: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: conversation c takes the first h turns of
    c - c % family (all if fewer, none if absent), h = crc32(c) % most, and then its own after
    its first h. Gives what `prefix_trie` takes."""
    c = F.col("conv_id")
    own = sizes.select("conv_id", F.col("turns").alias("own"), (F.crc32(c.cast("string")) % most).alias("h"),
                       (c - c % family).alias("base"))
    bases = sizes.where(c % family == 0).select(c.alias("base"), F.col("turns").alias("of_base"))
    all_ = common.written(
        own.join(bases, "base", "left")
        .withColumn("head", F.least("h", F.coalesce("of_base", F.lit(0).cast("long"))))
        .select("conv_id", "base", "h", "head",
                (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns")), "conversations")
    tails = placed.join(all_, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "turns", "digest", "words")
    first = placed.where((c % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    heads = first.join(all_, "base").where("pos < head").select("conv_id", "pos", "turns", "digest", "words")
    return tails.unionByName(heads), all_.select("conv_id", "turns")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(*rebuilt(*places(common.table(spark, sf_dir, "conversations"))))
