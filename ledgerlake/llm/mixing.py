"""Mixing sources to target weights with DataFrame functions only.

1. Pack: the documents of a source follow each other in hash order, equal rows together; its words are cut into
   blocks of `BLOCK_WORDS`. Offsets are prefix sums in two steps (within chunks of a source,
   over its chunks), so a source that holds a third of all rows is dealt over many tasks.
2. Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and share `SHARE` of
   all words; a target stops at `MOST` times its source, the excess is reshared by weight.
   In order of cap over weight that is one prefix sum (water filling).
3. Draw: a source gets its target in block slots. All slots go through one pseudorandom
   permutation of the output; a shard takes the next `SHARD_SLOTS` places of it. Counts of
   sources per shard are thus a multinomial draw, conditioned on the sources' totals, which
   keeps every target and every cap.
4. Map: slot k of a source with n blocks is place k mod n of permutation k div n of its block
   numbers, so a block is used again only when all were. Slots and blocks join by number.

Permutations are keyed Feistel networks on a grid that just covers n, walked until inside n:
nothing is sorted or collected for them, and reruns agree.

Defined results: null and word-less texts have size 0 and are taken 0 times; a null source
is a source of its own; repeated rows are packed one after the other; an empty table gives
an empty result; a source without words has target 0. Names of input columns other than
id, text and source do not matter.

Fully equal rows are one row with a count until their places are known, so a row that makes up
a third of the table is neither one task's work nor dealt by chance: copy j starts j sizes
after the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
CHUNK_DOCS = 2_000
SLOTS_PER_TASK = 1_000_000
COPIES_PER_ROW = 16_384
SEED = 20240229
ROUNDS = 4
# Walks leave a grid's excess with probability 1 - 1/sqrt(n) a step, and no walk is longer
# than the excess, which is below sqrt(n).
WALKS = 64


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The image of x in a pseudorandom permutation of 0..n-1 that `key` names."""
    side = F.ceil(F.sqrt(n.cast("double")))
    other = F.ceil(n / side)
    grid = F.transform(F.array(F.struct(x.alias("x"), n.alias("n"), side.alias("a"), other.alias("b"))), lambda g: _walk(g, key))
    return grid[0]


def _walk(g: Column, key: tuple[Column, ...]) -> Column:
    def once(x):
        start = F.struct(F.floor(x / g["b"]).alias("l"), (x % g["b"]).alias("r"))

        def step(acc, t):
            left = F.pmod(acc["l"] + F.pmod(F.xxhash64(*key, t, acc["r"]), g["a"]), g["a"])
            right = F.pmod(acc["r"] + F.pmod(F.xxhash64(*key, t, left, F.lit(1)), g["b"]), g["b"])
            return F.struct(left.alias("l"), right.alias("r"))

        return F.aggregate(F.array(*[F.lit(t) for t in range(ROUNDS)]), start, step, lambda a: a["l"] * g["b"] + a["r"])

    first = F.transform(F.array(once(g["x"])), lambda y: F.when(y < g["n"], y).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), y, lambda v, _: F.when(v < g["n"], v).otherwise(once(v)))))
    return first[0]


KEY = ["named", "source", "size", "hash", "other"]


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep_text: bool = False) -> DataFrame:
    """(named, source, size, hash, other, id, copies) of every different row, with its text if
    asked. The two hashes are the row's key; `named` tells a null source from an empty one, so
    that no part of the key is null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(source_col).isNotNull().alias("named"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(id_col, text_col).alias("hash"),
        F.xxhash64(F.lit("row"), F.col(id_col).isNull(), id_col, F.col(text_col).isNull(), text_col).alias("other"),
        F.col(id_col).alias("id"), *[text.alias("text")] * keep_text)
    return rows.groupBy(*KEY).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                  *[F.min("text").alias("text")] * keep_text)


def sizes_by_source(sizes: DataFrame) -> DataFrame:
    """(source, size) for `targets`: all copies of each row of `sized`."""
    return sizes.select(F.when(F.col("named"), F.col("source")).alias("source"), (F.col("size") * F.col("copies")).alias("size"))


def targets(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: number, source_size, target, blocks, slots, slot_from."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("number", F.row_number().over(order))
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    s = s.withColumn("weight", cycle[(F.col("number") - 1) % len(WEIGHTS)]).withColumn("cap", MOST * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("below", F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (SHARE * F.sum("source_size").over(everything) - F.col("below")) / F.col("open")))
    # Sources below the level are full; the first that is not sets the level of the rest.
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    s = s.withColumn("level", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(everything))
    s = s.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    blocks = F.ceil(F.col("source_size") / block_words)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.least(blocks, F.round((F.col("target") - whole * F.col("source_size")) / block_words).cast("long"))
    s = s.withColumn("blocks", blocks).withColumn("slots", whole * blocks + part)
    return s.withColumn("slot_from", F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("slots")).withColumn(
        "all_slots", F.sum("slots").over(Window.partitionBy())).select(
        "source", "number", "source_size", "target", "blocks", "slots", "slot_from", "all_slots")


def placed(sizes: DataFrame, by_source: DataFrame, docs: int) -> DataFrame:
    """`sizes` with number, source_size, target and `start`, the first word of a row's first
    copy in its source (null for a document without words). `docs`: about the number of rows."""
    chunks = max(1, -(-docs // CHUNK_DOCS))
    d = sizes.withColumn("chunk", F.pmod("hash", F.lit(chunks)))
    words = F.col("size") * F.col("copies")
    within = Window.partitionBy("named", "source", "chunk").orderBy("hash", "other", "size")
    d = d.withColumn("start", F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, 0)) - words)
    sums = d.groupBy("named", "source", "chunk").agg(F.sum(words).alias("words"))
    over = Window.partitionBy("named", "source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    named = by_source.withColumn("named", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    sums = sums.withColumn("before", F.sum("words").over(over) - F.col("words")).drop("words").join(
        named.select("named", "source", "number", "source_size", "target"), ["named", "source"])
    return d.join(sums, ["named", "source", "chunk"]).select(
        *KEY, "id", "copies", "number", "source_size", "target",
        F.when(F.col("size") > 0, F.col("start") + F.col("before")).alias("start"))


def copied(place: DataFrame, most: int = COPIES_PER_ROW) -> DataFrame:
    """One row per copy, each at its own start. Rows of more than `most` copies are cut into
    runs first, which are dealt before they are unfolded."""
    run = F.struct(F.col("from").alias("from"), F.least("copies", F.col("from") + most).alias("to"))
    many = place.where(F.col("copies") > most).select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("copies") - 1, F.lit(most).cast("long"))).alias("from")).repartition("hash", "from")
    few = place.where(F.col("copies") <= most).withColumn("from", F.lit(0).cast("long"))

    def unfolded(rows: DataFrame) -> DataFrame:
        return rows.withColumn("run", run).select("*", F.explode(F.sequence(
            F.col("run.from"), F.col("run.to") - 1)).alias("copy")).withColumn(
            "start", F.col("start") + F.col("copy") * F.col("size")).drop("copies", "from", "run", "copy")

    return unfolded(few).unionByName(unfolded(many))


def slots(by_source: DataFrame) -> DataFrame:
    """(number, block, shard, position): one row per output slot. Slots are made in groups,
    which are dealt before they are unfolded."""
    group = 16_384
    spark = by_source.sparkSession
    total = by_source.agg(F.max("all_slots")).first()[0] or 0
    # A number of its own: by their size the few group rows would be merged into one task.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SLOTS_PER_TASK))
    g = by_source.where("slots > 0").select(
        "number", "blocks", "slots", "slot_from", "all_slots",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / group))).alias("group"))
    k = g.repartition(tasks, "number", "group").select("*", F.explode(F.sequence(
        F.col("group") * group, F.least(F.col("slots"), (F.col("group") + 1) * group) - 1)).alias("k"))
    place = permuted(F.col("slot_from") + F.col("k"), F.col("all_slots"), F.lit(SEED))
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.lit(SEED), F.col("number"), F.floor(F.col("k") / F.col("blocks")))
    return k.select("number", block.alias("block"), place.alias("place")).select(
        "number", "block", F.floor(F.col("place") / SHARD_SLOTS).alias("shard"), (F.col("place") % SHARD_SLOTS).alias("position"))


def pieces(place: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(number, block, start, at, words): the words of the document at `start` that lie in a
    block, and their place in it; with the document's text also `id` and the piece's text."""
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    textual = "text" in place.columns
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "") if textual else F.lit(None)

    def piece(block, words):
        begin = F.greatest(F.col("start"), block * block_words)
        n = F.least(F.col("start") + F.col("size"), (block + 1) * block_words) - begin
        out = [block.alias("block"), (begin - block * block_words).alias("at"), n.alias("words")]
        if textual:
            out += [F.array_join(F.slice(words, (begin - F.col("start") + 1).cast("int"), n.cast("int")), " ").alias("text")]
        return F.struct(*out)

    cut = F.flatten(F.transform(F.array(split), lambda words: F.transform(
        F.sequence(first, last), lambda block: piece(block, words))))
    return place.where("size > 0").select(
        "number", "start", *["id"] * textual, F.inline(cut))


def manifest(place: DataFrame, by_source: DataFrame) -> DataFrame:
    """(number, block, shard, position, start, at, words): which words of which document go
    where. (number, start) is a document's key in `place`."""
    return _merged(slots(by_source)).join(pieces(place), ["number", "block"])


def _merged(rows: DataFrame) -> DataFrame:
    """Rows that were unfolded from a small table: the planner would take their size for
    that table's and broadcast them, however many they are."""
    return rows.hint("merge")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(placed documents, equal ones once; sources), written once to the shared folder (numbers only)."""
    sizes = common.written(sized(docs, id_col, text_col, source_col), "mix-sizes")
    by_source = common.written(targets(sizes_by_source(sizes)), "mix-sources")
    return common.written(placed(sizes, by_source, sizes.count()), "mix-placed"), by_source


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row."""
    place, by_source = plan(docs, id_col, text_col, source_col)
    place = copied(place)
    words = manifest(place, by_source).groupBy("number", "start").agg(F.sum("words").alias("taken"))
    return place.join(words, ["number", "start"], "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, one row per slot: shard, position, source, block, n_words, doc_ids and
    text (words joined by one space). Texts meet their places in the partitioning that made
    equal rows one; a block's pieces meet by its number; slots then join them in the same
    partitioning."""
    place, by_source = plan(docs, id_col, text_col, source_col)
    texts = sized(docs, id_col, text_col, source_col, keep_text=True).select(*KEY, "text")
    place = copied(place.join(texts, KEY))
    piece = F.struct("at", "id", "words", "text")
    blocks = pieces(place).groupBy("number", "block").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    filled = _merged(slots(by_source)).join(blocks, ["number", "block"])
    names = by_source.select("number", "source")
    return filled.join(names, "number").select(
        "shard", "position", "source", "block",
        F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"]).alias("n_words"),
        F.col("pieces.id").alias("doc_ids"), F.array_join("pieces.text", " ").alias("text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(common.table(spark, sf_dir, "documents"))
