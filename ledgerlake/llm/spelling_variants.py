"""Spelling variants: words at edit distance one, by pairs of trie nodes.

The nodes of the trie of all words and of the trie of all reversed words are numbered. A pair
(prefix node, suffix node) then stands for a word with a hole: all words with the same prefix
before one skipped position and the same suffix behind it meet in one pair (replacements), and
a word cut between two positions (a pair without a hole) meets the words that have one more
letter there (insertions and deletions). Equal pairs of integers are exact neighbours: there is
nothing to verify. A word of n letters has at most 2n + 1 pairs; those of a node that only one
word has are left out, for they meet nothing.

Numbering is one scan of the sorted words (`trie_paths`): a word's prefix is a new node if the
word before does not share it. Words are dealt by ranges, each range numbers its nodes by
itself, and the nodes that a range shares with the one before are renamed by a table with an
entry per letter that two neighbouring ranges share (two words a range pass through the driver).

A pair holds at most one word per letter of the alphabet (and one cut word), for such words
differ in the hole's letter only: that bounds what is gathered per pair. Within a pair only
counts and the two best words are used, never all couples. A couple whose letter can be
deleted at several places of a run of equal letters is met once, at the first of the run.

Defined results: a null text has no words, a null id counts as an empty text in the hash; fully
equal rows count each; words without near words have n_near 0 and themselves as root; an empty
table has none. Ties go to the smaller word in code-point order. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

# Fixed values of the word definition.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MISSPELT_EVERY = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3

# A node's number: the range's number, then the node's within the range.
NODE_BITS = 44
# Nodes that one Arrow batch of paths may hold.
PATH_NODES = 400_000


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT, misspelt_every: int = MISSPELT_EVERY) -> DataFrame:
    """(word, n): the words of all texts, one letter lost wherever `misspelt_every` divides
    the hash of id and word."""
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN), F.lit(0))).alias("run")).select(
        "id", F.translate("run", UPPER, LOWER).alias("run"))
    size, h = F.char_length("run"), F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    hashed = runs.select("run", h.alias("h"), size.alias("size")).where(F.col("size") >= least_letters)
    hole = (F.col("h") % F.col("size")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), hole), F.substring("run", hole + 2, F.col("size")))
    hit = F.col("h") % misspelt_every == 0
    words = hashed.where(~hit | (F.col("size") > least_letters)).select(F.when(hit, lost).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """How many letters two words begin with together."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    low, high = 0, least
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def trie_paths(words: DataFrame) -> DataFrame:
    """(id, path) for the rows (id, word) of `words`, words distinct: the numbers of the trie
    nodes of the word's prefixes, the empty one first, as far as the words beside it in
    code-point order share them (a node of one word pairs with nothing). Equal prefixes have
    equal numbers."""
    common.bounded_batches(words.sparkSession)
    source = words.select("id", "word").repartitionByRange("word").sortWithinPartitions("word")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base, nodes, held, rows, path = part << NODE_BITS, 0, 0, [], []
        last = waits = None  # the word before; its row, until the next word is seen
        for batch in batches:
            for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kept = 0 if last is None else _shared(last, word) + 1
                if waits:
                    if waits[3] is None:  # the first word of a range stays whole, as the last
                        waits = (waits[0], waits[1][:max(waits[2], kept)], *waits[2:])
                    rows.append((part, waits[0], waits[3], waits[1], None))
                    held += len(waits[1])
                fresh = len(word) + 1 - kept
                path = path[:kept] + list(range(base + nodes, base + nodes + fresh))
                waits = (key, path, kept, word if last is None else None)
                nodes, last = nodes + fresh, word
                if held >= PATH_NODES:
                    yield _path_batch(rows)
                    rows, held = [], 0
        if waits:
            rows.append((part, waits[0], waits[3], waits[1], None))
            rows.append((part, None, last, None, waits[1]))
            yield _path_batch(rows)

    local = common.written(source.mapInArrow(number, _PATH_FIELDS), "trie-paths")
    first = local.where("id IS NOT NULL AND word IS NOT NULL").select("part", F.col("word").alias("first"))
    last = local.where("id IS NULL").select("part", F.struct("word", "edge").alias("last"))
    ends = first.join(last, "part").orderBy("part")
    owners = _owners((r.part, r.first, r.last.word, r.last.edge) for r in ends.toLocalIterator())
    return _renamed(local.where("id IS NOT NULL").select("part", "id", "path"), owners)


_PATH_FIELDS = "part int, id long, word string, path array<bigint>, edge array<bigint>"


def _path_batch(rows: list[tuple]) -> pa.RecordBatch:
    many = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.string(), many, many))],
        names=["part", "id", "word", "path", "edge"])


def _owners(ends) -> dict[int, list[int]]:
    """{range: numbers of the nodes that its first word shares with the range before}. The
    nodes of a range's first word have the first numbers of the range, by depth."""
    owners: dict[int, list[int]] = {}
    last, path = None, []
    for part, first, text, own in ends:
        if last is not None:
            owners[part] = path[:_shared(last, first) + 1]
        kept = _shared(first, text) + 1
        shared = owners.get(part, [])
        path = [shared[d] if d < min(kept, len(shared)) else x for d, x in enumerate(own)]
        last = text
    return owners


def _renamed(local: DataFrame, owners: dict[int, list[int]]) -> DataFrame:
    if not owners:
        return local
    spark, mask = local.sparkSession, (1 << NODE_BITS) - 1
    table = spark.createDataFrame(list(owners.items()), "part int, shared array<bigint>")
    at = F.lit(mask)
    number = lambda x: x.bitwiseAND(at)
    renamed = F.transform("path", lambda x: F.when(
        number(x) < F.size("shared"), F.get("shared", number(x).cast("int"))).otherwise(x))
    return local.join(table, "part", "left").withColumn(
        "path", F.when(F.col("shared").isNull(), F.col("path")).otherwise(renamed)).drop("shared")


def numbered(counts: DataFrame) -> DataFrame:
    """`counts` (word, n) with `id`: numbers in the order of preference, that is, the more
    frequent word first, then the smaller in code-point order."""
    order = [F.col("n").desc(), F.col("word")]
    return common.written(counts.select("word", "n").repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("id", F.monotonically_increasing_id()), "words")


def node_pairs(words: DataFrame) -> DataFrame:
    """(before, behind, entry): each word (id, word) with each hole and each cut whose two nodes
    other words share. `entry` is 4 * id, + 2 for a hole, + 1 if the hole's letter differs
    from the letter before it."""
    ahead = trie_paths(words).withColumnRenamed("path", "ahead")
    back = trie_paths(words.select("id", F.reverse("word").alias("word"))).withColumnRenamed("path", "back")
    both = words.select("id", F.split("word", "").alias("letters")).join(ahead.select("id", "ahead"), "id").join(
        back.select("id", "back"), "id")
    size = F.size("letters")
    entry = F.shiftleft("id", 2)
    # The hole at i is behind i letters and before size - i - 1.
    first = lambda i: (i == 0) | (F.get("letters", i) != F.get("letters", i - 1))
    hole = lambda i: F.struct(
        F.get("ahead", i).alias("before"), F.get("back", size - i - 1).alias("behind"),
        (entry + F.when(first(i), 3).otherwise(2)).alias("entry"))
    cut = lambda i: F.struct(
        F.get("ahead", i).alias("before"), F.get("back", size - i).alias("behind"), entry.alias("entry"))
    places = lambda least, most: F.when(least <= most, F.sequence(least, most)).otherwise(
        F.array().cast("array<int>"))
    zero, a, b = F.lit(0), F.size("ahead") - 1, F.size("back") - 1
    holes = F.transform(places(F.greatest(zero, size - 1 - b), F.least(size - 1, a)), hole)
    cuts = F.transform(places(F.greatest(zero, size - b), F.least(size, a)), cut)
    return both.select(F.inline(F.concat(holes, cuts)))


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are at edit distance one and the smallest id of them,
    for the words that have one."""
    bit = lambda x, b: x.bitwiseAND(F.lit(b)) != 0
    met = pairs.groupBy("before", "behind").agg(F.count("*").alias("size"), F.collect_list("entry").alias("entries"))
    met = met.where("size > 1").select(
        "entries", F.filter("entries", lambda x: bit(x, 2)).alias("holes"), F.filter("entries", lambda x: bit(x, 1)).alias("firsts"),
        F.array_min(F.filter("entries", lambda x: ~bit(x, 2))).alias("cut")).select(
        "entries", F.array_min("holes").alias("best"), F.array_min("firsts").alias("best_first"), "cut",
        F.size("holes").alias("n_holes"), F.size("firsts").alias("n_firsts"),
        F.array_min(F.filter("holes", lambda x: x != F.array_min("holes"))).alias("second"))
    met = met.select(F.explode("entries").alias("e"), *[c for c in met.columns if c != "entries"])
    other = F.when(F.col("e") == F.col("best"), F.col("second")).otherwise(F.col("best"))
    shorter = F.when(bit(F.col("e"), 1), F.col("cut"))
    is_hole = bit(F.col("e"), 2)
    found = met.select(
        F.shiftright("e", 2).alias("id"),
        F.when(is_hole, F.col("n_holes") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
        .otherwise(F.col("n_firsts")).cast("long").alias("near"),
        F.shiftright(F.when(is_hole, F.least(other, shorter)).otherwise(F.col("best_first")), 2).alias("best"))
    return found.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the last word of the chain of forms (id, form) that begins at id; chains are
    halved each round."""
    now = common.written(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        nxt = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        now = common.written(now.join(nxt, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(counts: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of `counts` (word, n): `form` is the
    most frequent word at edit distance one, if it is `times` as frequent at least (2 or more:
    chains of forms then end), `root` the end of the chain of forms."""
    words = numbered(counts)
    near = common.written(near_words(node_pairs(words)), "near-words")
    named = lambda c: words.select(
        F.col("id").alias(f"{c}_id"), F.col("word").alias(c), F.col("n").alias(f"{c}_n"))
    forms = words.join(near.withColumnRenamed("best", "form_id"), "id").join(named("form"), "form_id", "left")
    chosen = F.col("form_n") >= times * F.col("n")
    forms = common.written(forms.select(
        "id", "n_near", *[F.when(chosen, F.col(c)).alias(c) for c in ("form_id", "form", "form_n")]), "forms")
    roots = _roots(forms.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    return (words.join(forms, "id", "left")
            .join(roots.withColumnRenamed("root", "root_id").join(named("root"), "root_id").select("id", "root"), "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words, forms and roots."""
    counts = common.written(word_counts(common.table(spark, sf_dir, "documents")), "words")
    return spelling_variants(counts)
