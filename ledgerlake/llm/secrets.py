"""Secret scans with DataFrame functions only.

Base spans are regular expressions (assignments, access keys, long hexadecimal runs). The
method adds `random` spans: runs of 16 and more key characters that a battery of tests finds
random in the encoding they appear to have.

Battery, per candidate of n characters over an inferred alphabet of k:
  uniform   chi-squared of the character counts against equal shares (Wilson-Hilferty);
  runs      Wald-Wolfowitz runs of the lower and upper half of the alphabet;
  serial    lag-1 serial correlation of the alphabet positions.
A candidate that any of them rejects at `REJECT` is not random. For the others the evidence
against ordinary writing is the smaller p-value, doubled, of
  concentration  ordinary writing repeats characters `REPEATS` times as often as chance, so
                 an index of coincidence as low as this one is unlikely in it;
  switches       ordinary writing changes between lower case, upper case and digits with
                 probability `SWITCH` at most; more changes have the Chernoff bound.
Benjamini-Hochberg at level `FDR` over all candidates of a length class in the whole input
picks those reported: classes keep many short words from hiding few long keys. Only a
histogram of -log p per class (fixed bins) is gathered.

Defined results: null text = empty text = no spans; rows repeat as they come (each repeats
its evidence); an empty table gives an empty result; decimal numbers are no candidates;
a candidate that overlaps a base span is not reported again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of [0-9a-f]+ with 32 characters or more
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"

FDR = 0.01
REJECT = 0.001
REPEATS = 1.7
SWITCH = 0.1
LENGTH_CLASSES = (24, 32, 48, 64, 128)
BINS_PER_UNIT = 20
LEAST_P = 1e-80  # smaller ones count as this: bounds the histogram

_SPAN = "struct<start:int,kind:int,end:int,token:string>"  # sorts by start, then kind


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _folded(xs: Column, state: Column, kind: str, step, finish=lambda acc: acc["out"]) -> Column:
    """Left to right over the array `xs` with a state: `step(acc, x)` gives the next `state` and
    `out` (an array of `kind`). An array that grows by one costs its length each time; so the
    fold goes in runs of about the root of the number of items, joined run by run."""
    empty = F.array().cast(f"array<{kind}>")

    def run(v, acc, at):
        return F.aggregate(F.slice(v["xs"], at + 1, v["run"]), F.struct(acc["state"].alias("state"), empty.alias("out")), step)

    def outer(v):
        starts = F.when(F.size(v["xs"]) > 0, F.sequence(F.lit(0), F.size(v["xs"]) - 1, v["run"])).otherwise(F.array().cast("array<int>"))
        return F.aggregate(
            starts, F.struct(state.alias("state"), empty.alias("out")),
            lambda acc, at: _let(run(v, acc, at), lambda r: F.struct(
                r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out"))), finish)

    bound = _let(xs, lambda x: F.struct(x.alias("xs"), F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(x))).cast("int")).alias("run")))
    return _let(bound, outer)


def _found(text: str, pattern: str, kind: int, group: int, least: int, token: bool = False) -> Column:
    """Spans of the leftmost, non-overlapping matches whose `group` has `least` characters:
    the pieces between matches and the matches, in turn, give the offsets. With `token` a
    span has its `token`, the match, too (null otherwise)."""
    p = F.lit(pattern)
    zipped = F.arrays_zip(
        F.split(F.col(text), pattern, -1).alias("gap"),
        F.regexp_extract_all(F.col(text), p, F.lit(0)).alias("hit"),
        F.regexp_extract_all(F.col(text), p, F.lit(group)).alias("value"))

    def step(acc, x):
        begin = acc["state"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))  # the last gap has no match
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                        (x["hit"] if token else F.lit(None).cast("string")).alias("token"))
        out = F.when(F.length(x["value"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("state"), out.alias("out"))

    return F.when(F.col(text).rlike(pattern), _folded(zipped, F.lit(0), _SPAN, step)).otherwise(
        F.array().cast(f"array<{_SPAN}>"))


def upper_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, after Abramowitz and Stegun 26.2.17."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-x * x / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, q).otherwise(1 - q)


# Encodings by pattern, in order; the first that fits is taken. Ordinary words fall under
# the letter alphabets, where only long strings can be told from them.
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("^[0-9]+$", ""),
    ("^[0-9a-f]+$", _DIGIT + "abcdef"),
    ("^[0-9A-F]+$", _DIGIT + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGIT + _LOWER),
    ("^[0-9A-Z]+$", _DIGIT + _UPPER),
    ("^[A-Za-z]+$", _LOWER + _UPPER),
    ("^[0-9A-Za-z]+$", _DIGIT + _LOWER + _UPPER),
    ("^[0-9A-Za-z+/]+$", _DIGIT + _LOWER + _UPPER + "+/"),
    ("^[0-9A-Za-z_-]+$", _DIGIT + _LOWER + _UPPER + "-_"),
    ("", _DIGIT + _LOWER + _UPPER + "+/-_"),
)


def alphabet_of(token: Column) -> Column:
    out = F.lit(ENCODINGS[-1][1])
    for pattern, alphabet in reversed(ENCODINGS[:-1]):
        out = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(out)
    return out


def _pairs(xs: Column) -> Column:
    return F.arrays_zip(F.slice(xs, F.lit(1), F.size(xs) - 1).alias("a"), F.slice(xs, F.lit(2), F.size(xs) - 1).alias("b"))


def p_ordinary(token: Column) -> Column:
    """The p-value against ordinary writing; 1 for what the battery does not find random;
    null for decimal numbers."""
    return _let(F.struct(F.rtrim(token, F.lit("=")).alias("t"), alphabet_of(F.rtrim(token, F.lit("="))).alias("abc")),
                lambda s: F.when(F.length(s["abc"]) > 0, _battery(s["t"], s["abc"])))


def _battery(token: Column, alphabet: Column) -> Column:
    index = F.transform(F.split(token, "(?!^)", -1), lambda c: F.instr(alphabet, c) - 1)
    return _let(F.struct(index.alias("x"), F.length(alphabet).cast("double").alias("k"),
                         F.size(index).cast("double").alias("n"), token.alias("t")),
                lambda s: _let(_statistics(s), _combined))


def _statistics(s: Column) -> Column:
    x, n, k = s["x"], s["n"], s["k"]
    zero = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def square(acc, v):  # sum of squared counts over the sorted positions
        run = F.when(acc["last"] == v, acc["run"] + 1).otherwise(F.lit(0.0))
        return F.struct(v.alias("last"), run.alias("run"), (acc["sum"] + 2 * run + 1).alias("sum"))

    squares = F.aggregate(F.array_sort(x), zero, square, lambda a: a["sum"])
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
    high = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.when(2 * v >= k, 1.0).otherwise(0.0))
    changes = F.aggregate(_pairs(x), F.lit(0.0), lambda a, p: a + F.when((2 * p["a"] >= k) != (2 * p["b"] >= k), 1.0).otherwise(0.0))
    around = _let(mean, lambda m: F.struct(
        F.aggregate(_pairs(x), F.lit(0.0), lambda a, p: a + (p["a"] - m) * (p["b"] - m)).alias("with_next"),
        F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)).alias("squared")))
    classes = F.split(F.translate(s["t"], _LOWER + _UPPER + _DIGIT, "l" * 26 + "u" * 26 + "d" * 10), "(?!^)", -1)
    switches = F.aggregate(_pairs(classes), F.lit(0.0), lambda a, p: a + F.when(p["a"] != p["b"], 1.0).otherwise(0.0))
    return F.struct(n.alias("n"), k.alias("k"), squares.alias("squares"), high.alias("high"),
                    (changes + 1).alias("runs"), around.alias("around"), switches.alias("switches"))


def _combined(v: Column) -> Column:
    n, k, sq, n1 = v["n"], v["k"], v["squares"], v["high"]
    n0, dof = n - n1, k - 1
    chi = k / n * sq - n
    z_uniform = (F.pow(F.greatest(chi, F.lit(0.0)) / dof, F.lit(1 / 3)) - (1 - 2 / (9 * dof))) / F.sqrt(2 / (9 * dof))
    runs_mean = 2 * n1 * n0 / n + 1
    runs_var = (runs_mean - 1) * (runs_mean - 2) / (n - 1)
    z_runs = (v["runs"] - runs_mean) / F.sqrt(runs_var)
    z_serial = (v["around"]["with_next"] / v["around"]["squared"] + 1 / n) * F.sqrt(n)
    random = ((upper_tail(z_uniform) >= REJECT)
              & (runs_var > 0) & (2 * upper_tail(F.abs(z_runs)) >= REJECT)
              & (v["around"]["squared"] > 0) & (2 * upper_tail(F.abs(z_serial)) >= REJECT))
    kappa = REPEATS / k
    coincidence = (sq - n) / (n * (n - 1))
    # Of a multinomial; the third moment of ordinary shares is taken as 1.25 kappa squared.
    var = 2 / (n * (n - 1)) * (kappa + (2 * (n - 2) * 1.25 - (2 * n - 3)) * kappa * kappa)
    p_concentration = upper_tail((kappa - coincidence) / F.sqrt(var))
    rate = v["switches"] / (n - 1)
    p_switches = F.when(rate > SWITCH, F.exp(-(n - 1) * (
        rate * F.log(rate / SWITCH)
        + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - SWITCH))).otherwise(F.lit(0.0))))).otherwise(F.lit(1.0))
    return F.when(random, F.least(F.lit(1.0), 2 * F.least(p_concentration, p_switches))).otherwise(F.lit(1.0))


def _length_class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for i, below in reversed(list(enumerate(LENGTH_CLASSES))):
        out = F.when(n < below, F.lit(i)).otherwise(out)
    return out


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with `_base`, the base spans in order, and `_candidates`: span, length class
    and bin (20 a unit of -ln p, rounded down) of each candidate outside the base spans."""
    d = docs.withColumn("_text", common.text_or_empty(text_col))
    d = d.withColumn("_found", F.array_sort(F.concat(
        _found("_text", ASSIGN, 0, 2, 8), _found("_text", ACCESS, 1, 0, 16), _found("_text", HEX, 2, 0, 32),
        _found("_text", CANDIDATE, 3, 0, 16, True))))

    def evidence(c):
        return _let(p_ordinary(c["token"]), lambda p: F.struct(
            c["start"].alias("start"), c["end"].alias("end"),
            _length_class(c["end"] - c["start"]).alias("length_class"),
            F.when(p.isNotNull(), F.floor(-F.log(F.greatest(p, F.lit(LEAST_P))) * BINS_PER_UNIT)).cast("int").alias("bin")))

    d = d.withColumn("_runs", _alone("_found"))
    d = d.withColumn("_candidates", F.filter(F.transform("_runs", evidence), lambda c: c["bin"].isNotNull()))
    return d.withColumn("_base", F.transform(F.filter("_found", lambda b: b["kind"] < 3), _plain)).drop("_text", "_found", "_runs")


def _plain(span: Column) -> Column:
    return F.struct(*[span[c].alias(c) for c in ("start", "kind", "end")])


def _alone(spans: str) -> Column:
    """The candidates (kind 3) that overlap no base span, in one pass over the sorted spans.
    Candidates do not overlap each other, so one at most waits for the base span behind it."""
    zero = F.struct(F.lit(0).alias("base_end"), F.lit(None).cast(_SPAN).alias("waits"))
    flushed = lambda acc: F.when(acc["state"]["waits"].isNull(), acc["out"]).otherwise(
        F.concat(acc["out"], F.array(acc["state"]["waits"])))

    def step(acc, s):
        candidate, base_end, waits = s["kind"] == 3, acc["state"]["base_end"], acc["state"]["waits"]
        state = F.struct(
            F.when(candidate, base_end).otherwise(F.greatest(base_end, s["end"])).alias("base_end"),
            F.when(candidate, F.when(s["start"] >= base_end, s)).otherwise(
                F.when(waits["end"] <= s["start"], waits)).alias("waits"))
        return F.struct(state.alias("state"), F.when(candidate, flushed(acc)).otherwise(acc["out"]).alias("out"))

    return _folded(F.col(spans), zero, _SPAN, step, flushed)


def discovery_bins(candidates: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row: `_least`, an array of the smallest bin that is a discovery per length class
    (null: none). `candidates` has `_candidates` of `scanned`."""
    bins = candidates.select(F.explode("_candidates").alias("c")).groupBy(
        F.col("c.length_class").alias("length_class"), F.col("c.bin").alias("bin")).count()
    at_least = Window.partitionBy("length_class").orderBy(F.desc("bin"))
    m = F.sum("count").over(Window.partitionBy("length_class"))
    passing = bins.select("length_class", "bin", F.sum("count").over(at_least).alias("found"), m.alias("m")).where(
        F.col("m") * F.exp(-F.col("bin") / F.lit(float(BINS_PER_UNIT))) <= fdr * F.col("found"))
    least = passing.groupBy().pivot("length_class", list(range(len(LENGTH_CLASSES) + 1))).agg(F.min("bin"))
    return least.select(F.array(*[F.col(str(i)) for i in range(len(LENGTH_CLASSES) + 1)]).alias("_least"))


def with_spans(scan: DataFrame, least: DataFrame) -> DataFrame:
    """`scanned` rows with `_spans`, all spans by start and kind; `least` has one row."""
    d = scan.withColumn("_least", least.scalar())
    found = F.filter("_candidates", lambda c: c["bin"] >= F.get(F.col("_least"), c["length_class"]))
    added = F.transform(found, lambda c: F.struct(
        c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return d.withColumn("_spans", F.array_sort(F.concat("_base", added))).drop("_least", "_candidates")


def joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda b: F.concat_ws(
        ":", names[b["kind"]], b["start"].cast("string"), b["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row. The scan is
    written once to the shared folder (offsets only) and read for the histogram and result."""
    scan = common.written(scanned(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))).select(
        "_id", "_base", "_candidates"), "secrets")
    d = with_spans(scan, discovery_bins(scan, fdr))

    def count(i):
        return F.size(F.filter("_spans", lambda b: b["kind"] == i)).cast("long")

    return d.select(F.col("_id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(joined("_base"), 256).alias("base_sha256"), joined("_spans").alias("spans"),
                    count(3).alias("n_random"))


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """`docs` with every span of a text replaced by `mark` (overlapping ones by one); rows
    without spans are unchanged. The rows are written once with their scan, which the
    histogram and the result read; a text is scanned once, and its clean form is joined from
    the pieces between spans (`_without`)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    scan = common.written(scanned(docs.select(whole, F.col(f"`{text_col}`").alias("text"))).drop("text"), "secrets")
    d = with_spans(scan, discovery_bins(scan, fdr))
    text = F.col("_doc")[text_col]
    clean = _without(text, "_spans", mark)
    return d.select(F.when(F.size("_spans") > 0, F.col("_doc").withField(f"`{text_col}`", clean)).otherwise(F.col("_doc"))
                    .alias("_doc")).select("_doc.*")


# Characters of the blocks that pieces of a text are cut from, and blocks grow with the root
# of its length: a piece costs a block, not the text before it.
BLOCK_CHARS = 4096


def _without(text: Column, spans: str, mark: str, block: int = BLOCK_CHARS) -> Column:
    """The text with the sorted `spans` replaced by `mark`, those that overlap by one."""
    size = F.char_length(text)

    def step(acc, s):  # the gap before each group of overlapping spans
        piece = F.struct(acc["state"].alias("start"), s["start"].alias("end"))
        return F.struct(F.greatest(acc["state"], s["end"]).alias("state"),
                        F.when(s["start"] >= acc["state"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    gaps = _folded(F.col(spans), F.lit(0), "struct<start:int,end:int>", step, lambda acc: F.concat(
        acc["out"], F.array(F.struct(acc["state"].alias("start"), size.alias("end")))))
    wide = F.greatest(F.lit(block), (F.sqrt(size) * 16).cast("int"))

    def cut(v):
        b = v["wide"]
        one = lambda g: F.array_join(F.transform(
            F.sequence((g["start"] / b).cast("int"), (g["end"] / b).cast("int")),
            lambda k: F.substring(v["blocks"][k], F.greatest(g["start"] - k * b, F.lit(0)) + 1,
                                  F.least(g["end"] - k * b, b) - F.greatest(g["start"] - k * b, F.lit(0)))), "")
        return F.array_join(F.transform(v["gaps"], one), mark)

    blocks = lambda w: F.transform(
        F.sequence(F.lit(0), (size / w).cast("int")), lambda k: F.substring(text, k * w + 1, w))
    return _let(wide, lambda w: _let(F.struct(w.alias("wide"), blocks(w).alias("blocks"), gaps.alias("gaps")), cut))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(common.table(spark, sf_dir, "documents"))
