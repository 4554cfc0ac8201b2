"""Types of text columns, found in the data: a lattice of value kinds that one aggregate joins.

Every value has a kind, a bit: whole number, other number, date, text; missing values have
none. The kinds of a column are the bits of its values joined by OR, so they are found map-side,
in any order and over any number of partitions; the column's type is the least one that
holds all of its kinds. No inference pass, no sample: the type holds for every value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S

WHOLE, NUMBER, DATE, TEXT = 1, 2, 4, 8
MISSING = ("", S.NONE_SENTINEL)
NUMBER_TYPE = "decimal(38,6)"

# Numbers as people write them: NaN, infinities and exponents are text. 18 digits fit a bigint,
# 32 before the point a decimal; a longer fraction is rounded.
_WHOLE = "^[+-]?[0-9]{1,18}$"
_NUMBER = "^[+-]?[0-9]{1,32}([.][0-9]*)?$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def present(value: Column, missing: tuple[str, ...] = MISSING) -> Column:
    """The trimmed text, NULL if it says that nothing is there."""
    text = F.trim(value)
    return F.when(~text.isin(*missing), text)


def kind_of(value: Column) -> Column:
    """The kind of a `present` value, 0 for NULL."""
    return (F.when(value.isNull(), 0).when(value.rlike(_WHOLE), WHOLE).when(value.rlike(_NUMBER), NUMBER)
            .when(value.rlike(_DATE) & value.try_cast("date").isNotNull(), DATE).otherwise(TEXT))


def type_of(kinds: int) -> str:
    """The least type that holds values of all `kinds`; a column without values is text."""
    return {WHOLE: "bigint", NUMBER: NUMBER_TYPE, WHOLE | NUMBER: NUMBER_TYPE, DATE: "date"}.get(kinds, "string")


def _type_column(kinds: Column) -> Column:
    out = F.lit("string")
    for k in (WHOLE, NUMBER, WHOLE | NUMBER, DATE):
        out = F.when(kinds == k, F.lit(type_of(k))).otherwise(out)
    return out


def source_profile(raw: DataFrame, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """One row per column of a table of text: values by kind, the type that holds them
    all, and the least and largest value in that type's order (as text).

    One aggregate over the table, partial in every task: a column's state is a few counts and
    ends. Columns are told by position, so equal or dotted names do no harm."""
    width = len(raw.columns)
    rows = raw.toDF(*[f"c{i}" for i in range(width)])
    values = rows.select(*[present(F.col(f"c{i}").cast("string"), missing).alias(f"c{i}") for i in range(width)])
    kinds = values.select("*", *[kind_of(F.col(f"c{i}")).alias(f"k{i}") for i in range(width)])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(width):
        v, k = F.col(f"c{i}"), F.col(f"k{i}")
        number = F.when((k == WHOLE) | (k == NUMBER), v.try_cast(NUMBER_TYPE))
        aggs += [F.count_if(k == b).alias(f"n{b}_{i}") for b in (WHOLE, NUMBER, DATE, TEXT)]
        aggs += [F.bit_or(k).alias(f"kinds_{i}"), F.min(v).alias(f"lo_{i}"), F.max(v).alias(f"hi_{i}"),
                 F.min(number).alias(f"nlo_{i}"), F.max(number).alias(f"nhi_{i}")]
    one = kinds.agg(*aggs)
    out = []
    for i, name in enumerate(raw.columns):
        kind = F.coalesce(f"kinds_{i}", F.lit(0))
        kind_type = _type_column(kind)
        end = lambda which: (
            F.when(kind == WHOLE, F.col(f"n{which}_{i}").cast("bigint").cast("string"))
            .when(kind_type == NUMBER_TYPE, F.col(f"n{which}_{i}").cast("string")).otherwise(F.col(f"{which}_{i}")))
        n_kind = {b: F.col(f"n{b}_{i}") for b in (WHOLE, NUMBER, DATE, TEXT)}
        out.append(F.struct(
            F.lit(i).cast("bigint").alias("position"), F.lit(name).alias("column_name"), F.col("n").alias("n_rows"),
            (F.col("n") - n_kind[WHOLE] - n_kind[NUMBER] - n_kind[DATE] - n_kind[TEXT]).alias("n_missing"),
            n_kind[WHOLE].alias("n_whole"), n_kind[NUMBER].alias("n_number"), n_kind[DATE].alias("n_date"),
            n_kind[TEXT].alias("n_text"), kind_type.alias("column_type"), end("lo").alias("min_value"),
            end("hi").alias("max_value")))
    return one.select(F.inline(F.array(*out)))


def typed(raw: DataFrame, profile: DataFrame, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """`raw` with each column in the type of its `source_profile` (one row per column reaches
    the driver)."""
    found = {r.position: r.column_type for r in profile.select("position", "column_type").collect()}
    rows = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    return rows.select(*[typed_value(F.col(f"c{i}").cast("string"), found.get(i, "string"), missing).alias(name)
                         for i, name in enumerate(raw.columns)])


def typed_value(value: Column, data_type: str, missing: tuple[str, ...] = MISSING) -> Column:
    v = present(value, missing)
    return v if data_type == "string" else v.try_cast(data_type)


# ---------------------------------------------------------------------------
# Documents with keys that nobody listed
# ---------------------------------------------------------------------------

MOST_KEYS = 2_000


def discovered_keys(maps: DataFrame, column: str, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """(key, kinds, n): every key of the `map<string,string>` column, with the kinds of its
    values. Map-side aggregates: a key is one row per task before the shuffle, however many
    documents have it."""
    entries = maps.select(F.explode(F.col(column)).alias("key", "value"))
    values = entries.select("key", kind_of(present(F.col("value"), missing)).alias("kind"))
    return values.groupBy("key").agg(F.bit_or("kind").alias("kinds"), F.count(F.lit(1)).alias("n"))


def widened(maps: DataFrame, column: str, keep: list[str], most_keys: int = MOST_KEYS,
            missing: tuple[str, ...] = MISSING) -> DataFrame:
    """The columns `keep` and one typed column per key that occurs in any row's map, by name.

    The keys and their types are found first (one aggregate; one row per key reaches the
    driver, `most_keys` at most: beyond, the keys are data, not columns, and the load fails
    rather than leave some out). Keys that differ in case only would be one column and fail
    too, as do keys that clash with `keep`."""
    found = sorted(discovered_keys(maps, column, missing).limit(most_keys + 1).collect())
    if len(found) > most_keys:
        raise ValueError(f"more than {most_keys} different keys")
    lower = [k.key.lower() for k in found] + [k.lower() for k in keep]
    if len(set(lower)) < len(lower):
        raise ValueError(f"keys that clash: {sorted({k for k in lower if lower.count(k) > 1})}")
    return maps.select(*keep, *[typed_value(F.col(column)[k.key], type_of(k.kinds), missing).alias(k.key) for k in found])
