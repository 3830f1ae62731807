"""Global quartiles and per-group ranks without a window over a whole group.

``rank().over(partition by period ...)`` puts a period into one task, and ``ntile`` without a
partition key the whole table. Both are computed here from counts on a fixed,
order-preserving grid of *slices* (a function of the value alone: about 0.4 % of a number's size, a
day of a date), so every executor puts a value into the same slice, and a retry too:

* ``rank_within``: a value's rank is one more than the rows of its group with an earlier value.
  Rows are counted per value, a running sum goes over the values of a slice, another over
  the slices of a group, and the rows take their rank from one join on the value.
* ``ntile_columns``: the row counts per slice tell in which slice each bucket begins. Only those
  few slices are looked into, by ever finer parts of their range of values, so a day on which a third of all rows fall
  is not one window; then by value and block of the tie-break, then row by row. All orders share these passes.
  The result is one cut row for each order and bucket, and every row is compared with these cuts in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one block of the tie-break column in ``ntile_columns``.
TIE_BLOCK = 1 << 16
#: Parts into which a range with a cut is split at each of LEVELS levels: a day comes down to 1.3 seconds, a number to a part in 10**7.
GRID = 1 << 16
LEVELS = 1


@dataclass(frozen=True)
class By:
    """An order by one numeric, date or timestamp column."""

    column: str
    desc: bool = True
    nulls_first: bool = True

    def keys(self, df: DataFrame) -> tuple[Column, Column, Column]:
        """(null flag, key, slice): ascending in this order."""
        kind, c = df.schema[self.column].dataType, F.col(self.column)
        if isinstance(kind, T.DateType):
            c = F.unix_date(c)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        key = -c if self.desc else c
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            slice_ = F.floor(key / (1 if isinstance(kind, T.DateType) else 86_400_000_000))
        else:
            x = key.cast("double")
            slice_ = F.floor(F.signum(x) * F.log1p(F.abs(x)) * 256)
        flag = F.when(c.isNull(), 0 if self.nulls_first else 2).otherwise(1)
        return flag, key, F.coalesce(slice_.cast("long"), F.lit(0).cast("long"))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def rank_within(df: DataFrame, partition_cols: Sequence[str], by: By, out_col: str) -> DataFrame:
    """Add ``out_col`` = RANK() OVER (PARTITION BY partition_cols ORDER BY by)."""
    group = list(partition_cols)
    flag, key, slice_ = by.keys(df)
    values = df.select(*group, flag.alias("_f"), key.alias("_k"), slice_.alias("_s")).groupBy(*group, "_f", "_k", "_s").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy(*group, "_f", "_s").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    local = values.withColumn("_local", F.sum("_n").over(inside) - F.col("_n"))
    # one row a slice in use: bounded by the grid, whatever the size of the group
    slices = values.groupBy(*group, "_f", "_s").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    at = [*group, "_f", "_s"]
    offsets = slices.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(at)], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    ranks = local.join(offsets, _same(at, [f"_o{i}" for i in range(len(at))])).select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate([*group, "_f", "_k"])], (F.col("_local") + F.col("_offset") + 1).cast("int").alias(out_col)
    )
    keyed = df.withColumn("_f", flag).withColumn("_k", key)
    names = [f"_r{i}" for i in range(len(group) + 2)]
    return keyed.join(ranks, _same([*group, "_f", "_k"], names), "left").select(*df.columns, out_col)


def _order_keys(df: DataFrame, bys: Sequence[By], tiebreak: str) -> DataFrame:
    """One row for each row and order: c (place in ``bys``), f, k (one type for all), s, id."""
    keys = [by.keys(df) for by in bys]
    types = [df.select(key).schema[0].dataType for _, key, _ in keys]
    if len(bys) == 1:
        common = types[0].simpleString()
    else:
        common = f"decimal(38,{max(t.scale if isinstance(t, T.DecimalType) else 0 for t in types)})"
    entries = [
        F.struct(F.lit(i).alias("c"), flag.cast("int").alias("f"), key.cast(common).alias("k"), slice_.alias("s")) for i, (flag, key, slice_) in enumerate(keys)
    ]
    return df.select(F.explode(F.array(*entries)).alias("e"), F.col(tiebreak).cast("long").alias("id")).select("e.*", "id")


def _inside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows in the ranges, with lo, hi and wants of their range. At most ``n - 1`` ranges an order: bounded by the call."""
    ranges = ranges.withColumnsRenamed({"c": "_c", "f": "_f"})
    within = (F.col("k") >= F.col("lo")) & (F.col("k") <= F.col("hi")) | F.col("k").isNull()
    return rows.join(F.broadcast(ranges), (F.col("c") == F.col("_c")) & (F.col("f") == F.col("_f")) & within).drop("_c", "_f")


def _wanted(counts: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The counted parts of a range in which a bucket begins: ``wants`` with its place among the rows of that part."""
    running = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("before", F.sum("n").over(running) - F.col("n"))
    here = F.filter("wants", lambda w: (w["off"] >= F.col("before")) & (w["off"] < F.col("before") + F.col("n")))
    moved = F.transform(here, lambda w: F.struct(w["p"].alias("p"), (w["off"] - F.col("before")).alias("off")))
    return counts.withColumn("wants", moved).where(F.size("wants") > 0)


def narrowed(rows: DataFrame, n: int, levels: int = LEVELS) -> DataFrame:
    """The ranges (c, f, lo, hi) in which buckets begin, with ``wants``: those buckets p and their offset there.

    First the slice, then for each level a 1 / GRID part of the range before it: whatever
    the values, a task looks at GRID + 1 counts of a range, and a range has shrunk by GRID ** levels.
    """
    ends = [F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")]
    slices = rows.groupBy("c", "f", "s").agg(*ends)  # bounded by the grid of slices
    total = F.sum("n").over(Window.partitionBy("c"))
    starts = [F.struct(F.lit(i).alias("p"), (F.floor(total / n) * i + F.least(F.lit(i), total % n)).alias("off")) for i in range(1, n)]
    # with fewer rows than buckets, the last ones begin behind the last row: in no slice, so they have no cut and stay empty
    ranges = _wanted(slices.withColumn("wants", F.array(*starts)), ["c"], ["f", "s"]).select("c", "f", "lo", "hi", "wants")
    for _ in range(levels):
        width = (F.col("hi") - F.col("lo")).cast("double")
        part = F.floor((F.col("k") - F.col("lo")).cast("double") / F.nullif(width, F.lit(0.0)) * GRID)
        parts = _inside(rows, ranges).withColumn("part", F.coalesce(part.cast("long"), F.lit(0).cast("long")))
        counts = parts.groupBy("c", "f", F.col("lo").alias("from"), "wants", "part").agg(*ends)
        ranges = _wanted(counts, ["c", "f", "from"], ["part"]).select("c", "f", "lo", "hi", "wants")
    return ranges


def ntile_cuts(df: DataFrame, n: int, bys: Sequence[By], tiebreak: str) -> DataFrame:
    """One row with ``cuts``: for each order (c) the first rows (flag, key, tie-break) of the second and later buckets of NTILE(n)."""
    rows = _order_keys(df, bys, tiebreak).withColumn("b", F.floor(F.coalesce("id", F.lit(-(1 << 62))) / TIE_BLOCK))
    # in the ranges that are left: values and blocks of the tie-break
    blocks = _inside(rows, narrowed(rows, n)).groupBy("c", "f", "lo", "wants", "k", "b").agg(F.count("*").alias("n"))
    hit = _wanted(blocks, ["c", "f", "lo"], [F.col("k").asc_nulls_first(), "b"])
    at = ["c", "f", "k", "b"]
    hit = hit.select(*[F.col(x).alias(f"_{x}") for x in at], F.explode("wants").alias("w"))
    # and the rows of those blocks
    found = rows.join(F.broadcast(hit), _same(at, [f"_{x}" for x in at]))
    place = F.row_number().over(Window.partitionBy("c", "w.p").orderBy(F.col("id").asc_nulls_first())) - 1
    cut = found.withColumn("place", place).where(F.col("place") == F.col("w.off"))
    lists = cut.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("f", "k", "id"))).alias("cuts"))
    return lists.agg(F.map_from_entries(F.collect_list(F.struct("c", "cuts"))).alias("cuts"))


def ntile_columns(df: DataFrame, n: int, orders: Sequence[tuple[By, str]], tiebreak: str, keys: DataFrame | None = None) -> DataFrame:
    """Add for each (by, name) of ``orders`` a column name = NTILE(n) OVER (ORDER BY by, tiebreak ASC).

    The tie-break is a unique integer column. ``keys``: a stored table with the columns, if ``df`` itself is costly to
    compute several times. Orders by whole numbers, decimals, dates and timestamps share their passes over it; one by a float has its own.
    """
    if n == 1 or not orders:
        return df.withColumns({name: F.lit(1) for _, name in orders})
    source = df if keys is None else keys
    floats = [o for o in orders if isinstance(df.schema[o[0].column].dataType, (T.FloatType, T.DoubleType))]
    exact = [o for o in orders if o not in floats]
    out = {}
    for family in [exact, *[[o] for o in floats]]:
        if not family:
            continue
        bys = [by for by, _ in family]
        cuts = ntile_cuts(source, n, bys, tiebreak)
        kind = cuts.schema["cuts"].dataType.valueType.elementType["k"].dataType
        cuts = cuts.scalar()
        for i, (by, name) in enumerate(family):
            flag, key, _ = by.keys(df)
            mine = F.struct(flag.cast("int").alias("f"), key.cast(kind).alias("k"), F.col(tiebreak).cast("long").alias("id"))
            here = F.try_element_at(cuts, F.lit(i))
            reached = [F.coalesce(F.get(here, F.lit(j)) <= mine, F.lit(False)).cast("int") for j in range(n - 1)]
            out[name] = sum(reached, F.lit(1))
    return df.withColumns(out)


def ntile_global(df: DataFrame, n: int, by: By, tiebreak: str, out_col: str, keys: DataFrame | None = None) -> DataFrame:
    """Add ``out_col`` = NTILE(n) OVER (ORDER BY by, tiebreak ASC): ``ntile_columns`` for one order."""
    return ntile_columns(df, n, [(by, out_col)], tiebreak, keys)
