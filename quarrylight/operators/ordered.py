"""Ordered scans of groups of any size: rows are dealt by ranges of (group, order), and what one range needs of those before
it is joined as one row a range. No window ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.jobs.shared import written
from quarrylight.operators.dense import cosine

#: Rows of a range.
ROWS = 20_000
#: Steps of the first histogram of a percentile, over -1..1.
BINS = 1 << 12


def in_ranges(df: DataFrame, group_col: str, order_col: str, rows: int = ROWS) -> DataFrame:
    """df as g, o, its other columns, and range: numbers that rise with (group, order), written once."""
    renamed = df.select(F.col(group_col).alias("g"), F.col(order_col).alias("o"), *(c for c in df.columns if c not in (group_col, order_col)))
    dealt = renamed.repartitionByRange(max(1, -(-df.count() // rows)), "g", "o")
    return written(dealt.withColumn("range", F.spark_partition_id()), "ranges")


def _within() -> Window:
    return Window.partitionBy("range").orderBy("g", "o")


def with_previous(ranged: DataFrame, value_col: str) -> DataFrame:
    """Adds first (no row of the group comes before) and before: the value of the group's row before, of whatever range."""
    ends = ranged.groupBy("range").agg(F.max_by(F.struct("g", F.col(value_col).alias("v")), F.struct("g", "o")).alias("end"))
    numbered = ends.withColumn("range", F.lead("range").over(Window.orderBy("range")))  # one row a range: the next one that has rows
    w = _within()
    here = ranged.withColumn("__head", F.row_number().over(w) == 1).withColumn("__g", F.lag("g").over(w)).withColumn("__v", F.lag(value_col).over(w))
    joined = here.join(numbered.select("range", "end"), "range", "left")
    same = F.when(F.col("__head"), F.col("end").isNotNull() & F.col("end.g").eqNullSafe(F.col("g"))).otherwise(F.col("__g").eqNullSafe(F.col("g")))
    before = F.when(same, F.when(F.col("__head"), F.col("end.v")).otherwise(F.col("__v")))
    return joined.withColumn("first", ~same).withColumn("before", before).drop("__head", "__g", "__v", "end")


def _totals(ranged: DataFrame, *aggregates: Column) -> DataFrame:
    """One row for each range and group: their aggregates."""
    return ranged.groupBy("range", "g").agg(*aggregates)


def running(ranged: DataFrame, value: Column, name: str, kind: str) -> DataFrame:
    """Adds the running sum or max of a value in each group, in its order."""
    f = {"sum": F.sum, "max": F.max}[kind]
    rows = ranged.withColumn("__x", value)
    earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for a range of the group
    carried = _totals(rows, f("__x").alias("t")).withColumn("carried", f("t").over(earlier)).select(F.col("range").alias("__r"), F.col("g").alias("__g"), "carried")
    own = f("__x").over(Window.partitionBy("range", "g").orderBy("o"))
    joined = rows.withColumn("__own", own).join(carried, (F.col("range") == F.col("__r")) & F.col("g").eqNullSafe(F.col("__g")), "left")
    both = F.coalesce(F.col("__own"), F.lit(0)) + F.coalesce(F.col("carried"), F.lit(0)) if kind == "sum" else F.greatest("__own", "carried")
    return joined.withColumn(name, both).drop("__x", "__own", "__r", "__g", "carried")


def exact_percentile(values: DataFrame, share: float) -> DataFrame:
    """(g, cut): the value at a share of the order of a group's x (-1 to 1), between neighbours in proportion.

    A histogram of fixed size says which steps hold the two values asked for; only the distinct values of those steps are
    put in order, with their numbers. A group's values never meet in one task, and equal ones are counted before they move.
    """
    rows = values.where(F.col("x").isNotNull()).withColumn("bin", F.floor((F.col("x") + 1) / 2 * BINS).cast("int"))
    counts = written(rows.groupBy("g", "bin", "x").agg(F.count("*").alias("c")), "percentile")
    steps = counts.groupBy("g", "bin").agg(F.sum("c").alias("n"))
    total = Window.partitionBy("g")
    steps = steps.withColumn("all", F.sum("n").over(total)).withColumn("before", F.sum("n").over(total.orderBy("bin")) - F.col("n"))
    at = F.lit(float(share)) * (F.col("all") - 1)
    steps = steps.select("g", "bin", "n", "before", at.alias("at"), F.floor(at).alias("low"), F.ceil(at).alias("high"))
    holds = lambda k: (F.col(k) >= F.col("before")) & (F.col(k) < F.col("before") + F.col("n"))
    wanted = steps.where(holds("low") | holds("high")).withColumnsRenamed({"g": "__g", "bin": "__bin"})
    few = counts.join(wanted, F.col("g").eqNullSafe(F.col("__g")) & (F.col("bin") == F.col("__bin"))).select("g", "bin", "x", "c", "before", "at", "low", "high")
    few = few.withColumn("from", F.col("before") + F.sum("c").over(Window.partitionBy("g", "bin").orderBy("x")) - F.col("c"))
    is_at = lambda k: (F.col(k) >= F.col("from")) & (F.col(k) < F.col("from") + F.col("c"))
    found = few.groupBy("g").agg(F.max(F.when(is_at("low"), F.col("x"))).alias("a"), F.max(F.when(is_at("high"), F.col("x"))).alias("b"), F.max(F.col("at") - F.col("low")).alias("part"))
    return found.select("g", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("cut"))


def segments(vectors: DataFrame, group_col: str, order_col: str, vector_col: str = "embedding", share: float = 0.3, longest: int = 10, rows: int = ROWS) -> DataFrame:
    """(group, order, sim, part, sub): neighbours' cosine; a part begins where it falls under the group's percentile, sub counts ``longest`` rows each.

    Rows with a null group are one group; orders must be unique in a group.
    """
    given = vectors.select(group_col, order_col, F.col(vector_col).cast("array<double>").alias("v"))
    alike = with_previous(in_ranges(given, group_col, order_col, rows), "v").withColumn("sim", cosine(F.col("v"), F.col("before"))).drop("v", "before")
    alike = written(alike, "similar")
    cuts = exact_percentile(alike.select("g", F.col("sim").alias("x")), share).select(F.col("g").alias("__g"), "cut")
    told = alike.join(F.broadcast(cuts) if cuts.limit(100_001).count() <= 100_000 else cuts, F.col("g").eqNullSafe(F.col("__g")), "left")
    broken = told.withColumn("broken", F.coalesce(F.round("sim", 9) < F.round("cut", 9), F.lit(False))).drop("__g", "cut")
    counted = running(running(broken, F.col("broken").cast("long"), "part", "sum"), F.lit(1).cast("long"), "nth", "sum")
    placed = running(counted, F.when(F.col("first") | F.col("broken"), F.col("nth")), "start", "max")
    sub = F.floor((F.col("nth") - F.col("start")) / longest)
    return placed.select(F.col("g").alias(group_col), F.col("o").alias(order_col), "sim", F.col("part").cast("long").alias("part"), sub.cast("long").alias("sub"))
