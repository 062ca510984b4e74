"""Relational building blocks: one row per key, limits per group, profiles, checks, upserts and change detection.

Every choice among rows has a total order: callers give one, and all remaining columns break its ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scratch import materialize


def _total(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    return [*order, *[F.col(c).asc_nulls_last() for c in df.columns if c not in keys]]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; Spark cuts the groups down before the shuffle (WindowGroupLimit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_total(df, keys, order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str = "loaded_at") -> DataFrame:
    return top_per_key(df, keys, [F.col(at).desc_nulls_last()])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold only nulls; one pass over the data."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def fill_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, filled (neither null nor blank) and their share; one aggregate, then a row for each column."""
    filled = [F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *filled)
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    stacked = counts.selectExpr("_rows AS n_rows", f"stack({len(df.columns)}, {pairs}) AS (column_name, n_filled)")
    return stacked.select("column_name", "n_rows", "n_filled", F.when(F.col("n_rows") > 0, F.col("n_filled") / F.col("n_rows")).otherwise(0.0).alias("coverage"))


def quality_report(df: DataFrame, rules: Mapping[str, float]) -> DataFrame:
    """Per ruled column: coverage (0 if the table lacks it), least allowed coverage, and whether it is reached; a table without rows fails."""
    found = fill_profile(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in rules]))
    least = F.element_at(F.create_map(*[x for c, v in rules.items() for x in (F.lit(c), F.lit(float(v)))]), F.col("column_name"))
    return found.withColumn("least", least).withColumn("passed", (F.col("n_rows") > 0) & (F.col("coverage") >= F.col("least")))


def assert_quality(report: DataFrame) -> None:
    failed = [r["column_name"] for r in report.filter(~F.col("passed")).collect()]  # a row for each ruled column
    if failed:
        raise ValueError(f"quality gate failed for: {', '.join(sorted(failed))}")


def assert_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df``, after a look that none of the columns is null in any row; an error names those that are."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    if any(nulls):
        raise ValueError("null values: " + ", ".join(f"{c} in {nulls[c]} rows" for c in columns if nulls[c]))
    return df


def append_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All existing rows, and those of the new ones whose key they lack; columns that only one side has are null in the other."""
    match = [existing[k].eqNullSafe(new[k]) for k in keys]
    return existing.unionByName(new.join(existing, match, "left_anti"), allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose (non-null) reference has no parent."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return df.dropna(subset=list(on)).join(keys, list(on), "left_anti")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def mode_per_group(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """The most frequent non-null value of each group, the least among equals. Counts are taken before the groups meet."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    return top_per_key(counts, keys, [F.col("_n").desc(), F.col(col).asc()]).select(*keys, F.col(col).alias(out))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """``old`` with ``new`` merged in: new keys are added whole, known ones take the ``update`` columns and keep the others.
    Null keys are keys like any other."""
    o, n = old.withColumn("_here", F.lit(True)).alias("o"), new.withColumn("_here", F.lit(True)).alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full_outer")
    is_new, is_old = F.col("n._here").isNotNull(), F.col("o._here").isNotNull()
    column = lambda c: F.when(is_new & ((~is_old) | F.lit(c in update)), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) if c in keys else column(c).alias(c) for c in old.columns])


def fingerprint(columns: Sequence[Column]) -> Column:
    return F.sha2(F.to_json(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(columns)]), {"ignoreNullFields": "false"}), 256)


def change_status(old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Per key of ``new``: new, changed or unchanged, by fingerprints of the content columns."""
    mark = fingerprint([F.col(c) for c in content])
    before = old.select(*keys, mark.alias("_before"))
    status = F.when(F.col("_before").isNull(), "new").when(F.col("_before") == F.col("_now"), "unchanged").otherwise("changed")
    return new.select(*keys, mark.alias("_now")).join(before, list(keys), "left").select(*keys, status.alias("status"))


def sequential_ids(df: DataFrame, order: str, prefix: str, width: int, out: str = "id") -> DataFrame:
    """Numbers 1, 2, ... by ``order`` (unique), as zero-padded ids. Rows are range-partitioned and numbered within their
    partition; a count per partition gives each its offset, so no task holds all rows. The partitioning is written down,
    for the counts and the numbers must see the same one."""
    spread = materialize(df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()), "ordered")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    counts = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = spread.withColumn("_k", within).join(F.broadcast(counts.select("_part", before.alias("_before"))), "_part")
    return numbered.withColumn(out, F.concat(F.lit(prefix), F.lpad((F.col("_k") + F.col("_before")).cast("string"), width, "0"))).drop("_part", "_k", "_before")


def tree_closure(nodes: DataFrame, key: str, parent: str, level: str, depth: int | None = None) -> DataFrame:
    """Per node and ancestor (itself included): key, ancestor, ancestor_level. Without a known ``depth`` of the trees, it goes up
    until no node has a further ancestor; a node that is its own ancestor is an error."""
    up = nodes.select(F.col(key).alias("ancestor"), F.col(parent).alias("above"), F.col(level).alias("ancestor_level"))
    current = nodes.select(F.col(key), F.col(key).alias("ancestor"), F.col(parent).alias("above"), F.col(level).alias("ancestor_level"))
    out = current
    step = 1
    while depth is None or step < depth:
        current = current.select(key, F.col("above").alias("ancestor")).join(up, "ancestor").select(key, "ancestor", "above", "ancestor_level")
        if depth is None:
            current = materialize(current, "ancestors")
            if current.isEmpty():
                break
            if not current.filter(F.col(key) == F.col("ancestor")).isEmpty():
                raise ValueError(f"{key} has a cycle")
        out = out.unionByName(current)
        step += 1
    return out.select(key, "ancestor", "ancestor_level")


def sample_rows(df: DataFrame, rows: int, columns: int = 8) -> DataFrame:
    """A look at a table: some ``rows`` of its first ``columns``; none of either where the number isn't positive."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[: max(columns, 0)]]).limit(max(rows, 0))
