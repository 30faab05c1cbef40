"""Data-quality checks (DQ-1..5, FL-1). Each check is a DataFrame of metrics
or violations; callers decide whether to fail, alert or just store them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealspark.operators.skew import salted_join


def _long(wide: DataFrame, table: str, metrics: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select(
        F.lit(table).alias("table_name"), "s.metric", "s.value")


def clean_layer_metrics(raw: DataFrame, clean: DataFrame, table: str,
                        null_columns: Sequence[str] = (),
                        flag_columns: Sequence[str] = (),
                        range_columns: Sequence[str] = ()) -> DataFrame:
    """DQ-1 / FL-1 / FL-2 / AG-7 / AG-8 / DD-2: a row count of the raw table
    and one pass over the clean table (rows, NULL counts, flag counts,
    min/max), as a long (table_name, metric, value) table. The clean table has
    one row per key, so the rows that it lacks are the duplicates removed."""
    stats = clean.agg(*clean_metric_columns(null_columns, flag_columns, range_columns))
    names = ["raw_rows", "duplicates_removed", *stats.columns]
    stats = stats.withColumn("raw_rows", raw.agg(F.count(F.lit(1))).scalar()).withColumn(
        "duplicates_removed", F.col("raw_rows") - F.col("clean_rows"))
    return _long(stats, table, names)


def distribution_metrics(distribution: DataFrame) -> DataFrame:
    """DQ-1: value counts (``profile.value_distributions``) as quality metrics named ``column=value``."""
    return distribution.select("table_name", F.concat_ws("=", "column_name", "value").alias("metric"),
                               F.col("count").cast("double").alias("value"))


def clean_metric_columns(null_columns: Sequence[str] = (), flag_columns: Sequence[str] = (),
                         range_columns: Sequence[str] = ()) -> list[Column]:
    """The clean-table metrics of DQ-1 as aggregate expressions (usable in
    ``agg`` or ``observe``)."""
    cols: list[Column] = [F.count(F.lit(1)).alias("clean_rows")]
    cols += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns]
    cols += [F.count_if(F.col(c) == F.lit(1)).alias(f"{c}_count") for c in flag_columns]
    for c in range_columns:
        cols += [F.min(F.col(c).cast("double")).alias(f"{c}_min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}_max")]
    return cols


def type_mismatches(df: DataFrame, expected: StructType, table: str) -> DataFrame:
    """DQ-2 (types): declared vs actual column types, one row per difference
    (metadata only; no job runs)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        got = actual.get(f.name)
        if got != f.dataType.simpleString():
            rows.append((table, f.name, f.dataType.simpleString(), got))
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, expected_type string, actual_type string")


def cast_violations(raw: DataFrame, casts: Mapping[str, tuple[str, Column]], row_key: str, table: str) -> DataFrame:
    """DQ-2 (values): one row for each cell whose text does not read as its
    declared type, from one pass over the raw table.

    ``casts`` maps a column to (declared type, parsed value). A cell violates
    its declaration if it is not NULL and its parsed value is: exactly the
    NULLs that cleaning introduces. Rows that repeat a key are reported each.
    """
    cells = [F.when(F.col(c).isNotNull() & parsed.isNull(), F.struct(
        F.lit(c).alias("column_name"), F.lit(declared).alias("declared_type"), F.col(c).cast("string").alias("raw_value")))
        for c, (declared, parsed) in casts.items()]
    return raw.select(F.col(row_key).cast("string").alias("row_key"), F.explode(F.array_compact(F.array(*cells))).alias("s")).select(
        F.lit(table).alias("table_name"), "row_key", "s.*")


def casts_hold(casts: Mapping[str, tuple[str, Column]]) -> Column:
    """Whether every declared cast of a row succeeds (a NULL cell does), for ``sinks.write_split``."""
    held = F.lit(True)
    for c, (_, parsed) in casts.items():
        held = held & (F.col(c).isNull() | parsed.isNotNull())
    return held


def range_violations(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """DQ-2 (ranges): rows failing each named rule, counted in one pass.
    A rule is a boolean Column that must hold; NULL counts as a violation."""
    wide = df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name)
                    for name, cond in rules.items()])
    rows = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select(
        F.lit(table).alias("table_name"), "s.rule", "s.violations")


def violating_rows(df: DataFrame, rule: Column) -> DataFrame:
    """DQ-2: the rows that break a rule, for inspection or quarantine."""
    return df.where(~F.coalesce(rule, F.lit(False)))


def orphans(child: DataFrame, parent: DataFrame, row_key: str, key: str = "customer_id") -> DataFrame:
    """DQ-3: child rows whose key is not in the parent; rows with a NULL key
    never match and are reported too. The anti join runs on distinct keys, and
    the rows of unmatched keys come back by a join salted by ``row_key``, so a
    hot key spreads over tasks."""
    keys = child.select(key).where(F.col(key).isNotNull()).distinct()
    unknown = keys.join(parent.select(key).distinct(), key, "left_anti")
    found = salted_join(child.where(F.col(key).isNotNull()), unknown, key, "left_semi", row_key)
    return found.select(*child.columns).unionByName(child.where(F.col(key).isNull()))


def orphan_counts(children: Mapping[str, DataFrame], parent: DataFrame,
                  key: str = "customer_id") -> DataFrame:
    """DQ-3 summary: orphan rows per child table.

    Each child is first reduced to (key, rows) by a partial aggregate, so
    the anti join sees one row per key — a key holding a third of the child
    rows is one row here — and the orphan rows are the sum over unmatched keys.
    """
    parts = []
    keys = parent.select(key).distinct()
    for name, child in children.items():
        per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
        o = per_key.join(keys, key, "left_anti").agg(
            F.coalesce(F.sum("__rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        parts.append(o.select(F.lit(name).alias("table_name"), "orphan_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def completeness(df: DataFrame, table: str) -> DataFrame:
    """DQ-4 (definition ours): non-NULL cells / cells × 100, one pass."""
    n_cols = len(df.columns)
    non_null = sum((F.count(F.col(c)) for c in df.columns), F.lit(0))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), non_null.alias("non_null_cells"))
    return wide.select(
        F.lit(table).alias("table_name"), "rows",
        (F.col("rows") * F.lit(n_cols)).alias("cells"), "non_null_cells",
        F.round(F.try_divide(F.col("non_null_cells") * F.lit(100.0), F.col("rows") * F.lit(n_cols)), 4)
        .alias("completeness_pct"))


def volume_growth(previous: DataFrame, current: DataFrame) -> DataFrame:
    """DQ-5: row-count change per table between two runs (or two layers).
    Inputs are ``(table_name, row_count)`` tables, one row per table."""
    p = previous.select("table_name", F.col("row_count").alias("previous_rows"))
    c = current.select("table_name", F.col("row_count").alias("current_rows"))
    j = p.join(c, "table_name", "full_outer")
    return j.select(
        "table_name", "previous_rows", "current_rows",
        (F.col("current_rows") - F.col("previous_rows")).alias("row_change"),
        F.round(F.try_divide((F.col("current_rows") - F.col("previous_rows")) * F.lit(100.0),
                             F.col("previous_rows")), 4).alias("growth_pct"))
