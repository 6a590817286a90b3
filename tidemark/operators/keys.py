"""Checks of declared keys and column rules, run as jobs because Parquet enforces none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.contracts import Table


def key_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def fk_violations(
    child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str]
) -> DataFrame:
    """Child rows whose key has no parent; a NULL in the key is no violation."""
    keyed = child.dropna(subset=list(child_cols))
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)])
    match = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(child_cols)]
    return keyed.join(parents, match, "left_anti")


def _edge_counts(child: DataFrame, parent: DataFrame, cols: Sequence[str], parent_cols: Sequence[str]) -> DataFrame:
    """Rows of one reference that match, that have no parent and that have no key.

    Child keys are counted before the join, so a hot key is one row by then.
    """
    keys = child.groupBy(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)]).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)]).distinct()
    no_key = F.lit(False)
    for i in range(len(cols)):
        no_key = no_key | F.col(f"_c{i}").isNull()
    joined = keys.join(parents, [F.col(f"_c{i}") == F.col(f"_p{i}") for i in range(len(cols))], "left")
    found = F.col("_p0").isNotNull()

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("bigint")

    return joined.agg(
        total(found).alias("matched_rows"),
        total(~found & ~no_key).alias("orphan_rows"),
        total(no_key).alias("null_rows"),
    )


def fk_report(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Table], table: str | None = None, direction: str = "imported"
) -> DataFrame:
    """References of a table with row-level counts.

    `imported`: the keys that the table takes from others; `exported`: where it is referenced.
    With `table=None` every declared reference is reported.
    """
    if direction not in ("imported", "exported"):
        raise ValueError(f"unknown direction: {direction}")
    report = None
    for contract in contracts.values():
        for ref in contract.references:
            wanted = contract.name if direction == "imported" else ref.parent
            if table is not None and wanted != table:
                continue
            edge = _edge_counts(tables[contract.name], tables[ref.parent], ref.columns, ref.parent_columns).select(
                F.lit(ref.name).alias("fk_name"),
                F.lit(contract.name).alias("child_table"),
                F.lit(",".join(ref.columns)).alias("child_columns"),
                F.lit(ref.parent).alias("parent_table"),
                F.lit(",".join(ref.parent_columns)).alias("parent_columns"),
                "matched_rows",
                "orphan_rows",
                "null_rows",
            )
            report = edge if report is None else report.unionByName(edge)
    if report is None:
        raise ValueError(f"no {direction} reference for {table}")
    return report


def check_schema(df: DataFrame, contract: Table) -> DataFrame:
    """Rows that break a column rule (not null, length), one output row per rule.

    All rules are counted in one pass over the table.
    """
    rules = []
    for f in contract.fields:
        if f.name not in df.columns:
            continue
        if not f.nullable:
            rules.append((f.name, "not null", F.col(f.name).isNull()))
        if f.max_length is not None:
            rules.append((f.name, f"length <= {f.max_length}", F.length(f.name) > f.max_length))
    return _counted(df, contract.name, rules)


def check_source(rows: DataFrame, contract: Table) -> DataFrame:
    """Stored values that break a column rule of a model table, one output row per rule, in one pass.

    The rules look at the stored columns, before any cast: a value is missing, is none of the
    declared type, has more decimal places than the type keeps, or is too long. So what a cast would turn into
    NULL or round is found here.
    """
    rules = []
    for f in contract.fields:
        stored = F.col(f.source)
        if not f.nullable:
            rules.append((f.source, "not null", stored.isNull()))
        cast = stored.try_cast(f.type)
        rules.append((f.source, f"is {f.type}", stored.isNotNull() & cast.isNull()))
        if f.type.startswith("decimal"):
            rules.append((f.source, f"scale of {f.type}", stored.try_cast("decimal(38,6)") != cast.cast("decimal(38,6)")))
        if f.max_length is not None:
            rules.append((f.source, f"length <= {f.max_length}", F.length(stored) > f.max_length))
    return _counted(rows, contract.name, rules)


def _counted(df: DataFrame, table: str, rules: Sequence[tuple]) -> DataFrame:
    counts = df.agg(
        *[F.count(F.when(broken, F.lit(1))).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col(f"r{i}").alias("violations"),
            )
            for i, (column, rule, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))
