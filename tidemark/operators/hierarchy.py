"""Walks over parent-child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.skew import salted_join
from tidemark.session import few_rows, new_folder

#: Pieces that wait for one ancestor, up to which they are joined by one task.
WAITING_ROWS = 250_000


def connect_by(
    nodes: DataFrame,
    id_col: str,
    parent: str,
    start: Column,
    label: str,
    sep: str = "-> ",
    root_col: str | None = None,
) -> DataFrame:
    """All rows reached from the start rows by the parent key, with `path` and `level`.

    The path has the separator before each element, the first too. `root_col` carries the label
    of the start row down its branch.

    By pointer jumping: a row knows an ancestor and the piece of path between them. Each round it
    takes over what that ancestor knows, which doubles the piece, so a tree of depth d needs
    log2(d) rounds with one join each. A piece that ends at a start row is a finished walk. All rounds write to
    one table, by round and by whether the piece is still open; the next round and the result read
    its partitions.

    Near the end most pieces wait for one of few ancestors, so a join of many pieces is salted.

    There is no bound on the depth. A cycle that a walk enters fails the job: at once where it comes back to its
    own start row, else when a piece is longer than there are rows. Cycles that no start row leads
    to change nothing. Repeated ids are walked through each of their rows.
    """
    spark, columns, root = nodes.sparkSession, nodes.columns, new_folder(nodes.sparkSession, "walk")
    element = F.concat(F.lit(sep), F.col(label).cast("string"))
    piece = nodes.select(
        *[F.col(f"`{c}`").alias(f"n_{c}") for c in columns],
        F.when(start, F.col(label)).alias("_root"),
        F.when(start, F.col(id_col)).alias("_root_id"),
        F.col(parent).alias("_up"),
        element.alias("path"),
        F.lit(1).cast("bigint").alias("level"),
        F.coalesce(start, F.lit(False)).alias("_starts"),
    )
    known = [f"n_{c}" for c in columns]
    kept = [*known, "_root", "_root_id", "_up", "path", "level"]
    nothing = F.lit(None)
    done = piece.filter("_starts").select(*kept, F.lit(False).alias("_open")).withColumn("_up", nothing.cast(piece.schema["_up"].dataType))
    left = piece.filter("_up is not null").withColumns({"_root": nothing.cast(piece.schema["_root"].dataType), "_root_id": nothing.cast(piece.schema["_root_id"].dataType)})
    fresh = done.unionByName(left.select(*kept, F.lit(True).alias("_open")))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in fresh.schema.fields], T.StructField("_round", T.IntegerType())])

    def table() -> DataFrame:
        return spark.read.schema(schema).option("basePath", root).parquet(root)

    rows, reach, turn = None, 1, 0
    while True:
        fresh.write.option("compression", "zstd").partitionBy("_open").parquet(f"{root}/_round={turn}")
        walks = table()
        finished, pieces = walks.filter("not _open"), walks.filter(F.col("_open") & (F.col("_round") == turn))
        if pieces.isEmpty():
            break
        if turn == 2 and rows is None:
            rows = nodes.count()  # few rounds are no sign of a cycle
        if rows is not None and reach > rows:
            ids = pieces.select(F.col(f"n_{id_col}").alias("_id")).distinct()
            if not finished.join(ids, F.col(f"n_{id_col}") == F.col("_id"), "left_semi").isEmpty():
                raise RuntimeError("a cycle away from the start rows: more levels than rows")
            break
        above = finished.unionByName(pieces).select(
            F.col(f"n_{id_col}").alias("_above"),
            *[F.col(c).alias(f"a{c}") for c in ("_root", "_root_id", "_up", "path", "level", "_open")],
        )
        again = F.raise_error(F.concat(F.lit("cycle at "), F.col(f"n_{id_col}").cast("string"))).cast("string")
        closed = ~F.col("a_open") & (F.col("a_root_id") == F.col(f"n_{id_col}"))
        pieces = pieces.withColumnRenamed("_up", "_above")
        if few_rows(pieces):
            met = pieces.join(above, "_above")
        else:
            met = salted_join(pieces, above, ["_above"], hot_rows=WAITING_ROWS, large=True)
        fresh = met.select(
            *known,
            F.col("a_root").alias("_root"),
            F.col("a_root_id").alias("_root_id"),
            F.col("a_up").alias("_up"),
            F.when(closed, again).otherwise(F.concat("apath", "path")).alias("path"),
            (F.col("level") + F.col("alevel")).alias("level"),
            F.col("a_open").alias("_open"),
        )
        turn, reach = turn + 1, 2 * reach
    carried = [F.col("_root").alias(root_col)] if root_col else []
    found = table().filter("not _open")
    return found.select(*[F.col(f"n_{c}").alias(c) for c in columns], "path", *carried, F.col("level").cast("int").alias("level"))


def branches(
    nodes: DataFrame, id_col: str, parent: str, start: Column, top: Column, label: str, root_col: str = "branch"
) -> DataFrame:
    """Branches below several roots, each row labelled with its root, and the top row added.

    The roots sit one level under the top row, so levels are one higher; the path of the top row
    is its bare label.
    """
    walked = connect_by(nodes, id_col, parent, start, label, root_col=root_col)
    below = walked.withColumn("level", F.col("level") + 1)
    first = nodes.filter(top).select(
        *nodes.columns, F.col(label).alias("path"), F.col(label).alias(root_col), F.lit(1).alias("level")
    )
    return below.unionByName(first)


def edge_nodes(df: DataFrame, id_col: str, parent: str, out: str = "is_edge_node") -> DataFrame:
    """Flag the rows that nobody reports to.

    Parents are made distinct first: a parent with very many children is one row in the join.
    """
    superiors = df.select(F.col(parent).alias("_superior")).distinct()
    joined = df.join(superiors, F.col(id_col) == F.col("_superior"), "left")
    return joined.select(*df.columns, F.col("_superior").isNull().alias(out))
