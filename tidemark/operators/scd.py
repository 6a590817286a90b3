"""Slowly changing dimensions of types 1, 2 and 3."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.hashing import diff_hash
from tidemark.operators.merge import MergeResult, join_by_key, merge
from tidemark.session import stage


def open_ts() -> Column:
    """The end stamp of a row that is current."""
    return F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")


def one_second_before(load: Column) -> Column:
    return load - F.expr("INTERVAL 1 SECOND")


def with_hash(rows: DataFrame, tracked: Sequence[str]) -> DataFrame:
    return rows.withColumn("diff_hash", diff_hash(tracked))


def scd1_initial(landed: DataFrame, tracked: Sequence[str]) -> DataFrame:
    return with_hash(landed, tracked)


def scd1(
    dim: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], stamp: str = "load_ts"
) -> MergeResult:
    """Overwrite on change: tracked columns, stamp and hash take the batch's values.

    Other columns of a known row keep what they hold, also when the batch differs there.
    """
    source = with_hash(batch, tracked)
    changed = [*tracked, stamp, "diff_hash"]
    return merge(
        dim,
        source,
        keys,
        update={c: F.col(f"s.{c}") for c in changed},
        insert={c: F.col(f"s.{c}") for c in dim.columns},
        when=F.col("t.diff_hash") != F.col("s.diff_hash"),
    )


def scd2_initial(landed: DataFrame, tracked: Sequence[str], stamp: str = "load_ts") -> DataFrame:
    """First version of each row: open from its load on."""
    return (
        with_hash(landed, tracked)
        .withColumn("from_dts", F.col(stamp))
        .withColumn("to_dts", open_ts())
        .drop(stamp)
    )


@dataclass(frozen=True)
class Bands:
    """How a table of bands is laid out: its columns for start and end, and the steps of a load."""

    from_col: str
    to_col: str
    open_value: Callable[[], Column]
    before: Callable[[Column], Column]
    hash_col: str = "diff_hash"

    def current(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(self.to_col) == self.open_value())

    def closed(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(self.to_col) != self.open_value())


def band_step(
    current: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], bands: Bands
) -> DataFrame:
    """Load a batch over the open bands: close the old band of a changed key, open a new one.

    `source` has the table's columns but the end; its start column is the load. The new band
    takes the `update` columns, the hash and the load from the source and everything else from
    the old band. Each open band is read once: a changed row becomes its closed and its new form
    by `inline`. Gives the open bands after the load and the bands it closed; bands closed
    earlier take no part.
    """
    from_col, to_col, hash_col = bands.from_col, bands.to_col, bands.hash_col
    open_value, before = bands.open_value(), bands.before
    joined = join_by_key(current, source, keys)

    inserted = F.col("t._t").isNull()
    changed = F.col("s._s").isNotNull() & (F.col(f"t.{hash_col}") != F.col(f"s.{hash_col}"))
    from_source = {*update, hash_col, from_col}
    types = {f.name: f.dataType for f in current.schema.fields}

    def row(pick: Callable[[str], Column]) -> Column:
        return F.struct(*[pick(c).cast(types[c]).alias(c) for c in current.columns])

    def kept(c: str) -> Column:
        return F.col(f"t.{c}")

    def new(c: str) -> Column:
        return open_value if c == to_col else F.col(f"s.{c}")

    def closed(c: str) -> Column:
        return before(F.col(f"s.{from_col}")) if c == to_col else F.col(f"t.{c}")

    def reopened(c: str) -> Column:
        return F.col(f"s.{c}") if c in from_source else F.col(f"t.{c}")

    rows = (
        F.when(inserted, F.array(row(new)))
        .when(changed, F.array(row(closed), row(reopened)))
        .otherwise(F.array(row(kept)))
    )
    return joined.select(F.inline(rows))


def band_load(
    table: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], bands: Bands
) -> DataFrame:
    """The whole table after a load: its open bands loaded, its closed ones as they are."""
    stepped = band_step(bands.current(table), source, keys, update, bands)
    return stepped.unionByName(bands.closed(table))


def band_loads(
    table: DataFrame, sources: Sequence[DataFrame], keys: Sequence[str], update: Sequence[str], bands: Bands
) -> DataFrame:
    """Several loads in their order.

    Each load writes the open bands and the ones it closed; closed bands are written once and
    not read again by later loads.
    """
    current, closed = bands.current(table), [bands.closed(table)]
    for source in sources:
        rows = stage(band_step(current, source, keys, update, bands), "bands")
        current = bands.current(rows)
        closed.append(bands.closed(rows))
    for rows in closed:
        current = current.unionByName(rows)
    return current


VERSIONS = Bands("from_dts", "to_dts", open_ts, one_second_before)


def scd2(
    dim: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], stamp: str = "load_ts"
) -> DataFrame:
    """A new version on change; the old version ends one second before the load."""
    return band_load(dim, scd2_source(batch, tracked, stamp), keys, tracked, VERSIONS)


def scd2_source(batch: DataFrame, tracked: Sequence[str], stamp: str = "load_ts") -> DataFrame:
    return with_hash(batch, tracked).withColumnRenamed(stamp, "from_dts")


def scd2_loads(
    dim: DataFrame, batches: Sequence[DataFrame], keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Several loads in their order; each reads the open versions that the one before left."""
    return band_loads(dim, [scd2_source(b, tracked) for b in batches], keys, tracked, VERSIONS)


def scd3_initial(landed: DataFrame, tracked: Sequence[str], original: str) -> DataFrame:
    """A type 1 table plus a column that keeps the first value of `tracked[0]`."""
    return scd1_initial(landed, tracked).withColumn(original, F.col(tracked[0]))


def scd3(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    original: str,
    stamp: str = "load_ts",
) -> MergeResult:
    """Type 1 load that sets the original value for new keys and never changes it."""
    source = with_hash(batch, tracked).withColumn(original, F.col(tracked[0]))
    changed = [*tracked, stamp, "diff_hash"]
    return merge(
        dim,
        source,
        keys,
        update={c: F.col(f"s.{c}") for c in changed},
        insert={c: F.col(f"s.{c}") for c in dim.columns},
        when=F.col("t.diff_hash") != F.col("s.diff_hash"),
    )


def changed_from_original(dim: DataFrame, col: str, original: str) -> DataFrame:
    return dim.filter(F.col(col) != F.col(original))
