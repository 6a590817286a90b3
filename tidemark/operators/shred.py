"""Shredding of documents into relational tables with surrogate keys.

Each operator takes the target as it stands and gives the rows to append to it; nothing that is
in the target is written again. Rows are reduced to one per natural key before anything else
(partial aggregation on the map side), so a value that sits in a third of all documents is one
row per task from then on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.merge import absent, without
from tidemark.operators.numbering import assign_keys
from tidemark.session import few_rows, join_side, stage


def first_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least of its rows, so the choice is the same in every run.

    The struct compares NULL as lowest, so a row with fewer values comes first.
    """
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    least = F.min(F.struct(*others)).alias("_least")
    return rows.groupBy(*keys).agg(least).select(*[c if c in keys else f"_least.{c}" for c in rows.columns])


def _max_key(target: DataFrame, sk: str) -> Column:
    return target.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()


def shred_dim(target: DataFrame, rows: DataFrame, natural_key: str, sk: str, few: bool | None = None) -> DataFrame:
    """Dimension rows whose natural key is absent, with keys after the target's highest.

    The batch is reduced to one row per key and written; the target is only asked for these keys.
    `few`, here and below, tells whether `rows` are few; a caller that knows of many saves counting them and what they meet.
    """
    known = rows.filter(F.col(natural_key).isNotNull())
    distinct = stage(first_per_key(known, [natural_key]), f"distinct-{sk}")
    fresh = without(distinct, target, [natural_key], written=True, few=few)
    keyed = assign_keys(fresh.select(*rows.columns), sk, [natural_key], _max_key(target, sk))
    return keyed.select(*target.columns)


def shred_rollup(
    target: DataFrame,
    parents: DataFrame,
    children: DataFrame,
    natural_key: str,
    parent_name: str,
    sk: str,
    parent_ref: str,
    few: bool | None = None,
) -> DataFrame:
    """New parents and children of one self-referencing table, parents first.

    `children` names its parent in `parent_name`; it is replaced by the parent's surrogate key.
    A child whose parent is not in the table is not loaded, as it has nothing to point to.
    Both are written once each: the parents are read several times, and the rows given back are plain scans.
    """
    types = {f.name: f.dataType for f in target.schema.fields}

    def filled(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[
                (F.col(c) if c in rows.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in target.columns
                if c != sk
            ]
        )

    new_parents = stage(shred_dim(target, filled(parents), natural_key, sk, few), "parents")
    with_parents = target.unionByName(new_parents)
    owners = with_parents.select(F.col(natural_key).alias(parent_name), F.col(sk).alias(parent_ref))
    small = few is not False and few_rows(with_parents)
    linked = children.join(owners if small else owners.hint("merge"), parent_name, "inner")
    return new_parents.unionByName(stage(shred_dim(with_parents, filled(linked), natural_key, sk, few), "children"))


def resolve(
    rows: DataFrame, dim: DataFrame, name: str, natural_key: str, sk: str, out: str, few: bool | None = None
) -> DataFrame:
    """Replace a natural key by the dimension's surrogate key.

    `few` tells whether `rows` are few, if the caller has counted them.
    """
    keys = dim.select(F.col(natural_key).alias(name), F.col(sk).alias(out))
    few = few_rows(rows) if few is None else few
    if not few:  # else the rows themselves might be broadcast beside few keys
        keys = F.broadcast(keys) if few_rows(dim) else keys.hint("merge")
    return rows.join(keys, name, "inner").drop(name)


def shred_values(
    target: DataFrame,
    rows: DataFrame,
    owner: DataFrame,
    name: str,
    natural_key: str,
    sk: str,
    value: str,
    few: bool | None = None,
) -> DataFrame:
    """New rows, one per owner and value of a multi-valued attribute; both make the key."""
    distinct = first_per_key(rows, [name, value])
    keyed = resolve(distinct, owner, name, natural_key, sk, sk, few_rows(rows) if few is None else few)
    return absent(target, stage(keyed, f"keyed-{value}"), [sk, value], written=True, few=few)


def shred_bridge(
    target: DataFrame,
    rows: DataFrame,
    sides: Mapping[str, tuple[DataFrame, str, str]],
    few: bool | None = None,
) -> DataFrame:
    """New pairs of surrogate keys for a many-to-many relationship.

    `sides` maps each natural-key column of `rows` to (dimension, its natural key, its surrogate key).
    """
    keyed, small = first_per_key(rows, list(sides)), few_rows(rows) if few is None else few
    for name, (dim, natural_key, sk) in sides.items():
        keyed = resolve(keyed, dim, name, natural_key, sk, sk, small)
    return absent(target, stage(keyed, "keyed-pairs"), [sk for _, _, sk in sides.values()], written=True, few=few)


def shredded_star(
    rollup: DataFrame, carrier: DataFrame, bridge: DataFrame, dim: DataFrame, member_sk: str, carrier_sk: str, dim_sk: str
) -> DataFrame:
    """Read the shredded tables back: one row per member and linked value, `None` for no value.

    `rollup` holds the members with the key of their carrier, `bridge` links them to `dim`.
    """
    carriers = carrier.select(carrier_sk, F.col("type").alias("carrier_type"))
    linked = dim.select(dim_sk, F.col("name").alias("_linked"))
    return (
        rollup.join(join_side(carriers), carrier_sk, "inner")
        .join(join_side(bridge.select(member_sk, dim_sk)), member_sk, "left")
        .join(join_side(linked), dim_sk, "left")
        .select(
            "name",
            F.coalesce("nickname", F.lit("None")).alias("nickname"),
            "carrier_type",
            F.coalesce("_linked", F.lit("None")).alias("linked_name"),
        )
    )
