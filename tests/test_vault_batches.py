"""A large batch meets the keys of a vault table in one aggregate; a small one looks them up."""

from __future__ import annotations

import datetime as dt

import pytest
from rows_of_frames import rows

from tidemark import session
from tidemark.operators import vault
from tidemark.session import stage

DAY = [dt.datetime(2024, 1, n) for n in (1, 2, 3)]
BATCH = "hk string, load_ts timestamp, x string, h string, rec_src string"
SAT = "hk string, load_ts timestamp, x string, hash_diff string, rec_src string"


@pytest.mark.parametrize("large", [False, True])
def test_each_key_once_and_held_keys_not_again(spark, monkeypatch, large):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0 if large else 50_000)
    batch = [("a", DAY[1], "A", "1", "s"), ("b", DAY[2], "B", "2", "s"), ("b", DAY[1], "B", "2", "s"), ("b", DAY[1], "B", "2", "s"),
             (None, DAY[2], "N", "1", "s"), (None, DAY[1], "N", "1", "s"), ("a", DAY[2], "A", None, "s")]
    batch = stage(spark.createDataFrame(batch, BATCH), "batch")
    held = [("a", DAY[0], "A", "1", "s"), ("a", DAY[0], "A", None, "s"), (None, DAY[0], "N", "1", "s"), ("z", DAY[0], "Z", "9", "s")]
    sat = stage(spark.createDataFrame(held, SAT), "sat")
    expected = [(None, DAY[1], "N", "1", "s"), ("a", DAY[2], "A", None, "s"), ("b", DAY[1], "B", "2", "s")]
    found = vault.load_sat(sat, batch, "hk", "h", ["x"])
    assert sorted(rows(found), key=repr) == sorted(expected, key=repr)
    target = vault.Target(sat, ["hk", "hash_diff"], {"hash_diff": "h"})
    assert sorted(rows(vault.insert_absent(batch, {"sat": target})["sat"]), key=repr) == sorted(expected, key=repr)
    found.collect()
    assert ("Join" not in found._jdf.queryExecution().executedPlan().toString()) == large
