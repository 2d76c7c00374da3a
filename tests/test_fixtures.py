"""The views read their tables whole."""

import datetime as dt

import pytest

from ledgerloom.operators import episodes as E
from ledgerloom.plans.fixtures import view


def test_master_has_every_customer(spark, tmp_path):
    """Customers beyond the first hundreds are securities too; symbols grow with them, conflicts are counted."""
    customers = spark.range(2001).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "'x' AS c_mktsegment")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    found = view(spark, str(tmp_path), "v_master").selectExpr("security_id", "symbol", "symbol_identity_conflict AS conflict").collect()
    assert {r["security_id"] for r in found} == {f"S{k}" for k in range(2001)}
    assert len({r["symbol"] for r in found}) == 1001
    assert [r["security_id"] for r in found if not r["conflict"]] == ["S2000"]


def test_name_changes_have_every_order(spark, tmp_path):
    """Orders whose key is no multiple of 20 count, and symbols go beyond 200."""
    spark.range(1, 1501).selectExpr("id AS o_orderkey", "id AS o_custkey", "DATE '1998-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    found = view(spark, str(tmp_path), "v_name_changes").collect()
    assert len(found) == 1500 and len({r["old_symbol"] for r in found}) == 751 and all(r["old_symbol"] != r["new_symbol"] for r in found)


def test_long_walks_are_not_cut(spark):
    """A walk ends where no change is left, after however many jobs."""
    day = dt.date(2000, 1, 1)
    for steps in (12, 40):
        master = spark.createDataFrame([("s1", f"N{steps}", True, None), ("s2", "N3", True, None), ("s3", "none", True, None)], "security_id string, symbol string, active boolean, delisted_date date")
        changes = spark.createDataFrame([(f"e{k:02}", day + dt.timedelta(days=k), f"N{k}", f"N{k + 1}") for k in range(steps)], "event_id string, process_date date, old_symbol string, new_symbol string")
        got = E.chains(master, changes, dt.date(2002, 1, 1)).collect()
        assert sorted((r["step"], r["cursor"], r["old"]) for r in got if r["security_id"] == "s1") == [(k + 1, f"N{steps - k}", f"N{steps - k - 1}") for k in range(steps)]
        assert len([r for r in got if r["security_id"] == "s2"]) == 3 and not [r for r in got if r["security_id"] == "s3"]
