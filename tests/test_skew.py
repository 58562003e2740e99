"""A third of all rows on one key: results stay whole, and hot joins are split.

Broadcasts are off and the limits for a skewed partition are low, so that the small test data take
the way large data would.
"""

import pytest
from pyspark.sql import functions as F

from tableflow.operators.audit import audit
from tableflow.operators.change import delete_where, update_where
from tableflow.operators.lookups import resolve_keys, unseen, with_count
from tableflow.sources.contracts import Contract, reference

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def large(spark):
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


@pytest.fixture(scope="module")
def facts(large):
    """Key 7 on every third row, else a key of its own; v tells the rows apart."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return large.range(0, ROWS, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def names(large):
    return large.range(0, ROWS, 1, 4).select(F.concat(F.lit("n"), "id").alias("name"),
                                             F.col("id").alias("name_id"))


def test_resolve_keys_splits_the_hot_key(large, facts, names):
    batch = facts.select(F.concat(F.lit("n"), "k").alias("name"), "v")
    found = resolve_keys(batch, names, {"name": "name"}, {"name_id": "k"})
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg(F.count(F.lit(1)), F.count_distinct("v"), F.count_if(F.col("k") == 7)).first() \
        == (ROWS, ROWS, ROWS // 3 + 1)


def test_unseen(large, facts):
    target = facts.where("v % 2 = 0")
    rest = unseen(facts, target, ["k"])
    assert sorted(r.v for r in rest.collect()) == [
        v for v in range(ROWS) if v % 3 and v % 2 and v != 7]


def test_update_and_delete(large, facts):
    chosen = facts.where("k = 7").select("k")
    new, changed = update_where(facts, chosen, ["k"], {"v": -1})
    assert changed.count() == ROWS // 3 + 1
    assert new.where("v = -1").count() == ROWS // 3 + 1 and new.count() == ROWS
    assert delete_where(facts, chosen, ["k"]).count() == ROWS - ROWS // 3 - 1


def test_counts_and_audit(large, facts, names):
    parents = names.select(F.col("name_id").alias("k"))
    counted = with_count(parents, facts, "k", "n")
    assert counted.agg(F.sum("n"), F.max("n"), F.count_if(F.col("n") == 0)).first() == (
        ROWS, ROWS // 3 + 1, ROWS // 3)
    contracts = {"facts": Contract("facts", (), primary_key=("k",),
                                   foreign_keys=(reference("k", "parents"),))}
    found = {r.rule: r.violations for r in
             audit({"facts": facts, "parents": parents.where("k <> 7")}, contracts).collect()}
    assert found == {"not null k": 0, "unique k": 1, "reference k -> parents": ROWS // 3 + 1}
