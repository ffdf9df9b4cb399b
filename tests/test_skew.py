"""A third of all lineitems on one order key: the only row-level shuffle
join of the model (postings = lineitem x orders) is split by AQE's skew
handling instead of landing in one task. Thresholds are scaled down to the
test's data size; on a cluster the defaults apply to gigabytes."""

import pytest

from ledgerline.operators import turnover as tov
from ledgerline.sources import fixtures as fx

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def skewed_conf(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_order_key_is_split(spark, workdir, skewed_conf):
    n = 300000
    spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS l_orderkey", "id % 50 AS l_suppkey",
        "CAST(id % 1000 AS DOUBLE) AS l_extendedprice",
        "CAST(date_add(DATE'1998-01-01', CAST(id % 28 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate",
    ).write.parquet(f"{workdir}/lineitem.parquet")
    spark.range(n).selectExpr("id AS o_orderkey", "id % 900 AS o_custkey").write.parquet(
        f"{workdir}/orders.parquet")
    postings = fx.postings(fx.DriverTables(spark, workdir))
    rows = postings.collect()
    assert len(rows) == n
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    # and the turnover over the same postings is exact for the hot customer
    # (order 7 belongs to customer 7, account 21), checked by brute force
    t = tov.daily_turnover(postings)
    hot = t.where("account_rk = 21").selectExpr("sum(credit_amount) AS s").first().s
    order_of = lambda i: 7 if i % 3 == 0 else i
    assert hot == sum(i % 1000 for i in range(n) if order_of(i) % 900 == 7)
