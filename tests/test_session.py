from __future__ import annotations

from tillstar import session


def test_partitions_follow_the_input():
    def partitions(size, cores):
        return int(session.settings_for(size, cores)["spark.sql.shuffle.partitions"])

    assert partitions(0, 8) == 8
    assert partitions(10 * 1024**3, 8) == 54
    assert partitions(100 * 1024**4, 8000) == 546134
    assert partitions(1024**4, 4000) == 5462


def test_settings_return_after_a_tuned_block(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.tuned(spark, 10 * 1024**3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "54"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_settings_can_be_set_on_a_running_session(spark):
    names = session.settings_for(0, 1)
    before = {n: spark.conf.get(n) for n in names}
    try:
        session.tune(spark, 0)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
