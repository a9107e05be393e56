"""Session defaults are defaults: they never replace what is already set."""

from farelens.plans import catalog
from farelens.session import DEFAULTS, METHOD_LIMIT, build_session


def test_settings_of_a_running_session_survive(spark):
    before = {k: spark.conf.get(k) for k in DEFAULTS}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Dhaka")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        same = build_session(shuffle_partitions=4)
        assert same.conf.get("spark.sql.session.timeZone") == "Asia/Dhaka"
        assert same.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        assert same.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_running_session_gets_the_method_limit_unless_it_has_one(spark, monkeypatch):
    monkeypatch.setattr(catalog, "tpch_frames", lambda spark, sf_dir: sf_dir)
    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.unset(METHOD_LIMIT)
        assert catalog.shared_frames(spark, "somewhere") == "somewhere"
        assert spark.conf.get(METHOD_LIMIT) == DEFAULTS[METHOD_LIMIT]
        spark.conf.set(METHOD_LIMIT, "65535")
        catalog.shared_frames(spark, "somewhere")
        assert spark.conf.get(METHOD_LIMIT) == "65535"
    finally:
        spark.conf.set(METHOD_LIMIT, before)
