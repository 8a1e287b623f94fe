"""The session's settings, without starting one."""

from visitlens.session import DEFAULT_CONF, session_builder


def options(**given):
    return session_builder(**given)._options


def test_hive_support_is_a_setting_of_the_catalog():
    assert options(hive=True)["spark.sql.catalogImplementation"] == "hive"
    assert "spark.sql.catalogImplementation" not in options()


def test_given_settings_win_over_the_defaults():
    key = next(iter(DEFAULT_CONF))
    got = options(master="local[2]", shuffle_partitions=5, extra_conf={key: "given"}, hive=True)
    assert got[key] == "given" and got["spark.master"] == "local[2]" and got["spark.sql.shuffle.partitions"] == "5"
    assert {k: v for k, v in got.items() if k in DEFAULT_CONF and k != key} == {
        k: v for k, v in DEFAULT_CONF.items() if k != key}


def test_a_builder_keeps_nothing_of_another():
    session_builder(hive=True, extra_conf={"spark.x": "1"})
    assert "spark.x" not in options() and "spark.master" not in options()
