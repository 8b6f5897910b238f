from clausemill.plans import session


def test_materialized_tables_can_be_released(spark):
    df = session.materialize(spark.range(5), "tmp")
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert df.count() == 5 and path.startswith(session.shared_dir(spark).removeprefix("file://"))
    assert session.release(spark) >= 1 and session.release(spark) == 0
    assert not __import__("os").path.exists(path)
