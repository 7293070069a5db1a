"""Tables that queries store are made and written by tasks of few rows."""

from callstrata.verification import sample, stored


def test_a_stored_day_is_written_by_tasks_of_few_rows(spark, sf_dir, monkeypatch):
    """All rows of a write are of one day, so of one key of its shuffle."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    monkeypatch.setattr(sample, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(stored, "_HOT", {})
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8k")
    try:
        files = stored.stored_hot(spark, sf_dir).table.files()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    whole = sample.hot_events(spark, sf_dir).count()
    assert len({file.partition("ist_day") for file in files}) == 1
    assert sum(file.rows for file in files) == whole
    assert max(file.rows for file in files) < whole / stored.WRITES / 2
