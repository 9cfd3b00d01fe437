"""A run that is stored two times."""

from suite import alerts


def test_run_is_found_once(spark, monkeypatch):
    append, read = alerts.append_alerts, []

    def seen(rows, path):
        read.append(sorted(rows.inputFiles()))
        append(rows, path)

    monkeypatch.setattr(alerts, "append_alerts", seen)
    assert alerts.stored_twice(spark, "/root/testdata/sf0.001").count() > 0
    assert len(read) == 2 and read[0] == read[1]
    assert read[0] and not any("events.parquet" in f for f in read[0])
