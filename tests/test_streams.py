from skeinwork.streaming import streams


def run(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)


def test_dedup_and_metrics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("Train loss: 1.5\nTrain loss: 1.5\nnothing\n")
    (tmp_path / "in/b.txt").write_text("Train loss: 1.5\nCorrection rate: 12.5% Corrections: 4\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    run(streams.dedup_lines(lines), "lines_once")
    assert spark.table("lines_once").count() == 3
    run(streams.metrics_of_log(lines), "metrics")
    assert sorted(tuple(map(str, r)) for r in spark.table("metrics").collect())[-1] == ("None", "None", "12.5", "4.0")
    assert spark.table("metrics").count() == 4
    query = streams.append_to(streams.metrics_of_log(lines), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_watch_runs(spark, tmp_path):
    log = [("a", i, v) for i, v in enumerate([2.5, 2.2, 2.0, 2.0, 2.01, 2.02])] + [("b", 0, 1.0), ("b", 1, float("inf")), ("c", 0, 1.0)]
    spark.createDataFrame(log, "run string, step long, loss double").coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema("run string, step long, loss double").parquet(str(tmp_path / "log"))
    run(streams.watch_runs(stream), "stops")
    assert sorted(tuple(r) for r in spark.table("stops").collect()) == [("a", 5, "no progress"), ("b", 1, "bad loss")]


def test_store_once_over_restarts_and_time(spark, tmp_path):
    """Exact over restarts and repeated micro-batches; with a time, older lines are forgotten."""
    import time

    def more(name, *lines):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

    def go_on(name, hours=None):
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
        streams.store_once(lines, str(tmp_path / name), str(tmp_path / f"{name}-state"), hours).awaitTermination(120)
        rows = spark.read.schema("value string, batch long").parquet(str(tmp_path / name)).collect()
        return sorted((r["value"], r.batch) for r in rows)

    more("a.txt", "x", "y", "x", "")
    assert go_on("out") == [("", 0), ("x", 0), ("y", 0)]
    more("b.txt", "y", "z", "x", "z")
    assert go_on("out") == [("", 0), ("x", 0), ("y", 0), ("z", 1)]
    # The last micro-batch was written, but its end was not noted: it is run again.
    (tmp_path / "out-state/commits/1").unlink()
    (tmp_path / "out-state/commits/.1.crc").unlink(missing_ok=True)
    more("c.txt", "w", "z")
    assert go_on("out") == [("", 0), ("w", 2), ("x", 0), ("y", 0), ("z", 1)]
    assert go_on("out") == [("", 0), ("w", 2), ("x", 0), ("y", 0), ("z", 1)]
    go_on("short", 2 / 3600)
    time.sleep(3)
    more("d.txt", "x", "v")
    assert [v for v, b in go_on("short", 2 / 3600) if b == 3] == ["v", "x"]
    more("e.txt", "x")
    assert [v for v, b in go_on("short", 1) if b == 4] == []
