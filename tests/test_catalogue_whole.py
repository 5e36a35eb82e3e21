from skeinwork.catalogue import services

SF = "/root/testdata/sf0.001"


def test_b7_returns_every_event(spark):
    ids = [r.event_id for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()]
    assert len(ids) > 100
    assert [r.id for r in services.b7_sorted(spark, SF).collect()] == sorted(ids, key=str)
