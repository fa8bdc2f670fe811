from kpiloom.session import scratch_path
from kpiloom.streaming import ingest_available


def test_default_checkpoint_belongs_to_the_target(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, schema = scratch_path(spark, "bronze"), "month date, visits double"
    (landing / "a.csv").write_text("month,visits\n2024-01-01,5\n")
    assert ingest_available(spark, str(landing), schema, target) == 1
    (landing / "b.csv").write_text("month,visits\n2024-02-01,7\n2024-03-01,9\n")
    assert ingest_available(spark, str(landing), schema, target, max_files=1) == 2
    assert ingest_available(spark, str(landing), schema, target) == 0
    assert spark.read.parquet(target).count() == 3


def test_incremental_ingest_is_exactly_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "jan.csv").write_text("month,visits\n2024-01-01,5\n")
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "bronze_ckpt")
    assert ingest_available(spark, str(landing), "month date, visits double", target, checkpoint=ckpt) == 1
    # a re-run with nothing new loads nothing; a new file is loaded once
    assert ingest_available(spark, str(landing), "month date, visits double", target, checkpoint=ckpt) == 0
    (landing / "feb.csv").write_text("month,visits\n2024-02-01,7\n2024-03-01,9\n")
    assert ingest_available(spark, str(landing), "month date, visits double", target, checkpoint=ckpt) == 2
    rows = spark.read.parquet(target).collect()
    assert sorted((r.source_file_name, r.visits) for r in rows) == [
        ("feb.csv", 7.0), ("feb.csv", 9.0), ("jan.csv", 5.0)]
    assert all(r.ingestion_timestamp is not None for r in rows)
