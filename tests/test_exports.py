"""Exports are written and read by many tasks."""

from pyspark.sql import functions as F

import registry
from tidewatch import session
from tidewatch.plans import contracts, exports
from tidewatch.sources import files


def _parts(path):
    return sorted(path.glob("part-*.csv"))


def test_text_exports_are_files_of_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "ROWS_A_FILE", 10)
    ids = spark.range(95).coalesce(1)
    texts = ids.select(F.col("id").alias("review_id"), F.concat(F.lit('line "one"\nline '), "id").alias("review_comment_message"))
    exports.export_tables({"sentiment": texts, "raw_logs": ids}, str(tmp_path))
    folder = tmp_path / exports.TABLE_EXPORTS["sentiment"]
    assert len(_parts(folder)) == 10 and len(_parts(tmp_path / exports.TABLE_EXPORTS["raw_logs"])) == 1
    again = files.read_csv(spark, str(folder), texts.schema, line_breaks=True)
    assert sorted(again.collect()) == sorted(texts.collect())


def test_exports_without_texts_are_split_between_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(20_000).select(*[F.col("id").alias(c) for c in ("risk_level", "is_anomaly", "anomaly_score")])
    exports.export_tables({"clean_logs": rows.coalesce(1)}, str(tmp_path))
    seen = []
    read = files.read_csv
    monkeypatch.setattr(files, "read_csv", lambda *a, **k: seen.append(read(*a, **k)) or seen[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "50000")
        found = contracts.export_report(spark, str(tmp_path)).where("check LIKE 'Row count%' OR check LIKE 'No fully%'").collect()
        assert [(r.status, r.detail) for r in found] == [("PASS", "Got 20,000"), ("PASS", "None")]
        assert seen[0].rdd.getNumPartitions() > 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_round_trip_keeps_its_exports_alone_and_texts_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    sf = "/root/testdata/sf0.001"
    report = registry.queries()["export_roundtrip"](spark, sf).collect()
    (folder,) = tmp_path.iterdir()
    assert folder.name.startswith("exports-") and {p.name for p in folder.iterdir()} == set(
        {**exports.TABLE_EXPORTS, **exports.MART_EXPORTS}.values()
    )
    assert {r.status for r in report if r.check == "File exists"} == {"PASS"}
    for name, table in (("sentiment", registry.sentiment_table), ("category_sentiment", registry.categories_table)):
        path = folder / exports.TABLE_EXPORTS[name]
        assert not _parts(path) and list(path.glob("part-*.csv.gz"))
        want = table(spark, sf)
        again = files.read_csv(spark, str(path), want.schema, line_breaks=True)
        assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()


def test_scratch_deletes_what_is_staged_within(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    with session.scratch(spark):
        gone = session.stage(spark.range(3), "gone")
        session.discard(gone)
        alone = session.stage_alone(spark, lambda: session.stage(spark.range(3), "on-the-way"), "alone")
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["alone"] and alone.count() == 3
    assert not list(tmp_path.iterdir())
    kept = session.stage_alone(spark, lambda: session.stage(spark.range(3), "on-the-way"), "kept")
    assert kept.count() == 3 and len(list(tmp_path.iterdir())) == 1
