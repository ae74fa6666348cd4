"""How the checks read and build their inputs: once, over many tasks, in bounded archives."""

from pyspark.sql import functions as F

from conftest import SF
from opinara.checks import queries as checks


def test_a_view_refreshed_again_scores_nothing_again(spark, monkeypatch):
    read, refresh = [], checks.refresh_view

    def refreshed(df, *args, **options):
        read.extend(df.inputFiles())
        refresh(df, *args, **options)

    monkeypatch.setattr(checks, "refresh_view", refreshed)
    assert checks.refreshed_view(spark, SF).count() == 200
    assert read and not any("documents.parquet" in file for file in read)


def test_the_rows_dealt_anew_go_to_many_tasks(spark, monkeypatch):
    frames, audit = {}, checks.audited

    def audited(df, name, *args, **options):
        frames[name] = df
        return audit(df, name, *args, **options)

    monkeypatch.setattr(checks, "audited", audited)
    checks.load_audit_content(spark, SF)
    monkeypatch.undo()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = (frames["dealt_anew"].select("lang", F.spark_partition_id().alias("task")).groupBy("lang")
                 .agg(F.countDistinct("task").alias("tasks"), F.count("*").alias("n")).where("n >= 20").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks and all(r["tasks"] > 1 for r in tasks)


def test_more_pages_make_more_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks, "ARCHIVE_PAGES", 5)
    spark.range(40).selectExpr("id AS page_id", "'<p>' AS html").write.parquet(str(tmp_path / "pages.parquet"))
    folder = checks.page_archives("tar")(spark, str(tmp_path))
    assert spark.read.format("binaryFile").load(folder).count() == 8
