import io
import json
import tarfile
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinara.operators.report import review_report, review_report_unique, score_reviews
from opinara.plans import jobs
from opinara.sinks.tables import audited, refresh_view, replace_table
from opinara.session import work_folder

NOW = datetime(2024, 5, 1, 15, 30)
REVIEWS = [
    {"review_id": f"r{i}", "business_id": f"b{i % 4}", "user_id": "u", "stars": float(i % 5), "useful": 0, "funny": 0,
     "cool": 0, "text": t, "date": "2024-01-01"}
    for i, t in enumerate(["good food", "bad food", "food", "not good", "GREAT place", "", "slow but nice", "x"])]
BUSINESSES = [{"business_id": f"b{i}", "name": f"name {i}", "categories": "c", "attributes": {"a": {"b": i}}} for i in range(3)]
EMAILS = {f"emails_feedback_faker/{i}.eml": f"From: a{i}\nTo: b\nSubject: s\n\n{t}".encode()
          for i, t in enumerate(["Le service est très bon pour les gens", "the food is bad and it is cold", "hm", ""])}


@pytest.fixture
def sources(tmp_path):
    with zipfile.ZipFile(tmp_path / "emails.zip", "w") as z:
        for name, data in EMAILS.items():
            z.writestr(name, data)
        z.writestr("emails_feedback_faker/broken.eml", b"From: x\n\n\xff")
        z.writestr("emails_feedback_faker/notes.txt", b"From: x\n\nno message")
        z.writestr("other/9.eml", b"From: x\n\nother folder")
    with tarfile.open(tmp_path / "reviews.tar", "w") as t:
        for entity, rows in (("review", REVIEWS), ("business", BUSINESSES), ("tip", [{"text": "t", "n": 1}])):
            data = "\n".join(map(json.dumps, rows)).encode() + b"\n{broken\n"
            info = tarfile.TarInfo(f"set_{entity}.json")
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return tmp_path


def report_rows(spark, name=jobs.REPORT):
    return sorted((r["NOME"], r["REVIEW"], r["SENTIMENTO"]) for r in spark.table(name).collect())


EXPECTED = sorted(
    (f"name {i % 4}", r["text"], label) for i, (r, label) in enumerate(zip(REVIEWS, [
        "POSITIVO", "NEGATIVO", "NEUTRO", "NEGATIVO", "POSITIVO", "NEUTRO", "POSITIVO", "NEUTRO"])) if i % 4 < 3)


def test_every_job_in_order(spark, sources, tmp_path):
    args = (str(sources / "emails.zip"), str(sources / "reviews.tar"), str(tmp_path / "lake"), NOW)
    for _ in range(2):
        audit = {r["table"]: r for r in jobs.run_all(spark, *args).collect()}
        assert audit[jobs.SCORED_EMAILS]["rows"] == 4 and audit[jobs.SCORED_REVIEWS]["rows"] == 8
        assert all(r["ended"] >= r["started"] and r["duration"] is not None for r in audit.values())
        emails = {r["sender"]: r["sentiment"] for r in spark.table(jobs.SCORED_EMAILS).collect()}
        assert emails == {"a0": "Positive", "a1": "Negative", "a2": "Neutral", "a3": "Neutral"}
        assert report_rows(spark) == EXPECTED
    assert spark.table("ext_tb_tip").count() == 1
    assert "attributes" not in spark.table("ext_tb_business").columns


def test_report_of_bucketed_tables_shuffles_no_text(spark, sources, tmp_path):
    jobs.run_all(spark, str(sources / "emails.zip"), str(sources / "reviews.tar"), str(tmp_path / "lake"), NOW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [spark.table(t) for t in (jobs.SCORED_REVIEWS, jobs.REVIEWS)]
        joined = tables[0].join(tables[1], "review_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_over_plain_files(spark, sources, tmp_path):
    jobs.ingest_files(spark, str(sources / "emails.zip"), str(tmp_path / "f"), NOW, "zip")
    rejects = jobs.load_emails(spark, str(tmp_path / "f"), "t_emails", "files", path=str(tmp_path / "t"))
    assert spark.table("t_emails").count() == 4
    assert [r["name"][-10:] for r in rejects.collect()] == ["broken.eml"]
    jobs.ingest_files(spark, str(sources / "reviews.tar"), str(tmp_path / "g"), NOW, "tar")
    status = jobs.load_reviews(spark, str(tmp_path / "g"), str(tmp_path / "clean"), "f_tb_", "files")
    assert status.where("NOT ok").isEmpty() and status.count() == 3
    business = spark.table("f_tb_business")
    assert business.count() == 3 and business.where("name IS NULL").isEmpty()
    sources = {r["table"]: r["path"] for r in status.collect()}
    assert "clean" in sources["f_tb_business"] and "clean" not in sources["f_tb_review"]
    raw = "".join(r[0] for r in spark.sql(sources["f_tb_business"]).collect())
    assert "attributes" not in raw


def test_nothing_landed_is_an_error(spark, tmp_path):
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes/a.eml").write_text("x")
    with pytest.raises(ValueError, match="no batch"):
        jobs.load_emails(spark, str(tmp_path), "t_none", "files")
    with pytest.raises(ValueError, match="no JSON"):
        jobs.load_reviews(spark, str(tmp_path), str(tmp_path / "c"), landing="files")


def test_joins(spark):
    reviews = spark.createDataFrame(
        [("r1", "b1", "good"), ("r1", "b1", "bad"), ("r2", "b9", "good"), (None, "b1", "good"), ("r3", None, "x"),
         ("r4", "b1", None)], "review_id string, business_id string, text string")
    reviews = reviews.withColumns({"date": F.lit("d"), "stars": F.lit(1)})
    shops = spark.createDataFrame([("b1", "n", "c"), (None, "m", "c")], "business_id string, name string, categories string")
    joined = review_report(score_reviews(reviews), reviews, shops)
    found = sorted((r["REVIEW"] or "", r["SENTIMENTO"] or "") for r in joined.collect())
    assert found == [("", ""), ("bad", "NEGATIVO"), ("bad", "POSITIVO"), ("good", "NEGATIVO"), ("good", "POSITIVO")]
    unique = reviews.where("text <> 'bad' OR text IS NULL")
    a = review_report(score_reviews(unique), unique, shops).collect()
    b = review_report_unique(unique, shops).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_refresh_replaces_rows_and_drops_old_versions(spark, tmp_path):
    for n in range(1, 5):
        refresh_view(spark.range(n), "v_report", path=str(tmp_path))
        assert spark.table("v_report").count() == n
    versions = [t.name for t in spark.catalog.listTables(pattern="v_report_v*")]
    assert len(versions) == 2


def test_audit_counts_what_was_written(spark, tmp_path):
    ticks = iter([datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 5)])
    audit = audited(spark.range(7), "t", lambda df: replace_table(df, "t_audit", path=str(tmp_path / "t")),
                    clock=lambda: next(ticks)).first()
    assert audit["rows"] == 7 and audit["duration"].total_seconds() == 5 and spark.table("t_audit").count() == 7


def test_work_folder_follows_the_setting(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_work_folder_is_never_a_temporary_one():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: "s3a://b/warehouse/" if key == "spark.sql.warehouse.dir" else default)

    assert work_folder(Session, "x").startswith("s3a://b/warehouse/work/x-")


def test_views_with_a_shared_prefix_keep_their_versions(spark, tmp_path):
    spark.range(5).write.saveAsTable("rep_v1")
    for n in (1, 2, 3):
        refresh_view(spark.range(n), "rep_vip", path=str(tmp_path / "vip"))
        refresh_view(spark.range(10 * n), "rep", path=str(tmp_path / "rep"))
        refresh_view(spark.range(100 * n), "rep_v2")
    assert [spark.table(t).count() for t in ("rep_vip", "rep", "rep_v2", "rep_v1")] == [3, 30, 300, 5]
    assert len(list((tmp_path / "rep").iterdir())) == 2  # older versions go with their files


@pytest.mark.parametrize("external", [True, False])
def test_a_failing_replace_leaves_the_old_rows(spark, tmp_path, external):
    name = f"t_kept_{external}".lower()
    path = str(tmp_path / "t") if external else None
    replace_table(spark.range(3), name, path=path)
    bad = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        replace_table(bad, name, path=path)
    assert spark.table(name).count() == 3
    replace_table(spark.table(name).union(spark.range(2)), name, path=path)
    assert spark.table(name).count() == 5
    if external:
        assert len(list((tmp_path / "t").iterdir())) == 1


def test_relanding_replaces_the_whole_batch(spark, tmp_path):
    from opinara.sinks.batches import write_batch

    root = str(tmp_path / "l")
    df = spark.createDataFrame([("review", "r"), ("tip", "t")], "entity string, value string")
    for rows in (df, df.where("entity = 'review'")):
        for batch in ("2024-01-01-00-00", "2024-01-02-00-00"):
            write_batch(rows if batch.startswith("2024-01-02") else df, root, batch, also_by=["entity"])
    found = sorted((r["batch"][:10], r["entity"]) for r in spark.read.parquet(root).collect())
    assert found == [("2024-01-01", "review"), ("2024-01-01", "tip"), ("2024-01-02", "review")]
    write_batch(df.limit(0), root, "2024-01-02-00-00", also_by=["entity"])
    assert {r["batch"] for r in spark.read.parquet(root).collect()} == {"2024-01-01-00-00"}


def test_a_landing_that_fails_leaves_the_earlier_rows(spark, tmp_path, monkeypatch):
    from opinara.sinks import batches

    root, batch = str(tmp_path / "l"), "2024-01-01-00-00"
    df = spark.createDataFrame([("review", "r"), ("tip", "t")], "entity string, value string")

    def rows():
        plain = sorted((r["entity"], r["value"]) for r in spark.read.parquet(root).collect())
        assert plain == sorted((r["entity"], r["value"]) for r in batches.newest_batch(spark, root).collect())
        return plain

    batches.write_batch(df, root, batch, also_by=["entity"])
    bad = spark.range(100).select(F.lit("review").alias("entity"), F.when(F.col("id") < 99, "new").otherwise(F.raise_error(F.lit("no"))).alias("value"))
    with pytest.raises(Exception):
        batches.write_batch(bad, root, batch, also_by=["entity"])
    assert rows() == [("review", "r"), ("tip", "t")]
    with monkeypatch.context() as m:  # written whole, but not published
        m.setattr(batches, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batches.write_batch(df, root, batch, also_by=["entity"])
    assert rows() == [("review", "r"), ("tip", "t")]
    with monkeypatch.context() as m:  # published, but the old version could not go
        m.setattr(batches, "_delete", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batches.write_batch(df.where("entity = 'tip'"), root, batch, also_by=["entity"])
    assert [(r["entity"], r["batch"]) for r in batches.newest_batch(spark, root).collect()] == [("tip", batch)]
    batches.write_batch(df, root, batch)  # other inner partitions, and cleans up
    assert rows() == [("review", "r"), ("tip", "t")]
    assert batches.read_batch(spark, root, batch).columns == ["entity", "value", "batch"]


def test_an_empty_newest_landing_is_passed_over(spark, tmp_path):
    from opinara.sinks.batches import landed_batches, newest_batch, read_batch, write_batch

    root, df = str(tmp_path / "l"), spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="no batch folder found"):
        newest_batch(spark, root)
    write_batch(df, root, "2024-01-01-00-00")
    write_batch(df.limit(0), root, "2024-01-02-00-00")
    assert landed_batches(spark, root) == ["2024-01-02-00-00", "2024-01-01-00-00"]
    assert newest_batch(spark, root).first()["batch"] == "2024-01-01-00-00"
    assert read_batch(spark, root, "2024-01-02-00-00").collect() == []
    with pytest.raises(ValueError, match="has not been landed"):
        read_batch(spark, root, "2024-01-03-00-00")


@pytest.mark.parametrize("failing", [1, 2])
def test_a_failing_swap_is_undone(spark, monkeypatch, failing):
    from opinara.sinks import tables

    name, calls, rename = f"t_swap_{failing}", [], tables._rename
    replace_table(spark.range(3), name)

    def some(spark, a, b):
        calls.append((a, b))
        if len(calls) == failing:
            raise RuntimeError("catalog is away")
        rename(spark, a, b)

    with monkeypatch.context() as m:
        m.setattr(tables, "_rename", some)
        with pytest.raises(RuntimeError, match="away"):
            replace_table(spark.range(5), name)
    assert spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    replace_table(spark.range(5), name)
    assert spark.table(name).count() == 5


def test_old_batches_are_not_looked_at(spark, tmp_path):
    """A folder that cannot be listed, or a broken landing, of an older batch does not matter."""
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("emails_feedback_faker/a.eml", b"From: a\n\nx")
    for kind, root in (("files", tmp_path / "f"), ("parquet", tmp_path / "p")):
        if kind == "files":
            jobs.ingest_files(spark, str(tmp_path / "e.zip"), str(root), NOW, "zip")
            old = root / "2001-01-01-00-00/emails_feedback_faker"
        else:
            jobs.ingest_emails(spark, str(tmp_path / "e.zip"), str(root), NOW)
            old = root / "batch=2001-01-01-00-00/version=1/cut=0"
            (root / "_landed/2001-01-01-00-00").mkdir()
            (root / "_landed/2001-01-01-00-00/1").write_text("not to be read")
        old.mkdir(parents=True)
        (old / "broken.parquet").write_text("not to be read")
        (old / "loop").symlink_to(old / "loop")
        jobs.load_emails(spark, str(root), f"t_old_{kind}", kind)
        assert [r["sender"] for r in spark.table(f"t_old_{kind}").collect()] == ["a"]


AWKWARD = ["a.eml", "_b.eml", ".c.eml", "empty.eml", "twice.eml", "twice.eml"]


def test_both_landings_of_messages_agree(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        for i, name in enumerate(AWKWARD):
            z.writestr(f"emails_feedback_faker/{name}", b"" if name == "empty.eml" else b"From: a%d\n\nx" % i)
    jobs.ingest_emails(spark, str(tmp_path / "e.zip"), str(tmp_path / "p"), NOW)
    jobs.load_emails(spark, str(tmp_path / "p"), "t_land_p")
    jobs.ingest_files(spark, str(tmp_path / "e.zip"), str(tmp_path / "f"), NOW, "zip")
    jobs.load_emails(spark, str(tmp_path / "f"), "t_land_f", "files")
    both = [sorted(str(r["sender"]) for r in spark.table(t).collect()) for t in ("t_land_p", "t_land_f")]
    assert both[0] == both[1] and len(both[0]) == 5 and "a5" in both[0] and "a4" not in both[0]


@pytest.mark.parametrize("landing", ["parquet", "files"])
def test_tables_have_all_columns_and_skip_bad_lines(spark, tmp_path, landing):
    lines = {"review": ['{"review_id": "r", "stars": 4, "extra": {"a": [1]}, "more": 2.5}', '{"review_id": "s"} trailing', "{'review_id': 't'}", '{"review_id'],
             "business": ['\t{"business_id": "b", "attributes": {"x": 1}, "open_late": true}'], "checkin": ['{"who": "w", "n": 7}']}
    with tarfile.open(tmp_path / "r.tar", "w") as t:
        for entity, rows in lines.items():
            data = "\n".join(rows).encode()
            info = tarfile.TarInfo(f"set_{entity}.json")
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    if landing == "parquet":
        jobs.ingest_lines(spark, str(tmp_path / "r.tar"), str(tmp_path / "l"), NOW)
    else:
        jobs.ingest_files(spark, str(tmp_path / "r.tar"), str(tmp_path / "l"), NOW, "tar")
    status = jobs.load_reviews(spark, str(tmp_path / "l"), str(tmp_path / "c"), f"all_{landing}_", landing)
    assert status.where("NOT ok").isEmpty()
    review = spark.table(f"all_{landing}_review").select("review_id", "stars", "extra.a", "more", "user_id").collect()
    assert [tuple(r) for r in review] == [("r", 4.0, [1], 2.5, None)]
    business = spark.table(f"all_{landing}_business")
    assert "attributes" not in business.columns and business.select("business_id", "open_late").first() == ("b", True)
    assert spark.table(f"all_{landing}_checkin").select("who", "n").first() == ("w", 7)


def test_the_content_of_a_load_is_told_by_its_rows_alone(spark, tmp_path):
    from opinara.sinks.tables import audited, content_of

    df = spark.createDataFrame([(1, "a", {"k": 1}), (2, None, None), (2, None, None), (3, "", {"j": 2})], "i int, t string, m map<string,int>")
    row = audited(df.repartition(3), "t", lambda rows: rows.write.parquet(str(tmp_path / "t")), content=True).first()
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert row["rows"] == 4 and row["content"] == content_of(stored) == content_of(df.select("m", "t", "i").repartition(5, "i"))
    others = [df.where("i != 3"), df.dropDuplicates(["i"]), df.na.fill("", ["t"]), df.union(df.where("i = 3")), df.withColumnRenamed("t", "u"), df.withColumn("i", F.col("i") + 1)]
    sums = [content_of(o) for o in others]
    assert len({*sums, row["content"]}) == len(others) + 1
    assert content_of(df.limit(0)) == "0:0"
