"""The six jobs, and all of them in order.

Jobs read and write; operators between them only transform. Every path and table
name is a parameter. ``now`` is the UTC time that names the batch.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batch import batch_key
from ..operators.emails import parse_emails, split_readable
from ..operators.jsonlines import drop_json_key
from ..operators.report import SCORE, review_report, score_emails, score_reviews
from ..sinks.batches import landed_folders, newest_batch, newest_landed, write_batch, write_member_files
from ..sinks.tables import audited, create_table_as, refresh_view, replace_table
from ..sources import archives
from ..sources.objects import entity_name, list_objects, newest_folder, select_paths
from ..sources.tables import SCHEMAS, line_views, read_json_lines

# Names of the original folders and tables.
EMAIL_FOLDER = "emails_feedback_faker"
EMAILS = "tb_emails_feedback"
SCORED_EMAILS = "tb_emails_feedback_analizados"
REVIEWS = "tb_review"
BUSINESSES = "tb_business"
SCORED_REVIEWS = "tb_review_analizados"
REPORT = "view_materializada_review_sentimentos"
EXTERNAL_PREFIX = "ext_tb_"
DROPPED_KEY = "attributes"


def batch_name(spark: SparkSession, now: datetime) -> str:
    """The batch key of a UTC time."""
    stamp = F.to_timestamp_ntz(F.lit(now.strftime("%Y-%m-%d %H:%M:%S"))).cast("timestamp")
    return spark.range(1).select(batch_key(stamp)).first()[0]


# --- land archives ---

def ingest_emails(spark, archive: str, root: str, now: datetime, kind="zip") -> str:
    """Unpack the messages into a batch of the parquet landing at ``root``."""
    batch = batch_name(spark, now)
    write_batch(archives.read_archive(spark, archive, kind), root, batch, also_by=["cut"])
    return batch


def ingest_lines(spark, archive: str, root: str, now: datetime, kind="tar") -> str:
    """Unpack the JSON members, line by line, into a batch of the parquet landing."""
    batch = batch_name(spark, now)
    lines = archives.read_archive_lines(spark, archive, kind, ".json")
    lines = lines.withColumn("entity", entity_name(F.col("member")))
    write_batch(lines, root, batch, also_by=["entity"])
    return batch


def ingest_files(spark, archive: str, root: str, now: datetime, kind: str) -> str:
    """Unpack members as the files they were, below ``<root>/<batch>/``."""
    batch = batch_name(spark, now)
    index = archives.member_index(spark, archive, kind)
    write_member_files(index, kind, root, batch).write.format("noop").mode("overwrite").save()
    return batch


# --- load tables ---

def load_emails(spark, root: str, table: str = EMAILS, landing="parquet", **options) -> DataFrame:
    """Parse the newest batch of messages into ``table``; returns the files left out."""
    if landing == "parquet":
        members = select_paths(newest_batch(spark, root), suffix=".eml", name="member").where(
            F.col("member").startswith(f"{EMAIL_FOLDER}/"))
        messages = archives.whole_members(members).select(F.col("member").alias("name"), "content")
    else:
        batch = newest_folder(spark, root)
        files = list_objects(spark, root, f"{batch}/{EMAIL_FOLDER}/", content=True)
        messages = select_paths(files, EMAIL_FOLDER, ".eml").select("name", "content")
    readable, rejects = split_readable(messages)
    replace_table(parse_emails(readable.drop("name")), table, **options)
    return rejects


def load_reviews(spark, root: str, clean_root: str = None, prefix=EXTERNAL_PREFIX,
                 landing="parquet") -> DataFrame:
    """Register one external table per entity of the newest batch; one status row each.

    The tables are views that parse the landed lines, with every column that the
    lines have, so nothing is copied; lines that are not one JSON object are skipped,
    in either landing alike. Over files, business files lose ``attributes`` first, as
    the original's did; the cleaned copy goes below ``clean_root``, since Spark does
    not overwrite what it reads. Spark reads no file whose name begins with ``_`` or
    ``.``: such members need the parquet landing, and here fail with an error.
    """
    if landing == "parquet":
        folder = f"{root.rstrip('/')}/batch={newest_landed(spark, root)}"
        entities = [r[0] for r in landed_folders(spark, folder).select("entity").distinct().collect()]
        # Over the batch, not one version of it: landing it again shows through.
        sources = {e: f"SELECT value FROM parquet.`{folder}` WHERE entity = '{e}'" for e in entities}
        dropped = {e: (DROPPED_KEY,) for e in entities if "business" in e}
    else:
        sources, dropped = _file_sources(spark, root.rstrip("/"), clean_root), {}
    names = {f"{prefix}{e}": e for e in sorted(sources)}
    return line_views(spark, {name: sources[e] for name, e in names.items()}, names, SCHEMAS, dropped)


def _file_sources(spark, root, clean_root):
    """SQL for the lines of each entity of the newest batch of files; business files cleaned first."""
    try:
        batch = newest_folder(spark, root)
    except ValueError as error:
        raise ValueError(f"{error}, so there is no JSON file to load") from error
    files = select_paths(list_objects(spark, root, f"{batch}/"), suffix=".json")
    hidden = F.max(F.substring_index("name", "/", -1).rlike("^[_.]"))
    # One row per table to be made.
    entities = (files.groupBy(entity_name(F.col("name")).alias("entity"))
                .agg(F.min("path").alias("path"), F.max(F.col("name").contains("business")).alias("business"),
                     F.count(F.lit(1)).alias("files"), hidden.alias("hidden")).collect())
    if not entities:
        raise ValueError("no JSON file in the newest batch")
    if any(r["hidden"] for r in entities):
        raise ValueError("file names that begin with _ or . need the parquet landing")
    sources = {r["entity"]: f"SELECT value FROM text.`{r['path']}`" for r in entities}
    cleaned = [r["entity"] for r in entities if r["business"]]
    merged = [r["entity"] for r in entities if r["files"] > 1 and not r["business"]]
    if cleaned or merged:
        lines = read_json_lines(spark, f"{root}/{batch}").select(
            "value", entity_name(F.col("_metadata.file_name")).alias("entity"))
        clean, _ = drop_json_key(lines.where(F.col("entity").isin(cleaned)), DROPPED_KEY)
        target = f"{clean_root.rstrip('/')}/{batch}"
        (clean.unionByName(lines.where(F.col("entity").isin(merged)))
         .write.mode("overwrite").partitionBy("entity").text(target))
        sources |= {entity: f"SELECT value FROM text.`{target}/entity={entity}`" for entity in cleaned + merged}
    return sources


# --- score and report ---

def score_emails_table(spark, source=EMAILS, target=SCORED_EMAILS, body="body",
                       options=None, **scoring) -> DataFrame:
    """Score and label the messages of a table; returns the load audit."""
    scored = score_emails(spark.table(source), body, **scoring)
    return audited(scored, target, lambda df: replace_table(df, target, **(options or {})))


def score_reviews_table(spark, reviews=REVIEWS, businesses=BUSINESSES, target=SCORED_REVIEWS,
                        prefix=EXTERNAL_PREFIX, buckets=None, root=None, **scoring) -> DataFrame:
    """Copy the external tables, score the reviews; returns the load audit.

    Reviews and scores are bucketed alike by ``review_id``, so neither the
    scoring nor the report shuffles them again. ``root`` names a folder for the
    three tables; without it they go to the warehouse folder.
    """
    def at(name):
        return {"path": f"{root.rstrip('/')}/{name}"} if root else {}

    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    create_table_as(spark.table(f"{prefix}review"), reviews, bucket_by="review_id", buckets=buckets, **at(reviews))
    create_table_as(spark.table(f"{prefix}business"), businesses,
                    ["business_id", "categories", "name"], **at(businesses))
    scored = score_reviews(spark.table(reviews), **scoring).select("review_id", SCORE)
    return audited(scored, target, lambda df: replace_table(
        df, target, bucket_by="review_id", buckets=buckets, clustered=True, **at(target)))


def refresh_report(spark, reviews=REVIEWS, businesses=BUSINESSES, scores=SCORED_REVIEWS,
                   view=REPORT, **options) -> None:
    """Join scores, reviews and businesses into the stored report."""
    report = review_report(spark.table(scores), spark.table(reviews), spark.table(businesses))
    refresh_view(report, view, **options)


def run_all(spark, email_archive: str, review_archive: str, root: str, now: datetime, **scoring) -> DataFrame:
    """Every job in the original order; the first failure stops the rest. Returns the audit rows."""
    root = root.rstrip("/")
    ingest_emails(spark, email_archive, f"{root}/emails", now)
    ingest_lines(spark, review_archive, f"{root}/reviews", now)
    load_emails(spark, f"{root}/emails")
    status = load_reviews(spark, f"{root}/reviews")
    failed = [r["table"] for r in status.where("NOT ok").collect()]
    if failed:
        raise RuntimeError(f"external tables failed: {', '.join(failed)}")
    audit = score_emails_table(spark, **scoring)
    audit = audit.unionByName(score_reviews_table(spark, **scoring))
    refresh_report(spark)
    return audit
