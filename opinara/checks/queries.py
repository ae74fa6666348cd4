"""Every operator run over the whole of a test table."""

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.batch import batch_key
from ..functions.labels import email_label, review_label
from ..functions.text import lower_letters
from ..functions.vocabulary import Vocabulary
from ..operators import report as R
from ..operators.emails import message_parts, parse_emails, split_readable
from ..operators.jsonlines import drop_json_key
from ..operators.text import (detect_language, glossary_from_table, score_sentiment, score_with,
                              translate, translate_with)
from ..functions.words import GLOSSARY
from ..plans import jobs
from ..session import work_folder
from ..sinks.batches import newest_batch, read_batch, write_batch, write_member_files
from ..sinks.tables import audited, content_of, create_table_as, refresh_view, replace_table, save_external
from ..sources import archives
from ..sources.members import read_members
from ..sources.objects import batches, entity_name, latest_batch, list_objects, select_paths
from ..sources.tables import external_table, read_table
from .archives import write_archives, write_line_archives
from .vocabulary import CHECK_LEXICON, EDITS

NOW = datetime(2024, 1, 2, 13, 0)
BATCH = "2024-01-02-10-00"


def staged(prepare, run):
    """A query in two steps, so that the making of its input can be told from its work."""
    def query(spark, sf_dir):
        return run(spark, prepare(spark, sf_dir))

    query.prepare, query.run = prepare, run
    return query


def read(spark, sf_dir, table, *columns):
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def lexicon():
    return Vocabulary.of(CHECK_LEXICON)


def four_places(df, column=R.SCORE):
    return df.withColumn(column, F.round(F.col(column).cast("double"), 4))


def documents(spark, sf_dir, *columns):
    return read(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


# --- scores ---

def score(edits=(), vocabulary=None, **options):
    def query(spark, sf_dir):
        df = documents(spark, sf_dir)
        text = F.col("text")
        for old, new in edits:
            text = F.replace(text, F.lit(old), F.lit(new))
        words = vocabulary(spark, sf_dir) if vocabulary else lexicon()
        scored = score_sentiment(df.withColumn("text", text), lexicon=words, **options)
        return four_places(scored).drop("text")
    return query


def corpus_lexicon(**bounds):
    """Valences by rule for the words of the benchmark texts."""
    def build(spark, sf_dir):
        words = read(spark, sf_dir, "benchmark").select(F.explode(lower_letters(F.col("text"))).alias("word"))
        valence = ((F.length("word") * 7 + F.ascii("word")) % 17 - 8) / F.lit(4.0)
        table = words.distinct().withColumn("valence", valence)
        return Vocabulary.from_table(table, "word", "valence", **bounds)
    return build


def score_with_function(spark, sf_dir):
    def scorer(texts):
        return texts.str.len() / (texts.str.len() + 1000)
    return four_places(score_with(documents(spark, sf_dir), scorer)).drop("text")


# --- reviews ---

def reviews(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("stars"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 366).cast("int"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.substring("source", 4, 9).cast("int").alias("business_id"),
        "text", day.cast("string").alias("date"), "stars")


def businesses(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("business_id"), F.col("n_name").alias("name"),
        F.col("r_name").alias("categories"))


def score_reviews(spark, sf_dir):
    scored = R.score_reviews(reviews(spark, sf_dir), lexicon=lexicon())
    return four_places(scored.select("review_id", R.SCORE))


def review_report(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    scores = R.score_reviews(rows, lexicon=lexicon())
    return four_places(R.review_report(scores, rows, businesses(spark, sf_dir)), "SENTIMENT_SCORE")


def review_report_unique(spark, sf_dir):
    report = R.review_report_unique(reviews(spark, sf_dir), businesses(spark, sf_dir), lexicon=lexicon())
    return four_places(report, "SENTIMENT_SCORE")


def refreshed_view(spark, sf_dir):
    """Two views whose names begin alike, refreshed in turn; both have to keep their rows."""
    folder = work_folder(spark, "view")
    rows = materialised(review_report_unique(spark, sf_dir))  # six refreshes, one scoring
    for part in (rows.limit(1), rows, rows):
        refresh_view(rows, "check_report_more", path=folder)
        refresh_view(part, "check_report", path=folder)
    return spark.table("check_report").unionByName(spark.table("check_report_more")).distinct()


def report_view(spark, sf_dir):
    folder = work_folder(spark, "report")
    scored = R.score_reviews(reviews(spark, sf_dir), lexicon=lexicon()).select("review_id", R.SCORE)
    for name, df in (("scores", scored), ("reviews", reviews(spark, sf_dir)), ("businesses", businesses(spark, sf_dir))):
        replace_table(df, f"check_view_{name}", path=f"{folder}/{name}")
    R.report_view(spark, "check_view", "check_view_scores", "check_view_reviews", "check_view_businesses")
    return four_places(spark.table("check_view"), "SENTIMENT_SCORE")


# --- emails and languages ---

def emails_report(spark, sf_dir):
    scored = R.score_emails(documents(spark, sf_dir), "text", lexicon=lexicon())
    return four_places(scored).drop("text")


def detect(spark, sf_dir):
    return detect_language(documents(spark, sf_dir)).drop("text")


def detect_page(spark, sf_dir):
    body = F.regexp_replace("html", "<[^>]*>", " ").alias("body")
    return detect_language(read(spark, sf_dir, "pages", "page_id", body), "body").drop("body")


def translated(spark, sf_dir):
    return translate(documents(spark, sf_dir)).drop("text")


def translated_from_table(**bounds):
    def query(spark, sf_dir):
        return translate(documents(spark, sf_dir), glossary=listed_glossary(spark, **bounds)).drop("text")
    return query


def listed_glossary(spark, **bounds):
    rows = [(lang, word, english) for lang, listed in GLOSSARY.items() for word, english in listed.items()]
    table = spark.createDataFrame(rows, "lang string, word string, english string")
    return glossary_from_table(table, **bounds)


def translated_with_function(spark, sf_dir):
    def translator(texts, langs):
        return langs + ": " + texts
    return translate_with(documents(spark, sf_dir), translator).drop("text")


def translated_in_part(spark, sf_dir):
    """A translator that fails on every text with a given letter pair: only those stay."""
    def translator(texts, langs):
        if texts.str.contains("ez", regex=False).any():
            raise RuntimeError("no translation")
        return langs + ": " + texts
    return translate_with(documents(spark, sf_dir), translator, ok="ok").drop("text")


def label_nulls(spark, sf_dir):
    n = F.col("event_id") % 10
    value = F.when(n == 0, None).when(n == 1, 0).otherwise(F.col("value") - 10)
    return read(spark, sf_dir, "events").select(
        "event_id", email_label(value).alias("email_label"), review_label(value).alias("review_label"))


# --- messages ---

def messages(spark, sf_dir):
    """Conversations as raw mail: folded, absent, empty and repeated headers, three line ends."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    minute = F.lpad((F.col("turn") % 60).cast("string"), 2, "0")
    end = F.element_at(F.array(F.lit("\n"), F.lit("\r\n")), (F.col("turn") % 2 + 1).cast("int"))

    def line(*parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts), end)

    head = F.concat(
        line("from: ", F.col("role"), "@example.com"),
        line("X-Note: Subject: not this one"),
        line("TO:\tdesk-", (F.col("conv_id") % 7).cast("string"), "@example.com"),
        F.when(F.col("turn") % 4 == 3, line("Subject:")).otherwise(
            line("Subject: Conversation ", conv, "\n turn ", turn)),
        line("Subject: repeated"),
        F.when(F.col("turn") % 3 != 0, line("Date: Mon, 1 Jan 2024 10:", minute, ":00 -0300")).otherwise(""),
        F.when(F.col("conv_id") % 5 == 4, line("Content-Type: multipart/mixed; boundary=x")).otherwise(""))
    return read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(head, end, F.col("text")).alias("message"))


def parsed(original_names=False):
    def query(spark, sf_dir):
        return parse_emails(messages(spark, sf_dir), original_names=original_names)
    return query


def email_parts(spark, sf_dir):
    """One row per part of every conversation as nested mail; a fifth of the mails has no parts."""
    text, turn = F.col("text"), F.col("turn").cast("string")
    nested = F.concat(
        F.lit("Subject: nested\nContent-Type: multipart/mixed; boundary=outer-edge\n\nnot shown\n--outer-edge\n\n"), text,
        F.lit("\n--outer-edge\nContent-Type: multipart/alternative; boundary=\"inner edge\"\n\n--inner edge\nContent-Type: text/html\n\n<p>"), text,
        F.lit("</p>\n--inner edge\nContent-Disposition: attachment; filename="), turn, F.lit(".txt\n\n"), F.col("role"),
        F.lit("\n--inner edge--\n\n--outer-edge--\n"))
    message = F.when(F.col("conv_id") % 5 == 3, F.concat(F.lit("Subject: plain\n\n"), text)).otherwise(nested)
    parts = message_parts(read(spark, sf_dir, "conversations").select("conv_id", "turn", message.alias("message")))
    part = parts.select("conv_id", "turn", F.explode("parts").alias("part")).select("conv_id", "turn", "part.*")
    return part.select("conv_id", "turn", "path", "content_type", "filename", F.md5("body").alias("digest"))


def email_rejects(spark, sf_dir):
    bad = F.when(F.col("conv_id") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.lit(b""))
    raw = messages(spark, sf_dir).select(
        "conv_id", "turn", F.concat(F.encode("message", "UTF-8"), bad).alias("content"))
    return split_readable(raw)[1]


def message_members(spark, sf_dir):
    name = F.concat(F.lit("emails_feedback_faker/"), F.col("conv_id").cast("string"), F.lit("-"),
                    F.col("turn").cast("string"), F.lit(".eml"))
    return messages(spark, sf_dir).select(
        name.alias("member"), F.encode("message", "UTF-8").alias("content")).repartition(4)


# --- JSON lines ---

LONG = "123456789012345678901234567890123456789012345"


def event_lines(spark, sf_dir):
    line = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"),
        F.lit(', "attributes": {"a": [1, {"b": null}], "attributes": "x"}, "keep": 1, "props": '), F.col("props"),
        F.lit(', "event_type": "'), F.col("event_type"),
        F.lit('", "keep": 2, "value": '), F.col("value").cast("string"), F.lit("}"))
    n = F.col("event_id") % 20
    # Malformed, trailing text, a second object, single quotes, and fine ones with a tab in front,
    # a repeated key inside and a long number.
    told = (F.when(F.col("event_id") % 10 == 0, F.substr(line, F.lit(1), F.length(line) - 1))
            .when(n == 1, F.concat(line, F.lit(" trailing")))
            .when(n == 2, F.concat(line, line))
            .when(n == 3, F.replace(line, F.lit('"'), F.lit("'")))
            .when(n == 4, F.concat(line, F.lit("]")))
            .when(n == 5, F.concat(F.lit("\t"), line))
            .when(n == 6, F.replace(line, F.lit('"keep": 1'), F.lit('"twice": {"x": 1, "x": 2}, "long": ' + LONG)))
            .otherwise(line))
    return read(spark, sf_dir, "events").select("event_id", told.alias("value"))


def json_key_dropped(spark, sf_dir):
    clean, _ = drop_json_key(event_lines(spark, sf_dir).select("value"), "attributes")
    shape = "event_id bigint, props struct<k: bigint>, event_type string, value double, keep bigint"
    has = F.get_json_object("value", "$.attributes").isNotNull()
    o = F.from_json("value", shape)
    return clean.select(o.alias("o"), has.alias("has_attributes"), F.get_json_object("value", "$.twice.x").alias("twice"),
                        F.regexp_extract("value", '"long":([0-9]+)', 1).alias("long")).select(
        "o.event_id", "o.props.k", "o.event_type", "o.value", "o.keep", "has_attributes", "twice", "long")


def json_rejects(spark, sf_dir):
    return drop_json_key(event_lines(spark, sf_dir), "attributes")[1].select("event_id")


# --- batches and paths ---

def events(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", batch_key(F.col("ts")).alias("key"))


def event_objects(spark, sf_dir):
    folder = (F.when(F.col("event_id") % 5 == 0, F.lit("zz-notes/"))
              .when(F.col("event_id") % 5 == 1, F.lit(""))
              .otherwise(F.concat("key", F.lit("/"))))
    name = F.concat(folder, F.lit("f"), F.col("event_id").cast("string"), F.lit(".json"))
    return events(spark, sf_dir).select("event_id", name.alias("name"))


def page_objects(spark, sf_dir):
    n = F.col("page_id")
    folder = (F.when(n % 4 == 0, "emails_feedback_faker/").when(n % 4 == 1, "emails_feedback_faker_old/")
              .when(n % 4 == 2, "").otherwise("x/y/"))
    entity = F.when(n % 2 == 0, "business").otherwise("review")
    end = F.when(n % 5 == 0, ".EML").when(n % 5 == 1, ".json").otherwise(".eml")
    name = F.concat(F.lit("2024-01-0"), (n % 3 + 1).cast("string"), F.lit("-10-00/"), folder, F.lit("set_"), entity, end)
    return read(spark, sf_dir, "pages", "page_id").withColumn("name", name)


def listed(spark, sf_dir):
    folder = work_folder(spark, "objects")
    page_files(spark, sf_dir, folder)
    return list_objects(spark, folder, "b/").select("name", "length")


def page_files(spark, sf_dir, folder):
    """Write every page as a file of its own, in two folders."""
    side = F.when(F.col("page_id") % 2 == 0, "a/").otherwise("b/")
    members = page_members(spark, sf_dir, side)
    write_archives(members, f"{folder}-archives", "tar")
    index = archives.member_index(spark, f"{folder}-archives", "tar")
    root, _, batch = folder.rpartition("/")
    write_member_files(index, "tar", root, batch).write.format("noop").mode("overwrite").save()


# --- tables ---

def created(spark, sf_dir):
    create_table_as(documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars"),
                    "check_copy", path=work_folder(spark, "copy"))
    return spark.table("check_copy")


def created_columns(spark, sf_dir):
    wide = businesses(spark, sf_dir).withColumn("unused", F.lit(1))
    create_table_as(wide, "check_business", ["business_id", "categories", "name"],
                    path=work_folder(spark, "business"))
    return spark.table("check_business")


def replaced(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "n_chars")
    path = work_folder(spark, "replaced")
    replace_table(docs, "check_replaced", path=path)
    replace_table(docs.withColumn("n_chars", F.col("n_chars") + 1), "check_replaced", path=path,
                  bucket_by="doc_id", buckets=8)
    return spark.table("check_replaced")


def external(spark, sf_dir):
    path = work_folder(spark, "json")
    columns = ["doc_id", "lang", "n_chars", "text"]
    read(spark, sf_dir, "documents", *columns).write.json(path)
    return external_table(spark, "check_external", path).select(*columns)


def saved_external(spark, sf_dir):
    path = work_folder(spark, "orc")
    df = read(spark, sf_dir, "conversations")
    for _ in range(2):
        save_external(df, "orc", path=path)
    return read_table(spark, path, "orc")


# --- archives ---

ARCHIVE_PAGES = 2000


def archive_count(spark, sf_dir):
    """As many archives as the pages need, so that none, and no directory of one, grows with the table."""
    return max(4, -(-read(spark, sf_dir, "pages").count() // ARCHIVE_PAGES))


def page_members(spark, sf_dir, folder=None):
    folder = F.lit("html/") if folder is None else folder
    name = F.concat(folder, F.col("page_id").cast("string"), F.lit(".html"))
    return read(spark, sf_dir, "pages").select(
        name.alias("member"), F.encode("html", "UTF-8").alias("content"), "page_id").repartition(archive_count(spark, sf_dir))


def page_archives(kind):
    def prepare(spark, sf_dir):
        folder = work_folder(spark, "archives")
        write_archives(page_members(spark, sf_dir), folder, kind)
        return folder
    return prepare


def members(kind, piece_bytes=4096):
    def run(spark, folder):
        pieces = archives.read_archive(spark, folder, kind.split(".")[0], piece_bytes)
        landing = work_folder(spark, "landing")
        write_batch(pieces, landing, BATCH, also_by=["cut"])
        whole = archives.whole_members(newest_batch(spark, landing))
        return whole.select("member", "size", F.md5("content").alias("digest"))
    return staged(page_archives(kind), run)


def marked_archives(spark, sf_dir):
    """Every page in a zip and in a tar, between members of other names."""
    folder, pages = work_folder(spark, "archives"), page_members(spark, sf_dir)
    both = pages.unionByName(page_members(spark, sf_dir, F.lit("notes/"))).repartitionByRange(
        archive_count(spark, sf_dir), "page_id")
    for kind in ("zip", "tar"):
        write_archives(both, f"{folder}/{kind}", kind)
    return folder


def members_by_name(spark, folder):
    """The pages by the archive format, small pieces over many tasks; no task is planned for the other members."""
    def of(kind):
        rows = read_members(spark, f"{folder}/{kind}", kind, prefix="html/", suffix=".html", pieceBytes=1024, taskBytes=65536)
        pieces = F.sort_array(F.collect_list(F.struct("piece", "content")))
        content = F.aggregate(pieces, F.lit(b""), lambda whole, part: F.concat(whole, part["content"]))
        return (rows.groupBy("archive", "member", "size").agg(F.md5(content).alias("digest"))
                .select(F.lit(kind).alias("kind"), "member", "size", "digest"))
    return of("zip").unionByName(of("tar"))


def lines(kind):
    def run(spark, folder):
        rows = archives.read_archive_lines(spark, folder, kind, ".html", 1000)
        page = F.regexp_extract("member", "([0-9]+)", 1).cast("bigint").alias("page_id")
        return rows.groupBy(page).agg(
            F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters"))
    return staged(page_archives(kind), run)


def batch_written(spark, sf_dir):
    folder = work_folder(spark, "landing")
    pages = read(spark, sf_dir, "pages").select("page_id", F.md5("html").alias("digest"))
    for batch, rows in (("2024-01-01-10-00", pages), (BATCH, pages), (BATCH, pages.withColumn("digest", F.md5("digest")))):
        write_batch(rows, folder, batch)
    return newest_batch(spark, folder)


def batch_relanded(spark, sf_dir):
    """A batch of two entities landed again, first by a landing that fails half-way, which changes nothing, then with one entity: nothing of the other may stay."""
    folder = work_folder(spark, "landing")
    pages = read(spark, sf_dir, "pages").select("page_id", F.md5("html").alias("digest"))
    first = pages.withColumn("entity", F.when(F.col("page_id") % 2 == 0, "review").otherwise("tip"))
    write_batch(first, folder, BATCH, also_by=["entity"])
    broken = F.when(F.col("page_id") % 50 == 7, F.raise_error(F.lit("half-way"))).otherwise("new")
    try:
        write_batch(pages.withColumn("entity", broken), folder, BATCH, also_by=["entity"])
    except Exception as error:
        if "half-way" not in str(error):
            raise
    held = materialised(read_batch(spark, folder, BATCH).withColumn("landing", F.lit("after a failure")))
    write_batch(pages.withColumn("entity", F.lit("review")), folder, BATCH, also_by=["entity"])
    return held.unionByName(read_batch(spark, folder, BATCH).withColumn("landing", F.lit("again")))


def materialised(df):
    folder = work_folder(df.sparkSession, "rows")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def awkward_archives(spark, sf_dir):
    """Pages as messages: some empty, some with names that Spark's readers skip, some written twice."""
    page = F.col("page_id")
    start = F.when(page % 5 == 0, "_").when(page % 5 == 1, ".").otherwise("")
    name = F.concat(F.lit("emails_feedback_faker/"), start, page.cast("string"), F.lit(".eml"))
    body = F.when(page % 7 == 0, F.lit("")).otherwise(F.col("html"))
    copies = F.when(page % 3 == 0, F.array(F.lit("old version"), body)).otherwise(F.array(body))
    rows = read(spark, sf_dir, "pages").select(name.alias("member"), (page % 3 + 1).alias("place"), (page % 2 == 0).alias("early"), F.posexplode(copies).alias("n", "text"))
    rows = rows.withColumn("early", F.col("early") & (F.col("text") == "old version"))
    folder = work_folder(spark, "awkward")
    # The versions of a name lie in one archive, the newer one behind the older, or the older one in an earlier archive.
    rows = rows.withColumn("place", F.when(F.col("early"), 0).otherwise(F.col("place")))
    rows = rows.select("member", "n", "place", F.encode("text", "UTF-8").alias("content"))
    write_archives(rows.repartitionByRange(4, "place").sortWithinPartitions("place", "n"), folder, "zip")
    return folder


def landed_members(spark, folder):
    """The members of both landings, which have to be the same."""
    landing = work_folder(spark, "landing")
    write_batch(archives.read_archive(spark, folder, "zip", 4096), landing, BATCH, also_by=["cut"])
    whole = archives.whole_members(newest_batch(spark, landing)).select("member", "size", "content", F.lit("parquet").alias("landing"))
    files = work_folder(spark, "files")
    jobs.ingest_files(spark, folder, files, NOW, "zip")
    listed = list_objects(spark, files, f"{BATCH}/", content=True)
    member = F.substr("name", F.lit(len(BATCH) + 2)).alias("member")
    found = whole.unionByName(listed.select(member, F.col("length").alias("size"), "content", F.lit("files").alias("landing")))
    return found.select("landing", "member", "size", F.md5("content").alias("digest"))


def written_files(spark, folder):
    files = work_folder(spark, "files")
    jobs.ingest_files(spark, folder, files, NOW, "zip")
    found = list_objects(spark, files, f"{BATCH}/", content=True)
    member = F.substr("name", F.lit(len(BATCH) + 2))
    return found.select(member.alias("member"), "length", F.md5("content").alias("digest")).withColumnRenamed("length", "size")


def load_audit(spark, sf_dir):
    path = work_folder(spark, "audit")
    audit = audited(read(spark, sf_dir, "documents"), "documents_copy",
                    lambda df: df.write.mode("overwrite").parquet(path))
    return audit.select("table", "rows")


def load_audit_content(spark, sf_dir):
    """Loads of the documents, of the same rows dealt anew, and of one changed row: which of them hold the same."""
    docs = read(spark, sf_dir, "documents")
    other = docs.withColumn("lang", F.when(F.col("doc_id") == 7, F.lit(None)).otherwise(F.col("lang")))
    loads = {"documents_copy": docs, "dealt_anew": docs.repartition("doc_id", "lang").select(*docs.columns[::-1]), "changed": other, "doubled": docs.union(docs.where("doc_id = 7"))}
    audits = []
    for name, df in loads.items():
        path = work_folder(spark, "audit")
        audits.append(audited(df, name, lambda rows, path=path: rows.write.parquet(path), content=True))
        stored = spark.read.parquet(path)
        audits[-1] = audits[-1].withColumn("as_stored", F.col("content") == content_of(stored))
    first = audits[0].first()["content"]
    rows = audits[0].unionByName(audits[1]).unionByName(audits[2]).unionByName(audits[3])
    return rows.select("table", "rows", "as_stored", (F.col("content") == first).alias("same"))


def previewed(spark, sf_dir):
    return R.preview(read(spark, sf_dir, "documents", "doc_id", "lang", "n_chars"), "doc_id")


# --- whole jobs ---

def email_archives(spark, sf_dir):
    folder = work_folder(spark, "emails")
    write_archives(message_members(spark, sf_dir), f"{folder}/archives", "zip")
    return folder


def job_emails(spark, folder):
    folder, archived = work_folder(spark, "emails"), f"{folder}/archives"
    jobs.ingest_emails(spark, archived, f"{folder}/landing", NOW)
    jobs.load_emails(spark, f"{folder}/landing", "check_emails", path=f"{folder}/table")
    jobs.score_emails_table(spark, "check_emails", "check_scored_emails",
                            options={"path": f"{folder}/scored"}, lexicon=lexicon())
    scored = spark.table("check_scored_emails")
    return four_places(scored.select("sender", "subject", R.SCORE, "sentiment"))


def job_emails_files(spark, folder):
    folder, archived = work_folder(spark, "emails"), f"{folder}/archives"
    jobs.ingest_files(spark, archived, f"{folder}/landing", NOW, "zip")
    jobs.load_emails(spark, f"{folder}/landing", "check_emails_files", "files", path=f"{folder}/table")
    return spark.table("check_emails_files")


def review_archives(spark, sf_dir):
    """Reviews, businesses and a third entity as lines of JSON in tar archives."""
    def lines(df, entity):
        value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        return df.select(F.lit(entity).alias("entity"), value.alias("value"))

    folder = work_folder(spark, "reviews")
    rows = reviews(spark, sf_dir).select(
        F.col("review_id").cast("string"), F.col("business_id").cast("string"), "stars",
        "text", "date", F.lit("u").alias("user_id"), F.lit(0).alias("useful"),
        F.struct((F.col("review_id") % 9).alias("rank")).alias("extra"))
    shops = businesses(spark, sf_dir).select(
        F.col("business_id").cast("string"), "name", "categories",
        F.struct(F.lit(True).alias("parking")).alias("attributes"))
    tips = read(spark, sf_dir, "nation", F.col("n_name").alias("tip"), F.col("n_nationkey").alias("likes"))
    write_line_archives(lines(rows, "review").unionByName(lines(shops, "business")).unionByName(lines(tips, "tip")),
                        f"{folder}/archives", "tar")
    return folder


def load_review_tables(spark, archived, landing, name):
    folder = work_folder(spark, "reviews")
    if landing == "parquet":
        jobs.ingest_lines(spark, f"{archived}/archives", f"{folder}/landing", NOW)
    else:
        jobs.ingest_files(spark, f"{archived}/archives", f"{folder}/landing", NOW, "tar")
    status = jobs.load_reviews(spark, f"{folder}/landing", f"{folder}/clean", name, landing)
    failed = status.where("NOT ok").collect()
    if failed:
        raise RuntimeError(str(failed))
    return folder


def job_reviews_from(landing):
    def run(spark, archived):
        name = f"check_{landing}_"
        folder = load_review_tables(spark, archived, landing, name)
        tables = {"reviews": f"{name}reviews", "businesses": f"{name}businesses"}
        jobs.score_reviews_table(spark, target=f"{name}scores", prefix=name, root=folder,
                                 lexicon=lexicon(), **tables)
        jobs.refresh_report(spark, scores=f"{name}scores", view=f"{name}report", path=folder, **tables)
        report = spark.table(f"{name}report").withColumn("ESTRELAS", F.col("ESTRELAS").cast("int"))
        return four_places(report, "SENTIMENT_SCORE")
    return staged(review_archives, run)


def all_columns(spark, archived):
    """Fields that no schema names, in both landings: of reviews, and of an entity without a schema."""
    rows = []
    for landing in ("parquet", "files"):
        name = f"check_all_{landing}_"
        load_review_tables(spark, archived, landing, name)
        create_table_as(spark.table(f"{name}review"), f"{name}copy", path=work_folder(spark, "copy"))
        rows.append(spark.table(f"{name}copy").select(F.lit(landing).alias("landing"), F.col("review_id").alias("name"), F.col("extra.rank").alias("number")))
        rows.append(spark.table(f"{name}tip").select(F.lit(landing).alias("landing"), F.col("tip").alias("name"), F.col("likes").alias("number")))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def registry():
    scores = {f"score_{name}": score(edits) for name, edits in EDITS.items()}
    return {
        "review_report": review_report,
        **scores,
        "review_report_unique": review_report_unique,
        "score_each": score(context="each"),
        "score_corpus_lexicon": score(vocabulary=corpus_lexicon()),
        "score_cut_lexicon": score(vocabulary=corpus_lexicon(max_entries=10)),
        "score_joined_lexicon": score(vocabulary=corpus_lexicon(max_entries=10, cut_entries=10)),
        "score_reviews": score_reviews,
        "score_with_function": score_with_function,
        "emails_report": emails_report,
        "detect_language": detect,
        "detect_page": detect_page,
        "translate": translated,
        "translate_cut_glossary": translated_from_table(max_entries=10),
        "translate_joined_glossary": translated_from_table(max_entries=10, cut_entries=10),
        "translate_with_function": translated_with_function,
        "translate_in_part": translated_in_part,
        "label_nulls": label_nulls,
        "parse_emails": parsed(),
        "parse_emails_original_names": parsed(True),
        "email_parts": email_parts,
        "email_rejects": email_rejects,
        "drop_json_key": json_key_dropped,
        "json_rejects": json_rejects,
        "batch_key": lambda spark, sf_dir: events(spark, sf_dir).withColumnRenamed("key", "batch"),
        "batches": lambda spark, sf_dir: batches(event_objects(spark, sf_dir)),
        "latest_batch": lambda spark, sf_dir: latest_batch(event_objects(spark, sf_dir)).select("event_id", "batch"),
        "select_paths": lambda spark, sf_dir: select_paths(
            page_objects(spark, sf_dir), "emails_feedback_faker", ".eml"),
        "select_entity": lambda spark, sf_dir: select_paths(page_objects(spark, sf_dir), containing="business"),
        "entity_name": lambda spark, sf_dir: page_objects(spark, sf_dir).select(
            "page_id", entity_name(F.col("name")).alias("entity")),
        "list_objects": listed,
        "create_table_as": created,
        "create_table_as_columns": created_columns,
        "replace_table": replaced,
        "external_table": external,
        "save_external": saved_external,
        "refresh_view": refreshed_view,
        "report_view": report_view,
        "archive_zip": members("zip"),
        "archive_tar": members("tar"),
        "archive_tar_gz": members("tar.gz"),
        "archive_members": staged(marked_archives, members_by_name),
        "archive_lines_zip": lines("zip"),
        "archive_lines_tar": lines("tar"),
        "write_batch": batch_written,
        "reland_batch": batch_relanded,
        "write_member_files": staged(page_archives("zip"), written_files),
        "landing_members": staged(awkward_archives, landed_members),
        "load_audit": load_audit,
        "load_audit_content": load_audit_content,
        "preview": previewed,
        "job_emails": staged(email_archives, job_emails),
        "job_emails_files": staged(email_archives, job_emails_files),
        "all_columns": staged(review_archives, all_columns),
        "job_reviews": job_reviews_from("parquet"),
        "job_reviews_files": job_reviews_from("files"),
    }
