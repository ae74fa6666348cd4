"""Join scores, reviews and businesses into the report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import email_label, review_label, review_label_sql
from .text import score_sentiment, translate

SCORE = "sentiment_score"
# Columns of the review table that the scored table leaves out.
REVIEW_ONLY = ["business_id", "cool", "date", "funny", "stars", "text", "useful", "user_id"]


def score_reviews(reviews: DataFrame, keep_columns=False, **scoring) -> DataFrame:
    """Reviews with their score; only the key and the score unless ``keep_columns``."""
    scored = score_sentiment(reviews, "text", SCORE, **scoring)
    return scored if keep_columns else scored.drop(*REVIEW_ONLY)


def score_emails(emails: DataFrame, body="body", glossary=None, stop_words=None, **scoring) -> DataFrame:
    """Translate the body, score the translation, label it, drop the translation."""
    df = translate(emails, body, "translated_body", glossary=glossary, stop_words=stop_words)
    df = score_sentiment(df, "translated_body", SCORE, **scoring).drop("translated_body")
    return df.withColumn("sentiment", email_label(F.col(SCORE)))


def _with_business(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    # No hint: Spark measures the business side and broadcasts it only if small;
    # otherwise it shuffles, and adaptive execution splits a hot business.
    names = businesses.select("business_id", "name", "categories")
    return reviews.join(names, "business_id").select(
        F.col("name").alias("NOME"),
        F.col("categories").alias("CATEGORIAS"),
        F.col("text").alias("REVIEW"),
        F.col("date").alias("DATA_AVALIACAO"),
        F.col("stars").alias("ESTRELAS"),
        F.col(SCORE).alias("SENTIMENT_SCORE"),
        review_label(F.col(SCORE)).alias("SENTIMENTO"))


def review_report(scores: DataFrame, reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Report rows: scores joined to their reviews and these to their businesses.

    Tables bucketed by ``review_id`` (see ``sinks.tables``) meet without a shuffle.
    """
    reviews = reviews.select("review_id", "business_id", "text", "date", "stars")
    joined = scores.select("review_id", SCORE).join(reviews, "review_id")
    return _with_business(joined, businesses)


def report_view(spark, name: str, scores: str, reviews: str, businesses: str) -> None:
    """The report as a plain view over three tables, joined anew whenever it is read."""
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT b.name AS NOME, b.categories AS CATEGORIAS, r.text AS REVIEW,
               r.date AS DATA_AVALIACAO, r.stars AS ESTRELAS, s.sentiment_score AS SENTIMENT_SCORE,
               {review_label_sql('s.sentiment_score')} AS SENTIMENTO
        FROM {scores} s JOIN {reviews} r USING (review_id) JOIN {businesses} b USING (business_id)""")


def review_report_unique(reviews: DataFrame, businesses: DataFrame, **scoring) -> DataFrame:
    """The same report where ``review_id`` is known to be unique.

    The score stays on its review, so texts are never shuffled to be joined with
    themselves. Rows without a ``review_id`` would not have joined and go first.
    """
    reviews = reviews.where(F.col("review_id").isNotNull())
    return _with_business(score_reviews(reviews, keep_columns=True, **scoring), businesses)


def preview(df: DataFrame, order_by, n=5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(order_by).limit(n)
