"""Sentiment labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the report, by the sign of the score.
REVIEW_LABELS = {"= 0": "NEUTRO", "> 0": "POSITIVO", "< 0": "NEGATIVO"}


def email_label(score: Column) -> Column:
    """English label; a missing score counts as Neutral."""
    return (F.when(score > 0, "Positive").when(score < 0, "Negative").otherwise("Neutral"))


def review_label(score: Column) -> Column:
    """Portuguese label of the report; a missing score has no label."""
    label = F
    for sign, condition in (("= 0", score == 0), ("> 0", score > 0), ("< 0", score < 0)):
        label = label.when(condition, REVIEW_LABELS[sign])
    return label


def review_label_sql(score: str) -> str:
    """The same label as SQL, for views."""
    return "CASE " + " ".join(f"WHEN {score} {sign} THEN '{label}'" for sign, label in REVIEW_LABELS.items()) + " END"
