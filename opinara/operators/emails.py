"""Parse raw email messages into rows."""

import email
import email.policy

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.email import body, header, header_block, is_multipart

FIELDS = ["sender", "recipient", "subject", "date", "body"]
# Column names of the original emails table.
ORIGINAL_NAMES = dict(zip(FIELDS, ["remetente", "destinatario", "assunto", "data", "corpo"]))


def split_readable(df: DataFrame, content="content", out="message"):
    """Return ``(readable, rejects)``: rows whose bytes are UTF-8 text, and the others.

    The two parts read the input independently; nothing is kept in between.
    """
    text = F.try_validate_utf8(F.col(content).cast("string"))
    readable = df.withColumn(out, text).where(F.col(out).isNotNull()).drop(content)
    rejects = df.where(F.col(content).isNull() | text.isNull()).drop(content)
    return readable, rejects


def parse_emails(df: DataFrame, message="message", original_names=False) -> DataFrame:
    """Replace ``message`` by the five fields and ``is_multipart``."""
    block = "header_block"
    df = df.withColumn(block, header_block(F.col(message)))
    fields = {
        "sender": header(F.col(block), "From"),
        "recipient": header(F.col(block), "To"),
        "subject": header(F.col(block), "Subject"),
        "date": header(F.col(block), "Date"),
        "body": body(F.col(message)),
        "is_multipart": is_multipart(F.col(block)),
    }
    df = df.withColumns(fields).drop(block, message)
    return df.withColumnsRenamed(ORIGINAL_NAMES) if original_names else df


PARTS = "array<struct<path: string, content_type: string, filename: string, body: string>>"


def _walk(message, path=""):
    """The parts below a message, each before its own parts; a container has no body."""
    for number, part in enumerate(message.get_payload(), 1):
        place = f"{path}{number}"
        inner = part.is_multipart()
        yield {"path": place, "content_type": part.get_content_type(), "filename": part.get_filename(),
               "body": None if inner else part.get_payload()}
        if inner:
            yield from _walk(part, f"{place}.")


def message_parts(df: DataFrame, message="message", out="parts") -> DataFrame:
    """Add the parts of each multipart message as an array of ``path, content_type, filename, body``.

    ``path`` tells the place in the tree of parts: ``2.1`` is the first part of the second.
    Containers come before their parts and have no body; an attached message has one part, the
    message in it. Bodies are as written, nothing is decoded. A message that is not multipart, or whose
    boundary is nowhere, has no parts; a NULL message has NULL. Only multipart messages go to
    Python, as Arrow arrays.
    """
    kind = pa.list_(pa.struct([(name, pa.string()) for name in ("path", "content_type", "filename", "body")]))

    @F.arrow_udf(PARTS)
    def parts(texts: pa.Array) -> pa.Array:
        def tree(text):
            parsed = email.message_from_string(text, policy=email.policy.compat32)
            return list(_walk(parsed)) if parsed.is_multipart() else []

        return pa.array([None if text is None else tree(text) for text in texts.to_pylist()], kind)

    text = F.col(message)
    found = parts(F.when(is_multipart(header_block(text)), text))
    return df.withColumn(out, F.when(text.isNotNull(), F.coalesce(found, F.array().cast(PARTS))))
