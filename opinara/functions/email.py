r"""Fields of a raw email, as column expressions over the message text.

The rules are those of the standard mail parser: header names match in any case,
the first of a repeated header wins, an absent header is NULL, a folded header
keeps its line break, nothing is decoded, and the headers end at the first line
that is neither a header nor a continuation. A line ends with \n, \r\n or \r.
Patterns step through the text without nested repetition, so long headers need
no deep regex stack.

A multipart message keeps its raw text after the headers as body and is flagged.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_START = r"(?:\A|(?<=\n)|(?<=\r)(?!\n))"
HEADER_LINE = r"(?:[!-9;-~]*:|[\t ]|From )"
BODY_START = rf"{LINE_START}(?!{HEADER_LINE})"
ENVELOPE_LINE = r"(From [^\r\n]*+(?>\r\n|\n|\r|\z))"
LINE_END = r"(?:\r\n|\n|\r(?!\n))"


def header_block(message: Column) -> Column:
    return F.regexp_extract(message, rf"(?s)\A(.*?)(?:{BODY_START}|\z)", 1)


def header(block: Column, name: str) -> Column:
    field = rf"(?is){LINE_START}{name}:"
    value = F.regexp_extract(block, rf"{field}[\t ]*(.*?)(?={LINE_END}(?![\t ])|\z)", 1)
    return F.when(block.rlike(field), F.regexp_replace(value, r"[\r\n]+\z", ""))


def body(message: Column) -> Column:
    """The text after the headers, less the empty line that ends them.

    An envelope line ("From ...") that ends the headers opens the body instead,
    unless it is the first line of the message.
    """
    start = rf"(?:{LINE_START}(?!\A){ENVELOPE_LINE}(?!{HEADER_LINE})|{BODY_START}|\z)"
    return F.regexp_replace(message, rf"(?s)\A.*?{start}(?:\r\n|\n|\r)?", "$1")


def is_multipart(block: Column) -> Column:
    kind = F.lower(header(block, "content-type"))
    return F.coalesce(kind.startswith("multipart/") | kind.startswith("message/"), F.lit(False))
