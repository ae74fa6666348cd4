"""Clean line-delimited JSON, as strictly as a JSON parser for one document takes a line."""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
STRICT = {"allowSingleQuotes": "false"}


def _quoted(text):
    return text.replace("\\", "\\\\").replace("'", "\\'")


def strict_sql(line: str, kind: str, options=None) -> str:
    """SQL for the one JSON object of ``line`` as ``kind``, in an array that is empty for anything else.

    Spark's parser stops behind the first value of a line. So the line is read as
    the value of an object that goes on with a key nobody has written, which a cut
    line or trailing text would hide, and as the only element of an array. That
    second reading builds nothing, and the first is named once, so it runs once.
    """
    end = f"end_{uuid.uuid4().hex}"
    given = "map('allowSingleQuotes', 'false'" + "".join(f", '{k}', '{v}'" for k, v in (options or {}).items()) + ")"
    whole = f"from_json(concat('{{\"o\":', {line}, ',\"{end}\":0}}'), 'o {_quoted(kind)}, {end} int', {given})"
    alone = f"size(from_json(concat('[', {line}, ']'), 'array<struct<{end}:int>>', {given}))"
    return f"transform(filter(array({whole}), w -> w.{end} = 0 AND w.o IS NOT NULL AND {alone} = 1), w -> w.o)"


def json_objects(line: str) -> Column:
    """The line's object as a map, in an array that is empty for anything else."""
    return F.expr(strict_sql(f"`{line}`", OBJECT))


def _last_of_each_key(parsed: Column) -> Column:
    entries = F.map_entries(parsed)
    keys = F.map_keys(parsed)
    last = F.filter(entries, lambda e, i: ~F.array_contains(
        F.slice(keys, i + 2, F.size(keys)), e["key"]))
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, F.map_from_entries(last)).otherwise(parsed)


# Numbers that a parser may spell in another way: with a point or an exponent, a zero with a sign, very long, or none at all.
SPELT = r"[0-9][.eE]|-0|[0-9]{16}|NaN|Infinity"
# What stands before the next number of a line, strings taken whole, and the number. Nothing is taken
# back once it is matched, so the work grows with the line and needs no stack.
NUMBERS = r'\G((?:[^"0-9NI-]++|-(?![0-9I])|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+)(-?[0-9][0-9.eE+-]*+|-?Infinity|NaN)'


def _written(parsed: Column, line: Column, key: str) -> Column:
    """The object without ``key`` as JSON. Numbers go through the parser as marked strings, so they keep their text."""
    def without(found):
        # As the element of an array the object is parsed once, however often the rule names it.
        return F.element_at(F.transform(F.array(found), lambda o: F.to_json(
            F.map_filter(_last_of_each_key(o), lambda k, v: k != key))), 1)

    mark = f"number_{uuid.uuid4().hex}_"
    marked = F.from_json(F.regexp_replace(line, NUMBERS, f'$1"{mark}$2"'), OBJECT, STRICT)
    plain = F.regexp_replace(without(marked), f'"{mark}([^"]*+)"', "$1")
    return F.when(line.rlike(SPELT), plain).otherwise(without(parsed))


def drop_json_key(df: DataFrame, key: str, line="value"):
    """Return ``(clean, rejects)``.

    ``clean`` holds every line that is one JSON object, without its top-level
    ``key``, written as JSON again; ``rejects`` all other lines: malformed ones,
    trailing text, a second object, single quotes, other values. A key given twice
    keeps its last value, at any depth; for that the session's
    ``spark.sql.variant.allowDuplicateKeys`` is set. Numbers stay as written at any
    depth, of any size and precision, and so do NaN and Infinity.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = "parsed"
    # Exploding the object, if there is one, parses each kept line once; a filter on
    # the parsed column would be pushed down and parse it again.
    clean = df.select("*", F.explode(json_objects(line)).alias(parsed))
    clean = clean.withColumn(line, _written(F.col(parsed), F.col(line), key)).drop(parsed)
    return clean, df.where(F.size(json_objects(line)) == 0)
