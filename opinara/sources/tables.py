"""Line-delimited JSON files and tables."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.jsonlines import strict_sql

# Schemas of the two entities the reports use, so that no pass over the data has
# to find them out. ``attributes`` is left out on purpose.
REVIEW_SCHEMA = """review_id string, user_id string, business_id string, stars double, useful bigint,
funny bigint, cool bigint, text string, date string"""
BUSINESS_SCHEMA = """business_id string, name string, address string, city string, state string,
postal_code string, latitude double, longitude double, stars double, review_count bigint,
is_open bigint, categories string, hours map<string,string>"""
SCHEMAS = {"review": REVIEW_SCHEMA, "business": BUSINESS_SCHEMA}


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line of the JSON files at or below ``path``."""
    return (spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.json").text(path))


def external_table(spark: SparkSession, name: str, path: str, schema: str = None) -> DataFrame:
    """Register the JSON lines at ``path`` as table ``name``, replacing an older one.

    Without ``schema`` Spark reads the data once to find its columns.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = f"({schema})" if schema else ""
    location = path.replace("'", r"\'")
    spark.sql(f"CREATE TABLE {name} {columns} USING json LOCATION '{location}'")
    return spark.table(name)


def found_columns(lines: DataFrame, line="value") -> dict:
    """Columns ``{name: type}`` of the JSON objects of all lines, from one pass over them."""
    # Exploded, as a filter on the parsed value would be pushed down and parse each line again.
    objects = f"filter(array(try_parse_json(`{line}`)), v -> schema_of_variant(v) LIKE 'OBJECT%')"
    kind = lines.select(F.expr(f"explode({objects})").alias("v")).agg(F.expr("schema_of_variant_agg(v)")).first()[0]
    if not kind or not kind.startswith("OBJECT<"):
        return {}
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", kind).replace("VOID", "STRING")
    shape = lines.sparkSession.sql(f"SELECT CAST(NULL AS {ddl}) AS o").schema["o"].dataType
    return {f.name: f.dataType.simpleString() for f in shape.fields}


def entity_schema(given: str, found: dict, left_out=()) -> str:
    """The ``given`` columns, with their types, and whatever else was found."""
    from pyspark.sql.types import StructType

    known = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(given).fields} if given else {}
    columns = {**known, **{n: t for n, t in found.items() if n not in known}}
    return ", ".join(f"`{n}` {t}" for n, t in columns.items() if n not in left_out)


def line_view(spark: SparkSession, name: str, source: str, schema: str) -> None:
    """Register view ``name`` with the columns of ``schema`` over the JSON lines of ``source``.

    ``source`` is SQL with one column ``value``. Lines that are not one JSON object
    are skipped; a value that does not fit its column's type is NULL.
    """
    kind = f"struct<{', '.join(schema.split(chr(10)))}>"
    kind = re.sub(r"(`[^`]+`) ", r"\1:", " ".join(kind.split()))
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"""
        CREATE VIEW {name} AS
        SELECT o.* FROM (SELECT explode({strict_sql('value', kind)}) AS o FROM ({source}))""")


def _each(spark, items, register) -> DataFrame:
    """Register every ``(table, path)``; a failure is kept as status and the next one follows."""
    status = []
    for name, path in items:
        try:
            register(name, path)
            status.append((name, path, True, None))
        except Exception as error:
            status.append((name, path, False, str(error).splitlines()[0]))
    return spark.createDataFrame(status, "table string, path string, ok boolean, error string")


def external_tables(spark: SparkSession, paths: dict, schemas: dict = None) -> DataFrame:
    """Register ``{table: path}`` as external tables; one status row per table."""
    def register(name, path):
        external_table(spark, name, path, (schemas or {}).get(name.rsplit("_", 1)[-1]))

    return _each(spark, paths.items(), register)


def line_views(spark: SparkSession, sources: dict, entities: dict, schemas: dict = None, left_out: dict = None) -> DataFrame:
    """Register ``{view: source}`` with all columns that their lines have; one status row per view.

    ``entities`` names the entity of each view; ``schemas`` gives the types of known
    columns, ``left_out`` columns to leave out, both by entity.
    """
    def register(name, source):
        entity = entities[name]
        schema = entity_schema((schemas or {}).get(entity), found_columns(spark.sql(source)), (left_out or {}).get(entity, ()))
        if not schema:
            raise ValueError(f"no JSON object among the lines of {entity}")
        line_view(spark, name, source, schema)

    return _each(spark, sources.items(), register)


def read_table(spark: SparkSession, source: str, fmt: str = None, **options) -> DataFrame:
    """A catalog table, or with ``fmt`` whatever that connector calls ``source``."""
    if fmt is None:
        return spark.table(source)
    return spark.read.format(fmt).options(**options).load(source)
