"""Batch keys: the local minute at which a batch was landed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone and format of the batch folders.
ZONE = "America/Sao_Paulo"
KEY_FORMAT = "yyyy-MM-dd-HH-mm"
KEY_PATTERN = r"[0-9]{4}(?:-[0-9]{2}){4}"


def batch_key(utc: Column, zone: str = ZONE) -> Column:
    """Folder name of a UTC wall-clock time."""
    return F.date_format(F.from_utc_timestamp(utc, zone), KEY_FORMAT)

