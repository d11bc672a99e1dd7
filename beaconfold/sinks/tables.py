"""Writing results in the layouts downstream readers expect.

Each writer replaces exactly one data date, as a whole or not at all (see ``days``), and returns the folder it is in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beaconfold.schemas import MART, SESSION_DATA
from beaconfold.sources.days import day_folder, replace_day

ROWS_PER_FILE = 5_000_000

def write_sessions(sessions: DataFrame, root: str, data_date: str, file_format: str = "parquet") -> str:
    """Sessions of one date under ``hour=…`` of a new version, snappy-compressed; ``avro`` needs its Spark module.

    Rows are brought together by hour so that an hour is a few files and not one per task;
    adaptive execution splits large hours, so one busy hour is written by many tasks.
    """

    def write(path: str) -> None:
        by_hour = sessions.drop("date").hint("rebalance", "hour").write.partitionBy("hour")
        by_hour.option("compression", "snappy").option("maxRecordsPerFile", ROWS_PER_FILE).format(file_format).save(path)

    return replace_day(sessions.sparkSession, root, data_date, write)


#: How mart text tables are written. ``\\N`` is NULL, so a text of just these two characters can't be told from it.
MART_TEXT = {
    "sep": "\t",
    "nullValue": "\\N",
    "emptyValue": '""',
    "escape": '"',
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_mart(mart: DataFrame, root: str, data_date: str) -> str:
    r"""Mart of one date as gzipped TSV without header: NULL is ``\N``, an empty text is ``""``."""

    def write(path: str) -> None:
        mart.write.options(**MART_TEXT, compression="gzip").csv(path)

    return replace_day(mart.sparkSession, root, data_date, write)


def mart_schema(extra_keys: Sequence[str] = ()) -> T.StructType:
    """The columns of a stored mart in the grain that ``extra_keys`` make, as ``daily_mart`` gives them."""
    return T.StructType([*(SESSION_DATA[k] for k in extra_keys), *MART.fields])


def read_mart(spark: SparkSession, root: str, data_date: str, extra_keys: Sequence[str] = ()) -> DataFrame:
    """A written mart date, under its column names. Gzip files are read whole in any case, so line breaks in texts cost nothing."""
    read = spark.read.schema(mart_schema(extra_keys)).options(**MART_TEXT | {"emptyValue": ""}, multiLine=True)
    return read.csv(day_folder(spark, root, data_date))


def write_pairs(pairs: DataFrame, root: str, data_date: str) -> str:
    """Extracted campaign pairs of one date as JSON lines."""
    return replace_day(pairs.sparkSession, root, data_date, lambda path: pairs.write.json(path))


def write_notices(frame: DataFrame, path: str) -> None:
    """Load notices as JSON lines, one message per line."""
    frame.write.mode("overwrite").json(path)
