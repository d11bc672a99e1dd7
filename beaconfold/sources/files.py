"""Inbound files, extracted mappings, and directory listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.schemas import CAMPAIGN_PAIRS, FILE_LISTING
from beaconfold.sources.days import day_folder


def _file_key() -> Column:
    """The file a row comes from, spelled the same by every reader: its URI with escapes undone."""
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(uri)


def _under(spark: SparkSession, directory: str, key: Column) -> Column:
    """The part of a key below a directory."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    whole = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    depth = len(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", whole).rstrip("/"))
    return F.substr(F.regexp_replace(key, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/"), F.lit(depth + 2))


def list_files(spark: SparkSession, directory: str, key_prefix: str = "") -> DataFrame:
    """Files under a directory, at any depth, as (key, etag), without reading them.

    ``key_prefix`` is compared with what follows the directory in the key, folders included. The folders it names are
    gone down directly, and below them only files and folders that can match are opened; folders are listed in parallel.
    ``etag`` changes with size or modification time, and is taken anew at each evaluation. Where the object store's own
    etags are at hand, for instance from an inventory, pass a DataFrame of those instead.
    """
    where = directory.rstrip("/") + "/" + exact_paths([key_prefix])[0] + "*" if key_prefix else directory
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(where)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or not key_prefix:
            raise
        return spark.createDataFrame([], FILE_LISTING)
    version = F.concat_ws("-", "length", F.unix_micros("modificationTime"))
    named = listing.select(_file_key().alias("key"), F.md5(version).alias("etag"))
    return named.where(F.startswith(_under(spark, directory, F.col("key")), F.lit(key_prefix)))


def list_partition_hours(spark: SparkSession, path: str, utcdates: Sequence[str]) -> DataFrame:
    """Source partitions of the given UTC dates in a layout ``utcdate=…/utchour=…``; other dates aren't listed."""
    try:
        files = spark.read.format("binaryFile").load(f"{path}/utcdate={{{','.join(utcdates)}}}/utchour=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "utcdate string, utchour string")
    return files.select(
        F.regexp_extract("path", "/utcdate=([^/]+)/", 1).alias("utcdate"),
        F.regexp_extract("path", "/utchour=([^/]+)/", 1).alias("utchour"),
    ).distinct()


def read_pairs(spark: SparkSession, root: str, data_date: str) -> DataFrame:
    """Extracted campaign pairs of one day, JSON lines."""
    return spark.read.schema(CAMPAIGN_PAIRS).json(day_folder(spark, root, data_date))


def exact_paths(keys: Sequence[str]) -> list[str]:
    """File keys as paths of a reader, which would take some characters for patterns."""
    return [re.sub(r"([\\{}\[\]*?^,])", r"\\\1", k) for k in keys]


# ---- CSV with line breaks inside quotes, read by many tasks --------------------------------

# States while walking a line: a field begins, inside a bare field, inside quotes, just behind a closing quote.
_BEGIN, _BARE, _QUOTED, _CLOSED = range(4)


def _ends_open(line: str, opened: bool) -> str:
    """SQL: whether a line ends inside quotes, given that it began there or not.

    A quote opens only at the beginning of a field; elsewhere in a bare field it is a character. Two of them inside quotes are one
    character. The line is walked from quote to quote.
    """

    def text(state: str, part: str) -> str:
        return f"CASE WHEN {part} = '' OR {state} = {_QUOTED} THEN {state} WHEN endswith({part}, ',') THEN {_BEGIN} ELSE {_BARE} END"

    first = text(str(_QUOTED if opened else _BEGIN), "parts[0]")
    quote = f"CASE s WHEN {_BEGIN} THEN {_QUOTED} WHEN {_QUOTED} THEN {_CLOSED} WHEN {_CLOSED} THEN {_QUOTED} ELSE {_BARE} END"
    step = f"transform(array({quote}), q -> {text('q', 'part')})[0]"
    walked = f"transform(array(split({line}, '\"')), parts -> aggregate(slice(parts, 2, size(parts)), {first}, (s, part) -> {step}))[0]"
    return f"CASE WHEN contains({line}, '\"') THEN {walked} = {_QUOTED} ELSE {str(opened).lower()} END"


def _with_state(rows: DataFrame, function: tuple[str, str], window: str, closed: str, opened: str) -> DataFrame:
    """Rows with the state before each, for a closed and for an open start of its window.

    ``function`` names the columns that say what a row makes of a closed and of an open state. It either sets the state, flips it
    or leaves it, so what counts is the last row before that sets it and the number of flips since: running sums.
    """
    of_closed, of_open = function
    before = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = rows.selectExpr("*", f"coalesce(sum(CAST({of_closed} AND NOT {of_open} AS INT)) {before}, 0) AS _flips")
    rows = rows.selectExpr("*", f"CASE WHEN {of_closed} = {of_open} THEN struct({of_closed} AS value, _flips AS flips) END AS _setting")
    rows = rows.selectExpr("*", f"last_value(_setting) IGNORE NULLS {before} AS _last")
    flipped = "((_flips - coalesce(_last.flips, 0)) % 2 = 1)"
    states = [f"(coalesce(_last.value, {start}) <> {flipped}) AS {name}" for start, name in (("false", closed), ("true", opened))]
    return rows.selectExpr("*", *states).drop("_flips", "_setting", "_last")


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records of CSV files as (key, block, row, record), line breaks inside quotes included, without headers.

    Files are split like text. What a line does to the state "inside quotes" is known for either state before it, so
    each block of a file is summarised on its own; a running combination over the few blocks gives each one's true start, and
    with it where records begin. Lines of one record come together by its key, also across blocks. A quote that is never
    closed makes one record of the rest of its file. ``\n`` ends a line, a ``\r`` before it goes at a record's end, and
    inside quotes too in a file whose first line ends in both.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        _file_key().alias("key"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("line")
    )
    lines = lines.selectExpr("*", f"{_ends_open('line', False)} AS after_closed", f"{_ends_open('line', True)} AS after_open")
    within = "PARTITION BY key, block ORDER BY row"
    lines = _with_state(lines, ("after_closed", "after_open"), within, "open_if_closed", "open_if_open")
    # Records that have begun in the block, this line included, for either start of it.
    begun = "sum(CAST(NOT {} AS INT)) OVER ({} ROWS UNBOUNDED PRECEDING)"
    lines = lines.selectExpr("*", *[f"{begun.format(f'open_if_{s}', within)} AS begun_if_{s}" for s in ("closed", "open")])

    ends = [f"max_by(CASE WHEN open_if_{s} THEN after_open ELSE after_closed END, row) AS ends_if_{s}" for s in ("closed", "open")]
    blocks = lines.groupBy("key", "block").agg(*[F.expr(f"{e}") for e in ends], *[F.max(f"begun_if_{s}").alias(f"count_if_{s}") for s in ("closed", "open")], F.expr(r"min_by(endswith(line, '\r'), row) AS crlf"))
    in_file = "PARTITION BY key ORDER BY block"
    blocks = _with_state(blocks, ("ends_if_closed", "ends_if_open"), in_file, "starts_open", "unused")
    blocks = blocks.selectExpr(
        "key", "block", "starts_open", "CASE WHEN starts_open THEN count_if_open ELSE count_if_closed END AS records", f"first_value(crlf) OVER ({in_file}) AS crlf"
    )
    # Lines before the first record of a block belong to the last record before the block.
    owner = f"last_value(CASE WHEN records > 0 THEN struct(block, records) END) IGNORE NULLS OVER ({in_file} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    blocks = blocks.selectExpr("key", "block", "starts_open", "crlf", f"{owner} AS owner")

    placed = lines.join(blocks, ["key", "block"]).selectExpr(
        "key", "block", "row", "line", "owner", "crlf", "CASE WHEN starts_open THEN begun_if_open ELSE begun_if_closed END AS n"
    )
    of = placed.selectExpr("key", "IF(n > 0, block, owner.block) AS of_block", "IF(n > 0, n, owner.records) AS of_n", "crlf", "struct(block, row, line) AS line")
    records = of.where("NOT (of_block = 0 AND of_n = 1)").groupBy("key", "of_block", "of_n", "crlf").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    text = r"regexp_replace(array_join(transform(lines, x -> x.line), '\n'), '\r$', '')"
    ended = rf"IF(crlf, replace({text}, '\r\n', '\n'), {text}) AS record"
    return records.selectExpr("key", "lines[0].block AS block", "lines[0].row AS row", ended).where("record <> ''")


def read_name_rows(spark: SparkSession, paths: str | Sequence[str], *, multi_line: bool = False) -> DataFrame:
    """Rows of id/name CSV files as (key, row_no, id, name), ``row_no`` in file order.

    The first line is a header, quotes are doubled inside quoted fields, and columns beyond
    the second are ignored. An id that is no number is an error, and so is a row without a name field; an empty field
    is an empty name. A file may be read in several splits: rows sort by the start of their split, then by position
    within it. With ``multi_line``, quoted fields may hold line breaks; files are split all the same, see ``csv_records``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = {"escape": '"', "columnNameOfCorruptRecord": "_raw"}
    fields = "id string, name string, _raw string"
    if multi_line:
        parsed = F.from_csv("record", fields, options | {"multiLine": "true"})
        lines = csv_records(spark, paths).select("key", F.struct("block", "row").alias("row_no"), parsed.alias("r")).select("key", "row_no", "r.*")
    else:
        read = spark.read.schema(fields).options(header=True, encoding="UTF-8", **options).csv(paths)
        at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        lines = read.select(_file_key().alias("key"), at.alias("row_no"), "id", "name", "_raw")
    not_a_number = F.raise_error(F.concat(F.lit("not an id: "), F.coalesce("id", F.lit("nothing"))))
    # A row of too few or too many fields has its text in _raw; without a separator it is too few.
    no_name = F.col("name").isNull() & F.col("_raw").isNotNull() & ~F.contains("_raw", F.lit(","))
    return lines.select(
        "key",
        "row_no",
        F.coalesce(F.expr("try_cast(trim(id) AS bigint)"), not_a_number).alias("id"),
        F.when(no_name, F.raise_error(F.concat(F.lit("no name field: "), "_raw"))).otherwise(F.coalesce("name", F.lit(""))).alias("name"),
    )
