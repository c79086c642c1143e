"""CSV reading shared by the trip and station sources.

Files are listed and their header lines read on the driver (one short read
per file); the rows themselves are read by Spark's CSV source, all columns as
text, and typed afterwards with expressions, so the scan stays splittable and
parallel. Files with different header orders are read in groups, one group
per distinct header, and combined by column name.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import FILE_POSITION, with_file_position

# The text pandas' CSV reader turns into missing values by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# The accepted forms of trip and station times: a US date (two- or four-digit
# year) or an ISO date, alone or with a time of day (one- or two-digit hour,
# seconds and fraction optional); US times also with AM/PM, ISO times also
# with a UTC offset, which reads as the UTC wall clock.
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_US_TIME = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})((?: {_TIME})?)$"
_ISO_TIME = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[ T]{_TIME})?$"
_SHORT_YEAR = r"^(\d{1,2}/\d{1,2})/(\d{2})( .*)?$"
_HALF_DAY = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (0?[1-9]|1[0-2])(:\d{2}(?::\d{2}(?:\.\d{1,9})?)?) ([AaPp])[Mm]$"
_ISO_OFFSET = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]{_TIME}(?:Z|[+-]\d{{2}}:\d{{2}})$"
_NO_SECONDS = r"([ T]\d{1,2}:\d{2})(Z|[+-]\d{2}:\d{2})$"

FILE_PATH = "__file_path"
FILE_NAME = "__file_name"
EXTRA = "__extra_field"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, sorted by file name (any Hadoop file system)."""
    hpath, fs = _fs(spark, pattern)
    found = fs.globStatus(hpath) or []
    paths = [st.getPath().toString() for st in found if st.isFile()]
    return sorted(paths, key=lambda p: (p.rsplit("/", 1)[-1], p))


def list_dirs(spark: SparkSession, pattern: str) -> list[str]:
    hpath, fs = _fs(spark, pattern)
    found = fs.globStatus(hpath) or []
    return sorted(st.getPath().toString() for st in found if st.isDirectory())


def read_first_line(spark: SparkSession, path: str) -> str:
    """The header line of a text file (reads only the start of the file)."""
    jvm = spark.sparkContext._jvm
    hpath, fs = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    if line is None:
        raise ValueError(f"Empty CSV file: {path}")
    return line.lstrip("﻿")


def parse_header(line: str) -> list[str]:
    return next(csv.reader([line]))


def read_text_columns(spark: SparkSession, paths: Sequence[str],
                      normalize: Callable[[str], str], multi_line: bool = False) -> DataFrame:
    """All rows of the CSV files as text columns named by the normalised
    header, plus the file path/name and the row's position in its file.

    ``multi_line`` reads quoted fields that span lines; a file is then read
    by one task (it cannot be split), so it is off by default."""
    groups: dict[tuple[str, ...], list[str]] = {}
    # Header lines are read concurrently: on an object store each read is a
    # round trip, and there may be thousands of files.
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda p: parse_header(read_first_line(spark, p)), paths))
    for path, header in zip(paths, headers):
        groups.setdefault(tuple(header), []).append(path)
    frames = []
    for header, files in groups.items():
        width = len(header)
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)]
                              + [T.StructField(EXTRA, T.StringType())])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv(files)
        )
        df = with_file_position(df)
        names = [normalize(h) for h in header]
        first = _checked_width(F.col("_c0"), width)
        df = df.select(
            first.alias(names[0]),
            *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names) if i > 0],
            F.col("_metadata.file_path").alias(FILE_PATH),
            F.col("_metadata.file_name").alias(FILE_NAME),
            *FILE_POSITION,
        )
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _checked_width(first: Column, width: int) -> Column:
    """The line's first field, or an error when the line has a value after
    its last header column (a line with fewer fields reads as nulls, as
    pandas does). An extra field that is empty reads as null and is not
    noticed. Folded into a column the scan projects anyway: no extra operator."""
    err = F.raise_error(F.concat(F.lit(f"CSV line has more than {width} fields; extra value: "), F.col(EXTRA)))
    return F.when(F.col(EXTRA).isNotNull(), err.cast("string")).otherwise(first)


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}")


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NA_SQL = ", ".join(_quote(t) for t in NA_TOKENS)

# The parsers below are SQL expressions: one call to the JVM per column
# keeps plan building cheap, and the generated code stays small.


def _text(name: str) -> str:
    return f"CASE WHEN `{name}` IN ({_NA_SQL}) THEN NULL ELSE `{name}` END"


def _missing(s: str) -> str:
    return f"({s} IS NULL OR {s} IN ({_NA_SQL}))"


def _typed(name: str, kind: str, fast: Callable[[str], str], rare: Callable[[str], str]) -> Column:
    """The column's text read by ``fast``, which is null for text it cannot
    read, or else by ``rare``. The rare reading is a lambda: Spark evaluates it
    outside the generated code, which stays below the size (8,000 bytes a
    method) up to which the JVM compiles it."""
    s = f"`{name}`"
    return F.expr(f"CASE WHEN {s} IS NULL THEN CAST(NULL AS {kind}) "
                  f"ELSE coalesce({fast(s)}, element_at(transform(array({s}), x -> {rare('x')}), 1)) END")


def parse_long(name: str, what: str) -> Column:
    """Integer text -> bigint; '8.0' is accepted, '8.5' or 'abc' raise."""
    msg = _quote(f"{what}: cannot read '{name}' value as integer: ")

    def rare(x: str) -> str:
        number = f"try_cast({x} AS DECIMAL(38,9))"
        return (f"CASE WHEN {_missing(x)} THEN CAST(NULL AS BIGINT) "
                f"WHEN {number} = floor({number}) THEN CAST({number} AS BIGINT) "
                f"ELSE CAST(raise_error(concat({msg}, {x})) AS BIGINT) END")

    return _typed(name, "BIGINT", lambda s: f"try_cast({s} AS BIGINT)", rare)


def parse_double(name: str, what: str) -> Column:
    """Number text -> double; 'nan' in any case is missing, as the other tokens are."""
    msg = _quote(f"{what}: cannot read '{name}' value as number: ")

    def rare(x: str) -> str:
        return (f"CASE WHEN {_missing(x)} THEN CAST(NULL AS DOUBLE) "
                f"ELSE coalesce(try_cast({x} AS DOUBLE), CAST(raise_error(concat({msg}, {x})) AS DOUBLE)) END")

    return _typed(name, "DOUBLE", lambda s: f"nullif(try_cast({s} AS DOUBLE), double('NaN'))", rare)


def parse_string(name: str) -> Column:
    return F.expr(_text(name))


def _regex(pattern: str) -> str:
    return f"r'{pattern}'"


def _us(text: str) -> str:
    return f"try_cast(regexp_replace({text}, {_regex(_US_TIME)}, '$3-$1-$2$4') AS TIMESTAMP_NTZ)"


def _rare_time(x: str, name: str) -> str:
    """Two-digit years, AM/PM, UTC offsets, missing values, or an error."""
    msg = _quote(f"cannot read '{name}' value as time: ")
    year, month_day, rest = (f"regexp_extract({x}, {_regex(_SHORT_YEAR)}, {k})" for k in (2, 1, 3))
    long_year = f"concat({month_day}, '/20', {year}, {rest})"  # '5/3/26 8:00' -> '5/3/2026 8:00'
    us_year = f"CASE WHEN {x} RLIKE {_regex(_SHORT_YEAR)} THEN {long_year} ELSE {x} END"
    month, day, whole_year, hour, later, half = (
        f"regexp_extract({us_year}, {_regex(_HALF_DAY)}, {k})" for k in range(1, 7))
    hour24 = f"CAST(CAST({hour} AS INT) % 12 + IF(lower({half}) = 'p', 12, 0) AS STRING)"
    twelve = f"try_cast(concat({whole_year}, '-', {month}, '-', {day}, ' ', {hour24}, {later}) AS TIMESTAMP_NTZ)"
    # an instant, since the text names its offset; seconds are added where they are left out
    instant = f"try_cast(regexp_replace({x}, {_regex(_NO_SECONDS)}, '$1:00$2') AS TIMESTAMP)"
    seconds = f"CAST(unix_micros({instant}) / CAST(1000000 AS DECIMAL(20,0)) AS DECIMAL(18,6))"
    return (f"CASE WHEN {_missing(x)} THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE coalesce("
            f"CASE WHEN {x} RLIKE {_regex(_ISO_OFFSET)} "
            f"THEN TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}) END, "
            f"CASE WHEN {us_year} RLIKE {_regex(_HALF_DAY)} THEN {twelve} END, "
            f"CASE WHEN {x} RLIKE {_regex(_SHORT_YEAR)} THEN {_us(long_year)} END, "
            f"CAST(raise_error(concat({msg}, {x})) AS TIMESTAMP_NTZ)) END")


def parse_timestamp(name: str) -> Column:
    """Text -> timestamp_ntz: the wall clock as written, whatever the session
    time zone (an hour that a zone skips or repeats in spring or autumn too).
    Missing values are null, and other text that is no time raises, so no row
    is lost in silence."""
    def fast(s: str) -> str:
        return (f"CASE WHEN contains({s}, '/') THEN {_us(s)} "
                f"WHEN {s} RLIKE {_regex(_ISO_TIME)} THEN try_cast({s} AS TIMESTAMP_NTZ) END")

    return _typed(name, "TIMESTAMP_NTZ", fast, lambda x: _rare_time(x, name))
