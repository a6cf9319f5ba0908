"""Delimited extracts (comma-separated, header line skipped, no quoting, bound by position).

Reading is schema-first: columns are bound by position to the table definition and the header's
own names are ignored. Empty fields become NULL. A row whose values do not fit the schema is kept
with nulls and its raw text lands in the corrupt-record column, so a load can count bad rows
instead of failing (or silently dropping them).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.schemas import REJECT_COLUMNS

CORRUPT_COLUMN = "_corrupt_record"
ROWS_PER_FILE = 1_000_000

_READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": "",              # '"' is an ordinary character, as in the source system's loader
    "enforceSchema": "true",  # bind by position; header names may differ in case
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd[ HH:mm:ss]",
}


def read_extract(spark: SparkSession, path: str, schema: T.StructType,
                 keep_corrupt: bool = True) -> DataFrame:
    """Read one extract (a file or a folder of part files) with ``schema``.

    With ``keep_corrupt`` the frame carries ``_corrupt_record`` (raw line of rows that failed to
    parse, else NULL). Filter or count it together with the data columns: Spark refuses queries
    that reference only the corrupt column of a raw file scan.
    """
    read_schema = schema
    opts = dict(_READ_OPTIONS)
    if keep_corrupt:
        read_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        opts["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
    return spark.read.schema(read_schema).options(**opts).csv(path)


def with_rejects(extract: DataFrame) -> DataFrame:
    """``read_extract``'s frame with ``REJECT_COLUMNS`` in place of the corrupt-record column: the raw text
    and the file of a row that did not parse."""
    raw, file = REJECT_COLUMNS
    bad = F.col(CORRUPT_COLUMN)
    return (extract.withColumn(file, F.when(bad.isNotNull(), F.col("_metadata.file_path"))).withColumn(raw, bad)
            .drop(CORRUPT_COLUMN))


def write_extract(df: DataFrame, path: str) -> None:
    """Write ``df`` as extract part files in the same format (used to stage test sources), packed with gzip
    in files of ``ROWS_PER_FILE`` rows, since a packed file is read by one task.

    Values are written verbatim: no quoting, no trimming, NULL and '' both as an empty field. The
    format cannot hold a separator or line break inside a value; such values are counted while
    writing and raise ``ValueError`` afterwards instead of shifting columns silently.
    """
    out = df.select([
        F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])
    texts = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    obs = Observation(f"extract_{uuid.uuid4().hex[:8]}")
    unsafe = F.lit(False)
    for c in texts:
        unsafe = unsafe | F.coalesce(c.contains(",") | c.contains("\n") | c.contains("\r"), F.lit(False))
    out = out.observe(obs, F.count_if(unsafe).alias("unsafe"))
    (out.write.mode("overwrite")
        .option("header", "true").option("sep", ",")
        .option("quote", "").option("escapeQuotes", "false")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("nullValue", "").option("emptyValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(path))
    if obs.get["unsafe"]:
        raise ValueError(f"{obs.get['unsafe']} rows hold a ',' or a line break, which the unquoted "
                         f"extract format cannot represent: {path}")
