"""Landing CSV files -> all-string DataFrames.

Semantics kept from the landing contract:

* a header row is skipped; columns are positional (``strict_header=True``
  instead checks every file's header against the schema names);
* an unquoted empty field is NULL, a quoted ``""`` is the empty string;
* quotes inside a quoted field are doubled (``"q ""z"", w"``);
* a row with too few or too many fields aborts the read (FAILFAST);
* a header-only file gives zero rows; a missing path raises.

``multiLine`` stays off by default so large files remain splittable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import entity as _entity

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    # An unquoted empty field stays NULL; only a quoted "" becomes ''.
    "nullValue": "\u0000",
    "emptyValue": "",
    "mode": "FAILFAST",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_landing(spark: SparkSession, entity: str, path: str | list[str], *, strict_header: bool = False,
                 multi_line: bool = False, with_file: bool = False) -> DataFrame:
    """Read landing CSV file(s) of ``entity`` with its declared all-string schema."""
    ent = _entity(entity)
    reader = (spark.read.schema(ent.schema).options(**CSV_OPTIONS)
              .option("enforceSchema", "false" if strict_header else "true")
              .option("multiLine", "true" if multi_line else "false"))
    df = reader.csv(path)
    if with_file:
        df = df.withColumn("source_file", F.input_file_name())
    return df


def read_landing_batches(spark: SparkSession, entity, incoming_dir: str, prefix: str, *,
                         strict_header: bool = False) -> DataFrame:
    """All daily files ``<incoming_dir>/<date>/<prefix>_<date>.csv`` of an entity, with a
    ``batch_date`` column taken from the folder name (for state replay by batch)."""
    import os
    df = read_landing(spark, entity, os.path.join(incoming_dir, "*", f"{prefix}_*.csv"),
                      strict_header=strict_header, with_file=True)
    day = F.regexp_extract(F.col("source_file"), r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return df.withColumn("batch_date", F.to_date(day)).drop("source_file")
