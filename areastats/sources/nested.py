"""JSON records, by default one multi-line array per state file."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_STRING = T.StringType()

#: School record: only the fields used, so the parser skips the rest.
SITE_SCHEMA = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType([T.StructField(c, _STRING) for c in ("COUNTY", "STATE", "NAME")]),
        )
    ]
)
#: Vulnerability record.
SVI_SCHEMA = T.StructType(
    [
        T.StructField("COUNTY", _STRING),
        T.StructField("ST_ABBR", _STRING),
        T.StructField("RPL_THEMES", T.DoubleType()),
    ]
)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    states: Sequence[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read a directory of JSON files; the elements of each top-level array become rows.

    Without a ``schema`` Spark infers one in an extra pass, which is meant for a first look.

    ``states`` keeps the files of the named states, recognised by ``.<state>.`` in the file name
    or a folder ``<column>=<state>``. The test is on the path alone, so other files are pruned
    before they are opened. A multi-line file cannot be split, so one file is one task: large
    inputs should come as many files, or as one record per line with ``multi_line=False``.
    """
    reader = spark.read.option("multiLine", multi_line)
    df = (reader if schema is None else reader.schema(schema)).json(path)
    if states is not None:
        pattern = "(?:" + "|".join(rf"\.{s}\.[^/]*$|={s}/" for s in map(re.escape, states)) + ")"
        # A space in a path is reported percent-encoded.
        df = df.where(F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" ")).rlike(pattern))
    return df


#: Bytes of a file with an array of records.
FILE_BYTES = 64 * 1024 * 1024
#: Files whose records are numbered together.
_SLICE_FILES = 8


def write_json_arrays(df: DataFrame, record: Column, path: str, state: str = "state", *, file_bytes: int = FILE_BYTES) -> None:
    """Write each record (a JSON text) into a multi-line array, one folder per state, at most ``file_bytes`` a file.

    Records are packed in the engine by a running total of their bytes. The total runs over slices of a
    state of a few files each, so that a state with most of the records is no single task. A record that is larger than
    a file gets a file of its own. Rows without a state go into one folder, rows without a record are left out.
    """
    s = F.col(f"`{state}`")
    rows = df.select(s.alias("state"), record.alias("record")).where(F.col("record").isNotNull())
    rows = rows.withColumn("bytes", F.octet_length("record") + 2)
    sizes = rows.groupBy("state").agg(F.ceil(F.sum("bytes") / (_SLICE_FILES * file_bytes)).cast("int").alias("slices"))
    sliced = rows.alias("r").join(sizes.alias("s"), F.expr("r.state <=> s.state"))
    sliced = sliced.select("r.state", "record", "bytes", F.expr("pmod(xxhash64(record), slices)").alias("slice"))
    before = Window.partitionBy("state", "slice").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    # A pack ends where the next record would begin beyond its share.
    pack = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / file_bytes)
    packs = sliced.withColumn("pack", pack).groupBy("state", "slice", "pack").agg(F.collect_list("record").alias("records"))
    text = F.concat(F.lit("["), F.array_join("records", ",\n"), F.lit("]"))
    packs.select(F.col("state").alias(state), text.alias("value")).write.option("maxRecordsPerFile", 1).partitionBy(state).text(path)
