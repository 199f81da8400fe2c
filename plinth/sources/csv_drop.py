"""Delimited file drops: positional read, lineage, listing and error modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.sources import manifest

# The file format (comma, newline, one header line, optional quotes, \N for NULL).
CSV_FORMAT = {
    "sep": ",", "lineSep": "\n", "header": "true", "quote": '"', "escape": '"', "nullValue": "\\N",
    # binding is by position: the header line is skipped, its names are not looked at
    "enforceSchema": "true",
}
LINEAGE = ["_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts"]
ERROR_MODES = {"abort": "FAILFAST", "keep": "PERMISSIVE", "continue": "DROPMALFORMED"}
CORRUPT = "_corrupt_record"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_positional(
    spark: SparkSession, path: str, columns: list[str], *, glob: str | None = None,
    on_error: str = "keep", corrupt_record: bool = False, options: dict[str, str] | None = None,
) -> DataFrame:
    """All-text rows of a file or folder, columns bound by position.

    ``on_error``: ``keep`` pads short rows with NULL and cuts long ones (a row with the wrong
    delimiter lands whole in the first column), ``abort`` fails on them, ``continue`` skips them.
    ``corrupt_record`` adds the raw text of malformed rows in ``_corrupt_record``;
    :func:`read_with_rejects` loses nothing in any mode.
    """
    schema = text_schema(columns + ([CORRUPT] if corrupt_record else []))
    reader = spark.read.schema(schema).options(**{**CSV_FORMAT, **(options or {})})
    reader = reader.option("mode", ERROR_MODES[on_error]).option("columnNameOfCorruptRecord", CORRUPT)
    if on_error != "keep" or corrupt_record:
        # a pruned read does not see missing or extra fields, so it would not judge the row
        reader = reader.option("columnPruning", "false")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def read_with_rejects(
    spark: SparkSession, path: str, columns: list[str], *, glob: str | None = None,
    on_error: str = "keep", options: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows to land, and the others with their text in ``_corrupt_record`` and a ``_reason``.

    ``keep`` lands short rows, padded with NULL for the quarantine step, and rejects rows with more
    fields than columns, which no column could take. ``continue`` rejects every malformed row.
    """
    every = read_positional(spark, path, columns, glob=glob, corrupt_record=True, options=options)
    # all columns are read on both sides: a pruned read would not judge the rows alike
    return rejected_rows(every, columns, on_error=on_error, options=options)


def rejected_rows(
    every: DataFrame, columns: list[str], *, on_error: str = "keep", options: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows that carry the text of malformed ones in ``_corrupt_record``, as :func:`read_with_rejects` does."""
    wider = text_schema([*columns, "_more"])
    how = {k: v for k, v in {**CSV_FORMAT, **(options or {})}.items() if k in ("sep", "quote", "escape")}
    more = F.from_csv(CORRUPT, wider.simpleString()[7:-1].replace(":", " "), {**how, "emptyValue": ""})["_more"].isNotNull()
    malformed = F.col(CORRUPT).isNotNull()
    rejected = malformed & more if on_error == "keep" else malformed
    reason = F.when(more, "more fields than columns").otherwise("fewer fields than columns")
    return every.where(~F.coalesce(rejected, F.lit(False))).drop(CORRUPT), every.where(rejected).withColumn("_reason", reason)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, size and modification time of every file below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def file_digests(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``path``, ``length``, ``modificationTime`` and content key of every file.

    The key is one rule for files of any size: MD5 over the number of lines and the sum and xor of
    64-bit hashes of (line number, line). Lines are numbered within the splits Spark reads, and
    splits of a file are put in order by their counts, so no file has to fit one row or task.
    """
    lines = spark.read.option("recursiveFileLookup", "true")
    if glob:
        lines = lines.option("pathGlobFilter", glob)
    rows = lines.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value",
    )
    blocks = rows.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("value").alias("lines"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of a file
    placed = blocks.select("path", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("offset"), "first")
    numbered = rows.join(placed, ["path", "block"])
    h = F.xxhash64(F.col("offset") + F.col("id") - F.col("first"), "value")
    keyed = numbered.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"), F.bit_xor(h).alias("x"),
    ).select("path", F.concat_ws(":", "n", "s", "x").alias("_key"))
    # a file without lines has no row in `keyed`
    return list_files(spark, path, glob).join(keyed, "path", "left").select(
        "path", "length", "modificationTime", F.md5(F.coalesce("_key", F.lit("0")).cast("binary")).alias("content_key")
    )


def with_lineage(
    spark: SparkSession, rows: DataFrame, path: str, *, glob: str | None = None, load_ts=None,
) -> DataFrame:
    """Add file name, modification time, content key and load time to rows read from files."""
    digests = file_digests(spark, path, glob).select(
        F.col("path").alias("_stg_file_name"), F.col("content_key").alias("_stg_file_md5")
    )
    landed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_stg_file_name"),
        F.col("_metadata.file_modification_time").alias("_stg_file_load_ts"),
    )
    loaded = landed.join(digests, "_stg_file_name", "left")
    return loaded.withColumn(
        "_copy_data_ts", F.current_timestamp() if load_ts is None else load_ts
    ).select(*rows.columns, *LINEAGE)


def copy_into(
    spark: SparkSession, path: str, columns: list[str], stage: str, *, glob: str | None = None,
    on_error: str = "abort", load_ts=None, options: dict[str, str] | None = None, force: bool = False,
) -> None:
    """Append the files below ``path`` to a parquet stage table, with lineage.

    ``abort`` keeps rows with another delimiter out by failing; ``keep`` lands them for the
    quarantine step. Rows that cannot land are appended to ``<stage>_rejects`` with their reason
    and lineage. A file of which the stage holds rows, by path and content key, is not loaded again
    unless ``force`` is set.
    """
    rejects = f"{stage}_rejects"
    if on_error == "abort":
        parts = {stage: read_positional(spark, path, columns, glob=glob, on_error=on_error, options=options)}
    else:
        landed, rejected = read_with_rejects(spark, path, columns, glob=glob, on_error=on_error, options=options)
        parts = {stage: landed, rejects: rejected}
    file = ["_stg_file_name", "_stg_file_md5"]
    known = spark.read.parquet(stage).select(*file).distinct() if not force and _is_table(spark, stage) else None
    # rejects go first: once the stage has a file, it counts as loaded
    for table in sorted(parts, key=lambda t: t == stage):
        loaded = with_lineage(spark, parts[table], path, glob=glob, load_ts=load_ts)
        if known is not None:
            loaded = loaded.join(known, file, "left_anti").select(*loaded.columns)
        loaded.write.mode("append").parquet(table)


def _is_table(spark: SparkSession, path: str) -> bool:
    return any(n.endswith(".parquet") for n in manifest.names(spark, path))


def write_csv(df: DataFrame, path: str, header: bool = True, partition_by: list[str] | None = None) -> None:
    """Write a table as a file drop in the same format."""
    writer = df.write.options(**{**CSV_FORMAT, "header": str(header).lower()}).option("emptyValue", '""')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
