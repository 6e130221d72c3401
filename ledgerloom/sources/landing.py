"""JSON-lines landing: layout, validation, batch gating and bulk load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.relational import union_all
from ..schemas import SOURCE_GROUPS

# Completion marker and layout of a landing batch.
SUCCESS_MARKER = "_SUCCESS"
LAYOUT = r"clients/([^/]+)/([^/]+)/([^/]+)/run_date=(\d{4}-\d{2}-\d{2})/([^/]*)$"
LAYOUT_FIELDS = ["client", "source", "table", "run_date", "file"]

# Lines whose blank ones are listed before they are summed up: bounds what one group collects.
CHUNK = 1000


def raw_path(tenant: str, source: str, table: str, run_date: str | None = None, file: str | None = None,
             base: str = "", compress: bool = True) -> str:
    """Path of a batch folder or of one file in it."""
    parts = [base.rstrip("/")] if base else []
    parts += ["clients", tenant, source, table]
    if run_date:
        parts.append(f"run_date={run_date}")
    if file:
        parts.append(file + (".gz" if compress and not file.endswith(".gz") else ""))
    return "/".join(parts)


def with_layout(df: DataFrame, path: str = "path") -> DataFrame:
    """Tenant, source, table, run date and file name of a landing path (null when it is not one)."""
    def part(group: int) -> Column:
        found = F.regexp_extract(F.col(path), LAYOUT, group)
        return F.when(F.regexp_like(F.col(path), F.lit(LAYOUT)), found)

    return df.withColumns({name: part(i + 1) for i, name in enumerate(LAYOUT_FIELDS)})


def with_source_table(df: DataFrame, file: str = "file") -> DataFrame:
    """Source and table of ``prefix_table.jsonl`` names; both null when there is no underscore.

    Rows with a null source are the rejects; :func:`split_rejects` sets them apart.
    """
    stem = F.replace(F.element_at(F.split(F.col(file), "/"), -1), F.lit(".jsonl"), F.lit(""))
    cut = F.locate("_", stem)
    prefix = F.substring(stem, F.lit(1), cut - 1)
    source = prefix
    for group, short in SOURCE_GROUPS.items():
        if group != short:
            source = F.when(prefix == short, F.lit(group)).otherwise(source)
    named = cut > 0
    return df.withColumns({"source": F.when(named, source),
                           "table": F.when(named, F.substring(stem, cut + 1, F.length(stem)))})


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by whether a source was recognised."""
    return df.filter(F.col("source").isNotNull()), df.filter(F.col("source").isNull())


def _text(spark: SparkSession, path: str, pattern: str | None, recursive: bool = True) -> DataFrame:
    """Lines with their file, the start of their split and ids that ascend within it."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return with_split(reader.text(path)).withColumn("seq", F.monotonically_increasing_id())


def with_split(text: DataFrame) -> DataFrame:
    """Lines of a text scan or stream with their file and the start of their split."""
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def judged(lines: DataFrame) -> DataFrame:
    """Lines with their parsed document, whether they are records (not blank) and whether they are bad ones."""
    record = F.trim("value") != ""
    return lines.withColumn("record", record).withColumn("record_content", F.when(record, F.try_parse_json("value"))).withColumn(
        "bad", F.col("record") & F.col("record_content").isNull())


def split_summary(lines: DataFrame) -> DataFrame:
    """What one pass over judged lines tells of every split of a file.

    ``first`` id, ``lines``, ``records`` and ``bad`` lines; ``lines_before`` and
    ``records_before`` it in its file; ``first_bad`` line number and the number of
    records before that line in the file; ``file_bad`` lines of its whole file. Lines are
    counted in chunks of ids, and only the blank ones of a chunk are listed, so that
    nothing grows with the file but one row a chunk.
    """
    chunks = lines.groupBy("file", "split", F.floor(F.col("seq") / CHUNK).alias("chunk")).agg(
        F.min("seq").alias("first"), F.count(F.lit(1)).alias("lines"), F.count_if("record").alias("records"),
        F.count_if("bad").alias("bad"), F.min(F.when(F.col("bad"), F.col("seq"))).alias("bad_at"),
        F.collect_list(F.when(~F.col("record"), F.col("seq"))).alias("blank"))
    earlier = Window.partitionBy("file", "split").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    blank_before = F.size(F.filter("blank", lambda at: at < F.col("bad_at")))
    in_split = chunks.withColumn("ahead", F.coalesce(F.sum("records").over(earlier), F.lit(0)) + F.col("bad_at") - F.col("first") - blank_before)
    splits = in_split.groupBy("file", "split").agg(
        F.min("first").alias("first"), F.sum("lines").alias("lines"), F.sum("records").alias("records"), F.sum("bad").alias("bad"),
        F.min("bad_at").alias("bad_at"), F.min_by("ahead", "bad_at").alias("ahead"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumns({
        "lines_before": F.coalesce(F.sum("lines").over(before), F.lit(0)),
        "records_before": F.coalesce(F.sum("records").over(before), F.lit(0)),
        "file_bad": F.sum("bad").over(Window.partitionBy("file"))})
    return placed.withColumns({
        "first_bad": F.col("bad_at") - F.col("first") + F.col("lines_before") + 1,
        "records_ahead": F.col("records_before") + F.col("ahead")}).drop("bad_at", "ahead")


def numbered(lines: DataFrame, summary: DataFrame) -> DataFrame:
    """Lines of the summary's splits with their number in the file.

    A line's number is its distance from the first id of its split plus the lines of the
    file's earlier splits: the lines are not sorted, and a large file is numbered by as
    many tasks as it has splits.
    """
    offsets = summary.select(F.col("file").alias("__file"), F.col("split").alias("__split"),
                             (F.col("lines_before") - F.col("first") + 1).alias("__offset"))
    placed = lines.join(offsets, (F.col("file") == F.col("__file")) & (F.col("split") == F.col("__split")))
    return placed.withColumn("line_number", F.col("seq") + F.col("__offset")).drop("__file", "__split", "__offset", "split", "seq")


def read_lines(spark: SparkSession, path: str, pattern: str | None = "*.jsonl.gz",
               recursive: bool = True) -> DataFrame:
    """Text lines with file and line number: one scan counts the lines of the splits, one reads them."""
    lines = _text(spark, path, pattern, recursive)
    plain = lines.withColumns({"record": F.lit(True), "bad": F.lit(False)})
    return numbered(lines, split_summary(plain)).select("value", "file", "line_number")


def validation(summary: DataFrame) -> DataFrame:
    """One row per file: valid or not, first bad line, number of records.

    Blank lines are skipped, a file without records is invalid, and the record count
    of an invalid file is that of the lines before its first bad one.
    """
    files = summary.groupBy("file").agg(
        F.min("first_bad").alias("first_bad_line"), F.sum("records").alias("__records"),
        F.min_by("records_ahead", "first_bad").alias("__ahead"))
    return files.select(
        "file", ((F.col("__records") > 0) & F.col("first_bad_line").isNull()).alias("is_valid"), "first_bad_line",
        F.when(F.col("first_bad_line").isNull(), F.col("__records")).otherwise(F.col("__ahead")).alias("n_records"))


def validate_files(spark: SparkSession, path: str, pattern: str | None = "*.jsonl.gz") -> DataFrame:
    """:func:`validation` of the files below a folder, from a single scan of their text."""
    return validation(split_summary(judged(_text(spark, path, pattern))))


def validate_jsonl(lines: DataFrame) -> DataFrame:
    """:func:`validation` of lines that have a file and a number."""
    return validation(split_summary(judged(lines.select("value", "file", F.lit(0).alias("split"), F.col("line_number").alias("seq")))))


ON_ERROR = ("skip_file", "skip_row", "keep")


def to_landing(lines: DataFrame, on_error: str = "skip_file") -> DataFrame:
    """Judged lines as landing rows: file, row number, ingest time, document.

    ``skip_file`` drops every row of a file that holds a bad line, ``skip_row`` only
    the bad ones, ``keep`` lands them with a null document.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"unknown on_error {on_error!r}")
    skip_file = on_error == "skip_file"
    summary = split_summary(lines if skip_file else lines.withColumn("bad", F.lit(False)))
    rows = numbered(lines, summary.filter("file_bad = 0") if skip_file else summary)
    wanted = F.col("record") & ~F.col("bad") if on_error == "skip_row" else F.col("record")
    return rows.filter(wanted).select(
        F.col("file").alias("metadata_filename"), F.col("line_number").alias("metadata_row_number"),
        F.current_timestamp().alias("metadata_ingest_time"), "record_content")


def load_raw(spark: SparkSession, path: str, on_error: str = "skip_file",
             pattern: str | None = "*.jsonl.gz") -> DataFrame:
    """Bulk load of JSON-lines files into landing rows: one scan judges the splits, one reads the documents."""
    return to_landing(judged(_text(spark, path, pattern)), on_error)


def listing(spark: SparkSession, base: str, client: str = "*", source: str = "*", table: str = "*", run_date: str = "*") -> DataFrame:
    """Paths of the data files and batch markers below a folder, without reading content.

    File sources hide names that start with an underscore, so the markers, one per
    batch, come from a glob over the batch folders. The patterns narrow both, for
    example to one run date, so that the markers asked for are as many as a run has batches.
    """
    batches = f"{base.rstrip('/')}/clients/{client}/{source}/{table}/run_date={run_date}"
    data = spark.read.format("binaryFile").load(f"{batches}/*").select("path")
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{batches}/{SUCCESS_MARKER}")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    markers = [(status.getPath().toString(),) for status in found or []]
    return data.unionByName(spark.createDataFrame(markers, "path string"))


def promote_complete_batches(files: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """Data files of the batches that have a completion marker.

    ``files`` is a listing with layout columns. Markers and folders are not data.
    """
    batch = ["client", "source", "table", "run_date"]
    marked = (files if markers is None else markers).filter(F.col("file") == SUCCESS_MARKER).select(*batch).distinct()
    data = files.filter((F.col("file") != SUCCESS_MARKER) & (F.col("file") != ""))
    return data.join(marked, batch, "left_semi")


def audit_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, ordered by name; each count is one row, so the sort is tiny."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in frames.items()]
    return union_all(*counts).orderBy("table_name")


def freshness(df: DataFrame, loaded_at: str, now: Column | None = None, where: str | Column | None = None) -> DataFrame:
    """Latest load time against now, as one row with the age in seconds."""
    rows = df if where is None else df.filter(where)
    moment = now if now is not None else F.current_timestamp()
    return rows.agg(F.max(loaded_at).alias("max_loaded_at")).select(
        "max_loaded_at", moment.alias("snapshotted_at"),
        F.timestamp_diff("SECOND", F.col("max_loaded_at"), moment).alias("age_seconds"))
