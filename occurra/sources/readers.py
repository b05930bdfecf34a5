"""Readers for landed source files (unpacked export directories, search pages).

* S1 ``read_tsv_export``      tab-separated export, header required, all text
* S2 ``read_parquet_shards``  every Parquet shard under a directory
* S3 ``member_listing``       file listing without metadata members
* S4 ``largest_text_member``  the largest .csv / .txt member, for exports known to have one table
* S5 ``read_download_export`` format dispatch over S1 / S2
* S6 ``read_search_pages``    JSON search pages -> one row per record

Every reader attaches the scan's file path and split start (``_file``,
``_block``); ``arrival_order`` adds the row position inside the split
(``_row``).  Call it after any filter: ``monotonically_increasing_id`` is
nondeterministic, so Catalyst would not push a filter below it into the scan,
while the position it gives stays increasing in file order after a filter.
Last-wins and first-N logic then never depends on partition order.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurra.functions.expr import ident, lit_sql
from occurra.schema import SEARCH_PAGE_SCHEMA, SEARCH_RECORD_TEXT_SCHEMA
from occurra.sources.records import has_open_lines, physical_lines, read_records

# Member names (lower case) that are never data, and data suffixes.
SKIP_MEMBER_PATTERN = r"citation|rights|metadata|meta\.xml|eml\.xml"
PARQUET_GLOB = "*.{parquet,pq,PARQUET,PQ}"
TEXT_GLOB = "*.{csv,txt,CSV,TXT}"


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an under-partitioned input over the cluster's cores.

    For a scan with narrow steps only, whose number of partitions is known from
    its files.  A gzip'd export or a single-row-group file is one split, which
    would put the whole normalisation in one task; inputs with at least
    ``min_partitions`` splits (default: the default parallelism), as large ones
    have, are returned unchanged.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)


def _folder(spark: SparkSession, root: str) -> str:
    """The path of ``root`` without scheme and host, as the file system resolves it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(conf).makeQualified(path).toUri().getPath().rstrip("/")


def _keep_member(path_col: str, folder: str) -> str:
    """Whether a file's path below ``folder`` names data (SQL text)."""
    path = f"regexp_replace({path_col}, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', '')"
    below = f"regexp_extract({path}, '[^/]*$', 0)"
    for form in dict.fromkeys((folder, quote(folder))):  # paths may come percent-encoded
        below = f"case when startswith({path}, {lit_sql(form + '/')}) then substring({path}, {len(form) + 1}) else {below} end"
    return f"not (lower({below}) rlike {lit_sql(SKIP_MEMBER_PATTERN)})"


def _with_source(df: DataFrame) -> DataFrame:
    """File path and split start of every row (deterministic metadata)."""
    return df.selectExpr(
        "*", "_metadata.file_path as _file", "_metadata.file_block_start as _block"
    )


def arrival_order(df: DataFrame) -> DataFrame:
    """Add ``_row`` (position inside the file split) and spread one-split inputs.

    Must run on the scan's own partitions (after filters, before any
    shuffle), so (``_file``, ``_block``, ``_row``) is the file order.  Rows that
    have their place already, as records put together from lines do, keep it.
    """
    if "_row" in df.columns:
        return spread(df)
    return spread(df.selectExpr("*", "monotonically_increasing_id() as _row"))


def member_listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """S3: (path, length) of data members under ``root`` matching ``glob``.

    Only file metadata is read (the binary content column is pruned).
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )
    return files.filter(_keep_member("path", _folder(spark, root)))


def largest_text_member(spark: SparkSession, root: str) -> str | None:
    """The largest .csv / .txt member (ties: the greater path). One row."""
    row = (
        member_listing(spark, root, TEXT_GLOB)
        .orderBy(F.desc("length"), F.desc("path"))
        .select("path")
        .first()
    )
    return None if row is None else row[0]


def text_members(spark: SparkSession, root: str) -> list[str]:
    """The .csv / .txt data members under ``root``, sorted; file names only."""
    return sorted(r["path"] for r in member_listing(spark, root, TEXT_GLOB).select("path").collect())


TEXT_OPTIONS = {
    "sep": "\t", "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE",
    "inferSchema": "false", "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_tsv_export(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """Tab-separated files with one header, UTF-8, every value text.

    Quoted fields may hold line breaks.  By default the lines are looked at
    first: if a record goes on over a line break, records are put together from
    the lines (``sources.records``; files stay splittable), else every line is
    a record.  ``multi_line`` saves that look: ``False`` promises that no field
    holds a line break, ``True`` reads each file as one split.  A file whose
    header differs from the first file's fails the read.
    """
    options = {**TEXT_OPTIONS, "multiLine": str(bool(multi_line)).lower()}
    df = spark.read.options(**options).csv(path)
    if not df.columns or all(c.startswith("_c") for c in df.columns):
        raise ValueError(f"{path!r} doesn't begin with column names")
    if multi_line is None:
        lines = physical_lines(spark, path)
        if has_open_lines(lines):
            return read_records(lines, df.columns)
    return _with_source(df)


def read_parquet_shards(spark: SparkSession, root: str, merge_schema: bool = True) -> DataFrame:
    """Every .parquet / .pq shard under ``root`` except metadata
    members, typed as stored, with arrival order (shard path, split, row)."""
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
        .option("mergeSchema", str(bool(merge_schema)).lower())
        .parquet(root)
    )
    # a filter on the file-path metadata column prunes whole files at planning
    return _with_source(df.filter(_keep_member("_metadata.file_path", _folder(spark, root))))


def _exists(spark: SparkSession, root: str, glob: str) -> bool:
    try:
        return member_listing(spark, root, glob).limit(1).count() > 0
    except Exception as exc:  # no matching files -> Spark raises at load
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return False
        raise


def read_download_export(
    spark: SparkSession, root: str, prefer_parquet: bool = False, only_largest: bool = False, multi_line: bool | None = None
) -> DataFrame:
    """Parquet shards when preferred and present; else all text members;
    else Parquet shards anyway; else ``ValueError``.

    ``only_largest`` reads just the largest text member (S4); ``multi_line`` is
    that of :func:`read_tsv_export`.
    """
    has_parquet = _exists(spark, root, PARQUET_GLOB)
    if prefer_parquet and has_parquet:
        return read_parquet_shards(spark, root)
    members = text_members(spark, root) if _exists(spark, root, TEXT_GLOB) else []
    if members:
        return read_tsv_export(spark, largest_text_member(spark, root) if only_largest else members, multi_line)
    if has_parquet:
        return read_parquet_shards(spark, root)
    raise ValueError(f"{root!r} holds neither Parquet nor text tables")


def parse_search_records(df: DataFrame, record: str = "_record") -> DataFrame:
    """Record fields of the JSON text in ``record``, which stays, and all other columns.

    A record is parsed once: it comes from a generator, below which no later
    filter on its fields is pushed (there the parse, and the record's making,
    would be repeated for every mention of a field).  ``_count_type`` is the JSON
    type of ``individualCount``, as a number and a text of the same digits count
    differently.
    """
    fields = ", ".join(
        f"{ident(f.name)} {'variant' if f.name == 'individualCount' else f.dataType.simpleString()}"
        for f in SEARCH_RECORD_TEXT_SCHEMA.fields
    )
    names = [
        "try_variant_get(_rec.individualCount, '$', 'string') as individualCount" if f.name == "individualCount"
        else f"_rec.{ident(f.name)} as {ident(f.name)}"
        for f in SEARCH_RECORD_TEXT_SCHEMA.fields
    ]
    rest = [ident(c) for c in df.columns if c != record]
    once = f"explode(array(from_json({ident(record)}, {lit_sql(fields)}))) as _rec"
    return df.selectExpr(once, f"{ident(record)} as _record", *rest).selectExpr(
        *names, "schema_of_variant(_rec.individualCount) as _count_type", "_record", *rest
    )


def _pages(spark: SparkSession, root: str, schema, multi_line: bool) -> DataFrame:
    return (
        spark.read.schema(schema).option("multiLine", str(bool(multi_line)).lower()).option("basePath", root).json(root)
        .withColumn("day", F.col("day").cast("date"))
    )


def page_envelopes(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """(day, offset, ends, records) of the landed pages; no record is read, they are only counted."""
    schema = "offset bigint, endOfRecords boolean, results array<struct<_none: string>>"
    return _pages(spark, root, schema, multi_line).selectExpr(
        "day", "offset", "coalesce(endOfRecords, false) as ends", "coalesce(size(results), 0) as records"
    )


def _stops(envelopes: DataFrame) -> DataFrame:
    """One row per day: the offset of the page that ended the day's paging."""
    return envelopes.filter("ends or records = 0").groupBy("day").agg(F.min("offset").alias("_stop"))


def page_gaps(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """(day, missing_from, missing_to) of offsets that no landed page has, up to each day's stop.

    A day without a stop isn't complete: its last row has no ``missing_to``.
    """
    envelopes = page_envelopes(spark, root, multi_line)
    stops = _stops(envelopes)
    pages = envelopes.join(stops, "day", "left").filter("_stop is null or offset <= _stop")
    by_day = Window.partitionBy("day").orderBy("offset", "records")
    reach = F.coalesce(F.max(F.col("offset") + F.col("records")).over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    holes = pages.withColumn("missing_from", reach).filter("offset > missing_from").selectExpr(
        "day", "missing_from", "offset - 1 as missing_to"
    )
    open_days = pages.filter("_stop is null").groupBy("day").agg(F.max(F.col("offset") + F.col("records")).alias("missing_from"))
    return holes.unionByName(open_days.selectExpr("day", "missing_from", "cast(null as bigint) as missing_to"))


def read_search_pages(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """Landed search pages -> one row per record, in arrival order.

    Pages are JSON documents under ``root/day=YYYY-MM-DD/``.  Paging of a day
    stops at the first page flagged ``endOfRecords`` or with no results;
    later pages of that day are ignored.  Output: the record fields, the whole
    record as it was (``_record``), ``_request_day``, ``_offset`` and ``_pos``
    (position in the page).  The stops come from the pages' envelopes alone.
    """
    stops = _stops(page_envelopes(spark, root, multi_line))
    pages = _pages(spark, root, SEARCH_PAGE_SCHEMA, multi_line)
    fetched = pages.join(stops, "day", "left").filter("_stop is null or offset <= _stop")
    records = fetched.selectExpr(
        "day as _request_day", "offset as _offset", "posexplode(results) as (_pos, _record)"
    )
    return parse_search_records(records)
