"""Records of delimited text files whose quoted fields hold line breaks.

The files stay splittable: they are read line by line, and which line breaks end
a record follows from the quotes before them.  A line is a map between two
states, outside and inside a quoted field; of the four maps there are, one keeps
the state, two set it and one turns it.  So the state before a line is the last
one that was set, turned as often as there were turning lines since: a prefix
sum per split, and another one over the splits of a file, whose rows are one per
split.

Only lines that keep the state can be without a quote, so just the others are
sorted; and only the lines of records that hold line breaks are shuffled with
their text, to be put together again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurra.functions.expr import ident, lit_sql

#: Lines of one record; more of them are a stray quote, and the read fails.
MAX_RECORD_LINES = 100_000
SPLIT = ["_file", "_block"]


def physical_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_file, _block, _row, line) of text files; a carriage return at a line's end stays."""
    return (
        spark.read.option("lineSep", "\n").text(path)
        .selectExpr("_metadata.file_path as _file", "_metadata.file_block_start as _block", "value as line")
        .selectExpr("_file", "_block", "monotonically_increasing_id() as _row", "line")
    )


def _closes(text: str) -> str:
    """Whether a quoted field ends in ``text``: a quote is left when the doubled ones are taken out."""
    return f"contains(replace({text}, '\"\"', ''), '\"')"


def open_after_sql(line: str, inside: bool, sep: str = "\t") -> str:
    """Whether a line ends inside a quoted field if it begins outside (or inside) one.

    A field is quoted if it begins with a quote; a quote elsewhere in a field is
    a character like others.
    """
    step = (
        f"(open, x) -> case when open then not {_closes('x')} "
        f"when startswith(x, '\"') then not {_closes('substring(x, 2)')} else false end"
    )
    start = "true" if inside else "false"
    return f"case when contains({line}, '\"') then aggregate(split({line}, {lit_sql(sep)}), {start}, {step}) else {start} end"


def has_open_lines(lines: DataFrame, sep: str = "\t") -> bool:
    """Whether any line that begins outside a quoted field ends inside one.

    If none does, no record has a line break: every file begins outside.
    """
    return not lines.filter("contains(line, '\"')").filter(open_after_sql("line", False, sep)).select("_row").isEmpty()


def _turned(last, turns_since):
    """The state set last, turned as often as given."""
    return (last.cast("int") + turns_since) % 2 == 1


def _states(maps: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Adds ``before`` and ``after`` (inside a quoted field?) for a partition that begins outside,
    and ``turned_before`` and ``turned_after`` for one that begins inside."""
    upto = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sets, turns = F.col("to_out") == F.col("to_in"), F.col("to_out") & ~F.col("to_in")
    rows = maps.withColumn("turns", F.coalesce(F.sum(turns.cast("int")).over(upto), F.lit(0)))
    mark = F.when(sets, F.struct(F.col("to_out").alias("state"), F.col("turns").alias("turns")))
    rows = rows.withColumn("last", F.last(mark, ignorenulls=True).over(upto))
    for name, start in (("before", False), ("turned_before", True)):
        began = F.coalesce(F.col("last.state"), F.lit(start))
        rows = rows.withColumn(name, _turned(began, F.col("turns") - F.coalesce(F.col("last.turns"), F.lit(0))))
    pick = lambda c: F.when(F.col(c), F.col("to_in")).otherwise(F.col("to_out"))
    return rows.withColumn("after", pick("before")).withColumn("turned_after", pick("turned_before"))


def broken_records(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """(_file, _block, first, last, start_block, start_row): runs of lines that belong to records with line breaks.

    A run lies in one split; a record's runs have the place of its first line.
    """
    maps = lines.selectExpr(
        "_file", "_block", "_row", f"{open_after_sql('line', False, sep)} as to_out", f"{open_after_sql('line', True, sep)} as to_in"
    ).filter("to_out or not to_in")  # lines that keep the state play no part
    marked = _states(maps, SPLIT, ["_row"])
    bounds = lines.groupBy(*SPLIT).agg(F.min("_row").alias("low"), F.max("_row").alias("high"))
    whole = marked.groupBy(*SPLIT).agg(
        F.max_by("after", "_row").alias("to_out"), F.max_by("turned_after", "_row").alias("to_in")
    )
    # a row per split: what the splits before leave behind
    splits = bounds.join(whole, SPLIT, "left").withColumn("to_out", F.coalesce("to_out", F.lit(False)))
    splits = splits.withColumn("to_in", F.coalesce("to_in", F.lit(True)))
    carried = _states(splits, ["_file"], ["_block"]).select(*SPLIT, "low", "high", F.col("before").alias("inside"))

    events = marked.join(carried, SPLIT).select(
        *SPLIT, "_row", "low", "high", "inside",
        F.when(F.col("inside"), F.col("turned_before")).otherwise(F.col("before")).alias("b"),
        F.when(F.col("inside"), F.col("turned_after")).otherwise(F.col("after")).alias("a"),
    ).filter("b <> a")  # a record with line breaks begins, or ends
    following = F.lead("_row").over(Window.partitionBy(*SPLIT).orderBy("_row"))
    begun = events.withColumn("until", F.coalesce(following, "high")).filter("a")
    own = begun.select(
        *SPLIT, F.col("_row").alias("first"), F.col("until").alias("last"),
        F.col("_block").alias("start_block"), F.col("_row").alias("start_row"),
    )
    # what a split begins with, if it begins inside a record, goes to the last record begun before it
    ends = events.groupBy(*SPLIT).agg(F.min("_row").alias("closed"))
    begins = begun.groupBy(*SPLIT).agg(F.max("_row").alias("begun"))
    place = F.when(F.col("begun").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("begun").alias("row")))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = carried.join(ends, SPLIT, "left").join(begins, SPLIT, "left").withColumn(
        "start", F.last(place, ignorenulls=True).over(earlier)
    ).filter("inside and start is not null")
    rest = heads.select(
        *SPLIT, F.col("low").alias("first"), F.coalesce("closed", "high").alias("last"),
        F.col("start.block").alias("start_block"), F.col("start.row").alias("start_row"),
    )
    return own.unionByName(rest)


def read_records(lines: DataFrame, columns: list[str], sep: str = "\t", max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """One row per record with the text columns, and ``_file``, ``_block``, ``_row`` of its first line.

    ``lines`` come from :func:`physical_lines`.  Every file's first record is its
    header; one that differs from ``columns`` fails, as does a record of more
    than ``max_lines`` lines.  Empty lines between records are no records.
    """
    runs = broken_records(lines, sep)
    longest = runs.groupBy("_file", "start_row").agg(F.sum(F.expr("last - first + 1")).alias("n")).agg(F.max("n")).first()[0]
    if (longest or 0) > max_lines:
        raise ValueError(f"a record has {longest} lines, more than {max_lines}: a quote that opens a field is not closed")
    member = runs.select(F.explode(F.sequence("first", "last")).alias("_row"), "start_block", "start_row")
    single = lines.join(member, "_row", "left_anti").select(*SPLIT, "_row", F.col("line").alias("record"))
    parts = lines.join(member, "_row").groupBy("_file", "start_block", "start_row").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(_block, _row, line))), x -> x.line), '\n')").alias("record")
    )
    joined = parts.select("_file", F.col("start_block").alias("_block"), F.col("start_row").alias("_row"), "record")
    records = single.unionByName(joined).withColumn("record", F.expr("rtrim('\\r', record)"))
    records = records.filter("record <> ''")

    schema = ", ".join(f"{ident(c)} string" for c in columns)
    options = {
        "sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    parsed = records.select(*SPLIT, "_row", F.from_csv("record", schema, options).alias("fields"))
    # a file's first line with anything in it, in the split that begins the file
    heads = lines.filter("_block = 0 and rtrim('\r', line) <> ''").groupBy("_file").agg(F.min("_row").alias("_row"))
    placed = parsed.join(heads.withColumn("is_header", F.lit(True)), ["_file", "_row"], "left")
    found, names = F.array(*[F.col("fields")[c] for c in columns]), F.array(*[F.lit(c) for c in columns])
    differs = F.raise_error(F.concat(F.lit("the header of "), F.col("_file"), F.lit(" differs from the first file's")))
    header = F.when(F.col("is_header"), F.when(found == names, True).otherwise(differs.cast("boolean"))).otherwise(False)
    return placed.filter(~header).select(*[F.col("fields")[c].alias(c) for c in columns], *SPLIT, "_row")
