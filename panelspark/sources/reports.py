"""Delimited report files read in splits: records that quotes carry over lines, quarantine, headings, budgets.

A line's end is inside a quoted field or not; what a line does to that is one of four functions of how it began: to
inside, to outside, unchanged, or swapped. How each line begins then follows from the last line that sets it and the
number of swaps since, first between splits, then within each: no file is held whole, and none is read by one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import decoded, file_name
from .shared import stored

# a field without quotes around it may hold some; a quoted one holds them doubled
FIELD, INNER = r'(?:"(?:[^"]|"")*"|[^",][^,]*|)', r'(?:[^"]|"")*'
OPEN = f"{FIELD}(?:,{FIELD})*"
#: Rows among which the heading is looked for.
HEAD = 10
DONE, GOES_ON, BROKEN = 0, 1, 2


def split_lines(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """(file, split, i, line): lines of text files with the offset of the split that they lie in and a number that
    grows in it. Files that aren't UTF-8 throughout are Windows-1252; a byte order mark is dropped. Lines end with a
    line feed; a carriage return before it stays with the line."""
    raw = spark.read.text(path, lineSep="\n").select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("i"))
    raw = raw.withColumn("path", F.url_decode("file_path")).select(file_name(depth).alias("file"), "split", "i", F.col("value").cast("binary").alias("bytes"))
    western = raw.groupBy("file").agg((~F.bool_and(F.is_valid_utf8(F.col("bytes").cast("string")))).alias("western"))
    first = Window.partitionBy("file", "split").orderBy("i")
    both = raw.join(western, "file").withColumn("_n", F.row_number().over(first))
    line = F.when(F.col("western"), decoded("bytes", force=True)).otherwise(F.col("bytes").cast("string"))
    mark = (F.col("split") == 0) & (F.col("_n") == 1)
    return both.select("file", "split", "i", F.when(mark, F.regexp_replace(line, "^\\x{FEFF}", "")).otherwise(line).alias("line"))


def ends(line: Column, inside: bool) -> Column:
    """What a line comes to that begins outside or inside a quoted field: a record's end, more lines, or a fault."""
    head = f'{INNER}"(?:,{OPEN})?' if inside else OPEN
    more = f'{INNER}|{INNER}"(?:,{FIELD})*,"{INNER}' if inside else f'(?:{FIELD},)*"{INNER}'
    return F.when(line.rlike(f"^(?s:{head})$"), DONE).when(line.rlike(f"^(?s:{more})$"), GOES_ON).otherwise(BROKEN)


def with_past(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """df (sets: null or the state that a row sets, swap: 0 or 1) with the swaps before each row and the last setting row
    before it."""
    w = Window.partitionBy(*by).orderBy(order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_s", F.coalesce(F.sum("swap").over(past), F.lit(0)))
    df = df.withColumn("_mark", F.when(F.col("sets").isNotNull(), F.struct(F.col("sets").alias("to"), F.col("_s").alias("s"))))
    return df.withColumn("_last", F.last("_mark", ignorenulls=True).over(past))


def state(mark: str, swaps: Column, start: Column) -> Column:
    """The state after `swaps` swaps in all, of which some came before the last setting row."""
    odd = lambda x: x % 2 == 1
    return F.when(F.col(mark).isNull(), start != odd(swaps)).otherwise(F.col(f"{mark}.to") != odd(swaps - F.col(f"{mark}.s")))


def records(lines: DataFrame) -> DataFrame:
    """(file, at, lines, fault, record): records of (file, split, i, line) in order of `at`.

    A record is faulty where text follows a closing quote, and ends there; reading goes on with the next line. A quote
    that is never closed makes a faulty record of all that follows. Of faulty records no text is gathered, and whole
    lines, which most records are, aren't shuffled again. Lines with what they do are stored once in the shared folder."""
    bare = F.regexp_replace("line", "\r$", "")
    f = lines.withColumns({"out": ends(bare, False), "in": ends(bare, True)})
    a, b = F.col("out") == GOES_ON, F.col("in") == GOES_ON
    f = stored(with_past(f.withColumns({"sets": F.when(a == b, a), "swap": F.when(a & ~b, 1).otherwise(0)}), ["file", "split"], "i"), "report_lines")
    per = f.groupBy("file", "split").agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("i"))).alias("m"), F.sum("swap").alias("all"))
    per = per.select("file", "split", F.when(F.col("m").isNotNull(), state("m", F.col("all"), F.lit(False))).alias("sets"), F.when(F.col("m").isNull(), F.col("all") % 2).otherwise(0).alias("swap"))
    entry = with_past(per, ["file"], "split").select("file", "split", state("_last", F.col("_s"), F.lit(False)).alias("entry"))  # a row per split
    inside = state("_last", F.col("_s"), F.col("entry"))
    own = Window.partitionBy("file", "split").orderBy("i")
    g = f.join(entry, ["file", "split"]).withColumn("inside", inside).withColumn("end", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")))
    start = F.when(~F.col("inside"), F.struct("split", "i"))
    g = g.withColumn("start", start).withColumn("at", F.last("start", ignorenulls=True).over(own))
    carried = g.groupBy("file", "split").agg(F.max("start").alias("last"))
    carried = carried.withColumn("carry", F.last("last", ignorenulls=True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))).drop("last")  # a row per split
    g = g.join(carried, ["file", "split"]).select("file", "split", "i", "line", "inside", "end", F.coalesce("at", "carry").alias("at"))
    single = ~F.col("inside") & (F.col("end") != GOES_ON)
    whole = g.where(single).select("file", "at", F.lit(1).cast("long").alias("lines"), (F.col("end") == BROKEN).alias("fault"), F.when(F.col("end") == DONE, bare).alias("record"))
    rest = g.where(~single)
    fate = rest.groupBy("file", "at").agg(F.count("*").alias("lines"), (F.max_by("end", F.struct("split", "i")) != DONE).alias("fault"))
    text = rest.join(fate.where("not fault").select("file", "at"), ["file", "at"], "left_semi").groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("split", "i", "line"))).alias("l"))
    text = text.select("file", "at", F.regexp_replace(F.array_join(F.col("l.line"), "\n"), "\r$", "").alias("record"))
    return whole.union(fate.join(text, ["file", "at"], "left").select("file", "at", "lines", "fault", "record"))


def fields_of(record: Column) -> Column:
    """The trimmed fields of a sound record."""
    cut = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f"(?s),({FIELD})"), F.lit(1))
    plain = lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.transform(cut, lambda x: F.regexp_replace(plain(x), r"^\s+|\s+$", ""))


def read_reports(spark: SparkSession, path: str, markers: list[str], expected: list[str] | None = None, budget: float = 0.01, depth: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rows, files) of the delimited files at path.

    rows: file, at (in order), values (column name to text). files: file, columns, good, quarantined, status. The heading
    is the first of HEAD rows that aren't blank with one of the marker columns; its repeats are dropped. A row of another
    number of fields is quarantined, as is each line of a faulty record. A file is unsupported with no heading, other
    columns than `expected`, two columns of one name, or more quarantined than int((good + quarantined) * budget); it
    keeps its line in `files` and has no rows."""
    r = records(split_lines(spark, path, depth)).withColumn("fields", fields_of(F.col("record"))).drop("record")
    r = stored(r, "report_records")
    sound = r.where(~F.col("fault") & F.exists("fields", lambda x: x != "")).drop("fault", "lines")
    first = sound.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("at"))).where(F.col("_n") <= HEAD)
    marked = first.where(F.arrays_overlap("fields", F.array(*map(F.lit, markers))))
    heads = marked.groupBy("file").agg(F.min_by("fields", "at").alias("heading"), F.min("at").alias("head_at"))
    named = F.transform("heading", lambda x, i: F.when(x == "", F.concat(F.lit("_unnamed_column_"), (i + 1).cast("string"))).otherwise(x))
    heads = heads.withColumn("columns", named)
    body = sound.join(heads, "file").where((F.col("at") > F.col("head_at")) & (F.col("fields") != F.col("heading")))
    fits = F.size("fields") == F.size("columns")
    counts = body.groupBy("file").agg(F.count_if(fits).alias("good"), F.count_if(~fits).alias("odd"))
    lost = r.groupBy("file").agg(F.coalesce(F.sum(F.when(F.col("fault"), F.col("lines"))), F.lit(0)).alias("lost"))
    quarantined, good = F.coalesce("odd", F.lit(0)) + F.col("lost"), F.coalesce("good", F.lit(0))
    changed = F.lit(False) if expected is None else F.col("heading") != F.array(*map(F.lit, expected))
    twice = F.size(F.array_distinct("columns")) < F.size("columns")
    status = F.when(F.col("heading").isNull(), "no heading").when(changed, "headings changed").when(twice, "ambiguous headings").when(quarantined > F.floor((good + quarantined) * budget), "too many unreadable rows").otherwise("parsed")
    files = lost.join(heads.select("file", "heading", "columns"), "file", "left").join(counts, "file", "left")
    files = files.select("file", "columns", good.alias("good"), quarantined.alias("quarantined"), status.alias("status"))
    rows = body.where(fits).join(files.where("status = 'parsed'").select("file"), "file", "left_semi")
    return rows.select("file", "at", F.map_from_arrays("columns", "fields").alias("values")), files
