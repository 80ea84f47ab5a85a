"""Reading and checking files: quarantine, budgets, listings, checksums, page tables, observation keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import number_in, squeezed


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Gzip or plain JSON lines under a fixed schema; a record that does not fit fails the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def file_name(depth: int = 1) -> Column:
    """The last `depth` parts of a file's path: more than one where folders tell files of one name apart."""
    return F.array_join(F.slice(F.split("path", "/"), -depth, depth), "/")


def verified_contents(spark: SparkSession, path: str, digests: DataFrame, depth: int = 1) -> DataFrame:
    """(name, actual, content, reason): files whose SHA-256 is not the listed one have a reason and no content.

    digests: name, digest."""
    j = spark.read.format("binaryFile").load(path).select(file_name(depth).alias("name"), "content", F.sha2("content", 256).alias("actual")).join(digests, "name", "left")
    reason = F.when(F.col("digest").isNull(), "not listed").when(F.col("digest") != F.col("actual"), "checksum differs")
    return j.select("name", "actual", F.when(reason.isNull(), F.col("content")).alias("content"), reason.alias("reason"))


def decoded(content: str, force: bool = False) -> Column:
    """UTF-8, or Windows-1252 where bytes are not UTF-8 (or with force): Latin-1 with the signs of 0x80 to 0x9F put in."""
    signs = {chr(k): bytes([k]).decode("cp1252", "ignore") for k in range(0x80, 0xA0)}
    signs = {k: v for k, v in signs.items() if v}
    western = F.translate(F.decode(content, "ISO-8859-1"), "".join(signs), "".join(signs.values()))
    if force:
        return western
    return F.when(F.is_valid_utf8(F.col(content).cast("string")), F.col(content).cast("string")).otherwise(western)


def numbered_lines(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """(file, line_no, line): each file's lines with their numbers; a byte order mark is dropped."""
    raw = spark.read.format("binaryFile").load(path).select(file_name(depth).alias("file"), decoded("content").alias("t"))
    return raw.select("file", F.posexplode(F.split(F.regexp_replace("t", "^\\x{FEFF}", ""), "\r?\n")).alias("line_no", "line")).where("line <> ''")


def parse_reports(lines: DataFrame, marker: str, columns: int, budget: float = 0.01, head: int = 10) -> tuple[DataFrame, DataFrame]:
    """(rows, files) of delimited reports from (file, line_no, line).

    The header is the first line within `head` that holds the marker column; repeats of it are dropped. A row with
    another number of fields or an odd number of quotes is bad; a file is rejected if it has no header or more bad
    rows than int(rows * budget)."""
    is_head = F.array_contains(F.transform(F.split("line", ","), lambda x: F.trim(x)), marker)
    first = lines.where(is_head & (F.col("line_no") < head)).groupBy("file").agg(F.min("line_no").alias("head_no"))
    body = lines.join(first, "file").where(F.col("line_no") > F.col("head_no")).where(~is_head)
    quotes = F.length(F.regexp_replace("line", '[^"]', ""))
    fields = F.size(F.split("line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    bad = (quotes % 2 == 1) | F.col("line").rlike('(^|,)"[^"]*"[^,"]') | (fields != columns)
    marked = body.withColumn("bad", bad)
    per = marked.groupBy("file").agg(F.count_if("bad").alias("bad_rows"), F.count("*").alias("n"))
    files = lines.select("file").distinct().join(per, "file", "left")
    status = F.when(F.col("n").isNull(), "no header").when(F.col("bad_rows") > F.floor(F.col("n") * budget), "rejected").otherwise("parsed")
    files = files.withColumn("status", status)
    rows = marked.where("not bad").join(files.where("status = 'parsed'").select("file"), "file", "left_semi")
    return rows.select("file", "line_no", F.transform(F.split("line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda x: F.trim(F.regexp_replace(x, '^"|"$', ""))).alias("fields")), files


def accepted_files(rows: DataFrame, bad: Column, file: str = "file", budget: float = 0.01) -> DataFrame:
    """(file, good, bad, accepted): whether bad rows stay within int((good + bad) * budget)."""
    g = rows.groupBy(file).agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    return g.withColumn("accepted", F.col("bad") <= F.floor((F.col("good") + F.col("bad")) * budget))


def parse_listing(spark: SparkSession, path: str) -> DataFrame:
    """(name, size, modified, fault) of the file nodes of XML directory listings."""
    raw = spark.read.format("xml").option("rowTag", "file").schema("name string, size long, modified long").load(path)
    name = F.url_decode("name")
    fault = F.when(F.col("name").isNull() | (name == ""), "no name").when(name.contains("..") | name.startswith("/"), "path leaves the folder").when(F.col("modified").isNull(), "no time")
    return raw.select(name.alias("name"), "size", F.timestamp_seconds("modified").alias("modified"), fault.alias("fault"))


def page_rows(pages: DataFrame, html: str = "html", row: str = "(?s)<li[^>]*>(.*?)</li>") -> DataFrame:
    """(all columns but html, row_no, link, label): table rows of pages, with links and squeezed labels."""
    rest = [c for c in pages.columns if c != html]
    each = pages.select(*rest, F.posexplode(F.regexp_extract_all(html, F.lit(row), 1)).alias("row_no", "cell"))
    return each.select(*rest, "row_no", F.regexp_extract("cell", 'href="([^"]*)"', 1).alias("link"), squeezed(F.regexp_replace("cell", "<[^>]*>", " ")).alias("label"))


def advertised_range(text: Column) -> dict[str, Column]:
    """The numbers of "Showing a to b of n"."""
    pattern = r"Showing ([0-9,]+) to ([0-9,]+) of ([0-9,]+)"
    return {k: number_in(text, pattern, i) for i, k in enumerate(("first", "last", "total"), 1)}


def roster_pages(pages: DataFrame, html: str = "html", cells: int = 5, most: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(rows, pages) of a listing's pages: the other columns of `pages` come along.

    rows: row_no, result_id (from the link that opens a record), name, entity, owner, birth, end_date. pages: first, last,
    total (the advertised range), fault. A fault refuses all rows of its page: a server error (told by its class only,
    as its text can hold rows), no range, an implausible one, other than `cells` cells, a row without an id, an end date
    that is none, fewer rows than the range. Rows are table rows with such a link."""
    rest = [c for c in pages.columns if c != html]
    plain = lambda x: squeezed(unescaped(F.regexp_replace(x, "<[^>]*>", " ")))
    said = squeezed(F.regexp_replace(html, "<[^>]*>", " "))
    p = pages.withColumns({"_said": said, **{k: v for k, v in advertised_range(said).items()}})
    tr = F.filter(F.regexp_extract_all(html, F.lit("(?s)<tr[^>]*>(.*?)</tr>"), 1), lambda x: x.rlike(r"javascript:open\("))
    parsed = F.transform(tr, lambda x: F.struct(
        F.regexp_extract(x, r"javascript:open\('([^']*)'\)", 1).alias("result_id"),
        F.transform(F.regexp_extract_all(x, F.lit("(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), plain).alias("cells"),
    ))
    p = p.withColumn("_rows", parsed)
    end = lambda r: F.get(r["cells"], cells - 1)
    broken = F.regexp_extract("_said", r"\b((?:[a-z]\w*\.)+[A-Z]\w*(?:Exception|Error))\b", 1)
    no_range = F.col("total").isNull()
    fault = (
        F.when(no_range & F.col("_said").contains("An abnormal error occur"), F.concat(F.lit("server error: "), F.coalesce(F.nullif(broken, F.lit("")), F.lit("unknown"))))
        .when(no_range, "range missing")
        .when((F.col("total") < 1) | (F.col("total") > most) | (F.col("first") < 1) | (F.col("first") > F.col("last")) | (F.col("last") > F.col("total")), "implausible range")
        .when(F.exists("_rows", lambda r: F.size(r["cells"]) != cells), "columns changed")
        .when(F.exists("_rows", lambda r: (r["result_id"] == "") | (F.get(r["cells"], 1) == "")), "identifier missing")
        .when(F.exists("_rows", lambda r: (end(r) != "") & F.try_to_timestamp(end(r), F.lit("MM/dd/yyyy")).isNull()), "end date not recognised")
        .when(F.size("_rows") < F.col("last") - F.col("first") + 1, "fewer rows than the range")
    )
    p = p.withColumn("fault", fault)
    each = p.where("fault IS NULL").select(*rest, F.posexplode("_rows").alias("row_no", "r"))
    named = {n: F.get("r.cells", F.lit(i)).alias(n) for i, n in enumerate(("name", "entity", "owner", "birth"))}
    last = F.try_to_timestamp(F.nullif(F.get("r.cells", F.lit(cells - 1)), F.lit("")), F.lit("MM/dd/yyyy")).cast("date")
    return each.select(*rest, "row_no", "r.result_id", *named.values(), last.alias("end_date")), p.select(*rest, "first", "last", "total", "fault")


def unescaped(text: Column) -> Column:
    """The five character references that tables of text use."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def file_family(directory: Column, name: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The family of the first rule (directory, name pattern, family) that fits; null if none does."""
    out = F.lit(None).cast("string")
    for d, pattern, family in reversed(rules):
        out = F.when((directory == d) & name.rlike(pattern), family).otherwise(out)
    return out


def key_faults(source: Column, slot: Column) -> Column:
    """Why an observation key is not valid, or null: source names and quarter-hour boundaries."""
    return F.when(~source.rlike("^[a-z][a-z0-9_-]*$"), "source name").when((F.minute(slot) % 15 != 0) | (F.second(slot) != 0), "not a quarter hour")


def population_points(points: DataFrame, source: str, slot: str = "slot") -> DataFrame:
    """A source's observations in order of their slots, point columns only: other columns aren't read."""
    return points.where(F.col("source") == source).select("source", slot, "observed_at", "population").orderBy(slot)


def deduplicated_bytes(blobs: DataFrame, content: str) -> DataFrame:
    """(digest, copies, size) of contents, each stored once."""
    return blobs.groupBy(F.sha2(F.col(content).cast("binary"), 256).alias("digest")).agg(F.count("*").alias("copies"), F.max(F.octet_length(content)).cast("long").alias("size"))


def catalogue_totals(listed: DataFrame, by: str, due: Column) -> DataFrame:
    """Per group of listed files (status, quarantined rows, archived or not): listed, archived, parsed and unsupported
    files, quarantined rows, and files that are due."""
    n = {"archived": F.col("archived"), "parsed": F.col("status") == "parsed", "unsupported": F.col("status") == "unsupported", "pending": due}
    return listed.groupBy(by).agg(F.count("*").alias("listed"), *[F.count_if(c).alias(k) for k, c in n.items()], F.sum("quarantined").alias("quarantined"))


def latest_per_date(summaries: DataFrame, date: str, order: str) -> DataFrame:
    w = Window.partitionBy(date).orderBy(F.desc(order))
    return summaries.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def with_provenance(points: DataFrame, application: str, build: str, parsers: dict[str, str]) -> DataFrame:
    """Application, build and the source's parser version on every observation."""
    p = points.sparkSession.createDataFrame(list(parsers.items()), "source string, parser_version string")
    return points.join(F.broadcast(p), "source", "left").withColumns({"application": F.lit(application), "build": F.lit(build)})
