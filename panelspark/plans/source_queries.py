"""Sources and sinks (IO)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import panel, points
from ..operators.history import latest_projection
from ..sources import files, layout, publish, reports
from ..sources.shared import shared_folder
from ..sources.views import duck, table, view
from .panel_queries import ENDS, OBSERVED, SPANS, observed_rows
from .registry import query, secs, text

V = view


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, population FROM points WHERE source = 'view' AND slot > TIMESTAMP '2024-01-05' AND slot <= TIMESTAMP '2024-01-20'"))
def io1_scan(spark: SparkSession, d: str) -> DataFrame:
    """A source's slots in a range of time, from folders by source and day."""
    at = lambda t: F.lit(t).cast("timestamp")
    path, p = shared_folder(spark, "days"), V(spark, d, "points")
    layout.write_days(p, path)
    return layout.scan_days(spark, path, p.schema, "view", at("2024-01-05"), at("2024-01-20")).select("source", secs("slot"), "population")


@query(duck("roster", SPANS + ENDS + " SELECT entity, count(*) AS spans, CAST(epoch(min(span_start)) AS BIGINT) AS first_start, coalesce(any_value(h.n), 0) AS end_changes FROM spans LEFT JOIN (SELECT entity, count(*) AS n FROM ends GROUP BY 1) h USING (entity) GROUP BY 1"))
def io3_io5_panel_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The nested panel, gated by the population check, written as JSON lines and read back under its schema."""
    r = V(spark, d, "roster")
    nested = publish.nested_panel(panel.presence_spans(r), panel.changes(r, "end_date"))
    bad = panel.check_populations(r, points.snapshot_metrics(r).select("slot", "population"))
    path = shared_folder(spark, "panel")
    publish.write_panel(nested, bad, path)
    back = publish.read_panel(spark, path, nested.schema)
    return back.select("entity", F.size("spans").cast("long").alias("spans"), F.unix_seconds(F.col("spans")[0]["span_start"]).alias("first_start"), F.coalesce(F.when(F.col("end_history").isNotNull(), F.size("end_history")), F.lit(0)).cast("long").alias("end_changes"))


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, population, CASE WHEN source = 'purchase' THEN 'bookings' ELSE 'people' END AS unit FROM points WHERE observed_at >= TIMESTAMP '2024-01-10'"))
def io6_io7_history_csv(spark: SparkSession, d: str) -> DataFrame:
    """The aggregate history as CSV with a cutoff, read back."""
    path = shared_folder(spark, "history")
    publish.write_history(V(spark, d, "points"), path, F.lit("2024-01-10").cast("timestamp"))
    back = publish.read_history(spark, path)
    return back.select("source", secs("slot"), "population", "unit")


FULL = OBSERVED + """, c AS (SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, max(ts) AS finished, max(ts) FILTER (value > 50) AS updated, count(DISTINCT user_id) AS population, count(*) AS n, count_if(value > 20) AS charges FROM events GROUP BY 1, 2),
fs AS (SELECT source, slot, count(*) AS new FROM (SELECT event_type AS source, user_id, min(time_bucket(INTERVAL 15 MINUTE, ts)) AS slot FROM events GROUP BY 1, 2) GROUP BY 1, 2),
seen AS (SELECT c.source, c.slot, sum(coalesce(new, 0)) OVER (PARTITION BY c.source ORDER BY c.slot) AS seen FROM c LEFT JOIN fs ON fs.source = c.source AND fs.slot = c.slot),
full_points AS (SELECT source, CASE WHEN source = 'purchase' THEN 'bookings' ELSE 'people' END AS unit, CAST(epoch(slot) AS BIGINT) AS slot, epoch_us(obs) AS observed_at, epoch_us(finished) AS finished_at, epoch_us(updated) AS source_updated_at, population, arrivals, departures, comparison_minutes,
CASE WHEN source <> 'purchase' THEN population END AS listed_people, CASE WHEN source <> 'purchase' THEN n END AS listed_records, CASE WHEN source = 'purchase' THEN charges END AS charge_rows, CAST(seen AS BIGINT) AS people_or_bookings_seen FROM c JOIN moved_on m USING (source, slot) JOIN seen USING (source, slot))"""


def full_points(spark: SparkSession, d: str) -> DataFrame:
    """Observation points with all that is published of them, and a field that isn't."""
    rows, keys = observed_rows(spark, d), ("source",)
    own = F.col("source") == "purchase"
    c = rows.groupBy("source", "slot").agg(F.min("ts").alias("observed_at"), F.max("ts").alias("finished_at"), F.max(F.when(F.col("value") > 50, F.col("ts"))).alias("source_updated_at"), F.count_distinct("entity").alias("population"), F.count("*").alias("n"), F.count_if(F.col("value") > 20).alias("charges"))
    c = c.withColumns({"listed_people": F.when(~own, F.col("population")), "listed_records": F.when(~own, F.col("n")), "charge_rows": F.when(own, F.col("charges"))})
    seen = points.cumulative_seen(rows, keys=keys).withColumnRenamed("seen", "people_or_bookings_seen")
    return c.join(points.flows(rows, keys=keys, observed="ts"), ["source", "slot"]).join(seen, ["source", "slot"])


def shown(df: DataFrame) -> DataFrame:
    """Times as numbers, which both engines print alike."""
    return df.select(*[F.unix_seconds(c).alias(c) if c == "slot" else F.unix_micros(c).alias(c) if publish.kind_of(c) == "timestamp" else F.col(c) for c in df.columns])


@query("WITH e AS (SELECT 1)" + FULL + " SELECT * FROM full_points WHERE observed_at >= epoch_us(TIMESTAMP '2024-01-10')")
def io6_published_history(spark: SparkSession, d: str) -> DataFrame:
    """All 14 columns of the published history from a time on, written as CSV and read back."""
    path = shared_folder(spark, "history")
    publish.write_history(full_points(spark, d), path, F.lit("2024-01-10").cast("timestamp"))
    return shown(publish.read_history(spark, path))


@query("WITH e AS (SELECT 1)" + FULL + f" SELECT {', '.join(publish.EXPORT)} FROM full_points")
def io7_whole_export(spark: SparkSession, d: str) -> DataFrame:
    """The export of all observations, without a time limit, in its 11 columns."""
    path = shared_folder(spark, "export")
    publish.write_export(full_points(spark, d), path)
    return shown(publish.read_history(spark, path, publish.EXPORT))


@query(duck("details", "SELECT entity, CAST(epoch(max(seen_at)) AS BIGINT) AS seen_at, arg_max(amount, seen_at) AS amount, arg_max(status, seen_at) AS status FROM details WHERE seen_at <= TIMESTAMP '1997-01-01' GROUP BY 1 HAVING list_contains(arg_max(cases, seen_at), 7)"))
def io8_exported_details(spark: SparkSession, d: str) -> DataFrame:
    return publish.exported_details(V(spark, d, "details"), F.lit("1997-01-01").cast("timestamp"), case=7).select("entity", secs("seen_at"), "amount", "status")


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, CAST(floor(epoch(observed_at)) AS BIGINT) AS observed_at, population FROM points WHERE source = 'click'"))
def io2_population_points(spark: SparkSession, d: str) -> DataFrame:
    path, p = shared_folder(spark, "days"), V(spark, d, "points")
    layout.write_days(p, path)
    return files.population_points(layout.scan_days(spark, path, p.schema, "click"), "click").select("source", secs("slot"), secs("observed_at"), "population")


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, population FROM points"))
def io3_gzip_records(spark: SparkSession, d: str) -> DataFrame:
    """Observations written as gzip JSON lines and read back under their schema."""
    path = shared_folder(spark, "records")
    V(spark, d, "points").select("source", "slot", "population").write.json(path, compression="gzip")
    return files.read_json(spark, path, "source string, slot timestamp, population long").select("source", secs("slot"), "population")


def day_files(spark: SparkSession, d: str, header: str | None, line, name: str) -> str:
    """A folder with one text file per source and day: a header and a line per slot."""
    path = shared_folder(spark, name)
    p = V(spark, d, "points").withColumn("day", F.col("slot").cast("date").cast("string"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("slot", line.alias("line")))), lambda x: x["line"])
    each = p.groupBy("source", "day").agg((F.concat(F.array(F.lit(header)), lines) if header else lines).alias("lines"))
    each.select("source", "day", F.array_join("lines", "\n").alias("value")).write.partitionBy("source", "day").text(path)
    return path


@query(duck("points", """SELECT source, CAST(CAST(slot AS DATE) AS VARCHAR) AS day, CASE WHEN source NOT IN ('click', 'view') THEN count(*) END AS n,
CASE source WHEN 'click' THEN 'not listed' WHEN 'view' THEN 'checksum differs' END AS reason FROM points GROUP BY source, CAST(slot AS DATE)"""))
def io11_verified_contents(spark: SparkSession, d: str) -> DataFrame:
    """Files against a list of digests that lacks one source and holds wrong ones for another."""
    path = day_files(spark, d, None, F.col("population").cast("string"), "blobs")
    listed = spark.read.format("binaryFile").load(path).where("source <> 'click'")
    digest = F.when(F.col("source") == "view", F.sha2(F.lit("other"), 256)).otherwise(F.sha2("content", 256))
    got = files.verified_contents(spark, path, listed.select(files.file_name(3).alias("name"), digest.alias("digest")), 3)
    part = lambda k: F.regexp_extract("name", f"{k}=([^/]*)", 1).alias(k)
    lines = F.size(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n")).cast("long")
    return got.select(part("source"), part("day"), F.when(F.col("content").isNotNull(), lines).alias("n"), "reason")


@query(duck("points", """SELECT source, CAST(CAST(slot AS DATE) AS VARCHAR) AS day, count(*) AS n, count_if(population % 11 = 0) AS bad_rows,
CASE WHEN count_if(population % 11 = 0) > floor(count(*) * 0.01) THEN 'rejected' ELSE 'parsed' END AS status FROM points GROUP BY source, CAST(slot AS DATE)"""))
def io12_report_files(spark: SparkSession, d: str) -> DataFrame:
    """Delimited files with a header; rows with a field too many are bad and reject their file beyond the budget."""
    more = F.when(F.col("population") % 11 == 0, ",odd").otherwise("")
    line = F.concat(F.unix_seconds("slot").cast("string"), F.lit(","), F.col("population").cast("string"), more)
    path = day_files(spark, d, "SLOT,POPULATION", line, "reports")
    status = files.parse_reports(files.numbered_lines(spark, path, 3), "POPULATION", 2)[1]
    part = lambda k: F.regexp_extract("file", f"{k}=([^/]*)", 1).alias(k)
    return status.select(part("source"), part("day"), "n", "bad_rows", "status")


@query(duck("points", """SELECT CASE WHEN source = 'view' THEN '../' ELSE '' END || source || ' ' || CAST(CAST(epoch(slot) AS BIGINT) AS VARCHAR) AS name, population AS size, CASE WHEN population % 7 <> 0 THEN CAST(epoch(slot) AS BIGINT) END AS modified,
CASE WHEN source = 'view' THEN 'path leaves the folder' WHEN population % 7 = 0 THEN 'no time' END AS fault FROM points"""))
def io14_listing(spark: SparkSession, d: str) -> DataFrame:
    """Observations written as XML file nodes with encoded names, some outside the folder or without a time."""
    path = shared_folder(spark, "listing")
    name = F.url_encode(F.concat(F.when(F.col("source") == "view", "../").otherwise(""), "source", F.lit(" "), F.unix_seconds("slot").cast("string")))
    nodes = V(spark, d, "points").select(name.alias("name"), F.col("population").alias("size"), F.when(F.col("population") % 7 != 0, F.unix_seconds("slot")).alias("modified"))
    nodes.write.format("xml").option("rootTag", "listing").option("rowTag", "file").save(path)
    return files.parse_listing(spark, path).select("name", "size", secs("modified"), "fault")


@query(duck("points", """, b AS (SELECT source, CAST(slot AS DATE) AS day FROM points GROUP BY 1, 2 HAVING count_if(population % 11 = 0) <= floor(count(*) * 0.01))
SELECT p.source, CAST(epoch(slot) AS BIGINT) AS slot, population, CASE WHEN population % 2 = 0 THEN 'two' || chr(10) || 'lines, "quoted"' ELSE 'plain' END AS note FROM points p JOIN b ON b.source = p.source AND b.day = CAST(p.slot AS DATE) WHERE population % 11 <> 0"""))
def io12_parsed_reports(spark: SparkSession, d: str) -> DataFrame:
    """Rows of report files, of which quoted fields go over lines, as far as the quarantine budget accepts their file."""
    note = F.when(F.col("population") % 2 == 0, '"two\nlines, ""quoted"""').otherwise("plain")
    more = F.when(F.col("population") % 11 == 0, ",odd").otherwise("")
    line = F.concat(F.unix_seconds("slot").cast("string"), F.lit(","), F.col("population").cast("string"), F.lit(","), note, more)
    rows, _ = reports.read_reports(spark, day_files(spark, d, "SLOT,POPULATION,NOTE", line, "reports"), ["POPULATION"], depth=3)
    v = lambda k: F.col("values")[k]
    return rows.select(F.regexp_extract("file", "source=([^/]*)", 1).alias("source"), v("SLOT").cast("long").alias("slot"), v("POPULATION").cast("long").alias("population"), v("NOTE").alias("note"))


IO9 = """, rv AS (SELECT DISTINCT family, version FROM reports UNION SELECT 'spreadsheet', 1998), ok AS (SELECT family, max(version) AS version FROM rv WHERE version <= 1998 GROUP BY 1)
SELECT k.family, k.version, r.case_no, r.entity, CASE WHEN k.family = 'spreadsheet' THEN 'unsupported' ELSE 'parsed' END AS status FROM ok k LEFT JOIN reports r ON r.family = k.family AND r.version = k.version"""


@query(duck("reports", IO9))
def io9_io10_exported_reports(spark: SparkSession, d: str) -> DataFrame:
    """The latest reports as of a version; a file that was not read stays as a row of nulls with its status."""
    r = V(spark, d, "reports")
    rev = r.select("family", "version").distinct().withColumn("status", F.lit("parsed"))
    rev = rev.union(spark.createDataFrame([("spreadsheet", 1998, "unsupported")], "family string, version int, status string"))
    return publish.exported_reports(r, rev, as_of=1998).select("family", "version", "case_no", "entity", "status")


@query(duck("reports", """, k AS (SELECT min(coalesce(nullif(entity, ''), case_no)) AS key FROM reports)
SELECT family, version, case_no, entity, 'parsed' AS status FROM reports, k WHERE version % 4 <> 0 AND coalesce(nullif(entity, ''), case_no) = key
UNION ALL SELECT DISTINCT family, version, NULL, NULL, 'unsupported' FROM reports WHERE version % 4 = 0"""))
def io9_all_versions_of_key(spark: SparkSession, d: str) -> DataFrame:
    """One key in all versions; versions that were not parsed stay as rows of nulls."""
    r = V(spark, d, "reports")
    rev = r.select("family", "version").distinct().withColumn("status", F.when(F.col("version") % 4 == 0, "unsupported").otherwise("parsed"))
    key = r.agg(F.min(F.coalesce(F.nullif("entity", F.lit("")), "case_no"))).first()[0]
    return publish.exported_reports(r, rev, key, all_versions=True).select("family", "version", "case_no", "entity", "status")


@query("SELECT l_suppkey AS file, count_if(NOT bad) AS good, count_if(bad) AS bad, count_if(bad) <= floor(count(*) * 0.01) AS accepted FROM (SELECT l_suppkey, l_quantity >= 50 AND l_linenumber >= 3 AS bad FROM lineitem) GROUP BY 1")
def io12_io13_quarantine_budget(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("file"), ((F.col("l_quantity") >= 50) & (F.col("l_linenumber") >= 3)).alias("b"))
    return files.accepted_files(li, F.col("b"))


@query("WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1, 's')) AS cell, generate_subscripts(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1, 's'), 1) - 1 AS row_no FROM pages) SELECT page_id, CAST(row_no AS INT) AS row_no, regexp_extract(cell, 'href=\"([^\"]*)\"', 1) AS link FROM c")
def io15_page_rows(spark: SparkSession, d: str) -> DataFrame:
    return files.page_rows(table(spark, d, "pages").select("page_id", "html")).select("page_id", "row_no", "link")


PAGED = """, l AS (SELECT slot, entity, owner, end_date, row_number() OVER (PARTITION BY slot ORDER BY entity) - 1 AS i, count(*) OVER (PARTITION BY slot) AS total FROM roster),
t AS (SELECT *, i // 25 AS page, (i // 25) * 25 + 1 AS first, least((i // 25 + 1) * 25, total) AS last, CAST(epoch(slot) AS BIGINT) // 21600 % 17 AS k FROM l)"""
PAGE_FAULT = "CASE WHEN k = 3 THEN 'server error: app.FaultException' WHEN k = 5 THEN 'range missing' WHEN k = 7 THEN 'implausible range' WHEN k = 9 AND page = 0 THEN 'fewer rows than the range' WHEN k = 11 THEN 'columns changed' WHEN k = 13 THEN 'identifier missing' WHEN k = 15 THEN 'end date not recognised' END"


def roster_html(spark: SparkSession, d: str) -> DataFrame:
    """(slot, page, html): snapshots as pages of 25 table rows with their advertised range; every other kind of fault."""
    w = Window.partitionBy("slot")
    r = V(spark, d, "roster").withColumns({"i": F.row_number().over(w.orderBy("entity")) - 1, "total": F.count("*").over(w), "k": F.floor(F.unix_seconds("slot") / 21600) % 17})
    r = r.withColumn("page", F.floor(F.col("i") / 25).cast("long"))
    cell = lambda c: F.concat(F.lit("<td>\n <b>"), c, F.lit(" </b></td>"))
    entity = F.col("entity").cast("string")
    link = F.concat(F.lit("<td><a class='x' href=\"javascript:open('"), F.when(F.col("k") == 13, "").otherwise(F.concat(F.lit("r"), entity)), F.lit("')\">Name&amp;  "), entity, F.lit("</a></td>"))
    date = F.coalesce(F.when(F.col("k") == 15, F.lit("soon")).otherwise(F.date_format("end_date", "MM/dd/yyyy")), F.lit(""))
    row = F.concat(F.lit("<tr>"), link, cell(entity), cell(F.col("owner")), F.when(F.col("k") == 11, "").otherwise(cell(F.lit("x"))), cell(date), F.lit("</tr>"))
    drop = (F.col("k") == 9) & (F.col("page") == 0) & (F.col("i") == 0)
    p = r.groupBy("slot", "page", "total", "k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~drop, F.struct("i", row.alias("row"))))), lambda x: x["row"]), "\n").alias("rows"))
    first, last = F.col("page") * 25 + 1, F.least((F.col("page") + 1) * 25, F.col("total"))
    thousands = lambda c: F.format_number(c, 0)
    said = F.concat(F.lit("<p>Showing <b>"), thousands(first), F.lit("</b> to "), thousands(last), F.lit(" of "), thousands(F.when(F.col("k") == 7, last - 1).otherwise(F.col("total"))), F.lit("\n results</p>"))
    html = F.when(F.col("k") == 3, "<h1>An abnormal error occurred</h1> java: app.FaultException: row of a person").when(F.col("k") == 5, F.concat(F.lit("<table>"), F.col("rows"), F.lit("</table>"))).otherwise(F.concat(said, F.lit("<table><tr><th>Name</th></tr>"), F.col("rows"), F.lit("</table>")))
    return p.select("slot", "page", html.alias("html"))


@query(duck("roster", PAGED + f""" SELECT CAST(epoch(slot) AS BIGINT) AS slot, page, CASE WHEN k NOT IN (3, 5) THEN first END AS first, CASE WHEN k NOT IN (3, 5) THEN last END AS last, CASE WHEN k = 7 THEN last - 1 WHEN k NOT IN (3, 5) THEN total END AS total,
{PAGE_FAULT} AS fault FROM t GROUP BY ALL"""))
def io15_page_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The advertised range of each page of a listing, and why a page is refused."""
    return files.roster_pages(roster_html(spark, d))[1].select(secs("slot"), "page", "first", "last", "total", "fault")


@query(duck("roster", PAGED + f" SELECT CAST(epoch(slot) AS BIGINT) AS slot, page, 'r' || entity AS result_id, 'Name& ' || entity AS name, CAST(entity AS VARCHAR) AS entity, owner, CAST(end_date AS VARCHAR) AS end_date FROM t WHERE {PAGE_FAULT} IS NULL"))
def io15_listed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the pages that aren't refused: the link's id, the cells' squeezed text, the end date."""
    return files.roster_pages(roster_html(spark, d))[0].select(secs("slot"), "page", "result_id", "name", "entity", "owner", text("end_date"))


@query("SELECT page_id, CASE WHEN dir = 'en' AND name LIKE '%.html' THEN 'english page' WHEN dir = 'en' THEN 'english folder' WHEN dir = 'de' AND regexp_matches(name, '^[0-9]+$') THEN 'german number' END AS family FROM (SELECT page_id, regexp_extract(url, '://[^/]*/([^/]*)/([^?#]*)', 1) AS dir, regexp_extract(url, '://[^/]*/([^/]*)/([^?#]*)', 2) AS name FROM pages)")
def io16_file_families(spark: SparkSession, d: str) -> DataFrame:
    pattern = "://[^/]*/([^/]*)/([^?#]*)"
    rules = [("en", r"\.html$", "english page"), ("en", "", "english folder"), ("de", "^[0-9]+$", "german number")]
    p = table(spark, d, "pages")
    return p.select("page_id", files.file_family(F.regexp_extract("url", pattern, 1), F.regexp_extract("url", pattern, 2), rules).alias("family"))


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS as_of, max(o_orderkey) AS observed FROM orders GROUP BY 1")
def io17_latest_per_date(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("as_of"), F.col("o_orderkey").alias("observed"))
    return files.latest_per_date(o, "as_of", "observed").select(text("as_of"), "observed")


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, population FROM points"))
def io18_idempotent_append(spark: SparkSession, d: str) -> DataFrame:
    """Two overlapping commits and a retry leave each observation once; a source's day is committed as a whole."""
    path = shared_folder(spark, "observations")
    p = V(spark, d, "points").select("source", "slot", "population").withColumn("day", F.to_date("slot"))
    layout.commit_new(spark, p.where("day < date '2024-01-20'"), path, ["source", "day"])
    for _ in range(2):
        layout.commit_new(spark, p.where("day >= date '2024-01-10'"), path, ["source", "day"])
    return layout.committed(spark, p.schema, path).select("source", secs("slot"), "population")


@query(duck("roster", "SELECT CAST(epoch(slot) AS BIGINT) AS slot, entity, owner FROM roster"))
def io18_snapshot_commits(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots committed by slot, twice over a range: a committed slot isn't written again."""
    path, r = shared_folder(spark, "snapshots"), V(spark, d, "roster").select("slot", "entity", "owner")
    layout.commit_new(spark, r.where("slot < timestamp '2024-01-20'"), path, ["slot"])
    layout.commit_new(spark, r.where("slot >= timestamp '2024-01-10'"), path, ["slot"])
    return layout.committed(spark, r.schema, path).select(secs("slot"), "entity", "owner")


@query(duck("roster", "SELECT (SELECT count(DISTINCT entity) FROM roster WHERE slot = (SELECT max(slot) FROM roster)) AS listed, count(DISTINCT entity) AS seen FROM roster"))
def io19_projection(spark: SparkSession, d: str) -> DataFrame:
    """Current state and cumulative ids as one row."""
    r = V(spark, d, "roster")
    counts = r.groupBy("slot").agg(F.count_distinct("entity").alias("listed")).withColumn("source", F.lit("all"))
    return latest_projection(counts.select("source", "slot", "listed")).select("listed").crossJoin(r.agg(F.count_distinct("entity").alias("seen")))


@query("SELECT sha256(text) AS digest, count(*) AS copies, CAST(max(strlen(text)) AS BIGINT) AS size FROM documents WHERE text IS NOT NULL GROUP BY 1")
def io20_deduplicated_bytes(spark: SparkSession, d: str) -> DataFrame:
    return files.deduplicated_bytes(table(spark, d, "documents").where("text is not null"), "text")


@query(duck("points", "SELECT source, CAST(epoch(max(slot)) AS BIGINT) AS slot, max(slot) < TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR AS stale FROM points GROUP BY 1"))
def io21_io22_newest_and_stale(spark: SparkSession, d: str) -> DataFrame:
    p = V(spark, d, "points").groupBy("source").agg(F.max("slot").alias("slot"))
    return p.select("source", secs("slot"), (F.col("slot") < F.lit("2024-01-31").cast("timestamp") - F.expr("INTERVAL 1 HOUR")).alias("stale"))


@query(duck("points", "SELECT source, CAST(epoch(slot) AS BIGINT) AS slot, CASE source WHEN 'view' THEN '2' WHEN 'click' THEN '1' END AS parser_version, 'panelspark' AS application, 'b1' AS build FROM points"))
def io23_provenance(spark: SparkSession, d: str) -> DataFrame:
    p = files.with_provenance(V(spark, d, "points"), "panelspark", "b1", {"view": "2", "click": "1"})
    return p.select("source", secs("slot"), "parser_version", "application", "build")


@query("SELECT event_id, CASE WHEN NOT regexp_full_match(event_type, '[a-z][a-z0-9_-]*') THEN 'source name' WHEN minute(ts) % 15 <> 0 OR second(ts) <> 0 THEN 'not a quarter hour' END AS fault FROM (SELECT event_id, event_type, CASE WHEN user_id % 2 = 0 THEN time_bucket(INTERVAL 15 MINUTE, ts) ELSE ts END AS ts FROM events)")
def io24_key_faults(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn("ts", F.when(F.col("user_id") % 2 == 0, points.slot_of(F.col("ts"))).otherwise(F.col("ts")))
    return e.select("event_id", files.key_faults(F.col("event_type"), F.col("ts")).alias("fault"))
