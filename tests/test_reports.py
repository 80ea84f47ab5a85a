"""Report files in splits, against the csv module."""

import csv
import io
import random

import pytest

from panelspark.sources import reports


def read_by_force(data):
    """Records of strict CSV, (fields or None, lines), going on with the next line after a fault."""
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = data.decode("cp1252", "replace")
    reader, out = csv.reader(io.StringIO(text, newline=""), strict=True), []
    while True:
        start = reader.line_num
        try:
            row = next(reader)
            if row:
                out.append(([x.strip() for x in row], reader.line_num - start))
        except StopIteration:
            return out
        except csv.Error:
            out.append((None, reader.line_num - start))


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "48b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_records_over_splits_by_force(spark, tmp_path, small_splits):
    rng = random.Random(9)
    pieces = ["a", "b,c", '"q"', '"x,y"', '"two\nlines"', '"d""d"', 'un"quoted', '"bad"x', ",", "\n", "\r\n", "é", '"over\r\nlines, ""and"" more\n\n"', "1,2,3\n", "4,5,6\n"]
    given = {f"f{i}.csv": "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for i in range(12)}
    given |= {"open.csv": 'a,b\n1,"2\n3,4\n5,6\n' * 3 + '7,"8\n9\n', "plain.csv": "x,y\n" * 50, "quoted.csv": '"' + "long text\n" * 40 + '",z\n', "end.csv": '"a",b'}
    for name, text in given.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "west.csv").write_bytes("a,“é”\r\nplain,€\n".encode("cp1252"))
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbfa,b\n1,2\n")
    got = {}
    table = reports.records(reports.split_lines(spark, f"file://{tmp_path}")).withColumn("fields", reports.fields_of(reports.F.col("record")))
    assert reports.split_lines(spark, f"file://{tmp_path}").select("file", "split").distinct().count() > 40
    for r in sorted(table.collect(), key=lambda r: (r.file, r["at"])):
        got.setdefault(r.file, []).append((None if r.fault else r.fields, r.lines))
    for name in [*given, "west.csv", "mark.csv"]:
        want = read_by_force((tmp_path / name).read_bytes())
        mine = [x for x in got.get(name, []) if x[0] != [""]]  # an empty line is no row to the csv module
        assert mine == [x for x in want if x[0] != [""]], name


def test_reports_with_headings_quarantine_and_budget(spark, tmp_path, small_splits):
    rows = "".join(f'"Last, F{i}","Room\n{i}",C{i}\r\n' for i in range(150))
    head = "Party,Where,Case\r\n"
    cases = {
        "good.csv": "title only,,\r\n\r\n" + head + rows + head, "one_bad.csv": head + rows + '"a"b",x,y\r\n', "odd.csv": head + rows + "too,few\r\n",
        "two_bad.csv": head + rows + "few\r\nfew,x\r\n", "open.csv": head + '"open,x,y\r\n' + rows, "nothing.csv": "a,b\r\n" * 20, "late.csv": "x,y,z\r\n" * 10 + head + rows,
        "other.csv": "Party,Case\r\nx,1\r\n", "twice.csv": "Case,Case,x\r\n1,2,3\r\n", "unnamed.csv": "Case,,\r\n1, 2 ,3\r\n",
    }
    for name, text in cases.items():
        (tmp_path / name).write_bytes(text.encode())
    parsed, files = reports.read_reports(spark, f"file://{tmp_path}", ["Case", "Case #"])
    got = {r.file: (r.status, r.good, r.quarantined) for r in files.collect()}
    assert got == {
        "good.csv": ("parsed", 150, 0), "one_bad.csv": ("parsed", 150, 1), "odd.csv": ("parsed", 150, 1), "two_bad.csv": ("too many unreadable rows", 150, 2), "open.csv": ("too many unreadable rows", got["open.csv"][1], got["open.csv"][2]),
        "nothing.csv": ("no heading", 0, 0), "late.csv": ("no heading", 0, 0), "other.csv": ("parsed", 1, 0), "twice.csv": ("ambiguous headings", 1, 0), "unnamed.csv": ("parsed", 1, 0),
    }
    good = sorted([r for r in parsed.collect() if r.file == "good.csv"], key=lambda r: r["at"])
    assert [r["values"] for r in good] == [{"Party": f"Last, F{i}", "Where": f"Room\n{i}", "Case": f"C{i}"} for i in range(150)]
    assert [r["values"] for r in parsed.where("file = 'unnamed.csv'").collect()] == [{"Case": "1", "_unnamed_column_2": "2", "_unnamed_column_3": "3"}]
    told = {r.file: r.status for r in reports.read_reports(spark, f"file://{tmp_path}", ["Case"], ["Party", "Case"])[1].collect()}
    assert told["other.csv"] == "parsed" and told["good.csv"] == "headings changed"
