import os
import tempfile

import pytest
from pyspark.sql import functions as F

from plumage.sources.csv import malformed_reasons, malformed_records, read_csv, scan_with_quarantine
from plumage.sources.headers import HeaderError, header_report, read_by_name
from plumage.sources.infer import infer_types, read_inferred

COLUMNS = {
    "int": ["1", "-20", "+3", "007"], "long": ["1", "3000000000", "-5", "2"],
    "double": ["1", "2.5", "1e3", "-0.1"], "big": ["12345678901234567890", "22345678901234567890", "32345678901234567891", "99345678901234567890"],
    "date": ["2024-01-31", "1999-12-01", "2000-02-29", "2020-01-01"],
    "time": ["2024-01-31 10:00:00", "1999-12-01 00:00:01", "2000-02-29 23:59:59", "2020-01-01 12:30:00"],
    "mixed_time": ["2024-01-31", "1999-12-01 00:00:01", "2000-02-29", "2020-01-01"],
    "flag": ["true", "FALSE", "True", "false"], "text": ["a", "1", "2.5", "true"],
    "number_and_date": ["1", "2020-01-01", "2", "3"], "not_a_date": ["2020-02-31", "2020-01-01", "2020-01-02", "2020-01-03"],
    "hex": ["12AB", "99", "FF", "1"], "empty": ["", "", "", ""], "some_empty": ["", "4", "", "5"],
}


def folder(files):
    d = tempfile.mkdtemp(prefix="plumage-test-")
    for name, content in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(content)
    return d


def test_types_are_those_of_spark(spark):
    rows = "\n".join(",".join(COLUMNS[c][i] for c in COLUMNS) for i in range(4))
    path = folder({"a.csv": ",".join(COLUMNS) + "\n" + rows + "\n"})
    want = dict(read_csv(spark, path, infer_schema=True).dtypes)
    got = read_inferred(spark, path)
    assert dict(got.dtypes) == want
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, read_csv(spark, path, infer_schema=True).collect()), key=repr)


def test_types_of_no_rows(spark):
    texts = spark.createDataFrame([], "a string, b string")
    assert infer_types(texts) == {"a": "string", "b": "string"}


def test_the_file_is_parsed_once(spark):
    path = folder({"a.csv": "a,b\n1,x\n2,y\n"})
    plan = read_inferred(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "csv" not in plan.split("Location")[0].lower()


def test_columns_are_taken_by_name(spark):
    path = folder({"a.csv": "a,b,c\n1,x,2.5\n", "b.csv": 'c,a,b\n0.5,7,"y,\nz"\n', "c.csv": "a,b,c\n"})
    got = read_by_name(spark, path, "a int, b string, c double", multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(1, "x", 2.5), (7, "y,\nz", 0.5)]


@pytest.mark.parametrize("header", ["a,b\n1,2\n", "a,b,d\n1,2,3\n", "a,b,c,c\n1,2,3,4\n", "A,b,c\n1,2,3\n"])
def test_a_wrong_header_is_an_error(spark, header):
    path = folder({"a.csv": "a,b,c\n1,x,2\n", "b.csv": header})
    with pytest.raises(HeaderError):
        read_by_name(spark, path, "a int, b string, c int")
    report = header_report(spark, path, "a int, b string, c int").where("size(unknown) + size(missing) + size(repeated) > 0")
    assert report.count() == 1


def test_files_without_lines(spark):
    assert read_by_name(spark, folder({"a.csv": ""}), "a int, b string").collect() == []


RECORDS = {
    "good": '1,"a ""b"", c",2.5\n', "line break": '2,"two\nlines",3\n', "short": "3,x\n", "long": "4,x,1,2\n",
    "bad cell": "5,x,y\n", "bad first cell": "z,x,1\n", "broken": '6,"so "called, x" y,1\n', "empty text": '7,,1\n',
    "quoted long": '8,"a,b",1,"c,d"\n',
}


def test_each_record_has_its_reason(spark):
    path = folder({f"{i}.csv": r for i, r in enumerate(RECORDS.values())})
    schema = "id int, text string, value double"
    scanned = scan_with_quarantine(spark, path, schema, header=False, multi_line=True, escape='"')
    got = {r.record.strip(): (r.reason, r.column) for r in malformed_records(scanned, schema).collect()}
    assert got == {
        "3,x": ("too_short", None), "4,x,1,2": ("too_long", None), "5,x,y": ("bad_cell", "value"),
        "z,x,1": ("bad_cell", "id"), '6,"so "called, x" y,1': ("broken_quote", None), '8,"a,b",1,"c,d"': ("too_long", None)}
    counts = {(r.reason, r.column): r.n for r in malformed_reasons(scanned, schema).collect()}
    assert counts[("too_long", None)] == 2 and sum(counts.values()) == 6


def test_a_quote_that_does_not_end(spark):
    from plumage.sources.csv import record_problem

    rows = spark.createDataFrame([('1,"never ends, 2.5',), ('1,ends "inside" a cell,2',), ('"a""",b,c',), ('"",,""',), ("",)], "r string")
    got = [r.p for r in rows.select(record_problem("r", "a string, b string, c string").alias("p")).collect()]
    assert [p.reason for p in got] == ["broken_quote", "broken_quote", "other", "other", "too_short"]
