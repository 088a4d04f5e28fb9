import os
import tempfile

from plumage.sources.csv import bad_rows, good_rows, malformed_report, read_csv, scan_with_quarantine

MALFORMED = 'gender,c,text\nmale,1,hi\nfemale,2\nbrand,3,x,y\nmale,4,"multi\nline"\nmale,zz,ok\n'
SCHEMA = "gender string, c int, text string"


def _write(content):
    d = tempfile.mkdtemp(prefix="plumage-test-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as f:
        f.write(content)
    return p


def test_quarantine_keeps_exactly_the_good_rows(spark):
    scanned = scan_with_quarantine(spark, _write(MALFORMED), SCHEMA)
    good = sorted(tuple(r) for r in good_rows(scanned).collect())
    assert good == [("male", 1, "hi"), ("male", 4, "multi")]
    assert good_rows(scanned).count() == 2  # count agrees with the rows
    bad = sorted(r[0] for r in bad_rows(scanned).collect())
    assert bad == sorted(["female,2", "brand,3,x,y", 'line"', "male,zz,ok"])
    rep = malformed_report(scanned).first()
    assert (rep.rows_read, rep.rows_good, rep.rows_malformed) == (6, 2, 4)


def test_permissive_scan_pads_and_nulls(spark):
    rows = read_csv(spark, _write(MALFORMED), SCHEMA).collect()
    assert len(rows) == 6
    assert ("female", 2, None) in [tuple(r) for r in rows]
    assert ("male", None, "ok") in [tuple(r) for r in rows]


def test_multiline_option_joins_quoted_newline(spark):
    scanned = scan_with_quarantine(spark, _write(MALFORMED), SCHEMA, multi_line=True)
    good = sorted(tuple(r) for r in good_rows(scanned).collect())
    assert ("male", 4, "multi\nline") in good
