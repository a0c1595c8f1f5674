"""CSV files in ranges against Python's sequential reader."""

import csv
import io
import random
from contextlib import contextmanager

import pytest

from tendril.sources import csv_ranges, files


@contextmanager
def ranges(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sequential(content):
    rows = csv.reader(io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", errors="replace", newline=""))
    return [row for k, row in enumerate(rows) if row or k == 0]


def random_csv(seed):
    rng = random.Random(seed)
    cells = ["", "a", "ë,ö", 'say ""x""', "two\nlines", "\n\n\n", "cr\rhere", "long " * 30, "350,000.00", '"', "\r\n"]
    out = []
    for _ in range(60):
        row = []
        for _ in range(rng.randrange(1, 5)):
            v = rng.choice(cells)
            row.append('"' + v.replace('"', '""') + '"' if rng.random() < 0.7 or any(x in v for x in ',"\n\r') else v)
        out.append(",".join(row))
        if rng.random() < 0.1:
            out.append("")
        if rng.random() < 0.1:
            out.append('5" pipe,un"quoted,"closed" then, x"y')
    return ("k,v,w\n" + rng.choice(["\n", "\r\n"]).join(out) + "\n").encode()


ODD = {
    "mark.csv": b'\xef\xbb\xbf"na\nme",b\n"x\ny",2\n\n\n3\n', "bad.csv": b'a,b\n\xff\xfe,"\xe9\n\xe9"\n', "empty.csv": b"", "blank.csv": b"\nx,y\n", "head.csv": b"a,b", "carriage.csv": b'a,b\r1,"2\r3"\r\r4,5\r',
    "one.csv": b'a,b\n1,"' + b"in a cell\n" * 100 + b'end"\n2,3\n', "doubled.csv": b'a,b\n"' + b'""\n' * 100 + b'",x\n"y""",z\n',
}


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_records_equal_a_sequential_reader(spark, tmp_path, size):
    contents = ODD | {f"random{k}.csv": random_csv(k) for k in range(2)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    with ranges(spark, size):
        if size < 400:
            assert spark.read.text(str(tmp_path / "random0.csv")).rdd.getNumPartitions() > 5
        got = {}
        for r in csv_ranges.records(spark, str(tmp_path)).collect():
            got.setdefault(r.path.rpartition("/")[2], []).append((r.ordinal, r.cells))
    for name, content in contents.items():
        assert sorted(got.get(name, [])) == list(enumerate(sequential(content))), name


def test_cells_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'k,v,k\n1,"x\ny",2,beyond\n3\n')
    with ranges(spark, 5):
        rows = sorted((r.row_ordinal, r.cells) for r in files.export_rows(spark, str(tmp_path)).collect())
    assert rows == [(1, {"k": "2", "v": "x\ny"}), (2, {"k": "", "v": ""})]


def test_states_of_lines():
    for text in ('a,"b', '"a""b",c', 'x"y', '"a"b"c,"d', '"",""', '"', '""', '"""', 'a\r"b', '"a\rb",c\rd,"e'):
        for before in ("", '"'):
            whole = before + ("q" if before else "") + text
            rows = list(csv.reader(io.StringIO(whole + "\nmark\n", newline="")))
            ends_inside = rows[-1] != ["mark"]
            assert csv_ranges.still_quoted(text.encode(), bool(before)) == ends_inside, (before, text)
