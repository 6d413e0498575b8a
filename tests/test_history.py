"""Reading and appending CSV histories."""

import csv
import io

import pytest

from changefold import append_csv_history, read_csv_history
from changefold.sources.history import SOURCE_FILE, csv_header
from tests.products import fragment

ROW = ("K7", "10:00", 4, 'x "y", z', " one\ntwo ", "3.10", "false")
HEADER = "product_id,updated_at,source_sequence,name,category,price,is_active"
#: Rows of every awkward kind that fits on a line, which Spark's reader takes as Python's does.
LINES = [
    'k1,2026-01-01T10:00:00Z,1,"a ""b"", c",d,1.00,true',
    "",
    "k2,2026-01-01T10:00:00Z,1,back\\slash,é,,",
    'k3,2026-01-01T10:00:00Z,2,5" disk,tail,2.00,',
    "k4,short",
    "",
    ',,,"",,,',
    'k5,2026-01-01T10:00:00Z,3," padded ", x ,9.00,FALSE',
    "k6,2026-01-01T10:00:00Z,1,long,d,1.00,true,beyond",
]


def by_python(text):
    """The same rows by Python's reader."""
    rows = csv.DictReader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
    return [tuple(row[name] for name in rows.fieldnames) for row in rows]


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v or "") for v in row))


@pytest.fixture
def split_size(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


@pytest.mark.parametrize("mark", ["", "\ufeff"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_do_not_depend_on_split_size_or_mode(spark, tmp_path, split_size, mark, end):
    text = mark + end.join([HEADER, *LINES * 20])
    path = tmp_path / "h.csv"
    path.write_bytes(text.encode())
    wanted = in_order(by_python(text))
    for size in ("1kb", "128MB"):
        split_size(size)
        for multiline in (True, False):
            history = read_csv_history(spark, str(path), multiline)
            assert in_order(map(tuple, history.drop(SOURCE_FILE).collect())) == wanted
            assert history.select(SOURCE_FILE).first()[0].endswith("h.csv")
    split_size("1kb")
    assert read_csv_history(spark, str(path), multiline=False).rdd.getNumPartitions() > 4


def test_line_breaks_inside_cells(spark, tmp_path):
    text = f'{HEADER}\nk1,t,1,"two\r\nlines, ""quoted""\n",c,1,true\n\n"k\r2",t,1,n,"{"long " * 20_000}",1,true\nk3,t,1,"closed\n,x",c,1,true\n'
    path = tmp_path / "h.csv"
    path.write_bytes(text.encode())
    rows = read_csv_history(spark, str(path)).drop(SOURCE_FILE).collect()
    assert in_order(map(tuple, rows)) == in_order(by_python(text))


def test_where_the_reader_differs(spark, tmp_path):
    """What the README lists: blank rows, text after a closing quote, empty cells of a row of an odd number of cells."""
    path = tmp_path / "h.csv"
    path.write_text('a,b,c\n   \n1,"q"tail,\n2,,x,beyond\n3,\n')
    for multiline in (True, False):
        rows = {r.a: (r.b, r.c) for r in read_csv_history(spark, str(path), multiline).collect()}
        blank = rows.pop("   ", None)
        assert blank == ((None, None) if multiline else None)
        assert rows == {"1": ('"q"tail', ""), "2": (None, "x"), "3": (None, None)}


@pytest.mark.parametrize("multiline", [True, False])
def test_columns_of_clashing_names(spark, tmp_path, multiline):
    path = tmp_path / "h.csv"
    path.write_text("_odd,a.b,_odd_\n1,,3\n")
    assert read_csv_history(spark, str(path), multiline).drop(SOURCE_FILE).collect() == [("1", "", "3")]


def test_append_matches_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "history")
    first = fragment(spark, [ROW])
    append_csv_history(first, path)
    append_csv_history(first.select(*reversed(first.columns)), path)
    rows = read_csv_history(spark, path).drop(SOURCE_FILE).collect()
    assert rows == [first.first()] * 2


@pytest.mark.parametrize("multiline", [True, False])
def test_files_with_other_headers_are_refused(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header does not conform|FAILED_READ_FILE"):
        read_csv_history(spark, str(tmp_path), multiline).collect()


@pytest.mark.parametrize("multiline", [True, False])
def test_header_only_and_empty_files(spark, tmp_path, multiline):
    path = tmp_path / "h.csv"
    path.write_text("product_id,updated_at\n")
    assert csv_header(spark, str(path)) == ["product_id", "updated_at"]
    assert read_csv_history(spark, str(path), multiline).isEmpty()
    path.write_text("")
    assert read_csv_history(spark, str(path), multiline).columns == []
