from __future__ import annotations

import csv
import random

import pytest

from billmill.sources import quoted_lines
from billmill.sources.bill_files import FILE_ORDER, first_text, read_bills_csv
from billmill.sources.quoted_lines import QuotedLines


@pytest.fixture
def block_size(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def write_files(folder, seed, rows=400, files=2):
    rng = random.Random(seed)
    cells = ["x", "two\nlines", 'say "q"\n\n\nlast', "a,b", "", '"', '""\n', "\n" * 40, 'x"\n"y', " pad "]
    for k in range(files):
        with open(folder / f"part-{k}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\n")
            out.writerow(["a", "b", "c"])
            for i in range(rows):
                out.writerow([f"{k}-{i}", rng.choice(cells), rng.choice(cells)])
    return str(folder)


@pytest.mark.parametrize("size", [300, 5_000, 1 << 20])
def test_rows_are_those_of_a_reader_that_takes_a_file_whole(spark, tmp_path, block_size, size):
    path = write_files(tmp_path, size)
    whole = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    want = sorted(map(str, whole.collect()))
    block_size(size)
    assert spark.read.text(path).rdd.getNumPartitions() > (1 if size < 1 << 20 else 0)
    found = read_bills_csv(spark, path, multi_line=True)
    assert sorted(map(str, found.select("a", "b", "c").collect())) == want
    assert [r.a for r in found.orderBy(*FILE_ORDER).collect()] == [f"{k}-{i}" for k in range(2) for i in range(400)]


def test_a_row_over_many_blocks(spark, tmp_path, block_size):
    (tmp_path / "a.csv").write_text('a,b\n1,"' + "line\n" * 2000 + '"\n2,end\n\n')
    block_size(500)
    rows = read_bills_csv(spark, str(tmp_path), multi_line=None).orderBy(*FILE_ORDER).collect()
    assert [(r.a, len(r.b)) for r in rows] == [("1", 10_000), ("2", 3)]


def test_breaks_are_looked_for(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x ""y"""\n')
    assert not QuotedLines(spark, str(tmp_path)).has_breaks()
    assert [tuple(r)[:2] for r in read_bills_csv(spark, str(tmp_path), multi_line=None).collect()] == [("1", 'x "y"')]
    (tmp_path / "b.csv").write_text('a,b\n2,"x\ny"\n')
    assert QuotedLines(spark, str(tmp_path)).has_breaks()
    assert sorted(tuple(r)[:2] for r in read_bills_csv(spark, str(tmp_path), multi_line=None).collect()) == [("1", 'x "y"'), ("2", "x\ny")]


@pytest.mark.parametrize("size", [60, 400, 1 << 20])
def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path, block_size, size):
    """Inches, lost quotes behind a closed cell, and cells of quotes only; some rows with breaks between them."""
    rng = random.Random(size)
    cells = ['5" pipe', 'x"y"z', '"closed"rest', ' "late', '"a ""b"""', '""', "plain", "", '"x\ny"', '"""\n"""', '"5"" pipe\n"']
    rows = [f"{i},{rng.choice(cells)},{rng.choice(cells)}" for i in range(300)]
    (tmp_path / "a.csv").write_text("a,b,c\n" + "\n".join(rows) + "\n")
    want = sorted(map(str, spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path)).collect()))
    block_size(size)
    found = read_bills_csv(spark, str(tmp_path), multi_line=None)
    assert sorted(map(str, found.select("a", "b", "c").collect())) == want
    assert [r.a for r in found.orderBy(*FILE_ORDER).collect()] == [str(i) for i in range(300)]
    (tmp_path / "a.csv").write_text('a,b,c\n1,5" pipe,x\n2,"x"y",z\n3,7",\n')
    assert not QuotedLines(spark, str(tmp_path)).has_breaks()


def test_states_follow_the_lines():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    for _ in range(300):
        lines = ["".join(rng.choice('",ab') for _ in range(rng.randrange(8))) for _ in range(rng.randrange(1, 12))]
        functions = quoted_lines.ends_inside(pa.array(lines))
        for start in (False, True):
            state, want = start, []
            for line in lines:
                at_cell = True
                i = 0
                while i < len(line):
                    c = line[i]
                    if state:
                        if c == '"' and line[i + 1 : i + 2] == '"':
                            i += 1
                        elif c == '"':
                            state, at_cell = False, False
                    elif c == '"' and at_cell:
                        state = True
                    else:
                        at_cell = c == ","
                    i += 1
                want.append(state)
            assert quoted_lines.states(*functions, start).tolist() == want, (lines, start)
            assert np.array_equal(quoted_lines.ends_inside(pa.array([line if '"' in line else None for line in lines], pa.string())), functions)


def test_bad_files_fail(spark, tmp_path, monkeypatch):
    place = tmp_path / "a.csv"
    for text, message in (
        ('a,b\n1,"x\ny",z\n', "more cells than the header"),
        ('a,b\n1,"x\ny\n2,z\n', "open quote"),
    ):
        place.write_text(text)
        with pytest.raises(Exception, match=message):
            read_bills_csv(spark, str(tmp_path), multi_line=True).collect()
    place.write_text('a,b\n1,"x\ny"\n2\n')
    assert [tuple(r)[:2] for r in read_bills_csv(spark, str(tmp_path), multi_line=True).orderBy("a").collect()] == [("1", "x\ny"), ("2", None)]
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_bills_csv(spark, str(tmp_path), multi_line=True).collect()


def test_a_lost_quote_is_refused_before_it_swallows_the_file(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(quoted_lines, "MOST_LINES", 50)
    texts = ["a,b", '1,"x', *["line"] * 80]
    batch = pa.table({"file": ["f"] * 82, "block": [0] * 82, "opened": pa.array([None] * 82, pa.int64()), "nth": pa.array([None] * 82, pa.int64()), "text": texts})
    with pytest.raises(ValueError, match="a quote stays open"):
        list(quoted_lines._walk(iter(batch.to_batches(max_chunksize=30))))


def test_the_first_text_in_file_order(spark, tmp_path, block_size):
    (tmp_path / "part-10.csv").write_text("a,b\n1,late\n")
    (tmp_path / "part-9.csv").write_text("a,b\n" + "1,N/A\n" * 500 + "2,early\n" + "3,later\n" * 300)
    (tmp_path / "part-1.csv").write_text("a,b\n")
    block_size(200)
    for lines in (False, None, True):
        assert first_text(spark, str(tmp_path), "b", lines) == "early"
    assert first_text(spark, str(tmp_path), "none") is None
