"""The CSV scan against the common reader (pandas) and DuckDB's, on files whose records cross lines and blocks."""

import gzip

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabprep.sources import records
from tabprep.sources.csv import read_csv, read_csv_apart
from tabprep.sources.tables import write_csv


def rows_of(df):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in df.collect()), key=str)


def pandas_rows(path, **options):
    df = pd.read_csv(path, dtype=str, **options)
    return sorted((tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in df.itertuples(index=False)), key=str)


CASES = {
    "quoted": 'id,txt,y\n1,"a ""q"", b",0\n2,"two\nlines",1\n3,"c:\\",0\n4,plain "quote" inside,1\n5,"x"tail,0\n',
    "line ends": 'id,txt\r\n1,"a\r\nb"\r\n2,c\r\n',
    "no last break": 'id,txt\n1,"a,b"\n2,"last"',
    "blank lines": "id,txt\n\n1,a\n   \n2,\n\n",
    "short rows": "a,b,c\n1\n2,x\n3,y,z\n",
    "missing": 'a,b\n"",NA\n"NA",x\nnull,"None"\n1,""\n',
    "mark and nameless": '\ufeffa,,b\n1,2,3\n',
    "header over lines": '"a\nb",c\n1,2\n',
    "quotes only": 'a,b\n"""","""x"""\n"","\n"\n',
    "one column": 'a\n1\n"2\n3"\n',
}


@pytest.mark.parametrize("name", CASES)
def test_rows_equal_the_common_reader(spark, tmp_path, name):
    p = tmp_path / "f.csv"
    p.write_bytes(CASES[name].encode())
    df = read_csv(spark, str(p), infer=False)
    want = pd.read_csv(p, dtype=str)
    assert df.columns == list(want.columns) and rows_of(df) == pandas_rows(p)


def _odd_file(path, n=400, seed=0):
    rng = np.random.default_rng(seed)
    bits = ["word", ",", '""', "\n", " ", "\\", "\r\n", "x" * 40, "\n\n", ',"",\n']
    with open(path, "w", newline="") as f:
        f.write("id,txt,y\n")
        for i in range(n):
            body = "".join(bits[k] for k in rng.integers(0, len(bits), rng.integers(0, 9)))
            f.write(f'{i},"{body}",{i % 3}\n' if rng.random() < 0.7 else f"{i},free text {i},{i % 3}\n")


@pytest.mark.parametrize("block", [64, 333, 5000])
def test_records_across_blocks(spark, tmp_path, block):
    """Blocks of a few lines: records begin, go on and end in different tasks."""
    _odd_file(tmp_path / "odd.csv")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, str(block))
        df = read_csv(spark, str(tmp_path / "odd.csv"), infer=False)
        assert rows_of(df) == pandas_rows(tmp_path / "odd.csv")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_several_files_and_gzip(spark, tmp_path):
    want = []
    for i in range(3):
        _odd_file(tmp_path / f"p{i}.csv", 50, i)
        want += pandas_rows(tmp_path / f"p{i}.csv")
        with gzip.open(tmp_path / f"z{i}.csv.gz", "wb") as f:
            f.write((tmp_path / f"p{i}.csv").read_bytes())
    assert rows_of(read_csv(spark, str(tmp_path / "p*.csv"), infer=False)) == sorted(want, key=str)
    assert rows_of(read_csv(spark, str(tmp_path / "*.gz"), infer=False)) == sorted(want, key=str)
    (tmp_path / "p3.csv").write_text("id,other,y\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "p*.csv"), infer=False)


def test_malformed_rows_are_kept_apart(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text('a,b\n1,x\n2,y,z\n3,"q, r"\n4,"s, ""t""",u,v\n5\n')
    with pytest.raises(ValueError, match="2 malformed rows"):
        read_csv(spark, str(p))
    rows, bad = read_csv_apart(spark, str(p))
    assert [tuple(r) for r in rows.orderBy("a").collect()] == [(1, "x"), (3, "q, r"), (5, None)]
    assert sorted(r["text"] for r in bad.collect()) == ["2,y,z", '4,"s, ""t""",u,v']
    assert read_csv(spark, str(p), malformed="drop").count() == 3
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="end inside quotes"):
        read_csv(spark, str(tmp_path / "open.csv"))
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_csv(spark, str(tmp_path / "head.csv")).count() == 0


def test_documents_through_csv(spark, sf, tmp_path):
    """Whole texts, with breaks and quotes, written and read back; DuckDB and pandas read the same."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.selectExpr("doc_id", "case when doc_id % 3 = 0 then concat('say \"', text, '\"\\r\\nand, more') else text end as text", "source")
    write_csv(odd.coalesce(1), str(tmp_path / "d"))
    file = next((tmp_path / "d").glob("*.csv"))
    got = rows_of(read_csv(spark, str(tmp_path / "d"), infer=False))
    assert len(got) == docs.count() and got == pandas_rows(file)
    duck = duckdb.connect().execute(
        f"SELECT * FROM read_csv('{file}', header = true, all_varchar = true, quote = '\"', escape = '\"', max_line_size = 20000000, "
        "parallel = false)").fetchall()
    assert sorted(([None if v in ("", "NA") else v for v in r] for r in duck), key=str) == [list(r) for r in sorted(got, key=lambda r: str(list(r)))]


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet='a",\n \\', max_size=40))
def test_line_states_agree_with_the_record_parser(text):
    """Joining lines by ``open_after`` gives the records that a character-by-character automaton finds."""
    records_found, field_start, inside, current = [], True, False, ""
    for i, c in enumerate(text):
        current += c
        if inside:
            if c == '"':
                inside = "maybe" if inside is True else True
                continue
            if inside == "maybe":
                inside = False
            else:
                continue
        if c == '"' and field_start:
            inside, field_start = True, False
        elif c == ",":
            field_start = True
        elif c == "\n":
            records_found.append(current[:-1])
            current, field_start = "", True
        else:
            field_start = False
    records_found.append(current)
    assert list(records.join_lines(text.split("\n"))) == records_found


def test_a_task_takes_few_lines_and_bytes_apart_at_a_time():
    import pyarrow as pa

    lines = ["x" * 1000] * 9000 + ["y" * (records.BYTES_AT_ONCE + 1)] + ["z"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(lines)), pa.array([0] * len(lines)), pa.array(lines)], ["file", "block", "line"])
    parts = [some for _, some in records._runs(iter([batch]))]
    assert [x for some in parts for x in some] == lines
    assert all(len(some) == 1 or sum(map(len, some)) <= records.BYTES_AT_ONCE for some in parts)
    assert max(map(len, parts)) <= 2000


def test_rows_leave_a_task_in_small_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "ROWS_AT_ONCE", 7)
    p = tmp_path / "f.csv"
    p.write_text("id,txt\n" + "".join(f'{i},"line {i}\nsecond"\n' for i in range(100)))
    assert sorted(int(r["id"]) for r in read_csv(spark, str(p)).collect()) == list(range(100))
