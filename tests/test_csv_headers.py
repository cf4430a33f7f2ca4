"""CSV files whose headers differ, brought together by column name."""

from __future__ import annotations

from pathlib import Path

import pytest

from lakeferry.sources.files import read_files


def csv_files(root, contents: dict[str, str], encoding: str = "utf-8") -> str:
    for name, text in contents.items():
        (Path(root) / name).parent.mkdir(parents=True, exist_ok=True)
        (Path(root) / name).write_bytes(text.encode(encoding))
    return str(root)


def test_many_headers_are_one_scan(spark, ws):
    contents = {f"{i}.csv": f"id,c{i},shared\n{i},v{i},{i * 1.5}\n" for i in range(30)}
    df = read_files(spark, csv_files(ws.dir("in"), contents), "CSV", options={"header": True})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" csv") == 1
    assert set(df.columns) == {"id", "shared", *(f"c{i}" for i in range(30))}
    found = {r.id: r.asDict() for r in df.collect()}
    assert len(found) == 30
    for i in range(30):
        assert {k: v for k, v in found[i].items() if v is not None} == {"id": i, "shared": i * 1.5, f"c{i}": f"v{i}"}


def test_headers_that_are_hard_to_match(spark, ws):
    contents = {
        "a b%20c.csv": 'x,"y, z",X2\n1,"a,b",\n2,"line, q",7\n',
        "sub/ü+1.csv": 'X2,x\n5,3\nX2,x\n6\n6,4,extra\n',  # a row like its header, a short and a long row
        "sub/empty.csv": "",
        "sub/only.csv": "x,new\n",
        "dup.csv": "x,x,\n8,9,10\n",
    }
    root = csv_files(ws.dir("in"), contents)
    df = read_files(spark, root, "CSV", recursive=True, options={"header": True, "inferSchema": False})
    assert {"x", "y, z", "X2", "new", "x0", "x1", "_c2"} == set(df.columns)
    got = {tuple(r[c] for c in ("x", "y, z", "X2", "x0", "x1", "_c2")) for r in df.collect()}
    assert got == {
        ("1", "a,b", None, None, None, None), ("2", "line, q", "7", None, None, None), ("3", None, "5", None, None, None),
        ("x", None, "X2", None, None, None), (None, None, "6", None, None, None), ("4", None, "6", None, None, None),
        (None, None, None, "8", "9", "10"),
    }


@pytest.mark.parametrize("options", [{}, {"multiLine": True}])
def test_headers_in_another_encoding(spark, ws, options):
    contents = {"a.csv": "größe,id\n1,ä\n", "b.csv": "id,straße\nü,2\n"}
    root = csv_files(ws.dir("in"), contents, "iso-8859-1")
    df = read_files(spark, root, "CSV", options={"header": True, "encoding": "ISO-8859-1", **options})
    assert {tuple(r[c] for c in ("größe", "id", "straße")) for r in df.collect()} == {(1, "ä", None), (None, "ü", 2)}


def test_strict_modes_judge_rows_by_their_own_header(spark, ws):
    root = csv_files(ws.dir("in"), {"a.csv": "x,y,z\n1,2,3\n", "b.csv": "x\n4\n"})
    df = read_files(spark, root, "CSV", options={"header": True, "mode": "FAILFAST"})
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2, 3), (4, None, None)]
