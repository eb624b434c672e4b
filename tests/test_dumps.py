import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerloom.sources import dumps

ROW = "id long, name string, active boolean, amount decimal(10,2), day date"


def lines(path):
    return [line for f in sorted(path.glob("part-*")) for line in f.read_bytes().decode().split("\n")]


def test_round_trip_of_awkward_texts(spark, tmp_path):
    rng = random.Random(1)
    texts = ["", "plain", r"\N", "\\", "\\\\", "a\tb", "a\nb", "\r\n", "\x0b\x0c\b", r"\t", r"\\N", "é日😀", " lead", None, r"\."]
    texts += ["".join(rng.choice("\\\t\n\rNtnx. ") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    rows = [(i, t, rng.choice([True, False, None]), rng.choice([None, Decimal("1.50")]), rng.choice([None, date(2024, 2, 29)])) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, ROW)
    dumps.write_dump(table.repartition(3), str(tmp_path / "d"), "public.t")
    good, bad = dumps.read_dump(spark, str(tmp_path / "d"), table.schema)
    assert sorted(map(tuple, good.collect())) == sorted(rows) and bad.isEmpty()
    assert sum(line == r"\." for line in lines(tmp_path / "d")) >= 3


def dump(path, *body, header="COPY public.t (id, name) FROM stdin;", end="\\."):
    path.mkdir()
    text = "\n".join(["--", "-- dump", "", "SET statement_timeout = 0;", "SELECT pg_catalog.set_config('search_path', '', false);", header, *body, end, ""])
    (path / "one.sql").write_bytes(text.encode())
    return str(path)


def test_bad_lines_go_to_the_dead_letters(spark, tmp_path):
    path = dump(tmp_path / "d", "1\tAli", "x2\tMir", "3", "4\ta\tb", "\\N\tno id", "5\t", "garbage line")
    good, bad = dumps.read_dump(spark, path, T.StructType.fromDDL("id long, name string"))
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, "Ali"), (5, ""), (None, "no id")]
    assert {tuple(r) for r in bad.collect()} == {
        ("x2\tMir", "type_of_id"), ("3", "number_of_fields"), ("4\ta\tb", "number_of_fields"), ("garbage line", "number_of_fields"),
    }


def test_columns_are_found_by_name(spark, tmp_path):
    path = dump(tmp_path / "d", "Ali\t1\tx", header='COPY public.t (name, id, "more") FROM stdin;')
    good, _ = dumps.read_dump(spark, path, T.StructType.fromDDL("id long, name string"))
    assert [tuple(r) for r in good.collect()] == [(1, "Ali")]
    with pytest.raises(ValueError, match="no column city"):
        dumps.read_dump(spark, path, T.StructType.fromDDL("id long, city string"))


def test_a_cut_off_dump_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="starts 1 times and ends 0"):
        dumps.read_dump(spark, dump(tmp_path / "d", "1\tAli", end=""), T.StructType.fromDDL("id long, name string"))


def test_reading_is_column_expressions(spark, tmp_path):
    path = dump(tmp_path / "d", "1\tAli")
    good, _ = dumps.read_dump(spark, path, T.StructType.fromDDL("id long, name string"))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
