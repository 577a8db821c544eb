"""Places of rejected rows: lines counted over blocks, quoted line breaks."""

import pytest
from pyspark.sql import types as T

from sentimart.sources.files import load_csv_table
from sentimart.sources.rejects import located_rejects, numbered_records

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("text", T.StringType())])


def body(n):
    """Records with quoted breaks, commas and quotes, blank lines and every
    kind of bad row; the lines on which they begin are returned too."""
    lines, places, at = ["id,day,text"], {}, 2
    for i in range(n):
        text = {0: "plain", 1: f'"two\nlines, ""{i}"""', 2: '"a, b"', 3: '"\n\n"', 4: ""}[i % 5]
        row = f"{i},2024-01-02,{text}"
        bad = None
        if i % 7 == 3:
            row, bad = f"{i},soon,{text}", ("day", "not a date: soon")
        elif i % 7 == 5:
            row, bad = f"x{i},2024-01-02,{text}", ("id", f"not a bigint: x{i}")
        elif i % 11 == 6:
            row, bad = f"{i},2024-01-02", (None, "2 fields of 3")
        elif i % 13 == 4:
            row, bad = f"{row},more", (None, "4 fields for 3")
        if i % 17 == 0:
            lines.append("")
            at += 1
        lines.append(row)
        places[at] = bad
        at += 1 + row.count("\n")
    return "\n".join(lines) + "\n", places


@pytest.mark.parametrize("block", ["64", "1000", "134217728"])
def test_places_do_not_depend_on_blocks(spark, tmp_path, block):
    want = {}
    for name, n in (("a", 120), ("b", 45), ("c", 1)):
        text, places = body(n)
        (tmp_path / f"{name}.csv").write_text(text)
        want[name] = places
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        records = numbered_records(spark, str(tmp_path))
        got = sorted((r["file"].rsplit("/")[-1][0], r["line"]) for r in records.select("file", "line").collect())
        assert got == sorted((f, line) for f, places in want.items() for line in places)
        bad = {(r["file"].rsplit("/")[-1][0], r["line"]): (r["column_name"], r["reason"])
               for r in located_rejects(spark, str(tmp_path), SCHEMA).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert bad == {(f, line): why for f, places in want.items() for line, why in places.items() if why}


def test_rejects_are_what_the_load_skips(spark, tmp_path):
    (tmp_path / "a.csv").write_text(body(300)[0])
    good, bad = load_csv_table(spark, str(tmp_path), SCHEMA)
    located = located_rejects(spark, str(tmp_path), SCHEMA)
    assert located.count() == bad.count() and good.count() + bad.count() == numbered_records(spark, str(tmp_path)).count()


def test_only_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,text\n")
    (tmp_path / "b.csv").write_text("")
    assert located_rejects(spark, str(tmp_path), SCHEMA).count() == 0
