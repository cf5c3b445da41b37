"""Rows in file order, whatever the pieces that the files are read in."""
import os
import random

import pytest

from lodestar.sources import files as FS


def long_files(folder):
    rnd = random.Random(5)
    files = {"a.txt": ["line %d %s" % (i, "x" * rnd.randrange(60)) for i in range(700)],
             "sub/b.txt": ["", "y" * 5000, "", "é\r", " "] * 40, "c.txt": ["one"], "empty.txt": []}
    for name, lines in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(lines) + ("\n" if name != "a.txt" and lines else ""))
    return files


@pytest.mark.parametrize("piece", ["1k", "37k", "128m"])
def test_sections_do_not_depend_on_pieces(spark, tmp_dir, piece):
    files = long_files(tmp_dir)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    try:
        got = {(r.path.rsplit("/", 1)[1], r.section): (r.n_lines, r.text) for r in FS.text_sections(spark, tmp_dir, 64).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(name.rsplit("/", 1)[-1], i // 64): (len(lines[i:i + 64]), "\n".join(lines[i:i + 64]))
            for name, lines in files.items() for i in range(0, len(lines), 64)}
    assert got == want


@pytest.mark.parametrize("parts,piece", [(1, "128m"), (5, "128m"), (3, "200b")])
def test_ordered_csv_round_trip(spark, tmp_dir, parts, piece):
    rows = [(i, f"v{i * 7919 % 311}") for i in range(300)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, v string").repartition(7)
    FS.write_ordered_csv(df, tmp_dir + "/m", ["id"], header=False, parts=parts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    try:
        back = FS.in_file_order(spark.read.schema("id long, v string").csv(tmp_dir + "/m")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.row_no, r.id, r.v) for r in back) == [(i, *r) for i, r in enumerate(sorted(rows))]


def test_empty_table_in_order(spark, tmp_dir):
    FS.write_ordered_csv(spark.createDataFrame([], "id long"), tmp_dir + "/e", ["id"], header=False)
    assert FS.in_file_order(spark.read.schema("id long").csv(tmp_dir + "/e")).count() == 0
