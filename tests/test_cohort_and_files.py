import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestar.operators import cohort as C
from lodestar.plans import standins as S
from lodestar.sources import files as FS

from conftest import SF001


def test_control_sample_exact_and_disjoint(spark):
    ids = spark.range(0, 5000).select(F.col("id").alias("subject_id"))
    got = C.seeded_sample(ids, 1234, seed=42, prefix_hex=2)
    got_ids = {r.subject_id for r in got.collect()}
    assert len(got_ids) == 1234
    want = {r[0] for r in duckdb.sql(
        "SELECT range AS id FROM range(5000) ORDER BY md5('42:' || CAST(range AS VARCHAR)), range LIMIT 1234"
    ).fetchall()}
    assert got_ids == want


def test_control_pool_excludes_cases(spark):
    cases = C.case_subjects(S.diagnoses(spark, SF001), S.CASE_PREFIXES)
    pool = C.exclude(S.patients(spark, SF001).select("subject_id"), cases)
    ctrl = C.control_sample(pool, cases.count())
    assert ctrl.join(cases, "subject_id").count() == 0
    assert ctrl.count() == min(cases.count(), pool.count())


def test_notes_preview_marker(spark):
    notes = spark.createDataFrame([(1, "  " + "x" * 2500 + "\n"), (2, None), (3, " short ")], "id long, text string")
    rows = C.notes_preview(notes, ["id"], n=3, max_chars=2000).collect()
    assert [r.id for r in rows] == [1, 3]
    assert rows[0].preview == "x" * 2000 + C.PREVIEW_MARKER and rows[1].preview == "short"


def test_csv_round_trip_multiline_quotes(spark, tmp_dir):
    df = spark.createDataFrame([("t", 'he said "x"\nnext, line', "No PDF link available")],
                               "title string, snippet string, pdf_link string")
    FS.write_csv(df, tmp_dir + "/out")
    back = FS.read_csv(spark, tmp_dir + "/out", "title string, snippet string, pdf_link string", multi_line=True).collect()
    assert len(back) == 1 and back[0].snippet == 'he said "x"\nnext, line'


def test_optional_sources(spark, tmp_dir):
    p = tmp_dir + "/a.csv"
    with open(p, "w") as f:
        f.write("subject_id,text\n1,hello\n")
    found = FS.existing(spark, [p, tmp_dir + "/missing.csv"])
    assert found == [p]
    df = FS.read_optional_csv(spark, [p, tmp_dir + "/missing.csv"], "subject_id long, text string")
    assert df.count() == 1


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    with open(tmp_dir + "/diag.csv", "w") as f:
        f.write("subject_id,hadm_id,seq_num,icd_code,icd_version\n1,100,1,E11,10\nx,101,2,0250,9\n")
    got = FS.read_csv(spark, tmp_dir + "/diag.csv", "icd_code string, subject_id long").collect()
    assert [tuple(r) for r in got] == [("E11", 1), ("0250", None)]
    with pytest.raises(ValueError, match="diag.csv.*no column gender"):
        FS.read_csv(spark, tmp_dir + "/diag.csv", "subject_id long, gender string")


def test_derived_folders_need_a_shared_place_off_one_machine():
    from lodestar import session
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session._private_root(master)
    assert os.path.isdir(session._private_root("local[2]"))


def test_document_scan_and_data_url(spark, tmp_dir):
    os.makedirs(tmp_dir + "/docs/sub")
    with open(tmp_dir + "/docs/sub/a.txt", "w") as f:
        f.write("rule one")
    with open(tmp_dir + "/docs/b.pdf", "wb") as f:
        f.write(b"%PDF fake")
    with open(tmp_dir + "/docs/c.bin", "wb") as f:
        f.write(b"skip")
    got = FS.scan_documents(spark, tmp_dir + "/docs", extractor=lambda src, b: b.decode()[5:])
    rows = {r.source: (r.text, r.error) for r in got.collect()}
    assert rows == {"sub/a.txt": ("rule one", None), "b.pdf": ("fake", None)}
    bad = FS.scan_documents(spark, tmp_dir + "/docs", extractor=lambda src, b: b.decode("utf-16"))
    assert [r.error.split(":")[0] for r in bad.filter("ext = '.pdf'").collect()] == ["UnicodeDecodeError"]
    img = FS.image_data_url(FS.read_images(spark, tmp_dir + "/docs/b.pdf")).collect()[0]
    assert img.data_url == "data:image/jpeg;base64,JVBERiBmYWtl"


def test_label_files_from_disk(spark, tmp_dir):
    from lodestar.operators import evaluation as EV
    os.makedirs(tmp_dir + "/gt")
    with open(tmp_dir + "/gt/img.1.txt", "w") as f:
        f.write("3 0.1 0.1 0.2 0.2\n\n  7 0 0 1 1\n")
    rows = EV.parse_label_lines(FS.read_whole_text(spark, tmp_dir + "/gt")).orderBy("pos").collect()
    assert [(r.stem, r.pos, r.true_id) for r in rows] == [("img.1", 0, 3), ("img.1", 1, 7)]


def test_index_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "s", 0, "t", [0.1, 0.2])],
                               "chunk_id long, source string, pos int, text string, embedding array<float>")
    FS.write_index(df, tmp_dir + "/idx")
    assert FS.read_index(spark, tmp_dir + "/idx").count() == 1


def test_sample_edges(spark):
    ids = spark.range(0, 300).select(F.col("id").alias("subject_id"))
    assert C.seeded_sample(ids, 0).count() == 0
    assert C.seeded_sample(ids, 300).count() == 300
    assert C.seeded_sample(ids, 1000).count() == 300        # n beyond the pool keeps everything
    assert C.control_sample(ids, 10_000).count() == 300      # min(cases, pool)
    empty = ids.filter("subject_id < 0")
    assert C.control_sample(empty, 5).count() == 0


def test_count_by_membership_reports_zero(spark):
    t = spark.createDataFrame([(1,), (2,), (2,)], "subject_id long")
    a = spark.createDataFrame([(2,)], "subject_id long")
    b = spark.createDataFrame([(9,)], "subject_id long")
    got = {r.dataset: r.n_rows for r in C.count_by_membership([("t", t)], [("a", a), ("b", b)]).collect()}
    assert got == {"t_a": 2, "t_b": 0}
