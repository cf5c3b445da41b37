import os
import random

import brute
import corpus_pipeline as P
import pytest
from test_text_operators import training

from lodestar.llm import queries
from lodestar.llm.piece_sampling import decode_pieces


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labelled rows, toxic ones among them, near copies, copies, shared lines, odd rows."""
    rng = random.Random(9)
    line = "A line of notice that stands at the foot of many of these documents"
    rows = [(i, t + ("\n" + line if i % 9 == 0 else ""), "en", f"s{i % 4}") for i, t, _ in training(240)]
    for i in (1, 2, 3):
        rows.append((500 + i, rows[i][1], "en", "s1"))
        words = rows[10 + i][1].split(" ")
        words[5] = "changed"
        rows.append((600 + i, " ".join(words), "en", "s2"))
    rows += [(700, None, "en", "s1"), (701, "", None, None), (702, "word " * 5000, "en", "s3")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, _, y in training(240)], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(path, "labels.parquet"))
    return path, rows


def test_every_stage_on_its_own_input(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    toxic = {i for i, _, y in training(240) if y}
    steps = []
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path).cache()
        assert docs.columns == P.COLUMNS
        steps.append([tuple(r) for r in docs.collect()])
    ids = {r[0] for r in steps[0]}
    assert len(toxic - ids) >= 0.9 * len(toxic) and len({r[0] for r in rows} - toxic - ids) <= 3
    want = {d: t for d, _, _, t in brute.dedup_lines([(r[0], r[1]) for r in steps[0]])}
    assert {r[0]: r[1] for r in steps[1]} == want and all(r[4] == len(r[1]) for r in steps[1])
    before = sorted((r[0], r[1]) for r in steps[1])
    classes = brute.near_classes([t for _, t in before])
    assert {r[0] for r in steps[2]} == {before[i][0] for i in set(classes)}
    counts = {r[0]: 0 for r in steps[2]}
    for r in steps[3]:
        counts[r[0]] += 1
    assert max(counts.values()) <= 2
    words = {r[0]: len(brute.words(r[1])) for r in steps[2]}
    total = sum(words.values())
    # a source can miss by half its longest text at worst
    assert abs(sum(words[i] * n for i, n in counts.items()) - 1.5 * total) < max(0.02 * total, max(words.values()) / 2)
    last = P.STAGES[-1][1](spark, docs, path).collect()
    text = {r[0]: r[1] or "" for r in steps[3]}
    assert {r["doc_id"] for r in last} == set(text)
    assert all(r["exact"] and decode_pieces(r["pieces"]) == text[r["doc_id"]] for r in last[:40])


def test_run_is_the_chain_of_its_stages(spark, folder):
    got = P.run(spark, folder[0])
    assert got.columns == ["doc_id", "sample", "pieces", "log_prob", "log_inclusion", "exact"] and got.count() > 300


def test_empty_tables(spark, folder, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder[0]}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
