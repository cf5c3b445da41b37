"""Model calls with a table of answers: each distinct prompt is asked once,
and a run that comes again asks only what has no answer yet."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..sources.files import existing
from .places import look_up_each, with_row_key

ANSWERS = T.StructType([
    T.StructField("prompt_hash", T.StringType()), T.StructField("prompt", T.StringType()),
    T.StructField("response", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("ended_at", T.TimestampType()),
    T.StructField("attempts", T.IntegerType()), T.StructField("run", T.StringType())])


def _now() -> datetime:
    return datetime.now(timezone.utc)


def ask_batch(fn: Callable[[list[str]], list[str]], prompts: list[str], retries: int) -> list[tuple]:
    """(response, error, started, ended, attempts) per prompt.  A batch that
    fails is asked again in halves, so one bad prompt among n costs some
    2 log n calls and no other its answer; a prompt that fails alone is asked
    ``retries`` more times, then its error is its result."""
    if not prompts:
        return []
    begun = _now()
    try:
        out = list(fn(prompts))
        if len(out) == len(prompts):
            ended = _now()
            return [(o, None, begun, ended, 1) for o in out]
        failure = f"ValueError: {len(out)} results for {len(prompts)} inputs"
    except Exception as e:  # a model's failure is data here
        failure = f"{type(e).__name__}: {e}"
    if len(prompts) > 1:
        half = len(prompts) // 2
        return ask_batch(fn, prompts[:half], retries) + ask_batch(fn, prompts[half:], retries)
    if retries:
        o, error, _, ended, attempts = ask_batch(fn, prompts, retries - 1)[0]
        return [(o, error, begun, ended, attempts + 1)]
    return [(None, failure, begun, _now(), 1)]


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The stored answers: for each prompt the one without an error that ended
    last, else its last failure."""
    if not existing(spark, [path]):
        return spark.createDataFrame([], ANSWERS)
    return _best(spark.read.schema(ANSWERS).parquet(path), ["prompt_hash", "prompt"])


def _best(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    fields = F.struct(*[c for c in ANSWERS.names if c not in ("prompt_hash", "prompt")])
    best = F.max_by(fields, F.struct(F.col("error").isNull(), "ended_at", "run"))
    return rows.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def ask_once(prompts: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], path: str, *,
             prompt_col: str = "prompt", batch: int = 64, retries: int = 2) -> DataFrame:
    """Ask the distinct texts of ``prompt_col`` that ``path`` holds no answer
    to, append the answers there, and return the stored answers to the texts
    (as ``read_answers``).

    ``load`` runs in the task, once per partition, and returns a function from
    a list of prompts to a list of answers; it sees ``batch`` prompts at a
    time.  Failures are stored with their error and asked again by the next
    run.  Null prompts are not asked.  The stored table is written before it
    is read, so nothing downstream repeats a call; a task that is run again
    after a lost executor repeats its own calls alone, and only the committed
    run's rows are kept."""
    return _ask(prompts, load, path, prompt_col, batch, retries, ANSWERS.names)


def _ask(prompts: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], path: str, prompt_col: str, batch: int,
         retries: int, keep: Sequence[str]) -> DataFrame:
    """``ask_once``, and the columns in ``keep`` of its answers: prompts are
    long, and a caller that goes by their hash need not move them again."""
    spark = prompts.sparkSession
    asked = prompts.select(F.col(prompt_col).alias("prompt")).filter("prompt is not null").distinct().withColumn(
        "prompt_hash", F.sha2("prompt", 256))
    todo, held = asked.select("prompt_hash", "prompt"), bool(existing(spark, [path]))
    if held:
        known = read_answers(spark, path).filter("error is null").select("prompt_hash", "prompt")
        todo = todo.join(known, ["prompt_hash", "prompt"], "left_anti")
    run = uuid.uuid4().hex

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = load()
        for pdf in frames:
            for start in range(0, len(pdf), batch):
                part = pdf.iloc[start:start + batch]
                got = ask_batch(fn, part["prompt"].tolist(), retries)
                cells = list(zip(*got))
                yield pd.DataFrame({"prompt_hash": part["prompt_hash"].to_numpy(), "prompt": part["prompt"].to_numpy(),
                                    "response": pd.Series(cells[0], dtype=object), "error": pd.Series(cells[1], dtype=object),
                                    "started_at": list(cells[2]), "ended_at": list(cells[3]),
                                    "attempts": pd.Series(cells[4], dtype="int32"), "run": run})

    todo.mapInPandas(call, ANSWERS).write.mode("append").option("compression", "zstd").parquet(path)
    # what this run asked it has answered last; the other texts have an answer without an error from before
    stored = spark.read.schema(ANSWERS).parquet(path)
    found = stored.filter(F.col("run") == run).select(*keep)
    if held:
        texts = prompts.select(F.sha2(F.col(prompt_col), 256).alias("prompt_hash")).distinct()
        older = _best(stored.filter(~F.col("run").eqNullSafe(run) & F.col("error").isNull()),
                      [c for c in ("prompt_hash", "prompt") if c in keep])
        found = found.unionByName(older.select(*keep).join(texts, "prompt_hash", "left_semi"))
    # read at once: Spark takes scans of one path for equal, so a plan that holds two of them, from before and
    # after a further append, would read the older files for both
    return materialize(found, "answers", "zstd")


def ask_list_once(df: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], path: str, *,
                  prompts_col: str = "prompts", out_col: str = "answers", batch: int = 64, retries: int = 2) -> DataFrame:
    """Adds ``out_col``: for each element of the array ``prompts_col`` a struct
    (response, error, started_at, ended_at, attempts), in the same places."""
    rows = with_row_key(df.withColumn("__hashes", F.transform(prompts_col, lambda p: F.sha2(p, 256))))
    fields = ["response", "error", "started_at", "ended_at", "attempts"]
    answers = _ask(rows.select(F.explode(prompts_col).alias("prompt")), load, path, "prompt", batch, retries,
                   ["prompt_hash", *fields])
    return look_up_each(rows, "__hashes", answers, "prompt_hash", fields, out_col).drop("__row", "__hashes")
