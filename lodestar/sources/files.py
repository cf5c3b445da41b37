"""File sources and sinks: header CSV tables, optional inputs, whole-file
text, recursive document folders, label files, binary images and the
persisted chunk/vector index."""

from __future__ import annotations

from typing import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Document extensions the folder scan dispatches on.
BINARY_DOC_EXTENSIONS = [".pdf", ".docx", ".xlsx", ".xls"]
TEXT_DOC_EXTENSIONS = [".txt", ".md"]


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
             multi_line: bool = False) -> DataFrame:
    """Header CSV: the declared columns, found by name in each path's own
    header, whatever else the file holds and in whatever order.  A declared
    column that a path lacks is an error that names both.  Values that do not
    parse as their type are NULL; code columns stay text.  Quotes inside
    fields are doubled.  Only ``multi_line`` files may hold line breaks
    inside quotes; such a file is read by one task, others are split."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    out = None
    for path in [paths] if isinstance(paths, str) else list(paths):
        raw = (spark.read.option("header", True).option("multiLine", multi_line).option("enforceSchema", False)
               .option("quote", '"').option("escape", '"').csv(path))
        lacking = [f.name for f in schema if f.name not in raw.columns]
        if lacking:
            raise ValueError(f"{path}: no column {', '.join(lacking)} in its header")
        part = raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
        out = part if out is None else out.unionByName(part)
    return out


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Keep only paths that exist (checked on the cluster file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def read_optional_csv(spark: SparkSession, paths: Sequence[str], schema, multi_line: bool = False) -> DataFrame | None:
    """Union of the CSV paths that exist; None when none does."""
    found = existing(spark, paths)
    return read_csv(spark, found, schema, multi_line) if found else None


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV sink with a fixed field order (the DataFrame's), quoting fields
    that need it; ``header=False`` for a bare integer matrix."""
    (df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"')
     .option("encoding", "UTF-8").csv(path))


def write_ordered_csv(df: DataFrame, path: str, order: Sequence[str], header: bool = True, parts: int | None = None) -> None:
    """``write_csv`` whose files, by name, hold the rows in ``order``: one range of the order a file."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    write_csv(ranged.sortWithinPartitions(*order), path, header)


def in_file_order(read: DataFrame, per_file: bool = False) -> DataFrame:
    """The columns of a file scan, ``path`` and ``row_no`` (long, from 0): the
    row's place in its file, or over all files by name.

    Rows carry the piece of the file that they come from and their turn in its
    task; they are written once, as another scan may cut its files elsewhere (the
    cut follows the cores at hand).  A piece is read in one go, so the turn less
    the piece's first is the place in the piece; what went before comes from a
    table with one row a piece.  No row is sorted, and a file of any length is as
    many tasks as it has pieces."""
    rows = materialize(read.select(*read.columns, F.col("_metadata.file_path").alias("path"),
                                   F.col("_metadata.file_block_start").alias("_piece"),
                                   F.monotonically_increasing_id().alias("_turn")), "file-order")
    pieces = rows.groupBy("path", "_piece").agg(F.min("_turn").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row a piece of a file; all files together when their rows are numbered through
    order = Window.partitionBy("path").orderBy("_piece") if per_file else Window.orderBy("path", "_piece")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(pieces.withColumn("_before", before).drop("_n"), ["path", "_piece"]).select(
        *read.columns, "path", (F.col("_before") + F.col("_turn") - F.col("_first")).alias("row_no"))


def text_sections(spark: SparkSession, path: str, lines: int = 2000, line_sep: str = "\n") -> DataFrame:
    """Text files of any length below ``path`` -> (path, section, n_lines, text):
    every ``lines`` lines of a file are a section, joined by ``line_sep`` again.
    Sections depend on the file alone, not on how it was cut for reading; a file
    is never one row.  A last line without its separator counts; an empty file
    has no section."""
    read = spark.read.option("recursiveFileLookup", True).option("lineSep", line_sep).text(path)
    placed = in_file_order(read, per_file=True)
    return (placed.withColumn("section", F.floor(F.col("row_no") / lines)).groupBy("path", "section")
            .agg(F.array_sort(F.collect_list(F.struct("row_no", "value"))).alias("_l"))
            .select("path", "section", F.size("_l").cast("long").alias("n_lines"),
                    F.array_join(F.col("_l.value"), line_sep).alias("text")))


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (name, path, content)."""
    df = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return df.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "path", "content")


def scan_documents(spark: SparkSession, folder: str,
                   extractor: Callable[[str, bytes], str] | None = None) -> DataFrame:
    """Recursive folder scan -> (source, ext, text, error).  ``source`` is the
    path relative to the folder.  Plain-text files are decoded natively;
    binary office/PDF formats go through the user ``extractor`` in batches
    (no decoder is bundled), and a file that fails has NULL text and its
    error; other extensions are skipped."""
    root = folder.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "content"))
    ext = F.lower(F.regexp_extract("path", "(\\.[^./]*)$", 1))
    rel = F.regexp_replace(F.regexp_replace("path", "^file:", ""), "^.*?" + _re_escape(root.replace("file:", "")) + "/", "")
    files = files.select(rel.alias("source"), ext.alias("ext"), "content")
    text = files.filter(F.col("ext").isin(TEXT_DOC_EXTENSIONS)).select(
        "source", "ext", F.decode("content", "UTF-8").alias("text"), F.lit(None).cast("string").alias("error"))
    if extractor is None:
        return text
    binary = files.filter(F.col("ext").isin(BINARY_DOC_EXTENSIONS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, errors = [], []
            for src, b in zip(pdf["source"], pdf["content"]):
                try:
                    texts.append(extractor(src, bytes(b)))
                    errors.append(None)
                except Exception as e:  # an unreadable document is a row with its reason
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"source": pdf["source"], "ext": pdf["ext"], "text": texts, "error": errors})

    return text.unionByName(binary.mapInPandas(run, "source string, ext string, text string, error string"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def image_data_url(df: DataFrame, content_col: str = "content", mime: str = "image/jpeg") -> DataFrame:
    """``data:<mime>;base64,<...>`` for image bytes (JVM-side base64; line
    breaks of MIME-chunked output removed, a data URL is one string)."""
    b64 = F.regexp_replace(F.base64(F.col(content_col)), "[\r\n]", "")
    return df.withColumn("data_url", F.concat(F.lit(f"data:{mime};base64,"), b64))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def write_index(chunks: DataFrame, path: str) -> None:
    """Persist the chunk/vector index as Parquet (no pickled objects)."""
    chunks.write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
