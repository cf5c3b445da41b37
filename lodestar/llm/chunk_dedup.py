"""Substring de-duplication by content-defined chunks (gear rolling hash)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize, mix64, release, row_slices, text_bytes

WINDOW = 32  # bytes that a 32-bit gear hash remembers
SLICE = 4 << 20
GEAR = (mix64(np.arange(256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
LENGTH_BITS, TWIN_BITS = 10, 22
PARTS = 2  # turns in which digests and texts are shuffled, each a share of them


def chunk_ends(raw: np.ndarray, offsets: np.ndarray, every: int, least: int, most: int) -> np.ndarray:
    """Sorted end positions (bytes) of the chunks of all rows.

    The gear hash h = (h << 1) + gear[byte] of the last 32 bytes is built by
    doubling: a window of 2w is the window before it, shifted, plus its own.
    Rows are set apart by a window of zeros, so that no row sees another.  A
    chunk ends where the hash is among the lowest 1/``every`` and no other
    such place lies within ``least`` bytes before it, both local rules, so
    chunks fall into step again right after an insertion.  Ends lie on
    character boundaries; a chunk over ``most`` bytes is cut in equal steps."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    shift = np.repeat(WINDOW * np.arange(1, n + 1), lengths)
    place = np.arange(len(raw)) + shift
    h = np.zeros(len(raw) + WINDOW * (n + 1), np.uint32)
    h[place] = GEAR[raw]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    starts_char = np.ones(len(raw) + 1, bool)
    starts_char[:-1] = (raw & 0xC0) != 0x80
    hit = np.flatnonzero((h[place] < np.uint32((1 << 32) // every)) & starts_char[1:]) + 1
    if len(hit):
        of_row = np.searchsorted(offsets, hit - 1, side="right")
        hit = hit[np.concatenate([[True], (np.diff(hit) >= least) | (np.diff(of_row) > 0)])]
    ends = np.union1d(hit, offsets[1:][lengths > 0])
    begins = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - begins > most)
    if len(long):
        extra = np.concatenate([np.arange(begins[i] + most, ends[i], most) for i in long])
        for _ in range(3):  # to the next character, three bytes on at most
            extra = extra + ~starts_char[extra]
        ends = np.union1d(ends, extra)
    return ends


def chunk_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", every: int = 24, least: int = 8,
               most: int = 512, part: int = 0, parts: int = 1) -> DataFrame:
    """(hi, lo, id, at, others): 128-bit digest of a chunk, its row's id and
    ``at``, which packs the chunk's first code point, 22 bits of the text's
    hash (rows that repeat an id are told apart by it) and its code points.
    A digest that a batch holds more than once is one row, its later places
    in ``others``, so a passage of a third of all rows is few rows; one place
    of rows that repeat an id and a text stands there twice at most.  Of
    ``parts`` shares of the digests, ``part`` is returned."""
    id_type = docs.schema[id_col].dataType
    place = T.StructType([T.StructField("id", id_type), T.StructField("at", T.LongType())])
    schema = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), *place.fields,
                           T.StructField("others", T.ArrayType(place))])
    source = docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(text_col), F.lit(1 << TWIN_BITS)).alias("twin"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(2))
            twins = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in row_slices(offsets, SLICE):
                piece, off = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                if not len(piece):
                    continue
                ends = chunk_ends(piece, off, every, least, most)
                begins = np.concatenate([[0], ends[:-1]])
                row = np.searchsorted(off, begins, side="right") - 1
                chars = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
                first = chars[begins] - chars[off[row]]
                at = (first << (TWIN_BITS + LENGTH_BITS)) | (twins[a + row] << LENGTH_BITS) | (chars[ends] - chars[begins])
                view = memoryview(piece)
                digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[s:e]) for s, e in
                                                 zip(begins.tolist(), ends.tolist())]), ">i8").reshape(-1, 2)
                hi, lo = digest[:, 0].astype(np.int64), digest[:, 1].astype(np.int64)
                mine = np.flatnonzero(hi % parts == part)
                if not len(mine):
                    continue
                hi, lo, at, row = hi[mine], lo[mine], at[mine], row[mine]
                # the ids' own order decides who is first; equal digests stand together
                column = batch.column(0).slice(a, b - a)
                ranked = pc.array_sort_indices(column).to_numpy()
                name = column.dictionary_encode(null_encoding="encode").indices.to_numpy()[ranked]
                by_id = np.empty(b - a, np.int64)
                by_id[ranked] = np.cumsum(np.append(0, name[1:] != name[:-1]))
                order = np.lexsort((at, by_id[row], lo, hi))
                lead = np.ones(len(order), bool)
                lead[1:] = (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)
                again = ~lead  # the same place as the one before
                again[1:] &= (np.diff(at[order]) == 0) & (np.diff(by_id[row[order]]) == 0)
                once = np.append(True, ~(again[1:] & again[:-1]))
                order, lead = order[once], lead[once]
                heads = np.flatnonzero(lead)
                sizes = np.diff(np.concatenate([heads, [len(order)]]))
                ids = batch.column(0).slice(a, b - a).take(pa.array(row[order]))
                at_sorted = pa.array(at[order], pa.int64())
                rest = pa.array(np.flatnonzero(~lead))
                others = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes - 1)]), pa.int32()),
                    pa.StructArray.from_arrays([ids.take(rest), at_sorted.take(rest)], ["id", "at"]))
                top = pa.array(heads)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi[order][heads]), pa.array(lo[order][heads]), ids.take(top), at_sorted.take(top), others],
                    names=schema.names)

    return source.mapInArrow(run, schema)


def extensions(docs: DataFrame, edges: DataFrame, *, id_col: str, text_col: str, reach: int) -> tuple[DataFrame, list[DataFrame]]:
    """(id, twin, run, side, more), and the tables that hold it, for
    ``release`` after its last reader: how many code points next to an edge
    (id, twin, run, side, pos, and the other place pid, ptwin, ppos) are the
    same at both places, before the two positions (side 0) or after (side 1).

    ``reach`` code points are compared first; edges that are equal all the
    way go on with eight times as many, so no length is a limit."""
    id_type = docs.schema[id_col].dataType.simpleString()
    # a struct is one key without nulls, whatever the id
    texts = docs.select(F.struct(F.col(id_col).alias("id"), F.pmod(F.xxhash64(text_col), F.lit(1 << TWIN_BITS)).alias("twin")).alias("doc"),
                        F.col(text_col).cast("string").alias("text"))
    kind = edges.schema.simpleString()[len("struct<"):-1]
    todo, done, tables = edges.withColumn("more", F.lit(0).cast("long")), None, []
    while True:
        step = F.when(F.col("side") == 1, F.col("more")).otherwise(-F.col("more"))
        sides = [("id", "twin", "pos"), ("pid", "ptwin", "ppos")]
        asks = [todo.select(F.struct(F.col(i).alias("id"), F.col(t).alias("twin")).alias("doc"), (F.col(p) + step).alias("at"), "side")
                for i, t, p in sides]
        asks = materialize(asks[0].unionByName(asks[1]).distinct().groupBy("doc").agg(F.collect_list(F.struct("at", "side")).alias("asks")),
                           "asks", "zstd")

        def cut(batches: Iterator[pa.RecordBatch], reach: int = reach) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, at, side, near = [], [], [], []
                for i, (text, wanted) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                    for ask in wanted:
                        x = ask["at"]
                        row.append(i)
                        at.append(x)
                        side.append(ask["side"])
                        near.append(text[x:x + reach] if ask["side"] else text[max(0, x - reach):x][::-1])
                doc = batch.column(0).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*doc.flatten(), pa.array(at, pa.int64()),
                     pa.array(side, pa.int32()), pa.array(near, pa.string())], names=["id", "twin", "at", "side", "near"])

        def share(df: DataFrame, i: int) -> DataFrame:
            return df.filter(F.pmod(F.xxhash64("doc"), F.lit(PARTS)) == i)

        # rows that repeat an id and a text are cut once
        contexts = [materialize(
            share(texts, i).join(share(asks, i), "doc").dropDuplicates(["doc"]).select("doc", "text", "asks")
            .mapInArrow(cut, f"id {id_type}, twin long, at long, side int, near string"), "contexts", "zstd") for i in range(PARTS)]
        release(asks)
        near = reduce(DataFrame.unionByName, contexts)
        def facing(side: int) -> DataFrame:
            joined, told = todo.filter(F.col("side") == side), near.filter(F.col("side") == side)
            for (i, t, p), name in zip(sides, ("a", "b")):
                joined = joined.join(told.select(F.col("id").alias("__i"), F.col("twin").alias("__t"), F.col("at").alias("__a"),
                                                 F.col("near").alias(name)),
                                     F.col(i).eqNullSafe(F.col("__i")) & (F.col(t) == F.col("__t"))
                                     & (F.col(p) + step == F.col("__a"))).drop("__i", "__t", "__a")
            return joined

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-2], pa.array([common_prefix(x, y) for x, y in zip(a, b)], pa.int64())],
                    names=[*batch.schema.names[:-2], "same"])

        seen = [materialize(facing(side).mapInArrow(compare, f"{kind}, more long, same long"), "extensions", "zstd") for side in (0, 1)]
        release(*contexts)
        tables += seen
        grown = reduce(DataFrame.unionByName, seen).withColumn("more", F.col("more") + F.col("same"))
        todo = grown.filter(F.col("same") == reach).drop("same")
        ended = grown.filter(F.col("same") < reach).select("id", "twin", "run", "side", "more")
        done = ended if done is None else done.unionByName(ended)
        if todo.isEmpty():
            return done, tables
        reach *= 8


def common_prefix(a: str, b: str) -> int:
    """Code points that two strings share from their beginning on."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def repeated_places(rows: DataFrame) -> DataFrame:
    """(id, start, twin, chars, later, other) of the places of ``chunk_rows``
    whose digest occurs more than once: whether it is a ``later`` place than
    the digest's first, and the ``other`` place to compare it with."""
    order = Window.partitionBy("hi", "lo").orderBy("id", "at")
    own = F.struct("id", "at")
    place = rows.withColumns({"n": F.row_number().over(order), "next": F.lead(own).over(order), "first": F.first(own).over(order),
                              "before": F.lag(own).over(order)})
    # a place that rows repeat says the same from its second row on
    said = F.when((F.col("n") > 2) & (F.col("before") == own), F.array()).otherwise(F.array(F.struct(
        "id", "at", (F.col("n") > 1).alias("later"), "other")))
    place = place.withColumn("other", F.when(F.col("n") > 1, F.col("first")).otherwise(F.coalesce(
        F.get(F.filter("others", lambda o: o != own), F.lit(0)), F.col("next"))))
    found = place.filter((F.col("n") > 1) | F.col("next").isNotNull() | (F.size("others") > 0)).select(F.explode(F.concat(
        said, F.transform("others", lambda o: F.struct(o["id"].alias("id"), o["at"].alias("at"), F.lit(True).alias("later"),
                                                 F.col("first").alias("other"))))).alias("c"))
    twin_of = lambda at: F.shiftright(at, LENGTH_BITS).bitwiseAND(F.lit((1 << TWIN_BITS) - 1))
    start_of = lambda at: F.shiftright(at, TWIN_BITS + LENGTH_BITS)
    here = F.col("c.other").isNull() | (F.col("c.other") == F.struct("c.id", "c.at"))
    return found.select(
        F.col("c.id").alias("id"), start_of("c.at").alias("start"), twin_of("c.at").alias("twin"),
        F.col("c.at").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).alias("chars"), "c.later",
        F.struct(here.alias("here"), F.col("c.other.id").alias("pid"), twin_of("c.other.at").alias("ptwin"),
                 start_of("c.other.at").alias("pstart")).alias("other"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 100,
                   every: int = 24) -> DataFrame:
    """One row per input row: (id, text_hash, ``n_chars``, ``repeated_chars``
    inside passages that occur elsewhere too, ``dropped_chars``, and
    ``dropped_spans``, sorted (start, end) code points).

    A passage is a run of adjoining chunks whose digests all occur more than
    once, with the text on both sides that is the same at another place of
    its first and last chunk (the first place; for that one, the next).  It
    has ``min_chars`` code points at least; shorter ones (common phrases) are
    left alone.  The first place of a chunk, by id and then by position,
    stays; its other places are dropped with the text beside them, in the
    same document too.  Null and empty texts have no chunks.  Null ids come
    first.  Rows that repeat an id with one text are one document, and each
    gets its row.

    Chunk rows cross the network once, ordered by digest (a window that
    streams and spills), in ``PARTS`` turns that each read the texts, so that
    the disk holds one share of them at a time; only repeated ones travel on,
    once, to their documents.  Texts cross it once more, in as many turns, for
    the ``min_chars`` code points on either side of a run."""
    places = [materialize(repeated_places(chunk_rows(docs, id_col=id_col, text_col=text_col, every=every, part=i, parts=PARTS)),
                          "places", "zstd") for i in range(PARTS)]
    # rows that repeat an id and a text give the same places: once is enough
    found = reduce(DataFrame.unionByName, places).repartition("id", "twin").groupBy("id", "twin", "start", "chars").agg(
        F.min("later").alias("later"), F.min("other").alias("other"))
    per_doc = Window.partitionBy("id", "twin").orderBy("start")
    fresh = F.coalesce((F.col("start") != F.lag(F.col("start") + F.col("chars")).over(per_doc)).cast("int"), F.lit(1))
    found = materialize(found.withColumn("__new", fresh).withColumn("run", F.sum("__new").over(per_doc)).drop("__new"),
                        "chunks", "zstd")
    release(*places)

    end = F.col("start") + F.col("chars")
    edge = F.struct("start", "chars", "other")
    run = materialize(found.groupBy("id", "twin", "run").agg(
        F.min("start").alias("start"), F.max(end).alias("end"), F.min(edge).alias("head"), F.max(edge).alias("tail")), "runs", "zstd")
    sides = [run.select("id", "twin", "run", F.lit(side).alias("side"), F.col(pos).alias("pos"), f"{chunk}.other.pid",
                        f"{chunk}.other.ptwin", (F.col(f"{chunk}.other.pstart") + past).alias("ppos"))
             .filter(~F.col(f"{chunk}.other.here") & (F.lit(side == 1) | (F.least("pos", "ppos") > 0)))
             for side, pos, chunk, past in ((0, "start", "head", F.lit(0)), (1, "end", "tail", F.col("tail.chars")))]
    grown, tables = extensions(docs, sides[0].unionByName(sides[1]), id_col=id_col, text_col=text_col, reach=max(1, min_chars))
    grown = grown.groupBy("id", "twin", "run").agg(*[
        F.max(F.when(F.col("side") == side, F.col("more"))).alias(name) for side, name in ((0, "before"), (1, "after"))])

    def same_run(a: str, b: str) -> Column:
        return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.twin") == F.col(f"{b}.twin")) & (
            F.col(f"{a}.run") == F.col(f"{b}.run"))

    before, after = F.coalesce("g.before", F.lit(0)), F.coalesce("g.after", F.lit(0))
    long = run.alias("r").join(grown.alias("g"), same_run("r", "g"), "left").filter(
        F.col("r.end") - F.col("r.start") + before + after >= min_chars).select(
        "r.id", "r.twin", "r.run", F.col("r.start").alias("first"), F.col("r.end").alias("last"),
        before.alias("before"), after.alias("after"))
    marked = found.alias("f").join(long.alias("l"), same_run("f", "l")).select(
        "f.id", "f.twin", "f.later",
        (F.col("start") - F.when(F.col("start") == F.col("first"), F.col("before")).otherwise(0)).alias("start"),
        (end + F.when(end == F.col("last"), F.col("after")).otherwise(0)).alias("end"))
    marked = materialize(marked, "marked", "zstd")
    release(found, run, *tables)

    def merged(df: DataFrame) -> DataFrame:
        """Spans that touch or overlap become one."""
        reached = F.max("end").over(per_doc.rowsBetween(Window.unboundedPreceding, -1))
        new = F.coalesce((F.col("start") > reached).cast("int"), F.lit(1))
        return (df.withColumn("__new", new).withColumn("cut", F.sum("__new").over(
            per_doc.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "twin", "cut")
            .agg(F.min("start").alias("start"), F.max("end").alias("end")))

    per_row = merged(marked).groupBy("id", "twin").agg(F.sum(F.col("end") - F.col("start")).alias("repeated_chars")).alias("m")
    spans = merged(marked.filter("later")).groupBy("id", "twin").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("dropped_spans"),
        F.sum(F.col("end") - F.col("start")).alias("dropped_chars")).alias("s")
    per_row = per_row.join(spans, F.col("m.id").eqNullSafe(F.col("s.id")) & (F.col("m.twin") == F.col("s.twin")), "left").select(
        "m.id", "m.twin", "m.repeated_chars", "s.dropped_spans", "s.dropped_chars")
    base = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("text_hash"),
                       F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("n_chars"))
    twin = F.pmod(F.col("b.text_hash"), F.lit(1 << TWIN_BITS))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return base.alias("b").join(per_row.alias("r"), F.col("b.__id").eqNullSafe(F.col("r.id")) & (twin == F.col("r.twin")),
                                "left").select(
        F.col("b.__id").alias(id_col), "b.text_hash", "b.n_chars",
        F.coalesce("r.repeated_chars", F.lit(0)).cast("long").alias("repeated_chars"),
        F.coalesce("r.dropped_chars", F.lit(0)).cast("long").alias("dropped_chars"),
        F.coalesce("r.dropped_spans", empty).alias("dropped_spans"))


def cut_spans(docs: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the dropped spans cut out of their texts; all input
    columns stay."""
    found = spans.filter(F.size("dropped_spans") > 0).select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), "dropped_spans").distinct()
    hashed = docs.withColumn("__text_hash", F.xxhash64(text_col))
    joined = hashed.alias("d").join(found.alias("s"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("s.__id"))
                                    & (F.col("d.__text_hash") == F.col("s.__hash")), "left")
    text, drop = F.col(f"d.`{text_col}`"), F.col("s.dropped_spans")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(drop, lambda s: s["end"]))
    ends = F.concat(F.transform(drop, lambda s: s["start"]), F.array(F.char_length(text).cast("long")))
    kept = F.array_join(F.zip_with(begins, ends, lambda b, e: F.substring(text, (b + 1).cast("int"), (e - b).cast("int"))), "")
    return joined.select(*[F.when(drop.isNull(), text).otherwise(kept).alias(c) if c == text_col
                           else F.col(f"d.`{c}`") for c in docs.columns])
