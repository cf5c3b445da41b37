"""Ticket messages as a Structured Streaming job.

Messages arrive as JSON lines in a folder (file source).  Each line is
parsed strictly into the ticket struct; the action code is set (overwritten)
on every accepted message, unparsable lines go to a reject sink.  The same
stateless column rules as the batch path validate and route each ticket, so
a stream and a batch over the same messages give the same rows.  With the
``availableNow`` trigger a run drains what is there and stops; progress is
kept in the checkpoint folder, so a restarted run resumes without
reprocessing and a lost executor only retries its micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tickets as TK
from ..operators.flows import Tools, process_tickets
from ..sources.tickets import parse_ticket, with_action_code


def dispatch_outcome(messages: DataFrame) -> DataFrame:
    """Validation and lane decision per message (stateless).  Rejected lines
    keep their raw text and NULL outcome columns, so one pass over a batch
    yields both outputs."""
    t = F.col("ticket")
    miss = TK.dispatch_missing(t)
    route = TK.dispatch_route(t)
    ok = t.isNotNull()
    payload = [F.col("payload")] if "payload" in messages.columns else []
    return messages.select(ok.alias("accepted"), F.when(~ok, F.col("raw")).alias("raw"), *payload,
                           t["eventId"].alias("eventId"), t["processActionCode"].alias("processActionCode"),
                           F.when(ok, F.size(miss) == 0).alias("valid"),
                           F.when(ok, TK.dispatch_error(miss)).alias("error"),
                           F.when(ok, route["lane"]).alias("lane"), F.when(ok, route["route_status"]).alias("route_status"))


def parse_messages(raw: DataFrame, action_code: str | None = None) -> DataFrame:
    """(raw, payload, ticket) from a DataFrame of raw JSON lines (batch or
    stream).  The payload is the accepted message whole, keys outside the
    ticket schema too, with the action code set (overwritten) if one is
    given; it is what goes on.

    The strict test and the ticket are columns before anything reads them, so
    a message is tested and parsed once."""
    raw = raw.select("raw", TK.strict_json_object(F.col("raw")).alias("strict"))
    raw = raw.select("raw", "strict", parse_ticket(F.col("raw"), F.col("strict")).alias("ticket"))
    t = F.col("ticket")
    payload = F.when(t.isNotNull(), F.col("raw"))
    if action_code is not None:
        t = F.when(t.isNotNull(), t.withField("processActionCode", F.lit(action_code)))
        payload = with_action_code(F.col("raw"), action_code, F.col("strict"))
    return raw.select("raw", payload.alias("payload"), t.alias("ticket"))


def run_dispatch(spark: SparkSession, in_folder: str, out_path: str, checkpoint: str,
                 action_code: str = "EventHandlerLookup") -> None:
    """Drain the message folder once (``availableNow``) into a Parquet table
    partitioned by ``accepted`` (outcomes under ``accepted=true``, rejected
    raw lines under ``accepted=false``).

    The stream itself carries only raw lines; each micro-batch is parsed and
    written once inside ``foreachBatch`` (a micro-batch arrives there as an
    already-planned scan, so parsing in the stream plan could not be pruned
    or re-optimized per batch).  Writes go under the batch id, so a batch
    retried after a failure overwrites its own files instead of duplicating
    them; progress lives in the checkpoint, so a restarted run resumes where
    it stopped."""
    raw = spark.readStream.format("text").load(in_folder).select(F.col("value").alias("raw"))

    def write(batch: DataFrame, batch_id: int) -> None:
        # The ticket struct is read field by field; letting the optimizer push
        # each field access into its own pruned from_json would parse every
        # message once per field.  The micro-batch runs in the stream's own
        # cloned session, so this does not leak into the caller's session.
        batch.sparkSession.conf.set("spark.sql.optimizer.enableJsonExpressionOptimization", "false")
        (dispatch_outcome(parse_messages(batch, action_code)).write.mode("overwrite").partitionBy("accepted")
         .parquet(f"{out_path}/batch={batch_id}"))

    q = (raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_outcomes(spark: SparkSession, out_path: str) -> DataFrame:
    """Accepted outcomes of all micro-batches."""
    return (spark.read.option("basePath", out_path).parquet(out_path)
            .filter(F.col("accepted").cast("string") == "true").drop("accepted", "raw", "batch"))


def read_rejects(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).filter(F.col("accepted").cast("string") == "false").select("raw")


def write_flows(batch: DataFrame, batch_id: int, out_path: str, tools: Tools) -> None:
    """One micro-batch of raw lines through the three flows into the sinks
    results, forwards and rejects, each a folder of text lines under the batch
    id: a batch that comes again overwrites its own files, and asks the model
    nothing that its answer table holds."""
    for name, rows in process_tickets(parse_messages(batch.select("raw")), tools).items():
        rows.filter("value is not null").write.mode("overwrite").text(f"{out_path}/{name}/batch={batch_id}")


def run_flows(spark: SparkSession, in_folder: str, out_path: str, checkpoint: str, tools: Tools) -> None:
    """Drain the message folder once (``availableNow``) through ``write_flows``;
    a restarted run goes on where the checkpoint says.  The rule index and the
    captions are static tables that every micro-batch joins."""
    raw = spark.readStream.format("text").load(in_folder).select(F.col("value").alias("raw"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.optimizer.enableJsonExpressionOptimization", "false")  # see run_dispatch
        write_flows(batch, batch_id, out_path, tools)

    raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_flow(spark: SparkSession, out_path: str, name: str) -> DataFrame:
    """Lines of one sink over all micro-batches."""
    return spark.read.text(f"{out_path}/{name}").select("value")
