"""A plan over a stream without a barrier between stages: each stage is a query of its own, reading what the one before wrote.

Rows come in chunks, and chunks are dealt to lanes. A lane has a chain of queries, one a stage: a stage takes a chunk as soon
as the stage before has written it, whatever other chunks do, so a slow one holds up the chunks behind it in its lane and
stage, and no others. Stages write with Spark's file sink, whose log makes each micro-batch count once, and read it back
through that log; checkpoints and outputs lie under the stage's signature, so a restart redoes nothing, and a changed stage
starts from what the stage before it has. Stages fuse rows, errors and provenance as in a batch plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sievework.plans import plan as P
from sievework.sources import jsonl as S


class Counters(StreamingQueryListener):
    """Rows and errors by query, summed over micro-batches, from what the stages observe of themselves."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in (event.progress.observedMetrics or {}).items():
            own = self.counts.setdefault(name, {"rows": 0, "errors": 0})
            for k in own:
                own[k] += row[k] or 0

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass(frozen=True)
class Flow:
    """schema: of the rows that are fed, chunk_id (a string) among them."""

    spark: SparkSession
    root: str
    plan: P.Plan
    schema: str
    lanes: int = 4

    def stages(self) -> list[tuple[P.Stage, str, str]]:
        """(stage, signature, folder), of a plan that has no limit: a limit needs all rows before it."""
        found = P.check(self.plan)
        if limited := [s.id for s in found if s.limit is not None]:
            raise P.PlanError(f"a stream has no first rows: {limited}")
        sigs = P.signatures(self.plan, f"stream:{self.lanes}")
        return [(s, sig, f"{self.root}/{S.stage_key(i, s.id, sig)}") for i, (s, sig) in enumerate(zip(found, sigs))]

    def feed(self, df: DataFrame) -> None:
        """Add rows. A chunk is all in one call; its lane is by its id."""
        names = T._parse_datatype_string(self.schema).names
        lane = F.pmod(F.xxhash64("chunk_id"), F.lit(self.lanes))
        df.select(*names, lane.alias("lane")).repartition("chunk_id").write.mode("append").partitionBy("lane").parquet(f"{self.root}/in")

    def compiled(self, df: DataFrame, stage: P.Stage, sig: str) -> DataFrame:
        out = P.compile_stage(df, stage, sig)
        return out.observe(f"{stage.id}-{sig}", F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce("error", F.lit(False))).alias("errors"))

    def start(self, trigger: dict | None = None, files: int = 8) -> list[StreamingQuery]:
        """Start all lanes' stages; trigger as writeStream's (by default every second), files: how many files (a chunk lies in
        one) a micro-batch takes at most."""
        out = []
        for lane in range(self.lanes):
            schema, before = T._parse_datatype_string(self.schema), f"{self.root}/in/lane={lane}"
            S.make_dir(self.spark, before)
            for stage, sig, folder in self.stages():
                rows = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(before)
                done = self.compiled(rows, stage, sig)
                at = f"{folder}/lane={lane}"
                S.make_dir(self.spark, f"{at}/rows")
                out.append(done.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/checkpoint").trigger(**(trigger or {"processingTime": "1 second"})).start())
                schema, before = done.schema, f"{at}/rows"
        return out

    def drain(self, files: int = 8) -> None:
        """Run until all that has been fed is through, and stop. Stages run at the same time; each is waited for in order."""
        running = self.start(files=files)
        try:
            for q in running:
                q.processAllAvailable()
        finally:
            for q in running:
                q.stop()

    def rows(self, stage: str | None = None) -> DataFrame:
        """What a stage has put out so far (the last one unless named), of all lanes."""
        schema, out = T._parse_datatype_string(self.schema), None
        for s, sig, folder in self.stages():
            schema = P.compile_stage(self.spark.createDataFrame([], schema), s, sig).schema
            if s.id == stage:
                break
        for lane in range(self.lanes):
            path = f"{folder}/lane={lane}/rows"
            # without the sink's log nothing has been put out yet
            one = self.spark.read.schema(schema).parquet(path) if S.exists(self.spark, f"{path}/_spark_metadata") else self.spark.createDataFrame([], schema)
            out = one if out is None else out.unionByName(one)
        return out

    def done(self) -> DataFrame:
        """(stage, chunk_id) that are through, as control's set logic takes them."""
        out = self.spark.createDataFrame([], "stage int, chunk_id string")
        for i, (s, _, _) in enumerate(self.stages()):
            out = out.unionByName(self.rows(s.id).select(F.lit(i).alias("stage"), "chunk_id").distinct())
        return out
