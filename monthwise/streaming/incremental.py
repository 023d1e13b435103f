"""Take in newly arrived deliveries exactly once.

The stream is over *deliveries* (``deliveries.py``), not over the Parquet rows:
month files differ in schema, and a Parquet stream needs one fixed schema.  A
micro-batch is a set of whole deliveries with their files.  ``foreachBatch``
takes the newest of each month and runs ``load_months``.  A delivery older than
the one that the ledger says was loaded is left out, so an old file that comes
late does not undo a newer one.  A new file that names no month fails the batch
(or is reported, see ``unnamed``), so it is never marked as seen in silence.
``load_months`` is safe to repeat, so a batch replayed after a crash has the
same effect as once: the checkpoint gives at-least-once delivery, idempotence
makes it exactly-once.

``trigger(availableNow=True)`` processes what is there and stops -- a
scheduled run; ``processingTime`` keeps it running.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.contract import TRIP_CONTRACT, Contract
from monthwise.functions.calendar import LANDING_PREFIX, month_from_file_name
from monthwise.operators.ledger import last_delivery
from monthwise.plans.load import OPEN_MONTHS, load_months
from monthwise.sources.landing import scan_files, scan_path
from monthwise.streaming.deliveries import Deliveries, batch_state, finish_deliveries

#: Files of less are packed many to a split, so that it holds rows of many months.
SMALL_FILE = 4 << 20


@dataclass
class IncrementalLoad:
    """``target_root`` / ``ledger_root``: the path form.  With ``table`` and
    ``ledger_table`` set, each batch loads into that catalog table instead
    (``load_months_to_table``: write, gate what was written, swap)."""

    landing: str
    target_root: str | None
    ledger_root: str | None
    checkpoint: str
    contract: Contract = TRIP_CONTRACT
    prefix: str = LANDING_PREFIX
    # whole deliveries up to so many files a batch (a larger one comes alone)
    max_files_per_trigger: int | None = None
    # "archive" | "delete" | None: deliveries of any number of files go as a
    # whole, once the batch that loaded them has finished
    clean_source: str | None = None
    unnamed: str = "fail"  # or "report": to the rows of unnamed_root
    unnamed_root: str | None = None
    archive_dir: str | None = None
    rebalance: bool = False  # always so for batches of many small files
    table: str | None = None
    ledger_table: str | None = None
    max_lost: int | None = None  # see ``load_months``

    def source_options(self) -> dict[str, str]:
        options = {"path": self.landing, "log": f"{self.checkpoint.rstrip('/')}/deliveries", "prefix": self.prefix}
        if self.clean_source:
            options["clean"] = self.clean_source
            options["archive"] = self.archive_dir or f"{self.landing.rstrip('/')}-archive"
        if self.max_files_per_trigger:
            options["maxFiles"] = str(self.max_files_per_trigger)
        return options

    def delivery_stream(self, spark: SparkSession) -> DataFrame:
        spark.dataSource.register(Deliveries)
        return spark.readStream.format(Deliveries.name()).options(**self.source_options()).load()

    def load_batch(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        self._check_names(batch, epoch_id)
        named = batch.where("unit <> ''").withColumn("date", month_from_file_name(F.col("unit"), self.prefix))
        sent = named.groupBy("date", "manifest", "unit").agg(
            F.max("modificationTime").alias("modificationTime"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("length"),
        )
        delivery = F.struct("manifest", "unit", "modificationTime", "n_files", "length")
        newest = F.max_by(delivery, F.struct("modificationTime", "unit", "manifest"))
        newest = sent.groupBy("date").agg(newest.alias("d")).select("date", "d.*")
        seen = last_delivery(spark, self._ledger_root(spark)).withColumnRenamed("delivered_at", "_seen")
        delivered = F.col("modificationTime").cast("timestamp_ntz")
        newest = newest.join(seen, "date", "left").where(F.col("_seen").isNull() | (F.col("_seen") <= delivered))
        picks = newest.select("date", "manifest", "unit", "n_files", "length", delivered.alias("delivered_at"))
        picks = picks.collect()  # a row a month
        if not picks:
            return
        chosen = spark.createDataFrame([(r["manifest"], r["unit"]) for r in picks], "manifest long, unit string")
        files = named.join(chosen, ["manifest", "unit"], "left_semi")
        files = files.select("path", scan_path("path", self.prefix).alias("scan"))
        frame = scan_files(spark, files, self.contract, self.prefix, lost=True)
        n_files, length = sum(r["n_files"] for r in picks), sum(r["length"] for r in picks)
        many = n_files > OPEN_MONTHS * len(picks) and length < SMALL_FILE * n_files
        options = {
            "months": [r["date"] for r in picks],
            "contract": self.contract,
            "rebalance": self.rebalance or many,
            "max_lost": self.max_lost,
            "delivered": {r["date"]: r["delivered_at"] for r in picks},
        }
        if self.table is not None:
            from monthwise.plans.catalog import load_months_to_table

            load_months_to_table(spark, frame, self.table, self.ledger_table, **options)
        else:
            load_months(spark, frame, self.target_root, self.ledger_root, **options)

    def _ledger_root(self, spark: SparkSession) -> str:
        if self.table is None:
            return self.ledger_root
        from monthwise.plans.catalog import table_location

        return table_location(spark, self.ledger_table)

    def _check_names(self, batch: DataFrame, epoch_id: int) -> None:
        odd = batch.where("unit = ''").select("path", "modificationTime", "length")
        if self.unnamed == "report":
            if self.unnamed_root is None:
                raise ValueError("unnamed='report' needs unnamed_root")
            # one folder a batch, so a replayed batch reports its files once
            odd.write.mode("overwrite").parquet(f"{self.unnamed_root.rstrip('/')}/batch={epoch_id}")
            return
        if names := [r["path"] for r in odd.select("path").limit(10).collect()]:
            raise ValueError(f"landing files that name no month: {names}")

    def run_available(self, spark: SparkSession) -> None:
        """Process every delivery not yet seen, then stop."""
        while True:
            before, unfinished = batch_state(self.checkpoint)
            q = self._writer(spark).trigger(availableNow=True).start()
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
            # Spark commits a batch to the source when the next one begins
            finish_deliveries(self.source_options(), self.checkpoint)
            # a run makes one batch; one that had to finish an old batch has not looked for more
            capped = self.max_files_per_trigger and batch_state(self.checkpoint)[0] > before
            if not capped and not unfinished:
                return

    def start(self, spark: SparkSession, every: str = "1 minute"):
        return self._writer(spark).trigger(processingTime=every).start()

    def _writer(self, spark: SparkSession):
        stream = self.delivery_stream(spark).writeStream.foreachBatch(self.load_batch)
        return stream.option("checkpointLocation", self.checkpoint)
