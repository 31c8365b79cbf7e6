"""The refresh procedure as a file stream.

The source procedure is: import new order-line CSV files into the source
tables, reload the mart (dimensions, then facts), run the reconciliation
checks, let the BI tool refresh. Here a Structured Streaming file source
watches a landing folder; each micro-batch

1. imports its lines under ``detailcommande_incoming/batch=<stream>-<epoch>``,
   good lines and rejected ones apart (``rejet``), where the stream is named by
   its checkpoint folder. The folder is written in overwrite mode, so a batch
   replayed after a failure replaces its own lines; another stream has other
   folders. The files of the batch (path, size, time) go to
   ``imported_files/batch=...``. That small table, not the lines, tells which files
   other batches have imported: the same file counts once even where a new
   checkpoint sees it again, and the lines of a file whose path was imported with another
   size or time are rejected with the rule ``fichier_remplace``, as they may
   repeat lines that are in the tables;
2. refreshes the mart from the sources as they now are (a new version:
   dimensions insert-if-absent, facts of the changed years rewritten, version
   marker last), and deletes versions older than the last two;
3. writes the revenue and order-count reconciliations (Q1, Q2) of that
   version under ``<mart_root>/_checks/batch=<stream>-<epoch>``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException

from salesmart.operators.quality import dq_order_count, dq_revenue_reconciliation
from salesmart.plans.mart import expire_versions, refresh
from salesmart.schema import DETAILCOMMANDE
from salesmart.sources.files import CHECKED, RAW_LINES_CSV, RAW_OPTIONS, checked_order_lines, read_oltp, with_source_file, write_checked_lines

LINE_COLS = [f.name for f in DETAILCOMMANDE.fields]
FILE = ("source_file", "source_size", "source_time")


def order_lines_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming S1: the raw lines of CSV files as they arrive in ``landing_dir``, each with its file."""
    r = spark.readStream.options(**RAW_OPTIONS).schema(RAW_LINES_CSV)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_source_file(r.csv(landing_dir))


def incoming_path(oltp_root: str) -> str:
    return f"{oltp_root.rstrip('/')}/detailcommande_incoming"


def files_path(oltp_root: str) -> str:
    return f"{oltp_root.rstrip('/')}/imported_files"


INCOMING = f"{CHECKED}, batch string"
FILES = "source_file string, source_size long, source_time timestamp, batch string"


def _read_if_there(spark: SparkSession, schema: str, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_incoming(spark: SparkSession, oltp_root: str) -> DataFrame | None:
    """The imported lines, rejected ones too, with their file and batch; None where nothing was imported yet."""
    return _read_if_there(spark, INCOMING, incoming_path(oltp_root))


def read_imported_files(spark: SparkSession, oltp_root: str) -> DataFrame | None:
    """(path, size, time, batch) of every file imported, a row per file."""
    return _read_if_there(spark, FILES, files_path(oltp_root))


def read_rejected(spark: SparkSession, oltp_root: str) -> DataFrame | None:
    """The rejected lines of all batches with the rules they break."""
    incoming = read_incoming(spark, oltp_root)
    return None if incoming is None else incoming.where("rejet").select("ligne", "regles", "source_file", "batch")


def read_lines(spark: SparkSession, oltp_root: str) -> DataFrame:
    """The source line table: the base snapshot plus the good lines of every imported batch."""
    base = spark.read.schema(DETAILCOMMANDE).parquet(f"{oltp_root.rstrip('/')}/detailcommande")
    incoming = read_incoming(spark, oltp_root)
    return base if incoming is None else base.unionByName(incoming.where("NOT rejet").select(LINE_COLS))


def import_batch(raw: DataFrame, oltp_root: str, name: str) -> None:
    """Write the lines of a batch, good and rejected, then its files; files of other batches are left out."""
    spark = raw.sparkSession
    files = raw.select(*FILE).distinct()
    lines = checked_order_lines(raw, FILE)
    known = read_imported_files(spark, oltp_root)
    if known is not None:
        known = known.where(F.col("batch") != name)  # a row per file: small beside the lines
        files = files.join(known.select(*FILE), list(FILE), "left_anti")
        lines = lines.join(known.select(*FILE), list(FILE), "left_anti")
        paths = known.select("source_file").distinct().withColumn("_replaced", F.lit(True))
        lines = lines.join(paths, "source_file", "left").withColumn(
            "regles", F.when(F.col("_replaced"), F.array_append("regles", F.lit("fichier_remplace"))).otherwise(F.col("regles")))
    write_checked_lines(lines.select(*LINE_COLS, "ligne", "regles", "source_file"), f"{incoming_path(oltp_root)}/batch={name}", "overwrite")
    files.coalesce(1).write.mode("overwrite").parquet(f"{files_path(oltp_root)}/batch={name}")


def batch_handler(oltp_root: str, mart_root: str, stream: str) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does; ``stream`` is the same name in all starts of a stream."""
    def handle(raw: DataFrame, epoch_id: int) -> None:
        spark, name = raw.sparkSession, f"{stream}-{epoch_id}"
        import_batch(raw, oltp_root, name)
        oltp = replace(read_oltp(spark, oltp_root), detailcommande=read_lines(spark, oltp_root))
        mart = refresh(spark, oltp, mart_root, incremental=True)
        counts = dq_order_count(oltp, mart)
        checks = dq_revenue_reconciliation(oltp, mart).select(
            "*",
            counts.select("commandes_oltp").scalar().alias("commandes_oltp"),
            counts.select("commandes_dw").scalar().alias("commandes_dw"))
        checks.write.mode("overwrite").parquet(f"{mart_root.rstrip('/')}/_checks/batch={name}")
        expire_versions(spark, mart_root)
    return handle


def start_refresh_stream(spark: SparkSession, landing_dir: str, oltp_root: str, mart_root: str,
                         checkpoint: str, available_now: bool = True,
                         every: str = "5 minutes") -> StreamingQuery:
    """Start the stream. ``checkpoint`` is its folder on shared storage, the
    same one in every start. ``available_now`` processes what has landed and
    stops (a scheduled refresh); otherwise it polls every ``every``."""
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    w = (order_lines_stream(spark, landing_dir).writeStream
         .foreachBatch(batch_handler(oltp_root, mart_root, stream))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
