"""K1: landing writer — newline-delimited JSON, one immutable folder per batch.

The landing form carries every DATE / TIMESTAMP column as epoch milliseconds
(what the silver layer reads back with ``DATE(TIMESTAMP_MILLIS(x))``) and keeps
NULL fields, so a column that is NULL in a whole batch still exists.

The write is distributed (each task writes its own part file); nothing passes
through the driver. A batch is not read before the audit log names it, so a write
that failed half-way is never seen, and a retry of it replaces its own folder only.

The jobs write compressed text: a row repeats the names of its columns and its keys, so
plain batches take about twenty times the disk of the tables they come from. Readers
tell a file's codec by its ending; plain and compressed batches of a table are read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyward.functions import sql as X
from tallyward.schemas import LOAD_DATE
from tallyward.sources.files import batch_dir

#: Codec of the text files that jobs write, and how hard it tries: the default level makes a batch
#: a tenth smaller and takes nearly twice the time.
CODEC = "gzip"
LEVEL = "FOUR"
#: Rows of a compressed file: it is read by one task, so it is not larger than what a task reads.
FILE_ROWS = 250_000


def landing_form(df: DataFrame) -> DataFrame:
    """Operational table → landing columns (temporal columns as epoch millis)."""
    return df.selectExpr(*(f"{X.epoch_millis(f.name, f.dataType)} AS {X.ident(f.name)}" for f in df.schema.fields))


def text_options(codec: str | None) -> dict[str, str | int]:
    """Options of a JSON or CSV writer for a codec; none for plain text."""
    return {"compression": codec, "zlib.compress.level": LEVEL, "maxRecordsPerFile": FILE_ROWS} if codec else {}


def write_landing(df: DataFrame, table_dir: str, batch: str, load_date: str, codec: str | None = None) -> int:
    """Write one batch to ``table_dir/batch=<batch>/load_date=<ddMMyyyy>/`` and
    return its row count. ``codec``: one of Spark's text codecs; plain text without one.

    The count is observed during the write itself (no second scan of the source,
    so the audited count is the count of what was written).
    """
    seen = Observation()  # loads write at the same time
    out = landing_form(df).withColumn(LOAD_DATE, F.lit(load_date)).observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        out.write.mode("overwrite")
        # the batch's folder is replaced whole even where the cluster defaults to
        # dynamic partition overwrite
        .option("partitionOverwriteMode", "static")
        .option("ignoreNullFields", "false")
        .options(**text_options(codec))
        .partitionBy(LOAD_DATE)
        .json(batch_dir(table_dir, batch))
    )
    return int(seen.get["rows"])
