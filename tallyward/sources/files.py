"""File sources: typed CSV scans (S3, S4), the untyped control CSV (S5) and the
landing JSON folders that make up the bronze layer (S6).

Every reader is given its schema. CSV fields bind by position (header names are
skipped, not checked, unless ``strict_header``); malformed cells become NULL
(PERMISSIVE), as the source files are loaded today.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import schemas
from tallyward.operators.layers import BronzeLayer, LazyFrames
from tallyward.specs import ENTITIES, HOSPITALS, SOURCE_KEYS, Hospital

CLAIMS_GLOB = "hospital*_claim_data.csv"
BATCH = "batch"


def read_claims_csv(spark: SparkSession, path: str, strict_header: bool = False) -> DataFrame:
    """S3: claim files (a glob such as ``landing/claims/hospital*_claim_data.csv``)."""
    return spark.read.csv(
        path,
        header=True,
        schema=schemas.CLAIMS,
        dateFormat="yyyy-MM-dd",
        enforceSchema=not strict_header,
    )


def read_cptcodes_csv(spark: SparkSession, path: str, strict_header: bool = False) -> DataFrame:
    """Procedure codes; quoted descriptions may span lines."""
    return spark.read.csv(
        path,
        header=True,
        schema=schemas.CPTCODES,
        multiLine=True,
        quote='"',
        enforceSchema=not strict_header,
    )


def read_load_config(spark: SparkSession, path: str) -> DataFrame:
    """The load-control file, all fields as strings (flags compare to '1')."""
    return spark.read.csv(path, header=True, schema=schemas.LOAD_CONFIG)


def with_lineage(df: DataFrame, extraction_timestamp: str) -> DataFrame:
    """The file each row came from, and the load's timestamp."""
    return df.withColumn("source_file_path", F.input_file_name()).withColumn(
        "extraction_timestamp", F.lit(extraction_timestamp).cast("timestamp")
    )


def landing_dir(landing_root: str, hospital: Hospital, entity: str) -> str:
    return f"{landing_root.rstrip('/')}/{hospital.name}/{entity}"


def batch_dir(table_dir: str, batch: str) -> str:
    return f"{table_dir.rstrip('/')}/{BATCH}={batch}"


def read_batch(spark: SparkSession, table_dir: str, batch: str, schema: T.StructType) -> DataFrame:
    """One landing batch. ``load_date`` stays a string."""
    return spark.read.schema(schema).json(batch_dir(table_dir, batch))


def read_batches(spark: SparkSession, table_dir: str, batches: Sequence[str], schema: T.StructType) -> DataFrame:
    """Several batches of a table, with ``load_date`` and ``batch``; no batch, no rows."""
    full = T.StructType([*schema.fields, *(T.StructField(n, T.StringType()) for n in (schemas.LOAD_DATE, BATCH) if n not in schema.fieldNames())])
    if not batches:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", table_dir).json([batch_dir(table_dir, b) for b in batches])


def read_landing(spark: SparkSession, landing_root: str, hospital: Hospital, entity: str, batch: str | None) -> DataFrame:
    """The current batch of one hospital's ``entity`` as a bronze table (the latest
    delta, for an incremental table); no rows if there is none."""
    schema = schemas.landing_schema(entity, hospital)
    if batch is None:
        return spark.createDataFrame([], schema)
    return read_batch(spark, landing_dir(landing_root, hospital, entity), batch, schema)


def read_landing_history(spark: SparkSession, landing_root: str, hospital: Hospital, entity: str, batches: Sequence[str]) -> DataFrame:
    """S6 over all batches of an incremental table: the rows of a source key that its
    newest batch has."""
    schema = schemas.landing_schema(entity, hospital)
    own = {conformed: name for name, conformed in hospital.renames_for(entity).items()}
    key = own.get(SOURCE_KEYS[entity], SOURCE_KEYS[entity])
    rows = read_batches(spark, landing_dir(landing_root, hospital, entity), batches, schema)
    newest = rows.groupBy(F.col(key).alias("_key")).agg(F.max(BATCH).alias("_batch"))
    return rows.join(newest, F.col(key).eqNullSafe(F.col("_key")) & (F.col(BATCH) == F.col("_batch"))).select(*schema.fieldNames())


def bronze_from_landing(
    spark: SparkSession,
    landing_root: str,
    batches: Mapping[tuple[str, str], Sequence[tuple[str, str]]],
    claims: DataFrame | None = None,
    cptcodes: DataFrame | None = None,
    hospitals: Sequence[Hospital] = HOSPITALS,
    scope: str = "latest",
) -> BronzeLayer:
    """S6 for all hospitals and entities: the bronze layer over landing batches.

    ``batches``: (database, table) -> (batch, load type) in order of time, as
    ``control.landed_batches`` gives it. ``scope="latest"`` (the pipeline's semantics)
    reads the last batch of every table. ``scope="all"`` reads the last batch of a table that
    was loaded fully, and of an incremental table the newest state of each source key over
    the batches since its last full load.
    """
    if scope not in ("latest", "all"):
        raise ValueError(f"scope must be 'latest' or 'all', not {scope!r}")

    def one(h: Hospital, entity: str) -> DataFrame:
        own = list(batches.get((h.database, entity), ()))
        if scope == "latest" or not own or own[-1][1] == "full":
            return read_landing(spark, landing_root, h, entity, own[-1][0] if own else None)
        full = [i for i, (_, kind) in enumerate(own) if kind == "full"]
        return read_landing_history(spark, landing_root, h, entity, [b for b, _ in own[full[-1] if full else 0 :]])

    frames = LazyFrames(
        {(h.name, entity): (lambda h=h, entity=entity: one(h, entity)) for h in hospitals for entity in ENTITIES}
    )
    return BronzeLayer(frames=frames, claims=claims, cptcodes=cptcodes, hospitals=hospitals)
