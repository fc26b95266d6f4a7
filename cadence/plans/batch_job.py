"""The whole daily job as one Spark application.

create tables -> read landed pages -> stage -> clean -> process -> load
star -> build models -> run checks.  Each layer is written to shared
storage and the next step reads it back, so a retried step restarts from
the last written layer instead of recomputing the lineage from the raw
pages; every write is keyed by the batch id, so a retry of the whole job
is idempotent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.checks import assert_checks, run_checks
from cadence.operators.clean import LINEAGE_COLUMNS, check_not_empty, clean_plays, with_play_id
from cadence.operators.star import dim_table, load_star
from cadence.plans.graph import MODELS, built_from, run_models, sources_of
from cadence.plans.models import Models, register_all, staging_models, stored_fact
from cadence.schemas import PROCESSED_COLUMNS, STAGED_COLUMNS
from cadence.session import ensure_conf
from cadence.sources import csv_files, raw_json
from cadence.sources.names import publish_names
from cadence.sources.warehouse import DIM_TABLES, Warehouse, check_batch_id


@dataclass
class JobResult:
    batch_id: str
    models: Models
    checks: DataFrame
    rejected_plays: int


def run_batch_job(spark: SparkSession, raw_path: str, warehouse_root: str, batch_id: str,
                  fmt: str = "parquet", multiline: bool = False, as_of=None,
                  latest_cap: int | None = None, fail_on_reject: bool = True,
                  fail_on_checks: bool = True, csv_multiline: bool = True,
                  identity: bool = False, database: str | None = None) -> JobResult:
    """Run the job for one landed batch.

    ``csv_multiline=False`` reads the CSV layers as one record a line, so that large
    files are split over tasks; it is for batches whose texts hold no line ends.
    ``identity`` counts a play once, where the windows of several runs overlap.
    ``database`` names a database of the catalog that gets the tables' names.
    """
    ensure_conf(spark)
    check_batch_id(batch_id)
    wh = Warehouse(spark, warehouse_root)
    wh.create_tables()

    # extract: landed pages -> staged plays (optionally the last day only, newest N).
    # The play id is given before the cap, so plays of one instant have an order.
    staged = with_play_id(raw_json.read_staged_from_json(spark, raw_path, multiline=multiline))
    if as_of is not None:
        staged = raw_json.recent_window(staged, as_of)
    if latest_cap is not None:
        staged = raw_json.latest_plays(staged, n=latest_cap)
    staging_path = f"{wh.root}/staging/batch_id={batch_id}"
    csv_files.save_staging(staged.select(*[F.col(c).cast("string") for c in STAGED_COLUMNS]),
                           staging_path, fmt=fmt)

    # transform: staged -> processed (with lineage columns for the loader)
    staged = csv_files.read_staging(spark, staging_path, fmt=fmt, multiline=csv_multiline)
    plays = clean_plays(check_not_empty(staged))
    processed_path = f"{wh.root}/processed/batch_id={batch_id}"
    if fmt == "csv":
        csv_files.save_processed(
            plays.select(*PROCESSED_COLUMNS, F.date_format("played_at", raw_json.ISO_FORMAT)
                         .alias("played_at"), "play_id"), processed_path, fmt="csv")
        plays = clean_back(spark, processed_path, csv_multiline)
    else:
        plays.write.mode("overwrite").parquet(processed_path)
        plays = spark.read.parquet(processed_path)

    # load, models, checks: the fact is summed once, and marts count only once
    # the checks have passed.
    loaded = load_star(wh, plays, batch_id, fail_on_reject=fail_on_reject, same_is_done=True,
                       identity=identity)
    with stored_fact(wh) as (state, fact):
        models = staging_models(wh, fact, state)
        run = run_models(wh, whole=True, fact=fact, state=state, publish=False)
        results = run_checks({
            "stg_streams": models.stg_streams, "stg_songs": models.stg_songs,
            "stg_artists": models.stg_artists, "fact_song_stream": fact,
            **{t: dim_table(wh, t, state) for t in DIM_TABLES}})
        # One row for each check, kept beyond the stored fact.
        checks = spark.createDataFrame(results.collect(), results.schema)
        if fail_on_checks:
            assert_checks(checks)
    below = sources_of(MODELS)
    wh.publish_models(run.attempts, {n: built_from(state, below[n]) for n in run.attempts})
    if database is not None:
        publish_names(wh, database)
    return JobResult(batch_id, register_all(wh), checks, loaded.rejected_plays)


def clean_back(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read a processed CSV layer (nine columns + lineage) with fixed types."""
    from pyspark.sql import types as T

    from cadence.schemas import PROCESSED
    schema = T.StructType(list(PROCESSED.fields) + [
        T.StructField(LINEAGE_COLUMNS[0], T.StringType()),
        T.StructField(LINEAGE_COLUMNS[1], T.LongType())])
    df = csv_files.read_csv(spark, path, schema, multiline)
    return df.withColumn("played_at", F.to_timestamp("played_at"))
