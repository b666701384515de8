"""The ingest workflow: extract, validate, transform, load, record the run."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import schemas, session
from geoloom.operators import layers, validate
from geoloom.sources import elements, sinks

log = logging.getLogger(__name__)


def _stored(df: DataFrame, kind: str) -> DataFrame:
    path = session.new_path(df.sparkSession, f"ingest-{kind}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest(
    spark: SparkSession,
    source: str,
    destination: str,
    validate_data: bool = True,
    run_table: str | None = None,
) -> dict:
    """Run the workflow; failures are reported in the result, not raised.

    The result carries both ``message`` and, on failure, ``error``.
    """
    run_id, started = uuid.uuid4().hex, datetime.now(timezone.utc)
    counts: dict[str, int] = {}
    error = None
    try:
        data = elements.extract(spark, source)
        # Every layer reads the parsed elements: parse once, into Parquet that all executors reach.
        kept = [_stored(df, kind) for kind, df in zip(("nodes", "ways", "relations"), (data.nodes, data.ways, data.relations))]
        if validate_data and not validate.is_valid_dataset(*kept):
            raise ValueError("the elements did not pass validation")
        parsed = elements.Elements(*kept, data.metadata)
        for name, layer in layers.ingest_layers(parsed).items():
            if not layer.isEmpty():
                counts[name] = sinks.write_layer(layer, f"{destination}/{name}")
    except Exception as e:  # noqa: BLE001 - the contract is to report
        error = str(e)
        log.error("ingest of %s: %s", source, error)
    ended = datetime.now(timezone.utc)
    stats = {
        "run_id": run_id,
        "records_processed": sum(counts.values()),
        "layers": counts,
        "duration_seconds": (ended - started).total_seconds(),
    }
    if run_table:
        row = [(run_id, started, ended, "failed" if error else "completed", source,
                stats["records_processed"], error)]
        runs = spark.createDataFrame(
            row,
            "run_id string, start_time timestamp, end_time timestamp, status string, "
            "source_file string, records_processed long, error_message string",
        ).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
        sinks.append_rows(runs, schemas.RUN, run_table)
    if error:
        return {"success": False, "stats": stats, "message": f"not ingested: {error}", "error": error}
    return {"success": True, "stats": stats, "message": f"ingested {stats['records_processed']} records"}
