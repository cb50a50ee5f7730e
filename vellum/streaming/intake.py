"""Documents as they arrive: a stream of jobs, each micro-batch run through the pipeline.

An extension of the batch engine.  A repeated micro-batch is harmless: jobs that
have succeeded are not run again, and its results replace those of the same
number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vellum.plans.pipeline import Pipeline
from vellum.sources import files


def start(arrivals: DataFrame, pipeline: Pipeline, checkpoint: str) -> StreamingQuery:
    """``arrivals(ord, pdf_path)`` is a streaming DataFrame; results go to the table ``results``."""

    def batch(rows: DataFrame, number: int) -> None:
        jobs = files.with_keys(rows).dropDuplicates(["paper_key"])
        if not jobs.isEmpty():
            pipeline.store.put(f"results/batch={number}", pipeline.run(jobs))

    return arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
