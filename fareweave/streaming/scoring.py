"""Continuous scoring of a request stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fareweave.operators.score import Scorer, score_requests


def start_scoring(
    requests: DataFrame,
    scorer: Scorer,
    scored_path: str,
    rejected_path: str,
    checkpoint: str,
    decimals: int | None = 2,
) -> StreamingQuery:
    """Score every micro-batch; invalid requests go to the second table.

    Scoring has no state. Each batch writes its own folder in overwrite mode, so a
    batch that is repeated after a failure does not add rows twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        scored, rejected = score_requests(batch, scorer, decimals)
        scored.write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        batch.unpersist()

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
