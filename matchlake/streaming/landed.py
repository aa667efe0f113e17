"""Landing driven by a file stream: the same raw partitions as the batch, day by day.

The stream only tells which days have new files. Each micro-batch rewrites those days
from everything landed for them, so a repeated micro-batch changes nothing.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchlake.plans.daily import land_days
from matchlake.sources.lake import Lake


def land_new_files(
    lake: Lake, landing_root: str, checkpoint: str, landed_at: datetime | None = None
) -> StreamingQuery:
    """Process all files not seen yet and stop."""
    # The file names are enough: as binary files their content is not read here.
    arrivals = (
        lake.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .load(landing_root)
        .select(F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})/", 1).alias("date"))
        .filter("date <> ''")
    )

    def rewrite(batch: DataFrame, _batch_id: int) -> None:
        days = [row["date"] for row in batch.distinct().collect()]  # bounded by the calendar
        land_days(lake, landing_root, days, landed_at or datetime.now(timezone.utc))

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(rewrite)
        .start()
    )
