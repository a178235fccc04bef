"""Dead letters on their way back through validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.operators.enrich import dead_letter
from pulsegrid.operators.validate import validate
from pulsegrid.schemas import RAW_CONTRACT, Contract


def replay(
    letters: DataFrame, config: IngestConfig = IngestConfig(), contract: Contract = RAW_CONTRACT,
    *, as_of: Column | None = None,
) -> DataFrame:
    """Validate the original texts again, in one pass.

    Validation results with ``attemptCount`` and, where a text failed once more,
    its new dead ``letter``. The attempt count rides along, so no join back to
    the old letters is needed.
    """
    bodies = letters.select(
        # The key carries the count of earlier attempts through the validation.
        F.struct(F.col("key"), F.col("payload.attemptCount").alias("attempts")).alias("key"),
        F.col("payload.originalPayload").alias("value"),
        "topic", "partition", "offset", F.col("recordTimestamp").alias("timestamp"),
    )
    results = validate(bodies, config, contract).withColumns({
        "attemptCount": F.col("key.attempts") + 1, "key": F.col("key.key"),
    })
    return results.withColumn("letter", F.when(~F.col("valid"), dead_letter(config, as_of, F.col("attemptCount"))))
