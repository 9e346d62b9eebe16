"""Tables that are computed once, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """df as a checkpoint, which outlives lost executors, in the folder that spark.checkpoint.dir names. A folder of this machine only where the
    setting is absent and Spark runs on this machine alone."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            found = "file://" + tempfile.mkdtemp(prefix="glossmark-")
        context.setCheckpointDir(found)
    return df.checkpoint()
