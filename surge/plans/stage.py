"""Stage boundaries: cut lineage where a pipeline hands a table to the next step.

``checkpoint()`` writes to the shared folder named by ``spark.checkpoint.dir``
(reliable: it survives the loss of executors, unlike a local checkpoint); the
folder is only created here when the session leaves it unset (tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from surge.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
