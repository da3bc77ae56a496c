"""Scoring rows as they arrive.

Fitted preparations and linear models are row expressions, so a stream needs no
operator of its own and no state.
"""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabprep.operators.prepare import Preparation
from tabprep.operators.scoring import submission


def score_stream(
    rows: DataFrame, preparation: Preparation, model, key: str, label: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Append predictions for arriving rows to a folder of CSV files; handles what is there and stops."""
    scored = submission(model.transform(preparation.transform(rows, keys=[key])), key, label)
    writer = scored.writeStream.format("csv").option("header", True).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
