"""Responses that arrive as a stream of files.

Extraction, structure checks and judge parsing look at one row at a time, so the
batch operators serve a stream as they are; only the reading and writing differ.
"""

from gradeloom.operators import quality, responses

RESPONSE_FILE = "response_id long, case_id long, model string, response string"


def read_responses(spark, path):
    """Responses from JSON Lines files as they are added to a folder."""
    return spark.readStream.schema(RESPONSE_FILE).json(path)


def write_analyses(stream, path, progress):
    """Start to write the analysis of each response; returns the running query.

    The trigger takes what is there and stops, so that a schedule can call it.
    ``progress`` is the shared folder that remembers what was taken: always the same
    one for an output, and for no other.
    """
    analyses = quality.add_structure_validity(responses.extract_analysis(stream))
    return (
        analyses.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
