import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """A table like ``documents`` from (doc_id, text, lang, source) rows."""

    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return frame.withColumn("n_chars", F.length("text").cast("long"))

    return make
