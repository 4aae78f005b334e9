import os
import sys

import pytest
from pyspark.sql import types as T

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
for path in (ROOT, HERE):
    if path not in sys.path:
        sys.path.insert(0, path)
# Python workers import the package too
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def awkward(spark):
    from conftest_rows import awkward_rows
    return spark.createDataFrame(awkward_rows(), DOCUMENTS).repartition(3)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
