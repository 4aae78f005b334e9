"""Run registered queries with injected task failures (used by test_retry.py).

A separate process: the session needs ``local[N,F]`` so failed tasks are
retried. Every table scan and every query result pass through an identity
``mapInPandas`` that fails the first attempt of every even partition, so map
tasks and tasks reading shuffle output both fail once. Prints one JSON line:
per query whether the rows equal a run without failures, and how many task
attempts were failed.
"""

import json
import os
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402

from traitlab.session import build_session  # noqa: E402
from traitlab.sources import tables as T  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sys.argv[1].split(",")
MARKS = tempfile.mkdtemp(prefix="traitlab-retry-")


def flaky(df):
    marks = MARKS

    def fn(batches):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            open(os.path.join(marks, uuid.uuid4().hex), "w").close()
            raise RuntimeError("injected task failure")
        yield from batches

    return df.mapInPandas(fn, df.schema)


def rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def main():
    spark = build_session("local[4,4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("OFF")
    import __spark_entry__ as E
    qs = E.queries()
    plain = {n: rows(qs[n](spark, SF)) for n in NAMES}
    original = T.TableSet.table
    T.TableSet.table = lambda self, name: flaky(original(self, name))
    out = {n: rows(flaky(qs[n](spark, SF))) == plain[n] for n in NAMES}
    out["_failed_attempts"] = len(os.listdir(MARKS))
    print(json.dumps(out))


if __name__ == "__main__":
    main()
