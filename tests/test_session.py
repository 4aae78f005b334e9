"""Session sizing for cluster-scale shuffles."""

import json
import os
import subprocess
import sys

from traitlab.session import apply_cluster_shuffle_defaults

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_PROBE = """
import json, sys
sys.path.insert(0, {root!r})
from traitlab.session import build_session, apply_cluster_shuffle_defaults
s = build_session("local[2]")
first = apply_cluster_shuffle_defaults(s)
second = apply_cluster_shuffle_defaults(s)
print(json.dumps({{"first": first, "second": second,
                  "initial": s.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")}}))
"""


def test_launch_shuffle_partitions_are_kept(spark):
    # the test session sets spark.sql.shuffle.partitions at launch
    assert apply_cluster_shuffle_defaults(spark) == {}
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_unsized_session_gets_wide_coalesced_shuffles():
    proc = subprocess.run([sys.executable, "-c", _PROBE.format(root=ROOT)],
                          capture_output=True, text=True, timeout=300)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("{")]
    assert lines, proc.stderr[-2000:]
    got = json.loads(lines[-1])
    assert set(got["first"]) == {"spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes"}
    assert got["second"] == {}                      # never overrides what is set
    assert int(got["initial"]) >= 10_000
