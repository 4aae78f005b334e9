"""Command line: the daily jobs.

    python -m traitlab features  --date 20180709 --input SF_DIR --out DIR
    python -m traitlab infer     --date 20180709 --input SF_DIR --attribute gender
                                 [--features DIR/features] [--out DIR] [--models DIR]
    python -m traitlab infer-all --date 20180709 --input SF_DIR [--features ...] [--out ...]

Training options for ``infer`` / ``infer-all``: ``--solver exact|lbfgs``, ``--max-iter``, ``--reg-param``,
``--[no-]fit-intercept``, ``--holdout-percent``, ``--split-seed``.

``--input`` is the directory of the sample tables; ``--source VIEW=TABLE`` (repeated)
reads an input view from a named table or a path instead; ``--append`` adds to the
output instead of replacing the date's partitions; ``--run-id`` makes the outputs
published tables (replaced in one step, a run appended once); ``--features`` reads the
dated features written by the ``features`` job instead of encoding again;
``--features-table`` (with ``--buckets``) has that job also write a catalog table of
parsed features bucketed by device, and the others read it. The run date is read leniently (20180732 means 20180801).
"""

from __future__ import annotations

import argparse
import json
import sys

from . import constants as C
from .functions.dates import normalise_job_date
from .plans import pipelines as pipe
from .plans.context import JobContext
from .session import build_session, remove_scratch_tables


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="traitlab")
    ap.add_argument("job", choices=["features", "infer", "infer-all"])
    ap.add_argument("--date", required=True)
    ap.add_argument("--input")
    ap.add_argument("--source", action="append", default=[], metavar="VIEW=TABLE_OR_PATH")
    ap.add_argument("--append", action="store_true")
    ap.add_argument("--run-id")
    ap.add_argument("--out")
    ap.add_argument("--features")
    ap.add_argument("--features-table")
    ap.add_argument("--buckets", type=int, default=C.FEATURE_BUCKETS)
    ap.add_argument("--attribute", choices=sorted(pipe.ATTRIBUTES))
    ap.add_argument("--models")
    ap.add_argument("--top-k", type=int)
    ap.add_argument("--files", type=int)
    ap.add_argument("--master")
    # training options (library defaults mirror the original settings)
    ap.add_argument("--solver", choices=["exact", "lbfgs"])
    ap.add_argument("--max-iter", type=int)
    ap.add_argument("--reg-param", type=float)
    ap.add_argument("--fit-intercept", action=argparse.BooleanOptionalAction, default=None)
    ap.add_argument("--holdout-percent", type=int)
    ap.add_argument("--split-seed", type=int)
    a = ap.parse_args(argv)
    train = {k: v for k, v in (("solver", a.solver), ("max_iter", a.max_iter), ("reg_param", a.reg_param),
                               ("fit_intercept", a.fit_intercept),
                               ("holdout_percent", a.holdout_percent),
                               ("split_seed", a.split_seed)) if v is not None}

    spark = build_session(a.master)
    try:
        report, ctx = _run(ap, a, train, spark)
    finally:
        # the outputs are written: drop this run's intermediate tables
        remove_scratch_tables(spark)
    print(json.dumps({"job": a.job, "date": ctx.job_date, "result": report}, default=str))
    return 0


def _run(ap: argparse.ArgumentParser, a: argparse.Namespace, train: dict, spark):
    if not a.input and not a.source:
        ap.error("name the inputs with --input or --source")
    ctx = JobContext(spark, a.input, normalise_job_date(a.date),
                     dict(x.split("=", 1) for x in a.source))
    if a.job == "features":
        if not a.out:
            ap.error("features needs --out")
        report = pipe.feature_job(ctx, a.out, a.top_k, a.files, a.run_id)
        if a.features_table:
            written = pipe.read_features(spark, f"{a.out}/features", ctx.job_date)
            pipe.feature_table(ctx, a.features_table, a.buckets, features=written)
    else:
        feats = pipe.read_features(spark, a.features, ctx.job_date) if a.features else None
        parsed = pipe.read_feature_table(spark, a.features_table, ctx.job_date) if a.features_table else None
        if a.job == "infer":
            if not a.attribute:
                ap.error("infer needs --attribute")
            res = pipe.infer(ctx, a.attribute, feats, a.out, a.models, append=a.append, run_id=a.run_id,
                             parsed=parsed, **train)
        else:
            res = pipe.infer_all(ctx, None, feats, a.out, a.models, append=a.append, run_id=a.run_id,
                             parsed=parsed, **train)
        report = {name: {"report": r.report, "threshold": r.threshold, "model": r.model_path}
                  for name, r in res.results.items()}
    return report, ctx


if __name__ == "__main__":
    sys.exit(main())
