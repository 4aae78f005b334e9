"""Order-independent logistic regression of many attributes at once (ML-1..3).

The same unpenalised objective as the L-BFGS estimator, minimised in steps that
give the same coefficients on any partitioning, cluster and engine:

* coefficients are integers in units of ``1 / WEIGHT_UNIT``, and a row's margin is
  a sum of integers;
* a probability is rounded to ``1 / RESIDUAL_UNIT`` before it meets the label, so
  gradients are sums of integers too, whatever their order;
* the step of a coefficient is its gradient over a fixed bound of the curvature
  (``bound`` times the sum of ``|x| * (sum of |x| of the row)``), which never
  overshoots; momentum ``(t - 1) / (t + 2)`` speeds it up; the result is rounded.

All attributes train together: an iteration is one pass (one job) over the labelled
rows that sums every attribute's gradient, keyed by coefficient, and an attribute
drops out once no coefficient of it moves by more than ``tol``. Rows are packed into
blocks of flat arrays once, so a pass hands a few buffers to each task.

Scoring is row-local with the coefficients broadcast (at most ``dim`` times the
number of classes). Scores are the rounded probabilities, so thresholds compare
exactly as well, and a score takes at most ``RESIDUAL_UNIT + 1`` values.

Defined results: a device without a known index has margin 0; ties between classes
go to the smaller one; an attribute without training rows has coefficients of 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import constants as C
from . import dataset as dsm
from . import metrics as met
from .model import chosen_threshold

# Units of coefficients and residuals; margins are cut off where probabilities saturate.
WEIGHT_UNIT = 1_000_000_000
RESIDUAL_UNIT = 1_000_000
MARGIN_CAP = 40.0
# Entries of a block of packed rows.
BLOCK_ENTRIES = 1 << 18
# Gradient cells one task should add up per iteration, and the tasks whose sums
# (each at most one number per coefficient) are merged at once.
CELLS_PER_TASK = 1_000_000
DIRECT_TASKS = 8
# Gradient cells of a pass that one task adds up faster than a job starts.
ONE_TASK_CELLS = 8_000_000


@dataclass(frozen=True)
class Target:
    """An attribute to learn from the label column ``label`` (-1 where unknown)."""
    name: str
    classes: int
    label: str
    refine: bool = False

    @property
    def columns(self) -> int:
        """Coefficient columns: one for two classes, else one per class."""
        return 1 if self.classes == 2 else self.classes

    @property
    def bound(self) -> float:
        """One over the largest curvature of the loss along a margin."""
        return 4.0 if self.classes == 2 else 2.0


def _spans(targets: Sequence[Target]) -> list[slice]:
    ends = np.cumsum([t.columns for t in targets]).tolist()
    return [slice(e - t.columns, e) for t, e in zip(targets, ends, strict=True)]


def _rounded(x: np.ndarray) -> np.ndarray:
    return np.floor(x + 0.5)


# --- packed rows -----------------------------------------------------------------------

_BLOCK = "n long, offsets binary, idx binary, val binary, labels binary"


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), (offsets - offsets[0]).astype(np.int64)


def _arrays(indices: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    idx, offsets = _flat(indices)
    val, _ = _flat(values)
    return idx, None if (val == 1.0).all() else val, offsets


def pack(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Blocks of (indices, values, label columns) rows as flat little-endian arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(0)), 0))
            ends = np.cumsum(pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + BLOCK_ENTRIES, "right")))
                part = batch.slice(at, stop - at)
                idx, val, offsets = _arrays(part.column(0), part.column(1))
                known = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns[2:]], 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.num_rows], pa.int64()), pa.array([offsets.astype("<i8").tobytes()], pa.binary()),
                    pa.array([idx.astype("<i4").tobytes()], pa.binary()),
                    pa.array([None if val is None else val.astype("<f8").tobytes()], pa.binary()),
                    pa.array([known.astype("<f8").tobytes()], pa.binary())],
                    names=["n", "offsets", "idx", "val", "labels"])
                at = stop

    return rows.select("indices", "values", *[F.col(c).cast("double") for c in labels]).mapInArrow(run, _BLOCK)


def _parts(batches: Iterator[pa.RecordBatch], n_labels: int):
    """(idx, val or None, offsets, labels) of every block."""
    for batch in batches:
        for k in range(batch.num_rows):
            n, offsets, idx, val, known = (batch.column(c)[k].as_py() for c in range(5))
            yield (np.frombuffer(idx, "<i4"), None if val is None else np.frombuffer(val, "<f8"),
                   np.frombuffer(offsets, "<i8"), np.frombuffer(known, "<f8").reshape(n, n_labels))


# --- the model ----------------------------------------------------------------------------

def margins(weights: np.ndarray, idx: np.ndarray, val: np.ndarray | None, offsets: np.ndarray) -> np.ndarray:
    """Integer margins (rows x columns) in ``WEIGHT_UNIT``; an empty row has 0."""
    out = np.zeros((len(offsets) - 1, weights.shape[1]), order="F")
    filled = np.flatnonzero(np.diff(offsets))
    for k in range(weights.shape[1] if len(filled) else 0):
        terms = np.ascontiguousarray(weights[:, k])[idx]
        if val is not None:
            terms = _rounded(terms * val)
        out[filled, k] = np.add.reduceat(terms, offsets[filled])
    return out


def probabilities(margin: np.ndarray) -> np.ndarray:
    """Probabilities in ``RESIDUAL_UNIT`` from the margins of one target."""
    z = margin / WEIGHT_UNIT
    if z.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -MARGIN_CAP, MARGIN_CAP)))
    else:
        e = np.exp(np.maximum(z - z.max(axis=1, keepdims=True), -MARGIN_CAP))
        p = e / e.sum(axis=1, keepdims=True)
    return _rounded(p * RESIDUAL_UNIT)


def _residuals(targets: Sequence[Target], margin: np.ndarray, known: np.ndarray) -> np.ndarray:
    out = np.zeros_like(margin)
    for n, (t, span) in enumerate(zip(targets, _spans(targets), strict=True)):
        has = known[:, n] >= 0
        first = 1 if t.classes == 2 else 0
        hit = known[has, n][:, None] == np.arange(first, first + t.columns)
        out[has, span] = probabilities(margin[has, span]) - RESIDUAL_UNIT * hit
    return out


def _cells(total: np.ndarray) -> tuple[bytes | None, bytes]:
    """The non-zero sums and their cells, or all sums without cells where that is shorter."""
    flat = total.ravel()
    cell = np.flatnonzero(flat)
    if 3 * len(cell) > 2 * len(flat):
        return None, flat.astype("<i8").tobytes()
    return cell.astype("<i4").tobytes(), flat[cell].astype("<i8").tobytes()


def _added(cells, sums, size: int) -> np.ndarray:
    """The sums of several tasks, added up."""
    out = np.zeros(size)
    for c, s in zip(cells, sums, strict=True):
        out[slice(None) if c is None else np.frombuffer(c, "<i4")] += np.frombuffer(s, "<i8")
    return out


def _summed(blocks: DataFrame, n_labels: int, add, shape: tuple[int, int], tasks: int) -> np.ndarray:
    """Sums of what ``add`` adds up over all blocks: each task sends one row
    with its sums. They are whole numbers, so neither the order nor the number of
    tasks matters; many tasks' rows are merged in groups, and the groups' to the
    one compressed row that the driver gets, whatever the number of tasks."""
    size = shape[0] * shape[1]
    groups = max(1, int(tasks ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, order="F")
        for part in _parts(batches, n_labels):
            add(part, total)
        cells, sums = _cells(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([cells], pa.binary()),
             pa.array([sums], pa.binary())], names=["grp", "cells", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        cells, sums = _cells(_added(table["cells"].to_pylist(), table["sums"].to_pylist(), size))
        return pa.table({"cells": pa.array([cells], pa.binary()), "sums": pa.array([sums], pa.binary())})

    def one_row(table: pa.Table) -> pa.Table:
        merged = merge(table)
        return merged.set_column(1, "sums", pa.array([zlib.compress(merged["sums"][0].as_py(), 1)], pa.binary()))

    found = blocks.mapInArrow(run, "grp int, cells binary, sums binary")
    if tasks > DIRECT_TASKS:
        found = found.groupBy("grp").applyInArrow(merge, "cells binary, sums binary")
    row = found.select("cells", "sums").groupBy().applyInArrow(one_row, "cells binary, sums binary").toArrow()
    return _added(row["cells"].to_pylist(), map(zlib.decompress, row["sums"].to_pylist()), size).reshape(shape)


def _curvature(part, total: np.ndarray) -> None:
    """Add per index and target the sum of ``|x| * (sum of |x| of the row)``."""
    idx, val, offsets, known = part
    size = np.diff(offsets)
    x = np.ones(len(idx)) if val is None else np.abs(val)
    row = np.repeat(np.arange(len(size)), size)
    whole = np.bincount(row, _rounded(x * RESIDUAL_UNIT), len(size))
    term = _rounded(x * whole[row] / RESIDUAL_UNIT)
    for k in range(total.shape[1]):
        total[:, k] += np.bincount(idx, term * (known[row, k] >= 0), len(total))


def _gradient(part, total: np.ndarray, targets: Sequence[Target], known_at: Sequence[int],
              weights: np.ndarray) -> None:
    """Add the gradients (dim x columns) of all targets over a block."""
    idx, val, offsets, known = part
    r = _residuals(targets, margins(weights, idx, val, offsets), known[:, known_at])
    row = np.repeat(np.arange(len(r)), np.diff(offsets))
    for k in range(total.shape[1]):
        terms = r[:, k][row]
        if val is not None:
            terms = _rounded(terms * val)
        total[:, k] += np.bincount(idx, terms, len(total))


@dataclass
class Weights:
    """Coefficients (dim x columns, integers) of several targets and their thresholds."""
    targets: list[Target]
    values: np.ndarray
    iterations: dict[str, int] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)

    def of(self, name: str) -> np.ndarray:
        for t, span in zip(self.targets, _spans(self.targets), strict=True):
            if t.name == name:
                return self.values[:, span]
        raise KeyError(name)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """(class, idx, weight, threshold) of one target: its non-zero coefficients
        as integers, and a row of class -1 that only has the threshold."""
        own = self.of(name)
        first = 1 if own.shape[1] == 1 else 0
        idx, k = np.nonzero(own)
        n = len(idx) + 1
        rows = pa.table({
            "class": pa.array(np.append(k + first, -1), pa.int32()), "idx": pa.array(np.append(idx, -1), pa.int32()),
            "weight": pa.array(np.append(own[idx, k], 0).astype(np.int64)),
            "threshold": pa.array([None] * (n - 1) + [self.thresholds.get(name, C.DEFAULT_THRESHOLD)], pa.float64())})
        return spark.createDataFrame(rows)

    def save(self, spark: SparkSession, path: str, name: str) -> None:
        self.table(spark, name).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, target: Target, dim: int = C.FEATURE_DIM) -> Weights:
    """One target's coefficients as saved by :meth:`Weights.save`."""
    rows = spark.read.parquet(path).toArrow()
    k, idx, weight, threshold = (rows[c].to_numpy() for c in ("class", "idx", "weight", "threshold"))
    own = k >= 0
    values = np.zeros((dim, target.columns))
    values[idx[own], k[own] - (1 if target.classes == 2 else 0)] = weight[own]
    return Weights([target], values, {}, {target.name: float(threshold[~own][0])})


def _descend(targets: Sequence[Target], bounds: np.ndarray, gradient, max_iter: int,
             tol: float) -> tuple[np.ndarray, list[int]]:
    """Coefficients (dim x columns) and iterations of all targets.

    ``gradient(active, weights)`` gives the gradients of the targets with the
    numbers ``active`` at their columns' ``weights``.
    """
    spans = _spans(targets)
    support = np.flatnonzero(bounds.any(axis=1))
    limit = np.concatenate([np.repeat(bounds[support, k:k + 1], t.columns, 1) for k, t in enumerate(targets)], 1)
    step = np.concatenate([np.full(t.columns, WEIGHT_UNIT / RESIDUAL_UNIT * t.bound) for t in targets])
    now, before = np.zeros_like(limit), np.zeros_like(limit)
    turns = [0] * len(targets)
    active = list(range(len(targets)))
    for turn in range(1, max_iter + 1):
        some = [targets[k] for k in active]
        columns = np.concatenate([np.arange(spans[k].start, spans[k].stop) for k in active])
        w, v, d = now[:, columns], before[:, columns], limit[:, columns]
        ahead = w + _rounded((turn - 1) / (turn + 2) * (w - v))
        sent = np.zeros((len(bounds), len(columns)), order="F")
        sent[support] = ahead
        g = gradient(active, sent)[support]
        new = np.where(d > 0, _rounded(ahead - g * step[columns] / np.maximum(d, 1)), 0.0)
        moved = np.abs(new - w)
        before[:, columns], now[:, columns] = w, new
        for k in active:
            turns[k] = turn
        active = [k for k, span in zip(active, _spans(some), strict=True) if moved[:, span].max() > tol * WEIGHT_UNIT]
        if not active:
            break
    out = np.zeros((len(bounds), limit.shape[1]))
    out[support] = now
    return out, turns


def _in_one_task(blocks: DataFrame, targets: Sequence[Target], dim: int, max_iter: int,
                 tol: float) -> tuple[np.ndarray, list[int]]:
    """All iterations over a bounded set of blocks in one task."""
    width = sum(t.columns for t in targets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(_parts(batches, len(targets)))
        bounds = np.zeros((dim, len(targets)), order="F")
        for part in parts:
            _curvature(part, bounds)

        def gradient(active: list[int], weights: np.ndarray) -> np.ndarray:
            total = np.zeros(weights.shape, order="F")
            for part in parts:
                _gradient(part, total, [targets[k] for k in active], active, weights)
            return total

        found, turns = _descend(targets, bounds, gradient, max_iter, tol)
        cells, sums = _cells(found)
        yield pa.RecordBatch.from_arrays([pa.array([cells], pa.binary()), pa.array([sums], pa.binary()),
                                          pa.array([turns], pa.list_(pa.int32()))], names=["cells", "sums", "turns"])

    row = blocks.coalesce(1).mapInArrow(run, "cells binary, sums binary, turns array<int>").first()
    return _added([row["cells"]], [row["sums"]], dim * width).reshape(dim, width), list(row["turns"])


def fit(rows: DataFrame, targets: Sequence[Target], dim: int = C.FEATURE_DIM, max_iter: int = C.LR_MAX_ITER,
        tol: float = C.LR_TOL, one_task_cells: int = ONE_TASK_CELLS) -> Weights:
    """Train all targets on (indices, values, label columns) rows.

    A pass over all rows per iteration: a job each, its gradients summed over
    the tasks, or, while a pass is so small (``one_task_cells``) that starting a
    job would take longer, all passes in one task. The numbers are the same.
    """
    targets = list(targets)
    width = sum(t.columns for t in targets)
    kept = pack(rows, [t.label for t in targets]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        entries = (kept.agg(F.sum(F.octet_length("idx"))).first()[0] or 0) // 4
        if not entries:
            return Weights(targets, np.zeros((dim, width)), {t.name: 0 for t in targets})
        if entries * width <= one_task_cells:
            values, turns = _in_one_task(kept, targets, dim, max_iter, tol)
        else:
            tasks = min(max(1, -(-entries * width // CELLS_PER_TASK)), kept.rdd.getNumPartitions())
            blocks = kept.coalesce(tasks)
            n = len(targets)
            bounds = _summed(blocks, n, _curvature, (dim, n), tasks)

            def gradient(active: list[int], weights: np.ndarray) -> np.ndarray:
                some = [targets[k] for k in active]
                return _summed(blocks, n, lambda part, total: _gradient(part, total, some, active, weights),
                               weights.shape, tasks)

            values, turns = _descend(targets, bounds, gradient, max_iter, tol)
        return Weights(targets, values, {t.name: k for t, k in zip(targets, turns, strict=True)})
    finally:
        kept.unpersist()


def score(rows: DataFrame, weights: Weights) -> DataFrame:
    """``rows`` (with indices and values, which go) and per target ``score_<name>``
    (probability of class 1, two classes only) and ``prediction_<name>``."""
    kept = [f for f in rows.schema.fields if f.name not in ("indices", "values")]
    targets, spans = weights.targets, _spans(weights.targets)
    added = [T.StructField(f"{kind}_{t.name}", T.DoubleType()) for t in targets
             for kind in (("score", "prediction") if t.classes == 2 else ("prediction",))]
    thresholds = {t.name: weights.thresholds.get(t.name, C.DEFAULT_THRESHOLD) for t in targets}
    shared = rows.sparkSession.sparkContext.broadcast(weights.values)
    names = [f.name for f in kept + added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            idx, val, offsets = _arrays(batch.column(0), batch.column(1))
            z = margins(w, idx, val, offsets)
            found = []
            for t, span in zip(targets, spans, strict=True):
                if t.classes == 2:
                    p = probabilities(z[:, span])[:, 0] / RESIDUAL_UNIT
                    found += [p, (p > thresholds[t.name]).astype(np.float64)]
                else:
                    found.append(np.argmax(z[:, span], axis=1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *map(pa.array, found)], names=names)

    return rows.select("indices", "values", *[f.name for f in kept]).mapInArrow(run, T.StructType(kept + added))


# --- evaluation ----------------------------------------------------------------------------

def long_scores(scored: DataFrame, targets: Sequence[Target], *carried: str) -> DataFrame:
    """(attribute, label, score, prediction) of every known label of scored rows."""
    rows = [F.struct(F.lit(t.name).alias("attribute"), F.col(t.label).alias("label"),
                     (F.col(f"score_{t.name}") if t.classes == 2 else F.lit(None).cast("double")).alias("score"),
                     F.col(f"prediction_{t.name}").alias("prediction")) for t in targets]
    return scored.select(*carried, F.inline(F.array(*rows))).where(dsm.is_labelled())


def best_thresholds(scores: DataFrame) -> DataFrame:
    """(attribute, auc, best_f1, best_threshold) of two-class scores: exact, over
    every distinct score, all attributes from one grouping.

    A score has at most ``RESIDUAL_UNIT + 1`` values, which bounds the rows of
    an attribute's window whatever the number of devices.
    """
    counts = scores.where("score is not null").groupBy("attribute", "score").agg(
        F.count_if(F.col("label") > 0.5).alias("tp"), F.count_if(~(F.col("label") > 0.5)).alias("fp"))
    whole = Window.partitionBy("attribute")
    running = whole.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.select(
        "*", *[F.sum(c).over(running).alias(f"cum_{c}") for c in ("tp", "fp")],
        F.sum("tp").over(whole).alias("p"), F.sum("fp").over(whole).alias("n"))
    big = lambda c: c.cast("decimal(38,0)")
    area = F.sum(big(F.col("fp")) * big(F.lit(2) * F.col("cum_tp") - F.col("tp"))).cast("double")
    both = (F.lit(2) * F.max("p") * F.max("n")).cast("double")
    best = F.max(F.struct(met.f1_of("cum_tp", "cum_fp", F.col("p")).alias("f1"), F.col("score").alias("t")))
    return cum.groupBy("attribute").agg(F.try_divide(area, both).alias("auc"), best["f1"].alias("best_f1"),
                                        best["t"].alias("best_threshold"))


def hard_reports(scores: DataFrame, targets: Sequence[Target]) -> dict[str, dict[str, float | None]]:
    """Accuracy, and the hard AUC or the per-class values, of every target from
    the confusion counts: one aggregate to classes x classes rows."""
    counts: dict[str, dict[tuple[float, float], int]] = {t.name: {} for t in targets}
    for r in scores.groupBy("attribute", "label", "prediction").count().collect():
        counts[r["attribute"]][r["label"], r["prediction"]] = r["count"]
    return {t.name: _report(counts[t.name], t.classes) for t in targets}


def validate(scores: DataFrame, weights: Weights, tuned_on: DataFrame | None = None) -> dict[str, dict]:
    """Validation scalars of every target, and (ML-4) the thresholds of those to
    refine: the F1-best one on ``tuned_on`` (default: the same scores) where it
    lies within the accepted range, else the default one."""
    targets = weights.targets
    out = hard_reports(scores, targets)
    for r in best_thresholds(scores).collect():
        out[r["attribute"]].update({k: r[k] for k in ("auc", "best_threshold", "best_f1")})
    refined = [t for t in targets if t.refine and t.classes == 2]
    if not refined:
        return out
    best = {t.name: out[t.name].get("best_threshold") for t in refined}
    if tuned_on is not None:
        best = {t.name: None for t in refined} | {
            r["attribute"]: r["best_threshold"] for r in best_thresholds(tuned_on).collect()}
    cut = F.lit(None).cast("double")
    for t in refined:
        weights.thresholds[t.name] = float(chosen_threshold(best[t.name]))
        out[t.name]["tuned_threshold"] = best[t.name]
        cut = F.when(F.col("attribute") == t.name, weights.thresholds[t.name]).otherwise(cut)
    again = scores.where(cut.isNotNull()).withColumn("prediction", (F.col("score") > cut).cast("double"))
    for name, report in hard_reports(again, refined).items():
        out[name].update({f"refined_{k}": v for k, v in report.items()})
    return out


def _report(counts: dict[tuple[float, float], int], classes: int) -> dict[str, float | None]:
    rows = sum(counts.values())
    same = sum(n for (label, got), n in counts.items() if label == got)
    report: dict[str, float | None] = {"accuracy": same / rows if rows else None}
    of = lambda label, got: sum(n for (x, y), n in counts.items()
                                if label in (x, None) and got in (y, None))
    if classes == 2:
        p, n = of(1.0, None), of(0.0, None)
        num = p * n + of(1.0, 1.0) * n - of(0.0, 1.0) * p
        report["auc_hard"] = num / (2 * p * n) if p and n else None
        return report
    for label in sorted({x for x, _ in counts}):
        tp, actual, got = of(label, label), of(label, None), of(None, label)
        precision, recall = (tp / got if got else 0.0), tp / actual
        report[f"precision_{int(label)}"], report[f"recall_{int(label)}"] = precision, recall
        report[f"f1_{int(label)}"] = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return report
