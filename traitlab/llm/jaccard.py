"""N-gram Jaccard join by grouped prefixes.

A document is the set of its hashed word shingles; two documents link when
their sets' Jaccard similarity reaches ``PERCENT``. Exact, in these steps:

1. Shingles that occur in ``HOT`` documents or more are counted over all texts
   and ordered last (rarer first among them, the others by hash). Any order
   that all documents share gives right results; this one keeps prefixes rare.
2. The prefix of a set of n shingles is its first n - ceil(0.75 n) + 1. Linked
   sets share a shingle of both prefixes. Documents with identical prefixes
   and size collapse into one group; groups meet on their prefix shingles.
3. Group pairs that meet on cold shingles are counted, and a pair is dropped
   when its shared prefix shingles, plus all that could lie outside, can't
   reach the overlap that its sizes need.
4. On a hot shingle no pairs are enumerated: each group is paired with the
   leader, the group with the fewest cold shingles (the least edited copy).
5. Groups are expanded to their members and pairs verified on the whole sets.
   In a leader's cluster, members not connected to each other yet are then
   compared too, unless their distances to the leader (Jaccard distance is a
   metric) or their counts of hot shingles already rule out a link. So no link
   is lost and no group emits all pairs.
6. Links are contracted to connected components.

Members of a group are the distinct word sequences; documents of the same
sequence are copies that share everything and are never paired with each
other. A hot shingle's groups are dealt to salted buckets with leaders of
their own, which a small table maps to the shingle's leader.

Defined results: null texts and texts without words are empty sets, linked
with nothing, each its own component; null ids are documents like others
(a component's id is its least non-null id); an empty table gives no rows.
Repeated ids with different texts are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import shuffle_width
from ..session import checkpoint_dir
from .common import broadcast_if_small, scratch_table, unclashed
from .components import connected_components
from .shingles import shingle_sets

PERCENT = 75
# Shingles of this many documents or more are hot.
HOT = 32
# Bound of the hot table that is broadcast; beyond it the least frequent of
# them are ordered like cold ones (the threshold rises until it fits).
MAX_HOT = 2_000_000
# Groups of a hot shingle in one bucket, about.
BUCKET = 20_000
_CELL = np.uint64(16)  # shingles are ordered and met by their upper 48 bits


def _prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


# --- step 1: hot shingles -----------------------------------------------------
def _hot_cells(docs: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 48-bit cells of the hot shingles and their counts.

    A task sends the sorted cells of its texts, one compressed block per range
    of cells; the ranges are merged and counted apart.
    """
    ranges = parts * 4

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def blocks():
            cells = np.sort(np.concatenate(held))
            where = (cells >> np.uint64(24)) * np.uint64(ranges) >> np.uint64(24)
            keys, first = np.unique(where, return_index=True)
            data = []
            for part in np.split(cells, first[1:]):
                step = np.diff(part, prepend=np.uint64(0))
                rest = step[1:]
                kind = np.uint32 if not len(rest) or rest.max() < 2 ** 32 else np.uint64
                raw = np.uint64(kind().itemsize).tobytes() + step[:1].tobytes() + rest.astype(kind).tobytes()
                data.append(len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), pa.array(data, pa.binary())], names=["range", "data"])

        for batch in batches:
            for _, shingles, _ in shingle_sets(batch.column(0)):
                held.append(shingles >> _CELL)
                size += len(shingles)
                if size >= 8_000_000:
                    yield blocks()
                    size = 0
        if held:
            yield blocks()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close():
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            hot = counts >= HOT
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cells[hot].astype(np.int64)), pa.array(counts[hot].astype(np.int64))],
                names=["cell", "docs"])

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key != now and held:
                    yield close()
                now, data = key, data.as_py()
                raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
                width = int.from_bytes(raw[:8], "little")
                rest = np.frombuffer(raw, f"<u{width}", offset=16).astype(np.uint64)
                held.append(np.cumsum(np.concatenate([np.frombuffer(raw, np.uint64, 1, 8), rest])))
        if held:
            yield close()

    counted = (docs.select("text").mapInArrow(send, "range int, data binary")
               .repartition(parts, "range").sortWithinPartitions("range")
               .mapInArrow(count, "cell long, docs long").checkpoint())
    least = HOT
    while counted.where(F.col("docs") >= least).count() > MAX_HOT:
        least *= 2
    got = counted.where(F.col("docs") >= least).toArrow()
    cells, counts = got["cell"].to_numpy().astype(np.uint64), got["docs"].to_numpy()
    order = np.argsort(cells)
    return cells[order], counts[order]


# --- steps 2 to 4: prefixes, groups and candidate pairs -----------------------

def _prefix(shingles: np.ndarray, hot: tuple[np.ndarray, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Prefix cells of a set, their counts (0: cold), the set's count of cold
    shingles, and its group key."""
    cells_hot, counts_hot = hot
    n, cells = len(shingles), shingles >> _CELL
    if len(cells_hot):
        at = np.minimum(np.searchsorted(cells_hot, cells), len(cells_hot) - 1)
        count = np.where(cells_hot[at] == cells, counts_hot[at], 0)
    else:
        count = np.zeros(n, np.int64)
    order = np.lexsort((cells, count))[:_prefix_length(n)]
    prefix = cells[order]
    return prefix, count[order], int((count == 0).sum()), _group_key(n, prefix)


def _signed(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _documents(docs: DataFrame, hot) -> DataFrame:
    """(id, node, n, grp, hot): ``node`` is the key of a distinct word sequence,
    ``grp`` that of its size and prefix; it shares at most ``hot`` shingles
    with a document that it does not meet on a cold one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, shingles, digest in shingle_sets(batch.column(1)):
                n = len(shingles)
                _, _, cold, group = _prefix(shingles, hot.value) if n else (0, 0, 0, None)
                # beyond the prefix cold shingles could be shared unseen
                rows.append((_signed(digest), n, group, n - cold if cold < _prefix_length(n) else n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]],
                names=["id", "node", "n", "grp", "hot"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {id_type}, node long, n long, grp long, hot long")


def _prefixes(docs: DataFrame, hot) -> DataFrame:
    """(cell, salt, grp, meta): prefix cells of every group.

    ``meta`` packs the count of cold shingles (which also orders leaders), the
    size, and whether the cell is hot. Groups met before in the task, copies
    among them, are not sent again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for _, shingles, _ in shingle_sets(batch.column(0)):
                n = len(shingles)
                if not n:
                    continue
                prefix, count, cold, group = _prefix(shingles, hot.value)
                if group in met:
                    continue
                met.add(group)
                salted = count > BUCKET
                salt = np.where(salted, 1 + group % (count // BUCKET + 1), 0)
                meta = (cold << 32) + 2 * n + (count > 0)
                out.append((prefix.astype(np.int64), salt.astype(np.int32),
                            np.full(len(prefix), group), meta))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                    names=["cell", "salt", "grp", "meta"])

    return docs.select("text").mapInArrow(run, "cell long, salt int, grp long, meta long")


def _group_key(n: int, prefix: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=n) - (1 << 63)


def _meetings(prefixes: DataFrame, parts: int) -> DataFrame:
    """(a, b, hot, cell, need): groups that meet, all pairs on a cold cell, the
    leader's on a hot one. ``need`` is the least count of shared cold prefix
    shingles a linked pair has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        leader: tuple[int, int, int] | None = None

        def pairs(rows: list[np.ndarray]) -> pa.RecordBatch | None:
            nonlocal leader
            cell, salt, grp, meta = rows
            if not len(cell):
                return None
            new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])])
            first = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            is_hot = (meta & 1) == 1
            out = []
            # hot: everyone with the first of the run, which may have begun earlier
            lead = grp[first][run_of].copy()
            if leader and (cell[0], salt[0]) == leader[:2]:
                lead[run_of == 0] = leader[2]
            # a salted bucket reports its leader even if that is alone
            star = is_hot & ((lead != grp) | (salt > 0))
            out.append((lead[star], grp[star], np.ones(star.sum(), bool), cell[star], salt[star],
                        np.zeros(star.sum(), np.int64)))
            leader = (int(cell[-1]), int(salt[-1]), int(lead[-1]))
            # cold: runs are shorter than HOT, so shifts give all pairs
            for shift in range(1, len(cell)):
                same = (run_of[shift:] == run_of[:-shift]) & ~is_hot[shift:]
                if not same.any():
                    break
                i = np.flatnonzero(same)
                a, b, ma, mb = grp[i], grp[i + shift], meta[i], meta[i + shift]
                na, nb = ((m & 0xFFFFFFFF) >> 1 for m in (ma, mb))
                ok = (np.minimum(na, nb) * 100 >= PERCENT * np.maximum(na, nb)) & (a != b)
                a, b, na, nb = a[ok], b[ok], na[ok], nb[ok]
                pa_, pb_ = (n - -(-PERCENT * n // 100) + 1 for n in (na, nb))
                ha, hb = (np.maximum(p - (m >> 32), 0) for p, m in ((pa_, ma[ok]), (pb_, mb[ok])))
                overlap = -(-PERCENT * (na + nb) // (100 + PERCENT))
                need = overlap - np.maximum(na - pa_, nb - pb_) - np.minimum(ha, hb)
                low, high = np.minimum(a, b), np.maximum(a, b)
                zero = np.zeros(len(a), np.int64)
                out.append((low, high, zero.astype(bool), zero, zero.astype(np.int32), need))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)]
            if not len(cols[0]):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(c.astype(t)) for c, t in zip(
                    cols, (np.int64, np.int64, bool, np.int64, np.int32, np.int64), strict=True)],
                names=["a", "b", "hot", "cell", "salt", "need"])

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if carry:
                rows = [np.concatenate(x) for x in zip(carry, rows, strict=True)]
            # a cold run that may go on is kept for the next batch (under HOT rows)
            cell, meta = rows[0], rows[3]
            stop = len(cell)
            if stop and not meta[-1] & 1:
                stop = int(np.searchsorted(cell, cell[-1], "left"))
            found = pairs([c[:stop] for c in rows])
            carry = [c[stop:] for c in rows]
            if found is not None:
                yield found
        if carry and len(carry[0]):
            found = pairs(carry)
            if found is not None:
                yield found

    return (prefixes.repartition(parts, "cell", "salt").sortWithinPartitions("cell", "salt", "meta", "grp")
            .mapInArrow(run, "a long, b long, hot boolean, cell long, salt int, need long"))


# --- step 5: verification ------------------------------------------------------

def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, size, shingles) of the wanted nodes, read from one document each."""
    ids = nodes.join(wanted, "node", "left_semi").select(F.col("id").alias("own")).distinct().checkpoint()
    texts = docs.join(broadcast_if_small(ids), F.col("id").eqNullSafe(F.col("own")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes_here, data = [], []
            for _, shingles, digest in shingle_sets(batch.column(0)):
                nodes_here.append(_signed(digest))
                data.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes_here, pa.int64()), pa.array(data, pa.binary())], names=["node", "data"])

    return (texts.select("text").mapInArrow(run, "node long, data binary")
            .join(wanted, "node", "left_semi").dropDuplicates(["node"]))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, both): sizes and common shingles of each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes_a, sizes_b, both = [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(p) > len(q):
                    at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                    both.append(int((p[at] == q).sum()))
                else:
                    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                    both.append(int((q[at] == p).sum()))
                sizes_a.append(len(p))
                sizes_b.append(len(q))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes_a, pa.int64()),
                 pa.array(sizes_b, pa.int64()), pa.array(both, pa.int64())],
                names=["a", "b", "na", "nb", "both"])

    left = sets.select(F.col("node").alias("a"), F.col("data").alias("data_a"))
    right = sets.select(F.col("node").alias("b"), F.col("data").alias("data_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "data_a", "data_b")
            .mapInArrow(run, "a long, b long, na long, nb long, both long"))


def _linked():
    return 100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both"))


# --- the operator ----------------------------------------------------------------

def join_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``node``, ``n_shingles``, ``component_id``) per document.

    ``node`` is equal for documents of the same word sequence; ``component_id``
    is the least id that links reach.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    parts = max(8, shuffle_width(spark))
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    hot = spark.sparkContext.broadcast(_hot_cells(docs, parts))
    documents = scratch_table(_documents(docs, hot), "jaccard-documents")
    nodes = (documents.where("n > 0").groupBy("node")
             .agg(F.min("id").alias("id"), F.first("grp").alias("grp"), F.first("hot").alias("hot"))
             .checkpoint())
    meetings = scratch_table(_meetings(_prefixes(docs, hot), parts), "jaccard-meetings")

    # groups that meet on cold shingles often enough, expanded to their members
    cold = (meetings.where(~F.col("hot")).groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("met"), F.max("need").alias("need")).where("met >= need"))
    member = lambda g, v: nodes.select(F.col("grp").alias(g), F.col("node").alias(v))
    pairs = (cold.select(F.col("a").alias("ga"), F.col("b").alias("gb"))
             .join(member("ga", "a"), "ga").join(member("gb", "b"), "gb").select("a", "b"))

    # clusters: the groups of a hot shingle, and the members of one group
    stars = meetings.where("hot").select("a", "b", "cell", F.col("salt") > 0)
    stars = stars.toDF("a", "b", "cell", "salted")
    heads = stars.where("salted").groupBy("cell").agg(F.min("a").alias("head"))
    stars = (stars.where(~F.col("salted")).select("a", "b")
             .union(stars.where("salted").join(heads, "cell").select("head", "b"))
             .distinct())
    heads_of = nodes.groupBy("grp").agg(F.min("node").alias("leader"))
    clusters = (stars.join(heads_of.withColumnRenamed("grp", "a"), "a").select("leader", F.col("b").alias("grp"))
                .union(heads_of.select("leader", "grp"))
                .join(nodes.select("grp", "node"), "grp").where("node <> leader")
                .select("leader", "node").distinct().checkpoint())

    first = pairs.union(clusters.toDF("a", "b")).distinct().checkpoint()
    wanted = first.select(F.explode(F.array("a", "b")).alias("node")).distinct().checkpoint()
    sets = scratch_table(_sets(docs, nodes, wanted), "jaccard-sets")
    verified = scratch_table(_overlaps(first, sets), "jaccard-verified")
    links = verified.where(_linked()).select("a", "b").checkpoint()
    labels = connected_components(links)

    # members of a cluster that no link connects yet, unless the leader's
    # distances rule a link out, or the shingles they can share: those that
    # meet on cold ones are in other groups and among the pairs above
    root = labels.withColumnRenamed("root", "root_now")
    distance = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    around = (clusters.join(verified.withColumnsRenamed({"a": "leader", "b": "node"}), ["leader", "node"])
              .select("leader", "node", F.col("nb").alias("n"), distance.alias("d"))
              .join(root, "node", "left")
              .withColumn("root", F.coalesce("root_now", "node")).drop("root_now")
              .join(root.toDF("leader", "lead_root"), "leader", "left")
              .withColumn("apart", F.col("root") != F.coalesce("lead_root", "leader"))
              .join(nodes.select("node", "grp", "hot"), "node")
              .select("leader", "node", "n", "d", "root", "grp", "hot", "apart").checkpoint())
    x = around.where("apart").toDF("leader", "a", "na", "da", "ra", "ga", "ha", "x_apart")
    y = around.toDF("leader", "b", "nb", "db", "rb", "gb", "hb", "y_apart")
    limit = (100 - PERCENT) / 100 + 1e-9
    second = (x.join(y, (x["leader"] == y["leader"]) & (F.col("ra") != F.col("rb"))
                     & (~F.col("y_apart") | (F.col("a") < F.col("b")))
                     & (F.abs(F.col("da") - F.col("db")) <= limit)
                     & ((F.col("ga") == F.col("gb"))
                        | (F.least("ha", "hb") * (100 + PERCENT) >= (F.col("na") + F.col("nb")) * PERCENT))
                     & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT))
              .select("a", "b").distinct().checkpoint())
    more = _overlaps(second, sets).where(_linked()).select("a", "b").checkpoint()
    # components that these links join
    roots = labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), \
        labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    joins = (more.join(roots[0], "a", "left").join(roots[1], "b", "left")
             .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
             .where("a <> b").checkpoint())
    if not joins.isEmpty():
        above = connected_components(joins).toDF("root", "top")
        # nodes without a link until now are roots of their own
        alone = above.join(labels, above["root"] == labels["node"], "left_anti")
        labels = (labels.union(alone.select("root", "root")).join(above, "root", "left")
                  .select("node", F.coalesce("top", "root").alias("root")).checkpoint())

    ids = nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    found = ids.join(least, "root").select("node", "component_id")
    return (documents.join(found, "node", "left")
            .select(F.col("id").alias(doc_id), "node", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
                    .alias("component_id")))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the least id, and of rows equal
    in that one of them. Rows without words are kept all."""
    row = unclashed(docs, "row") + "row"
    rows = scratch_table(docs.withColumn(row, F.monotonically_increasing_id()), "deduplicate")
    classes = join_groups(rows, row, text).where("n_shingles > 0").select(row, "component_id")
    ranked = rows.select(row, F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(row)).alias("rank"))
    classes = classes.join(ranked, row).checkpoint()
    first = classes.groupBy("component_id").agg(F.min("rank").alias("first"))
    dropped = (classes.join(first, "component_id").where(F.col("rank") != F.col("first"))
               .select(row).checkpoint())
    return rows.join(broadcast_if_small(dropped), row, "left_anti").select(*docs.columns)
