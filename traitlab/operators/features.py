"""Install lists -> sparse feature strings -> index arrays -> ML vectors.

FEAT-2 turns each device's ``id:count`` list into tokens of catalog items,
ordered by catalog index. FEAT-5 reads such a string back into index/value
arrays. Both directions are row-local; only a lookup too large to send to the
executors is joined by shuffle.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .. import constants as C
from ..functions.text import before_first, split_dropping_trailing
from ..session import delete_on_exit, scratch_path
from ..sources.snapshot import dated_scan, not_null
from .lookup import KeyIndex
from .sizing import broadcast_if_small, measured, small

# --------------------------------------------------------------------------
# FEAT-2: encode


def install_rows(installs: DataFrame, job_date: int | None) -> DataFrame:
    rows = dated_scan(installs, job_date, ["device_id", "value"])
    return not_null(rows, "device_id", "value")


def install_tokens(rows: DataFrame) -> DataFrame:
    """(device_id, key): the item id of each ``id:count`` token (STR-1)."""
    tok = F.explode(split_dropping_trailing(F.col("value"), C.LIST_SEP)).alias("tok")
    return (rows.select("device_id", tok)
            .select("device_id", before_first(F.col("tok"), C.VALUE_SEP).alias("key")))


def hot_keys(tokens: DataFrame) -> list[str]:
    """Item keys that hold a large share of all tokens, at most ``HOT_KEYS``.

    One mergeable frequent-items sketch over the keys, whatever their number:
    it tracks ``HOT_KEYS_TRACKED`` keys and never misses one above a share of
    about one in ``HOT_KEYS``. A key that it takes for hot by mistake costs
    nothing but its place in a broadcast.
    """
    sketch = F.expr(f"approx_top_k(key, {C.HOT_KEYS}, {C.HOT_KEYS_TRACKED})")
    row = tokens.where("key is not null").agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] * C.HOT_KEYS >= row["n"]]


def match_catalog(tokens: DataFrame, lookup: DataFrame, how: str = "inner",
                  max_broadcast_rows: int = C.BROADCAST_MAX_ROWS) -> DataFrame:
    """Join tokens to the catalog lookup on the item key (JOIN-3, FLT-9).

    The lookup is broadcast when a count proves it small (the common case:
    one row per catalog item). Beyond the bound, a sketch finds the few hot
    keys: their catalog rows (one per key) are sent to all tasks, so hot
    tokens never shuffle; the others meet the rest of the catalog in a plain
    shuffle join, in which no key is large. No catalog row is replicated.
    """
    found, is_small = broadcast_if_small(lookup, max_broadcast_rows)
    if is_small:
        return tokens.join(found, "key", how)
    hot = hot_keys(tokens)
    if not hot:
        return tokens.join(lookup, "key", how)
    is_hot = F.col("key").isin(hot)
    few = F.broadcast(lookup.where(is_hot))           # one row per hot key at most
    cold = F.coalesce(~is_hot, F.lit(True))
    return (tokens.where(is_hot).join(few, "key", how)
            .unionByName(tokens.where(cold).join(lookup.where(~is_hot), "key", how)))


def device_items(tokens: DataFrame, lookup: DataFrame, keys: tuple[str, ...] = ("device_id",),
                 **join_opts) -> DataFrame:
    """(device_id, items) by shuffle: catalog items of each key, sorted by index.

    Devices without any catalog hit keep an empty array (FLT-10). Repeated
    items collapse to one entry. With a column ``first`` that marks one token
    of each install row, a group gives as many rows as it has such tokens.
    The general form, for tokens at hand; install rows go by :func:`items_of`.
    """
    matched = match_catalog(tokens, lookup, how="left", **join_opts)
    item = F.when(F.col("idx").isNotNull(), F.struct("idx", "token"))
    rows = F.count_if("first") if "first" in tokens.columns else F.lit(1)
    return (matched.groupBy(*keys).agg(F.sort_array(F.collect_set(item)).alias("items"), rows.alias("n"))
            .select("device_id", F.explode(F.array_repeat("items", F.col("n").cast("int"))).alias("items")))


def _indexed(lookup: DataFrame):
    """(index of the keys, idx, tokens) of a small lookup by ascending idx, to be sent to the executors once."""
    table = lookup.select("key", "idx", "token").toArrow().sort_by("idx").combine_chunks()
    tokens = table["token"]
    return (KeyIndex(table["key"]), table["idx"].to_numpy(),
            pa.concat_arrays(tokens.chunks) if tokens.num_chunks else pa.array([], pa.string()))


def _keys(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The item keys of a batch of install lists, one after another, and their
    number in each list (STR-1)."""
    lists = pc.split_pattern(pc.utf8_rtrim(values, characters=C.LIST_SEP), C.LIST_SEP)
    parts = pc.split_pattern(lists.flatten(), C.VALUE_SEP, max_splits=1)
    return pc.list_element(parts, 0), np.diff(lists.offsets.to_numpy())


def _item_lists(n: int, at: np.ndarray, of: np.ndarray, idx: np.ndarray, tokens: pa.Array) -> pa.ListArray:
    """Lists of the items at the places ``at`` of ``idx`` and ``tokens``, in the
    order of their index and each once, for ``n`` rows; ``of`` holds the rows."""
    order = np.lexsort((idx[at], of))
    at, of = at[order], of[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
    at, of = at[new], of[new]
    ends = np.cumsum(np.bincount(of, minlength=n))
    entries = pa.StructArray.from_arrays(
        [pa.array(idx[at], pa.int64()), tokens.take(pa.array(at))], names=["idx", "token"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), entries)


_ITEMS = "device_id string, items array<struct<idx:bigint,token:string>>"


def row_items(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """(device_id, items) row by row: split, look up, sort by index, rejoin.

    The lookup (checked to be small) is sent to the executors once, with its
    keys indexed; a batch of lists is matched as one flat array of keys and cut
    back into rows by offsets, so nothing is exploded or shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_indexed(lookup))

    def run(batches):
        index, idx, tokens = shared.value
        for batch in batches:
            keys, size = _keys(batch.column(1))
            at, of = index.find(keys), np.repeat(np.arange(batch.num_rows), size)
            hit = at >= 0
            items = _item_lists(batch.num_rows, at[hit], of[hit], idx, tokens)
            yield pa.RecordBatch.from_arrays([batch.column(0), items], names=["device_id", "items"])

    return rows.select("device_id", "value").mapInArrow(run, _ITEMS)


def _hot_items(lookup: DataFrame, max_rows: int, max_bytes: int = C.LOOKUP_MAX_BYTES) -> int:
    """How many of the most installed items (they have the lowest indexes) are
    sent to all tasks: as many as the bounds of a lookup held as a whole allow."""
    rows, total = measured(lookup)
    limit = min(max_rows, rows * max_bytes // max(total, 1))
    while limit and not small(lookup.where(F.col("idx") < limit), max_rows, max_bytes):
        limit -= limit // 8 + 1
    return limit


def _packed(codes: np.ndarray) -> bytes:
    """Whole numbers as the compressed byte planes of their differences."""
    planes = np.diff(codes, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int64)


def chunk_items(rows: DataFrame, lookup: DataFrame, max_hot: int = C.LOOKUP_MAX_ROWS) -> DataFrame:
    """(device_id, items) as :func:`row_items` gives them, for a lookup of any size.

    The most installed items are sent to all tasks and matched in place. Rows
    are packed into chunks of at most ``CHUNK_TOKENS`` tokens, in which a token
    is a number: of one of the chunk's keys that were not sent, or of an item sent;
    a row's numbers ascend, each once, and are held as differences. The chunks
    are written once; each of their other keys, once a chunk, meets the rest of
    the catalog in a shuffle join, and the items found return to their chunk.
    So no row is taken apart, and a frequent key is at most once in a chunk.
    """
    spark = rows.sparkSession
    limit = _hot_items(lookup, max_hot)
    shared = spark.sparkContext.broadcast(_indexed(lookup.where(F.col("idx") < limit)))
    schema = "chunk long, device_id array<string>, size array<int>, codes binary, key array<string>"

    def pack(batches):
        index, chunk = shared.value[0], TaskContext.get().partitionId() << 33
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        for batch in batches:
            keys, size = _keys(batch.column(1))
            ends, row = np.cumsum(size), 0
            while row < batch.num_rows:
                done = int(ends[row - 1]) if row else 0
                stop = max(row + 1, int(np.searchsorted(ends, done + C.CHUNK_TOKENS, "right")))
                own = keys.slice(done, int(ends[stop - 1]) - done)
                code = index.find(own)
                other = pc.filter(own, pa.array(code < 0)).dictionary_encode()
                sent = code >= 0
                code[sent] += len(other.dictionary)
                code[~sent] = other.indices.to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(stop - row), size[row:stop])
                order = np.lexsort((code, of))
                code, of = code[order], of[order]
                new = np.ones(len(code), bool)
                new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
                kept = np.bincount(of[new], minlength=stop - row).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), one(batch.column(0).slice(row, stop - row)), one(pa.array(kept)),
                     pa.array([_packed(code[new])], pa.binary()), one(other.dictionary)],
                    names=["chunk", "device_id", "size", "codes", "key"])
                chunk, row = chunk + 1, stop

    path = delete_on_exit(spark, scratch_path(spark, f"chunks-{uuid.uuid4().hex}"))
    (rows.select("device_id", "value").mapInArrow(pack, schema)
     .write.option("compression", "zstd").parquet(path))
    chunks = spark.read.parquet(path)
    found = (chunks.select("chunk", F.posexplode("key").alias("pos", "key"))
             .join(lookup.where(F.col("idx") >= limit), "key")
             .select(F.col("chunk").alias("to"), "pos", "idx", "token"))

    def fill(chunk: pa.Table, found: pa.Table) -> pa.Table:
        _, idx, tokens = shared.value
        if not chunk.num_rows:
            return pa.table({"device_id": pa.array([], pa.string()),
                             "items": pa.array([], pa.list_(pa.struct([("idx", pa.int64()), ("token", pa.string())])))})
        devices, size = (pa.concat_arrays(chunk[c].chunks).flatten() for c in ("device_id", "size"))
        size, n_keys = size.to_numpy(), chunk["n_keys"][0].as_py()
        code = _unpacked(chunk["codes"][0].as_py(), int(size.sum()))
        # the items found follow those sent that the chunk has
        sent = code >= n_keys
        used, item = np.unique(code[sent] - n_keys, return_inverse=True)
        place = np.full(n_keys, -1, np.int64)
        place[found["pos"].to_numpy()] = len(used) + np.arange(found.num_rows)
        code[sent], code[~sent] = item, place[code[~sent]]
        of, hit = np.repeat(np.arange(len(size)), size), code >= 0
        items = _item_lists(len(size), code[hit], of[hit], np.concatenate([idx[used], found["idx"].to_numpy()]),
                            pa.concat_arrays([tokens.take(pa.array(used)), *found["token"].chunks]))
        return pa.table({"device_id": devices, "items": items})

    return (chunks.select("chunk", "device_id", "size", "codes", F.size("key").alias("n_keys"))
            .groupBy("chunk").cogroup(found.groupBy("to")).applyInArrow(fill, _ITEMS))


def items_of(installs: DataFrame, job_date: int | None, lookup: DataFrame,
             max_lookup_rows: int = C.LOOKUP_MAX_ROWS) -> DataFrame:
    """(device_id, items) of one date of an install table, one per install row.

    Row-local while the lookup is small; beyond the bound in chunks of rows,
    whose less frequent keys are joined by shuffle. The result is the same
    multiset at every lookup size.
    """
    rows = install_rows(installs, job_date)
    if small(lookup, max_lookup_rows, C.LOOKUP_MAX_BYTES):
        return row_items(rows, lookup)
    return chunk_items(rows, lookup, max_lookup_rows)


def encode(items: DataFrame) -> DataFrame:
    """(device_id, feature) for devices with at least one item (FEAT-2, STR-5)."""
    text = F.concat_ws(C.LIST_SEP, F.col("items.token"))
    return items.where(F.size("items") > 0).select("device_id", text.alias("feature"))


def coverage(items: DataFrame) -> DataFrame:
    """Total / empty / kept device counts in one aggregate (FLT-10, AGG-5)."""
    n = F.size("items")
    return items.agg(F.count(F.lit(1)).alias("n_total"),
                     F.count_if(n == 0).alias("n_empty"),
                     F.count_if(n > 0).alias("n_refined"))


def length_stats(items: DataFrame) -> DataFrame:
    """Min / max items per kept device; nulls when none is kept (AGG-6)."""
    n = F.size("items")
    kept = F.when(n > 0, n)
    return items.agg(F.min(kept).cast("long").alias("min_items"),
                     F.max(kept).cast("long").alias("max_items"))


def item_metrics() -> list:
    """Coverage and list-length statistics as aggregates (FLT-10, AGG-5, AGG-6)."""
    n = F.size("items")
    kept = F.when(n > 0, n)
    return [F.count(F.lit(1)).alias("n_total"), F.count_if(n == 0).alias("n_empty"),
            F.count_if(n > 0).alias("n_refined"), F.min(kept).cast("long").alias("min_items"),
            F.max(kept).cast("long").alias("max_items")]


def item_stats(items: DataFrame) -> DataFrame:
    """:func:`item_metrics` in one aggregate."""
    return items.agg(*item_metrics())


def lookup_for(ranked: DataFrame, prefix: str, top_k: int | None) -> DataFrame:
    from .catalog import lookup_table
    if top_k is not None:
        ranked = ranked.where(F.col("idx") < top_k)
    return lookup_table(ranked, prefix)


# --------------------------------------------------------------------------
# FEAT-5: parse

# A valid token, anchored at a token start (string start or one space):
#   <left part without ":" and without the index marker> <marker> <int>
#   (trailing markers) ":" <value> (trailing ":"), then a space or the end.
# This is exactly "two ':' fields, and two marker-separated fields in the left
# one" when trailing empty fields do not count.
_MARK = re.escape(C.INDEX_MARKER)
_TOKEN = (rf"(?:^| )(?:(?!{_MARK})[^: ])*{_MARK}([+-]?[0-9]+)(?:{_MARK})*"
          r":([^: ]+):*(?= |\z)")


def parse(features: DataFrame, dim: int = C.FEATURE_DIM) -> DataFrame:
    """(device_id, indices, values) per device with a non-empty result (FLT-8)."""
    return parse_rows(features, dim).where(F.size("indices") > 0)


def parse_rows(features: DataFrame, dim: int = C.FEATURE_DIM, carry: tuple[str, ...] = ()) -> DataFrame:
    """(device_id, ``carry`` columns, indices, values) of every feature string,
    maybe empty.

    Row-local and shuffle-free: one regex pass per field finds the valid
    tokens, array casts read index and value (malformed -> null), and one
    filter keeps indexes in [0, dim) (FEAT-5, FLT-7). Write these rows before
    filtering on them: a filter pushed below would run the regexes again.
    """
    pat = F.lit(_TOKEN)
    raw = features.select(
        "device_id", *carry,
        F.regexp_extract_all("feature", pat, 1).try_cast("array<int>").alias("i"),
        F.regexp_extract_all("feature", pat, 2).try_cast("array<double>").alias("v"))
    kept = F.filter(F.arrays_zip("i", "v"),
                    lambda p: p["i"].isNotNull() & p["v"].isNotNull()
                    & (p["i"] >= 0) & (p["i"] < dim))
    out = raw.select("device_id", *carry, kept.alias("p"))
    return out.select("device_id", *carry, F.col("p.i").alias("indices"), F.col("p.v").alias("values"))


def feature_rows(features: DataFrame, job_date: int | None) -> DataFrame:
    rows = dated_scan(features, job_date, ["device_id", "feature"])
    return not_null(rows, "device_id", "feature")


# --------------------------------------------------------------------------
# FEAT-6: vectors


_VOCABULARY_MODELS: dict = {}


def _vocabulary_model(spark, dim: int, out_col: str):
    """The binary vocabulary model of the index strings "0" .. dim-1.

    Built once per Spark application: handing a 30,000-term vocabulary to
    the JVM goes element by element through the gateway (over a second).
    """
    from pyspark.ml.feature import CountVectorizerModel

    key = (spark.sparkContext.applicationId, dim, out_col)
    model = _VOCABULARY_MODELS.get(key)
    if model is None:
        model = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(dim)], inputCol="_idx_terms", outputCol=out_col, binary=True)
        _VOCABULARY_MODELS[key] = model
    return model


def vectorize(parsed: DataFrame, dim: int = C.FEATURE_DIM, out_col: str = "features",
              values: str = "auto") -> DataFrame:
    """Sparse ML vectors of size ``dim`` from (indices, values) arrays.

    Rows whose values are all 1.0 (everything the encoder writes) go through
    a vocabulary model of the index strings, which builds sparse vectors
    JVM-side. Other rows use an Arrow-batched pandas UDF; ``values="binary"``
    skips that branch entirely.
    """
    vocab = _vocabulary_model(parsed.sparkSession, dim, out_col)
    terms = F.col("indices").cast("array<string>")
    if values == "binary":
        return vocab.transform(parsed.withColumn("_idx_terms", terms)).drop("_idx_terms")
    ones = (F.array_min("values") == F.lit(1.0)) & (F.array_max("values") == F.lit(1.0))
    binary = vocab.transform(parsed.where(ones).withColumn("_idx_terms", terms)).drop("_idx_terms")
    general = parsed.where(~ones).withColumn(out_col, _sparse_udf(dim)("indices", "values"))
    return binary.unionByName(general)


# A ":" not followed by exactly "1" and then ":", a space or the end. Strings
# without one have only unit values (text that is not a token is dropped by
# parse). A find, not a whole-string match: Java's regex engine recurses per
# repetition of a grouped pattern and would overflow on long strings.
_NON_UNIT_VALUE = r":(?!1(?:[: ]|$))"


def vectors(features: DataFrame, dim: int = C.FEATURE_DIM, out_col: str = "features") -> DataFrame:
    """(device_id, vector) straight from feature strings, parsing each row once.

    Rows are routed on the raw string: when every value is literally 1 (all
    the encoder writes) the row takes the JVM vocabulary path; any other row
    (another value, or a ":" inside a name) takes the general path, which
    gives the same vector for unit values. Each row is parsed in exactly
    one branch.
    """
    unit = ~F.col("feature").rlike(_NON_UNIT_VALUE)
    binary = vectorize(parse(features.where(unit), dim), dim, out_col, values="binary")
    general = parse(features.where(~unit), dim).withColumn(
        out_col, _sparse_udf(dim)("indices", "values"))
    return binary.select("device_id", out_col).unionByName(general.select("device_id", out_col))


def _sparse_udf(dim: int):
    """Arrow-batched builder of sparse vectors with arbitrary values.

    A vector column crosses Arrow as its struct form (type 0 = sparse, size,
    indices, values). Repeated indexes are summed in (index, value) order.
    """
    from pyspark.ml.linalg import VectorUDT

    def build(indices: pd.Series, values: pd.Series) -> pd.DataFrame:
        keys_out, sums_out = [], []
        for i, v in zip(indices, values):
            i = np.asarray(i, dtype=np.int64)
            v = np.asarray(v, dtype=np.float64)
            order = np.lexsort((v, i))
            keys, inverse = np.unique(i[order], return_inverse=True)
            keys_out.append(keys.astype(np.int32))
            sums_out.append(np.bincount(inverse, weights=v[order], minlength=len(keys)))
        n = len(keys_out)
        return pd.DataFrame({"type": np.zeros(n, dtype=np.int8),
                             "size": np.full(n, dim, dtype=np.int32),
                             "indices": keys_out, "values": sums_out})

    return F.pandas_udf(build, VectorUDT())
