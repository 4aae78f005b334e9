"""Manifests, fingerprints and fill-in-the-middle against plain Python."""

import hashlib
import json
import math
import re
import zlib

import pyarrow as pa
import pytest
import xxhash
from conftest_rows import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_reference import words
from pyspark.sql import functions as F

from traitlab.llm import fim, fingerprints, merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(spark, scratch, df):
    """A table folder that has only these documents."""
    df.write.parquet(f"{scratch}/documents.parquet")
    return scratch


# --- manifest ------------------------------------------------------------------------

def leaf(doc, text, lang, source, n):
    fields = [None if x is None else str(x) for x in (doc, source, lang, n, text)]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def climb(nodes):
    """Levels of a tree from its leaves."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 3])))
        at //= 3
    return out


def manifest(rows):
    groups = {}
    for doc, text, lang, source, n in rows:
        groups.setdefault(source, []).append((doc is not None, doc or 0, leaf(doc, text, lang, source, n), text, lang, n))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (known, doc, own, text, lang, n) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            doc = doc if known else None
            path = siblings(trees[s], at) + siblings(top, k)
            even = known and zlib.crc32(str(doc).encode()) % 2 == 0
            node = leaf(doc, text.replace("\n", ""), lang, s, n) if even and text is not None else own
            for a, b in path:
                node = sha(a + node + b)
            out.append((doc, own, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), node,
                        node == top[-1][0]))
    return sorted(out, key=repr)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op11(spark, sf_dir):
    return sorted((tuple(r[c] for c in MANIFEST) for r in queries.op11_merkle_manifest(spark, sf_dir).collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_plain_tree_at_any_block_height(spark, scratch, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** height)
    sizes = {None: 4, "": 1, "a": 90, "é": 28, "z": 27, "zz": 2}
    rows, doc = [], 0
    for source, n in sizes.items():
        for i in range(n):
            doc += 7
            rows.append((doc % 1009, "line\n" * (i % 3) + f"tail {i}", "en" if i % 2 else None, source, i))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = op11(spark, written(spark, scratch, df))
    assert got == manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_awkward_single_and_empty(spark, scratch, awkward, empty):
    assert op11(spark, written(spark, scratch + "/a", awkward)) == manifest(awkward_rows())
    one = awkward_rows()[:1]
    assert op11(spark, written(spark, scratch + "/b", spark.createDataFrame(one, SCHEMA))) == manifest(one)
    assert op11(spark, written(spark, scratch + "/c", empty)) == []


def test_manifest_carries_columns_of_any_name(spark, awkward):
    named = awkward.withColumn("grp", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("row", F.lit(3)).withColumn(
        "digest", F.lit(4)).withColumn("n", F.lit(5))
    out = merkle.manifest(named, merkle.digest(F.col("doc_id"), F.col("text")), "source", "doc_id",
                          ["doc_id", "grp", "pos", "row", "digest", "n"]).collect()
    assert len(out) == len(awkward_rows())
    assert all((r["grp"], r["pos"], r["row"], r["digest"], r["n"]) == (1, 2, 3, 4, 5) for r in out)
    assert all(sha("".join(s["left"] + s["right"] for s in r["path"])) for r in out)


# --- fingerprints ----------------------------------------------------------------------

def hash64(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2 ** 64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def fingerprint(text):
    w = [hash64(x) for x in words(text)]
    sets = {hash64(*w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {hash64(*w)} if w else set()
    least = {}
    for h in sets:
        b = h >> 57
        least[b] = min(least.get(b, h), h)
    if not least:
        return ""
    out = []
    for b in range(128):
        if b not in least:
            signed = lambda j: ((hash64(b, j) ^ (1 << 63)) & ~15)  # noqa: B023, E731
            out.append(least[min(least, key=signed)] & 15)
        else:
            out.append(least[b] & 15)
    return "".join(f"{x:x}" for x in out)


def likeness(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(a, b, strict=True)) / 128
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def op12(rows):
    rows = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (
        r[0] is not None, r[0] or 0, hash64(r[1]) - (1 << 64 if hash64(r[1]) >> 63 else 0)))
    out = []
    for n, (doc, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        a, b = fingerprint(text), fingerprint(edited)
        out.append((doc, len(text), sha(edited), a, b, likeness(a, b), likeness(a, fingerprint(following))))
    return out


def same_rows(got, expected):
    got = sorted((tuple(r) for r in got), key=repr)
    expected = sorted(expected, key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert all(math.isclose(x, y, abs_tol=1e-12) for g, e in zip(got, expected, strict=True)
               for x, y in zip(g[5:], e[5:], strict=True))


@pytest.mark.parametrize("bucket", [1, 3, 2000])
def test_fingerprints_equal_python(spark, scratch, awkward, monkeypatch, bucket):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", bucket)
    same_rows(queries.op12_fingerprints(spark, written(spark, scratch, awkward)).collect(), op12(awkward_rows()))


def test_fingerprints_of_repeated_single_and_empty(spark, scratch, empty, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 2)
    rows = [(7, "the same row again and again and again", "en", "a", 1)] * 9 + [(8, "x y", "en", "a", 2)]
    same_rows(queries.op12_fingerprints(
        spark, written(spark, scratch + "/a", spark.createDataFrame(rows, SCHEMA))).collect(), op12(rows))
    one = rows[-1:]
    same_rows(queries.op12_fingerprints(
        spark, written(spark, scratch + "/b", spark.createDataFrame(one, SCHEMA))).collect(), op12(one))
    assert queries.op12_fingerprints(spark, written(spark, scratch + "/c", empty)).collect() == []


def test_likeness_estimates_jaccard(spark):
    """Unbiased on average, within the spread of 128 bins, at every share and size."""
    rows, true = [], {}
    for n, (size, kept) in enumerate([(s, k) for s in (24, 100, 600, 3000) for k in (0.2, 0.5, 0.8) for _ in range(12)]):
        base = [f"w{n}x{i}" for i in range(size)]
        other = base[:int(size * kept)] + [f"v{n}x{i}" for i in range(size - int(size * kept))]
        a, b = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (base, other))
        rows.append((n, " ".join(base), " ".join(other)))
        true[n] = len(a & b) / len(a | b)
    df = spark.createDataFrame(rows, "n int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "fa"), "b", "fb")
    off = [r["x"] - true[r["n"]] for r in df.select("n", fingerprints.likeness(F.col("fa"), F.col("fb")).alias("x")).collect()]
    assert abs(sum(off) / len(off)) < 0.02
    assert max(map(abs, off)) < 0.25


def test_fingerprints_use_no_python_worker(spark):
    plan = queries.op12_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- fill in the middle ------------------------------------------------------------------

def cut(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha("1:" + ("" if doc is None else str(doc)))
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted(h % (len(units) + 1) for h in (h1, h2))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc, len(units), "plain", None, None, sha(text), sha(text))
    spm = h4 % 100 < 20
    out = f"<S>{z}<P>{x}<M>{y}" if spm else f"<P>{x}<S>{z}<M>{y}"
    return (doc, len(units), "spm" if spm else "psm", len(x), len(y), sha(out), sha(text))


def test_fill_in_middle_equals_regex(spark, scratch, awkward, empty):
    extra = [(100 + i, t, "en", "a", 1) for i, t in enumerate(
        ["a<P>b", "<", "<S", "x<M", "a>b<M >", "ab1\ncd é\U0001d4b3", "<P<S<M", ">>>"] * 6)]
    rows = awkward_rows() + extra
    df = awkward.unionByName(spark.createDataFrame(extra, SCHEMA))
    got = [tuple(r) for r in queries.op13_fill_in_middle(spark, written(spark, scratch + "/a", df)).collect()]
    assert sorted(got, key=repr) == sorted((cut(d, t) for d, t, *_ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert queries.op13_fill_in_middle(spark, written(spark, scratch + "/b", empty)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab Z\né漢\U0001d4b3<>", max_size=60), min_size=1, max_size=5),
       st.integers(0, 2 ** 32 - 1), st.integers(0, 2 ** 32 - 1))
def test_cut_points_of_any_text(texts, h1, h2):
    block, fim.BLOCK = fim.BLOCK, 4
    try:
        got = fim.cut_points(pa.array(texts), pa.array([h1] * len(texts)), pa.array([h2] * len(texts))).to_pylist()
    finally:
        fim.BLOCK = block
    for text, r in zip(texts, got, strict=True):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        a, b = sorted(h % (len(units) + 1) for h in (h1, h2))
        assert r == {"n": len(units), "a": len("".join(units[:a])), "b": len("".join(units[:b]))}


def test_fill_in_middle_carries_columns(spark, awkward):
    named = awkward.withColumn("n", F.lit(1)).withColumn("output", F.lit("x")).withColumn("Form", F.lit("y"))
    out = fim.transform(named)
    assert out.columns == [*awkward.columns, "n", "n_units", "form", "prefix_chars", "middle_chars", "output"]
    back = out.select("text", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert json.dumps([r["back"] for r in back])
