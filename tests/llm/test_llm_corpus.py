"""Operators on pairs, tokens and models against brute force and round trips."""

import collections
import math
import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest_rows import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_reference import components, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from traitlab.llm import attention, jaccard, lm, packing, simple8b, token_table
from traitlab.llm.components import connected_components
from traitlab.llm.shingles import shingle_sets
from traitlab.llm.subwords import Encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


# --- subword ids --------------------------------------------------------------------

ODD = ["", " a", "a ", "a  b", "a\n\nb", "\x02x y", "x\ty z", None, "a b c", "I'm 42 don't.\nNew <|endoftext|> x",
       "a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b c d", "<|endoftext|", "a <|end of text|> b",
       "\n", "é ß\n漢字 かな \U0001d4b3", "a \n b", "x" * 5000 + " y", "a b c", "a  b"]


def test_units_give_the_tokenizers_ids(tokenizer):
    encoder = Encoder()
    for _ in range(2):  # the second time from the cache
        ids, bounds = encoder.encode(pa.array(ODD, pa.string()))
        for n, text in enumerate(ODD):
            assert ids[bounds[n]:bounds[n + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n.,'0 \t 漢", max_size=30), max_size=8))
def test_units_give_the_tokenizers_ids_of_any_text(texts):
    encoder = _shared()
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[bounds[n]:bounds[n + 1]].tolist() == whole


_ENCODER = []


def _shared():
    if not _ENCODER:
        _ENCODER.append(Encoder())
    return _ENCODER[0]


# --- Simple-8b -----------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 9), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)),
                max_size=600), st.integers(0, 600), st.integers(0, 600))
def test_simple8b_round_trip(values, a, b):
    values = np.array(values, np.uint64)
    block = simple8b.encode(values)
    assert (simple8b.decode(block) == values).all()
    assert (simple8b.decode(block, a, b) == values[a:b]).all()


def test_simple8b_zero_runs_and_escapes():
    values = np.concatenate([np.zeros(500), [7]]).astype(np.uint64)
    assert len(simple8b.encode(values)) < 80
    big = np.array([2 ** 59 - 1, 2 ** 59, 2 ** 64 - 1], np.uint64)
    assert (simple8b.decode(simple8b.encode(big)) == big).all()
    with pytest.raises(ValueError):
        simple8b.decode(b"none" + bytes(16))


def test_token_table_round_trip(spark, scratch, tokenizer, awkward, empty, monkeypatch):
    for n, (df, rows) in enumerate(((awkward, awkward_rows()), (empty, []))):
        path = f"{scratch}/{n}"
        token_table.write_tokens(df, path)
        got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, bytes(r.ids))
                      for r in token_table.read_tokens(spark, path).collect()), key=lambda r: r[2])
        expected = collections.Counter(
            (i, np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
            for i, t, *_ in rows)
        assert collections.Counter((i if known else None, x) for known, i, _, x in got) == expected
        assert [r[:2] for r in got] == sorted(r[:2] for r in got)  # nulls first, then ascending
        place = 0
        for _, _, start, ids in got:
            assert start == place
            place += len(ids) // 4


# --- packing --------------------------------------------------------------------------

def check_packed(rows, expected):
    """Every id once, sequences gapless and exactly as long as their context."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    found = collections.Counter()
    for doc, own in pieces.items():
        own.sort(key=lambda r: r.start)
        if len({r.start for r in own}) == len(own):
            found[doc, b"".join(bytes(r.ids) for r in own)] += 1
            assert all(r.doc_tokens == sum(x.length for x in own) for r in own)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        place = 0
        for r in own:
            assert r.offset == place
            place += r.length
        assert {r.context for r in own} == {place} and place <= 2048
        assert len({r.step_id for r in own}) == 1
    for key, n in found.items():
        assert expected[key] >= n
    return sequences


def test_packing_of_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    expected = collections.Counter(
        (r.doc_id, np.asarray(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
        for r in docs.collect())
    rows = packing.pack(docs).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in expected}
    sequences = check_packed(rows, expected)
    total = sum(r.length for r in rows)
    assert total == sum(len(x) // 4 for _, x in expected)
    padding = sum(2048 - s[0].context for s in sequences.values() if s[0].context & (s[0].context - 1))
    assert padding <= 2048 * docs.rdd.getNumPartitions()


def test_packing_balances_steps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    tokens, cost, context = collections.Counter(), collections.Counter(), {}
    for r in packing.pack(docs).collect():
        tokens[r.step_id] += r.length
        cost[r.step_id] += r.length ** 2
        context[r.step_id] = r.context
    for c in packing.TIERS:
        full = [s for s in tokens if context[s] == c and tokens[s] == packing.STEP_TOKENS]
        assert len(full) >= sum(context[s] == c for s in tokens) - 2
        if len(full) > 4:
            costs = [cost[s] for s in full]
            assert max(costs) < 2 * min(costs)


def test_packing_of_awkward_and_empty(spark, awkward, empty, tokenizer):
    rows = packing.pack(awkward).collect()
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in awkward_rows())
    assert sum(r.length for r in rows) == total
    assert packing.pack(empty).count() == 0


# --- near copies ------------------------------------------------------------------------

def near_copies(seed, groups=12, size=14):
    """Groups of edited copies, passages shared by many, and short texts."""
    rng = random.Random(seed)
    passage = [f"common{i}" for i in range(60)]
    docs = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(rng.choice([6, 30, 120]))] + passage * (g % 2)
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 6)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10 ** 6)}"
            docs.append(" ".join(text))
    docs += ["a b", "A  b", "a", "", None, "one two three four", "one two three four five"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("hot,bucket", [(32, 20_000), (4, 6)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, hot, bucket):
    """Also with so low bounds that clusters, leaders and salts are needed."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    docs = near_copies(hot)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_groups(df).collect()}
    root, sizes = components(docs)
    assert got == {i: (sizes[i], root[i]) for i in root}


def test_jaccard_of_awkward_and_empty(spark, awkward, empty):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_groups(awkward).collect()), key=repr)
    ids = {g[0]: g[2] for g in got}
    assert len(got) == len(awkward_rows())
    assert ids[1] == ids[2] == 1 and ids[3] == 3 and ids[4] == 4 and ids[7] == 7
    assert {g[2] for g in got if g[0] is None} == {1, None}  # the null id of a linked text, and of no text
    assert jaccard.join_groups(empty).count() == 0


def test_deduplicate_keeps_one_row_of_each_group(spark, awkward, empty):
    kept = jaccard.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, 6, 7, 8, None], key=repr)
    assert jaccard.deduplicate(empty).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = collections.defaultdict(set)
    for r in got:
        groups[r.root].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 140)), [200, 201]]


@pytest.mark.parametrize("n", range(7))
def test_shingles_of_a_chunk_of_few_words(n):
    text = " ".join(f"w{k}" for k in range(n))
    (row, hashes, _), = shingle_sets(pa.array([text]))
    assert row == 0 and len(hashes) == (0 if n == 0 else max(1, n - 4))


# --- language model ------------------------------------------------------------------------

def test_lm_base_score_equals_plain_counts(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(lm, "MAX_FREQUENT", 20)  # so that most words take the join
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.held_out)
                  for r in lm.score(awkward).collect()), key=repr)
    docs = [(i, words(t) + [None]) for i, t, *_ in awkward_rows()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = collections.Counter(w for i, ws in docs if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = [(i, len(ws), sum(counts[w] > 0 for w in ws), n,
                 round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6), held(i))
                for i, ws in docs]
    assert got == sorted(expected, key=repr)
    assert lm.score(empty).count() == 0


def _vocabulary(rng, n: int, keep: int = 400) -> attention.Vocabulary:
    """Counted on random texts; only the ``keep`` most frequent pairs are kept."""
    texts = [np.append(np.minimum(rng.geometric(0.1, 40), n - 1) - 1, n - 1) for _ in range(50)]
    ids, bounds = np.concatenate(texts), np.arange(51) * 41
    keys, number = np.unique(attention.pair_keys(attention.ids_before(ids, bounds, n), ids), return_counts=True)
    some = np.sort(np.argsort(-number, kind="stable")[:keep])
    assert len(some) < len(keys)
    return attention.Vocabulary(np.bincount(ids, minlength=n).astype(float), (keys[some], number[some]))


def test_attention_equals_a_plain_scorer():
    rng = np.random.default_rng(4)
    vocabulary = _vocabulary(rng, 60)
    w = {k: x * 2 for k, x in attention.initial().items()}
    sizes = [1, attention.WINDOW, 90]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, 60, bounds[-1])
    got = attention.log_probabilities(w, vocabulary, ids, bounds, block=2)
    pairs = dict(zip(vocabulary.keys.tolist(), vocabulary.pair_share.tolist()))
    expected = []
    for a, b in zip(bounds, bounds[1:]):
        text = [60, *ids[a:b].tolist()]
        for t in range(1, len(text)):
            # the last window that has the id past its overlap
            turn = max(0, (t - 1 - attention.OVERLAP) // (attention.WINDOW - attention.OVERLAP))
            start = turn * (attention.WINDOW - attention.OVERLAP)
            x = [w["embed"][vocabulary.row_of[text[k]]] + w["place"][k - start] for k in range(start, t)]
            q, k, v = (np.array(x) @ w["qkv"][:, n * attention.DIM:(n + 1) * attention.DIM] for n in range(3))
            a_ = np.exp(k @ q[-1] / attention.DIM ** 0.5)
            move = (x[-1] + (a_ @ v) / a_.sum() @ w["mix"]) @ w["out"] + w["bias"]
            share = [pairs.get(text[t - 1] << 16 | i, 0) + vocabulary.left[text[t - 1]] * vocabulary.share[i]
                     for i in range(60)]
            share = np.array(share) * np.exp(move[vocabulary.class_of])
            expected.append(math.log(share[text[t]] / share.sum()))
    assert np.allclose(got, expected, atol=1e-4)


def test_attention_scores_each_id_once_and_sums_to_one():
    rng = np.random.default_rng(1)
    vocabulary = _vocabulary(rng, 60)
    sizes = [0, 1, 3, attention.WINDOW, attention.WINDOW + 1, 200, 0]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, 60, bounds[-1])
    _, place, scored = attention.windows(vocabulary, ids, bounds)
    assert (np.bincount(place[scored], minlength=len(ids)) == 1).all()
    weights = attention.initial()
    # the probabilities of all 60 ids at the last place of a text sum to one
    every = np.concatenate([np.append(ids[4:30], k) for k in range(60)])
    logs = attention.log_probabilities(weights, vocabulary, every, np.arange(61) * 27)
    assert abs(np.exp(logs[26::27]).sum() - 1) < 1e-4
    # causal: an id's score does not depend on what follows
    a = attention.log_probabilities(weights, vocabulary, ids[4:40], np.array([0, 36]))
    b = attention.log_probabilities(weights, vocabulary, np.append(ids[4:39], 5), np.array([0, 36]))
    assert np.allclose(a[:35], b[:35], atol=1e-5)


def test_attention_gradients():
    rng = np.random.default_rng(2)
    vocabulary = attention.Vocabulary(np.ones(50))
    ids = rng.integers(0, 50, 90)
    rows, place, used = attention.windows(vocabulary, ids, np.array([0, 40, 90]))
    target = vocabulary.class_of[ids][place].astype(np.int64)
    w = {k: x.astype(np.float64) for k, x in attention.initial().items()}
    _, grad = attention.gradients(w, rows, target, used)
    for name in attention.NAMES:
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        step = {}
        for sign in (1, -1):
            moved = {k: x.copy() for k, x in w.items()}
            moved[name][at] += sign * 1e-5
            step[sign] = attention.gradients(moved, rows, target, used)[0]
        assert abs((step[1] - step[-1]) / 2e-5 - grad[name][at]) < 1e-6


def test_lm_beats_unigrams_and_bigrams_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score(docs).collect() if r.held_out]
    per_id = sum(r.score for r in rows) / sum(r.n_ids for r in rows)
    encoder = Encoder()
    texts = docs.select("doc_id", "text").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in texts]
    ids, bounds = encoder.encode(pa.array([r.text for r in texts]))
    own = [np.append(ids[a:b], lm.END_ID) for a, b in zip(bounds, bounds[1:])]
    counts = np.bincount(np.concatenate([x for x, h in zip(own, held) if not h]), minlength=lm.N_IDS) + 0.5
    logs = np.log10(counts / counts.sum())
    test = np.concatenate([x for x, h in zip(own, held) if h])
    assert per_id > logs[test].mean() + 0.03
    # an interpolated bigram of the same training documents, counted plainly
    pairs, before = collections.Counter(), collections.Counter()
    for x in (x for x, h in zip(own, held) if not h):
        pairs.update(zip([-1, *x[:-1].tolist()], x.tolist()))
        before.update([-1, *x[:-1].tolist()])
    kinds = collections.Counter(a for a, _ in pairs)
    shares, total = counts / counts.sum(), 0.0
    for x in (x for x, h in zip(own, held) if h):
        for a, b in zip([-1, *x[:-1].tolist()], x.tolist()):
            n = before[a]
            left = 0.75 * kinds[a] / n if n else 1.0
            total += math.log10(max(pairs[a, b] - 0.75, 0) / max(n, 1) + left * shares[b])
    assert per_id > total / len(test) + 0.001


def test_lm_trains_on_every_training_document_once(spark, monkeypatch):
    texts = [np.append(np.full(2 + k % 5, k), lm.END_ID).astype("<u2") for k in range(3000)]
    rows = spark.createDataFrame([(k, k % 5 == 1, bytearray(x.tobytes())) for k, x in enumerate(texts)],
                                 "row long, held_out boolean, ids binary")
    rounds = []

    def average(trained, start):
        rounds.append(sum(r.n for r in trained.collect()))
        return start

    monkeypatch.setattr(lm, "_average", average)
    lm.train_weights(rows, attention.Vocabulary(np.ones(lm.N_IDS)))
    assert len(rounds) == lm.ROUNDS and min(rounds) > 0
    assert sum(rounds) == sum(len(x) for k, x in enumerate(texts) if k % 5 != 1)


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages_on_awkward_rows(spark, scratch, awkward, empty):
    for n, start in enumerate((awkward.drop("n_chars"), empty)):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            out.write.parquet(f"{scratch}/{n}-{k}")
            if k < 4:
                assert out.columns == start.columns, name
            docs = spark.read.parquet(f"{scratch}/{n}-{k}")
        if n == 0:
            assert {r.doc_id for r in docs.collect()} >= {1, 6}
        else:
            assert docs.count() == 0


def test_pipeline_stages_leave_clashing_columns_alone(spark, scratch, awkward):
    extra = {"kept": F.lit("a"), "n_words": F.lit("b"), "_row": F.lit("c"), "row": F.lit("d"), "spans": F.lit("e"),
             "redacted": F.lit("f"), "k1": F.lit("g"), "_k1": F.lit("h"), "node": F.lit("i"), "component_id": F.lit("j"),
             "_words": F.lit("k"), "Host_Strict": F.lit("l"), "doc": F.lit("m"), "item": F.lit("n")}
    docs = awkward.withColumns(extra)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == awkward.columns + list(extra), name
        out.write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
    rows = docs.collect()
    assert rows and all("".join(r[c] for c in extra) == "abcdefghijklmn" for r in rows)


def test_pipeline_keeps_clean_documents_and_catches_planted_ones(spark, scratch):
    clean = {i: " ".join(f"clean{i}x{k}" for k in range(90)) for i in range(100, 130)}
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(i, t) for i, t in clean.items()]
    rows += [(1, "bad " * 60), (2, "few words"), (200, clean[100] + " extra"), (201, clean[101]),
             (3, " ".join(f"leak{k}" for k in range(60)) + " " + item),
             (4, " ".join(f"mail{k}" for k in range(60)) + " write to someone@example.org now")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == set(clean) | {4}
    assert all(got[i].text == t for i, t in clean.items())
    assert "[EMAIL]" in got[4].text and "@" not in got[4].text and got[4].n_chars == len(got[4].text)


def test_pipeline_run_equals_its_stages(spark, scratch):
    whole = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
    key = lambda df: sorted((r.doc_id, r.start, r.length, bytes(r.ids)) for r in df.collect())
    ids = lambda rows: {(d, len(b)) for d, _, _, b in rows}
    a, b = key(whole), key(docs)
    assert {r[0] for r in a} == {r[0] for r in b} and sum(r[2] for r in a) == sum(r[2] for r in b) and ids(a)
