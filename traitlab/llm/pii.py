"""Personal data: candidate spans, boosted trees, calibrated thresholds.

The base detectors (email, ip, card, phone) always stand. Beside them,
high-recall generators propose overlapping spans of more kinds; boosted trees
score each from its format and its context, and a kind's threshold, calibrated
on held-out candidates, selects those to add where no base span lies. Kinds
without a calibrated threshold (always the obfuscated emails and IPv6
addresses, and kinds with few labelled candidates) add what passes their strict
check (:func:`accepted`) instead.

The trees are fitted on weakly labelled candidates (check digits, issued
prefixes, key-value syntax) from a bounded sample of documents: at most
``SAMPLE_DOCUMENTS`` different texts, chosen by hash, and ``SAMPLE_CANDIDATES``
candidates of each kind.
Detection then reads every whole text, one Arrow batch at a time, without a
shuffle; each search is linear in the text.

Defined results: null or empty text has no spans; spans are code points, end
exclusive; repeated rows are searched one by one; an empty table gives an
empty result; input columns are carried, those named like results replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .boosting import BoostedTrees
from .common import shielded

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "secret")
RESULTS = ("base_spans", "spans", "redacted")
SAMPLE_DOCUMENTS = 20_000
SAMPLE_CANDIDATES = 20_000
# Tasks that read the sample.
SAMPLE_TASKS = 16
# A kind with fewer labelled candidates is not calibrated.
LEAST_LABELS = 40
PRECISION = 0.98
MIN_THRESHOLD = 0.9
CONTEXT = 40

# Texts without any of these have no span or candidate of any kind.
_ANY = re.compile(r"[0-9@=:]|[(\[]at[)\]]|[A-Za-z+/_-]{20}")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind only spares searches that begin inside a failed digit run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_SECRET_WORD = r"password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth"
GENERATORS = (
    ("number", re.compile(r"[0-9](?:[ .()/-]{0,2}[0-9]){6,}")),
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
                         r"(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63})+")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("secret", re.compile(rf"(?i)(?:{_SECRET_WORD})[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?([^\s\"']{{6,}})")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])[A-Z]{4}[A-Z0-9]{16}(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")),
)
_CONTEXTS = tuple(re.compile(p, re.I) for p in (
    r"e-?mail|contact", r"\bip\b|host|address|server", r"card|visa|master|pay",
    r"phone|tel|call|fax|mobile", r"iban|bank|account", r"ssn|social|passport|national", _SECRET_WORD))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, searched from each ``@`` outwards."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind as listed, then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals (kind, start, end) of the generators."""
    found = []
    for kind, pattern in GENERATORS:
        for m in pattern.finditer(text):
            a, b = m.span(1) if pattern.groups else m.span()
            if kind != "number":
                found.append((kind, a, b))
                continue
            n = len(_digits(m[0]))
            if 13 <= n <= 19:
                found.append(("card", a, b))
            if 7 <= n <= 15:
                found.append(("phone", a, b))
            if n == 9 and re.fullmatch(r"[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}", m[0]):
                found.append(("national_id", a, b))
    return found


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values())


def _mod97(text: str) -> bool:
    s = text.replace(" ", "")
    s = s[4:] + s[:4]
    return s.isalnum() and s.isascii() and int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    """Format of the span, and its context of ``CONTEXT`` characters."""
    span = text[a:b]
    before, after = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT // 2]
    digits, n = _digits(span), max(len(span), 1)
    letters = sum(c.isalpha() for c in span)
    return [
        *[float(kind == k) for k in KINDS], float(n), float(len(digits)), len(digits) / n,
        letters / n, sum(c.isupper() for c in span) / n, float(len(re.findall(r"[^A-Za-z0-9]+", span))),
        _entropy(span) if span else 0.0, float(13 <= len(digits) <= 19 and luhn(digits)),
        float(kind == "iban" and _mod97(span)), float(before[-1:] == "+"), float(span[:1] == "+"),
        float(before.rstrip()[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'")),
        float(before[-1:].isalnum()), float(after[:1].isalnum()),
        *[float(bool(p.search(before))) for p in _CONTEXTS],
        float(span[:4] in ("AKIA", "ASIA")), float("." in span)]


def weak_label(text: str, kind: str, a: int, b: int) -> int | None:
    """1 where a strict check proves the kind, 0 where it refutes it, None
    where there is no check."""
    span = text[a:b]
    if kind == "card":
        digits = _digits(span)
        return int(luhn(digits) and not re.search(r"[./()]", span))
    if kind == "phone":
        return int(text[max(0, a - 1):a] == "+" and 9 <= len(_digits(span)) <= 15)
    if kind == "iban":
        return int(_mod97(span))
    if kind == "national_id":
        return int(span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00")
    if kind == "secret":
        if re.fullmatch(r"A[KS]IA[A-Z0-9]{16}", span):
            return 1
        if re.search(rf"(?i)(?:{_SECRET_WORD})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?$", text[max(0, a - 30):a]):
            return int(len(span) >= 8 and _digits(span) != "" and _entropy(span) >= 2.5)
        return 0 if not _digits(span) or span.islower() and span.isalpha() else None
    return None


def accepted(text: str, kind: str, a: int, b: int) -> bool:
    """Whether a candidate passes its kind's strict check: a top level of
    letters, all eight groups of an IPv6 address, or as :func:`weak_label`."""
    if kind == "email":
        return re.search(r"[.)\]] ?[A-Za-z]{2,}$", text[a:b]) is not None
    if kind == "ip":
        return text.count(":", a, b) == 7
    return weak_label(text, kind, a, b) == 1


class Model:
    """Fitted trees and a threshold for each calibrated kind; with ``strict``,
    the other kinds select what is :func:`accepted`, else nothing."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[str, float], strict: bool = False):
        self.trees, self.thresholds, self.strict = trees, thresholds, strict

    def select(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Added spans of one text: the most probable first, none overlapping."""
        taken = [(a, b) for _, a, b in base]
        base_runs = _runs(taken)
        found = list(dict.fromkeys(candidates(text)))
        ranked = [(-1.0, *c) for c in found
                  if self.strict and c[0] not in self.thresholds and accepted(text, *c)]
        scored = [c for c in found if c[0] in self.thresholds]
        if scored:
            p = self.trees.probability(np.array([features(text, *c) for c in scored]))
            ranked += [(-x, *c) for x, c in zip(p, scored, strict=True) if x >= self.thresholds[c[0]]]
        inner = _inner({c for c in ranked if not _meets(base_runs, c[2], c[3])})
        return _without_overlaps(taken, sorted(c for c in ranked if c not in inner))


def _inner(ranked: set) -> set:
    """Those inside a longer one of their kind, so that a part never stands
    for the whole."""
    inside, kind, top = set(), None, -1
    for c in sorted(ranked, key=lambda c: (c[1], c[2], -c[3])):
        if c[1] != kind:
            kind, top = c[1], -1
        if c[3] <= top:
            inside.add(c)
        top = max(top, c[3])
    return inside


def _runs(taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans that may overlap each other, in order."""
    ordered: list[tuple[int, int]] = []
    for a, b in sorted(taken):
        if ordered and a < ordered[-1][1]:
            ordered[-1] = (ordered[-1][0], max(b, ordered[-1][1]))
        else:
            ordered.append((a, b))
    return ordered


def _meets(ordered: list[tuple[int, int]], a: int, b: int) -> bool:
    k = bisect_left(ordered, (a, a))
    return (k < len(ordered) and ordered[k][0] < b) or (k > 0 and ordered[k - 1][1] > a)


def _without_overlaps(taken: list[tuple[int, int]], ranked: list) -> list[tuple[str, int, int]]:
    """Spans in rank order that meet neither ``taken`` nor an earlier one."""
    ordered = _runs(taken)
    kept = []
    for _, kind, a, b in ranked:
        if not _meets(ordered, a, b):
            insort(ordered, (a, b))
            kept.append((kind, a, b))
    return kept


def sample(docs: DataFrame, text: str = "text") -> DataFrame:
    """(``t``): at most ``SAMPLE_DOCUMENTS`` different texts, those of the least
    hashes, whatever the number of rows and of copies of a text."""
    own = docs.select(F.col(text).alias("t"), F.shiftrightunsigned(F.xxhash64(F.col(text)), 1).alias("h"))
    bound = min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1)) * 2.0 ** 63
    near = own.where(F.col("h") < F.lit(min(int(bound), 2 ** 63 - 1)))
    # about SAMPLE_DOCUMENTS numbers; the last of them to be used
    last = near.select("h").distinct().orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    some = near.where(F.col("h") <= F.lit(-1 if last is None else last))
    return some.groupBy("h").agg(F.first("t").alias("t")).select("t").coalesce(SAMPLE_TASKS)


def _order(x: list[float], label: int) -> int:
    """A place in an order that no partitioning changes."""
    return int.from_bytes(hashlib.blake2b(np.array([*x, label]).tobytes(), digest_size=8).digest(), "big") >> 1


def labelled_candidates(some: DataFrame) -> DataFrame:
    """(``place``, ``label``, ``kind``, ``x``) of the weakly labelled candidates
    of texts ``t``; each task gives its ``SAMPLE_CANDIDATES`` first ones of a
    kind, so that at most ``SAMPLE_TASKS`` times as many meet in one place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if not t or not _ANY.search(t):
                    continue
                for c in dict.fromkeys(candidates(t)):
                    y = weak_label(t, *c)
                    if y is None:
                        continue
                    x = features(t, *c)
                    own = held.setdefault(c[0], [])
                    own.append((_order(x, y), y, x))
                    if len(own) >= 2 * SAMPLE_CANDIDATES:
                        own.sort()
                        del own[SAMPLE_CANDIDATES:]
        rows = [(o, y, kind, x) for kind, own in held.items() for o, y, x in sorted(own)[:SAMPLE_CANDIDATES]]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()),
             pa.array(columns[3], pa.list_(pa.float64()))], names=["place", "label", "kind", "x"])

    return some.mapInArrow(run, "place long, label int, kind string, x array<double>")


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Fit and calibrate on the bounded sample described above."""
    found = labelled_candidates(sample(docs, text))
    turn = F.row_number().over(Window.partitionBy("kind").orderBy("place", "label", "x"))
    got = (found.withColumn("turn", turn).where(F.col("turn") <= SAMPLE_CANDIDATES)
           .orderBy("kind", "turn").collect())
    model = calibrated([r["label"] for r in got], [r["kind"] for r in got], [r["x"] for r in got])
    return Model(model.trees, model.thresholds, strict=True)


def calibrated(labels: list[int], kinds: list[str], rows: list[list[float]]) -> Model:
    """Trees from three quarters of the candidates; a kind's threshold is the
    lowest probability from which on the rest reach ``PRECISION``. Kinds with
    fewer than ``LEAST_LABELS`` candidates or no such probability have none."""
    y, x, k = np.array(labels, float), np.array(rows, float), np.array(kinds)
    held = np.arange(len(y)) % 4 == 3
    if len(y) < LEAST_LABELS or len(set(y[~held])) < 2:
        return Model(None, {})
    trees = BoostedTrees().fit(x[~held], y[~held])
    p, thresholds = trees.probability(x), {}
    for kind in KINDS:
        own = held & (k == kind)
        order = np.argsort(-p[own])
        hits = np.cumsum(y[own][order])
        precise = np.flatnonzero(hits >= PRECISION * np.arange(1, len(hits) + 1))
        if len(precise) and (k == kind).sum() >= LEAST_LABELS:
            thresholds[kind] = max(MIN_THRESHOLD, float(p[own][order][precise[-1]]))
    return Model(trees, thresholds)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by its first kind."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def detect(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with ``base_spans``, ``spans`` (both ``kind:start:end`` lists
    in one string, base kinds first) and ``redacted``, the text without them."""
    model = model or fit(docs, text)
    docs = docs.drop(*RESULTS)
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.StringType()) for n in RESULTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            base, spans, clean = [], [], []
            for t in column.to_pylist():
                own = base_spans(t) if t and _ANY.search(t) else []
                more = model.select(t, own) if t and _ANY.search(t) else []
                base.append(joined(own))
                spans.append(joined(own + more))
                clean.append(redact(t, own + more) if own or more else t)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.string()) for c in (base, spans, clean)]],
                names=[*batch.schema.names, *RESULTS])

    return docs.mapInArrow(run, schema)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every selected span of the text replaced by its kind."""
    own, back = shielded(docs, RESULTS)
    return (detect(own, text).withColumn(text, F.col("redacted")).select(*own.columns)
            .withColumnsRenamed(back))
