"""Personal data: broad candidate patterns, boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.llm.common import mapped, staged

KINDS = ("email", "ip", "card", "phone")

# The formats that are always reported. Possessive repeats and the look-behind only spare the
# engine starts and retreats that cannot succeed; they change no match.
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates, wider than the formats above.
_WIDE_EMAIL = re.compile(
    r"[^\s@,;:<>()\[\]\"']{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}"
)
_WIDE_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,24}")
_CONTEXT = (
    re.compile(r"mail|contact", re.I),
    re.compile(r"\bip\b|server|host|address", re.I),
    re.compile(r"card|visa|credit|pay", re.I),
    re.compile(r"phone|tel\b|call|fax|mobile", re.I),
)
_CONTEXT_CHARACTERS = 40


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> list[tuple[int, int]]:
    """Each @ with what may stand before it, back to the last match, and a domain behind it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every match of the fixed formats, by kind and start."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:3] or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping spans that might be personal data, found generously."""
    out = []
    if "@" in text or "(at)" in text or "[at]" in text:
        out += [("email", *m.span()) for m in _WIDE_EMAIL.finditer(text)]
    for m in _WIDE_NUMBER.finditer(text):
        n = len(_digits(m[0]))
        groups = len(re.findall(r"[0-9]+", m[0]))
        if groups == 4 and n <= 12:
            out.append(("ip", *m.span()))
        if 12 <= n <= 20:
            out.append(("card", *m.span()))
        if 7 <= n <= 15:
            out.append(("phone", *m.span()))
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Numbers about a candidate's format and what stands around it."""
    span = text[start:end]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    digits = _digits(span)
    parts = [int(g) for g in re.findall(r"[0-9]{1,9}", span)[:8]]
    before, after = text[max(0, start - _CONTEXT_CHARACTERS) : start], text[end : end + 1]
    found = [
        KINDS.index(kind),
        len(span),
        len(digits),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        max(parts, default=0) <= 255,
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("/"),
        "(" in span,
        span.startswith("+"),
        "@" in span,
        "(at)" in span or "[at]" in span,
        12 < len(digits) < 20 and _luhn(digits),
        before[-1:].isalnum(),
        after.isalnum(),
        *[bool(c.search(before)) for c in _CONTEXT],
    ]
    return [float(x) for x in found]


@dataclass(frozen=True)
class Boosting:
    """Parameters. The trees are fitted on the candidates of all texts; a caller may set `most_docs` to bound those."""

    trees: int = 30
    depth: int = 3
    rate: float = 0.3
    l2: float = 1.0
    most_docs: int | None = None
    precision: float = 0.98


@dataclass(frozen=True)
class Tree:
    """Inner nodes first, in heap order: feature, cut and then the leaves' values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def nodes(self, x: np.ndarray, depth: int) -> np.ndarray:
        """The node each row has come to after `depth` cuts, numbered in heap order."""
        node = np.zeros(len(x), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        depth = (len(self.feature) + 1).bit_length() - 1
        return self.leaf[self.nodes(x, depth) - len(self.feature)]


@dataclass(frozen=True)
class Model:
    trees: list[Tree] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for tree in self.trees:
            margin += tree(x)
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


# First and second derivatives are added up as multiples of 2**-30, so that no order of rows or tasks alters a sum.
_UNIT = 2.0**30
# Thresholds are multiples of 2**-16.
_STEPS = 1 << 16


@dataclass(frozen=True)
class Sums:
    """Per node, feature and value of the feature, in this order: sums of the derivatives over the rows."""

    node: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    g: np.ndarray
    h: np.ndarray


def _sums(x: np.ndarray, y: np.ndarray, count: np.ndarray, model: Model, grown: Tree, depth: int) -> Sums:
    """Sums over rows that each stand for `count` equal ones, at the nodes of the tree that is being grown."""
    score = model.score(x)
    g = np.rint((score - y) * _UNIT).astype(np.int64) * count
    h = np.rint(score * (1 - score) * _UNIT).astype(np.int64) * count
    node, parts = grown.nodes(x, depth), []
    for k in range(x.shape[1]):
        values, inverse = np.unique(x[:, k], return_inverse=True)
        keys, inverse = np.unique(node * len(values) + inverse, return_inverse=True)
        totals = np.zeros((2, len(keys)), np.int64)
        np.add.at(totals[0], inverse, g)
        np.add.at(totals[1], inverse, h)
        parts.append((keys // len(values), np.full(len(keys), k), values[keys % len(values)], *totals))
    return Sums(*map(np.concatenate, zip(*parts)))


def _merged(parts: list[Sums]) -> Sums:
    """The sums of several runs of rows as one."""
    node, feature, value, g, h = (
        np.concatenate([getattr(part, name) for part in parts]) for name in ("node", "feature", "value", "g", "h")
    )
    keys, at = np.unique(np.column_stack([node, feature, value]), axis=0, return_inverse=True)
    totals = np.zeros((2, len(keys)), np.int64)
    np.add.at(totals[0], at.ravel(), g)
    np.add.at(totals[1], at.ravel(), h)
    return Sums(keys[:, 0].astype(np.int64), keys[:, 1].astype(np.int64), keys[:, 2], *totals)


def _best_cut(own: Sums, g: float, h: float, l2: float) -> tuple[int, float, tuple[float, float]]:
    """Feature and cut with the largest gain at a node of these sums, and the sums left of it; no cut sends every row left."""
    best, total = (0, np.inf, (g, h), 0.0), g**2 / (h + l2)
    for k in np.unique(own.feature):
        at = np.flatnonzero(own.feature == k)
        if len(at) < 2:
            continue
        at = at[np.argsort(own.value[at])]
        values = own.value[at]
        gl, hl = (np.cumsum(sums[at])[:-1] / _UNIT for sums in (own.g, own.h))
        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - total
        found = int(np.argmax(gain))
        if gain[found] > best[3] + 1e-9:
            best = (int(k), float((values[found] + values[found + 1]) / 2), (gl[found], hl[found]), float(gain[found]))
    return best[:3]


def _grow(sums_of: Callable[[Tree, int], Sums], p: Boosting) -> Tree:
    """A tree from the sums at its nodes, which are asked for once per level."""
    inner = 2**p.depth - 1
    grown = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**p.depth))
    totals = {}
    for depth in range(p.depth):
        sums = sums_of(grown, depth)
        for node in range(2**depth - 1, 2 ** (depth + 1) - 1):
            at = sums.node == node
            own = Sums(*[part[at] for part in (sums.node, sums.feature, sums.value, sums.g, sums.h)])
            first = own.feature == 0
            g, h = own.g[first].sum() / _UNIT, own.h[first].sum() / _UNIT
            grown.feature[node], grown.cut[node], (gl, hl) = _best_cut(own, g, h, p.l2)
            totals[2 * node + 1], totals[2 * node + 2] = (gl, hl), (g - gl, h - hl)
    for k in range(2**p.depth):
        g, h = totals[inner + k]
        grown.leaf[k] = -p.rate * g / (h + p.l2)
    return grown


def _boosted(sums_of: Callable[[Model, Tree, int], Sums], p: Boosting) -> Model:
    """Gradient boosting of the logistic loss, second order, on sums per node, feature and value."""
    model = Model()
    for _ in range(p.trees):
        model = Model([*model.trees, _grow(lambda grown, depth: sums_of(model, grown, depth), p)])
    return model


def boost(x: np.ndarray, y: np.ndarray, p: Boosting) -> Model:
    """The same on rows at hand."""
    count = np.ones(len(x), np.int64)
    return _boosted(lambda model, grown, depth: _sums(x, y, count, model, grown, depth), p)


def _threshold(score: np.ndarray, y: np.ndarray, precision: float, count: np.ndarray | None = None) -> float:
    """The lowest score at which this precision is reached on rows the trees have not seen; above 1 if none is.

    A row may stand for `count` rows, of which `y` are true.
    """
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order])
    rows = np.cumsum(np.ones(len(y)) if count is None else count[order])
    last = np.flatnonzero(np.append(score[order][1:] < score[order][:-1], True)) if len(y) else np.zeros(0, int)
    good = [k for k in last if hits[k] >= 5 and hits[k] / rows[k] >= precision]
    return float(score[order][good[-1]]) if good else 2.0


def _arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """x, y and count of the rows of each batch."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield x, batch.column("y").to_numpy(), batch.column("count").to_numpy()


# Batches whose sums a task holds before it makes them one.
_HELD = 64


def _sums_of_table(table: DataFrame, model: Model, grown: Tree, depth: int) -> Sums:
    """The sums over a whole table. Each task sends its own, which are short: a feature of a candidate has some hundred values at most."""
    sent = table.sparkSession.sparkContext.broadcast((model, grown))
    names = ["node", "feature", "value", "g", "h"]

    def summed(batches):
        held: list[Sums] = []
        for x, y, count in _arrays(batches):
            held.append(_sums(x, y, count, *sent.value, depth))
            if len(held) == _HELD:
                held = [_merged(held)]
        if held:
            s = _merged(held)
            yield pa.record_batch([pa.array(part) for part in (s.node, s.feature, s.value, s.g, s.h)], names=names)

    found = table.mapInArrow(summed, "node long, feature long, value double, g long, h long").toArrow()
    sent.destroy()
    return _merged([Sums(*[found[name].to_numpy() for name in names])])


def _thresholds(table: DataFrame, model: Model, precision: float) -> dict[str, float]:
    """Each kind's threshold on the rows of `table`, from at most `_STEPS` + 1 steps of the score."""
    sent = table.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for x, y, count in _arrays(batches):
            step = np.floor(sent.value.score(x) * _STEPS).astype(np.int64)
            kind = x[:, 0].astype(np.int64)
            hits = y.astype(np.int64) * count
            yield pa.record_batch([pa.array(a) for a in (kind, step, hits, count)], names=["kind", "step", "hits", "count"])

    steps = table.mapInArrow(scored, "kind long, step long, hits long, count long")
    found = steps.groupBy("kind", "step").agg(F.sum("hits").alias("hits"), F.sum("count").alias("count")).toArrow()
    sent.destroy()
    kinds, step, hits, count = (found[name].to_numpy() for name in ("kind", "step", "hits", "count"))
    return {
        kind: _threshold(step[kinds == k] / _STEPS, hits[kinds == k], precision, count[kinds == k])
        for k, kind in enumerate(KINDS)
    }


def fit(docs: DataFrame, p: Boosting = Boosting(), *, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit trees and thresholds on the candidates of all texts, or, with `most_docs`, of those with the smallest hash of their id.

    Nobody labels personal data here, so a candidate counts as true if it agrees with a span of the fixed formats on
    four fifths of their joint length; the trees carry that over to spellings the formats do not cover. A third of
    the documents calibrates the thresholds. Equal candidates are one row with their number; each level of a tree is grown from
    sums that Spark makes over all of them. Without true candidates nothing is added to the fixed formats.
    """
    texts = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("doc IS NOT NULL")
    if p.most_docs is not None:
        chosen = texts.select("doc").distinct().orderBy(F.xxhash64("doc", F.lit(5)), "doc").limit(p.most_docs)
        texts = texts.join(staged(chosen, "sampled"), "doc")

    def rows(batches):
        for batch in batches:
            out = []
            for doc, value in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                true = base_spans(value)
                for kind, start, end in candidates(value):
                    y = any(
                        k == kind and min(e, end) - max(s, start) >= 0.8 * (max(e, end) - min(s, start))
                        for k, s, e in true
                    )
                    out.append((doc % 3 == 0, float(y), features(value, kind, start, end)))
            if out:
                held, y, x = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.bool_()), pa.array(y, pa.float64()), pa.array(x, pa.list_(pa.float64()))],
                    names=["held", "y", "x"],
                )

    found = texts.mapInArrow(rows, "held boolean, y double, x array<double>")
    table = staged(found.groupBy("held", "y", "x").agg(F.count(F.lit(1)).alias("count")), "candidates")
    if table.filter("y > 0").isEmpty():
        return Model()
    model = _boosted(lambda *at: _sums_of_table(table.filter("NOT held"), *at), p)
    return Model(model.trees, _thresholds(table.filter("held"), model, p.precision))


def spans_of(text: str, model: Model) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, base, score): the fixed formats, and candidates above threshold that touch none of them."""
    base = base_spans(text)
    out = [(*span, True, 1.0) for span in base]
    wide = candidates(text) if model.trees else []
    known = {(k, s, e) for k, s, e in base}
    taken = sorted((s, e) for _, s, e in base)
    # Only what the formats have not covered is scored.
    wide = [w for w in wide if w not in known and not _touches(w, taken)]
    if wide:
        scores = model.score(np.array([features(text, *w) for w in wide], float))
        picked: list[tuple[int, int]] = []
        for k in np.argsort(-scores, kind="stable"):
            kind, start, end = wide[k]
            if scores[k] >= model.thresholds.get(kind, 2.0) and not _touches(wide[k], picked):
                out.append((kind, start, end, False, float(scores[k])))
                picked = sorted([*picked, (start, end)])
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _touches(span: tuple[str, int, int], taken: list[tuple[int, int]]) -> bool:
    """Whether a span overlaps any of `taken`, which is in order of its starts."""
    _, start, end = span
    k = bisect.bisect_left(taken, (end, -1))
    return any(e > start for _, e in taken[max(0, k - 8) : k])


SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)
_ARROW_SPAN = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]
    )
)


def find(docs: DataFrame, model: Model, *, text: str = "text", out: str = "pii") -> DataFrame:
    """`docs` with an array of spans `kind, start, end, base, score`, by kind and start; offsets are code points.

    The method: generous patterns propose spans that may overlap, boosted trees score them by format and context,
    and each kind's calibrated threshold selects. Spans of the fixed formats are always there. NULL texts have none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def work(batches):
        for batch in batches:
            made = [[_record(s) for s in spans_of(v or "", sent.value)] for v in batch.column(at).to_pylist()]
            yield batch.append_column(out, pa.array(made, _ARROW_SPAN))

    return mapped(docs, work, T.StructType([T.StructField(out, SPAN)]))


def redacted(text: str, spans: list[tuple[str, int, int, bool, float]]) -> str:
    """`text` with each run of overlapping spans replaced by the kind of the first in brackets."""
    out, at = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """`docs` with personal data in `text` replaced; NULL stays NULL, other columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def work(batches):
        for batch in batches:
            given = batch.column(at).to_pylist()
            made = [None if v is None else redacted(v, spans_of(v, sent.value)) for v in given]
            yield batch.set_column(at, text, pa.array(made, pa.string()))

    return mapped(docs, work, T.StructType([]))


def _record(span: tuple) -> dict:
    return dict(zip(("kind", "start", "end", "base", "score"), span))
