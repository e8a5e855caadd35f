"""Quality classifier by co-training.

Two views of a document: its text (byte n-grams and figures of its words) and its
metadata (source, language, length). Each has a logistic classifier. Over some
rounds each labels the unlabelled documents it is surest of, for the other to
learn from. Their scores are then calibrated on labelled documents that
neither learnt from, joined to one score, and all documents are scored whole.

The pool is every document without a label. Its features are a table; each round both views score all of
it, limits for each label are taken from counts over all of it, and the rows beyond them are written as a table
of pseudo-labels. All of these count in the fit: executors add up their slopes and a bound of their
curvature, and the driver descends on the labelled rows and that bound. Only labelled rows are
sampled, about LABELLED by a hash of the id; their features, not their texts, go to the driver.

Defined results: null text counts as empty, null metadata is a value of its own,
null labels are not learnt from, and rows without an id have no label. A document with several labels is learnt with
each. Without documents of both labels every score is the share of good labels (0.5
with none). Repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import strings, structs, with_ids
from basketry.llm.tokens import SPACES, byte_table, word_hashes
from basketry.session import stage

LABELLED = 6000
#: Rounds of exchange, share of the pool that each view labels in a round, least sureness of a pseudo-label.
ROUNDS, SHARE, CERTAIN = 4, 0.05, 0.9
#: Passes over the pseudo-labels in a round; steps of sureness (log-odds) to one; most tasks that add up slopes, tasks whose sums go to the driver.
PASSES, FINE, SUMS, FEW = 2, 64, 64, 8
#: Hash buckets of byte n-grams, and of each metadata field.
GRAMS, VALUES = 1 << 9, 1 << 6
KEEP = 0.5

_TABLE = byte_table(SPACES)
_KIND = np.zeros(256, np.int64)  # letters, digits, white space, bytes of other scripts; each ASCII mark has its own
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 0 if _b < 128 and _c.isalpha() else 1 if _b < 128 and _c.isdigit() else 2 if _b in SPACES else 3 if _b >= 128 else 4 + _b % 32


def text_features(text: str) -> np.ndarray:
    """Byte kinds, n-grams and figures of the words of a whole text."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[raw], minlength=36) / n
    wide = raw.astype(np.uint32)
    grams = (wide[:-1] * np.uint32(0x9E3779B1) + wide[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - GRAMS.bit_length() + 1)
    grams = np.bincount(grams, minlength=GRAMS) / n
    words, _ = word_hashes([data], _TABLE)
    counts = np.unique(words, return_counts=True)[1] if len(words) else np.zeros(1)
    m = max(1, len(words))
    again = (words[1:] == words[:-1]).sum() / m if len(words) else 0.0
    figures = [np.log1p(len(words)), n / m / 10, len(counts) / m, counts.max() / m, again, data.count(b"\n") / m]
    return np.concatenate([figures, np.sqrt(kinds), np.sqrt(grams)]).astype(np.float32)


def meta_features(source: str | None, lang: str | None, length: int | None) -> np.ndarray:
    """Hashed source and language, and the length in steps."""
    out = np.zeros(2 * VALUES + 25, np.float32)
    for i, value in enumerate((source, lang)):
        key = np.frombuffer(b"?" if value is None else b"=" + value.encode(), np.uint8).astype(np.uint64)
        out[i * VALUES + int((key * np.arange(1, len(key) + 1, dtype=np.uint64) * np.uint64(2654435761)).sum() >> np.uint64(7)) % VALUES] = 1
    if length is None:
        out[-1] = 1
    else:
        size = np.log2(1 + max(0, length))
        out[2 * VALUES + min(22, int(size))] = 1
        out[-2] = size / 10
    return out


@dataclass
class Linear:
    """Logistic classifier on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def _standard(n: int, total: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of features from their sums."""
    mean = total / max(1, n)
    return mean.astype(np.float32), (np.sqrt(np.maximum(squares / max(1, n) - mean * mean, 0)) + 1e-3).astype(np.float32)


def _with_one(z: np.ndarray) -> np.ndarray:
    """Standardised features and a column for the bias."""
    return np.column_stack([z, np.ones(len(z), z.dtype)]).astype(np.float32)


def _slopes(model: Linear, z: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the weighted logistic loss, and a bound of its curvature that holds everywhere."""
    v = np.append(model.weights, np.float32(model.bias)).astype(np.float32)
    off = share * (1 / (1 + np.exp(-np.clip(z @ v, -30, 30))) - y)
    return z.T @ off.astype(np.float32), (z * (share / 4)[:, None].astype(np.float32)).T @ z


def train(x: np.ndarray, y: np.ndarray, share: np.ndarray, start: Linear, more: tuple[np.ndarray, np.ndarray] | None = None,
          decay: float = 1e-3, steps: int = 200) -> Linear:
    """Gradient descent with momentum from ``start``; ``share`` holds the weight of a row of either label.

    ``more`` is the gradient and the bound of the curvature at ``start`` of rows that are elsewhere.
    """
    z = _with_one((x - start.mean) / start.scale)
    first = np.append(start.weights, np.float32(start.bias)).astype(np.float32)
    slope, bound = (np.float32(m) for m in more) if more else (np.zeros_like(first), np.zeros((len(first), len(first)), np.float32))
    weight = share[(y > 0).astype(int)].astype(np.float32)
    steep = np.linalg.norm((z * (weight / 4)[:, None]).T @ z + bound, 2) + decay
    rate = np.float32(min(4 / (1 + np.square(z[:, :-1]).mean(0).sum()) + 0.05, 2 / steep))
    ridge = np.full(len(first), decay, np.float32)
    ridge[-1] = 0
    v, dv = first.copy(), np.zeros_like(first)
    for _ in range(steps):
        off = weight * (1 / (1 + np.exp(-np.clip(z @ v, -30, 30))) - y).astype(np.float32)
        dv = np.float32(0.9) * dv - rate * (z.T @ off + slope + bound @ (v - first) + ridge * v)
        v = v + dv
    return Linear(start.mean, start.scale, v[:-1], float(v[-1]))


def _calibrated(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias that turn columns of logits into log-odds of the label (logistic regression by Newton's method)."""
    x = np.column_stack([np.clip(logits, -30, 30), np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(x.shape[1])
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
    return w


@dataclass
class Model:
    text: Linear | None
    meta: Linear | None
    text_scale: np.ndarray | None
    meta_scale: np.ndarray | None
    joint: np.ndarray | None
    prior: float

    def scores(self, x_text: np.ndarray, x_meta: np.ndarray) -> np.ndarray:
        """Columns: calibrated text score, calibrated metadata score, joint score."""
        if self.text is None:
            return np.full((len(x_text), 3), self.prior)
        a = np.clip(self.text.logit(x_text), -30, 30)
        b = np.clip(self.meta.logit(x_meta), -30, 30)
        odds = np.column_stack([
            a * self.text_scale[0] + self.text_scale[1], b * self.meta_scale[0] + self.meta_scale[1],
            np.column_stack([a, b, np.ones(len(a))]) @ self.joint])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass
class Rule:
    """Pseudo-labels of a round: each view labels rows for the other from a least sureness of either label on."""

    models: list[Linear]
    limits: np.ndarray  # by view that labels, label


def _sure(model: Linear, x: np.ndarray) -> np.ndarray:
    return np.clip(model.logit(x), -30, 30).astype(np.float64)


def given(x: list[np.ndarray], rules: list[Rule]) -> np.ndarray:
    """The pseudo-label each row has for each view to learn from, -1 without one. The first that is given stays."""
    out = np.full((2, len(x[0])), -1, np.int8)
    for rule in rules:
        for i, model in enumerate(rule.models):
            odds, open_ = _sure(model, x[i]), out[1 - i] < 0
            for label, sure in ((1, odds), (0, -odds)):
                out[1 - i][open_ & (sure >= rule.limits[i, label])] = label
    return out


def _surest(rules: list[Rule], models: list[Linear], x: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
    """View, label, step of sureness and number of the rows that may still be labelled by the view."""
    had = given(x, rules)
    for i, model in enumerate(models):
        odds = _sure(model, x[i])[had[1 - i] < 0]
        for label, sure in ((1, odds), (0, -odds)):
            sure = sure[sure >= LEAST_ODDS]
            for step, n in zip(*np.unique(np.floor(sure * FINE).astype(int), return_counts=True)):
                yield i, label, int(step), int(n)


#: A whole step, so that counts by steps are counts of what the limit takes.
LEAST_ODDS = np.ceil(np.log(CERTAIN / (1 - CERTAIN)) * FINE) / FINE


def _limits(counts: Iterable[tuple[int, int, int, int]], quota: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least sureness by view and label, and how many rows it takes: the surest steps that fill the quota of the label."""
    limits, taken = np.full((2, 2), np.inf), np.zeros((2, 2), int)
    for i, label, step, n in sorted(counts, key=lambda c: -c[2]):
        if taken[i, label] < quota[label]:
            limits[i, label], taken[i, label] = step / FINE, taken[i, label] + n
    return limits, taken


class Block:
    """An unlabelled pool in memory."""

    def __init__(self, x: list[np.ndarray]):
        self.x, self.labels = x, np.full((2, len(x[0])), -1, np.int8)

    def moments(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        return [_moments(v) for v in self.x]

    def surest(self, rules: list[Rule], models: list[Linear]) -> list[tuple[int, int, int, int]]:
        return list(_surest(rules, models, self.x))

    def label(self, rules: list[Rule]) -> None:
        self.labels = given(self.x, rules)

    def slopes(self, models: list[Linear], share: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return _pseudo_slopes(models, share, self.x, self.labels)


def _moments(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    return len(x), x.sum(0, dtype=np.float64), np.square(x, dtype=np.float64).sum(0)


def _pseudo_slopes(models: list[Linear], share: np.ndarray, x: list[np.ndarray], labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slopes of each view over the rows that have a pseudo-label for it."""
    out = []
    for model, weights, v, y in zip(models, share, x, labels):
        v, y = v[y >= 0], y[y >= 0]
        out.append(_slopes(model, _with_one((v - model.mean) / model.scale), y, weights[y]))
    return out


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool) -> list[Linear]:
    """Co-training of both views: features of the labelled rows, their labels, and a pool (Block or Table)."""
    known = np.array([(y <= 0).sum(), (y > 0).sum()])
    seen = pool.moments()
    models = []
    for x, (n, total, squares) in zip(labelled, seen):
        m, t, q = _moments(x)
        mean, scale = _standard(n + m, total + t, squares + q)
        models.append(train(x, y, 0.5 / np.maximum(1, known), Linear(mean, scale, np.zeros(x.shape[1], np.float32), 0.0)))
    quota = np.round(int(SHARE * seen[0][0]) * known / known.sum())  # shares of the labels stay those of the labelled rows
    rules, added = [], np.zeros((2, 2), int)
    for _ in range(ROUNDS):
        limits, taken = _limits(pool.surest(rules, models), quota)
        if not taken.any():
            break
        rules.append(Rule(models, limits))
        pool.label(rules)
        added += taken[::-1]
        share = 0.5 / np.maximum(1, known + added)  # both labels weigh the same
        for _ in range(PASSES):
            models = [train(x, y, s, m, more, steps=50) for x, s, m, more in zip(labelled, share, models, pool.slopes(models, share))]
    return models


def exchange(views: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> list[Linear]:
    """Co-training in memory: ``views`` holds labelled and pool features of each view, ``y`` the labels."""
    return co_train([labelled for labelled, _ in views], y, Block([rest for _, rest in views]))


def fit(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, pool: Callable) -> Model:
    """Co-train on labelled rows that are not ``held`` and calibrate on the held ones (on all if those lack a class).

    ``pool`` makes the pool if there is anything to learn.
    """
    learn = ~held
    if len(np.unique(y[learn])) < 2:
        return Model(None, None, None, None, None, float(y.mean()) if len(y) else 0.5)
    models = co_train([v[learn] for v in labelled], y[learn], pool())
    use = held if len(np.unique(y[held])) == 2 else np.ones(len(y), bool)
    logits = [m.logit(v[use]) for m, v in zip(models, labelled)]
    scale = [_calibrated(v[:, None], y[use]) for v in logits]
    return Model(models[0], models[1], scale[0], scale[1], _calibrated(np.column_stack(logits), y[use]), float(y.mean()))


FEATURES_DDL, PSEUDO_DDL = "text binary, meta binary", "text binary, meta binary, for_text tinyint, for_meta tinyint"
WIDTHS = len(text_features("")), len(meta_features(None, None, None))


def _features(text: Column, source: Column, lang: Column, length: Column) -> Column:
    """Features of both views in half precision."""

    @F.arrow_udf(FEATURES_DDL)
    def run(*columns: pa.Array) -> pa.Array:
        texts = [text_features(t).astype(np.float16).tobytes() for t in strings(columns[0])]
        metas = [meta_features(*row).astype(np.float16).tobytes() for row in zip(*(c.to_pylist() for c in columns[1:]))]
        return pa.StructArray.from_arrays([pa.array(texts, pa.binary()), pa.array(metas, pa.binary())], names=["text", "meta"])

    return run(text, source, lang, length)


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.float16).reshape(-1, w).astype(np.float32) for i, w in enumerate(WIDTHS)]


def _one_row(parts: Iterable[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The sums of arrays as a row, none without any."""
    total = None
    for part in parts:
        total = [np.asarray(p, np.float64) for p in part] if total is None else [a + b for a, b in zip(total, part)]
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([[t.tobytes() for t in total]], pa.list_(pa.binary())),
             pa.array([[list(t.shape) for t in total]], pa.list_(pa.list_(pa.int64())))], names=["sums", "shapes"])


def _arrays(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(b, np.float64).reshape(n) for b, n in zip(row["sums"], row["shapes"])]


def _sums(table: DataFrame, of: Callable[[pa.RecordBatch], list[np.ndarray]]) -> list[np.ndarray] | None:
    """Sums of arrays over all batches of a table; None without rows. Tasks add up theirs, FEW tasks add up those."""

    def first(batches):
        yield from _one_row(of(batch) for batch in batches if batch.num_rows)

    def again(batches):
        yield from _one_row(_arrays(row) for batch in batches for row in batch.to_pylist())

    kind = "sums array<binary>, shapes array<array<bigint>>"
    got = table.mapInArrow(first, kind).repartition(FEW).mapInArrow(again, kind).collect()
    return [np.sum(p, axis=0) for p in zip(*[_arrays(r.asDict()) for r in got])] if got else None


def _batch_moments(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [part for v in _unpacked(batch) for part in _moments(v)]


def _batch_slopes(models: list[Linear], share: np.ndarray, batch: pa.RecordBatch) -> list[np.ndarray]:
    labels = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)])
    return [part for slope in _pseudo_slopes(models, share, _unpacked(batch), labels) for part in slope]


class Table:
    """The unlabelled pool as a table of features, and its pseudo-labels as tables."""

    def __init__(self, features: DataFrame):
        self.rows, self.pseudo = stage(features, "quality-pool"), None

    def moments(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        got = _sums(self.rows, _batch_moments) or [part for w in WIDTHS for part in (0, np.zeros(w), np.zeros(w))]
        return [(int(got[i]), got[i + 1], got[i + 2]) for i in (0, 3)]

    def surest(self, rules: list[Rule], models: list[Linear]) -> list[tuple[int, int, int, int]]:
        def run(batches):
            counts: dict[tuple[int, int, int], int] = {}
            for batch in batches:
                for i, label, step, n in _surest(rules, models, _unpacked(batch)):
                    counts[i, label, step] = counts.get((i, label, step), 0) + n
            columns = list(zip(*[(*k, n) for k, n in counts.items()])) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["view", "label", "step", "n"])

        counts = self.rows.mapInArrow(run, "view bigint, label bigint, step bigint, n bigint")
        return [tuple(r) for r in counts.groupBy("view", "label", "step").agg(F.sum("n").alias("n")).collect()]

    def label(self, rules: list[Rule]) -> None:
        """Write the rows that the last rule labels, with the labels it gives."""

        def run(batches):
            for batch in batches:
                x = _unpacked(batch)
                new = np.where(given(x, rules[:-1]) < 0, given(x, rules), -1).astype(np.int8)
                keep = pa.array((new >= 0).any(0))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(new[0]), pa.array(new[1])], names=["text", "meta", "for_text", "for_meta"]).filter(keep)

        new = stage(self.rows.mapInArrow(run, PSEUDO_DDL), "quality-pseudo-labels")
        self.pseudo = new if self.pseudo is None else self.pseudo.unionByName(new)

    def slopes(self, models: list[Linear], share: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        # every task sends sums of a megabyte, so there are not many
        got = _sums(self.pseudo.coalesce(SUMS), partial(_batch_slopes, models, share))
        return [(got[0], got[1]), (got[2], got[3])]


def _draw(column: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on the id."""
    return F.pmod(F.xxhash64(column, F.lit("quality sample")), F.lit(1 << 20)) / (1 << 20)


def _matrix(rows: list, name: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), np.float16).astype(np.float32).reshape(len(rows), width)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on a bounded sample of the documents with a label and on all without one."""
    known = labels.select("doc_id", F.col(label).cast("double").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    texts = docs.where(F.col("doc_id").isNotNull())
    n_known = known.count()
    views = _features(*map(F.col, ("text", "source", "lang", "n_chars"))).alias("v")
    some = known.where(_draw() < LABELLED / max(1, n_known))
    rows = texts.join(F.broadcast(some), "doc_id").select("doc_id", "y", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held"), views)
    got = sorted(rows.select("doc_id", "y", "held", "v.*").collect(), key=lambda r: (str(r["doc_id"]), r["y"], r["text"], r["meta"]))
    free = with_ids(docs.select("doc_id", views), known.select("doc_id").distinct(), "left_anti").select("v.*")
    return fit(tuple(_matrix(got, v, w) for v, w in zip(("text", "meta"), WIDTHS)), np.array([r["y"] for r in got], float),
               np.array([r["held"] for r in got], bool), lambda: Table(free))


SCORES = pa.struct([("text_score", pa.float64()), ("meta_score", pa.float64()), ("score", pa.float64()), ("keep", pa.bool_())])


def score(model: Model) -> Column:
    """Struct of the text score, the metadata score, the joint score and the decision, from text, source, lang and n_chars."""

    def rows(columns: tuple[pa.Array, ...]):
        for at in range(0, len(columns[0]), 256):
            part = [c[at:at + 256] for c in columns]
            x = np.stack([text_features(t) for t in strings(part[0])])
            m = np.stack([meta_features(*row) for row in zip(*(c.to_pylist() for c in part[1:]))])
            for a, b, c in model.scores(x, m):
                yield float(a), float(b), float(c), bool(c >= KEEP)

    @F.arrow_udf("text_score double, meta_score double, score double, keep boolean")
    def run(*columns: pa.Array) -> pa.Array:
        return structs(SCORES, rows(columns))

    return run(*map(F.col, ("text", "source", "lang", "n_chars")))
