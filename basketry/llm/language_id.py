"""Language identification by error-correcting output codes.

Every language gets a codeword of bits; a binary classifier over hashed byte
n-grams predicts each bit. Decoding weighs each bit's logistic loss and takes the
codeword with the least sum; the answer is ambiguous when the runner-up is close.

Learning reads at most about ``per_language`` labelled texts of each language
(drawn by a hash of the id, whole texts); every text is then scored whole.

Defined results: null text or text without a letter is ``und`` with score 0 and
not ambiguous. With no labelled text at all every text is ``und``; with one
language only, every text with a letter is that language. Rows with a null id are
not learnt from and not held out. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import strings, structs

UNKNOWN = "und"
#: Hash buckets of n-grams, texts learnt from per language, rounds of gradient descent.
BUCKETS, PER_LANGUAGE, ROUNDS = 1 << 12, 400, 150
#: Texts whose best language has a lower share of the decoding weight are flagged.
AMBIGUOUS = 0.6
LETTER = re.compile(r"[^\W\d_]")
_LOWER = bytes(range(256)).lower()


def ngrams(text: str) -> np.ndarray:
    """Share of each bucket among the hashed byte bigrams and trigrams of the whole text."""
    data = np.frombuffer(text.encode().translate(_LOWER), np.uint8).astype(np.uint32)
    if len(data) < 2:
        return np.zeros(BUCKETS, np.float32)
    two = data[:-1] * np.uint32(0x9E3779B1) + data[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(31) + data[2:] * np.uint32(0xC2B2AE3D)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    counts = np.bincount((two * np.uint32(0x27D4EB2F)) >> shift, minlength=BUCKETS)
    counts += np.bincount((three * np.uint32(0x165667B1)) >> shift, minlength=BUCKETS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A matrix of +1 and -1 with one row a language, rows far apart and columns that split the languages differently.

    Up to 7 languages take the exhaustive code (every split once); more take the best of some random codes.
    """
    if n <= 7:
        bits = [[1] * n if c == 0 else [1 if c >> (n - 1 - r) & 1 == 0 else -1 for r in range(n)] for c in range(1 << (n - 1))]
        return np.array(bits[1:] or [[1] * n], np.float32).T.reshape(n, -1)
    draw, best, distance = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], np.float32), (n, int(15 * np.log2(n))))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if apart > distance:
            best, distance = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of the weight exp(-loss), and the runner-up's share."""
        margins = features @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None]).sum(2)
        weight = np.exp(loss.min(1, keepdims=True) - loss)
        share = weight / weight.sum(1, keepdims=True)
        best = share.argmax(1)
        top = share[np.arange(len(share)), best]
        rest = share.copy()
        rest[np.arange(len(share)), best] = 0
        return best, top, rest.max(1)


def fit(texts: list[str], languages: list[str]) -> Model:
    """Binary logistic classifiers, one a bit, by gradient descent with momentum on all given texts."""
    names = sorted(set(languages))
    codes = codewords(len(names)) if names else np.zeros((0, 1), np.float32)
    weights, bias = np.zeros((BUCKETS, codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    if len(names) < 2:
        return Model(names, codes, weights, bias)
    x = np.stack([ngrams(t) for t in texts])
    at = np.array([names.index(v) for v in languages])
    y = codes[at]
    share = ((1 / np.bincount(at))[at][:, None] / len(names)).astype(np.float32)  # each language weighs the same
    step_w, step_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(ROUNDS):
        slope = -y * share / (1 + np.exp(y * (x @ weights + bias)))
        step_w = np.float32(0.9) * step_w - np.float32(40) * (x.T @ slope + np.float32(1e-5) * weights)
        step_b = np.float32(0.9) * step_b - np.float32(4) * slope.sum(0)
        weights, bias = weights + step_w, bias + step_b
    return Model(names, codes, weights, bias)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, label: str = "lang") -> Model:
    """Fit on about ``per_language`` texts of each language among the rows that may be learnt from.

    The driver holds the sampled texts only: languages times per_language.
    """
    usable = docs.select("doc_id", "text", F.col(label).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit([], [])
    draw = (F.xxhash64("doc_id", F.lit("language sample")) % 1_000_000 + 1_000_000) % 1_000_000
    limit = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1_000_000, -(-per_language * 1_000_000 // n)))])
    rows = usable.where(draw < limit[F.col("lang")]).select("text", "lang", "doc_id").collect()
    rows.sort(key=lambda r: (r["lang"], str(r["doc_id"]), r["text"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


REPORT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def predict(text: Column, model: Model) -> Column:
    """Struct of the language, its score and whether the runner-up is close."""

    def rows(texts: list[str]):
        for at in range(0, len(texts), 128):
            part = texts[at:at + 128]
            best, top, _ = model.decode(np.stack([ngrams(t) for t in part]))
            for t, b, s in zip(part, best, top):
                yield (model.languages[b], float(s), bool(s < AMBIGUOUS)) if LETTER.search(t) else (UNKNOWN, 0.0, False)

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def run(column: pa.Array) -> pa.Array:
        texts = strings(column)
        if len(model.languages) < 2:
            only = model.languages[0] if model.languages else UNKNOWN
            return structs(REPORT, [(only, 1.0, False) if LETTER.search(t) and model.languages else (UNKNOWN, 0.0, False) for t in texts])
        return structs(REPORT, rows(texts))

    return run(text)
