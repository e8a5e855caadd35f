"""Spelling variant grouping by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Bigrams are
ordered by how few words hold them. A word's prefix is its three rarest bigrams, of which any two
that do not touch cannot both be destroyed by one change: the pivots are the two disjoint ones with the least postings, chosen by
dynamic programming. Of two near words, a pivot of the one with the lower last prefix bigram stays whole and is in the prefix of
the other. The change lies before or behind it, so the words agree from their beginning to the end of the pivot, or from
the pivot to their end, and in the first or the second half of the rest; that places it exactly. The join of pivots with prefixes
is on the agreeing stretches and the length, so pairs meet that are near or almost so, however many words share a rare bigram.
Every pair that meets is verified.

A word's form is its near word of most occurrences if it has at least twice as many; forms are followed to the root by doubling.

Defined results: null or empty text has no words. Rows that repeat count each. A null id is written as the empty text before the colon. Words
may be as long as a text; what a word adds to the index grows with its length only. Only id and text are read; an empty table gives no rows.

Joins are sorted merges, never broadcasts: Spark sizes a side by the compressed file it comes from, and a key by the word
it was made of, so a few MB of words look small enough to be sent whole while their keys fill the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import stage

LEAST_LENGTH, LEAST_COUNT, DROPPED = 5, 3, 97
#: Letters A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z became a-z.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Words a task counts before it hands them on.
HELD = 200_000
#: Bigrams of a prefix and pivots for one change.
PREFIX, PIVOTS = 3, 2

Batches = Iterator[pa.RecordBatch]


def noisy(run: bytes, seed: int) -> bytes:
    """The run, or if DROPPED divides its checksum, the run without one code point. ``seed`` is the checksum of what stands before it."""
    h = zlib.crc32(run, seed)
    if h % DROPPED:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def _counted(batches: Batches) -> Batches:
    """Words of at least LEAST_LENGTH code points and how often they stand in the task's rows so far."""

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode() for w in held], pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    held: Counter[bytes] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if not text.is_valid:
                continue
            seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(RUN.findall(text.as_py().lower())).items():
                word = noisy(run, seed)
                if len(word) - word.count(b"\xc3") >= LEAST_LENGTH:
                    held[word] += n
            if len(held) > HELD:
                yield flush()
                held.clear()
    yield flush()


def words(docs: DataFrame) -> DataFrame:
    """Distinct words with at least LEAST_COUNT occurrences: word, n."""
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_counted, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def bigrams(word: str) -> list[str]:
    return [word[i:i + 2] for i in range(len(word) - 1)]


def _postings(batches: Batches) -> Batches:
    held: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.update(set(bigrams(word)))
    yield pa.RecordBatch.from_pydict({"gram": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})


def prefix(word: str, postings: dict[str, int]) -> list[tuple[int, str, int]]:
    """The PREFIX rarest bigrams (postings, bigram, place) in order, and the last one's repeat just behind it."""
    grams = sorted((postings[g], g, i) for i, g in enumerate(bigrams(word)))
    kept = grams[:PREFIX]
    # between equal bigrams the place decides; one change can move a place by one
    return kept + [g for g in grams[PREFIX:PREFIX + 1] if kept and g[:2] == kept[-1][:2] and g[2] == kept[-1][2] + 1]


def pivots(grams: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """PIVOTS bigrams of the prefix that do not overlap, with the least postings together."""
    places = sorted(grams[:PREFIX], key=lambda g: g[2])
    # best[k]: least cost and choice of k disjoint bigrams among those up to each place
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * PIVOTS]
    for j, gram in enumerate(places):
        free = next((i for i in range(j, 0, -1) if places[i - 1][2] + 2 <= gram[2]), 0)
        row = list(best[j])
        for k in range(1, PIVOTS + 1):
            before = best[free][k - 1]
            if before is not None and (row[k] is None or before[0] + gram[0] < row[k][0]):
                row[k] = before[0] + gram[0], (*before[1], j)
        best.append(row)
    chosen = best[-1][PIVOTS]
    return [places[j] for j in chosen[1]] if chosen else []


def _keys(word: str, at: int, length: int) -> list[int]:
    """Keys of a word with a bigram at a place, for pairs of which the word indexed by its prefix has ``length`` code points.

    The words agree up to the bigram's end, or from its beginning on. In the rest, of which the word indexed by its prefix
    has m code points, one change leaves the first m // 2 or the last m - 1 - m // 2 as they are: each choice is a key.
    """
    keys = []
    m = length - at - 2  # behind the bigram, if the beginnings agree
    if m >= 0:
        first, last = at + 2 + m // 2, m - 1 - m // 2
        keys += [(b"<%d:%d:", m, word[:first]), (b"(%d:%d:", m, word[:at + 2] + "|" + word[len(word) - last:] if last > 0 else word[:at + 2])]
    m = at + length - len(word)  # before it, if the ends agree
    if m >= 0:
        first, last = m // 2, m - 1 - m // 2
        keys += [(b">%d:%d:", m, word[at - last if last > 0 else at:]), (b")%d:%d:", m, word[:first] + "|" + word[at:])]
    return [xxhash.xxh3_64_intdigest(kind % (length, rest) + text.encode()) - (1 << 63) for kind, rest, text in keys]


def _index(postings: dict[str, int], of_pivots: bool) -> Callable[[Batches], Batches]:
    """Keys of each word: of its pivots for words up to one longer or shorter, or of its prefix."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys, which = [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                grams = prefix(word, postings)
                lengths = (len(word) - 1, len(word), len(word) + 1) if of_pivots else (len(word),)
                own = {k for _, _, at in (pivots(grams) if of_pivots else grams) for n in lengths for k in _keys(word, at, n)}
                keys += own
                which += [i] * len(own)
            picked = batch.take(pa.array(which, pa.int32()))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "word": picked.column("word"), "n": picked.column("n")})

    return run


def near_pairs(counted: DataFrame) -> DataFrame:
    """Pairs of near words, each once: a, n_a, b, n_b with a < b. ``counted`` (word, n) is read three times."""
    grams = counted.select("word").mapInArrow(_postings, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    postings = {r["gram"]: r["n"] for r in grams.collect()}  # two letters of 90: at most 8,100
    one, two = (counted.select("word", "n").mapInArrow(_index(postings, p), "key long, word string, n long") for p in (True, False))
    x, y = one.select("key", F.col("word").alias("x"), F.col("n").alias("n_x")), two.select("key", F.col("word").alias("y"), F.col("n").alias("n_y"))
    met = x.join(y.hint("merge"), (x["key"] == y["key"]) & (F.col("x") != F.col("y")) & (F.levenshtein("x", "y", 1) == 1))
    low, high = (F.when(c, F.struct(F.col("x").alias("w"), F.col("n_x").alias("n"))).otherwise(F.struct(F.col("y").alias("w"), F.col("n_y").alias("n")))
                 for c in (F.col("x") < F.col("y"), F.col("x") > F.col("y")))
    return met.select(low.alias("l"), high.alias("h")).select(
        F.col("l.w").alias("a"), F.col("l.n").alias("n_a"), F.col("h.w").alias("b"), F.col("h.n").alias("n_b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): every word jumps over its form's form until no form is left. Counts double along a chain, so it is short."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stage(at.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    counted = stage(words(docs), "spelling-words")
    pairs = stage(near_pairs(counted), "spelling-pairs")

    def side(word: str, n: str, near: str, near_n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(n).alias("n"), F.struct((-F.col(near_n)).alias("n"), F.col(near).alias("word")).alias("near"))

    both = pairs.select(F.explode(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.max("n").alias("own"), F.min("near").alias("near"))
    has = -F.col("near.n") >= 2 * F.col("own")
    formed = stage(best.select("word", "n_near", F.when(has, F.col("near.word")).alias("form"), F.when(has, -F.col("near.n")).alias("form_n")), "spelling-forms")
    roots = _roots(stage(formed.where("form is not null").select("word", "form"), "spelling-links"))
    return counted.join(formed.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
