"""Vector codes, spelling variants and packing against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import edge, empty  # noqa: F401
from basketry.llm import packing, spellings, vector_codes
from basketry.llm.catalog import word_model

VECTORS = "vec_id long, embedding array<float>, label int"


# vector codes ---------------------------------------------------------------------------------------------------------

def plain_codes(rows, rounds=4, most=256):
    kept = sorted((i, [int(np.floor(1024 * float(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v))
    width = len(kept[0][1]) // 4
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(4)] for _, v, _ in kept]
    books = [[parts[p] for parts in cut[:most]] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for parts in cut:
                members[nearest(p, parts[p])[1]].append(parts[p])
            for e, xs in members.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[nearest(p, parts[p]) for p in range(4)] for parts in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    return [(i, "".join(f"{e:02x}" for _, e in f), error, by_label[label], digest) for (i, _, label), f, error in zip(kept, found, errors)]


@pytest.mark.parametrize("n", [40, 420])
def test_codes_equal_plain_lloyd(spark, n):
    draw = np.random.default_rng(n)
    centres = draw.normal(0, 0.3, (30, 8))
    rows = [(i * 3, (centres[draw.integers(30)] + draw.normal(0, 0.02, 8)).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(n)]
    rows += [(i + 1, rows[0][1], 5) for i in range(0, 3 * n, 9)]  # one vector in many rows
    rows += [(9001, None, 1), (9002, [1.0, None] + [0.0] * 6, 1), (9003, [float("nan")] * 8, 2), (9004, [float("inf")] + [0.0] * 7, 2)]
    random.Random(n).shuffle(rows)
    got = vector_codes.report(spark.createDataFrame([(*r, "x", 7) for r in rows], VECTORS + ", code string, row int")).collect()
    assert sorted(map(tuple, got)) == plain_codes(rows)


def test_codes_of_edge_rows(spark):
    rows = [(1, [0.5] * 8, 1), (1, [0.5] * 8, 1), (1, [0.25] * 8, None), (None, [1.0] * 8, None), (2, [1.0] * 6, 2), (3, [], 2), (4, [3e38] * 8, 3), (5, [-3e38] * 8, 3), (None, None, None)]
    got = vector_codes.report(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 8 and len({r["codebooks_sha256"] for r in got}) == 1
    assert [r["code"] for r in got if r["vec_id"] == 1].count("00000000") == 1  # equal parts: the lower entry; [0.25] comes first
    assert all(r["error"] == 0 for r in got if r["vec_id"] in (4, 5))
    nothing = vector_codes.report(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert nothing.collect() == [] and vector_codes.report(spark.createDataFrame([], VECTORS)).collect() == []


def test_only_parts_that_change_entry_are_shuffled(spark):
    rows = [(i, [float(np.float32(np.sin(i * k))) for k in range(8)], 1) for i in range(400)]
    parts = spark.createDataFrame([(i, i, 1, 0, [int(1024 * x) for x in v[:2]]) for i, v, _ in rows], "row long, vec_id long, label int, position int, part array<int>")
    books = vector_codes.Codebooks(np.array([[[int(1024 * x) for x in v[:2]] for _, v, _ in rows[:8]]]))
    members = vector_codes._Members(parts, 400)
    members.migrate(books)
    books = vector_codes._moved(members.resident, books)
    before = {r["row"]: r["entry"] for r in members.resident.collect()}
    members.migrate(books)
    after = {r["row"]: r["entry"] for r in members.resident.collect()}
    changed = sum(before[r] != after[r] for r in before)
    plan = members.resident._jdf.queryExecution().executedPlan().toString()
    assert len(after) == 400 and 0 < changed < 400 and "Exchange" not in plan  # both sides are written tables


# spelling variants ----------------------------------------------------------------------------------------------------

def plain_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_variants(words):
    out, form = [], {}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def near_words(seed, letters, n):
    draw, out = random.Random(seed), []
    for _ in range(n):
        w = "".join(draw.choice(letters) for _ in range(draw.randint(5, 8)))
        out.append(w)
        for _ in range(draw.randint(0, 4)):
            i = draw.randrange(len(w))
            w = draw.choice((w[:i] + w[i + 1:], w[:i] + draw.choice(letters) + w[i:], w[:i] + draw.choice(letters) + w[i + 1:]))
            out.append(w)
    return out


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghiÀÿ"])
def test_variants_equal_all_pairs(spark, letters):
    draw = random.Random(7)
    rows = [(i, " ".join(w for w in near_words(i % 5, letters, 40) for _ in range(draw.choice((1, 1, 2, 5, 20))))) for i in range(12)]
    rows += [(None, rows[0][1].upper()), (3, None), (4, ""), (4, rows[1][1])]
    got = spellings.variants(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")).collect()
    assert sorted(map(tuple, got)) == plain_variants(plain_words(rows))


def test_chains_of_forms_end_at_the_root(spark):
    words = ["abcdefgh"[:5] + "x" * k for k in range(1, 9)]
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2**k)))]
    got = {r["word"]: r["root"] for r in spellings.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {r[0]: r[2] for r in plain_variants(plain_words(rows))} and len(set(got.values())) == 1


def test_long_runs_and_edge_rows(spark, edge, empty):
    rows = [(i, " ".join(["a" * 30_000, "a" * 30_001, "x" + "ab" * 10_000, "ab" * 10_000])) for i in range(3)]
    got = spellings.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == plain_variants(plain_words(rows))
    want = plain_variants(plain_words([(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]))
    assert sorted(map(tuple, spellings.variants(edge).collect())) == want
    assert spellings.variants(empty).collect() == []


def test_no_join_of_words_is_broadcast(spark, monkeypatch):
    """A few MB of words have keys of hundreds: stored tables look small, so small ones show what a middling size gets."""
    plans, stage = [], spellings.stage

    def seen(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, purpose)

    monkeypatch.setattr(spellings, "stage", seen)
    rows = [(i, " ".join(near_words(i, "abc", 30) * 3)) for i in range(3)]
    out = spellings.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, out.collect())) == plain_variants(plain_words(rows))
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4 and not any("Broadcast" in p for p in plans)


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=5, max_size=9), st.integers(0, 8), st.sampled_from("abé"), st.integers(0, 2), st.integers(0, 5))
def test_near_words_share_a_pivot_key(word, at, letter, kind, seed):
    """Whatever the order of bigrams, one of two near words has a pivot in the other's prefix, beside the same stretch."""
    at = min(at, len(word) - 1)
    other = (word[:at] + letter + word[at:], word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:])[kind]
    if other == word or len(other) < 5:
        return
    draw = random.Random(seed)
    postings = {a + b: draw.randint(1, 4) for a, b in itertools.product("abé", repeat=2)}

    def keys(w, of_pivots):
        grams = spellings.prefix(w, postings)
        lengths = (len(w) - 1, len(w), len(w) + 1) if of_pivots else (len(w),)
        return {k for _, _, i in (spellings.pivots(grams) if of_pivots else grams) for n in lengths for k in spellings._keys(w, i, n)}

    assert keys(word, True) & keys(other, False) or keys(other, True) & keys(word, False)


# packing --------------------------------------------------------------------------------------------------------------

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_model())


def check_pieces(rows, got, capacity=4096):
    """Every id in one piece, pieces gapless in sequences of at most the capacity; returns padding."""
    own = library()
    ids = Counter()
    for i, text in rows:
        ids[i, np.array(own.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == {i for i, _ in ids}
    for i, found in by_doc.items():
        want = [b for (k, b), n in ids.items() for _ in range(n) if k == i]
        assert sum(n for _, n, _, _ in found) == sum(len(b) // 4 for b in want) and {t for *_, t in found} == {len(b) // 4 for b in want}
        for start, length, crc, tokens in found:
            assert any(len(b) == 4 * tokens and zlib.crc32(b[4 * start:4 * (start + length)]) == crc for b in want)
        if len(want) == 1:
            found.sort()
            assert [s for s, *_ in found] == [0, *itertools.accumulate(n for _, n, _, _ in found)][:-1]
    padding = 0
    for found in by_sequence.values():
        found.sort()
        ends = [0, *itertools.accumulate(n for _, n in found)]
        assert [o for o, _ in found] == ends[:-1] and 0 < ends[-1] <= capacity and min(n for _, n in found) > 0
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else capacity - ends[-1]
    return padding


def test_every_id_is_packed_once_without_padding(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(f"word{draw.randrange(500)} B,c'LL é" for _ in range(int(draw.paretovariate(0.8))))[:60_000]) for i in range(500)]
    rows += [(1000 + i, "the same text of some words " * 20) for i in range(300)] + [(2000, None), (2001, ""), (2002, " \n\t "), (None, "no id"), (None, None), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, row string, part int").repartition(7)
    assert check_pieces(rows, packing.pieces(df, word_model()).collect()) == 0


def test_packing_of_edge_rows(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    assert check_pieces(rows, packing.pieces(edge, word_model()).collect()) == 0
    assert packing.pieces(empty, word_model()).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_best(seed):
    """Never more items than there are; against the best number of full sequences of small histograms, by search."""
    draw = random.Random(seed)
    demand = {s: draw.randint(1, 6) for s in draw.sample(range(1, 9), 4)}
    uses = packing.plan(demand, 8)
    used = Counter()
    for pattern, n in uses:
        assert sum(s * a for s, a in pattern) == 8 and n > 0
        used.update({s: a * n for s, a in pattern})
    assert all(used[s] <= demand[s] for s in used)
    bound = sum(v for _, v in packing.fractional(np.array(sorted(demand)), np.array([demand[s] for s in sorted(demand)]), 8))

    def best(left, size=8, room=8):
        """Most full sequences, items chosen from the longest down."""
        if room == 0:
            return 1 + best(left)
        sizes = [s for s, n in left.items() if n and s <= min(size, room)]
        return max((best({**left, s: left[s] - 1}, s, room - s) for s in sizes), default=0)

    small = {s: min(n, 2) for s, n in demand.items()}
    assert best(small) <= sum(v for _, v in packing.fractional(np.array(sorted(small)), np.array([small[s] for s in sorted(small)]), 8)) + 1e-6
    assert bound - 4 <= sum(n for _, n in uses) <= bound + 1e-6


def test_most_documents_stay_whole(spark):
    draw = random.Random(5)
    rows = [(i, "a " * draw.randint(20, 3000)) for i in range(4000)]
    got = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"), word_model())
    cut = got.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").count()
    assert cut < 0.6 * len(rows) and check_pieces(rows, got.collect()) == 0


BITS = st.sampled_from([" ", "\n", "\t", "\r", "\x1c", "\x85", " ", " ", "a", "The", "é", "é", "̈", "İ", "Σ", "漢", "😀", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "12", "...", "\0", "ﬁ", "×", "ª", "²", "¼", "\xad", "À", "ß", "\xa0"])


@settings(max_examples=1000, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text([chr(c) for c in range(256)], max_size=40), st.lists(BITS, max_size=12).map("".join)).filter(lambda t: t.encode(errors="ignore").decode() == t))
def test_chunk_ids_equal_the_library(text):
    want = np.array(library_once().encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert list(packing.chunks_of(word_model()).encode(["x", text, text]))[1:] == [want, want]


_LIBRARY = []


def library_once():
    if not _LIBRARY:
        _LIBRARY.append(library())
    return _LIBRARY[0]
