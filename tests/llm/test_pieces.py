"""Piece codec against the library."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import plain
from fixtures import docs_of  # noqa: F401
from basketry.llm import pieces
from basketry.llm.catalog import piece_model


@pytest.fixture(scope="module")
def own():
    return pieces.Codec(piece_model())


BITS = st.sampled_from([" ", "  ", "▁", "\n", "\t", "\0", "a", "the", "é", "ß", "漢", "😀", "<s>", "ing", ".", "<0x41>", " "])


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(BITS, max_size=12).map("".join)).filter(lambda t: t.isprintable() or t.encode(errors="ignore").decode() == t))
def test_ids_and_text_equal_the_library(own, text):
    want = own.model.encode(text)
    [joined] = own.encode([text])
    assert joined == ",".join(map(str, want))
    assert own.decode(joined).decode() == own.model.decode(want)


def test_the_chunk_path_is_the_one_in_use(own):
    assert own.by_chunk


def test_a_full_table_starts_anew(own, monkeypatch):
    texts = [f"some words {i} and more" for i in range(50)]
    want = list(own.encode(texts))
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "GROUP", 5)
    assert list(pieces.Codec(piece_model()).encode(texts)) == want


def test_a_worker_keeps_a_small_table():
    codec = pieces.Codec(piece_model())
    for first in range(0, 100_000, 1_000):
        list(codec.encode([" ".join(f"w{i}" for i in range(first, first + 1_000))]))
    assert len(codec.table) < 50_000


def test_a_vocabulary_without_the_condition_goes_text_by_text(own):
    other = pieces.Codec(piece_model())
    other.by_chunk = False
    assert list(other.encode(["a b", "", "x"])) == list(own.encode(["a b", "", "x"]))
    assert other.decode("264,287") == own.decode("264,287")


def test_columns(spark, docs_of, own):
    texts = [None, "", "hello wörld", " lead", "x" * 5000, "▁▁ a"]
    rows = docs_of(list(enumerate(texts))).select(
        "doc_id", pieces.encode(F.col("text"), piece_model()).alias("ids"), pieces.digest(F.col("text"), piece_model()).alias("d"))
    back = rows.withColumn("back", pieces.decode(F.col("ids"), piece_model())).orderBy("doc_id").collect()
    for r, text in zip(back, texts):
        want = own.model.encode(text or "")
        assert r["ids"] == want and r["back"] == own.model.decode(want)
        assert tuple(r["d"]) == (len(want), plain.sha(",".join(map(str, want))), plain.sha(own.model.decode(want)))
