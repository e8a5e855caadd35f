"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask lays over consecutive words and ignores some of them; the hash of the
rest is a seed. Seeds of the benchmark items are joined with the seeds at every
word of every document. Around a hit, item and document are laid side by side and
their words compared one to one: an overlap holds when any WINDOW words of the item (all of
a shorter item) that contain the hit agree in at least 80 %.

No overlap is missed. A window of B blocks of words with at most K words changed keeps B - K
blocks whole, so the masks that keep B - K of B blocks, tried at every word, hit it wherever the
changes are. Items of different lengths allow different K and have masks of their own.

A document costs one pass over its positions. At every position the first words that a mask keeps (its anchor: a block, or two single words) are hashed
once for all masks that begin so, and looked up among the anchors of the items; masks are laid only where one is found. Such places are few, and only they
carry words along: hashes of the words around them, by which the windows are compared, so no text is fetched again and no row grows with its document.

The seeds of the items are sent to the executors only below SEEDS_AT_ONCE, else places are found by
a shuffle of positions and hashes, and the documents that have some are read again.

Defined results: null or empty texts have no seeds. Items of fewer words than
the shortest mask (6) are no evidence and match nothing. A document that
repeats an item, or rows that share an id, give one row per document and item.
Rows without an id are reported under a null id. Items are told apart by id and text: those that share an id are
compared each and reported under it together, those without one under a null id. Columns other than id and text are not read.
"""

from __future__ import annotations

import functools
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import whole_text
from basketry.session import stage

WINDOW, LEAST = 24, 0.8


def covering(blocks: int, size: int, changed: int) -> tuple[str, ...]:
    """Masks that keep all but ``changed`` of so many blocks of words, each once wherever it lies, the longest first."""
    kept = {tuple(i - chosen[0] for i in chosen) for chosen in combinations(range(blocks), blocks - changed)}
    masks = ["".join("10"[i not in chosen] * size for i in range(chosen[-1] + 1)) for chosen in kept]
    return tuple(sorted(masks, key=lambda m: (-len(m), m)))


#: Least words of an item: its blocks, their words, and how many may be changed. Of 6 words one may be changed, of 10 two, of 15 three, of 20 and of a window of 24 four.
SHAPES = {6: (6, 1, 1), 10: (5, 2, 2), 15: (5, 3, 3), 20: (6, 3, 4), WINDOW: (6, 4, 4)}
MASKS = {least: covering(*shape) for least, shape in SHAPES.items()}
SHORTEST = min(MASKS)
#: Most seeds, and words of items, that are sent to every executor.
SEEDS_AT_ONCE = 500_000


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def anchor(mask: str, size: int) -> str:
    """The words a mask begins with that are looked up first: its first block, or its first two words if blocks are single words."""
    return mask[:size] if size > 1 else mask[:mask.index("1", 1) + 1]


def _seed(row: Column, at: Column, mask: str) -> Column:
    """Hash of the words, given by their hashes, that a mask keeps when it is laid at a position."""
    return F.xxhash64(F.lit(int(mask, 2)), *[F.get(row, at + F.lit(i)) for i, c in enumerate(mask) if c == "1"])


def _hashes(row: Column) -> Column:
    return F.transform(row, lambda x: F.xxhash64(x))


def _trimmed(row: Column) -> Column:
    """Words without the empty ones that separators at either end leave."""
    return F.filter(row, lambda w: w != "")


def _laid(items: DataFrame, masks: list[str], names: list[Column]) -> DataFrame:
    """Items (number, item: word hashes) with every mask at every position where it fits: adds at, span, seed and the given columns of the mask."""
    rows = None
    for mask, name in zip(masks, names):
        fits = F.when(F.size("item") >= len(mask), F.sequence(F.lit(0), F.size("item") - F.lit(len(mask))))
        placed = items.select("number", "item", F.explode(fits).alias("at"))
        part = placed.select("number", "at", F.lit(len(mask)).alias("span"), _seed(F.col("item"), F.col("at"), mask).alias("seed"), name)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _agreeing(first: Column, last: Column, length: Column) -> Column:
    """Largest share of the item's words [start, start + length) that equal the document's beside them, first <= start <= last."""
    places = F.sequence(first, last + length - 1)
    beside = lambda j: F.get(F.col("near"), j - F.col("item_at") + F.col("lead"))
    same = F.transform(places, lambda j: F.coalesce(beside(j) == F.get(F.col("item"), j), F.lit(False)))
    counts = lambda agree: F.transform(
        F.sequence(F.lit(0), last - first), lambda k: F.size(F.filter(F.slice(agree, k + 1, length), lambda x: x)))
    return F.array_max(F.get(F.transform(F.array(same), counts), F.lit(0))) / length


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item with an overlap: doc_id, item_id, overlap, first_word, n_hits.

    ``overlap`` is the best share of agreeing words, ``first_word`` the least position in the document where the item's
    first word would lie (below 0 if the document begins inside the item), ``n_hits`` the number of confirmed hits.
    """
    texts = docs.select("doc_id", words(whole_text()).alias("w"))
    items = items.select("item_id", _trimmed(words(whole_text())).alias("w")).where(F.size("w") >= SHORTEST).distinct()
    items = stage(items.select(F.monotonically_increasing_id().alias("number"), "item_id", _hashes(F.col("w")).alias("item")), "benchmark-items")
    ends = [*list(MASKS)[1:], None]
    parts, n, used = [], 0, {}
    for (least, masks), end in zip(MASKS.items(), ends):
        part = items.where((F.size("item") >= least) & (F.size("item") < end if end else F.lit(True)))
        size = part.agg(F.count("*").alias("n"), F.sum(F.size("item")).alias("words")).first()
        if size["n"]:
            n += size["words"] * len(masks)
            used |= {m: anchor(m, SHAPES[least][1]) for m in masks}
            parts.append(_laid(part, list(masks), [F.lit(anchor(m, SHAPES[least][1])).alias("anchor") for m in masks]))
    if not parts:
        return docs.select("doc_id").where(F.lit(False)).select(
            "doc_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("overlap"), F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("n_hits"))
    small = n <= SEEDS_AT_ONCE
    marks = stage(functools.reduce(DataFrame.unionByName, parts).distinct(), "benchmark-seeds")
    rated = _confirmed(_places(texts, items, sorted(set(used.values())), small), items, marks, used, small)
    return rated.join(F.broadcast(items.select("number", "item_id")) if small else items.select("number", "item_id"), "number").groupBy("doc_id", "item_id").agg(
        F.max("overlap").alias("overlap"), F.min("starts").cast("long").alias("first_word"), F.count("*").alias("n_hits"))


def _anchored(rows: DataFrame, carried: list[str], anchors: list[str]) -> DataFrame:
    """Rows with (hashes) at every position with every anchor that fits there: the carried columns, at, anchor and its hash."""
    least = min(map(len, anchors))
    places = F.when(F.size("hashes") >= least, F.sequence(F.lit(0), F.size("hashes") - F.lit(least)))
    placed = rows.select(*carried, "hashes", F.explode(places).alias("at"))
    found = [F.struct(F.lit(a).alias("anchor"), _seed(F.col("hashes"), F.col("at"), a).alias("hash")) for a in anchors]
    return placed.select("*", F.inline(F.array(*found)))


def _places(texts: DataFrame, items: DataFrame, anchors: list[str], small: bool) -> DataFrame:
    """Positions of documents where an anchor of an item stands: doc_id, at, length, anchor, near (word hashes around), lead (how many of them come before)."""
    known = _laid(items, anchors, [F.lit(a).alias("anchor") for a in anchors]).select(F.col("seed").alias("hash")).distinct()
    lead = F.least("at", F.lit(WINDOW))
    near = F.slice("hashes", F.col("at") - lead + 1, 3 * WINDOW)
    shown = ["doc_id", "at", F.size("hashes").alias("length"), "anchor", near.alias("near"), lead.alias("lead")]
    if small:
        rows = _anchored(texts.select("doc_id", _hashes(F.col("w")).alias("hashes")), ["doc_id"], anchors)
        return rows.join(F.broadcast(known), "hash", "left_semi").select(*shown)
    stored = stage(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", _hashes(F.col("w")).alias("hashes")), "document-words")
    at = _anchored(stored.select("row", "hashes"), ["row"], anchors).select("row", "at", "anchor", "hash").join(known, "hash", "left_semi")
    return stored.join(stage(at.drop("hash"), "anchored-places"), "row").select(*shown)


def _confirmed(places: DataFrame, items: DataFrame, marks: DataFrame, used: dict[str, str], small: bool) -> DataFrame:
    """Hits whose overlap holds: doc_id, number, overlap, starts."""
    send = F.broadcast if small else (lambda df: df)
    laid = [F.when((F.col("anchor") == a) & (F.col("at") + len(m) <= F.col("length")), _seed(F.col("near"), F.col("lead"), m)) for m, a in used.items()]
    seeds = places.select("doc_id", "at", "near", "lead", F.explode(F.array(*laid)).alias("seed")).where("seed is not null")
    hits = seeds.join(send(marks.select("seed", "number", "span", F.col("at").alias("item_at"))), "seed").join(send(items.select("number", "item")), "number")
    length = F.least(F.size("item"), F.lit(WINDOW))
    last = F.size("item") - length
    # the hit lies in the window; a mask that keeps blocks at the end of a window is found there too
    first, end = F.greatest(F.col("item_at") + F.col("span") - length, F.lit(0)), F.least(F.col("item_at"), last)
    rated = hits.select("doc_id", "number", (F.col("at") - F.col("item_at")).alias("starts"), _agreeing(first, end, length).alias("overlap"))
    return rated.where(F.col("overlap") >= LEAST)
