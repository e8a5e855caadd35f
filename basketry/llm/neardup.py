"""Near-duplicate groups from MinHash signatures: bands, exact Jaccard, components.

Documents with equal shingle sets are one node from the start. Nodes whose band
hashes agree meet in buckets. No large bucket is expanded into all its pairs: its members
are compared with one of them, and only pairs that can still be linked after that, and are not in one
component by then, are compared (see ``_resolve``); none that can is left out. A link holds when
the whole shingle sets meet the threshold.

Defined results: null or empty text has no shingles, is linked with nothing and is
kept. Rows that share id and text are one document. A row without an id joins the
group of its text; if all rows of the group lack ids the component is null and
they are kept. An empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import ranges, strings, whole_text, with_ids
from basketry.llm.components import connected
from basketry.llm.tokens import SPACES, U64, byte_table, distinct, mix, shingles, sums, word_hashes
from basketry.session import stage

#: (distinct shingle hashes, offsets, coordinates) to a uint32 matrix of one row a text.
Signer = Callable[[np.ndarray, np.ndarray, int], np.ndarray]
#: Chance that a pair right at the threshold shares no band.
MISS = 1e-8
#: Pairs whose estimated similarity is this far below the threshold are not compared: over six standard errors.
SLACK = 0.2
#: Buckets of at most so many members compare them all; four times as many on every further level.
SMALL = 24
#: Percent of a centre's members that another centre must meet too for the two to be one.
MERGED = 90
#: Members around a centre that show which shingles are frequent there, and how many such shingles are listed at most.
TRIED, HOT = 64, 1_000


@dataclass(frozen=True)
class Likeness:
    """What makes two texts near-duplicates: words, shingle length and the least similarity in percent."""

    shingle: int = 5
    percent: int = 80
    separators: bytes = SPACES

    @property
    def shape(self) -> tuple[int, int]:
        """Rows a band and bands: the longest bands that miss with chance MISS and need at most 200 coordinates."""
        def bands(rows: int) -> int:
            return math.ceil(math.log(MISS) / math.log1p(-((self.percent / 100) ** rows)))

        rows = max((r for r in range(1, 9) if r * bands(r) <= 200), default=1)
        return rows, bands(rows)

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        words, offsets = word_hashes([t.encode() for t in texts], byte_table(self.separators))
        return distinct(*shingles(words, offsets, self.shingle))


FEATURES = pa.struct([
    ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])


def band_hashes(coords: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit hash a text and band; the band's number is part of it."""
    out = np.empty((len(coords), bands), U64)
    for b in range(bands):
        h = np.full(len(coords), b + 1, U64)
        for r in range(rows):
            h = mix(h * U64(0x9E3779B97F4A7C15) + coords[:, b * rows + r].astype(U64))
        out[:, b] = h
    return out.view(np.int64)


def features(text: Column, like: Likeness, signer: Signer) -> Column:
    """Struct of set size, 128-bit set key, band hashes and the low byte of each coordinate."""
    rows, bands = like.shape

    @F.arrow_udf("n long, k1 long, k2 long, bands array<long>, sig binary")
    def run(column: pa.Array) -> pa.Array:
        parts = [_features(like, signer, rows, bands, strings(column[a:b])) for a, b in ranges(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], FEATURES)

    return run(text)


def _features(like: Likeness, signer: Signer, rows: int, bands: int, texts: list[str]) -> pa.StructArray:
    values, offsets = like.sets(texts)
    sizes = np.diff(offsets)
    coords = signer(values, offsets, rows * bands)
    full = sizes > 0
    ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
    low = (coords & np.uint32(255)).astype(np.uint8)
    return pa.StructArray.from_arrays([
        pa.array(sizes, pa.int64()),
        pa.array(sums(mix(values), offsets).view(np.int64)),
        pa.array(sums(mix(values ^ U64(0x5851F42D4C957F2D)), offsets).view(np.int64)),
        pa.ListArray.from_arrays(ends, pa.array(band_hashes(coords, rows, bands)[full].ravel())),
        pa.array([s.tobytes() if f else None for s, f in zip(low, full)], pa.binary()),
    ], fields=list(FEATURES))


def _agreement(a: Column, b: Column) -> Column:
    """Share of equal bytes of two signatures, computed once: a filter on it is not moved below, where it would be
    computed again by a second Python worker a task."""

    @F.arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = zip(x.to_pylist(), y.to_pylist())
        return pa.array([float((np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).mean()) for p, q in pairs], pa.float64())

    return run.asNondeterministic()(a, b)


PROFILE_DDL = "linked boolean, m long, n long, common long, own array<long>"


def _profile(a: Column, b: Column, like: Likeness) -> Column:
    """Of texts a and b: whether they are linked, the sizes of their sets and of what they share, and what b alone has."""

    @F.arrow_udf(PROFILE_DDL)
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        linked, others, sizes, common, own = [], [], [], [], []
        for lo, hi in ranges(x, y):
            (u, p), (v, q) = like.sets(strings(x[lo:hi])), like.sets(strings(y[lo:hi]))
            for i in range(hi - lo):
                one, two = u[p[i]:p[i + 1]], v[q[i]:q[i + 1]]
                alone = two[~np.isin(two, one, assume_unique=True)]
                both = len(two) - len(alone)
                linked.append(100 * both >= like.percent * (len(one) + len(two) - both))
                others.append(len(one))
                sizes.append(len(two))
                common.append(both)
                own.append(alone.view(np.int64))
        ends = np.concatenate([[0], np.cumsum([len(o) for o in own])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *own])
        return pa.StructArray.from_arrays(
            [pa.array(linked, pa.bool_()), *[pa.array(c, pa.int64()) for c in (others, sizes, common)], pa.ListArray.from_arrays(ends, pa.array(flat))],
            names=["linked", "m", "n", "common", "own"])

    return run(a, b)


def _met(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids with their texts."""
    ids = stage(pairs.select("a").unionAll(pairs.select("b")).withColumnRenamed("a", "doc_id").distinct(), "pair-ids")
    texts = with_ids(docs.select("doc_id", whole_text().alias("text")), ids, "left_semi")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b")


class _Links:
    """Links found so far and the components they make."""

    def __init__(self, docs: DataFrame, like: Likeness) -> None:
        self.docs, self.like = docs, like
        self.labels: DataFrame | None = None

    def of(self, rows: DataFrame, node: str, to: str) -> DataFrame:
        """Rows with the component of a node column."""
        if self.labels is None:
            return rows.withColumn(to, F.col(node))
        labels = self.labels.select(F.col("node").alias(node), F.col("component").alias("_c"))
        return rows.join(labels, node, "left").withColumn(to, F.coalesce("_c", node)).drop("_c")

    def profiles(self, pairs: DataFrame) -> DataFrame:
        """a, b and the profile of b's text beside a's, for pairs of ids; a written table."""
        met = _met(pairs, self.docs).select("a", "b", _profile(F.col("text_a"), F.col("text_b"), self.like).alias("p"))
        return stage(met.select("a", "b", "p.*"), "profiles")

    def compare(self, pairs: DataFrame) -> None:
        """Compare the pairs and join the components of those that hold."""
        met = _met(pairs, self.docs)
        self.add(met.where(_profile(F.col("text_a"), F.col("text_b"), self.like)["linked"]))

    def add(self, pairs: DataFrame) -> None:
        """Join the components of linked pairs (a, b)."""
        found = stage(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        if self.labels is not None:
            found = found.unionByName(self.labels.select(F.col("node").alias("u"), F.col("component").alias("v")))
        self.labels = connected(found)

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components."""
        return self.of(self.of(pairs, "a", "_x"), "b", "_y").where("_x <> _y").drop("_x", "_y")


def _check(nodes: DataFrame, pairs: DataFrame, links: _Links) -> None:
    """Compare distinct pairs (a, b) of nodes whose sizes and signatures allow a link: first each b with its likeliest a."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    percent = links.like.percent
    near = (pairs.join(one, "a").join(two, "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            .select("a", "b", _agreement(F.col("sig_a"), F.col("sig_b")).alias("est"))
            .where(F.col("est") >= percent / 100 - SLACK))
    near = stage(near, "candidates")
    if near.isEmpty():
        return
    links.compare(near.groupBy("b").agg(F.max(F.struct("est", "a")).alias("p")).select("p.a", "b"))
    rest = stage(links.apart(near.select("a", "b")), "rest")
    if not rest.isEmpty():
        links.compare(rest)


def _open(members: DataFrame, links: _Links) -> DataFrame:
    """Members (bucket, node) of buckets that hold several components: adds comp and size; a written table."""
    rows = links.of(members, "node", "comp")
    ends = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_ = stage(ends.where("lo <> hi").select("bucket", "size"), "open")
    return stage(rows.join(open_, "bucket"), "members")


def _resolve(nodes: DataFrame, members: DataFrame, links: _Links) -> None:
    """Find all links between members (bucket, node) of a bucket.

    Small buckets compare all their members. A large one compares them with its centre c, the member that meets the most
    others. Two members x and y without a common shingle outside of c share at most min(|x & c|, |y & c|) shingles, which
    with the sizes bounds their similarity: pairs that the bound allows are compared, by groups of equal profile (size,
    shared with c). Members with a common shingle outside of c make new buckets, by the first of these (``_own_buckets``).
    So what many texts share, a passage or the text most are copies of, is the centre's and never brings them together
    again. From level to level larger buckets count as small, so the levels end.
    """
    most, percent = SMALL, links.like.percent
    while True:
        members = _open(members, links)
        if members.isEmpty():
            return
        small = members.where(F.col("size") <= most)
        one = small.select("bucket", F.col("node").alias("a"), F.col("comp").alias("_x"))
        two = small.select("bucket", F.col("node").alias("b"), F.col("comp").alias("_y"))
        _check(nodes, one.join(two, "bucket").where("a < b AND _x <> _y").select("a", "b").distinct(), links)

        large = members.where(F.col("size") > most).select("bucket", "node", "size")
        most *= 4
        if large.isEmpty():
            return
        degree = stage(large.groupBy("node").agg(F.sum("size").alias("degree")), "degrees")
        top = F.max(F.struct("degree", (-F.col("node")).alias("last")))
        centre = large.join(degree, "node").groupBy("bucket").agg(top.alias("top")).select("bucket", (-F.col("top.last")).alias("a"))
        met = stage(large.select("bucket", "node").join(stage(centre, "centres"), "bucket").join(degree.withColumnRenamed("node", "a"), "a"), "around")
        around = _merged(met).where("node <> a").select("a", F.col("node").alias("b"))
        profiles = links.profiles(stage(around.distinct(), "around-pairs"))
        links.add(profiles.where("linked"))

        rows = links.of(profiles, "b", "comp")
        apart = rows.groupBy("a").agg(F.count("*").alias("around"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        rows = stage(rows.join(stage(apart.select("a", "around"), "centres-apart"), "a").select("a", "b", "n", "common", "own", "comp", "around"), "profile-rows")
        # a set that has less than its share at the threshold inside of c fits no other without a shingle outside of c
        _check(nodes, _allowed(rows.where(F.col("common") * 100 >= F.col("n") * percent), percent), links)
        members = _own_buckets(rows, percent)


def _merged(met: DataFrame) -> DataFrame:
    """Members (a, node) by centre; buckets of a centre whose members nearly all meet one other centre too are that one's.

    ``met`` has bucket, a, node and the degree of a. A bucket goes to another centre as a whole, so members that met still meet.
    """
    best = met.groupBy("node").agg(F.max(F.struct("degree", "a")).alias("best")).select("node", F.col("best.a").alias("best"))
    pairs = stage(met.select("a", "node").distinct(), "members-around")
    counts = pairs.join(stage(best, "best-centres"), "node").groupBy("a", "best").agg(F.count("*").alias("n"))
    most = counts.groupBy("a").agg(F.max(F.struct("n", "best")).alias("most"), F.sum("n").alias("n"))
    to = most.select("a", F.when(F.col("most.n") * 100 >= F.col("n") * MERGED, F.col("most.best")).otherwise(F.col("a")).alias("to"))
    return pairs.join(stage(to, "merged-centres"), "a").select(F.col("to").alias("a"), "node")


def _own_buckets(rows: DataFrame, percent: int) -> DataFrame:
    """Members by the first shingles they have outside of their centre.

    In any one order of all shingles two sets at similarity t have their first common shingle among the first
    n - ceil(t n) + 1 of each. The order here puts shingles outside of the centre first, and among these the ones that
    many members around it have last: those seen twice among about TRIED of them, at most HOT. So only the first ones are
    expanded; what is seen decides where members meet, not which links are found.
    """
    tried = rows.where(F.pmod(F.xxhash64("b"), F.col("around")) < TRIED)
    seen = tried.select("a", F.explode("own").alias("shingle")).groupBy("a", "shingle").agg(F.count("*").alias("times")).where("times > 1")
    place = Window.partitionBy("a").orderBy(F.desc("times"), "shingle")
    top = seen.withColumn("place", F.row_number().over(place)).where(F.col("place") <= HOT)
    hot = top.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).getField("shingle").alias("hot"))
    known = rows.join(stage(hot, "hot-shingles"), "a", "left").withColumn("hot", F.coalesce("hot", F.array().cast("array<bigint>")))
    ordered = F.concat(F.array_except("own", "hot"), F.array_intersect("hot", "own"))
    first = F.slice(ordered, 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    return known.select("a", "b", F.explode(first).alias("shingle")).select(F.xxhash64("a", "shingle").alias("bucket"), F.col("b").alias("node")).distinct()


def _allowed(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs around one centre, of different components, that the bound allows to be linked."""
    groups_ = stage(rows.groupBy("a", "n", "common").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "profile-groups")
    one, two = (groups_.select("a", *[F.col(c).alias(f"{c}_{i}") for c in ("n", "common", "lo", "hi")]) for i in (1, 2))
    least = F.least("common_1", "common_2")
    # each pair of groups once, the smaller profile first; groups that are in one and the same component need nothing
    once = (F.col("n_1") < F.col("n_2")) | ((F.col("n_1") == F.col("n_2")) & (F.col("common_1") <= F.col("common_2")))
    apart = (F.least("lo_1", "lo_2") != F.greatest("hi_1", "hi_2"))
    fits = (100 + percent) * least >= percent * (F.col("n_1") + F.col("n_2"))
    pairs = stage(one.join(two, "a").where(once & apart & fits).select("a", "n_1", "common_1", "n_2", "common_2"), "profile-pairs")
    x = rows.select("a", F.col("n").alias("n_1"), F.col("common").alias("common_1"), F.col("b").alias("x"), F.col("comp").alias("cx"))
    y = rows.select("a", F.col("n").alias("n_2"), F.col("common").alias("common_2"), F.col("b").alias("y"), F.col("comp").alias("cy"))
    met = pairs.join(x, ["a", "n_1", "common_1"]).join(y, ["a", "n_2", "common_2"]).where("cx <> cy")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, signer: Signer, like: Likeness = Likeness()) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (least id of the group), kept."""
    found = stage(docs.select("doc_id", features(whole_text(), like, signer).alias("f")).select("doc_id", "f.*"), "features")
    sets = stage(found.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("node")).where("node is not null"), "sets")
    firsts = sets.select(F.col("node").alias("doc_id"), "k1", "k2")
    nodes = stage(found.join(firsts, ["doc_id", "k1", "k2"], "left_semi").dropDuplicates(["doc_id", "k1", "k2"])
                  .select(F.col("doc_id").alias("node"), "n", "bands", "sig"), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stage(buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"), "shared-buckets")
    links = _Links(docs, like)
    _resolve(nodes, stage(buckets.join(shared, "bucket"), "bucket-members"), links)
    groups = stage(links.of(sets, "node", "component_id").select("k1", "k2", "component_id"), "groups")
    out = found.select("doc_id", F.col("n").alias("n_shingles"), "k1", "k2").join(groups, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
