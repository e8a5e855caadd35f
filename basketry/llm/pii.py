"""Personal data: patterns, and identifiers found by bootstrapped contexts. DataFrame functions only.

E-mail addresses, IP addresses, card and phone numbers are found by pattern and
checked. They seed a search for identifiers of unknown form (tokens with three
digits in a row): the one or two words before an entity are its lexical
pattern; patterns and instances make a graph, scored in rounds:

  pattern  = (sum over its instances of their score times how often they follow it) / (all occurrences of its words in the corpus)
  instance = 1 - product over its patterns of (1 - pattern score); a seed has 1

A pattern counts with SUPPORT distinct instances that already have a score, and a score of
SURE or more. Instances of such patterns are reported as ``ctx`` wherever they follow one.
Dividing by all occurrences keeps common words, which stand before anything, from becoming patterns.
Both counts take every row, so copies of documents change no score.

Positions are code points: matches are marked in the text, the text is split at
the marks, and lengths of the parts are added up per document.

Defined results: null text counts as empty. Rows that share id and text are
one document and get the same result, each its own row. A row without an id is treated
like any other. An empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import whole_text
from basketry.session import stage

KINDS = ("email", "ip", "card", "phone", "ctx")
EMAIL, IP, CARD, PHONE, CONTEXT = range(5)
#: Distinct scored instances a pattern needs, the least score that counts, rounds of scoring.
SUPPORT, SURE, ROUNDS = 3, 0.5, 3
#: Patterns whose occurrences are counted by sending them to every executor; more are joined by a shuffle.
PATTERNS_AT_ONCE = 200_000
#: Marks the ends of a match; in a text that holds it, it is replaced first by another character no pattern has.
MARK, OTHER = "\x01", "�"

#: Each takes the leftmost longest run that the plain pattern would, but without its repeated groups, whose matching
#: needs stack in proportion to the text: a character class with a look-behind says what may follow what.
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    EMAIL: rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@(?={_LABEL}++\.{_LABEL}){_LABEL}"
           rf"(?:[A-Za-z0-9.-](?<={_LABEL}|{_LABEL}\.(?={_LABEL})))*+",
    IP: r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[0-9 -](?<=[0-9]|[0-9][ -](?=[0-9])))*+",
    PHONE: r"\+[0-9][ ().0-9-]+[0-9]",
    CONTEXT: r"""(?<![^\s"'(=:])[^\s"'<>|,;()]*[0-9]{3}[^\s"'<>|,;()]*""",
}
#: Cheap tests that a text has a match.
TESTS = PATTERNS | {CARD: r"[0-9](?:[ -]?[0-9]){11}", CONTEXT: r"[0-9]{3}"}
#: The one or two whole words before a match, at the end of what precedes it in lower case. Each word is tried once.
_END = r"""[ \t]*+[:#=]?[ \t]*+["'(]?$"""
BEFORE = rf"(?<!\p{{L}})(?:(\p{{L}}++)[ \t]++)?(\p{{L}}++){_END}"
#: The last letters of a text settle its words, unless two words or fewer fill them.
TAIL, FILLED = 64, rf"^\p{{L}}*+[ \t]*+\p{{L}}*+{_END}"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _parts(text: Column, kind: int) -> Column:
    """What stands outside and inside of matches by turns; null without a match."""
    clean = F.translate(text, MARK, OTHER)
    marked = F.regexp_replace(clean, F.lit(PATTERNS[kind]), F.lit(f"{MARK}$0{MARK}"))
    return F.when(text.rlike(TESTS[kind]), F.split(marked, MARK, -1))


def _valid(kind: Column, value: Column) -> Column:
    """Whether a match stands."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (F.when(kind == IP, value.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"))
            .when(kind == CARD, F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
            .when(kind == PHONE, F.length(digits).between(9, 15))
            .otherwise(F.lit(True)))


def matches(docs: DataFrame) -> DataFrame:
    """Valid matches of every kind: doc_id, key (hash of the text), times (rows of that id and text), kind, start, end, value, before (one or two words)."""
    text = whole_text()
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), _parts(text, k).alias("parts")) for k in range(len(KINDS))])
    rows = (docs.select("doc_id", F.xxhash64(text).alias("key"), F.explode(kinds).alias("k"))
            .select("doc_id", "key", "k.kind", F.posexplode("k.parts").alias("at", "part")))
    tail = F.lower(F.right("part", F.lit(TAIL)))
    words = lambda end: F.concat_ws(" ", F.regexp_extract(end, BEFORE, 1), F.regexp_extract(end, BEFORE, 2))
    before = F.when((F.length("part") > TAIL) & tail.rlike(FILLED), words(F.lower("part"))).otherwise(words(tail))
    narrow = rows.select(
        "doc_id", "key", "kind", "at", F.length("part").cast("long").alias("size"), F.when(F.col("at") % 2 == 1, F.col("part")).alias("value"),
        F.when(F.col("at") % 2 == 0, before).alias("words"))
    same = [F.first(c).alias(c) for c in ("size", "value", "words")]
    narrow = narrow.groupBy("doc_id", "key", "kind", "at").agg(*same, F.count("*").alias("times"))
    order = Window.partitionBy("doc_id", "key", "kind").orderBy("at")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = narrow.select("doc_id", "key", "times", "kind", "value", "size", start.alias("start"), F.lag("words").over(order).alias("before"))
    return placed.where(F.col("value").isNotNull() & _valid(F.col("kind"), F.col("value"))).select(
        "doc_id", "key", "times", "kind", "start", (F.col("start") + F.col("size")).alias("end"), "value", F.trim("before").alias("before"))


def _apart(found: DataFrame) -> DataFrame:
    """The matches without the candidate tokens that overlap a checked one."""
    spans = Window.partitionBy("doc_id", "key").orderBy("start", "kind")
    base = F.col("kind") != CONTEXT
    reach = F.max(F.when(base, F.col("end"))).over(spans.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(base, F.col("start"))).over(spans.rowsBetween(1, Window.unboundedFollowing))
    marked = found.select("*", reach.alias("reach"), following.alias("following"))
    free = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce("following", F.col("end")) >= F.col("end"))
    return marked.where(base | free).drop("reach", "following")


def _patterns(before: Column) -> Column:
    """The last word, and the last two words if there are two."""
    last = F.substring_index(before, " ", -1)
    return F.array_distinct(F.array(last, before))


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often the words of each pattern occur in all texts: pattern, total."""
    w = F.split(F.lower(whole_text()), r"[^\p{L}]+")
    rows = docs.select(w.alias("w")).select("w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("at"))
    one, two = F.get("w", F.col("at")), F.concat_ws(" ", F.get("w", F.col("at") - 1), F.get("w", F.col("at")))
    # at the first word both are the same
    rows = rows.select(F.explode(F.array_distinct(F.array(one, two))).alias("pattern"))
    few = patterns.limit(PATTERNS_AT_ONCE + 1).count() <= PATTERNS_AT_ONCE
    return rows.join(F.broadcast(patterns) if few else patterns, "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def score_patterns(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """Patterns that are sure after the rounds: pattern, score.

    ``edges``: distinct (pattern, instance, seed), with ``times`` the instance follows the pattern (once without the column);
    ``totals``: occurrences of every pattern that can count.
    """
    edges = edges if "times" in edges.columns else edges.withColumn("times", F.lit(1))
    edges = stage(edges.join(totals, "pattern"), "pii-edges")
    scores = stage(edges.where("seed").select("instance", F.lit(1.0).alias("score")).distinct(), "pii-instances")
    sure = None
    for _ in range(ROUNDS):
        sure = stage(
            edges.join(scores, "instance").groupBy("pattern", "total").agg(F.sum(F.col("score") * F.col("times")).alias("weight"), F.count("*").alias("n"))
            .select("pattern", "n", F.least(F.col("weight") / F.col("total"), F.lit(1.0)).alias("score"))
            .where((F.col("n") >= SUPPORT) & (F.col("score") >= SURE)).select("pattern", "score"), "pii-patterns")
        doubt = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9))))
        scores = stage(
            edges.join(sure, "pattern").groupBy("instance", "seed").agg(F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("score"))
            .select("instance", "score")
            .unionByName(edges.where("seed").select("instance", F.lit(1.0).alias("score")))
            .groupBy("instance").agg(F.max("score").alias("score")), "pii-instances")
    return sure


def spans(docs: DataFrame) -> DataFrame:
    """All spans: doc_id, key, kind, start, end, value."""
    found = stage(_apart(matches(docs)), "pii-matches")
    linked = found.where("before <> ''").select(
        F.explode(_patterns(F.col("before"))).alias("pattern"), F.lower("value").alias("instance"), (F.col("kind") != CONTEXT).alias("seed"), "times")
    edges = stage(linked.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("times").alias("times")), "pii-graph")
    able = stage(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).select("pattern"), "pii-able")
    totals = stage(_occurrences(docs, able), "pii-totals")
    sure = score_patterns(edges, totals).select("pattern")
    places = found.where(F.col("kind") == CONTEXT).where("before <> ''").withColumn("pattern", F.explode(_patterns(F.col("before"))))
    unseen = places.join(sure, "pattern", "left_semi").drop("pattern").distinct()
    return found.where(F.col("kind") != CONTEXT).unionByName(unseen).drop("before", "times")


def _joined(chosen: Column) -> Column:
    """kind:start:end of sorted (start, kind, end) rows."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(chosen: Column, kind: int) -> Column:
    return F.size(F.filter(chosen, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_ctx."""
    rows = spans(docs).groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    keyed = docs.select("doc_id", F.xxhash64(whole_text()).alias("key"))
    found = keyed.join(rows.withColumnRenamed("doc_id", "_id").withColumnRenamed("key", "_key"),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    every = F.coalesce("all", F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>"))
    counts = [_count(F.col("all"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    base = F.filter("all", lambda s: s["kind"] != CONTEXT)
    return found.select("doc_id", every.alias("all")).select(
        "doc_id", *counts[:CONTEXT], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), counts[CONTEXT])
