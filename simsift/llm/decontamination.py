"""Benchmark decontamination over a distributed positional inverted index. DataFrame functions only.

A window is `window` consecutive words of a benchmark item, or all words of a shorter item. Windows of the
same words count once, as the first of them, so an item that repeats itself is searched once.

1. Split every text into words once, into a table of their own.
2. Count the corpus occurrences of the benchmark's terms; of each window pick the two rarest terms.
   Neighbouring windows mostly pick the same places of an item, so few places are searched.
3. Store the postings (term, document, position) of the picked terms: the index, written as a
   table by the tasks that read the words, without a shuffle.
4. Join postings and picked places on the term; position minus place is the offset at which the
   item would stand in the document. A (document, pick, offset) survives if both places of the pick
   are found there: the intersection of the offset-adjusted lists of the rarest terms.
5. The places of a survivor's windows, a row each, are joined with the postings of the surviving documents on
   document, position and term: the intersection with the other lists. Postings are made at the asked positions
   only: the other words of such a document are in no shuffle. Places that are found and follow each
   other without a gap are a stretch; one of a window's length or more is a phrase match, all
   of whose words are hit. Hit words are counted from the ends of stretches, never listed.
6. Proximity: the two rarest words of a window within `window` words of each other, in any order.

No row holds a text beside a place, so memory doesn't depend on how often a text repeats a word.
Sides that don't grow with the corpus are broadcast after their rows and bytes are checked, else
joined by shuffle; postings and picks come straight from tables then, so adaptive execution can
split a hot term. A document's survivors are rows of a join, never one list.

phrase_matches and proximity_matches answer any other query from an index of all terms.

Defined cases: null and empty texts have no words and no hits; items without words are no items;
items that repeat an item_id count once a document; a row is known by doc_id (null too) and its
text's hash, so rows that repeat get the same result each; an empty benchmark hits nothing; other
columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.llm._space import bounded, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def split_words(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), n_words, words of docs(doc_id, text), a row each, as a table."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(words_of(F.col("text")), F.array().cast("array<string>")).alias("words"))
    return written(rows.select("doc_id", "h", F.size("words").cast("long").alias("n_words"), "words"), "words")


def build_index(words: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings term, doc_id, h, at (0-based position) of the terms, or of all, from split words."""
    postings = words.select("doc_id", "h", F.posexplode("words").alias("at", "term"))
    if terms is not None:
        postings = postings.join(bounded(terms.select("term")), "term")
    return written(postings.select("term", "doc_id", "h", "at"), "postings")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase_id, doc_id, h, start of every occurrence of phrases(phrase_id, words array), from an
    index that holds their terms."""
    places = written(phrases.select("phrase_id", F.size("words").alias("n"), F.posexplode("words").alias("pos", "term")), "phrases")
    met = index.join(bounded(places), "term").withColumn("start", F.col("at") - F.col("pos"))
    return met.groupBy("phrase_id", "doc_id", "h", "start", "n").count().where("count = n").drop("n", "count")


def proximity_matches(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """query_id, doc_id, h, start where all distinct words of queries(query_id, words array) stand,
    in any order, in the `within` words from start, the first of them at start."""
    places = queries.select("query_id", F.array_distinct("words").alias("words"))
    places = written(places.select("query_id", F.size("words").alias("n"), F.explode("words").alias("term")), "proximity")
    met = index.join(bounded(places), "term")
    ahead = W.partitionBy("query_id", "doc_id", "h").orderBy("at").rangeBetween(0, within - 1)
    met = met.withColumn("found", F.size(F.collect_set("term").over(ahead)))
    return met.where("found = n").select("query_id", "doc_id", "h", F.col("at").alias("start")).distinct()


def _windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """item, s (its first place), k of each distinct window where it first occurs; and item, s, item_id
    of all items that have it."""
    k = F.least(F.size("words"), F.lit(window))
    every = items.select("item", "item_id", "words", k.alias("k"), F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("at"))
    every = every.select("item", "item_id", "k", "at", F.slice("words", F.col("at") + 1, F.col("k")).alias("content"))
    first = every.groupBy("content", "k").agg(F.min(F.struct("item", "at")).alias("first"))
    first = written(first.select("content", "k", F.col("first.item").alias("item"), F.col("first.at").alias("s")), "windows")
    members = every.drop("item", "k").join(first, "content").select("item", "s", F.col("item_id").cast("string").alias("item_id")).distinct()
    return first.select("item", "s", "k"), written(members, "members")


def _picked(items: DataFrame, windows: DataFrame, counts: DataFrame) -> DataFrame:
    """item, s, k, rare: of each window that can occur the places of its two rarest terms, in order (one
    place if it has one word)."""
    places = items.select("item", F.posexplode("words").alias("pos", "term")).join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    inside = windows.select("item", "s", "k", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("k") - 1)).alias("pos")).join(places, ["item", "pos"])
    rare = inside.groupBy("item", "s", "k").agg(F.slice(F.array_sort(F.collect_list(F.struct("count", "pos"))), 1, 2).alias("r"))
    pick = F.array_sort(F.transform("r", lambda x: x["pos"]))
    return rare.where(F.col("r")[0]["count"] > 0).select("item", "s", "k", pick.alias("rare"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a window whose two
    rarest words stand near each other) of every row of docs(doc_id, text) against benchmark(item_id, text)."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = written(items.distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    windows, members = _windows(items, window)
    terms = written(items.select(F.explode("words").alias("term")).distinct(), "terms")
    corpus = split_words(docs)
    seen = corpus.select(F.explode("words").alias("term")).join(bounded(terms), "term")
    counts = written(seen.groupBy("term").count(), "term-counts")
    rare = written(_picked(items, windows, counts), "rare")
    chosen = written(rare.select("item", "rare").distinct().withColumn("pick", F.monotonically_increasing_id()), "named-picks")
    picks = written(rare.join(chosen, ["item", "rare"]), "picks")
    places = items.select("item", F.posexplode("words").alias("pos", "term"))
    anchors = chosen.select("item", "pick", "rare", F.explode("rare").alias("pos"))
    bit = F.when(F.size("rare") == 1, 3).when(F.col("pos") == F.col("rare")[0], 1).otherwise(2).alias("bit")
    anchors = written(anchors.join(places, ["item", "pos"]).select("pick", "pos", bit, "term"), "anchors")
    index = build_index(corpus, written(anchors.select("term").distinct(), "index-terms"))
    row, named = ["doc_id", "h"], F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    key = [F.col("doc_id").alias("_id"), F.col("h").alias("_h")]

    met = written(_met(index.join(bounded(anchors), "term"), row, window), "met")
    aligned = met.where("bits = 3")
    whole = picks.select("item", "pick", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("k") - 1)).alias("pos")).distinct()
    whole = written(whole.join(places, ["item", "pos"]), "pick-places")
    spots = aligned.select(*row, "offset", "pick").join(bounded(whole), "pick")
    spots = written(spots.select(*row, "item", "offset", "pos", "term").distinct(), "spots")

    place = (F.col("offset") + F.col("pos")).alias("_at")
    wanted = written(spots.groupBy(*key).agg(F.collect_set(place).alias("wanted")), "wanted")
    postings = _postings_at(corpus, wanted, named).select(*row, "at", "term")
    asked = spots.select(*key, "item", "offset", "pos", place, F.col("term").alias("_term"))
    found = postings.join(asked, named & (F.col("at") == F.col("_at")) & (F.col("term") == F.col("_term")))
    found = found.select(*row, "item", "offset", "pos").distinct()
    island = F.col("pos") - F.row_number().over(W.partitionBy(*row, "item", "offset").orderBy("pos"))
    found = found.withColumn("island", island).groupBy(*row, "item", "offset", "island").agg(F.min("pos").alias("first"), F.count(F.lit(1)).cast("int").alias("n"))
    found = found.join(bounded(windows.select("item", "k").distinct()), "item").where(F.col("n") >= F.col("k"))
    hits = written(found.select(*row, "item", "k", "first", "n", (F.col("offset") + F.col("first")).alias("start")), "hits")

    stretches = hits.groupBy(*row, "start").agg(F.max("n").alias("n"))
    before = F.max(F.col("start") + F.col("n")).over(W.partitionBy(*row).orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    words = stretches.withColumn("fresh", fresh).groupBy(*row).agg(F.sum("fresh").alias("n_hit"))
    inside = hits.select(*row, "item", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - F.col("k"))).alias("s")).distinct()
    ids = inside.join(bounded(members), ["item", "s"]).groupBy(*row).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    near = met.where("near").select(*row, "pick").distinct().join(bounded(picks.select("item", "pick", "s")), "pick").select(*row, "item", "s").distinct()
    near = near.join(bounded(members), ["item", "s"]).groupBy(*row).agg(F.count_distinct("item_id").alias("n_near"))
    found = words.select(*key, "n_hit").join(ids, named).select(*key, "n_hit", "ids")
    found = bounded(written(found, "found"))
    near = bounded(written(near.select(F.col("doc_id").alias("_id2"), F.col("h").alias("_h2"), "n_near"), "near"))
    every = corpus.select("doc_id", "h", "n_words").join(found, named, "left")
    every = every.join(near, F.col("doc_id").eqNullSafe(F.col("_id2")) & (F.col("h") == F.col("_h2")), "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("ids", F.array().cast("array<string>"))
    return every.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def _postings_at(words: DataFrame, wanted: DataFrame, named: Column) -> DataFrame:
    """Postings at the positions of wanted(_id, _h, wanted array, at most about a text's words), of its documents alone. Past
    what may be broadcast, their words are shuffled once, a row a document."""
    held = words.join(bounded(wanted.select("_id", "_h")), named, "left_semi").join(bounded(wanted), named)
    postings = held.select("doc_id", "h", F.explode(F.transform("wanted", lambda at: F.struct(at.alias("at"), F.get("words", at).alias("term")))).alias("p"))
    return postings.select("doc_id", "h", "p.at", "p.term").where("term IS NOT NULL")


def _met(postings: DataFrame, row: list[str], window: int) -> DataFrame:
    """Document, pick, offset where all places of the pick are found (bits is 3), or near one of whose postings one of
    the other place stands less than `window` words before: if any two do, then two that are neighbours in order
    of position. One shuffle of the postings serves both."""
    group = [*row, "pick"]
    met = postings.select(*group, F.col("at").cast("int").alias("at"), (F.col("at") - F.col("pos")).cast("int").alias("offset"), F.col("bit").cast("byte").alias("bit"))
    last = W.partitionBy(*group).orderBy("at", "bit")
    gap = F.col("at") - F.lag("at").over(last)
    near = (F.col("bit") == 3) | F.coalesce((F.col("bit") != F.lag("bit").over(last)) & (gap > 0) & (gap < window), F.lit(False))
    met = met.withColumn("near", near).groupBy(*group, "offset").agg(F.bit_or("bit").alias("bits"), F.max("near").alias("near"))
    return met.where("bits = 3 OR near")
