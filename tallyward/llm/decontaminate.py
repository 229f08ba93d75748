"""Benchmark decontamination by winnowing.

Both sides keep, of every ``SPAN - K + 1`` consecutive K-grams of words, the leftmost with the smallest hash.  What is kept depends
on the window's words alone, so two texts that share SPAN words in a row keep the same K-gram at the same place of that span.
Fingerprints are joined; each hit names a document, an item and a shift between them, and is extended along that shift:
every window of the item is compared word by word with the document.  Items of fewer than SPAN words are one window and are joined
by the hash of all their words with the documents' n-grams of that length (only for the lengths that occur).

Edge cases: NULL and empty texts have no words: no hits, the digest of an empty list.  An item without words or with a NULL id
is no item.  Rows are told apart by id and text, so repeated rows (and NULL ids) get a result each; an empty benchmark
contaminates nothing.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import ascii_lower, let, stored

SPAN = 10  # words in a window of an item
K = 5  # words in a fingerprinted gram
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def letters(text: Column) -> Column:
    """Runs of ASCII digits, letters and everything beyond ASCII, with A-Z in lower case."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def fingerprints(w: Column, k: int = K, span: int = SPAN) -> Column:
    """Winnowed k-grams of a list of words as (at, fp); none below ``span`` words."""
    width = span - k + 1  # k-grams in a window of ``span`` words

    def grams(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[w[i + j] for j in range(k)]))

    def least(g: Column) -> Column:
        window = lambda i: F.slice(g, i + 1, width)
        place = lambda i: let(window(i), lambda s: F.array_position(s, F.array_min(s))).cast("int") + i - 1
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(g) - width), place))

    def kept(g: Column) -> Column:
        return F.transform(least(g), lambda i: F.struct(i.alias("at"), g[i].alias("fp")))

    return F.when(F.size(w) >= span, let(grams(w), kept))


def ngrams(w: Column, n: int) -> Column:
    hashed = lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(n).cast("int"), F.slice(w, i + 1, n)).alias("fp"))
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), hashed))


def occurrences(doc: Column, item: Column, shift: Column, span: int = SPAN) -> Column:
    """Places of the document's words that start a window equal to the item's window at the same place less ``shift``."""
    win = F.least(F.lit(span), F.size(item))
    lo = F.greatest(F.lit(0), -shift)  # first window of the item that lies inside the document
    hi = F.least(F.size(item), F.size(doc) - shift) - win
    same = lambda i: F.slice(doc, i + shift + 1, win) == F.slice(item, i + 1, win)
    at = F.when(hi >= lo, F.filter(F.sequence(lo, hi), same))
    return F.transform(at, lambda i: F.sequence(i + shift, i + shift + win - 1))


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, item_ids (sorted as strings), hits (sorted places of hit words), contaminated; a row per document."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", letters(F.col("text")).alias("item"))
    items = stored(items.where(F.size("item") > 0).distinct().withColumn("ih", F.xxhash64("item")), "items")
    lengths = sorted(r[0] for r in items.where(F.size("item") < span).select(F.size("item")).distinct().collect())  # < span numbers
    long_ = items.select("item_id", "ih", F.explode(fingerprints(F.col("item"), k, span)).alias("f"))
    short = items.where(F.size("item") < span).withColumn("f", F.struct(F.lit(0).alias("at"), F.xxhash64(F.size("item"), "item").alias("fp")))
    marks = stored(long_.unionByName(short.drop("item")).select("item_id", "ih", F.col("f.at").alias("item_at"), F.col("f.fp").alias("fp")), "marks")

    known = docs.select("doc_id", "text", F.xxhash64("text").alias("dh"))
    # One more mark per document, which matches nothing: it carries the row itself through the join.
    own = F.array(F.struct(F.lit(-1).alias("at"), F.xxhash64("doc_id", "dh").alias("fp")))
    every = [own, *[F.coalesce(c, F.array().cast("array<struct<at:int,fp:bigint>>")) for c in (fingerprints(F.col("w"), k, span), *[ngrams(F.col("w"), n) for n in lengths])]]
    marked = known.withColumn("w", letters(F.col("text"))).select("doc_id", "dh", F.size("w").cast("long").alias("n_words"), F.explode(F.concat(*every)).alias("f"))
    marked = marked.select("doc_id", "dh", "n_words", F.col("f.at").alias("at"), F.col("f.fp").alias("fp"))
    found = stored(marked.join(marks, "fp", "left").where((F.col("at") < 0) | F.col("item_id").isNotNull()), "found")

    shifts = found.where("at >= 0").select("doc_id", "dh", "item_id", "ih", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    near = shifts.join(items, ["item_id", "ih"]).groupBy("doc_id", "dh").agg(F.collect_list(F.struct("item_id", "item", "shift")).alias("near"))
    near = near.withColumnsRenamed({"doc_id": "near_id", "dh": "near_dh"})
    pairs = known.join(near, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("dh") == F.col("near_dh")))
    pairs = pairs.withColumn("w", letters(F.col("text")))  # after the join, so that texts are moved and not lists
    places = lambda c: F.struct(c["item_id"].alias("item_id"), F.flatten(occurrences(F.col("w"), c["item"], c["shift"], span)).alias("at"))
    hits = pairs.select("near_id", "near_dh", F.filter(F.transform("near", places), lambda m: F.size(m["at"]) > 0).alias("m")).select(
        "near_id",
        "near_dh",
        F.array_sort(F.array_distinct(F.flatten(F.transform("m", lambda m: m["at"])))).alias("hits"),
        F.array_sort(F.array_distinct(F.transform("m", lambda m: m["item_id"].cast("string")))).alias("item_ids"),
    ).dropDuplicates(["near_id", "near_dh"])
    rows = found.where("at < 0").select("doc_id", "dh", "n_words")
    out = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("dh") == F.col("near_dh")), "left")
    return out.select(
        "doc_id",
        F.col("dh").alias("text_hash"),
        "n_words",
        F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        (F.coalesce(F.size("hits"), F.lit(0)) > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input without the contaminated documents."""
    bad = decontaminate(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(stored(bad, "contaminated").hint("merge"), docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")), "left_anti")
