"""Benchmark decontamination with SimHash over item-sized windows, in DataFrame operations only.

Texts and benchmark items become lower-case words and shingles of five words. A shingle weighs its
number of occurrences times its rarity among the items, ``ln(1 + items / items that hold it)``.
A document is read in windows as long as an item. A window can only reach the similarity with some item
if it holds one of that item's rarest shingles, any that together weigh more than 0.2 of the item
(prefix filter on weights). So windows are laid out only where such an anchor occurs, aligned to its place
in the item and shifted by as many words to both sides as inserted or deleted words can move it at 0.8 (for shingles
that do not repeat within a window). The anchors are broadcast below a checked number of rows and joined by shuffle above.

Each window and each item gets a weighted SimHash fingerprint of 64 bits, which is cut into four blocks: all windows and
items whose fingerprints differ in three bits at most agree in a block and are joined by it. At a similarity of 0.8
fingerprints differ in far more bits, so these pairs are joined by those with an anchor in common, of which
a Hamming distance of more than half of the bits, where unrelated ones lie, drops some. Pairs are verified: weighted Jaccard similarity of the shingles themselves, at least 0.8.

Null and empty texts and items, and items of fewer than five words, match nothing. Repeated
documents are matched each by itself (same key: reported once; rows of one key, or of none, with different texts are judged each by its text); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import stored

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS = 64, 32
#: Fingerprints as near as this meet by their blocks, all of them.
BLOCK_RADIUS = 3
#: Tables of the benchmark's size are broadcast up to so many rows (some ten bytes each).
BROADCAST_ROWS = 500_000
#: Words of a text that are looked up together.
PART = 256


def words_of(text: Column) -> Column:
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(split, lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of the shingles; only the anchors are looked up by them."""
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))
    return F.transform(first, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))


def shingles(words: Column) -> Column:
    """The shingles as text."""
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))
    return F.transform(first, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))


def _parts(words: Column, longest: int) -> Column:
    """``words`` in parts of PART, each with as many words on either side as an item may have."""
    numbers = F.sequence(F.lit(0), F.greatest(F.floor((F.size(words) - 1) / PART).cast("int"), F.lit(0)))
    start = lambda k: F.greatest(k * PART - longest, F.lit(0))
    return F.transform(numbers, lambda k: F.slice(words, start(k) + 1, k * PART + PART + longest - start(k)))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fingerprints(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of each key from rows (keys, shingle, weight)."""
    # whole numbers, so that the sums and their signs do not depend on the order of the rows
    bits = weighted.select(*keys, F.xxhash64("shingle").alias("h"), F.round(F.col("weight") * 1_000_000).cast("long").alias("weight"))
    sums = bits.groupBy(*keys).agg(
        *[F.sum(F.when(F.shiftright("h", j).bitwiseAND(1) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"s{j}") for j in range(BITS)]
    )
    value = F.lit(0).cast("long")
    for j in range(BITS):
        value = value.bitwiseOR(F.when(F.col(f"s{j}") > 0, F.lit(1 << j if j < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, value.alias("fp"))


def blocks(fp: Column, radius: int) -> Column:
    """radius + 1 blocks that share out the bits: two fingerprints within the radius agree in one at least."""
    n, out, at = radius + 1, [], 0
    for b in range(n):
        width = BITS // n + (b < BITS % n)
        out.append(F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, at).bitwiseAND((1 << width) - 1).alias("value")))
        at += width
    return F.array(*out)


def identity(key: str) -> Column:
    """A row's key and text in one digest: rows of one key, or of none, are told apart by their texts."""
    return F.md5(F.concat_ws("\n", F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("")), "text"))


def _found(docs: DataFrame, benchmark: DataFrame, radius: int, similarity: float, key: str) -> tuple[DataFrame, DataFrame]:
    """Windows that match, as rows (key, __id, begin, n_words, content, item, similarity, distance, by_blocks); item and item_id."""
    items = stored(
        benchmark.select("item_id", words_of(F.col("text")).alias("words"))
        .where(F.size("words") >= SHINGLE)
        .dropDuplicates(["item_id", "words"])
        .select("item_id", F.xxhash64("item_id", "words").alias("item"), F.size("words").alias("size"), F.posexplode(shingles(F.col("words"))).alias("at", "shingle")),
        "items",
    )
    total = items.agg(F.countDistinct("item")).first()[0]
    held = items.groupBy("shingle").agg(F.countDistinct("item").alias("held"))
    rarity = held.select("shingle", F.log1p(F.lit(float(total)) / F.col("held")).alias("weight"))
    weighted = stored(items.join(rarity, "shingle"), "weighted-items")
    n_rows = weighted.count()
    # anchors: an item's rarest shingles, as many as hold more than 1 - similarity of its weight
    rare = Window.partitionBy("item").orderBy(F.desc("weight"), "shingle", "at")
    before = F.coalesce(F.sum("weight").over(rare.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # shifts: with k shingles fewer in common a pair is at most (whole - lightest k) / (whole + k * lightest of all)
    lightest = weighted.agg(F.min("weight")).first()[0] or 0.0
    light = Window.partitionBy("item").orderBy("weight", "shingle", "at").rowsBetween(Window.unboundedPreceding, 0)
    lost = F.sum("weight").over(light) + similarity * lightest * F.count("*").over(light)
    judged = weighted.withColumns({"before": before, "whole": F.sum("weight").over(Window.partitionBy("item"))})
    judged = judged.withColumn("spare", (lost <= (1 - similarity) * F.col("whole") + 1e-9).cast("int"))
    judged = judged.withColumn("shift", F.greatest(F.sum("spare").over(Window.partitionBy("item")) - (SHINGLE - 1), F.lit(0)))
    place = F.sequence(F.greatest(F.col("at") - F.col("shift"), F.lit(0)), F.least(F.col("at") + F.col("shift"), F.col("size") - SHINGLE))
    anchors = (
        judged.where(F.col("before") <= (1 - similarity) * F.col("whole") + 1e-9)
        .select(F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(k)) for k in range(SHINGLE)]).alias("h"), F.explode(place).alias("at"), "size", "item")
        .groupBy("h", "at", "size")
        .agg(F.collect_set("item").alias("items"))
    )
    anchors = stored(anchors, "anchors")
    n_anchors = anchors.count()
    longest = items.agg(F.max("size")).first()[0] or 0
    texts = docs.select(key, identity(key).alias("__id"), words_of(F.col("text")).alias("words"))
    content = F.md5(F.concat_ws(" ", "words")).alias("content")
    # Windows are cut where the anchor is found, out of a part of the text, so that a long text costs in proportion.
    parts = texts.select(key, "__id", F.posexplode(_parts(F.col("words"), longest)).alias("part", "words"))
    start = F.greatest(F.col("part") * PART - longest, F.lit(0))  # place of the part's first word in the text
    seen = parts.select(key, "__id", "words", start.alias("start"), (F.col("part") * PART).alias("own"), F.posexplode(shingle_hashes(F.col("words"))).alias("pos", "h"))
    seen = seen.withColumn("pos", F.col("pos") + F.col("start")).where((F.col("pos") >= F.col("own")) & (F.col("pos") < F.col("own") + PART))
    begin = F.col("pos") - F.col("at")
    inside = F.greatest(begin, F.lit(0)) - F.col("start")
    cut = F.slice("words", inside + 1, begin + F.col("size") - F.col("start") - inside)
    met = seen.join(F.broadcast(anchors) if n_anchors <= BROADCAST_ROWS else anchors, "h")
    windows = met.select(key, "__id", begin.alias("begin"), "items", cut.alias("words"))
    windows = stored(windows.withColumn("content", content), "windows")
    # equal windows are judged once
    contents = windows.groupBy("content").agg(F.first("words").alias("words"))
    pieces = contents.select("content", F.explode(shingles(F.col("words"))).alias("shingle"))
    known = _small(rarity, n_rows)
    valued = pieces.join(known, "shingle", "left").withColumn("weight", F.coalesce("weight", F.log1p(F.lit(float(total)))))
    valued = stored(valued, "valued-windows")
    # written out: a plan holds the sums by bit once, not again for each use of a fingerprint
    left = stored(fingerprints(valued, ["content"]).withColumnRenamed("fp", "window_fp"), "window-fingerprints")
    right = stored(fingerprints(weighted, ["item"]).withColumnRenamed("fp", "item_fp"), "item-fingerprints")
    pairs = windows.select("content", F.explode("items").alias("item")).distinct()
    far = F.bit_count(F.col("window_fp").bitwiseXOR(F.col("item_fp"))).alias("distance")
    anchored = pairs.join(left, "content").join(_small(right, n_rows), "item").select("content", "item", far, F.lit(False).alias("by_blocks"))
    # all fingerprints within BLOCK_RADIUS, whichever anchor the window was laid at
    mine = left.select("content", "window_fp", F.explode(blocks(F.col("window_fp"), BLOCK_RADIUS)).alias("b"))
    theirs = right.select("item", "item_fp", F.explode(blocks(F.col("item_fp"), BLOCK_RADIUS)).alias("b"))
    blocked = mine.join(_small(theirs, (BLOCK_RADIUS + 1) * n_rows), "b").select("content", "item", far, F.lit(True).alias("by_blocks"))
    blocked = blocked.where(F.col("distance") <= BLOCK_RADIUS)
    near = anchored.where(F.col("distance") <= radius).unionByName(blocked)
    near = stored(near.groupBy("content", "item", "distance").agg(F.bool_or("by_blocks").alias("by_blocks")), "near")
    # exact weights: per pair and shingle the occurrences on both sides
    own = valued.groupBy("content", "shingle", "weight").agg(F.count("*").alias("n"))
    held = weighted.groupBy("item", "shingle", "weight").agg(F.count("*").alias("n"))
    sides = near.join(own, "content").select("content", "item", "distance", "by_blocks", "shingle", "weight", F.col("n").alias("a"), F.lit(0).cast("long").alias("b"))
    sides = sides.unionByName(near.join(held, "item").select("content", "item", "distance", "by_blocks", "shingle", "weight", F.lit(0).cast("long").alias("a"), F.col("n").alias("b")))
    met = sides.groupBy("content", "item", "distance", "by_blocks", "shingle", "weight").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    scored = met.groupBy("content", "item", "distance", "by_blocks").agg(
        (F.sum(F.least("a", "b") * F.col("weight")) / F.sum(F.greatest("a", "b") * F.col("weight"))).alias("similarity")
    )
    verified = stored(scored.where(F.col("similarity") >= similarity - 1e-12), "verified")
    places = windows.select(key, "__id", "begin", F.size("words").alias("n_words"), "content")
    return places.join(verified, "content"), items.select("item", "item_id").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, key: str = "doc_id") -> DataFrame:
    """doc_id, item_id, start and n_words of the best window, similarity, distance and found_by, for each pair that matches.

    found_by: ``blocks`` if the fingerprints met by their blocks, ``anchor`` if only an anchor in common brought them together.
    """
    found, names = _found(docs, benchmark, radius, similarity, key)
    found = found.join(names, "item")
    best = F.max_by(
        F.struct(F.greatest("begin", F.lit(0)).alias("start"), "n_words", "similarity", "distance", F.when(F.col("by_blocks"), "blocks").otherwise("anchor").alias("found_by")),
        F.struct("similarity", -F.col("begin"), -F.col("n_words")),
    )
    return found.groupBy(key, "item_id").agg(best.alias("w")).select(key, "item_id", "w.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents without a match."""
    found, _ = _found(docs, benchmark, RADIUS, SIMILARITY, key)
    kept = docs.withColumn("__id", identity(key)).join(found.select("__id").distinct(), "__id", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
