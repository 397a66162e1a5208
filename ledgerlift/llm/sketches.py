"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ascending array of the k smallest different hashes of a text's word
shingles. Two sketches merge into the sketch of the joined sets, so parts of a corpus can
be sketched apart. Sketches estimate resemblance, containment and the number of different
shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 128


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """A long for every run of ``words`` lower-case words split at white space.

    Words are hashed once and runs combine their words' hashes. A text with fewer words,
    or none, or null, is one shingle of what there is, so every text has a hash and equal
    texts have equal hashes.
    """
    split = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")

    def runs(found: Column) -> Column:
        # the number of words, as a part of the hash, tells a short text from a run
        count = F.least(F.size(found), F.lit(words))
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(found) - words, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(words)], count))

    return _bound(F.transform(split, lambda w: F.xxhash64(w)), runs)


def sketch(text: Column, *, words: int = 5, size: int = SIZE) -> Column:
    """The bottom-k sketch of a text."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, size)


def merged(left: Column, right: Column, size: int = SIZE) -> Column:
    """The sketch of two parts together; null counts as no part."""
    empty = F.array().cast("array<bigint>")
    return F.slice(F.sort_array(F.array_union(F.coalesce(left, empty), F.coalesce(right, empty))), 1, size)


def merge_all(rows: DataFrame, keys: list[str], sketch_column: str, size: int = SIZE) -> DataFrame:
    """One sketch for each key: the ``size`` smallest different hashes of all the key's sketches.

    Hashes are exploded and numbered; the limit is applied before the shuffle as well, so
    a hot key sends at most ``size`` hashes from each task.
    """
    hashes = rows.select(*keys, F.explode(sketch_column).alias("__hash"))
    order = Window.partitionBy(*keys).orderBy("__hash")
    first = hashes.withColumn("__rank", F.dense_rank().over(order)).filter(F.col("__rank") <= size)
    return first.groupBy(*keys).agg(F.sort_array(F.collect_set("__hash")).alias(sketch_column))


def resemblance(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1; null if a sketch is null."""
    def share(joint: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(left, right), joint))
        return F.when(F.size(joint) == 0, F.lit(1.0)).otherwise(shared / F.size(joint))

    known = left.isNotNull() & right.isNotNull()
    return F.when(known, _bound(merged(left, right, size), share))


def distinct_count(of: Column, size: int = SIZE) -> Column:
    """Estimated number of different shingles; exact below ``size``."""
    share = (F.element_at(of, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(of) < size, F.size(of).cast("double")).otherwise((size - 1) / share)


def containment(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated share of the left text's shingles that the right one has, 0 to 1."""
    alike = resemblance(left, right, size)
    common = alike / (1 + alike) * (distinct_count(left, size) + distinct_count(right, size))
    return F.least(F.lit(1.0), common / distinct_count(left, size))


def as_text(of: Column) -> Column:
    """A sketch as 16 hexadecimal digits a hash."""
    return F.lower(F.array_join(F.transform(of, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def in_neighbour_blocks(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``docs`` with __block and __guest, by which a window finds the row with the next key.

    Rows are dealt into blocks of neighbouring keys. The bounds of the blocks are keys of
    the table, found by one aggregation of the key column; their number follows the
    shuffle parallelism, not the data. The row of each bound also goes to the block before,
    as a guest, so no window crosses a block and texts are shuffled once. The least key's
    row is the guest of the last block. Rows without a key stand before all others.
    """
    blocks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / blocks for i in range(1, blocks)]
    accuracy = max(10_000, 20 * blocks)
    found = docs.agg(F.min(key).alias("least"), F.percentile_approx(key, shares, accuracy).alias("inner")).first()
    if found["least"] is None:
        return docs.withColumns({"__block": F.lit(0), "__guest": F.lit(False)})
    bounds = sorted({found["least"], *found["inner"]})
    keys = F.array(*map(F.lit, bounds))
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def further(low: Column, step: Column) -> Column:
        return F.when(F.get(keys, low + step) <= F.col(key), low + step).otherwise(low)

    placed = docs.withColumn("__own", F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further))
    own = F.struct(F.col("__own").alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("__own") - 1, F.lit(len(bounds))).alias("block"), F.lit(True).alias("guest"))
    homes = F.when(F.get(keys, F.col("__own")) == F.col(key), F.array(own, guest)).otherwise(F.array(own))
    return placed.withColumn("__home", F.explode(homes)).withColumns(
        {"__block": F.col("__home.block"), "__guest": F.col("__home.guest")}).drop("__home", "__own")


def with_edits(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, size: int = SIZE) -> DataFrame:
    """key, text, edited, sketch, edited_sketch, next_sketch for every document.

    The edited text has its last floor(n/2) code points replaced by the first as many (or
    all) of the next document by ascending key; after the last key comes the least. Null
    text counts as empty. Rows of one key stand in the order of their texts' hashes.
    A table of one row follows itself; without any key the last row has no next text.
    """
    order = Window.partitionBy("__block").orderBy("__guest", key, "__tie")
    whole = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text)).withColumn("__tie", F.xxhash64(text))
    blocks = in_neighbour_blocks(whole, key=key)
    told = blocks.withColumn("__next", F.lead(text).over(order)).withColumn(
        "sketch", sketch(F.col(text), words=words, size=size))
    told = told.withColumn("next_sketch", F.lead("sketch").over(order)).filter(~F.col("__guest"))
    half = F.floor(F.length(text) / 2).cast("int")
    edited = F.concat(
        F.substring(F.col(text), F.lit(1), F.length(text) - half),
        F.substring(F.coalesce(F.col("__next"), F.lit("")), F.lit(1), half))
    return told.withColumn("edited", edited).select(
        key, text, "edited", "sketch", sketch(F.col("edited"), words=words, size=size).alias("edited_sketch"),
        "next_sketch")
