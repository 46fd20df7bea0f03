"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A fingerprint is the K smallest distinct 48-bit hashes of a text's shingles (five words, ASCII
white space between words, case folded), ascending. A set of fewer than K shingles is kept
whole. Fingerprints of parts merge into that of the whole; two fingerprints estimate
resemblance and containment, one estimates the number of distinct shingles.

Cases: a text of one to four words is one shingle of all its words; null, empty and wordless
texts have the empty fingerprint, which resembles only itself; equal texts have equal
fingerprints; the order of documents is by id, a null id first, those with one id by the first
characters of their text and then by its hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import in_order, prepare
from stallbook.operators.hot import ID, PART, part_count
from stallbook.session import stage

K = 128
SHINGLE_WORDS = 5
SPAN = 2**48
# Running numbers of rows have their part above so many bits.
PART_SHIFT = 33


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sketch(words_column: str, k: int = K, width: int = SHINGLE_WORDS) -> Column:
    """Bottom-k sketch of a column of word arrays, as an ascending array of longs."""
    w = words_column
    return F.expr(
        f"""CASE WHEN size({w}) = 0 THEN array()
        ELSE slice(sort_array(array_distinct(transform(
            sequence(1, greatest(size({w}) - {width - 1}, 1)),
            i -> shiftrightunsigned(xxhash64(slice({w}, i, {width})), 16)))), 1, {k}) END"""
    ).cast("array<bigint>")


def as_text(sketch_column: Column) -> Column:
    return F.array_join(F.transform(sketch_column, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_parts(parts: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """Sketch of each key's whole from the sketches of its parts: `key`, `column`.

    Only the k smallest hashes of a key leave a task, so one key may hold any number of parts.
    """
    hashes = parts.select(key, F.explode(column).alias("h")).distinct()
    ranked = hashes.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("h"))).where(F.col("n") <= k)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both sets; 1 for two empty sets."""
    union = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union)).cast("double")


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) * SPAN / F.element_at(a, k))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has; 1 for an empty first set."""
    common = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def with_next(documents: DataFrame, key: str, text: str, columns) -> DataFrame:
    """Each document beside the next one's text (after the last: the first) and derived columns.

    columns: {name: function of the working frame's `words` column} computed once per document;
    the next document's come as next_<name>. The texts are laid out in order, in parts that end
    anywhere, also among rows with one id; each part gets a copy of the next part's first document.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    placed = in_order(rows, "key", "text", part_count(rows)).withColumn(ID, F.monotonically_increasing_id())
    # Written once: a layout made twice would be cut in other places.
    placed = stage(placed.withColumn(PART, F.shiftright(ID, PART_SHIFT)), "ordered-texts")
    heads = placed.where(F.col(ID) == F.shiftleft(F.col(PART), PART_SHIFT)).select(PART, "text")
    order = Window.orderBy(PART)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One short row per part, so one task orders them all.
    before = heads.select(F.col(PART).alias("head"), F.coalesce(F.lag(PART).over(order), F.last(PART).over(whole)).alias("before"))
    guards = heads.join(before, F.col("head") == F.col(PART)).select(
        F.lit(None).cast("long").alias("key"), "text", F.lit(2**63 - 1).alias(ID), F.col("before").alias(PART)
    )
    # Moved before sketches are made, which are as long as many a text.
    both = placed.select("key", "text", ID, PART).unionByName(guards).repartition(PART).withColumn("words", words(F.col("text")))
    for name, make in columns.items():
        both = both.withColumn(name, make("words"))
    both = both.drop("words")
    own = Window.partitionBy(PART).orderBy(ID)
    for name in ["text", *columns]:
        both = both.withColumn(f"next_{name}", F.lead(name).over(own))
    return both.where(F.col(ID) < 2**63 - 1).drop(ID, PART)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    Edited: the last half (rounded down, in code points) replaced by as many first code points
    of the next document, or all it has.
    """
    rows = with_next(documents, key, text, {"sketch": lambda w: sketch(w, k)})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = rows.withColumn("n", n).withColumn("edited", edited).drop("text", "next_text")
    rows = rows.withColumn("edited_words", words(F.col("edited"))).withColumn("edited_sketch", sketch("edited_words", k))
    return rows.select(
        F.col("key").alias(key),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("shingles_estimate"),
    )
