"""Line dedup: the first document that holds a line keeps it.

A line's key is the stripped, lower-cased line. Texts are split once, and the two 64-bit hashes of
each key are written with document and position. They are dealt in ranges of the first hash, a range
to a partition (equal ranges hold equal shares of uniform hashes, so no sampling pass is needed),
sorted by hash, document and position, and streamed: the first row of each hash is its first
occurrence, and rows of later documents are dropped. Only (hashes, document, position) are shuffled.
What comes out is a compressed keep bitmap for each document, no text.

Very frequent keys would fill one range. They are looked for in a sample of the lines (a key is
frequent with at least 1/2000 of the sampled lines, so there are at most 2000, small enough to
broadcast); their smallest document is found over all documents by an aggregate with map-side
combination, and their rows are then spread over all ranges. Which keys count as frequent changes
nothing in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, materialize, unused

#: At most so many keys can have one part in so many of the sampled lines.
FREQUENT_KEYS = 2000
SAMPLE_ONE_IN = 64
#: Highest bits of a hash that tell its range.
RANGE_BITS = 31


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, text_key, pos, h1, h2) for each line whose key has ``min_chars`` code points."""
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_key"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line")
    )
    lines = lines.select("doc", "text_key", "pos", F.btrim("line", F.lit(SPACES)).alias("key")).where(F.length("key") >= min_chars)
    key = ascii_lower(F.col("key"))
    return lines.select("doc", "text_key", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(min_chars), key).alias("h2"))


def frequent_firsts(keys: DataFrame) -> DataFrame:
    """(h1, h2, first_doc) of the very frequent keys, at most FREQUENT_KEYS rows."""
    sample = keys.where(F.pmod(F.xxhash64("doc", "pos"), F.lit(SAMPLE_ONE_IN)) == 0).groupBy("h1", "h2").agg(F.count("*").alias("n"))
    total = sample.agg(F.sum("n")).collect()[0][0] or 0
    hot = sample.where(F.col("n") * FREQUENT_KEYS >= total).select("h1", "h2")
    return keys.join(F.broadcast(hot), ["h1", "h2"]).groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Keep bitmaps of the documents that lose lines.

    A line is lost if its key has at least ``min_chars`` code points and a document with a smaller
    id holds the key too. Returns (doc, text_key, n_dropped, keep_bitmap): keep_bitmap lists
    (word, bits) for each 64 lines of which any is lost, bit ``b`` of word ``w`` set if line
    ``64 * w + b`` (from 0) stays; words not listed keep all. ``text_key`` is the text's 64-bit
    hash, so that rows which share an id but not a text have bitmaps of their own.

    Null and empty texts, and rows with a null id (which no other row is compared with), lose
    nothing and are not listed. Rows with equal ids are one document. Other columns are ignored.
    Texts of any length are read whole. An empty table gives an empty table.
    """
    keys = materialize(line_keys(docs, id_col, text_col, min_chars))
    firsts = frequent_firsts(keys)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The hash's highest bits as a share of the ranges: neighbouring hashes are in one range.
    of = lambda h: (F.shiftrightunsigned(h, 64 - RANGE_BITS) * ranges / (1 << RANGE_BITS)).cast("int")
    dealt = keys.join(F.broadcast(firsts), ["h1", "h2"], "left").withColumn("range", F.when(F.col("first_doc").isNull(), of(F.col("h1"))).otherwise(of(F.xxhash64("doc", "pos"))))
    ordered = dealt.repartitionById(ranges, "range").sortWithinPartitions("range", "h1", "h2", "doc", "pos")
    stream = Window.partitionBy("range", "h1", "h2").orderBy("doc", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = ordered.withColumn("first_doc", F.coalesce("first_doc", F.first("doc").over(stream))).where(F.col("doc") > F.col("first_doc"))
    words = lost.groupBy("doc", "text_key", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("gone"))
    return words.groupBy("doc", "text_key").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep_bitmap")
    )


def kept_text(text: Column, bitmap: Column) -> Column:
    """``text`` without the lines whose bit is not set; a null bitmap keeps all, null text is ""."""
    by_word = F.map_from_entries(bitmap)
    dense = F.transform(F.sequence(F.lit(0), F.element_at(bitmap, -1)["word"]), lambda w: F.coalesce(F.element_at(by_word, w), F.lit(-1).cast("long")))
    return F.when(bitmap.isNull(), F.coalesce(text, F.lit(""))).otherwise(_join_kept(text, dense))


def _join_kept(text: Column, dense: Column) -> Column:
    # The words are bound to a lambda's variable, so that they are built once for each text.
    kept = F.transform(F.array(dense), lambda words: F.array_join(F.filter(F.split(text, "\n"), lambda _, i: _bit(words, i)), "\n"))
    return F.element_at(kept, 1)


def _bit(words: Column, i: Column) -> Column:
    word = F.coalesce(F.get(words, F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
    return F.call_function("getbit", word, F.pmod(i, F.lit(64)).cast("int")) == 1


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with the columns n_lines, n_dropped and kept_text added.

    Each row of ``docs`` gives one row. A null or empty text is one empty line, which stays. Added
    columns replace columns of the same names.
    """
    doc, key, gone, keep = unused(docs, "doc", "key", "gone", "keep")
    found = line_bitmaps(docs, id_col, text_col, min_chars)
    found = found.select(F.col("doc").alias(doc), F.col("text_key").alias(key), F.col("n_dropped").alias(gone), F.col("keep_bitmap").alias(keep))
    joined = docs.join(found, (docs[id_col] == F.col(doc)) & (F.xxhash64(docs[text_col]) == F.col(key)), "left")
    n_lines = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).cast("long")
    added = {"n_lines": n_lines, "n_dropped": F.coalesce(gone, F.lit(0).cast("long")), "kept_text": kept_text(F.col(text_col), F.col(keep))}
    return joined.select(*[c for c in docs.columns if c not in added], *[v.alias(k) for k, v in added.items()])
