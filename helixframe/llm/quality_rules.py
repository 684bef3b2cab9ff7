"""Quality rules: compression bands.

Repetitive text compresses too well and noise too badly. The whole document and each chunk of a
fixed size, the rest at the end included, are compressed with zstandard, and the ratio of compressed
to raw bytes must lie in a band that depends on the number of raw bytes, as short texts compress
less. Chunks find a repetitive or noisy stretch inside a document whose whole ratio is usual.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, map_texts

SYMBOLS = "#*$%&|<>"
CHUNK_BYTES = 4096
LEVEL = 3
#: (bytes below which the band holds, least ratio, largest ratio), for whole texts and chunks alike. Least ratios lie
#: below what labelled good documents whose crc32(doc_id) mod 5 is not 0 show at each length; largest ones leave room
#: for languages that pack less. Under 64 bytes the frame outweighs the text, so only runs of one character are out.
SHORT_BANDS = (
    (64, 0.50, float("inf")), (128, 0.68, 1.25), (256, 0.47, 1.02), (512, 0.50, 0.85), (1024, 0.47, 0.74), (2048, 0.44, 0.64), (CHUNK_BYTES, 0.43, 0.60),
)
#: Whole texts of more bytes: what repeats farther apart than a chunk shows here only.
DOCUMENT_BANDS = (*SHORT_BANDS, (8192, 0.415, 0.60), (16384, 0.405, 0.60), (65536, 0.385, 0.60), (float("inf"), 0.28, 0.60))
#: Chunks, the last of a text being shorter; a text of at most CHUNK_BYTES is one chunk.
CHUNK_BANDS = (*SHORT_BANDS, (CHUNK_BYTES + 1, 0.43, 0.58))
#: More than one in so many chunks outside their bands reject a text. The share keeps long texts from being dropped
#: for the one table or list that some chunk of theirs holds; up to 20 chunks a single one is too much.
ODD_CHUNKS = 20

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, ratio double, n_chunks long, n_chunks_off long"


def repeat_words(words: list, width: int = 5) -> int:
    """Words that lie in a window of ``width`` words which is found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = h[:n].copy()
    for i in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    often = np.zeros(n, bool)
    often[order[1:]] |= same
    often[order[:-1]] |= same
    # Equal windows have equal keys; equal keys are confirmed on the words themselves.
    at = np.flatnonzero(often).tolist()
    windows = [tuple(words[i : i + width]) for i in at]
    counts = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, windows):
        if counts[w] > 1:
            covered[i] += 1
            covered[i + width] -= 1
    return int((np.cumsum(covered) > 0).sum())


def text_statistics(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at the space and the code points 9 to 13
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def band(n_bytes: int, bands: tuple) -> tuple[float, float]:
    """(least, largest) ratio of so many bytes."""
    return next((low, high) for most, low, high in bands if n_bytes < most)


def compression(raw: bytes, compressor: zstandard.ZstdCompressor) -> tuple:
    """(n_bytes, ratio, n_chunks, n_chunks_off): the whole text and each of its chunks, compressed."""
    if not raw:
        return 0, 1.0, 0, 0
    ratio, view = len(compressor.compress(raw)) / len(raw), memoryview(raw)
    n = -(-len(raw) // CHUNK_BYTES)
    ratios = [ratio]
    if n > 1:
        chunks = (view[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES))
        ratios = [len(compressor.compress(x)) / len(x) for x in chunks]
    off = 0
    for i, x in enumerate(ratios):
        low, high = band(min(CHUNK_BYTES, len(raw) - i * CHUNK_BYTES), CHUNK_BANDS)
        off += not low <= x <= high
    return len(raw), ratio, n, off


def _rows():
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def row(doc, text):
        yield (doc, *text_statistics(text), *compression(text.encode("utf-8", "surrogatepass"), compressor))

    return row


def quality_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its statistics, and whether the bands keep it.

    ``base_failed``: under 10 words, or over 20 % of the words in repeated 5-word windows.
    ``kept``: not base_failed, the whole ratio in the band of the text's bytes, and at most one in
    ODD_CHUNKS chunks with a ratio outside that of its own. Null and empty texts have no words and
    fail; texts of any length are read whole. Rows with equal or null ids give a row each; ids keep
    their type. Other columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    found = map_texts(rows, "doc", "text", f"doc {rows.schema['doc'].dataType.simpleString()}, {SCHEMA}", _rows)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    in_band = F.lit(False)
    for most, low, high in reversed(DOCUMENT_BANDS):
        in_band = F.when(F.col("n_bytes") < most, F.col("ratio").between(low, high)).otherwise(in_band)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & in_band & (F.col("n_chunks_off") * ODD_CHUNKS <= F.col("n_chunks")))


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep; a row's verdict depends on its text alone.

    Null and empty texts go; rows with a null id and repeated rows are judged like others. All
    columns pass, whatever their names; an empty table stays empty. Texts are judged once in each
    row's own place, so nothing is shuffled.
    """
    schema = docs.schema

    def run(batches):
        judge = _rows()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            keep = [verdict_of(next(iter(judge(None, x.as_py() or "")))) for x in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def verdict_of(row: tuple) -> bool:
    """``kept`` of a row of statistics, in plain Python."""
    _, n_words, _, _, _, n_repeat, n_bytes, ratio, n_chunks, n_off = row
    if n_words < 10 or 100 * n_repeat > 20 * n_words:
        return False
    low, high = band(n_bytes, DOCUMENT_BANDS)
    return low <= ratio <= high and n_off * ODD_CHUNKS <= n_chunks
