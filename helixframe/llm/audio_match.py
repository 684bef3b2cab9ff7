"""Media columns: chroma fingerprints of an audio column, and recordings aligned by them.

Recordings with equal fingerprints are one class. A stated set of queries is matched against all
classes in blocks: each block of queries meets each part of the classes in one task, so a task holds
one block and streams one part. A block's queries are filed in an inverted index, and what a recording
finds in it is counted by offset (``audio_index``). Those that the index can't tell apart, and all of
them if asked, are searched at every offset: it is bounded from below, and what lies within the bound
is verified by the share of differing bits, so these matches are those of a search over all offsets.
"""

from __future__ import annotations

import io
import wave
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import audio_index, chroma
from .common import materialize

#: Bytes of the queries' fingerprints that a block holds, about; four for each hop of audio.
BLOCK_BYTES = 8 << 20
#: Classes of a part, about.
PART_CLASSES = 2048
#: A class counts as large with one part in so many of all rows.
LARGE_CLASSES = 1000
#: Integers that are summed for the bound.
STEP = 4
LARGEST_ERROR = 0.20
LEAST_OVERLAP = 0.5


def fingerprints(recordings: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """(id, n_ints, fingerprint, k1, k2): packed integers as bytes and their 128-bit hash.

    Null, empty, damaged and too short audio gives no integers and null hashes; what is left of a
    recording that is cut off is heard. Recordings of any length are read whole. Ids are whole
    numbers; null and repeated ones give a row each. Other columns are ignored, whatever their names;
    an empty table gives an empty table.
    """

    def run(batches):
        schema = pa.schema([("id", pa.int64()), ("n_ints", pa.int64()), ("fingerprint", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64())])
        for batch in batches:
            rows = []
            for key, audio in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = chroma.fingerprint(chroma.samples(audio.as_py()))
                raw = found.astype("<u4").tobytes()
                h = xxhash.xxh3_128_intdigest(raw)
                k = np.array([h >> 64, h & (1 << 64) - 1], np.uint64).view(np.int64).tolist() if len(found) else (None, None)
                rows.append((key, len(found), raw, *k))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return recordings.select(F.col(id_col).cast("long"), audio_col).mapInArrow(run, "id long, n_ints long, fingerprint binary, k1 long, k2 long")


def align(a: np.ndarray, b: np.ndarray, offsets, largest_error: float = LARGEST_ERROR, least_overlap: float = LEAST_OVERLAP):
    """(offset, bit_error) of the best of ``offsets`` of b over a, None if none is good enough."""
    best = None
    for offset in offsets:
        error, places = chroma.bit_error(a, b, int(offset))
        if places >= least_overlap * min(len(a), len(b)) and error <= largest_error and (best is None or (error, abs(offset), offset) < best[:3]):
            best = error, abs(offset), int(offset)
    return None if best is None else (best[2], best[0])


def _padded(prints: list) -> tuple[np.ndarray, np.ndarray]:
    """The integers of each print in a row, zeros after its end, and the prints' lengths."""
    lengths = np.array([len(p) for p in prints])
    words = np.zeros((len(prints), lengths.max(initial=0)), "<u4")
    for row, p in zip(words, prints):
        row[: len(p)] = p
    return words, lengths


def _signs(words: np.ndarray) -> np.ndarray:
    """The bits of each integer as -1 and 1."""
    bits = np.unpackbits(words.view(np.uint8).reshape(*words.shape, 4), axis=2)
    return bits.astype(np.float32) * 2 - 1


def _chunks(prints: list, rows: int, places: int):
    """Places of prints of similar length, at most ``rows`` and about ``places`` integers at once."""
    order, at = np.argsort([len(p) for p in prints], kind="stable"), 0
    while at < len(order):
        n = max(1, min(rows, places // max(1, len(prints[order[min(at + rows, len(order)) - 1]]))))
        yield order[at : at + n]
        at += n


def _differing(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray, offset: int) -> np.ndarray:
    """Differing bits of each row of b, of length n, laid over that of a, of length m, from ``offset``."""
    low, high = max(0, offset), min(a.shape[1], offset + b.shape[1])
    place = np.arange(low, high)
    valid = (place < m[:, None]) & (place < offset + n[:, None])
    return np.where(valid, np.bitwise_count(a[:, low:high] ^ b[:, low - offset : high - offset]), 0).sum(1, dtype=np.int64)


class _Block:
    """Queries that are laid over recordings at every offset.

    Differing bits are bounded from below: with bits as -1 and 1, the squared distance of the sums of
    STEP integers is at most STEP times that of the integers, which is four for each differing bit. One
    product of matrices bounds all pairs at an offset; those within the bound are counted in full, so
    no alignment is lost.
    """

    def __init__(self, ids: list, prints: list):
        self.ids, self.prints = ids, [np.frombuffer(p, "<u4") for p in prints]

    def matches(self, found: np.ndarray) -> list:
        """(query id, offset, error) of the queries that the recording's integers align with."""
        return [hit[1:] for hit in self.all_matches([found])]

    def all_matches(self, found: list) -> list:
        """(place in ``found``, query id, offset, error) of each recording and query that align."""
        result = []
        recordings = [(at, *_padded([found[i] for i in at])) for at in _chunks(found, 2048, 1 << 18)]
        recordings = [(*r, self._sums(r[1], r[2])) for r in recordings]
        for mine in _chunks(self.prints, 256, 1 << 15):
            a, m = _padded([self.prints[i] for i in mine])
            running = self._running(a, m)
            for at, b, n, sums in recordings:
                result += [(int(at[r]), self.ids[mine[q]], offset, error) for q, r, offset, error in self._best(a, m, running, b, n, sums)]
        return result

    @staticmethod
    def _sums(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows (sums, squared length, 1) of each whole STEP integers, one column for each recording."""
        k = words.shape[1] // STEP
        s = _signs(np.ascontiguousarray(words[:, : k * STEP])).reshape(len(words), k, STEP, 32).sum(2)
        made = np.concatenate([s, (s * s).sum(2, keepdims=True), np.ones((*s.shape[:2], 1), np.float32)], axis=2)
        made[np.arange(1, k + 1) * STEP > lengths[:, None]] = 0
        return np.ascontiguousarray(made.reshape(len(words), -1).T)

    @staticmethod
    def _running(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(-2 sums, 1, squared length) of the STEP integers from each place."""
        n = max(0, words.shape[1] - STEP + 1)
        signs = _signs(words)
        s = sum(signs[:, i : i + n] for i in range(STEP))
        made = np.concatenate([-2 * s, np.ones((*s.shape[:2], 1), np.float32), (s * s).sum(2, keepdims=True)], axis=2)
        made[np.arange(n) + STEP > lengths[:, None]] = 0
        return made

    @staticmethod
    def _best(a, m, running, b, n, sums):
        """(query, recording, offset, error) of the best offset of each pair that has a good one."""
        long_a, long_b, width = a.shape[1], b.shape[1], 34
        # Equal lengths need one bound for all pairs.
        each_m = m[:1, None] if (m == m[0]).all() else m[:, None]
        each_n = n[None, :1] if (n == n[0]).all() else n[None, :]
        shorter = np.minimum(each_m, each_n)
        best = np.full((len(a), len(b)), np.inf)
        where = np.zeros((len(a), len(b)), np.int64)
        # The nearer offset wins among equal errors, the negative one among equally near ones.
        for offset in sorted(range(1 - long_b, long_a), key=lambda d: (abs(d), d)):
            places = np.minimum(each_m, offset + each_n) - max(0, offset)
            ok = (places > 0) & (places >= LEAST_OVERLAP * shorter)
            if not ok.any():
                continue
            limit = np.where(ok, places * (32 * LARGEST_ERROR * 4 * STEP * 1.001) + 1, -1).astype(np.float32)
            first, last = max(0, -(offset // STEP)), min(long_b // STEP, (long_a - offset) // STEP)
            if last > first:
                left = running[:, offset + STEP * first : offset + STEP * (last - 1) + 1 : STEP].reshape(len(a), -1)
                near = np.flatnonzero(left @ sums[width * first : width * last] <= limit)
            else:
                near = np.flatnonzero(np.broadcast_to(ok, best.shape))
            slice_rows = max(1, (1 << 20) // min(long_a, long_b))
            for start in range(0, len(near), slice_rows):
                q, r = np.divmod(near[start : start + slice_rows], len(b))
                over = np.minimum(m[q], offset + n[r]) - max(0, offset)
                keep = (over > 0) & (over >= LEAST_OVERLAP * np.minimum(m[q], n[r]))
                q, r, over = q[keep], r[keep], over[keep]
                error = _differing(a[q], b[r], m[q], n[r], offset) / (32 * over)
                better = (error <= LARGEST_ERROR) & (error < best[q, r])
                q, r = q[better], r[better]
                best[q, r], where[q, r] = error[better], offset
        for q, r in np.argwhere(np.isfinite(best)).tolist():
            yield q, r, int(where[q, r]), float(best[q, r])


class _Indexed:
    """Queries filed in an index; plain queries and plain recordings meet at every offset."""

    def __init__(self, ids: list, prints: list):
        self.ids, self.prints = ids, prints
        self.index = audio_index.Index([np.frombuffer(p, "<u4") for p in prints])

    def _block(self, plain: bool) -> _Block:
        at = np.flatnonzero(self.index.plain == plain).tolist()
        return _Block([self.ids[i] for i in at], [self.prints[i] for i in at])

    def all_matches(self, found: list) -> list:
        """As ``_Block.all_matches``."""
        plain = np.array([self.index.is_plain(f) for f in found], bool)
        usual, special = np.flatnonzero(~plain).tolist(), np.flatnonzero(plain).tolist()
        result = [(usual[j], self.ids[i], offset, error) for i, j, offset, error in self.index.matches([found[j] for j in usual], LARGEST_ERROR, LEAST_OVERLAP)]
        if self.index.plain.any():
            result += self._block(True).all_matches(found)
        if special and not self.index.plain.all():
            result += [(special[j], *hit) for j, *hit in self._block(False).all_matches([found[j] for j in special])]
        return result


def _met(batches, kind=_Indexed):
    schema = pa.schema([("class_id", pa.int64()), ("match_id", pa.int64()), ("offset", pa.int64()), ("bit_error", pa.float64())])
    key, ids, prints, index = None, [], [], None
    for batch in batches:
        rows, held, classes = [], [], []

        def close():
            if held:
                rows.extend((q, classes[i], offset, error) for i, q, offset, error in index.all_matches(held) if q != classes[i])
            held.clear(), classes.clear()

        for block, part, side, class_id, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (block, part) != key:
                close()
                key, ids, prints, index = (block, part), [], [], None
            if side == 0:
                ids.append(class_id), prints.append(raw)
                continue
            if not ids:
                continue
            index = index or kind(ids, prints)
            held.append(np.frombuffer(raw, "<u4")), classes.append(class_id)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def match_recordings(prints: DataFrame, is_query, block_bytes: int = BLOCK_BYTES, part_classes: int = PART_CLASSES, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, matches) of a fingerprint table.

    members: (id, n_ints, class_id) for each row, class_id the smallest id with the same integers,
    null where there are none or the id is null. matches: (class_id, match_id, offset, bit_error) for
    each class that holds a query (rows where ``is_query``, a column of id) and each other class it
    aligns with, ``offset`` the place in the query where the match begins. Of equal errors the
    offset nearest 0 wins, and of two as near the negative one. Rows that repeat an id with other
    integers are members of their own classes. Silent or null recordings match nothing. An empty
    table gives empty tables.

    Offsets that two integers or more agree on, up to a bit, are looked at with their neighbours, and
    all offsets of recordings that are plain to the index of a block (loops, held tones, what a fixed
    share of its queries is like). ``exact`` looks at every offset of every pair, so no match is lost
    and each costs time; without, time goes to the integers that are looked up in each block.
    """
    prints = materialize(prints)
    known = prints.where("k1 is not null and id is not null")
    classes = known.groupBy("k1", "k2").agg(F.min("id").alias("class_id"), F.max(is_query.cast("int")).alias("asked"), F.count("*").alias("rows"))
    # Classes with one part in LARGE_CLASSES of all rows or more, at most LARGE_CLASSES, are broadcast,
    # and their rows spread by id, like rows without a class.
    large = classes.where(F.col("rows") * LARGE_CLASSES >= prints.count()).select("k1", "k2", F.col("class_id").alias("large"))
    spread = prints.join(F.broadcast(large), ["k1", "k2"], "left")
    spread = spread.withColumn("j1", F.when(F.col("large").isNull() & F.col("k1").isNotNull(), F.col("k1")).otherwise(F.xxhash64("id"))).withColumn("j2", F.when(F.col("large").isNull(), F.col("k2")))
    named = spread.join(classes.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "class_id"), ["j1", "j2"], "left")
    named = materialize(named.select("id", "n_ints", F.when(F.col("id").isNotNull(), F.coalesce("large", "class_id")).alias("class_id"), F.when(F.col("id") == F.coalesce("large", "class_id"), F.col("fingerprint")).alias("fingerprint")))
    members = named.select("id", "n_ints", "class_id")
    leaders = named.where("fingerprint is not null").select("class_id", "fingerprint").join(classes.select("class_id", "asked"), "class_id")
    leaders = materialize(leaders.dropDuplicates(["class_id"]))
    n, held = leaders.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("asked") == 1, F.octet_length("fingerprint"))), F.lit(0))).first()
    blocks, parts = max(1, -(-held // block_bytes)), max(1, -(-n // part_classes))
    number = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "class_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = leaders.where("asked = 1").select(number(1, blocks).alias("block"), every(parts).alias("part"), F.lit(0).alias("side"), "class_id", "fingerprint")
    all_classes = leaders.select(every(blocks).alias("block"), number(2, parts).alias("part"), F.lit(1).alias("side"), "class_id", "fingerprint")
    dealt = asked.unionByName(all_classes).repartition("block", "part").sortWithinPartitions("block", "part", "side", "class_id")
    return members, dealt.mapInArrow(partial(_met, kind=_Block if exact else _Indexed), "class_id long, match_id long, offset long, bit_error double")


NOTE_SAMPLES = 200


def tones(values) -> bytes:
    """A row of numbers as a WAV recording: one tone for each number, higher for larger ones."""
    v = np.nan_to_num(np.array([0.0 if x is None else x for x in values], np.float64))
    if not len(v):
        return b""
    z = v / max(np.sqrt((v * v).mean()), 1e-9)
    note = 57 + np.clip(np.floor((z + 2) * 6), 0, 23)
    phase = 2 * np.pi * np.cumsum(np.repeat(440.0 * 2 ** ((note - 69) / 12), NOTE_SAMPLES)) / chroma.RATE
    sound = (np.sin(phase) * 100 + 128).astype(np.uint8)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(1), w.setframerate(chroma.RATE)
        w.writeframes(sound.tobytes())
    return out.getvalue()


def sonified(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, audio): a recording for each vector, of one note for each of its numbers, whatever their count.

    Null vectors give null audio, empty ones empty audio, null and not-a-number elements the note of
    0. Null and repeated ids give a row each. Other columns are ignored; an empty table gives an
    empty table.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 256):
                part = [None if v is None else tones(v) for v in batch.column(1).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids.slice(at, 256), pa.array(part, pa.binary())], names=["id", "audio"])

    return vectors.select(F.col(id_col).cast("long"), vector_col).mapInArrow(run, "id long, audio binary")
