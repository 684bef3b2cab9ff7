"""SentencePiece encoding and decoding with sampled segmentations.

Forward filtering and backward sampling over the lattice of pieces (see piece_lattice) draw each
text's segmentation with probability proportional to exp(theta * sum of its pieces' scores). The
draw is seeded by the row's key: reruns, other partitions and retried tasks give the same pieces.
Characters that no piece spells are spelled in byte pieces, so decoding gives every text back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from .piece_lattice import Sampler, Vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 3e-4
#: Characters that are segmented at once.
BATCH_CHARS = 1_000_000


def load_pieces(model_path: str = MODEL) -> dict:
    """The vocabulary of a SentencePiece model file with byte pieces, as plain values."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = range(model.vocab_size())
    bytes_at = {model.id_to_piece(i): i for i in n if model.is_byte(i)}
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in n]
    return {"pieces": [model.id_to_piece(i) for i in n], "scores": [model.get_score(i) for i in n], "special": special, "bytes_at": [bytes_at[f"<0x{b:02X}>"] for b in range(256)]}


def row_seed(key, seed: str, copy: int = 0) -> int:
    return xxhash.xxh3_64_intdigest((f"{seed}:{key}:{copy}" if copy else f"{seed}:{key}").encode())


def sample_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, theta: float = THETA, seed: str = "pieces", with_ids: bool = True, number_copies: bool = False) -> DataFrame:
    """(doc, n_pieces, ids_sha256, lossless, ids) for each row of ``docs``; ids is null if not asked for.

    ``ids_sha256`` is of the ids as little-endian 32-bit integers; ``lossless`` tells whether
    decoding them gave the text back. A null text is an empty one, which has no pieces. The seed of a
    row is its id (null is a key like others), so rows with equal ids and texts get equal pieces,
    unless ``number_copies`` asks for a draw of its own for each of them: rows with equal ids and
    texts are numbered, and a row's seed is its id and number. Ids keep their type. Texts of any
    length are read whole. Other columns are ignored, whatever their names; an empty table gives an
    empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    copy = F.row_number().over(Window.partitionBy("doc", F.xxhash64("text")).orderBy(F.lit(0))) - 1 if number_copies else F.lit(0)
    rows = rows.withColumn("copy", copy)
    kind = rows.schema["doc"].dataType
    schema = pa.schema([("doc", to_arrow_type(kind)), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()), ("lossless", pa.bool_()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        vocabulary = Vocabulary(theta=theta, **shared.value)
        sampler = Sampler(vocabulary)
        keys, texts, copies, held = [], [], [], 0

        def flush():
            found = sampler(texts, [row_seed(k, seed, n) for k, n in zip(keys, copies)])
            columns = [
                keys,
                [len(x) for x in found],
                [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in found],
                [vocabulary.decode(x) == t if t else len(x) == 0 for x, t in zip(found, texts)],
                found if with_ids else [None] * len(found),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for key, text, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py() or ""
                keys.append(key), texts.append(text), copies.append(n)
                held += len(text)
                if held >= BATCH_CHARS or len(keys) >= 20_000:
                    yield flush()
                    keys, texts, copies, held = [], [], [], 0
        if keys:
            yield flush()

    return rows.mapInArrow(run, f"doc {kind.simpleString()}, n_pieces long, ids_sha256 string, lossless boolean, ids array<int>")


def decode_pieces(encoded: DataFrame, ids_col: str = "ids", model_path: str = MODEL, text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its pieces in ``text_col``; null ids give a null text, no ids an empty one."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    kept = encoded.drop(text_col)
    names = kept.columns

    def run(batches):
        vocabulary = Vocabulary(theta=THETA, **shared.value)
        for batch in batches:
            ids = batch.column(names.index(ids_col)).to_pylist()
            texts = [None if x is None else vocabulary.decode(np.array(x, np.int64)) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, text_col])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(text_col, StringType())]))
