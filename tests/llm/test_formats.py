import gzip
import io
import json
import struct
import zipfile
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from helixframe.llm import audio_match, chroma, queries, warc_zip
from helixframe.llm.piece_lattice import Sampler, Vocabulary
from helixframe.llm.sentencepiece_sampling import MODEL, THETA, decode_pieces, load_pieces, sample_pieces
from helixframe.llm.zip_directory import members

from .fixtures import documents, table

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u\r\nInjected: x", "other é\r\n\r\nbody"), (4, "u", None), (5, "u", ""), (0, "u", "<p>same</p>"), (None, "u", "<p>same</p>"), (6, "u", "y" * 100_000), (6, "u", "y" * 100_000)]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("first", F.lit(1))
    archives = warc_zip.write_archives(pages)
    got = warc_zip.read_archives(archives).collect()
    assert len(got) == len(PAGES) == sum(r["n_records"] for r in archives.collect())
    same = [i for i, _, h in PAGES if i is not None]
    for r in got:
        html = dict((i, h or "") for i, _, h in PAGES)[r["page_id"]]
        raw = html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), warc_zip.payload_digest(raw))
        first = None if r["page_id"] is None else min(i for i in same if dict((j, h or "") for j, _, h in PAGES)[i] == html)
        revisit = first is not None and first != r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if revisit else ("response", None))
        assert r["payload"] is None if revisit else bytes(r["payload"]) == raw
    listed = warc_zip.archive_folder(spark, archives.collect()[0]["path"].rsplit("/", 1)[0])
    assert warc_zip.read_archives(listed).count() == len(PAGES)


def test_small_payloads_and_small_archives(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archives = warc_zip.write_archives(pages.coalesce(1), least_bytes=50, archive_bytes=200)
    assert archives.count() > 1
    got = warc_zip.read_archives(archives)
    assert got.where("record_type = 'revisit'").count() == 0 and got.count() == len(PAGES)
    empty = warc_zip.write_archives(pages.limit(0))
    assert empty.count() == 0 and warc_zip.read_archives(empty).count() == 0


def test_pages_sql(spark, tmp_path):
    rows = [r for r in PAGES[:6]]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op6_warc_zip(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.OP6_SQL).fetchall())


def foreign(kind, url, block, extra="", digest=None, mime="application/http; msgtype=response"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{url}>\r\nWARC-Target-URI: {url}\r\n{extra}Content-Type: {mime}\r\nContent-Length: {len(block)}\r\n"
    head += f"WARC-Payload-Digest: sha1:{digest}\r\n" if digest else ""
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_makers(spark, tmp_path):
    """Two data files, one of them not indexed and one not compressed, an index that is gzipped, requests, chunked bodies, no private fields."""
    digest = warc_zip.payload_digest(b"hello world")
    first = [
        foreign("warcinfo", "i", b"software: x", mime="application/warc-fields"),
        foreign("response", "http://a.org/1", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n6;x=y\r\n world\r\n0\r\n\r\n", digest=digest),
        foreign("request", "http://a.org/1", b"GET / HTTP/1.1\r\n\r\n"),
    ]
    second = [foreign("resource", "http://b.org/z", b"raw bytes", mime="text/plain"), foreign("revisit", "http://b.org/1", b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Refers-To: <urn:x:http://a.org/1>\r\n", digest)]
    third = [foreign("response", f"http://c.org/{i}", b"HTTP/1.1 200 OK\r\n\r\n" + b"p%d" % i * 50) for i in range(40)]
    packed = [gzip.compress(r) for r in third]
    at = np.cumsum([0] + [len(r) for r in packed]).tolist()
    lines = ['!meta {"format": "cdxj"}'] + [f"org,c)/{i} 2024 " + json.dumps({"offset": str(at[i]), "length": str(len(packed[i])), "filename": "c.warc.gz"}) for i in range(40)]
    with zipfile.ZipFile(tmp_path / "other.wacz", "w") as z:
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        z.writestr("archive/a.warc.gz", b"".join(gzip.compress(r) for r in first))
        z.writestr("archive/b.warc", b"".join(second))
        z.writestr("archive/c.warc.gz", b"".join(packed))
        z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(lines).encode()))
    paths = spark.createDataFrame([(f"file://{tmp_path}/other.wacz", 1), (None, 2)], "path string, n int")
    got = {r["url"]: r for r in warc_zip.read_archives(paths).collect()}
    assert len(got) == 43 and all(r["page_id"] is None for r in got.values())
    one = got["http://a.org/1"]
    assert (one["record_type"], bytes(one["payload"]), one["payload_digest"], one["record_id"]) == ("response", b"hello world", digest, "<urn:x:http://a.org/1>")
    assert bytes(got["http://b.org/z"]["payload"]) == b"raw bytes" and got["http://b.org/1"]["refers_to_id"] == one["record_id"] and got["http://b.org/1"]["payload"] is None
    assert all(bytes(got[f"http://c.org/{i}"]["payload"]) == b"p%d" % i * 50 for i in range(40))
    with zipfile.ZipFile(tmp_path / "deflated.zip", "w") as z:
        z.writestr("archive/a.warc.gz", b"x" * 99, zipfile.ZIP_DEFLATED)
    with pytest.raises(Exception, match="not stored"):
        warc_zip.read_archives(spark.createDataFrame([(f"file://{tmp_path}/deflated.zip",)], "path string")).count()


def test_ranges_are_merged_and_dealt_by_bytes(spark, monkeypatch):
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    archives = warc_zip.write_archives(pages.coalesce(1))
    parts = warc_zip.index_parts(archives).collect()
    assert len(parts) == 1 and len(parts[0]["offsets"]) == 600 and parts[0]["bytes"] == archives.first()["n_bytes"]
    monkeypatch.setattr(warc_zip, "RANGE_BYTES", 20_000)
    monkeypatch.setattr(warc_zip, "TASK_BYTES", 30_000)
    many = warc_zip.index_parts(archives).collect()
    assert len(many) > 5 and max(r["bytes"] for r in many) <= 20_000 and sum(len(r["offsets"]) for r in many) == 600
    records = warc_zip.read_archives(archives)
    assert records.rdd.getNumPartitions() >= archives.first()["n_bytes"] / 30_000 and records.where("payload is not null").count() == 600


def test_common_payloads_are_spread(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "COMMON", 5)
    rows = [(i, "u", "same" if i % 2 else f"p{i // 4}") for i in range(60)] + [(None, "u", "same")]
    got = {r["page_id"]: r["refers_to"] for r in warc_zip.read_archives(warc_zip.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    first = {}
    for i, _, h in rows[:-1]:
        first.setdefault(h, i)
    assert got == {**{i: None if first[h] == i else first[h] for i, _, h in rows[:-1]}, None: None}


def test_directory_reads_what_zipfile_writes():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"first")
        with z.open(zipfile.ZipInfo("b"), "w", force_zip64=True) as f:
            f.write(b"second")
        z.comment = b"PK\x05\x06 in a comment"
    raw = out.getvalue()
    got = {m.name: raw[m.start : m.start + m.size] for m in members(lambda at, n: raw[at : at + n], len(raw))}
    assert got == {"a": b"first", "b": b"second"}


def test_zip64_directory():
    name, data = b"big", b"payload"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, 20) + name + struct.pack("<HHQQ", 1, 16, 7, 7)
    extra = struct.pack("<HHQQQ", 1, 24, 7, 7, 0)
    entry = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = len(local) + len(data)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    raw = local + data + entry + end64 + struct.pack("<4sIQI", b"PK\x06\x07", 0, start + len(entry), 1) + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    (got,) = members(lambda at, n: raw[at : at + n], len(raw))
    assert (got.name, raw[got.start : got.start + got.size]) == ("big", data)
    with pytest.raises(ValueError):
        members(lambda at, n: raw[at : at + n], 10)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(theta=THETA, **load_pieces())


def segmentations(v, text):
    if not text:
        return [((), 0.0)]
    found = []
    for n in range(1, min(len(text), v.longest) + 1):
        if (i := v.known.get(text[:n])) is not None:
            found += [((i, *rest), v.log_weight[i] + w) for rest, w in segmentations(v, text[n:])]
    return found


@pytest.mark.parametrize("word", ["the", "order", "  x"])
def test_samples_follow_the_lattice(vocabulary, word):
    n = 20_000
    counts = Counter(tuple(x.tolist()) for x in Sampler(vocabulary)([word] * n, list(range(n))))
    every = segmentations(vocabulary, " " + word)
    total = sum(np.exp(w) for _, w in every)
    assert set(counts) <= {s for s, _ in every}
    for s, w in every:
        p = np.exp(w) / total
        assert abs(counts[s] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


def test_long_chunks_follow_the_lattice(vocabulary, monkeypatch):
    from helixframe.llm import piece_lattice

    short = Sampler(vocabulary)(["ordering thing"] * 50, list(range(50)))
    monkeypatch.setattr(piece_lattice, "LONG_CHUNK", 3)
    long = Sampler(vocabulary)(["ordering thing"] * 50, list(range(50)))
    assert [x.tolist() for x in short] == [x.tolist() for x in long]


def test_pieces_decode_to_the_text(spark, vocabulary):
    docs = table(spark)
    encoded = sample_pieces(docs)
    rows = encoded.collect()
    assert len(rows) == len(documents()) and all(r["lossless"] for r in rows)
    texts = Counter((i, t or "") for i, t, *_ in documents())
    assert Counter((r["doc"], r["text"]) for r in decode_pieces(encoded).collect()) == texts
    again = sample_pieces(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert sample_pieces(table(spark, [])).count() == 0
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = next(r for r in rows if r["doc"] == 11)
    assert library.decode(plain["ids"]) == "one two three"


def melody(seed, n=64):
    return audio_match.tones(np.random.default_rng(seed).normal(size=n))


def brute_offsets(a, b):
    found = audio_match.align(a, b, range(-len(b) + 1, len(a)))
    return found


def test_fingerprints_align_shifted_and_noisy_copies():
    rng = np.random.default_rng(8)
    x = chroma.samples(melody(1))
    a = chroma.fingerprint(x)
    b = chroma.fingerprint(x[20 * chroma.HOP :] + rng.normal(0, 0.02, len(x) - 20 * chroma.HOP))
    assert audio_match.align(a, b, [20])[1] < 0.05
    assert audio_match._Block([7], [a.tobytes()]).matches(b)[0][:2] == (7, 20)
    assert audio_match._Block([7], [a.tobytes()]).matches(chroma.fingerprint(chroma.samples(melody(2)))) == []


def test_bad_audio():
    assert len(chroma.samples(None)) == len(chroma.samples(b"no wave")) == len(chroma.fingerprint(np.zeros(10))) == 0
    assert len(chroma.samples(melody(3)[:60])) == 16  # what is left after 44 bytes of header


def test_matches_recall_brute_force(spark):
    rng = np.random.default_rng(9)
    base = [rng.normal(size=64) for _ in range(12)]
    vectors = [v for v in base] + [v + rng.normal(0, 0.04, 64) for v in base] + [base[0], None, []]
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    recordings = audio_match.sonified(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    prints = audio_match.fingerprints(recordings, "id", "audio")
    members_, matches = audio_match.match_recordings(prints, F.col("id") % 4 == 0, block_bytes=400, part_classes=5)
    members_ = {r["id"]: r["class_id"] for r in members_.collect()}
    assert members_[24] == members_[0] == 0 and members_[25] is None and members_[26] is None
    made = {r["id"]: np.frombuffer(r["fingerprint"], "<u4") for r in prints.collect()}
    classes = sorted({c for c in members_.values() if c is not None})
    asked = {members_[i] for i in members_ if i % 4 == 0 and members_[i] is not None}
    want = {(q, c) for q in asked for c in classes if q != c and brute_offsets(made[q], made[c])}
    got = {(r["class_id"], r["match_id"]) for r in matches.collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and want
    none = audio_match.match_recordings(prints.limit(0), F.col("id") % 4 == 0)
    assert none[0].count() == none[1].count() == 0


def test_matches_are_those_of_all_offsets():
    rng = np.random.default_rng(10)
    base = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (74, 74, 40, 5, 90)]
    made = []
    for e in (0.1, 0.15, 0.19, 0.2, 0.21):
        for b in base:
            flips = np.packbits(rng.random((len(b), 32)) < e, axis=1).view("<u4")[:, 0]
            made += [b ^ flips, np.roll(b, 9) ^ flips, (b ^ flips)[: 1 + len(b) // 2]]
    # A loop of four integers: its first offsets overlap too little or are worse than a later one.
    loop = np.tile(rng.integers(0, 2**32, 4, dtype=np.uint32), 20)
    prints = [*base, loop, loop[:50] ^ np.uint32(1), *made]
    block = audio_match._Block(list(range(7)), [p.astype("<u4").tobytes() for p in prints[:7]])
    want = {(r, q, *hit) for r, b in enumerate(prints) for q in range(7) if (hit := brute_offsets(prints[q], b))}
    assert set(block.all_matches(prints)) == want and len(want) > 50


def test_copies_of_one_recording_are_one_class(spark, monkeypatch):
    monkeypatch.setattr(audio_match, "LARGE_CLASSES", 4)
    rows = [(i, melody(1)) for i in range(10)] + [(20 + i, melody(2 + i % 3)) for i in range(6)] + [(30, None), (None, melody(1))]
    prints = audio_match.fingerprints(spark.createDataFrame(rows, "id long, audio binary"), "id", "audio")
    members, matches = audio_match.match_recordings(prints, F.col("id") % 50 == 0)
    assert sorted((r["id"], r["class_id"]) for r in members.collect() if r["id"] is not None) == [(i, 0) for i in range(10)] + [(20 + i, 20 + i % 3) for i in range(6)] + [(30, None)]
    assert {r["class_id"] for r in matches.collect()} <= {0}


def test_every_number_is_heard():
    assert len(chroma.samples(audio_match.tones(np.ones(100)))) == 100 * audio_match.NOTE_SAMPLES
