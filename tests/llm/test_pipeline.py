import hashlib
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from helixframe.llm import mixing, near_dedup, quality_rules
from helixframe.llm.line_dedup import dedup_lines
from helixframe.llm.piece_lattice import Sampler, Vocabulary
from helixframe.llm.sentencepiece_sampling import THETA, decode_pieces, load_pieces, row_seed
from helixframe.operators.graph import UnionFind

from .fixtures import documents
from .test_near import shingles
from .test_quality import brute, brute_bands

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    """Prose of three sources and of none, near and exact copies, shared lines, junk, nulls, a very long text; columns clash."""
    rng = np.random.default_rng(21)
    words = ["".join(rng.choice(list("etaoinshrdlucmfwyp"), rng.integers(2, 9))) for _ in range(3000)]
    prose = lambda n: "\n".join(" ".join(rng.choice(words, 12)) for _ in range(n // 12))
    rows = [(i, prose(240), None, ["a", "a", "b", "ç", None][i % 5]) for i in range(30)]
    near = rows[3][1].split()
    near[40] = "changed"
    rows += [(40, rows[0][1], "x", "b"), (41, rows[0][1], "x", "a"), (42, " ".join(near), "x", "a"), (42, " ".join(near), "x", "a")]
    rows += [(50 + i, prose(120) + "\nA license line that many documents share\n" + prose(120), "x", "b") for i in range(4)]
    rows += [(60, None, None, "a"), (61, "", None, None), (62, "###$$$ " * 80, "x", "b"), (None, prose(200), "x", "b"), (63, prose(20_000), "x", "ç"), (64, prose(400) + " ab" * 2500, "x", "a")]
    return [(i, t, lang, source, None if k % 4 == 0 else len(t or ""), k, "d", 1.0) for k, (i, t, lang, source) in enumerate(rows)]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, doc long, node string, `__doc` double"


def plain_quality(rows):
    def kept(text):
        base, (_, _, _, inside) = brute(text), brute_bands(text.encode())
        return base[0] >= 10 and 100 * base[4] <= 20 * base[0] and inside

    return [r for r in rows if kept(r[1] or "")]


def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    first = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n") if i is not None else ():
            k = key(line)
            if len(k) >= 10:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, text, lang, source, n, *rest in rows:
        left = [x for x in (text or "").split("\n") if i is None or len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, "\n".join(left), lang, source, len("\n".join(left)), *rest))
    return out


def plain_near(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    groups = UnionFind()
    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            both = len(s & t)
            if s and t and 100 * both >= 80 * (len(s) + len(t) - both):
                groups.union(i, j)
    return [r for r in rows if r[0] is None or groups.find(r[0]) == r[0]]


def plain_mix(rows):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in names}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, free = {}, list(names)
    while free:
        share = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in free)
        full = [s for s in free if share * weight[s] > 3 * total[s]]
        target |= {s: 3.0 * total[s] for s in full} or {s: share * weight[s] for s in free}
        free = [s for s in free if s not in target] if full else []
    out = []
    for s in names:
        order = sorted((hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), -1 if r[0] is None else r[0], n, k) for k, (n, r) in enumerate(zip(size, rows)) if r[3] == s)
        budget, before = int(target[s] + 0.5), 0
        for *_, n, k in order:
            part = max(0, min(n, budget - budget // max(total[s], 1) * total[s] - before))
            before += n
            out += [rows[k]] * (budget // total[s] + (2 * part >= n) if n else 0)
    return out


def plain_pieces(rows):
    vocabulary, seen, out = Vocabulary(theta=THETA, **load_pieces()), Counter(), []
    for i, text, *_ in rows:
        (ids,) = Sampler(vocabulary)([text], [row_seed(i, "pieces", seen[i, text])])
        seen[i, text] += 1
        out.append((str(i), tuple(ids.tolist())))
    return out


def test_stages_match_plain_python(spark, tmp_path):
    now = corpus()
    spark.createDataFrame(now, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    plain = [plain_quality, plain_lines, plain_near, plain_mix]
    for k, ((name, stage), again) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        before, now = now, again(now)
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        assert sorted(map(str, map(tuple, after.collect()))) == sorted(map(str, now)), name
        assert len(before) != len(now) or before != now, name
        after.write.parquet(f"{tmp_path}/after{k}")
        docs = spark.read.parquet(f"{tmp_path}/after{k}")
    found = corpus_pipeline.run(spark, str(tmp_path))
    rows = found.collect()
    assert sorted((str(r["doc_id"]), tuple(r["ids"])) for r in rows) == sorted(plain_pieces(now))
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in rows)
    assert Counter(r["text"] for r in decode_pieces(found).collect()) == Counter(r[1] for r in now)
    # Epochs of one document are segmented each in its own way.
    times = Counter(r[0] for r in now)
    assert any(n > 1 and len({tuple(r["ids"]) for r in rows if r["doc_id"] == i}) > 1 for i, n in times.items())


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0, name


def test_run_removes_what_stages_wrote(spark, tmp_path):
    spark.createDataFrame([r[:5] for r in corpus()][:12], COLUMNS.split(", doc long")[0]).write.parquet(f"{tmp_path}/documents.parquet")
    from helixframe.operators import shared

    before = set(shared._left)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert len(set(shared._left) - before) == 1


def test_stages_take_effect(spark, tmp_path):
    rows = [r[:5] for r in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, now, str(tmp_path))
        if k < 4:
            assert after.columns == docs.columns, name
        if name == "quality rules":
            assert after.count() == quality_rules.quality_statistics(now).where("kept").count()
        if name == "line dedup":
            want = sorted((r["doc_id"] or -1, r["kept_text"]) for r in dedup_lines(now).collect())
            assert sorted((r["doc_id"] or -1, r["text"]) for r in after.collect()) == want
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if name == "near-dedup":
            assert after.count() == near_dedup.near_duplicates(now).where("kept").count()
        if name == "mixing":
            assert after.count() == sum(r["copies"] for r in mixing.mix_sources(now).collect())
        after.write.parquet(str(tmp_path / f"stage{k}"))
        now = spark.read.parquet(str(tmp_path / f"stage{k}"))
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.drop("ids").collect())) == sorted(map(str, now.drop("ids").collect()))
    assert run.where("not lossless").count() == 0


def test_near_stage_links_from_four_fifths(spark):
    rows = []
    for pair in range(12):
        words = [f"p{pair}w{i}" for i in range(100)]
        # Two words off: 86 of 106 shingles are common (0.81); three off: 81 of 111 (0.73).
        other = [f"z{w}" if i in ((20, 60) if pair < 9 else (20, 50, 80)) else w for i, w in enumerate(words)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {2 * pair for pair in range(12)} | {2 * pair + 1 for pair in range(9, 12)}
    assert near_dedup.drop_near_duplicates(docs).count() == 24  # op10_ keeps its 0.85
