"""Cross-tokenizer alignment, quality by neighbours and hard negatives against plain forms."""

import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import hard_negatives, kernel, quality, token_alignment
from tidewater.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

# -- alignment ---------------------------------------------------------------------------------------


def plain_alignment(texts):
    """Of each text: n_a, n_b, groups, n_links, n_best, count_sum, digest."""
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    tb = sentencepiece.SentencePieceProcessor(model_file=B)
    piece = lambda i: bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode()
    found, documents = [], Counter()
    for text in texts:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in ta.id_to_token(i)) for i in a]
        bytes_b = [piece(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append(([], [], [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in both]
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, e in zip(ids, ends, strict=True):
                groups[bisect.bisect_left(both, e)][side].append(i)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        documents.update(set(links))
        found.append((a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in documents.items():
        top[x] = max(top[x], n)
    out = []
    for a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if documents[p] == top[p[0]])
        total = sum(n * documents[p] for p, n in links.items())
        out.append((len(a), len(b), len(groups), sum(links.values()), best, total, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def odd_texts():
    rng = random.Random(11)
    signs = "ab cd  é ß中文 \t\n\x00<|endoftext|> <s> ▁  =====-- 🙂 🏳️‍🌈 12345 don't ﬁ Ǆ ́"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["", " ", "  ", "x", "<|endoftext|>", "</s><unk>", "▁", "a▁b", "=" * 999, " " * 77, "x" * 3000, "the end " * 400, "中" * 500, "🙂" * 99]
    white = [" ", "\t", "\n", "\x0b", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "\ufeff", "▁", "é", "a", ".", "1", "'s"]
    texts += ["".join(rng.choice(white) if rng.random() < 0.6 else " " for _ in range(30)) for _ in range(250)]
    return texts + texts[-5:]


def digest_rows(spark, texts, **how):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(3)
    out = token_alignment.scored(token_alignment.alignments(rows.select(F.struct("i", "text").alias("row")), A, B), **how)
    got = {r.i: tuple(r)[1:] for r in out.select("row.i", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("hot", [1, 40, 1 << 17])
def test_alignment_of_odd_texts(spark, hot):
    texts = odd_texts()
    assert digest_rows(spark, texts, hot_pairs=hot) == plain_alignment(texts)


def test_alignment_query(spark, sf, documents):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_token_alignment"](spark, sf).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert [got[r.doc_id] for r in rows] == plain_alignment([r.text or "" for r in rows])


def test_alignment_where_hashes_collide_and_the_memo_is_small(monkeypatch):
    texts = odd_texts()
    column = pa.array(texts)
    want = plain_alignment(texts)

    def digests():
        aligner = token_alignment.Aligner(A, B)
        out = []
        for _, _, data, offsets in kernel.text_slices(column):
            out += aligner.texts(data, offsets).digests
        return out

    assert digests() == [w[-1] for w in want]
    monkeypatch.setattr(token_alignment, "run_hashes", lambda mixed, starts, ends: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(token_alignment, "MEMO_CHUNKS", 2)
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 3)
    monkeypatch.setattr(token_alignment, "OFTEN", 1)
    monkeypatch.setattr(token_alignment, "SMALL_GROUP", 5)
    assert digests() == [w[-1] for w in want]


def test_alignment_gives_groups_and_handles_awkward_rows(spark, awkward, clashing, nothing):
    rows = clashing.select(F.struct("*").alias("row"))
    out = token_alignment.scored(token_alignment.alignments(rows, A, B, groups=True))
    assert {"row", "groups", "n_best"} <= set(out.columns)
    got = Counter((r.row.doc_id, r.groups_sha256) for r in out.collect())
    texts = [(r.doc_id, r.text or "") for r in awkward.collect()]
    assert got == Counter((d, w[-1]) for (d, _), w in zip(texts, plain_alignment([t for _, t in texts]), strict=True))
    for r in out.collect():
        text = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if r.n_a else "")
    assert token_alignment.scored(token_alignment.alignments(nothing.select(F.struct("*").alias("row")), A, B)).count() == 0


# -- quality -------------------------------------------------------------------------------------------


def plain_terms(text):
    """Columns and counts of one text, word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    kind = lambda b: 65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b
    shapes = []
    for w in words:
        kinds = [kind(b) for b in w.encode()]
        shapes.append(bytes(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k))

    def hashed(data):
        x = np.frombuffer(data, np.uint8)
        total = (kernel.BYTE_MIX[x] * kernel.powers(kernel.BASE, len(x))).sum(dtype=np.uint64)
        return kernel.mix(np.array([total]))

    n = quality.DIMENSIONS - quality.LEVELS
    out = Counter()
    for w, s in zip(words, shapes, strict=True):
        out[quality.LEVELS + int(kernel.mix(hashed(w.encode()))[0] % np.uint64(n))] += 1
        out[quality.LEVELS + int(kernel.mix(hashed(s) + np.uint64(1))[0] % np.uint64(n))] += 1
    if words:
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
        known = 1 - len(set(words)) / len(words)
        for k, v in enumerate(quality.REPEATED):
            out.update({k: quality.LEVEL_COUNT} if again > v else {})
        for k, v in enumerate(quality.KNOWN):
            out.update({len(quality.REPEATED) + k: quality.LEVEL_COUNT} if known > v else {})
    return dict(out)


def test_terms_are_those_counted_word_by_word(awkward):
    texts = [r.text for r in awkward.collect()] + ["a a a b", "Über!! über 12ab,3", "x  x\n\ny", "of Of of", "&&& and&&& AND!!"]
    rows = []
    for t in quality.terms(pa.array(texts)):
        for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True):
            rows.append(dict(zip(t.columns[a:b].tolist(), t.counts[a:b].tolist(), strict=True)))
    assert rows == [plain_terms(t or "") for t in texts]


def test_votes_against_one_by_one():
    rng = np.random.default_rng(5)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    known, z = unit(rng.standard_normal((60, 8))).astype(np.float32), unit(rng.standard_normal((40, 8))).astype(np.float32)
    known[7] = known[8] = known[9]
    labels = rng.integers(0, 2, 60).astype(float)
    model = quality.Model(np.ones(8, np.float32), np.eye(8, dtype=np.float32), np.ascontiguousarray(known.T), labels, labels.mean())
    for row, got in zip(z, model._votes(z), strict=True):
        near = sorted(((max(0.0, float(row @ k)), y) for k, y in zip(known, labels, strict=True)), reverse=True)
        near = [x for x in near if x[0] >= near[quality.NEIGHBOURS - 1][0]]
        weights = [s**quality.POWER for s, _ in near]
        good = sum(w * y for w, (_, y) in zip(weights, near, strict=True))
        assert got == pytest.approx((good + quality.PRIOR * labels.mean()) / (sum(weights) + quality.PRIOR), abs=1e-4)
    assert model._votes(np.zeros((1, 8), np.float32)) == pytest.approx(labels.mean())


def test_space_holds_the_leading_directions(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words[: 300 if i % 2 else 30]) for _ in range(40)), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(df, df.select("doc_id", "quality"), rank=8)
    (t,) = quality.terms(pa.array([r[1] for r in rows]))
    x = t.dense(0, len(rows), model.idf).astype(float)
    best = (np.linalg.svd(x, compute_uv=False)[:8] ** 2).sum()
    assert (np.linalg.norm(x @ model.space, axis=0) ** 2).sum() > 0.97 * best
    assert model.vectors.shape == (8, 200)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op12_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, labels[d]) for d, r in got.items() if r.held_out and d in labels]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert sum(p == y for p, y in held if y == 0) / sum(y == 0 for _, y in held) > 0.75


def test_quality_of_awkward_rows(spark, awkward, clashing, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 1), (9, 0), (9, 1), (12, 0), (None, 1), (14, None), (99, 1), (15, 7)], "doc_id long, quality int")
    rows = clashing.select(F.struct("*").alias("row"))
    out = quality.rate(rows, quality.fit(clashing, labels)).collect()
    assert len(out) == awkward.count() and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if not (r.row.text or "").strip()}
    assert len(empty) == 1 and 0 < empty.pop() < 1
    assert len({r.score for r in out}) <= len({r.row.text for r in out})
    good = quality.rate(rows, quality.fit(awkward, labels.filter("quality = 1"))).collect()
    assert {r.score for r in good} == {1.0}
    none = quality.rate(rows, quality.fit(awkward, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.0}
    assert quality.rate(nothing.select(F.struct("*").alias("row")), quality.fit(nothing, labels)).count() == 0


# -- hard negatives --------------------------------------------------------------------------------------


def plain_negatives(rows, every=10):
    """(anchor, positive, rank, negative, positive score, negative score) of (id, label, vector)."""
    rows = sorted({(i, y, tuple(v)) for i, y, v in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=False))
    out = []
    for i, y, v in rows:
        if i is None or i % every:
            continue
        scored = [(-dot(v, w), j is None, j or 0, j, z) for j, z, w in rows if j != i]
        same = sorted(s for s in scored if s[4] == y)[:5]
        for p in same:
            fit = sorted(s for s in scored if s[4] != y and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0])[:10]
            out += [(i, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(fit)]
    return Counter(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, "id long, label long, v array<double>").repartition(3)
    out = hard_negatives.mine(df, F.pmod("id", F.lit(10)) == 0, **how)
    return Counter(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize(("block", "chunk"), [(1000, 1000), (37, 4)])
def test_hard_negatives(spark, block, chunk):
    rng = np.random.default_rng(block)
    rows = [(i, int(rng.choice([0, 0, 0, 1, 2])), np.floor(4 * rng.standard_normal(6)).tolist()) for i in range(300)]
    rows += rows[:20]  # repeated rows
    rows += [(1000 + i, i % 3, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(40)]  # ties
    rows += [(500, 1, []), (501, 2, [1.0, 2.0]), (None, 1, [3.0] * 6), (510, 4, [1.0] * 6), (520, 0, [0.0] * 6), (520, 1, [2.0] * 6)]
    got = mined(spark, rows, block_rows=block, chunk_rows=chunk)
    assert got == plain_negatives(rows) and len(got) > 300


def test_hard_negatives_of_large_numbers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, np.floor(2e8 * rng.standard_normal(3)).tolist()) for i in range(60)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_lists_are_not_read_to_their_ends(monkeypatch):
    rng = np.random.default_rng(3)
    m = np.floor(100 * rng.standard_normal((20_000, 3)))
    block = hard_negatives.Block.of(np.arange(20_000), np.zeros(20_000, int), m)
    scored = []
    monkeypatch.setattr(hard_negatives, "products", lambda m, v, most: scored.append(len(m)) or (m @ v).astype(np.int64))
    for v in ([3.0, -2.0, 1.0], [0.0, 0.0, -5.0], [1.0, 1.0, 0.0]):
        scored.clear()
        ((rows, scores),) = block.search(np.array(v), np.ones(20_000, bool), [None], [None], 5)
        s = m @ np.array(v)
        order = np.lexsort((np.arange(20_000), -s))[:5]
        assert rows.tolist() == order.tolist() and scores.tolist() == s[order].astype(int).tolist()
        assert sum(scored) < 6_000


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [1.0, -inf], 1), (6, [0.5, -0.001], None), (7, [0.001, -0.001], 9), (None, [1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit(1)).withColumn("v", F.lit("x"))
    got = {tuple(r)[:2] + (tuple(r.v),) for r in hard_negatives.vectors(df, label=hard_negatives.relabelled()).collect()}
    assert got == {(1, 1, (256.0, 512.0)), (7, 0, (0.0, -1.0)), (None, 3, (256.0,))}
    assert mined(spark, []) == Counter()
