"""Token files, periodic runs and centroids against brute force, over awkward rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wicker.llm import centroids, packing, periodic, pretoken, token_counts, token_files

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
CRC = "start long, n_tokens long, ids_crc32 long"


@pytest.fixture(scope="session")
def given(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def thue_morse(a, b, n):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


# --- pre-tokens of one hash -----------------------------------------------------------


def test_pretokens_of_one_hash_keep_their_own_ids(spark):
    library = Tokenizer.from_file(VOCAB)
    texts = [t for a, b in (("q", "t"), ("a", "b"), ("e", "z")) for n in (512, 1024, 2048, 4096) for t in (thue_morse(a, b, n), thue_morse(b, a, n))]
    texts += [f"{a} and {b} {a}" for a, b in zip(texts[::2], texts[1::2], strict=True)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = packing.Encoder(pretoken.vocabulary(VOCAB))
    assert [x.tolist() for x in encoder.encode(texts)] == want  # in one batch
    assert [encoder.encode([t])[0].tolist() for t in texts] == want  # and alone
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 7):
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df.repartition(parts), VOCAB, 512).collect()}
        assert got == {i: len(w) for i, w in enumerate(want)}
        packed = packing.pack_documents(df.repartition(parts), VOCAB, packing.Limits(), keep_ids=True).collect()
        for i, w in enumerate(want):
            pieces = sorted((r.start, r.ids) for r in packed if r.doc_id == i)
            assert [x for _, ids in pieces for x in ids] == [*w, 1]


# --- 11 --------------------------------------------------------------------------


def files_of(df, tmp_path, **more):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(df, path, VOCAB, 2, **more)
    return path


def test_token_files_give_every_id_back(spark, docs, given, tmp_path):
    path = files_of(docs, tmp_path)
    library = Tokenizer.from_file(VOCAB)
    ids = {t: np.array([*e.ids, 2], "<u4") for t, e in zip([t for _, t in given], library.encode_batch([t for _, t in given], add_special_tokens=False), strict=True)}
    want = Counter((k, len(ids[t]), zlib.crc32(ids[t].tobytes())) for k, t in given)
    for mapped in (True, False):
        got = token_files.read_token_files(spark, path, token_files.ids_crc, CRC, mapped).collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
        at = 0  # ascending ids, nulls first, without gaps
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
        assert order == sorted(order, key=lambda k: (k is not None, k or 0))


def test_token_files_are_flat(spark, docs, tmp_path):
    path = files_of(docs, tmp_path)
    parts = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()
    docs_before = ids_before = 0
    for p in parts:
        assert (p.docs_before, p.ids_before, p.id_bytes) == (docs_before, ids_before, 2)
        only = lambda sub: next(x for x in os.scandir(f"{path}/{sub}/part={p.part}") if x.name.startswith("part-")).path  # noqa: B023, E731
        flat, offsets = np.fromfile(only("data/kind=ids"), "<u2"), np.fromfile(only("offsets"), "<u8")
        assert len(flat) == p.n_ids and len(offsets) == p.n_docs + 1
        assert offsets[0] == ids_before and offsets[-1] == ids_before + p.n_ids
        assert (flat[(offsets[1:] - offsets[0] - 1).astype(int)] == 2).all()
        docs_before, ids_before = docs_before + p.n_docs, ids_before + p.n_ids


def test_token_files_split_one_id_and_take_empty_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 4000)
    hot = spark.createDataFrame([(7, f"copy {i % 40} of one id, as long as it is") for i in range(900)] + [(-3, None), (9, "")], "doc_id long, text string").repartition(5)
    path = files_of(hot, tmp_path)
    sizes = [r.n_docs for r in spark.read.parquet(f"{path}/manifest").collect()]
    assert len(sizes) > 5 and max(sizes) < 400 and sum(sizes) == 902
    assert token_files.token_file_digests(hot.limit(0), str(tmp_path / "none"), VOCAB).count() == 0


def test_token_files_width():
    assert token_files.id_bytes(VOCAB, 2) == 2 and token_files.id_bytes(VOCAB, 50256) == 4
    with pytest.raises(ValueError):
        token_files.id_bytes(VOCAB, 1 << 24)


# --- 12 --------------------------------------------------------------------------


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(all(w[i + k] == w[i + k + p] for k in range(size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1 if j == i else j
    return sorted(out)


def brute_result(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_texts():
    rng = random.Random(3)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x " * 3000, "a b c " * 500 + "d " + "a b c " * 500, "é 漢字 é 漢字 é 漢字 é 漢字  "]
    for _ in range(300):
        n, k = rng.randrange(0, 400), rng.choice((1, 2, 3, 40))
        w = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randrange(4) if n else 0):
            a, p = rng.randrange(n), rng.randrange(1, 60)
            part = w[a : a + p]
            for i in range(a, rng.randrange(a, n + 1)):
                w[i] = part[(i - a) % len(part)]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("plant", [False, True])
def test_periodic_runs_against_brute_force(spark, docs, given, plant):
    rows = list(enumerate(periodic_texts())) + [(5, "a a a a a a a"), (5, "a a a a a a a"), (None, "b c b c b c b c"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = []
    for k, t in rows + [x for x in given if len(x[1]) < 20000]:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(b"" if k is None else str(k).encode())
        if plant and h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        want.append((k, *brute_result(w, brute_runs(w))))
    both = df.unionByName(docs.select("doc_id", "text").where("text IS NULL OR length(text) < 20000"))
    got = [tuple(r) for r in periodic.collapse_runs(both, plant).collect()]
    assert Counter(map(repr, got)) == Counter(map(repr, want))
    assert any(r[1] > 0 for r in got)


def test_periodic_runs_longer_than_any_tile(spark):
    words = [f"v{i}" for i in range(700)]
    rows = [(1, " ".join(["start", *words * 9, "end"])), (2, "z " * 50000), (3, " ".join(f"u{i}" for i in range(20000)))]
    got = {r.doc_id: r for r in periodic.collapse_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert tuple(got[1])[1:6] == (1, 1, 6300, 700, 9000)
    assert tuple(got[2])[1:6] == (1, 0, 50000, 1, 50000000)
    assert got[2].collapsed_sha256 == hashlib.sha256(b"z").hexdigest()
    assert got[3].n_runs == 0 and got[3].collapsed_sha256 == hashlib.sha256(rows[2][1].encode()).hexdigest()
    assert periodic.collapse_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tiles_without_repeats_go_no_further(spark):
    plain = spark.createDataFrame([(i, " ".join(f"w{i * j}" for j in range(1, 300))) for i in range(1, 50)], "doc_id long, text string")
    assert periodic.split_tiles(plain, False, "text", "doc_id").where("octave IS NOT NULL").count() == 0


# --- 13 --------------------------------------------------------------------------

SMALL = centroids.Settings(k=5, rounds=3, dim=6, scale=64, seed=1)


def brute_clusters(rows, s):
    v = [(k, [int(np.floor(s.scale * float(x))) for x in e]) for k, e in rows if e is not None and len(e) == s.dim and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(v, key=lambda r: (r[0] is None, hashlib.sha256(f"{s.seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [x for _, x in order[: s.k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for i in range(s.rounds + 1):
        own = [min(range(len(c)), key=lambda j: (dist(x, c[j]), j)) for _, x in v]
        if i < s.rounds:
            for j in range(len(c)):
                if mine := [x for (_, x), a in zip(v, own, strict=True) if a == j]:
                    c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    d = [dist(x, c[a]) for (_, x), a in zip(v, own, strict=True)]
    total = Counter()
    for a, x in zip(own, d, strict=True):
        total[a] += x
    return [(k, a, x, total[a], sum(d), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for (k, _), a, x in zip(v, own, d, strict=True)]


def vectors(seed, n, spread):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, 6))
    return [(i, (centre[rng.integers(5)] + rng.normal(size=6) * spread).astype("float32").tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,spread", [(0, 0.05), (1, 0.5), (2, 2.0), (3, 0.0)])
def test_clusters_against_brute_force(spark, seed, spread):
    rows = vectors(seed, 240, spread)
    nan, inf = float("nan"), float("inf")
    rows += [(0, rows[0][1]), (0, rows[1][1]), (None, rows[2][1]), (None, None), (900, []), (901, [1.0] * 5), (902, [1.0] * 7), (903, [nan] * 6), (904, [inf] + [0.0] * 5), (905, [None] + [0.0] * 5), (906, [0.0] * 6), (907, [-1000.5] * 6), (908, [40000.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS v", "'y' AS a", "1 AS d").repartition(3)
    got = [tuple(r) for r in centroids.cluster_vectors(df, SMALL).collect()]
    assert Counter(map(repr, got)) == Counter(map(repr, brute_clusters(rows, SMALL)))


def test_clusters_of_few_or_no_vectors(spark):
    two = [(1, [0.0] * 6), (2, [1.0] * 6)]
    df = spark.createDataFrame(two, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, centroids.cluster_vectors(df, SMALL).collect())) == sorted(brute_clusters(two, SMALL))
    one = centroids.cluster_vectors(df.limit(1), SMALL).collect()
    assert [(r.cluster, r.distance) for r in one] == [(0, 0)]
    assert centroids.cluster_vectors(df.limit(0), SMALL).count() == 0


def test_loosening_is_sound_and_below_full_drift():
    rng = np.random.default_rng(8)
    less = []
    for _ in range(300):
        old = rng.integers(-200, 200, (4, 5)).astype(float)
        new = old + rng.integers(-60, 60, (4, 5))
        radius = rng.uniform(0, 250, 4)
        loosen = centroids.loosening(old, new, radius)
        full = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(4):
            x = rng.normal(size=(400, 5))
            x = old[i] + x / np.linalg.norm(x, axis=1)[:, None] * radius[i] * np.append(np.ones(300), rng.uniform(size=100))[:, None]
            others = [j for j in range(4) if j != i]
            nearer = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in others)
            assert nearer <= loosen[i] + 1e-9
            assert loosen[i] <= full[others].max() * (1 + 1e-6)
            less.append(loosen[i] < 0.9 * full[others].max())
    assert np.mean(less) > 0.2


def test_settled_vectors_are_not_scanned():
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.integers(-20, 20, (500, 6)) + c for c in rng.integers(-400, 400, (4, 6))])
    old = np.array([v[i * 500 : i * 500 + 5].mean(0).astype(int) for i in range(4)])
    a, upper, lower = centroids.nearest(v, old)
    new = np.array([v[a == j].sum(0) // (a == j).sum() for j in range(4)])
    radius = np.array([upper[a == j].max() for j in range(4)])
    got, _, _, scanned = centroids.reassign(v, a, upper, lower, centroids.Round.after(old, new, radius))
    assert (got == centroids.nearest(v, new)[0]).all() and scanned < 100
