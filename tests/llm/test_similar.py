"""Texts by Jaccard similarity against brute force."""

from __future__ import annotations

import numpy as np

from wicker.llm import similar, simhash


def kept_by_brute_force(texts: list[str], similarity: float = 0.8) -> set[int]:
    sets, parent = [set(simhash.shingle_hashes(t, 5)) for t in texts], list(range(len(texts)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if (len(x & y) / len(x | y) if x or y else 1.0) >= similarity:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i for i in parent if root(i) == i}


def edited(rng, words: list[str], n: int) -> list[str]:
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"edit{rng.integers(10**9)}"
    return out


def corpus(seed: int) -> list[str]:
    """Clusters around the limit, a large one, and unlike texts with a long passage in common."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"wort{i}" for i in range(3000)]
    draw = lambda n: list(rng.choice(vocabulary, n))
    texts = []
    for _ in range(30):
        words = draw(rng.integers(6, 200))
        texts += [words, *(edited(rng, words, max(1, int(len(words) * share))) for share in rng.uniform(0.005, 0.06, 4))]
    large = draw(150)
    texts += [edited(rng, large, 2) for _ in range(60)] + [edited(rng, large, 5) for _ in range(20)]
    passage = draw(120)
    texts += [passage + draw(n) for n in rng.integers(20, 60, 80)]  # from alike to unlike
    texts = [" ".join(t) for t in texts] + ["", "  ", "short one", "Short  ONE", "short two"]
    return [texts[i] for i in rng.permutation(len(texts))]


def test_similar_texts_exactly(spark, monkeypatch):
    for name, value in (("WIDEN", 5), ("CHUNK", 5), ("OFTEN", 2), ("FREQUENT", 40)):
        monkeypatch.setattr(similar, name, value)  # groups go through every step
    texts = corpus(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {r.doc_id for r in simhash.keep_one(df, similarity=0.8).collect()} == kept_by_brute_force(texts)


def test_many_similar_texts_are_all_found(spark):
    """More partners than a fingerprint's three nearest, far apart in fingerprint bits."""
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(60):
        words = [f"w{i}" for i in rng.integers(0, 5000, 40)]
        texts += [" ".join(words)] + [" ".join(edited(rng, words[:-1] + [f"x{k}"], 0)) for k in range(2)] + [" ".join([f"y{rng.integers(10**9)}", *words[1:]])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in simhash.keep_one(df, similarity=0.8).collect()} == kept_by_brute_force(texts)


def test_sets_and_lengths():
    for text in corpus(1)[:60] + ["A B c d E", "a b c d", "x " * 50, "\x1c É é \ud800"]:
        assert similar.shingle_set(text).tolist() == sorted(set(simhash.shingle_hashes(text, 5)))
    assert [similar.prefix_length(n, 0.8) for n in (0, 1, 4, 5, 6, 9, 10, 100)] == [0, 1, 1, 2, 2, 2, 3, 21]


def test_prefixes_share_a_shingle_in_any_order():
    rng = np.random.default_rng(2)
    last = np.sort(rng.integers(0, 500, 60).astype(np.uint64))
    for n in (1, 2, 5, 9, 10, 40, 100):
        x = np.unique(rng.choice(500, n, replace=False).astype(np.uint64))
        for gone in range(n // 5 + 1):
            y = np.unique(np.concatenate([rng.choice(x, n - gone, replace=False), rng.integers(500, 999, gone // 4).astype(np.uint64)]))
            if len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)):
                assert len(np.intersect1d(similar.prefix(x, last, 0.8), similar.prefix(y, last, 0.8)))


def test_fine_parities_tell_large_sets_apart_and_never_more_than_they_differ():
    rng = np.random.default_rng(4)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    bits = lambda x: np.frombuffer(similar.parities(x), np.uint64).reshape(1, -1)
    for n in (0, 1, 3, 500, 520, 4000, 70_000):
        x = draw(n)
        for y in (x, draw(n), x[: int(n * 0.81)], np.union1d(x, draw(n // 5))):
            apart = similar.bits_apart(similar.fine_parities(x), similar.fine_parities(y))
            assert apart == similar.bits_apart(similar.fine_parities(y), similar.fine_parities(x)) <= len(np.setxor1d(x, y))
    x, y = draw(4000), draw(4000)
    assert similar.may_be(bits(x), bits(y), np.array([8000]), 0.8).all()  # 1,024 bins are full
    assert not similar.near_enough(similar.bits_apart(similar.fine_parities(x), similar.fine_parities(y)), 8000, 0.8)


def test_few_edges_are_written_in_few_partitions(spark, monkeypatch):
    """A step of ``components`` costs files by its edges, not by the number of shuffle partitions."""
    parts, cut = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: parts.append((out := cut(df)).rdd.getNumPartitions()) or out)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "37"), strict=True):
            spark.conf.set(k, v)
        edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
        assert {r.root for r in simhash.components(edges).collect()} == {0}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(parts) > 4 and set(parts[1:]) == {1}


def test_candidates_grow_with_a_group_not_with_its_square(spark):
    made = []
    for n in (500, 4000):
        rows = spark.range(n).selectExpr("7L AS h", "xxhash64(id) AS s", "50L AS n")
        made.append(similar.places(similar.shared(rows), 1, 1, 0.8).count() / n)
    assert made == [499 / 500, 3999 / 4000]


def test_ids_that_are_no_whole_numbers_lose_no_document(spark):
    """Cut to whole numbers they were found in no row: every document of 1.25 and 1.75 went."""
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "One two THREE four five six", "a b c d e f g"]
    for kind, ids in (("double", [1.25, 1.75, 2.5, None]), ("decimal(5,2)", [1.25, 1.75, 2.5, 7.0]), ("string", ["b", "c", "x", None]), ("int", [1, 2, 3, None])):
        df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id string, text string" if kind == "string" else f"doc_id {kind if kind == 'int' else 'double'}, text string")
        df = df.withColumn("doc_id", df.doc_id.cast(kind))
        for similarity in (0.8, None):
            assert sorted(r.text for r in simhash.keep_one(df, similarity=similarity).collect()) == sorted([texts[0], texts[1], texts[3]]), (kind, similarity)
