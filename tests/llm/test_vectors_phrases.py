"""Whitening, exact search and phrase mining against plain versions, on random and on odd tables."""

import re
from collections import Counter

import numpy as np
import pytest
from llm_tables import LONG
from pyspark.sql import functions as F

from riskfeat.llm import collocations, exact_topk, whitening

VECTORS = "vec_id long, embedding array<double>, label int"


def made(n, dims, seed, rank=None):
    rng = np.random.default_rng(seed)
    basis = rng.normal(size=(rank or dims, dims))
    return rng.normal(size=(n, rank or dims)) @ basis * 0.1


def vector_table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS)


ODD = [
    (900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 0.0, 0.0]),
    (905, [1e12, 0.0, 0.0]),
]


# -- whitening


def whole(v):
    return np.floor(1024 * np.asarray(v)).astype(np.int64) + 100_000


def check_whitening(got, rows, components):
    x = np.array([whole(v) for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(got) == n * components and set(by_row) == {i for i, _ in rows}
    for (i, _), one, d in zip(rows, x, centred):
        for c in range(1, components + 1):
            r = by_row[i][c]
            assert r["n"] == n and r["deviation"] == sum(int(e) ** 2 for e in n * one - sums)
            assert abs(abs(r["whitened"]) - abs(d @ vectors[:, c - 1]) / np.sqrt(values[c - 1])) < 1e-7
            assert abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-9
            assert r["identity_error"] < 1e-9


def test_whitening_equals_plain_eigenvectors(spark):
    rows = list(enumerate(made(300, 12, 1)))
    got = whitening.whitened_vectors(vector_table(spark, rows).repartition(5)).collect()
    check_whitening(got, rows, 8)
    signs = Counter()
    for r in got:
        signs[r["component"]] += r["whitened"]
    assert all(abs(s) < 1e-8 for s in signs.values())


def test_whitening_of_odd_rows(spark):
    rows = list(enumerate(made(40, 3, 2)))
    df = vector_table(spark, rows + ODD + [(906, [1.0, 2.0])]).withColumn("n", F.lit("x")).withColumn("component", F.lit(7))
    check_whitening(whitening.whitened_vectors(df).collect(), rows, 3)


def test_whitening_without_variance(spark):
    df = vector_table(spark, [(1, [0.5, 0.25])] * 4)
    assert whitening.whitened_vectors(df).collect() == []
    assert whitening.whitened_vectors(df.limit(0)).collect() == []
    assert whitening.whitened_vectors(vector_table(spark, ODD[:5])).collect() == []
    # two rows span one component; an id may be NULL or occur twice
    two = whitening.whitened_vectors(vector_table(spark, [(None, [0.5, 0.25]), (3, [0.0, 0.25]), (3, [0.0, 0.25])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in two) == [(0, 1), (3, 1), (3, 1)]


def test_deviations_beyond_64_bits(spark):
    got = whitening.whitened_vectors(vector_table(spark, [(1, [1e6, 0.0]), (2, [-1e6, 0.0]), (3, [0.0, 0.0])])).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {1: None, 2: None, 3: 0}


@pytest.mark.parametrize("dims, rank", [(1, 1), (7, 7), (20, 6), (33, 33)])
def test_factor_and_rotations(dims, rank):
    a = made(200, dims, dims, rank)
    matrix = a.T @ a
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape[1] == rank
    assert np.allclose(factor @ factor.T, matrix, rtol=0, atol=1e-10 * np.trace(matrix))
    values, vectors = whitening.one_sided_jacobi(factor)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-9, atol=1e-12 * values[0])
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-10 * values[0])


def test_rounds_meet_every_pair_once():
    for n in (1, 2, 5, 8):
        met = Counter()
        for a, b in whitening._rounds(n):
            assert len({*a, *b}) == 2 * len(a)
            met.update(zip(a.tolist(), b.tolist()))
        assert met == Counter((i, j) for i in range(n) for j in range(i + 1, n))


# -- search


def plain_top(rows, asked, k):
    """Sorted (query_id, rank, vec_id, score)."""
    fits = [(i, np.floor(64 * np.asarray(v, dtype=float)).astype(int)) for i, v in rows]
    out = []
    for q, v in fits:
        if q in asked:
            near = [(-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in fits if i != q]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("numbers", [100, 1000, 10**6])
def test_search_equals_plain_search(spark, numbers):
    rows = list(enumerate(np.where(np.random.default_rng(3).random((230, 9)) < 0.6, 0, made(230, 9, 3))))
    df = vector_table(spark, rows).repartition(4)
    got = exact_topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k=7, block_numbers=numbers).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, set(range(0, 230, 20)), 7)


def test_search_with_ties_odd_rows_and_few_candidates(spark):
    rows = [(i, [0.5, 0.25, 0.0]) for i in range(60)] + [(60, [0.1, 0.1, 0.1]), (61, [0.5])]
    df = vector_table(spark, rows + ODD + [(None, [9.0, 9.0, 9.0])])
    df = df.withColumns({c: F.lit("x") for c in ("id", "w", "asked", "score", "rank")})
    assert sorted(map(tuple, exact_topk.nearest(df).collect())) == plain_top(rows, {0, 20, 40, 60}, 20)
    few = vector_table(spark, rows[:3])
    assert [tuple(r) for r in exact_topk.nearest(few).orderBy("rank").collect()] == [(0, 1, 1, 1280), (0, 2, 2, 1280)]
    assert exact_topk.nearest(few.limit(0)).collect() == [] == exact_topk.nearest(few.where("vec_id > 0")).collect()


def test_repeated_candidates_and_queries(spark):
    rows = [(0, [1.0]), (0, [1.0]), (0, [2.0]), (1, [1.0]), (1, [1.0]), (2, [0.5])]
    got = sorted(map(tuple, exact_topk.exact_top_k(vector_table(spark, rows), F.col("vec_id") == 0, k=3).collect()))
    one = [(0, 1, 1, 4096), (0, 2, 1, 4096), (0, 3, 2, 2048)]
    assert got == sorted(one + [(q, r, i, 2 * s) for q, r, i, s in one])


# -- phrases


def plain_collocations(rows, least, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        of = counts.setdefault(lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for size in range(1, 5):
                of.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        covered = set()
        for p, n in held.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    part = p[i : i + size]
                    if 100 * n >= 80 * f[part]:
                        covered.add(part)
        scored = []
        for p, a in held.items():
            if p not in covered:
                s, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def text_table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def random_texts(n, seed, words=30):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Über", "naïve", "漢字", "a.b", "x, y", "Two words"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    weights /= weights.sum()
    return [
        (["en", "de", None, "und"][i % 4], " ".join(rng.choice(vocabulary, p=weights, size=rng.integers(0, 60)))) for i in range(n)
    ]


@pytest.mark.parametrize("share", [0.0, 0.02, 0.3, 1.0])
def test_phrases_do_not_depend_on_the_sample(spark, share):
    rows = random_texts(120, 5)
    df = text_table(spark, rows).repartition(6)
    got = collocations.collocations(df, least=8, share=share)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 8)


def test_phrases_of_odd_tables(spark):
    rows = [("en", None), ("en", ""), ("en", " \t\n "), (None, LONG), ("de", "one two."), ("de", "one two."), ("de", "...")]
    df = text_table(spark, rows)
    df = df.withColumns({c: F.lit("x") for c in ("n", "size", "phrase", "hash", "a", "score", "draw")})
    assert sorted(map(tuple, collocations.collocations(df, least=2).collect())) == plain_collocations(rows, 2)
    assert collocations.collocations(df.where("false")).collect() == []
    assert collocations.collocations(df.drop("doc_id").where("lang = 'en'")).collect() == []


def test_phrases_of_one_language_are_cut_at_the_top(spark):
    rows = random_texts(80, 6, 200)
    got = collocations.collocations(text_table(spark, rows), least=2, top=15).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 2, 15)


def test_hashes_that_meet_do_not_join_phrases(monkeypatch):
    """With one hash for all longer phrases and a full bitmap the counts are those of all phrases."""
    monkeypatch.setattr(collocations, "_longer", lambda head, word: np.zeros(len(head), dtype=np.uint64))
    full = np.full(1 << (collocations.BITS - 3), 255, dtype=np.uint8)
    text = b"a b c a b d a b c a b.b c"
    got = {p: n for ps, _, ns in collocations.count_text(text, 1, full, 4) for p, n in zip(ps.to_pylist(), ns)}
    want = Counter()
    for t in text.decode().split("."):
        w = t.split()
        want.update(" ".join(w[i : i + s]) for s in range(1, 5) for i in range(len(w) - s + 1))
    assert got == {**want, "": 13}


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 16)
    rng = np.random.default_rng(7)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 40)).astype(np.uint8)) for _ in range(200)]
    gaps = [[b" ", b"\t  ", b". ", b".."][i] for i in rng.integers(0, 4, 200)]
    data = b" ." + b"".join(w + g for w, g in zip(words, gaps))
    hashes, pieces = collocations.word_hashes(data, 5)
    by_word = dict(zip(words, hashes))
    assert [by_word[w] for w in words] == list(hashes) and len(set(by_word.values())) == len(by_word)
    assert list(pieces) == list(1 + np.append(0, np.cumsum([g.count(b".") for g in gaps]))[:-1])
    assert len(collocations.word_hashes(b"", 5)[0]) == 0 == len(collocations.word_hashes(b" .\t. ", 5)[0])


def test_hashes_are_packed_and_added_up():
    rng = np.random.default_rng(8)
    hashes = rng.integers(0, 1 << collocations.COUNT_BITS, 5000).astype(np.uint64)
    hashes = np.concatenate([hashes, hashes[:3000], hashes[:7].repeat(50)])
    got = collocations._summed(hashes, np.ones(len(hashes), dtype=np.uint64), 30)
    want = Counter(hashes.tolist())
    assert dict(zip(*(x.tolist() for x in got))) == {h: min(n, 30) for h, n in want.items()}
    batch = collocations._ranges(*got, 6)
    back = [collocations.unpack(x) for x in batch.column("packed").to_pylist()]
    assert [np.concatenate(x).tolist() for x in zip(*back)] == [x.tolist() for x in got]
    assert sorted(set((got[0] >> np.uint64(34)).tolist())) == batch.column("range").to_pylist()
