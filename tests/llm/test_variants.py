"""Spelling variants, SimHash and whitening against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vacancia.llm import common, queries, simhash, spelling, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("word", "n", "entry", "list", "row", "form", "vec_id", "dims", "size", "x")


def clash(df):
    """The table with columns whose names the operators use inside."""
    return df.withColumns({c: F.lit(c) for c in CLASHING if c not in df.columns})


# --- spelling -----------------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def spell(rows):
    n: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def words_near(seed, docs=60):
    rng = random.Random(seed)
    letters = "aabé×cd"
    bases = ["".join(rng.choice(letters) for _ in range(rng.choice([5, 5, 6, 7, 12, 40]))) for _ in range(25)] + ["aaaaa", "aaaaaa", "a" * 600]
    rows = []
    for key in range(docs):
        words = []
        for _ in range(60):
            w = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1])] = rng.choice(["", "x", "ÿ"])
            words.append("".join(w))
        rows.append((key, rng.choice([" ", "-", ", "]).join(words)))
    return [*rows, *((docs + i, "chains " * 8 + "Chainss " * 3 + "chainsst") for i in range(3))]  # forms in a chain


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)  # long lists in several blocks
    monkeypatch.setattr(spelling, "TILE", 16)
    rows = words_near(seed)
    got = spelling.spelling_groups(clash(spark.createDataFrame(rows, "doc_id long, text string")))
    want = spell(rows)
    assert {tuple(r) for r in got.collect()} == want and max(r[4] for r in want) > 3 and any(r[2] not in (r[0], r[1]) for r in want)


def test_spelling_of_odd_rows(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(spelling, "LONG_TEXT", 100)
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert {tuple(r) for r in spelling.spelling_groups(docs).collect()} == spell(texts)
    assert spelling.spelling_groups(empty).count() == 0


def test_tiles_equal_pairs():
    rng = random.Random(5)
    held = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([5, 6]))) for _ in range(60)})
    lengths = np.array([len(w) for w in held])
    whole = slice(0, len(held))
    pre, suf = spelling.overlaps(held, lengths, whole, whole)
    for i, a in enumerate(held):
        for j, b in enumerate(held):
            if i != j:
                assert (pre[i, j] + suf[i, j] >= max(len(a), len(b)) - 1) == one_edit(a, b)
    long = ["x" * 700, "x" * 701, "y" + "x" * 699]
    pre, suf = spelling.overlaps(long, np.array([700, 701, 700]), slice(0, 3), slice(0, 3))
    assert (pre[0, 1], suf[0, 1], pre[0, 2], suf[0, 2]) == (700, 700, 0, 699)


# --- SimHash ------------------------------------------------------------------------------------


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words)] if 0 < len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(keys, prints):
    """The smallest key that links lead to, for each row."""
    n = len(keys)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(keys):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(n)]


def test_simhash_of_odd_rows(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    prints = [print_of(t) for _, t in texts]
    keys = [k for k, _ in texts]
    want = sorted(zip(keys, (f"{p:016x}" for p in prints), classes(keys, prints)), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(clash(docs)).collect()), key=repr) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("limit", [-1, common.BROADCAST_BYTES])
@pytest.mark.parametrize("longest", [4, 256])
def test_simhash_links_equal_brute_force(spark, monkeypatch, longest, limit):
    """Fingerprints in dense clusters, by both kinds of lists and both kinds of joins."""
    monkeypatch.setattr(simhash, "LIST", longest)
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(longest)
    prints = [0, 3, (1 << 64) - 1]
    for _ in range(12):
        base = rng.getrandbits(64)
        prints += [base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.choice([0, 63])) for _ in range(25)]
    prints = list(dict.fromkeys(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash._search(simhash._index(spark.createDataFrame(signed, "entry long")), 5).collect()
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in edges:
        a, b = a % (1 << 64), b % (1 << 64)
        root[find(a)] = find(b)
    want = classes(list(range(len(prints))), prints)
    got = {}
    for i, p in enumerate(prints):
        got.setdefault(find(p), i)
    assert [got[find(p)] for p in prints] == want


# --- whitening ----------------------------------------------------------------------------------


def whitened(rows):
    """What the contract asks for, of rows of one length, by a dense eigensolver."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    keep = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:32]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return n, deviations, centred @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def held_against(spark, rows, extra=()):
    table = spark.createDataFrame([*rows, *extra], "vec_id long, embedding array<float>")
    got = whitening.whiten(clash(table).drop("vec_id_").repartition(3)).toPandas()
    n, deviations, white, explained = whitened([r for r in rows])
    k = white.shape[1]
    assert len(got) == len(rows) * k and set(got["n"]) == {n} and got["identity_error"].max() <= 1e-9
    wide = got.sort_values("component").groupby("vec_id")["whitened"].apply(list)
    matrix = np.array([wide[key] for key, _ in rows])
    signs = np.sign((matrix * white).sum(0))
    assert np.abs(matrix * signs - white).max() < 1e-7
    assert np.abs(got.drop_duplicates("component").sort_values("component")["explained"] - explained).max() < 1e-12
    assert got.drop_duplicates("vec_id").set_index("vec_id").loc[[key for key, _ in rows], "deviation"].tolist() == deviations


def test_whitening_equals_dense_solver(spark):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((40, 40)) * np.geomspace(1, 1e-2, 40)
    rows = [(i, [float(v) for v in np.float32(4 * rng.standard_normal(40) @ mix)]) for i in range(300)]
    odd = [(900, None), (901, [None] * 40), (902, [math.nan] * 40), (903, [math.inf] + [0.0] * 39), (904, []), (905, [1.0, 2.0])]
    held_against(spark, rows, odd)


def test_whitening_of_few_directions(spark):
    """Vectors in a plane: two components, however many dimensions."""
    rng = np.random.default_rng(4)
    plane = np.array([[1.0] * 8, [1, -1] * 4])
    held_against(spark, [(i, [float(v) for v in rng.integers(-9, 9, 2) * [1, 3] @ plane]) for i in range(50)])


def test_whitening_of_equal_deviations(spark):
    """Every dimension varies alike: all components share one eigenvalue, which single chains find once."""
    rows = [(i * 2 + s, [(1.0 if s else -1.0) if d == i else 0.0 for d in range(6)]) for i in range(6) for s in (0, 1)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert set(got["component"]) == set(range(1, 7)) and got["identity_error"].max() < 1e-9
    assert np.abs(got["explained"] - 1 / 6).max() < 1e-12


def test_whitening_without_deviation(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    keyless = [(None, [0.0, 1.0]), (3, [5.0, 1.0]), (3, [5.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(keyless, schema)).collect()
    assert sorted(((r.vec_id, r.component, r.n) for r in got), key=repr) == [(3, 1, 3), (3, 1, 3), (None, 1, 3)]


def test_whitening_of_huge_entries(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 0.0]), (3, [3e38, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None for r in got)


@pytest.mark.parametrize("name, keys", [("op11_spelling", {"word", "form", "root", "n", "n_near", "form_n"}), ("op12_simhash", {"doc_id", "fingerprint", "component_id"}),
                                        ("op13_whitening", {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"})])
def test_queries(spark, sf, name, keys):
    got = queries.QUERIES[name](spark, sf)
    assert set(got.columns) == keys and got.count() > 0
