"""Joins and dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.llm import exact_dedup, fingerprints, ngram_join, trie

BLANK = r"[\x20\x09-\x0D]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute(rows):
    """(key, size, class, links) of each row."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, queue = {i}, [i]
        for x in queue:
            for y in linked[x]:
                if y not in seen:
                    seen.add(y)
                    queue.append(y)
        keys = [rows[x][0] for x in seen if rows[x][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(keys, default=None), len(linked[i])))
    return sorted(out, key=repr)


def planted(seed, docs=150):
    """Near copies of a few texts, some with a common passage."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(4000)}"
    common = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.choice([6, 30, 120, 300]))] for _ in range(12)]
    rows = []
    for key in range(docs):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.3:
            words += common
        rows.append((key, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)  # several blocks to a hub
    rows = planted(seed)
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_join_of_odd_rows(docs, texts, empty):
    assert sorted(map(tuple, ngram_join.similar_documents(docs).collect()), key=repr) == brute(texts)
    assert ngram_join.similar_documents(empty).count() == 0


def test_keep_one(docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 5, 6, 7, 8, 10, 11, 12, 13]


def test_keep_one_judges_texts_of_a_repeated_key_apart(spark):
    base, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, base), (2, base), (2, other), (2, other), (2, None), (3, other)]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, base), (2, other), (2, None)], key=repr)


def test_keep_one_with_any_column_names(spark):
    base, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, base), (2, base), (3, other), (3, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("dropped", "row", "of_key", "of_text", "name", "key", "component_id", "n", "count", "least"):
        docs = docs.withColumn(name, F.lit(name))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, base), (3, other)]


def test_trie_equals_pairwise():
    rng = np.random.default_rng(3)
    sets = [np.unique(np.concatenate([rng.choice(60, 40), rng.choice(2000, k)])) for k in (0, 1, 5, 20, 30) * 8]
    sizes = np.array([len(s) for s in sets])
    got = {(i, j) for i, found in trie.overlaps(sets, sizes, sets, sizes) for j in found.tolist()}
    want = {
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets)
        if 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    }
    assert got == want


def test_exact_duplicates(docs, texts, empty):
    got = sorted(map(tuple, exact_dedup.exact_duplicates(docs).collect()), key=repr)
    norm = [re.sub(BLANK, "", t or "") for _, t in texts]
    order = sorted(range(len(texts)), key=lambda i: (-len(texts[i][1] or ""), texts[i][0] is None, texts[i][0] or 0))
    first: dict = {}
    for i in order:
        first.setdefault(norm[i], i)
    want = [
        (k, texts[first[n]][0], norm.count(n), first[n] == i, hashlib.sha256(n.encode()).hexdigest())
        for i, ((k, _), n) in enumerate(zip(texts, norm))
    ]
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_radix_levels(spark):
    """Texts that part at the edges of the levels, and prefixes of each other."""
    rows = [(i, "ab" * 200 + "x" * n + end) for i, (n, end) in enumerate((n, e) for n in (0, 1, 31, 32, 33, 287, 288, 2500) for e in ("", "", "é", "z"))]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {}
    for k, t in rows:
        want.setdefault(t, []).append(k)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(k, min(want[t]), len(want[t])) for k, t in rows}


def test_neighbours(docs, texts, empty):
    got = {r.doc_id: r for r in fingerprints.compare_neighbours(docs).collect() if r.doc_id != 12}
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    for i, (key, text) in enumerate(order):
        if key == 12:
            continue
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r = got[key]
        own, new, after = fingerprints.signature_sets([text.encode(), edited.encode(), following.encode()])
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.to_text(own), fingerprints.to_text(new))
        jaccard = lambda a, b: len({*a} & {*b}) / len({*a} | {*b}) if len(a) + len(b) else 1.0
        assert (r.near_edited, r.near_next) == (jaccard(own.tolist(), new.tolist()), jaccard(own.tolist(), after.tolist()))
    assert fingerprints.compare_neighbours(empty).count() == 0
    assert len(got) == len(texts) - 2


def test_signatures_by_hand():
    """An anchor's chain is its next content words; the start of a text is an anchor."""
    a, b, c = fingerprints.signature_sets([b"the cat sat down", b"The  cat, sat down!", b"cat sat down the"])
    assert a.tolist() == b.tolist() and len(a) == 2
    assert len(set(a.tolist()) & set(c.tolist())) == 1  # the chain from the start
