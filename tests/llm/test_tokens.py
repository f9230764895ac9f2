"""Encoding, token files and packing against the public libraries."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vacancia.llm import bpe, packing, pretokens, token_files
from vacancia.llm.tokens import encode_texts, library_cache, merge, rank_table

RANKS, LIBRARY = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abstrevdlm'' \n\t 　1²é!?,-漢"), max_size=60), max_size=5))
def test_scan_finds_the_pattern(texts):
    want = [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    assert [[p.decode() for p in x] for x in pretokens.split([t.encode() for t in texts])] == want


@pytest.mark.parametrize("size", [63, 64, 65, 5000])
def test_scan_crosses_blocks(size):
    text = ("ab' x's  12" * size)[:size]
    assert [p.decode() for p in next(pretokens.split([text.encode()]))] == regex.findall(public_tokenizers.PATTERN, text)


def test_merge_of_a_long_piece(reference):
    for piece in ("a" * 3000, "abracadabra" * 200, "é" * 500):
        assert merge(rank_table(RANKS), piece.encode()) == reference.encode_ordinary(piece)


def test_library_ids_are_those_of_the_library(texts):
    library = Tokenizer.from_file(LIBRARY)
    library.encode_special_tokens = True
    plain = [t or "" for _, t in texts] + ["<|endoftext|> is text"]
    got = [np.frombuffer(b, "<u2").tolist() for b in encode_texts(library_cache(LIBRARY), [t.encode() for t in plain])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in plain]


SPELLED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "don't  <|endoftext|>'s \n<|endoftext", "é \t<|endoftext|>\n\n", ""]


def test_every_code_point_has_the_class_of_the_libraries(reference):
    """Before and behind letters, digits, apostrophes and white space."""
    library = Tokenizer.from_file(LIBRARY)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    texts = ["".join(f"{c}'s {c}'re1{c} {c}{c}a{c}\n" for c in map(chr, points[i : i + 4000])) for i in range(0, len(points), 4000)]
    pieces = [[p.decode() for p in found] for found in pretokens.split([t.encode() for t in texts])]
    assert all("".join(p) == t for p, t in zip(pieces, texts))
    known = {}  # ids of pieces, so that the rank merge runs once for each

    def ids(piece):
        if piece not in known:
            known[piece] = reference.encode_ordinary(piece)
        return known[piece]

    for text, found, whole in zip(texts, pieces, reference.encode_ordinary_batch(texts)):
        assert [i for p in found for i in ids(p)] == whole, hex(ord(text[0]))
    for text in texts[:20] + texts[-1:]:
        bounds = [p for p, _ in library.pre_tokenizer.pre_tokenize_str(text)]
        (own,) = pretokens.split([text.encode()])
        assert [len(b) for b in own] == [len(b) for b in bounds]


def test_added_tokens_are_cut_out_as_the_library_does(texts):
    library = Tokenizer.from_file(LIBRARY)
    plain = [t or "" for _, t in texts] + SPELLED
    cache = library_cache(LIBRARY, encode_special_tokens=False)
    got = [np.frombuffer(b, "<u2").tolist() for b in encode_texts(cache, [t.encode() for t in plain])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in plain]
    assert got[len(texts)] == [64, 220, 50256, 275]


def test_files_and_packing_hold_the_ids_of_added_tokens(spark):
    library = Tokenizer.from_file(LIBRARY)
    spelled = spark.createDataFrame(list(enumerate(SPELLED)), "doc_id long, text string")
    plain = [library.encode(t, add_special_tokens=False).ids for t in SPELLED]

    def crc(ids):
        return zlib.crc32(np.array(ids, "<u4").tobytes())

    files = token_files.read(spark, token_files.write(spelled, LIBRARY, end_id=2)).collect()
    starts = np.cumsum([0] + [len(x) + 1 for x in plain]).tolist()
    assert sorted(map(tuple, files)) == [(k, starts[k], len(x) + 1, crc([*x, 2])) for k, x in enumerate(plain)]
    packed = packing.pack(spelled, LIBRARY, end_id=0).collect()
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in packed) == [(k, len(x) + 1, crc([*x, 0])) for k, x in enumerate(plain)]


def test_round_trip(docs, texts, reference):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, RANKS).collect())
    want = []
    for key, text in texts:
        ids = reference.encode_ordinary(text or "")
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()), hashlib.sha256((text or "").encode())
        want.append((key or 0, len(ids), *(d.hexdigest() for d in digests)))
    assert got == sorted(want)


def test_decode_and_offsets(docs, texts):
    coded = bpe.encode(docs, RANKS)
    decoded = sorted((r.doc_id or 0, bytes(r.body)) for r in bpe.decode(coded, RANKS).collect())
    assert decoded == sorted((k or 0, (t or "").encode()) for k, t in texts)
    row = coded.filter("doc_id = 10").first()
    assert row.offsets[0] == 0 and row.offsets == sorted(row.offsets) and len(row.offsets) == len(row.ids)


def test_token_files(spark, docs, texts, reference):
    manifest = token_files.write(docs, LIBRARY, end_id=2)
    got = [tuple(r) for r in token_files.read(spark, manifest).orderBy("start").collect()]
    want, start = [], 0
    for key, text in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*reference.encode_ordinary(text or ""), 2], "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    found = [token_files.TokenFile(r.path).find(8) for r in manifest.collect()]
    assert [x.tolist() for x in found if x is not None] == [[*reference.encode_ordinary("one two"), 2]]


@pytest.mark.parametrize("key", [None, 7])
def test_rows_of_one_key_spread_over_files(spark, key):
    rows = [(key, f"text number {i}") for i in range(400)] + [(1, "first")]
    manifest = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), LIBRARY, end_id=2)
    assert manifest.count() > 2 and max(r.documents for r in manifest.collect()) < 200
    got = token_files.read(spark, manifest).orderBy("start").collect()
    assert len(got) == 401 and got[0].doc_id == 1 and all(r.doc_id == key for r in got[1:])
    assert [r.start for r in got[1:]] == np.cumsum([r.n_tokens for r in got])[:-1].tolist()


def test_empty_tables(spark, empty):
    assert bpe.round_trip(empty, RANKS).count() == 0
    assert token_files.read(spark, token_files.write(empty, LIBRARY, end_id=2)).count() == 0
    assert packing.pack(empty, LIBRARY).count() == 0


def test_packing_places_every_piece_once(docs, texts, reference):
    rows = packing.pack(docs, LIBRARY, size=256).collect()
    used: dict = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert total == sum(len(reference.encode_ordinary(t or "")) + 1 for _, t in texts)
    long = sorted((r for r in rows if r.doc_id == 11), key=lambda r: r.piece)
    assert [r.piece for r in long] == list(range(len(long))) and all(r.length == 256 for r in long[1:])


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_best_fit_is_best_fit(counts):
    """The moves fill as sequential best-fit decreasing does."""
    bins: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, gap in enumerate(bins) if gap >= length]
            if fits:
                bins[min(fits, key=lambda i: bins[i])] -= length
            else:
                bins.append(40 - length)
    moves = sorted(packing.best_fit(counts, 40))
    fill: dict = {}
    for m, (length, first, sequence, each, offset) in enumerate(moves):
        end = moves[m + 1][1] if m + 1 < len(moves) and moves[m + 1][0] == length else counts[length]
        for turn in range(end - first):
            fill.setdefault(sequence + turn // each, []).append((offset + turn % each * length, length))
    assert sorted(40 - sum(x for _, x in f) for f in fill.values()) == sorted(bins)
    for f in fill.values():
        at = 0
        for offset, length in sorted(f):
            assert offset == at
            at += length
