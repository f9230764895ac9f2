"""Token ids of many texts: pre-tokens by the scan, ids of each distinct pre-token from a cache."""

from __future__ import annotations

import base64
import functools
import heapq
import os
import re
from collections.abc import Callable, Iterator

from vacancia.llm.pretokens import split

#: Pre-tokens kept by a Python worker; a full cache starts anew. Bounds memory, not results.
CACHE_ENTRIES = 450_000


class PieceCache(dict):
    """Packed ids of a pre-token, computed at first sight."""

    def __init__(self, encode: Callable[[bytes], list[int]], width: int, added: dict[bytes, int] | None = None):
        """`added`: tokens that are cut out of a text before it is split into pre-tokens, and their ids."""
        super().__init__()
        self.encode, self.width = encode, width
        self.added = {t: i.to_bytes(width, "little") for t, i in (added or {}).items()}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.cutter = re.compile(b"(" + b"|".join(longest_first) + b")") if longest_first else None

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        packed = b"".join(i.to_bytes(self.width, "little") for i in self.encode(piece))
        if len(piece) <= 64:
            self[piece] = packed
        return packed


def encode_texts(cache: PieceCache, texts: list[bytes]) -> Iterator[bytes]:
    """Packed little-endian ids of each UTF-8 text."""
    look = cache.__getitem__
    if not cache.cutter:
        for pieces in split(texts):
            yield b"".join(map(look, pieces))
        return
    runs = [cache.cutter.split(text) for text in texts]  # [text, added token, text, ..., text]
    pieces = split([part for run in runs for part in run[::2]])
    for run in runs:
        ids = [b"".join(map(look, next(pieces)))]
        for token in run[1::2]:
            ids += cache.added[token], b"".join(map(look, next(pieces)))
        yield b"".join(ids)


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies, by its public rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.cache
def library_cache(path: str, encode_special_tokens: bool = True) -> PieceCache:
    """Ids by the tokenizers library: its byte-level BPE model, fed one pre-token at a time.

    The model never merges across pre-tokens, so the ids of a text are those of its pre-tokens.
    The library first cuts texts at the added tokens of the file, each of which is one id.
    `encode_special_tokens` is the library's flag of that name, there off by default: if it is set,
    a text that spells a special token is ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, mapped = tokenizer.model, byte_symbols()
    added = {}
    for number, token in tokenizer.get_added_tokens_decoder().items():
        if token.single_word or token.lstrip or token.rstrip or token.normalized:
            raise ValueError(f"added token with matching rules of its own: {token.content}")
        if not (encode_special_tokens and token.special):
            added[token.content.encode()] = number
    lead = mapped[32]

    def encode(piece: bytes) -> list[int]:
        word = piece[1:] if piece[0] == 32 else piece
        if word.isalnum():  # of ASCII
            text = lead + word.decode() if piece[0] == 32 else word.decode()
        else:
            text = piece.decode("latin-1").translate(mapped)
        return [t.id for t in model.tokenize(text)]

    return PieceCache(encode, 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4, added)


@functools.cache
def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def id_bytes(path: str) -> dict[int, bytes]:
    return {i: b for b, i in rank_table(path).items()}


def merge(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Byte-pair merging: again and again the leftmost pair of lowest rank becomes one token.

    Neighbours are linked and waiting pairs lie in a heap, so a piece of n bytes takes n log n steps.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    ends = list(range(1, n + 1))  # end of the token that begins at i
    back = list(range(-1, n - 1))  # begin of the token before
    heap = []
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    dead = bytearray(n)
    while heap:
        _, i, j = heapq.heappop(heap)
        middle = ends[i]
        if dead[i] or middle >= n or ends[middle] != j or middle == j:
            continue
        dead[middle] = 1
        ends[i] = j
        if j < n:
            back[j] = i
            r = get(piece[i : ends[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, ends[j]))
        p = back[i]
        if p >= 0:
            r = get(piece[p:j])
            if r is not None:
                heapq.heappush(heap, (r, p, j))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


@functools.cache
def rank_cache(path: str) -> PieceCache:
    """Ids by the rank file, by the merge loop above."""
    ranks = rank_table(path)
    return PieceCache(lambda piece: merge(ranks, piece), 2 if max(ranks.values()) < 1 << 16 else 4)
