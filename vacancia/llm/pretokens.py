"""Pre-token boundaries without regex: code-point classes and a scan of transition functions.

A token automaton has eight states; each position's symbol is one function from states to states.
Functions compose associatively, and all their compositions form a small finite set (the transition
monoid), so a composition is one lookup in a table of function numbers. Boundaries of a long text
come from a blocked prefix scan: blocks are scanned side by side, block totals are scanned by
doubling, and the state before each position decides whether a token starts there.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import tiktoken

# The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The contractions that are tokens of their own, after an apostrophe.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

#: Classes: the four of code points, the second and later bytes of one, and the edge between texts.
BLANK, LETTER, NUMBER, OTHER, INNER, END = range(6)
#: Symbols, which add what follows to the class. A gap is white space with more of it behind (or
#: the end); the last white space before a word is a lead if it is a space, else a break.
EDGE, WORD, DIGIT, MARK, GAP, BREAK, LEAD, SHORT, LONG, SAME = range(10)
#: States: a token must start; inside letters, numbers, marks, gap; behind a lead; one or two
#: letters of a contraction to come.
FRESH, IN_WORD, IN_DIGIT, IN_MARK, IN_GAP, LED, ONE_MORE, TWO_MORE = range(8)

BLOCK = 64
#: Texts are scanned together up to about so many bytes; a longer text is scanned alone.
GROUP_BYTES = 1 << 19
#: Bytes that UTF-8 never holds: between texts, and between pre-tokens.
EDGE_BYTE, CUT_BYTE = b"\xfe", b"\xff"


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a token start here)."""
    if symbol == SAME:
        return state, False
    if symbol == EDGE:
        return FRESH, True
    if state in (ONE_MORE, TWO_MORE):
        if symbol == WORD:
            return (ONE_MORE if state == TWO_MORE else FRESH), False
        state = FRESH  # never reached: only letters follow within a contraction
    if symbol in (WORD, DIGIT):
        inside = IN_WORD if symbol == WORD else IN_DIGIT
        return inside, state not in (inside, LED)
    if symbol in (SHORT, LONG) and state not in (IN_MARK, LED):
        return (ONE_MORE if symbol == SHORT else TWO_MORE), True
    if symbol in (MARK, SHORT, LONG):
        return IN_MARK, state not in (IN_MARK, LED)
    if symbol == GAP:
        return IN_GAP, state != IN_GAP
    return (LED if symbol == LEAD else FRESH), True


@functools.cache
def automaton() -> tuple[bytes, bytes, bytes, bytes]:
    """Tables over bytes: symbol to function, pair of functions to their composition, function and
    state to state, state and symbol to whether a token starts."""
    symbols = [tuple(step(s, x)[0] for s in range(8)) for x in range(10)]
    known = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    for f in queue:
        for g in symbols:
            h = tuple(g[f[s]] for s in range(8))
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    assert len(known) <= 16, len(known)
    number, compose, after, starts = bytearray(256), bytearray(256), bytearray(256), bytearray(256)
    for x, f in enumerate(symbols):
        number[x] = known[f]
        for s in range(8):
            starts[s << 4 | x] = step(s, x)[1]
    for f, a in known.items():
        for g, b in known.items():
            compose[a << 4 | b] = known[tuple(g[f[s]] for s in range(8))]
        for s in range(8):
            after[a << 4 | s] = f[s]
    return bytes(number), bytes(compose), bytes(after), bytes(starts)


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, by its general category."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for category, number in (("L", LETTER), ("N", NUMBER)):
        table[[ord(c) for c in _members(every, category)]] = number
    table[WHITE_SPACE] = BLANK
    return table


def _members(text: str, category: str) -> str:
    """The code points of a general category. The encoding library is asked, whose Unicode version decides,
    not Python's: it encodes what its pattern finds, here one byte to an id, and nothing else."""
    probe = tiktoken.Encoding("probe", pat_str=rf"\p{{{category}}}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return probe.decode(probe.encode_ordinary(text))


@functools.cache
def byte_classes() -> bytes:
    """The class of each ASCII byte; other lead bytes count as other until they are decoded."""
    table = classes()[:128].tolist() + [INNER] * 64 + [OTHER] * 64
    table[EDGE_BYTE[0]] = END
    return bytes(table)


def look_up(table: bytes, keys: np.ndarray) -> np.ndarray:
    return np.frombuffer(keys.tobytes().translate(table), np.uint8).reshape(keys.shape)


def symbols(data: np.ndarray) -> np.ndarray:
    """The symbol of each byte of UTF-8 texts that edge bytes divide."""
    kind = look_up(byte_classes(), data).copy()
    lead = np.flatnonzero((data >= 0xC0) & (data < 0xF8))
    width = np.ones(0, np.int64)
    if len(lead):
        width = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        point = data[lead].astype(np.uint32) & (0x7F >> width)
        for k in range(1, 4):
            more = width > k
            point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
        kind[lead] = classes()[point]
    out = look_up(bytes([GAP, WORD, DIGIT, MARK, SAME, EDGE] + [0] * 250), kind).copy()
    blank = np.flatnonzero(kind == BLANK)
    ahead = np.append(kind, [END])
    behind = blank + 1
    while (inner := ahead[behind] == INNER).any():  # the inner bytes of white space outside ASCII
        behind[inner] += 1
    last = (ahead[behind] != BLANK) & (ahead[behind] != END)
    out[blank[last]] = np.where(data[blank[last]] == 0x20, LEAD, BREAK)
    quotes = np.flatnonzero(data == 0x27)
    if len(quotes):
        padded = np.append(data, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        out[quotes[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        for a, b in LONG_ENDINGS:
            out[quotes[(one == ord(a)) & (two == ord(b))]] = LONG
    return out


def token_starts(symbol: np.ndarray) -> np.ndarray:
    """1 where a token starts, by the scan of composed transition functions."""
    number, compose, after, starts = automaton()
    n = len(symbol)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, SAME, np.uint8)
    padded[:n] = symbol
    f = np.array(look_up(number, padded).reshape(blocks, BLOCK).T, order="C")  # a row per place in a block
    for j in range(1, BLOCK):
        f[j] = look_up(compose, f[j - 1] << 4 | f[j])
    total, reach = f[-1].copy(), 1
    while reach < blocks:  # doubling: total[i] covers the blocks up to i
        total[reach:] = look_up(compose, total[:-reach] << 4 | total[reach:])
        reach *= 2
    begin = np.full(blocks, FRESH, np.uint8)
    begin[1:] = look_up(after, total[:-1] << 4 | FRESH)
    state = np.empty((BLOCK, blocks), np.uint8)
    state[0] = begin
    state[1:] = look_up(after, f[:-1] << 4 | begin)
    return look_up(starts, state.T.reshape(-1)[:n] << 4 | symbol)


def split(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The pre-tokens of each UTF-8 text, in order; texts are scanned in groups of bounded length."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > GROUP_BYTES:
            yield from _split_group(group)
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield from _split_group(group)


def _split_group(texts: list[bytes]) -> Iterator[list[bytes]]:
    data = np.frombuffer(EDGE_BYTE + EDGE_BYTE.join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    place = np.cumsum(token_starts(symbols(data)), dtype=np.int64)  # tokens begun so far
    first = [*place[edges].tolist(), int(place[-1]) + 1]
    place += np.arange(len(data))
    cut = np.full(int(place[-1]) + 1, CUT_BYTE[0], np.uint8)
    cut[place] = data
    pieces = cut.tobytes().split(CUT_BYTE)  # [nothing, edge, pre-token, ..., edge, pre-token, ...]
    for a, b in zip(first, first[1:]):
        yield pieces[a + 1 : b]
