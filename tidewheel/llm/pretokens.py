"""Cutting texts into pre-tokens, and encoding every distinct pre-token of a task once.

No merge of the two tokenizers crosses a pre-token, so a text's ids are the ids of its pre-tokens in a row. A block
of texts is cut with numpy; its distinct pre-tokens are found by their hashes, those that the worker has not seen are
encoded by the tokenizer's library, and the rest is table look-up.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np

from tidewheel.llm.text import _BASE, KEPT as _encoders, Block, _power, mix

_U = np.uint64
_RAW = mix(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F))
CACHE_ENTRIES = 1_000_000

#: Bytes by class: 0 letter (also all bytes beyond ASCII), 1 digit, 2 white space, 3 other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 0
_CLASS[48:58] = 1
_CLASS[[9, 10, 11, 12, 13, 32]] = 2

#: Bytes beyond ASCII that can belong to the letters U+00C0 to U+027F.
_PLAIN = np.ones(256, bool)
_PLAIN[0xC0:0xC3] = _PLAIN[0xCA:] = False


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, case-sensitive and with the length mixed in."""
    n = len(data)
    total = np.zeros(n + 1, _U)
    np.cumsum(_RAW[data] * _power("up", _BASE, n + 1)[:n], out=total[1:])
    inverse = _power("down", pow(_BASE, -1, 1 << 64), n + 1)
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U))


def spaced_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of spaces with the non-spaces behind them; for texts that begin with a space."""
    space = block.data == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    edge = np.zeros(len(block.data), bool)
    edge[block.offsets[1:] - 1] = True  # separators belong to no pre-token
    begins |= edge
    at = np.flatnonzero(begins)
    stop = np.append(at[1:], len(block.data))
    kept = ~edge[at]
    return at[kept], stop[kept]


def byte_level(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the usual byte-level pattern.

    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|white space before white space or the end|white space
    """
    data, offsets = block
    kind = _CLASS[data]
    last = offsets[1:] - 1
    kind[last] = 4  # separators
    cut = np.ones(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    white = kind == 2
    # a run of white space before something else gives up its last character, which stands alone or, if a space, joins
    gives = np.zeros(len(data), bool)
    gives[:-1] = white[:-1] & (kind[1:] < 4) & ~white[1:]
    cut |= gives
    joins = np.flatnonzero(gives & (data == 32))
    cut[joins + 1] = False
    quote = np.flatnonzero((data == 39) & cut)
    if len(quote):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        for found, size in ((quote[short], 2), (quote[long & ~short], 3)):
            cut[found] = True
            cut[found + 1] = False
            cut[np.minimum(found + size, len(data) - 1)] = True
    at = np.flatnonzero(cut)
    stop = np.append(at[1:], len(data))
    kept = kind[at] != 4
    return at[kept], stop[kept]


def odd_documents(block: Block) -> np.ndarray:
    """Documents holding characters whose class the byte tables do not know: they are left to the library."""
    data, offsets = block
    odd = ~_PLAIN[data]
    sign = (data == 0x97) | (data == 0xB7)  # multiplication and division sign, after 0xC3
    odd[1:] |= sign[1:] & (data[:-1] == 0xC3)
    return np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)


class Encoder:
    """Ids of distinct pre-tokens; `encode` takes a list of byte strings and gives a list of id lists.

    `known` forgets everything at CACHE_ENTRIES, so that its memory is bounded.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.length = np.zeros(1 << 16, np.int32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of every pre-token, an index into `length` and `begin`."""
        values, first, back = np.unique(hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.known) + len(values) > CACHE_ENTRIES:
            self.forget()
        listed = values.tolist()
        get = self.known.get
        entries = np.array([get(v, -1) for v in listed], np.int64)
        new = np.flatnonzero(entries < 0)
        if len(new):
            raw = data.tobytes()
            lists = self.encode([raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            base = len(self.known)
            entries[new] = np.arange(base, base + len(new))
            self.known.update(zip(values[new].tolist(), range(base, base + len(new))))
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self._room(base + len(new), self.used + int(sizes.sum()))
            self.length[base:base + len(new)] = sizes
            self.begin[base:base + len(new)] = self.used + np.cumsum(sizes) - sizes
            flat = np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))
            self.ids[self.used:self.used + len(flat)] = flat
            self.used += len(flat)
        return entries[back]

    def _room(self, entries: int, ids: int) -> None:
        if entries > len(self.length):
            grow = max(entries, 2 * len(self.length)) - len(self.length)
            self.length = np.concatenate([self.length, np.zeros(grow, np.int32)])
            self.begin = np.concatenate([self.begin, np.zeros(grow, np.int64)])
        if ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(ids, 2 * len(self.ids)) - len(self.ids), np.uint32)])

    def expand(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a row of pre-tokens, and where each pre-token's begin."""
        sizes = self.length[entries].astype(np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        where = np.arange(first[-1]) + np.repeat(self.begin[entries] - first[:-1], sizes)
        return self.ids[where], first


def piece_encoder(path: str) -> Encoder:
    """For a sentencepiece model whose pieces hold a space only in front. One per worker process and file."""
    key = ("piece", path)
    if key not in _encoders:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space inside, so pre-tokens can't be counted alone")
        if model.encode(" ", out_type=str) != ["▁▁"]:
            raise ValueError("the model does not keep white space as it is")
        lone = [model.piece_to_id("▁")]

        def encode(tokens: list[bytes]) -> list[list[int]]:
            # the model puts a space in front itself
            return [ids if token != b" " else lone for token, ids in
                    zip(tokens, model.encode([t[1:].decode() for t in tokens], num_threads=1))]

        _encoders[key] = Encoder(encode)
    return _encoders[key]


def byte_encoder(ranks_path: str, pattern: str) -> Encoder:
    """For a byte-level vocabulary as ranks."""
    key = ("byte", ranks_path)
    if key not in _encoders:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        vocabulary = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[key] = Encoder(lambda tokens: [vocabulary.encode_ordinary(t.decode()) for t in tokens])
    return _encoders[key]


def library_tokenizer(path: str):
    """The tokenizers library's object for a .json file, one per worker process."""
    key = ("library", path)
    if key not in _encoders:
        from tokenizers import Tokenizer

        _encoders[key] = Tokenizer.from_file(path)
    return _encoders[key]
