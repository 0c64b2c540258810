"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Encoding. The BPE encoding of a string ends in one certain token, and a sequence of tokens is an encoding exactly if
each two neighbours are one. So the encoding of a prefix is known from its last token and the encoding before that
token. A state of the transducer is what of the input is still open: the last token that is settled, and the bytes
after it. Reading a byte finds the token that ends there; a boundary is settled, and the tokens before it are emitted,
once the encodings of all prefixes that a later token can still follow go through it. Such a token must begin with the
bytes from its start on, so no more than the longest token is ever open. States and transitions are made when they
are first met (lazy determinisation) and kept up to a bound.

Decoding. A machine reads UTF-8 byte by byte and holds an open character between tokens; its steps over whole tokens
are also made when first met.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import LATIN_PARTS, NOT_LATIN, Memo


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class _State:
    __slots__ = ("previous", "open", "ends", "ways", "live", "steps", "rest")

    def __init__(self, previous: int, open_: bytes, ends: tuple[int, ...], ways: tuple[int, ...], live: tuple[int, ...]):
        self.previous, self.open = previous, open_
        self.ends = ends  # the token that ends after each byte of open
        self.ways = ways  # for each boundary from 0 on, the boundaries of the encoding up to it, as bits
        self.live = live  # boundaries at which a later token can begin
        self.steps: dict[int, tuple[_State, tuple[int, ...]]] | None = None
        self.rest: tuple[int, ...] | None = None


class Transducer:
    """The encoder of one table of ranks, in which every single byte is a token."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.beginnings = {token[:i] for token in ranks for i in range(1, len(token))}
        # For each token its two parts before the last merge. Tokens that no merges lead to have none; a string that
        # is one of them as a whole is that token all the same.
        self.halves = {token: self._last_merge(token) for token in ranks}
        self.merged = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.halves[token]}
        self.odd = {token: rank for token, rank in ranks.items() if token not in self.merged}
        self.never = max(self.bytes_of) + 1
        self._edges = functools.lru_cache(100_000)(self._edge)
        self._agree = functools.lru_cache(300_000)(self._neighbours)
        self.states: dict[tuple[int, bytes], _State] = {}
        self.start = self._state(-1, b"", (), (1,), (0,))

    def _last_merge(self, token: bytes) -> tuple[bytes, bytes] | None:
        """Join the neighbours of lowest rank, the first of equal ones, again and again; the last two parts if that gives the token."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(rank, i) for i in range(len(parts) - 1) if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return None
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _edge(self, rank: int, side: int) -> list[tuple[int, bytes]]:
        """What stands at the left (0) or right (1) edge of a token while it is merged, from a byte to the token."""
        token = self.bytes_of[rank]
        out = [(rank, token)]
        while len(token) > 1:
            token = self.halves[token][side]
            out.append((self.ranks[token], token))
        return out[::-1]

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens side by side encode to themselves: no merge across their border may ever come first.

        Merges come in the order of ranks, so what stands on either side of the border changes in that order. Of equal
        ranks the one further left comes first.
        """
        a, b = self._edges(left, 1), self._edges(right, 0)
        i = j = 0
        while True:
            across = self.ranks.get(a[i][1] + b[j][1], self.never)
            next_a = a[i + 1][0] if i + 1 < len(a) else self.never
            next_b = b[j + 1][0] if j + 1 < len(b) else self.never
            if across < next_a and across <= next_b and across < self.never:
                return False
            if next_a == next_b == self.never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _state(self, previous: int, open_: bytes, *rest) -> _State:
        key = (previous, open_)
        state = self.states.get(key)
        if state is None:
            state = _State(previous, open_, *rest)
            if len(self.states) < self.max_states:
                self.states[key] = state
                state.steps = {}
        return state

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        data = state.open + bytes((byte,))
        n = len(data)
        live = []
        found = -1
        for i in state.live:
            part = data[i:]
            if found < 0 and (token := self.merged.get(part)) is not None:
                before = state.ends[i - 1] if i else state.previous
                if before < 0 or self._agree(before, token):
                    found, at = token, i
            if part in self.beginnings:
                live.append(i)
        ends = (*state.ends, found)
        ways = (*state.ways, state.ways[at] | 1 << n)
        live.append(n)
        # Settled is what the ways of all boundaries share at which a later token can begin.
        common = ways[n]
        for i in live:
            common &= ways[i]
        settled = common.bit_length() - 1
        if not settled:
            return self._state(state.previous, data, ends, ways, tuple(live)), ()
        tokens = tuple(token for i, token in enumerate(ends[:settled], 1) if common >> i & 1)
        ways = tuple(way >> settled for way in ways[settled:])
        return self._state(ends[settled - 1], data[settled:], ends[settled:], ways, tuple(i - settled for i in live)), tokens

    def encode(self, data: bytes) -> list[int]:
        """Token ids of one part of a text."""
        if data in self.odd:
            return [self.odd[data]]
        state, out = self.start, []
        for byte in data:
            step = state.steps.get(byte) if state.steps is not None else None
            if step is None:
                step = self._step(state, byte)
                if state.steps is not None:
                    state.steps[byte] = step
            state, tokens = step
            if tokens:
                out += tokens
        if state.rest is None:
            state.rest = tuple(token for i, token in enumerate(state.ends, 1) if state.ways[-1] >> i & 1)
        return out + list(state.rest)


class Utf8:
    """An incremental UTF-8 machine. A state is the open bytes of one character; wrong bytes become U+FFFD, one for
    each longest part that could begin a character."""

    @staticmethod
    def begins(data: bytes) -> int:
        """0 if data begins no character, else the length of the character."""
        first = data[0]
        size = 1 if first < 0x80 else 2 if 0xC2 <= first <= 0xDF else 3 if 0xE0 <= first <= 0xEF else 4 if 0xF0 <= first <= 0xF4 else 0
        if size and len(data) > 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(first, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(first, 0xBF)
            if not low <= data[1] <= high or any(not 0x80 <= b <= 0xBF for b in data[2:]):
                return 0
        return size

    @classmethod
    def step(cls, held: bytes, byte: int) -> tuple[str, bytes]:
        data = held + bytes((byte,))
        size = cls.begins(data)
        if size:
            return (data.decode(), b"") if size == len(data) else ("", data)
        if not held:
            return "�", b""
        text, rest = cls.step(b"", byte)
        return "�" + text, rest


class _Held(dict):
    """A state of the decoder: the step of each token, made when first met."""

    def __init__(self, decoder: Decoder, held: bytes):
        super().__init__()
        self.decoder, self.held = decoder, held

    def __missing__(self, token: int):
        text, held = "", self.held
        for byte in self.decoder.bytes_of[token]:
            more, held = Utf8.step(held, byte)
            text += more
        step = self[token] = (text, self.decoder.state(held))
        return step


class Decoder:
    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.states: dict[bytes, _Held] = {}

    def state(self, held: bytes) -> _Held:
        if held not in self.states:
            self.states[held] = _Held(self, held)
        return self.states[held]

    def stream(self, tokens: Iterable[int]) -> Iterator[str]:
        """The text of each token as soon as its characters are complete, then what is left open."""
        state = self.state(b"")
        for token in tokens:
            text, state = state[token]
            yield text
        if state.held:
            yield "�"

    def decode(self, tokens: Iterable[int]) -> str:
        return "".join(self.stream(tokens))


class Codec:
    """Texts to ids and back, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN

        self.transducer = Transducer(read_ranks(path))
        self.decoder = Decoder(self.transducer.bytes_of)
        self.parts = regex.compile(PATTERN).findall
        self.known = Memo(self._part, 700_000)

    def _part(self, part: str) -> bytes:
        ids = self.transducer.encode(part.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = self.parts(text) if NOT_LATIN(text) else LATIN_PARTS(text)
        return b"".join(map(self.known.__getitem__, parts))

    def decode(self, ids: bytes) -> str:
        return self.decoder.decode(np.frombuffer(ids, "<u4").tolist())


@functools.lru_cache(2)
def codec_of(path: str) -> Codec:
    """The codec of a process: what it has met stays known from task to task, up to its bounds."""
    return Codec(path)


def coded(docs: DataFrame, path: str, make: Callable[[str], Codec] = codec_of, with_ids: bool = True) -> DataFrame:
    """doc_id, ids, decoded and digests of both for every row of docs (doc_id, text); without the first two on request.

    A null text is empty: it has no ids, and the digests of nothing. Rows are coded one by one and never moved.
    """

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gc.set_threshold(1_000_000)  # states are many and never garbage
        codec = make(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = codec.encode(text)
                decoded = codec.decode(ids).encode()
                digests = (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                out.append((doc_id, len(ids) // 4, *digests, *((np.frombuffer(ids, "<u4").astype("i8"), decoded.decode()) if with_ids else ())))
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if with_ids else ())])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(code, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * with_ids)
