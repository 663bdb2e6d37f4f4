"""Byte-level BPE encoding and decoding by a prefix dynamic program.

In byte-pair encoding, every prefix of a piece has one encoding, so one last token. The encoder stores
that token for every byte prefix. The last token of a prefix is the longest vocabulary entry that ends
there, whose own start is a prefix with last token t, and which may follow t: two tokens may stand next
to each other exactly if the encoding of their joined bytes is those two tokens. The encoding is read
backwards from the last prefix. Because the table of a prefix never depends on later bytes, appending
is exact at the cost of the new bytes alone, and an edit re-encodes from the edited byte until the table
agrees with the old one again.

Texts are split by the tokenizer's pattern and each match is encoded separately; a match that is itself
an entry is that entry. Spark partitions the rows; each worker keeps a memo of pieces, bounded by number and
bytes. The vocabulary is read on the driver and broadcast (a file of a few MB at most). Long texts are split,
encoded and hashed in stretches of pieces, and a long piece keeps one number per byte, so working memory is a
few times the bytes of the longest text; a cell of 2 GB is beyond Spark's own batches.

Defined results: a null text equals the empty text, which has no tokens; every byte string round-trips;
lone surrogates cannot occur in Spark strings; repeated rows give repeated results; an empty table gives
an empty table; other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from functools import cached_property, lru_cache
from itertools import chain, islice
from sys import getsizeof
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from pulsevault.llm.common import CHUNK_BYTES, executors_ready, text_chunks, text_of

#: Token pairs that a Python worker remembers before it starts anew (about 100 bytes each).
MEMO = 200_000
#: Bytes of the pieces that it remembers, as Python's objects and the dictionary's slots (``SLOT_BYTES`` each) take them:
#: one half for the latest pieces, the other for those before them.
MEMO_BYTES = 40 << 20
SLOT_BYTES = 100
#: Pieces, or ids, of one text that are worked on at a time.
STRETCH = 200_000
#: Characters above which a text is split in stretches.
_LONG_TEXT = 2 << 20
_NONE = -1
#: Longer byte strings get the whole table, byte by byte; shorter ones the prefixes that their encoding needs.
_ON_DEMAND = 200


class Table(NamedTuple):
    """Per byte prefix: its last token (none for the empty one), and the entries under way at its end as
    (bytes so far, what may follow), longest first."""

    last: list[int]
    alive: list[list[tuple[int, dict]]]


class Ragged:
    """Byte strings by number, joined by whole arrays of numbers."""

    def __init__(self, strings: dict[int, bytes]):
        size = np.zeros(max(strings) + 1, np.int64)
        for i, b in strings.items():
            size[i] = len(b)
        self.size = size
        self.start = np.concatenate(([0], np.cumsum(size)[:-1]))
        self.data = np.frombuffer(b"".join(strings[i] for i in sorted(strings)), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - ends + size, size)
        at += np.arange(len(at))
        return self.data[at].tobytes()


class PrefixEncoder:
    """Encoder and decoder for one set of ranks (token bytes -> id; every single byte must be present)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.numerals = Ragged({i: b"%d," % i for i in self.token})
        self.bytes = Ragged(self.token)
        self.size = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.endings = self._trie(backwards=True)
        self._pair: dict[int, bool] = {}
        self._sound: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}  # piece -> its ids, four bytes each
        self._before: dict[str, bytes] = {}
        self._held = 0

    @cached_property
    def trie(self) -> dict:
        """The entries by their bytes, for what is read forwards: long byte strings and tables."""
        made = self._trie()
        gc.freeze()
        return made

    def _trie(self, backwards: bool = False) -> dict:
        """The entries by their bytes, read forwards or backwards: byte -> (id of the entry that is complete here or
        none, what may come next)."""
        nodes: dict[bytes, list] = {b"": [_NONE, {}]}
        leaf: dict = {}
        for entry, rank in self.ranks.items():
            entry = entry[::-1] if backwards else entry
            for n in range(1, len(entry) + 1):
                nodes.setdefault(entry[:n], [_NONE, leaf])
            nodes[entry][0] = rank
        for key in sorted(nodes, key=len, reverse=True)[:-1]:  # from the leaves up
            parent = nodes[key[:-1]]
            parent[1] = parent[1] or {}
            parent[1][key[-1]] = tuple(nodes[key])
        return nodes[b""][1]

    def merged(self, data: bytes) -> list[int]:
        """The defining procedure: join the neighbours of lowest joint rank until none can be joined. Used
        on the bytes of two tokens at most."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [self.ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``."""
        key = (a << 32) | b
        known = self._pair.get(key)
        if known is None:
            if len(self._pair) >= MEMO:
                self._pair.clear()
            known = self._pair[key] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return known

    def stands(self, t: int) -> bool:
        """Whether the token's own bytes encode to it (some entries are only reached as whole pieces)."""
        known = self._sound.get(t)
        if known is None:
            known = self._sound[t] = self.merged(self.token[t]) == [t]
        return known

    def table(self) -> "Table":
        """The table of the empty byte string."""
        return Table([_NONE], [[(0, self.trie)]])

    def _step(self, byte: int, end: int, last, states: list) -> tuple[int, list]:
        """Move on the entries that are under way by the byte that ends the prefix of ``end`` bytes, longest first.
        The first to end here that may follow what stands before it is the last token of this prefix."""
        found, moved = _NONE, []
        for size, follow in states:
            step = follow.get(byte)
            if step is not None:
                t, follow = step
                size += 1
                if t >= 0 and found < 0:
                    if size == end:
                        fits = self.stands(t)
                    else:
                        fits = self._pair.get((last[end - size] << 32) | t)
                        if fits is None:
                            fits = self.follows(last[end - size], t)
                    if fits:
                        found = t
                if follow:
                    moved.append((size, follow))
        moved.append((0, self.trie))
        return found, moved

    def extend(self, data: bytes, table: "Table", until: int | None = None) -> "Table":
        """Complete ``table``, which stands for a prefix of ``data``, byte by byte."""
        last, alive = table
        states = alive[-1]
        for end in range(len(last), (len(data) if until is None else until) + 1):
            found, states = self._step(data[end - 1], end, last, states)
            last.append(found)
            alive.append(states)
        return table

    def read(self, table: "Table") -> list[int]:
        """The tokens of the table's whole byte string."""
        last, out = table.last, []
        i = len(last) - 1
        while i > 0:
            out.append(last[i])
            i -= self.size[last[i]]
        out.reverse()
        return out

    def _read_back(self, data: bytes) -> array:
        """The tokens of a byte string, last one first."""
        out, i = array("I"), len(data)
        if i > _ON_DEMAND:  # all prefixes, but the entries under way at the last one only
            last, states = array("i", [_NONE]), [(0, self.trie)]
            for end, byte in enumerate(data, 1):
                found, states = self._step(byte, end, last, states)
                last.append(found)
        else:
            last = [_NONE] * (i + 1)
        while i > 0:
            t = last[i] if last[i] >= 0 else self._last(data, i, last)
            out.append(t)
            i -= self.size[t]
        return out

    def encode_bytes(self, data: bytes) -> list[int]:
        """The encoding of ``data`` by merges alone."""
        return self._read_back(data)[::-1].tolist()

    def _last(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of the prefix of ``end`` bytes, filling in those prefixes only that the answer needs:
        the entries that end here are tried longest first, each against the last token of what it leaves."""
        found, follow, i = [], self.endings, end
        while i > 0:
            step = follow.get(data[i - 1])
            if step is None:
                break
            t, follow = step
            i -= 1
            if t >= 0:
                found.append((i, t))
        for start, t in reversed(found):
            if start == 0:
                fits = self.stands(t)
            else:
                before = last[start]
                if before < 0:
                    before = self._last(data, start, last)
                fits = self._pair.get((before << 32) | t)
                if fits is None:
                    fits = self.follows(before, t)
            if fits:
                last[end] = t
                return t
        raise ValueError("the vocabulary lacks a byte")

    def append(self, table: "Table", data: bytes, more: bytes) -> "Table":
        """Extend the table of ``data`` to ``data + more``; only the new bytes are worked on."""
        return self.extend(data + more, table)

    def edit(self, table: "Table", old: bytes, at: int, removed: int, inserted: bytes) -> tuple["Table", int]:
        """Table of ``old`` with ``removed`` bytes at ``at`` replaced, and how many prefixes were worked on.
        Once as many prefixes in a row as the longest entry has bytes agree with the old table, the rest of it
        is taken over."""
        new = old[:at] + inserted + old[at + removed:]
        shift = len(inserted) - removed
        fresh, agreed, done = Table(table.last[:at + 1], table.alive[:at + 1]), 0, 0
        while len(fresh.last) <= len(new):
            i = len(fresh.last)
            self.extend(new, fresh, i)
            done += 1
            if i > at + len(inserted):
                agreed = agreed + 1 if fresh.last[i] == table.last[i - shift] else 0
                if agreed >= self.longest:
                    fresh.last.extend(table.last[i - shift + 1:])
                    fresh.alive.extend(table.alive[i - shift + 1:])
        return fresh, done

    def encode_piece(self, piece: bytes) -> list[int]:
        """The encoding of one match of the pattern."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.encode_bytes(piece)

    def piece_ids(self, piece: str) -> bytes:
        """The ids of one match of the pattern, four bytes each; remembered if the match is short."""
        ids = self._before.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            ids = (array("I", [whole]) if whole is not None else self._read_back(data)[::-1]).tobytes()
            if len(data) > _ON_DEMAND:
                return ids
        if self._held >= MEMO_BYTES // 2:
            self._before, self._pieces, self._held = self._pieces, {}, 0
        self._pieces[piece] = ids
        self._held += getsizeof(piece) + getsizeof(ids) + SLOT_BYTES
        return ids

    def ids_of(self, pieces: list[list[str]]):
        """The ids of each list of matches."""
        different = list(set(chain.from_iterable(pieces)))
        here = dict(zip(different, map(self._pieces.get, different), strict=True))  # small enough for the processor's caches
        for piece in [piece for piece, ids in here.items() if ids is None]:
            here[piece] = self.piece_ids(piece)
        for some in pieces:
            yield np.frombuffer(b"".join(map(here.__getitem__, some)), np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that ``ids`` stand for."""
        return self.bytes.join(np.asarray(ids, np.int64))


@lru_cache(maxsize=2)
def _made(lines: bytes) -> PrefixEncoder:
    made = PrefixEncoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())})
    gc.freeze()  # the tries stay for the worker's life; the collector need not walk them again and again
    return made


def _lines(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as f:
        return f.read()


def encoder(vocabulary: str) -> PrefixEncoder:
    """The encoder for a rank file (a line per token: base64 bytes, rank)."""
    return _made(_lines(vocabulary))


@lru_cache(maxsize=2)
def splitter(pattern: str):
    import regex
    return regex.compile(pattern).findall


@lru_cache(maxsize=2)
def _matches(pattern: str):
    import regex
    return regex.compile(pattern).finditer


def _encoded(texts: list[str], enc: PrefixEncoder, pattern: str):
    """The ids of each text."""
    if all(len(text) <= _LONG_TEXT for text in texts):
        yield from enc.ids_of([splitter(pattern)(text) for text in texts])
        return
    for text in texts:
        matches, parts = (m.group() for m in _matches(pattern)(text)), [np.zeros(0, np.uint32)]
        while some := list(islice(matches, STRETCH)):
            parts += enc.ids_of([some])
        yield np.concatenate(parts)


def _digests(texts: list[str], enc: PrefixEncoder, pattern: str):
    """(tokens, SHA-256 of the ids, SHA-256 of the decoded bytes) of each text."""
    for ids in _encoded(texts, enc, pattern):
        line, data = hashlib.sha256(), hashlib.sha256()
        for at in range(0, len(ids), STRETCH):
            some = ids[at:at + STRETCH]
            numerals = enc.numerals.join(some)
            line.update(numerals if at + STRETCH < len(ids) else numerals[:-1])
            data.update(enc.decode(some))
        yield len(ids), line.hexdigest(), data.hexdigest()


def _shipped(df: DataFrame, vocabulary: str):
    """The workers made ready and the vocabulary's lines broadcast."""
    executors_ready(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(_lines(vocabulary))


def token_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256. ``vocabulary`` is a path on the driver."""
    lines = _shipped(docs, vocabulary)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        for b, texts in text_chunks(batches, 1, CHUNK_BYTES):
            out = list(zip(*_digests([t.decode() for t in texts], _made(lines.value), pattern), strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and its token ids. ``vocabulary`` is a path on the driver."""
    lines = _shipped(docs, vocabulary)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        for b, texts in text_chunks(batches, 1):
            ids = [x.astype(np.int32) for x in _encoded([t.decode() for t in texts], _made(lines.value), pattern)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: doc_id and the bytes that its ids stand for. ``vocabulary`` is a path on the driver."""
    lines = _shipped(encoded, vocabulary)

    def run(batches):
        import pyarrow as pa
        enc = _made(lines.value)
        for b in batches:
            data = [enc.decode(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")
