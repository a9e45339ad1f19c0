"""Byte-pair encoding and decoding as streaming transducers of constant memory.

A merge list has a *sufficient lookahead*: how far to the left the bytes that follow a position can
still change tokens. A difference starts with a merge across the position; it moves left only when a
later merge (of higher rank) joins the token at its left edge to the one before. The token at the edge
then begins with the left part of the earlier merge. The longest such chain over the merge list, in
bytes, bounds the lookahead. Tokens that end further left than that are stable and are emitted.

Text is fed in slices. The splitter holds back what the next characters may still change, pieces of
usual length are merged whole, and an endless piece goes through the byte transducer in blocks.
Decoding feeds the bytes of each token to a state machine that keeps at most one unfinished character.
"""

from __future__ import annotations

import codecs
import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, without

# The pattern that splits text before byte-level merging, and its longest look ahead.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES_AHEAD = 3
RUNS = (r"\p{L}*", r"\p{N}*", r"[^\s\p{L}\p{N}]*", r"\s*")

SLICE = 1 << 16  # characters fed at a time
BLOCK = 2_048  # bytes of an endless piece that are settled at a time, beside the lookahead
CACHE = 1 << 17  # pieces whose tokens a worker remembers
ROWS = 256  # rows that a worker hands on at a time
NONE = 1 << 31  # no merge


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable Latin-1 for itself, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class MergeList:
    """Vocabulary, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, definition: str) -> None:
        read = json.loads(definition)
        letters = byte_letters()
        model = read["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """The longest chain of merges of rising rank by which a difference moves left, in bytes."""
        left = {self.made[rank]: a for (a, _), rank in self.rank.items()}
        reach: dict[int, int] = {}  # for a token at the left edge: how much further later merges carry a difference
        longest = 0
        for a, b in reversed(sorted(self.rank, key=self.rank.get)):
            here = len(self.bytes_of[a]) + reach.get(a, 0)
            longest = max(longest, here)
            while b is not None:
                reach[b] = max(reach.get(b, 0), here)
                b = left.get(b)
        return longest

    def merge(self, piece: bytes) -> list[int]:
        """The tokens of a piece: the lowest rank first, leftmost first among equals."""
        ids = [self.first[b] for b in piece]
        if len(ids) > 256:
            return self._merge_long(ids)
        rank, made = self.rank.get, self.made
        ranks = [rank(p, NONE) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            k = ranks.index(best)
            ids[k : k + 2] = [made[best]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), NONE)
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a queue, for blocks of an endless piece."""
        rank, made = self.rank, self.made
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        queue = [(rank[p], k, *p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(queue)
        while queue:
            best, k, a, b = heapq.heappop(queue)
            n = after[k]
            if ids[k] != a or n < 0 or ids[n] != b:
                continue
            ids[k] = made[best]
            ids[n] = -1
            after[k] = after[n]
            if after[k] >= 0:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0 and (p := (ids[x], ids[y])) in rank:
                    heapq.heappush(queue, (rank[p], x, *p))
        return [i for i in ids if i >= 0]


class _Pieces(dict):
    """Piece to packed ids; forgets all when full, so its size is bounded."""

    def __init__(self, merges: MergeList) -> None:
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> bytes:
        packed = pack(self.merges.merge(piece.encode()))
        if len(piece) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = packed
        return packed


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Text in slices to packed ids; what it holds back is bounded by constants."""

    def __init__(self, merges: MergeList, block: int = BLOCK) -> None:
        self.merges = merges
        self.block = block
        self.cache = _Pieces(merges)
        self.pieces = regex.compile(PIECES)
        self.runs = [regex.compile(r) for r in RUNS]
        self.specials = regex.compile("|".join(regex.escape(s) for s in merges.special)) if merges.special else None
        self.hold = max((len(s) - 1 for s in merges.special), default=0)
        self._reset()

    def _reset(self) -> None:
        self.ahead = ""  # may begin a special token
        self.rest = ""  # may still be cut differently
        self.run = None  # the class of an endless piece
        self.pending = b""  # its bytes that are not stable

    def encode(self, text: str) -> bytes:
        """The ids of one whole text."""
        self._reset()
        if len(text) <= SLICE:
            return self.feed(text) + self.finish()
        parts = [self.feed(text[k : k + SLICE]) for k in range(0, len(text), SLICE)]
        return b"".join(parts) + self.finish()

    def feed(self, text: str) -> bytes:
        """Take more text and return the ids that are stable now."""
        text = self.ahead + text
        out, start = [], 0
        for found in self.specials.finditer(text) if self.specials else ():
            out += [self._plain(text[start : found.start()]), self._end(), pack([self.merges.special[found[0]]])]
            start = found.end()
        stop = max(start, len(text) - self.hold)
        self.ahead = text[stop:]
        out.append(self._plain(text[start:stop]))
        return b"".join(out)

    def finish(self) -> bytes:
        """The ids of all that was held back."""
        out = self._plain(self.ahead) + self._end()
        self._reset()
        return out

    def _end(self) -> bytes:
        out = self._stable(self.rest.encode(), last=True) if self.run else self._known(self.pieces.findall(self.rest))
        self.rest, self.run = "", None
        return out

    def _known(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, pieces))

    def _plain(self, text: str) -> bytes:
        text = self.rest + text
        out = b""
        if self.run:
            stop = self.run.match(text).end()
            if stop == len(text):
                keep = max(0, stop - PIECES_AHEAD)
                self.rest = text[keep:]
                return self._stable(text[:keep].encode())
            if self.run is self.runs[3]:
                stop -= 1  # the last blank before a word belongs to what follows
            out = self._stable(text[:stop].encode(), last=True)
            text, self.run = text[stop:], None
        pieces = self.pieces.findall(text)
        held = []
        size = 0
        while pieces and (not held or size < PIECES_AHEAD):
            held.append(pieces.pop())
            size += len(held[-1])
        self.rest = "".join(reversed(held))
        out += self._known(pieces)
        if len(self.rest) > SLICE // 2 and len(held[-1]) > SLICE // 4:
            endless = held.pop()
            if not held:
                self.run = next(r for r in self.runs if r.fullmatch(endless[-1]))
                self.rest = endless[-PIECES_AHEAD:]
                out += self._stable(endless[:-PIECES_AHEAD].encode())
        return out

    def _stable(self, more: bytes, last: bool = False) -> bytes:
        """The byte transducer: tokens further left than the lookahead can no longer change."""
        out = []
        view = self.pending + more
        at = 0
        size = self.block + self.merges.lookahead
        while len(view) - at > size:
            block = view[at : at + size]
            end, limit, stable = 0, self.block, []
            for i in self.merges.merge(block):
                end += len(self.merges.bytes_of[i])
                if end > limit:
                    break
                stable.append(i)
                at += len(self.merges.bytes_of[i])
            out.append(pack(stable))
        self.pending = view[at:]
        if last:
            out.append(pack(self.merges.merge(self.pending)))
            self.pending = b""
        return b"".join(out)


class Decoder:
    """Packed ids to text: a UTF-8 state machine that keeps at most one unfinished character."""

    def __init__(self, merges: MergeList) -> None:
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def decode(self, packed: bytes) -> str:
        """The text of one whole sequence; broken byte sequences become U+FFFD."""
        step = 4 * SLICE
        parts = [self.feed(packed[k : k + step]) for k in range(0, len(packed), step)]
        parts.append(self.state.decode(b"", final=True))
        self.state.reset()
        return "".join(parts)

    def feed(self, packed: bytes) -> str:
        ids = memoryview(packed).cast("I") if len(packed) else ()
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))


@lru_cache(1)
def encoder_of(definition: str) -> Encoder:
    """A worker's encoder; it keeps its remembered pieces from task to task."""
    return Encoder(MergeList(definition))


@lru_cache(1)
def decoder_of(definition: str) -> Decoder:
    return Decoder(MergeList(definition))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that a worker never holds the results of a large one."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _with_type(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def bpe_encode(docs: DataFrame, definition: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``, the tokens of the whole text as packed little-endian 32-bit integers.

    ``definition`` is the content of a byte-level tokenizer file, a constant of a few megabytes that goes to each
    worker. Strings of special tokens in a text become these tokens. NULL and empty texts give no tokens;
    an empty table gives an empty result; a column of ``docs`` that is called as the result is replaced.
    """
    source = without(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encoder = encoder_of(definition)
        for batch in _slices(batches):
            column = batch.column(batch.schema.get_field_index(text))
            packed = pa.array([encoder.encode(t.as_py() or "") for t in column], pa.binary())
            yield batch.append_column(ids, packed)

    return map_batches(source, run, _with_type(source.schema, ids, T.BinaryType()))


def bpe_decode(tokens: DataFrame, definition: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` with the text of its packed ids; NULL and empty sequences give the empty text."""
    source = without(tokens, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        decoder = decoder_of(definition)
        for batch in _slices(batches):
            column = batch.column(batch.schema.get_field_index(ids))
            yield batch.append_column(text, pa.array([decoder.decode(p.as_py() or b"") for p in column], pa.string()))

    return map_batches(source, run, _with_type(source.schema, text, T.StringType()))


def bpe_round_trip(docs: DataFrame, definition: str, text: str = "text", ids: str = "ids", same: str = "round_trip") -> DataFrame:
    """``docs`` with ``ids`` in the place of the text, and whether they decode to it.

    One pass of one worker per text: neither the text nor what is decoded is handed on.
    """
    kept = without(docs, text, ids, same).schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encoder, decoder = encoder_of(definition), decoder_of(definition)
        for batch in _slices(batches):
            packed, equal = [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                body = value.as_py() or ""
                packed.append(encoder.encode(body))
                equal.append(decoder.decode(packed[-1]) == body)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.record_batch(
                [*columns, pa.array(packed, pa.binary()), pa.array(equal, pa.bool_())], names=[*[f.name for f in kept], ids, same]
            )

    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()), T.StructField(same, T.BooleanType())])
    return map_batches(docs, run, schema)
