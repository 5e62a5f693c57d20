"""A range asymmetric numeral system over token ids: one static table a shard, independent interleaved blocks.

Image of a shard, little-endian:

  header    magic ``TRNS``, the fields of ``HEADER``, crc32 of header, table and directory
  docs      zlib of: null flags (1 byte each), ids (8 bytes each), token counts (8 bytes each)
  table     zlib of: symbols that occur, ascending (4 bytes each), their frequencies (4 bytes each, sum 2**scale_bits)
  directory for each block: tokens, words, crc32 of its tokens as 32-bit values; then for each checkpoint of each
            block the number of words before it (8 bytes) and the states of all lanes (8 bytes each)
  words     32-bit words of all blocks, in the order in which a decoder consumes them

Token i of a block is coded by lane ``i % lanes`` in step ``i // lanes``. States live in [2**31, 2**63) and move 32 bits
at a time. A checkpoint holds what a decoder has before a step, so each of them is a place to start from: all of a
shard's checkpoints are decoded side by side.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"TRNS"
HEADER = struct.Struct("<BBIIIQQIIII")  # version, scale_bits, lanes, steps, every, tokens, docs, blocks, docs, table, directory bytes
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


class CorruptShard(ValueError):
    """A checksum of an image does not hold."""


@dataclass(frozen=True)
class Layout:
    """Lanes a block, steps a block, steps between checkpoints and bits of the frequency scale."""

    lanes: int = 64
    steps: int = 1024
    every: int = 512
    scale_bits: int = 20


def frequencies(counts: np.ndarray, scale_bits: int) -> np.ndarray:
    """Positive counts scaled to positive integers that sum to 2**scale_bits."""
    total = 1 << scale_bits
    if len(counts) > total:
        raise ValueError("more symbols than the frequency scale has places")
    scaled = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    excess = int(scaled.sum()) - total
    while excess > 0:  # rare symbols raised to 1 are paid for by the frequent ones
        cut = np.minimum(scaled[order] - 1, max(1, excess // len(order)))
        cut[np.cumsum(cut) > excess] = 0
        if not cut.any():
            cut[np.argmax(scaled[order] > 1)] = 1
        scaled[order] -= cut
        excess -= int(cut.sum())
    scaled[order[0]] -= excess
    return scaled


def _encode(ranks: np.ndarray, freq: np.ndarray, cum: np.ndarray, layout: Layout):
    """Blocks (block, step, lane) of symbol ranks to words, their places and the states at checkpoints."""
    blocks, steps, lanes = ranks.shape
    shift = np.uint64(layout.scale_bits)
    room = np.uint64(63 - layout.scale_bits)  # a symbol of frequency f may be coded while the state is below f << room
    state = np.full((blocks, lanes), LOW, np.uint64)
    words = np.zeros((steps, blocks, lanes), np.uint32)
    moved = np.zeros((steps, blocks, lanes), bool)
    points = np.zeros((blocks, -(-steps // layout.every), lanes), np.uint64)
    for step in range(steps - 1, -1, -1):
        f, c = freq[ranks[:, step]], cum[ranks[:, step]]
        full = state >= (f << room)
        words[step] = state.astype(np.uint32)
        moved[step] = full
        state = np.where(full, state >> WORD, state)
        whole = state // f
        state = (whole << shift) + (state - whole * f) + c
        if step % layout.every == 0:
            points[:, step // layout.every] = state
    return words.transpose(1, 0, 2), moved.transpose(1, 0, 2), points


def encode(ids: np.ndarray, doc_ids: list[int | None], doc_sizes: list[int], layout: Layout = Layout()) -> bytes:
    """The image of a shard of whole documents; ``ids`` are their tokens one after another."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    ranks = (np.cumsum(counts > 0) - 1).astype(np.uint32)[ids]
    freq = frequencies(counts[symbols], layout.scale_bits).astype(np.uint64) if len(ids) else np.empty(0, np.uint64)
    cum = np.cumsum(freq, dtype=np.uint64) - freq
    block = layout.lanes * layout.steps
    whole = len(ids) // block * block
    parts = []
    if whole:
        parts.append(ranks[:whole].reshape(-1, layout.steps, layout.lanes))
    if rest := len(ids) - whole:
        steps = -(-rest // layout.lanes)
        padded = np.full(steps * layout.lanes, np.argmax(freq), ranks.dtype)
        padded[:rest] = ranks[whole:]
        parts.append(padded.reshape(1, steps, layout.lanes))
    directory, states, words = [], [], []
    for part in parts:
        coded, moved, points = _encode(part, freq, cum, layout)
        for i in range(len(part)):
            start = len(directory) * block
            tokens = ids[start : start + block].astype("<u4")
            before = np.concatenate([[0], np.cumsum(moved[i].sum(axis=1))])
            directory.append((len(tokens), int(before[-1]), zlib.crc32(tokens.tobytes())))
            places = before[: moved.shape[1] : layout.every]
            states.append(b"".join(struct.pack("<Q", p) + s.astype("<u8").tobytes() for p, s in zip(places, points[i])))
            words.append(coded[i][moved[i]].astype("<u4").tobytes())
    flags = np.array([d is None for d in doc_ids], np.uint8)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    docs = zlib.compress(flags.tobytes() + names.tobytes() + np.array(doc_sizes, "<i8").tobytes(), 1)
    table = zlib.compress(symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    listed = b"".join(struct.pack("<III", *d) for d in directory) + b"".join(states)
    header = HEADER.pack(
        1, layout.scale_bits, layout.lanes, layout.steps, layout.every, len(ids), len(doc_ids), len(directory),
        len(docs), len(table), len(listed),
    )
    check = struct.pack("<I", zlib.crc32(header + docs + table + listed))
    return MAGIC + header + check + docs + table + listed + b"".join(words)


class Shard:
    """Reads an image; everything but the words is checked on opening, blocks when they are decoded."""

    def __init__(self, image: bytes):
        size = len(MAGIC) + HEADER.size + 4
        if image[: len(MAGIC)] != MAGIC or len(image) < size:
            raise CorruptShard("not an image of a shard")
        fields = HEADER.unpack_from(image, len(MAGIC))
        _, bits, lanes, steps, every, self.n_tokens, n_docs, n_blocks, n_d, n_t, n_l = fields
        self.layout = Layout(lanes, steps, every, bits)
        body = image[size : size + n_d + n_t + n_l]
        if zlib.crc32(image[len(MAGIC) : size - 4] + body) != struct.unpack_from("<I", image, size - 4)[0]:
            raise CorruptShard("the header, table or directory is damaged")
        docs = zlib.decompress(body[:n_d])
        flags = np.frombuffer(docs, np.uint8, n_docs)
        names = np.frombuffer(docs, "<i8", n_docs, n_docs)
        self.doc_ids = [None if f else int(d) for f, d in zip(flags, names)]
        self.doc_sizes = np.frombuffer(docs, "<i8", n_docs, 9 * n_docs)
        table = np.frombuffer(zlib.decompress(body[n_d : n_d + n_t]), "<u4")
        self.symbols, self.freq = table[: len(table) // 2], table[len(table) // 2 :].astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self._place = None
        listed = body[n_d + n_t :]
        self.directory = [struct.unpack_from("<III", listed, 12 * i) for i in range(n_blocks)]
        self.points: list[tuple[int, int, int, np.ndarray]] = []  # block, first step, words before it in all blocks, states
        at, words = 12 * n_blocks, 0
        for i, (tokens, n_words, _) in enumerate(self.directory):
            for step in range(0, -(-tokens // lanes), every):
                before, = struct.unpack_from("<Q", listed, at)
                self.points.append((i, step, words + before, np.frombuffer(listed, "<u8", lanes, at + 8)))
                at += 8 * (lanes + 1)
            words += n_words
        if len(image) < size + len(body) + 4 * words:
            raise CorruptShard("the words are cut off")
        self.words = np.frombuffer(image, "<u4", words, size + len(body))

    def tokens(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` tokens from ``first``, decoded from the checkpoints that cover them; whole blocks are checked."""
        stop = self.n_tokens if count is None else min(self.n_tokens, first + count)
        span = self.layout.lanes * self.layout.steps
        piece = self.layout.lanes * self.layout.every
        starts = [b * span + s * self.layout.lanes for b, s, _, _ in self.points]
        wanted = [i for i, at in enumerate(starts) if at < stop and at + piece > first]
        if not wanted:
            return np.empty(0, np.uint32)
        found = self._decode([self.points[i] for i in wanted])
        low, high = wanted[0], wanted[-1]
        offset = starts[low]
        ids = np.concatenate(found)
        for b, (size, _, crc) in enumerate(self.directory):
            inside = b * span - offset
            if inside >= 0 and inside + size <= len(ids) and starts[high] + piece >= b * span + size:
                if zlib.crc32(ids[inside : inside + size].astype("<u4").tobytes()) != crc:
                    raise CorruptShard(f"block {b} is damaged")
        return ids[first - offset : stop - offset]

    def _decode(self, points) -> list[np.ndarray]:
        lanes, every, bits = self.layout.lanes, self.layout.every, np.uint64(self.layout.scale_bits)
        if self._place is None:
            self._place = np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freq.astype(np.int64))
        steps = np.array([min(every, -(-self.directory[b][0] // lanes) - s) for b, s, _, _ in points])
        order = np.argsort(-steps, kind="stable")
        state = np.stack([points[i][3] for i in order]).astype(np.uint64)
        at = np.array([points[i][2] for i in order], np.int64)
        long = steps[order]
        out = np.zeros((len(points), every, lanes), np.uint32)
        mask = np.uint64((1 << int(bits)) - 1)
        last = max(len(self.words) - 1, 0)
        for step in range(int(long[0])):
            live = int(np.searchsorted(-long, -step, "left"))
            x = state[:live]
            slot = x & mask
            rank = self._place[slot]
            out[:live, step] = rank
            x = self.freq[rank] * (x >> bits) + slot - self.cum[rank]
            short = x < LOW
            n = short.cumsum(axis=1)
            if len(self.words):
                # A damaged stream may ask for words beyond the end; the block's checksum then tells.
                index = np.minimum(at[:live, None] + n - 1, last)
                x = np.where(short, (x << WORD) | self.words[np.maximum(index, 0)], x)
            at[:live] += n[:, -1]
            state[:live] = x
        found: list[np.ndarray] = [np.empty(0, np.uint32)] * len(points)
        for row, i in enumerate(order):
            b, s, _, _ = points[i]
            count = min(self.directory[b][0] - s * lanes, every * lanes)
            found[i] = self.symbols[out[row].reshape(-1)[:count]]
        return found
