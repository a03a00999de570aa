"""Packing of token streams into windows by Karmarkar-Karp multiway differencing.

A task packs its documents block by block. Whole windows of a long document are cut off first; the remainders of a
block are differenced: partial partitions, each a sorted set of window loads, meet with opposing imbalances until one
partition with near-equal loads is left. If a load exceeds the capacity, the number of windows rises and the block is
differenced again. Documents may be cut freely, so the last windows then fill the small gaps of the others, and what
is left over goes into windows of powers of two, which need no padding.

Blocks follow the order of the input partitions, so no token is shuffled; a retried task packs the same way.

Edge cases: null and empty texts are the end id alone; rows without an id or with a repeated id are packed like others;
an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 1024
END = 0
BLOCK_DOCUMENTS = 256
MEMO = 1_000_000  # chunks of text that a worker remembers
SPECIAL = b"<|endoftext|>"  # an entry that no merging makes

Piece = tuple[int, int, int]  # place of the document in its block, start, length


_load = itemgetter(0)


def difference(loads: list[int], windows: int, capacity: int | None = None) -> list[list[int]] | None:
    """Partition of the places of ``loads`` into at most ``windows`` sets with near-equal sums; None once a window of a
    partial partition exceeds the capacity, as windows never shrink.

    A partial partition lists (load, members) in descending order and leaves out empty windows. Two of them meet as
    the largest window of one with the smallest of the other, always the two partitions with the largest imbalance.
    """
    heap: list[tuple[int, int, list]] = []
    for i, load in enumerate(loads):
        heap.append((-load if windows > 1 else 0, i, [(load, (i, None, None))]))
    heapq.heapify(heap)
    n = len(loads)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        both = max(0, len(one) + len(two) - windows)
        met = one[: len(one) - both] + two[: len(two) - both]
        if both:
            met += [(a[0] + b[0], (-1, a[1], b[1])) for a, b in zip(one[len(one) - both :], reversed(two[len(two) - both :]), strict=True)]
        met.sort(key=_load, reverse=True)
        if capacity is not None and met[0][0] > capacity:
            return None
        heapq.heappush(heap, (-(met[0][0] - (met[-1][0] if len(met) == windows else 0)), n, met))
        n += 1
    out = []
    for _, tree in heap[0][2] if heap else []:
        members, todo = [], [tree]
        while todo:
            place, left, right = todo.pop()
            if place >= 0:
                members.append(place)
            else:
                todo += [right, left]
        out.append(members)
    return out


def partition(loads: list[int], capacity: int) -> list[list[int]]:
    """Sets of places whose sums stay within the capacity; the number of sets rises until they do."""
    windows = max(1, -(-sum(loads) // capacity))
    while True:
        sets = difference(loads, windows, capacity)
        if sets is not None:
            return sets
        windows += 1


def pack(lengths: list[int], capacity: int = WINDOW) -> list[list[Piece]]:
    """Windows of pieces: all are full but the last few, whose lengths are powers of two."""
    full, rest, owner = [], [], []
    for i, n in enumerate(lengths):
        whole = n // capacity
        full += [[(i, k * capacity, capacity)] for k in range(whole)]
        if n % capacity:
            owner.append((i, whole * capacity))
            rest.append(n % capacity)
    sets = sorted(partition(rest, capacity), key=lambda s: -sum(rest[i] for i in s)) if rest else []
    windows = [[(owner[i][0], owner[i][1], rest[i]) for i in s] for s in sets]
    goal = sum(rest) // capacity
    givers = [piece for window in reversed(windows[goal:]) for piece in window]

    def take(room: int) -> list[Piece]:
        got = []
        while room:
            doc, start, length = givers.pop()
            got.append((doc, start, min(length, room)))
            if length > room:
                givers.append((doc, start + room, length - room))
            room -= min(length, room)
        return got

    for window in windows[:goal]:
        full.append(window + take(capacity - sum(length for _, _, length in window)))
    left = sum(length for _, _, length in givers)
    full += [take(1 << bit) for bit in reversed(range(left.bit_length())) if left >> bit & 1]
    return full


class Tokens:
    """Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit numbers.

    The vocabulary file is the ``tokenizers`` library's; the tests hold these ids against that library's. Merging runs in
    a faster library over the same entries. The vocabulary's pattern never joins a character that is no white space with a space after it, so a text falls
    into chunks at such spaces, and equal chunks have equal ids wherever they stand. Each distinct chunk is merged once per worker while there is room; unusual white space keeps its surroundings in one chunk.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        entries = content["model"]["vocab"]
        # Added tokens are found in texts before anything is merged, the longest first, as the library does.
        self.added = {x["content"]: struct.pack("<I", x["id"]) for x in content["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        # The file spells a byte as itself where it prints, and the others, in order, as characters from 256 on.
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in prints]
        byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in entry): i for entry, i in entries.items() if all(c in byte_of for c in entry)}
        ranks = {entry: i for entry, i in ranks.items() if entry != SPECIAL}
        # Ids rise in the order of the merges, so ranks are ids; the merging itself is the same for all chunks.
        self.merge = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.between = re.compile(r"(?<=\S) (?=\S)")
        self.unusual = re.compile(r" (?:(?=\s|\Z)|(?<=\s ))|\A ")
        self.heads: dict[str, bytes] = {}  # ids of chunks that begin a text
        self.memo: dict[str, bytes] = {}  # ids of chunks after a space, which is theirs
        self.packs: dict = {}

    def learn(self, memo: dict[str, bytes], fresh: set[str], before: str) -> None:
        if len(memo) + len(fresh) > MEMO:
            memo.clear()
        merge, packs = self.merge, self.packs
        for chunk in fresh:
            if chunk in memo:
                continue
            ids = merge(before + chunk)
            n = len(ids)
            memo[chunk] = (packs.get(n) or packs.setdefault(n, struct.Struct(f"<{n}I").pack))(*ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        unusual, cut = self.unusual.search, self.between.split
        chunked = [(cut(t) if unusual(t) else t.split(" ")) if t else [""] for t in texts]
        heads = [chunks[0] for chunks in chunked]
        for chunks in chunked:
            del chunks[0]
        self.learn(self.heads, set(heads), "")
        self.learn(self.memo, set().union(*chunked), " ")
        get = self.memo.__getitem__
        return [self.heads[head] + b"".join(map(get, chunks)) for head, chunks in zip(heads, chunked, strict=True)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """As ``encode``, with the file's added tokens as single ids."""
        out = self.encode([None if t and self.cut and self.cut.search(t) else t for t in texts])
        for i, text in enumerate(texts):
            if text and self.cut and self.cut.search(text):
                parts = self.cut.split(text)
                parts[::2] = self.encode(parts[::2])
                parts[1::2] = map(self.added.__getitem__, parts[1::2])
                out[i] = b"".join(parts)
        return out


def _packer(path: str, capacity: int):
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = np.array([END], dtype="<u4").tobytes()
    made: dict[str, Tokens] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = made.get(path) or made.setdefault(path, Tokens(path))
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin in range(0, len(batch), BLOCK_DOCUMENTS):
                block = batch.iloc[begin : begin + BLOCK_DOCUMENTS]
                ids = [raw + end for raw in tokens.ids(block["text"].tolist())]
                rows, owners = [], []
                for window in pack([len(raw) // 4 for raw in ids], capacity):
                    offset = 0
                    for doc, start, length in window:
                        raw = ids[doc]
                        rows.append((start, length, zlib.crc32(memoryview(raw)[4 * start : 4 * (start + length)]), len(raw) // 4, sequence, offset))
                        owners.append(doc)
                        offset += length
                    sequence += 1
                done = pd.DataFrame(rows, columns=columns)
                done.insert(0, "doc_id", block["doc_id"].to_numpy()[owners])
                yield done

    return run


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(documents: DataFrame, path: str | None = None, capacity: int = WINDOW) -> DataFrame:
    """One row per piece of (doc_id, text); ``path`` names the vocabulary file on the executors."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return documents.select("doc_id", "text").mapInPandas(_packer(path, capacity), PIECES)
