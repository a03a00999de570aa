"""Token counts by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch that a worker has not counted yet go into a trie, level by level. A node's forward
score is the least cost of a segmentation of its prefix: the score of the node that a piece starts from plus the
piece's cost, over all pieces that end here. It is found once per node, however many pre-tokens share the prefix, and
the node where a pre-token ends stores its count.

The pieces' costs are a unigram model: the vocabulary file ranks its pieces by frequency but has no probabilities, so
a piece of rank r costs log(r + 2), as Zipf's law has it, in whole units of 2^-16. Ties go to fewer pieces. A character
without a piece costs more than any path around it and counts as its UTF-8 bytes.

Edge cases: null and empty texts count 0; texts and pre-tokens of any length are taken whole; repeated rows count
alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from tidewatch.llm.common import mix64
from tidewatch.llm.pieces import Vocabulary

MEMO = 1_500_000
TRIE_DEPTH = 64  # longer pre-tokens, which share few prefixes, are counted one by one
UNIT = 1 << 16
STEP = 1 << 20  # room for a piece count under each cost: a path's cost breaks ties by its number of pieces
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


class Unigram:
    """Costs of pieces, by piece and as sorted hash tables by length."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        ranked = sorted(vocabulary.ids, key=lambda p: (-vocabulary.scores[p], vocabulary.ids[p]))
        self.cost = {p: round(math.log(r + 2) * UNIT) * STEP + 1 for r, p in enumerate(ranked)}
        self.unknown = 40 * UNIT * STEP
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []
        for length in sorted(set(map(len, ranked))):
            pieces = [p for p in ranked if len(p) == length]
            hashes = self._spell(np.array([[ord(c) for c in p] for p in pieces], dtype=np.uint64))
            costs = np.array([self.cost[p] for p in pieces], dtype=np.int64)
            order = np.argsort(hashes)
            self.tables.append((length, hashes[order], costs[order]))
        self.longest = self.tables[-1][0]

    @staticmethod
    def _spell(characters: np.ndarray) -> np.ndarray:
        h = np.zeros(len(characters), dtype=np.uint64)
        for i in range(characters.shape[1]):
            h = h * np.uint64(_MULTIPLIER) + mix64(characters[:, i] + np.uint64(1))
        return h

    def count(self, word: str) -> int:
        """Pieces of one pre-token's best segmentation, by itself."""
        n = len(word)
        best, pieces = [0] + [0] * n, [0] * (n + 1)
        for i in range(1, n + 1):
            bytes_ = len(word[i - 1].encode("utf-8", "replace"))
            least, many = best[i - 1] + self.unknown + bytes_, pieces[i - 1] + bytes_
            for j in range(max(0, i - self.longest), i):
                cost = self.cost.get(word[j:i])
                if cost is not None and best[j] + cost < least:
                    least, many = best[j] + cost, pieces[j] + 1
            best[i], pieces[i] = least, many
        return pieces[n]

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces of each pre-token; ``words`` are distinct, sorted and at most TRIE_DEPTH characters long."""
        n = len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        out = np.zeros(n, dtype=np.int64)
        # A level of the trie: parent's place in the level above, hash of the prefix, least cost, pieces on that path.
        levels = [(np.zeros(1, np.int64), np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        active, node = np.arange(n), np.zeros(n, dtype=np.int64)
        depth = 0
        while True:
            ends = sizes[active] == depth
            out[active[ends]] = levels[-1][3][node[ends]]
            active, node = active[~ends], node[~ends]
            if not len(active):
                return out
            depth += 1
            letter = text[begins[active] + depth - 1]
            fresh = np.concatenate(([True], (node[1:] != node[:-1]) | (letter[1:] != letter[:-1])))
            parent, own = node[fresh], letter[fresh]
            node = np.cumsum(fresh) - 1
            prefix = levels[-1][1][parent] * np.uint64(_MULTIPLIER) + mix64(own + np.uint64(1))
            bytes_ = 1 + (own >= 0x80).astype(np.int64) + (own >= 0x800) + (own >= 0x10000)
            least = levels[-1][2][parent] + self.unknown + bytes_
            many = levels[-1][3][parent] + bytes_
            above, reached, power = parent, 1, _MULTIPLIER
            for length, hashes, costs in self.tables:
                if length > depth:
                    break
                while reached < length:
                    above = levels[-reached][0][above]
                    reached += 1
                    power = power * _MULTIPLIER & 0xFFFFFFFFFFFFFFFF
                _, start_hash, start_cost, start_many = levels[-length]
                piece = prefix - start_hash[above] * np.uint64(power)
                at = np.minimum(np.searchsorted(hashes, piece), len(hashes) - 1)
                known = np.flatnonzero(hashes[at] == piece)
                cost = start_cost[above[known]] + costs[at[known]]
                better = cost < least[known]
                known, cost = known[better], cost[better]
                least[known] = cost
                many[known] = start_many[above[known]] + 1
            levels.append((parent, prefix, least, many))
            if len(levels) > self.longest + 1:
                levels.pop(0)


class Counter:
    """Counts of pre-tokens that a worker has met."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.unigram = Unigram(self.vocabulary)
        self.memo: dict[str, int] = {}

    def learn(self, fresh: list[str]) -> None:
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
        short = sorted(w for w in fresh if len(w) <= TRIE_DEPTH)
        self.memo.update(zip(short, self.unigram.counts(short).tolist() if short else [], strict=True))
        self.memo.update((w, self.unigram.count(w)) for w in fresh if len(w) > TRIE_DEPTH)

    def totals(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Pre-tokens and pieces of each text."""
        split = [self.vocabulary.words(t) if t else [] for t in texts]
        every = {w for words in split for w in words}
        if len(self.memo) + len(every) > MEMO:
            self.memo.clear()
        self.learn([w for w in every if w not in self.memo])
        return [(len(words), sum(map(self.memo.__getitem__, words))) for words in split]


_made: dict[str, Counter] = {}


def _count(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _made.get(path) or _made.setdefault(path, Counter(path))
        for batch in batches:
            done = pd.DataFrame(counter.totals(batch["text"].tolist()), columns=["n_pretokens", "n_tokens"])
            done.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield done

    return run


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every text; ``path`` names the model file on the executors."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return documents.select("doc_id", "text").mapInPandas(_count(path), "doc_id long, n_pretokens long, n_tokens long")
