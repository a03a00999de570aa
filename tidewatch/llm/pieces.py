"""A piece vocabulary as a weighted transducer: encoding is a shortest path, decoding its inverse.

Three machines are composed with each input. The normaliser puts the word mark in place of spaces and one before the
text. The piece machine has an arc per vocabulary entry that spells its characters and writes its id. The byte machine
spells any character as its UTF-8 bytes, for characters without an entry. Weights add along a path and the least path
wins (the tropical semiring).

For a vocabulary of merges every arc weighs 1, and an arc may only follow a piece that the merges would have left
standing next to it; any other sequence weighs infinity, so exactly one path is left, the one that merging gives. For
a vocabulary of log probabilities an arc weighs minus its score and any arc may follow any other.

Where no entry joins a character with a mark after it, the composed machine falls apart into one independent machine
per word, so equal words have equal paths; a worker remembers those it has found.

Edge cases: null and empty texts have no ids and decode to the empty text; the word mark itself decodes to a space, so
texts that contain it do not round-trip (``round_trip`` tells); texts of any length are taken whole; repeated rows are
encoded alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from tidewatch.llm.common import mix64

MARK = "▁"
MEMO_BYTES = 64_000_000  # of words and their ids that a worker remembers
FITS = 250_000  # answers on which piece may follow which that a worker remembers
ENTRY_BYTES = 200  # of a remembered word besides its characters and ids
SLICE = 1 << 21  # characters that are encoded at once; a longer text by itself
SLOT_BITS = 21  # answers that a worker keeps at hand on which piece may follow which
TREE_DEPTH = 64  # longer words, which share few beginnings, are encoded one by one
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BPE_MODEL, BYTE_PIECE, NORMAL_PIECE, USER_PIECE = 2, 6, 1, 4  # fixed values of the model file's format


class Vocabulary:
    """Pieces, ids, scores and the normaliser's switches of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.precompiled_charsmap:
            raise ValueError("the normaliser's character map is not supported")
        self.merges = model.trainer_spec.model_type == BPE_MODEL
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.squeeze = model.normalizer_spec.remove_extra_whitespaces
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL_PIECE, USER_PIECE)}
        self.scores = {p.piece: p.score for p in model.pieces if p.type in (NORMAL_PIECE, USER_PIECE)}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE_PIECE}
        self.spelling = [b""] * len(model.pieces)
        for piece, i in self.ids.items():
            self.spelling[i] = piece.replace(MARK, " ").encode()
        for byte, i in self.byte_ids.items():
            self.spelling[i] = bytes([byte])
        self.longest = max(map(len, self.ids))
        self.line_by_line = not any("\n" in p for p in self.ids)
        self.word_by_word = all(MARK not in p.lstrip(MARK) for p in self.ids)

    def words(self, text: str) -> list[str]:
        """The normalised text, cut where no entry reaches across."""
        text = text.replace(MARK, " ")
        if self.squeeze:
            text = " ".join(text.split(" "))
        if not text:
            return []
        if not self.word_by_word:
            return [(MARK if self.prefix else "") + text.replace(" ", MARK)]
        if not self.line_by_line or "\n" not in text:
            return self._line(text, self.prefix)
        first, *rest = text.split("\n")
        out = self._line(first, self.prefix)
        for line in rest:
            out.append("\n")
            if line:
                out += self._line(line, False)
        return out

    @staticmethod
    def _line(text: str, prefix: bool) -> list[str]:
        """Words of a line, each with the marks before it; ``prefix`` puts a mark before the first."""
        parts = text.split(" ")
        if "" not in parts:
            marked = [MARK + p for p in parts]
            if not prefix:
                marked[0] = parts[0]
            return marked
        out, head = [], MARK if prefix else ""
        for i, part in enumerate(parts):
            head += MARK if i else ""
            if part:
                out.append(head + part)
                head = ""
        return [*out, head] if head else out


class Transducer:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        # Merge order: the higher score first, then the smaller id.
        order = sorted(v.ids, key=lambda p: (-v.scores[p], v.ids[p]))
        self.rank = {p: i for i, p in enumerate(order)}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0
        self.by_length: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.slot_keys = np.full(1 << SLOT_BITS, -1, dtype=np.int64)
        self.slot_fits = np.zeros(1 << SLOT_BITS, dtype=bool)
        # Ends of entries: the entry's place in the merge order, or -1 for what is only the end of a longer one.
        self.tails: dict[str, int] = {}
        self.order = order
        for place, piece in enumerate(order):
            if not v.merges or len(piece) == 1 or self._split(piece) != ("", ""):
                self.tails[piece] = place
                for i in range(1, len(piece)):
                    self.tails.setdefault(piece[i:], -1)
        for piece, place in self.rank.items():
            if self.tails.get(piece) == -1 and (not v.merges or len(piece) == 1 or self._split(piece) != ("", "")):
                self.tails[piece] = place

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes this one; None for a single character; ('', '') if merging never makes it."""
        if len(piece) == 1:
            return None
        if piece not in self.halves:
            parts = list(piece)
            last = ("", "")
            while len(parts) > 1:
                ranks = [self.rank.get(a + b, math.inf) for a, b in zip(parts, parts[1:], strict=False)]
                best = min(ranks)
                if best == math.inf:
                    break
                i = ranks.index(best)
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.halves[piece] = last if len(parts) == 1 else ("", "")
        return self.halves[piece]

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging leaves these two pieces standing side by side.

        Merges inside the two are undone from the latest back; before each of them the pieces then facing each other
        must not have been due for an earlier merge.
        """
        limit, rank = math.inf, self.rank
        while True:
            due = rank.get(left + right)
            if due is not None and due < limit:
                return False
            a = rank[left] if len(left) > 1 else -1
            b = rank[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            # Of two equal merges the left one comes first, so the right one is undone first.
            if a > b:
                limit = a
                left = self._split(left)[1]
            else:
                limit = b + 0.5
                right = self._split(right)[0]

    def _merge_path(self, word: str) -> list[int | str]:
        """Places in the merge order of the pieces on the one finite path; a character without an entry is itself.

        Any prefix of the word has exactly one finite path, so a position keeps its last piece only. A single
        character is the last arc where no longer one may follow.
        """
        tails, fits = self.tails, self.fits
        back: list[tuple[int, int]] = [(0, -1)]
        for i in range(1, len(word) + 1):
            ends = []
            for j in range(i - 1, -1, -1):
                place = tails.get(word[j:i])
                if place is None:
                    break
                if place >= 0:
                    ends.append((j, place))
            best = (i - 1, -1)
            for j, place in reversed(ends):
                before = back[j][1]
                if j and before >= 0:
                    key = before << 32 | place
                    fit = fits.get(key)
                    if fit is None:
                        if len(fits) >= FITS:
                            fits.clear()
                        fit = fits[key] = self._may_follow(self.order[before], self.order[place])
                    if not fit:
                        continue
                best = (j, place)
                break
            back.append(best)
        out, i = [], len(word)
        while i:
            j, place = back[i]
            out.append(place if place >= 0 else word[j:i])
            i = j
        return out[::-1]

    def _score_path(self, word: str) -> list[int | str]:
        """The same for log probabilities: the path of the least sum."""
        v, n = self.vocabulary, len(word)
        missing = 10.0 - min(v.scores.values())
        cost, back = [0.0] + [math.inf] * n, [(0, -1)] * (n + 1)
        for i in range(1, n + 1):
            cost[i], back[i] = cost[i - 1] + missing, (i - 1, -1)
            for j in range(i - 1, -1, -1):
                place = self.tails.get(word[j:i])
                if place is None:
                    break
                if place >= 0 and cost[j] - v.scores[self.order[place]] < cost[i]:
                    cost[i], back[i] = cost[j] - v.scores[self.order[place]], (j, place)
        out, i = [], n
        while i:
            j, place = back[i]
            out.append(place if place >= 0 else word[j:i])
            i = j
        return out[::-1]

    def _ids(self, word: str) -> bytes:
        v, out = self.vocabulary, []
        for piece in self._merge_path(word) if v.merges else self._score_path(word):
            if isinstance(piece, int):
                out.append(v.ids[self.order[piece]])
            else:
                out += [v.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return struct.pack(f"<{len(out)}i", *out)

    def _tables(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Entries by length: sorted hashes of their spellings, and their places in the merge order."""
        if not self.by_length:
            for length in sorted({len(p) for p, place in self.tails.items() if place >= 0}):
                pieces = [p for p, place in self.tails.items() if place >= 0 and len(p) == length]
                letters = np.array([[ord(c) for c in p] for p in pieces], dtype=np.uint64)
                hashes = np.zeros(len(pieces), dtype=np.uint64)
                for i in range(length):
                    hashes = hashes * _MULTIPLIER + mix64(letters[:, i] + np.uint64(1))
                order = np.argsort(hashes)
                self.by_length.append((length, hashes[order], np.array([self.tails[p] for p in pieces], dtype=np.int64)[order]))
        return self.by_length

    def _fitting(self, keys: np.ndarray) -> np.ndarray:
        """For pairs (left place * 2^32 + right place): whether the right piece may follow the left one."""
        slots = ((keys.view(np.uint64) * _MULTIPLIER) >> np.uint64(64 - SLOT_BITS)).view(np.int64)
        out = self.slot_fits[slots]
        unknown = np.flatnonzero(self.slot_keys[slots] != keys)
        if len(unknown):
            distinct, first, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
            fits = np.empty(len(distinct), dtype=bool)
            for i, key in enumerate(distinct.tolist()):
                fit = self.fits.get(key)
                if fit is None:
                    if len(self.fits) >= FITS:
                        self.fits.clear()
                    fit = self.fits[key] = self._may_follow(self.order[key >> 32], self.order[key & 0xFFFFFFFF])
                fits[i] = fit
            self.slot_keys[slots[unknown[first]]] = distinct
            # Of keys that share a slot the last one written stays, with its own answer.
            mine = self.slot_keys[slots[unknown[first]]] == distinct
            self.slot_fits[slots[unknown[first]][mine]] = fits[mine]
            out[unknown] = fits[back]
        return out

    def paths(self, words: list[str]) -> list[bytes]:
        """Ids of many words at once: the machine is composed with the prefix tree of the words, level by level, so
        words that begin alike share the beginning of their paths. ``words`` are distinct and sorted."""
        n = len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
        begins = np.cumsum(sizes) - sizes
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        # Of each node: the last piece, the node it starts from, pieces so far, and whether a character had no entry.
        last, start = [np.full(1, -1, np.int64)], [np.zeros(1, np.int64)]
        many, odd = [np.zeros(1, np.int64)], [np.zeros(1, dtype=bool)]
        prefix, parents, firsts = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], [0]
        end = np.zeros(n, dtype=np.int64)  # the node where a word ends
        active, node, depth, nodes = np.arange(n), np.zeros(n, dtype=np.int64), 0, 1
        while True:
            done = sizes[active] == depth
            end[active[done]] = node[done] + firsts[depth]
            active, node = active[~done], node[~done]
            if not len(active):
                break
            depth += 1
            letter = text[begins[active] + depth - 1]
            fresh = np.concatenate(([True], (node[1:] != node[:-1]) | (letter[1:] != letter[:-1])))
            parent, own = node[fresh], letter[fresh]
            node = np.cumsum(fresh) - 1
            spelled = prefix[-1][parent] * _MULTIPLIER + mix64(own + np.uint64(1))
            prefix.append(spelled)
            parents.append(parent)
            arcs, above, reached, power = [], parent, 1, int(_MULTIPLIER)
            for length, hashes, places in self._tables():
                if length > depth:
                    break
                while reached < length:
                    above = parents[depth - reached][above]
                    reached += 1
                    power = power * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF
                piece = spelled - prefix[depth - length][above] * np.uint64(power)
                at = np.minimum(np.searchsorted(hashes, piece), len(hashes) - 1)
                met = np.flatnonzero(hashes[at] == piece)
                arcs.append((length, met, places[at[met]], above[met]))
            size = len(parent)
            own_last, own_start = np.full(size, -1, np.int64), parent + firsts[depth - 1]
            own_many, own_odd = many[-1][parent] + 1, odd[-1][parent].copy()
            free = np.ones(size, dtype=bool)
            for length, met, places, above in reversed(arcs):
                open_ = free[met]
                met, places, above = met[open_], places[open_], above[open_]
                before = last[depth - length][above]
                if length > 1:
                    # An odd node's words are encoded one by one, so what follows an odd character does not matter here.
                    fit = before < 0
                    check = np.flatnonzero(~fit)
                    fit[check] = self._fitting((before[check] << 32) | places[check])
                    met, places, above = met[fit], places[fit], above[fit]
                free[met] = False
                own_last[met], own_start[met] = places, above + firsts[depth - length]
                own_many[met], own_odd[met] = many[depth - length][above] + 1, odd[depth - length][above]
            own_odd |= free
            last.append(own_last)
            start.append(own_start)
            many.append(own_many)
            odd.append(own_odd)
            firsts.append(nodes)
            nodes += size
        pieces, froms = np.concatenate(last), np.concatenate(start)
        count, strange = np.concatenate(many)[end], np.concatenate(odd)[end]
        stops = np.cumsum(count)
        ids = np.zeros(int(stops[-1]) if n else 0, dtype=np.int32)
        to_id = np.array([self.vocabulary.ids[p] for p in self.order], dtype=np.int32)
        at, here = stops - 1, end
        while len(here):
            ids[at] = to_id[pieces[here]]
            here = froms[here]
            going = here > 0
            at, here = at[going] - 1, here[going]
        raw, cuts = ids.tobytes(), (stops * 4).tolist()
        out = [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        for i in np.flatnonzero(strange):
            out[i] = self._ids(words[i])
        return out

    def learn(self, texts: list[list[str]]) -> None:
        """Remember the ids of all words of these texts; the words of earlier ones go where there is no room."""
        every = set().union(*texts)
        if self.memo_bytes > MEMO_BYTES:
            self.memo.clear()
            self.memo_bytes = 0
        fresh = [w for w in every if w not in self.memo]
        found: list[tuple[str, bytes]] = []
        if self.vocabulary.merges:
            short = sorted(w for w in fresh if len(w) <= TREE_DEPTH)
            found += zip(short, self.paths(short), strict=True)
            fresh = [w for w in fresh if len(w) > TREE_DEPTH]
        found += [(w, self._ids(w)) for w in fresh]
        self.memo.update(found)
        self.memo_bytes += sum(ENTRY_BYTES + len(w) + len(ids) for w, ids in found)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.vocabulary.words(t) if t else [] for t in texts]
        self.learn(split)
        get = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype=np.int32) for words in split]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.vocabulary.spelling.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.vocabulary.prefix and text.startswith(" ") else text


_made: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker and model file."""
    if path not in _made:
        _made[path] = Transducer(path)
    return _made[path]


def slices(texts: pd.Series) -> Iterator[slice]:
    """Runs of rows of about ``SLICE`` characters."""
    sizes = np.cumsum([len(t) if t else 0 for t in texts]) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b)


def _encode(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for batch in batches:
            for part in map(batch.iloc.__getitem__, slices(batch["text"])):
                rows = []
                for text, ids in zip(part["text"], machine.encode_all(part["text"].tolist()), strict=True):
                    back = machine.decode(ids)
                    rows.append((len(ids), ids, hashlib.sha256(back.encode("utf-8", "replace")).hexdigest(), back == (text or "")))
                done = pd.DataFrame(rows, columns=["n_ids", "ids", "decoded_sha256", "round_trip"])
                done.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield done

    return run


def encoded(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every text, and what they decode to; ``path`` names the model file on the executors."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    schema = "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, round_trip boolean"
    return documents.select("doc_id", "text").mapInPandas(_encode(path), schema)


def _decode(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for batch in batches:
            texts = [machine.decode(np.asarray(ids, dtype=np.int64)) if ids is not None else "" for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    return run


def decoded(encodings: DataFrame, path: str | None = None) -> DataFrame:
    """Texts of (doc_id, ids)."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return encodings.select("doc_id", "ids").mapInPandas(_decode(path), "doc_id long, text string")
