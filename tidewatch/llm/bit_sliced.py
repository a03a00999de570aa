"""Ranked lexical search over bit-sliced Bloom signatures.

One pass over the documents builds the index. Documents of about equal richness are put in blocks, and a block is a stack
of bitmaps: every term sets four bits of its document's column, and so does "this term more than 1, 2, 4, ... times". Read
across, a row of the stack is a slice, one bit per document. The bits of a term are the AND of its four slices, which never
misses a document that holds the term and marks a few that do not. The same pass counts documents per term and terms per
document.

A search adds up, per item and document, the weight of each term times what it can give at most for the highest count
that the slices admit: an upper bound of the score. The documents of the highest bounds are scored exactly from their
texts; the tenth best of these scores is a floor, and every document whose bound reaches it is scored exactly, so nothing that
could be among the ten is left out. Equal texts are scored once. Items are searched in blocks of about ``ITEM_TERMS``
terms, each with two scans of the index; only the terms of such a block are sent to tasks.

Edge cases: a null or empty text and one without terms has no term, counts nowhere and is never found; documents without
an id are found like others, after equal scores with one; rows that repeat an id or a text are documents of their own; rows of one item id are one item with the terms of all of them, those
without an id included; items without a term that any document holds give no rows; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import mix64, table
from tidewatch.session import stage

BITS_PER_TOKEN, HASHES = 16, 4
COUNTS = (1, 2, 4, 8, 16, 32)  # a count above one of these sets a token of its own
BLOCK_DOCS, BLOCK_CELLS = 1024, 1 << 23
ITEM_TERMS = 20_000
BEST, TRIED = 10, 40
MEMO = 200_000
SLICE = 2048  # documents whose terms are held at once

# Bytes of terms, A-Z in lower case; every other byte is a gap. Bytes from 0x80 on belong to characters beyond ASCII.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

_INDEX = (
    "kind string, term binary, df long, documents long, terms long, "
    "ids array<long>, texts_a array<long>, texts_b array<long>, lengths array<long>, height long, slices binary"
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_BYTES).split() if text else []


class TermHashes(dict):
    """64-bit hashes of terms, remembered while there is room."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[term] = xxhash.xxh64_intdigest(term)
        return value


def _level(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix64(hashes + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64))


def _places(tokens: np.ndarray, height: int) -> np.ndarray:
    """The rows of each token, [hash, token]."""
    first, step = tokens >> np.uint64(32), (tokens & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((first + turns * step) % np.uint64(height)).astype(np.int64)


# ---- index ------------------------------------------------------------------


def _signature(counts: Counter, hashes: TermHashes) -> np.ndarray:
    own = np.fromiter(map(hashes.__getitem__, counts), dtype=np.uint64, count=len(counts))
    times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    parts = [_level(own, 0)]
    for level, most in enumerate(COUNTS, 1):
        above = times > most
        if not above.any():
            break
        parts.append(_level(own[above], level))
    return np.concatenate(parts)


def _cut(sizes: np.ndarray) -> Iterator[slice]:
    """Blocks of documents sorted by their number of tokens: alike in size, bounded in documents and in bits."""
    start = 0
    for i in range(1, len(sizes) + 1):
        full = i == len(sizes) or i - start >= BLOCK_DOCS or sizes[i] > 2 * sizes[start]
        if full or (i + 1 - start) * int(sizes[i]) * BITS_PER_TOKEN > BLOCK_CELLS:
            yield slice(start, i)
            start = i


def _stack(signatures: list[np.ndarray]) -> tuple[int, bytes]:
    height = BITS_PER_TOKEN * max(map(len, signatures))
    tokens = np.concatenate(signatures)
    column = np.repeat(np.arange(len(signatures)), [len(s) for s in signatures])
    bits = np.zeros((height, len(signatures)), dtype=bool)
    for row in _places(tokens, height):
        bits[row, column] = True
    return height, np.packbits(bits, axis=1).tobytes()


def _indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of documents, documents per term, and totals."""
    hashes, held, totals = TermHashes(), Counter(), [0, 0]

    def lexicon() -> pd.DataFrame:
        done = pd.DataFrame({"kind": "term", "term": list(held), "df": list(held.values())})
        held.clear()
        return _filled(done)

    for batch in (whole.iloc[i : i + SLICE] for whole in batches for i in range(0, len(whole), SLICE)):
        found = []
        for place, text in enumerate(batch["text"]):
            terms = terms_of(text)
            if terms:
                counts = Counter(terms)
                held.update(counts.keys())
                found.append((place, len(terms), _signature(counts, hashes)))
        found.sort(key=lambda x: len(x[2]))
        totals = [totals[0] + len(found), totals[1] + sum(x[1] for x in found)]
        ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
        a, b = batch["text_a"].to_numpy(), batch["text_b"].to_numpy()
        for part in _cut(np.array([len(x[2]) for x in found])) if found else ():
            own = found[part]
            at = [x[0] for x in own]
            height, slices = _stack([x[2] for x in own])
            one = {"kind": "block", "ids": [ids[i] for i in at], "texts_a": a[at], "texts_b": b[at], "lengths": [x[1] for x in own]}
            yield _filled(pd.DataFrame([{**one, "height": height, "slices": slices}]))
        if len(held) > MEMO:
            yield lexicon()
    yield lexicon()
    yield _filled(pd.DataFrame([{"kind": "total", "documents": totals[0], "terms": totals[1]}]))


def _filled(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows with all columns of the index, null where they have none."""
    rows = rows.reindex(columns=[c.split()[0] for c in _INDEX.split(", ")]).astype(object)
    return rows.where(rows.notna(), None)


def _documents(documents: DataFrame) -> DataFrame:
    a, b = F.xxhash64("text"), F.xxhash64(F.lit("second"), "text")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").withColumns({"text_a": a, "text_b": b})


@dataclass(frozen=True)
class Index:
    """The stored index of a table of documents."""

    documents: DataFrame
    parts: DataFrame
    n: int
    length: int

    def blocks(self) -> DataFrame:
        return self.parts.where("kind = 'block'").select("ids", "texts_a", "texts_b", "lengths", "height", "slices")

    def lexicon(self) -> DataFrame:
        return self.parts.where("kind = 'term'").groupBy("term").agg(F.sum("df").alias("df"))


def build(documents: DataFrame) -> Index:
    rows = _documents(documents)
    parts = stage(rows.mapInPandas(_indexed, _INDEX), "index")
    total = parts.where("kind = 'total'").agg(F.sum("documents").alias("n"), F.sum("terms").alias("length")).first()
    return Index(rows, parts, total["n"] or 0, total["length"] or 0)


# ---- search -----------------------------------------------------------------


@dataclass(frozen=True)
class Items:
    """A block of items: their terms' hashes and weights, and for each item the places of its terms."""

    ids: tuple
    terms: tuple[bytes, ...]
    hashes: np.ndarray
    weights: np.ndarray
    places: tuple[np.ndarray, ...]
    n: int
    length: int

    def shares(self, lengths: list[int]) -> np.ndarray:
        """What the length of each document adds to the count that halves a term's worth."""
        return np.array([8 * (100 - 90 + 90 * own * self.n // self.length) for own in lengths], dtype=np.int64)


def _weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _items(rows: list, index: Index) -> Items:
    terms = sorted({bytes(r.term): _weight(index.n, r.df) for r in rows}.items())
    at = {term: i for i, (term, _) in enumerate(terms)}
    own: dict = {}
    for r in rows:
        own.setdefault(r.item_id, []).append(at[bytes(r.term)])
    hashes = np.array([xxhash.xxh64_intdigest(term) for term, _ in terms], dtype=np.uint64)
    weights = np.array([w for _, w in terms], dtype=np.int64)
    return Items(tuple(own), tuple(at), hashes, weights, tuple(np.array(p) for p in own.values()), index.n, index.length)


def _bounds(items: Items, block) -> np.ndarray:
    """Upper bounds of the scores of a block's documents, [item, document]."""
    lengths, height = np.array(block.lengths, dtype=np.int64), int(block.height)
    slices = np.frombuffer(block.slices, dtype=np.uint8).reshape(height, -1)

    def admitted(hashes: np.ndarray, level: int) -> np.ndarray:
        rows = _places(_level(hashes, level), height)
        return reduce(np.bitwise_and, (slices[r] for r in rows))

    bits = admitted(items.hashes, 0)
    active = np.flatnonzero(bits.any(axis=1))
    bits, hashes = bits[active], items.hashes[active]
    levels = np.unpackbits(bits, axis=1, count=len(lengths))
    rising = np.arange(len(active))
    for level in range(1, len(COUNTS) + 1):
        bits = bits & admitted(hashes[rising], level)
        more = bits.any(axis=1)
        bits, rising = bits[more], rising[more]
        if not len(rising):
            break
        levels[rising] += np.unpackbits(bits, axis=1, count=len(lengths))
    shares = items.shares(lengths.tolist())
    worth = np.zeros((len(COUNTS) + 2, len(lengths)), dtype=np.int64)
    for level, most in enumerate((*COUNTS, None), 1):
        count = lengths if most is None else np.minimum(most, lengths)
        worth[level] = 1_000_000_000 * count // (1000 * count + shares)
    gains = worth[levels, np.arange(len(lengths))] * items.weights[active][:, None]
    at = np.full(len(items.hashes), -1)
    at[active] = np.arange(len(active))
    out = np.zeros((len(items.places), len(lengths)), dtype=np.int64)
    for i, places in enumerate(items.places):
        own = at[places]
        own = own[own >= 0]
        if len(own):
            out[i] = gains[own].sum(axis=0)
    return out


_FOUND = "item int, doc_id long, text_a long, text_b long, bound long"


def _found(block, item: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> pd.DataFrame:
    ids, a, b = np.array(block.ids, dtype=object), np.array(block.texts_a), np.array(block.texts_b)
    done = pd.DataFrame({"item": item.astype(np.int32), "text_a": a[place], "text_b": b[place], "bound": bounds[item, place]})
    done.insert(1, "doc_id", pd.array(ids[place], dtype="Int64"))
    return done


def _highest(items: Items):
    """Of each task and item, the documents of the highest bounds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for block in batch.itertuples():
                bounds = _bounds(items, block)
                width = min(TRIED, bounds.shape[1])
                place = np.argpartition(-bounds, width - 1, axis=1)[:, :width].ravel()
                new = _found(block, np.repeat(np.arange(len(bounds)), width), place, bounds)
                held = pd.concat([x for x in (held, new[new["bound"] > 0]) if x is not None])
                held = held.sort_values("bound", ascending=False, kind="stable").groupby("item").head(TRIED)
        if held is not None:
            yield held

    return run


def _reaching(items: Items, floors: np.ndarray):
    """All documents whose bound reaches the item's floor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples():
                bounds = _bounds(items, block)
                item, place = np.nonzero(bounds >= floors[:, None])
                yield _found(block, item, place, bounds)

    return run


def _scores(items: Items):
    weights = items.weights.tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, a, b, wanted in zip(batch["text"], batch["text_a"], batch["text_b"], batch["items"], strict=True):
                terms = terms_of(text)
                counts, share = Counter(terms), int(items.shares([len(terms)])[0])
                for item in wanted:
                    score = 0
                    for place in items.places[item].tolist():
                        times = counts.get(items.terms[place], 0)
                        score += weights[place] * (1_000_000_000 * times // (1000 * times + share))
                    rows.append((item, a, b, score))
            yield pd.DataFrame(rows, columns=["item", "text_a", "text_b", "score"])

    return run


def _ranked(index: Index, items: Items, found: DataFrame) -> DataFrame:
    """(item, rank, doc_id, score) of the best of the documents found, scored exactly. Of equal texts ten will do."""
    text = ["text_a", "text_b"]
    copies = Window.partitionBy("item", *text).orderBy(F.asc_nulls_last("doc_id"))
    found = stage(found.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= BEST), "candidates")
    wanted = found.groupBy(*text).agg(F.min("doc_id").alias("own_id"), F.collect_set("item").alias("items"))  # items of one block
    wanted = stage(wanted, "texts-wanted")
    same = [F.col(f"d.{c}") == F.col(f"w.{c}") for c in text] + [F.col("doc_id").eqNullSafe(F.col("own_id"))]
    texts = index.documents.alias("d").join(wanted.alias("w"), same).select("d.text", *[f"d.{c}" for c in text], "items")
    scores = texts.mapInPandas(_scores(items), "item int, text_a long, text_b long, score long")
    scores = scores.groupBy("item", *text).agg(F.max("score").alias("score")).where("score > 0")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.join(scores, ["item", *text]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return best.select("item", "rank", "doc_id", "score")


def _searched(index: Index, items: Items) -> DataFrame:
    highest = index.blocks().mapInPandas(_highest(items), _FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
    tried = highest.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TRIED).drop("place")
    floors = np.ones(len(items.ids), dtype=np.int64)
    for row in _ranked(index, items, tried).where(F.col("rank") == BEST).collect():  # one row per item of the block
        floors[row["item"]] = row["score"]
    done = stage(_ranked(index, items, index.blocks().mapInPandas(_reaching(items, floors), _FOUND)), "ranked")
    names = done.sparkSession.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
    return done.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(i, term) for i, text in zip(batch["item_id"], batch["text"], strict=True) for term in set(terms_of(text))]
        done = pd.DataFrame(rows, columns=["item_id", "term"])
        yield done.assign(item_id=done["item_id"].astype("Int64"))


def search(index: Index, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ten best documents of each item."""
    spark = items.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInPandas(_item_terms, "item_id long, term binary")
    terms = stage(rows.distinct().join(index.lexicon(), "term"), "item-terms")
    blocks = math.ceil(terms.count() / ITEM_TERMS)
    own: Column = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) if blocks else F.lit(0)
    done = [_searched(index, _items(found, index)) for i in range(blocks) if (found := terms.where(own == i).collect())]
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, done) if done else empty


def ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals GROUP BY term
),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // len))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""
