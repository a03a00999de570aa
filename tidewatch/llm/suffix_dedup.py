"""Removal of byte strings that occur more than once, by two-stage suffix arrays over the places where they can occur.

Every string of ``length`` bytes contains one anchor: of its 64-byte grams, the first with the least hash. Equal
strings have equal anchors, so a string can only repeat where an anchor's gram does. Strings that share one anchor
occurrence lie side by side and form its context, at most 2 * length - 64 bytes.

1. Anchors of all texts are counted by gram; those that occur once are done with.
2. Contexts that occur whole more than once are repeated in full; this is decided by 128 bits of hash.
3. Of the other contexts one per distinct content is cut out of its text, dealt to blocks by gram, and a suffix array
   of each block tells which of its strings repeat: suffixes smaller than their successors are sorted directly, the
   others are induced from them by scanning the buckets, and the common prefixes of neighbours are measured.
   A gram with more contexts than a block may hold is settled by counting the hashes of its strings instead, so that
   no task ever holds an unbounded group.
4. The repeated strings of a document merge into spans.

Edge cases: a null text is an empty text; texts shorter than ``length`` keep all bytes. A place belongs to an id and a
text (by 64 bits of hash, within that id): rows that share an id but not a text are searched and cut each for itself,
rows without an id like all others. Rows that repeat both count as two places, and each loses the spans found for both.
An empty table gives no rows. Other columns, whatever their names, are carried along or not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import mix64
from tidewatch.session import stage

LENGTH = 200
GRAM = 64
BLOCK_CONTEXTS = 4000  # contexts that a block's suffix array is aimed at; a gram may add as many again

_BASE = 0x9E3779B97F4A7C15 | 1


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            steps = np.full(n, _BASE, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            steps[0] = 1
            self.down = np.cumprod(steps, dtype=np.uint64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window: prefix and suffix minima of blocks of one window's width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, powers: Powers, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first start, last start, gram hash, context hash) of each anchor's strings; starts are dealt out without rest."""
    n = len(data)
    if n < length:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    powers.reach(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:n], out=sums[1:])
    grams = mix64((sums[GRAM:] - sums[: n - GRAM + 1]) * powers.down[: n - GRAM + 1])
    # The upper half of the hash decides, then the place: the first of equal grams.
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_least(ranked, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:] - 1, [len(place) - 1]))
    at = place[first]
    whole = (sums[last + length] - sums[first]) * powers.down[first]
    shape = (last - first).astype(np.uint64) * np.uint64(1 << 20) + (at - first).astype(np.uint64)
    return first, last, grams[at], mix64(whole + mix64(shape))


def _find_anchors(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            parts = []
            for doc_id, mark, text in zip(batch["doc_id"], batch["mark"], batch["text"], strict=True):
                if text and len(text) * 4 >= length:
                    first, last, gram, context = anchors(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), powers, length)
                    if len(first):
                        of = np.full(len(first), doc_id, np.int64), np.full(len(first), mark, np.int64)
                        parts.append((*of, first, (last - first).astype(np.int32), gram.view(np.int64), context.view(np.int64)))
            if parts:
                columns = ["doc_id", "mark", "start", "extra", "gram", "context"]
                yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    return run


# ---- two-stage suffix array of a block -------------------------------------


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the end of the text is smaller than all."""
    n = len(text)
    rises = np.zeros(n, dtype=bool)
    if n > 1:
        change = np.flatnonzero(text[1:] != text[:-1])  # last place of each run of one byte
        up = text[change + 1] > text[change]
        run = np.searchsorted(change, np.arange(n - 1))
        known = run < len(change)
        rises[: n - 1][known] = up[run[known]]
    return rises


def two_stage_order(text: np.ndarray, needed: np.ndarray, length: int) -> np.ndarray:
    """The needed suffixes in the order of their first ``length`` bytes at least.

    ``needed`` has, for each suffix that is larger than its successor, the successor too. Directly sorted are only
    suffixes smaller than their successors; each bucket (one first byte) then hands the places before its suffixes on
    to the buckets of their bytes, in order.
    """
    rises = _types(text)
    padded = np.concatenate((text, np.zeros(length, dtype=np.uint8)))
    views = np.lib.stride_tricks.sliding_window_view(padded, length)
    direct = np.flatnonzero(needed & rises)
    keys = np.ascontiguousarray(views[direct]).view(f"S{length}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    del keys
    # What is larger than its successor and has none: the last place of the text.
    seeds = np.flatnonzero(needed & ~rises)
    seeds = seeds[seeds == len(text) - 1]
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    for seed in seeds:
        waiting[text[seed]].append(np.array([seed]))
    bounds = np.searchsorted(text[direct], np.arange(257))
    order = []
    for byte in range(256):
        got = waiting[byte]
        fresh = np.concatenate(got) if got else np.empty(0, dtype=np.int64)
        bucket = []
        while len(fresh):
            bucket.append(fresh)
            before = fresh[fresh > 0] - 1
            fresh = before[needed[before] & ~rises[before] & (text[before] == byte)]
        bucket.append(direct[bounds[byte] : bounds[byte + 1]])
        done = np.concatenate(bucket)
        if not len(done):
            continue
        order.append(done)
        before = done[done > 0] - 1
        before = before[needed[before] & ~rises[before] & (text[before] > byte)]
        if len(before):
            values = text[before]
            before = before[np.argsort(values, kind="stable")]
            to, starts = np.unique(text[before], return_index=True)
            for value, part in zip(to, np.split(before, starts[1:]), strict=True):
                waiting[value].append(part)
    return np.concatenate(order) if order else np.empty(0, dtype=np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Bytes, up to ``length``, that each suffix shares with the one before it in the order."""
    padded = np.concatenate((text, np.zeros(length, dtype=np.uint8)))
    views = np.lib.stride_tricks.sliding_window_view(padded, length)
    out = np.zeros(len(order), dtype=np.int64)
    for i in range(1, len(order), 20_000):
        part = slice(i, min(i + 20_000, len(order)))
        differ = views[order[part]] != views[order[part.start - 1 : part.stop - 1]]
        out[part] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return out


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, the starts of its strings that occur in another context too."""
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    wanted = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(wanted, begins[:-1], 1)
    np.add.at(wanted, begins[1:] - length + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    # Suffixes that others are induced from: from the last wanted place on to the first that is sorted directly.
    rises = _types(text)
    stops = np.append(np.flatnonzero(rises), len(text) - 1)
    ends = begins[1:] - length
    until = stops[np.searchsorted(stops, ends)]
    marks = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(marks, ends, 1)
    np.add.at(marks, until + 1, -1)
    needed = wanted | (np.cumsum(marks[:-1]) > 0)
    order = two_stage_order(text, needed, length)
    order = order[wanted[order]]
    same = common_prefixes(text, order, length) >= length
    twice = np.zeros(len(text), dtype=bool)
    twice[order[same]] = True
    twice[order[np.flatnonzero(same) - 1]] = True
    found = np.flatnonzero(twice)
    cuts = np.searchsorted(found, begins)
    return [found[cuts[i] : cuts[i + 1]] - begins[i] for i in range(len(contexts))]


def _block_spans(length: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        starts = repeated_starts(list(block["content"]), length)
        for doc_id, mark, start, alone, places in zip(block["doc_id"], block["mark"], block["start"], block["alone"], starts, strict=True):
            if alone and len(places):
                breaks = np.flatnonzero(np.diff(places) > length) + 1
                for part in np.split(places, breaks):
                    rows.append((doc_id, mark, start + part[0], start + part[-1] + length))
        return pd.DataFrame(rows, columns=["doc_id", "mark", "first", "stop"]).astype("int64")

    return run


# ---- the distributed operator ----------------------------------------------


def place_of(documents: DataFrame) -> tuple[Column, Column]:
    """What tells the rows of a table apart: the id (0 if there is none) and a hash of the text."""
    return F.coalesce(documents["doc_id"].cast("long"), F.lit(0)), F.xxhash64(documents["doc_id"].isNull(), documents["text"])


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, mark, first, stop): merged byte ranges covered by strings that start anywhere else too, by ``place_of``."""
    doc_id, mark = place_of(documents)
    texts = documents.where(documents["text"].isNotNull()).select(doc_id.alias("doc_id"), mark.alias("mark"), documents["text"])
    schema = "doc_id long, mark long, start long, extra int, gram long, context long"
    found = stage(texts.mapInPandas(_find_anchors(length), schema), "anchors")
    grams = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    hits = stage(found.join(grams, "gram"), "anchor-hits")
    contexts = stage(
        hits.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "start", "extra")).alias("place")), "contexts"
    )
    whole = hits.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"])
    spans = whole.select("doc_id", "mark", F.col("start").alias("first"), (F.col("start") + F.col("extra") + length).alias("stop"))

    kinds = contexts.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = contexts.join(kinds, "gram").select("gram", "kinds", (F.col("n") == 1).alias("alone"), "place.*")
    per_document = mixed.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("gram", "kinds", "alone", "start", "extra")).alias("cuts"))
    one_each = texts.join(per_document, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    raw = one_each.select("doc_id", "mark", F.encode("text", "UTF-8").alias("raw"), F.explode("cuts").alias("cut")).select("doc_id", "mark", "raw", "cut.*")
    cut = stage(
        raw.select("doc_id", "mark", "gram", "kinds", "alone", "start", F.expr(f"substring(raw, int(start) + 1, extra + {length})").alias("content")), "context-bytes"
    )
    few = cut.where(F.col("kinds") <= BLOCK_CONTEXTS)
    blocks = max(1, -(-few.count() // BLOCK_CONTEXTS))
    block = F.pmod(F.xxhash64("gram"), F.lit(blocks))
    schema = "doc_id long, mark long, first long, stop long"
    from_blocks = few.withColumn("block", block).groupBy("block").applyInPandas(_block_spans(length), schema)

    many = cut.where(F.col("kinds") > BLOCK_CONTEXTS)
    offsets = F.explode(F.sequence(F.lit(0), F.length("content") - length))
    string = F.expr(f"substring(content, place + 1, {length})")
    each = many.select("doc_id", "mark", "alone", "start", "content", offsets.alias("place")).select(
        "doc_id", "mark", "alone", (F.col("start") + F.col("place")).alias("first"), F.xxhash64(string).alias("key"), F.hash(string).alias("key2")
    )
    # Only the strings of one gram meet here, so 96 bits of hash tell them apart.
    counted = each.groupBy("key", "key2").agg(F.count("*").alias("n")).where("n > 1").select("key", "key2")
    from_many = each.where("alone").join(counted, ["key", "key2"]).select("doc_id", "mark", "first", (F.col("first") + length).alias("stop"))

    every = spans.union(from_blocks).union(from_many)
    order = Window.partitionBy("doc_id", "mark").orderBy("first", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("first") > reach).cast("int"), F.lit(1))
    numbered = every.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "mark", "island").agg(F.min("first").alias("first"), F.max("stop").alias("stop")).drop("island")


def without_spans(raw: bytes, spans: list) -> bytes:
    if not len(spans):
        return raw
    out, at = [], 0
    for first, stop in sorted(spans):
        out.append(raw[at:first])
        at = stop
    return b"".join((*out, raw[at:]))


def _unused(documents: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of the table has."""
    taken = {c.lower() for c in documents.columns}
    while name in taken:
        name = "_" + name
    return name


def _with_spans(documents: DataFrame, length: int, spans: str) -> DataFrame:
    """The documents with a column of their spans."""
    merged = repeated_spans(documents, length).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "stop")).alias("found"))
    doc_id, mark = place_of(documents)
    joined = documents.join(merged, (doc_id == merged["doc_id"]) & (mark == merged["mark"]), "left")
    return joined.select(*[documents[f"`{c}`"] for c in documents.columns], merged["found"].alias(spans))


def _remaining(texts: pd.Series, spans: pd.Series) -> Iterator[tuple[bytes, list]]:
    for text, found in zip(texts, spans, strict=True):
        ranges = [] if found is None else [(int(s["first"]), int(s["stop"])) for s in found]
        yield without_spans(text.encode("utf-8", "replace") if text else b"", ranges), ranges


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with the text that is left; bytes of a character that was cut through go with the cut."""

    def rest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        kept = [raw.decode("utf-8", "ignore") if ranges else text for text, (raw, ranges) in zip(texts, _remaining(texts, spans), strict=True)]
        return pd.Series(kept, dtype="object")

    rest.__annotations__ = {"texts": pd.Series, "spans": pd.Series, "return": pd.Series}
    left = F.pandas_udf(rest, "string")
    spans = _unused(documents, "spans")
    return _with_spans(documents, length, spans).withColumn("text", left(F.col("text"), F.col(spans))).drop(spans)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for raw, ranges in _remaining(batch["text"], batch["spans"]):
            removed = sum(stop - first for first, stop in ranges)
            rows.append((len(raw) + removed, removed, len(ranges), hashlib.sha256(raw).hexdigest()))
        done = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        done.insert(0, "doc_id", batch["doc_id"].to_numpy())
        yield done


def suffix_dedup(documents: DataFrame) -> DataFrame:
    held = _with_spans(documents.select("doc_id", "text"), LENGTH, "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return held.mapInPandas(_digest, schema)
