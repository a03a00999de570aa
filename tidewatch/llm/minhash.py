"""Near duplicates by HyperMinHash: compressed min-wise registers, banding, corrected estimates, exact confirmation.

A register keeps, of the least hash in its bucket, the number of leading zeros and ten mantissa bits: 16 bits in all.
Bands propose links. They share no registers and are the longest that miss a pair at the rule's threshold at most once in
100,000 times: 48 bands of eight at 85 % (0.0000002) and 54 of seven at 80 % (0.000003). Agreeing registers, less the agreements that compression
alone would give, estimate the Jaccard similarity; what the estimate cannot rule out is confirmed on the full sets.

Equal sets are one class first, so copies never meet pair by pair. Every class is first tried with one other: of the
first classes of its bands' groups, the one it shares most bands with. Then only pairs that confirmed links leave in
different components are tried: all of them in groups of up to ``SMALL_GROUP`` classes. Larger groups
that share classes make a region, where every class stands once, however many bands it shares. Its classes are put in
``ORDERS`` orders of their registers, each from a drawn one on, where similar ones come to stand together. Of the classes
before it in all orders, those that stand there most often are tried with a class, at most ``NEIGHBOURS`` a round, for as long
as rounds confirm enough. What they leave apart is settled exactly: regions are cut by set size and into blocks of
``BLOCK`` classes, every two blocks whose sizes may link meet in one task, and all their pairs across components are
compared by registers there and confirmed on the full sets. Rows are as many as a region's classes times the blocks they
meet; the pairs themselves are never rows.

Edge cases: a text without words (null and empty ones too) has the empty set, is linked with nothing and stays; fewer
words than a shingle make one shingle of all of them; rows without an id are linked with nothing and stay; rows that
repeat an id share its component; an empty table gives no rows; other columns are carried along or not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import mix64, with_likely
from tidewatch.llm.components import components
from tidewatch.session import discard, stage

REGISTERS = 384
MISS = 1e-5  # share of pairs at the threshold that may share no band
TURNS = 4  # bands are shuffled a share at a time
SMALL_GROUP = 32
CELL, NEIGHBOURS, SORTED_BY = 4096, 2, 16  # classes sorted together, neighbours tried, registers of the order
BLOCK = 2048  # classes of a region that meet another block's, register by register, in one task
ORDERS, WORTH = 8, 50  # orders of a round; rounds go on while they confirm more than one in so many pairs
MANTISSA = 10
EXPECTED_AGREEMENT = 0.169919487159739093975  # fixed value of the sketch's published collision estimate
MARGIN = 4.5  # standard deviations that an estimate may lie under the threshold before its pair is ruled out
MEMO = 500_000
DIGEST = ["n_shingles", "digest_a", "digest_b"]


@dataclass(frozen=True)
class Rule:
    """Links need ``percent`` * union <= 100 * intersection over shingles of ``words`` words."""

    words: int = 5
    percent: int = 80


class WordHashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    n = len(found)
    if not n:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=n)
    size = min(n, words)
    mixed = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + each[i : n - size + 1 + i])
    return np.unique(mixed)


def registers(shingles: np.ndarray) -> np.ndarray:
    """16 bits per bucket: zeros before the first one bit, then the ten bits behind it, larger for smaller hashes; 0
    marks an empty bucket. The shingles are sorted and the bucket is their upper part, so buckets are runs."""
    out = np.zeros(REGISTERS, dtype=np.uint16)
    if not len(shingles):
        return out
    bucket = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    rest = (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64) + 1.0
    part, exponent = np.frexp(rest)  # rest = part * 2^exponent with part in [0.5, 1)
    zeros = np.clip(54 - exponent, 0, 62)
    mantissa = ((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    value = ((zeros + 1) << MANTISSA) | ((1 << MANTISSA) - 1 - mantissa)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    out[bucket[starts].astype(np.int64)] = np.maximum.reduceat(value, starts)
    return out


def bands_of(percent: int) -> np.ndarray:
    """Registers of each band, [band, place], no register in two of them."""
    for size in range(REGISTERS, 1, -1):
        n = REGISTERS // size
        if (1 - (percent / 100) ** size) ** n <= MISS:
            return np.arange(n * size).reshape(n, size)
    return np.arange(REGISTERS).reshape(REGISTERS, 1)


def _keys(sketch: np.ndarray, places: np.ndarray, first: int = 0) -> np.ndarray:
    """Keys of the bands from number ``first`` on, of one sketch or of the rows of a matrix."""
    bands = sketch.astype(np.uint64)[..., places]
    keys = np.arange(first + 1, first + len(places) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(places.shape[1]):
        keys = mix64(keys * np.uint64(0xD6E8FEB86659FD93) + bands[..., i])
    return keys.view(np.int64)


def band_keys(sketch: np.ndarray, places: np.ndarray) -> list[int]:
    """One 64-bit key per band that has a register."""
    return _keys(sketch, places)[sketch[places].any(axis=1)].tolist()


def _banded(places: np.ndarray, first: int):
    """A row (id, n, band) for each of these bands that has a register, from parts of sketches that hold just them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part = np.frombuffer(b"".join(batch["part"]), np.uint16).reshape(len(batch), places.size)
            some = part[:, places].any(axis=2)
            row = np.nonzero(some)[0]
            yield pd.DataFrame({"id": batch["id"].to_numpy()[row], "n": batch["n"].to_numpy()[row], "band": _keys(part, places, first)[some]})

    return run


def sketches(rule: Rule):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingle_set(text, rule.words, hashes)
                with np.errstate(over="ignore"):
                    digest = (int(s.sum().view(np.int64)), int(mix64(s).sum().view(np.int64))) if len(s) else (0, 0)
                rows.append((len(s), *digest, registers(s).tobytes()))
            done = pd.DataFrame(rows, columns=["n_shingles", "digest_a", "digest_b", "sketch"])
            done.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield done

    return run


def estimated_jaccard(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, int]:
    """Similarity by agreeing registers, less the agreements by compression alone; and the registers in use."""
    used = int(((a > 0) | (b > 0)).sum())
    if not used:
        return 0.0, 0
    agree = int(((a == b) & (a > 0)).sum())
    by_chance = EXPECTED_AGREEMENT * REGISTERS / (1 << MANTISSA) * (4.0 * n_a * n_b / (n_a + n_b) ** 2)
    return max(0.0, agree - by_chance) / used, used


def _plausible(percent: int):
    low = percent / 100

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for a, b, n_a, n_b in zip(batch["sketch_a"], batch["sketch_b"], batch["n_a"], batch["n_b"], strict=True):
                estimate, used = estimated_jaccard(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16), n_a, n_b)
                keep.append(estimate >= low - MARGIN * (low * (1 - low) / max(1, used)) ** 0.5)
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return run


def _apart(percent: int):
    """Of two blocks of a region: every class that has pairs across components which the estimate lets pass, with the
    others of its pairs. Blocks are put in the order of set sizes, where the sizes that may link are one slice."""
    low = percent / 100
    schema = {"region": "int64", "p": "int64", "q": "int64", "id": "int64", "part": "int64"}

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        region, p, q = key
        rows = rows.sort_values(["n", "id"], ignore_index=True)
        own, part_of, others = rows["own"].to_numpy(), dict(zip(rows["id"].tolist(), rows["part"].tolist(), strict=True)), {}

        def side(block: int) -> tuple[np.ndarray, ...]:
            of = rows[own == block]
            sketch = np.frombuffer(b"".join(of["sketch"]), np.uint16).reshape(len(of), REGISTERS)
            return of["id"].to_numpy(), of["part"].to_numpy(), of["n"].to_numpy(), sketch, (sketch > 0).astype(np.float32)

        ids, parts, n, sketch, filled = side(p)
        ids_b, parts_b, n_b, sketch_b, filled_b = side(q)
        size, size_b = filled.sum(axis=1), filled_b.sum(axis=1)
        # An empty register agrees with none.
        sought = np.where(sketch > 0, sketch, np.uint16(0xFFFF))
        first = np.arange(len(n)) + 1 if p == q else np.searchsorted(n_b * 100, n * percent)
        last = np.searchsorted(n_b * percent, n * 100, side="right")
        for i in range(len(ids)):
            to = slice(first[i], last[i])
            if first[i] >= last[i] or (parts_b[to] == parts[i]).all():
                continue
            # Eight registers to a word, whose bytes count up to 48.
            same = (sketch_b[to] == sought[i]).view(np.uint64).sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=1)
            used = np.maximum(1, size[i] + size_b[to] - filled_b[to] @ filled[i])
            n_i, n_j = float(n[i]), n_b[to].astype(np.float64)
            by_chance = EXPECTED_AGREEMENT * REGISTERS / (1 << MANTISSA) * (4.0 * n_j * n_i / (n_j + n_i) ** 2)
            estimate = np.maximum(0.0, same - by_chance) / used
            near = (estimate >= low - MARGIN * (low * (1 - low) / used) ** 0.5) & (parts_b[to] != parts[i])
            if near.any():
                found = ids_b[to][near].tolist()
                others.setdefault(int(ids[i]), []).extend(found)
                for j in found:
                    others.setdefault(j, [])
        held = sorted(others)
        out = pd.DataFrame({"region": region, "p": p, "q": q, "id": held, "part": [part_of[i] for i in held]}).astype(schema)
        out["others"] = pd.Series([others[i] for i in held], dtype=object)
        return out

    return run


def _joined(rule: Rule):
    """Of two blocks' classes with their texts: confirmed pairs, but none between parts that others have joined."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, sets = WordHashes(), {}
        texts = dict(zip(rows["id"].tolist(), rows["text"], strict=True))
        part = dict(zip(rows["id"].tolist(), rows["part"].tolist(), strict=True))
        root = {c: c for c in part.values()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_set(texts[i], rule.words, hashes)
            return sets[i]

        links = []
        for i, others in zip(rows["id"].tolist(), rows["others"], strict=True):
            for j in others:
                a, b = find(part[i]), find(part[int(j)])
                if a == b:
                    continue
                one, two = of(i), of(int(j))
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= rule.percent * (len(one) + len(two) - both):
                    root[a] = b
                    links.append((min(i, int(j)), max(i, int(j))))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _confirmed(rule: Rule):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, last = WordHashes(), (None, np.empty(0))
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch["a"], batch["text_a"], batch["text_b"], strict=True):
                if last[0] != a:
                    last = (a, shingle_set(text_a, rule.words, hashes))
                one, two = last[1], shingle_set(text_b, rule.words, hashes)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= rule.percent * (len(one) + len(two) - both))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return run


def _sizes_allow(percent: int, n_a: Column | str, n_b: Column | str) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


class NearDuplicates:
    """Links and components of (doc_id, text) under a rule."""

    def __init__(self, documents: DataFrame, rule: Rule):
        self.rule = rule
        self.documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        schema = "doc_id long, n_shingles long, digest_a long, digest_b long, sketch binary"
        self.sets = stage(self.documents.mapInPandas(sketches(rule), schema), "sketches")
        self.classes = stage(
            self.sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*DIGEST).agg(F.min("doc_id").alias("id")), "classes"
        )

    def labels(self) -> DataFrame:
        """(node, component) of every class that confirmed links join to another."""
        shares = [self._band_members(turn) for turn in range(TURNS)]
        met = reduce(DataFrame.union, shares)
        # One plan at every size: the texts that can take part are cut out of all texts once, by a shuffle of both.
        members = stage(met.select("id").distinct(), "members")
        self.sketch = stage(self._sets_of(members, "n_shingles", "sketch"), "member-sketches")
        slim = stage(self.sets.drop("sketch"), "sets")
        discard(self.sets)
        self.sets = slim
        likely = with_likely(self.documents, F.col("doc_id"), members).where("likely").drop("likely")
        wanted = members.withColumnRenamed("id", "doc_id").hint("shuffle_merge")
        self.texts = stage(likely.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
        shared = met.where(F.col("id") != F.col("first.id")).groupBy("first", "id", "n").agg(F.count("*").alias("bands"))
        best = shared.groupBy("id", "n").agg(F.max_by("first", F.struct("bands", -F.col("first.id"))).alias("first"))
        first = best.select(F.col("first.id").alias("a"), F.col("id").alias("b"), F.col("first.n").alias("n_a"), F.col("n").alias("n_b"))
        tried = stage(self._sized(first), "pairs")
        found = self._confirm(tried)
        small, large = met.where(F.col("size") <= SMALL_GROUP), met.where(F.col("size") > SMALL_GROUP)
        fresh = stage(self._sized(self._across(small, components(found))).join(tried, ["a", "b"], "left_anti"), "pairs")
        found, tried, turn = found.union(self._confirm(fresh)), tried.union(fresh), 0
        regions, labels = self._regions(large), components(found)
        while True:
            fresh = stage(self._sized(self._neighbours(regions, labels, turn)).join(tried, ["a", "b"], "left_anti"), "pairs")
            more = self._confirm(fresh)
            n_more = more.count()
            if n_more:
                found, tried, turn = found.union(more), tried.union(fresh), turn + 1
                labels = components(found)
            if n_more * WORTH <= fresh.count():
                settled = self._settled(regions, labels)
                labels = labels if settled.isEmpty() else components(found.union(settled))
                discard(self.sketch, self.texts, *shares)
                return labels

    def _band_members(self, turn: int) -> DataFrame:
        """(band, id, n, size, first) of the classes that share a band with others, for one turn's share of the bands."""
        places = bands_of(self.rule.percent)
        own = np.array_split(np.arange(len(places)), TURNS)[turn]
        size, first = places.shape[1], int(own[0]) if len(own) else 0
        # Bands lie side by side, so a share of them is one part of the sketch.
        part = F.substring("sketch", 2 * first * size + 1, 2 * len(own) * size).alias("part")
        parts = self._sets_of(self.classes.select("id").distinct(), F.col("n_shingles").alias("n"), part)
        rows = parts.mapInPandas(_banded(places[: len(own)], first), "id long, n long, band long")
        bands = stage(rows, "bands")
        groups = bands.groupBy("band").agg(F.count("*").alias("size"), F.min(F.struct("id", "n")).alias("first")).where("size > 1")
        met = stage(bands.join(groups, "band").select("band", "id", "n", "size", "first"), "band-members")
        discard(bands)
        return met

    def _sets_of(self, ids: DataFrame, *columns: Column | str) -> DataFrame:
        """Columns of the sets of some classes, one row for each id; of sets that share an id, always the same one."""
        one = self.classes.groupBy("id").agg(F.min(F.struct(*DIGEST)).alias("own")).join(ids, "id", "left_semi")
        key = [F.col(c).alias(f"_{c}") for c in DIGEST]
        named = self.sets.select(F.col("doc_id").alias("id"), *key, *columns)
        own = one.select("id", *[F.col(f"own.{c}").alias(f"_{c}") for c in DIGEST])
        alike = ["id", *[f"_{c}" for c in DIGEST]]
        return named.join(own.hint("shuffle_merge"), alike, "left_semi").dropDuplicates(alike).drop(*alike[1:])

    def _across(self, small: DataFrame, labels: DataFrame) -> DataFrame:
        """All pairs within small groups that links leave in different components."""
        parted = small.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
        left = parted.select("band", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("part").alias("part_a"))
        right = parted.select("band", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("part").alias("part_b"))
        apart = (F.col("a") < F.col("b")) & (F.col("part_a") != F.col("part_b"))
        return left.join(right, "band").where(apart).select("a", "b", "n_a", "n_b")

    def _regions(self, large: DataFrame) -> DataFrame:
        """(id, n, region, size) of every class in a large group, once; groups that share classes are one region."""
        # A class stands at the least first class of its bands; these alone are linked, as a class's other ones reach it.
        firsts = F.collect_set("first.id").alias("firsts")
        at = stage(large.groupBy("id", "n").agg(firsts).withColumn("at", F.array_min("firsts")), "region-firsts")
        edges = at.select(F.explode("firsts").alias("a"), F.col("at").alias("b")).distinct()
        regions = components(edges).select(F.col("node").alias("at"), F.col("component").alias("region"))
        held = stage(at.select("id", "n", "at").join(regions, "at").drop("at"), "region-members")
        return stage(held.join(held.groupBy("region").agg(F.count("*").alias("size")), "region"), "regions")

    def _parted(self, regions: DataFrame, labels: DataFrame) -> DataFrame:
        named = regions.join(labels.withColumnRenamed("node", "id"), "id", "left")
        return named.select("region", "size", "id", "n", F.coalesce("component", "id").alias("part"))

    def _neighbours(self, regions: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
        """Pairs within regions, across components: every class with its neighbours in the orders of the registers
        from drawn ones on. Cells of about ``CELL`` drawn classes bound what a task sorts."""
        sketch = self.sketch.select("id", F.concat("sketch", "sketch").alias("twice"))
        each = self._parted(regions, labels).join(sketch, "id").withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))))
        start = F.pmod(F.xxhash64("region", "order", F.lit(turn)), F.lit(REGISTERS)) * 2 + 1
        cells = each.select(
            "region", "order", F.pmod(F.xxhash64("id", "order", F.lit(turn)), F.ceil(F.col("size") / CELL)).alias("cell"),
            "id", "n", "part", F.substring("twice", start.cast("int"), F.lit(2 * SORTED_BY)).alias("registers"),
        )
        order = Window.partitionBy("region", "order", "cell").orderBy("registers", "id")
        one = F.struct("id", "n", "part")
        near = F.array(*(F.lag(one, k).over(order) for k in range(1, NEIGHBOURS + 1)))
        other = F.filter("near", lambda x: (x["part"] != F.col("part")) & _sizes_allow(self.rule.percent, x["n"], F.col("n")))
        met = cells.select("id", "n", "part", near.alias("near")).select("id", "n", other.alias("near")).where(F.size("near") > 0)
        # Over all its orders a class keeps the neighbours that stand by it most often.
        stood = met.groupBy("id").agg(F.first("n").alias("n"), F.flatten(F.collect_list("near")).alias("near"))
        often = F.transform(F.array_distinct("near"), lambda x: F.struct(-F.size(F.filter("near", lambda y: y == x)), x.alias("other")))
        kept = F.transform(F.slice(F.array_sort(often), 1, NEIGHBOURS), lambda x: x["other"])
        met = stood.select("id", "n", F.explode(kept).alias("other"))
        return met.select(F.col("other.id").alias("a"), F.col("id").alias("b"), F.col("other.n").alias("n_a"), F.col("n").alias("n_b"))

    def _blocks(self, regions: DataFrame, labels: DataFrame) -> DataFrame:
        """(region, p, q, own, id, n, part): every class of a region with several components, in its block ``own``, once
        per pair of blocks that meet. Sets whose sizes may link are of one level or of two that follow each other."""
        named = stage(self._parted(regions, labels), "places")
        split = named.groupBy("region").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most")
        # A step wider than the rule's, so that rounding parts no pair that it allows.
        step = max(0.01, 1.001 * float(np.log(100 / self.rule.percent)))
        named = named.join(stage(split.select("region"), "regions-apart"), "region", "left_semi")
        named = named.withColumn("level", F.floor(F.log("n") / step)).drop("size")
        # Components of more than a block have blocks of their own; the others of a level share blocks.
        counts = stage(named.groupBy("region", "level", "part").agg(F.count("*").alias("held")), "region-parts")
        shared = F.sum(F.when(F.col("held") <= BLOCK, F.col("held"))).alias("shared")
        sizes = counts.join(counts.groupBy("region", "level").agg(shared), ["region", "level"])
        few = F.col("held") <= BLOCK
        whole = F.when(~few, F.col("part")).alias("whole")
        chunk = F.when(few, F.pmod(F.xxhash64("part"), F.ceil(F.col("shared") / BLOCK)))
        chunk = chunk.otherwise(F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / BLOCK)))
        dealt = named.join(sizes, ["region", "level", "part"])
        dealt = stage(dealt.select("region", "level", "id", "n", "part", whole, F.xxhash64("level", "whole", chunk).alias("own")), "region-blocks")
        blocks = dealt.select("region", "level", "own", "whole").distinct()
        other = blocks.select("region", *[F.col(c).alias(f"other_{c}") for c in ("level", "own", "whole")])
        apart = "abs(level - other_level) <= 1 AND (whole IS NULL OR other_whole IS NULL OR whole <> other_whole)"
        meet = blocks.join(other, "region").where(apart).select("region", "own", F.least("own", "other_own").alias("p"), F.greatest("own", "other_own").alias("q"))
        return dealt.join(meet, ["region", "own"]).select("region", "p", "q", "own", "id", "n", "part")

    def _settled(self, regions: DataFrame, labels: DataFrame) -> DataFrame:
        """Links between the components of regions: all pairs whose sizes allow it, by blocks."""
        rows = self._blocks(regions, labels).join(self.sketch.select("id", "sketch"), "id")
        schema = "region long, p long, q long, id long, part long, others array<long>"
        apart = stage(rows.groupBy("region", "p", "q").applyInPandas(_apart(self.rule.percent), schema), "apart")
        texts = self.texts.select(F.col("doc_id").alias("id"), "text")
        both = apart.join(texts.hint("shuffle_merge"), "id")
        return stage(both.groupBy("region", "p", "q").applyInPandas(_joined(self.rule), "a long, b long"), "links-settled")

    def _sized(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs, the smaller id first, that set sizes allow."""
        allowed = pairs.where(_sizes_allow(self.rule.percent, "n_a", "n_b"))
        return allowed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the estimate lets pass and the full sets confirm."""
        sketch = self.sketch.select("id", "n_shingles", "sketch")
        one = sketch.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
        two = sketch.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
        likely = stage(pairs.join(one, "a").join(two, "b").mapInPandas(_plausible(self.rule.percent), "a long, b long"), "likely")
        texts = self.texts
        with_b = likely.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        return stage(both.select("a", "b", "text_a", "text_b").mapInPandas(_confirmed(self.rule), "a long, b long"), "links-found")

    def components(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) of every row; a component is named by its smallest document."""
        labels = self.labels().withColumnRenamed("node", "id")
        named = self.classes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")).drop("id")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
        return self.sets.join(named, DIGEST, "left").select("doc_id", "n_shingles", own)


def near_duplicates(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; rows without an id are kept."""
    done = NearDuplicates(documents, rule).components()
    return done.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents without those that a smaller id of their component stands for.

    Rows that repeat a kept id stay as they came.
    """
    gone = near_duplicates(documents, rule).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    gone = stage(gone, "gone")
    # Only texts whose id may be gone are shuffled.
    rows = with_likely(documents, F.col("doc_id").cast("long"), gone)
    asked = rows.where("likely").drop("likely")
    return rows.where("NOT likely").drop("likely").union(asked.join(gone, asked["doc_id"] == gone["gone_id"], "left_anti"))


def minhash_dedup(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents, Rule(words=3, percent=85))
