"""Classes of large groups meet by regions: once per pair of blocks, not once per band."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import minhash
from tidewatch.llm.minhash import NearDuplicates, Rule, WordHashes, shingle_set


def _family(n: int, words: int, changed: int) -> list[str]:
    """Texts of one source with some words replaced, so that pairs lie about the threshold."""
    draw = np.random.default_rng(5)
    source = [f"w{i}" for i in range(words)]
    texts = []
    for k in range(n):
        own = list(source)
        for at in draw.choice(words, changed, replace=False).tolist():
            own[at] = f"x{k}_{at}"
        texts.append(" ".join(own))
    return texts


def _components(texts: list[str], rule: Rule) -> list[int]:
    sets = [shingle_set(t, rule.words, WordHashes()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [16, 1024])
def test_large_group_near_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows, placed = {}, NearDuplicates._blocks

    def counted(self, regions, labels):
        out = placed(self, regions, labels)
        rows["classes"], rows["placed"] = regions.count(), out.count()
        rows["pairs"] = out.select("region", "p", "q").distinct().count()
        return out

    monkeypatch.setattr(NearDuplicates, "_blocks", counted)
    rule, texts = Rule(words=3, percent=85), _family(90, 400, 6) + _family(60, 400, 6)[:1] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, rule).collect()}
    assert [got[i] for i in range(len(texts))] == _components(texts, rule)
    assert rows["classes"] == 90
    # A class of a region stands once in each pair of blocks that its own is part of.
    assert rows["placed"] <= (90 if block == 1024 else 90 * rows["pairs"])


def test_sizes_at_the_edge_of_two_levels_meet(spark):
    draw = NearDuplicates(spark.createDataFrame([], "doc_id long, text string"), Rule(words=1, percent=80))
    sizes = [4, 5, 64, 80, 100, 125, 51200, 64000, 80000, 100000]
    regions = spark.createDataFrame([(i, n, 0, len(sizes)) for i, n in enumerate(sizes)], "id long, n long, region long, size long")
    labels = spark.createDataFrame([], "node long, component long")
    placed = draw._blocks(regions, labels).groupBy("p", "q").agg(F.collect_set("id").alias("ids")).collect()
    met = {(i, j) for r in placed for i in r["ids"] for j in r["ids"] if i < j}
    allowed = {(i, j) for i in range(len(sizes)) for j in range(i + 1, len(sizes)) if 100 * sizes[i] >= 80 * sizes[j]}
    assert allowed and allowed <= met
