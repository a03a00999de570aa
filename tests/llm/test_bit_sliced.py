"""Ranked search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import bit_sliced as B
from tidewatch.llm.common import table

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(documents, items):
    docs = [(i, Counter(words(t))) for i, t in documents]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(words(text))
    out = []
    for item, wanted in terms.items():
        scored = []
        for doc_id, c, own in docs:
            m = 100 - 90 + (90 * own * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:10], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


def found(spark, documents, items):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    done = B.search(B.build(docs.repartition(3)), spark.createDataFrame(items, "item_id long, text string"))
    return sorted(map(tuple, done.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_whole_tables(spark):
    documents = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = sorted(map(tuple, B.ranked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == brute(documents, items)


@pytest.mark.parametrize("seed", [1, 2])
def test_drawn_texts(spark, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "ÉA", "x-y", "a_b", "漢字", "O'B"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(draw.choices(vocabulary, weights, k=draw.choice([0, 1, 3, 20, 200, 900]))) for _ in range(150)]
    texts += [texts[3]] * 30 + [None, "", "---", "\x00\x01"]
    documents = list(enumerate(texts)) + [(None, "w1 w2"), (None, "w1 w2"), (5, "w1 w3"), (5, texts[5])]
    items = [(i, " ".join(draw.choices(vocabulary, k=8)).upper()) for i in range(25)] + [(3, "w1 w50"), (77, None), (78, ""), (79, "nowhere"), (None, "w2")]
    assert found(spark, documents, items) == brute(documents, items)


def test_item_blocks_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(B, "ITEM_TERMS", 10)
    draw = random.Random(9)
    documents = [(i, " ".join(f"t{draw.randrange(400)}" for _ in range(30))) for i in range(120)]
    documents.append((500, " ".join(f"t{i % 5000}" for i in range(120_000))))
    documents.append((501, "z" * 200_000))
    items = [(i, " ".join(f"t{draw.randrange(400)}" for _ in range(6))) for i in range(12)]
    assert found(spark, documents, items) == brute(documents, items)


def test_bounds_never_lie_below_scores():
    draw = random.Random(4)
    documents = [" ".join(draw.choices([f"w{i}" for i in range(40)], k=draw.randint(1, 300))) for _ in range(80)]
    import pandas as pd

    rows = list(B._indexed(iter([pd.DataFrame({"doc_id": range(80), "text": documents, "text_a": range(80), "text_b": 0})])))
    blocks = [r for part in rows for r in part.itertuples() if r.kind == "block"]
    df = Counter(bytes(r.term) for part in rows for r in part.itertuples() if r.kind == "term" for _ in range(r.df))
    n, length = 80, sum(len(d.split()) for d in documents)
    terms = sorted(df)
    weights = np.array([B._weight(n, df[t]) for t in terms])
    items = B.Items((0,), tuple(terms), np.array([B.TermHashes()[t] for t in terms], dtype=np.uint64), weights, (np.arange(len(terms)),), n, length)
    assert sum(len(b.ids) for b in blocks) == 80
    for block in blocks:
        bounds = B._bounds(items, block)[0]
        for doc_id, bound in zip(block.ids, bounds, strict=True):
            text = documents[doc_id]
            scored = next(B._scores(items)(iter([pd.DataFrame({"text": [text], "text_a": 0, "text_b": 0, "items": [[0]]})])))
            assert bound >= scored["score"][0] > 0


def test_nothing_to_find(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5), (2, "c", "y", 6)], "doc_id long, text string, kind string, text_a int")
    items = spark.createDataFrame([(1, "A", 3)], "item_id long, text string, term int")
    assert [tuple(r) for r in B.search(B.build(docs), items).collect()] == [(1, 1, 1, brute([(1, "a b"), (2, "c")], [(1, "A")])[0][3])]
