"""The corpus operators against brute force, on small tables with the awkward cases."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import gru, inverted_multi_index, line_dedup, lm_scoring, minhash, packing, pieces, spotsigs, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, bands string, key long"  # two more columns, with names that operators use


def _texts():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "idiot"]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage, line = prose(60), "A line that many of the documents share, word for word."
    out = [None, "", " ", "one", "two words", "é ß 爱 😀", "x" * 500, "a\n" * 6, prose(3000)]
    for i in range(12):
        own = prose(120).split()
        out.append(" ".join(own))
        own[draw.randrange(len(own))] = "changed"
        out.append(" ".join(own))
        out.append(f"{prose(20)}\n{line}\nshort\nlines\n{prose(5)}")
        out.append(f"{prose(9)} {passage} {prose(7)}")
    return out + [out[9], out[9]]


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "b", i % 3) for i, t in enumerate(_texts())]


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _raw(text):
    return (text or "").encode()


def test_near_duplicates_have_the_components_of_all_pairs(documents, rows):
    def shingles(text):
        w = _raw(text).lower().split()
        return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()

    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    done = minhash.minhash_dedup(documents).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in done} == {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_links_inside_large_groups_are_settled_exactly(spark, monkeypatch):
    # One boilerplate in all texts: all pairs lie just under the threshold, but for a few true pairs.
    draw = random.Random(8)
    common = [f"c{i}" for i in range(200)]
    own = [[f"t{i}_{k}" for k in range(24)] for i in range(150)]
    rows = [(i, " ".join(common + w)) for i, w in enumerate(own)]
    for i in range(0, 150, 10):
        rows.append((1000 + i, " ".join(common + own[i][:-1] + [f"u{draw.random()}"])))
    # Every group counts as large and the cheap tries find nothing, so that all links are left to the last pass.
    monkeypatch.setattr(minhash, "BLOCK", 48)
    monkeypatch.setattr(minhash, "SMALL_GROUP", 1)
    monkeypatch.setattr(minhash.NearDuplicates, "_sized", lambda self, pairs: pairs.select("a", "b").limit(0))
    done = {r.doc_id: r.component_id for r in minhash.minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, t in rows for w in [t.split()]}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert links == {(i, 1000 + i) for i in range(0, 150, 10)}
    assert done == {i: i - 1000 if i >= 1000 else i for i in sets}


def test_estimates_are_near_the_similarity():
    draw = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        every = np.unique(draw.integers(0, 2**63, 8000).astype(np.uint64))
        both, rest = every[: int(len(every) * share)], every[int(len(every) * share) :]
        one, two = np.sort(np.concatenate((both, rest[::2]))), np.sort(np.concatenate((both, rest[1::2])))
        found, _ = minhash.estimated_jaccard(minhash.registers(one), minhash.registers(two), len(one), len(two))
        assert abs(found - share) < 0.15


def test_repeated_strings_are_those_of_all_windows(documents, rows):
    length, seen = suffix_dedup.LENGTH, {}
    for _, t, *_ in rows:
        for i in range(len(_raw(t)) - length + 1):
            window = _raw(t)[i : i + length]
            seen[window] = seen.get(window, 0) + 1
    expected = set()
    for i, t, *_ in rows:
        raw, gone = _raw(t), bytearray(len(_raw(t)))
        for j in range(len(raw) - length + 1):
            if seen[raw[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        expected.add((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert {tuple(r) for r in suffix_dedup.suffix_dedup(documents).collect()} == expected
    assert any(e[2] for e in expected)


def test_hot_grams_give_the_same_spans(documents, monkeypatch):
    plain = {tuple(r) for r in suffix_dedup.suffix_dedup(documents).collect()}
    monkeypatch.setattr(suffix_dedup, "BLOCK_CONTEXTS", 2)
    assert {tuple(r) for r in suffix_dedup.suffix_dedup(documents).collect()} == plain


def test_two_stage_order_is_the_suffix_order():
    draw = random.Random(5)
    for _ in range(30):
        text = np.frombuffer(bytes(draw.choice(b"ab\x00c") for _ in range(60)), dtype=np.uint8)
        order = suffix_dedup.two_stage_order(text, np.ones(60, dtype=bool), 60)
        assert [bytes(text[i:]) for i in order] == sorted(bytes(text[i:]) for i in range(60))


def test_packing_is_gapless_and_takes_the_librarys_ids(documents, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t, *_ in rows}
    found = sorted(packing.packed(documents).collect(), key=lambda r: (r.doc_id, r.start))
    reached, windows = dict.fromkeys(ids, 0), {}
    for r in found:
        assert r.start == reached[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        reached[r.doc_id] += r.length
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert reached == {i: len(x) for i, x in ids.items()}
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0


def test_odd_white_space_is_tokenised_as_a_whole_text():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    tokens, draw = packing.Tokens(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    for _ in range(2000):
        text = "".join(draw.choice([" ", "  ", "\n", "\t", " ", " ", "\x1c", "ab", "don't", "12", "é", "爱", "!?", "<|endoftext|>"]) for _ in range(draw.randrange(9)))
        assert np.frombuffer(tokens.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_differencing_keeps_capacity():
    draw = random.Random(4)
    loads = [draw.randrange(1, 100) for _ in range(200)]
    sets = packing.partition(loads, 100)
    assert sorted(i for s in sets for i in s) == list(range(200)) and max(sum(loads[i] for i in s) for s in sets) <= 100


def test_pieces_are_the_librarys(documents, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r.doc_id: r for r in pieces.encoded(documents).collect()}
    for i, t, *_ in rows:
        assert found[i].ids == library.encode(t or "") and found[i].round_trip
    machine, draw = pieces.transducer(public_tokenizers.path("piece_bpe_32k.model")), random.Random(6)
    odd = ["".join(draw.choice(" \t\nabdehinorst  éß梦😀▁.,9") for _ in range(draw.randrange(80))) for _ in range(500)]
    assert [x.tolist() for x in machine.encode_all(odd)] == library.encode(odd)


def test_token_counts_are_those_of_single_words(documents, rows):
    counter = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    expected = {i: sum(counter.unigram.count(w) for w in counter.vocabulary.words(t)) if t else 0 for i, t, *_ in rows}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents).collect()} == expected


def test_neighbours_and_recall(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16))
    vectors = [(centres[i % 12] + 0.4 * draw.normal(size=16)).astype(np.float32).tolist() for i in range(1500)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(2000 + i, vectors[20], 0) for i in range(60)]
    odd = [(3000, None, 0), (3020, [0.0] * 16, 0), (3040, [float("nan")] * 16, 0), (3060, [None] * 16, 0), (3080, [1.0], 0), (None, vectors[0], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    found = {}
    for r in inverted_multi_index.neighbours(table, share=0.3).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = np.lexsort((ids, -np.round(scores, 9)))[:20]
        hits += len({v for _, v, _ in found[ids[i]]} & set(ids[best].tolist()))
        total += 20
        assert [r for r, _, _ in sorted(found[ids[i]])] == list(range(1, 21))
    assert set(found) == {int(i) for i in ids if i % 20 == 0} and hits / total >= 0.9


def test_language_model_base_and_gradient(documents, rows):
    import math
    from collections import Counter

    tokens = {i: [*_raw(t).lower().split(), None] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in lm_scoring.scored(documents).collect():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[r.doc_id])
        assert r.held_out == held[r.doc_id] and r.n_tokens == len(tokens[r.doc_id]) and r.train_tokens == n
        assert r.n_known == sum(counts[w] > 0 for w in tokens[r.doc_id]) and abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
    draw, weights = np.random.default_rng(0), gru.initial(3)
    text = [(draw.integers(0, gru.INPUTS, 15), draw.integers(0, gru.CLASSES, 15), draw.integers(0, 32, 15)) for _ in range(3)]
    _, places, many, (inputs, classes, words) = next(gru.windows(text, 32))
    g, total = gru.gradients(weights, inputs, classes, words, many, np.zeros((len(places), gru.HIDDEN), np.float32))
    for key, at in (("class_bias", (5,)), ("state", (1, 2)), ("input", (int(inputs[0, 0]), 1))):
        sides = []
        for step in (1e-2, -1e-2):
            moved = {k: x.copy() for k, x in weights.items()}
            moved[key][at] += step
            sides.append(-gru.score(moved, text).sum() / total)
        assert abs(g[key][at] - (sides[0] - sides[1]) / 2e-2) < 2e-4 + 0.1 * abs(g[key][at])


def test_fingerprints(documents, rows):
    found = sorted(spotsigs.fingerprints(documents).collect(), key=lambda r: r.doc_id)
    texts = [t or "" for _, t, *_ in rows]
    for i, r in enumerate(found):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        sets = [{f[k : k + 8] for k in range(0, len(f), 8)} for f in (r.fingerprint, r.edited_fingerprint)]
        assert abs(r.near_edited - (len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1)) < 1e-9
    assert found[9].fingerprint == found[-1].fingerprint


def test_very_long_runs_of_common_words(spark):
    texts = ["the " * 50_000 + "end of it", "a | " * 50_000, "k " * 100_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(spotsigs.fingerprints(table).collect()) == 3


def test_similar_fingerprints_are_those_of_all_pairs(documents, spark):
    sets = {r.doc_id: frozenset(r["set"]) for r in spotsigs.with_signatures(documents.fillna("", ["text"]), "text", "set").collect()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    ids = sorted(i for s, i in first.items() if s)
    expected = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.class_id, r.other_id) for r in spotsigs.near_duplicates(documents).collect()} == expected


def test_lines_go_with_later_copies(spark):
    long = "a line of more than forty characters, to be sure"
    texts = [f"{long}\nx\ny\nz", f"q\n{long}", "x\ny\nend", "y\nz", "x", None, "", "k\nk\nk\nk"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in line_dedup.with_line_dedup(table).collect()}
    assert kept == {0: texts[0], 1: "q", 2: "end", 3: "", 4: "x", 5: "", 6: "", 7: "k"}


def test_obfuscated_words_are_restored(spark):
    rows = [(i, "plain words of prose here" if i % 3 else "plain idiot words of prose here", i % 3 == 0) for i in range(300)]
    hidden = [(1000, "plain 1d10t"), (1001, "i d i o t"), (1002, "words idiooooot"), (1003, None), (1004, ""), (1005, "plain prose")]
    documents = spark.createDataFrame([r[:2] for r in rows] + hidden, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(documents, labels).collect()}
    assert [found[i] for i in range(1000, 1006)] == [1, 1, 1, 0, 0, 0] and found[0] == 1 and found[1] == 0


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    operators = [minhash.minhash_dedup, suffix_dedup.suffix_dedup, packing.packed, pieces.encoded, token_counts.token_counts,
                 lm_scoring.scored, spotsigs.fingerprints, line_dedup.line_dedup, lambda d: toxicity.toxicity(d, labels),
                 lambda _: inverted_multi_index.neighbours(vectors)]
    for operator in operators:
        assert operator(empty).collect() == []


def test_null_ids_do_not_break(spark):
    table = spark.createDataFrame([(None, "some words here"), (1, "some words here"), (1, "some words here"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    operators = [minhash.minhash_dedup, suffix_dedup.suffix_dedup, packing.packed, pieces.encoded, token_counts.token_counts,
                 lm_scoring.scored, spotsigs.fingerprints, line_dedup.line_dedup, lambda d: toxicity.toxicity(d, labels)]
    for operator in operators:
        assert len(operator(table).collect()) >= 4


def test_pipeline_runs_on_a_small_table(spark, documents, tmp_path):
    import corpus_pipeline

    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
