"""Toxicity by a noisy channel: obfuscated spellings are decoded, then the restored words are scored.

A spelling such as ``1d10t``, ``i d i o t`` or ``idiooot`` is a character lattice: every character may stand for
itself or for the letters it imitates, a separator may be dropped or be the border of two words, and a repeated character
may be dropped. Every token with a sign, digit, separator or doubled letter is decoded, beside its plain reading. The
Viterbi path under a character trigram model of the corpus is the restored spelling. A linear model over restored
words and their beginnings gives the score.

Edge cases: a null or empty text has no features and gets the score of the intercept; a null id belongs to the fold
of the empty text; an empty table gives no rows; with no labelled rows of both kinds every score is the share of
label 1 (0 without labels). Repeated rows are scored alike. Columns of the documents other than the id and the text
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fold
from tidewatch.session import stage

# ---- fixed values: what a character may stand for, and what a path pays ----
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = frozenset(".-_*~'`^,;:/\\ ​­")
PAY_LEET, PAY_ODD, PAY_DROP, PAY_REPEAT = 1.0, 6.0, 0.5, 0.3
# ----------------------------------------------------------------------------

LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER, EDGE, SYMBOLS = 26, 27, 28  # any other letter; the border of a word
FIT_ROWS = 8192  # labelled documents that the classifier is fitted on at most, in the order of a hash of their id
FEATURES = 512  # words and word beginnings that the classifier weighs at most
STEMS = (4, 5, 6)  # lengths of word beginnings
MEMO = 400_000  # spellings that a worker remembers

_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_DOUBLE = re.compile(r"(.)\1")
_OUTER = re.compile(f"^[^\\w{re.escape(''.join(IMITATES))}]+|[^\\w{re.escape(''.join(IMITATES))}]+$")
_PARTS = re.compile(r"[^\W_]+(?:[0-9@$!|+(€£]+[^\W_]+)*")
_CODE = np.full(256, EDGE, dtype=np.int64)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _CODE[ord(_c.upper())] = _i
_CODE[0x80:] = OTHER


def trigram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of character trigrams of whole texts; what is no letter is a word border, kept once."""
    total = np.zeros(SYMBOLS**3, dtype=np.int64)
    for batch in batches:
        for text in batch["text"]:
            if not text:
                continue
            codes = _CODE[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)]
            codes = np.concatenate(([EDGE, EDGE], codes, [EDGE]))
            codes = codes[np.concatenate(([True], (codes[1:] != EDGE) | (codes[:-1] != EDGE)))]
            codes = np.concatenate(([EDGE], codes))
            total += np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"code": seen, "n": total[seen]})


def character_model(documents: DataFrame) -> np.ndarray:
    """Negative log probabilities [first, second, third] from all texts; 21,952 sums reach the driver at most."""
    counts = documents.select("text").mapInPandas(trigram_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    n = np.zeros(SYMBOLS**3)
    for row in counts.collect():
        n[row["code"]] = row["n"]
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    single = n.sum((0, 1)) + 1.0
    single /= single.sum()
    pair = n.sum(0) + 20.0 * single
    pair /= pair.sum(1, keepdims=True)
    triple = n + 20.0 * pair[None]
    return -np.log(triple / triple.sum(2, keepdims=True))


def _code(c: str) -> int:
    i = ord(c) - 97
    return i if 0 <= i < 26 else OTHER


def decode(word: str, model: np.ndarray, repeats: bool = True) -> str:
    """The cheapest reading of one spelling, with a space where a separator is read as the border of two words.

    A state is the last two letters written and the last raw character, so a dropped repetition compares raw
    characters. The number of states per position is bounded by the few readings of a character.
    """
    paths: dict[tuple, tuple[float, tuple | None]] = {(EDGE, EDGE, ""): (0.0, None)}
    for raw in word:
        readings = [(raw, 0.0)] if raw.isalpha() else [(x, PAY_LEET) for x in IMITATES.get(raw, "")]
        after: dict[tuple, tuple[float, tuple | None]] = {}

        def offer(state: tuple, cost: float, text: tuple | None) -> None:
            if state not in after or cost < after[state][0]:
                after[state] = (cost, text)

        for (one, two, last), (cost, text) in paths.items():
            for letter, pay in readings:
                code = _code(letter)
                offer((two, code, raw), cost + pay + model[one, two, code], (text, letter))
            if raw in SEPARATORS and two != EDGE:
                offer((two, EDGE, raw), cost + PAY_DROP + model[one, two, EDGE], (text, " "))
            if raw == last and repeats:
                offer((one, two, last), cost + PAY_REPEAT, text)
            elif raw in SEPARATORS:
                offer((one, two, last), cost + PAY_DROP, text)
            elif not readings:
                offer((one, two, raw), cost + PAY_ODD, text)
        paths = after
    best = min(((cost + model[one, two, EDGE], text) for (one, two, _), (cost, text) in paths.items()), key=lambda x: x[0])[1]
    letters = []
    while best is not None:
        best, letter = best
        letters.append(letter)
    return "".join(reversed(letters))


class Restorer:
    """Words of a text as they were meant; remembers the spellings it has decoded."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.memo: dict[str, tuple[str, ...]] = {}
        self.readings: dict[str, tuple[str, ...]] = {}

    def token(self, token: str) -> tuple[str, ...]:
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[token] = self._token(token)
        return found

    def _token(self, token: str) -> tuple[str, ...]:
        core = _EDGES.sub("", token)
        plain = [core] if core.isalpha() else [p for p in _PARTS.findall(token) if p.isalpha()]
        # Outer signs that imitate nothing can only be dropped; the others may be letters or brackets.
        return tuple(dict.fromkeys([*plain, *self.decoded(core), *self.decoded(_OUTER.sub("", token))]))

    def decoded(self, spelling: str) -> tuple[str, ...]:
        """Words of the cheapest readings; none of a spelling that can only be itself."""
        doubled = _DOUBLE.search(spelling)
        if not spelling or spelling.isalpha() and not doubled:
            return ()
        found = self.readings.get(spelling)
        if found is None:
            if len(self.readings) >= MEMO:
                self.readings.clear()
            words = decode(spelling, self.model).split()
            if doubled and not spelling.isalpha():
                words += decode(spelling, self.model, repeats=False).split()
            parts = _PARTS.findall(spelling)
            if len(parts) > 1:
                words += [w for p in parts if not p.isalpha() and not p.isdigit() for w in decode(p, self.model).split()]
            found = self.readings[spelling] = tuple(words)
        return found

    def spaced(self, run: str) -> tuple[str, ...]:
        """Words of a run of single letters: as one word, and with borders where the model sees them."""
        return (*self.token(run[::2]), *decode(run, self.model).split()) if len(run) < 80 else tuple(decode(run, self.model).split())

    def words(self, text: str | None) -> set[str]:
        """Distinct restored words of a whole text."""
        if not text:
            return set()
        low = text.lower()
        out: set[str] = set()
        for token in set(low.split()):
            out.update(self.token(token))
        for run in _SPACED.findall(low):
            out.update(self.spaced(run))
        return out


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def labelled_features(restore: Restorer):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted({f for w in restore.words(t) for f in features_of(w)}) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "features": found})

    return run


def fit(documents: DataFrame, labels: DataFrame, model: np.ndarray, folds: int, held_out: int) -> tuple[dict[str, float], float]:
    """Weights of features and the intercept, from at most FIT_ROWS labelled documents outside the held-out fold.

    The chosen ids are the only side that is broadcast, and the matrix of the chosen documents, FIT_ROWS x FEATURES
    bits at most, is what reaches the driver.
    """
    chosen = (
        labels.select("doc_id", "toxic")
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = stage(rows.mapInPandas(labelled_features(Restorer(model)), "doc_id long, toxic int, features array<string>"), "toxic-sample")
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ones, zeros = kinds.get(1, 0), sum(n for k, n in kinds.items() if k != 1)
    if not ones or not zeros:
        share = min(max(ones / max(1, ones + zeros), 1e-9), 1 - 1e-9)
        return {}, float(np.log(share / (1 - share)))
    share = (F.col("p") + 0.5) / (ones + 1)
    other = (F.col("q") + 0.5) / (zeros + 1)
    best = (
        sample.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.sum((F.col("toxic") == 1).cast("int")).alias("p"), F.sum((F.col("toxic") != 1).cast("int")).alias("q"))
        .where((F.col("p") >= 3) & (share > 3 * other))
        .orderBy(F.desc(F.round(F.col("p") * F.log(share / other), 6)), "feature").limit(FEATURES)
    )
    names = [r["feature"] for r in best.collect()]
    at = {f: i for i, f in enumerate(names)}
    x, y = np.zeros((ones + zeros, len(names))), np.zeros(ones + zeros)
    kept = F.array_intersect("features", F.array(*[F.lit(f) for f in names])) if names else F.array().cast("array<string>")
    for i, row in enumerate(sample.select("toxic", "doc_id", kept.alias("f")).orderBy("doc_id").collect()):
        y[i] = row["toxic"] == 1
        x[i, [at[f] for f in row["f"]]] = 1
    w, b = np.zeros(len(names)), float(np.log(ones / zeros))
    rate, mw, vw, mb, vb = 0.05, np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, 601):  # Adam on the mean log loss with a light ridge
        gap = 1 / (1 + np.exp(-(x @ w + b))) - y
        gw, gb = x.T @ gap / len(y) + 2e-4 * w, gap.mean()
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        w -= rate * (mw / (1 - 0.9**step)) / (np.sqrt(vw / (1 - 0.999**step)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    return {f: float(w[i]) for f, i in at.items()}, float(b)


def scorer(restore: Restorer, weights: dict[str, float], intercept: float):
    """The column of scores of a column of texts."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, frozenset[str]] = {}
        nothing: frozenset[str] = frozenset()

        def found(words) -> frozenset[str]:
            return frozenset(f for w in words for f in features_of(w) if f in weights) or nothing

        for texts in batches:
            out = []
            for text in texts:
                hits: set[str] = set()
                low = text.lower() if text else ""
                for token in set(low.split()):
                    own = memo.get(token)
                    if own is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        own = memo[token] = found(restore._token(token))
                    if own:
                        hits |= own
                for run in _SPACED.findall(low):
                    hits |= found(restore.spaced(run))
                out.append(1 / (1 + np.exp(-(intercept + sum(weights[f] for f in sorted(hits))))))
            yield pd.Series(out, dtype="float64")

    return score


def with_scores(documents: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """The documents with a column ``toxic_score``: two passes over all texts, no shuffle of them."""
    model = character_model(documents)
    weights, intercept = fit(documents, labels, model, folds, held_out)
    score = F.pandas_udf(scorer(Restorer(model), weights, intercept), "double")
    return documents.withColumn("toxic_score", score(F.col("text")))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_scores(documents.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )
