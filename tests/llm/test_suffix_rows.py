"""Repeated strings where ids repeat or are missing, and where columns clash."""

import hashlib
import random

from tidewatch.llm import suffix_dedup

L = suffix_dedup.LENGTH


def _brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of every row, from all windows of all rows."""
    raws, seen = [(t or "").encode() for _, t in rows], {}
    for raw in raws:
        for i in range(len(raw) - L + 1):
            seen[raw[i : i + L]] = seen.get(raw[i : i + L], 0) + 1
    out = []
    for (doc_id, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - L + 1):
            if seen[raw[i : i + L]] > 1:
                gone[i : i + L] = b"\1" * L
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _rows():
    draw = random.Random(8)
    prose = lambda n: " ".join(f"w{draw.randrange(900)}" for _ in range(n))
    shared, other = prose(80), prose(90)
    long = f"{prose(20_000)} {other} {prose(20_000)}"
    return [
        (1, f"{prose(3)} {shared}"), (1, "ab"), (2, f"{shared} {prose(2)}"),  # one id, two texts
        (3, other), (3, prose(70)), (3, None), (3, ""),
        (None, f"x {shared} y"), (None, prose(60)), (None, None), (0, f"x {shared} y"),  # no id, and the id 0
        (5, f"{prose(5)} {other}"), (5, f"{prose(5)} {other}"), (6, long),
        (7, "é" * 150), (8, "é" * 150),
    ]


def _key(row):
    return tuple((v is None, v) if v is not None else (True, 0) for v in row)


def test_rows_that_share_or_lack_an_id(spark):
    rows = _rows()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [tuple(r) for r in suffix_dedup.suffix_dedup(table).collect()]
    assert sorted(found, key=_key) == sorted(_brute(rows), key=_key)


def test_clashing_columns_are_carried_along(spark):
    rows = _rows()
    schema = "doc_id long, text string, spans string, mark string, found string, _spans string, `a.b` string"
    full = [(i, t, f"s{n}", "m", "f", "p", "d") for n, (i, t) in enumerate(rows)]
    done = suffix_dedup.remove_repeats(spark.createDataFrame(full, schema).repartition(3))
    assert done.columns == ["doc_id", "text", "spans", "mark", "found", "_spans", "a.b"]
    kept = {r.spans: r for r in done.collect()}
    assert len(kept) == len(rows)
    for n, ((doc_id, text), (_, n_bytes, removed, _, digest)) in enumerate(zip(rows, _brute(rows), strict=True)):
        row = kept[f"s{n}"]
        assert (row.doc_id, row.mark, row.found, row["_spans"], row["a.b"]) == (doc_id, "m", "f", "p", "d")
        if removed == 0:
            assert row.text == text
        else:
            assert len(row.text.encode()) == n_bytes - removed and hashlib.sha256(row.text.encode()).hexdigest() == digest


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, spans string")
    assert suffix_dedup.suffix_dedup(empty).count() == 0 and suffix_dedup.remove_repeats(empty).count() == 0
