"""Spellings that the lattice is built for reach it."""

import numpy as np
import pytest

from tidewatch.llm import toxicity

WORDS = "you are an idiot and a moron so stupid what an ass this shit is plain prose of words and letters all over"


@pytest.fixture(scope="module")
def restore(spark):
    table = spark.createDataFrame([(i, WORDS) for i in range(200)], "doc_id long, text string")
    return toxicity.Restorer(toxicity.character_model(table))


@pytest.mark.parametrize(
    ("spelling", "word"),
    [("idio+", "idiot"), ("shi+", "shit"), ("a$$", "ass"), ("stu.pid", "stupid"), ("idi-ot", "idiot"), ("stu_pid", "stupid"),
     ("mor*on", "moron"), ("id\u200biot", "idiot"), ("iidiioott", "idiot"), ("(idi0t).", "idiot"), ("y o u i d i o t", "idiot"),
     ("so.stu.pid", "stupid"), ("letters", "letters"), ("well-known", "known")],
)
def test_obfuscations_are_decoded(restore, spelling, word):
    assert word in restore.words(f"plain {spelling}")


def test_plain_words_are_themselves():
    model = np.zeros((toxicity.SYMBOLS,) * 3)
    assert toxicity.Restorer(model).words("plain words, here.") == {"plain", "words", "here"}
