"""Added tokens inside ordinary texts, against the library as it comes."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewatch.llm import packing


def test_added_tokens_in_texts_are_the_librarys():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, tokens, draw = Tokenizer.from_file(path), packing.Tokens(path), random.Random(3)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", None, ""]
    for _ in range(1000):
        texts.append("".join(draw.choice([" ", "  ", "\n", "ab", "don't", "12", "爱", "<|", "<|endoftext|>"]) for _ in range(draw.randrange(9))))
    for text, found in zip(texts, tokens.ids(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
