"""Ids word by word against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortlens.llm.tokens import WordIds, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    own = Tokenizer.from_file(PATH).encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in own]


def test_typographic_text():
    texts = [
        "He said “yes”.", "wait…!", "yes”, she said", "(“ok”)?", "done—.", "😀!", "price €.", "कि.", "İ.", "it's.", "x'", "ΟΔΟΣ.",
        "á.", "ﬁ.", "a²!", "H̱ J̌.", "ẖ.", "<|endoftext|>.", "<|ENDOFTEXT|>", "b<|x|>.", "", "   ", " a  b ", " a. ", "a. b", None,
    ]
    assert WordIds(PATH).encode(texts) == whole(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_text(seed):
    draw = random.Random(seed)
    some = list("abXYZ019 .,!?'\"-_()[]{}<>|/=&%$#@~^:;*\n\t") + list("éèßİıſΣςǅ①²½ªº“”‘’…—€́̇िकำ가각中 ‍😀👍🏽\x00\x7f\x85Ωᲀབྷ̱")
    every = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(draw.choice(some if draw.random() < 0.8 else every) for _ in range(draw.randrange(14))) for _ in range(20_000)]
    assert word_ids(PATH, 500).encode(texts) == whole(texts)
    assert word_ids(PATH, 500) is word_ids(PATH, 500)
