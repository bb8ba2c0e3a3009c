"""The word ids of the packing stage: those of the tokenizer, without a second model in memory."""

import numpy as np
import pytest

from riskframe.llm import tokens
from riskframe.llm.queries import WORD_VOCABULARY, tokenizer_path

P = pytest.importorskip("public_tokenizers")
TEXTS = ["Plain words, it's 42 plain words!", "Ünïted ÉTÉ çà ØRE ž", "a\x00b 中文 \U0001f600", "x" * 500, "", None, " \t\n",
         "<|endoftext|> inside", "tabs\tand  spaces we'll they've"]


def test_ids_are_those_of_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    words = tokens.WordIds(tokenizer_path(WORD_VOCABULARY))
    whole = [words.whole.encode(text or "", add_special_tokens=False).ids for text in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in words.encode(TEXTS)] == whole


def test_both_tokenizers_hold_one_model():
    words = tokens.WordIds(tokenizer_path(WORD_VOCABULARY))
    words.words.model.fuse_unk = True
    try:
        assert words.whole.model.fuse_unk
    finally:
        words.words.model.fuse_unk = False
