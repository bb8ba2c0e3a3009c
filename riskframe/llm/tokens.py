"""Token ids of texts by a public tokenizer, with a bounded cache of words for the word-based vocabulary."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Sequence

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words kept per worker; the cache starts anew beyond it.
CACHE_WORDS = 600_000
#: Texts whose words are looked up together.
GROUP = 128


@functools.lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of a tokenizer that splits texts into words before merging, as ``encode(add_special_tokens=False)`` gives.

    Plain Latin texts are split here and each distinct word is encoded once by the same
    merge model; any other text goes through the tokenizer whole.
    """

    # Letters that keep their length in lower case and are composed already; ASCII; ASCII white space.
    PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-įı-ňŊ-ž]*")
    # The pre-tokenizer's pattern, for such texts in lower case.
    SPLIT = re.compile(
        "'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ž]+|[0-9]"
        "|[^\t-\r a-zÀ-ÖØ-öø-ž0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = load(path)
        self.special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        ends = getattr(self.whole.model, "end_of_word_suffix", None)
        if not ends:
            raise ValueError("the vocabulary must mark the ends of words")
        vocab = self.whole.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocab.items() if token.endswith(ends)]] = True
        # Both tokenizers hold the same model, it is in memory once.
        self.words = Tokenizer(self.whole.model)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        self.cache: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        # The fast form keeps no offsets.
        ids = self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype="<u4")
        stops = np.flatnonzero(self.last[ids]) + 1
        data, at = ids.tobytes(), 0
        for word, stop in zip(words, stops.tolist(), strict=True):
            self.cache[word] = data[4 * at:4 * stop]
            at = stop

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit values."""
        out = []
        for i in range(0, len(texts), GROUP):
            split = []
            for text in texts[i:i + GROUP]:
                text = text or ""
                plain = self.PLAIN.fullmatch(text) and not any(mark in text for mark in self.special)
                split.append(self.SPLIT.findall(text.lower()) if plain else text)
            used = set().union(*[words for words in split if isinstance(words, list)])
            fresh = used.difference(self.cache)
            if fresh:
                self._learn(list(used if len(self.cache) + len(fresh) > CACHE_WORDS else fresh))
            for words in split:
                if isinstance(words, list):
                    out.append(b"".join(map(self.cache.__getitem__, words)))
                else:
                    ids = self.whole.encode(words, add_special_tokens=False).ids
                    out.append(np.array(ids, dtype="<u4").tobytes())
        return out


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
