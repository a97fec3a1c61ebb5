"""Token ids of an Arrow text column with a public tokenizer file, word by word.

For a tokenizer that drops white space and never joins across it, the ids of a text are those of its words one
after another. A task encodes each distinct word once and then gathers ids by array operations.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

from tripmart.llm.wordhash import words

#: Ids that a task remembers for words it has met.
_KNOWN_IDS = 4_000_000
#: Words that are given to the tokenizer at once; its results take far more memory than their ids.
_WORDS_AT_ONCE = 4096
_WORDS_JOINED = 128


# Kinds of bytes: 1 for ASCII letters, 2 for ASCII punctuation. Where they meet the tokenizer always cuts. The
# apostrophe is left out, as it starts contractions, and the bar, as it is part of special tokens.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[list(map(ord, string.ascii_letters))] = 1
_KINDS[[ord(c) for c in string.punctuation if c not in "'|"]] = 2


class WordEncoder:
    """Ids of the rows of a chunk, for a tokenizer that drops white space, lower-cases, and cuts letters from
    punctuation. So are the words here, before they are encoded: then few of them are distinct.
    """

    def __init__(self, path: str):
        # One thread for a task: Spark counts on it, and each further thread keeps memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, tokens: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text one after another, a few thousand texts at a time."""
        for low in range(0, len(tokens), _WORDS_AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(tokens[low : low + _WORDS_AT_ONCE], add_special_tokens=False)
            for x in encoded:
                yield np.array(x.ids, dtype=np.uint32)

    def _encode_letters(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, sizes) of words of letters only, each of which ends with its one token that ends a word.

        They are joined by spaces, which takes half the time of one call for each. None if the tokenizer marks
        no ends of words.
        """
        joined = [" ".join(tokens[k : k + _WORDS_JOINED]) for k in range(0, len(tokens), _WORDS_JOINED)]
        ids = np.concatenate([*self._encode(joined), np.zeros(0, np.uint32)])
        past = np.flatnonzero(self.ends_word[ids]) + 1
        return (ids, np.diff(past, prepend=0)) if len(past) == len(tokens) else None

    def _learn(self, keys: np.ndarray, tokens: list[str]) -> None:
        plain = np.array([t.isalpha() and t.lower().isalpha() for t in tokens])
        order = np.argsort(~plain, kind="stable")
        n_plain = int(plain.sum())
        tokens = [tokens[k] for k in order]
        found = self._encode_letters(tokens[:n_plain])
        if found is None:
            found, n_plain = (np.zeros(0, np.uint32), np.zeros(0, np.int64)), 0
        rest = list(self._encode(tokens[n_plain:]))
        size = np.concatenate([found[1], np.array([len(x) for x in rest], dtype=np.int64)])
        first = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, found[0], *rest])
        every = np.concatenate([self.keys, keys[order]])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.first = np.concatenate([self.first, first])[order]
        self.size = np.concatenate([self.size, size])[order]

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, number of ids of each row)."""
        # A special token in capitals is ordinary text and must not become one.
        lower = b"<|" not in data.tobytes()
        found = words(data, bounds, lower=lower, kinds=_KINDS)
        kinds, where, place = np.unique(found.hash, return_index=True, return_inverse=True)
        if len(self.ids) > _KNOWN_IDS:
            self._forget()
        new = np.ones(len(kinds), dtype=bool)
        if len(self.keys):
            new = self.keys[np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)] != kinds
        if new.any():
            raw = found.data.tobytes()
            spans = zip(found.start[where[new]].tolist(), found.end[where[new]].tolist(), strict=True)
            self._learn(kinds[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
        at = np.searchsorted(self.keys, kinds)[place]
        size = self.size[at]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ids = self.ids[np.repeat(self.first[at], size) + within]
        return ids, np.bincount(found.row, weights=size, minlength=len(bounds) - 1).astype(np.int64)
