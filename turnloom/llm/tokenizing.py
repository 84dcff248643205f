"""Token ids by a public tokenizer, each distinct word encoded about once per worker.

The tokenizer drops white space and never joins across it, so the ids of a text
are those of its words, one after the other.  Words are told apart by 64-bit
hashes and lengths; a table in the Python worker holds the ids of known words,
and a batch of texts is then one array lookup.  Special strings in a text are
found as the library finds them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np

from turnloom.llm.words import Words, gather, text_runs, words_of

TOKENIZER = "word_bpe_49k.json"
KNOWN_WORDS = 2_000_000
BATCH_CHARS = 250_000
# Letters that normalising leaves alone but for their case, and the marks that often follow a word.
_CORE = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_ENDS = (b".", b",")


@cache
def tokenizer_path(name: str) -> str:
    """A bare name is a file of the public collection; anything else is a path."""
    if os.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordEncoder:
    """Ids of texts, from a table of whole words.

    A word of Latin letters with perhaps one full stop or comma behind it is two
    pieces to the tokenizer, and case is folded by it.  New words of this kind
    are encoded in long runs by a copy of the tokenizer that leaves out the
    steps which change nothing here; the end mark on a core's last token tells
    them apart.  Any other word is encoded alone by the tokenizer as it is.
    """

    def __init__(self, name: str = TOKENIZER, known: int = KNOWN_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(tokenizer_path(name))
        self.plain = Tokenizer.from_file(tokenizer_path(name))
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        for t, i in self.tok.get_vocab().items():
            self.ends[i] = t.endswith("</w>")
        self.tail = {p: self._alone([p.decode()])[0] for p in _ENDS}
        self.limit = known
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.size = np.zeros(0, np.int64)  # bytes of the word
        self.at = np.zeros(0, np.int64)  # where its ids are in the pool
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _alone(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def _cores(self, cores: list[str], run: int = 256) -> Iterator[tuple[str, list[int]]]:
        for i in range(0, len(cores), run):
            words = cores[i : i + run]
            ids = self.plain.encode(" ".join(words), add_special_tokens=False).ids
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            yield from zip(words, (ids[a:b] for a, b in zip([0, *cuts], cuts)), strict=True)

    def _learn(self, words: list[bytes]) -> list[list[int]]:
        parts: list[tuple[str | None, list[int]]] = []
        odd = []
        for w in words:
            end = w[-1:]
            core = w[:-1] if end in self.tail else w
            if _CORE.fullmatch(core):
                parts.append((core.decode().lower(), self.tail[end] if core != w else []))
            else:
                parts.append((None, []))
                odd.append(w.decode("utf-8", "replace"))
        ids = dict(self._cores(list({c for c, _ in parts if c is not None})))
        rest = iter(self._alone(odd))
        return [next(rest) if core is None else ids[core] + tail for core, tail in parts]

    def _find(self, key: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table of each word, and whether it is there."""
        if not len(self.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return place, (self.key[place] == key) & (self.size[place] == size)

    def _coded(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        key, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        size = (w.end - w.start)[first]
        place, known = self._find(key, size)
        if not known.all():
            if len(self.key) + np.count_nonzero(~known) > self.limit:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            ids = self._learn([w.data[a:b] for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            at = len(self.pool) + np.cumsum(length) - length
            self.pool = np.concatenate([self.pool, np.fromiter((x for i in ids for x in i), np.uint32, int(length.sum()))])
            order = np.searchsorted(self.key, key[new])
            self.key, self.size, self.at, self.length = (
                np.insert(old, order, more)
                for old, more in ((self.key, key[new]), (self.size, size[new]), (self.at, at), (self.length, length))
            )
            place, known = self._find(key, size)
        place = place[which]
        length = self.length[place]
        ends = np.concatenate([[0], np.cumsum(length)])
        return gather(self.pool, self.at[place], length), ends[w.bounds]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text as 32-bit numbers; none for a null text."""
        for run in text_runs(texts, BATCH_CHARS):
            ids, ends = self._coded(words_of(run))
            yield from (ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))


@cache
def encoder(name: str = TOKENIZER) -> WordEncoder:
    """One encoder per worker process, kept between tasks."""
    return WordEncoder(name)
