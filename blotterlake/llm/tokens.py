"""Token ids of whole texts with the tokenizers library, one encoding per distinct word.

The tokenizer's splitting never joins characters across ASCII white space, so a text's ids are
those of its white-space separated words in order.  Words repeat, so a task encodes each distinct
word once and gathers ids by position.  Equality with encoding the whole text is tested.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from blotterlake.llm.common import WORKER_CACHES

CACHE_WORDS = 400_000  # words an encoder remembers; a full memory keeps those it meets most
END_ID = 1
_ENCODERS: dict[str, WordEncoder] = {}
WORKER_CACHES.append(_ENCODERS)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str, held_words: int = CACHE_WORDS) -> WordEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks of one operator."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].held_words = held_words
    return _ENCODERS[path]


class WordEncoder:
    """Ids of words are held end to end in one array and found by a word's number, so a text's ids are a take of Arrow's."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.word_end = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.word_end[i] = token.endswith("</w>")
        self.held_words = CACHE_WORDS
        self.closing: dict[str, bool] = {}  # by character: whether signs after it are a piece of their own
        self._hold({}, pa.array([np.array([END_ID], self.kind).tobytes()], pa.large_binary()), np.zeros(1, np.int32))

    def _hold(self, memory: dict[str, int], coded: pa.Array, uses: np.ndarray) -> None:
        """``memory`` gives the place of a word's ids in ``coded``; place 0, of no word, has the end id."""
        self.memory, self.uses, self.filled = memory, uses, len(coded)
        _, stops, ids = coded.buffers()
        self.stops = np.frombuffer(stops, np.int64)[: len(coded) + 1].copy()  # in bytes
        self.coded = np.frombuffer(ids, np.uint8)[: self.stops[-1]].copy()

    def _held(self, places: np.ndarray) -> pa.Array:
        buffers = [None, pa.py_buffer(self.stops), pa.py_buffer(self.coded)]
        return pa.Array.from_buffers(pa.large_binary(), self.filled, buffers).take(pa.array(places))

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Remember new words by their ids, end to end, and how many bytes of these each has."""
        ends = self.stops[self.filled] + np.cumsum(lengths)
        more = self.filled + len(words)
        if len(words):
            self.stops = _room(self.stops, more + 1)
            self.coded = _room(self.coded, int(ends[-1]))
            self.uses = _room(self.uses, more)
            self.coded[self.stops[self.filled] : ends[-1]] = ids.view(np.uint8)
            self.stops[self.filled + 1 : more + 1] = ends
            self.uses[self.filled : more] = 0
            self.memory.update(zip(words, range(self.filled, more)))
            self.filled = more

    def _forget(self) -> None:
        """Keep, of at most half the words a memory may have, those that the most calls met."""
        half, uses = self.held_words // 2, self.uses[: self.filled]
        least = np.partition(uses, -half - 1)[-half - 1] if half else uses.max()
        kept = uses > least
        kept[0] = True
        renumbered = np.where(kept, np.cumsum(kept) - 1, -1).tolist()
        memory = {w: place for w, at in self.memory.items() if (place := renumbered[at]) > 0}
        places = np.flatnonzero(kept)
        self._hold(memory, self._held(places), uses[places] // 2)

    def _closes(self, char: str) -> bool:
        """Whether the tokenizer splits between ``char`` and a full stop; both its marks and unknown letters may not be split."""
        if char not in self.closing:
            tidy, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
            text = tidy.normalize_str(f"{char}.") if tidy else f"{char}."
            self.closing[char] = split is not None and split.pre_tokenize_str(text)[-1][0] == "."
        return self.closing[char]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _each(self, words: list[str]) -> None:
        """Remember words that are encoded one by one."""
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            found = [self.encode(w) for w in some]
            self._add(some, np.concatenate(found), self.kind.itemsize * np.fromiter(map(len, found), np.int64, len(found)))

    def _letters(self, words: list[str]) -> None:
        """Remember words of letters only: a thousand in one call, cut where words end."""
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            # Without offsets in the text, which nobody reads.
            (found,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(some):  # a letter whose lower case is more than letters
                self._each(some)
            else:
                self._add(some, ids, self.kind.itemsize * np.diff(ends, prepend=0))

    def _tailed(self, words: list[str], stems: list[str]) -> None:
        """Remember words of letters and signs after them, by the ids of both, which the tokenizer splits anyway."""
        tails = [w[len(stem) :] for w, stem in zip(words, stems)]
        self._letters([w for w in dict.fromkeys(stems) if w not in self.memory])
        self._each([w for w in dict.fromkeys(tails) if w not in self.memory])
        pairs = np.empty(2 * len(words), np.int64)
        pairs[::2], pairs[1::2] = self._places(stems), self._places(tails)
        self.uses[pairs] += 1
        held = self._held(pairs)
        _, stops, ids = held.buffers()
        stops = np.frombuffer(stops, np.int64)[: len(held) + 1 : 2]
        self._add(words, np.frombuffer(ids, np.uint8)[: stops[-1]], np.diff(stops))

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the words are held; -1 of one that is not."""
        return np.fromiter(map(self.memory.get, words, repeat(-1)), np.int64, len(words))

    def words(self, words: list[str]) -> np.ndarray:
        """Where the ids of each of the words, all different, are held."""
        if self.filled > self.held_words:
            self._forget()
        places = self._places(words)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self._letters([w for w in new if w.isalpha()])
            rest = [(w, w.rstrip(".,!?;:*#%&$")) for w in new if w not in self.memory]
            tailed = [(w, stem) for w, stem in rest if stem != w and stem.isalpha() and self._closes(stem[-1])]
            if tailed:
                self._tailed(*map(list, zip(*tailed)))
            self._each([w for w, _ in rest if w not in self.memory])
            places[missing] = self._places(new)
        self.uses[places] += 1
        return places

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``END_ID``, and the len + 1 offsets of the texts."""
        if not len(texts):
            return np.empty(0, self.kind), np.zeros(1, np.int64)
        # A copy that starts at offset 0: ascii_lower misreads slices of an array.
        texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
        # The tokenizer lower-cases, so words that differ in ASCII case have the same ids, but for
        # its special tokens, which are found before that.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each word first
        known = self._held(np.append(self.words(words), 0))
        counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(counts)
        order = np.insert(coded.indices.to_numpy(), ends, len(known) - 1)
        _, stops, ids = known.take(pa.array(order)).buffers()
        stops = np.frombuffer(stops, np.int64)[: len(order) + 1] // self.kind.itemsize
        return np.frombuffer(ids, self.kind)[: stops[-1]], np.concatenate(([0], stops[ends + np.arange(1, len(ends) + 1)]))


def _room(held: np.ndarray, size: int) -> np.ndarray:
    """``held``, or a copy with room for ``size`` values and a fifth more."""
    if size <= len(held):
        return held
    wider = np.empty(size + size // 5, held.dtype)
    wider[: len(held)] = held
    return wider
