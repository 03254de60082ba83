"""Token ids of whole texts, by the tokenizers library, inside Arrow tasks.

Running text repeats its words. A task cuts a slice of texts into words,
numbers the distinct ones, looks up or encodes each of those once, and gathers
the ids of all texts from them by position. Cutting is exact only where a
tokenizer cannot see across the cut, which ``_cuts`` decides from its
definition; other tokenizers and texts, such as those that hold the string of a
special token, go through the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words that a worker remembers; about 200 bytes each.
CACHED_WORDS = 400_000
#: As many if nothing else runs in the worker.
CACHED_WORDS_ALONE = 800_000
#: Bytes of text that are cut and gathered at a time.
SLICE_BYTES = 4 << 20
#: Words that the library encodes at a time; what it returns is far larger than its ids.
WORDS_AT_ONCE = 2_000

#: Marks a word that no blank precedes; twice, the end of a text.
_MARK = "\0"
#: All that Python or a tokenizer may hold for white space.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Letters below this are single letters to any tokenizer, in lower case too.
_PLAIN_LETTERS = "\u0100"
#: White space that a tokenizer might group across a cut, and the mark itself.
_HARD = rf" {_SPACES}|{_SPACES}{{3}}|{_SPACES}{{2}}$|\x00"
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])[ \n]")


def _cuts(definition: dict) -> str | None:
    """How texts may be cut into words: "before" white space, "at" it, or not at all.

    A byte-level tokenizer that keeps white space puts a blank to the word
    behind it, and no piece crosses from a word into white space. One that
    drops white space treats every word alone.
    """
    pieces = definition.get("pre_tokenizer") or {}
    if pieces.get("type") == "ByteLevel" and not definition.get("normalizer"):
        if pieces.get("use_regex") and not pieces.get("add_prefix_space"):
            return "before"
    if pieces.get("type") == "Sequence":
        first = pieces["pretokenizers"][0]
        drops = first.get("type") == "Split" and first.get("behavior") == "Removed"
        pattern = first.get("pattern", {}).get("Regex", "")
        if drops and first.get("invert") and pattern.endswith(r"|[^\s\p{L}\p{N}]+"):
            return "at"
    return None


def _core(key: str) -> str:
    """A word without the comma or full stop behind its last letter."""
    if key[-1:] in (",", ".") and key[-2:-1].isalpha() and key[-2] < _PLAIN_LETTERS:
        return key[:-1]
    return key


def parts(text: str, size: int) -> Iterator[str]:
    """A long text in parts that begin at white space behind a word."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Texts to ids, each text's followed by an end id."""

    def __init__(
        self,
        path: str,
        end_id: int,
        cached_words: int = CACHED_WORDS,
        special_as_text: bool = False,
    ) -> None:
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        # Strings like <|endoftext|> in a text are that token, as the library has it by default.
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [] if special_as_text else definition.get("added_tokens", [])
        self.dtype = id_type(path, end_id)
        self.code = np.dtype(self.dtype).char
        self.end = np.array([end_id], self.dtype).tobytes()
        self.cuts = _cuts(definition)
        if any(re.search(r"\s", token["content"]) for token in self.added):
            self.cuts = None
        self.cached_words = cached_words
        self.known: dict[str, bytes] = {_MARK * 2: self.end}
        if self.cuts:
            self.known |= zip((_MARK + ",", _MARK + "."), self._library([",", "."]))
        steps = (definition.get("normalizer") or {}).get("normalizers", [])
        self.folds = self.cuts == "at" and {"type": "Lowercase"} in steps

    def _library(self, texts: list[str]) -> list[bytes]:
        encode, done = self.tokenizer.encode_batch_fast, []
        for first in range(0, len(texts), WORDS_AT_ONCE):
            encoded = encode(texts[first : first + WORDS_AT_ONCE], add_special_tokens=False)
            done += [array(self.code, e.ids).tobytes() for e in encoded]
        return done

    def _word(self, key: str) -> str:
        """The text that a word stands for: with the blank before it, if there is one."""
        if key.startswith(_MARK):
            return key[1:]
        return key if self.cuts == "at" or key.startswith("\n") else " " + key

    def _of_words(self, keys: list[str]) -> list[bytes]:
        """The ids of distinct words; unknown ones go through the library, once each.

        A comma or full stop behind a letter is a piece of its own in both kinds
        of tokenizers, so a word with one shares the ids of the word without.
        """
        known = self.known
        found = [*map(known.get, keys)]
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh: dict[str, bytes | None] = {}
        for i in missing:
            core = _core(keys[i])
            if core not in known:
                fresh[core] = None
        fresh = dict(zip(fresh, self._library([*map(self._word, fresh)]), strict=True))
        if len(known) + len(fresh) <= self.cached_words:
            known.update(fresh)
        for i in missing:
            key = keys[i]
            core = _core(key)
            ids = fresh[core] if core in fresh else known[core]
            found[i] = ids if core == key else ids + known[_MARK + key[-1]]
        return found

    def _gathered(self, texts: pa.Array, last: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that may be cut, and how many each has; ``last`` closes each text."""
        blank = " " if self.cuts == "at" else " \n"
        texts = pc.ascii_lower(texts) if self.folds else texts
        marked = pc.binary_join_element_wise(_MARK, pc.replace_substring(texts, "\n", blank), last, "")
        split = pc.split_pattern(marked, " ")
        words = split.values.dictionary_encode()
        at = words.indices.to_numpy()
        found = self._of_words(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // len(self.end)
        ids = np.frombuffer(b"".join(found), self.dtype)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[at]
        ends = np.cumsum(lengths)
        place = np.repeat(starts[at] - (ends - lengths), lengths)
        place += np.arange(len(place))
        first = split.offsets.to_numpy()
        before = np.concatenate([[0], ends])
        return ids[place], before[first[1:]] - before[first[:-1]]

    def _alone(self, text: str) -> np.ndarray:
        """Ids of a text that is long or must not be cut, without the end id."""
        done = []
        for part in parts(text, SLICE_BYTES) if self.cuts else [text]:
            slice_ = pa.array([part])
            if self._hard(slice_)[0].as_py():
                done.append(np.frombuffer(self._library([part])[0], self.dtype))
            else:
                done.append(self._gathered(slice_, "")[0])
        return np.concatenate(done)

    def _hard(self, texts: pa.Array) -> pa.Array:
        if self.cuts is None:
            return pa.array([True] * len(texts))
        hard = pc.match_substring_regex(texts, _HARD if self.cuts == "before" else r"\x00")
        for token in self.added:
            # Words are folded before the library sees them, which must not make a token of text.
            any_case = self.folds or bool(token.get("normalized"))
            found = pc.match_substring(texts, token["content"], ignore_case=any_case)
            hard = pc.or_(hard, found)
        return hard

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per slice of ``texts``: the ids of its texts, back to back, and each text's number of ids.

        A NULL text is an empty one. Every text has its end id.
        """
        texts = texts.cast(pa.string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy()
        hard = self._hard(texts).to_numpy(zero_copy_only=False) | (sizes > SLICE_BYTES)
        end = np.frombuffer(self.end, self.dtype)
        first = 0
        while first < len(texts):
            if hard[first]:
                ids = np.concatenate([self._alone(texts[first].as_py()), end])
                yield ids, np.array([len(ids)])
                first += 1
                continue
            # Up to the next hard text or the slice's size, one text at least.
            stop = np.flatnonzero(hard[first:])
            stop = first + int(stop[0]) if len(stop) else len(texts)
            room = np.searchsorted(np.cumsum(sizes[first:stop]), SLICE_BYTES, "right")
            stop = first + max(1, int(room))
            yield self._gathered(texts[first:stop], f" {_MARK}{_MARK}")
            first = stop


@functools.cache
def encoder(
    path: str, end_id: int, cached_words: int = CACHED_WORDS, special_as_text: bool = False
) -> Encoder:
    """One encoder per worker process, with the words it has met."""
    return Encoder(path, end_id, cached_words, special_as_text)


def id_type(path: str, end_id: int) -> str:
    """The smallest unsigned type that holds every id."""
    size = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    return "<u2" if size <= 1 << 16 else "<u4"
