"""Token counts of whole texts under a sentencepiece BPE vocabulary.

Only the number of tokens is wanted, so no token is ever named. A task cuts a
slice of texts into pre-tokens, counts each distinct one once, and adds up. The
unknown pre-tokens of a slice lie behind one another in one array of symbols,
a ragged array with a start per sequence. In a round every sequence finds the
lowest rank of its adjacent pairs and merges all pairs of that rank at once,
from the left where two overlap; sequences without a pair are counted and
leave. What survives is a token, or as many as it has bytes where it is a
character that the vocabulary lacks.

Merging all pairs of a rank at once gives what merging one by one gives as long
as no merge makes a pair of a lower rank, which holds for trained vocabularies.
Sequences where it doesn't, and long ones where many pieces share a rank (runs
of blanks), are merged one by one instead.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from waybill.llm.shared import ship

#: Tokens beyond which a document is over the limit.
LIMIT = 4096
#: Pre-tokens that a worker remembers; about 150 bytes each.
CACHED_WORDS = 400_000
#: Bytes of text that are cut at a time, and symbols that are merged at a time.
SLICE_BYTES = 4 << 20
SYMBOLS_AT_ONCE = 1 << 20
#: Symbols from which a sequence with a shared rank is merged one pair at a time.
LONG_TIE = 64

#: Fixed value: what the library puts for a blank.
BLANK = "▁"
_NONE = np.iinfo(np.int32).max


class Merges:
    """A vocabulary of pieces with scores, as arrays of pairs and ranks."""

    def __init__(self, pieces: dict[str, float]) -> None:
        letters = {letter for piece in pieces for letter in piece}
        names = [*pieces, *sorted(letters - pieces.keys())]
        number = {name: i for i, name in enumerate(names)}
        self.width = len(names)
        # A letter outside of the vocabulary is minus its bytes in UTF-8.
        self.of_letter = np.full(0x110000, -4, np.int64)
        for below, size in ((0x10000, -3), (0x800, -2), (0x80, -1)):
            self.of_letter[:below] = size
        for letter in letters:
            self.of_letter[ord(letter)] = number[letter]
        if BLANK in number:
            self.of_letter[ord(" ")] = number[BLANK]
        self.cost = np.array([1 if name in pieces else len(name.encode()) for name in names])

        scores, rank = np.unique([-score for score in pieces.values()], return_inverse=True)
        self.tied = np.bincount(rank, minlength=len(scores)) > 1
        pairs, joins = {}, set()
        for piece, place in zip(pieces, rank.tolist()):
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (place, number[piece])
                joins.add(number[piece[cut - 1]] * self.width + number[piece[cut]])
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        found = [pairs[key] for key in sorted(pairs)] or [(_NONE, 0)]
        self.ranks, self.results = (np.array(column) for column in zip(*found))
        self.joins = np.array(sorted(joins) or [-1], np.int64)

        # Texts can be cut before a blank, and before a new line, that never follows in a piece.
        inner = {letter for piece in pieces for letter in piece.lstrip(BLANK)}
        self.cuts = BLANK not in inner
        self.cuts_lines = self.cuts and "\n" not in letters
        ends = r"\n" if self.cuts_lines else ""
        self.words = re.compile(rf"[ {BLANK}]+[^ {BLANK}{ends}]*|\n[^ {BLANK}\n]*")
        self.known: dict[str, int] = {}

    # Ragged merging

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of pairs of symbols; no rank for those that don't merge."""
        key = np.where((left < 0) | (right < 0), -2, left * self.width + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        return np.where(there, self.ranks[at], _NONE), self.results[at]

    def _costs(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < 0, -symbols, self.cost[symbols])

    def _one_by_one(self, symbols: np.ndarray) -> int:
        """Survivors of one sequence, its best pair merged first, the left one of equals."""
        symbols = symbols.tolist()
        before, after = [*range(-1, len(symbols) - 1)], [*range(1, len(symbols) + 1)]
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols) and min(symbols[left], symbols[right]) >= 0:
                key = symbols[left] * self.width + symbols[right]
                at = int(np.searchsorted(self.keys, key))
                if at < len(self.keys) and self.keys[at] == key:
                    rank, result = int(self.ranks[at]), int(self.results[at])
                    heapq.heappush(waiting, (rank, left, symbols[left], symbols[right], result))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        gone = -5
        while waiting:
            _, left, first, second, result = heapq.heappop(waiting)
            right = after[left]
            if symbols[left] != first or right >= len(symbols) or symbols[right] != second:
                continue
            symbols[left], symbols[right] = result, gone
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        left = np.array([symbol for symbol in symbols if symbol != gone], np.int64)
        return int(self._costs(left).sum())

    def _merged(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Survivors of each sequence of a ragged array."""
        counts = np.zeros(len(starts), np.int64)
        lengths = np.diff(starts, append=len(symbols))
        original, bounds, symbols = symbols, np.append(starts, len(symbols)), symbols.copy()
        who = np.arange(len(starts))
        last = np.zeros(len(symbols), bool)
        last[starts + lengths - 1] = True
        early = np.zeros(len(starts), bool)
        following = np.append(symbols[1:], -1)
        rank, result = self._pair(symbols, np.where(last, -1, following))
        while len(who):
            low = np.minimum.reduceat(rank, starts)
            shared = (low < _NONE) & self.tied[np.minimum(low, len(self.tied) - 1)]
            slow = early | (shared & (lengths > LONG_TIE))
            done = (low == _NONE) & ~slow
            if done.any():
                ends = np.add.reduceat(self._costs(symbols), starts)
                counts[who[done]] = ends[done]
            for i in who[slow]:
                counts[i] = self._one_by_one(original[bounds[i] : bounds[i + 1]])
            if (left := ~(done | slow)).sum() < len(who):
                inside = np.repeat(left, lengths)
                symbols, last, rank, result = (x[inside] for x in (symbols, last, rank, result))
                who, lengths, low, shared = who[left], lengths[left], low[left], shared[left]
                starts = np.cumsum(lengths) - lengths
                if not len(who):
                    break
            of = np.repeat(np.arange(len(who)), lengths)
            at = np.flatnonzero(rank == low[of])
            # Of pairs that overlap every other one, from the left; of a shared rank the first.
            new = np.r_[True, np.diff(at) != 1]
            place = np.arange(len(at))
            at = at[(place - place[new][np.cumsum(new) - 1]) % 2 == 0]
            first = np.r_[True, of[at[1:]] != of[at[:-1]]]
            at = at[first | ~shared[of[at]]]
            # A merge may make a better pair with a symbol that the next merge takes.
            early = np.zeros(len(who), bool)
            close = at[:-1][np.diff(at) == 2]
            next_rank, _ = self._pair(result[close], symbols[close + 2])
            early[of[close[(next_rank < low[of[close]]) & ~last[close + 1]]]] = True
            symbols[at] = result[at]
            last[at] = last[at + 1]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, last, rank, result, of = (x[kept] for x in (symbols, last, rank, result, of))
            lengths = np.bincount(of, minlength=len(who))
            starts = np.cumsum(lengths) - lengths
            at = at - np.arange(len(at))
            near = np.unique(np.concatenate([at, np.maximum(at - 1, 0)]))
            following = symbols[np.minimum(near + 1, len(symbols) - 1)]
            rank[near], result[near] = self._pair(
                symbols[near], np.where(last[near], -1, following)
            )
            early[of[near[rank[near] < low[of[near]]]]] = True
        return counts

    def survivors(self, words: list[str]) -> np.ndarray:
        """How many tokens each word ends as; a blank in it is a blank of the text."""
        counts, first = np.zeros(len(words), np.int64), 0
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        while first < len(words):
            room = np.searchsorted(np.cumsum(sizes[first:]), SYMBOLS_AT_ONCE, "right")
            stop = first + max(1, int(room))
            letters = np.frombuffer("".join(words[first:stop]).encode("utf-32-le"), "<u4")
            symbols = self.of_letter[letters]
            word = np.repeat(np.arange(stop - first), sizes[first:stop])
            if len(symbols):
                # Nothing merges across two letters that stand side by side in no piece.
                key = np.where(
                    (symbols[:-1] < 0) | (symbols[1:] < 0),
                    -2,
                    symbols[:-1] * self.width + symbols[1:],
                )
                where = np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)
                joined = (self.joins[where] == key) & (word[1:] == word[:-1])
                starts = np.flatnonzero(np.r_[True, ~joined])
                found = self._merged(symbols, starts)
                of = word[starts]
                counts[first:stop] = np.bincount(of, found, minlength=stop - first).astype(np.int64)
            first = stop
        return counts

    # Whole texts

    def _of_words(self, keys: list[str]) -> np.ndarray:
        """Tokens of distinct pre-tokens, of which each unknown one is merged once.

        A key that does not begin with a blank, or a new line to cut at, has a blank before it.
        """
        known = self.known
        found = [*map(known.get, keys)]
        missing = [i for i, count in enumerate(found) if count is None]
        if missing:
            fresh = [keys[i] for i in missing]
            whole = (" ", "\n") if self.cuts_lines else " "
            spelled = [key if key.startswith(whole) else f" {key}" for key in fresh]
            counts = self.survivors(spelled).tolist()
            if len(known) + len(fresh) <= CACHED_WORDS:
                known.update(zip(fresh, counts))
            for i, count in zip(missing, counts):
                found[i] = count
        return np.array(found, np.int64)

    def _cut_by_arrow(self, texts: pa.Array) -> np.ndarray:
        """Tokens of non-empty texts in which no two blanks meet."""
        if self.cuts_lines:
            texts = pc.replace_substring(texts, "\n", " \n")
        split = pc.split_pattern(texts, " ")
        words = split.values.dictionary_encode()
        each = self._of_words(words.dictionary.to_pylist())[words.indices.to_numpy()]
        before = np.concatenate([[0], np.cumsum(each)])
        at = split.offsets.to_numpy()
        return before[at[1:]] - before[at[:-1]]

    def _cut_by_rule(self, text: str) -> int:
        """Tokens of any non-empty text, in parts of bounded size where blanks allow it."""
        if not self.cuts:
            return int(self.survivors([" " + text])[0])
        total, start = 0, 0
        text = text.replace(BLANK, " ")
        while start <= len(text):
            stop = len(text)
            if stop - start > SLICE_BYTES:
                # A lone blank between two words: the next part has it in front, as every text has.
                cut = _LONE_BLANK.search(text, start + SLICE_BYTES)
                stop = cut.start() if cut else stop
            words = self.words.findall(" " + text[start:stop])
            keys = [w[1:] if w[0] == " " and w[1:2] != " " else w for w in words]
            distinct = {key: i for i, key in enumerate(dict.fromkeys(keys))}
            each = self._of_words([*distinct])
            total += int(each[np.fromiter(map(distinct.get, keys), np.int64, len(keys))].sum())
            start = stop + 1
        return total

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a NULL or empty one has none."""
        texts = texts.cast(pa.string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        hard = (sizes > SLICE_BYTES) | (not self.cuts)
        for found in (
            pc.starts_with(texts, " "),  # the library puts one more blank in front
            pc.match_substring(texts, "  "),
            pc.match_substring(texts, BLANK),
        ):
            hard |= found.to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(hard & (sizes > 0)):
            counts[i] = self._cut_by_rule(texts[int(i)].as_py())
        easy = np.flatnonzero(~hard & (sizes > 0))
        slices = np.cumsum(sizes[easy]) // SLICE_BYTES
        for some in np.split(easy, np.flatnonzero(np.diff(slices)) + 1) if len(easy) else []:
            counts[some] = self._cut_by_arrow(texts.take(pa.array(some)))
        return counts


_LONE_BLANK = re.compile(r"(?<=[^ \n]) (?=[^ \n])")


def _pieces(model: SentencePieceProcessor) -> dict[str, float]:
    """The pieces that text can become, with their scores; bytes stand for all other characters."""
    numbers = range(model.get_piece_size())
    if not any(map(model.is_byte, numbers)) or any(map(model.is_unused, numbers)):
        raise ValueError("the vocabulary needs byte pieces and must use all its pieces")
    odd = (model.is_byte, model.is_control, model.is_unknown)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in numbers
        if not any(is_odd(i) for is_odd in odd)
    }


def _probes(pieces: Iterable[str]) -> list[str]:
    """Short texts that show how a model treats blanks, unknown letters and merges."""
    some = [*pieces][:: max(1, len([*pieces]) // 200)]
    plain = [piece.replace(BLANK, " ") for piece in some]
    return ["  a  b \t\n\n c ", "</s>\0\U0010ffff", "".join(plain), " ".join(plain), *plain]


@functools.cache
def merges(path: str) -> Merges:
    """One table per worker process, with the pre-tokens it has met.

    Raises ValueError for a model that is not BPE with byte pieces, or that
    changes texts beyond blanks.
    """
    model = SentencePieceProcessor(model_file=path)
    pieces = _pieces(model)
    table = Merges(pieces)
    probes = _probes(pieces)
    if table.count(pa.array(probes)).tolist() != [len(model.encode(probe)) for probe in probes]:
        raise ValueError(f"{path} does not merge pairs by score alone")
    return table


def count_tokens(
    docs: DataFrame,
    model: str,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens and over_limit.

    The counts are the library's for ``model``, a sentencepiece BPE model with
    byte pieces, without begin and end tokens. Strings like ``</s>`` in a text
    are text. A NULL or empty text has 0 bytes and 0 tokens; rows may repeat
    and ids may be NULL; other columns are not read; an empty table gives none.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(model)
        for batch in batches:
            counts = table.count(batch.column("text"))
            columns = [batch.column("id"), batch.column("n_bytes"), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_column)
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = texts.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
