"""Packing token sequences by minimum bin slack.

Each document becomes token ids and an end id. Whole windows are cut off its
front; what is left, shorter than a window, goes to a pool. A window starts
with the longest remainder in the pool, and a subset-sum over the lengths in
the pool (a bitset per length, so that sums reachable with bounded counts are
one shift and one OR per power of two) finds the multiset that comes closest
to the capacity; backtracking over the kept bitsets gives the counts. Slack
that no multiset fills is filled by cutting one further remainder.

Work is per input partition: pools are bounded, so a task holds at most
``POOL`` remainders of less than a window each, whatever its input. The last
window of a task is split into powers of two, which need no padding.

Defined cases: a null or empty text is its end id alone; rows alike are packed
separately; a null doc_id stays null; an empty table gives no pieces; texts of
any length are cut whole; further columns are not read.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import arrow_ready, text_or_empty

WINDOW, POOL = 1024, 20_000
END_ID = 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class Tokens:
    """Token ids of texts by a public byte-level vocabulary.

    Two public libraries read it: one from its merges, one from its ranks, the
    second about four times as fast. Both split a text by the same expression;
    they can differ only in which rare characters they take for letters,
    numbers or spaces. So texts of ``ALIKE`` characters go to the faster one
    and any other text to the first, whose ids are the ones asked for; so does
    a text that holds an added token of the vocabulary, which is one id.
    """

    #: ASCII, Latin letters and common signs, which have been what they are since the first Unicode versions
    ALIKE = re.compile(r"[\x00-\x1b\x20-\x7f\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-ʯ‐-‧€]*")

    def __init__(self, path: str | None = None, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if path is None or ranks:
            with open(ranks or public_tokenizers.path(RANKS), "rb") as lines:
                by_piece = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_piece, special_tokens={}
            )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if self.fast and self.ALIKE.fullmatch(text) and not any(a in text for a in self.added):
                ids = self.fast.encode_ordinary(text)
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids.append(END_ID)
            out.append(np.frombuffer(array("I", ids), dtype="<u4"))
        return out


def closest(counts: list[int], lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(length, number) of a multiset from the pool whose sum is the largest up to ``capacity``.

    ``lengths`` are those in the pool, longest first. Bit s of ``sums`` tells
    that s is reachable; the search ends as soon as the capacity itself is.
    """
    limit, goal = (1 << (capacity + 1)) - 1, 1 << capacity
    sums, kept = 1, []
    for length in lengths:
        if length > capacity:
            continue
        number, power = min(counts[length], capacity // length), 1
        while number:
            take = min(power, number)
            kept.append((length, take, sums))
            sums |= (sums << (length * take)) & limit
            number -= take
            power *= 2
        if sums & goal:
            break
    left, chosen = sums.bit_length() - 1, []
    for length, take, before in reversed(kept):
        if not before >> left & 1:  # not reachable without this group, so the sum holds it
            chosen.append((length, take))
            left -= length * take
    return chosen


class Packer:
    """Remainders of one task, packed window by window."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window, self.next_sequence = window, first_sequence
        self.counts = [0] * window
        self.waiting: list[list[tuple]] = [[] for _ in range(window)]
        self.size = self.total = 0
        self.rows: list[tuple] = []

    def piece(self, item: tuple, sequence: int, offset: int, of: slice = slice(None)) -> int:
        doc_id, start, ids, total = item
        part = ids[of]
        self.rows.append((doc_id, start + (of.start or 0), len(part), zlib.crc32(part.tobytes()), total, sequence, offset))
        return offset + len(part)

    def sequence(self) -> int:
        self.next_sequence += 1
        return self.next_sequence - 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.piece((doc_id, start, ids[start : start + self.window], total), self.sequence(), 0)
        if whole < total:
            self._wait((doc_id, whole, ids[whole:], total))

    def _wait(self, item: tuple) -> None:
        self.waiting[len(item[2])].append(item)
        self.counts[len(item[2])] += 1
        self.size += 1
        self.total += len(item[2])

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.size -= 1
        self.total -= length
        return self.waiting[length].pop()

    def pack(self, keep: int) -> None:
        """Fill windows until at most ``keep`` remainders wait."""
        lengths = [n for n in range(self.window - 1, 0, -1) if self.counts[n]]
        while self.size > keep:
            while not self.counts[lengths[0]]:
                lengths.pop(0)
            if self.total < self.window:
                self._rest(lengths)
                return
            sequence, at = self.sequence(), 0
            at = self.piece(self._take(lengths[0]), sequence, at)
            for length, number in closest(self.counts, [n for n in lengths if self.counts[n]], self.window - at):
                for _ in range(number):
                    at = self.piece(self._take(length), sequence, at)
            while at < self.window and self.size:
                at = self._cut(sequence, at)
                lengths = [n for n in range(self.window - 1, 0, -1) if self.counts[n]]

    def _cut(self, sequence: int, at: int) -> int:
        """Fill slack from the longest remainder; its other part goes back to the pool."""
        length = next(n for n in range(self.window - 1, 0, -1) if self.counts[n])
        item, room = self._take(length), self.window - at
        if length <= room:
            return self.piece(item, sequence, at)
        self._wait((item[0], item[1] + room, item[2][room:], item[3]))
        return self.piece(item, sequence, at, slice(0, room))

    def _rest(self, lengths: list[int]) -> None:
        """What does not fill a window: sequences of falling powers of two, cut where they end."""
        items = [self._take(n) for n in lengths for _ in range(self.counts[n])]
        left = sum(len(i[2]) for i in items)
        room, sequence, at = 0, 0, 0
        for item in items:
            begin = 0
            while begin < len(item[2]):
                if not room:
                    room, sequence, at = 1 << (left.bit_length() - 1), self.sequence(), 0
                end = min(len(item[2]), begin + room)
                at = self.piece(item, sequence, at, slice(begin, end))
                room, left, begin = room - (end - begin), left - (end - begin), end


_TOKENS: dict[str | None, Tokens] = {}


def packer(window: int, path: str | None):
    """A mapInArrow function from documents to the pieces of packed sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENS:
            _TOKENS[path] = Tokens(path)
        tokens = _TOKENS[path]
        state = Packer(window, TaskContext.get().partitionId() << 40)

        def rows() -> pa.RecordBatch:
            columns = list(zip(*state.rows)) or [()] * 7
            names = [c.split()[0] for c in PIECES.split(", ")]
            state.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1).to_pylist())):
                state.add(doc_id, ids)
            if state.size > POOL:
                state.pack(POOL // 2)
            yield rows()
        state.pack(0)
        yield rows()

    return run


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None) -> DataFrame:
    """A row per piece of every row of ``docs`` (doc_id, text): where it starts, its sequence and its place there.

    ``tokenizer_path`` names another vocabulary; it has to lie at the same path on all executors.
    """
    arrow_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text")).mapInArrow(
        packer(window, tokenizer_path), PIECES
    )
