"""Byte-level BPE by prefix dynamic programming: encoding, appends, edits and decoding.

For every prefix of a byte string there is exactly one token with which the
merged encoding of that prefix ends: the one token t that ends there whose
predecessor, the last token of the prefix before t, stays apart from t when
both are merged together. So a table of one token per prefix holds the
encodings of all prefixes, filled from left to right; walking it backwards
gives the ids. Appending goes on with the table, and an edit keeps it up to
the place of the edit.

A text is split by the public pattern first, and each match is encoded by
itself: as one id where it is in the vocabulary, else by the table. ``Document``
keeps a text with its matches; after an edit only matches from the one before
the edit up to the first old boundary behind it are split and encoded again.

Characters count as letters, numbers or spaces as in ``tiktoken``: up to
``SAFE`` all libraries agree; beyond it the classes are read off that library.

Defined cases: a null text counts as empty and has no ids; rows alike are
encoded separately; an empty table gives an empty result; of further columns
none is read. Texts of any length are encoded whole: the table of a match
takes one entry a byte, and distinct short matches are encoded once a worker.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import arrow_ready, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
#: Characters on whose classes Unicode versions and libraries agree.
SAFE = regex.compile("[\x00-ʯΑ-ΡΣ-ϿА-я‐-‧ぁ-ゖァ-ヺ一-龥가-힣€]*")
#: Longer matches are not kept for other texts, and so many shorter ones at most at a time.
KEPT_BYTES, KEPT_MATCHES = 64, 400_000


class Vocabulary:
    """Tokens by rank, and the table of last tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = dict(map(reversed, ranks.items()))
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            ends.setdefault(token[-4:], set()).add(len(token))
        #: lengths of tokens of four bytes or more by their last four
        self.ends = {end: sorted(lengths, reverse=True) for end, lengths in ends.items() if len(end) == 4}
        self.apart: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first; only for the few bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b, len(self.ranks) + 1) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best > len(self.ranks):
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stays(self, token: int) -> bool:
        """Whether a token's bytes merge to the token itself."""
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = self.merged(self.tokens[token]) == [token]
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay the two they are."""
        if len(self.apart) > 2_000_000:
            self.apart.clear()
        found = self.apart[left << 32 | right] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return found

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill the table: entry i is the token with which the encoding of the first i + 1 bytes ends."""
        rank, lengths_of, apart = self.ranks.get, self.ends.get, self.apart.get
        for stop in range(len(last) + 1, len(data) + 1):
            for length in (*lengths_of(data[stop - 4 : stop], ()), 3, 2, 1) if stop > 3 else range(stop, 0, -1):
                start = stop - length
                if start < 0 or (token := rank(data[start:stop])) is None:
                    continue
                if start:
                    left = last[start - 1]
                    if (stays := apart(left << 32 | token)) is None:
                        stays = self.stay_apart(left, token)
                else:
                    stays = self.stays(token)
                if stays:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The ids of the whole table."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.tokens[last[at - 1]])
        return ids[::-1]

    def encode(self, match: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        known = self.ranks.get(match)
        return [known] if known is not None else self.walk(self.extend(match, []))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def as_written(pattern: str) -> regex.Pattern:
    """``pattern`` with its letter and number classes spelled out as ``tiktoken`` has them."""
    import tiktoken

    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    for name in (r"\p{L}", r"\p{N}"):
        reader = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        points = np.array([ord(c) for c in bytes(reader.encode_ordinary(every)).decode()])
        gaps = np.flatnonzero(np.diff(points) != 1)
        spans = zip(points[np.append(0, gaps + 1)], points[np.append(gaps, len(points) - 1)])
        pattern = pattern.replace(name, "[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in spans) + "]")
    return regex.compile(pattern, regex.V1)


class Splitter:
    """Matches of the pattern; the spelled-out classes are made only when a text needs them."""

    def __init__(self, pattern: str) -> None:
        self.text, self.plain, self.exact = pattern, regex.compile(pattern), None

    def of(self, text: str) -> regex.Pattern:
        if SAFE.fullmatch(text):
            return self.plain
        if self.exact is None:
            self.exact = as_written(self.text)
        return self.exact


class Document:
    """A text with its matches and their ids, for appends and edits."""

    def __init__(self, text: str, vocabulary: Vocabulary, splitter: Splitter) -> None:
        self.text, self.vocabulary, self.splitter = text, vocabulary, splitter
        self.ends = [m.end() for m in splitter.of(text).finditer(text)]
        self.tables = [self._table(text[a:b]) for a, b in zip([0, *self.ends], self.ends)]

    def _table(self, match: str, before: tuple[bytes, list[int]] = (b"", [])) -> tuple[bytes, list[int]]:
        data, (old, last) = match.encode(), before
        shared = next((i for i, (a, b) in enumerate(zip(data, old)) if a != b), min(len(data), len(old)))
        return data, self.vocabulary.extend(data, last[:shared])

    def ids(self) -> list[int]:
        known = self.vocabulary.ranks
        return [i for data, last in self.tables for i in ([known[data]] if data in known else self.vocabulary.walk(last))]

    def edit(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of ``text[start:end]``; returns how many matches were encoded anew.

        A match depends on its own characters and at most two behind it (a run of spaces leaves its last one to a word),
        so those that end two before ``start`` stay. Behind the edit the first boundary that was one before ends the work.
        """
        text = self.text[:start] + new + self.text[end:]
        first = bisect.bisect_left(self.ends, start - 1)
        at = self.ends[first - 1] if first else 0
        shift, old = len(new) - (end - start), set(self.ends)
        ends, tables = [], []
        rest = len(self.ends)
        for m in self.splitter.of(text).finditer(text, at):
            place = first + len(ends)
            before = self.tables[place] if place < len(self.tables) else (b"", [])
            tables.append(self._table(m.group(), before))
            ends.append(m.end())
            if m.end() - shift >= end and m.end() >= start + len(new) and m.end() - shift in old:
                rest = bisect.bisect_left(self.ends, m.end() - shift) + 1
                break
        self.text = text
        self.ends = self.ends[:first] + ends + [e + shift for e in self.ends[rest:]]
        self.tables = self.tables[:first] + tables + self.tables[rest:]
        return len(ends)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)


class Matches(dict):
    """Ids of matches, as bytes, found when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, match: str) -> bytes:
        data = match.encode()
        found = np.array(self.vocabulary.encode(data), dtype="<u4").tobytes()
        if len(data) <= KEPT_BYTES:
            self[match] = found
        return found


class Codec:
    """Encoding and decoding of whole texts."""

    def __init__(self, path: str | None = None, pattern: str | None = None) -> None:
        import public_tokenizers

        self.vocabulary = Vocabulary.read(path or public_tokenizers.path(RANKS))
        self.splitter = Splitter(pattern or public_tokenizers.PATTERN)
        self.matches = Matches(self.vocabulary)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.matches) > KEPT_MATCHES:
            self.matches.clear()
        return b"".join(map(self.matches.__getitem__, self.splitter.of(text).findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return self.vocabulary.decode(np.frombuffer(ids, dtype="<u4").tolist())


_CODECS: dict[tuple, Codec] = {}


def codec(path: str | None, pattern: str | None) -> Codec:
    """One codec per worker and vocabulary."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encoder(path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            found = [own.encode(t) for t in batch.column("text").to_pylist()]
            counts = pa.array([len(f) // 4 for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(found, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return run


def decoder(path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            found = [own.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "bytes"])

    return run


def digester(path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                found = own.encode(text)
                counts.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(own.decode(found)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    arrow_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text).

    ``path`` names another file of ranks; it has to lie at the same place on all executors.
    """
    return _texts(docs).mapInArrow(encoder(path, pattern), ENCODED)


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and bytes of every row of ``encoded`` (doc_id, ids)."""
    arrow_ready(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(decoder(path, pattern), "doc_id bigint, bytes binary")


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes decoded from them, of every row of ``docs``."""
    return _texts(docs).mapInArrow(digester(path, pattern), DIGESTS)
