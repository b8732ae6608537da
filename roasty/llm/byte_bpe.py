"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The texts are cut into words by the vocabulary's pattern. The distinct words
of a block of texts form one corpus: their bytes lie in one list, and an
inverted index holds, for each token that two neighbours would merge to, the
places of such pairs. The merges are then replayed in rank order over the
whole corpus at once; a merge looks only at the two pairs that it changes.

No word is encoded by itself, so a merge costs its places in the corpus and
nothing per word. Blocks are bounded, texts and words are not: a word of any
length is replayed whole, in time n log n.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import claim

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: The pattern that cuts texts into words; a fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of the texts, and of new words, that are taken at once.
BLOCK_BYTES = 1_000_000
CORPUS_BYTES = 400_000
#: Bytes of encoded words that a task keeps between blocks; beyond that it
#: starts anew, and words in use come over from before.
KEPT_BYTES = 40_000_000


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of ``base64 rank``."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _weight(word: str) -> int:
    """About the bytes that a word and its ids take up in memory."""
    return 200 + 5 * len(word)


class Merges:
    """The ranks of a vocabulary, by pairs of neighbouring tokens. A token's
    id is its rank; every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} of the 256 single bytes have no rank")
        self.ranks = ranks
        self.findall = regex.compile(pattern).findall
        top = max(ranks.values())
        #: Ids of no token: the gap between two words, and what a merge used up.
        self.gap, self.gone, self.base = top + 1, top + 2, top + 3
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left * self.base + right] = rank
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        none = np.iinfo(np.int32).max
        of_pair = np.full((256, 256), none, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                of_pair[token[0], token[1]] = rank
        self.of_pair, self.no_rank = of_pair, none
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    # One corpus of words.

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (not empty), little-endian unsigned 32-bit."""
        if not words:
            return []
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        start = self.of_byte[raw]
        start[ends] = self.gap
        # The index of the first pairs, from the bytes.
        first = self.of_pair[raw[:-1], raw[1:]]
        first[ends[:-1]] = self.no_rank
        first[ends - 1] = self.no_rank
        at = np.flatnonzero(first != self.no_rank)
        rank = first[at]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        bounds = [*np.flatnonzero(np.diff(rank, prepend=-1)).tolist(), len(at)]
        places = {int(rank[a]): at[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)}
        out = np.array(self._merge(start.tolist(), places), np.int64)
        out = out[out != self.gone]
        stops = np.flatnonzero(out == self.gap) * 4
        flat = out.astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip([0, *(stops[:-1] + 4)], stops, strict=True)]

    def _merge(self, tokens: list[int], places: dict[int, list[int]]) -> list[int]:
        """Replays the merges over ``tokens`` (words, a gap after each).
        ``places`` maps a rank to the places whose pair merges to it."""
        pairs, base, gone = self.pairs.get, self.base, self.gone
        after = list(range(1, len(tokens) + 1))
        before = list(range(-1, len(tokens) - 1))
        heap = list(places)
        heapq.heapify(heap)
        push = heapq.heappush
        while heap:
            rank = heapq.heappop(heap)
            here = places.pop(rank)
            here.sort()
            for n, i in enumerate(here):
                j = after[i]
                # An earlier merge may have taken either side of the pair.
                if pairs(tokens[i] * base + tokens[j]) != rank:
                    continue
                k = after[j]
                tokens[i], tokens[j] = rank, gone
                after[i], before[k] = k, i
                sooner = False
                h = before[i]
                if h >= 0:
                    made = pairs(tokens[h] * base + rank)
                    if made is not None:
                        sooner = made <= rank
                        others = places.get(made)
                        if others is None:
                            places[made] = [h]
                            push(heap, made)
                        else:
                            others.append(h)
                made = pairs(rank * base + tokens[k])
                if made is not None:
                    sooner = sooner or made <= rank
                    others = places.get(made)
                    if others is None:
                        places[made] = [i]
                        push(heap, made)
                    else:
                        others.append(i)
                if sooner:
                    # A pair of an earlier rank came up (not in a vocabulary
                    # learnt by merging): it goes before the places left.
                    if rank in places:
                        places[rank].extend(here[n + 1 :])
                    elif n + 1 < len(here):
                        places[rank] = here[n + 1 :]
                        push(heap, rank)
                    break
        return tokens

    # Texts.

    def _learn(self, words: set[str]) -> None:
        """Encodes the words that are not known yet, block by block."""
        known, ranks = self._known, self.ranks
        new: list[str] = []
        raw: list[bytes] = []
        size = 0

        def flush() -> None:
            known.update(zip(new, self.replay(raw), strict=True))
            new.clear()
            raw.clear()

        # Sorted, so that a block is the same in every run.
        for word in sorted(words):
            data = word.encode()
            self._held += _weight(word)
            whole = ranks.get(data)
            if whole is not None:
                known[word] = whole.to_bytes(4, "little")
                continue
            new.append(word)
            raw.append(data)
            size += len(data)
            if size >= CORPUS_BYTES:
                flush()
                size = 0
        flush()

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut = [self.findall(t) for t in texts]
        distinct: set[str] = set()
        for words in cut:
            distinct.update(words)
        if self._held > KEPT_BYTES:
            self._older, self._known, self._held = self._known, {}, 0
        known, older = self._known, self._older
        new = distinct.difference(known)
        for word in new.intersection(older):
            known[word] = older[word]
            self._held += _weight(word)
        self._learn(new.difference(known))
        return [b"".join([known[w] for w in words]) for words in cut]


_LOADED: dict[int, Merges] = {}


def _loaded(ranks, pattern: str) -> Merges:
    """One vocabulary a worker process, whatever tasks it runs."""
    claim("byte_bpe", _LOADED.clear)
    key = hash((ranks.value, pattern))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Merges(read_ranks(ranks.value), pattern)
    return _LOADED[key]


def _blocks(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """A column of texts in runs of BLOCK_BYTES or a little more, each with
    the place where it starts."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        size += n
        if size >= BLOCK_BYTES:
            yield start, column.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(column):
        yield start, column.slice(start)


def _kept(docs: DataFrame, value: str, result: str) -> tuple[DataFrame, list[str], str]:
    """``docs`` as one struct column beside ``value``, so that no name of the
    table can meet one of the operator's."""
    names = [c for c in docs.columns if c != result]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{value}`").alias("_value"))
    return rows, names, rows.schema["_row"].dataType.simpleString()


def encode(docs: DataFrame, ranks_path: str = RANKS_PATH, pattern: str = PATTERN, text_col: str = "text",
           ids_col: str = "ids", packed: bool = False) -> DataFrame:
    """``docs`` with ``ids_col``, the token ids of the whole text: an array of
    int, or with ``packed`` one binary of little-endian unsigned 32-bit
    integers (the form of token files).

    Null and empty texts have no ids. No string of a text is a special token.
    Repeated rows give repeated results, an empty table an empty one; other
    columns are kept as they are, and one named as the result is replaced."""
    with open(ranks_path, "rb") as f:  # the vocabulary: under a MB, read on the driver and sent to each executor
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    rows, names, row_type = _kept(docs, text_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _loaded(ranks, pattern)
        for b in batches:
            for start, part in _blocks(b.column(1)):
                coded = merges.encode_texts([t or "" for t in part.to_pylist()])
                if packed:
                    ids = pa.array(coded, pa.binary())
                else:
                    ends = [0, *accumulate(len(c) // 4 for c in coded)]
                    flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(coded)), ids], ["_row", "ids"])

    out = rows.mapInArrow(run, f"_row {row_type}, ids {'binary' if packed else 'array<int>'}")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], F.col("ids").alias(ids_col))


def decode(docs: DataFrame, ranks_path: str = RANKS_PATH, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with ``bytes_col``, the bytes that the ids of ``ids_col`` (an
    array or packed) stand for. Null ids give null; no ids give no bytes; an
    id that is no token's fails the job. Bytes need not be whole characters
    if the ids are cut from a longer list."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    rows, names, row_type = _kept(docs, ids_col, bytes_col)
    packed = rows.schema["_value"].dataType.typeName() == "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {rank: token for token, rank in read_ranks(ranks.value).items()}
        for b in batches:
            lists = (np.frombuffer(v, "<u4").tolist() if packed and v is not None else v for v in (x.as_py() for x in b.column(1)))
            out = [None if ids is None else b"".join([of[i] for i in ids]) for ids in lists]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["_row", "decoded"])

    out = rows.mapInArrow(run, f"_row {row_type}, decoded binary")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], F.col("decoded").alias(bytes_col))


def digests(docs: DataFrame, ranks_path: str = RANKS_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id_col, n_tokens, ids_sha256, decoded_sha256``: of the packed
    ids, and of the bytes that they decode to."""
    coded = encode(docs.select(id_col, text_col), ranks_path, text_col=text_col, ids_col="_ids", packed=True)
    back = decode(coded.select(id_col, "_ids"), ranks_path, ids_col="_ids", bytes_col="_bytes")
    return back.select(
        id_col, F.expr("octet_length(_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("_ids", 256).alias("ids_sha256"), F.sha2("_bytes", 256).alias("decoded_sha256"),
    )
