"""SentencePiece encoding and decoding with a shared-prefix Viterbi pass.

A text is cut into marked words: runs of the space mark with what follows
them. The distinct words of a batch are sorted, which lays them out as a trie
in depth-first order; the forward state of a prefix is computed once and
reused by all words below it.

Two kinds of vocabulary are supported. A unigram one keeps, per prefix, the
best sum of piece scores. A merge (BPE) vocabulary admits one segmentation per
prefix, the one the merges give, and the state is that segmentation's last
piece: a piece may follow another if merging the two pieces' characters gives
back those two pieces, and a chain of such pairs is the segmentation of the
whole. So the pass gives exactly what the merges would, prefix by prefix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import claim

#: The space mark, a fixed value of the format.
MARK = "▁"

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

#: Encoded words a task keeps between batches; it starts anew beyond that.
CACHED_WORDS = 150_000
CACHED_PAIRS = 250_000
#: Characters whose words are sorted together.
BATCH_CHARS = 4_000_000


def _shared(a: str, b: str) -> int:
    """Characters that two words have in common at their beginnings."""
    n = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        n += 1
    return n


class Vocabulary:
    """Pieces with scores; ``kind`` is 'bpe' or 'unigram'. Characters without
    a piece become byte pieces, or the unknown piece if there are none."""

    def __init__(self, pieces: dict[str, tuple[int, float]], kind: str, byte_ids: list[int] | None, unknown: int,
                 dummy_prefix: bool = True):
        self.kind, self.byte_ids, self.unknown, self.dummy_prefix = kind, byte_ids, unknown, dummy_prefix
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self._packed = {p: pack("<i", i) for p, i in self.ids.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.longest = max(map(len, pieces), default=1)
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces that hold a space mark after another character cannot be encoded word by word")
        joined = {c for p in pieces if len(p) > 1 for c in p}
        #: A line end that no longer piece holds is a word of its own.
        self._line_words = "\n" not in joined
        self._pairs = 0
        self._encoded: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        worst = min(self.scores.values(), default=0.0)
        self.unknown_score = worst - 10.0
        if kind == "bpe":
            self._learn_splits()
        top = max([*self.ids.values(), *(byte_ids or []), unknown], default=0)
        self._bytes_of = [b""] * (top + 1)
        for p, i in self.ids.items():
            self._bytes_of[i] = p.encode()
        for b, i in enumerate(byte_ids or []):
            self._bytes_of[i] = bytes([b])

    @classmethod
    def from_model(cls, proto: bytes, kind: str = "bpe") -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=proto)
        pieces, byte_ids = {}, [0] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i)] = (i, sp.get_score(i))
        return cls(pieces, kind, byte_ids if any(byte_ids) else None, sp.unk_id())

    # Merge vocabularies.

    def _learn_splits(self) -> None:
        """The two parts each piece is merged from, earlier merges first; a
        piece that no merge reaches is never used."""
        self.rank: dict[str, int] = {}
        self.split: dict[str, tuple[str, str]] = {}
        order = sorted((p for p in self.scores if len(p) > 1), key=lambda p: (-self.scores[p], self.ids[p]))
        made = {p: r for r, p in enumerate(order)}
        for p in order:
            for i in range(1, len(p)):
                a, b = p[:i], p[i:]
                if (i == 1 or a in self.rank) and (len(b) == 1 or b in self.rank) and self._pair_holds(a, b):
                    self.rank[p], self.split[p] = made[p], (a, b)
                    break
        self._build_automaton()

    def _build_automaton(self) -> None:
        """An automaton over the pieces that merges reach. A node is the
        longest beginning of a piece that ends a prefix: its steps by
        character, the node of the next shorter one, and the pieces that end
        the prefix, long first, each with what it may follow so far known."""
        self._follows: dict[str, dict[str, bool]] = {p: {"": True} for p in self.rank}
        self._root = root = ({}, None, ())
        level, size, pieces = {"": root}, 0, list(self.rank)
        while pieces:
            size += 1
            above, level = level, {}
            for p in pieces:
                head = p[:size]
                if head not in level:
                    parent = above[head[:-1]]
                    lower = self._step(parent[1], head[-1])
                    own = ((size, head, self._follows[head]),) if head in self.rank else ()
                    level[head] = parent[0][head[-1]] = ({}, lower, own + lower[2])
            pieces = [p for p in pieces if len(p) > size]

    def _step(self, node: tuple | None, c: str) -> tuple:
        while node is not None:
            to = node[0].get(c)
            if to is not None:
                return to
            node = node[1]
        return self._root

    def _pair_holds(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` gives ``a, b`` before
        any later merge joins them: undoes the merges of both sides in reverse
        and looks for one across the border that would have come first."""
        rank, split = self.rank, self.split
        limit = len(self.scores) + 1
        while True:
            across = a + b
            r = rank.get(across, limit)
            if r < limit and split[across] == (a, b):
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, split[a][1]
            else:
                limit, b = rb + 1, split[b][0]

    def _may_follow(self, a: str, b: str) -> bool:
        if self._pairs >= CACHED_PAIRS:
            for known in self._follows.values():
                known.clear()
                known[""] = True
            self._pairs = 0
        self._pairs += 1
        got = self._follows[b][a] = self._pair_holds(a, b)
        return got

    # The forward pass.

    def _cut_bpe(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each word and its pieces. The state of a prefix is its last piece:
        the longest that may follow the piece before it."""
        step, may_follow = self._step, self._may_follow
        states, nodes = [""], [self._root]
        before = ""
        for word in sorted(words):
            end = _shared(word, before)
            del states[end + 1 :], nodes[end + 1 :]
            node = nodes[end]
            for c in word[end:]:
                end += 1
                node = node[0].get(c) or step(node[1], c)
                nodes.append(node)
                for size, piece, known in node[2]:
                    last = states[end - size]
                    follows = known.get(last)
                    if follows or follows is None and may_follow(last, piece):
                        states.append(piece)
                        break
                else:
                    states.append(c)
            parts = []
            while end:
                piece = states[end]
                parts.append(piece)
                end -= len(piece)
            parts.reverse()
            yield word, parts
            before = word

    def _extend_unigram(self, word: str, end: int, states: list) -> tuple[float, int]:
        """Best score of the prefix and its last piece's length; of equal
        scores the longer piece."""
        best = None
        for size in range(min(self.longest, end), 0, -1):
            piece = word[end - size : end]
            score = self.scores.get(piece, self.unknown_score if size == 1 else None)
            if score is not None:
                total = states[end - size][0] + score
                if best is None or total > best[0]:
                    best = (total, size)
        return best

    def _cut_unigram(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        states = [(0.0, 0)]
        before = ""
        for word in sorted(words):
            shared = _shared(word, before)
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(self._extend_unigram(word, end, states))
            parts = []
            end = len(word)
            while end:
                parts.append(word[end - states[end][1] : end])
                end -= states[end][1]
            parts.reverse()
            yield word, parts
            before = word

    def _cut(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each word and its pieces. ``words`` are visited in sorted order; the
        states of the prefix shared with the word before are kept."""
        return self._cut_bpe(words) if self.kind == "bpe" else self._cut_unigram(words)

    def _ids_of(self, part: str) -> list[int]:
        known = self.ids.get(part)
        if known is not None:
            return [known]
        if self.byte_ids:
            return [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Piece ids of each word."""
        return {word: [i for p in parts for i in self._ids_of(p)] for word, parts in self._cut(words)}

    # Texts.

    def _marked_words(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """The distinct marked words of ``texts``, which of them the texts
        hold one after the other, and where each text begins in that row."""
        texts = pc.replace_substring(texts.cast(pa.string()).fill_null(""), MARK, " ")
        if self.dummy_prefix:
            texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int32)
        raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
        space, line = raw == ord(" "), raw == ord("\n")
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if self._line_words:
            begins |= line
            begins[1:] |= line[:-1]
        begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        return pc.replace_substring(words.dictionary, " ", MARK), words.indices, np.searchsorted(starts, bounds)

    def _encoded_words(self, words: list[str]) -> list[bytes]:
        """Each word's piece ids as little-endian 32-bit integers."""
        known, packed = self._encoded, self._packed.__getitem__
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHED_WORDS:
            # Words in use come over from the older half, the rest goes.
            self._older, known = known, {}
            self._encoded = known
            new = words
        if self._older:
            older = self._older.get
            known.update((w, code) for w in new if (code := older(w)) is not None)
            new = [w for w in new if w not in known]
        for word, parts in self._cut(new):
            try:
                known[word] = b"".join(map(packed, parts))
            except KeyError:  # characters without a piece
                ids = [i for p in parts for i in self._ids_of(p)]
                known[word] = pack(f"<{len(ids)}i", *ids)
        return [known[w] for w in words]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of all texts in a row, and where each text's begin."""
        words, held, bounds = self._marked_words(texts)
        coded = pa.array(self._encoded_words(words.to_pylist()), pa.large_binary()).take(held)
        if not len(coded):
            return np.zeros(0, np.int32), bounds
        _, ends, data = coded.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(coded) + 1] // 4
        return np.frombuffer(data, "<i4", ends[-1]), ends[bounds]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Each text's piece ids as little-endian 32-bit integers."""
        flat, ends = self.encode_array(pa.array(texts, pa.string()))
        return [flat[a:b].tobytes() for a, b in pairwise(ends)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of piece ids; unknown and control ids have none."""
        of = self._bytes_of
        try:
            raw = b"".join(map(of.__getitem__, ids))
        except IndexError:
            raw = b"".join(of[i] for i in ids if i < len(of))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[int, Vocabulary] = {}


def _loaded(model, kind: str) -> Vocabulary:
    """One vocabulary a worker process, whatever tasks it runs."""
    claim("pieces", _LOADED.clear)
    key = hash((model.value, kind))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary.from_model(model.value, kind)
    return _LOADED[key]


def _portions(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, model_path: str = MODEL_PATH, kind: str = "bpe", text_col: str = "text",
           pieces_col: str = "pieces", check_col: str | None = "round_trip") -> DataFrame:
    """``docs`` with ``pieces_col``, the piece ids of the whole text, and
    ``check_col``: whether decoding them gives the text back.

    Null and empty texts have no pieces and decode to the empty text. A text
    that holds the space mark itself decodes to spaces there. Repeated rows
    give repeated results; other columns are kept as they are, and one named
    as a result is replaced."""
    with open(model_path, "rb") as f:  # the vocabulary: some hundred KB, read on the driver and sent to each executor
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    text_only = docs.withColumn("_row", F.struct(*[F.col(c) for c in docs.columns if c not in (pieces_col, check_col)]))
    names = [c for c in docs.columns if c not in (pieces_col, check_col)]
    row_type = text_only.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _loaded(model, kind)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for part in _portions(texts):
                some = texts[part]
                flat, ends = v.encode_array(b.column(1).slice(part.start, len(some)))
                ids = flat.tolist()
                ok = [v.decode(ids[a:z]) == t for (a, z), t in zip(pairwise(ends.tolist()), some, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(part.start, len(some)), lists, pa.array(ok, pa.bool_())], ["_row", "pieces", "ok"]
                )

    out = text_only.select("_row", F.col(text_col)).mapInArrow(run, f"_row {row_type}, pieces array<int>, ok boolean")
    extra = [F.col("pieces").alias(pieces_col)] + ([F.col("ok").alias(check_col)] if check_col else [])
    return out.select(*[F.col("_row")[c].alias(c) for c in names], *extra)


def decode(docs: DataFrame, model_path: str = MODEL_PATH, pieces_col: str = "pieces", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``, the text of ``pieces_col``; null stays null."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.col(pieces_col).alias("_pieces"))
    row_type = packed.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _loaded(model, "bpe")
        for b in batches:
            texts = [None if p is None else v.decode(i for i in p if i is not None) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["_row", "text"])

    out = packed.mapInArrow(run, f"_row {row_type}, text string")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], F.col("text").alias(text_col))
