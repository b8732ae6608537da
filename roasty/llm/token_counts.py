"""Token counts that follow edits.

A text is cut into segments at places where a pre-token surely ends, so that
the segments' counts add up to the text's. A tree over the segments keeps the
characters and tokens below each node. An edit finds its segments from the
root, takes in neighbours until both ends are sure again, encodes that region
alone and updates the sums on the way up.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary cuts a text into pre-tokens; a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters of a segment, about.
SEGMENT = 400

EDIT = "array<struct<pos:bigint,n_delete:bigint,insert:string>>"
TREE = "array<struct<chars:int,tokens:int>>"


def load(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


#: Places where a pre-token surely ends, whatever is around them. The pattern's
#: tokens are runs of letters, of digits or of other signs, the first space of
#: a run of white space going to the word after it: so a run ends before white
#: space and before a run of another kind. An apostrophe may start a suffix
#: with the letters after it, so nothing is sure there.
SURE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])|(?<=')(?=\p{N})"
)


def sure(before: str, after: str) -> bool:
    """Whether a pre-token surely ends between the two texts, by the last
    character of one and the first of the other."""
    return bool(before and after) and SURE.match(before[-1] + after[0], 1) is not None


def cut(text: str) -> list[str]:
    """The text in segments of SEGMENT characters or somewhat more."""
    out, start = [], 0
    while start < len(text):
        end = SURE.search(text, start + SEGMENT)
        at = end.start() if end else len(text)
        out.append(text[start:at])
        start = at
    return out


class SegmentTree:
    """Sums of characters and tokens over a text's segments. The leaves stay
    where they are: a region's new segments are dealt over its old leaves."""

    def __init__(self, segments: list[str], tokens: list[int], count):
        self.count = count
        self.size = 1
        while self.size < max(1, len(segments)):
            self.size *= 2
        self.leaf: list[str] = segments + [""] * (self.size - len(segments))
        self.chars = [0] * self.size + [len(s) for s in self.leaf]
        self.tokens = [0] * self.size + tokens + [0] * (self.size - len(tokens))
        for i in range(self.size - 1, 0, -1):
            self._sum(i)
        self.encoded_chars = 0

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _find(self, pos: int) -> tuple[int, int]:
        """The leaf that holds character ``pos``, and the place in it."""
        i = 1
        while i < self.size:
            i *= 2
            if pos >= self.chars[i] and self.chars[i + 1]:
                pos -= self.chars[i]
                i += 1
        return i - self.size, pos

    def _next(self, leaf: int, step: int) -> int | None:
        """The nearest leaf in that direction that is not empty."""
        leaf += step
        while 0 <= leaf < self.size:
            if self.leaf[leaf]:
                return leaf
            leaf += step
        return None

    def edit(self, pos: int, n_delete: int, insert: str) -> None:
        """Replaces ``n_delete`` characters from ``pos`` on; both are held to
        the text's bounds."""
        total = self.chars[1]
        pos = min(max(0, pos), total)
        n_delete = min(max(0, n_delete), total - pos)
        low, offset = self._find(pos)
        high = self._find(max(pos, pos + n_delete - 1))[0] if n_delete else low
        high = max(low, high)
        old = "".join(self.leaf[low : high + 1])
        region = old[:offset] + insert + old[offset + n_delete :]
        # Boundary context: both ends of the region must be sure again, also
        # where one of them has become empty.
        while (left := self._next(low, -1)) is not None and not sure(self.leaf[left], region):
            region, low = self.leaf[left] + region, left
        while (right := self._next(high, 1)) is not None and not sure(region, self.leaf[right]):
            region, high = region + self.leaf[right], right
        new, places = cut(region), high - low + 1
        for k in range(places):
            part = new[k * len(new) // places : (k + 1) * len(new) // places]
            self.leaf[low + k] = "".join(part)
            i = self.size + low + k
            self.chars[i], self.tokens[i] = len(self.leaf[low + k]), sum(map(self.count, part))
        self.encoded_chars += len(region)
        low, high = (self.size + low) // 2, (self.size + high) // 2
        while low:
            for i in range(low, high + 1):
                self._sum(i)
            low, high = low // 2, high // 2

    @property
    def text(self) -> str:
        return "".join(self.leaf)

    def rows(self) -> list[dict]:
        """The leaves, as kept between edits."""
        return [{"chars": self.chars[i], "tokens": self.tokens[i]} for i in range(self.size, 2 * self.size) if self.chars[i]]


def from_rows(text: str, rows: list[dict], count) -> SegmentTree:
    segments, at = [], 0
    for r in rows:
        segments.append(text[at : at + r["chars"]])
        at += r["chars"]
    if at != len(text):
        raise ValueError(f"the tree covers {at} characters of a text of {len(text)}")
    return SegmentTree(segments, [r["tokens"] for r in rows], count)


_LOADED: list = []


def _encoding(ranks):
    """One encoder a worker process."""
    if not _LOADED or _LOADED[0] is not ranks.value:
        _LOADED[:] = [ranks.value, load(ranks.value)]
    return _LOADED[1]


def _ranks(docs: DataFrame, path: str):
    with open(path, "rb") as f:  # under 1 MB
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _packed(docs: DataFrame, replaced: tuple[str, ...], used: list[str]):
    names = [c for c in docs.columns if c not in replaced]
    out = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), *[F.col(c).alias(f"_{k}") for k, c in enumerate(used)])
    return names, out, out.schema["_row"].dataType.simpleString()


def build(docs: DataFrame, ranks_path: str = RANKS_PATH, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` of the whole text and ``tree``, its segments'
    characters and tokens. Null and empty texts have no tokens and an empty
    tree; other columns stay, but for those two names."""
    ranks = _ranks(docs, ranks_path)
    names, packed, row_type = _packed(docs, ("n_tokens", "tree"), [text_col])
    tree_type = pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks).encode_ordinary
        for b in batches:
            totals, trees = [], []
            for text in b.column(1).to_pylist():
                parts = cut(text or "")
                counts = [len(encode(p)) for p in parts]
                totals.append(sum(counts))
                trees.append([{"chars": len(p), "tokens": c} for p, c in zip(parts, counts, strict=True)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(totals, pa.int64()), pa.array(trees, tree_type)], ["_row", "n_tokens", "tree"])

    out = packed.mapInArrow(run, f"_row {row_type}, n_tokens long, tree {TREE}")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], "n_tokens", "tree")


def apply_edits(docs: DataFrame, edits_col: str = "edits", ranks_path: str = RANKS_PATH, text_col: str = "text") -> DataFrame:
    """``docs`` (with ``tree``, as built) after their edits: ``text_col``,
    ``n_tokens`` and ``tree`` are those of the edited text, ``encoded_chars``
    says how many characters were encoded for it.

    ``edits_col`` is an array of (pos, n_delete, insert), applied in order,
    positions in characters of the text as it is by then, held to its bounds.
    Null arrays, edits and inserts do nothing; null numbers count as 0."""
    ranks = _ranks(docs, ranks_path)
    names, packed, row_type = _packed(docs, ("n_tokens", "tree", "encoded_chars", text_col, edits_col), [text_col, "tree", edits_col])
    tree_type = pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks).encode_ordinary
        count = lambda s: len(encode(s))
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text, rows, edits in zip(*[b.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                tree = from_rows(text or "", rows or [], count)
                for e in edits or ():
                    if e is not None:
                        tree.edit(e["pos"] or 0, e["n_delete"] or 0, e["insert"] or "")
                for column, value in zip(out, (tree.text, tree.tokens[1], tree.rows(), tree.encoded_chars), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], tree_type), pa.array(out[3], pa.int64())],
                ["_row", "text", "n_tokens", "tree", "encoded_chars"],
            )

    out = packed.mapInArrow(run, f"_row {row_type}, text string, n_tokens long, tree {TREE}, encoded_chars long")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], F.col("text").alias(text_col), "n_tokens", "tree", "encoded_chars")


def derived_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 2000) -> DataFrame:
    """``docs`` with ``edits``: one for each ``every`` characters of a text,
    places and sizes from hashes of the id. An edit takes out up to 30
    characters and puts in a piece of the same text."""
    n = F.char_length(F.coalesce(F.col(text_col), F.lit("")))

    def edit(j):
        h = lambda salt: F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), j, F.lit(salt)), F.lit(1 << 30))
        return F.struct(
            F.when(n > 0, h(1) % F.greatest(n, F.lit(1))).otherwise(0).cast("long").alias("pos"),
            (h(2) % 31).cast("long").alias("n_delete"),
            F.substr(F.coalesce(F.col(text_col), F.lit("")), (h(3) % F.greatest(n, F.lit(1)) + 1).cast("int"), (h(4) % 40).cast("int")).alias("insert"),
        )

    return docs.withColumn("edits", F.transform(F.sequence(F.lit(1), (n / every).cast("int") + 1), edit).cast(EDIT))
