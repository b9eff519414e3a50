"""Byte-level BPE: the ``tokenizers`` library over Arrow batches, driven by a rank file, and exact decoding.

A text is cut into the matches of a pattern; every match is encoded by itself. The library works on characters that
stand for bytes, so ranks are rewritten through the byte-to-character table and turned into merges. Each distinct
match of a slice of documents is encoded once and remembered as packed ids, and a document is the concatenation of
its matches. Decoding joins the bytes of all tokens before it reads characters, so characters split over tokens,
or over slices of ids, come back whole.
"""
from __future__ import annotations

import base64
import functools
import os
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from .base import bound_batches, c, frugal

#: Matches remembered in each Python worker (a memo: when full it starts again), and the longest that is.
MEMO_ENTRIES, MEMO_CHARS = 150_000, 64
#: Bytes of text, or tokens, handled at once.
SLICE = 1 << 19


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The published byte table: printable Latin-1 bytes stand for themselves, the others, in order, for U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def merge_list(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every split of every token into two tokens, in rank order: any adjacent pair that spells a token may merge.

    The rank algorithm takes the leftmost of equal tokens. Two overlapping pairs of parts X|Y|Z can spell the same
    token only if XY = YZ; then the split after X must come before the split after Y, which this order ensures."""
    merges = []
    for token in sorted(ranks, key=ranks.get):
        n = len(token)
        cuts = [i for i in range(1, n) if token[:i] in ranks and token[i:] in ranks]
        period = {i for i in cuts if token[i:] == token[:n - i]}
        cuts.sort(key=lambda i: (i not in period or n - i in period, i))
        merges += [(token[:i], token[i:]) for i in cuts]
    return merges


def _char_class(*kinds: str) -> str:
    """A character class of all code points of these general categories, as ranges."""
    spans, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] in kinds
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            spans.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(spans)


@functools.lru_cache(maxsize=4)
def splitter(pattern: str):
    """The compiled pattern. ``\\p{L}`` and ``\\p{N}`` become explicit classes, white space Unicode's White_Space, so
    that the standard matcher, the fastest here, can run it."""
    space = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
    classes = {r"\p{L}": _char_class("L"), r"\p{N}": _char_class("N"), r"\s": space}
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\s|\\S|\[|\])", pattern):
        if part in ("[", "]"):
            inside = part == "["
            out.append(part)
        elif part in classes:
            out.append(classes[part] if inside else f"[{classes[part]}]")
        elif part == r"\S":
            out.append(f"[^{space}]")
        else:
            out.append(part)
    return re.compile("".join(out))


class ByteBpe:
    """The encoder of one rank file, with its memo."""

    def __init__(self, content: bytes, pattern: str):
        # one thread a task: those of the library would share the task's core and take memory each
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = parse_ranks(content)
        chars = byte_characters()
        spell = lambda token: "".join(chars[b] for b in token)
        self.tokenizer = Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, ignore_merges=True,
                                              merges=[(spell(a), spell(b)) for a, b in merge_list(ranks)]))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.findall = splitter(pattern).findall
        self.memo: dict[str, bytes] = {}
        self.length = spelling(content).length

    def pieces(self, texts: list[str]) -> list[list[str]]:
        return [self.findall(t) for t in texts]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian int32."""
        split = self.pieces(texts)
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        new = list(set().union(*split).difference(memo))
        found = {p: np.array(e.ids, "<i4").tobytes()
                 for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False))}
        long = {p: found.pop(p) for p in new if len(p) > MEMO_CHARS}
        memo.update(found)
        if not long:
            return [b"".join(map(memo.__getitem__, p)) for p in split]
        return [b"".join([memo[x] if x in memo else long[x] for x in p]) for p in split]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character positions [start, end) of each token: of the characters that its bytes touch, so a character
        split over tokens belongs to each of them."""
        ends = np.cumsum(self.length[ids])
        starts = ends - self.length[ids]
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return (char[starts] if len(ids) else starts).astype(np.int32), (char[ends - 1] + 1 if len(ids) else ends).astype(np.int32)


class Spelling:
    """The decoder of one rank file: all token bytes in one array. Ids that name no token spell U+FFFD."""

    def __init__(self, content: bytes):
        ranks = parse_ranks(content)
        top = max(ranks.values(), default=-1) + 1
        tokens = ["\ufffd".encode()] * (top + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.unknown = top
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, one after the other, and each one's length."""
        ids = np.where((ids >= 0) & (ids < self.unknown), ids, self.unknown)
        length = self.length[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(length) - length), length)
        return self.bytes[shift + np.arange(len(shift))], length


@functools.lru_cache(maxsize=2)
def built(content: bytes, pattern: str) -> ByteBpe:
    """One encoder per Python worker and rank file."""
    return ByteBpe(content, pattern)


@functools.lru_cache(maxsize=2)
def spelling(content: bytes) -> Spelling:
    """One decoder per Python worker and rank file."""
    return Spelling(content)


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """Ranges of rows of a string column that hold about ``most`` bytes, and their texts."""
    for a, b in slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most):
        yield a, b, column.slice(a, b - a).to_pylist()


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about ``most``; one larger row is a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _shipped(df: DataFrame, path: str | None, pattern: str | None):
    import public_tokenizers

    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    with open(path or rank_file(), "rb") as f:  # a file of the driver, of fixed size: its content is broadcast
        return df.sparkSession.sparkContext.broadcast(f.read()), pattern or public_tokenizers.PATTERN


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           pattern: str | None = None, offsets: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, the columns ``keep``, ``ids array<int>`` and, with ``offsets``, ``starts`` and
    ``ends``, the character span of every token. Null and empty texts have no ids. Special tokens are never produced: their spelling is
    ordinary text. Rows may repeat; an empty table gives an empty result."""
    ranks, pattern = _shipped(df, path, pattern)
    rows = df.select(c(id_col).alias("doc_id"), *[c(k) for k in keep], F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", ids array<int>" + (
        ", starts array<int>, ends array<int>" if offsets else "")

    def run(batches):
        bpe = built(ranks.value, pattern)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(batch.num_columns - 1), SLICE):
                packed = bpe.packed(texts)
                columns = [*(x.slice(a, b - a) for x in batch.columns[:-1]), id_lists(packed)]
                if offsets:
                    spans = [bpe.offsets(t, np.frombuffer(p, "<i4")) for t, p in zip(texts, packed)]
                    columns += [pa.ListArray.from_arrays(columns[-1].offsets, pa.array(np.concatenate([s[k] for s in spans]), pa.int32()))
                                for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "ids", "starts", "ends"][:len(columns)])

    return rows.mapInArrow(frugal(run), schema)


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """An Arrow list of ids for each text of ``ByteBpe.packed``."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p) // 4 for p in packed)]), pa.int32()),
                                    pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))


def spelled(ids: pa.ListArray, spell: Spelling) -> pa.Array:
    """The bytes that each list of ids spells; null lists give null, null ids U+FFFD."""
    null = ~ids.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(null, 0, np.diff(ids.offsets.to_numpy()).astype(np.int64))
    raw, length = spell.decode(ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ids), [pa.py_buffer(np.packbits(~null, bitorder="little").tobytes()),
                                      pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
               pattern: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``ids`` as of ``encode`` and ``bytes`` as of ``decode``, for every input row, in one
    pass: the worker that made the ids decodes them, so texts and ids cross to Python once and each task needs one
    worker instead of two."""
    ranks, pattern = _shipped(df, path, pattern)
    rows = df.select(c(id_col).alias("doc_id"), *[c(k) for k in keep], F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", ids array<int>, bytes binary"

    def run(batches):
        bpe, spell = built(ranks.value, pattern), spelling(ranks.value)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(batch.num_columns - 1), SLICE):
                ids = id_lists(bpe.packed(texts))
                yield pa.RecordBatch.from_arrays([*(x.slice(a, b - a) for x in batch.columns[:-1]), ids, spelled(ids, spell)],
                                                 names=[*batch.schema.names[:-1], "ids", "bytes"])

    return rows.mapInArrow(frugal(run), schema)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None,
           pattern: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, the columns ``keep`` and ``bytes``, what the ids spell; null ids give null.

    Casting ``bytes`` to string reads characters after all tokens are joined. An id that names no token, and a null
    among the ids, spell U+FFFD."""
    ranks, pattern = _shipped(df, path, pattern)
    rows = df.select(c(id_col).alias("doc_id"), *[c(k) for k in keep], c(ids_col).cast("array<int>").alias("ids"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"doc_id {kinds['doc_id']}", *(f"`{k}` {kinds[k]}" for k in keep), "bytes binary"])

    def run(batches):
        spell = spelling(ranks.value)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64) * lists.is_valid().to_numpy(zero_copy_only=False)
            for a, b in slices(sizes.tolist(), SLICE):
                yield pa.RecordBatch.from_arrays([*(x.slice(a, b - a) for x in batch.columns[:-1]), spelled(lists.slice(a, b - a), spell)],
                                                 names=[*batch.schema.names[:-1], "bytes"])

    return rows.mapInArrow(frugal(run), schema)
