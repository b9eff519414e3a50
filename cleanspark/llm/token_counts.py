"""Token counts by a linear longest-match automaton (LinMaxMatch, Song et al. 2021).

Greedy longest match from the left needs no backtracking when every trie node knows which node matching goes on from
(its failure link) and how many pieces are finished by then (its pop count). Reading a word byte by byte and adding
the pop counts gives the number of pieces in time linear in the word, and no piece is ever built.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from .base import c
from .bpe import parse_ranks, rank_file, text_slices

#: Word counts remembered in each Python worker (a memo: when full it starts again), and the longest word that is.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64
SLICE = 1 << 19


class Automaton:
    """Trie of ``pieces``, failure links and pop counts.

    A word is read after ``prefix``, which marks its start: pieces that begin with it open a word, the others go on.
    """

    def __init__(self, pieces, prefix: bytes = b" "):
        self.child: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                nxt = self.child[node].get(byte)
                if nxt is None:
                    nxt = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    final.append(False)
                node = nxt
            final[node] = bool(piece)
        self.link, self.pops = [-1] * len(self.child), [0] * len(self.child)
        order = [(0, byte, node) for byte, node in self.child[0].items()]
        for parent, byte, node in order:  # breadth first: what a link leads to is finished before
            order.extend((node, b, n) for b, n in self.child[node].items())
            if final[node]:
                self.link[node], self.pops[node] = 0, 1
                continue
            at, count = self.link[parent], self.pops[parent]
            while at >= 0 and byte not in self.child[at]:
                count += self.pops[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.pops[node] = self.child[at][byte], count
        self.prefix = prefix
        self.memo: dict[str, int] = {}

    def count(self, word: str) -> int:
        """The number of pieces of a word; -1 if greedy matching gets stuck (the word is unknown as a whole)."""
        child, link, pops = self.child, self.link, self.pops
        node, n = 0, 0
        for byte in self.prefix + word.encode("utf-8", "surrogatepass"):
            nxt = child[node].get(byte)
            while nxt is None:
                n += pops[node]
                node = link[node]
                if node < 0:
                    return -1
                nxt = child[node].get(byte)
            node = nxt
        while node:
            n += pops[node]
            node = link[node]
            if node < 0:
                return -1
        return n

    def counts(self, words: list[str]) -> list[int]:
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        rare = {}
        for word in set(words).difference(memo):
            (memo if len(word) <= MEMO_CHARS else rare)[word] = self.count(word)
        if not rare:
            return list(map(memo.__getitem__, words))
        return [rare[w] if w in rare else memo[w] for w in words]


_BUILT: dict[tuple[str, bytes], Automaton] = {}


def _automaton(content: bytes, prefix: bytes) -> Automaton:
    key = (hashlib.sha256(content).hexdigest(), prefix)
    if key not in _BUILT:
        _BUILT[key] = Automaton(parse_ranks(content), prefix)
    return _BUILT[key]


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 prefix: bytes = b" ", lengths: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_tokens, n_unknown, longest`` and, with ``lengths``, the piece count
    of every word as ``word_pieces``.

    Words are what ``str.split`` parts (by Unicode white space and U+001C to U+001F); each is cut greedily into the longest pieces of the vocabulary file
    (``path``, base64 pieces with ranks). A word that cannot be cut to its end counts as one token and as unknown (in
    ``word_pieces`` too). ``longest`` is the largest piece count of a word. Null and empty texts have no words and all
    zeros. Repeated rows are each counted; an empty table gives an empty result."""
    ship_package(df.sparkSession)
    with open(path or rank_file(), "rb") as f:  # a file of the driver, of fixed size: its content is broadcast
        vocabulary = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(c(id_col).alias("doc_id"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint, n_unknown bigint, "
              "longest bigint" + (", word_pieces array<int>" if lengths else ""))

    def run(batches):
        automaton = _automaton(vocabulary.value, prefix)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                split = [t.split() for t in texts]
                sizes = np.array([len(w) for w in split], np.int64)
                n = np.array(automaton.counts([w for words in split for w in words]), np.int64)
                ends = np.cumsum(sizes)
                owner = np.repeat(np.arange(b - a), sizes)
                unknown, pieces = n < 0, np.where(n < 0, 1, n)
                longest = np.zeros(b - a, np.int64)
                np.maximum.at(longest, owner, pieces)
                sums = lambda x: pa.array(np.bincount(owner, weights=x, minlength=b - a).astype(np.int64))
                columns = [batch.column(0).slice(a, b - a), pa.array(sizes), sums(pieces), sums(unknown), pa.array(longest)]
                if lengths:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(pieces.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "n_unknown", "longest", "word_pieces"][:len(columns)])

    return rows.mapInArrow(run, schema)
