"""Language ID by language-bitmask n-gram filters.

Every character n-gram of the learning rows enters one bit-sliced Bloom filter: a table of cells, each a bitmask over
languages; the AND of an n-gram's cells are all languages that (probably) contain it. A text counts, per language, its
n-grams with that bit, corrects the share for the filter's false positives, and takes the largest. The filter has
``CELLS_A_GRAM`` cells for each n-gram of the language that has most, as a power of two between ``CELLS``; beyond its
upper bound nothing is left out, the rate of false positives rises and is corrected. Learning takes up to ``LEARN_ROWS``
rows of a language, by a hash of their texts: the one bound on what is learned from.
"""
from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from .base import bound_batches, c, frugal, written
from .bpe import text_slices
from .words import mix

#: Lengths of the n-grams: inside a word or touching its ends.
SIZES = (3, 4)
#: Rows a language is learned from, about: a bounded sample of its labelled rows; with fewer, all of them.
LEARN_ROWS = 1_000_000
#: Cells of the filter for an n-gram, its least and most cells (powers of two), and cells probed per n-gram; 64 languages
#: take 8 bytes a cell, so the filter has 128 MB for each 64 languages at most.
CELLS_A_GRAM, CELLS, PROBES = 16, (1 << 16, 1 << 24), 3
#: Bytes of text handled at once.
SLICE = 1 << 18
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram hashes of all texts and the text that each belongs to, in order of the texts for each n-gram size.

    Texts are lower-cased; everything but letters is a word end. An n-gram starts or ends at most one step outside of
    a word, so even a word of one letter has one."""
    low = [(t or "").lower() for t in texts]
    joined = " " + " ".join(low) + "  "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low]) if low else np.zeros(0, np.int64)
    letter = _letters()[code]
    code = np.where(letter, code, 32).astype(np.uint64)
    hashes, owners = [], []
    for n in SIZES:
        count = len(low) and len(code) - 2 - (n - 2)  # n-grams whose second character lies in a text or its end
        if count <= 0:
            continue
        inner = letter[1:1 + count].copy()
        for j in range(2, n - 1):
            inner &= letter[j:j + count]
        at = np.flatnonzero(inner)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h + code[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        hashes.append(mix(h))
        owners.append(owner[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` of all texts of ``labelled`` (text, lang): each task sums its own, Spark the tasks'."""
    ship_package(labelled.sparkSession)
    bound_batches(labelled.sparkSession)

    def run(batches):
        sums: dict[str, pd.Series] = {}

        def out():
            for lang, n in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array(n.index.to_numpy().view(np.int64)), pa.array(n.to_numpy(np.int64))],
                    names=["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, texts in text_slices(batch.column(0), SLICE):
                hashes, owner = gram_hashes(texts)
                of = langs[a:b][owner]
                for lang in set(langs[a:b]):
                    new = pd.Series(hashes[of == lang]).value_counts(sort=False)
                    sums[lang] = sums[lang].add(new, fill_value=0) if lang in sums else new
                if sum(map(len, sums.values())) > 500_000:
                    yield from out()
        yield from out()

    return (labelled.select("text", "lang").mapInArrow(frugal(run), "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class LanguageModel:
    """The filter: ``masks`` of shape (planes, cells), the languages in bit order, and each one's false-positive rate."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        fill = [np.count_nonzero(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / masks.shape[1] for i in range(len(languages))]
        self.false_positive = np.array(fill) ** PROBES

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the corrected share of its n-grams that the language's filter holds."""
        n, k = len(texts), len(self.languages)
        hashes, owner = gram_hashes(texts)
        total = np.bincount(owner, minlength=n)
        share = np.zeros((k, n))
        cells = self.masks.shape[1]
        for plane in range(len(self.masks)):
            found = np.full(len(hashes), ~np.uint64(0))
            for probe in _probe_cells(hashes, cells):
                found &= self.masks[plane][probe]
            for i in range(plane * 64, min(k, plane * 64 + 64)):
                held = np.bincount(owner, weights=(found >> np.uint64(i % 64) & np.uint64(1)).astype(np.float64), minlength=n)
                rate = self.false_positive[i]
                share[i] = np.clip((held / np.maximum(total, 1) - rate) / max(1e-9, 1 - rate), 0, 1)
        if not k:
            return [UNDETERMINED] * n, np.zeros(n)
        best = share.argmax(axis=0)
        names = [self.languages[j] if t else UNDETERMINED for j, t in zip(best, total)]
        return names, np.where(total > 0, share[best, np.arange(n)], 0.0)


def _probe_cells(hashes: np.ndarray, cells: int):
    mask = np.uint64(cells - 1)
    for i in range(PROBES):
        yield (hashes >> np.uint64(20 * i)) & mask


def filter_cells(most_grams: int) -> int:
    """Cells of a filter whose largest language has ``most_grams`` n-grams."""
    return min(CELLS[1], max(CELLS[0], 1 << (CELLS_A_GRAM * most_grams - 1).bit_length()))


def learning_rows(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each ``lang`` of ``rows`` (text, lang), chosen by a hash of the text; all, where there are fewer."""
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).collect()  # a row a language
    if not sizes:
        return rows
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    cut = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], most * (1 << 30) // r["n"])])
    return rows.filter(place < F.coalesce(cut[F.col("lang")], F.lit(1 << 30)))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", learn_rows: int = LEARN_ROWS) -> LanguageModel:
    """The model of the rows of ``labelled`` with a language. Languages come in order of their n-grams, most first
    (ties by name), which also decides ties of predictions.

    The driver receives the languages with their totals and the set cells: at most ``CELLS[1]`` per 64 languages."""
    rows = labelled.select(c(text_col).cast("string").alias("text"), c(lang_col).cast("string").alias("lang"))
    counts = written(gram_counts(learning_rows(rows.filter("text IS NOT NULL AND lang IS NOT NULL"), learn_rows)), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("grams"))
    ordered = sorted(totals.collect(), key=lambda r: (-r["total"], r["lang"]))
    languages = [r["lang"] for r in ordered]
    cells = filter_cells(max((r["grams"] for r in ordered), default=0))
    masks = np.zeros(((len(languages) + 63) // 64, cells), np.uint64)
    if languages:
        bits = labelled.sparkSession.createDataFrame([(r["lang"], i) for i, r in enumerate(ordered)], "lang string, bit int")
        probes = F.array(*[F.shiftrightunsigned("gram", 20 * i).bitwiseAND(F.lit(cells - 1)) for i in range(PROBES)])
        found = (counts.join(F.broadcast(bits), "lang")
                 .select((F.col("bit") / 64).cast("int").alias("plane"), (F.col("bit") % 64).alias("bit"), F.explode(probes).alias("cell"))
                 .groupBy("plane", "cell").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")).toArrow())
        masks[found["plane"].to_numpy(), found["cell"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return LanguageModel(languages, masks)


def _shared(df: DataFrame, model: LanguageModel):
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast((model.languages, model.masks))


def predict(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score``. Null, empty and letterless texts, and all texts of a model
    without languages, are ``und`` with score 0; a text with letters always gets a learned language."""
    shared = _shared(df, model)
    rows = df.select(c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))

    def run(batches):
        known = LanguageModel(*shared.value)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                names, scores = known.predict(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(scores)],
                                                 names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(frugal(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 0 modulo 5 (a null id: as empty)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5 == 0


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, with a model learned from the rows not held out."""
    model = train(df.filter(~held_out(c(id_col))), text_col, lang_col)
    return predict(df, model, id_col, text_col).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, min_score: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text has a language with at least ``min_score``, learned from
    the rows with a language. Each row is judged by itself, in the scan: only its text goes to Python, nothing is
    shuffled."""
    shared = _shared(df, train(df, text_col, lang_col))

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def run(parts):
            known = LanguageModel(*shared.value)
            for column in parts:
                kept = [np.zeros(0, bool)]
                for _, _, texts in text_slices(column, SLICE):
                    names, scores = known.predict(texts)
                    kept.append((scores >= min_score) & (np.array(names, object) != UNDETERMINED))
                yield pa.array(np.concatenate(kept))

        yield from frugal(run)(columns)

    return df.filter(F.arrow_udf(judge, "boolean")(c(text_col).cast("string")))
