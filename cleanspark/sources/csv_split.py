"""One large CSV file read by many tasks, line breaks inside fields included.

A split of a file cannot tell by itself whether it begins inside a quoted field. Quotes come in pairs (a quote inside a
field is doubled), so the number of quotes ahead of a line says it: even is outside, odd inside.

1. every split counts its quotes; a running sum over the splits of a file, a row each, gives the parity each begins with;
2. every split joins its lines to records, a record ends with the first line after which the parity is even. What it
   holds of records that begin or end in other splits are fragments, two of a split at most;
3. fragments are joined in the order of the splits; each record is parsed by Spark's CSV parser.

Nothing but parities and fragments leaves its task. A file whose quotes do not pair up is an error; a quote inside an
unquoted field, which the format forbids, can only be told by that or by records with a wrong number of fields.
"""
from __future__ import annotations

import csv
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RECORD, HEAD, TAIL, INNER = 0, 1, 2, 3
_RAW = "file string, start bigint, kind int, text string"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    lines = spark.read.text(list(paths), lineSep="\n")
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.col("_metadata.file_block_length").alias("length"), "value")


def split_parities(lines: DataFrame, quote: str = '"') -> dict[tuple[str, int, int], bool]:
    """``(file, start, length)`` of each split -> whether it begins inside a quoted field; an entry a split, as the scan's own plan
    holds it. A file with an odd number of quotes is an error."""
    counts = lines.groupBy("file", "start", "length").agg(
        F.sum(F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("file").orderBy("start"))
    rows = counts.select("file", "start", "length", (ahead - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("file")).alias("all")).collect()
    odd = sorted({r["file"] for r in rows if r["all"] % 2})
    if odd:
        raise ValueError(f"quotes do not pair up in {odd}")
    return {(r["file"], r["start"], r["length"]): r["before"] % 2 == 1 for r in rows}


def _records(values: pa.Array, inside: bool, quote: str) -> tuple[list[str], list[str], bool]:
    """Of the lines of one split, which begins ``inside`` a field or not: whole groups of lines that end outside of quotes, the
    lines left over, and whether these end inside (they do, where there are any)."""
    odd = np.asarray(pc.fill_null(pc.count_substring(values, quote), 0)) % 2
    after = (np.cumsum(odd) + inside) % 2
    ends = np.flatnonzero(after == 0) + 1
    texts = values.to_pylist()
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    groups = ["\n".join(texts[a:b]) if b - a > 1 else texts[a] for a, b in zip(starts.tolist(), ends.tolist())]
    return groups, texts[ends[-1] if len(ends) else 0:], bool(after[-1]) if len(after) else inside


def records(lines: DataFrame, parities: dict[tuple[str, int, int], bool], names: Sequence[str] | None, sep: str = ",", quote: str = '"') -> DataFrame:
    """``file, start, kind, text`` of ``_lines``: records, and the fragments at the ends of splits. The first record of a file must
    be the header ``names`` (None: there is none)."""
    shared = lines.sparkSession.sparkContext.broadcast(parities)

    def out(file, start, kind, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()),
                                           pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string())], names=["file", "start", "kind", "text"])

    def one_split(key, batches: Iterator[pa.Array]):
        file, start, _ = key
        if key not in shared.value:
            raise ValueError(f"{file} was split otherwise when its quotes were counted; read it again")
        inside = shared.value[key]
        began_inside, first, open_lines = inside, start == 0 and names is not None, []
        for values in batches:
            groups, rest, inside = _records(values, inside, quote)
            if groups:
                groups[0] = "\n".join([*open_lines, groups[0]])
                open_lines = rest
                if began_inside:
                    yield out(file, start, HEAD, groups[:1])
                    groups, began_inside = groups[1:], False
                if first and groups:
                    found = next(csv.reader([groups[0].rstrip("\r").lstrip("﻿")], delimiter=sep, quotechar=quote), [])
                    if list(found) != list(names):
                        raise ValueError(f"the header of {file} is {found}, not {list(names)}")
                    groups, first = groups[1:], False
                yield out(file, start, RECORD, [g.removesuffix("\r") for g in groups if g not in ("", "\r")])
            else:
                open_lines += rest
        if open_lines:
            yield out(file, start, INNER if began_inside else TAIL, ["\n".join(open_lines)])

    def run(batches):
        def parts():
            for batch in batches:
                keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
                a = 0
                for key, same in itertools.groupby(keys):
                    n = sum(1 for _ in same)
                    yield key, batch.column(3).slice(a, n)
                    a += n

        for key, group in itertools.groupby(parts(), key=lambda x: x[0]):
            yield from one_split(key, (values for _, values in group))

    return lines.mapInArrow(run, _RAW)


def stitched(fragments: DataFrame) -> DataFrame:
    """``text`` of the records that span splits: a tail, the splits that lie inside of the record, and the head that ends it."""
    place = F.struct("start", F.when(F.col("kind") == TAIL, 1).otherwise(0).alias("last"))
    order = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == TAIL, 1).otherwise(0))
    numbered = fragments.withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct(place.alias("place"), "text")))
    return numbered.groupBy("file", "record").agg(parts.alias("parts")).select(
        F.regexp_replace(F.array_join(F.col("parts")["text"], "\n"), "\r$", "").alias("text"))


def read_csv_split(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], header: bool = True, malformed: str = "fail",
                   sep: str = ",", quote: str = '"', reject_column: str = "_corrupt_record") -> DataFrame:
    """CSV files with the given columns as a table of strings, each file split over tasks.

    Empty lines are skipped, a missing value is null, a record with a wrong number of fields fails the read or
    (``malformed="keep"``) stays as a row whose text is in ``reject_column``."""
    lines = _lines(spark, paths)
    parities = split_parities(lines, quote)
    found = records(lines, parities, list(columns) if header else None, sep, quote)
    texts = found.where(F.col("kind") == RECORD).select("text")
    if any(parities.values()):
        texts = texts.unionByName(stitched(found.where(F.col("kind") != RECORD)))
    kept = [*columns, reject_column] if malformed == "keep" else list(columns)
    schema = ", ".join("`" + c.replace("`", "``") + "` string" for c in kept)
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true", "mode": "FAILFAST" if malformed == "fail" else "PERMISSIVE",
               "columnNameOfCorruptRecord": reject_column}
    return texts.select(F.from_csv("text", schema, options).alias("x")).select("x.*")
