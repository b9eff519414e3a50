"""URL filter: rules first, then the ratio of two character language models.

A smoothed variable-order Markov model is learned for the URLs that the rules accept and one for those they reject.
A character is predicted from the longest context that was seen; shorter contexts are mixed in by their counts. All
counts are kept, as a table in the shared folder that grows with the input. URLs are scored in chunks: a chunk's
distinct n-grams and contexts are joined with the counts, and one task scores the chunk from what comes back, so no
task holds the model and a common n-gram is one row a chunk. The score of a URL is the log-likelihood difference per
character; the threshold is calibrated on ruled URLs that the models have not seen.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from .base import LOWER, UPPER, c, written
from .words import mix

#: The rules of the contract as (host, path, verdict); a rule reads host + path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Longest context in characters.
ORDER = 5
#: Bytes of URLs that are scored together; a longer URL is a chunk of its own.
CHUNK_BYTES = 1 << 17
#: Weight of the shorter context, in observations.
SMOOTHING = 2.0
#: Width of the score bins that the threshold is calibrated on, and their range.
BIN, RANGE = 0.01, 10.0
ACCEPT, REJECT = 0, 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty when the url is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null. Of rules of one length the first listed wins."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1]))[::-1]:
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _codes(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of what follows ``://`` (the whole string without it), A-Z lower-cased and each digit as 0, every
    URL after ORDER start marks and before an end mark; and each URL's length with its end mark."""
    table = np.arange(256, dtype=np.uint64)
    table[ord("A"):ord("Z") + 1] += 32
    table[ord("0"):ord("9") + 1] = ord("0")
    raw = [b"\x01" * ORDER + (u.split("://", 1)[-1]).encode("utf-8", "surrogatepass") + b"\x02" for u in urls]
    return table[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(r) - ORDER for r in raw], np.int64)


def _gram_hashes(codes: np.ndarray, lengths: np.ndarray):
    """The positions that are predicted, and for each n the hashes of the n characters that end there."""
    padded = lengths + ORDER
    start = np.cumsum(padded) - padded
    predicted = np.ones(len(codes), bool)
    for j in range(ORDER):
        predicted[start + j] = False
    at = np.flatnonzero(predicted)
    h = np.zeros(len(at), np.uint64)
    grams = []
    for n in range(1, ORDER + 2):
        h = (h + codes[at - n + 1] + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
        grams.append(mix(h + np.uint64(n)))
    return at, grams


def _context_hashes(codes: np.ndarray, at: np.ndarray):
    """For each length 1 .. ORDER the hash of the characters ahead of each position, as ``_gram_hashes`` makes them."""
    h = np.zeros(len(at), np.uint64)
    out = []
    for n in range(1, ORDER + 1):
        h = (h + codes[at - n] + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
        out.append(mix(h + np.uint64(n)))
    return out


def _slices(urls: list[str], most: int = 1 << 18):
    start, total = 0, 0
    for i, u in enumerate(urls):
        if i > start and total + len(u) > most:
            yield start, i
            start, total = i, 0
        total += len(u)
    if start < len(urls):
        yield start, len(urls)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``label, kind, gram, n`` over all rows of ``labelled`` (url, label). Kind 0 counts predicted n-grams, kind 1
    the contexts they were predicted from; gram 0 of kind 1 is the empty context, the number of characters."""
    ship_package(labelled.sparkSession)

    def run(batches):
        sums: dict[tuple[int, int], pd.Series] = {}

        def out():
            for (label, kind), n in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), label, np.int32)), pa.array(np.full(len(n), kind, np.int32)),
                     pa.array(n.index.to_numpy().view(np.int64)), pa.array(n.to_numpy(np.int64))], names=["label", "kind", "gram", "n"])
            sums.clear()

        for batch in batches:
            urls, labels = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for label in (ACCEPT, REJECT):
                own = [u for u, x in zip(urls, labels) if x == label]
                for a, b in _slices(own):
                    codes, lengths = _codes(own[a:b])
                    at, grams = _gram_hashes(codes, lengths)
                    contexts = [np.zeros(len(at), np.uint64), *_context_hashes(codes, at)]
                    for kind, values in ((0, grams), (1, contexts)):
                        new = pd.Series(np.concatenate(values)).value_counts(sort=False)
                        key = (label, kind)
                        sums[key] = sums[key].add(new, fill_value=0) if key in sums else new
                if sum(map(len, sums.values())) > 2_000_000:
                    yield from out()
        yield from out()

    return (labelled.select("url", "label").mapInArrow(run, "label int, kind int, gram bigint, n bigint")
            .groupBy("label", "kind", "gram").agg(F.sum("n").alias("n")))


class _Counts:
    """Counts by hash: sorted keys and a binary search for many at once."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.n = grams[order], n[order].astype(np.float64)

    def of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(grams))
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.n[at], 0.0)


class UrlModel:
    """Both classes' counts: ``parts`` maps (label, kind) to (grams, n)."""

    def __init__(self, parts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], threshold: float = 0.0):
        self.parts, self.threshold = parts, threshold
        self.counts = {key: _Counts(*part) for key, part in parts.items()}

    def scores(self, urls: list[str]) -> np.ndarray:
        """Log-likelihood of the accepted class minus the rejected one's, per character."""
        difference, lengths = self.differences(urls)
        owner = np.repeat(np.arange(len(urls)), lengths)
        return np.bincount(owner, weights=difference, minlength=len(urls)) / lengths

    def differences(self, urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The difference of the classes' log-probabilities for each character of each URL, and the URLs' lengths."""
        codes, lengths = _codes(urls)
        at, grams = _gram_hashes(codes, lengths)
        contexts = _context_hashes(codes, at)
        difference = np.zeros(len(at))
        for label, sign in ((ACCEPT, 1.0), (REJECT, -1.0)):
            seen, ahead = self.counts[label, 0], self.counts[label, 1]
            p = np.full(len(at), 1 / 256)
            held = np.ones(len(at), bool)
            for n in range(ORDER + 1):
                of_context = ahead.of(np.zeros(1, np.uint64))[0] if n == 0 else ahead.of(contexts[n - 1])
                held = held & (of_context > 0)  # a context is used only if all shorter ones are held
                mixed = (seen.of(grams[n]) + SMOOTHING * p) / (of_context + SMOOTHING)
                p = np.where(held, mixed, p)
            difference += sign * np.log(p)
        return difference, lengths


def train(labelled: DataFrame, min_share: float = 0.0) -> UrlModel:
    """The model of all rows of ``labelled`` (url, label) on the driver, for small inputs; ``filter_urls`` does not
    collect its counts. With ``min_share`` what has less than this share of its class's characters is left out."""
    counts = gram_counts(labelled).persist()
    totals = {r["label"]: r["n"] for r in counts.filter("kind = 1 AND gram = 0").select("label", "n").collect()}
    least = F.create_map(*[F.lit(x) for label in (ACCEPT, REJECT) for x in (label, float(totals.get(label, 0) * min_share))])
    held = counts.filter(F.col("n") >= least[F.col("label")]).toArrow()
    counts.unpersist()
    label, kind = held["label"].to_numpy(), held["kind"].to_numpy()
    gram, n = held["gram"].to_numpy().view(np.uint64), held["n"].to_numpy()
    parts = {(x, k): (gram[(label == x) & (kind == k)], n[(label == x) & (kind == k)]) for x in (ACCEPT, REJECT) for k in (0, 1)}
    return UrlModel(parts)


def class_counts(labelled: DataFrame) -> DataFrame:
    """``kind, gram, accept, reject``: how often both classes of ``labelled`` (url, label) hold each n-gram and context."""
    def of(label: int) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(F.lit(0)))

    return gram_counts(labelled).groupBy("kind", "gram").agg(of(ACCEPT).alias("accept"), of(REJECT).alias("reject"))


def _chunked(df: DataFrame) -> DataFrame:
    """``df``, which has a column ``url``, with ``chunk``: rows of a task that follow each other, CHUNK_BYTES at most."""
    position = df.columns.index("url")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", chunk bigint"

    def run(batches):
        chunk, size = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            lengths = [len((u or "").encode("utf-8", "surrogatepass")) + ORDER + 1 for u in batch.column(position).to_pylist()]
            chunks = np.empty(len(lengths), np.int64)
            for i, length in enumerate(lengths):
                if size and size + length > CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
                size += length
                chunks[i] = chunk
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks)], names=[*batch.schema.names, "chunk"])

    return df.mapInArrow(run, schema)


def _wanted(chunked: DataFrame) -> DataFrame:
    """``chunk, kind, gram``: the n-grams and contexts of each chunk's URLs, each once a chunk and batch."""

    def run(batches):
        for batch in batches:
            urls, chunks = [u or "" for u in batch.column(0).to_pylist()], batch.column(1).to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(urls)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                codes, lengths = _codes(list(dict.fromkeys(urls[a:b])))
                at, grams = _gram_hashes(codes, lengths)
                contexts = [np.zeros(1, np.uint64), *_context_hashes(codes, at)]
                found = [np.unique(np.concatenate(x)) for x in (grams, contexts)]
                n = sum(map(len, found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, chunks[a])), pa.array(np.repeat(np.arange(2, dtype=np.int32), [len(x) for x in found])),
                     pa.array(np.concatenate(found).view(np.int64))], names=["chunk", "kind", "gram"])

    return chunked.select("url", "chunk").mapInArrow(run, "chunk bigint, kind int, gram bigint")


def score(df: DataFrame, counts: DataFrame) -> DataFrame:
    """``df``, which has a column ``url``, with ``score`` by the ``class_counts``; a null url is scored as an empty one."""
    position = df.columns.index("url")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", score double"
    chunked = written(_chunked(df), "url-chunks")
    known = _wanted(chunked).join(counts, ["kind", "gram"]).select("chunk", "kind", "gram", "accept", "reject")

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        kind, gram = found["kind"].to_numpy(), found["gram"].to_numpy().view(np.uint64)
        parts = {}
        for label, name in ((ACCEPT, "accept"), (REJECT, "reject")):
            n = found[name].to_numpy()
            for k in (0, 1):
                own = (kind == k) & (n > 0)
                parts[label, k] = gram[own], n[own]
        rows = rows.drop_columns(["chunk"])
        urls = [u or "" for u in rows.column(position).to_pylist()]
        distinct = {u: i for i, u in enumerate(dict.fromkeys(urls))}
        scores = UrlModel(parts).scores(list(distinct))
        return rows.append_column("score", pa.array(scores[[distinct[u] for u in urls]]))

    return chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


def calibrate(scored: DataFrame) -> float:
    """The threshold with the best balanced accuracy on ruled rows (label, score), from counts per bin; of equal
    ones the middle. 0 where a class is missing."""
    top = int(RANGE / BIN)
    bins = scored.groupBy("label", F.greatest(F.lit(-top), F.least(F.lit(top), F.floor(F.col("score") / BIN))).cast("int").alias("bin")).count().collect()
    counts = np.zeros((2, 2 * top + 2))
    for r in bins:
        counts[r["label"], r["bin"] + top] += r["count"]
    if not counts.sum(axis=1).all():
        return 0.0
    share = counts / counts.sum(axis=1, keepdims=True)
    below = np.cumsum(share, axis=1) - share  # of each class, under the bin's lower edge
    accuracy = (1 - below[ACCEPT]) + below[REJECT]
    best = np.flatnonzero(accuracy >= accuracy.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 - top) * BIN


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    A rule decides where one fits, else the model: allow from the threshold on. The models learn from all ruled URLs
    but a fifth (by crc32 of the url), which calibrates the threshold. Null urls and urls without ``://`` have empty
    host and path, fit no rule and are scored as they read (null: as empty). With no ruled URLs of one class the
    score is that of an unseen class against the other and the threshold 0. Repeated rows each get their verdict."""
    ship_package(df.sparkSession)
    rows = df.select(c(id_col).alias("page_id"), c(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    ruled = rows.withColumn("host", host).withColumn("path", path)
    ruled = ruled.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("ruled.verdict") == "allow", ACCEPT).otherwise(REJECT)
    known = ruled.filter("ruled IS NOT NULL").select("url", label.alias("label"))
    unseen = F.crc32("url") % 5 == 0
    counts = written(class_counts(known.filter(~unseen)), "url-counts")
    scored = written(score(ruled, counts), "url-scores")
    threshold = calibrate(scored.filter("ruled IS NOT NULL").filter(unseen).select(label.alias("label"), "score"))
    return scored.select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score")
