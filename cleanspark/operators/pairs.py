"""Candidate pairs and pair features.

Rows are compared on ``(name, email, phone)``. The shape keeps this linear in the input except for the candidate
pairs themselves:

* **A row has an identity of its own.** ``with_row_id`` numbers rows in the order of a business key and all other
  columns; text, missing or repeated keys make no difference. A caller's own key must be unique (``require_unique``).
* **Copies collapse first.** Rows are grouped by the compared triple; a triple's id is the smallest row key in
  it (``tid``). All rows of one triple are copies (similarity 1.0 on every field); they are linked to the triple's
  first row (a star), and counted as ``copies``, so a group of copies holding a third of all rows costs one row per copy.
* **Lossless pruning.** A missing field scores 0, which caps the mean at 2/3 < 0.7: rows with a null in any
  compared field cannot pass the rule and are not paired (``eligible``).
* **Blocking on equi-keys, split on both sides.** Distinct triples are self-joined on each block key (``email``, last 8
  phone digits, sorted name tokens; single name tokens and MinHash bands opt-in). A block larger than the split size is
  cut into ``g`` parts on either side and joined part by part, a grid of ``g x g`` joins, so no task sees a whole hot
  block; every pair is produced once. The table of large blocks is bounded by construction, hence its broadcast.

The exhaustive all-pairs comparison (J1) is kept only as a brute-force reference in the tests: it is a cross join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import indel_ratio, token_set_ratio, tokens
from ..session import cut_lineage

COMPARED = ("name", "email", "phone")
DEFAULT_KEYS = ("email", "phone8", "name_sorted")
ROW_ID = "_row_id"
# A block is split from this many triples on, or from a HOT_BLOCKS-th of all key rows, whichever is more; so at most
# HOT_BLOCKS blocks are large.
SPLIT_ROWS = 2_000
HOT_BLOCKS = 100_000
# Rows of one triple are spread over this many join partitions when they look up their triple.
SPREAD = 16
# MinHash LSH keys (opt-in): character 3-grams, LSH_BANDS bands of LSH_ROWS hashes each.
LSH_BANDS = 6
LSH_ROWS = 2


def with_row_id(df: DataFrame, order: Sequence[str] = ("customer_id",), row_id: str = ROW_ID, written: bool = False) -> DataFrame:
    """``df`` with a unique number that rises with ``order`` (nulls first), then with all other columns, fixed from then on.

    Where the first column of ``order`` is a whole number, never missing and never repeated, it is that number: finding this
    out shuffles nothing but that column. Else the rows are sorted into ranges once and written. ``written`` says that
    ``df`` is a written table already."""
    by = [c for c in order if c in df.columns] + [c for c in df.columns if c not in order]
    first = next((f for f in df.schema.fields if by and f.name == by[0] and f.name in order), None)
    if first is not None and isinstance(first.dataType, (T.LongType, T.IntegerType, T.ShortType)):
        df = df if written else cut_lineage(df)
        if is_unique(df, first.name):
            return df.withColumn(row_id, F.col(f"`{first.name}`").cast("long"))
    ranked = df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in by])
    return cut_lineage(ranked.withColumn(row_id, F.monotonically_increasing_id()))


def is_unique(df: DataFrame, key: str) -> bool:
    """Whether ``key`` is held by every row and names one each."""
    return df.groupBy(F.col(f"`{key}`").alias("k")).agg(F.count(F.lit(1)).alias("n")).where(F.col("k").isNull() | (F.col("n") > 1)).isEmpty()


def require_unique(df: DataFrame, key: str) -> None:
    """Fail when ``key`` is missing in a row or names more than one."""
    repeated = df.groupBy(F.col(f"`{key}`").alias("k")).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("k").isNull() | (F.col("n") > 1)).limit(1).collect()
    if repeated:
        raise ValueError(f"{key} is not a unique key: {repeated[0]['k']!r} names {repeated[0]['n']} rows; use with_row_id")


def eligible(df: DataFrame, fields: Sequence[str] = COMPARED) -> DataFrame:
    cond = F.lit(True)
    for f in fields:
        cond = cond & F.col(f).isNotNull()
    return df.where(cond)


def triples(df: DataFrame, key: str = ROW_ID, materialize: bool = True) -> DataFrame:
    """Distinct compared triples: ``(tid, name, email, phone, copies)``; ``tid`` = smallest row key.

    Materialised by default (``cut_lineage``): block keys, both sides of the block join and the value joins of the
    pair features all read it."""
    t = eligible(df).groupBy(*COMPARED).agg(F.min(key).alias("tid"), F.count(F.lit(1)).alias("copies"))
    return cut_lineage(t) if materialize else t


def look_up(df: DataFrame, t: DataFrame, columns: Sequence[str], key: str = ROW_ID) -> DataFrame:
    """``(key, *columns)`` of the rows whose triple is in ``t``. A triple is repeated ``SPREAD`` times and its rows are
    dealt over the repeats, so a triple held by a third of all rows is not one task; callers pass only the triples that
    matter."""
    rows = eligible(df).select(key, *COMPARED, F.pmod(F.xxhash64(key), F.lit(SPREAD)).cast("int").alias("_spread"))
    build = t.select(*COMPARED, *columns, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_spread"))
    return rows.join(build, [*COMPARED, "_spread"]).select(key, *columns)


def _key_structs(keys: Sequence[str]):
    out = []
    for k in keys:
        if k == "email":
            out.append(F.array(F.struct(F.lit("email").alias("kind"), F.col("email").alias("key"))))
        elif k == "phone8":
            out.append(F.array(F.struct(F.lit("phone8").alias("kind"),
                                        F.substring(F.col("phone"), -8, 8).alias("key"))))
        elif k == "name_sorted":
            out.append(F.array(F.struct(F.lit("name_sorted").alias("kind"),
                                        F.array_join(F.array_sort(tokens("name")), " ").alias("key"))))
        elif k in ("email_lsh", "name_lsh"):
            text = F.substring_index(F.col("email"), "@", 1) if k == "email_lsh" else F.col("name")
            out.append(_lsh_keys(text, k))
        elif k == "name_token":
            out.append(F.transform(tokens("name"),
                                   lambda t: F.struct(F.lit("name_token").alias("kind"), t.alias("key"))))
        else:
            raise ValueError(f"unknown block key {k!r}")
    return out


def _lsh_keys(text, kind: str):
    """MinHash bands over the character 3-grams of ``text``: similar strings share a band with high probability
    (``1 - (1 - J^r)^b`` for 3-gram Jaccard ``J``)."""
    n = F.greatest(F.length(text) - 2, F.lit(1))
    grams = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(text, i, F.lit(3)))
    mins = [F.array_min(F.transform(grams, lambda g, s=s: F.xxhash64(g, F.lit(s))))
            for s in range(LSH_BANDS * LSH_ROWS)]
    bands = [F.struct(F.lit(kind).alias("kind"),
                      F.concat_ws(":", F.lit(b), *[mins[b * LSH_ROWS + r].cast("string") for r in range(LSH_ROWS)])
                      .alias("key")) for b in range(LSH_BANDS)]
    return F.array(*bands)


def block_keys(t: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """``(tid, kind, key)``: one row per block key of each distinct triple."""
    ks = _key_structs(keys)
    return t.select("tid", F.explode(F.flatten(F.array(*ks))).alias("k")).select("tid", "k.kind", "k.key") \
            .where(F.col("key").isNotNull() & (F.col("key") != ""))


def block_report(t: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, min_size: int = 2) -> DataFrame:
    """Block sizes and the pairs each block generates (for choosing keys and spotting hot keys)."""
    return block_keys(t, keys).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("size")) \
        .where(F.col("size") >= min_size).withColumn("pairs", F.col("size") * (F.col("size") - 1) / 2)


def candidate_pairs(t: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Distinct ``(tid_i, tid_j)``, ``tid_i < tid_j``, sharing at least one block key; large blocks are joined as a grid of
    parts (``grid_join``). ``lossless.py`` finds pairs without keys."""
    return grid_join(cut_lineage(block_keys(t, keys)), ["kind", "key"], split_rows).select("tid_i", "tid_j").distinct()


def grid_join(k: DataFrame, on: Sequence[str], split_rows: int = SPLIT_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """``tid_i < tid_j`` of the rows of ``k`` (``tid``, ``on``, ``carry``: a written table) that agree in ``on``, with both sides' ``carry``.

    The first side of a large block is repeated along the rows of its grid and the second along the columns; all other
    blocks are one cell."""
    on = list(on)
    limit = max(split_rows, k.count() // HOT_BLOCKS)
    hot = k.groupBy(*on).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).select(
        *on, F.ceil(F.col("size") / F.lit(limit)).cast("int").alias("parts"))  # at most HOT_BLOCKS rows
    k = k.join(F.broadcast(hot), on, "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
         .withColumn("part", F.pmod(F.xxhash64("tid"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("tid", *carry)]
    left = k.select(*side("i"), *on, F.col("part").alias("row"), other.alias("col"))
    right = k.select(*side("j"), *on, F.col("part").alias("col"), other.alias("row"))
    return left.join(right, [*on, "row", "col"]).where(F.col("tid_i") < F.col("tid_j"))


def with_values(t: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of triples with both sides' compared values and copies (``name_i`` ... ``copies_j``)."""
    def side(x: str) -> DataFrame:
        return t.select(F.col("tid").alias(f"tid_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in (*COMPARED, "copies")])

    return pairs.join(side("i"), "tid_i").join(side("j"), "tid_j")


def similarities(valued: DataFrame) -> DataFrame:
    """D1-D3 on ``with_values`` rows: ``(tid_i, tid_j, copies_i, copies_j, name_sim, email_sim, phone_sim, avg_sim)``."""
    feats = valued.select(
        "tid_i", "tid_j", "copies_i", "copies_j",
        token_set_ratio("name_i", "name_j").alias("name_sim"),
        indel_ratio("email_i", "email_j").alias("email_sim"),
        indel_ratio("phone_i", "phone_j").alias("phone_sim"))
    return with_mean(feats)


def with_mean(feats: DataFrame) -> DataFrame:
    """``feats`` with the mean of the three similarities, ``avg_sim``."""
    return feats.withColumn("avg_sim", (F.col("name_sim") + F.col("email_sim") + F.col("phone_sim")) / 3.0)


def triple_pair_features(t: DataFrame, pairs: DataFrame) -> DataFrame:
    """D1-D3 on candidate triple pairs: ``(tid_i, tid_j, name_sim, email_sim, phone_sim, avg_sim)``."""
    return similarities(with_values(t, pairs)).drop("copies_i", "copies_j")


def copy_edges(df: DataFrame, t: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Star edges ``(tid, row)`` from each triple's first row to its other copies, all similarities 1.0."""
    m = look_up(df, t.where("copies > 1"), ["tid"], key)
    return m.where(F.col(key) != F.col("tid")).select(
        F.col("tid").alias("row_i"), F.col(key).alias("row_j"),
        *[F.lit(1.0).alias(c) for c in ("name_sim", "email_sim", "phone_sim", "avg_sim")])


def pair_features(df: DataFrame, key: str = ROW_ID, keys: Sequence[str] = DEFAULT_KEYS,
                  **kw) -> DataFrame:
    """The pair table ``(row_i, row_j, name_sim, email_sim, phone_sim, avg_sim)``: candidate pairs between the first
    rows of distinct triples, plus copy edges. ``key`` must be unique."""
    require_unique(df, key)
    t = triples(df, key)
    feats = triple_pair_features(t, candidate_pairs(t, keys, **kw)).withColumnRenamed("tid_i", "row_i") \
        .withColumnRenamed("tid_j", "row_j")
    return feats.unionByName(copy_edges(df, t, key))


def row_pair_count(t: DataFrame, triple_pairs: DataFrame, copies_are_duplicates: bool = True) -> DataFrame:
    """How many pairs of rows the duplicate triples stand for, as one row ``value``: every pair inside a triple, and for
    a pair of triples (``triple_pairs`` with ``copies_i``, ``copies_j``) every row of one with every row of the other.
    Counted from the group sizes; no pair of copies is ever listed."""
    inside = t.select((F.col("copies") * (F.col("copies") - 1) / 2).alias("n")) if copies_are_duplicates else \
        t.select(F.lit(0.0).alias("n")).limit(0)
    across = triple_pairs.select((F.col("copies_i") * F.col("copies_j")).cast("double").alias("n"))
    return inside.unionByName(across).agg(F.coalesce(F.sum("n"), F.lit(0.0)).cast("bigint").alias("value"))


def sampled_recall(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, threshold: float = 0.7, every: int = 50,
                   most: int = 2_000, **kw) -> DataFrame:
    """What blocking misses, measured: triples whose id hashes to 0 modulo ``every`` are compared with all triples,
    without blocks, and the rule's pairs among them looked up among the candidates: ``(queries, pairs, found, recall)``.

    The whole query set is compared, in cells of about ``most`` queries by as many of the other triples (``compare.py``)."""
    from .compare import compared
    base = with_row_id(df) if ROW_ID not in df.columns else df
    t = triples(base)
    q = cut_lineage(t.where(F.pmod(F.xxhash64("tid"), F.lit(every)) == 0))
    near = with_mean(compared(q, t, threshold, most))
    true = cut_lineage(near.where(F.col("avg_sim") > threshold).select("tid_i", "tid_j").distinct())
    found = true.join(candidate_pairs(t, keys, **kw), ["tid_i", "tid_j"], "left_semi")
    n, hit = true.count(), found.count()
    return df.sparkSession.createDataFrame([(q.count(), n, hit, hit / n if n else None)],
                                           "queries long, pairs long, found long, recall double")


def _length_bound(column: str, a: str = "_i", b: str = "_j"):
    """The largest indel ratio that two lengths allow: ``2 min / sum``."""
    la, lb = F.length(f"{column}{a}"), F.length(f"{column}{b}")
    return F.lit(2.0) * F.least(la, lb) / (la + lb)
