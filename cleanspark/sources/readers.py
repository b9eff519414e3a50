"""Sources and schema handling.

Text formats are read with every column as string (X6): type inference would strip leading zeros from phones and turn
gapped digit columns into floats. Typing happens in the cleaning stage with guarded casts.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_split import read_csv_split

# The text tokens a CSV reader treats as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The column roles of a customer table, in output order.
EXPECTED_COLUMNS = ("customer_id", "name", "email", "phone", "city", "country", "signup_date", "amount")
CONTENT_COLUMNS = EXPECTED_COLUMNS[1:]

# Header synonyms mapped onto the roles above (compared after strip + lower case).
ROLE_SYNONYMS = {
    "customer_id": ("id", "client_id", "patient_id", "id_client"),
    "name": ("nom", "full_name", "nom_complet", "client", "customer"),
    "email": ("e-mail", "mail", "courriel", "adresse_email"),
    "phone": ("telephone", "tel", "phone_number", "mobile", "gsm"),
    "city": ("ville", "town"),
    "country": ("pays",),
    "signup_date": ("date", "date_inscription", "date_ordonnance", "created_at"),
    "amount": ("prix_dt", "prix", "price", "montant", "total"),
}


#: The column that holds a text record which does not fit its header, with ``malformed="keep"``.
REJECT_COLUMN = "_corrupt_record"


def read_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Read a table. CSV and JSON come in with all columns as string; Parquet/ORC keep their types.

    ``columns`` gives the header for header-less text or restricts the schema; with a header CSV and no
    ``columns`` the header row of each path is read first (one small job each) and every column is declared string.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt in ("parquet", "orc"):
        df = spark.read.format(fmt).options(**options).load(paths)
        return df.select(*columns) if columns else df
    if fmt == "csv":
        return read_csv(spark, paths, columns, **options)
    if fmt == "json":
        if columns is None:
            df = spark.read.options(**options).json(paths)
            return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
        return spark.read.options(**options).schema(schema).json(paths)
    return spark.read.format(fmt).options(**options).load(paths)


def read_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, malformed: str = "fail",
             split: bool = False, **options) -> DataFrame:
    """CSV paths as one table of strings, columns aligned by name.

    Fields may hold quotes (doubled), separators and line breaks. Each path has a header of its own; paths whose headers
    differ in order or content are read apart and stacked by name (absent columns null), and a file under a path that
    has another header than the path's first is an error, never read by position. A record with too few or too many
    fields fails the read (``malformed="fail"``) or stays as a row whose text is in ``_corrupt_record``
    (``malformed="keep"``, see ``split_rejects``).

    ``split=True`` deals large files over tasks although fields may hold line breaks (``csv_split.py``; of the options it takes
    ``header``, ``sep`` and ``quote``); else a file is one task, unless ``multiLine="false"`` says that there are none.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed must be 'fail' or 'keep'")
    opts = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "enforceSchema": "false",
            "mode": "FAILFAST" if malformed == "fail" else "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN, **options}

    def read(part: Sequence[str], names: Sequence[str]) -> DataFrame:
        if split:
            return read_csv_split(spark, part, names, str(opts["header"]).lower() == "true", malformed, opts.get("sep", ","), opts["quote"], REJECT_COLUMN)
        kept = [*names, REJECT_COLUMN] if malformed == "keep" else names
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in kept])
        # enforceSchema=false also checks the header; a header-less file has none
        fixed = opts if str(opts["header"]).lower() == "true" else {**opts, "enforceSchema": "true"}
        return spark.read.options(**fixed).schema(schema).csv(list(part))

    if columns is not None:
        return read(paths, columns)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        header = spark.read.options(**{**opts, "inferSchema": "false", "mode": "PERMISSIVE"}).csv(p).columns
        by_header.setdefault(tuple(header), []).append(p)
    frames = [read(part, header) for header, part in by_header.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, and the rejected records (one text column), of a table read with ``malformed="keep"``."""
    bad = F.col(REJECT_COLUMN).isNotNull()
    return df.where(~bad).drop(REJECT_COLUMN), df.where(bad).select(REJECT_COLUMN)


def read_many(spark: SparkSession, specs: Iterable[tuple[str, str]], **options) -> DataFrame:
    """V1: several sources of possibly different formats and columns, stacked by name; missing columns null."""
    frames = [read_table(spark, p, fmt, **options) for p, fmt in specs]
    frames = [normalize_headers(f) for f in frames]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def apply_null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Exact-match missing tokens -> null in string columns; NaN -> null in floating columns."""
    wanted = set(columns) if columns is not None else None
    token_array = F.array(*[F.lit(t) for t in tokens])
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if wanted is not None and field.name not in wanted:
            out.append(c.alias(field.name))
        elif isinstance(field.dataType, T.StringType):
            out.append(F.when(~F.array_contains(token_array, c), c).alias(field.name))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(~F.isnan(c), c).alias(field.name))
        else:
            out.append(c.alias(field.name))
    return df.select(*out)


def normalize_headers(df: DataFrame) -> DataFrame:
    """S3: strip + lower case every column name; a collision is an error (it would silently shadow a column)."""
    names = [c.strip().lower() for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*names)


def complete_schema(df: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Add absent expected columns as null strings, after the existing ones."""
    missing = [c for c in expected if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def map_roles(df: DataFrame, synonyms: Mapping[str, Sequence[str]] = ROLE_SYNONYMS) -> DataFrame:
    """Rename columns whose normalised header is a known synonym of a role. An existing column that already
    carries the role name wins; each role is taken by the first synonym found. Other columns pass through."""
    taken = {c.strip().lower() for c in df.columns}
    renames: dict[str, str] = {}
    for role, names in synonyms.items():
        if role in taken:
            continue
        for c in df.columns:
            if c.strip().lower() in names and c not in renames:
                renames[c] = role
                taken.add(role)
                break
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns])


def detect_roles(df: DataFrame, synonyms: Mapping[str, Sequence[str]] = ROLE_SYNONYMS) -> dict[str, str]:
    """The ``(role -> source column)`` map that ``map_roles`` applies (schema only, no job)."""
    mapped = map_roles(df, synonyms)
    return {new: old for old, new in zip(df.columns, mapped.columns) if new in synonyms}
