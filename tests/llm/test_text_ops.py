"""BPE, token counts, decontamination and language ID: against libraries, brute force and held-out rows."""
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cleanspark.llm import bpe
from cleanspark.llm import decontaminate as DC
from cleanspark.llm import language_id as LI
from cleanspark.llm import token_counts as TC
from cleanspark.llm import words as W
from cleanspark.llm.queries import ORACLE, QUERIES

from ..conftest import SF001
from . import brute

SCHEMA = "doc_id long, text string"
ODD = ["", "a", " ", "\n\n", "  two  spaces ", "it's we'll I'D", "naïve café — “quoted”", "日本語のテキスト", "🙂🙃 mixed 🙂a1b2", "1234567 89",
       " nbsp em", "<|endoftext|> is text", "a" * 5000, "ab" * 3000, " " * 4000, "----" * 500, "=" * 33, "\x00\x01\x7f",
       "é combining", "\r\n\tx", "ﬁ ligature Ⅷ ½ ²", "word " * 3000]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    with open(bpe.rank_file(), "rb") as f:
        content = f.read()
    ranks = bpe.parse_ranks(content)
    return content, ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(content, texts):
    import public_tokenizers
    return [np.frombuffer(p, "<i4").tolist() for p in bpe.built(content, public_tokenizers.PATTERN).packed(texts)]


def test_bpe_equals_the_rank_library(library):
    content, _, enc = library
    assert ids_of(content, ODD) == [enc.encode_ordinary(t) for t in ODD]


def test_bpe_on_periodic_texts(library):
    """Runs of one unit, where equal tokens can overlap."""
    content, ranks, enc = library
    rng = random.Random(5)
    units = {t[:n // k] for t in ranks for n in [len(t)] for k in (2, 3, 4) if n % k == 0 and t == t[:n // k] * k}
    units = sorted(u.decode() for u in units if u.isascii())
    texts = [rng.choice(units) * rng.randint(1, 40) + rng.choice(units) * rng.randint(0, 9) for _ in range(4000)]
    texts += [u * n for u in units for n in (2, 3, 5, 7, 13, 31, 64)]
    assert ids_of(content, texts) == [enc.encode_ordinary(t) for t in texts]


def test_bpe_random_texts(library):
    content, _, enc = library
    rng = random.Random(6)
    alphabet = "abcdefgh EIou  '’.,!?\n\t0123é日🙂‍̀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(3000)]
    assert ids_of(content, texts) == [enc.encode_ordinary(t) for t in texts]


def test_splitter_is_the_pattern(library):
    """Every code point falls into the same class as in the library (through the ids of a probing text)."""
    content, _, enc = library
    points = [chr(i) for i in [*range(0x3000), *range(0xD7FF - 50, 0xD800), *range(0xE000, 0x110000, 97)]]
    texts = [f"a{x}1 {x}{x}!{x}x" for x in points]
    assert ids_of(content, texts) == [enc.encode_ordinary(t) for t in texts]


def test_bpe_frames(spark, library):
    _, _, enc = library
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, None), (3, "again")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("ids", F.lit("clash")).withColumn("start.s", F.lit(2))
    got = bpe.encode(df, offsets=True).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((d, tuple(enc.encode_ordinary(t or ""))) for d, t in rows)
    by_ids = {tuple(r.ids): r for r in got}
    for _, t in rows:
        r = by_ids[tuple(enc.encode_ordinary(t or ""))]
        at = 0  # bytes so far; a token's span holds the characters that its bytes touch
        first = [0]
        for ch in t or "":
            first.append(first[-1] + len(ch.encode()))
        for token, a, b in zip(r.ids, r.starts, r.ends):
            end = at + len(enc.decode_single_token_bytes(token))
            assert first[a] <= at < first[a + 1] and first[b - 1] < end <= first[b]
            at = end
    back = bpe.decode(bpe.encode(df)).select("doc_id", F.col("bytes").cast("string").alias("text")).collect()
    assert Counter(map(tuple, back)) == Counter((d, t or "") for d, t in rows)
    assert bpe.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_decode_split_characters_nulls_and_unknown_ids(spark, library):
    _, _, enc = library
    smile = enc.encode_ordinary("🙂")
    assert len(smile) > 1  # one character over several tokens
    rows = [(1, smile), (2, smile[:1]), (3, None), (4, []), (5, [10 ** 6, -1]), (6, [None, *smile])]
    got = {r.doc_id: r.bytes for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(2)).collect()}
    assert bytes(got[1]).decode() == "🙂" and bytes(got[2]) == enc.decode_single_token_bytes(smile[0])
    assert got[3] is None and bytes(got[4]) == b"" and bytes(got[5]).decode() == "��" and bytes(got[6]).decode() == "�🙂"


def test_op2_query(spark, library):
    _, _, enc = library
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_byte_bpe"](spark, SF001).collect()}
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM read_parquet('{SF001}/documents.parquet')").fetchall()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {d: (len(i), sha(",".join(map(str, i))), sha(t)) for d, t in texts for i in [enc.encode_ordinary(t)]}


# ---------------------------------------------------------------- token counts

def test_automaton_random_vocabularies():
    rng = random.Random(2)
    for _ in range(1500):
        pieces = {bytes(rng.choice(b"ab c") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        automaton = TC.Automaton(pieces)
        for _ in range(8):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))
            assert automaton.count(word) == brute.greedy(pieces, word), (pieces, word)


def test_token_counts(spark, library, tmp_path):
    _, ranks, _ = library
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "a"), (1, "a")]
    got = TC.token_counts(spark.createDataFrame(rows, SCHEMA).repartition(2).withColumn("n_words", F.lit(9)), lengths=True).collect()
    expected = []
    for d, t in rows:
        n = [brute.greedy(ranks, w) for w in (t or "").split() if len(w) < 200] if max(map(len, (t or "").split()), default=0) < 200 else None
        if n is not None:
            expected.append((d, len(n), sum(n), 0, max(n, default=0), n))
    assert Counter(map(str, expected)) <= Counter(str(tuple(r)) for r in got) and len(got) == len(rows)
    assert TC.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    few = tmp_path / "few"  # " a" and "b" only: other words are unknown as a whole
    few.write_text("IGE= 0\nYg== 1\n")
    r = TC.token_counts(spark.createDataFrame([(1, "abb ac b a")], SCHEMA), path=str(few), lengths=True).first()
    assert (r.n_words, r.n_tokens, r.n_unknown, r.longest, r.word_pieces) == (4, 6, 2, 3, [3, 1, 1, 1])


# ---------------------------------------------------------------- words and decontamination

@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_word_hashes(monkeypatch, piece):
    monkeypatch.setattr(W, "PIECE", piece)
    W._powers.cache_clear()
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB9 é\n.ßœ字 ") for _ in range(rng.choice([0, 1, 3, 20, 200]))) for _ in range(200)] + [None, "", "a" * 5000 + " b"]
    raw, bounds = W.text_bytes(pa.array(texts, pa.string()).slice(2))
    h, at = W.word_hashes(raw, bounds)
    expected = [brute.words(t) for t in texts[2:]]
    assert [len(e) for e in expected] == np.diff(at).tolist()
    seen = dict(zip([w for e in expected for w in e], h.tolist()))
    assert [seen[w] for e in expected for w in e] == h.tolist() and len(set(seen.values())) == len(seen)
    W._powers.cache_clear()


def contaminated(spark, docs, items, **options):
    got = DC.contamination(spark.createDataFrame(docs, SCHEMA).repartition(3).withColumn("kind", F.lit("clash")),
                           spark.createDataFrame(items, "item_id long, text string"), **options).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in got)


def test_contamination_random(spark):
    """A vocabulary of four words: windows, overlaps, ties and short items everywhere."""
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "B", "cé", "d1"]) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 5, 7, 9, 10, 11, 30]) + 6)) for i in range(12)] + [(50, "d1 d1 d1 d1 d1 d1 d1 d1 d1"), (51, ""), (52, None), (1, "a a a a a a a a a a")]
    docs = [(i, text(rng.choice([0, 2, 9, 10, 11, 40, 300]))) for i in range(120)]
    docs += [(200, items[3][1]), (201, "x y z " + (items[5][1] + " q ") * 3), (202, None), (203, ""), (200, items[3][1]), (None, items[7][1])]
    expected = sorted((str(d), len(brute.words(t)), *brute.hits(t, items)) for d, t in docs)
    assert contaminated(spark, docs, items) == expected


def test_contamination_short_items_and_shuffled_benchmark(spark, monkeypatch):
    items = [(1, "one"), (2, "two three"), (3, "one two three four five six seven eight nine"), (4, "...")]
    docs = [(1, "One! two three"), (2, "three two"), (3, "zero one two three four five six seven eight nine ten"), (4, "none")]
    expected = sorted((str(d), len(brute.words(t)), *brute.hits(t, items)) for d, t in docs)
    assert contaminated(spark, docs, items) == expected
    monkeypatch.setattr(DC, "BROADCAST_FINGERPRINTS", 0)  # beyond the bound: both sides are shuffled
    assert contaminated(spark, docs, items) == expected


def test_contamination_empty_tables_and_filter(spark):
    empty_docs, empty_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (2, "x"), (None, "y")], SCHEMA).withColumn("n_hit", F.lit(1))
    assert DC.contamination(empty_docs, empty_items).count() == 0
    assert [r.n_hit for r in DC.contamination(docs, empty_items).collect()] == [0, 0, 0]
    kept = DC.decontaminate(docs, spark.createDataFrame([(1, "b c")], "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "n_hit"] and {r.doc_id for r in kept.collect()} == {2, None}


# ---------------------------------------------------------------- language ID

def test_language_held_out_accuracy(spark):
    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id").collect()
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 5 == 0) for r in got.collect())


def test_language_equals_sets_of_grams(spark):
    """Every n-gram of the learning rows is in the filter: predictions are those of plain sets, but for false positives."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()
    grams = lambda t: LI.gram_hashes([t])[0].tolist()
    sets, sizes = {}, Counter()
    for r in docs:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            sets.setdefault(r.lang, set()).update(grams(r.text))
            sizes[r.lang] += len(grams(r.text))
    got = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, SF001).collect()}
    for r in docs:
        own = grams(r.text)
        if not own:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        share = {x: sum(g in held for g in own) / len(own) for x, held in sets.items()}
        best = max(share, key=lambda x: (share[x], sizes[x]))
        assert got[r.doc_id].score == pytest.approx(share[best], abs=0.02)
        assert got[r.doc_id].lang_pred == best or share[best] - share[got[r.doc_id].lang_pred] < 0.02
    model = LI.train(spark.createDataFrame([(r.text, r.lang) for r in docs if r.lang], "text string, lang string"))
    for r in docs[:50]:  # no n-gram of a learning row is missing
        if r.lang and grams(r.text):
            assert LI.LanguageModel([r.lang], model.masks >> np.uint64(model.languages.index(r.lang)) & np.uint64(1)).predict([r.text])[1][0] == 1.0


def test_language_learning_rows(spark):
    """Up to the bound all rows are learned from; beyond it a share of each large language, the small ones whole."""
    rows = [(f"text {i} {'abcdefgh'[i % 8]}", "xx") for i in range(4000)] + [(f"other {i}", "yy") for i in range(30)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert LI.learning_rows(df, 4000).count() == 4030
    some = {r.lang: r["count"] for r in LI.learning_rows(df, 1000).groupBy("lang").count().collect()}
    assert some["yy"] == 30 and 850 < some["xx"] < 1150
    assert [LI.filter_cells(n) for n in (0, 4096, 4097, 1 << 30)] == [1 << 16, 1 << 16, 1 << 17, 1 << 24]


def test_round_trip_is_encode_and_decode(spark):
    rows = [(i, t, "s") for i, t in enumerate([None, "", "a", "Grüße, 東京 🙂", "x" * 3000, "The end.\n" * 50])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(2)
    got = bpe.round_trip(df).collect()
    assert {r.doc_id: r.ids for r in got} == {r.doc_id: r.ids for r in bpe.encode(df).collect()}
    assert {r.doc_id: bytes(r.bytes).decode() for r in got} == {i: t or "" for i, t, _ in rows}
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_language_odd_rows(spark):
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(30)] + [(30 + i, "der hund und die katze schlafen", "de") for i in range(30)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !?", "de"), (103, "Der Hund", None), (104, "THE DOG " * 20_000, None),
             (105, "日本", None), (None, "the cat", None), (1, "der hund", "de"), (106, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).withColumn("score", F.lit("clash"))
    got = LI.identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[102].score == 0
    assert (by[103].lang_pred, by[104].lang_pred, by[None].lang_pred) == ("de", "en", "en")
    assert by[105].lang_pred in ("de", "en") and by[105].score < 0.2 and by[106].lang_pred in ("de", "en")
    kept = LI.keep_identified(df, 0.2)
    assert kept.columns == df.columns and {100, 101, 102, 105} & {r.doc_id for r in kept.collect()} == set()
    assert {103, 104, None} <= {r.doc_id for r in kept.collect()}


def test_filter_learns_from_all_rows(spark):
    """A language that only rows of the held-out fifth are labelled with is known to the filter."""
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0][:6]
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(400) if i not in out]
    rows += [(i, "qwxz zjkv vbxq kqzz wvvx", "xx") for i in out]
    kept = LI.keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 0.2)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(400))


def test_language_without_training_rows(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in LI.identify(df).collect()] == [("und", 0.0)]
    assert LI.identify(df.limit(0)).count() == 0


def test_language_masks_more_than_64_languages(spark):
    rng = random.Random(4)
    names = [f"l{i:03d}" for i in range(70)]
    vocabulary = {x: ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(6)] for x in names}
    rows = [(i, " ".join(vocabulary[x] * 3), x) for x in names for i in range(2)]
    model = LI.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.masks.shape[0] == 2
    predicted, score = model.predict([" ".join(vocabulary[x]) for x in names])
    assert predicted == names and min(score) > 0.9


# ---------------------------------------------------------------- SQL

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = QUERIES[name](spark, SF001)
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(result.fetchall())
