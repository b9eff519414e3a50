"""Spelling variants: words at one edit from each other, found through an index of variable-length grams (VGRAM).

The gram dictionary holds every gram of ``Q_MIN`` characters and, of those that more than ``FREQUENT`` words hold, their
extensions by one character up to ``Q_MAX``: frequent grams make long lists and are replaced by longer, rarer ones. A
word is decomposed into the longest dictionary gram from each position, without those that lie inside an earlier one.

An edit changes the grams that it touches; a gram beside it can be lost only if a longer dictionary gram may begin at or
before it and reach the edit (then it might grow, or be swallowed), or may end at or behind it. So each gram of a word has
places where an edit surely leaves it, in place, and with all that stands outside of it: a gram before the edit with the whole
beginning of the word up to it, one behind the edit with the whole end. Two words at one edit have the same grams left, so
also the same rarest one. A word is listed by the rarest gram that is left, for each place and kind of edit, and nothing else: each
rarer gram takes the places it survives, and the next one those in between. A list is of words with the same gram in the same place, the
same beginning or the same end with it, and two given lengths. With ``Q_MAX`` = 3 an edit reaches two characters to each side, so a
word of ``MIN_LENGTH`` characters always keeps a gram. Pairs that share a list are verified by their edit distance.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import LOWER, UPPER, c, written

Q_MIN, Q_MAX = 2, 3
#: Words that hold a gram before it is extended.
FREQUENT = 64
#: Fixed values of the contract: least length and occurrences of a word, one run in TYPO loses a character, the
#: frequency ratio between a form and its variants, the characters of a run.
MIN_LENGTH, MIN_COUNT, TYPO, RATIO = 7, 2, 31, 10
RUN = "[A-Za-z\\u00C0-\\u00FF]"
#: Words of one part of a list; two parts are joined by one piece of work. Lists this long are at most HOT_LISTS.
PART_WORDS, HOT_LISTS = 1_000, 100_000


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, n`` of all words of all texts, as the contract makes them from runs of letters."""
    runs = df.select(F.coalesce(c(id_col).cast("string"), F.lit("")).alias("doc"),
                     F.explode(F.regexp_extract_all(c(text_col).cast("string"), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    low = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % typo == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return low.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _every(column: Column, q: int) -> Column:
    """All grams of ``q`` characters of a word, one for each start."""
    return F.when(F.length(column) >= q, F.transform(F.sequence(F.lit(1), F.length(column) - (q - 1)), lambda i: F.substring(column, i, F.lit(q)))
                  ).otherwise(F.array().cast("array<string>"))


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``gram, extended, n``: the grams of the dictionary, whether it holds longer ones that begin with it, and the words
    that hold each. Grams of Q_MAX characters are in it where all their beginnings are frequent."""
    counts = None
    for q in range(Q_MIN, Q_MAX + 1):
        level = words.select(F.explode(F.array_distinct(_every(F.col("word"), q))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        if counts is not None:  # only extensions of frequent grams
            level = level.join(counts.filter("extended").select(F.col("gram").alias("shorter")), F.substring("gram", 1, q - 1) == F.col("shorter"), "left_semi")
        level = written(level.withColumn("extended", F.lit(q < Q_MAX) & (F.col("n") > frequent)), "grams")
        counts = level if counts is None else counts.union(level)
    return counts


def _decomposed(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``word, grams``: of each gram of the word's decomposition its start ``a`` (from 1), ``gram``, ``n`` (words that hold it)
    and ``open``: whether it could grow, being frequent."""
    short = words.select("word", F.posexplode(_every(F.col("word"), Q_MIN)).alias("at", "short"))
    cut = short.select("word", (F.col("at") + 1).alias("a"), "short", F.expr(f"substring(word, at + 1, {Q_MAX})").alias("long"))
    # both parts of the dictionary are broadcast: an alphabet of 90 letters has 8,100 and 729,000 such grams at most
    two = dictionary.filter(F.length("gram") == Q_MIN).select(F.col("gram").alias("short"), F.col("n").alias("n_short"), "extended")
    three = dictionary.filter(F.length("gram") == Q_MAX).select(F.col("gram").alias("long"), F.col("n").alias("n_long"))
    held = cut.join(F.broadcast(two), "short").join(F.broadcast(three), "long", "left")
    whole = F.col("n_long").isNotNull()
    starts = F.array_sort(F.collect_list(F.struct("a", F.when(whole, F.col("long")).otherwise(F.col("short")).alias("gram"),
                                                  F.coalesce("n_long", "n_short").alias("n"), F.col("extended").alias("open"))))
    every = held.groupBy("word").agg(starts.alias("starts"))
    # a start is swallowed where the gram before it reaches as far: grams are Q_MIN or Q_MIN + 1 long
    end = lambda s: s["a"] + F.length(s["gram"])
    return every.select("word", "starts", F.filter("starts", lambda s, i: (i == 0) | (
        end(s) > end(F.get(F.col("starts"), i - 1)))).alias("grams"))


def _bounded(words: DataFrame) -> DataFrame:
    """``_decomposed`` rows, whose ``grams`` also have ``lo`` and ``hi``, with ``bound``, the most grams that one edit can take from the word.

    An edit at character p (replaced or deleted) leaves the grams with p >= ``lo``, which end before it, and those with p <= ``hi``, which
    begin behind it. One that ends at p - 1 might grow over p, if it can; one that begins at p + 1 and is of Q_MIN characters fits into
    a longer gram from p on. An insertion before p touches what lies around it: it leaves those with p >= ``lo`` or p <= ``hi`` + 1."""
    short = lambda g: (F.length(g["gram"]) < Q_MAX).cast("int")
    reach = F.transform("grams", lambda g: F.struct(
        g["a"].alias("a"), g["gram"].alias("gram"), g["n"].alias("n"), g["open"].alias("open"),
        (g["a"] + F.length(g["gram"]) + short(g) * g["open"].cast("int")).alias("lo"), (g["a"] - 1 - short(g)).alias("hi")))

    def lost(p: Column, inserted: int) -> Column:
        return F.size(F.filter("grams", lambda g: (p < g["lo"]) & (p > g["hi"] + inserted)))

    places = F.sequence(F.lit(1), F.length("word") + 1)
    return words.withColumn("grams", reach).withColumn("bound", F.array_max(F.transform(places, lambda p: F.greatest(lost(p, 0), lost(p, 1)))))


def _listed(words: DataFrame) -> DataFrame:
    """``word, list, half``: the lists of each word, by the rarest gram that each edit leaves. A list is named by a hash of two lengths
    (equal, or one apart) and the word's beginning up to the gram's end, or its end from the gram's start. ``half`` is 0 in a list
    of equal lengths (a character is replaced), else 1 for the shorter (one is inserted) and 2 for the longer words (one is deleted)."""
    size = F.length("word")
    rare = F.array_sort(F.transform("grams", lambda g: F.struct(g["n"].alias("n"), g["gram"].alias("gram"), g["a"].alias("a"),
                                                                g["lo"].alias("lo"), g["hi"].alias("hi"))))
    ranked = words.select("word", rare.alias("rare")).select("word", "rare", F.col("rare.lo").alias("los"), F.col("rare.hi").alias("his"))
    # the places that no rarer gram survives lie between ``left`` and ``right``
    steps = F.transform("rare", lambda g, i: F.struct(
        g["a"].alias("a"), (g["a"] + F.length(g["gram"]) - 1).alias("end"), g["lo"].alias("lo"), g["hi"].alias("hi"),
        F.coalesce(F.array_max(F.slice("his", F.lit(1), i)), F.lit(-1)).alias("left"),
        F.coalesce(F.array_min(F.slice("los", F.lit(1), i)), size + 2).alias("right")))

    def names(g: Column) -> Column:
        until, since = F.substring(F.col("word"), F.lit(1), g["end"]), F.substring(F.col("word"), g["a"], size)
        out = []
        for inserted, lengths in ((0, ((0, 0, 0), (2, 1, 0))), (1, ((1, 0, 1),))):
            left, right = F.greatest(F.lit(0), g["left"] + inserted), F.least(size + 1 + inserted, g["right"])
            for side, part, takes in (("<", until, g["lo"] < right), (">", since, g["hi"] + inserted > left)):
                out += [F.when(takes & (left + 1 < right), F.struct(F.xxhash64(F.lit(side), size - less, size + more, part).alias("list"), F.lit(half).alias("half")))
                        for half, less, more in lengths]
        return F.array(*out)

    some = F.filter(steps, lambda g: g["left"] + 1 < g["right"])
    return ranked.select("word", F.explode(F.array_compact(F.flatten(F.transform(some, names)))).alias("x")).select("word", "x.list", "x.half")


def near_words(words: DataFrame, frequent: int = FREQUENT, part_words: int = PART_WORDS) -> DataFrame:
    """``a, b``: both orders of every two words of ``words`` (distinct ``word`` of at least MIN_LENGTH characters) that differ by one
    inserted, deleted or replaced character.

    A list longer than ``part_words`` is cut into parts and joined part by part, so no task holds a whole one."""
    dictionary = gram_dictionary(words, frequent)
    lists = written(_listed(_bounded(_decomposed(words.select("word"), dictionary))), "lists")
    limit = max(part_words, lists.count() // HOT_LISTS)
    hot = lists.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > limit).select(
        "list", F.ceil(F.col("size") / limit).cast("int").alias("parts"))  # at most HOT_LISTS rows
    held = lists.join(F.broadcast(hot), "list", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    held = held.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = held.filter("half < 2").select("list", F.col("part").alias("i"), other.alias("j"), F.col("word").alias("a"), "half")
    right = held.filter("half <> 1").select("list", F.col("part").alias("j"), other.alias("i"), F.col("word").alias("b"))
    found = left.join(right, ["list", "i", "j"]).filter(((F.col("half") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, ratio: int = RATIO,
             frequent: int = FREQUENT, part_words: int = PART_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts of ``df`` with at least ``min_count`` occurrences.

    The form of a word is its near word of most occurrences (ties: the first in code-point order), if those are at
    least ``ratio`` times the word's own; the root is where forms lead to. Null texts have no words, a null id counts as
    empty, repeated rows count again, an empty table gives an empty result. Only the table of words goes through the index; it
    is made by partial aggregates, so a word that holds a third of all occurrences is a row of each map task."""
    words = written(word_counts(df, id_col, text_col).filter(F.col("n") >= min_count), "words")
    near = near_words(words, frequent, part_words)
    best = near.join(words.select(F.col("word").alias("b"), "n"), "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form"))).alias("m"))
    form_n = -F.col("m.less")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form_n >= F.col("n") * ratio, F.col("m.form")).alias("form"),
        F.when(form_n >= F.col("n") * ratio, form_n).alias("form_n")), "forms")
    # occurrences grow by the ratio with each step, so a chain is short; its ends double their reach in each round
    chain = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        chain = written(chain, "chain")
        step = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chain.join(step, "root", "left_semi").isEmpty():
            break
        chain = chain.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
