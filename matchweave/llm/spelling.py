"""Spelling variants: words one edit apart, found through asymmetric chunks and grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.session import durable

#: Words are maximal runs of these letters; only A-Z is lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One occurrence in so many, chosen by a checksum, loses a letter before words are counted.
DAMAGE = 97
#: Least length and number of occurrences of a word.
LENGTH, OCCURRENCES = 5, 3
#: A form has at least so many times the occurrences of its variant.
RATIO = 2
#: Pairs that a chunk may bring together before it is cut finer.
PAIRS = 1_024


def damaged(doc_id: Column, run: Column) -> Column:
    """The lower-cased run, without one letter if its checksum with the document's id says so."""
    # lower() knows more capitals than A-Z
    run = F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (check % F.length(run)).cast("int")
    return F.when(check % DAMAGE == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def count_words(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """``word, n`` of every word of the whole texts with enough letters and occurrences."""
    runs = docs.select(F.col("doc_id").alias("_doc"), F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("_run"))
    words = runs.select(damaged(F.col("_doc"), F.col("_run")).alias("word")).filter(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= occurrences)


def _key(word: Column, longer: Column, shift: Column) -> Column:
    """What a word shows outside the window ``lo`` to ``hi``, for partners of ``longer`` letters; it has ``shift`` fewer."""
    return F.xxhash64(longer, "lo", "hi", F.substr(word, F.lit(1), F.col("lo")), F.substr(word, F.col("hi") - shift + 1))


def _halves(lo: Column, hi: Column) -> Column:
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def _windows(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each row twice: with the edit in the first half of its window, and in the second."""
    cut = rows.withColumn("_half", F.explode(_halves(lo, hi))).drop("lo", "hi").select("*", "_half.lo", "_half.hi").drop("_half")
    longer = F.length("word") + F.col("shift")
    return cut.withColumn("_chunk", _key(F.col("word"), longer, F.col("shift")))


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``word, n, other, other_n``: every two words that differ by one inserted, deleted or replaced code point, once.

    The longer word (of equally long ones, either) gives two disjoint chunks, its halves; one edit leaves one of them as
    it is. The other word gives its grams of these lengths at the places where such a chunk can be: the same place, or
    shifted by the one letter that it is shorter. A chunk shared by so many words that it would bring together more
    than ``pairs`` pairs is joined by more letters: the part outside it, where the edit is, is halved again, and so on
    down to one letter, where no more words meet than there are letters. What meets is verified.
    """
    place = F.array(*[F.lit(s) for s in (0, 1)])
    sides = words.select("word", "n", F.lit(0).alias("shift"), F.lit(True).alias("chunk")).unionByName(
        words.select("word", "n", F.explode(place).alias("shift"), F.lit(False).alias("chunk"))
    )
    rows = _windows(sides, F.lit(0), F.length("word") + F.col("shift"))
    found = []
    while True:
        rows = durable(rows)
        met = F.count_if("chunk") * F.count_if(~F.col("chunk"))
        groups = rows.groupBy("_chunk").agg(met.alias("_met"), F.max(F.col("hi") - F.col("lo")).alias("_open")).filter("_met > 0")
        groups = groups.select("_chunk", ((F.col("_met") > pairs) & (F.col("_open") > 1)).alias("_hot"))
        rows = durable(rows.join(groups, "_chunk"))
        left = rows.filter("chunk and not _hot").select("_chunk", "word", "n")
        right = rows.filter("not chunk and not _hot").select("_chunk", F.col("word").alias("other"), F.col("n").alias("other_n"))
        longer = F.length("word") > F.length("other")
        one_edit = F.levenshtein("word", "other", 1) == 1
        found.append(left.join(right, "_chunk").filter((longer | (F.col("word") < F.col("other"))) & one_edit).drop("_chunk"))
        rows = rows.filter("_hot").drop("_chunk", "_hot")
        if rows.isEmpty():
            break
        rows = _windows(rows, F.col("lo"), F.col("hi"))
    # a letter lost from a run of equal ones may be missing in either half
    return reduce(DataFrame.unionByName, found).dropDuplicates(["word", "other"])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word reached from each row of ``word, form``.

    A form has more occurrences than its word, so there are no circles; each round doubles the steps taken.
    """
    reached = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = durable(reached.join(onward, "root", "left"))
        reached = moved.select("word", F.coalesce("_next", "root").alias("root"))
        if moved.filter("_next is not null").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, ratio: int = RATIO, pairs: int = PAIRS
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` with enough letters and occurrences.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (of equal ones the smallest in
    code-point order) if it has at least ``ratio`` times the word's occurrences, else null; ``root`` is reached by
    following forms to the last, the word itself if it has none.

    Null texts and texts without letters have no words; a null id counts as an empty one in the checksum. Rows that repeat an id
    count each. An empty table gives no rows; other columns are not read.
    """
    words = durable(count_words(docs, length, occurrences))
    found = durable(near_pairs(words, pairs))
    both = found.unionByName(found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    first = F.min(F.struct((-F.col("other_n")).alias("_less"), F.col("other").alias("_form")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), first.alias("_first"))
    enough = -F.col("_first._less") >= ratio * F.col("n")
    near = durable(
        near.select(
            "word", "n_near", F.when(enough, F.col("_first._form")).alias("form"), F.when(enough, -F.col("_first._less")).alias("form_n")
        )
    )
    last = roots(near.filter("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(last, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
    )
