"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed, and the distinct documents of a host that hold
a line are counted, copies included. Lines that more documents share than a limit
allows are taken out; a document that is depleted by that, or that fails a base
rule of its own, is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.common import SPACE_RUN, let
from homematch.session import saved

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEAT_PERCENT = 20
#: A line goes if more documents of one host hold it.
LINE_LIMIT = 50
#: A document goes if less of its word characters than this percentage is left.
LEAST_LEFT_PERCENT = 30


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words in windows of five that stand twice or more in the text, the first included.

    Window hashes are sorted with their places inside the row; windows equal to
    a neighbour are the repeated ones, and each covers what the next repeated
    window does not.
    """

    def of_words(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - WINDOW)
        marked = F.array_sort(F.transform(places, lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i"))))

        def repeated(m: Column) -> Column:
            same = F.filter(m, lambda x, k: (F.get(m, k - 1)["h"] == x["h"]) | (F.get(m, k + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def covered(starts: Column) -> Column:
            reach = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
            return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

        return let(let(marked, repeated), covered)

    return F.when(F.size(words) > WINDOW, let(words, of_words)).otherwise(F.lit(0)).cast("bigint")


def line_key(line: Column) -> Column:
    """Hash of a line without letter case, digits and repeated white space; null for a line without a word."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), SPACE_RUN, " "))
    return F.when(plain != "", F.xxhash64(plain))


def measured(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Counts of each text and the hashes of its lines with their word characters."""
    kept = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        held = F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        return let(held, lambda h: F.struct(
            (F.size(h) - F.size(F.array_distinct(h))).cast("bigint").alias("n_dup_lines"),
            F.transform(h, lambda x: F.struct(line_key(x).alias("line"), F.length(F.translate(x, SPACES, "")).alias("chars"))).alias("lines"),
        ))

    return kept.select(
        "doc_id", "host",
        F.xxhash64("text").alias("text_hash"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(words_of(F.col("text")), of_words).alias("_words"),
        let(F.split("text", "\n"), of_lines).alias("_lines"),
    ).select("doc_id", "host", "text_hash", "word_chars", "n_symbols", "_words.*", "_lines.*")


def common_lines(held: DataFrame, ids: DataFrame, line_limit: int) -> DataFrame:
    """(host, line) of lines that more distinct documents of a host hold than the limit.

    ``held`` has the lines of each text with the text's documents ``n``; an id
    whose different texts hold the same line counts once. Without an id each
    different text is one document.
    """
    several = ids.groupBy("host", "doc_id").agg(F.count("*").alias("k")).where("k > 1").select("host", "doc_id")
    again = held.join(ids.join(several, ["host", "doc_id"]), ["host", "text_hash"]).groupBy("host", "line", "doc_id").agg((F.count("*") - 1).alias("k"))
    twice = again.where("k > 0").groupBy("host", "line").agg(F.sum("k").alias("twice"))
    many = held.groupBy("host", "line").agg(F.sum("n").alias("n")).where(F.col("n") > line_limit)
    return many.join(twice, ["host", "line"], "left").where(F.col("n") - F.coalesce("twice", F.lit(0)) > line_limit).select("host", "line")


def judge_documents(
    docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: int = LEAST_LEFT_PERCENT, with_text: bool = False,
    key: str = "doc_id", text: str = "text", host: str = "source",
) -> DataFrame:
    """Counts, base rules and verdict of every document; with ``clean_text`` on request.

    Null texts count as empty and fail the base rules; documents without a host
    share one; repeated rows get the same result each; an empty table gives no
    rows; other columns, whatever their names, are ignored.
    """
    rows = saved(measured(docs, key, text, host), "lines")
    texts = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    ids = rows.select("host", "text_hash", "doc_id").distinct()
    texts = texts.join(ids.groupBy("host", "text_hash").agg(F.count("*").alias("n")), ["host", "text_hash"])
    held = texts.select("host", "text_hash", "n", F.inline("lines")).groupBy("host", "line", "text_hash").agg(F.sum("chars").alias("chars"), F.max("n").alias("n"))
    held = saved(held, "line-texts")
    found = held.join(common_lines(held, ids, line_limit), ["host", "line"])
    taken = found.groupBy("host", "text_hash").agg(F.sum("chars").alias("gone_chars"), *([F.collect_set("line").alias("gone")] if with_text else []))
    left = F.col("word_chars") - F.coalesce("gone_chars", F.lit(0))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    judged = rows.drop("lines").join(taken, ["host", "text_hash"], "left").select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * left >= least_left * F.col("word_chars"))).alias("kept"),
        left.cast("bigint").alias("left_chars"),
        *([F.col("gone")] if with_text else []),
    )
    if not with_text:
        return judged.drop("host", "text_hash")
    once = judged.dropDuplicates(["doc_id", "host", "text_hash"])
    gone = F.coalesce("gone", F.array().cast("array<bigint>"))
    whole = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: line_key(x).isNull() | ~F.array_contains(gone, line_key(x)))
    same = whole["doc_id"].eqNullSafe(once["doc_id"]) & (whole["host"] == once["host"]) & (whole["text_hash"] == once["text_hash"])
    return whole.join(once, same).select(*[once[c] for c in judged.columns if c not in ("host", "text_hash", "gone")], F.array_join(lines, "\n").alias("clean_text"))
