"""Quality rules, built-in expressions only: text statistics of each document
and the frequency of its lines over the documents of its host.

Normalised lines are hashed; a line found in more distinct documents of one
host than both limits allow is boilerplate and removed; a document that loses
more than half of its words that way is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is boilerplate above both limits: documents of the host that hold it,
# as a number and as a share of the host's documents.
LINE_DOCS = 30
LINE_SHARE = 0.002
MAX_REMOVED_PERCENT = 50

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_HOST = "\x00"


def words(text: Column) -> Column:
    """``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * 5), " "), "")


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")


def statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds _n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words.

    Windows of three words are compared by a 64-bit hash, sorted with their
    positions; the words of repeated windows are counted from the gaps between
    the positions. A text without a repeated window skips the sort.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = _lines_with_words(text)
    out = (docs.withColumn("_w", words(text))
           .withColumn("_word_chars", F.length(F.translate(text, BLANKS, "")).cast("long"))
           .withColumn("_n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
           .withColumn("_l", lines))
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(
        F.arrays_zip(F.slice("_w", F.lit(1), n - 2).alias("a"), F.slice("_w", F.lit(2), n - 2).alias("b"),
                     F.slice("_w", F.lit(3), n - 2).alias("c")),
        lambda x: F.xxhash64(x["a"], x["b"], x["c"])))
    out = (out.withColumn("_n_words", n.cast("long"))
           .withColumn("_n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
           .withColumn("_h", windows).drop("_w", "_l"))
    repeated = F.size("_h") > F.size(F.array_distinct("_h"))
    at = F.sort_array(F.transform(F.col("_h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_s", F.when(repeated, at)).drop("_h")
    m = F.size("_s")
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    near = F.arrays_zip(F.col("_s").alias("cur"),
                        F.concat(none, F.slice("_s", F.lit(1), m - 1)).alias("prev"),
                        F.concat(F.slice("_s", F.lit(2), m), none).alias("next"))
    hits = F.filter(near, lambda x: F.coalesce(x["cur"]["h"] == x["prev"]["h"], F.lit(False))
                    | F.coalesce(x["cur"]["h"] == x["next"]["h"], F.lit(False)))
    out = out.withColumn("_p", F.when(F.col("_s").isNotNull(),
                                      F.sort_array(F.transform(hits, lambda x: x["cur"]["i"])))).drop("_s")
    k = F.size("_p")
    gaps = F.zip_with(F.slice("_p", F.lit(2), k), F.slice("_p", F.lit(1), k - 1),
                      lambda b, a: F.least(F.lit(3), b - a))
    covered = F.aggregate(gaps, F.lit(3), lambda acc, g: acc + g)
    return (out.withColumn("_n_repeat_words", F.coalesce(F.when(k > 0, covered), F.lit(0)).cast("long"))
            .drop("_p"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_removed_words), one row for each row of ``docs``.

    Null text is an empty text. A null host is a host of its own. Equal texts
    of one host count as one document for the line limits, so exact copies do
    not make their lines frequent. Other columns are ignored; an empty table
    gives no rows.
    """
    host = F.coalesce(F.col(host_col), F.lit(_NO_HOST))
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), host.alias("host"),
                       F.xxhash64(text).alias("content"))
    stats = statistics(base, "text").drop("text")

    plain = F.regexp_replace(F.translate(F.col("text"), UPPER, LOWER), r"[ \t\x0B\f\r]+", " ")
    lines = F.transform(F.filter(F.transform(F.split(plain, "\n"), F.trim), lambda x: x != ""),
                        lambda x: F.struct(F.xxhash64(x).alias("line"),
                                           (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1)
                                           .alias("n")))
    found = (base.select("host", "content", F.explode(lines).alias("l"))
             .groupBy("host", "l.line", "content")
             .agg(F.first("l.n").alias("n"), F.count("*").alias("times")))
    copies = base.groupBy("host", "content").agg(F.count("*").alias("copies"))
    hosts = copies.groupBy("host").agg(F.count("*").alias("host_docs"))
    frequent = (found.groupBy("host", "line").agg(F.count("*").alias("docs"))
                .where(F.col("docs") > line_docs).join(hosts, "host")
                .where(F.col("docs") > line_share * F.col("host_docs")).select("host", "line"))
    removed = (found.join(frequent, ["host", "line"]).groupBy("host", "content")
               .agg(F.sum(F.col("n") * F.col("times")).alias("removed")))
    per_text = (copies.join(removed, ["host", "content"])
                .select("host", "content", (F.col("removed") / F.col("copies")).cast("long").alias("removed")))
    lost = F.coalesce("removed", F.lit(0))
    n = F.col("_n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return (stats.join(per_text, ["host", "content"], "left")
            .select("doc_id", n.alias("n_words"), F.col("_word_chars").alias("word_chars"),
                    F.col("_n_symbols").alias("n_symbols"), F.col("_n_dup_lines").alias("n_dup_lines"),
                    F.col("_n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
                    (~failed & (100 * lost <= MAX_REMOVED_PERCENT * n)).alias("kept"),
                    lost.alias("n_removed_words")))
