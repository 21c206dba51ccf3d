"""Quality rules: counts within a document, and lines that many documents of a host share.

DataFrame functions only. The counts of a document come from its own row; nothing is shuffled for
them. Lines (lower case, white space collapsed) are hashed and counted per host by the distinct
texts that hold them, so exact copies count once, and both counting steps combine before they
shuffle, so a line or host with a third of all rows is spread. A line is frequent if more than
`share` of its host's distinct texts and more than `least` of them hold it; by that share, a host has
at most (lines per document) / `share` such lines. They are written to the shared folder, and
joined to the documents by host: broadcast up to `broadcast_lines` hashes, else as Spark plans it.

With `most` or `corpus` set, a line of `wide_words` words or more is also frequent if more than `most` distinct texts of
its host hold it, or more than `corpus` distinct texts of the whole table, whatever the size of either. There may
be any number of such lines, so they are joined with the lines of the texts by their hashes, and each text gets its own
frequent lines. Shorter lines (braces, headings) follow the share alone.

Defined cases: a null text has no words and fails the base rules; a null host is a host of its own;
repeated rows get equal results, and equal texts count once; an empty table gives no rows; other
columns pass through, the results lie in one struct column whose name is a parameter.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.llm.names import free_prefix
from weblake.session import checkpoint_dir

WHITE = " \t\n\x0b\f\r"
_RUN = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    share: float = 0.05
    least: int = 10
    min_kept_share: float = 0.2
    broadcast_lines: int = 1_000_000
    most: int | None = None
    corpus: int | None = None
    wide_words: int = 4


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _RUN), "")


def _let(value: Column, then) -> Column:
    """`then(x)` with x computed once: a name inside a lambda stands for a value, not for its formula."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _fence(rows: DataFrame) -> DataFrame:
    """No later filter moves below this point: there it would repeat the formulas that it looks at, lambdas and all."""
    name = free_prefix(rows, "__fence")
    return rows.withColumn(name, F.spark_partition_id()).where(F.col(name) >= 0).drop(name)


def repeated_words(words: Column, n: int) -> Column:
    """How many words lie in windows of n words that occur at least twice; windows are compared by 64-bit hash."""
    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, k: F.least(F.lit(n), F.coalesce(F.get(starts, k + 1) - s, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeats(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda w, k: (w["h"] == F.get(ordered, k - 1)["h"]) | (w["h"] == F.get(ordered, k + 1)["h"]))
        return _let(F.sort_array(F.transform(twice, lambda w: w["at"])), covered)

    def among(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(ordered, repeats))

    windows = F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])))
    return F.coalesce(_let(windows, among), F.lit(0)).cast("long")


def line_hashes(text: Column) -> Column:
    """For each line of a text its hash as a normalised line; null for lines without a word."""
    flat = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(flat, "\n"), lambda line: _let(F.btrim(line), lambda t: F.when(t != "", F.xxhash64(t))))


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """These rows, written to the shared folder and read again."""
    folder = f"{checkpoint_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _frequent(docs: DataFrame, rules: Rules, text: str, host: str) -> DataFrame:
    """(host, line) of the lines that are frequent by the share."""
    held = docs.select(F.col(host).alias("host"), F.xxhash64(F.col(text)).alias("doc"), F.array_compact(F.array_distinct(line_hashes(F.col(text)))).alias("lines"))
    lines = held.select("host", "doc", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.countDistinct("doc").alias("n"))
    return _above(lines, docs, rules, text, host).where("n > by_share").select("l.host", "line")


def _above(lines: DataFrame, docs: DataFrame, rules: Rules, text: str, host: str) -> DataFrame:
    """The lines (host, line, n) above `least`, with the limit by the share."""
    hosts = docs.select(F.col(host).alias("host"), F.xxhash64(F.col(text)).alias("doc")).groupBy("host").agg(F.countDistinct("doc").alias("docs"))
    limit = F.greatest(F.lit(rules.least), F.floor(F.col("docs") * rules.share))
    return lines.where(F.col("n") > rules.least).alias("l").join(hosts.alias("h"), F.expr("l.host <=> h.host")).withColumn("by_share", limit)


def frequent_lines(docs: DataFrame, rules: Rules, text: str, host: str) -> DataFrame:
    """(host, lines): the hashes of each host's frequent lines, written to the shared folder and read again."""
    return _kept(_frequent(docs, rules, text, host).groupBy("host").agg(F.collect_list("line").alias("lines")), "frequent-lines")


def frequent_lines_of_texts(docs: DataFrame, rules: Rules, text: str, host: str) -> DataFrame:
    """(host, doc, lines): for each text of a host that has any, the hashes of its lines that are frequent by any of the limits."""
    body = F.col(text)
    flat = F.regexp_replace(F.lower(body), r"[\x20\x09\x0B-\x0D]+", " ")
    wide = F.transform(F.split(flat, "\n"), lambda line: F.length(F.btrim(line)) - F.length(F.replace(F.btrim(line), F.lit(" "), F.lit(""))) + 1 >= rules.wide_words)
    pairs = F.array_distinct(F.filter(F.arrays_zip(line_hashes(body).alias("line"), wide.alias("wide")), lambda x: x["line"].isNotNull()))
    held = docs.select(F.col(host).alias("host"), F.xxhash64(body).alias("doc"), F.explode(pairs).alias("x")).select("host", "doc", "x.line", "x.wide")
    counts = _kept(held.groupBy("host", "line", "wide").agg(F.countDistinct("doc").alias("n")), "line-counts")
    of_host = F.col("n") > F.col("by_share")
    if rules.most is not None:
        of_host = of_host | (F.col("wide") & (F.col("n") > rules.most))
    by_host = _kept(_above(counts, docs, rules, text, host).where(of_host).select("l.host", "line"), "frequent-lines")
    hits = held.alias("t").join(by_host.alias("f"), F.expr("t.line = f.line and t.host <=> f.host"), "left_semi").select("host", "doc", "line")
    if rules.corpus is not None:
        # Copies of a text on several hosts count once: the sums over hosts only say which lines to count anew.
        many = _kept(counts.where("wide").groupBy("line").agg(F.sum("n").alias("n")).where(F.col("n") > rules.corpus).select("line"), "line-candidates")
        some = held.where("wide").join(many, "line", "left_semi").groupBy("line").agg(F.countDistinct("doc").alias("n"))
        by_corpus = _kept(some.where(F.col("n") > rules.corpus).select("line"), "frequent-lines")
        hits = hits.unionByName(held.join(by_corpus, "line", "left_semi").select("host", "doc", "line"))
    return _kept(hits.groupBy("host", "doc").agg(F.collect_set("line").alias("lines")), "lines-of-texts")


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source", out: str = "quality") -> DataFrame:
    """The rows and columns of `docs` and a struct `out`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_frequent_lines, n_left (words in the other lines), text (without frequent lines; null if none is
    frequent), kept."""
    body = F.coalesce(F.col(text), F.lit(""))
    at = free_prefix(docs, f"__{out}_")
    names = docs.columns
    same = F.col(host).eqNullSafe(F.col(at + "host"))
    if rules.most is None and rules.corpus is None:
        frequent = frequent_lines(docs, rules, text, host)
        size = frequent.agg(F.sum(F.size("lines") + 1)).first()[0] or 0
        if size <= rules.broadcast_lines:
            frequent = F.broadcast(frequent)
        frequent = frequent.select(F.col("host").alias(at + "host"), F.col("lines").alias(at + "bad"))
    else:
        frequent = frequent_lines_of_texts(docs, rules, text, host).select(F.col("host").alias(at + "host"), F.col("doc").alias(at + "doc"), F.col("lines").alias(at + "bad"))
        same = (F.xxhash64(F.col(text)) == F.col(at + "doc")) & same
    rows = (docs.join(frequent, same, "left")
            .select(*[F.col(f"`{c}`") for c in names], F.col(at + "bad"), words_of(body).alias(at + "words"), F.split(body, "\n").alias(at + "lines"),
                    F.translate(body, WHITE, "").alias(at + "dense")))
    bad = F.coalesce(F.arrays_overlap(F.col(at + "bad"), F.col(at + "hashes")), F.lit(False))
    rows = _fence(rows).withColumn(at + "hashes", F.when(F.col(at + "bad").isNotNull(), line_hashes(body)))
    rows = rows.withColumn(at + "hit", bad)
    lines = F.arrays_zip(F.col(at + "lines").alias("line"), F.col(at + "hashes").alias("h"))
    rows = rows.withColumn(at + "gone", F.when(F.col(at + "hit"), F.filter(lines, lambda x: F.coalesce(F.array_contains(F.col(at + "bad"), x["h"]), F.lit(False)))))
    left = F.when(F.col(at + "hit"), F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(at + "bad"), x["h"]), F.lit(False))))
    worded = F.filter(F.col(at + "lines"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    counts = F.struct(
        F.size(at + "words").cast("long").alias("n_words"), F.length(at + "dense").cast("long").alias("word_chars"),
        (F.length(at + "dense") - F.length(F.translate(F.col(at + "dense"), _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col(at + "words"), rules.window).alias("n_repeat_words"),
        F.coalesce(F.size(F.col(at + "gone")), F.lit(0)).cast("long").alias("n_frequent_lines"),
        F.coalesce(F.aggregate(F.col(at + "gone"), F.lit(0), lambda n, x: n + F.size(words_of(x["line"]))), F.lit(0)).cast("long").alias("n_gone"),
        F.array_join(F.transform(left, lambda x: x["line"]), "\n").alias("text"))
    q = F.col(at + "q")
    rows = _fence(rows.select(*[F.col(f"`{c}`") for c in names], counts.alias(at + "q")))
    failed = (q["n_words"] < rules.min_words) | (100 * q["n_repeat_words"] > rules.max_repeat_percent * q["n_words"])
    n_left = q["n_words"] - q["n_gone"]
    depleted = (q["n_gone"] > 0) & ((n_left < rules.min_words) | (n_left < rules.min_kept_share * q["n_words"]))
    verdict = F.struct(*[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], failed.alias("base_failed"),
                       F.greatest(q["n_frequent_lines"], F.lit(0).cast("long")).alias("n_frequent_lines"), n_left.alias("n_left"), q["text"].alias("text"), (~failed & ~depleted).alias("kept"))
    return rows.select(*[F.col(f"`{c}`") for c in names], verdict.alias(out))
