"""Quality rules by counts inside a document and by cross-document line frequency, in SQL functions only.

Per document: words (runs without blank and 0x09-0x0D), their code points, symbols, lines that repeat
an earlier line, and words inside three-word windows that occur twice or more. A document fails the
base rules with too few words or too many repeated ones.

Across documents: every line is normalised (lower case, runs of white space as one blank, trimmed),
hashed, and counted by distinct documents of its host. Documents are distinct when their whole texts are,
so exact copies count once; near copies are documents of their own, and a host that has more of them than
the limit loses the lines that they share. Lines above the limit are removed, and a document of which
too little is left is rejected, whatever the lines are: a notice that is most of a page goes like a footer.

Defined results: a null, empty or blank text has no words and fails the base rules; a null host is a
host of its own; a line that occurs twice in a document counts one document; rows that repeat a
doc_id are judged one by one; an empty table gives an empty result; further columns travel untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written

MIN_WORDS = 50
MAX_REPEATED_PCT = 50
#: Distinct documents of a host that may share a line.
LINE_LIMIT = 20
#: Least share of a document's words that must be left without the lines above the limit.
MIN_LEFT_PCT = 30
_BLANKS = " \t\n\x0b\f\r"
_BLANK_RUN = r"[ \t\n\x0B\f\r]+"


def _let(value: Column, use) -> Column:
    """`use` of a value that is evaluated once, also where a lambda reads it for every element."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK_RUN))


def _lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)) != "")


def _line_key(line: Column) -> Column:
    """Hash of the normalised line, with its length in front, so that keys sort by length."""
    normal = F.regexp_replace(F.lower(F.btrim(line, F.lit(_BLANKS))), _BLANK_RUN, " ")
    return _let(normal, lambda n: F.concat(F.lpad(F.char_length(n).cast("string"), 8, "0"), F.left(F.md5(n), F.lit(20))))


def _repeated_words(words: Column, size: Column) -> Column:
    """Words inside three-word windows that a text holds twice or more.

    Windows are sorted with their places, so that equal ones are neighbours; the places of the
    repeated ones, in order, cover three words each less what overlaps. No step is quadratic.
    """

    def covered(places: Column) -> Column:
        new = F.transform(places, lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get(places, i - 1), F.lit(-3))))
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    def places(pairs: Column) -> Column:
        hit = F.filter(
            pairs,
            lambda w, i: (F.get(pairs, i - 1)["h"] == w["h"]).eqNullSafe(True)
            | (F.get(pairs, i + 1)["h"] == w["h"]).eqNullSafe(True),
        )
        return F.sort_array(F.transform(hit, lambda w: w["i"]))

    def of(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
        )
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return _let(F.sort_array(pairs), lambda p: _let(places(p), covered))

    return F.when(size < 3, F.lit(0)).otherwise(_let(words, of)).cast("long")


def _packed(docs: DataFrame, host: str) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    return docs.select(
        F.col("doc_id"),
        F.col("text"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("whole"),
        F.col(f"`{host}`").alias("host"),
        rest.alias("rest"),
    )


def _line_rows(packed: DataFrame) -> DataFrame:
    """A row for every line of every document: doc_id, print (of the text), host, line, words and first
    (not a repetition inside the document)."""
    line = F.transform(
        _lines(F.col("whole")),
        lambda x: F.struct(_line_key(x).alias("line"), F.size(_words(x)).alias("words")),
    )
    sorted_lines = packed.select(
        "doc_id", F.xxhash64("whole").alias("print"), "host", F.sort_array(line, asc=False).alias("lines")
    )
    return sorted_lines.select(
        "doc_id", "print", "host", F.posexplode("lines").alias("i", "own"), "lines"
    ).select(
        "doc_id",
        "print",
        "host",
        F.col("own")["line"].alias("line"),
        F.col("own")["words"].alias("words"),
        (~F.col("own")["line"].eqNullSafe(F.get("lines", F.col("i") - 1)["line"])).alias("first"),
    )


def frequent_lines(lines: DataFrame, limit: int = LINE_LIMIT) -> DataFrame:
    """host, line and documents of the lines above the limit. A hot line is first one row for each text
    that has it, so it has partial counts in many tasks before they meet."""
    texts = lines.filter("first").select("host", "line", "print").distinct()
    return (
        texts.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > limit)
    )


def assess(
    docs: DataFrame,
    host: str = "source",
    min_words: int = MIN_WORDS,
    max_repeated_pct: int = MAX_REPEATED_PCT,
    line_limit: int = LINE_LIMIT,
    min_left_pct: int = MIN_LEFT_PCT,
) -> DataFrame:
    """doc_id, text, rest (a struct of the other columns), clean_text (without the lines above the
    limit), the counts, n_line_words (words in those lines), base_failed, depleted and kept."""
    packed = _packed(docs, host)
    lines = written(_line_rows(packed), "lines")
    often = frequent_lines(lines, line_limit)
    bad = (
        lines.alias("l")
        .join(often.alias("o"), F.col("l.host").eqNullSafe(F.col("o.host")) & (F.col("l.line") == F.col("o.line")))
        .groupBy(F.col("l.doc_id").alias("bad_id"), F.col("l.print").alias("bad_print"))
        # rows that repeat a document with its text each count its lines: their share is one row's
        .agg(
            F.collect_set("l.line").alias("bad"),
            F.sum("words").alias("words"),
            F.sum(F.col("first").cast("long")).alias("firsts"),
        )
        .select("bad_id", "bad_print", "bad", (F.col("words") * F.size("bad") / F.col("firsts")).cast("long").alias("bad_words"))
    )
    counted = (
        packed.withColumn("words", _words(F.col("whole")))
        .withColumn("size", F.size("words").cast("long"))
        .select(
            "doc_id",
            "text",
            "rest",
            "whole",
            F.xxhash64("whole").alias("print"),
            F.col("size").alias("n_words"),
            F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.regexp_count("whole", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _let(_lines(F.col("whole")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            _repeated_words(F.col("words"), F.col("size")).alias("n_repeat_words"),
        )
    )
    joined = counted.join(
        bad, counted["doc_id"].eqNullSafe(bad["bad_id"]) & (counted["print"] == bad["bad_print"]), "left"
    )
    kept_lines = F.filter(
        F.split("whole", "\n"), lambda line: ~F.array_contains("bad", _line_key(line))
    )
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated_pct)
    return (
        joined.withColumn("n_line_words", F.coalesce("bad_words", F.lit(0).cast("long")))
        .withColumn(
            "clean_text", F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(kept_lines, "\n"))
        )
        .withColumn("base_failed", failed)
        .withColumn("depleted", (F.col("n_words") - F.col("n_line_words")) * 100 < F.col("n_words") * min_left_pct)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("whole", "print", "bad", "bad_id", "bad_print", "bad_words")
    )


def digest(docs: DataFrame) -> DataFrame:
    return assess(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept documents with their columns, without the lines above the limit."""
    own = [
        F.col("doc_id") if c == "doc_id" else F.col("clean_text").alias("text") if c == "text" else F.col("rest")[c].alias(c)
        for c in docs.columns
    ]
    return assess(docs).filter("kept").select(*own)


_SQL_KEY = rf"""list_transform([regexp_replace(lower(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12)
    || chr(13))), '[\x20\x09-\x0D]+', ' ', 'g')], lambda n: lpad(len(n)::VARCHAR, 8, '0') || md5(n)[1:20])[1]"""

SQL = rf"""
WITH whole AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), split_up AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM whole
), every_word AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split_up
), triples AS (
  SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g
  FROM every_word WINDOW o AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM triples WHERE g IS NOT NULL
), repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r
), line_rows AS (
  SELECT source, t, unnest(list_distinct(list_transform(lines, lambda x: {_SQL_KEY}))) AS line FROM split_up
), often AS (
  SELECT source, line FROM line_rows GROUP BY source, line HAVING count(DISTINCT t) > {LINE_LIMIT}
), line_words AS (
  SELECT r, source, unnest(lines) AS x FROM split_up
), gone AS (
  SELECT l.r, sum(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS n
  FROM line_words l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND o.line = {_SQL_KEY}
  GROUP BY l.r
), counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n, 0) AS gone
  FROM split_up LEFT JOIN repeated USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED_PCT} AS base_failed,
       NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED_PCT})
         AND NOT (n_words - gone) * 100 < n_words * {MIN_LEFT_PCT} AS kept
FROM counts
"""
