"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged on its own:

* navigation: at least ``NAV_MARKS`` separators (``|``, guillemets, bullets)
  and one for every ``NAV_WORDS`` words at least;
* boilerplate: a line of up to ``BOILERPLATE_WORDS`` words that holds a phrase of
  ``BOILERPLATE``;
* punctuation: no sentence mark before white space or the line's end, or
  symbols make up ``SYMBOL_SHARE`` percent of the line.

Failing lines are removed (empty lines stay, they hold no words); a document
that keeps less than ``KEEP_SHARE`` percent of its words is rejected. Rules of the whole
text come first: fewer than ``MIN_WORDS`` words, or more than half of the words
in three-word windows that occur twice or more.

Everything is computed inside the row, without a shuffle. The windows of a
text are hashed, sorted with their places, and neighbours compared, so a text
of n words costs n log n whatever repeats in it.

Edges: a null text has no words and no lines and is rejected; its cleaned
text is null. Rows are judged one by one, so ties and repeated rows stay;
extra columns pass through ``clean``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.once import once

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_SHARE = 50
KEEP_SHARE = 50
NAV_MARKS = 2
NAV_WORDS = 4
BOILERPLATE_WORDS = 30
SYMBOL_SHARE = 10
NAV = "[|»«›‹•]"
SENTENCE_MARK = "[.!?:;…。！？][\"')\\]»”’]*([\\x20\\x09-\\x0D]|\\z)"
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "accept cookies", "subscribe to our newsletter",
               "enable javascript", "lorem ipsum", "click here to", "sign up for", "powered by", "share on facebook", "alle rechte vorbehalten",
               "tous droits réservés", "todos los derechos reservados")


def _n(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def line_fails(line: Column, lowered: Column) -> Column:
    """Whether a line with words is removed; the cheap tests come first, words are counted only where they matter."""
    marks = _n(line, NAV)
    navigation = (marks >= NAV_MARKS) & (marks * NAV_WORDS >= _n(line, WORD))
    phrase = F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | F.contains(lowered, F.lit(p))
    boilerplate = phrase & (_n(line, WORD) <= BOILERPLATE_WORDS)
    punctuation = ~line.rlike(SENTENCE_MARK) | (_n(line, SYMBOLS) * 100 >= F.length(line) * SYMBOL_SHARE)
    return line.rlike(r"[^\x20\x09-\x0D]") & (punctuation | navigation | boilerplate)


def _windows(docs: DataFrame) -> DataFrame:
    """``__n_repeat``: words that lie in a three-word window found twice or more; takes ``__words`` away."""
    windows = F.when(F.size("__words") >= 3, F.transform(
        F.slice("__words", 1, F.size("__words") - 2), lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    out = once(docs, __hashes=windows).drop("__words")
    # Most texts repeat no window: only the others are sorted with their places.
    places = F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = once(out, __places=F.coalesce(places, F.array().cast("array<struct<h:bigint,i:int>>"))).drop("__hashes")
    same = lambda s, k: F.coalesce(F.get("__places", k)["h"] == s["h"], F.lit(False))
    again = F.filter("__places", lambda s, k: ((k > 0) & same(s, F.greatest(k - 1, F.lit(0)))) | same(s, k + 1))
    out = once(out, __again=F.sort_array(F.transform(again, lambda s: s["i"]))).drop("__places")
    spans = F.transform("__again", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("__again", k + 1) - p, F.lit(3))))
    return once(out, __n_repeat=F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x)).drop("__again")


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` (with text) and the columns __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat, __base_failed, __kept, __clean."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = once(docs, __lines=F.split(text, "\n", -1), __lower=F.split(F.lower(text), "\n", -1), __n_symbols=_n(text, SYMBOLS))
    filled = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    good = F.filter("__lines", lambda x, i: ~line_fails(x, F.get("__lower", i)))
    out = once(out, __filled=filled, __good=good).withColumn("__all_good", F.size("__good") == F.size("__lines")).drop("__lines", "__lower")
    clean_text = F.when(F.col("text").isNotNull(), F.array_join("__good", "\n"))
    out = once(out, __clean=clean_text, __n_dup_lines=(F.size("__filled") - F.size(F.array_distinct("__filled"))).cast("long"), __words=F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).drop("__filled", "__good")
    n_words = F.size("__words").cast("long")
    left = F.when(F.col("__all_good"), n_words).otherwise(F.coalesce(_n("__clean", WORD), F.lit(0).cast("long")))
    out = once(out, __n_words=n_words, __word_chars=F.length(F.array_join("__words", "")).cast("long"), __left=left).drop("__all_good")
    failed = (F.col("__n_words") < MIN_WORDS) | (F.col("__n_repeat") * 100 > F.col("__n_words") * REPEAT_SHARE)
    out = _windows(out).withColumn("__base_failed", failed)
    return out.withColumn("__kept", ~F.col("__base_failed") & (F.col("__left") * 100 >= F.col("__n_words") * KEEP_SHARE))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text, in the columns of ``docs``; n_chars follows where there is one."""
    names = docs.columns
    new = {"text": F.col("__clean"), **({"n_chars": F.length("__clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})}
    return judge(docs).where("__kept").select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in names])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their figures and verdicts."""
    d = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return d.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__word_chars").alias("word_chars"), F.col("__n_symbols").alias("n_symbols"),
                    F.col("__n_dup_lines").alias("n_dup_lines"), F.col("__n_repeat").alias("n_repeat_words"),
                    F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__left").alias("n_left_words"))


_RE_PHRASES = "|".join(BOILERPLATE)
OP6_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS k FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) x WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM dup, (VALUES (0), (1), (2)) AS o(j) GROUP BY doc_id),
lines AS (SELECT doc_id, l, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS nw, len(regexp_extract_all(l, '{NAV}')) AS marks
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) x),
by_line AS (SELECT doc_id, count(*) FILTER (WHERE nw > 0) - count(DISTINCT l) FILTER (WHERE nw > 0) AS dups,
                   coalesce(sum(nw) FILTER (WHERE NOT (NOT regexp_matches(l, '{SENTENCE_MARK.replace("'", "''")}')
                       OR len(regexp_extract_all(l, '{SYMBOLS}')) * 100 >= length(l) * {SYMBOL_SHARE}
                       OR (marks >= {NAV_MARKS} AND marks * {NAV_WORDS} >= nw)
                       OR (nw <= {BOILERPLATE_WORDS} AND regexp_matches(lower(l), '{_RE_PHRASES}')))), 0) AS left_words
            FROM lines GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS nw, length(array_to_string(w, '')) AS wc, len(regexp_extract_all(t, '{SYMBOLS}')) AS ns, dups, coalesce(rep.n, 0) AS nr, left_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN by_line USING (doc_id))
SELECT doc_id, CAST(nw AS BIGINT) AS n_words, CAST(wc AS BIGINT) AS word_chars, CAST(ns AS BIGINT) AS n_symbols, CAST(dups AS BIGINT) AS n_dup_lines,
       CAST(nr AS BIGINT) AS n_repeat_words, nw < {MIN_WORDS} OR nr * 100 > nw * {REPEAT_SHARE} AS base_failed,
       NOT (nw < {MIN_WORDS} OR nr * 100 > nw * {REPEAT_SHARE}) AND left_words * 100 >= nw * {KEEP_SHARE} AS kept, CAST(left_words AS BIGINT) AS n_left_words
FROM f"""
