"""Line-first quality rules, in DataFrame functions only.

Every line of a text is held against rules on punctuation, navigation and boilerplate. Failing
lines are removed; a document that loses more than ``max_loss`` of its characters is rejected, as
is one that fails the document rules (too few words, too much repetition).

Words are runs of anything but ASCII white space. Repetition is counted over word positions in
three-word windows that occur twice or more; windows are compared by a 64-bit hash within one text.

Defined results: null text has no words, so it is rejected. An empty or blank text likewise.
Blank lines break no rule and stay. Repeated rows are judged each. Other columns pass through
``cleaned`` untouched (internal columns carry a prefix); the report has only its own columns. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space, symbols, and lines that are furniture of a page.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = r"[|»›•·]"
SENTENCE_END = r"[.!?…。！？]"
SHOUTS = r"[!?]{2,}"
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright \(c\)|©|cookie policy|privacy policy|terms of (use|service)"
    r"|licensed under the|released under the|enable javascript|subscribe to our newsletter"
    r"|skip to (main )?content|click here|read more|sign up now|powered by|lorem ipsum)"
)

LEAST_WORDS = 50
MAX_LOSS = 0.5
#: Symbols, or shouts, a line may have for each of its words.
MAX_MARKS = 0.3
#: Words for each separator below which a line with several separators is a menu.
MENU_WORDS = 4


def _n(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def fails(line: Column) -> Column:
    """Whether a line breaks a rule. Lines without a word break none."""
    words = _n(line, r"[^\x20\x09-\x0D]+")
    separators = _n(line, SEPARATORS)
    return (words > 0) & (
        ~line.rlike(SENTENCE_END)
        | (_n(line, SYMBOLS) > MAX_MARKS * words)
        | (_n(line, SHOUTS) > MAX_MARKS * words)
        | ((separators >= 2) & (words < MENU_WORDS * separators))
        | line.rlike(BOILERPLATE)
    )


def _chars(text: Column) -> Column:
    """Code points that are no ASCII white space."""
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def measured(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` with ``_q_`` columns: counts, both verdicts and the text that is left."""
    c = F.col
    out = docs.withColumn("_q_text", F.coalesce(c(text), F.lit("")))
    out = out.withColumns(
        {
            "_q_w": F.filter(F.split("_q_text", SPACE, -1), lambda w: w != ""),
            "_q_lines": F.split("_q_text", "\n", -1),
        }
    )
    out = out.withColumns(
        {
            "_q_n_words": F.size("_q_w").cast("long"),
            "_q_word_chars": F.length(F.array_join("_q_w", "")).cast("long"),
            "_q_n_symbols": _n(c("_q_text"), SYMBOLS).cast("long"),
            "_q_full": F.filter("_q_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "_q_good": F.filter("_q_lines", lambda x: ~fails(x)),
            "_q_h": F.when(
                F.size("_q_w") >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size("_q_w") - 3),
                    lambda i: F.xxhash64(
                        F.get("_q_w", i), F.get("_q_w", i + 1), F.get("_q_w", i + 2)
                    ),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_q_w")
    # Only texts with a repeated window are sorted; a window equal to a neighbour is repeated.
    out = out.withColumn(
        "_q_s",
        F.when(
            F.size(F.array_distinct("_q_h")) < F.size("_q_h"),
            F.sort_array(F.transform("_q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop("_q_h")
    same = lambda x, j: F.coalesce(F.get("_q_s", j)["h"] == x["h"], F.lit(False))
    again = F.filter("_q_s", lambda x, j: same(x, j - 1) | same(x, j + 1))
    covered = F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    out = out.withColumns(
        {
            "_q_n_dup_lines": (F.size("_q_full") - F.size(F.array_distinct("_q_full"))).cast("long"),
            "_q_n_repeat_words": F.size(F.array_distinct(F.flatten(covered))).cast("long"),
            "_q_left": F.array_join("_q_good", "\n"),
        }
    ).drop("_q_s", "_q_full", "_q_good", "_q_lines")
    out = out.withColumn("_q_left_chars", _chars(c("_q_left")))
    base_failed = (c("_q_n_words") < LEAST_WORDS) | (
        100 * c("_q_n_repeat_words") > 50 * c("_q_n_words")
    )
    lost = c("_q_word_chars") - c("_q_left_chars")
    return out.withColumns(
        {
            "_q_base_failed": base_failed,
            "_q_kept": ~base_failed & (lost <= max_loss * c("_q_word_chars")),
        }
    )


REPORT = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept left_chars"
).split()


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and the columns of ``REPORT``."""
    rows = measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.select("doc_id", *(F.col(f"_q_{name}").alias(name) for name in REPORT))


def cleaned(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are kept, with the failing lines taken out of ``text``.

    ``n_chars``, where there is one, is counted anew.
    """
    # The row number keeps the optimiser from copying all of the above into the filter.
    rows = measured(docs).withColumn("_q_row", F.monotonically_increasing_id())
    rows = rows.where("_q_kept AND _q_row >= 0").withColumn("text", F.col("_q_left"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


#: The report in DuckDB's SQL.
SQL = rf"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        string_split(coalesce(text, ''), chr(10)) AS l,
        row_number() OVER () AS r
    FROM documents
),
lines AS (
    SELECT r, pos, line,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
        len(regexp_extract_all(line, '{SEPARATORS}')) AS seps,
        len(regexp_extract_all(line, '{SYMBOLS}')) AS syms,
        len(regexp_extract_all(line, '{SHOUTS}')) AS shouts
    FROM (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM base)
),
kept_lines AS (
    SELECT r, sum(length(regexp_replace(line, '{SPACE}', '', 'g'))) AS left_chars FROM lines
    WHERE NOT (n > 0 AND (NOT regexp_matches(line, '{SENTENCE_END}')
        OR syms > {MAX_MARKS} * n OR shouts > {MAX_MARKS} * n
        OR (seps >= 2 AND n < {MENU_WORDS} * seps) OR regexp_matches(line, '{BOILERPLATE}')))
    GROUP BY r
),
dup AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE n > 0 GROUP BY r
),
windows AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) >= 3
),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM grams) WHERE k > 1),
covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
),
counts AS (
    SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
        CAST(coalesce(d.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(k.left_chars, 0) AS BIGINT) AS left_chars
    FROM base b LEFT JOIN dup d USING (r) LEFT JOIN covered c USING (r) LEFT JOIN kept_lines k USING (r)
)
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words)
        AND word_chars - left_chars <= {MAX_LOSS} * word_chars AS kept
FROM counts
"""
