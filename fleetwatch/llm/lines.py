"""Line-first quality rules in DataFrame functions only.

Every line is judged first: it must end like a sentence, must not be a navigation bar and must not be boilerplate. Failing
lines are removed, and a document that loses more than ``max_lost`` of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.common import SPACES, WORD

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Fixed values of the line rules.
ENDS, CLOSERS, QUOTES = ".!?…。！？؟।:;", "\"'”’»)]", "\"”"
SEPARATORS = r"[|»›•→¦]"
BOILERPLATE = (
    "all rights reserved", "accept cookies", "accept all cookies", "cookie policy", "uses cookies", "use cookies",
    "privacy policy", "terms of use", "terms of service", "terms and conditions", "enable javascript", "javascript is",
    "lorem ipsum", "skip to content", "skip to main content", "click here", "read more", "sign up for", "log in to",
    "subscribe to our", "powered by", "back to top", "share this", "follow us on", "page not found",
)
BOILERPLATE_WORDS = 25


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def line_passes(line: Column) -> Column:
    """True for a line that stays; lines without a word stay."""
    trimmed = F.rtrim(line, F.lit(SPACES))
    words = F.regexp_count(line, F.lit(WORD))
    last = F.right(F.rtrim(trimmed, F.lit(CLOSERS)), F.lit(1))
    ends = last.isin(*ENDS) | F.right(trimmed, F.lit(1)).isin(*QUOTES)
    bars = F.regexp_count(line, F.lit(SEPARATORS))
    navigation = (bars >= 2) & (bars * 4 >= words)
    phrases = F.lower(line).rlike("|".join(BOILERPLATE))
    return (F.length(trimmed) == 0) | (ends & ~navigation & ~((words <= BOILERPLATE_WORDS) & phrases))


def judge_lines(
    docs: DataFrame, text: str = "text", max_lost: float = 0.5, min_words: int = 20, max_repeat: int = 30
) -> DataFrame:
    """The rows of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned.

    Columns of these names in ``docs`` are replaced. Null and empty texts have no word, fail the base rules and are not
    kept. ``cleaned`` is the text without its failing lines. Repeated rows are judged alike. Windows of eight words are
    compared by 64-bit hashes inside one row, so nothing is shuffled.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned"]
    # Work columns stand in structs under one name each, so that no column of the input can clash.
    name = lambda c: F.col(f"`{c.replace('`', '``')}`")
    columns = [name(c) for c in docs.columns if c not in own]
    body = F.coalesce(name(text), F.lit(""))
    step = docs.select(*columns, body.alias("#body"), word_list(body).alias("#words"), F.split(body, "\n").alias("#lines"))
    n = F.size("#words")
    windows = F.when(
        n > WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("#words"), i, F.lit(WINDOW)))
        ),
    )
    worded = F.filter(F.col("#lines"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    step = step.select(
        *columns,
        "#body",
        n.cast("long").alias("n_words"),
        F.length(F.translate("#body", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("#body") - F.length(F.translate("#body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        worded.alias("#worded"),
        windows.alias("#windows"),
        F.array_join(F.filter(F.col("#lines"), line_passes), "\n").alias("cleaned"),
    )
    repeats = F.size(F.array_distinct("#windows")) < F.size("#windows")
    ranked = F.when(repeats, F.array_sort(F.transform("#windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.select(
        *columns, "n_words", "word_chars", "n_symbols", "cleaned",
        (F.size("#worded") - F.size(F.array_distinct("#worded"))).cast("long").alias("n_dup_lines"),
        ranked.alias("#ranked"),
    )

    def again(x: Column, k: Column) -> Column:
        before, after = F.get(F.col("#ranked"), k - 1), F.get(F.col("#ranked"), k + 1)
        return F.coalesce(x["h"] == before["h"], F.lit(False)) | F.coalesce(x["h"] == after["h"], F.lit(False))

    starts = F.array_sort(F.transform(F.filter(F.col("#ranked"), again), lambda x: x["i"]))
    step = step.select(
        *columns, "n_words", "word_chars", "n_symbols", "cleaned", "n_dup_lines", F.size("#ranked").alias("#n"),
        starts.alias("#starts"),
    )
    spans = F.transform(
        F.col("#starts"),
        lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("#starts"), k + 1) - p, F.lit(WINDOW))),
    )
    covered = F.coalesce(F.aggregate(spans, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    step = step.withColumns({"n_repeat_words": covered, "#left": F.regexp_count("cleaned", F.lit(WORD))})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    lost = (F.col("n_words") - F.col("#left")) > max_lost * F.col("n_words")
    return step.select(
        *columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~lost).alias("kept"), "cleaned",
    )


def oracle_sql() -> str:
    """The same rules over documents for DuckDB."""
    words = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
    trimmed = "rtrim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"
    phrases = "|".join(BOILERPLATE)
    closers = CLOSERS.replace("'", "''")
    ends = f"contains('{ENDS}', right(rtrim({trimmed}, '{closers}'), 1)) AND rtrim({trimmed}, '{closers}') <> '' OR right({trimmed}, 1) IN ('\"', '”')"
    strip = "'[\\x20\\x09-\\x0D]+'"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {words} AS words, string_split(t, chr(10)) AS lines FROM d),
win AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g
        FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) > {WINDOW})),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
ln AS (SELECT r, unnest(lines) AS line FROM w),
judged AS (SELECT r, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
                  len(regexp_extract_all(line, '{SEPARATORS}')) AS bars FROM ln),
lines AS (SELECT r, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
        sum(n) FILTER (NOT (({ends}) AND NOT (bars >= 2 AND bars * 4 >= n)
                            AND NOT (n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{phrases}')))) AS n_lost
      FROM judged GROUP BY r),
m AS (SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(t, {strip}, '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols, n_dup_lines,
        coalesce(cov.n, 0) AS n_repeat_words, coalesce(n_lost, 0) AS n_lost
      FROM w LEFT JOIN cov USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND n_lost <= 0.5 * n_words AS kept
FROM f"""
