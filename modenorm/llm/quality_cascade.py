"""Quality rules as a short-circuit cascade of SQL expressions.

A rule is a name and a boolean SQL expression that is true for a text to
reject.  On a bounded sample (about ``SAMPLE`` rows) the rejections of every
rule, the base rule included, are counted and its cost is timed: the least of
``RUNS`` warm runs over each row ``REPEATS`` times, less the same of a rule
that never rejects.  The rules are then ordered by rejections per second and
become one ``CASE``, which stops at a text's first rejection.  The order
changes the work and the reported reason, never the verdict.

Everything runs as DataFrame and SQL functions.  Repeated 8-word windows are
found inside each row: windows are hashed to 64 bits, and only texts whose
window hashes are not all distinct are looked at further (sorted hashes with
positions, then the union of the covered words).

Defined results: a null or empty text has zero counts, fails the base rule and
is not kept.  Repeated rows give repeated results.  A rule whose expression is
null for a row does not reject it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import staged

SAMPLE = 300
#: evaluations of a sampled row in a run, and runs, that time a rule; a cost below the clock's noise counts as this
REPEATS, RUNS, LEAST_SECONDS = 20, 3, 1e-3
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

#: Verdict rules beside the base rules: rejected if true.
RULES = {
    "symbols": "100 * n_symbols > 10 * word_chars",
    "dup_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "capitals": "100 * char_length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]+', '')) > 35 * word_chars",
    "digits": "100 * char_length(regexp_replace(text, '[^0-9]+', '')) > 30 * word_chars",
}

_W = WINDOW_WORDS


def counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` and the base counts of every whole text."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = docs.selectExpr(
        "doc_id", "text",
        r"array_remove(split(text, '[\\x20\\x09-\\x0D]+'), '') AS words",
        r"filter(split(text, '\n'), line -> line rlike '[^\\x20\\x09-\\x0D]') AS lines",
        "CAST(char_length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS LONG) AS n_symbols")
    hashed = base.selectExpr(
        "doc_id", "text", "n_symbols", "CAST(size(words) AS LONG) AS n_words",
        "CAST(char_length(array_join(words, '')) AS LONG) AS word_chars",
        "CAST(size(lines) AS LONG) AS n_lines",
        "CAST(size(lines) - size(array_distinct(lines)) AS LONG) AS n_dup_lines",
        f"IF(size(words) <= {_W}, CAST(array() AS ARRAY<LONG>), "
        "transform(words, w -> xxhash64(w))) AS word_hash")
    windows = hashed.selectExpr(
        *[c for c in hashed.columns if c != "word_hash"],
        f"IF(size(word_hash) = 0, word_hash, transform(sequence(1, size(word_hash) - {_W - 1}), "
        f"i -> xxhash64(slice(word_hash, i, {_W})))) AS windows")
    keep = [c for c in windows.columns if c != "windows"]
    repeated = windows.selectExpr(
        *keep, "IF(size(array_distinct(windows)) = size(windows), NULL, "
        "sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i)))) AS sorted")
    places = repeated.selectExpr(
        *keep, "IF(sorted IS NULL, NULL, sort_array(transform(filter(sorted, (x, k) -> "
        "(k > 0 AND x.h = get(sorted, k - 1).h) OR coalesce(x.h = get(sorted, k + 1).h, false)), x -> x.i))) AS places")
    return places.selectExpr(
        *keep, f"IF(places IS NULL, 0L, aggregate(transform(places, (p, k) -> "
        f"least({_W}, coalesce(get(places, k + 1) - p, {_W}))), 0L, (a, x) -> a + x)) AS n_repeat_words")


def sample_rows(df: DataFrame, id_col: str, text_col: str, size: int = SAMPLE) -> DataFrame:
    """About ``size`` rows at most: those of ``size`` ids by smallest hash, thinned where the ids repeat.

    The ids and their counts come from the id column alone; as literals they reach the scan as a filter, so
    that row groups without one of them are not read.
    """
    ids = df.groupBy(F.col(id_col).alias("id")).count().where("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(size).collect()
    rows = sum(r["count"] for r in ids)
    sample = df.select(id_col, text_col).where(F.col(id_col).isin([r.id for r in ids]))
    return sample if rows <= size else sample.sample(size / rows, seed=1)


def order_rules(sample: DataFrame, rules: dict[str, str]) -> list[str]:
    """Rule names by rejections per second on the sample, best first; ties by name."""
    part = staged(sample.sparkSession, sample, "rule-sample")
    many = part.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    every = [F.max(F.hash(c)) for c in part.columns]  # all runs read the same columns

    def least(rule: str) -> tuple[int, float]:
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            hits = many.agg(F.expr(f"count_if({rule})").alias("n"), *every).first().n
            times.append(time.perf_counter() - began)
        return hits / REPEATS, min(times)

    nothing = least("n_words < 0")[1]
    value = {}
    for name, rule in rules.items():
        hits, took = least(rule)
        value[name] = (hits + 0.5) / max(took - nothing, LEAST_SECONDS)
    return sorted(rules, key=lambda r: (-value[r], r))


def cascade(df: DataFrame, rules: dict[str, str], order: list[str]) -> DataFrame:
    """``df`` with ``rejected_by``: the first rule of ``order`` that rejects the row, else null."""
    whens = " ".join(f"WHEN {rules[name]} THEN '{name}'" for name in order)
    return df.withColumn("rejected_by", F.expr(f"CASE {whens} END") if order else F.lit(None).cast("string"))


def judge(df: DataFrame, rules: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every text."""
    rules = RULES if rules is None else rules
    counted = counts(df, id_col, text_col)
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words")
    based = counted.withColumn("base_failed", failed)
    rules = {"base": "base_failed", **rules}
    sample = counts(sample_rows(df, id_col, text_col), id_col, text_col).withColumn("base_failed", failed)
    done = cascade(based, rules, order_rules(sample, rules))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       F.col("rejected_by").isNull().alias("kept"))


JUDGE_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT row_id, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM base),
windows AS (
  SELECT row_id, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS i FROM parts WHERE len(words) >= 8)),
repeated AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT row_id, sum(least(8, coalesce(next_i - i, 8))) AS n_repeat_words
  FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS next_i FROM repeated) GROUP BY row_id),
counted AS (
  SELECT p.doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM parts p LEFT JOIN covered c USING (row_id)),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 10 * word_chars
            OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 100 * length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) > 35 * word_chars
            OR 100 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 30 * word_chars) AS kept
FROM failed"""
