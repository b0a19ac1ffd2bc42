"""How far the sources of a language diverge from each other and from the language, term by term.

1. ``mapInArrow`` counts terms where the texts are read, with Arrow's compute functions alone: ``ascii_lower``,
   ``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by``.  A task gives (lang, source, term, count,
   docs) rows, merged up to ``TASK_TERMS`` of them before they leave.
2. One Spark aggregate (partial on the map side) adds the tasks' rows: the table of cells.  Terms in at least
   ``MIN_DOCS`` documents of their language are kept; N and V are sums over it.
3. Cells are dealt into columnar shards by (lang, hash of the term), so that a shard of S sources holds about
   ``SHARD_CELLS`` / S terms.  In a shard the S x T table of p is one array, and a pair's part of the sum is
   columnar arithmetic over two of its rows; terms without a count have the p of a count of 0.  One aggregate adds
   the shards.

All arithmetic is on integers: p fits 31 bits, (p - q)**2 fits 63, sums over terms stay below 2**32 + 2 V.

Defined results: null text, lang and source are ''.  Every row is a document of its own, repeated ids too.  A group
without kept terms has p of count 0 everywhere.  A language with a single source has no ``pair`` rows; a language
without kept terms has no ``term`` rows, and its pairs have value 0.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modenorm.llm.common import staged, text_batches

MIN_DOCS = 10
TOP_TERMS = 10
#: rows of counts that a task merges before it gives them away
TASK_TERMS = 500_000
#: bytes of text that are split into terms at once
SLICE_BYTES = 8 << 20
#: about as many cells (sources x terms) make one shard's array
SHARD_CELLS = 1 << 21
#: Fixed value of the contract: what separates terms.
SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

_COUNTS = "lang string, source string, term string, n long, docs long"


def count_batch(lang, source, text):
    """Arrow table (lang, source, term, n, docs) of three string arrays of the same length."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATOR)
    words = pa.table({"row": pc.list_parent_indices(lists), "term": pc.list_flatten(lists)})
    words = words.filter(pc.not_equal(words["term"], "")).combine_chunks()
    coded = pc.dictionary_encode(words["term"]).combine_chunks()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.chunk(0) if coded.num_chunks else pa.array([], pa.string()).dictionary_encode()
    per_row = pa.table({"row": words["row"], "code": coded.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    lang, source = pc.dictionary_encode(lang), pc.dictionary_encode(source)
    cells = pa.table({"lang": pc.take(lang.indices, per_row["row"]), "source": pc.take(source.indices, per_row["row"]),
                      "code": per_row["code"], "n": per_row["count_all"]})
    cells = cells.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table({"lang": pc.take(lang.dictionary, cells["lang"]), "source": pc.take(source.dictionary, cells["source"]),
                     "term": pc.take(coded.dictionary, cells["code"]), "n": cells["n_sum"], "docs": cells["count_all"]})


def _merged(tables):
    import pyarrow as pa

    out = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns(["lang", "source", "term", "n", "docs"]).cast(
        pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of every term of every group, from columns ``lang, source, text``."""
    slice_bytes, most = SLICE_BYTES, TASK_TERMS

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        held, rows = [], 0
        for batch in batches:
            lang, source, text = (pc.fill_null(batch.column(k).cast(pa.string()), "") for k in range(3))
            ends = pc.cumulative_sum(pc.add(pc.binary_length(text).cast(pa.int64()), 1)).to_numpy()
            start = 0
            while start < len(text):
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(ends.searchsorted(before + slice_bytes, side="right")))
                cells = count_batch(*(c.slice(start, stop - start) for c in (lang, source, text)))
                held.append(cells)
                rows += cells.num_rows
                start = stop
                if rows > 2 * most:
                    held = [_merged(held)]
                    rows = held[0].num_rows
                    if rows > most:
                        yield from held[0].to_batches(max_chunksize=50_000)
                        held, rows = [], 0
        if rows:
            yield from _merged(held).to_batches(max_chunksize=50_000)

    return docs.select("lang", "source", "text").mapInArrow(run, _COUNTS)


def _share(count: str, total: str, terms: str) -> str:
    """p = 1 + floor(1000000000 * (count + 2) / (N + 2 V)), exact at every size."""
    return f"1 + ((CAST({count} AS DECIMAL(19, 0)) + 2) * 1000000000 DIV (CAST({total} AS DECIMAL(19, 0)) + 2 * {terms}))"


def _pair_sums(cells, headers):
    """One shard: its part of the sum for every pair of its sources (lower name first)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = headers["source"].combine_chunks()
    order = pc.sort_indices(names)
    names, none = pc.take(names, order), pc.take(headers["p0"].combine_chunks(), order).to_numpy(zero_copy_only=False)
    row = pc.index_in(cells["source"].combine_chunks(), value_set=names).to_numpy(zero_copy_only=False)
    column = cells["term"].combine_chunks().dictionary_encode()
    p = np.repeat(none.astype(np.int64)[:, None], len(column.dictionary), axis=1)
    p[row, column.indices.to_numpy(zero_copy_only=False)] = cells["p"].to_numpy()
    a, b, value = [], [], []
    for i in range(len(p) - 1):
        q = p[i + 1:]
        d = q - p[i]
        value.append((d * d // (q + p[i])).sum(axis=1))
        a.append(np.full(len(q), i, np.int32))
        b.append(np.arange(i + 1, len(p), dtype=np.int32))
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    lang = headers["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pc.take(names, pa.array(a)).cast(pa.string()),
                     "b": pc.take(names, pa.array(b)).cast(pa.string()), "value": pa.array(value, pa.int64())})


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergence of every pair of sources, top terms of every source."""
    spark = df.sparkSession
    text_batches(spark)
    plain = df.select(*[F.col(c).cast("string").alias(n) for c, n in
                        ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    cells = staged(spark, term_counts(plain).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-cells")
    groups = plain.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()

    terms = (cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
             .where(F.col("docs") >= min_docs).drop("docs"))
    kept = staged(spark, cells.drop("docs").join(terms, ["lang", "term"]), "kept-cells")
    by_lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("S")).join(by_lang, "lang", "left")
    headers = staged(spark, groups.join(totals, ["lang", "source"], "left").join(langs, "lang").na.fill(
        0, ["total", "kept", "lang_total"]).withColumn("p0", F.expr(
            f"IF(kept = 0, 0L, {_share('0', 'total', 'kept')})")).withColumn("shards", F.expr(
                f"greatest(1L, CAST(ceil(S * kept / {SHARD_CELLS}.0D) AS LONG))")), "sources")
    shares = kept.join(headers, ["lang", "source"]).withColumn("p", F.expr(_share("n", "total", "kept")))

    # pairs: shards of (lang, hash of the term), each with every source's header
    shard = shares.where("S > 1").selectExpr("lang", "pmod(xxhash64(term), shards) AS shard", "source", "term", "p")
    heads = headers.where("S > 1").selectExpr("lang", "explode(sequence(0L, shards - 1)) AS shard", "source", "p0")
    parts = (shard.groupBy("lang", "shard").cogroup(heads.groupBy("lang", "shard"))
             .applyInArrow(_shard_pairs, "lang string, a string, b string, value long"))
    sums = staged(spark, parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pair-sums")
    pairs = sums.selectExpr("lang", "a AS source", "b AS item", "value").unionByName(
        sums.selectExpr("lang", "b AS source", "a AS item", "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))

    # terms: the source's share against the language's
    over = shares.withColumn("q", F.expr(_share("lang_n", "lang_total", "kept"))).where("p > q")
    best = over.selectExpr("lang", "source", "term AS item", "(p - q) * (p - q) DIV (p + q) AS value")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(best.select(columns))


def _shard_pairs(cells, headers):
    """A shard whose language has one source, or none, has no pairs."""
    import pyarrow as pa

    if headers.num_rows < 2:
        text = pa.array([], pa.string())
        return pa.table({"lang": text, "a": text, "b": text, "value": pa.array([], pa.int64())})
    return _pair_sums(cells, headers)


AUDIT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
cells AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row_id) AS docs FROM words GROUP BY ALL),
terms AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term HAVING sum(docs) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM terms GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT s.lang, s.source, t.term, t.n AS lang_n, coalesce(c.n, 0) AS n
  FROM sources s JOIN terms t USING (lang) LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.term = t.term),
shares AS (
  SELECT g.lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY g.lang, source) + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (total + 2 * v) AS q
  FROM grid g JOIN langs USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
best AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM best))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
