"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text yields whole counts (words, word characters, symbols, repeated lines, words in
repeated windows).  Four ratios of them are put into log-linear buckets (exact below 64,
then 32 to an octave, at most 1/32 too low).  Counts per (lang, source, measure, bucket) are
a quantile sketch that merges by addition, so the aggregation combines before the shuffle and
a hot source costs no more than a small one.  Quartiles of each group's sketch give
its fences: q3 + 3 (q3 - q1) + slack above, and for word length also one below.  A group of fewer
than ``least`` documents takes the sketch of its language, then that of all documents.

Cases: null or blank text has no words and fails the base rule; null lang or source is a group
of its own; repeated rows count and return one row each; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, let, materialize, words

LEAST = 50
SPREAD = 3
WINDOW = 8
#: Slack in the measure's own unit, so that a group without any spread still allows a little.
SLACK = {"symbol": 40, "length": 100, "repeat": 300, "lines": 60}
SALTS = 16
#: Threshold rows that may be broadcast; beyond it the join is salted instead.
BROADCAST_ROWS = 50_000


def _repeat_words(ws: Column) -> Column:
    """Words covered by windows that occur twice or more."""
    # A window's hash by doubling: words, pairs, fours, eights.
    wider = lambda k: lambda hs: F.transform(hs, lambda h, i: F.xxhash64(h, F.get(hs, i + k)))
    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    for k in (1, 2, 4):
        hashes = let(hashes, wider(k))
    hashes = F.slice(hashes, F.lit(1), F.size(ws) - (WINDOW - 1))

    def covered(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ps: Column) -> Column:
            same = lambda p, k: F.coalesce(F.get(ps, k)["h"] == p["h"], F.lit(False))
            twice = F.filter(ps, lambda p, k: same(p, k - 1) | same(p, k + 1))
            return F.array_sort(F.transform(twice, lambda p: p["i"]))

        reach = lambda at: F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"].cast("long"),
        )
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(let(let(pairs, starts), reach))

    return F.when(F.size(ws) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def _counts(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    dup = let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))

    def of(ws: Column) -> Column:
        return let(
            F.array_join(ws, ""),
            lambda joined: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.length(joined).cast("long").alias("word_chars"),
                (F.length(joined) - F.length(F.regexp_replace(joined, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
                dup.alias("n_dup_lines"),
                _repeat_words(ws).alias("n_repeat_words"),
            ),
        )

    return let(words(text), of)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(docs: DataFrame, keep: list[str], into: str = "_q") -> DataFrame:
    """``keep`` columns and a struct ``into`` of the counts and ``base_failed``."""
    # A generator is computed once per row, where a plain column would be copied into each use of its fields.
    measured = docs.select(*keep, F.explode(F.array(_counts(F.col("text")))).alias(into))
    failed = (F.col(f"{into}.n_words") < 20) | (F.col(f"{into}.n_repeat_words") * 100 > F.col(f"{into}.n_words") * 30)
    return measured.withColumn(into, F.col(into).withField("base_failed", failed))


def measures(q: str = "_q") -> dict[str, Column]:
    c = lambda n: F.col(f"{q}.{n}")
    per = lambda k, a, b: F.floor(k * c(a) / F.greatest(c(b), F.lit(1))).cast("long")
    return {"symbol": per(1000, "n_symbols", "word_chars"), "length": per(100, "word_chars", "n_words"), "repeat": per(1000, "n_repeat_words", "n_words"), "lines": per(1000, "n_dup_lines", "n_words")}


def bucket(x: Column) -> Column:
    """Lower edge of the log-linear bucket of a whole number."""
    shift = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return x - x % step


def sketch(counted: DataFrame, q: str = "_q") -> DataFrame:
    """(lang, source, measure, bucket, n): mergeable by adding n."""
    rows = F.array(*(F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in measures(q).items()))
    flat = counted.filter(~F.col(f"{q}.base_failed")).select("lang", "source", F.explode(rows).alias("m"))
    return flat.groupBy("lang", "source", F.col("m.measure").alias("measure"), F.col("m.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def _quartiles(merged: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles of each sketch; a sketch has some hundred buckets at most, whatever the input."""
    w = Window.partitionBy(*by, "measure")
    seen = merged.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    seen = seen.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("all", F.sum("n").over(w))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bucket")))
    return seen.groupBy(*by, "measure").agg(F.max("all").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def thresholds(sketched: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per (lang, source): the fences of each measure."""
    own = _quartiles(sketched, ["lang", "source"])
    lang = _quartiles(sketched, ["lang"]).select(F.col("lang").alias("l2"), F.col("measure").alias("m2"), *(F.col(c).alias(f"{c}_lang") for c in ("n", "q1", "q3")))
    total = _quartiles(sketched, []).select(F.col("measure").alias("m3"), *(F.col(c).alias(f"{c}_all") for c in ("q1", "q3")))
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("l2")) & (F.col("measure") == F.col("m2")))
    both = both.join(total, F.col("measure") == F.col("m3"))
    pick = lambda c: F.when(F.col("n") >= least, F.col(c)).when(F.col("n_lang") >= least, F.col(f"{c}_lang")).otherwise(F.col(f"{c}_all"))
    slack = F.create_map(*(F.lit(x) for kv in SLACK.items() for x in kv))
    fence = SPREAD * (pick("q3") - pick("q1")) + slack[F.col("measure")]
    fences = both.select("lang", "source", "measure", (pick("q3") + fence).alias("hi"), (pick("q1") - fence).alias("lo"))
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    return fences.groupBy("lang", "source").agg(*(of(m, "hi").alias(f"hi_{m}") for m in SLACK), of("length", "lo").alias("lo_length"))


def _judged(counted: DataFrame, limits: DataFrame, q: str = "_q", into: str = "_kept") -> DataFrame:
    """``counted`` with a boolean column ``into``."""
    own = dict(zip(limits.columns, free_names([*counted.columns, into], *(f"_t_{c}" for c in limits.columns))))
    limits = limits.withColumnsRenamed(own)
    salt, salt_t = free_names([*counted.columns, into, *limits.columns], "_salt", "_t_salt")
    same = F.col("lang").eqNullSafe(F.col(own["lang"])) & F.col("source").eqNullSafe(F.col(own["source"]))
    if limits.count() <= BROADCAST_ROWS:
        joined = counted.join(F.broadcast(limits), same, "left")
    else:
        salted = limits.withColumn(salt_t, F.explode(F.array([F.lit(i).cast("long") for i in range(SALTS)])))
        joined = counted.withColumn(salt, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(salted, same & (F.col(salt) == F.col(salt_t)), "left").drop(salt, salt_t)
    m = measures(q)
    inside = F.lit(True)
    for k in SLACK:
        inside = inside & (m[k] <= F.coalesce(F.col(own[f"hi_{k}"]), F.lit(1 << 60)))
    inside = inside & (m["length"] >= F.coalesce(F.col(own["lo_length"]), F.lit(0)))
    kept = ~F.col(f"{q}.base_failed") & inside
    return joined.withColumn(into, kept).drop(*limits.columns)


def quality_table(docs: DataFrame) -> DataFrame:
    """Counts and verdict per document; texts are read once, the narrow counts are written and reread."""
    counted = materialize(base_counts(docs, ["doc_id", "lang", "source"]), "rules")
    limits = materialize(thresholds(sketch(counted)), "rules-limits")
    judged = _judged(counted, limits)
    return judged.select("doc_id", *(F.col(f"_q.{c}").alias(c) for c in COUNTS), F.col("_q.base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """Documents that pass, all columns kept.  Texts are measured twice (once for the sketch, once for the
    verdict), so that they need not be shuffled to meet it."""
    limits = materialize(thresholds(sketch(base_counts(docs, ["doc_id", "lang", "source"]))), "rules-limits")
    q, into = free_names(docs.columns, "_q", "_kept")
    judged = _judged(base_counts(docs, list(docs.columns), q), limits, q, into)
    return judged.filter(F.col(into)).select(*docs.columns)


_FENCE = "3 * (%s3 - %s1) + CASE measure WHEN 'symbol' THEN 40 WHEN 'length' THEN 100 WHEN 'repeat' THEN 300 ELSE 60 END"
ORACLE = """
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
wh AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k FROM win),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM wh),
gap AS (SELECT rid, least(8, i - coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -8)) AS g FROM rep WHERE c >= 2),
cov AS (SELECT rid, sum(g)::BIGINT AS n FROM gap GROUP BY rid),
b AS (
  SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
     - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON w.rid = cov.rid),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    1000 * n_symbols // greatest(word_chars, 1) AS m_symbol, 100 * word_chars // greatest(n_words, 1) AS m_length,
    1000 * n_repeat_words // greatest(n_words, 1) AS m_repeat, 1000 * n_dup_lines // greatest(n_words, 1) AS m_lines FROM b),
v AS (
  SELECT lang, source, measure, x - x % (1::BIGINT << greatest(length(bin(x)) - 6, 0)::BIGINT) AS bucket FROM (
    SELECT lang, source, 'symbol' AS measure, m_symbol AS x FROM f WHERE NOT base_failed UNION ALL
    SELECT lang, source, 'length', m_length FROM f WHERE NOT base_failed UNION ALL
    SELECT lang, source, 'repeat', m_repeat FROM f WHERE NOT base_failed UNION ALL
    SELECT lang, source, 'lines', m_lines FROM f WHERE NOT base_failed)),
own AS (SELECT lang, source, measure, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM v GROUP BY ALL),
ln AS (SELECT lang, measure, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM v GROUP BY ALL),
al AS (SELECT measure, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM v GROUP BY ALL),
p AS (SELECT own.lang, own.source, own.measure,
    CASE WHEN own.n >= 50 THEN own.q1 WHEN ln.n >= 50 THEN ln.q1 ELSE al.q1 END AS q1,
    CASE WHEN own.n >= 50 THEN own.q3 WHEN ln.n >= 50 THEN ln.q3 ELSE al.q3 END AS q3
  FROM own JOIN ln ON own.lang IS NOT DISTINCT FROM ln.lang AND own.measure = ln.measure JOIN al ON own.measure = al.measure),
t AS (SELECT lang, source, measure, q3 + FENCE AS hi, q1 - (FENCE) AS lo FROM p),
tt AS (SELECT lang, source, max(hi) FILTER (measure = 'symbol') AS hs, max(hi) FILTER (measure = 'length') AS hl,
    max(hi) FILTER (measure = 'repeat') AS hr, max(hi) FILTER (measure = 'lines') AS hd, max(lo) FILTER (measure = 'length') AS ll FROM t GROUP BY ALL)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(m_symbol <= hs, true) AND coalesce(m_length <= hl, true) AND coalesce(m_repeat <= hr, true)
    AND coalesce(m_lines <= hd, true) AND coalesce(m_length >= ll, m_length >= 0) AS kept
FROM f LEFT JOIN tt ON f.lang IS NOT DISTINCT FROM tt.lang AND f.source IS NOT DISTINCT FROM tt.source
""".replace("FENCE", _FENCE.replace("%s", "q"))
