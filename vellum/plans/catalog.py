"""The reference operators as queries over the shared tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, metrics
from ..functions import text as tx
from ..operators import align, compose, experiments, guards, jobs, placement, routing
from ..sources import formats
from ..streaming import queue
from . import corpus as c

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PUA_RE, ZW_RE = "[^-]", "[​-‍﻿]"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def docs(spark: SparkSession, d: str) -> DataFrame:
    return c.load(spark, d, "documents")


# --- sources and gates

_HEADS = ["255044462D312E37", "89504E470D0A1A0A00", "FFD8FFE0", "49492A0008", "4D4D002A08", "68656C6C6F", ""]
_HEAD_SQL = " ".join(f"WHEN {k} THEN '{h}'" for k, h in enumerate(_HEADS))
_FMT_SQL = "CASE " + " ".join(f"WHEN starts_with(h, '{m}') THEN '{n}'" for m, n in formats.MAGIC.items()) + " END"


def _heads(spark: SparkSession, d: str) -> DataFrame:
    head = F.element_at(F.array(*map(F.lit, _HEADS)), (F.col("doc_id") % 7 + 1).cast("int"))
    return docs(spark, d).select("doc_id", "n_chars", F.unhex(head).alias("content"))


@query(f"SELECT fmt, count(*) AS n FROM (SELECT {_FMT_SQL} AS fmt FROM (SELECT CASE doc_id % 7 {_HEAD_SQL} END AS h FROM documents)) GROUP BY fmt")
def sniff_formats(spark: SparkSession, d: str) -> DataFrame:
    return _heads(spark, d).groupBy(formats.sniff(F.col("content")).alias("fmt")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, CASE WHEN n_chars = 0 OR fmt IS NULL THEN 415 WHEN n_chars > 3000 THEN 413 ELSE 202 END AS code FROM (SELECT doc_id, n_chars, {_FMT_SQL} AS fmt FROM (SELECT doc_id, n_chars, CASE doc_id % 7 {_HEAD_SQL} END AS h FROM documents))")
def ingest_gate(spark: SparkSession, d: str) -> DataFrame:
    return _heads(spark, d).select("doc_id", formats.gate(formats.sniff(F.col("content")), F.col("n_chars"), 3000).alias("code"))


@query("SELECT doc_id, sha256(text) AS sha256, length(sha256(text)) = 64 AS valid FROM documents")
def digests(spark: SparkSession, d: str) -> DataFrame:
    s = F.sha2(F.col("text").cast("binary"), 256)
    return docs(spark, d).select("doc_id", s.alias("sha256"), formats.valid_digest(s).alias("valid"))


_IAM = ["# comment", "", *(f"f{i // 3:02d}-u-{i % 3:02d} {'err' if i % 4 == 3 else 'ok'} 154 8 {100 + i} {700 + 90 * (i % 3)} {1500 - i} 60 A|move|{i}" for i in range(12))]


@query("SELECT * FROM (VALUES " + ", ".join(f"('f{k:02d}-u', '" + "' || chr(10) || '".join(f"A move {3 * k + j}" for j in range(3)) + f"', {100 + 3 * k}::INT, 700::INT, 1600::INT, 940::INT)" for k in range(4)) + ") t(form, text, x0, y0, x1, y1)")
def handwriting_forms(spark: SparkSession, d: str) -> DataFrame:
    raw = spark.createDataFrame([(x,) for x in _IAM], "value string")
    return formats.handwriting_forms(formats.handwriting_lines(raw))


# --- triage and routing

_SOLID = r"length(regexp_replace(text, '\s', '', 'g'))"


@query(c.with_sql("dirty") + f"SELECT doc_id, length(regexp_replace(text, '{ZW_RE}', '', 'g')) AS kept_chars, length(regexp_replace(text, '{PUA_RE}', '', 'g')) AS pua, {_SOLID} AS non_space, CASE WHEN {_SOLID} > 0 THEN length(regexp_replace(text, '{PUA_RE}', '', 'g')) / {_SOLID} <= 0.01 ELSE true END AS clean FROM dirty")
def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return c.dirty(spark, d).select("doc_id", F.length(tx.strip_zero_width(t)).cast("long").alias("kept_chars"), tx.private_use(t).cast("long").alias("pua"), tx.non_space(t).cast("long").alias("non_space"), tx.is_clean(t).alias("clean"))


@query(c.with_sql("dirty") + f"SELECT source, count(*) FILTER (pua > 0.01 * solid OR solid = 0) AS needs_ocr, count(*) AS pages FROM (SELECT source, length(regexp_replace(text, '{PUA_RE}', '', 'g')) AS pua, {_SOLID} AS solid FROM dirty) GROUP BY source")
def needs_ocr_pages(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    need = guards.needs_ocr(tx.non_space(t), tx.private_use(t), F.lit(1.0), F.lit(1.0), F.lit(0.0))
    return c.dirty(spark, d).select("source", need.alias("needs_ocr")).groupBy("source").agg(F.count_if("needs_ocr").alias("needs_ocr"), F.count("*").alias("pages"))


_RANGES = {"thai": "฀-๿", "cyrillic": "Ѐ-ӿ", "arabic": "؀-ۿ", "devanagari": "ऀ-ॿ", "cjk": "぀-ヿ一-鿿가-힯"}
_SC = ", ".join(f"length(regexp_replace(text, '[^{r}]', '', 'g')) AS {k}" for k, r in _RANGES.items()) + ", length(regexp_replace(text, '[^A-Za-zÀ-ɏ]', '', 'g')) AS latin"
_BEST = "greatest(" + ", ".join(_RANGES) + ")"
_FIRST_SEEN = "(list_sort([" + ", ".join(f"{{'n': -{k}, 'at': length(regexp_extract(text, '^[^{r}]*')), 'name': '{k}'}}" for k, r in _RANGES.items()) + "])[1]).name"
_SCRIPT_SQL = f"CASE WHEN {_BEST} > 0 AND {_BEST} >= 0.10 * (latin + {' + '.join(_RANGES)}) THEN {_FIRST_SEEN} ELSE 'latin' END"
_SCRIPTED = c.with_sql("dirty") + f", s AS (SELECT doc_id, lang, text, {_SC} FROM dirty), scripted AS (SELECT doc_id, lang, {_SCRIPT_SQL} AS script FROM s) "


def _scripted(spark: SparkSession, d: str) -> DataFrame:
    return c.dirty(spark, d).select("doc_id", "lang", tx.script(F.col("text")).alias("script"))


@query(_SCRIPTED + "SELECT doc_id, script FROM scripted")
def detect_script_docs(spark: SparkSession, d: str) -> DataFrame:
    return _scripted(spark, d).select("doc_id", "script")


@query(_SCRIPTED + "SELECT lang, script, count(*) AS n FROM scripted GROUP BY ALL")
def script_counts(spark: SparkSession, d: str) -> DataFrame:
    return _scripted(spark, d).groupBy("lang", "script").agg(F.count("*").alias("n"))


_ROUTE_SQL = ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in routing.ROUTES)


@query(_SCRIPTED + f", r AS (SELECT * FROM (VALUES {_ROUTE_SQL}) t(script, ocr_lang, reader, base_url, engine)) SELECT reader, engine, ocr_lang, count(*) AS n FROM (SELECT coalesce(r.ocr_lang, 'en') AS ocr_lang, CASE WHEN s.script = 'arabic' THEN 'special' ELSE r.reader END AS reader, coalesce(r.engine, 'paddle') AS engine FROM scripted s LEFT JOIN r ON s.script = r.script) GROUP BY ALL")
def route_resolution(spark: SparkSession, d: str) -> DataFrame:
    override = spark.createDataFrame([("arabic", "special")], "script string, reader string")
    met = routing.resolve(_scripted(spark, d), routing.routes(spark), override)
    return met.groupBy("reader", "engine", "ocr_lang").agg(F.count("*").alias("n"))


@query(_SCRIPTED + "SELECT script, CASE WHEN script IN ('latin', 'cjk') THEN 'rapidocr' WHEN script = 'thai' THEN 'apple_vision' END AS engine, count(*) AS n FROM scripted GROUP BY ALL")
def engine_choice(spark: SparkSession, d: str) -> DataFrame:
    pick = routing.auto_engine(F.col("script"), [("rapidocr", ["latin", "cjk"], True), ("apple_vision", ["latin", "thai"], True), ("other", ["arabic"], False)])
    return _scripted(spark, d).select("script", pick.alias("engine")).groupBy("script", "engine").agg(F.count("*").alias("n"))


# --- tokens and scores

_CJK = "぀-ヿｦ-ﾟ㐀-䶿一-鿿豈-﫿가-힯"
_TOK = f"regexp_extract_all({{}}, '[{_CJK}]|[^\\s{_CJK}]+')"


@query(c.with_sql("dirty") + f"SELECT doc_id, len({_TOK.format('text')}) AS n_tokens FROM dirty")
def word_tokens_count(spark: SparkSession, d: str) -> DataFrame:
    return c.dirty(spark, d).select("doc_id", F.size(tx.tokens(F.col("text"))).cast("long").alias("n_tokens"))


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    pairs = docs(spark, d).select("doc_id", "lang", "source", F.col("text").alias("ref"), c.confused("text").alias("hyp"))
    return metrics.bag_overlap(pairs, ["doc_id", "lang", "source"], "ref", "hyp")


_OVER = f"""tok AS (SELECT doc_id, lang, source, unnest({_TOK.format('text')}) AS w, 1 AS r, 0 AS h FROM documents
  UNION ALL SELECT doc_id, lang, source, unnest({_TOK.format("translate(text, 'oil', '01l')")}), 0, 1 FROM documents
  UNION ALL SELECT doc_id, lang, source, NULL, 0, 0 FROM documents),
cnt AS (SELECT doc_id, lang, source, w, sum(r) AS r, sum(h) AS h FROM tok GROUP BY ALL),
over AS (SELECT doc_id, lang, source, sum(least(r, h))::BIGINT AS overlap, sum(r)::BIGINT AS ref_words, sum(h)::BIGINT AS hyp_words FROM cnt GROUP BY ALL)"""


@query(f"WITH {_OVER} SELECT doc_id, overlap, ref_words, hyp_words FROM over")
def multiset_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).select("doc_id", "overlap", "ref_words", "hyp_words")


@query(f"WITH {_OVER} SELECT doc_id, overlap::DOUBLE / greatest(ref_words, 1)::DOUBLE AS word_recall, overlap::DOUBLE / greatest(hyp_words, 1)::DOUBLE AS word_precision, CASE WHEN overlap = 0 THEN 0.0 ELSE 2.0::DOUBLE * overlap / (ref_words + hyp_words) END::DOUBLE AS f1 FROM over")
def word_recall_precision(spark: SparkSession, d: str) -> DataFrame:
    f1 = F.when(F.col("overlap") == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.col("overlap") / (F.col("ref_words") + F.col("hyp_words")))
    return _overlaps(spark, d).select("doc_id", metrics.safe_ratio(F.col("overlap"), F.col("ref_words")).alias("word_recall"), metrics.safe_ratio(F.col("overlap"), F.col("hyp_words")).alias("word_precision"), f1.alias("f1"))


def _char_errors(spark: SparkSession, d: str) -> DataFrame:
    """Edit distance line by line: whole texts, and no table larger than a line squared."""
    cut = c.lines(spark, d).select("doc_id", metrics.distance(F.col("t"), c.confused("t")).alias("e"), F.length("t").cast("long").alias("n"))
    return cut.groupBy("doc_id").agg(F.sum("e").alias("char_errors"), F.sum("n").alias("ref_chars"))


_ERR = c.SQL["lines"] + ", err AS (SELECT doc_id, sum(levenshtein(t, translate(t, 'oil', '01l')))::BIGINT AS char_errors, sum(length(t))::BIGINT AS ref_chars FROM lines GROUP BY doc_id)"


@query(f"WITH {_ERR} SELECT * FROM err")
def char_distance_lines(spark: SparkSession, d: str) -> DataFrame:
    return _char_errors(spark, d)


_MICRO = "count(*) AS pages, sum(overlap)::DOUBLE / greatest(sum(greatest(ref_words, 1)), 1)::DOUBLE AS word_recall, sum(overlap)::DOUBLE / greatest(sum(greatest(hyp_words, 1)), 1)::DOUBLE AS word_precision, sum(char_errors)::DOUBLE / greatest(sum(greatest(ref_chars, 1)), 1)::DOUBLE AS cer"
_PAGE_NORM = r"trim(regexp_replace(nfc_normalize({}), '\s+', ' ', 'g'))"
_SCORED = c.with_sql("lines") + f""", pt AS (SELECT doc_id, ((ix - ix % 40) // 40)::INT AS pg, string_agg(t, chr(10) ORDER BY ix) AS ref FROM lines GROUP BY ALL),
pp AS (SELECT d.doc_id, coalesce(pg, 0) AS pg, lang, source, {_PAGE_NORM.format("coalesce(ref, '')")} AS ref FROM documents d LEFT JOIN pt USING (doc_id)),
ph AS (SELECT *, translate(ref, 'oil', '01l') AS hyp FROM pp),
tok AS (SELECT doc_id, pg, unnest({_TOK.format('ref')}) AS w, 1 AS r, 0 AS h FROM ph UNION ALL SELECT doc_id, pg, unnest({_TOK.format('hyp')}), 0, 1 FROM ph UNION ALL SELECT doc_id, pg, NULL, 0, 0 FROM ph),
cnt AS (SELECT doc_id, pg, w, sum(r) AS r, sum(h) AS h FROM tok GROUP BY ALL),
over AS (SELECT doc_id, pg, sum(least(r, h)) AS overlap, sum(r) AS ref_words, sum(h) AS hyp_words FROM cnt GROUP BY ALL),
scored AS (SELECT ph.lang, ph.source, over.*, levenshtein(ref, hyp) AS char_errors, length(ref) AS ref_chars FROM ph JOIN over ON over.doc_id = ph.doc_id AND over.pg = ph.pg) """


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Raw counts of every page, normalised; a document without lines is one blank page.  Pages are counted before they
    meet their documents, so that texts are shuffled once; the bags of rows that repeat a doc_id are one bag."""
    cut = c.lines(spark, d).select("doc_id", "ix", "t", ((F.col("ix") - F.col("ix") % 40) / 40).cast("int").alias("pg"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "t"))), lambda x: x["t"]), "\n")
    pages = cut.groupBy("doc_id", "pg").agg(text.alias("ref")).select("doc_id", "pg", tx.normalize(F.col("ref")).alias("ref")).withColumn("hyp", c.confused("ref"))
    counted = pages.select("doc_id", "pg", metrics.page_counts("ref", "hyp").alias("n")).select("doc_id", "pg", "n.*")
    copies = F.count("*").over(Window.partitionBy("doc_id"))
    told = docs(spark, d).filter("doc_id is not null").select("doc_id", "lang", "source", copies.alias("copies")).join(counted, "doc_id", "left")
    count = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    bags = [(count(x) * F.col("copies")).alias(x) for x in ("overlap", "ref_words", "hyp_words")]
    return told.select("doc_id", F.coalesce("pg", F.lit(0)).alias("pg"), "lang", "source", *bags, *(count(x).alias(x) for x in ("char_errors", "ref_chars")))


@query(_SCORED + f"SELECT lang, {_MICRO} FROM scored GROUP BY ROLLUP (lang)")
def scorecard_rollup_lang(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).rollup("lang").agg(*metrics.micro())


@query(_SCORED + f"SELECT {_MICRO} FROM scored")
def scorecard_micro(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).agg(*metrics.micro())


@query(_SCORED + f"SELECT lang, source, {_MICRO} FROM scored GROUP BY GROUPING SETS ((lang, source), (lang))")
def grouping_sets_scores(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored(spark, d)
    return scored.groupingSets([[F.col("lang"), F.col("source")], [F.col("lang")]], "lang", "source").agg(*metrics.micro())


@query("SELECT lang, median(n_chars)::DOUBLE AS median_chars, quantile_disc(n_chars, 0.1)::DOUBLE AS p10, quantile_disc(n_chars, 0.9)::DOUBLE AS p90 FROM documents GROUP BY lang")
def median_p90_chars(spark: SparkSession, d: str) -> DataFrame:
    disc = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n_chars)").cast("double")
    return docs(spark, d).groupBy("lang").agg(F.median("n_chars").cast("double").alias("median_chars"), disc(0.1).alias("p10"), disc(0.9).alias("p90"))


@query("SELECT lang, quality, avg(n_chars)::DOUBLE AS mean_chars, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def mean_by_quality(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).join(c.load(spark, d, "labels"), "doc_id").groupBy("lang", "quality").agg(F.avg("n_chars").alias("mean_chars"), F.count("*").alias("n"))


@query(r"""WITH ch AS (SELECT doc_id, ch, count(*) AS k FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\s', '', 'g'), '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ALL),
c2 AS (SELECT doc_id, sum(k) >= 200 AND (max(k) >= 0.9 * sum(k) OR count(*) <= 3) AS by_char FROM ch GROUP BY 1),
w AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\S+')) AS w FROM documents) GROUP BY ALL),
w2 AS (SELECT doc_id, sum(k) >= 40 AND (max(k) >= 0.4 * sum(k) OR count(*) < 0.1 * sum(k)) AS by_word FROM w GROUP BY 1)
SELECT doc_id, coalesce(by_char, false) AS by_char, coalesce(by_word, false) AS by_word FROM documents LEFT JOIN c2 USING (doc_id) LEFT JOIN w2 USING (doc_id)""")
def degenerate_repetition(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", guards.flooded(F.col("text")).alias("by_char"), guards.looping(F.col("text")).alias("by_word"))


@query("SELECT doc_id, replace(replace(replace(replace(lower(text), 'ß', 'ss'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS folded FROM documents")
def casefold_escape(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", tx.escape_html(tx.casefold(F.col("text"))).alias("folded"))


# --- composition

_CLOSE = c.IOU.format(a="o", b="l") + " >= 0.5"
_SUP = c.with_sql("lines", "tl", "ocr") + f", sup AS (SELECT o.* FROM ocr o WHERE EXISTS (SELECT 1 FROM tl l WHERE l.doc_id = o.doc_id AND l.pg = o.pg AND NOT l.contaminated AND {_CLOSE})) "


@query(_SUP + "SELECT doc_id, pg, ix FROM sup")
def iou_semi_superseded(spark: SparkSession, d: str) -> DataFrame:
    return compose.superseded(c.detected(spark, d), c.text_layer(spark, d)).select("doc_id", "pg", "ix")


@query(_SUP + f"SELECT l.doc_id, l.pg, l.ix FROM tl l WHERE l.contaminated AND EXISTS (SELECT 1 FROM ocr o WHERE l.doc_id = o.doc_id AND l.pg = o.pg AND {_CLOSE} AND (o.doc_id, o.ix) NOT IN (SELECT (doc_id, ix) FROM sup))")
def contaminated_superseded(spark: SparkSession, d: str) -> DataFrame:
    return compose.contaminated_superseded(c.detected(spark, d), c.text_layer(spark, d)).select("doc_id", "pg", "ix")


_COV = c.with_sql("lines", "tl", "regions") + ", cov AS (SELECT r.doc_id, r.pg, r.rix, r.kind, least(1.0, coalesce(sum(greatest(0.0, least(r.x1, l.x1) - greatest(r.x0, l.x0)) * greatest(0.0, least(r.y1, l.y1) - greatest(r.y0, l.y0))), 0.0) / ((r.x1 - r.x0) * (r.y1 - r.y0)))::DOUBLE AS coverage FROM regions r LEFT JOIN tl l ON l.doc_id = r.doc_id AND l.pg = r.pg AND NOT l.contaminated GROUP BY r.doc_id, r.pg, r.rix, r.kind, r.x0, r.y0, r.x1, r.y1) "


@query(_COV + "SELECT *, CASE WHEN coverage >= 0.5 THEN 'textlayer' ELSE 'ocr' END AS region_source FROM cov")
def region_coverage(spark: SparkSession, d: str) -> DataFrame:
    return compose.region_coverage(c.regions(spark, d), c.text_layer(spark, d))


_FIRST = c.with_sql("lines", "ocr", "regions") + ", fr AS (SELECT o.*, coalesce(x.region, -1)::INT AS region FROM ocr o LEFT JOIN (SELECT o.doc_id, o.ix, min(rix) AS region FROM ocr o JOIN regions r ON o.doc_id = r.doc_id AND o.pg = r.pg AND (o.x0 + o.x1) / 2 BETWEEN r.x0 AND r.x1 AND (o.y0 + o.y1) / 2 BETWEEN r.y0 AND r.y1 GROUP BY 1, 2) x ON x.doc_id = o.doc_id AND x.ix = o.ix), ro AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, pg ORDER BY CASE WHEN region < 0 THEN 1000000 ELSE region END, round_even(y0 / 5.0, 0), x0, ix) - 1)::INT AS rank FROM fr) "


def _ordered(spark: SparkSession, d: str) -> DataFrame:
    return compose.reading_order(compose.first_region(c.detected(spark, d), c.regions(spark, d)))


@query(_FIRST + "SELECT doc_id, pg, ix, region FROM fr")
def first_region_lookup(spark: SparkSession, d: str) -> DataFrame:
    return compose.first_region(c.detected(spark, d), c.regions(spark, d)).select("doc_id", "pg", "ix", "region")


@query(_FIRST + "SELECT doc_id, pg, ix, rank FROM ro")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return _ordered(spark, d).select("doc_id", "pg", "ix", "rank")


@query(_FIRST + "SELECT doc_id, pg, string_agg(det_text, chr(10) ORDER BY rank) AS page_text, count(*) AS n_lines FROM ro GROUP BY ALL")
def gated_text(spark: SparkSession, d: str) -> DataFrame:
    return compose.page_text(_ordered(spark, d))


_CELL = c.with_sql("lines", "ocr", "regions") + """, m AS (SELECT r.doc_id, r.pg, r.rix, o.ix, o.x0, o.y0, o.det_text,
  greatest(0.0, least(r.x1, o.x1) - greatest(r.x0, o.x0)) * greatest(0.0, least(r.y1, o.y1) - greatest(r.y0, o.y0)) AS common, greatest((o.x1 - o.x0) * (o.y1 - o.y0), 1.0) AS own,
  (o.x0 + o.x1) / 2 BETWEEN r.x0 AND r.x1 AND (o.y0 + o.y1) / 2 BETWEEN r.y0 AND r.y1 AS inside FROM regions r LEFT JOIN ocr o ON r.doc_id = o.doc_id AND r.pg = o.pg)
SELECT doc_id, pg, rix, trim(coalesce(string_agg(det_text, ' ' ORDER BY round_even(y0 / 5.0, 0), x0, ix) FILTER (inside), '')) AS cell_text, count(*) FILTER (common >= 0.1 * own) AS touching,
  CASE WHEN count(*) FILTER (common >= 0.1 * own) = 0 THEN 'empty' WHEN min(common / own) FILTER (common >= 0.1 * own) < 0.7 THEN 'spanning' ELSE 'clean' END AS confidence FROM m GROUP BY ALL"""


@query(_CELL)
def cell_confidence(spark: SparkSession, d: str) -> DataFrame:
    return compose.cell_confidence(c.regions(spark, d), c.detected(spark, d))


_TABLES = ", t AS (SELECT doc_id, pg, rix AS tix, x0 + (doc_id % 5) * 30 AS x0, y0 + (rix % 3) * 25 AS y0, x1 + (doc_id % 5) * 30 AS x1, y1 + (rix % 3) * 25 AS y1 FROM regions)"


@query(c.with_sql("lines", "regions") + _TABLES + ", f AS (SELECT r.doc_id, r.pg, r.rix, t.tix, (greatest(0.0, least(r.x1, t.x1) - greatest(r.x0, t.x0)) * greatest(0.0, least(r.y1, t.y1) - greatest(r.y0, t.y0)) / greatest(least((r.x1 - r.x0) * (r.y1 - r.y0), (t.x1 - t.x0) * (t.y1 - t.y0)), 1.0))::DOUBLE AS share FROM regions r JOIN t ON r.doc_id = t.doc_id AND r.pg = t.pg) SELECT * FROM (SELECT * FROM f WHERE share > 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id, pg, rix ORDER BY share DESC, tix) = 1) WHERE tix % 3 <> 1")
def best_table_argmax(spark: SparkSession, d: str) -> DataFrame:
    r = c.regions(spark, d)
    dx, dy = (F.col("doc_id") % 5) * 30, (F.col("rix") % 3) * 25
    tables = r.select("doc_id", "pg", F.col("rix").alias("tix"), F.when(F.col("rix") % 3 == 1, "<table></table>").otherwise("<td></td>").alias("html"), (F.col("x0") + dx).alias("x0"), (F.col("y0") + dy).alias("y0"), (F.col("x1") + dx).alias("x1"), (F.col("y1") + dy).alias("y1"))
    return compose.best_table(r, tables)


# --- placement

_PLACE = c.with_sql("lines", "tl", "ocr") + ", iou AS (SELECT o.doc_id, o.pg, o.ix, l.ix AS line, o.det_text, " + c.IOU.format(a="o", b="l") + " AS iou FROM ocr o JOIN tl l ON o.doc_id = l.doc_id AND o.pg = l.pg), strict AS (SELECT * FROM iou WHERE iou >= 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id, pg, ix ORDER BY iou DESC, line DESC) = 1), band AS (SELECT o.doc_id, o.pg, o.ix, l.ix AS line, o.det_text FROM ocr o JOIN tl l ON o.doc_id = l.doc_id AND o.pg = l.pg AND least(o.y1, l.y1) - greatest(o.y0, l.y0) >= 0.5 * (l.y1 - l.y0) AND least(o.x1, l.x1) > greatest(o.x0, l.x0)) "


def _counted(name: str) -> str:
    return f", bag AS (SELECT doc_id, pg, ix AS line, unnest({_TOK.format('t')}) AS w FROM tl), own AS (SELECT DISTINCT doc_id, pg, line, unnest({_TOK.format('det_text')}) AS w FROM {name}), any_ AS (SELECT DISTINCT doc_id, pg, unnest({_TOK.format('det_text')}) AS w FROM ocr), pc AS (SELECT b.doc_id, b.pg, count(o.w) AS placed, count(a.w) AS plain, count(*) AS total FROM bag b LEFT JOIN own o ON b.doc_id = o.doc_id AND b.pg = o.pg AND b.line = o.line AND b.w = o.w LEFT JOIN any_ a ON a.doc_id = b.doc_id AND a.pg = b.pg AND a.w = b.w GROUP BY 1, 2) "


@query(_PLACE + _counted("strict") + "SELECT * FROM pc")
def placement_strict(spark: SparkSession, d: str) -> DataFrame:
    o, t = c.detected(spark, d), c.text_layer(spark, d)
    return placement.counts(placement.strict(o, t), o, t)


@query(_PLACE + _counted("band") + "SELECT * FROM pc")
def placement_band(spark: SparkSession, d: str) -> DataFrame:
    o, t = c.detected(spark, d), c.text_layer(spark, d)
    return placement.counts(placement.band(o, t), o, t)


@query(_PLACE + _counted("strict") + "SELECT sum(placed)::DOUBLE / greatest(sum(total), 1)::DOUBLE AS placement_recall, sum(plain)::DOUBLE / greatest(sum(total), 1)::DOUBLE AS plain_recall, (sum(plain) - sum(placed))::DOUBLE / greatest(sum(total), 1)::DOUBLE AS gap FROM pc")
def placement_summary(spark: SparkSession, d: str) -> DataFrame:
    return placement.summary(placement_strict(spark, d))


# --- experiments

_ARM = c.with_sql("scores") + ", arm AS (SELECT source, threshold, sum(hits)::DOUBLE / greatest(sum(n_chars), 1)::DOUBLE AS recall, count(*) AS n FROM scores GROUP BY ALL), dl AS (SELECT a.source, a.threshold, a.recall, a.recall - b.recall AS delta FROM arm a JOIN arm b ON a.source = b.source AND b.threshold = 0) "


@query(_ARM + "SELECT * FROM dl")
def delta_vs_baseline(spark: SparkSession, d: str) -> DataFrame:
    return experiments.deltas(experiments.by_arm(c.scores(spark, d)))


@query(_ARM + "SELECT threshold, max(abs(delta)) AS max_abs_delta, CASE WHEN max(abs(delta)) < 0.005 THEN 'benign' WHEN max(abs(delta)) >= 0.02 THEN 'load-bearing' ELSE 'mild' END AS verdict, bool_or(delta > 0) AND bool_or(delta < 0) AS opposed FROM dl WHERE threshold > 0 GROUP BY threshold")
def sweep_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return experiments.verdicts(delta_vs_baseline(spark, d))


@query(c.with_sql("scores") + "SELECT s.threshold, row_number() OVER (PARTITION BY s.threshold ORDER BY b.hits - s.hits DESC, s.doc_id)::INT AS rank, s.doc_id, b.hits - s.hits AS loss FROM scores s JOIN scores b ON s.doc_id = b.doc_id AND b.threshold = 0 WHERE s.threshold > 0 QUALIFY rank <= 5")
def worst5_per_threshold(spark: SparkSession, d: str) -> DataFrame:
    return experiments.worst_items(c.scores(spark, d))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT (SELECT greatest(1, count(*) // 10) FROM documents)")
def bottom_decile(spark: SparkSession, d: str) -> DataFrame:
    return experiments.bottom_share(docs(spark, d).select("doc_id", "n_chars"), "n_chars", "doc_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def todo_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return experiments.todo(docs(spark, d).select("doc_id", "source"), c.load(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def shared_intersect(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id").intersect(c.load(spark, d, "labels").select("doc_id"))


@query("SELECT 'doc' AS kind, doc_id AS id, length(text) AS n FROM documents UNION ALL SELECT 'page', page_id, length(html) FROM pages")
def pooled_union(spark: SparkSession, d: str) -> DataFrame:
    a = docs(spark, d).select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.length("text").cast("long").alias("n"))
    return a.unionByName(c.load(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.length("html").cast("long").alias("n")))


@query(c.with_sql("lines") + "SELECT t FROM lines WHERE doc_id % 2 = 0 INTERSECT ALL SELECT t FROM lines WHERE doc_id % 2 = 1")
def multiset_intersect_all(spark: SparkSession, d: str) -> DataFrame:
    cut = c.lines(spark, d)
    return cut.filter("doc_id % 2 = 0").select("t").intersectAll(cut.filter("doc_id % 2 = 1").select("t"))


@query("SELECT doc_id, lang FROM documents ORDER BY sha256('17:' || doc_id::VARCHAR) LIMIT 50")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return experiments.sample(docs(spark, d).select("doc_id", "lang"), "doc_id", 17, 50)


_TURNS = f"tt AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before_role FROM conversations), pr AS (SELECT * FROM tt WHERE role = 'assistant' AND before_role = 'user'), tk AS (SELECT conv_id, turn, unnest({_TOK.format('before')}) AS w, 1 AS r, 0 AS h FROM pr UNION ALL SELECT conv_id, turn, unnest({_TOK.format('text')}), 0, 1 FROM pr UNION ALL SELECT conv_id, turn, NULL, 0, 0 FROM pr), ct AS (SELECT conv_id, turn, w, sum(r) AS r, sum(h) AS h FROM tk GROUP BY ALL)"


@query(f"WITH {_TURNS} SELECT conv_id, turn, sum(least(r, h))::BIGINT AS overlap, CASE WHEN sum(least(r, h)) = 0 THEN 0.0 ELSE 2.0::DOUBLE * sum(least(r, h)) / (sum(r) + sum(h)) END AS f1 FROM ct GROUP BY ALL")
def word_f1_turns(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    told = c.load(spark, d, "conversations").withColumn("before", F.lag("text").over(w)).withColumn("before_role", F.lag("role").over(w))
    pairs = told.filter("role = 'assistant' and before_role = 'user'").select("conv_id", "turn", F.col("before").alias("ref"), F.col("text").alias("hyp"))
    over = metrics.bag_overlap(pairs, ["conv_id", "turn"], "ref", "hyp")
    return over.select("conv_id", "turn", "overlap", F.when(F.col("overlap") == 0, 0.0).otherwise(F.lit(2.0) * F.col("overlap") / (F.col("ref_words") + F.col("hyp_words"))).alias("f1"))


# --- jobs and streams

_LOG = "log AS (SELECT sha256(user_id::VARCHAR) AS sha256, event_id, ts, CASE event_type WHEN 'signup' THEN 'queued' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'error' END AS event FROM events WHERE event_type IN ('signup', 'view', 'purchase', 'error'))"


@query(f"WITH {_LOG} SELECT sha256, arg_max(event, (ts, event_id)) AS status, max(ts) AS updated_at, count(*) AS n_events FROM log GROUP BY sha256")
def job_latest_status(spark: SparkSession, d: str) -> DataFrame:
    return jobs.latest(jobs.event_log(c.load(spark, d, "events")))


_MOVE = "CASE WHEN s.status = '' AND l.event = 'queued' THEN 'queued' WHEN s.status IN ('queued', 'done', 'error') AND l.event = 'running' THEN 'running' WHEN s.status = 'running' AND l.event IN ('done', 'error') THEN l.event ELSE s.status END"


@query(f"WITH RECURSIVE {_LOG}, o AS (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY ts, event_id) AS k FROM log), s AS (SELECT DISTINCT sha256, 0::BIGINT AS k, '' AS status, 0 AS moves FROM o UNION ALL SELECT l.sha256, l.k, {_MOVE}, s.moves + CASE WHEN {_MOVE} <> s.status THEN 1 ELSE 0 END FROM s JOIN o l ON l.sha256 = s.sha256 AND l.k = s.k + 1) SELECT sha256, arg_max(status, k) AS status, arg_max(moves, k)::INT AS moves FROM s GROUP BY sha256")
def job_state_machine(spark: SparkSession, d: str) -> DataFrame:
    return jobs.folded(jobs.event_log(c.load(spark, d, "events")))


@query(f"WITH {_LOG} SELECT event AS status, count(*) AS n, count(DISTINCT sha256) AS jobs, max(ts) AS newest FROM log GROUP BY event")
def job_feed(spark: SparkSession, d: str) -> DataFrame:
    return jobs.event_log(c.load(spark, d, "events")).groupBy(F.col("event").alias("status")).agg(F.count("*").alias("n"), F.countDistinct("sha256").alias("jobs"), F.max("ts").alias("newest"))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS starts, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_events(spark: SparkSession, d: str) -> DataFrame:
    return queue.tumbling(c.load(spark, d, "events"))


# --- order-dependent algorithms: checked by pytest goldens


@query()
def line_clusters(spark: SparkSession, d: str) -> DataFrame:
    return align.line_clusters(c.detected(spark, d))


@query()
def fused_lines(spark: SparkSession, d: str) -> DataFrame:
    return align.fuse_pages(c.detected(spark, d), c.readings(spark, d), c.regions(spark, d))


def _box_join(spark: SparkSession, d: str) -> DataFrame:
    return c.detected(spark, d).select("doc_id", "pg", "ix", geometry.area(geometry.box()).alias("area"))


@query(c.with_sql("lines", "ocr") + "SELECT doc_id, pg, ix, (x1 - x0) * (y1 - y0) AS area FROM ocr")
def segment_areas(spark: SparkSession, d: str) -> DataFrame:
    return _box_join(spark, d)


from . import reports  # noqa: E402, F401  (adds its queries)
