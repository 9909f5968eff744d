"""Personal data: fixed patterns, and contextual extraction bootstrapped from them.

The four base kinds are matched natively; what a match leaves over on either side comes from
splitting by the same pattern, which gives positions without any marker in the text.

Their spans seed the bootstrap, and so do tokens that look like keys (20 letters and digits or more, mixed), with a
prior below certainty.  Every token with a digit or an at sign is an instance, and so are up to PARTS adjacent ones of a
number written with spaces.  An instance's patterns are the two words before it; the word before it if that ends
like a label (: = #), with the classes of characters in the instance; and the words on either side, with those classes.
Patterns and instances form a bipartite graph that is scored until nothing changes: a pattern's
score is the mean score of its distinct instances, damped for few; an instance that is no
seed gets one minus the product of its confident patterns' doubts.  Patterns need ``support`` distinct known
instances and ``confidence``; instances that reach it become known for the next round.  New spans
are of kind ``id``.  Texts are read once; the graph holds ids, contexts and tokens only.

Positions are running sums taken in blocks, and pieces of a text are cut from blocks of it, so that the work on one
text grows with its length and not with its square.

Cases: null text is empty and has no spans; repeated rows are found alike and returned each; overlapping
spans of different kinds all count and are masked as one; tables without seeds discover nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, free_names, let, materialize, scratch

#: Possessive and anchored at the start of a run, so that no text takes more than linear time; the matches
#: are those of the plain pattern.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "id")
#: Stands for each character of a base span where tokens are looked for, and what the character itself becomes there.
COVER, COVERED = "\uE000", "\uE001"
_GAP = r"\x20\x09-\x0D"
_LOOSE = rf"[^{_GAP}@{COVER}0-9]*+[0-9][^{_GAP}@{COVER}]*+(?![^{_GAP}])"
#: Tokens of one number written with spaces, at most.
PARTS = 8
TOKEN = rf"(?<![^{_GAP}])(?:{_LOOSE}(?:(?<![.,;:!?])[\x20\x09]++{_LOOSE}){{0,{PARTS - 1}}}+|[^{_GAP}0-9@{COVER}]*+[0-9@{COVER}][^{_GAP}]*+)"
#: What looks like a key or secret, and how sure that is.
SECRET, PRIOR = r"^(?=(?:[^0-9]*[0-9]){4})(?=(?:[^A-Za-z]*[A-Za-z]){4})[A-Za-z0-9+=]{20,}$", 0.95
SUPPORT, CONFIDENCE, DAMPING = 3, 0.7, 0.5
#: Rounds after which scoring that has not settled is an error.
MOST_ROUNDS = 50
SALTS = 8
SPANS = "array<struct<k:string,s:int,e:int>>"
BLOCK, PIECE = 64, 1024


def running(xs: Column, join) -> Column:
    """Inclusive running combination of an array<int>, block by block."""
    nothing = F.array().cast("array<int>")

    def plain(ys: Column) -> Column:
        return F.aggregate(ys, nothing, lambda acc, y: F.concat(acc, F.array(F.when(F.size(acc) == 0, y).otherwise(join(F.element_at(acc, -1), y)))))

    def whole(ys: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ys) - 1) / BLOCK).cast("int")), lambda k: plain(F.slice(ys, k * BLOCK + 1, F.lit(BLOCK))))

        def together(bs: Column) -> Column:
            upto = plain(F.transform(bs, lambda b: F.element_at(b, -1)))
            return let(upto, lambda us: F.flatten(F.transform(bs, lambda b, k: F.when(k == 0, b).otherwise(F.transform(b, lambda x: join(F.get(us, k - 1), x))))))

        return let(blocks, together)

    return let(xs, lambda ys: F.when(F.size(ys) == 0, nothing).when(F.size(ys) <= BLOCK, plain(ys)).otherwise(whole(ys)))


def in_pieces(text: Column, body) -> Column:
    """``body`` of a function (start, end) that cuts from ``text``, its cost bounded by the cut's length."""

    def bound(ps: Column) -> Column:
        def cut(s: Column, e: Column) -> Column:
            first = F.floor(s / PIECE).cast("int")
            few = F.slice(ps, first + 1, F.floor((e - 1) / PIECE).cast("int") - first + 1)
            return F.when(e <= s, F.lit("")).otherwise(F.substr(F.array_join(few, ""), s - first * PIECE + 1, e - s))

        return body(cut)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0), bound)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m, before, after>> of all matches of a pattern, in code points."""

    def placed(ms: Column) -> Column:
        def walk(gaps: Column) -> Column:
            ends = running(F.transform(ms, lambda m, i: F.length(F.get(gaps, i)) + F.length(m)), lambda a, b: a + b)
            return let(ends, lambda es: F.transform(ms, lambda m, i: F.struct((F.get(es, i) - F.length(m)).alias("s"), F.get(es, i).alias("e"), m.alias("m"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"))))

        return let(F.split(text, pattern, -1), walk)

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string of at most 19 digits holds."""
    n = F.length(digits)
    at = F.sequence(F.lit(1), n)
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    digit = lambda i: F.ascii(F.substr(digits, i, F.lit(1))) - 48
    total = F.aggregate(at, F.lit(0), lambda acc, i: acc + F.when((n - i) % 2 == 1, double(digit(i))).otherwise(digit(i)))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: let(F.ltrim(p, F.lit("0")), lambda t: (F.length(t) <= 3) & (F.coalesce(F.when(F.length(t) <= 3, F.try_to_number(F.lpad(t, 3, "0"), F.lit("000"))), F.lit(999)) <= 255))
        return F.forall(F.split(m, "\\."), small)
    if kind == "card":
        return let(_digits(m), lambda d: F.when((F.length(d) >= 13) & (F.length(d) <= 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid spans of the four kinds, by kind and start."""
    empty = F.array().cast(SPANS)
    found = []
    for kind, pattern in PATTERNS.items():
        good = _checked(text, kind, pattern)
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
        found.append(F.when(hint, good).otherwise(empty))
    return F.concat(*found)


def _checked(text: Column, kind: str, pattern: str) -> Column:
    good = F.filter(matches(text, pattern), lambda x: _valid(kind, x["m"]))
    return F.transform(good, lambda x: F.struct(F.lit(kind).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def _maximal(spans: Column) -> Column:
    """array<struct<s, e, k>>: maximal runs of overlapping spans, in order, with the kind of their first."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def of(xs: Column) -> Column:
        def heads(upto: Column) -> Column:
            first = F.filter(F.sequence(F.lit(0), F.size(xs) - 1), lambda i: (i == 0) | (F.get(xs, i)["s"] >= F.get(upto, i - 1)))
            return let(first, lambda hs: F.transform(hs, lambda h, j: F.struct(F.get(xs, h)["s"].alias("s"), F.get(upto, F.coalesce(F.get(hs, j + 1), F.size(xs)) - 1).alias("e"), F.get(xs, h)["k"].alias("k"))))

        return let(running(F.transform(xs, lambda x: x["e"]), F.greatest), heads)

    return let(order, of)


def _rewritten(text: Column, spans: Column, write) -> Column:
    """The text with ``write`` of each maximal run of spans in its place."""

    def made(runs: Column) -> Column:
        def joined(cut) -> Column:
            parts = F.transform(runs, lambda r, i: F.concat(cut(F.coalesce(F.get(runs, i - 1)["e"], F.lit(0)), r["s"]), write(r)))
            return F.concat(F.array_join(parts, ""), cut(F.element_at(runs, -1)["e"], F.length(text)))

        return in_pieces(text, joined)

    return F.when(F.size(spans) == 0, text).otherwise(let(_maximal(spans), made))


INSTANCES = "array<struct<patterns:array<string>,token:string,s:int,e:int,seed:boolean,prior:double>>"


def _instances(text: Column, spans: Column) -> Column:
    """Runs of tokens with a digit or at sign, their patterns, and whether a base span is in them."""
    covered = _rewritten(F.translate(text, COVER, COVERED), spans, lambda r: F.repeat(F.lit(COVER), r["e"] - r["s"]))
    gap_words = lambda g: F.split(F.btrim(F.lower(g), F.lit(" \t\n\x0b\x0c\r")), WORD_GAP)

    def of(x: Column, cut) -> Column:
        lead = F.length(F.regexp_extract(x["m"], r"^[\"'(\[{<]*", 0))
        tail = F.length(F.reverse(F.regexp_extract(F.reverse(x["m"]), r"^[\"')\]}>.,;:!?]*", 0)))
        s, e = x["s"] + lead, x["e"] - tail
        seed = F.contains(x["m"], F.lit(COVER))
        token = F.when(seed, cut(s, e)).otherwise(F.substr(x["m"], lead + 1, F.greatest(e - s, F.lit(0))))
        before = F.substring_index(F.right(x["before"], F.lit(200)), "\n\n", -1)

        def told(t: Column) -> Column:
            classes = F.regexp_replace(F.regexp_replace(t, "[0-9]", "9"), r"\p{L}", "a")
            shape = F.array_join(F.array_sort(F.array_distinct(F.split(classes, ""))), "")

            def contexts(ws: Column) -> Column:
                last = F.element_at(ws, -1)
                next_ = F.element_at(gap_words(F.left(x["after"], F.lit(100))), 1)
                two = F.when((F.size(ws) >= 2), F.concat(F.lit("2 "), F.get(ws, F.size(ws) - 2), F.lit(" "), last))
                label = F.when(last.rlike("[:=#]$"), F.concat(F.lit("1 "), last, F.lit(" "), shape))
                both = F.when((last != "") & (next_ != ""), F.concat(F.lit("3 "), last, F.lit(" _ "), next_, F.lit(" "), shape))
                return F.array_compact(F.array(two, label, both))

            prior = F.when(seed, 1.0).when(t.rlike(SECRET), PRIOR).otherwise(0.0)
            return F.struct(let(gap_words(before), contexts).alias("patterns"), t.alias("token"), s.alias("s"), e.alias("e"), seed.alias("seed"), prior.alias("prior"))

        return let(token, told)

    found = in_pieces(text, lambda cut: F.transform(matches(covered, TOKEN), lambda x: of(x, cut)))
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(INSTANCES))


def _like_identifier(token: Column) -> Column:
    return (F.length(token) >= 6) & ((F.length(_digits(token)) >= 3) | F.contains(token, F.lit("@")))


def discover(read: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, h, s, e) of identifiers that the patterns find beside the seeds; ``read`` has doc_id, h, instances."""
    spark = read.sparkSession
    each = read.select("doc_id", "h", F.inline("instances")).filter("token <> ''")
    told = each.select("doc_id", "h", F.explode("patterns").alias("pattern"), "token", "s", "e", "seed", "prior")
    graph = told.groupBy("pattern", "token").agg(F.max("prior").alias("prior"), F.max("seed").alias("seed")).filter((F.col("prior") > 0) | _like_identifier(F.col("token")))
    # A pattern with fewer tokens than the support can never be confident, in any round.
    wide = graph.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if("seed").alias("k")).filter((F.col("n") > F.col("k")) & (F.col("n") >= support))
    graph = materialize(_salted(graph, wide.select("pattern")), "pii-graph")
    scores = materialize(graph.groupBy("token").agg(F.max("prior").alias("score")), "pii-scores")
    if scores.isEmpty():
        return spark.createDataFrame([], "doc_id long, h long, s int, e int")
    known = None
    for _ in range(MOST_ROUNDS):
        edges = graph.select("pattern", "token").join(scores, "token")
        patterns = edges.groupBy("pattern").agg((F.sum("score") / (F.count("*") + DAMPING)).alias("p"), F.count_if(F.col("score") >= confidence).alias("k"))
        patterns = patterns.filter((F.col("k") >= support) & (F.col("p") >= confidence)).select("pattern", "p")
        patterns = materialize(patterns, "pii-patterns")
        doubt = _salted(graph.select("pattern", "token"), patterns).groupBy("token").agg(F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999))))).alias("doubt"))
        after = scores.join(doubt, "token", "left").select("token", F.greatest("score", F.coalesce(1 - F.col("doubt"), F.lit(0.0))).alias("score"))
        scores = materialize(after, "pii-scores")
        now = scores.agg(F.round(F.sum("score"), 6), F.count_if(F.col("score") >= confidence)).first()
        if now == known:
            break
        known = now
    else:
        raise RuntimeError(f"pattern scores did not settle in {MOST_ROUNDS} rounds")
    # Confident pairs, not tokens alone: a token elsewhere, outside such a pattern, stays.
    unseen = told.filter(~F.col("seed") & ((F.col("prior") > 0) | _like_identifier(F.col("token"))))
    hits = _salted(unseen, patterns.select("pattern"))
    return hits.select("doc_id", "h", "s", "e").distinct()


def _salted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on pattern; the right side is repeated per salt, so a frequent pattern spreads."""
    spread = right.withColumn("_z", F.explode(F.array([F.lit(i).cast("long") for i in range(SALTS)])))
    return left.withColumn("_z", F.pmod(F.xxhash64("token"), F.lit(SALTS))).join(spread, ["pattern", "_z"]).drop("_z")


def read_once(docs: DataFrame) -> DataFrame:
    """(doc_id, h, spans, instances) of every row: all that later steps need of the texts."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), text.alias("t"), F.explode(F.array(base_spans(text))).alias("spans"))  # once per row, not per use
    return found.select("doc_id", "h", "spans", _instances(F.col("t"), F.col("spans")).alias("instances"))


def _per_row(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct(F.lit("id").alias("k"), "s", "e"))).alias("more"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, all_spans) of every row."""
    read = materialize(read_once(docs), "pii-read")
    more = _per_row(discover(read)).withColumnsRenamed({"doc_id": "d2", "h": "h2"})
    joined = read.join(more, read["doc_id"].eqNullSafe(more["d2"]) & (read["h"] == more["h2"]), "left")
    return joined.select("doc_id", "spans", F.concat("spans", F.coalesce("more", F.array().cast(SPANS))).alias("all_spans"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["k"], x["s"], x["e"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each maximal run of overlapping spans replaced by [KIND]."""
    return _rewritten(text, spans, lambda r: F.concat(F.lit("["), F.upper(r["k"]), F.lit("]")))


def redact(docs: DataFrame) -> DataFrame:
    """All documents with the spans masked in their texts (and n_chars, if present, counted anew).  Base spans
    are found again where the text is, so that only discovered ones are joined to it."""
    d, h, s, every = free_names(docs.columns, "_d", "_h", "_s", "_all")
    with scratch(docs.sparkSession):
        read = materialize(read_once(docs), "pii-read")
        more = materialize(_per_row(discover(read)).withColumnsRenamed({"doc_id": d, "h": h, "more": s}), "pii-found", keep=True)
    joined = docs.join(more, docs["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(docs["text"]) == F.col(h)), "left")
    spans = F.concat(base_spans(F.coalesce("text", F.lit(""))), F.coalesce(s, F.array().cast(SPANS)))
    # A generator is computed once per row, where a plain column would be copied into each use.
    joined = joined.select("*", F.explode(F.array(spans)).alias(every))
    touched = F.col("text").isNotNull() & (F.size(every) > 0)
    out = joined.withColumn("text", F.when(touched, masked(F.col("text"), F.col(every))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(every) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
