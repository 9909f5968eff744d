"""The training-data operators against brute force, libraries and planted cases, on small tables."""

from __future__ import annotations

import hashlib
import io
import itertools
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.llm import bin_packing, byte_cnn, language_mix, personal_data, piece_bpe, quality_rules, queries, reply_trees, residual_quantizer, simhash, token_files

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use for themselves.
CLASHING = ["score", "component_id", "fp", "h", "_q", "_kept", "_t_lang", "_d", "_all", "salt", "spans", "count", "rank", "length"]
ODD = [None, "", " \n\t ", "x", "Ünï ça 図 😀", "a" * 70_000, "word " * 9_000, "same line\nsame line\nother", "a\x00b", "▁ a ▁"]


def documents(spark, texts, **more):
    rows = [(k, t, "en", "web", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(None, "no id", None, None, None)], DOCS)
    for c in CLASHING:
        df = df.withColumn(c, F.lit(1))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- quality classifier


def test_classifier_learns_and_scores_every_text(spark):
    rng = np.random.default_rng(1)
    texts = [(" ".join(rng.choice(["good", "plain", "words"], 40)) if k % 2 else " ".join(rng.choice(["$$#", "@@!", "%%%"], 40))) for k in range(300)]
    docs = documents(spark, texts + ODD)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)] + [(0, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in byte_cnn.score_table(docs, byte_cnn.train(docs, labels)).collect()}
    assert len(got) == 300 + len(ODD) + 1
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([got[k].predicted == k % 2 for k in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_classifier_without_both_labels(spark):
    docs = documents(spark, ["a", "b", "c"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in byte_cnn.score_table(docs, byte_cnn.train(docs, none)).collect()} == {0.5}
    assert byte_cnn.score_table(empty(spark), byte_cnn.train(empty(spark), none)).count() == 0


def test_slices_do_not_change_a_score(monkeypatch):
    model = byte_cnn.ByteCnn()
    text = bytes(range(256)) * 40
    whole = model.score(text)
    monkeypatch.setattr(byte_cnn, "SLICE", 7)
    assert model.score(text) == pytest.approx(whole, abs=1e-6)


# --- packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_bins_hold_their_pieces(lengths):
    bins, places, final = bin_packing.pack_lengths(lengths, (16, 32, 64), 2)
    for b, c in enumerate(final):
        inside = sorted((places[i], n) for i, n in enumerate(lengths) if bins[i] == b)
        at = 0
        for place, n in inside:
            assert place == at
            at += n
        assert at <= c and all(at > x for x in (16, 32, 64) if x < c)


def least_total(lengths, capacities):
    """Least total length of bins by trying every way to deal the pieces."""
    best = [10**9]

    def go(k, bins):
        if k == len(lengths):
            best[0] = min(best[0], sum(min(c for c in capacities if c >= b) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= max(capacities):
                go(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        go(k + 1, [*bins, lengths[k]])

    go(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=7))
def test_packing_of_few_pieces_is_near_the_best_of_all(lengths):
    capacities = (4, 8, 16)
    total = sum(bin_packing.pack_lengths(lengths, capacities, 0)[2])
    assert least_total(lengths, capacities) <= total <= 1.34 * least_total(lengths, capacities)


def test_several_lengths_are_opened_and_no_single_one_is_better():
    rng = np.random.default_rng(5)
    lengths = rng.integers(2_700, 9_000, 2_000).tolist()
    bins, _, final = bin_packing.pack_lengths(lengths)
    alone = []
    for c in (16_384,):
        room, n = [], 0
        for x in sorted(lengths, reverse=True):
            at = min((k for k in range(len(room)) if room[k] >= x), key=lambda k: room[k], default=None)
            if at is None:
                room.append(c)
                at = len(room) - 1
            room[at] -= x
        alone.append(sum(min(k for k in bin_packing.CAPACITIES if k >= c - r) for r in room))
    assert sum(final) <= min(alone) and len({c for c in final}) > 1 and sorted(final)[len(final) // 10] < 16_384
    assert len(bins) == len(lengths)


def test_packing_places_every_byte(spark):
    texts = [*ODD, *ODD, *("t" * n for n in range(1, 400))]
    got = bin_packing.pack(documents(spark, texts), group=50).toPandas()
    want = sum(len((t or "").encode()) + 1 for t in texts) + len("no id") + 1
    assert got.length.sum() == want
    by = got.groupby("bin_id").agg(n=("length", "sum"), c=("capacity", "first"))
    assert (by.n <= by.c).all() and set(by.c) <= set(bin_packing.CAPACITIES)
    assert bin_packing.pack(empty(spark)).count() == 0


# --- quality rules


def test_rules_equal_their_sql(spark, same_as_sql, tmp_path):
    base = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = documents(spark, [t for t in ODD if t != "a\x00b"]).select(F.col("doc_id") + 10_000, "text", "lang", "source")
    base.union(odd).union(odd).write.parquet(str(tmp_path / "documents.parquet"))
    same_as_sql(quality_rules.quality_table(spark.read.parquet(str(tmp_path / "documents.parquet"))), quality_rules.ORACLE, str(tmp_path))


def test_rules_filter_keeps_columns_and_clean_documents(spark):
    clean = [" ".join(f"word{k:03d}x{j:02d}" for j in range(60 + k % 7)) for k in range(120)]
    junk = ["spam spam spam spam spam spam spam spam " * 20, "#$%& " * 60, "few words"]
    docs = documents(spark, clean + junk)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(120))
    assert quality_rules.keep_good(empty(spark)).count() == 0 and quality_rules.quality_table(empty(spark)).count() == 0


# --- token ids


TRICKY = ["", " ", "  a", "a  ", "a\n\nb", "\n a", "\t\tx", "don't we'll", "naïve Ünï", "図書館😀", "<s></s><unk><0x0A>", "<|endoftext|>", "▁▁a", "a b", "​", "x" * 300, "1234567 89,5.", "Hello, world. Ok.", "ab.\ncd,", "aaaaaaaaabbbbbbbb" * 9, "\r\n", "é", "A.B.C. end."]


def test_pieces_equal_the_library():
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.Vocabulary(path)

    def check(text):
        ids = library.encode(text, add_bos=True, add_eos=True)
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert own.decode(got).decode() == library.decode(ids), text

    for t in TRICKY:
        check(t)
    settings(max_examples=400, deadline=None)(given(st.text(st.one_of(st.sampled_from(" \naeinrst.,'▁"), st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), max_size=60))(check))()


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.Encoder(path)

    def check(text):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text

    for t in TRICKY:
        check(t)
    settings(max_examples=400, deadline=None)(given(st.text(st.one_of(st.sampled_from(" \n\t\raeinrst.,'1"), st.characters(exclude_categories=["Cs"])), max_size=60))(check))()


def test_frequent_pieces_are_encoded_once(monkeypatch):
    """CPU seconds of op5: a full table keeps what is met again, and closing marks cost no call of the library."""
    coder = token_files.Encoder(queries.tokenizer("byte_bpe_50k.json"))
    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    asked, word = [], coder.word
    monkeypatch.setattr(coder, "word", lambda p: asked.append(p) or word(p))
    letters = "abcdefghij"
    frequent = [f" frequent{a}" for a in letters]
    for k in range(60):
        new = [f" {letters[k // 10]}{letters[k % 10]}{a}{b}" for a in letters[:6] for b in letters[:5]]
        text = "".join(frequent + new + [f"{p}!!?" for p in frequent])
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == coder.library.encode(text, add_special_tokens=False).ids
    assert sorted(p for p in asked if "frequent" in p) == frequent


def test_slices_of_texts_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 7)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 100)
    coder = token_files.Encoder(queries.tokenizer("byte_bpe_50k.json"))

    def check(texts):
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
        assert got == [coder.library.encode(t, add_special_tokens=False).ids for t in texts], texts

    check([])
    check(TRICKY * 2)
    check(["a<|endoftext|>. b", "", "\n", " ", "it's. don't' x'll!\n'", "b" * 70 + " " + "b" * 70 + "." + " c" * 80, "\n a", "a\xa0. b\x1c", "é!! 中文。. 1.,"])
    check(["a\n\nb  c", "a \nb\n c", "a  <|endoftext|> b", "  ", "a\n\n", "a\n\n\nb", "\n\na \tb\t\t c", "a\r\nb"])
    text = st.text(st.one_of(st.sampled_from(" \n\taeis.,'!<|>1"), st.characters(exclude_categories=["Cs"])), max_size=40)
    settings(max_examples=300, deadline=None)(given(st.lists(text, max_size=8))(check))()


@pytest.mark.parametrize("unit", [8, 1])
def test_planes_round_trip(unit):
    import pyarrow as pa

    rng, out = np.random.default_rng(3), io.BytesIO()
    docs = [(k, rng.integers(0, 2 ** int(rng.integers(1, 32)), int(n)).astype("<u4")) for k, n in enumerate([0, 1, 7, 1000, 0, 333])] + [(None, np.array([5], "<u4"))]
    w = token_files.PlaneWriter(out, unit, chunk=64)
    for k, ids in docs:
        w.add(k, ids.tobytes())
    assert w.close() == sum(len(i) for _, i in docs)
    source = pa.BufferReader(out.getvalue())
    got = [(k, np.concatenate([*p, np.zeros(0, "<u4")]).astype("<u4").tolist()) for k, p in token_files.PlaneReader(source).documents()]
    assert got == [(k, i.tolist()) for k, i in docs]


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    texts = TRICKY + ODD
    path = queries.tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = documents(spark, texts).filter("doc_id is not null")
    start = 0
    got = sorted(token_files.round_trip(docs, path).collect())
    for k, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(got[k]) == (k, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.round_trip(empty(spark), path).count() == 0


def test_piece_digests(spark):
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for t in ODD if t is None or "\x00" not in t]
    got = {r.doc_id: r for r in piece_bpe.encode_digests(documents(spark, texts), path).collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert got[k].n_tokens == len(ids) and got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# --- personal data


def plain_spans(text):
    """The base definition with Python's engine."""
    luhn = lambda d: sum((2 * int(c) - 9 * (int(c) > 4)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0]))


PERSONAL = [
    "mail a.b+c@mail.example.org, or x@y.z_q@r.st.", "10.0.0.1 300.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255", "card 4111 1111 1111 1111 and 4111-1111-1111-1112 5",
    "call +44 (20) 7946-0958 or +1 2 3", "a@b a@b. @c.d e@f..g", "12345678901234567890123 0000000000000", "+1234567890.1.2.3", "😀 é a@b.cd 😀 9.9.9.9", "", None, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1",
]


def base_of(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    spans = personal_data.base_spans(F.coalesce("text", F.lit("")))
    return {r.doc_id: r.s for r in df.select("doc_id", personal_data.spans_text(spans).alias("s")).collect()}


def test_base_spans_equal_the_plain_patterns(spark):
    rng = np.random.default_rng(4)
    mixed = ["".join(rng.choice(list("01259.-+@ ()ab_é"), 60)) for _ in range(600)]
    texts = PERSONAL + mixed
    got = base_of(spark, texts)
    for k, t in enumerate(texts):
        assert got[k] == plain_spans(t or ""), t


def test_patterns_find_unseen_identifiers(spark):
    seeds = [f"please write to user{k}@mail.org today" for k in range(8)]
    texts = [*seeds, "please write to user-9931-x77 today", "the year 2023451 was good", None, ""]
    got = {r.doc_id: personal_data_text(r.all_spans) for r in personal_data.find(documents(spark, texts)).collect()}
    assert got[8] == "id:16:29" and got[9] == "" and got[10] == "" and got[0].startswith("email:16:30")
    assert len(got) == len(texts) + 1


def test_identifiers_written_with_spaces(spark):
    seeds = [f"reach me under +1 (743) 555-38{k:02d} today" for k in range(20)]
    texts = [*seeds, "reach me under (743) 555-3824 today", "reach me under 1234 5678 9012, 77 of us", "reach me under 1234 5678\n9012", "the years 1234 5678 passed"]
    got = {r.doc_id: personal_data_text(r.all_spans) for r in personal_data.find(documents(spark, texts)).collect()}
    assert [got[k] for k in (20, 21, 22, 23)] == ["id:16:29", "id:15:29", "id:15:24", ""]
    assert all(got[k] == "phone:15:32" for k in range(20))
    kept = {r.doc_id: r.text for r in personal_data.redact(documents(spark, texts)).collect()}
    assert kept[21] == "reach me under [ID], 77 of us" and kept[0] == "reach me under [PHONE] today"


def test_keys_after_a_cue_are_found_and_nothing_else(spark):
    rng = np.random.default_rng(9)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 32)) for _ in range(40)]
    planted = [f'some words then token = "{h}" and more' for h in hexes] + ['then token = "9f2e77c1" ends']
    clean = [f"in {1900 + k} the {k}.5 units of part-{k * 7919} moved on" for k in range(200)]
    rows = personal_data.find(documents(spark, planted + clean)).collect()
    got = {r.doc_id: personal_data_text(r.all_spans) for r in rows}
    assert all(planted[k][int(got[k].split(":")[1]) : int(got[k].split(":")[2])] == hexes[k] for k in range(40))
    assert got[40] == "id:14:22" and not any(got[41 + k] for k in range(200))


def test_work_on_a_long_text_grows_with_its_length(spark):
    import time

    def took(n):
        text = " ".join(f"w{i} {i}.{i % 200}.1.2 a{i}@b.com" for i in range(n))
        df = documents(spark, [text]).filter("text is not null")
        start = time.time()
        out = personal_data.redact(df).first().text
        assert out.count("[EMAIL]") == n and out.count("[IP]") == sum(i <= 255 for i in range(n))
        return time.time() - start

    took(100)
    assert took(8_000) < 4 * took(2_000) + 10


def personal_data_text(spans):
    return ",".join(f"{s.k}:{s.s}:{s.e}" for s in spans)


def test_masking_keeps_everything_else(spark):
    texts = ["to a@b.cd and 1.2.3.4!", "nothing", None, "", "+1234567890.1.2.3"]
    docs = documents(spark, texts)
    out = personal_data.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == "to [EMAIL] and [IP]!" and got[0].n_chars == len(got[0].text)
    assert got[1].text == "nothing" and got[2].text is None and got[3].text == "" and "1" not in got[4].text and len(got) == 6
    assert personal_data.redact(empty(spark)).count() == 0 and personal_data.find(empty(spark)).count() == 0


# --- language


def test_languages_and_their_absence(spark):
    said = {"en": "the house is on the hill and the water is cold today", "de": "das haus steht auf dem berg und das wasser ist heute kalt", "fr": "la maison est sur la colline et l'eau est froide aujourd'hui"}
    rows = [(k, (said[lang] + " ") * (1 + k % 4), lang, "web", 0) for k, lang in zip(range(240), itertools.cycle(said))]
    rows += [(1000, said["en"] * 3 + " " + said["de"], None, None, 0), (1001, None, "en", None, 0), (1002, "12 34 !!", "de", None, 0), (1003, "", None, None, 0), (1003, "", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("count", F.lit(1))
    model = language_mix.train(docs)
    got = language_mix.predict_table(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[r[0]].lang_pred == r[2] for r in rows[:240])
    assert by[1000].lang_pred == "en" and 0.5 < by[1000].score < 0.95
    assert [by[k].lang_pred for k in (1001, 1002, 1003)] == ["und"] * 3
    assert {r.doc_id for r in language_mix.keep_identified(docs, model).collect()} == {*range(240), 1000}
    nothing = language_mix.train(empty(spark))
    assert {r.lang_pred for r in language_mix.predict_table(docs, nothing).collect()} == {"und"}


# --- nearest neighbours


def exact(ids, x, k=10):
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        yield q, [ids[i] for i in np.lexsort((ids, d)) if ids[i] != q][:k]


def test_search_recall_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32).astype(float)
    x[700:760] = x[100]
    bad = [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0, None] + [0.0] * 14), (5400, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    got = residual_quantizer.search(df, F.col("vec_id") % 100 == 0).toPandas()
    want = dict(exact(np.arange(1500), x))
    assert set(got.query_id) == set(want) and set(got.groupby("query_id").size()) == {10}
    found = {q: g.sort_values("rank").vec_id.tolist() for q, g in got.groupby("query_id")}
    assert np.mean([len(set(found[q]) & set(w)) / 10 for q, w in want.items()]) >= 0.9
    assert found[100] == list(range(700, 710))
    assert np.allclose(got.score, [np.sqrt(((x[a] - x[b]) ** 2).sum()) for a, b in zip(got.query_id, got.vec_id)])


def test_search_of_an_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 0.5]), (3, [9.0, 9.0]), (4, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = residual_quantizer.search(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 3)) for r in got] == [(3, 0.5), (4, 2.0), (3, 12.042)]


def test_search_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in residual_quantizer.search(few, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1)]
    assert residual_quantizer.search(few.filter("vec_id > 5"), F.col("vec_id") % 100 == 0).count() == 0


# --- near-duplicates


def plain_print(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, prints):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            r, s = sorted((find(ids[a]), find(ids[b])))
            root[s] = r
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("segments, bucket", [(3, 128), (2, 128), (3, 1), (3, 3)])
def test_classes_link_as_all_pairs_do(spark, segments, bucket):
    rng = np.random.default_rng(6)
    prints = []
    for _ in range(12):
        at = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                at ^= 1 << int(b)
            prints.append(at)
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame(list(enumerate(signed)), "rep long, fp long")
    labels = {r.node: r.component for r in simhash.connected_components(simhash.linked_classes(classes, segments, bucket)).collect()}
    want = plain_components(list(range(len(prints))), prints)
    assert {i: labels.get(i, i) for i in want} == want


def test_near_duplicates_equal_all_pairs(spark):
    base = " ".join(f"tok{k}" for k in range(400))
    texts = [base, base.upper(), base + " end", base.replace("tok7 ", "zzz "), *ODD, *(" ".join(f"w{k * j % 97}" for j in range(50)) for k in range(1, 30)), *ODD]
    docs = documents(spark, texts)
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_print(t) for t in texts]
    want = plain_components(list(range(len(texts))), prints)
    assert len(got) == len(texts) + 1
    for r in got:
        if r.doc_id is not None:
            assert r.fp % (1 << 64) == prints[r.doc_id] and r.component_id == want[r.doc_id]
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.deduplicate(empty(spark)).count() == 0


def test_tables_that_grow_with_the_input_are_not_broadcast(spark):
    """Exploded tables of few classes or edges look small to Spark, whose driver then has to hold all their rows."""
    from vellum.llm import components

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    classes = spark.range(40).select(F.col("id").alias("rep"), (F.col("id") * F.col("id")).alias("fp"))
    edges = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    prints = classes.select(F.col("rep").alias("doc_id"), F.lit(1).alias("h"), "fp")
    for df in (simhash.linked_classes(classes, 3), components._joined(edges), simhash._spread(prints, classes.select("fp", F.col("rep").alias("component_id")))):
        assert "Broadcast" not in plan(df)


# --- chat


def test_conversations_equal_their_sql(spark, same_as_sql, tmp_path):
    hard = ["<|im_end|>", "<\\|x", "<\\\\|im_start|>user\n", "\\<|", None, "", "line\n<|im_end|>\nline", "<|n|>"]
    rows = [(k % 3, k // 3, ["user", "assistant"][k // 3 % 2], t) for k, t in enumerate(hard * 3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    same_as_sql(queries.op10_reply_trees(spark, str(tmp_path)), reply_trees.ORACLE, str(tmp_path))


def test_odd_roles_nulls_and_ids(spark):
    rows = [(None, 0, "a\nb", "x"), (None, 1, "assistant", "y"), (None, 1, "assistant", "y"), (7, None, None, None), (8, 0, "<|n|>", "t")]
    told = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in reply_trees.read_back(reply_trees.format_paths(reply_trees.linear(told))).collect()}
    assert [tuple(t) for t in back[None].turns] == [("a\nb", "x"), ("assistant", "y"), ("assistant", "y")] and back[None].learned == "yy"
    assert [tuple(t) for t in back[7].turns] == [("", "")] and [tuple(t) for t in back[8].turns] == [("<|n|>", "t")]
    assert reply_trees.digests(reply_trees.linear(told.filter("conv_id = 99"))).count() == 0


def test_the_best_branch_is_formatted(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9), (1, 4, 3, "user", "more", 0.5), (1, 5, 99, "user", "lost", 9.0), (1, 6, 7, "user", "round", 9.0), (1, 7, 6, "user", "round", 9.0)]
    tree = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double").withColumn("leaf", F.lit(0)).withColumn("up", F.lit(0))
    got = reply_trees.read_back(reply_trees.format_paths(tree, branches=2)).orderBy("branch").collect()
    assert [[t.text for t in r.turns] for r in got] == [["q", "good", "more"], ["q", "bad"]]
    assert [r.learned for r in got] == ["good", "bad"]


# --- pipeline


def test_pipeline_stages(spark, duck, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {"documents": docs}
    texts = {r.doc_id: r.text for r in docs.collect()}
    names, rows = duck(quality_rules.ORACLE)
    good = {int(r[names.index("doc_id")]) for r in rows if r[names.index("kept")] == "True"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language id", "near-duplicates", "personal data", "packing"]
    steps = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        steps.append(docs)
        if k < 4:
            assert docs.columns == kept["documents"].columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in steps]
    assert ids[0] == good
    model = language_mix.train(steps[0])
    assert ids[1] == {i for i in good if (p := model.predict(texts[i]))[0] != "und" and p[1] >= 0.5}
    order = sorted(ids[1])
    assert ids[2] == set(plain_links(order, [texts[i] for i in order]).values())
    assert ids[3] == ids[2] == ids[4]
    after = {r.doc_id: r.text for r in steps[3].collect()}
    assert not any(plain_spans(t) for t in after.values() if t)
    assert all(after[i] == texts[i] for i in ids[3] if not re.search("[0-9@]", texts[i]))
    assert steps[4].agg(F.sum("length")).first()[0] == sum(len(t.encode()) + 1 for t in after.values())


def test_rows_of_one_id_with_different_texts(spark):
    from vellum.llm import shingle_sets

    a, b = "the first text " * 9, "quite another thing " * 9
    rows = [(1, a, 1), (5, a, 2), (5, b, 3), (7, b, 4), (8, a, 5), (8, a, 5), (None, a, 6), (9, "alone " * 8, 9), (9, "alone " * 8, 8), (9, "apart " * 8, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int")
    for module in (simhash, shingle_sets):
        kept = module.deduplicate(docs)
        assert kept.columns == docs.columns
        want = [(1, a, 1), (5, b, 3), (9, "alone " * 8, 8), (9, "apart " * 8, 7), (None, a, 6)]
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_stages_on_empty_null_repeated_and_clashing_input(spark):
    import corpus_pipeline

    rows = [(1, None, None, None, None, 1), (2, "", "en", "web", 0, 2), (None, "words " * 30, "en", None, 180, 3), (4, "word " * 40, "en", "web", 200, 4), (4, "word " * 40, "en", "web", 200, 4), (4, "other 1.2.3.4 " * 40, None, "web", 560, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _q int"
    for docs in (spark.createDataFrame(rows, schema), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DATA)
            if name != "packing":
                assert out.columns == docs.columns, name
            assert out.count() >= 0


# --- similarity of the pipeline's near-duplicates


def plain_links(ids, texts):
    """Components of all pairs of a five-word similarity of 0.8 or more, by Python's sets."""
    sets = {}
    for i, t in zip(ids, texts):
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(" ".join(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else frozenset()
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        x, y = sets[a], sets[b]
        if x == y or 9 * len(x & y) >= 4 * (len(x) + len(y)) > 0:
            r, s = sorted((find(a), find(b)))
            root[s] = r
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("centres,share", [((1, 4), 2), ((), 3)])
def test_stage_links_every_pair_of_similarity_four_fifths(spark, monkeypatch, centres, share):
    from vellum.llm import shingle_sets

    # Buckets of ten copies are split into several parts.
    monkeypatch.setattr(shingle_sets, "SHARE", share)
    rng = np.random.default_rng(8)
    texts = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(int(rng.integers(60, 300)))]
        for _ in range(10):
            ws = list(base)
            for at in rng.choice(len(ws), int(rng.integers(0, len(ws) // 30 + 1)), replace=False):
                ws[at] = f"new{rng.integers(1 << 30)}"
            texts.append(" ".join(ws))
    texts += [*ODD, *ODD, "one two three", "One  Two\nthree"]
    want = plain_links(range(len(texts)), texts)
    assert len(set(want.values())) > 20
    docs = documents(spark, texts)
    got = {r.doc_id: r.component_id for r in shingle_sets.near_duplicates(docs, centres=centres).collect()}
    assert {i: got[i] for i in want} == want and len(got) == len(texts) + 1
    kept = shingle_sets.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert shingle_sets.near_duplicates(empty(spark)).count() == 0 and shingle_sets.deduplicate(empty(spark)).count() == 0


def test_stage_finds_candidates_by_fingerprints(spark):
    """Multi-index hashing alone connects the sets as all pairs of fingerprints within four bits do."""
    from vellum.llm import shingle_sets

    rng = np.random.default_rng(9)
    texts = []
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(400)]
        for _ in range(8):
            ws = list(base)
            ws[int(rng.integers(0, 400))] = f"new{rng.integers(1 << 30)}"
            texts.append(" ".join(ws))
    sets = [shingle_sets.text_set(t) for t in texts]
    prints = [simhash.fingerprint(s) for s in sets]
    want = plain_components(list(range(len(texts))), prints)
    assert len(set(want.values())) < 30
    read = shingle_sets.read_sets(documents(spark, texts), 5, False).filter("doc_id is not null").cache()
    assert {r.doc_id: r.sim % (1 << 64) for r in read.collect()} == dict(enumerate(prints))
    pairs = shingle_sets.close_sets(read.select(F.col("doc_id").alias("rep"), F.xxhash64("fp").alias("v"), "sim"))
    found = {(r.a, r.b) for r in pairs.collect()}
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in found)
    labels = {r.node: r.component for r in simhash.connected_components(pairs).collect()}
    assert {i: labels.get(i, i) for i in want} == want
    # No bands are needed for the links among them.
    members = spark.createDataFrame([(k, s.view(np.int64).tolist()) for k, s in enumerate(sets)], "rep long, members array<long>")
    none = spark.createDataFrame([], "key long, rep long, n int, u long")
    linked = {r.node: r.component for r in shingle_sets.linked_sets(none, [pairs], members).collect()}
    assert linked == labels


@pytest.mark.parametrize("most", [0, 60, 1 << 19])
def test_components_in_one_task_equal_those_in_rounds(spark, most):
    from vellum.llm import components

    rng = np.random.default_rng(11)
    edges = [(k, k + 1) for k in range(-40, 0)] + [(9, 9), (5000, 70), (70, 5000), (1 << 62, 71)] + [tuple(map(int, rng.integers(100, 160, 2))) for _ in range(40)]
    want = {}
    for x in {x for e in edges for x in e if e[0] != e[1]}:
        reached, todo = {x}, [x]
        while todo:
            at = todo.pop()
            new = {b if a == at else a for a, b in edges if at in (a, b)} - reached
            reached |= new
            todo += new
        want[x] = min(reached)
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = components.connected_components(table, one_task=most).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert components.connected_components(table.limit(0), one_task=most).count() == 0


def test_few_links_of_the_stage_take_no_rounds(spark, monkeypatch):
    """On check_h four tables of links took 15 rounds of 1,500 tasks on 211 partitions, which wrote more logs than data."""
    from vellum.llm import components, shingle_sets

    def rounds(edges):
        raise AssertionError("a round for a table of a few links")

    monkeypatch.setattr(components, "_large_star", rounds)
    texts = [" ".join([f"w{k}" for k in range(40 + g)] + [f"end{g}"]) for g in range(12)] + ["none of these words " * 3]
    got = {r.doc_id: r.component_id for r in shingle_sets.near_duplicates(documents(spark, texts)).collect()}
    want = plain_links(range(len(texts)), texts)
    assert {i: got[i] for i in want} == want and len(set(want.values())) == 2


def test_pipeline_removes_copies_that_simhash_leaves(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = plain_links([i for i, _ in rows], [t for _, t in rows])
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, DATA).collect()}
    assert got == set(want.values()) and 177 not in got
