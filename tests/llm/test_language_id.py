import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cases import SF_MID, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import language_id as L
from patrolcast.llm.common import ROW, table


def test_phrases_match_naive_parsing():
    samples = {"x": "the cat sat on the mat and the hat", "y": "der hund und die katze im haus", "z": "a"}
    model = L.CrossParser(samples)
    rng = np.random.default_rng(3)
    texts = ["the hat", "die katze", "zzz", "q" * 50, "the cat sat on the mat and the hat", "a",
             *("".join(rng.choice(list("theacd runk"), 3000)) for _ in range(3))]
    codes = [model.encode(t) for t in texts]
    n = np.array([len(c) for c in codes])
    got = model.phrases(np.concatenate(codes), n) * np.array([a.bits for a in model.automata]) / n[:, None]
    want = [[brute.cross_entropy(t, samples[k]) for k in model.langs] for t in texts]
    assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents")
    got = L.op3_language_id(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right / n >= 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_odd_rows(spark, odd_documents, table_dir):
    d = table_dir(documents=odd_documents)
    got = L.op3_language_id(spark, d).collect()
    assert len(got) == odd_documents.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].lang_pred for i in (3, 4, 5, 6)] == ["und"] * 4 and by[3][0].score == 0
    assert {r.lang_pred for r in by[1] + by[2] + by[None]} == {"en"} and by[8][0].lang_pred in ("de", "en")
    kept = L.stage(spark, odd_documents, d)
    assert kept.columns == odd_documents.columns and kept.count() == 7


FOREIGN = {
    "pl": "Język polski należy do grupy zachodniosłowiańskiej języków indoeuropejskich. Jest językiem urzędowym w Polsce oraz jednym "
          "z języków Unii Europejskiej, a mówi nim około czterdziestu milionów ludzi na całym świecie dzisiaj, także poza krajem.",
    "ru": "Русский язык является одним из восточнославянских языков, национальным языком русского народа. " * 3,
    "no": "kjh3 xq9z wvv0 zzqk " * 20}


def test_stage_fills_languages_and_rejects_strange_texts(spark):
    given = table(spark, SF_MID, "documents")
    fresh = given.where("length(text) > 300").limit(40).withColumn("true", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(-i, t, None, "x", len(t), k) for i, (k, t) in enumerate(FOREIGN.items(), 1)] +
                                [(-9, "kurz", None, "x", 4, "short"), (-8, "123 !", None, "x", 5, "und"), (-7, FOREIGN["pl"], "pl", "x", 9, "pl")], fresh.schema)
    got = {r.doc_id: r for r in L.stage(spark, fresh.unionByName(odd), SF_MID).collect()}
    assert set(got) - {-9} == {r.doc_id for r in fresh.collect()} and -9 in got  # short texts are never strange
    assert sum(r.lang == r.true for r in got.values()) >= 38 and all(r.lang for r in got.values())
    kept = L.stage(spark, given, SF_MID)
    assert kept.columns == given.columns and kept.join(given, ["doc_id", "text", "lang"]).count() == kept.count() >= 0.99 * given.count()


def test_low_score_is_no_reason_to_go(spark):
    """Two languages that share a text's words score near 0; the text stays."""
    samples = dict.fromkeys("ab", "the cat and the dog sat on the mat " * 60)
    df = spark.createDataFrame([(1, "the cat and the dog sat on the mat " * 10)], "doc_id long, text string")
    r = L.identify(df, samples, F.col(f"{ROW}.text")).first()
    assert r.score == 0 and r.strange < 1.5 and r.lang_pred == "a"


def test_stage_without_labels_passes_rows_through(spark, odd_documents, table_dir):
    none = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    out = L.stage(spark, none, table_dir(documents=none))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, none.collect()), key=repr)


def test_own_bits_are_those_of_plain_parsing():
    text = "".join(np.random.default_rng(2).choice(list("abcd efg"), 6000))
    model = L.CrossParser({"x": text, "y": "too short"})
    said = L.fold(text)
    half = len(said) // 2
    rest, known, phrases = said[half:], said[:half], 0
    for at in range(0, len(rest), L.LANE):
        part, i = rest[at:at + L.LANE], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i:i + n + 1] in known:
                n += 1
            i, phrases = i + n, phrases + 1
    assert np.isclose(model.usual[0], phrases * np.log2(half + 2) / len(rest), rtol=1e-3) and model.usual[1] == np.inf


def test_empty_and_unlabelled(spark, odd_documents, table_dir):
    d = table_dir(documents=odd_documents.limit(0))
    assert L.op3_language_id(spark, d).count() == 0
    assert L.identify(odd_documents.select("text"), {}, F.col(f"{ROW}.text")).where("lang_pred != 'und'").count() == 0


@pytest.mark.parametrize("bound", [50, 500])
def test_sample_is_bounded(spark, bound):
    s = L.train(table(spark, SF_MID, "documents"), chars_per_lang=bound)
    assert len(s) == 4 and all(len(v) <= bound for v in s.values())


def test_lowest_pieces_do_not_depend_on_the_bound(spark):
    """Even hashes, hashes in the top of the range only (the bound is raised until enough pass), few rows, many copies."""
    top = (1 << 63) - 1
    rows = [("en", -(1 << 63) + i * (1 << 54), f"e{i}") for i in range(900)] + [("de", top - i, f"d{i}") for i in range(900)] + \
        [("fr", i, f"f{i}") for i in range(3)] + [("fr", 1, "f1")] * 500 + [("es", 7, "x")] * 2000
    df = spark.createDataFrame(rows, "lang string, h long, piece string").repartition(5)
    for wanted in (1, 20, 5000):
        want = {}
        for lang, h, piece in sorted(set(rows)):
            want.setdefault(lang, []).append(piece)
        assert L.lowest_pieces(df, wanted) == {k: v[:wanted] for k, v in want.items()}
    assert L.lowest_pieces(df.where("false"), 5) == {}


def test_copies_count_once(spark):
    texts = ["one text of many copies", "a second text", "and a third one"]
    df = spark.createDataFrame([(t, "en") for t in texts for _ in range(20)], "text string, lang string")
    assert sorted(L.train(df, docs_per_lang=3)["en"]) == sorted(" ".join(texts))
    assert len(L.train(df, docs_per_lang=2)["en"]) > max(map(len, texts))  # two different ones, not a text twice


def test_every_character_of_a_sample_counts():
    rng = np.random.default_rng(8)
    signs = [chr(0x4E00 + i) for i in range(1500)]
    samples = {"x": "".join(rng.choice(signs, 6000)), "y": "".join(rng.choice(signs[700:], 3000)), "z": "a plain text"}
    model = L.CrossParser(samples)
    texts = [samples["x"][100:1900], samples["y"][5:300] + "text " + samples["x"][:50], "".join(signs), "\u7fff a b"]
    codes = [model.encode(t) for t in texts]
    n = np.array([len(c) for c in codes])
    got = model.phrases(np.concatenate(codes), n) * np.array([a.bits for a in model.automata]) / n[:, None]
    assert np.allclose(got, [[brute.cross_entropy(t, samples[k]) for k in model.langs] for t in texts])
    assert model.predict(texts[:2])[0] == ["x", "y"]
