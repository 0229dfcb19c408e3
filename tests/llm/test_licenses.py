from cases import SF_MID, documents
from patrolcast.llm import licenses as L
from patrolcast.llm.common import table


def test_families_of_the_given_documents(spark):
    """Each document's licences are those whose notice it holds, and no other document has any."""
    notice = {"CC-BY-NC": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "GNU General Public License, version 3.", "MIT": "the MIT License.",
              "Apache-2.0": "Apache License, Version 2.0.", "proprietary": "All rights reserved."}
    want = {r.doc_id: ",".join(sorted(f for f, s in notice.items() if s in (r.text or "")))
            for r in table(spark, SF_MID, "documents").collect()}
    got = {r.doc_id: r.licences for r in L.op7_license_scan(spark, SF_MID).collect()}
    assert got == want and sum(map(bool, want.values())) > 30


def test_unseen_wordings_mentions_and_odd_rows(spark):
    base = [(i, f"ordinary words of text number {i}, and nothing else in here.", "en", "a") for i in range(100, 160)]
    texts = {1: "© 2019 Jane Roe\nThis file is licensed under the MIT license.", 2: None, 3: "", 4: " \n ",
             5: "MIT and the public know the GNU animal; my driver's license is a licence.", 6: "Some code\nis distributed under the GNU General Public License, version 2.",
             7: "you may use it under the Apache License Version 2.0", 8: "DER!! MIT!! UND!! ALL!!", 9: "license", 10: "Licensed under CC BY-NC 4.0.\n" * 3 + "All rights reserved."}
    rows = [(i, t, None, None) for i, t in texts.items()] + base + [(1, texts[1], None, None), (None, texts[6], "x", "y")]
    df = documents(spark, rows)
    found = {}
    for r in L.scan(df).where("confirmed").join(df.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS k1"), "k1").collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    assert found == {1: {"MIT"}, 6: {"GPL-2.0"}, None: {"GPL-2.0"}, 7: {"Apache-2.0"}, 10: {"CC-BY-NC", "proprietary"}}


def _wrapped(text, width):
    lines, line = [], ""
    for w in text.split(" "):
        if line and len(line) + 1 + len(w) > width:
            lines.append(line)
            line = ""
        line = f"{line} {w}" if line else w
    return "\n".join([*lines, line])


def test_wrapped_notices_name_the_family_of_unwrapped_ones(spark):
    """Every template, on one line, wrapped, and inside a long paragraph: its own family and no other."""
    base = [(i, f"ordinary words of text number {i}, and nothing else in here.", "en", "a") for i in range(100, 160)]
    prose = " ".join(f"they went on to talk of things number{i} and of others" for i in range(30))
    rows, want = [], {}
    for k, (family, said) in enumerate(L.TEMPLATES):
        for j, text in enumerate((said, _wrapped(said, 40), _wrapped(said, 20), f"An own text.\n\n{_wrapped(said, 33)}\n\nMore of it.")):
            rows.append((1000 + 10 * k + j, text, None, None))
            want[1000 + 10 * k + j] = {family}
    gpl = L.TEMPLATES[6][1]
    rows += [(5, f"{prose} {gpl} {prose}", None, None), (6, "Public License as published by", None, None),
             (7, "redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation", None, None)]
    want[5] = {"GPL-3.0"}
    df = documents(spark, rows + base)
    found = {}
    for r in L.scan(df).where("confirmed").join(df.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS k1"), "k1").collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    assert found == want


def plain_confirmed(family, ws):
    """Confirmation by sets of word pairs."""
    pairs = {tuple(ws[i:i + 2]) for i in range(len(ws) - 1)}
    cover = dict.fromkeys(L.FAMILIES, 0.0)
    for f, said in L.TEMPLATES:
        t = L.template_words(said)
        t = {tuple(t[i:i + 2]) for i in range(len(t) - 1)}
        both = len(pairs & t)
        cover[f] = max(cover[f], both / len(t), both / len(pairs) if both >= 2 else 0.0)
    return cover[family] >= 0.6 and all(c < cover[family] for f, c in cover.items() if f != family)


def test_confirmation_and_features_equal_plain_versions(spark):
    import random
    from pyspark.sql import functions as F
    rng = random.Random(6)
    rows = []
    for _ in range(400):
        _, said = rng.choice(L.TEMPLATES)
        ws = L.template_words(said)
        a = rng.randint(0, len(ws) - 1)
        ws = ws[a:a + rng.randint(1, 30)] + [rng.choice(["and", "license", "gnu", "x"]) for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice(L.FAMILIES) if rng.random() < 0.5 else next(f for f, s in L.TEMPLATES if s == said), ws))
    df = spark.createDataFrame(rows, "family string, w array<string>").withColumn("pairs", L.grams(F.col("w"), 2)).withColumn("cover", L.covers())
    got = [r.c for r in df.select(L.confirmed().alias("c")).collect()]
    assert got == [plain_confirmed(f, ws) for f, ws in rows] and 20 < sum(got) < 380
    long = [f"w{i}" for i in range(200)]
    parts = spark.createDataFrame([(long,), (long[:7],), (long[:60],), (long[:61],)], "w array<string>").select(L.windows(F.col("w")).alias("p")).collect()
    assert [[(p[0], len(p)) for p in r.p] for r in parts] == [
        [("w0", 60), ("w30", 60), ("w60", 60), ("w90", 60), ("w120", 60), ("w150", 50)], [("w0", 7)], [("w0", 60)], [("w0", 60), ("w30", 31)]]
    text = "a\nb\n\nc\n \t\n\nd\n"
    assert spark.createDataFrame([(text,)], "t string").select(L.paragraphs_of(F.col("t")).alias("p")).first().p == ["a\nb", "c", "d\n"]


def test_calibration_never_calls_an_empty_paragraph_a_licence(spark):
    """Few and odd paragraphs to learn from: a defined result, no error."""
    for texts in (["x"], ["GNU GNU GNU license version"] * 3, ["All rights reserved."] * 50):
        found = L.Classifier(spark.createDataFrame([(t,) for t in texts], "said string"))
        b = found.model.interceptVector.toArray()
        assert found.slope * (max(b[1:]) - b[0]) + found.shift < 0
        df = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
        assert L.scan(df).where("family = 'unknown'").count() == 0


def test_empty(spark, tmp_path):
    documents(spark, [(1, "x")]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert L.op7_license_scan(spark, str(tmp_path)).count() == 0


def test_templates_are_plain_words():
    assert all(w.replace(".", "").isalnum() and w.isascii() for _, s in L.TEMPLATES for w in L.template_words(s))
