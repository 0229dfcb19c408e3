import random

import brute
from cases import SF_SMALL, documents, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import line_dedup as L
from patrolcast.llm.common import ROW, table


def _texts(df):
    return sorted(((r[0].doc_id, r.kept_text) for r in df.select(ROW, "kept_text").collect()), key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(4)
    pool = ["Sign in to your account now", "Page 12 of 30", "Page 7 of 30", "a b c", "  a  b c ", "x"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 3))]
        lines += [f"user {rng.choice(['ann', 'bob', 'cy', 'dee'])} of the site logged {rng.choice(['in', 'out', 'off'])} at {rng.randint(0, 99)} today"]
        lines += [" ".join(rng.choice("pqrstuvw") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 5))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (None, rows[5][1]), (202, None), (203, ""), (204, " \n \n"), (7, "x\nnew line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, exact in ((3, None), (10, None), (40, None), (10, 2), (40, 5)):
        want = brute.line_dedup(rows, k, exact_docs=exact)
        assert _texts(L.dedup(df, k, exact)) == sorted(want, key=repr)
    assert brute.line_dedup(rows, 10) != rows


def test_given_documents(spark):
    """The registered setting."""
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = brute.line_dedup(rows, L.MIN_DOCS, exact_docs=L.EXACT_DOCS)
    assert sorted(((r.doc_id, r.text) for r in L.op2_line_dedup(spark, SF_SMALL).collect()), key=repr) == sorted(want, key=repr)
    assert want != rows


def test_odd_rows_and_stage(spark, odd_documents):
    out = L.dedup(odd_documents, 1)  # every line recurs; first texts keep theirs
    assert out.count() == odd_documents.count()
    kept = L.stage(spark, odd_documents, None)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
    assert L.stage(spark, odd_documents.limit(0), None).count() == 0
    rows = [(i, "always the same line here", "en", "s", 25) for i in range(12)]
    own = [f"own text number {'abcdefghijkl'[i] * 9}" for i in range(12)]
    df = spark.createDataFrame([(i, f"{t}\n{own[i]}" if i % 2 else t, *r) for i, t, *r in rows], odd_documents.schema.names[:5])
    got = {r.doc_id: r.text for r in L.stage(spark, df, None).collect()}
    # equal texts 0, 2, 4, ... hold the line first and keep it; the odd ones lose it and are left with their own
    assert got == {i: own[i] if i % 2 else rows[i][1] for i in range(12)}


def test_recall_of_planted_templates_by_number_of_texts(spark):
    """Lines that differ in one word recur as a template from MIN_DOCS texts on, and stay below; equal lines go from two on."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    lines = [(f"t{k}", f"{lead} reports that {word()} has left the building today") for k in (*range(2, 10), 10, 12)
             for lead in [word()] for _ in range(k)]
    lines += [(f"e{k}", same) for k in (2, 3, 9) for same in [f"{word()} is one and the same line"] for _ in range(k)]
    df = spark.createDataFrame([(i, f"{line}\n{word()}") for i, (_, line) in enumerate(lines)], "doc_id long, text string")
    gone = {r[0].doc_id for r in L.dedup(df, exact_docs=L.EXACT_DOCS).where("n_dropped = 1").select(ROW).collect()}
    caught = {k: sum(i in gone for i, (x, _) in enumerate(lines) if x == k) for k in dict(lines)}
    assert caught == {**{f"t{k}": 0 for k in range(2, 10)}, "t10": 9, "t12": 11, "e2": 1, "e3": 2, "e9": 8}


def test_lines_in_two_texts(spark, table_dir):  # noqa: F811
    """What recurs in two texts goes from the second; lines that only differ in a number do not."""
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(1, f"{long}\nsays one\nin 1998 it rained 3 days"), (2, f"own two\n  {long}\nin 1998  it rained 3 days"),
            (3, "own three\nin 1997 it rained 4 days\nshort"), (4, "short\nown four")]
    df = documents(spark, rows)
    want = {1: rows[0][1], 2: "own two", 3: rows[2][1], 4: "own four"}
    assert {r.doc_id: r.text for r in L.op2_line_dedup(spark, table_dir(documents=df)).collect()} == want
    assert {r.doc_id: r.text for r in L.stage(spark, df, None).collect()} == want


def test_several_templates_in_a_leaf(spark):
    """Templates of 60 and 40 texts, of a third each, and one among many other lines with its start."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    forms = [("alert from host {} disk space is running low", 60), ("alert from host {} cpu load has been high", 40),
             *((f"notice to all {{}} {x}", 20) for x in ("we close at noon", "please wash your hands", "bring some own food")),
             ("posted on forum {} under the common terms", 12)]
    lines = [(k, f.format(word())) for k, (f, n) in enumerate(forms) for _ in range(n)]
    lines += [(None, "posted on forum " + " ".join(word() for _ in range(5))) for _ in range(90)]
    rng.shuffle(lines)
    df = spark.createDataFrame([(i, f"{line}\n{word()}") for i, (_, line) in enumerate(lines)], "doc_id long, text string")
    first = {k: i for i, (k, _) in reversed(list(enumerate(lines)))}
    gone = {r[0].doc_id for r in L.dedup(df).where("n_dropped = 1").select(ROW).collect()}
    assert gone == {i for i, (k, _) in enumerate(lines) if k is not None and first[k] != i}
