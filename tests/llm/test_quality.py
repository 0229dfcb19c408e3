import random

import pytest

from cases import SF_SMALL, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import quality as Q
from patrolcast.llm.common import ROW, table

PROSE = "this is a plain sentence of an ordinary text, and it goes on for quite a few words more."


def _base(text):
    """The measures that the contract fixes, word by word."""
    words, run = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            words += [run] if run else []
            run = ""
        else:
            run += ch
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_base_measures(spark, odd_documents, table_dir):  # noqa: F811
    rng = random.Random(6)
    texts = [None, "", " \n", "a\x85b c d", "x " * 30, "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h", *(
        " ".join(rng.choice(["a", "b#", "ü", "a\n", "|"]) for _ in range(n)) for n in (5, 19, 20, 60, 200))]
    for t in texts:
        j = Q.judge(t)
        assert (j["n_words"], j["word_chars"], j["n_symbols"], j["n_dup_lines"], j["n_repeat_words"], j["base_failed"]) == _base(t)
    got = sorted((tuple(r)[:7] for r in Q.op6_quality_rules(spark, table_dir(documents=odd_documents)).collect()), key=repr)
    assert got == sorted(((r.doc_id, *_base(r.text)) for r in odd_documents.collect()), key=repr)
    assert Q.clean(odd_documents.limit(0)).count() == 0
    assert Q.clean(odd_documents).select(f"{ROW}.*").columns == odd_documents.columns


@pytest.mark.parametrize("line,fault", [
    (PROSE, None), ("short line", None), ("Home | News | Sport | Login", "navigation"), ("Shop > Books > Prose > Old", "navigation"),
    ("so$$$ many### symbols&&& here***", "punctuation"), ("word " * 45, "punctuation"), ("word " * 45 + "end.", None),
    ("© 2020 Some Body. All rights reserved.", "boilerplate"), ("Please read our Privacy Policy", "boilerplate"),
    ("10 % of them and 5 % of us, in a sentence of ordinary length", None)])
def test_line_rules(line, fault):
    assert Q.line_fault(line, Q.split_words(line)) == fault


def test_verdict():
    j = Q.judge("\n".join([PROSE, "Home | News | Sport | Login", "The other lines of it read well too."]))
    assert j["kept"] and j["bad_navigation"] == 1 and j["lost_words"] == 7 and "Home" not in j["kept_text"]
    assert not Q.judge(PROSE + "\n" + "a$ b$ c$ d$ e$ " * 10)["kept"]
    assert Q.judge(" ".join(f"w{i}" for i in range(30)) + ".")["kept"]


def test_labels_of_the_given_documents(spark):
    got = Q.op6_quality_rules(spark, SF_SMALL).join(table(spark, SF_SMALL, "labels"), "doc_id")
    assert got.where("kept AND quality = 0").count() == 0
    assert got.where("NOT kept AND NOT base_failed AND quality = 1").count() == 0
