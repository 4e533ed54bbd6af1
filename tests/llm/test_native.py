"""Quality rules, mixing and surrogates, the operators made of Spark functions only."""

from __future__ import annotations

import re

from clickloom.llm.columns import word_count
from clickloom.llm.mixing import mix, mixed_documents
from clickloom.llm.quality import measure, quality_filter
from clickloom.llm.surrogates import replace_entities
from pyspark.sql import functions as F

from .samples import LONG, sentences, varied, words

GOOD = "\n".join(f"Line {i} says {sentences(f'good-{i}', 9)}." for i in range(12))
MENU = "Home | Shop | News | About\nclick here\nLOGIN NOW\n" * 30


def base(text):
    text = text or ""
    own = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    hit = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_measures_equal_brute_force(spark, documents):
    texts = [t for t in varied(3, 10) if t != LONG] + [GOOD, MENU, "a b a b a b a", "x\nx\n\nx", " ".join("abc" * 90)]
    got = {r.doc_id: r for r in measure(documents(*texts)).collect()}
    for doc, text in enumerate(texts, 1):
        r, want = got[doc], base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_rejects_furniture_and_keeps_clean_text(spark, documents):
    kept = quality_filter(documents(GOOD, MENU, None, "", LONG)).collect()
    assert [r.doc_id for r in kept] == [1] and kept[0].text == GOOD
    assert quality_filter(documents(GOOD).limit(0)).collect() == []


def test_quality_replaces_clashing_columns(spark):
    rows = spark.createDataFrame([(1, GOOD, "x", "y")], "doc_id long, text string, kept string, row string")
    (r,) = measure(rows).collect()
    assert r.kept is True and r.row == "y"


def test_mix_meets_targets_and_bounds(spark, documents):
    rows = [(i, sentences(i, 5 + i % 40), ["big", "mid", None][min(i % 7, 2)]) for i in range(300)]
    rows += [(900, None, "mid"), (901, "", "tiny"), (902, "one two", "tiny")]
    docs = documents(*rows)
    got = mix(docs, word_count(F.col("text"))).collect()
    assert len(got) == len(rows)
    taken, target = {}, {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.target <= 3 * r.source_size
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)
    assert abs(sum(target.values()) - sum(len(words(t)) for _, t, _ in rows)) < 1
    again = mix(docs.repartition(5), word_count(F.col("text"))).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_mix_of_nothing(spark, documents):
    empty = documents("x").limit(0)
    assert mix(empty, word_count(F.col("text"))).collect() == []
    (r,) = mix(documents((1, None, "a")), word_count(F.col("text"))).collect()
    assert (r.size, r.source_size, r.target, r.taken) == (0, 0, 0.0, 0)


def test_surrogates_are_consistent_and_distinct(spark, documents):
    texts = [
        "Mail ann.lee@example.com or bob@example.org now.",
        "ann.lee@example.com wrote; call +1 555 010 9999.",
        "Nothing personal here.",
        None,
        "",
    ]
    got = {r.doc_id: r.text for r in replace_entities(documents(*texts)).collect()}
    mail = re.compile(r"[\w.+-]+@[\w.-]*\w")
    one, two = mail.findall(got[1]), mail.findall(got[2])
    assert len(one) == 2 and len(two) == 1
    assert one[0] == two[0] != one[1]
    assert not {"ann.lee@example.com", "bob@example.org"} & {*one, *two}
    assert "+1 555 010 9999" not in got[2]
    assert (got[3], got[4], got[5]) == (texts[2], None, "")
    again = {r.doc_id: r.text for r in replace_entities(documents(*texts)).collect()}
    assert again == got
    other = {r.doc_id: r.text for r in replace_entities(documents(*texts), key="another").collect()}
    assert other[1] != got[1]
    assert replace_entities(documents("x").limit(0)).collect() == []


def test_surrogates_keep_other_columns(spark):
    rows = spark.createDataFrame([(1, "a@example.com", "v")], "doc_id long, text string, value string")
    (r,) = replace_entities(rows).collect()
    assert r.value == "v" and r.text != "a@example.com"
