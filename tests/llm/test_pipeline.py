"""The pipeline's stages against plain Python versions of what they decide."""

import pytest

import corpus_pipeline
from corpus_pipeline import COLUMNS
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], SCHEMA)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def groups(rows):
    """Components of rows whose five-word shingles are alike at 0.75."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def corpus():
    base, other = prose(1, 200), prose(2, 200)
    near = base.split()
    near[50] = "CHANGED"
    return [(1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, other, None, "b"), (4, base.upper(), "en", "c"),
            (5, prose(3, 60), "en", "a"), (6, prose(4, 60), "de", None)]


REPEATED = [(2, prose(11, 150), "en", "x"), (7, prose(12, 150), "en", "x"), (7, prose(13, 150), "en", "x"),
            (7, prose(12, 150), "en", "other"), (8, prose(14, 90), "en", "x"), (8, prose(14, 90), "en", "x"),
            (None, prose(15, 90), "en", "x"), (None, prose(15, 90) + " end", "en", "x"), (None, prose(16, 90), "en", "x")]


@pytest.mark.parametrize("rows", [corpus(), corpus() + REPEATED, []], ids=["plain", "repeated ids", "empty"])
def test_near_duplicates(spark, rows):
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect()]
    whole = [(i, t, lang, src, len(t)) for i, t, lang, src in rows]
    label = groups(rows)
    assert set(kept) <= set(whole)
    # One of each group, and the smallest id where the group has no repeated one.
    assert sorted(label[whole.index(k)] for k in kept) == sorted(set(label))
    often = [r[0] for r in rows if [x[0] for x in rows].count(r[0]) > 1 or r[0] is None]
    for one in set(label):
        own = [r for r, g in zip(whole, label) if g == one]
        if not any(r[0] in often for r in own):
            assert min(own) in kept


def test_language_keeps_clean_documents(spark):
    rows = corpus() + [(20, None, "en", "a"), (21, "123 ... 456", "en", "a"), (22, "", None, "a")]
    kept = corpus_pipeline.language(spark, frame(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3, 4, 5, 6]
    assert all(r.lang is not None and r.text == dict((x[0], x[1]) for x in rows)[r.doc_id] for r in kept)


def test_decontamination_drops_what_the_rule_says(spark, tmp_path):
    item = prose(30, 40)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, item, "en", "a"), (2, prose(31, 400) + " " + " ".join(item.split()[:15]), "en", "a"),
            (3, prose(32, 100) + " " + item, "en", "a"), (4, prose(33, 100), "en", "a"), (5, " ".join(item.split()[:12]), "en", "a")]
    kept = corpus_pipeline.decontamination(spark, frame(spark, rows), str(tmp_path)).collect()

    def contaminated(text):
        words, bench = text.lower().split(), item.lower().split()
        windows = {tuple(bench[i:i + 13]) for i in range(len(bench) - 12)}
        hit = {j for i in range(len(words) - 12) if tuple(words[i:i + 13]) in windows for j in range(i, i + 13)}
        return len(hit) > 0 and 20 * len(hit) >= len(words)
    assert sorted(r.doc_id for r in kept) == [r[0] for r in rows if not contaminated(r[1])]


def test_personal_data_and_packing_keep_every_document(spark):
    rows = [(1, "write to jane.doe@example.org now", "en", "a"), (2, prose(40, 5000), "en", "a"), (3, None, "en", "a")]
    clean = corpus_pipeline.personal_data(spark, frame(spark, rows), "")
    out = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == COLUMNS and sorted(out) == [1, 2, 3]
    assert "jane.doe@" not in out[1].text and out[1].n_chars == len(out[1].text) and out[2].text == rows[1][1]
    pieces = corpus_pipeline.packed(spark, clean, "").collect()
    assert {r.doc_id for r in pieces} == {1, 2, 3}
    for doc in (1, 2, 3):
        own = sorted((r.start, r.length, r.doc_tokens) for r in pieces if r.doc_id == doc)
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[-1][0] + own[-1][1] == own[0][2]


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == [], name
