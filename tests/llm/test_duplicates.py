"""Near duplicates, repeated strings and fuzzy passages against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlake.llm import chains, neardup, sql, suffixes
from courierlake.llm.graph import components
from tests.llm.conftest import corpus, prose


def test_near_duplicates_match_sql(docs):
    rows = sorted({(r[0], r[1]) for r in corpus() if r[0] is not None})
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = set(map(tuple, con.execute(sql.OP4).fetchall()))
    out = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert len(out) == len(corpus())
    assert {r for r in out if r[0] is not None} == want
    assert all(r[2] is None and r[3] for r in out if r[0] is None)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """A group of graded copies: every link counts, whatever the centre."""
    base, rows = prose(11, 120).split(), []
    for i in range(60):
        own, rng = list(base), random.Random(i)
        for k in rng.sample(range(len(own)), rng.randrange(7)):
            own[k] = f"e{i}x{k}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 7)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(con.execute(sql.OP4).fetchall())


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 100), (7, 7), (None, 3)]
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def brute(texts, size=200):
    count = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if count[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check_repeats(spark, rows):
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)
    assert got == sorted(((r[0], *b) for r, b in zip(rows, brute([(r[1] or "").encode() for r in rows]))), key=repr)


def test_repeats_match_brute_force(spark):
    check_repeats(spark, [r[:2] for r in corpus() if r[0] != 14])


def test_repeats_with_overlaps_and_runs(spark, monkeypatch):
    a, b = prose(21, 90), prose(22, 90)
    rows = [(1, a + b), (2, b[50:] + a[:260]), (3, "z" * 450), (4, "z" * 199 + a[1:230]), (5, "ab" * 300), (6, a[:199]),
            (7, a[3:203]), (8, None)]
    check_repeats(spark, rows)
    monkeypatch.setattr(suffixes, "GROUP_STRINGS", 1)  # every anchor takes the sorted windows
    check_repeats(spark, rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=8), max_size=6))
def test_loser_tree(runs):
    runs = [sorted(set(r)) for r in runs]
    decoded = [suffixes.front_decode(suffixes.front_code(r)) for r in runs]
    assert [d[0] for d in decoded] == runs
    out = list(suffixes.LoserTree(decoded))
    assert [x[0] for x in out] == sorted(s for r in runs for s in r)
    for before, now in zip(out, out[1:]):
        assert now[1] == suffixes.common_prefix(before[0], now[0])


def test_passages(spark, docs):
    passage = prose(31, 80).split()
    fuzzy = list(passage)
    fuzzy[40] = "other"
    del fuzzy[60]
    rows = [(1, prose(32, 100) + " " + " ".join(passage) + " " + prose(33, 50)), (2, " ".join(fuzzy) + " " + prose(34, 90)),
            (3, prose(35, 200)), (4, " ".join(passage[:30]) + " " + prose(36, 90)), (5, None), (6, ""), (None, prose(37, 90))]
    out = [tuple(r) for r in chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert [(r[0], r[3]) for r in out] == [(2, 1)]
    assert out[0][1] <= 1 and out[0][2] >= 78 and 99 <= out[0][4] <= 101 and out[0][7] > 0.9
    pairs = {(r.doc_id, r.ref_doc_id) for r in chains.passages(docs).collect()}
    assert {(1, 0), (2, 0), (15, 0), (4, 3)} <= pairs
    assert not {r for r in pairs if {11, 14} & set(r)}


def longest_run(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


def test_passages_whose_parts_stand_in_earlier_documents(spark):
    passage = prose(41, 80, 10 ** 6).split()
    parts = [passage[:45], passage[18:63], passage[35:]]
    bodies = {1: parts[0], 2: parts[1], 3: parts[2], 10: passage, 11: parts[0], 12: parts[1], 13: parts[2], 14: parts[1], 20: passage}
    rows = [(i, " ".join([prose(100 + i, 70, 10 ** 6), *body, prose(200 + i, 70, 10 ** 6)])) for i, body in bodies.items()]
    want = {(i, j) for i, x in rows for j, y in rows if j < i and longest_run(x.split(), y.split()) >= chains.MIN_WORDS}
    out = chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert want == {(20, 10)} and [(r.doc_id, r.ref_doc_id) for r in out] == [(20, 10)]
    assert (out[0].start, out[0].end, out[0].ref_start, out[0].ref_end, out[0].n_matched) == (70, 150, 70, 150, 80)


def best_segment(a, b):
    """(score, words, equal words) of the best gapless local alignment of all."""
    best = (0.0, 0, 0)
    for shift in range(-len(b) + 1, len(a)):
        score, words, same = 0.0, 0, 0
        for i in range(max(shift, 0), min(len(a), len(b) + shift)):
            equal = a[i] == b[i - shift]
            score, words, same = score + (1 if equal else -chains.MISMATCH), words + 1, same + equal
            if score <= 0:
                score, words, same = 0.0, 0, 0
            best = max(best, (score, words, same))
    return best


def test_recall_of_changed_passages_against_all_pairs_alignment(spark):
    """Passages of 60 to 100 words with 0 to 20 % of their words changed."""
    rng, rows = random.Random(9), []
    for i in range(60):
        passage = prose(1000 + i, rng.choice([60, 80, 100]), 10 ** 6).split()
        changed = list(passage)
        for at in rng.sample(range(len(passage)), int(len(passage) * (i % 5) / 20)):
            changed[at] = f"changed{at}"
        rows.append((i, " ".join([prose(2000 + i, 20, 10 ** 6), *passage])))
        rows.append((100 + i, " ".join([prose(3000 + i, 30, 10 ** 6), *changed, prose(4000 + i, 10, 10 ** 6)])))
    words = {i: x.split() for i, x in rows}
    want = set()
    for i, a in words.items():
        for j, b in words.items():
            if j < i and len(set(a) & set(b)) >= 40:
                _, n, same = best_segment(a, b)
                if n >= chains.MIN_WORDS and same >= chains.MIN_IDENTITY * n:
                    want.add((i, j))
    found = {(r.doc_id, r.ref_doc_id) for r in chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    print(len(want), len(found & want), found - want)
    assert len(want) >= 55 and len(found & want) >= 0.9 * len(want)
    assert all(i - 100 == j for i, j in found)


def test_common_short_runs_do_not_meet_in_pairs(spark, monkeypatch):
    """A line of 30 words in every document, and runs of equal seeds: one class."""
    line = prose(77, 30, 10 ** 6)
    rows = [(i, " ".join([prose(5000 + i, 60, 10 ** 6), line, prose(6000 + i, 60, 10 ** 6)])) for i in range(40)]
    sizes, real = {}, chains.staged

    def counted(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(chains, "staged", counted)
    assert chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
    assert sizes["open"] <= 30 * len(rows)


def test_steps_of_passages_leave_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = (x.rsplit("/", 1)[-1] for x in manager.getAllFiles().mkString("\n").splitlines())
        return {x for x in names if x.startswith("shuffle_")}

    rows = [(i, prose(8000 + i // 2, 200, 10 ** 6)) for i in range(20)]
    before = files()
    out = chains.passages(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {x.split("_")[1] for x in files() - before}
    assert len(left) <= 2, left  # before: of each of the steps; looking for repeated rows is no write
    assert {(r.doc_id, r.ref_doc_id) for r in out.collect()} == {(i + 1, i) for i in range(0, 20, 2)}


def test_pairs_of_seeds_with_other_partners_are_left_out():
    pos, seed = np.array([0, 20, 40, 60]), np.array([11, 12, 13, 14])
    def keys(partner):
        return [(int(a[k]), int(b[k])) for _, a, b in chains._pairs(pos, seed, 13, 113, partner) for k in range(len(a))]
    assert len(keys(None)) == 6
    assert keys(np.array([5, 5, 6, 0])) == [(0, 20), (0, 60), (20, 60), (40, 60)]


def test_repeated_words_meet_in_proportion_to_their_number():
    """Two stretches of one word: 2,000 times 1,500 matches before."""
    own = np.arange(2000), np.full(2000, 7)
    ref = np.arange(1502), np.concatenate(([3], np.full(1500, 7), [7]))[:1502]
    a, b = chains._met(*own, chains._sorted_seeds(*ref))
    assert len(a) <= 2 * 1502 and (np.diff(a) >= 0).all()
    path = max(chains._paths(a.tolist(), b.tolist(), 18), key=lambda x: len(x[0]))
    assert len(path[0]) == 1501
    other = np.array([0, 4, 9, 30]), np.array([1, 2, 1, 9])
    assert sorted(zip(*(x.tolist() for x in chains._met(*other, chains._sorted_seeds(*other))))) == [
        (0, 0), (0, 9), (4, 4), (9, 0), (9, 9), (30, 30)]


def test_seeds_across_chunks_and_repeated_rows(spark, monkeypatch):
    words = prose(78, 300, 50).encode().split()
    whole = [x.tolist() for x in chains.seeds(words)]
    monkeypatch.setattr(chains, "CHUNK_WORDS", 17)
    assert [x.tolist() for x in chains.seeds(words)] == whole
    text = " ".join(["same"] * 400)
    rows = [(1, text), (1, text), (2, text), (2, text), (3, prose(79, 80, 10 ** 6))]
    out = chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.ref_doc_id, r.identity) for r in out] == [(2, 1, 1.0)]


def test_chain_is_the_best_by_brute_force():
    rng = random.Random(5)
    for _ in range(30):
        points = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(8)})
        best, scores = 0.0, []
        for j, (p, r) in enumerate(points):
            gains = [scores[i] - chains.GAP_COST * (p - points[i][0] + r - points[i][1])
                     for i in range(j) if points[i][0] < p and points[i][1] < r]
            scores.append(chains.SEED_SCORE + max([0.0, *gains]))
            best = max(best, scores[-1])
        path = chains.chain([p for p, _ in points], [r for _, r in points])[0]
        total = chains.SEED_SCORE * len(path) - chains.GAP_COST * sum(
            points[b][0] - points[a][0] + points[b][1] - points[a][1] for a, b in zip(path, path[1:]))
        assert abs(total - best) < 1e-9


def test_empty_tables(nothing):
    assert neardup.near_duplicates(nothing).collect() == []
    assert suffixes.remove_repeats(nothing).collect() == []
    assert chains.passages(nothing).collect() == []


def test_a_bucket_with_one_stranger_stays_in_proportion(spark, monkeypatch):
    """One component and one stranger in a bucket: rows in proportion to its
    members, however many blocks they make; and the pair is found."""
    import numpy as np

    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 8)
    n, width = 400, neardup.LOW_BITS * neardup.N_HASHES // 64
    rng = np.random.default_rng(1)
    plane = rng.integers(-2 ** 62, 2 ** 62, width).tolist()
    shared = spark.createDataFrame([(7, i, n) for i in range(n)], "key long, id long, n long")
    labels = spark.createDataFrame([(i, 0) for i in range(n - 1)], "id long, label long")
    classes = spark.createDataFrame([(i, plane, [7]) for i in range(n)], "id long, planes array<long>, bands array<long>")
    sizes, real = [], neardup.staged

    def counted(df, name):
        out = real(df, name)
        if name == "rest":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(neardup, "staged", counted)
    every = neardup._between_components(shared, labels, classes, False).distinct().collect()
    assert sizes == [n + n // 8]
    assert sorted(map(tuple, every)) == [(i, n - 1) for i in range(n - 1)]
    best = neardup._between_components(shared, labels, classes, True).distinct().collect()
    assert len(best) >= 1 and all(r.b == n - 1 for r in best)


def test_passages_whose_pairs_of_seeds_stand_in_earlier_documents(spark):
    """Each pair of seeds of a passage is first in a document that holds at most one more seed of it."""
    passage = prose(51, 80, 10 ** 6).split()
    at = chains.seeds([w.encode() for w in passage])[1].tolist()
    pairs = [(a, b) for a in at for b in at if any(low <= b - a < high for low, high in chains.PAIR_SPANS)]
    assert len(pairs) >= 10
    bodies = {}
    for i, (a, b) in enumerate(pairs):
        held = {a, b, min((x for x in at if a < x < b), key=lambda x: abs(2 * x - a - b))}
        bodies[i] = [w if any(x <= a + k < x + 5 for x in held) else f"other{i}x{k}" for k, w in enumerate(passage[a:b + 5])]
    bodies |= {1000: passage, 2000: [*passage[:at[len(at) // 2]], "changed", *passage[at[len(at) // 2] + 1:]]}
    rows = [(i, " ".join([prose(3000 + i, 70, 10 ** 6), *body, prose(6000 + i, 70, 10 ** 6)])) for i, body in bodies.items()]
    out = chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.ref_doc_id, r.start, r.end, r.ref_start, r.ref_end) for r in out] == [(2000, 1000, 70, 150, 70, 150)]


def test_chains_of_many_pairs_side_by_side():
    """Those of the recurrence of each pair alone, equal links and long ones too."""
    rng = random.Random(6)
    pairs = []
    for k in range(120):
        wide = 12 if k % 3 else 200
        points = sorted({(rng.randrange(wide), rng.randrange(wide)) for _ in range(300 if k % 40 == 0 else rng.randrange(2, 40))})
        pairs.append((np.array([p for p, _ in points]), np.array([r for _, r in points])))
    want = [chains._outer(chains._paths(p.tolist(), r.tolist(), 18)) for p, r in pairs]
    assert any(want) and chains._many_paths(pairs, 18) == want


def test_documents_that_meet_in_blocks_move_with_the_root_of_their_pairs(spark, monkeypatch):
    """80 rows against 80: 6,400 pairs. Before, each pair carried the seeds of both."""
    import pyarrow as pa

    monkeypatch.setattr(chains, "BLOCK_PAIRS", 400)
    pairs = spark.createDataFrame([(i, j) for i in range(80) for j in range(100, 180)], "row long, ref long")
    rows = spark.createDataFrame([(i, [i] * 3) for i in range(81)], "row long, pos array<int>")
    refs = spark.createDataFrame([(j, [j] * 3) for j in range(100, 181)], "ref long, ref_pos array<int>")

    def work(left, right):
        held = set(right.column("ref").to_pylist())
        met = [(row, x["ref"]) for row, of in zip(left.column("row").to_pylist(), left.column("of").to_pylist()) for x in of]
        assert {ref for _, ref in met} == held
        return pa.table({"n": [left.num_rows + right.num_rows] + [0] * len(met), "row": [-1] + [r for r, _ in met], "ref": [-1] + [r for _, r in met]})

    out = chains._in_blocks(pairs, rows, refs, work, "n long, row long, ref long", F.size("pos"), F.size("ref_pos")).collect()
    met = [(r.row, r.ref) for r in out if r.row >= 0]
    assert len(met) == 6400 and set(met) == {(r.row, r.ref) for r in pairs.collect()}
    assert sum(r.n for r in out) <= 4 * 160  # four lines of four blocks


def test_common_words_are_counted_behind_equal_ends():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randrange(9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert chains._common(a, b) == table[-1][-1]
