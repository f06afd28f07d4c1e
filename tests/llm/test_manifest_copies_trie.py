"""Merkle manifest, exact duplicates and the conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlake.llm import exactdup, manifest, sql, trie
from courierlake.llm.parens import Parens
from tests.llm.conftest import SCHEMA, corpus
from tests.llm.test_text_operators import duck, got

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def expected_manifest(rows):
    """(doc_id, leaf, subroot, root, siblings) of (doc_id, text, lang, source, n_chars) rows."""
    def leaf(r):
        doc_id, text, lang, source, n = r[:5]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, g in enumerate(names):
        for i, x in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            siblings = []
            for tree, at in ((trees[k], i), (top, k)):
                for nodes in tree[:-1]:
                    siblings += nodes[at ^ 1:(at ^ 1) + 1]
                    at //= 2
            out.append((x[3], x[2], trees[k][-1][0], top[-1][0], h(*siblings)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run, block", [(1 << 14, 8), (1, 1), (3, 2)])
def test_manifest_brute_force(spark, docs, monkeypatch, run, block):
    monkeypatch.setattr(manifest, "RUN_LEAVES", run)
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", block)
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("tree", "part", "r", "digest", "tie", "carried", "total")])
    found = manifest.manifest(clash).withColumn("folded", manifest.fold(F.col("leaf"), F.col("path")))
    rows = found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("p"), "folded").collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected_manifest(corpus())
    assert all(r.folded == r.root for r in rows)


def test_manifest_empty_and_tampered(spark, nothing, docs):
    assert manifest.manifest(nothing).collect() == []
    more = manifest.digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    found = manifest.manifest(docs, carry={"changed": more}).select(
        "leaf", "carried.changed", "root", manifest.fold(F.col("carried.changed"), F.col("path")).alias("folded")).collect()
    assert {r.changed != r.leaf for r in found} == {True, False}  # a null length stays
    assert all((r.folded == r.root) == (r.changed == r.leaf) for r in found)


@given(st.integers(1, 60), st.integers(0, 59), st.integers(1, 60))
@settings(max_examples=150, deadline=None)
def test_multiproof_is_least(total, start, size):
    """Without any one of the missing nodes some path cannot be derived, with
    all of them every path can, and none lies below another."""
    start %= total
    end = min(total, start + size)
    leaves = [h(str(i)) for i in range(total)]
    tree = levels(leaves)
    missing = list(manifest.missing(start, end, total))
    found = manifest.paths(start, leaves[start:end], total, {(k, i): tree[k][i] for k, i in missing})
    for at, path in zip(range(start, end), found):
        want = [(-1 if (at >> k) & 1 else 1, tree[k][(at >> k) ^ 1]) if (at >> k) ^ 1 < len(tree[k]) else (0, None)
                for k in range(len(tree) - 1)]
        assert path == want
    below = {(k, i): set(range(i << k, min(total, (i + 1) << k))) for k, i in missing}
    assert set().union(*below.values()) == set(range(total)) - set(range(start, end))
    assert sum(map(len, below.values())) == total - (end - start)


def expected_copies(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        text = "".join(" " if c in " \t\n\v\f\r" else c for c in r[1] or "")
        while "  " in text:
            text = text.replace("  ", " ")
        groups[text].append((r[0] is None, r[0] or 0, i, r[0]))
    return sorted(((x[3], min(g)[3], len(g), x == min(g), h(t)) for t, g in groups.items() for x in g), key=repr)


COPIES = [(30, "a \t b", None, None, 1, 1, "", ""), (31, "a b", "x", None, 1, 1, "", ""), (5, "a\n\nb", None, "s", 1, 1, "", ""),
          (32, " a b", None, None, 1, 1, "", ""), (33, "ab", None, None, 1, 1, "", ""), (34, "b a", None, None, 1, 1, "", ""),
          (35, " ", None, None, 1, 1, "", ""), (36, "\U0001f600" * 130, None, None, 1, 1, "", ""),
          (37, "\U0001f600" * 130, None, None, 1, 1, "", ""), (38, "\U0001f600" * 129 + "x", None, None, 1, 1, "", "")]


@pytest.mark.parametrize("options", [{}, {"chunk": 64}, {"chunk": 7, "bases": (3,), "modulus": 5}])
def test_copies_brute_force(spark, docs, options):
    """The last options make unlike texts share fingerprints all the time."""
    every = docs.unionByName(spark.createDataFrame(COPIES, SCHEMA)).select(
        "*", *[F.lit("z").alias(c) for c in ("id", "sha", "k", "chunk", "print", "rest", "size")])
    found = got(exactdup.exact_duplicates(every, **options))
    # Which of rows with one id and one text stays is not fixed.
    def loose(rows):
        return sorted((r[:3] + r[4:] for r in rows), key=repr), sum(r[3] for r in rows)
    assert loose(found) == loose(expected_copies(corpus() + COPIES))
    kept = [(r[1], r[4]) for r in found if r[3]]
    assert len(set(kept)) == len(kept)


def test_copies_empty(nothing):
    assert exactdup.exact_duplicates(nothing).collect() == []


@given(st.binary(max_size=300), st.lists(st.integers(0, 300), max_size=4))
@settings(max_examples=100, deadline=None)
def test_fingerprint_composes(data, cuts):
    edges = sorted({0, len(data), *(min(c, len(data)) for c in cuts)})
    parts = [data[a:b] for a, b in zip(edges, edges[1:])]
    for k, base in enumerate(exactdup.BASES):
        whole = sum((b + 1) * pow(base, len(data) - 1 - i, exactdup.MODULUS) for i, b in enumerate(data)) % exactdup.MODULUS
        value = (0, 0)
        for part, own in zip(parts, exactdup.hashes(parts, exactdup.BASES)[:, k] if parts else []):
            value = exactdup.combine(value, (int(own), len(part)), base)
        assert value == (whole, len(data))


@given(st.integers(0, 10 ** 6), st.integers(1, 200), st.sampled_from([2, 8, 64]))
@settings(max_examples=100, deadline=None)
def test_parentheses(seed, n, block):
    rng, bits, open_now, left = random.Random(seed), [1], 1, n
    while open_now:
        more = left and (open_now == 1 or rng.random() < 0.55)
        bits.append(1 if more else 0)
        open_now += 1 if more else -1
        left -= bool(more)
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree, opens = Parens(np.array(bits), block), np.flatnonzero(bits)
    ends = tree.findclose(opens)
    assert ends.tolist() == [close[i] for i in opens]
    assert tree.rank_open(opens).tolist() == list(range(len(opens)))
    assert tree.rank_pairs(opens, ends).tolist() == [
        sum(bits[k] > bits[k + 1] for k in range(i, close[i])) for i in opens.tolist()]


def conversations():
    """Shared heads, copies, a branch in each family, no turns of its own, nulls, ties."""
    rng, rows = random.Random(5), []
    for c in (*range(0, 30), *range(100, 130), *range(400, 420), 7 * 10 ** 9):
        start = [("user", f"hello {rng.randrange(3)}"), ("assistant", f"hi {rng.randrange(2)}")]
        for k, (role, text) in enumerate(start + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "x" * 70000]))
                                                  for _ in range(rng.randrange(0, 7))]):
            rows.append((c, k if rng.random() > 0.02 else None, role, text, "z"))
    rows += [(500 + c, t, "user", "same") + ("z",) for c in range(40) for t in range(3)]
    return rows + [(600, 1, "user", "tie", "z"), (600, 1, "user", "tie", "z"), (600, 1, "user", "other", "z"),
                   (None, 1, "user", "nobody", "z"), (601, 0, "user", "only", "z")]


def expected_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, h(f"{len(role)}:{role}{text}"), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        k = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:k] + own[c][k:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                below[path[:d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in below
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
    return sorted(((m[0], len(s), members[s[:-1]][0] if s else None, len(m), len(below[s]), leaves[s], saved[s],
                    h(",".join(map(str, ends.get(s, []))))) for s, m in list(members.items())), key=repr)


TURNS = "conv_id long, turn long, role string, text string, node string"


@pytest.mark.parametrize("steps", [1 << 16, 40, 1])
def test_trie_brute_force(spark, monkeypatch, steps):
    """One shard, a few, and one for nearly every path."""
    monkeypatch.setattr(trie, "SHARD_STEPS", steps)
    rows = conversations()
    frame = spark.createDataFrame(rows, TURNS).repartition(3).withColumn("steps", F.lit(1)).withColumn("path", F.lit("p"))
    found = got(trie.prefix_trie(trie.branched(trie.turns_of(frame))))
    assert found == expected_trie(rows)


def test_trie_matches_sql(spark):
    rows = [r[:4] for r in conversations()]
    columns = {"conv_id": "BIGINT", "turn": "BIGINT", "role": "VARCHAR", "text": "VARCHAR"}
    assert duck(sql.OP13, conversations=(columns, rows)) == expected_trie(rows)


def test_trie_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(trie.branched(trie.turns_of(none))).collect() == []
    silent = spark.createDataFrame([(3, [])], "conv_id long, steps array<struct<turn:long,digest:string,n:long>>")
    assert got(trie.prefix_trie(silent)) == [(3, 0, None, 1, 0, 1, 0, h("3"))]


def test_manifest_matches_sql():
    columns = {"doc_id": "BIGINT", "text": "VARCHAR", "lang": "VARCHAR", "source": "VARCHAR", "n_chars": "BIGINT"}
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents ({', '.join(f'{c} {t}' for c, t in columns.items())})")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in corpus()])
    rows = con.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256 FROM ({sql.OP11})").fetchall()
    assert sorted(rows, key=repr) == expected_manifest(corpus())
