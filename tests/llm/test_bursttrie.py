import hashlib
import random
import zlib

import pytest

from gridtables.llm import bursttrie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"
KEYS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    return md5(md5(role) + md5(text))


def sequences(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(built):
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = set()
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(p)))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(len(q) == len(p) + 1 for q in below), len(childless),
                 saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    found = [tuple(r[k] for k in KEYS) for r in bursttrie.prefix_trie(df, **options).collect()]
    assert len(found) == len(set(found))
    return set(found)


def conversations(n, kinds, longest, seed):
    rnd = random.Random(seed)
    return [(c, t, ("user", "assistant")[t % 2], rnd.choice(kinds)) for c in range(n) for t in range(rnd.randint(1, longest))]


@pytest.mark.parametrize("limit", [1, 3, 4096])
def test_equals_brute_force(spark, limit):
    rows = conversations(60, ["a", "b", "ü" * 3], 12, 1)
    assert got(spark, rows, limit=limit) == brute(sequences(rows))


@pytest.mark.parametrize("limit", [2, 4096])
def test_long_conversations_go_on_under_further_heads(spark, limit, monkeypatch):
    monkeypatch.setattr(bursttrie, "PIECE", 4)
    base = [(0, t, "user", f"t{t % 3}") for t in range(30)]
    copies = [(c, t, "user", f"t{t % 3}") for c in (5, 10, 15, 20) for t in range(c + 8)]
    rows = base + copies + [(25, t, "user", f"t{t % 3}" if t < 17 else "other") for t in range(24)] + conversations(12, ["t0"], 9, 2)[30:]
    assert got(spark, rows, limit=limit) == brute(sequences(rows))


def test_nulls_ties_copies_and_turnless(spark):
    rows = [(0, 1, "user", "x"), (0, None, None, "first"), (0, 1, "user", "a"), (0, 1, "user", "x"), (None, 0, "user", "lost")]
    rows += [(c, t, "user", None if t == 1 else "same") for c in range(5, 45, 5) for t in range(3)]
    rows += [(c, 0, "user", "gone") for c in range(101, 110)]  # without a base: turnless where h is at least 1
    rows += [(-5, 0, "user", "same"), (2000, 0, "user", "é" * 50_000)]
    want = sequences(rows)
    assert any(not s for s in want.values())
    assert got(spark, rows) == brute(want)


def test_only_turnless_and_empty(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert got(spark, [(c, 0, "user", "x")]) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
    assert got(spark, []) == set()
    assert got(spark, [(None, 0, "user", "x")]) == set()


def test_ends_are_hashed_in_order_across_lists(spark, monkeypatch):
    monkeypatch.setattr(bursttrie, "SPAN", 2)
    rows = [(c, 7, 3) for c in range(-20, 200, 3)] + [(c, 8, 3) for c in range(5)]
    found = {r.node: r.ends_sha256 for r in bursttrie.end_digests(spark.createDataFrame(rows, "conv long, node long, depth long")).collect()}
    want = {n: hashlib.sha256(",".join(str(c) for c in sorted(c for c, m, _ in rows if m == n)).encode()).hexdigest() for n in (7, 8)}
    assert found == want
