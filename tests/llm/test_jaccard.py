import random

import numpy as np
import pytest

from gridtables.llm import jaccard as j
from gridtables.llm.components import components

BLANK = " \t\n\x0b\x0c\r"


def shingles(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANK:
            if word:
                words.append("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in word))
            word = ""
        else:
            word += c
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for i, (doc, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(docs)), key=repr)


def cases(seed, n=150):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = pick.choices(vocabulary, k=14)  # stands in many texts, in short ones as nearly all of it
    docs = [(None, "a b c"), (900, None), (901, ""), (902, " \n"), (903, "a b c"), (904, "A\tB\x0bC"), (905, "one"), (905, "one")]
    base = []
    for i in range(n):
        kind = pick.random()
        if kind < 0.45 and base:
            words = list(pick.choice(base))
            for _ in range(pick.randint(0, max(1, len(words) // 40))):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
        elif kind < 0.7:
            words = passage + pick.choices(vocabulary, k=pick.randint(0, 8))
        else:
            words = pick.choices(vocabulary, k=pick.choice([3, 5, 6, 8, 30, 60, 120, 200, 400]))
        base.append(words)
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("seed, frequent, crowd", [(1, 64, 64), (2, 3, 3), (3, 2, 2), (4, 2, 0)])
def test_against_brute_force(spark, monkeypatch, seed, frequent, crowd):
    monkeypatch.setattr(j, "FREQUENT", frequent)
    monkeypatch.setattr(j, "CELL", 3)
    monkeypatch.setattr(j, "CROWD", crowd)
    docs = cases(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, node int, sig string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in j.near_duplicates(df).collect()), key=repr)
    assert got == brute(docs)


def test_linked_sets_share_a_signature():
    """The prefixes of every pair that links meet, whatever the frequencies."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(2, 200))
        x = rng.choice(2**62, n, replace=False).astype(np.uint64)
        y = np.unique(np.concatenate([x[rng.random(n) < 0.93], rng.choice(2**62, int(rng.integers(0, max(1, n // 12) + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if x.tolist() == y.tolist() or not 100 * both >= 80 * (len(x) + len(y) - both):
            continue
        weight = {int(t): int(w) for t, w in zip(np.union1d(x, y), rng.choice([0, 5, 64, 1000], len(np.union1d(x, y))), strict=True)}

        def signed(s):
            s = np.sort(s)
            w = np.array([weight[int(t)] for t in s])
            order = np.argsort(w, kind="stable")
            small, every = set(), set()
            for own, role in j.signatures(s[order], w[order]):
                small |= set(own[:role].tolist())
                every |= set(own.tolist())
            return small, every

        (sx, ex), (sy, ey) = signed(x), signed(y)
        assert (sx & ey) if len(x) < len(y) else (ex & sy) if len(x) > len(y) else (sx & ey) | (ex & sy)


def test_one_of_each(spark):
    rows = [(3, "a b c d e f g", "p"), (1, "a b c d e f g", "q"), (1, "a b c d e f g", "q"), (2, None, "r"), (4, None, "s"), (5, "x y", "t"), (None, "x y", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = j.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a b c d e f g", "q"), (2, None, "r"), (4, None, "s"), (5, "x y", "t")]


def test_one_of_each_without_ids_of_their_own(spark):
    texts = ["a b c d e f g", "h i j k l m n", "o p q r s t u"]
    rows = [(None, t) for t in texts] + [(None, texts[0].upper())]  # unlinked but for the copy
    rows += [(7, "one two three"), (7, "four five six"), (8, "four five six")]
    blank = [(None, ""), (None, ""), (None, None), (9, " \t\n\x0b\x0c\r"), (9, None)]
    df = spark.createDataFrame(rows + blank + [(10, "\x00"), (11, "\xa0")], "doc_id long, text string")
    got = sorted(((r.doc_id, (r.text or "").lower() if r.text else r.text) for r in j.one_of_each(df).collect()), key=repr)
    want = [(None, t) for t in texts] + [(7, "one two three"), (7, "four five six")] + blank + [(10, "\x00"), (11, "\xa0")]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert j.near_duplicates(empty).count() == 0
    assert j.one_of_each(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)] + [(139, -5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: -5 for i in range(100, 140)}}
