import hashlib
import random
from collections import Counter

import pytest

from gridtables.llm import repeats


def brute(docs):
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    out = []
    for (doc, _), x in zip(docs, raw, strict=True):
        gone = bytearray(len(x))
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases(seed):
    pick = random.Random(seed)
    text = lambda n: "".join(pick.choices("abcdefgh é日", k=n))
    passages = [text(n) for n in (199, 200, 201, 260, 500, 1200)]
    docs = [(None, None), (1, ""), (1, text(150)), (2, "z" * 199), (3, "y" * 200), (4, "x" * 201), (5, "ab" * 400), (6, passages[4]), (6, passages[4])]
    for i in range(60):
        parts = [text(pick.randint(0, 400))]
        for _ in range(pick.randint(0, 3)):
            p = pick.choice(passages)
            if pick.random() < 0.3:
                at = pick.randrange(len(p))
                p = p[:at] + "#" + p[at + 1 :]
            elif pick.random() < 0.3:
                p = p[pick.randint(0, 60) : len(p) - pick.randint(0, 60)]
            parts += [p, text(pick.randint(0, 300))]
        docs.append((10 + i, "".join(parts)))
    docs.append((99, docs[-1][1]))
    docs.append((100, passages[5] * 3))
    return docs


@pytest.mark.parametrize("seed, crowd, chunk", [(1, 20_000, 1 << 15), (2, 3, 1 << 15), (3, 20_000, 5)])
def test_against_brute_force(spark, monkeypatch, seed, crowd, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    docs = cases(seed)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, place int").repartition(3)
    done = repeats.without_repeats(df, crowd=crowd)
    got = []
    for r in done.collect():
        removed = sum(s["end"] - s["start"] for s in r.removed)
        got.append((r.doc_id, r.n_bytes, removed, len(r.removed), hashlib.sha256(r.kept).hexdigest()))
    assert sorted(got, key=repr) == brute(docs)


def test_cut_documents(spark):
    common = "é" * 150
    rows = [(1, common, 150), (2, common, 150), (3, "own " + common + " text", 160), (4, "", 0), (5, None, None), (6, "short", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, repeats.cut_documents(df).collect()))
    assert got == [(3, "own  text", 9), (4, "", 0), (5, None, None), (6, "short", 5)]


def test_empty_table_and_clash(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.digests(empty).count() == 0
    with pytest.raises(ValueError):
        repeats.without_repeats(empty.withColumn("kept", empty.text))
