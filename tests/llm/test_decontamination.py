import random
import re

import pytest

from gridtables.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    patterns = []
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        patterns += [(name, w[i : i + k]) for i in range(len(w) - k + 1 if k else 0)]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for name, p in patterns:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found.add(name)
        out.append((doc, len(w), len(hit), sorted(str(n) for n in found if n is not None)))
    return sorted(out, key=repr)


def cases():
    pick = random.Random(5)
    vocabulary = ["a", "b", "the", "of", "Zürich", "été", "x1", "9", "日本", "o"]
    sentence = lambda n: " ".join(pick.choices(vocabulary, k=n))
    items = [(i, sentence(n)) for i, n in enumerate([1, 2, 3, 5, 12, 13, 14, 30, 40])] + [(20, None), (21, ""), (22, "...!"), (None, sentence(20)), (7, "dup of the"), (7, "dup of the")]
    docs = [(None, sentence(9)), (1, None), (2, ""), (3, " .,;"), (3, "tie"), (4, sentence(3000))]
    for i in range(40):
        passage = pick.choice(items[:9])[1]
        noisy = re.sub(" ", lambda m: pick.choice([" ", "\n", ", ", "--", " !"]), passage).upper() if i % 2 else passage
        docs.append((10 + i, f"{sentence(pick.randint(0, 30))} {noisy} {sentence(pick.randint(0, 30))}"))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_against_brute_force(spark, block_bytes):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, "clash", [1]) for i, t in docs], "doc_id long, text string, spans string, items array<int>")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = dc.hits(dc.contamination(d, b, block_bytes=block_bytes))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == brute(docs, items)
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in found.collect())


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = dc.hits(dc.contamination(docs, none)).first()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (2, 0, [], False)
    assert dc.contamination(docs.limit(0), none).count() == 0


def test_clean_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", 3), (2, "nothing of it here", 4), (None, None, 5)], "doc_id long, text string, row int")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    kept = dc.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == [(2, "nothing of it here", 4), (None, None, 5)]


def test_further_blocks_stage_hits_and_no_texts(spark, monkeypatch):
    docs, items = cases()
    d = spark.createDataFrame(docs + docs[:4], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    written = []
    monkeypatch.setattr(dc, "staged", lambda df, *a, s=dc.staged, **o: written.append(df.columns) or s(df, *a, **o))
    found = dc.hits(dc.contamination(d, b, block_bytes=200))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == brute(docs + docs[:4], items)
    assert len(written) >= 2 and all(c == ["digest", "spans", "items"] for c in written)


def test_spans_of_blocks_are_merged(spark):
    text = " ".join(f"w{i}" for i in range(40))
    items = [(1, " ".join(f"w{i}" for i in range(15))), (2, " ".join(f"w{i}" for i in range(10, 25))), (3, " ".join(f"w{i}" for i in range(30, 33)))]
    d = spark.createDataFrame([(1, text), (2, text), (3, "w1")], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in dc.contamination(d, b, block_bytes=20).collect()}
    assert [(s.start, s.end) for s in rows[1].spans] == [(0, 25), (30, 33)] == [(s.start, s.end) for s in rows[2].spans]
    assert rows[1]["items"] == ["1", "2", "3"] and rows[3].spans == []
