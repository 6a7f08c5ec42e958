"""Each stage on its own input against a plain version, and the whole run."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from gridtables.llm.queries import tokenizer
from tests.llm import test_decontamination, test_jaccard, test_repeats

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(cp.STAGES)
    kept = cp.staged(stages["quality"](spark, docs, FOLDER))
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r.doc_id for r in kept.collect()}
    assert sum((labels[d] == 1) == (d in left) for d in labels) >= 0.9 * len(labels)

    one = cp.staged(stages["near_copies"](spark, kept, FOLDER))
    want = {c for _, n, c in test_jaccard.brute([(r.doc_id, r.text) for r in kept.collect()])}
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted(want)

    cut = cp.staged(stages["repeats"](spark, one, FOLDER))
    removed = {d: gone for d, _, gone, _, _ in test_repeats.brute([(r.doc_id, r.text) for r in one.collect()])}
    before = {r.doc_id: r.text for r in one.collect()}
    assert cut.columns == columns
    for r in cut.collect():
        lost = len(before[r.doc_id].encode()) - len(r.text.encode())
        assert removed[r.doc_id] <= lost <= removed[r.doc_id] + 8 and r.n_chars == len(r.text)

    clean = cp.staged(stages["decontamination"](spark, cut, FOLDER))
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rows = test_decontamination.brute([(r.doc_id, r.text) for r in cut.collect()][:40], items)
    bad = {d for d, n, hit, _ in rows if hit and 20 * hit >= n}
    assert clean.columns == columns and not bad & {r.doc_id for r in clean.collect()}
    assert {d for d, *_ in rows} - bad <= {r.doc_id for r in clean.collect()}

    library = Tokenizer.from_file(tokenizer())
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in stages["bpe"](spark, clean, FOLDER).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.round_trip


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in cp.STAGES] == ["quality", "near_copies", "repeats", "decontamination", "bpe"]
    found = cp.run(spark, FOLDER)
    assert found.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"] and found.count() > 0


CLASHES = ("quality_stats", "stats", "row", "body", "kept", "kept_text", "removed", "n_bytes", "ids", "decoded", "spans", "items", "id", "text_hash", "open")


def test_stages_with_clashing_columns_nulls_and_repeats(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    long = " ".join(f"word{i}" for i in range(90))
    texts = [(1, long), (1, long), (2, long + " end"), (None, "some words of its own here"), (None, "other words that stand alone"), (None, None), (None, ""),
             (5, None), (6, ""), (7, " . "), (8, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or ""), *CLASHES) for i, t in texts], schema).repartition(3)
    stages = dict(cp.STAGES)
    for name in ("quality", "near_copies", "repeats", "decontamination"):
        for given in (docs, docs.limit(0)):
            found = stages[name](spark, given, FOLDER)
            assert found.columns == docs.columns
            rows = found.collect()
            assert all(tuple(r[c] for c in CLASHES) == CLASHES for r in rows) and (rows or given is not docs or name == "quality")
    one = sorted(((r.doc_id, r.text) for r in stages["near_copies"](spark, docs, FOLDER).collect()), key=repr)
    assert one == sorted([(1, long), *texts[3:]], key=repr)
    cut = sorted(((r.doc_id, r.text, r.n_chars) for r in stages["repeats"](spark, docs, FOLDER).collect()), key=repr)
    assert cut == sorted([(2, " end", 4), *((i, t, len(t or "")) for i, t in texts[3:10]), (8, "x" * 300_000, 300_000)][:-1], key=repr)
    encoded = stages["bpe"](spark, docs, FOLDER)
    assert encoded.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"]
    assert encoded.count() == len(texts) and {r.round_trip for r in encoded.collect()} == {True}
    assert stages["bpe"](spark, docs.limit(0), FOLDER).count() == 0
