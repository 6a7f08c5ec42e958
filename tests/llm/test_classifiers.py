import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridtables.llm import quality, toxicity
from gridtables.llm.common import held_out
from gridtables.llm.queries import op1, op2
from gridtables.llm.registry import QUERIES
from gridtables.llm.samples import labelled_sample

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("query, label, modulus, rest, least", [(op1, "quality", 5, 0, 0.95), (op2, "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, query, label, modulus, rest, least):
    got = query(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", label), "doc_id", "left").collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [r for r in got if r.held_out and r[label] is not None]
    assert sum(r.predicted == r[label] for r in judged) >= least * len(judged)


def test_statistics_by_hand(spark):
    rows = [(1, "One one two.\nOne one two.\n#tag A9"), (2, ""), (3, None), (None, "é|é"), (5, "x" * 3_000_000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, stats int")
    got = {r.id: dict(zip(quality.STATISTICS, r.stats, strict=True)) for r in quality.statistics(df).collect()}
    one = got[1]
    assert (one["n_words"], one["n_lines"], one["n_bytes"]) == (8, 3, 33)
    assert one["distinct_words"] == 4 / 8 and one["top_word"] == 4 / 8 and one["repeated_words"] == 2 / 8
    assert one["distinct_lines"] == 2 / 3 and one["digits"] == 1 / 33 and one["symbols"] == 1 / 33
    assert set(got[2].values()) == set(got[3].values()) == {0.0}
    assert got[None]["bars"] == 1 / 5 and got[5]["long_words"] == 1
    with pytest.raises(ValueError):
        quality.with_statistics(df)


def test_rules_compile_to_the_same_score(spark):
    rules = quality.Rules(((((0, True, 5.0), (1, False, 2.0)), 1.5), (((1, True, 2.0),), -0.5)), 0.25)
    df = spark.createDataFrame([([3.0, 3.0],), ([9.0, 1.0],), ([5.0, 2.0],)], "stats array<double>")
    import math

    want = [1 / (1 + math.exp(-z)) for z in (1.75, -0.25, -0.25)]
    assert [r[0] for r in df.select(rules.score()).collect()] == pytest.approx(want)


def test_fit_without_two_classes(spark):
    schema = "stats array<double>, label double, weight double"
    assert quality.fit(spark.createDataFrame([], schema)).rules == ()
    one = quality.fit(spark.createDataFrame([([1.0] * len(quality.STATISTICS), 1.0, 1.0)], schema))
    assert one.rules == () and one.intercept > 0
    empty = toxicity.learn(spark.createDataFrame([], "id long, text string, label double, weight double"))
    assert empty.lexicon == {}
    df = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    assert [r.matches for r in toxicity.evidence(df, empty).collect()] == [[], []]


def test_sample_weights_and_odd_labels(spark):
    rows = [(i, 0) for i in range(50)] + [(100 + i, 1) for i in range(5)] + [(None, 1), (60, None), (61, 7), (62, 0), (62, 1), (0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, quality int")
    got = labelled_sample(df, "doc_id", "quality", F.lit(True), per_class=10).collect()
    assert sorted({(r.label, r.weight) for r in got}) == [(0.0, 5.0), (1.0, 1.0)]
    assert len(got) == 15 and not {r.id for r in got} & {60, 61, 62, None}
    kept = labelled_sample(df, "doc_id", "quality", ~held_out("doc_id", 5, 0)).collect()
    assert all(zlib.crc32(str(r.id).encode()) % 5 for r in kept)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_finds_all_words_within_one_edit():
    lexicon = {"idiot": 1.0, "scum": 0.9, "élève": 0.8, "moron": 0.7, "begin*": 0.6, "moro": 0.5}
    automaton = toxicity.Automaton(lexicon, frozenset({"morons"}))
    pick = random.Random(9)
    words = ["morons", "beginnen", "begin", "begi", "idiot", "scun", "élève", "eleve"]
    for _ in range(3000):
        word = list(pick.choice(["idiot", "scum", "élève", "moron", "moro", "begin"]))
        for _ in range(pick.randint(0, 2)):
            at = pick.randrange(len(word) + 1)
            word[at : at + pick.randint(0, 1)] = pick.choice(["", "x", "i", "o", "*", "é"])
        words.append("".join(word) or "q")
    tokens = toxicity.Tokens([" ".join(words)])
    got = {w: (t, exact) for w, t, exact in automaton.matches(tokens)}
    plain = [t for t in lexicon if not t.endswith("*")]
    for i, word in enumerate(words):
        if word in plain:
            assert got[i] == (word, True)
        elif word.startswith("begin"):
            assert got[i] == ("begin*", True)
        else:
            near = [t for t in plain if len(t) >= toxicity.MIN_FUZZY and distance(t, word) == 1]
            assert got.get(i) == ((max(near, key=lambda t: lexicon[t]), False) if near and word != "morons" else None), word


def test_quotation_weighs_less_than_abuse(spark):
    model = toxicity.Model({"idiot": 1.0}, weights=(1.0, 0.0, 0.0))
    texts = ["you idiot", 'he wrote "you idiot" to me', "the word idiot", "« idiot »", 'a "thing" then idiot', "idiot\x00idiot", "IDIOT!", "id1ot"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, features int")
    got = {r.id: [m.weight for m in r.matches] for r in toxicity.evidence(df, model).collect()}
    assert got[0] == [1.0] and got[2] == [toxicity.REPORTED] and got[3] == [toxicity.QUOTED] and got[4] == [1.0]
    assert got[1] == [toxicity.QUOTED * toxicity.REPORTED] and got[5] == [1.0, 1.0] and got[6] == [1.0] and got[7] == [toxicity.MISSPELT]


def family(spark):
    """Texts with a toxic word in two forms that share a beginning, and clean texts with a word of the same beginning."""
    pick = random.Random(3)
    filler = lambda: " ".join(pick.choices([f"plain{c}{d}" for c in "abcdefgh" for d in "klmnop"], k=12))
    toxic = [f"{filler()} {w} {filler()}" for w in ["idiot"] * 50 + ["idiots"] * 30]
    clean = [f"{filler()} idiom" for _ in range(2)] + [filler() for _ in range(400)]
    rows = [(i, t, float(i < len(toxic)), 1.0) for i, t in enumerate(toxic + clean)]
    return toxicity.learn(spark.createDataFrame(rows, "id long, text string, label double, weight double"))


def test_words_of_a_beginning_match_with_an_edit(spark):
    model = family(spark)
    assert {"idio*", "idiot", "idiots"} <= model.lexicon.keys()
    words = ["idiot", "idiots", "idi0t", "ideot", "idiotic", "idiom", "idea"]
    got = {words[w]: (t, exact) for w, t, exact in toxicity.Automaton(model.lexicon, model.exceptions).matches(toxicity.Tokens([" ".join(words)]))}
    assert got == {
        "idiot": ("idiot", True), "idiots": ("idiots", True), "idi0t": ("idiot", False), "ideot": ("idiot", False), "idiotic": ("idio*", True)}


def test_rare_terms_of_large_samples(spark):
    """12 of 5,000 toxic texts hold nothing but the rarer term."""
    rows = [f"idiot w{i}" for i in range(4988)] + [f"zwackel w{i}" for i in range(12)] + [f"plain w{i}" for i in range(5000)]
    df = spark.createDataFrame([(i, t, float(i < 5000), 1.0) for i, t in enumerate(rows)], "id long, text string, label double, weight double")
    assert {"idiot", "zwackel"} <= toxicity.learn(df).lexicon.keys()


def test_a_text_keeps_its_only_term(spark):
    better = [f"better{c}" for c in "abcde"]
    texts = [" ".join([*better, "only", f"x{i}"]) for i in range(8)] + ["only y", "only z"]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "id long, text string, label double")
    assert list(toxicity._needed(df, dict.fromkeys([*better, "only"], 1.0))) == [*better, "only"]


def test_all_clean_words_of_a_beginning_are_exempt(spark):
    many = " ".join(f"idio{i}" for i in range(100_500))  # one text
    rows = [f"{w} w{i}" for i, w in enumerate(["idiot"] * 50 + ["idiots"] * 30)] + [many] + [f"plain v{i}" for i in range(100)]
    df = spark.createDataFrame([(i, t, float(i < 80), 1.0) for i, t in enumerate(rows)], "id long, text string, label double, weight double")
    model = toxicity.learn(df)
    assert "idio*" in model.lexicon and set(many.split()) <= model.exceptions


def brute_statistics(text):
    b = (text or "").encode()
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    words, lowered = re.split(rb"[\x20\x09-\x0D]+", b), re.split(rb"[\x20\x09-\x0D]+", lower)
    words, lowered = [w for w in words if w], [w for w in lowered if w]
    lines = [x for x in lower.split(b"\n") if x]
    share = lambda part, whole: part / whole if whole else 0.0
    among = lambda chars: share(sum(c in chars for c in b), len(b))
    symbols = b"#$%&*+/<=>@[\\]^_`{|}~"
    upper = bytes(range(65, 91))
    n = len(words)
    return {
        "n_bytes": len(b), "n_words": n, "mean_word": share(sum(map(len, words)), n), "long_words": share(sum(len(w) > 20 for w in words), n),
        "distinct_words": share(len(set(lowered)), n), "repeated_words": share(sum(x == y for x, y in zip(lowered, lowered[1:])), n),
        "top_word": share(max(Counter(lowered).values(), default=0), n), "letters": among(upper + bytes(range(97, 123))), "digits": among(b"0123456789"),
        "symbols": among(symbols), "marks": among(b".,;:!?'\"()-"), "upper": among(upper), "non_ascii": among(bytes(range(128, 256))),
        "n_lines": len(lines), "mean_line": share(len(b), len(lines)), "distinct_lines": share(len(set(lines)), len(lines)),
        "odd_endings": share(sum(w[-1] in symbols for w in words), n), "bars": among(b"|")}


def odd_texts():
    pick = random.Random(11)
    parts = ["word", "Word", "über", "x" * 25, "a|b", "12.5", "end#", "?!", "日本", "the", "the", "THE"]
    texts = ["".join(pick.choice(parts) + pick.choice([" ", "\n", "\t", "  ", "\n\n"]) for _ in range(pick.randint(0, 40))) for _ in range(60)]
    return [None, "", " \n\t", "one", *texts, "long word " * 60_000]


def test_statistics_equal_plain_counts(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.stats for r in quality.statistics(df).collect()}
    for i, text in enumerate(texts):
        want = brute_statistics(text)
        assert got[i] == pytest.approx([want[c] for c in quality.STATISTICS], abs=1e-9), i
    beside = {r.doc_id: r.stats for r in quality.with_statistics(df).collect()}
    assert beside == got


def test_scores_equal_the_rules_by_hand(spark):
    texts = odd_texts()
    at = {c: i for i, c in enumerate(quality.STATISTICS)}
    rules = quality.Rules(((((at["letters"], False, 0.4), (at["n_words"], True, 30.0)), 1.5), (((at["top_word"], True, 0.2),), -2.0)), 0.25)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.score for r in quality.statistics(df).select("id", rules.score().alias("score")).collect()}
    for i, text in enumerate(texts):
        s = brute_statistics(text)
        total = 0.25 + 1.5 * (s["letters"] > 0.4 and s["n_words"] <= 30) - 2.0 * (s["top_word"] <= 0.2)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_toxicity", "op11_language_id"])
def test_queries_on_odd_tables(spark, tmp_path, name):
    texts = odd_texts()
    rows = [(i, t, "en" if i % 2 else None, "s", 0) for i, t in enumerate(texts)] + [(None, "no id", "de", "s", 0), (3, "one", "en", "s", 0), (3, "one", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, score int"
    labels = [(i, i % 2, i % 3 // 2) for i in range(len(texts))] + [(None, 1, 1), (5, 0, 1), (777, 1, 0), (6, None, None)]
    for folder, docs, given in (("some", rows, labels), ("none", [], []), ("unlabelled", rows, [])):
        base = str(tmp_path / folder)
        spark.createDataFrame(docs, schema).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame(given, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        found = QUERIES[name](spark, base).collect()
        assert sorted((str(r.doc_id) for r in found)) == sorted(str(d[0]) for d in docs)
        assert all(0 <= r.score <= 1 and (r.held_out is not None) for r in found)
