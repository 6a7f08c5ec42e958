"""Toxicity by a lexicon, its misspellings, and the words around them.

The lexicon comes from labelled texts: words, and beginnings of words ("begin*"), with high odds of a toxic label. Its trie is run against the Levenshtein automaton of one
edit: a state is a set of (trie node, edits used), found by the subset construction as texts ask for it, so each word of a
text costs one table look-up per character whatever the lexicon's size. Short terms match exactly only. The full words of a beginning are
terms beside it and so match with an edit. Words of clean labelled texts that are only a variant of a term, or only share a term's
beginning, are words of their own and do not count.

Each match is weighed by the window of words around it: inside quotation marks, or near a word of reporting, it tells of abuse rather
than being it. The evidence of a text goes through a logistic regression fitted on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import staged

MIN_FUZZY = 5  # characters from which a term may have an edit
BEGIN = 4  # characters of the shortest beginning
WINDOW = 6
QUOTED, REPORTED, MISSPELT = 0.3, 0.5, 0.8
#: Words that report speech or speak about words (fixed values).
REPORTING = frozenset("""
said says wrote writes quoted quote quotes called calling insult insults slur slurs word words term terms offensive
sagte schrieb zitat nannte wort beleidigung dijo escribió cita llamó palabra insulto dit écrit citation appelé mot insulte
""".split())
OPENING, CLOSING = frozenset("\"“„«‘"), frozenset("\"”“»’")
_BREAKS = " \t\n\r\f\v.,;:!?\"()[]{}<>|“”„«»‘’…/\\\x00\xa0  　"
FEATURES = ("evidence", "density", "matches")


def _letters() -> np.ndarray:
    table = np.ones(0x110000, bool)
    table[[ord(c) for c in _BREAKS]] = False
    return table


class Tokens:
    """Words of lower-cased texts as spans of one array of characters."""

    inside: np.ndarray | None = None

    def __init__(self, texts: list[str]):
        if Tokens.inside is None:
            Tokens.inside = _letters()
        lowered = [t.lower() for t in texts]
        self.text = "\x00".join(lowered) + "\x00"
        self.chars = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4")
        inside = Tokens.inside[self.chars]
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8)]))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
        self.first = np.searchsorted(self.starts, self.offsets)

    def word(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]]


class Automaton:
    """Lexicon trie intersected with Levenshtein automata of one edit, made deterministic as needed."""

    def __init__(self, lexicon: dict[str, float], exceptions: frozenset[str]):
        self.lexicon, self.exceptions = lexicon, exceptions
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.open: dict[int, str] = {}
        for term in sorted(lexicon):
            at = 0
            for c in term.removesuffix("*"):
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                at = self.children[at][c]
            if term.endswith("*"):
                self.open[at] = term
            else:
                self.term[at] = term
        alphabet = sorted({c for term in lexicon for c in term.removesuffix("*")})
        self.alphabet = ["\x00", *alphabet]  # class 0: no character of the lexicon
        self.classes = np.zeros(0x110000, np.int32)
        for i, c in enumerate(alphabet, 1):
            self.classes[ord(c)] = i
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.table = np.full((1024, len(self.alphabet)), -1, np.int32)
        self.table[0] = 0
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, places: set[tuple[int, int]]) -> frozenset:
        """With the places that leaving out a term's character reaches; of one node the fewest edits count."""
        places |= {(to, 1) for node, edits in places if edits == 0 for to in self.children[node].values()}
        return frozenset((n, e) for n, e in places if e == 0 or (n, 0) not in places)

    def _state(self, places: frozenset) -> int:
        if (known := self.states.get(places)) is None:
            known = self.states[places] = len(self.sets)
            self.sets.append(places)
            if known == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return known

    def _step(self, state: int, kind: int) -> int:
        c, to = self.alphabet[kind], set()
        for node, edits in self.sets[state]:
            if (child := self.children[node].get(c)) is not None:
                to.add((child, edits))
            if edits == 0 and node in self.open:
                to.add((node, 0))
            elif edits == 0:
                to.add((node, 1))
                to |= {(child, 1) for child in self.children[node].values()}
        return self._state(self._closed(to))

    def run(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(word, state at its end) of the words that did not fall out of the automaton."""
        kinds = self.classes[tokens.chars]
        alive = np.arange(len(tokens.starts))
        state = np.full(len(alive), self.start, np.int32)
        place, ends = tokens.starts.copy(), tokens.ends
        done_words, done_states = [], []
        while len(alive):
            kind = kinds[place]
            to = self.table[state, kind]
            if (unknown := to < 0).any():
                for s, k in {*zip(state[unknown].tolist(), kind[unknown].tolist(), strict=True)}:
                    target = self._step(s, k)  # may grow the table
                    self.table[s, k] = target
                to = self.table[state, kind]
            place = place + 1
            over = place == ends[alive]
            hit = over & (to > 0)
            done_words.append(alive[hit])
            done_states.append(to[hit])
            on = ~over & (to > 0)
            alive, state, place = alive[on], to[on], place[on]
        return (np.concatenate(done_words), np.concatenate(done_states)) if done_words else (np.zeros(0, np.int64), np.zeros(0, np.int32))

    def matches(self, tokens: Tokens) -> list[tuple[int, str, bool]]:
        """(word, term, exact) in text order."""
        found = []
        known: dict[int, tuple[str | None, str | None, list[str]]] = {}
        for word, state in zip(*(x.tolist() for x in self.run(tokens)), strict=True):
            if state not in known:
                terms = [(e, self.term[n]) for n, e in self.sets[state] if self.term[n] is not None]
                begun = [self.open[n] for n, e in self.sets[state] if e == 0 and n in self.open]
                known[state] = (
                    next((t for e, t in terms if e == 0), None), max(begun, key=len, default=None), sorted(t for e, t in terms if e and len(t) >= MIN_FUZZY))
            exact, begin, near = known[state]
            if exact is not None:
                found.append((word, exact, True))
            elif (begin or near) and tokens.word(word) not in self.exceptions:
                found.append((word, begin, True) if begin else (word, max(near, key=lambda t: (self.lexicon[t], t)), False))
        return sorted(found)


def context(tokens: Tokens, word: int, low: int, high: int, text_start: int, text_end: int) -> float:
    """1 for plain use, less where the window shows quotation or report. The document's words are low to high."""
    a, b = max(low, word - WINDOW), min(high - 1, word + WINDOW)
    left = tokens.text[tokens.ends[a - 1] if a > low else text_start : tokens.starts[word]]
    right = tokens.text[tokens.ends[word] : tokens.starts[b + 1] if b < high - 1 else text_end]
    opened = any(c in OPENING for c in left) and any(c in CLOSING for c in right)
    # an even number of straight marks to the left opens nothing
    if opened and not any(c in "“„«‘" for c in left):
        opened = left.count('"') % 2 == 1
    factor = QUOTED if opened else 1.0
    if any(tokens.word(i) in REPORTING for i in range(a, b + 1) if i != word):
        factor *= REPORTED
    return factor


@dataclass(frozen=True)
class Model:
    """Lexicon with strengths, clean variants, and the fitted weights."""

    lexicon: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    weights: tuple[float, ...] = (0.0,) * len(FEATURES)
    intercept: float = 0.0

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for i, w in enumerate(self.weights):
            total = total + F.col("features")[i] * w
        return 1 / (1 + F.exp(-total))


def evidence(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features, matches: word number, term, exact, weight) of every whole text.

    A null or empty text has no words and zeros. Repeated rows and null ids each give a row, an empty table gives none, other columns are not
    read. Long texts are worked on whole, in a step of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.exceptions))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    match_type = pa.list_(pa.struct([("word", pa.int32()), ("term", pa.string()), ("exact", pa.bool_()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        for batch in batches:
            features, found = [], []
            for texts in _runs(batch["body"].to_pylist()):
                tokens = Tokens(texts)
                own: list[list[dict]] = [[] for _ in texts]
                matches = automaton.matches(tokens)
                docs_of = np.searchsorted(tokens.first, [m[0] for m in matches], "right") - 1 if matches else ()
                at = tokens.offsets
                for (word, term, exact), doc in zip(matches, docs_of, strict=True):
                    low, high = int(tokens.first[doc]), int(tokens.first[doc + 1])
                    factor = context(tokens, word, low, high, int(at[doc]), int(at[doc + 1]) - 1)
                    own[doc].append({"word": word - low, "term": term, "exact": exact, "weight": factor * (1.0 if exact else MISSPELT)})
                for doc, rows in enumerate(own):
                    n = int(tokens.first[doc + 1] - tokens.first[doc])
                    total = sum(r["weight"] * automaton.lexicon[r["term"]] for r in rows)
                    features.append([min(total, 20.0), min(1.0, 20 * total / n) if n else 0.0, min(10.0, sum(r["weight"] for r in rows))])
                found += own
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(features, pa.list_(pa.float64())), pa.array(found, match_type)], names=["id", "features", "matches"])

    return narrow.mapInArrow(
        run, f"id {narrow.schema['id'].dataType.simpleString()}, features array<double>,"
        " matches array<struct<word:int,term:string,exact:boolean,weight:double>>")


def _runs(texts: list[str | None], size: int = 1 << 20) -> Iterator[list[str]]:
    run, total = [], 0
    for text in texts:
        run.append((text or "").replace("\x00", " "))
        total += len(run[-1])
        if total >= size:
            yield run
            run, total = [], 0
    if run:
        yield run


def _apart(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Of a beginning and its words one kind stays: the word if it makes up most of the beginning, else the (shortest) beginning.
    ``_with_words`` brings the words of a beginning back once it is known to be needed."""
    begins = {t[:-1]: n for t, (_, n) in found.items() if t.endswith("*")}
    begins = {b: n for b, n in begins.items() if b[:-1] not in begins}
    top = dict.fromkeys(begins, 0)
    for word, (_, n) in found.items():
        for size in range(BEGIN, min(len(word), BEGIN + 3) + 1):
            if not word.endswith("*") and word[:size] in top:
                top[word[:size]] = max(top[word[:size]], n)
    begins = {b for b, n in begins.items() if top[b] < 0.8 * n}
    return {
        t: odds for t, (odds, _) in found.items()
        if (t[:-1] in begins if t.endswith("*") else not any(t[:size] in begins for size in range(BEGIN, BEGIN + 4)))}


def _with_words(lexicon: dict[str, float], found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """With the full words of the beginnings: these match exactly what the beginning does, and with an edit what it does not."""
    begins = {t[:-1] for t in lexicon if t.endswith("*")}
    return lexicon | {
        t: odds for t, (odds, _) in found.items()
        if not t.endswith("*") and any(t[:size] in begins for size in range(BEGIN, min(len(t), BEGIN + 3) + 1))}


def _needed(texts: DataFrame, lexicon: dict[str, float], rare: frozenset[str] = frozenset(), enough: int = 5, share: float = 0.3) -> dict[str, float]:
    """Terms, best first, that toxic texts need. A term stays as long as a text has no other; without such a text those that mostly stand
    in texts with ``enough`` better terms are chance finds, and so are ``rare`` ones."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in batches:
            found = []
            for text in batch["text"].to_pylist():
                tokens = Tokens([(text or "").replace("\x00", " ")])
                own = {tokens.word(i) for i in range(len(tokens.starts))}
                own |= {w[:n] + "*" for w in own for n in range(BEGIN, min(len(w), BEGIN + 3) + 1)}
                found.append(sorted(own & terms.keys()))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.list_(pa.string()))], names=["id", "terms"])

    toxic = texts.where("label = 1").select("id", "text")
    of_text = toxic.mapInArrow(run, f"id {toxic.schema['id'].dataType.simpleString()}, terms array<string>").collect()  # bounded by the sample
    by_term: dict[str, list[int]] = {t: [] for t in lexicon}
    for i, row in enumerate(of_text):
        for t in row.terms:
            by_term[t].append(i)
    covered = [0] * len(of_text)
    kept = {}
    for term, odds in lexicon.items():
        own = by_term[term]
        if any(not covered[i] for i in own) or term not in rare and sum(covered[i] < enough for i in own) >= share * len(own):
            kept[term] = odds
            for i in own:
                covered[i] += 1
    return kept


def learn(rows: DataFrame, min_texts: int = 2, rare_share: float = 0.004, min_odds: float = 3.0, max_terms: int = 2000) -> Model:
    """Fits on ``rows`` (id, text, label, weight), which the caller bounds. Equal texts count once.

    A term stands in at least ``min_texts`` toxic texts, whatever the size of the sample, with log odds of ``min_odds`` or more whose lower
    bound (95 %) is above 0; one in less than ``rare_share`` of them must be the only term of a text. The ``max_terms`` with the highest
    bound are the lexicon, a parameter of the method.
    """
    texts = staged(rows.groupBy("text").agg(F.max("label").alias("label"), F.first("weight").alias("weight"), F.min("id").alias("id")))
    totals = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1.0, 0), totals.get(0.0, 0)
    if not n_toxic or not n_clean:
        share = 0.001 if not n_toxic else 0.999
        return Model({}, intercept=float(np.log(share / (1 - share))) if n_toxic or n_clean else 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic: dict[str, int] = {}
            clean: dict[str, int] = {}
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                count = toxic if label else clean
                tokens = Tokens([(text or "").replace("\x00", " ")])
                own = {tokens.word(i) for i in range(len(tokens.starts))}
                own |= {w[:n] + "*" for w in own for n in range(BEGIN, min(len(w), BEGIN + 3) + 1)}
                for word in own:
                    count[word] = count.get(word, 0) + 1
            words = [*{**toxic, **clean}]
            yield pa.RecordBatch.from_pydict({
                "word": words, "toxic": pa.array([toxic.get(w, 0) for w in words], pa.int64()), "clean": pa.array([clean.get(w, 0) for w in words], pa.int64())})

    counts = staged(texts.select("text", "label").mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    bound = odds - 1.96 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    chosen = counts.withColumns({"odds": odds, "bound": bound}).where(
        (F.col("toxic") >= min_texts) & (F.col("odds") >= min_odds) & (F.col("bound") > 0) & (F.length("word") >= 3))
    rows = chosen.orderBy(F.desc("bound"), "word").limit(max_terms).collect()
    found = {r.word: (float(r.odds), r.toxic) for r in rows}
    rare = frozenset(t for t, (_, n) in found.items() if n < rare_share * n_toxic)
    lexicon = _with_words(_needed(texts, _apart(found), rare), found)
    top = max(lexicon.values(), default=1.0)
    lexicon = {w: o / top for w, o in lexicon.items()}

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(lexicon, frozenset())
        for batch in batches:
            words = batch["word"].to_pylist()
            tokens = Tokens(words)
            own = {tokens.word(w) for w, term, exact in automaton.matches(tokens) if not exact or term.endswith("*")}
            yield pa.RecordBatch.from_pydict({"word": pa.array(sorted(own), pa.string())})

    clean_words = counts.where("clean > 0 AND clean >= toxic AND word NOT LIKE '%*'").select("word")
    exceptions = frozenset(r.word for r in clean_words.mapInArrow(variants, "word string").collect()) if lexicon else frozenset()
    model = Model(lexicon, exceptions)
    marked = evidence(texts, model, "id", "text").select("id", "features").join(texts.select("id", "label", "weight"), "id")
    fitted = LogisticRegression(featuresCol="v", labelCol="label", weightCol="weight", regParam=0.001, maxIter=50).fit(
        staged(marked).select(array_to_vector("features").alias("v"), "label", "weight"))
    return Model(lexicon, exceptions, tuple(map(float, fitted.coefficients.toArray())), float(fitted.intercept))
