"""Byte-level BPE: prefix-sharing trie traversal for encoding, table lookup for decoding.

The encoding of every prefix of a word ends with exactly one token, and that token together with the state of the prefix before it
gives the whole encoding. So the state of a trie node is one token: its prefix's last. Distinct words of a batch form a trie
(sorted words, walked depth first: the path down to the common prefix with the word before is kept), each node's state is found once
from its ancestors' states, and a word's ids are read back along its path. A token may follow another when no merge across
their border would have come before the merges that made the two.

Text is cut into units at single spaces between non-blank characters; a unit is cut into words by the tokenizer's pattern. Where blanks
touch, the whole text is cut by the pattern at once. Units already encoded stay in a cache of bounded size.
"""

from __future__ import annotations

import array
import functools
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtables.llm.common import release, slices, utf8

#: The pattern of the byte-level pre-tokenizer (fixed by the format).
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Words that an encoder remembers.
CACHE = 250_000
LONG = 64
#: Bytes of text that a task encodes as one batch.
BATCH = 4 << 20
#: Units whose ids are put in place at once.
RUN = 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The format's characters for bytes: printable Latin-1 stands for itself, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a tokenizer file of kind BPE with a byte-level pre-tokenizer."""

    def __init__(self, text: str):
        spec = json.loads(text)
        kind = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        alphabet = byte_alphabet()
        self.tokens: dict[int, bytes] = {}
        by_name = spec["model"]["vocab"]
        for name, i in by_name.items():
            self.tokens[i] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not supported")
        for name, i in self.special.items():
            self.tokens[i] = name.encode()
        self.ids: dict[bytes, int] = {self.tokens[i]: i for name, i in by_name.items() if name not in self.special}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for order, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = by_name[left], by_name[right], by_name[left + right]
            self.rank[a, b], self.made[a, b] = order, c
            self.parts.setdefault(c, (order, a, b))
        self.table = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]

    def merge(self, text: bytes) -> list[int]:
        """Plain merging by rank, leftmost first: for checking single tokens."""
        ids = [self.ids[bytes([b])] for b in text]
        while len(ids) > 1:
            best = min(((self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))))
            if best[0] == 1 << 60:
                break
            ids[best[1] : best[1] + 2] = [self.made[ids[best[1]], ids[best[1] + 1]]]
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.table.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()


class Trie:
    """Last-token states over the tries of word sets."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        #: trie of reversed tokens, to walk back from a place over all tokens that end there
        self.node: dict[int, int] = {}
        self.token: list[int] = [-1]
        for text, i in vocabulary.ids.items():
            at = 0
            for byte in reversed(text):
                key = at << 8 | byte
                if (to := self.node.get(key)) is None:
                    to = self.node[key] = len(self.token)
                    self.token.append(-1)
                at = to
            self.token[at] = i
        self.length = {i: len(t) for t, i in vocabulary.ids.items()}
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.follows: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that used it up) down the right (2) or left (1) edge."""
        got = self.spines.get((token, side))
        if got is None:
            got, until, t = [], 1 << 60, token
            while True:
                got.append((t, until))
                part = self.v.parts.get(t)
                if part is None:
                    break
                until, t = part[0], part[side]
            self.spines[token, side] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.follows.get(key)
        if known is None:
            rank = self.v.rank
            known = True
            for x, until_x in self._spine(a, 2):
                for y, until_y in self._spine(b, 1):
                    q = rank.get((x, y))
                    # of equal merges the left one comes first
                    if q is not None and q < until_x and q <= until_y:
                        known = False
            if len(self.follows) > 400_000:
                self.follows.clear()
            self.follows[key] = known
        return known

    def _is_whole(self, token: int) -> bool:
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.v.merge(self.v.tokens[token]) == [token]
        return known

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct words."""
        node, token_at, length, follows, may_follow = self.node, self.token, self.length, self.follows, self.may_follow
        out: dict[bytes, bytes] = {}
        last: list[int] = [-1]
        before = b""
        for word in sorted(words):
            n = len(word)
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :]
            for depth in range(shared + 1, n + 1):
                at, place, state = 0, depth, -1
                while place:
                    place -= 1
                    at = node.get(at << 8 | word[place])
                    if at is None:
                        break
                    t = token_at[at]
                    if t >= 0:
                        if place:
                            ok = follows.get(last[place] << 32 | t)
                            if ok is None:
                                ok = may_follow(last[place], t)
                        else:
                            ok = self._is_whole(t)
                        if ok:
                            state = t
                            break
                if state < 0:
                    raise ValueError(f"no token ends {word[:depth]!r}")
                last.append(state)
            ids, place = [], n
            while place:
                t = last[place]
                ids.append(t)
                place -= length[t]
            ids.reverse()
            out[word] = array.array("I", ids).tobytes()
            before = word
        return out


#: Below this character all versions of the letter and number classes agree; a text beyond it is cut by the library's pre-tokenizer.
SETTLED = "\u0530"
MARKS = frozenset(".,;:!?")


def cutter(text: str) -> Callable[[str], list[str]]:
    """Cuts a text into the tokenizer's words."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(text).pre_tokenizer

    def words(unit: str) -> list[str]:
        if unit and max(unit) < SETTLED:
            return PATTERN.findall(unit)
        return [unit[low:high] for _, (low, high) in own.pre_tokenize_str(unit)]

    return words


class UnitEncoder:
    """Ids of texts. ``encode_words`` gives those of distinct words; words seen before come from a cache.

    A unit is what stands between two single spaces, with the space before it; where it neither starts nor ends with a blank, its words
    do not depend on its neighbours. A text with a unit that does is cut as a whole. Units are made distinct, and most of them (letters,
    with a mark behind them or not) cut, by array operations.
    """

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], cut: Callable[[str], list[str]], special: dict[str, int], cache: int | None = None):
        self.encode_words, self.cut, self.limit = encode_words, cut, cache or CACHE
        self.special = {name: np.uint32(i).tobytes() for name, i in special.items()}
        self.names = sorted(special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.names)) + ")") if special else None
        self.known: dict[str, bytes] = {}

    def _packed(self, words: list[str]) -> list[bytes]:
        fresh = [w for w in words if w not in self.known and w not in self.special]
        if len(self.known) + len(fresh) > self.limit:
            self.known = {w: self.known[w] for w in words if w in self.known}
        self.known |= self.special
        self.known.update(zip(fresh, self.encode_words(fresh), strict=True))
        out = [*map(self.known.__getitem__, words)]
        for w in fresh:
            if len(w) > LONG:
                del self.known[w]
        return out

    def _whole(self, text: str) -> list[str]:
        pieces = self.at_special.split(text) if self.at_special else [text]
        return [w for p in pieces if p for w in ([p] if p in self.special else self.cut(p))]

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets by text) of a string column without nulls."""
        n = len(column)
        pieces = pc.split_pattern(column, " ")
        bounds = pieces.offsets.to_numpy().astype(np.int64)
        flat, bounds = pieces.flatten(), bounds - bounds[0]
        first = bounds[:-1]
        heads = flat.take(pa.array(first)).to_pylist()
        units = flat.dictionary_encode()
        del pieces, flat
        codes = units.indices.to_numpy().copy()
        units = units.dictionary
        total = len(units)

        # letters below SETTLED, perhaps with one mark behind them
        buf, offsets = utf8(units)
        size = np.diff(offsets)
        last = np.zeros(total, np.uint8)
        last[size > 0] = buf[offsets[1:][size > 0] - 1]
        marked = _MARK[last] & (size > 1)
        base = pc.utf8_rtrim(units, "".join(sorted(MARKS)))
        plain = pc.utf8_is_alpha(base).to_numpy(zero_copy_only=False) & (np.diff(utf8(base)[1]) + marked == size)
        high = np.concatenate([[0], np.cumsum(buf >= _HIGH)])
        plain &= high[offsets[1:]] == high[offsets[:-1]]
        base = pc.binary_join_element_wise(pa.scalar(" ", base.type), base.filter(pa.array(plain)), pa.scalar("", base.type)).dictionary_encode()
        index = {w: i for i, w in enumerate(base.dictionary.to_pylist())}
        for mark in MARKS:
            index.setdefault(mark, len(index))
        code_of = np.zeros(256, np.int64)
        for mark in MARKS:
            code_of[ord(mark)] = index[mark]
        count = np.zeros(total + n, np.int64)
        count[:total][plain] = 1 + marked[plain]
        start = np.cumsum(count) - count
        words = np.zeros(int(count.sum()), np.int64)
        words[start[:total][plain]] = base.indices.to_numpy()
        words[start[:total][plain & marked] + 1] = code_of[last[plain & marked]]

        # the others one by one
        more: list[int] = []
        odd = np.zeros(n + 1, np.int64)
        other = np.flatnonzero(~plain)
        bad = np.zeros(total, bool)
        for i, unit in zip(other.tolist(), units.take(pa.array(other)).to_pylist(), strict=True):
            if not unit or unit[0].isspace() or unit[-1].isspace():
                bad[i] = True
                continue
            own = [index.setdefault(w, len(index)) for w in self.cut(" " + unit)]
            start[i], count[i] = len(words) + len(more), len(own)
            more += own
        is_first = np.zeros(len(codes), bool)
        is_first[first] = True
        odd[np.searchsorted(bounds, np.flatnonzero(bad[codes] & ~is_first), "right") - 1] = 1
        odd[np.flatnonzero([h[-1:].isspace() for h in heads])] = 1
        for name in self.names:
            odd[np.flatnonzero(pc.match_substring(column, name).to_numpy(zero_copy_only=False))] = 1
        for i, (head, whole) in enumerate(zip(heads, odd[:-1].tolist(), strict=True)):
            own = [index.setdefault(w, len(index)) for w in (self._whole(column[i].as_py()) if whole else self.cut(head) if head else ())]
            start[total + i], count[total + i] = len(words) + len(more), len(own)
            more += own
        codes[first] = np.arange(total, total + n)
        words = np.concatenate([words, np.array(more, np.int64)])
        on = is_first | np.repeat(odd[:-1] == 0, np.diff(bounds))
        del units, base, buf, high, heads, more, is_first

        packed = self._packed([*index])
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        source = np.frombuffer(b"".join(packed), "<u4")
        del packed, index
        # the ids of distinct units in a row; where those of each begin and how many they are
        sizes = lengths[words]
        source = source[_spread((np.cumsum(lengths) - lengths)[words], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        begin = upto[start]
        size = (upto[start + count] - begin).astype(np.int32)
        del words, sizes, upto, start, count
        n_ids = size[codes]
        n_ids[~on] = 0
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(n_ids, first, dtype=np.int64))]) if n else np.zeros(1, np.int64)
        ids, at = np.empty(int(ends[-1]), np.uint32), 0
        # units in runs, so that index arrays stay small
        for low in range(0, len(codes), RUN):
            own = source[_spread(begin[codes[low : low + RUN]], n_ids[low : low + RUN])]
            ids[at : at + len(own)] = own
            at += len(own)
        return ids, ends


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then those of starts[1], and so on."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(int(ends[-1]) if len(ends) else 0)


#: Lead bytes from here on may begin a character from SETTLED on.
_HIGH = 0xD4
_MARK = np.zeros(256, bool)
_MARK[[ord(m) for m in MARKS]] = True


def trie_encoder(text: str) -> tuple[Vocabulary, UnitEncoder]:
    vocabulary = Vocabulary(text)
    trie = Trie(vocabulary)

    def words(missing: list[str]) -> list[bytes]:
        raw = [w.encode() for w in missing]
        ids = trie.encode(set(raw))
        return [ids[w] for w in raw]

    return vocabulary, UnitEncoder(words, cutter(text), vocabulary.special)


@functools.lru_cache(1)  # a worker keeps it, and the words it knows, from task to task
def library_encoder(text: str) -> UnitEncoder:
    """Words encoded by the tokenizers library's own model."""
    from tokenizers import Tokenizer

    tokenize = Tokenizer.from_str(text).model.tokenize
    to_alphabet = {b: c for c, b in byte_alphabet().items()}
    special = {t["content"]: t["id"] for t in json.loads(text)["added_tokens"]}

    space = to_alphabet[0x20]

    def words(missing: list[str]) -> list[bytes]:
        names = [
            space + w[1:] if w[0] == " " and w.isascii() and w[1:].isalpha() else w.encode().decode("latin-1").translate(to_alphabet)
            for w in missing]
        return [array.array("I", [t.id for t in tokenize(w)]).tobytes() for w in names]

    return UnitEncoder(words, cutter(text), special, 2 * CACHE)


def text_batches(column: pa.Array, size: int = BATCH) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of about ``size`` bytes; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    for low, high in slices(utf8(column)[1], size):
        yield low, column.slice(low, high - low)


def gathered(batches: Iterator[pa.RecordBatch], text_col: str, size: int = BATCH) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they hold ``size`` bytes of text."""
    held: list[pa.RecordBatch] = []
    got = 0
    for batch in batches:
        held.append(batch)
        got += batch[text_col].nbytes
        if got >= size:
            yield from _together(held)
            held, got = [], 0
    yield from _together(held)


def _together(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return held if len(held) < 2 else [pa.concat_batches(held)]


def encode_column(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus the ids (packed little-endian unsigned 32-bit) and, if named, the text decoded from them.

    ``tokenizer`` is the path of the tokenizer file on the driver; its content (of fixed size) is broadcast. A null text counts as
    empty and has no ids. A column of the same name as a new one is an error.
    """
    if {ids_col, decoded_col} & set(docs.columns):
        raise ValueError(f"{ids_col} or {decoded_col} is already a column")
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = trie_encoder(shared.value)
        for batch in batches:
            packed: list[bytes] = []
            decoded: list[bytes] = []
            for _, texts in text_batches(batch.column(names.index(text_col))):
                ids, bounds = encoder.batch(texts)
                for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    packed.append(ids[low:high].tobytes())
                    if decoded_col:
                        decoded.append(vocabulary.decode(ids[low:high]))
            columns = [*batch.columns, pa.array(packed, pa.binary())]
            if decoded_col:
                columns.append(pa.array(decoded, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, ids_col, *([decoded_col] if decoded_col else [])])
        del vocabulary, encoder
        release()

    added = [T.StructField(ids_col, T.BinaryType()), *([T.StructField(decoded_col, T.StringType())] if decoded_col else [])]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def encode_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and SHA-256 of the ids and of the decoded text: what ``encode_column`` gives, without moving it to the JVM.

    A null text counts as empty: no ids, and the digests of nothing. Repeated rows and null ids each give a row, an empty table gives none.
    Other columns are not read.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = trie_encoder(shared.value)
        for batch in batches:
            n, digests, decoded = [], [], []
            for _, texts in text_batches(batch["body"]):
                ids, bounds = encoder.batch(texts)
                for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    n.append(high - low)
                    digests.append(hashlib.sha256(ids[low:high].tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(vocabulary.decode(ids[low:high])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        del vocabulary, encoder
        release()

    schema = T.StructType([
        narrow.schema["id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
