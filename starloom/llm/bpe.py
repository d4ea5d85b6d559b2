"""Byte-level BPE by per-prefix dynamic programming.

For every prefix of a piece there is exactly one token that ends the prefix's encoding.
An automaton over the vocabulary reports all tokens that are suffixes of the prefix; the
one that is *compatible* with the last token of what precedes it is stored. Following
the stored tokens back from the end gives the ids. No merge is ever simulated on the
text, so a piece of any length takes time in proportion to its length.

Two tokens are compatible if the merges would leave exactly this boundary between them:
undo the merges on both sides of the boundary, latest first, and no pair across it may
have a merge that would have come before the step that consumed it.

Texts are cut into pieces by the vocabulary's published split pattern, so the result of
a piece depends on nothing else. The distinct new pieces of some megabytes of text are worked
off together, prefix by prefix for all pieces of one length at once; frequent short pieces,
the words between blanks and tested pairs are remembered (bounded tables that a worker keeps
from task to task and from which only what is not asked for goes).

Defined results: a null text counts as empty and has no ids; a special token's text
inside a document becomes its id; decoding bytes that are not UTF-8 gives U+FFFD as the
library does. A vocabulary in which two merges make the same token is rejected.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memory, pick, slices

#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = 1 << 60
#: Bytes of a batch that are worked off at a time.
_SLICE = 2 << 20
_BLANK_AFTER_SPACE = re.compile(r"\s(?= )").search
_WORDS = re.compile(r"^[^ ]+| [^ ]*").findall


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, reversed:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """What an encoder needs, small enough to be sent to every task (its size is that of
    the vocabulary file)."""
    tokens: list[bytes]                      # by id
    made_of: list[tuple[int, int] | None]    # by id: the two tokens of the merge that makes it
    rank: list[int]                          # by id: the merge's place, -1 for bytes
    merge: dict[tuple[int, int], int]        # pair -> place
    special: dict[str, int] = field(default_factory=dict)


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE vocabulary file (JSON with vocab, merges, added tokens)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = 1 + max([*vocab.values(), *special.values()])
    tokens: list[bytes] = [b""] * size
    for text, i in vocab.items():
        tokens[i] = bytes(letters[c] for c in text) if text not in special else text.encode()
    for text, i in special.items():
        tokens[i] = text.encode()
    made_of: list[tuple[int, int] | None] = [None] * size
    rank = [-1] * size
    merge: dict[tuple[int, int], int] = {}
    for place, pair in enumerate(spec["model"]["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        made = vocab[a + b]
        if made_of[made] is not None:
            raise ValueError(f"two merges make the token {a + b!r}")
        made_of[made] = (vocab[a], vocab[b])
        rank[made] = place
        merge[vocab[a], vocab[b]] = place
    return Vocabulary(tokens, made_of, rank, merge, special)


class Automaton:
    """The vocabulary's suffix automaton in arrays, so that many pieces advance together. Its
    states are the prefixes of tokens; ``back`` is the longest suffix that is a state too,
    ``end`` the nearest state on that way, itself included, that is a token."""

    def __init__(self, tokens: list[tuple[int, bytes]]):
        step: dict[int, int] = {}
        token, above = [-1], [(0, 0)]
        for i, t in tokens:
            at = 0
            for c in t:
                to = step.get(at << 8 | c)
                if to is None:
                    to = step[at << 8 | c] = len(token)
                    token.append(-1)
                    above.append((at, c))
                at = to
            token[at] = i
        depth = [0] * len(token)
        for state in range(1, len(token)):
            depth[state] = depth[above[state][0]] + 1
        back, end = [0] * len(token), [0] * len(token)
        for state in sorted(range(1, len(token)), key=depth.__getitem__):
            at, c = above[state]
            while at:
                at = back[at]
                to = step.get(at << 8 | c)
                if to is not None:
                    back[state] = to
                    break
            end[state] = state if token[state] >= 0 else end[back[state]]
        self.step, self.backs, self.ends, self.tokens = step, back, end, token
        self.key = np.array(sorted(step), np.int64)
        self.to = np.array([step[k] for k in self.key.tolist()], np.int64)
        self.back, self.end, self.token = (np.array(x, np.int64) for x in (back, end, token))
        self.first = np.array([step.get(c, 0) for c in range(256)], np.int64)

    def advance(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The longest states that are suffixes of each state and its next byte."""
        out = self.first[letter]
        todo = np.flatnonzero(state)
        at, c = state[todo], letter[todo]
        while len(todo):
            key = at << 8 | c
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[place] == key
            out[todo[hit]] = self.to[place[hit]]
            todo, at, c = todo[~hit], self.back[at[~hit]], c[~hit]
            todo, at, c = todo[at > 0], at[at > 0], c[at > 0]
        return out


class Encoder:
    """Encodes with one vocabulary. Kept by a worker from task to task, with what it remembers."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = 200_000, short: int = 32, pairs: int = 20):
        self.v = vocabulary
        self.short = short
        taken = set(vocabulary.special.values())
        # Tokens that no merge makes and that are no single byte never occur in an encoding.
        usable = [(i, t) for i, t in enumerate(vocabulary.tokens)
                  if t and i not in taken and (len(t) == 1 or vocabulary.made_of[i] is not None)]
        self.automaton = Automaton(usable)
        self.size = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.split = regex.compile(PATTERN).findall
        self.special = (regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")")
            if vocabulary.special else None)
        #: Ids (packed as int32) of pieces and of words with the blank before them.
        self.known = Memory(remembered)
        #: Tested pairs: a pair has one place in a table of ``2 ** pairs``, the latest one holds it.
        self.bits = pairs
        self.pair = np.full(1 << pairs, -1, np.int64)
        self.fits = np.zeros(1 << pairs, bool)
        self.tested = Memory(remembered)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' text is exactly these two tokens."""
        v, a, b, a_until, b_until = self.v, left, right, _NEVER, _NEVER
        while True:
            place = v.merge.get((a, b))
            # On equal places the leftmost pair goes first: the one that consumed ``a``
            # lies to the left of this boundary, the one that consumed ``b`` to the right.
            if place is not None and place < a_until and place <= b_until:
                return False
            if v.rank[a] < 0 and v.rank[b] < 0:
                return True
            if v.rank[a] > v.rank[b]:
                a_until, a = v.rank[a], v.made_of[a][1]
            else:
                b_until, b = v.rank[b], v.made_of[b][0]

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As :meth:`compatible` for many pairs."""
        key = left << 32 | right
        place = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        known = self.pair[place] == key
        out = self.fits[place]
        if not known.all():
            new, which = np.unique(key[~known], return_inverse=True)
            fits = np.array([self.compatible(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()])
            out[~known] = fits[which]
            # Where two pairs share a place one of them stays, with its own result.
            at = place[~known]
            self.pair[at] = key[~known]
            self.fits[at] = np.where(self.pair[at] == key[~known], out[~known], self.fits[at])
            clash = self.pair[at] != key[~known]
            if clash.any():
                self.pair[at[clash]] = -1
        return out

    def _prefixes(self, data: np.ndarray) -> np.ndarray:
        """The last token of every prefix, for rows of bytes: column n for the first n bytes."""
        auto = self.automaton
        last = np.full((len(data), data.shape[1] + 1), -1, np.int64)
        state = np.zeros(len(data), np.int64)
        for stop in range(1, data.shape[1] + 1):
            state = auto.advance(state, data[:, stop - 1])
            at = auto.end[state]
            row = np.flatnonzero(at)
            at = at[row]
            while len(row):
                token = auto.token[at]
                start = stop - self.size[token]
                left = last[row, start]
                ok = start == 0
                test = np.flatnonzero(left >= 0)
                ok[test] = self._compatible(left[test], token[test])
                last[row[ok], stop] = token[ok]
                row, at = row[~ok], auto.end[auto.back[at[~ok]]]
                row, at = row[at > 0], at[at > 0]
        return last

    def _rows(self, data: np.ndarray) -> list[bytes]:
        """Packed ids of rows of bytes."""
        last = self._prefixes(data)
        ids = np.zeros(data.shape, np.int32)
        begin = np.full(len(data), data.shape[1])
        at = begin.copy()
        row = np.arange(len(data))
        # Follow the stored tokens back; ids fill their row from the right.
        while len(row):
            token = last[row, at[row]]
            begin[row] -= 1
            ids[row, begin[row]] = token
            at[row] -= self.size[token]
            row = row[at[row] > 0]
        raw, wide = ids.tobytes(), 4 * data.shape[1]
        return [raw[k * wide + 4 * b:(k + 1) * wide] for k, b in enumerate(begin.tolist())]

    def _long(self, data: bytes) -> bytes:
        """As :meth:`_rows` for one long piece, byte by byte."""
        auto, size = self.automaton, self.v.tokens
        last, state = [-1] * (len(data) + 1), 0
        for stop, c in enumerate(data, 1):
            while (to := auto.step.get(state << 8 | c)) is None and state:
                state = auto.backs[state]
            state = to or 0
            at = auto.ends[state]
            while at:
                token = auto.tokens[at]
                start = stop - len(size[token])
                if start == 0 or (last[start] >= 0 and self._tested(last[start], token)):
                    last[stop] = token
                    break
                at = auto.ends[auto.backs[at]]
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= len(size[last[at]])
        return np.array(ids[::-1], np.int32).tobytes()

    def _tested(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.tested.young.get(key)
        if known is None:
            known = self.tested.recall(key)
        if known is None:
            known = self.compatible(left, right)
            self.tested.put(key, known)
        return known

    def _pieces(self, new: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Packed ids of pieces."""
        by_size: dict[int, list[str]] = {}
        for p in new:
            by_size.setdefault(len(p) if p.isascii() else len(p.encode()), []).append(p)
        for size, some in by_size.items():
            if size > 64:
                yield from ((p, self._long(p.encode())) for p in some)
                continue
            # A bounded number of bytes at a time.
            step = max(1, (1 << 20) // size)
            for lo in range(0, len(some), step):
                data = np.frombuffer("".join(some[lo:lo + step]).encode(), np.uint8).reshape(-1, size)
                yield from zip(some[lo:lo + step], self._rows(data.astype(np.int64)), strict=True)

    def _plan(self, text: str) -> Iterator[bytes | list[str]]:
        """The text's parts: a special token's id, or stretches that no piece reaches across."""
        parts = self.special.split(text) if self.special is not None else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield np.int32(self.v.special[part]).tobytes()
            elif part:
                # A piece never runs from a visible character into white space, so a text
                # without white space before a blank may be cut before every blank.
                yield [part] if _BLANK_AFTER_SPACE(part) else _WORDS(part)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as int32 bytes."""
        plans = [list(self._plan(t or "")) for t in texts]
        young, recall, now, several = self.known.young.get, self.known.recall, {}, {}
        new: set[str] = set()
        for s in set().union(*[x for plan in plans for x in plan if not isinstance(x, bytes)]):
            ids = young(s) or recall(s)
            if ids is not None:
                now[s] = ids
            elif s.isalpha() or (s[0] == " " and s[1:].isalpha()):
                new.add(s)
            else:
                several[s] = found = self.split(s)
                for p in found:
                    if p not in now and p not in new:
                        ids = young(p) or recall(p)
                        if ids is not None:
                            now[p] = ids
                        else:
                            new.add(p)
        fresh = dict(self._pieces(new))
        now.update(fresh)
        for s, found in several.items():
            if len(found) > 1:
                now[s] = fresh[s] = b"".join(map(now.__getitem__, found))
        for s, ids in fresh.items():
            if len(s) <= self.short:
                self.known.put(s, ids)
        return [b"".join([x if isinstance(x, bytes) else b"".join(map(now.__getitem__, x)) for x in plan])
                for plan in plans]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_all([text])[0], np.int32)

    def decode(self, ids) -> str:
        return b"".join(map(self.v.tokens.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(mark: str, vocabulary: Callable[[], Vocabulary]) -> Encoder:
    """This worker's encoder of the vocabulary with this mark; the vocabulary is only fetched
    where the encoder is not there yet, so a worker holds it once."""
    if mark not in _encoders:
        _encoders.clear()
        _encoders[mark] = Encoder(vocabulary())
    return _encoders[mark]


def _encoded(batches: Iterable[pa.RecordBatch], coder: Encoder) -> Iterator[pa.RecordBatch]:
    """(id, ids) from (id, text), a slice at a time."""
    for whole in batches:
        for b in slices(whole, _SLICE):
            rows = coder.encode_all(b.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, rows)]) // 4
            flat = np.frombuffer(b"".join(rows), np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["id", "ids"])
        pa.default_memory_pool().release_unused()


def _decoded(batches: Iterable[pa.RecordBatch], tokens: list[bytes], ids_col: str) -> Iterator[pa.RecordBatch]:
    """The batches with the text of their ids, a slice at a time."""
    for whole in batches:
        for b in slices(whole, _SLICE):
            col = b.column(ids_col)
            flat = col.values.to_numpy(zero_copy_only=False)
            ends = col.offsets.to_numpy()
            pieces = list(map(tokens.__getitem__, flat[ends[0]:ends[-1]].tolist()))
            at = (ends - ends[0]).tolist()
            texts = [b"".join(pieces[x:y]).decode("utf-8", "replace")
                     for x, y in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, "text"])
        pa.default_memory_pool().release_unused()


def _mark(vocabulary: Vocabulary) -> str:
    return hashlib.sha256(pickle.dumps(vocabulary)).hexdigest()


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids) for every row; ids is an array of int."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    mark = _mark(vocabulary)
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, _encoder(mark, lambda: sent.value))

    kind = base.schema["id"].dataType.simpleString()
    return (base.mapInArrow(work, f"id {kind}, ids array<int>")
            .select(F.col("id").alias(id_col), "ids"))


def decode(encoded: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",),
           ids_col: str = "ids") -> DataFrame:
    """(keep..., ids, text): the text of every row's ids."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(batches, sent.value, ids_col)

    base = encoded.select(*keep, ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(work, f"{schema}, text string")


def encode_decode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, ids, text) for every row: :func:`encode`, and :func:`decode` of its ids, in one worker
    for each task. One after the other they are two, and as workers are lent to either from task
    to task, both come to hold an encoder."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    mark = _mark(vocabulary)
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(mark, lambda: sent.value)
        return _decoded(_encoded(batches, coder), coder.v.tokens, "ids")

    kind = base.schema["id"].dataType.simpleString()
    return (base.mapInArrow(work, f"id {kind}, ids array<int>, text string")
            .select(F.col("id").alias(id_col), "ids", "text"))
