"""SentencePiece encoding that keeps offsets, and decoding.

1. Normalisation: at every position the longest key of the model's compiled character map is
   replaced; a character that begins no key stays. Blanks become U+2581, a blank goes in front,
   extra ones are dropped if the model says so. Each byte of the result is aligned with the
   byte of the source where its replacement began.
2. Merging: adjacent symbols whose joined text is a piece are merged, best score first, the
   leftmost of equals. Characters are sorted into classes such that no piece mixes two of them
   (but for blanks in front); no merge crosses classes, so the text is cut between them, and a
   cut is worked off once for as long as it is remembered (a bounded table). The new cuts of
   some megabytes of text are merged together, all of one length at once; a cut of n > 32
   characters takes n log n steps of its own.
3. Spans: the pieces follow each other in the normalised text; their ends are projected through
   the alignment to byte offsets of the original text. A character that is no piece becomes
   the ids of its bytes; the last one carries its span, those before it are empty.

Defined results: a null text counts as empty; an empty text has only the end id, if one is
asked for, whose span is empty and lies at the end; a blank text has whatever the model keeps
of it; decoding leaves out control ids, gives one U+FFFD for each byte that is no UTF-8 and the
model's mark for the unknown id; ids outside the vocabulary fail. Repeated rows are encoded
each for itself. Only BPE models with byte fallback and without user-defined or unused pieces
are read; others are rejected.
"""

from __future__ import annotations

import heapq
import itertools
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memory, pick, slices

#: The letter that stands for a blank; piece types of the model file.
BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6

_NO_MERGE = 1 << 60


def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map, {source: replacement}.

    The blob holds the size of a double-array trie, the trie (32-bit units) and the zero-ended
    replacements; a leaf's value is the place of its replacement. A unit keeps its byte in the
    low bits, whether a leaf follows in bit 8 and the way to its children above.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    texts = blob[4 + size:]
    step = (units >> 10) << ((units & 0x200) >> 6)
    letters = np.arange(1, 256)
    out: dict[str, str] = {}
    # Level by level: the places of the children of all open nodes at once.
    bases, prefixes = step[:1], [b""]
    while prefixes:
        at = bases[:, None] ^ letters
        unit = units[np.minimum(at, len(units) - 1)]
        node, letter = np.nonzero((at < len(units)) & (unit & 0x800000FF == letters))
        place = at[node, letter]
        bases = place ^ step[place]
        prefixes = [prefixes[i] + bytes([c]) for i, c in zip(node.tolist(), (letter + 1).tolist(), strict=True)]
        for i in np.flatnonzero(units[place] >> 8 & 1):
            start = int(units[bases[i]]) & 0x7FFFFFFF
            out[prefixes[i].decode()] = texts[start:texts.index(0, start)].decode()
    return out


@dataclass(frozen=True)
class Model:
    """What an encoder needs, small enough to be sent to every task (its size is that of the
    model file)."""
    pieces: list[str]                # by id
    kinds: list[int]                 # by id
    rank: dict[str, int]             # of normal pieces, 0 merges first
    rules: dict[str, str]            # of the compiled character map
    byte_ids: list[int]
    unknown: str                     # how the unknown id is shown
    end: int
    blank_first: bool
    blank_last: bool
    drop_blanks: bool
    escape: bool


def load(path: str) -> Model:
    """Read a model file."""
    from sentencepiece import sentencepiece_model_pb2 as proto
    spec = proto.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    return read(spec)


def read(spec) -> Model:
    """Take over a parsed model."""
    kinds = [p.type for p in spec.pieces]
    if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback:
        raise ValueError("only BPE models with byte fallback are supported")
    if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or spec.denormalizer_spec.precompiled_charsmap:
        raise ValueError("user-defined or unused pieces and denormalisers are not supported")
    normal = [p for p in spec.pieces if p.type == _NORMAL]
    places = {s: i for i, s in enumerate(sorted({p.score for p in normal}, reverse=True))}
    ids = {p.piece: i for i, p in enumerate(spec.pieces)}
    t, n = spec.trainer_spec, spec.normalizer_spec
    return Model([p.piece for p in spec.pieces], kinds, {p.piece: places[p.score] for p in normal},
                 character_map(n.precompiled_charsmap), [ids[f"<0x{b:02X}>"] for b in range(256)],
                 t.unk_surface, t.eos_id, n.add_dummy_prefix and not t.treat_whitespace_as_suffix,
                 n.add_dummy_prefix and t.treat_whitespace_as_suffix, n.remove_extra_whitespaces,
                 n.escape_whitespaces)


class Normaliser:
    """Longest-prefix replacement with source alignment."""

    def __init__(self, model: Model):
        self.m = model
        self.blank = BLANK if model.escape else " "
        self.longest: dict[str, int] = {}
        for key in model.rules:
            self.longest[key[0]] = max(self.longest.get(key[0], 0), len(key))
        # A character is copied if it is no key and the next one continues none.
        special = {k for k in model.rules if len(k) == 1} | {c for k in model.rules for c in k[1:]} | {" "}
        cls = "[^" + "".join(f"\\U{ord(c):08x}" for c in sorted(special)) + "]"
        self.plain = regex.compile(f"{cls}+(?={cls}|$)", regex.DOTALL)
        self.simple = not model.rules and not model.drop_blanks and not model.blank_last and model.escape

    def __call__(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text and for each of its bytes, and its end, the source byte it comes
        from (None where :meth:`source` works it out from the blanks)."""
        if self.simple:
            return (self.blank * self.m.blank_first + text.replace(" ", BLANK) if text else ""), None
        out: list[str] = []
        aligned: list[np.ndarray] = []
        read, at, n = 0, 0, len(text)

        def emit(piece: str) -> None:
            piece = piece.replace(" ", self.blank)
            out.append(piece)
            aligned.append(np.full(len(piece.encode()), read, np.int64))

        def prefix() -> tuple[int, str]:
            """Length and replacement of the longest key here, or the character itself."""
            for k in range(min(self.longest.get(text[at], 0), n - at), 0, -1):
                new = self.m.rules.get(text[at:at + k])
                if new is not None:
                    return k, new
            return 1, text[at]

        while self.m.drop_blanks and at < n:
            k, new = prefix()
            if new != " ":
                break
            read, at = read + len(text[at:at + k].encode()), at + k
        if at == n:
            return "", np.array([read])
        if self.m.blank_first:
            emit(" ")
        skip = self.m.drop_blanks
        while at < n:
            run = self.plain.match(text, at)
            if run:
                size = len(run[0].encode())
                out.append(run[0])
                aligned.append(np.arange(read, read + size))
                at, read, skip = run.end(), read + size, False
                continue
            k, new = prefix()
            kept = new.lstrip(" ") if skip else new
            if kept:
                emit(kept)
            if new:
                skip = self.m.drop_blanks and new.endswith(" ")
            read, at = read + len(text[at:at + k].encode()), at + k
        joined, align = "".join(out), np.concatenate([*aligned, [read]])
        if self.m.drop_blanks and joined.endswith(self.blank):
            joined = joined.rstrip(self.blank)
            align = align[:len(joined.encode()) + 1]
        if self.m.blank_last:
            joined += self.blank
            align = np.concatenate([align, np.full(len(self.blank.encode()), align[-1])])
        return joined, align

    def source(self, text: str, align: np.ndarray | None, ends: np.ndarray) -> np.ndarray:
        """Source bytes before each of the places ``ends`` of the normalised text."""
        if align is not None:
            return align[ends]
        # Every blank of the source takes two bytes more here, the blank in front takes three.
        raw = np.frombuffer(text.encode(), np.uint8)
        blanks = np.flatnonzero(raw == 32)
        front = 3 * self.m.blank_first
        return np.maximum(ends - front, 0) - 2 * np.searchsorted(
            blanks + 2 * np.arange(len(blanks)) + front, ends, "left")


def cutter(pieces: Iterable[str]) -> Callable[[str], list[str]]:
    """A function that cuts a text where no piece can reach across."""
    beside = {a + b for p in pieces for a, b in itertools.pairwise(p)}
    if any(p[0] != BLANK and p[1] == BLANK for p in beside):
        # Pieces that end in a blank or hold one: no cuts.
        return lambda text: [text] if text else []
    home: dict[str, str] = {}

    def find(c: str) -> str:
        while home.setdefault(c, c) != c:
            home[c] = c = home[home[c]]
        return c

    for a, b in beside:
        if a != BLANK:
            home[find(a)] = find(b)
    classes: dict[str, list[str]] = {}
    for c in home:
        classes.setdefault(find(c), []).append(c)
    sets = ["[" + "".join(f"\\U{ord(c):08x}" for c in sorted(of)) + "]+" for of in
            sorted(classes.values(), key=len, reverse=True) if len(of) > 1 or of[0] * 2 in beside]
    return re.compile(f"{BLANK}*(?:{'|'.join([*sets, f'[^{BLANK}]'])})|{BLANK}+", re.DOTALL).findall


class Merges:
    """Merging of many short cuts at once: of all cuts of one length the best pair of each is
    merged, then the next one, so that the rows of a step stay equally long."""

    def __init__(self, rank: dict[str, int], ids: dict[str, int]):
        #: Symbols are pieces by id; characters that are no piece of their own never merge.
        self.of = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.of[ord(p)] = i
        made = [(ids[p[:k]] << 32 | ids[p[k:]], rank[p], ids[p]) for p in rank for k in range(1, len(p))
                if p[:k] in ids and p[k:] in ids]
        made.sort()
        self.pair, self.place, self.whole = np.array(made or [(-1, _NO_MERGE, 0)], np.int64).T.copy()

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the table, or -1."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, at, -1)

    def packed(self, cuts: list[str]) -> dict[str, bytes]:
        """Ids of the cuts whose characters are all pieces, packed."""
        out: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        for c in cuts:
            by_length.setdefault(len(c), []).append(c)
        for n, words in by_length.items():
            points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n)
            ids = self.of[points]
            row = np.flatnonzero((ids >= 0).all(axis=1))
            ids = ids[row].astype(np.int64)
            at = self._look(ids[:, :-1], ids[:, 1:])
            place = np.where(at >= 0, self.place[at], _NO_MERGE)
            while len(row):
                wide = ids.shape[1]
                best = place.argmin(axis=1) if wide > 1 else np.zeros(len(row), np.int64)
                each = np.arange(len(row))
                open_ = place[each, best] < _NO_MERGE if wide > 1 else np.zeros(len(row), bool)
                raw = ids[~open_].astype(np.int32).tobytes()
                out.update((words[i], raw[k * 4 * wide:(k + 1) * 4 * wide])
                           for k, i in enumerate(row[~open_].tolist()))
                row, ids, at, place, best = row[open_], ids[open_], at[open_], place[open_], best[open_, None]
                if not len(row):
                    break
                each, column = np.arange(len(row)), np.arange(wide - 1)
                new = self.whole[at[each, best[:, 0]]]
                ids = np.where(column <= best, ids[:, :-1], ids[:, 1:])
                ids[each, best[:, 0]] = new
                at = np.where(column[:-1] < best, at[:, :-1], at[:, 1:])
                place = np.where(column[:-1] < best, place[:, :-1], place[:, 1:])
                for side in (best[:, 0] - 1, best[:, 0]):
                    ok = np.flatnonzero((side >= 0) & (side < wide - 2))
                    s = side[ok]
                    found = self._look(ids[ok, s], ids[ok, s + 1])
                    at[ok, s] = found
                    place[ok, s] = np.where(found >= 0, self.place[found], _NO_MERGE)
        return out


class Encoder:
    """Encodes with one model. Kept by a worker from task to task, with what it remembers."""

    def __init__(self, model: Model, remembered: int = 120_000, short: int = 40):
        self.m = model
        self.normalise = Normaliser(model)
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == _NORMAL}
        self.cut = cutter(model.rank)
        self.chunks, self.short = Memory(remembered), short
        self.merges = Merges(model.rank, self.ids)
        #: Bytes of a token in the normalised text; whether it is a byte, and one that continues.
        self.size = np.array([1 if k == _BYTE else len(p.encode()) for p, k in
                              zip(model.pieces, model.kinds, strict=True)], np.int64)
        self.is_byte = np.array([k == _BYTE for k in model.kinds])
        self.continues = np.zeros(len(model.pieces), bool)
        self.continues[model.byte_ids[0x80:0xC0]] = True

    def merge(self, text: str) -> bytes:
        """Ids of a cut, packed."""
        known = self.ids.get
        if len(text) > 32:
            parts = self._merge_long(text)
        else:
            rank = self.m.rank.get
            parts = list(text)
            places = [rank(x, _NO_MERGE) for x in map(add, text, text[1:])]
            while places:
                best = min(places)
                if best == _NO_MERGE:
                    break
                i = places.index(best)
                one = parts[i] = parts[i] + parts.pop(i + 1)
                del places[i]
                if i:
                    places[i - 1] = rank(parts[i - 1] + one, _NO_MERGE)
                if i < len(places):
                    places[i] = rank(one + parts[i + 1], _NO_MERGE)
        ids = [known(p) for p in parts]
        if None in ids:
            ids = [j for p, i in zip(parts, ids, strict=True)
                   for j in ([i] if i is not None else map(self.m.byte_ids.__getitem__, p.encode()))]
        return array("i", ids).tobytes()

    def _merge_long(self, text: str) -> list[str]:
        rank, n = self.m.rank.get, len(text)
        parts: list[str] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := rank(text[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, size = heapq.heappop(queue)
            j = after[i]
            # Out of date if either side has been merged meanwhile.
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(queue, (r, a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p]

    def _known(self, distinct: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of each cut."""
        memory, now, new = self.chunks, {}, []
        for c in distinct:
            ids = memory.young.get(c) or memory.recall(c)
            if ids is None:
                new.append(c)
            else:
                now[c] = ids
        now.update(self.merges.packed([c for c in new if len(c) <= 32]))
        for c in new:
            if c not in now:
                now[c] = self.merge(c)
            if len(c) <= self.short:
                memory.put(c, now[c])
        return now

    def encode(self, text: str | None, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends): ids of a whole text and the bytes of the text each one covers."""
        return self.encode_all([text], end)[0]

    def encode_all(self, texts: list[str | None], end: bool = True) -> list[tuple[np.ndarray, ...]]:
        """As :meth:`encode` for each text."""
        normal = [self.normalise(t or "") for t in texts]
        cuts = [self.cut(n) for n, _ in normal]
        now = self._known(set().union(*cuts))
        return [self._spans(t or "", align, np.frombuffer(b"".join(map(now.__getitem__, c)), np.int32), end)
                for t, (_, align), c in zip(texts, normal, cuts, strict=True)]

    def _spans(self, text: str, align: np.ndarray | None, ids: np.ndarray,
               end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # A place of the normalised text is where one piece ends and the next begins.
        marks = self.normalise.source(text, align, np.concatenate([[0], np.cumsum(self.size[ids])]))
        begins, ends = marks[:-1], marks[1:]
        byte = self.is_byte[ids]
        if byte.any():
            follows = self.continues[ids]
            head = np.maximum.accumulate(np.where(follows, 0, np.arange(len(ids))))
            begins = begins[head]
            ends = np.where(byte & np.append(follows[1:], False), begins, ends)
        if end:
            last = len(text.encode())
            return np.append(ids, np.int32(self.m.end)), np.append(begins, last), np.append(ends, last)
        return ids, begins, ends


class Decoder:
    """Texts of ids."""

    def __init__(self, model: Model):
        self.m = model
        self.control = {i for i, k in enumerate(model.kinds) if k == _CONTROL}
        self.shown = [b"" if k == _CONTROL else model.unknown.encode() if k == _UNKNOWN
                      else p.replace(BLANK, " ").encode() for p, k in zip(model.pieces, model.kinds, strict=True)]
        for b, i in enumerate(model.byte_ids):
            self.shown[i] = bytes([b])
        self.is_control = np.array([k == _CONTROL for k in model.kinds])

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids."""
        while ids and self.m.kinds[ids[-1]] == _CONTROL:
            ids = ids[:-1]
        try:
            if not self.control.isdisjoint(ids):
                raise ValueError("bytes on both sides of a control id do not belong together")
            text = b"".join(map(self.shown.__getitem__, ids)).decode()
        except ValueError:
            # Bytes that are no UTF-8 stand alone, one mark each; pieces are always whole.
            text = "".join(self._bytes(b"".join(map(self.shown.__getitem__, run))) if byte
                           else b"".join(map(self.shown.__getitem__, run)).decode()
                           for byte, run in itertools.groupby(ids, lambda i: self.m.kinds[i] == _BYTE))
        return text[self._front(ids):]

    def decode_all(self, flat: np.ndarray, ends: list[int]) -> list[str]:
        """The texts of lists of ids that lie end to end; list k ends at ``ends[k + 1]``."""
        shown = list(map(self.shown.__getitem__, flat.tolist()))
        # Control ids before the last one are rare and cut byte runs: the slow way takes them.
        rare = np.concatenate([[0], np.cumsum(self.is_control[flat])]) if len(flat) else np.zeros(1, np.int64)
        out = []
        for x, y in zip(ends, ends[1:], strict=False):
            if x == y or rare[y - 1] > rare[x] or self.m.drop_blanks:
                out.append(self.decode(flat[x:y].tolist()))
                continue
            try:
                text = b"".join(shown[x:y]).decode()
            except UnicodeDecodeError:
                out.append(self.decode(flat[x:y].tolist()))
                continue
            out.append(text[self._front(flat[x:x + 1].tolist()):])
        return out

    def _front(self, ids: list[int]) -> int:
        """How many blanks at the beginning were put in front."""
        n = 0
        if self.m.blank_first or self.m.blank_last or self.m.drop_blanks:
            for i in itertools.filterfalse(self.control.__contains__, ids):
                if self.m.kinds[i] != _NORMAL or self.m.pieces[i][0] != BLANK:
                    break
                n += 1
                if not self.m.drop_blanks or self.m.pieces[i] != BLANK:
                    break
        return n

    @staticmethod
    def _bytes(data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + n].decode())
                    break
                except UnicodeDecodeError:
                    pass
            else:
                n = 1
                out.append("�")
            at += n
        return "".join(out)


_encoders: list[Encoder] = []


def _encoder(model: Model) -> Encoder:
    """This worker's encoder of the model."""
    if not _encoders or _encoders[0].m.pieces != model.pieces or _encoders[0].m != model:
        _encoders[:] = [Encoder(model)]
    return _encoders[0]


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           end: bool = True, spans: tuple[str, ...] = ("begins", "ends")) -> DataFrame:
    """(id, ids, begins, ends) for every row: arrays of int; piece k covers the bytes from
    ``begins[k]`` up to ``ends[k]`` of the text's UTF-8. ``spans`` names those that are wanted."""
    names = ("ids", *spans)
    places = [("ids", "begins", "ends").index(n) for n in names]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = pick(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(sent.value)
        for whole in batches:
            for b in slices(whole, 2 << 20):
                rows = coder.encode_all(b.column("text").to_pylist(), end)
                at = pa.array(np.cumsum([0, *[len(r[0]) for r in rows]]), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate([r[k] for r in rows]), pa.int32()))
                         for k in places]
                yield pa.RecordBatch.from_arrays([b.column("id"), *lists], names=["id", *names])

    kind = base.schema["id"].dataType.simpleString()
    return (base.mapInArrow(work, f"id {kind}, {', '.join(f'{n} array<int>' for n in names)}")
            .select(F.col("id").alias(id_col), *names))


def decode(encoded: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",),
           ids_col: str = "ids") -> DataFrame:
    """(keep..., ids, text): the text of every row's ids; null ids give an empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    base = encoded.select(*keep, ids_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Decoder(sent.value)
        for whole in batches:
            for b in slices(whole, 2 << 20):
                col = b.column(ids_col)
                ends = col.offsets.to_numpy()
                flat = col.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
                texts = coder.decode_all(flat, (ends - ends[0]).tolist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                                 names=[*b.schema.names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(work, f"{schema}, text string")
