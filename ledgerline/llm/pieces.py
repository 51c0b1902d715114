"""SentencePiece (merge-type) encoding and decoding by a table of last tokens.

A model of merge type joins neighbouring symbols, the best-scored piece first
and the leftmost of equals, starting from characters.  Its result is a sequence
in which every two neighbours, taken alone, also encode to just these two
tokens, and no other sequence of a text has that property.  So each prefix of a
text has one last token: of the pieces that end there, the only one that is
compatible with the last token of the prefix before it.  ``PrefixTable`` finds
the pieces with an Aho-Corasick automaton, tests pairs by merging their two
texts, and reads the tokens off the table backwards.

A place where no piece can lie across is an exact cut: around a character that
no piece holds and, if no piece has a space mark behind another character,
before every such mark.  The chunks between cuts are words, so the task keeps
the tokens of the ``WORDS`` last seen ones.  The new words of a batch fill their
tables in lockstep, a place at a time, on a table of the automaton's moves;
longer chunks and those with rare characters go through an automaton one by one.
Either is linear in the chunk.  Texts are encoded whole, each in the task that
reads it; there is no shuffle, and rows never meet.

The model file is read on the driver and sent with the code (a vocabulary of
fixed size).  Supported are merge-type models that map no characters and have
neither user-defined nor unused pieces; others are refused.

Defined results: null and empty texts have no tokens and decode to the empty
text; repeated rows give repeated results; ids may be null; very long texts
need memory in proportion to their length; an empty table gives an empty
result; extra columns are kept by ``encode`` and ``decode`` (a column of the name
they write is replaced) and ignored by ``report``.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

SPACE = "▁"
#: Words and pairs kept in a task: of words two stores of this size, of which the older one goes when the newer is full.
WORDS, PAIRS = 200_000, 400_000
#: Characters with a column in the table of moves.
COMMON = 192
#: Chunks of more characters are not kept.
LONGEST_WORD = 64
#: Rows encoded at once.
BATCH = 256

# Kinds of pieces and the model type in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2


class Model(NamedTuple):
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool
    byte_fallback: bool
    unknown_surface: str


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, raw[at:at + size]
        at += size


def read_model(path: str) -> Model:
    """The parts of a model file that encoding and decoding need."""
    pieces, scores, kinds = [], [], []
    kept = {"type": 1, "bytes": 0, "surface": " ⁇ ".encode(), "map": b"", "prefix": 1, "trim": 1, "escape": 1}
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in _fields(raw):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL, **dict(_fields(value))}
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0])
            kinds.append(piece[3])
        elif number == 2:
            names = {3: "type", 35: "bytes", 44: "surface"}
            kept.update({names[k]: v for k, v in _fields(value) if k in names})
        elif number == 3:
            names = {2: "map", 3: "prefix", 4: "trim", 5: "escape"}
            kept.update({names[k]: v for k, v in _fields(value) if k in names})
    if kept["type"] != MERGE_TYPE:
        raise ValueError("only models of merge type have the pair property")
    if kept["map"] or kept["trim"] or not kept["escape"] or {USER_DEFINED, UNUSED} & set(kinds):
        raise ValueError("models that map characters, trim spaces or have user-defined or unused pieces are not supported")
    return Model(tuple(pieces), tuple(scores), tuple(kinds), bool(kept["prefix"]), bool(kept["bytes"]),
                 kept["surface"].decode())


class PrefixTable:
    """Encoder of one model.

    Tokens are numbered by their ids, characters that occur in pieces without
    being one from the vocabulary's size on.
    """

    def __init__(self, model: Model):
        self.model = model
        self.score = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k == NORMAL}
        ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        characters = {c for p in ids for c in p}
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.symbols = [*model.pieces, *sorted(characters - ids.keys())]
        self.sizes = [len(p) for p in self.symbols]
        self.size_of = np.array(self.sizes)
        ids.update({p: i for i, p in enumerate(self.symbols) if i >= len(model.pieces)})
        self.ids = ids
        self.character = {c: ids[c] for c in characters}
        self.automaton = ahocorasick.Automaton()
        for p, i in ids.items():
            if len(p) > 1:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.gap = next(c for c in map(chr, range(0x110000)) if c not in characters)
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        marked_inside = any(SPACE in p.lstrip(SPACE) for p in self.score)
        self.lockstep = Lockstep(self)
        known = "".join(map(re.escape, sorted(characters | {SPACE})))
        others = "".join(map(re.escape, sorted(characters - {SPACE})))
        self.chunk = re.compile(f"[{known}]+|[^{known}]" if marked_inside else f"{SPACE}*[{others}]+|{SPACE}+|[^{known}]")

    def _merged(self, first: str, second: str) -> bool:
        """Whether merging the characters of both texts ends with just these two (with one, if the first is empty)."""
        symbols = [*first, *second]
        cut = len(first)  # symbols before the cut belong to the first
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None or at == cut - 1:
                break  # nothing left to merge, or a merge across the cut
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            cut -= at < cut
        return symbols == ([first, second] if first else [second])

    def compatible(self, pair: int) -> bool:
        """Whether two tokens stay as they are side by side; the pair is ``(first + 1) * tokens + second``, first -1 for none."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        first, second = divmod(pair, len(self.symbols))
        found = self.pairs[pair] = self._merged(self.symbols[first - 1] if first else "", self.symbols[second])
        return found

    def last_tokens(self, text: str) -> list[int]:
        """For every prefix of a text its last token; -1 behind a character that no piece holds, where a new run starts.

        One of the pieces that end at a place is the right one, so it is the
        character alone where no longer one is compatible.
        """
        last = [self.character.get(c, -1) for c in text]
        last.append(-1)  # the place before the text
        pairs, n, done = self.pairs, len(self.symbols), -1
        for end, (token, size) in self.automaton.iter(text):
            if end != done:
                pair = (last[end - size] + 1) * n + token
                found = pairs.get(pair)
                if found or found is None and self.compatible(pair):
                    last[end] = token
                    done = end
        return last

    def _as_bytes(self, symbol: str) -> list[int]:
        return [self.byte_ids[b] for b in symbol.encode()] if self.model.byte_fallback else [self.unknown]

    def tokens(self, chunks: list[str]) -> Iterator[tuple[int, ...]]:
        """The tokens of chunks, read backwards off one table over all of them."""
        last = self.last_tokens(self.gap.join(chunks))
        sizes, vocabulary, start = self.sizes, len(self.model.pieces), 0
        for chunk in chunks:
            back: list[int] = []
            end = start + len(chunk) - 1
            while end >= start:
                token = last[end]
                if 0 <= token < vocabulary:
                    back.append(token)
                else:
                    back += reversed(self._as_bytes(chunk[end - start] if token < 0 else self.symbols[token]))
                end -= sizes[token] if token >= 0 else 1
            yield tuple(reversed(back))
            start += len(chunk) + 1

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return next(iter(self.encode_all([text])))

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of whole texts."""
        lead = SPACE if self.model.dummy_prefix else ""
        chunks = [self.chunk.findall(lead + t.replace(" ", SPACE)) if t else [] for t in texts]
        found = [list(map(self.words.get, c)) for c in chunks]
        missing = {c: self.older.get(c) for cs, fs in zip(chunks, found) if None in fs for c, f in zip(cs, fs) if f is None}
        unseen = [c for c, f in missing.items() if f is None]
        missing.update(self.lockstep.tokens(unseen))
        rest = [c for c in unseen if missing[c] is None]
        missing.update(zip(rest, self.tokens(rest)))
        for cs, fs in zip(chunks, found):
            if None in fs:
                fs = [missing[c] if f is None else f for c, f in zip(cs, fs)]
            ids = np.fromiter(chain.from_iterable(fs), np.int32)
            if not self.model.byte_fallback and len(ids):  # neighbouring unknown characters are one token
                again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
                ids = ids[np.concatenate(([True], ~again))]
            yield ids
        if len(self.words) + len(missing) > WORDS:
            self.words, self.older = {}, self.words
        self.words.update((c, f) for c, f in missing.items() if len(c) <= LONGEST_WORD)


class Lockstep:
    """The table of last tokens of many words at once.

    The automaton of the pieces of several characters, made of common characters
    only, is a table of states by characters; each state knows the longest piece
    that ends there, and each piece the next shorter one.
    """

    def __init__(self, table: PrefixTable):
        self.table = table
        counts = Counter(c for p in table.score for c in p if c in table.score)
        common = [c for c, _ in counts.most_common(COMMON)]
        column = {c: k for k, c in enumerate(common)}
        self.column = np.full(0x110000, -1, np.int16)
        self.column[[ord(c) for c in common]] = np.arange(len(common))
        self.single = np.array([table.character[c] for c in common], np.int32)
        nodes: list[dict[int, int]] = [{}]
        piece, depth = [-1], [0]
        for p in table.score:
            if len(p) < 2 or not all(c in column for c in p):
                continue
            at = 0
            for c in p:
                at = nodes[at].setdefault(column[c], len(nodes))
                if at == len(nodes):
                    nodes.append({})
                    piece.append(-1)
                    depth.append(0)
            piece[at], depth[at] = table.ids[p], len(p)
        self.piece, self.depth = np.array(piece, np.int32), np.array(depth, np.int32)
        self.move = np.zeros((len(nodes), len(common)), np.int32)
        fail = np.zeros(len(nodes), np.int32)
        #: The longest piece that ends in a state (a state), and the next shorter one that ends in a piece's state.
        self.longest, self.shorter = np.full(len(nodes), -1, np.int32), np.full(len(nodes), -1, np.int32)
        queue = [0]
        for at in queue:  # by depth, so that what a state falls back to is complete
            self.move[at] = self.move[fail[at]]
            before = self.longest[fail[at]] if at else -1
            self.longest[at] = at if piece[at] >= 0 else before
            self.shorter[at] = before
            for c, to in nodes[at].items():
                fail[to] = self.move[fail[at], c] if at else 0
                self.move[at, c] = to
                queue.append(to)
        self.keys, self.good = np.empty(0, np.int64), np.empty(0, bool)

    def _compatible(self, pairs: np.ndarray, fresh: dict[int, bool]) -> np.ndarray:
        """Whether pairs are compatible: those of earlier batches from a sorted list, others are tested."""
        out = np.zeros(len(pairs), bool)
        at = np.searchsorted(self.keys, pairs)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == pairs[known]
        out[known] = self.good[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            test = self.table.compatible
            for i, pair in zip(new.tolist(), pairs[new].tolist()):
                found = fresh.get(pair)
                if found is None:
                    found = fresh[pair] = test(pair)
                out[i] = found
        return out

    def tokens(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """The tokens of the words that are short and of common characters."""
        words = [w for w in words if len(w) <= LONGEST_WORD]
        if not words:
            return {}
        size = np.array([len(w) for w in words])
        column = self.column[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        use = np.minimum.reduceat(column, np.cumsum(size) - size) >= 0
        order = np.flatnonzero(use)[np.argsort(-size[use], kind="stable")]  # longest first: the words of a step lie in front
        if not len(order):
            return {}
        start, size = (np.cumsum(size) - size)[order], size[order]
        n, longest = len(order), int(size[0])
        last = np.full((n, longest + 1), -1, np.int32)
        state = np.zeros(n, np.int32)
        count = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
        tokens_, fresh = len(self.table.symbols), {}
        for end in range(1, longest + 1):
            m = count[end - 1]
            c = column[start[:m] + end - 1]
            state[:m] = self.move[state[:m], c]
            best = self.single[c]
            piece = self.longest[state[:m]]
            todo = np.flatnonzero(piece >= 0)
            piece = piece[todo]
            while len(todo):
                pair = (last[todo, end - self.depth[piece]].astype(np.int64) + 1) * tokens_ + self.piece[piece]
                right = self._compatible(pair, fresh)
                best[todo[right]] = self.piece[piece[right]]
                todo, piece = todo[~right], self.shorter[piece[~right]]
                todo, piece = todo[piece >= 0], piece[piece >= 0]
            last[:m, end] = best
        self._remember(fresh)
        sizes, back, at = self.table.size_of, [], size.copy()
        rows = np.arange(n)
        while len(rows):
            token = last[rows, at[rows]]
            back.append((rows, token))
            at[rows] -= sizes[token]
            rows = rows[at[rows] > 0]
        row, token = (np.concatenate(x) for x in zip(*back))
        step = np.repeat(np.arange(len(back)), [len(r) for r, _ in back])
        forward = np.lexsort((-step, row))
        token, cut = token[forward].tolist(), np.cumsum(np.bincount(row, minlength=n)).tolist()
        return {words[w]: tuple(token[s:e]) for w, s, e in zip(order.tolist(), [0, *cut], cut)}

    def _remember(self, fresh: dict[int, bool]) -> None:
        if not fresh:
            return
        keep = len(self.keys) + len(fresh) <= PAIRS
        keys = np.concatenate([self.keys if keep else self.keys[:0], np.fromiter(fresh, np.int64, len(fresh))])
        good = np.concatenate([self.good if keep else self.good[:0], np.fromiter(fresh.values(), bool, len(fresh))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.good = keys[order], good[order]


class Decoder:
    """Decoder of one model."""

    def __init__(self, model: Model):
        self.model = model
        self.surface = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                        model.unknown_surface.encode() if k == UNKNOWN else p.replace(SPACE, " ").encode()
                        for p, k in zip(model.pieces, model.kinds)]
        self.is_byte = np.array([k == BYTE for k in model.kinds])
        self.length = np.array([len(x) for x in self.surface])
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.controls = [i for i, k in enumerate(model.kinds) if k == CONTROL]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; the space put before a text is taken off again."""
        ids = np.asarray(ids, np.int64)
        length = self.length[ids]
        raw = self.flat[np.repeat(self.begin[ids] - (np.cumsum(length) - length), length) + np.arange(length.sum())].tobytes()
        lead = self._lead(ids)
        try:
            if not np.isin(ids, self.controls).any():  # they part the bytes of a character
                return raw[lead:].decode()
        except UnicodeDecodeError:
            pass
        parts = [self.surface[i] for i in ids.tolist()]
        if lead:
            parts[int(np.flatnonzero(length)[0])] = parts[int(np.flatnonzero(length)[0])][lead:]
        return "".join(self._run_by_run(ids, parts))

    def _lead(self, ids: np.ndarray) -> int:
        """1 if the first token with a text is a piece (no byte, no unknown one) that begins with a space."""
        if self.model.dummy_prefix:
            for i in ids.tolist():
                if self.model.kinds[i] == NORMAL:
                    return int(self.surface[i].startswith(b" "))
                if self.model.kinds[i] != CONTROL:
                    break
        return 0

    def _run_by_run(self, ids: np.ndarray, parts: list[bytes]) -> Iterator[str]:
        cuts = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        bounds = [0, *cuts.tolist(), len(ids)]
        for s, e in zip(bounds, bounds[1:]):
            raw = b"".join(parts[s:e])
            while raw:
                try:
                    yield raw.decode()
                    break
                except UnicodeDecodeError as bad:  # each byte that starts no character is one replacement
                    yield raw[:bad.start].decode() + "�"
                    raw = raw[bad.start + 1:]


@lru_cache(maxsize=2)
def _encoder(model: Model) -> PrefixTable:
    return PrefixTable(model)


@lru_cache(maxsize=2)
def _decoder(model: Model) -> Decoder:
    return Decoder(model)


def _lists(rows: Iterable[np.ndarray]) -> pa.Array:
    rows = list(rows)
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32()))


def _mapped(df: DataFrame, column: str, field: StructField, convert) -> DataFrame:
    """``df`` with ``field`` made from ``column`` a batch at a time, in place of a column of its name or as the last."""
    kept = [c for c in df.columns if c != field.name]
    source = df.columns.index(column)
    schema = StructType([df.schema[c] for c in kept] + [field])
    at = [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, BATCH):
                b = whole.slice(s, BATCH)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in at], convert(b.column(source))],
                                                 names=[*kept, field.name])
    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, model: Model, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids``: the tokens of each whole text."""
    def convert(column: pa.Array) -> pa.Array:
        table = _encoder(model)
        return _lists(table.encode_all([t or "" for t in column.to_pylist()]))
    return _mapped(docs, text, StructField(ids, ArrayType(IntegerType(), False)), convert)


def decode(encoded: DataFrame, model: Model, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the column ``text``: what the tokens stand for; null ids give the empty text."""
    def convert(column: pa.Array) -> pa.Array:
        decoder, flat = _decoder(model), column.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum([0, *[0 if n is None else n for n in _sizes(column)]])
        return pa.array([decoder.decode(flat[s:e]) for s, e in zip(ends, ends[1:])], pa.string())
    return _mapped(encoded, ids, StructField(text, StringType()), convert)


def _sizes(column: pa.Array) -> list[int | None]:
    return pc.list_value_length(column).to_pylist()


def report(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of tokens and digests of the ids and of the text they decode to."""
    model = read_model(path)
    coded = decode(encode(docs.select("doc_id", "text"), model).select("doc_id", "ids"), model)
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
