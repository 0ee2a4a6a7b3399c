"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent symbol pairs.

A text is cut into stretches that no piece of the vocabulary can cross, and each stretch is merged on its own:
all adjacent pairs that form a piece wait in an agenda, best score first and leftmost first among equals; a taken
pair becomes one symbol and its new neighbours join the agenda. Short stretches of a batch are merged together, the
head of each one's agenda at a time. Stretches recur, so a task remembers the ones it has seen. In every batch,
each stretch that is new is checked against the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywell.llm.common import chunks, column

SPACE = "▁"
REMEMBERED = 400_000
SHORT = 64
NEVER = np.iinfo(np.int64).max
NORMAL, UNKNOWN, USER_DEFINED, UNUSED, BYTE = 1, 2, 4, 5, 6


class Pieces:
    """The vocabulary of a model file and the merges of one text at a time."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces
                or not rules.escape_whitespaces or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces)):
            raise ValueError("a merge-type model with identity normalisation and no user-defined or unused pieces is needed")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = rules.add_dummy_prefix
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), 0)
        self.unknown_text = model.trainer_spec.unk_surface
        byte = {p.piece: i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [byte[f"<0x{b:02X}>"] for b in range(256)] if byte else None
        self.byte_of = {i: b for b, i in enumerate(self.bytes or [])}
        self.piece = [p.piece for p in model.pieces]
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type not in (NORMAL, BYTE, UNKNOWN)}
        # Where no piece has a space mark after another character, and none has a line end, texts can be cut there.
        apart = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        lines = not any("\n" in p for p in self.id)
        none = r"\n" if lines else ""
        self.cut = re.compile(
            f"{SPACE}*[^{SPACE}{none}]+|{SPACE}+" + (r"|\n" if lines else "") if apart else r".+", re.S)
        self.seen: dict[str, tuple[str, str]] = {}
        self._pairs()

    def _pairs(self) -> None:
        """Arrays for merging many stretches: symbols of characters, and the piece and rank of each pair."""
        size = len(self.piece)
        self.symbol = np.arange(0x110000, dtype=np.int64) + size
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        ranks = {score: i for i, score in enumerate(sorted(set(self.score.values())))}
        found = [(self.id[p[:i]] * size + self.id[p[i:]], self.id[p], ranks[self.score[p]])
                 for p in self.id for i in range(1, len(p)) if p[:i] in self.id and p[i:] in self.id]
        # An open table of pairs; a pair is at most ``probes`` slots behind its own.
        self.bits = max(4, (16 * len(found)).bit_length())
        self.pair = np.full((1 << self.bits) + 64, -1, np.int64)
        self.value = np.zeros(len(self.pair), np.int64)
        self.probes = 1
        for (key, into, rank), slot in zip(found, self._slot(np.array([f[0] for f in found], np.int64)).tolist(), strict=True):
            step = 0
            while self.pair[slot + step] >= 0:
                step += 1
            self.pair[slot + step], self.value[slot + step] = key, rank << 20 | into
            self.probes = max(self.probes, step + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge_many(self, stretches: list[str]) -> list[list[int]]:
        """The ids of each stretch of at most ``SHORT`` characters."""
        size = len(self.piece)
        symbols = self.symbol[np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)]
        owner = np.repeat(np.arange(len(stretches)), [len(t) for t in stretches])
        done_symbols, done_owners = [], []
        while len(symbols):
            left, right = symbols[:-1], symbols[1:]
            able = np.flatnonzero((owner[:-1] == owner[1:]) & (left < size) & (right < size))
            key = left[able] * size + right[able]
            slot = self._slot(key)
            at = np.full(len(key), -1)
            for step in range(self.probes):
                hit = self.pair[slot + step] == key
                at[hit] = slot[hit] + step
            able, value = able[at >= 0], self.value[at[at >= 0]]
            # The head of each stretch's agenda: the best rank, and the leftmost of equals.
            wait = (value >> 20) << 40 | able
            first = np.flatnonzero(np.diff(owner[able], prepend=-1))
            head = np.minimum.reduceat(wait, first) if len(first) else wait
            places = head & ((1 << 40) - 1)
            symbols[places] = value[np.searchsorted(able, places)] & ((1 << 20) - 1)
            live = np.zeros(len(stretches), bool)
            live[owner[places]] = True
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            going = live[owner]
            done_symbols.append(symbols[keep & ~going])
            done_owners.append(owner[keep & ~going])
            symbols, owner = symbols[keep & going], owner[keep & going]
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owners)
        foreign = symbols >= size
        symbols = symbols[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(stretches))).tolist()
        strange = set(np.flatnonzero(np.bincount(owner, foreign, minlength=len(stretches))).tolist())
        flat, out, low = symbols.tolist(), [], 0
        for i, high in enumerate(ends):
            ids = flat[low:high]
            out.append([j for x in ids for j in self._spelled(x)] if i in strange else ids)
            low = high
        return out

    def _spelled(self, symbol: int) -> list[int]:
        if symbol < len(self.piece):
            return [symbol]
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in chr(symbol - len(self.piece)).encode("utf-8", "surrogatepass")]

    def learn(self, stretches: list[str]) -> None:
        """Merge new stretches, check them against the library, and remember them."""
        short = [t for t in stretches if len(t) <= SHORT]
        made = dict(zip(short, self.merge_many(short) if short else [], strict=True))
        made.update((t, self.merge(t)) for t in stretches if len(t) > SHORT)
        # The library puts a space mark before a text. One that has none is asked for behind a line end.
        lead = self.library.encode("\n")
        for marked in (True, False):
            asked = [t for t in made if t.startswith(SPACE) == marked]
            texts = [(t[1:] if marked else "\n" + t).replace(SPACE, " ") for t in asked]
            for t, own, wanted in zip(asked, texts, self.library.encode(texts, num_threads=1), strict=True):
                if not marked:
                    if wanted[: len(lead)] != lead:
                        raise ValueError("the library merges across a line end")
                    wanted = wanted[len(lead):]
                elif not own:
                    # An empty text gives no ids, so a lone space mark has no counterpart.
                    wanted = made[t]
                if wanted != made[t]:
                    raise ValueError(f"ids of {t!r} differ from the library's")
        for t, ids in made.items():
            self.seen[t] = ",".join(map(str, ids)), self.text_of(ids)

    def merge(self, text: str) -> list[int]:
        """The ids of one stretch."""
        symbols: list[str | None] = list(text)
        score, last = self.score, len(symbols) - 1
        left, right = list(range(-1, last)), list(range(1, last + 2))
        agenda = []
        for i in range(last):
            pair = symbols[i] + symbols[i + 1]
            if pair in score:
                agenda.append((score[pair], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, a, b, pair = heapq.heappop(agenda)
            x, y = symbols[a], symbols[b]
            if x is None or y is None or len(x) + len(y) != len(pair):
                continue
            symbols[a], symbols[b] = pair, None
            after = right[b]
            right[a] = after
            if after <= last:
                left[after] = a
                new = pair + symbols[after]
                if new in score:
                    heapq.heappush(agenda, (score[new], a, after, new))
            before = left[a]
            if before >= 0:
                new = symbols[before] + pair
                if new in score:
                    heapq.heappush(agenda, (score[new], before, a, new))
        out: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            found = self.id.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out += [self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def text_of(self, ids: list[int]) -> str:
        """The characters that ids stand for, with space marks as spaces."""
        parts, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i == self.unknown:
                parts.append(self.unknown_text)
            elif i not in self.hidden:
                parts.append(self.piece[i].replace(SPACE, " "))
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts)

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each text."""
        mark, seen = SPACE if self.prefix else "", self.seen
        cut = [self.cut.findall(mark + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = set().union(*cut).difference(seen)
        if new:
            self.learn(list(new))
        out = []
        for stretches in cut:
            found = [seen[t] for t in stretches]
            decoded = "".join([f[1] for f in found])
            out.append((",".join([f[0] for f in found]), decoded[1:] if mark and decoded.startswith(" ") else decoded))
        if len(seen) > REMEMBERED:
            seen.clear()
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def model_path(name: str) -> str:
    """A file of the public tokenizers, where this worker has them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(df: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids (joined by commas) and decoded; the text stays only if ``keep_text``.

    A null or empty text has no ids and decodes to an empty text. A stretch whose ids differ from the
    library's fails. Other columns stay; those named like the new ones are replaced.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())]
    return _encoded(df, model, text, keep_text, new, lambda ids, decoded: (ids, decoded))


def digest(df: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """``df`` without the text, with n_tokens, ids_sha256 and decoded_sha256."""
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
           T.StructField("decoded_sha256", T.StringType())]
    return _encoded(df, model, text, False, new, lambda ids, decoded: (
        hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))


def _encoded(df: DataFrame, model: str, text: str, keep_text: bool, new: list[T.StructField], make) -> DataFrame:
    names = {f.name for f in new}
    kept = [f for f in df.schema if f.name not in names and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path(model) if "/" not in model else model)
        for batch in batches:
            for rows, _, _ in chunks(batch, text):
                texts = [t or "" for t in column(rows, text).to_pylist()]
                found = pieces.encode(texts)
                made = [make(*f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*(column(rows, f.name) for f in kept),
                     pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in found], pa.int64()),
                     pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.string())],
                    [*(f.name for f in kept), *(f.name for f in new)])

    return df.mapInArrow(run, T.StructType([*kept, *new]))
