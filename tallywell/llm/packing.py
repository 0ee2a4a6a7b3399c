"""Best-fit packing of tokenised documents into sequences, by the linear grouping scheme.

Documents are encoded in their tasks and cut into pieces. The driver sees only how many pieces each length has,
and plans by those counts. Pieces are then ranked within their length, from counts per length and bucket, and
each piece looks its rank up in the plan.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.llm.common import chunks, column, settled, tidy, unused
from tallywell.llm.packing_plan import plan
from tallywell.llm.pieces import model_path

#: Words, and their cores, whose ids a task remembers; about 80 MB.
REMEMBERED, CORES = 200_000, 300_000
#: A word of marks, letters and marks: letters that stay one letter in lower case and under normalisation.
parted = re.compile(rb"([!-&(-/:-@\[-`{-~]*)((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)").fullmatch
#: The pattern that parts words where letters meet marks, but for a contraction at the start of marks.
PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of a text as little-endian 32-bit bytes. White space parts what the tokenizer joins, so words are remembered.

    A model that parts letters from marks (``PARTED``) and closes its last token of a run with a suffix gets the letters
    of many words as one text, and words that differ in the marks around them share the ids of their letters.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = b"<|"
        self.seen: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.closing: np.ndarray | None = None
        if suffix and PARTED in _patterns(json.loads(self.library.pre_tokenizer.__getstate__())):
            vocabulary = self.library.get_vocab()
            self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closing[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def _whole(self, words: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _runs(self, words: list[bytes], each: int = 512) -> list[bytes]:
        """Ids of runs of letters, ``each`` of them as one text whose closing tokens part them again."""
        out: list[bytes] = []
        groups = [words[i: i + each] for i in range(0, len(words), each)]
        for group, found in zip(groups, self.library.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False),
                                strict=True):
            ids = np.array(found.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
            raw = ids.tobytes()
            out += ([raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                    if len(ends) == len(group) and ends[-1] == len(raw) else self._whole(group))
        return out

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of new words."""
        if self.closing is None:
            self.seen.update(zip(new, self._whole(new), strict=True))
            return
        seen, cores = self.seen, self.cores
        found = [None if self.special in w or (m := parted(w)) is None else m.groups() for w in new]
        odd = [w for w, m in zip(new, found, strict=True) if m is None]
        seen.update(zip(odd, self._whole(odd), strict=True))
        words = [w for w, m in zip(new, found, strict=True) if m is not None]
        heads, runs, tails = zip(*[m for m in found if m is not None], strict=True) if words else ((), (), ())
        del found
        fresh = list(set(runs).difference(cores))
        cores.update(zip(fresh, self._runs(fresh), strict=True))
        marks = list({*heads, *tails})
        around = dict(zip(marks, self._whole(marks), strict=True))
        seen.update(zip(words, [around[a] + cores[b] + around[c] for a, b, c in zip(heads, runs, tails, strict=True)], strict=True))
        if len(cores) > CORES:
            cores.clear()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # A-Z fold before the tokenizer does it; a text that may hold a special token, which is matched as written, stays.
        split = [(t if self.special in t else t.lower()).split() for t in texts]
        seen = self.seen
        new = list(set().union(*split).difference(seen))
        if new:
            self._learn(new)
        out = [b"".join([seen[w] for w in words]) for words in split]
        if len(seen) > REMEMBERED:
            seen.clear()
        return out


def _patterns(node: object) -> list[str]:
    """All patterns in the description of a pre-tokenizer."""
    if isinstance(node, dict):
        own = [node["Regex"]] if isinstance(node.get("Regex"), str) else []
        return own + [p for x in node.values() for p in _patterns(x)]
    return [p for x in node for p in _patterns(x)] if isinstance(node, list) else []


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    return WordIds(path)


def tokenised(docs: DataFrame, model: str = "word_bpe_49k.json", capacity: int = 4096, end: int = 1,
              id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of the pieces of each document, each document closed by ``end``.

    The model's own normalisation drops white space and lowers case. A null or empty text is one piece of
    ``end`` alone. Ids may be null or repeated. Other columns are left out; an empty table gives no pieces.
    """
    schema = T.StructType([
        T.StructField(id, docs.schema[id].dataType), T.StructField("piece", T.IntegerType()),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))])
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(model_path(model) if "/" not in model else model)
        for batch in batches:
            for rows, data, offsets in chunks(batch, text):
                raw = data.tobytes()
                ends = offsets.tolist()
                owner, piece, length, code = [], [], [], []
                for i, ids in enumerate(words.encode([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])):
                    ids += last
                    for j, low in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[low: low + 4 * capacity]
                        owner.append(i)
                        piece.append(j)
                        length.append(len(part) // 4)
                        code.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [column(rows, id).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array([p * capacity for p in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(code, pa.int64())],
                    schema.names)
        # Cores stay for the next task of the worker.
        words.seen.clear()
        tidy()

    return docs.select(id, text).mapInArrow(run, schema)


def packed(pieces: DataFrame, capacity: int = 4096, groups: int = 24, id: str = "doc_id", per_bucket: int = 20_000) -> DataFrame:
    """``pieces`` with sequence_id and offset: no sequence is longer than ``capacity``, and none has a gap.

    ``pieces`` needs the id, piece, length and ids_crc32; its other columns stay, but for those of the new names; lengths lie from 1 to ``capacity``. Equal pieces may swap
    places. Without rows the result is empty.
    """
    spark = pieces.sparkSession
    pieces = settled(pieces.drop("sequence_id", "offset"), "pieces")
    n = pieces.count()
    key = F.xxhash64(id, "piece", "ids_crc32", "length")
    kept = pieces.columns
    own, bucket, place, rank, begin = unused(pieces, "_key", "_bucket", "_n", "_rank", "_begin")
    pieces = pieces.withColumn(own, key).withColumn(
        bucket, F.pmod(F.xxhash64(own), F.lit(max(1, math.ceil(n / per_bucket)))).cast("int"))
    counts = settled(pieces.groupBy("length", bucket).count(), "length-counts")
    # At most ``capacity`` rows.
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("length", bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(begin))
    within = Window.partitionBy("length", bucket).orderBy(own)
    ranked = pieces.withColumn(place, F.row_number().over(within)).join(begins, ["length", bucket]).withColumn(
        rank, F.col(begin) + F.col(place) - 1)
    first, many, sequence = unused(ranked, "_from", "_count", "_sequence")
    table = spark.createDataFrame(
        [(r.size, r.rank, r.count, r.sequence, r.offset) for r in plan(lengths, capacity, groups)],
        f"length long, {first} long, {many} long, {sequence} long, offset long")
    # The plan is bounded by the number of lengths, not by the number of pieces.
    found = ranked.join(F.broadcast(table), (ranked.length == table.length) & (F.col(rank) >= F.col(first))
                        & (F.col(rank) < F.col(first) + F.col(many))).drop(table.length)
    return found.withColumn("sequence_id", F.col(sequence) + F.col(rank) - F.col(first)).select(*kept, "sequence_id", "offset")


def pack(docs: DataFrame, model: str = "word_bpe_49k.json", capacity: int = 4096) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packed(tokenised(docs, model, capacity), capacity)
