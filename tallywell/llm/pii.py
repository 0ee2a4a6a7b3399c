"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: mail addresses, network addresses, card and phone numbers. All words of a document
with an entity are terms that may reveal it. Over the whole corpus a term's disclosure of an entity is the share of
the entity's information content that knowing the term gives away:

    PMI(term; entity) / IC(entity) = log(N * n(term, entity) / (n(term) * n(entity))) / log(N / n(entity))

with document counts n and N. The same is estimated for what an entity shares with others: the domain and name of an
address, a network, a card issuer, a dialling code. So rare entities pool their evidence. A share is smoothed by the
number of contexts it was seen in, each of which leaves the part ``doubt`` of the doubt, and the highest one counts.
The words next to an entity are its context. A term of high disclosure is removed and one of middling disclosure is
generalised, wherever it stands, also far from its entity and in documents without one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywell.llm.common import (
    LOWER,
    U,
    buckets,
    chunks,
    column,
    cuts_of,
    mix,
    running_hash,
    settled,
    span_hash,
    tidied,
    unused,
    words,
)

KINDS = ("email", "ip", "card", "phone")
ADDED = ("removed", "general")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": "[TERM]", "general": "[WORD]"}
# Fixed patterns. Behind an at sign only the part after it is matched; what is before is the run that ends there.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

MARK = np.zeros(256, bool)
MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
TERM = np.dtype([("term", "<u8"), ("docs", "<i4"), ("held", "<i4")])
PAIR = np.dtype([("term", "<u8"), ("set", "<i8"), ("n", "<i4")])
#: A filter of fixed size; what it lets through wrongly is dropped by an exact join.
FILTER_BITS, SALTS = 22, 32


@dataclass(frozen=True)
class Settings:
    """``window`` words on either side are the context; ``doubt`` smooths disclosure, which counts 1 - doubt^contexts;
    terms of fewer than ``least_bytes`` are none."""

    window: int = 6
    doubt: float = 0.4
    least_bytes: int = 3
    remove: float = 0.95
    generalise: float = 0.85


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind as listed; each kind leftmost and without overlap.

    Every pattern is tried in linear time, also on runs of one class that fill a long text.
    """
    out, at = [], text.find("@")
    last = 0
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        if found:
            start = at
            while start > last and text[start - 1] in LOCAL_CHARACTERS:
                start -= 1
            if start < at:
                out.append((start, found.end(), "email"))
                last = found.end()
        at = text.find("@", at + 1)
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _entities(kind: str, text: str) -> list[int]:
    """The names of an entity, however it is written, and of the parts that it may share with others.

    The kind itself is no part: its label stays in the text and tells it anyway.
    """
    if kind == "email":
        value = text.lower()
        local, domain = value.split("@", 1)
        shared = [f"domain:{domain}", *(f"local:{name}" for name in [re.sub("[^a-z]", "", local)] if name)]
    elif kind == "ip":
        value = text
        numbers = [str(int(n)) for n in text.split(".")]
        shared = ["net:" + ".".join(numbers[:n]) for n in (2, 3)]
    else:
        value = re.sub("[^0-9]", "", text)
        shared = [f"issuer:{value[:6]}"] if kind == "card" else [f"code:{value[:-n]}" for n in (4, 7)]
    return [int.from_bytes(hashlib.blake2b(v.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
            for v in (f"{kind}:{value}", *shared)]


def _terms(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, start, end, first word of each text): words without marks at their ends; 0 for those too short."""
    lower = LOWER[data]
    start, end, firsts = words(lower, offsets)
    if len(start):
        # The next byte that is no mark from each place on, and the last one up to it.
        plain, at = ~MARK[data], np.arange(len(data))
        following = np.minimum.accumulate(np.where(plain, at, len(data))[::-1])[::-1]
        start = np.minimum(following[start], end)
        end = np.maximum(np.maximum.accumulate(np.where(plain, at, -1))[end - 1] + 1, start)
    term = np.where(end - start >= least, span_hash(running_hash(lower), start, end) | U(1), U(0))
    return term, start, end, firsts


SHARED = T.ArrayType(T.StructType([T.StructField("entity", T.LongType()), T.StructField("context", T.LongType())]))
FOUND = T.StructType([
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base", T.StringType()),
    T.StructField("shared", SHARED), T.StructField("set", T.LongType()),
    T.StructField("part", T.IntegerType()), T.StructField("packed", T.BinaryType()), T.StructField("pairs", T.BinaryType())])
OCCURS = "row long, term long, start int, end int"


def _places(data: np.ndarray, spans: list, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code point of each byte, byte of each code point, which terms are outside of all spans) of one text."""
    lead = (data & 0xC0) != 0x80
    places, where = np.append(0, np.cumsum(lead)), np.flatnonzero(np.append(lead, True))
    taken = np.zeros(len(data) + 1, np.int64)
    for a, b, _ in spans:
        taken[where[a] + 1: where[b] + 1] = 1
    taken = np.cumsum(taken)
    return places, where, taken[end] == taken[start]


def _found(rows: DataFrame, parts: int, s: Settings) -> DataFrame:
    """A row for each row: its base spans and its entities with their contexts; and rows of packed terms.

    These have the number of documents and of documents with an entity of each term, and how often a term is in
    documents with the same set of entities and contexts.
    """
    kept = [T.StructField(f.name, f.dataType) for f in rows.schema if f.name != "text"]
    schema = T.StructType([*kept, *FOUND.fields])
    kinds = to_arrow_schema(schema)

    def entities(text: str, spans: list, where: np.ndarray, free: np.ndarray, term: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
        """The entities with the least of their contexts, so a document counts once with an entity."""
        out = {}
        for a, b, kind in spans:
            low, high = np.searchsorted(end, where[a], "right"), np.searchsorted(start, where[b])
            own = [i for i in (*range(max(0, low - s.window), low), *range(high, min(len(term), high + s.window))) if free[i]]
            context = int(mix(term[own]).min().view(np.int64)) if own else 0
            for entity in _entities(kind, text[a:b]):
                out[entity] = min(out.get(entity, context), context)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, links = [], [np.zeros(0, PAIR)]
            for part, data, offsets in chunks(batch):
                term, start, end, firsts = _terms(data, offsets, s.least_bytes)
                owner = np.repeat(np.arange(part.num_rows), np.diff(firsts))
                out, held = [], [np.zeros(0, U)]
                for i, text in enumerate(column(part, "text").to_pylist()):
                    spans = base_spans(text)
                    row = {f"n_{k}": sum(x[2] == k for x in spans) for k in KINDS} | {"base": written(spans), "shared": []}
                    if spans:
                        own, at = slice(firsts[i], firsts[i + 1]), int(offsets[i])
                        t, low, high = term[own], start[own] - at, end[own] - at
                        _, where, free = _places(data[at: offsets[i + 1]], spans, low, high)
                        free &= t != 0
                        pairs = sorted(entities(text, spans, where, free, t, low, high).items())
                        row["shared"] = [{"entity": e, "context": c} for e, c in pairs]
                        row["set"] = int.from_bytes(hashlib.blake2b(np.array(pairs, np.int64).tobytes(), digest_size=8).digest(), "little", signed=True)
                        held.append(np.unique(t[free]))
                        link = np.ones(len(held[-1]), PAIR)
                        link["term"], link["set"] = held[-1], row["set"]
                        links.append(link)
                    out.append(row)
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, f.name) for f in kept),
                     *(pa.array([r.get(f.name) for r in out], kinds.field(f.name).type) for f in FOUND)], schema.names)
                # Each term once a document, with the number of documents of the chunk.
                at = np.lexsort((owner, term))
                once = np.ones(len(at), bool)
                once[1:] = (term[at[1:]] != term[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
                value, docs = np.unique(term[at[once]], return_counts=True)
                counted = np.zeros(len(value), TERM)
                counted["term"], counted["docs"] = value, docs
                with_one, n = np.unique(np.concatenate(held), return_counts=True)
                counted["held"][np.searchsorted(value, with_one)] = n
                every.append(counted[value != 0])
            if not every:
                continue
            joined = np.concatenate(every)
            value, inverse = np.unique(joined["term"], return_inverse=True)
            total = np.empty(len(value), TERM)
            total["term"], total["docs"] = value, np.bincount(inverse, joined["docs"], len(value))
            total["held"] = np.bincount(inverse, joined["held"], len(value))
            total, part = _dealt(total, parts)
            live, cuts = cuts_of(part)
            # The terms of pairs are among those counted.
            pairs, part = _dealt(_added_up(np.concatenate(links)), parts)
            low, high = np.searchsorted(part, live), np.searchsorted(part, live, "right")
            packed = {"part": pa.array(live, pa.int32()),
                      "packed": pa.array([total[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                      "pairs": pa.array([pairs[a:b].tobytes() for a, b in zip(low, high, strict=True)], pa.binary())}
            yield pa.RecordBatch.from_arrays(
                [packed[f.name] if f.name in packed else pa.nulls(len(live), kinds.field(f.name).type) for f in schema], schema.names)

    return rows.mapInArrow(tidied(run), schema)


def _dealt(found: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """``found`` by the parts of its terms, and these parts."""
    part = (mix(found["term"]) % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return found[order], part[order]


def _added_up(pairs: np.ndarray) -> np.ndarray:
    """Each term and set once."""
    pairs = pairs[np.lexsort((pairs["set"], pairs["term"]))]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs["term"][1:] != pairs["term"][:-1]) | (pairs["set"][1:] != pairs["set"][:-1])
    first = np.flatnonzero(new)
    out = pairs[first]
    if len(first):
        out["n"] = np.add.reduceat(pairs["n"], first)
    return out


def _candidates(packed: DataFrame, total: int, s: Settings) -> DataFrame:
    """(term, n_term, set, n) of the terms whose counts allow enough disclosure of any entity.

    The bound loses none: it is the condition on the disclosure with the greatest n_both and the least n_entity.
    """
    least = max(1, math.ceil(math.log(1 - s.generalise) / math.log(s.doubt) - 1e-9))
    bound = min(1.0, least / max(total, 1)) ** (1 - s.generalise) * (1 - 1e-9)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(rows["packed"]), TERM)
        value, inverse = np.unique(found["term"], return_inverse=True)
        held = np.bincount(inverse, found["held"], len(value))
        docs = np.bincount(inverse, found["docs"], len(value)).astype(np.int64)
        keep = (held >= least) & (held >= bound * docs)
        value, docs = value[keep], docs[keep]
        pairs = np.frombuffer(b"".join(rows["pairs"]), PAIR)
        pairs = _added_up(pairs[np.isin(pairs["term"], value)])
        return pd.DataFrame({"term": pairs["term"].astype(np.int64),
                             "n_term": docs[np.searchsorted(value, pairs["term"])], "set": pairs["set"], "n": pairs["n"].astype(np.int64)})

    return packed.groupBy("part").applyInPandas(add, "term long, n_term long, set long, n long")


def _filter(telling: DataFrame) -> np.ndarray:
    """A bit for the hash of each term; at most 2^FILTER_BITS / 64 numbers are collected."""
    bit = F.shiftrightunsigned("term", 20).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in telling.select(F.shiftright(bit, 6).cast("int").alias("at"), bit.bitwiseAND(F.lit(63)).alias("b")).groupBy("at").agg(
            F.bit_or(F.expr("shiftleft(1L, int(b))")).alias("bits")).collect():
        out[r["at"] * 8: r["at"] * 8 + 8] = np.frombuffer(int(r["bits"]).to_bytes(8, "little", signed=True), np.uint8)
    return out


def _occurrences(rows: DataFrame, bits: np.ndarray, s: Settings) -> DataFrame:
    """(row, term, start, end) of terms outside of entities that pass the filter, in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch):
                term, start, end, firsts = _terms(data, offsets, s.least_bytes)
                bit = ((term >> U(20)) & U((1 << FILTER_BITS) - 1)).astype(np.int64)
                hit = np.flatnonzero((term != 0) & ((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0))
                cuts, texts, named = np.searchsorted(hit, firsts), column(part, "text"), column(part, "row")
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    own = hit[cuts[i]: cuts[i + 1]]
                    low, high = start[own] - offsets[i], end[own] - offsets[i]
                    places, _, free = _places(data[offsets[i]: offsets[i + 1]], base_spans(texts[i].as_py()), low, high)
                    own, low, high = own[free], low[free], high[free]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), named[i].as_py(), np.int64)), pa.array(term[own].view(np.int64)),
                         pa.array(places[low].astype(np.int32)), pa.array(places[high].astype(np.int32))], ["row", "term", "start", "end"])

    return rows.select("row", "text").mapInArrow(tidied(run), OCCURS)


def find(docs: DataFrame, s: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, n_email, n_ip, n_card, n_phone, base, added) of each row.

    ``base`` is the written base spans, ``added`` the spans (start, end, kind) of terms that reveal an entity. ``row``
    is a hash of id and text. A null text is empty. Ids may be null or repeated; repeated rows count as documents of
    their own, and yet as one context. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias(id), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", F.xxhash64(id, "text"))
    every = settled(_found(rows, buckets(rows, 13.5, "text"), s), "found", "zstd")
    found = every.where("part IS NULL").drop("part", "packed", "pairs")
    packed = every.where("part IS NOT NULL").select("part", "packed", "pairs")
    total = found.count()
    sets = found.where("set IS NOT NULL").select("set", "shared").dropDuplicates(["set"])
    seen = _candidates(packed, total, s).join(sets, "set").select("term", "n_term", "n", F.explode("shared").alias("x")).select("term", "n_term", "n", "x.*")
    pairs = seen.groupBy("term", "entity", "context").agg(F.sum("n").alias("n"), F.max("n_term").alias("n_term")).groupBy("term", "entity").agg(
        F.sum("n").alias("n_both"), F.count("*").alias("contexts"), F.max("n_term").alias("n_term"))
    # No share is above 1, so what is under the threshold by its contexts alone need not be joined.
    pairs = pairs.withColumn("sure", 1 - F.pow(F.lit(s.doubt), "contexts")).where(F.col("sure") >= s.generalise)
    entities = found.select(F.explode("shared.entity").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    content = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    told = F.log2(F.lit(float(max(total, 1))) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    share = F.when(content > 0, F.least(told / content, F.lit(1.0)) * F.col("sure")).otherwise(0.0)
    telling = pairs.join(entities, "entity").groupBy("term").agg(F.max(share).alias("share")).where(F.col("share") >= s.generalise)
    telling = settled(telling.select("term", F.when(F.col("share") >= s.remove, ADDED[0]).otherwise(ADDED[1]).alias("kind")), "telling")
    # A term may stand in very many documents, so its occurrences are dealt over salts.
    salted = telling.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    occurs = _occurrences(rows, _filter(telling), s).withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int"))
    added = occurs.join(salted, ["term", "salt"]).groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("added"))
    return found.drop("shared", "set").join(added, "row", "left")


def _all_spans(base: str, added) -> list[tuple[int, int, str]]:
    spans = [(int(a), int(b), k) for k, a, b in (x.split(":") for x in base.split(",") if x)]
    most = {}
    for x in added if added is not None else ():
        at = (x["start"], x["end"])
        most[at] = min(most.get(at, x["kind"]), x["kind"], key=ADDED.index)
    spans += [(a, b, k) for (a, b), k in most.items()]
    return sorted(spans, key=lambda x: (x[0], (*KINDS, *ADDED).index(x[2])))


def report(docs: DataFrame, s: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, counts, base_sha256, spans) of each row."""
    added = F.transform(F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:string>>")), lambda x: F.struct(
        x["start"].alias("start"), F.when(x["kind"] == ADDED[0], 4).otherwise(5).alias("order"), x["end"].alias("end"),
        F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")).alias("text")))
    listed = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(
        F.split(x, ":")[1].cast("int").alias("start"),
        (F.array_position(F.lit(list(KINDS)), F.split(x, ":")[0]) - 1).cast("int").alias("order"),
        F.split(x, ":")[2].cast("int").alias("end"), x.alias("text")))
    found = find(docs, s, id, text)
    return found.select(id, *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"),
                        F.array_join(F.transform(F.array_sort(F.concat(listed, added)), lambda x: x["text"]), ",").alias("spans"))


def sanitise(docs: DataFrame, s: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with entities and revealing terms replaced by labels of their kinds.

    Other columns stay as they are, whatever their names. A null text stays null, and an empty table empty.
    """
    spans = find(docs, s, id, text).where("base <> '' OR added IS NOT NULL").select("row", "base", "added").dropDuplicates(["row"])
    own = docs.columns
    key, base, added = unused(docs, "_row", "_base", "_added")
    marked = docs.withColumn(key, F.xxhash64(F.col(id), F.coalesce(F.col(text), F.lit("")))).join(
        spans.select(F.col("row").alias(key), F.col("base").alias(base), F.col("added").alias(added)), key, "left")

    @F.pandas_udf("string")
    def replace(texts: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
        out = []
        for t, b, a in zip(texts, base, added, strict=True):
            parts, at = [], 0
            for start, end, kind in _all_spans(b, a):
                if start >= at:
                    parts += [t[at:start], LABELS[kind]]
                at = max(at, end)
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    hit = marked.where(F.col(base).isNotNull()).withColumn(text, replace(F.col(text), base, added))
    return marked.where(F.col(base).isNull()).select(*own).unionByName(hit.select(*own))
