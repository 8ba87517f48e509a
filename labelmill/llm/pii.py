"""Personal data in texts, and the terms that give it away.

Entities (e-mail and IP addresses, card and telephone numbers) are found by patterns. A term that
stands in documents of an entity reveals it by their mutual information, estimated from the numbers of
documents that have the entity, the term, and both; a term that carries nearly all of the entity's
own information is generalised, or removed, in the documents that have the entity. The same goes for
what an entity shares with others: its kind, and the local part and the domain of an address.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import U64, flat, mix, slices
from labelmill.llm.lookup import fresh
from labelmill.operators.skew import salted_join
from labelmill.sources.staging import Staging

KINDS = ("email", "ip", "card", "phone", "term")
# How likely a term and an entity may be to meet as often by accident: one document is enough among 500.
CHANCE = 0.002
# Shares of an entity's information that a term must carry to be generalised, and to be removed.
GENERALISE = 0.8
REMOVE = 0.95
# Pairs of entity and term, or terms, that may be broadcast (16 and 8 bytes each).
BROADCAST_PAIRS = 1 << 20
# Pairs of entity and term of one text that are handed on at a time.
CROSSED = 1 << 18
# Different terms that a task counts before it hands them on.
COUNTED_TERMS = 500_000

AROUND = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A match cannot begin inside a run of digits: the run's end decides, and matches end with one.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")
# Words of three letters, and words of two letters and numbers that stand alone.
TERM = re.compile(r"[^\W\d_]{3,}|(?<![^\W_])(?:[^\W\d_]{2}|\d+)(?![^\W_])")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of a local part, ``@`` and a name with a dot, found from each ``@``."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and not LOCAL.match(text, start - 1):
            start -= 1
        found = AROUND.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def entities(text: str) -> list[Span]:
    """All base spans, by start, then by kind."""
    spans = list(emails(text))
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = DIGITS.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(DIGITS.sub("", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


@lru_cache(1 << 17)
def _word_hash(word: str) -> int:
    return _hash(word.lower())


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def entity_key(text: str, span: Span) -> int:
    """Equal for the same address or number, however it is spelt."""
    kind, start, end = span
    value = text[start:end]
    value = value.lower() if kind in ("email", "ip") else DIGITS.sub("", value)
    return _hash(f"{kind}:{value}")


def entity_keys(text: str, spans: list[Span]) -> set[int]:
    """Keys of the entities, of their kinds, and of the local parts and domains of addresses."""
    keys = set()
    for kind, start, end in spans:
        keys |= {entity_key(text, (kind, start, end)), _hash(f"kind:{kind}")}
        if kind == "email":
            local, _, domain = text[start:end].lower().partition("@")
            keys |= {_hash(f"local:{local}"), _hash(f"domain:{domain}")}
    return keys


def is_term(word: str) -> bool:
    """Whether a match of TERM is one: words of two small letters are not."""
    return len(word) != 2 or not word.islower()


def terms_of(text: str) -> set[int]:
    """Hashes of all terms, those inside of entities too."""
    return {_word_hash(w) for w in set(TERM.findall(text)) if is_term(w)}


def _free_terms(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Terms outside of the entities."""
    out, i = [], 0
    merged = joined(spans)
    for m in TERM.finditer(text):
        while i < len(merged) and merged[i][1] <= m.start():
            i += 1
        if (i == len(merged) or merged[i][0] >= m.end()) and is_term(m.group()):
            out.append(m.span())
    return out


def joined(spans: list[Span]) -> list[tuple[int, int, str]]:
    """Spans without overlaps: those that overlap are one, of the first one's kind."""
    out: list[list] = []
    for kind, start, end in spans:
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end, kind])
    return [tuple(s) for s in out]


def general(word: str) -> str:
    """What a term is generalised to: its kind."""
    return "[NAME]" if word[:1].isupper() else "[WORD]"


@dataclass
class Disclosure:
    """For each entity key the terms that reveal it, with the share of its information they carry."""

    terms: dict[int, dict[int, float]] = field(default_factory=dict)

    def of(self, keys: Collection[int], terms: Collection[int]) -> dict[int, float]:
        """Those of the terms that reveal one of the keys, with their greatest share."""
        known = [self.terms[k] for k in keys if k in self.terms]
        return {t: max(k[t] for k in known if t in k) for t in terms if any(t in k for k in known)}

    def spans(self, text: str, base: list[Span]) -> list[tuple[str, int, int, float]]:
        """Terms of the text that reveal one of its entities."""
        free = [(s, e, _word_hash(text[s:e])) for s, e in _free_terms(text, base)]
        shares = self.of(entity_keys(text, base), {t for _, _, t in free})
        return [("term", s, e, shares[t]) for s, e, t in free if t in shares]


def _pairs(entity: np.ndarray, term: np.ndarray) -> np.ndarray:
    return mix(mix(entity.astype(np.int64).view(U64)) ^ term.astype(np.int64).view(U64))


class Packed(Disclosure):
    """The same in two arrays, by the hash of entity key and term."""

    def __init__(self, entity: np.ndarray, term: np.ndarray, share: np.ndarray) -> None:
        pairs = _pairs(entity, term)
        order = np.argsort(pairs)
        self._pairs, self._shares = pairs[order], share[order]

    def of(self, keys: Collection[int], terms: Collection[int]) -> dict[int, float]:
        out: dict[int, float] = {}
        if len(self._pairs) == 0 or not terms:
            return out
        term = np.fromiter(terms, np.int64, len(terms))
        for key in keys:
            pairs = _pairs(np.array([key]), term)
            at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
            hit = self._pairs[at] == pairs
            for t, share in zip(term[hit].tolist(), self._shares[at[hit]].tolist(), strict=True):
                out[t] = max(share, out.get(t, 0.0))
        return out


def sanitise(text: str, base: list[Span], terms: list[tuple[str, int, int, float]]) -> str:
    """The text with entities named by their kind, and terms generalised or removed."""
    cuts = [(s, e, f"[{kind.upper()}]") for s, e, kind in joined(base)]
    cuts += [(s, e, "" if share >= REMOVE else general(text[s:e])) for _, s, e, share in terms]
    out, at = [], 0
    for s, e, instead in sorted(cuts):
        out += [text[at:s], instead]
        at = e
    return "".join([*out, text[at:]])


def _suspects(part: pa.RecordBatch, column: str) -> np.ndarray:
    """Rows that have an ``@`` or a digit: no others can have an entity."""
    data, offsets = flat(part.column(column))
    hits = np.concatenate([[0], np.cumsum((data == 64) | ((data >= 48) & (data <= 57)))])
    return np.flatnonzero(hits[offsets[1:]] > hits[offsets[:-1]])


def _texts(part: pa.RecordBatch, column: str, rows: np.ndarray) -> list[str]:
    return [t or "" for t in part.column(column).take(pa.array(rows)).to_pylist()]


def _crossed(keys: set[int], terms: set[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every key with every term, at most about CROSSED pairs at a time."""
    key, term = np.array([*keys], np.int64), np.array([*terms], np.int64)
    step = max(1, CROSSED // max(1, len(term)))
    for at in range(0, len(key), step):
        some = key[at : at + step]
        yield np.repeat(some, len(term)), np.tile(term, len(some))


def _beside(pairs: DataFrame, lookup: DataFrame, key: str, other: str) -> DataFrame:
    """Inner join on ``key``: a small lookup is broadcast, else the pairs of a hot key are spread."""
    if lookup.count() <= BROADCAST_PAIRS:
        return pairs.join(F.broadcast(lookup), key)
    counts = pairs.groupBy(key).agg(F.count("*").alias("n"))
    return salted_join(pairs, lookup, key, other, counts, pairs.count())


def disclosure(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``entity, term, share``: terms that carry GENERALISE or more of an entity key's information.

    ``share = log2(n * both / (entity * term)) / log2(n / entity)`` with numbers of documents, each
    counted whole, with all of its terms. All documents are counted, and a single one is enough.
    Pairs go that would meet as often by accident with a probability of more than CHANCE, by
    Chernoff's bound: ``(entity / n) ** both`` where all documents with the term have the entity.
    """
    staging = Staging(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for text in _texts(part, "text", _suspects(part, "text")):
                    spans = entities(text)
                    if spans:
                        # Term 0 stands for the entity alone.
                        for entity, term in _crossed(entity_keys(text, spans), {0, *terms_of(text)}):
                            yield pa.record_batch({"entity": entity, "term": term})

    met = (
        rows.mapInArrow(meet, "entity long, term long")
        .groupBy("entity", "term")
        .agg(F.count("*").alias("docs"))
    )
    met = staging.table(met, "met")
    alone = met.where("term = 0").select("entity", F.col("docs").alias("entity_docs"))
    pairs = met.where("term <> 0").select("entity", "term", F.col("docs").alias("both"))
    terms = staging.table(pairs.select("term").distinct(), "terms")
    wanted = None
    if terms.count() <= BROADCAST_PAIRS:
        wanted = np.sort(terms.toArrow().column("term").to_numpy())
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        total, kept = 0, []

        def flush() -> pa.RecordBatch:
            every = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in kept)])
            docs_of = np.concatenate([np.zeros(0, np.int64), *(c for _, c in kept)])
            term, at = np.unique(every, return_inverse=True)
            docs_of = np.bincount(at, docs_of, len(term)).astype(np.int64)
            kept.clear()
            return pa.record_batch(
                {
                    "term": pa.array(np.append(term, 0), pa.int64()),
                    "docs": pa.array(np.append(docs_of, total), pa.int64()),
                }
            )

        for batch in batches:
            for part in slices(batch, "text"):
                total += part.num_rows
                if asked is not None and len(asked) == 0:
                    continue
                found = []
                for text in _texts(part, "text", np.arange(part.num_rows)):
                    found += terms_of(text)
                term, docs_of = np.unique(np.array(found, np.int64), return_counts=True)
                if asked is not None:
                    at = np.minimum(np.searchsorted(asked, term), len(asked) - 1)
                    term, docs_of = term[asked[at] == term], docs_of[asked[at] == term]
                kept.append((term, docs_of))
                if sum(len(t) for t, _ in kept) > COUNTED_TERMS:
                    yield flush()
                    total = 0
        yield flush()

    counted = staging.table(
        rows.mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")),
        "counted",
    )
    n = counted.where("term = 0").agg(F.sum("docs")).first()[0] or 0
    met = _beside(pairs, alone, "entity", "term").where(F.col("entity_docs") < n)
    met = _beside(met, counted.withColumnRenamed("docs", "term_docs"), "term", "entity")
    both, entity_docs, term_docs = F.col("both"), F.col("entity_docs"), F.col("term_docs")
    apart = term_docs - both
    likely = F.when(apart > 0, apart * F.log(apart * n / (term_docs * (n - entity_docs)))).otherwise(0)
    likely = both * F.log(both * n / (term_docs * entity_docs)) + likely
    shares = met.where(likely >= -log(CHANCE)).select(
        "entity",
        "term",
        (F.log2(n * both / (entity_docs * term_docs)) / F.log2(n / entity_docs)).alias("share"),
    )
    return staging.table(shares.where(F.col("share") >= GENERALISE), "shares")


Lookup = Callable[[pa.RecordBatch, int], Disclosure]


def _by_broadcast(sent) -> Lookup:
    return lambda _part, _row: sent.value


def _by_column(part: pa.RecordBatch, row: int) -> Disclosure:
    table: dict[int, dict[int, float]] = {}
    for r in part.column(part.num_columns - 1)[row].as_py() or []:
        table.setdefault(r["entity"], {})[r["term"]] = r["share"]
    return Disclosure(table)


def _revealed(docs: DataFrame, shares: DataFrame, text_col: str) -> tuple[DataFrame, Lookup]:
    """The rows, and the disclosure table at hand in the tasks: sent whole if it is small, else
    joined by text as a last column."""
    if shares.count() <= BROADCAST_PAIRS:
        table = shares.toArrow()
        known = Packed(*(table.column(c).to_numpy() for c in ("entity", "term", "share")))
        return docs, _by_broadcast(docs.sparkSession.sparkContext.broadcast(known))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for text in _texts(part, "text", _suspects(part, "text")):
                    spans = entities(text)
                    if spans:
                        for entity, term in _crossed(entity_keys(text, spans), terms_of(text)):
                            one = np.full(len(term), _hash(text))
                            yield pa.record_batch({"entity": entity, "term": term, own: one})

    own, found = fresh("_own", docs.columns), fresh("_found", docs.columns)
    by_text = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(keys, f"entity long, term long, {own} long")
        .join(shares, ["entity", "term"])
        .groupBy(own)
        .agg(F.collect_set(F.struct("entity", "term", "share")).alias(found))
    )

    def own_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                key: list[int | None] = [None] * part.num_rows
                rows = _suspects(part, text_col)
                for row, text in zip(rows.tolist(), _texts(part, text_col, rows), strict=True):
                    key[row] = _hash(text) if entities(text) else None
                yield part.append_column(own, pa.array(key, pa.int64()))

    # Only rows that have entities are shuffled.
    keyed = docs.mapInArrow(own_key, docs.withColumn(own, F.lit(None).cast("long")).schema)
    held = keyed.where(F.col(own).isNotNull()).join(by_text, own, "left").select(*docs.columns, found)
    bare = keyed.where(F.col(own).isNull()).select(*docs.columns)
    bare = bare.withColumn(found, F.lit(None).cast(by_text.schema[found].dataType))
    return held.unionByName(bare), _by_column


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans, sanitised`` of every row: spans are (kind, start, end, share) in code points.

    The share is null for entities. A null text counts as empty; null and repeated ids are kept.
    Terms are learnt from the same documents.
    """
    shares = disclosure(docs, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, of = _revealed(rows, shares, "text")
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found: list[list] = [[] for _ in range(part.num_rows)]
                texts = _texts(part, "text", np.arange(part.num_rows))
                for row in _suspects(part, "text").tolist():
                    text = texts[row]
                    base = entities(text)
                    if base:
                        terms = of(part, row).spans(text, base)
                        every = [(*s, None) for s in base] + terms
                        every.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                        found[row] = [dict(zip(("kind", "start", "end", "share"), s, strict=True)) for s in every]
                        texts[row] = sanitise(text, base, terms)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "spans": pa.array(found, kind),
                        "sanitised": pa.array(texts, pa.string()),
                    }
                )

    return rows.mapInArrow(
        run,
        "doc_id long, spans array<struct<kind:string,start:long,end:long,share:double>>,"
        " sanitised string",
    )


def sanitised(docs: DataFrame, *, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with sanitised texts, all columns; ``length_col`` gets the new length.

    A null text stays null.
    """
    rows, of = _revealed(docs, disclosure(docs, text_col=text_col), text_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                changed = set()
                for row in _suspects(part, text_col).tolist():
                    base = entities(texts[row])
                    if base:
                        terms = of(part, row).spans(texts[row], base)
                        texts[row] = sanitise(texts[row], base, terms)
                        changed.add(row)
                columns = {n: part.column(n) for n in names}
                columns[text_col] = pa.array(texts, pa.string())
                if length_col and changed:
                    lengths = columns[length_col].to_pylist()
                    for row in changed:
                        lengths[row] = len(texts[row])
                    columns[length_col] = pa.array(lengths, columns[length_col].type)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return rows.mapInArrow(run, docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts of entities, a digest of them, and all spans as text, from ``find``."""

    def listed(kinds: str) -> str:
        spans = f"filter(spans, s -> s.kind in ({kinds}))" if kinds else "spans"
        return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"

    base = ", ".join(f"'{k}'" for k in KINDS[:4])
    return found.select(
        "doc_id",
        *(
            F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}")
            for k in KINDS[:4]
        ),
        F.sha2(F.expr(listed(base)), 256).alias("base_sha256"),
        F.expr(listed("")).alias("spans"),
    )
