"""Personal data by fixed patterns, and information-theoretic sanitisation of what gives it away.

Entities are the values that the base patterns find (addresses, numbers). Over the whole corpus it is
estimated how strongly a term found near an entity reveals it: pointwise mutual information
log p(e,t) / (p(e) p(t)), as a share of the entity's own information -log p(e). Terms above the
disclosure threshold, seen with the entity in enough different contexts, are spans too, and are
removed, where base spans are generalised to their kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, discard, release, small_batches, stored, tidy

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EDGE = "\"'`.,;:!?()[]{}<>*#$%&|+-=/\\~^_"

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Found from each @ outwards, in time linear in the text: the local part is all of the run before the @ that is not yet used."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
            at = text.find("@", end)
        else:
            end = at + 1
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[list[Span]]:
    """Spans of email, ip, card and phone, each leftmost and without overlap within its kind."""
    found: list[list[Span]] = [emails(text) if "@" in text else [], [], [], []]
    if _DIGIT.search(text):
        found[1] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found[2].append(m.span())
        if "+" in text:
            found[3] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


def joined(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in own)


def stable_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def term_of(word: str) -> str:
    return word.strip(_EDGE).lower()


@dataclass(frozen=True)
class Disclosure:
    """window: words on either side of an entity; beyond: words beyond it on either side that are the context. min_contexts: different contexts (what stands beyond the window) of entity and
    term; copies count once. threshold: share of the entity's information that the term must reveal. min_chars: of a term."""

    window: int = 5
    beyond: int = 60
    min_contexts: int = 3
    threshold: float = 0.8
    min_chars: int = 3


#: Bits of the broadcast filter of candidate terms: 0.5 MB, whatever the corpus.
FILTER_BITS = 1 << 22
#: Terms that one broadcast holds; more are marked in several passes, each over all rows.
TERMS_A_PASS = 200_000


#: Multipliers of the hashes of a context. Copies agree in some of them, though each may miss an edited word.
_HASHES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def least_hashes(units: Iterable[str]) -> tuple[int, ...]:
    """The least of each of several hashes of the units."""
    h = np.array([stable_hash(u) for u in units], np.int64).view(np.uint64)
    if not len(h):
        return (0,) * len(_HASHES)
    h = h[:, None] * _HASHES
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return tuple(h.min(0).view(np.int64).tolist())


def surroundings(text: str, rules: Disclosure) -> Iterator[tuple[str, list[str], list[list[str]]]]:
    """(entity, terms within the window, terms beyond it before and after) of each base span. Words, of any length, that the entity has a part in are none."""
    found = base_spans(text)
    if not any(found):
        return
    places = [m.span() for m in WORD.finditer(text)]
    starts, ends = [a for a, _ in places], [b for _, b in places]
    terms = lambda i, j: [term_of(text[a:b]) for a, b in places[max(0, i) : max(0, j)]]
    n, far = rules.window, rules.window + rules.beyond
    for own in found:
        for a, b in own:
            i, j = bisect_right(ends, a), bisect_left(starts, b)
            yield text[a:b].lower(), sorted({*terms(i - n, i), *terms(j, j + n)}), [terms(i - far, i - n), terms(j + n, j + far)]


def _is_term(term: str, rules: Disclosure) -> bool:
    return len(term) >= rules.min_chars and not _DIGIT.search(term) and "@" not in term


def contexts(text: str, rules: Disclosure) -> Iterator[tuple]:
    """(entity, term, hashes of the context) for the terms around each base span. The context is the pairs of words beyond the
    window, so that terms that always stand together do not make it one; else the words there, else the other terms."""
    for entity, near, far in surroundings(text, rules):
        units = {f"{x} {y}" for side in far for x, y in pairwise(side)} or {x for side in far for x in side}
        common = least_hashes(units)
        for term in near:
            if _is_term(term, rules):
                yield stable_hash(entity), term, *(common if units else least_hashes(t for t in near if t != term))


def context_counts(seen: DataFrame) -> DataFrame:
    """entity, term, c0, c1, ... → entity, term, n_pair: the different contexts of each pair.

    By one hash after the other, contexts that agree in it become one, with the later hashes that most of them have. An edited copy
    of a passage that differs from the others in one hash meets them by the next.
    """
    names = [f"c{k}" for k in range(len(_HASHES))]
    seen = seen.groupBy("entity", "term", *names).agg(F.count("*").alias("n"))
    for k in range(len(names) - 1):
        most = F.max(F.struct("n", *names[k + 1 :])).alias("most")
        seen = seen.groupBy("entity", "term", names[k]).agg(F.sum("n").alias("n"), most).select("entity", "term", "n", *(f"most.{c}" for c in names[k + 1 :]))
    return seen.groupBy("entity", "term", names[-1]).agg(F.sum("n")).groupBy("entity", "term").agg(F.count("*").alias("n_pair"))


def disclosing_terms(docs: DataFrame, rules: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """term, share: the terms of the corpus that reveal an entity beyond the threshold. A stored table.

    Two passes over all texts. The first gathers the terms near entities and keeps those with enough
    different contexts (so copies of one text count once). The second counts in how many
    documents those terms occur away from entities; only words that pass a filter of fixed size are shuffled,
    and an exact join follows. p(e,t) is counted in contexts, p(t) in contexts with any entity and in
    documents that have it elsewhere only, p(e) by the most contexts that e has with any term.
    """
    texts = small_batches(docs).select(text_col)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [x for t in b.column(0) if t.is_valid for x in contexts(t.as_py(), rules)]
            cols = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=names)

    names = ["entity", "term", *(f"c{k}" for k in range(len(_HASHES)))]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * len(_HASHES)]
    every = stored(context_counts(texts.mapInArrow(near, ", ".join(f"{c} {'string' if c == 'term' else 'long'}" for c in names))), "contexts")
    pairs = every.where(F.col("n_pair") >= rules.min_contexts)
    bit = F.xxhash64("term").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int")
    got = pairs.select(bit.alias("bit")).distinct().limit(FILTER_BITS).toArrow().column("bit").to_numpy()
    if not len(got):  # nothing to count
        out = stored(pairs.select("term", F.lit(0.0).alias("share")), "terms")
        discard(every)
        return out
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    np.bitwise_or.at(table, got >> 3, (1 << (got & 7)).astype(np.uint8))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, rejected, sums, n_docs = shared.value, set(), Counter(), 0
        from xxhash import xxh64

        def terms(text: str) -> set[str]:
            """The candidates among the words; almost all words are rejected, by one difference of sets."""
            found = set()
            for word in set(text.encode("utf-8", "surrogatepass").split()) - rejected:  # bytes part at ASCII white space
                term = term_of(word.decode("utf-8", "surrogatepass"))
                bit = xxh64(term.encode("utf-8", "surrogatepass"), 42).intdigest() & (FILTER_BITS - 1)
                if bits[bit >> 3] >> (bit & 7) & 1:
                    found.add(term)
                else:
                    rejected.add(word)
            if len(rejected) > 300_000:
                rejected.clear()
            return found

        for b in batches:
            for text in b.column(0):
                n_docs += 1
                text = text.as_py() or ""
                if found := terms(text):
                    sums.update(found - {x for _, near, _ in surroundings(text, rules) for x in near if _is_term(x, rules)})
            if len(sums) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.int64())], names=["term", "n"])
                sums.clear()
        sums[None] = n_docs
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["term", "n"])

    counts = stored(texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")), "term-counts")
    n_docs = (counts.where(F.col("term").isNull()).head() or [None, 1])[1]
    seen = pairs.join(pairs.groupBy("entity").agg(F.max("n_pair").alias("n_entity")), "entity")
    beside = every.join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n_pair").alias("n_beside"))
    n_term = F.col("n_beside") + F.coalesce("n", F.lit(0))
    share = F.log(F.col("n_pair") * n_docs / (F.col("n_entity") * n_term)) / F.log(F.greatest(F.lit(n_docs), F.col("n_entity") + 1) / F.col("n_entity"))
    best = seen.join(beside, "term").join(counts, "term", "left").withColumn("share", share).groupBy("term").agg(F.max("share").alias("share"))
    out = stored(best.where(F.col("share") >= rules.threshold), "terms")
    discard(every, counts)
    return out


def find(docs: DataFrame, rules: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text", clean: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs → id, columns in carry, n_email, n_ip, n_card, n_phone, n_term, n_spans (all), base_sha256, spans and, if asked for, clean_text.

    One row per input row. Null and empty texts have no spans. Spans are in code points, end exclusive; kinds in the
    order of KINDS, then by start. clean_text has [KIND] for each base span (overlapping ones as one) and
    nothing for a disclosing term outside of them. Ids may be null or repeat; columns besides those named are not read.
    """
    spark = docs.sparkSession
    with tidy(spark):
        terms = disclosing_terms(docs, rules, text_col)
    n = terms.count()
    passes = max(1, -(-n // TERMS_A_PASS))
    part = F.pmod(F.xxhash64("term"), F.lit(passes))
    rows = docs.select(id_col, *carry, F.col(text_col), F.lit("").alias("terms"))
    for k in range(passes):
        got = terms.where(part == k).select("term").toArrow().column("term").to_pylist() if n else []
        rows = _marked(rows, spark.sparkContext.broadcast(frozenset(got)), rules) if got else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, marked in zip(*(c.to_pylist() for c in b.columns[-2:])):
                text = text or ""
                spans = base_spans(text)
                own = sorted(tuple(map(int, x.split(":"))) for x in marked.split(",")) if marked else []
                base = joined(spans)
                n = [*map(len, spans), len(own)]
                row = (*n, sum(n), hashlib.sha256(base.encode()).hexdigest(), joined([*spans, own]))
                out.append((*row, cleaned(text, [*spans, own])) if clean else row)
            cols = list(zip(*out)) or [()] * (9 if clean else 8)
            kinds = [pa.int64()] * 6 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *map(pa.array, cols, kinds)], names=names)
        release()

    names = [id_col, *carry, "n_email", "n_ip", "n_card", "n_phone", "n_term", "n_spans", "base_sha256", "spans", *["clean_text"] * clean]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-2])
    return rows.mapInArrow(run, f"{kept}, n_email long, n_ip long, n_card long, n_phone long, n_term long, n_spans long, base_sha256 string, spans string" + ", clean_text string" * clean)


def _marked(rows: DataFrame, shared, rules: Disclosure) -> DataFrame:
    """Adds the spans of the broadcast terms to the last column; the one before is the text."""

    def spans(text: str) -> Iterator[str]:
        terms = shared.value
        for m in WORD.finditer(text):
            if term_of(m[0]) in terms:
                core = m[0].strip(_EDGE)
                start = m.start() + m[0].index(core)
                yield f"{start}:{start + len(core)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [",".join(filter(None, [old, *spans(t or "")])) for t, old in zip(*(c.to_pylist() for c in b.columns[-2:]))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.string())], names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def cleaned(text: str, spans: list[list[Span]]) -> str:
    """Base spans generalised to their kind, disclosing terms removed; of overlapping spans the first kind names the union."""
    marks = sorted((a, b, k) for k, own in enumerate(spans) for a, b in own)
    if not marks:
        return text
    out, at, i = [], 0, 0
    while i < len(marks):
        a, b, k = marks[i]
        while i + 1 < len(marks) and marks[i + 1][0] < b:
            i += 1
            b, k = max(b, marks[i][1]), min(k, marks[i][2])
        out += [text[at:a], "" if KINDS[k] == "term" else f"[{KINDS[k].upper()}]"]
        at, i = b, i + 1
    return "".join([*out, text[at:]])
