"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms around them.

The patterns find the protected entities. From the whole corpus, the co-occurrence of entities and terms in
documents estimates how much a term reveals: PMI(term, entity) over the entity's information content, which is 1 where
the term occurs with the entity only. Terms above a threshold are generalised, above a higher one removed, wherever
they occur. Terms are runs of letters and digits of two characters at least outside entities. A term must be seen
with the entity in documents of ``support`` different contexts (what stands around the entity there), so copies of
one passage, which share their context, aren't evidence.

Most values are too rare for that, so evidence is pooled, too: a value also counts for its group, which is the domain
of an address, the network of three parts, the issuer's eight digits of a card, or a phone number without its last four
digits. A group that more than ``common`` of all documents have protects nobody and is left out.

A rare term may meet a frequent entity by chance. If both were independent, the chance of at least as many common
documents is at most exp(-d D), d being the term's documents and D the divergence of the share of them that have the
entity from its share in the corpus. Times the number of entities and candidate terms this must be at most ``chance``.

Counting goes in three passes: entities and their contexts; all terms of the documents of entities that have enough
contexts, which give the candidate terms; then only those are counted in all documents. The second pass also says in how
many documents with any of the entities a term is. A term is in so many documents at least, so those that can't reach
a threshold even then aren't counted. What is broadcast are bitmaps of fixed size; joins then decide exactly. As only ``support`` contexts are asked for, a task gives out so many of each
entity and term, and how many documents have both; one entity in very many documents costs no more rows than terms.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch, prepare, sliced
from strandlake.llm.secrets import replaced
from strandlake.llm.textbytes import chunks, lower_ascii, mix64, span_hashes, utf8, word_spans

KINDS = ("email", "ip", "card", "phone", "term")
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
#: The patterns. Local parts of mail addresses are read backwards from the @, so no text takes
#: quadratic time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

BITS = 24
#: Stands for any entity.
ANY = 0
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
SHORTEST = 2


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value), in order."""
    out = []
    end = 0
    for m in _DOMAIN.finditer(text):
        s = m.start()
        while s > end and text[s - 1] in _LOCAL:
            s -= 1
        if s < m.start():
            end = m.end()
            out.append((s, 0, end, text[s:end].lower()))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            out.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), digits))
    for m in _PHONE.finditer(text):
        digits = "".join(c for c in m[0] if "0" <= c <= "9")
        if 10 <= len(digits) <= 15:
            out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def terms(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, hash) of the terms of some texts, in bytes: runs of letters and digits,
    A-Z lower-cased."""
    starts, ends, many = word_spans(raw, at, _GAP)
    row = np.repeat(np.arange(len(at) - 1), many)
    count = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    long = count[ends] - count[starts] >= SHORTEST
    starts, ends, row = starts[long], ends[long], row[long]
    return row, starts - at[row], ends - at[row], span_hashes(lower_ascii(raw), starts, ends)


def in_code_points(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte offsets of one text as code point offsets."""
    count = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return count[places]


def entity_name(kind: int, value: str, pooled: bool = False) -> int:
    """Hash of a value or, where ``pooled``, of a group of values, which is odd."""
    name = int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)
    return name | 1 if pooled else name & ~1


def group_of(kind: int, value: str) -> str:
    """What values are pooled by: domain, network, issuer, or the first digits of a phone number."""
    return (value.rpartition("@")[2], value.rpartition(".")[0], value[:8], value[:-4])[kind]


def outside(lo: np.ndarray, hi: np.ndarray, spans: list[tuple]) -> np.ndarray:
    """Which of the sorted, disjoint ranges touch no span (s, kind, e, value)."""
    free = np.ones(len(lo), bool)
    for s, _, e, _ in spans:
        free[np.searchsorted(hi, s, "right") : np.searchsorted(lo, e)] = False
    return free


def counted_once(rows: np.ndarray, support: int) -> np.ndarray:
    """Rows of entity, term, context and documents (one each a column), with equal ones summed and at most ``support``
    contexts of each entity and term; the first of these has all its documents."""
    order = np.lexsort(rows[2::-1])
    rows = rows[:, order]
    differ = rows[:, 1:] != rows[:, :-1]
    pair = np.concatenate(([True], differ[:2].any(0)))
    firsts = np.flatnonzero(np.concatenate(([True], differ[:3].any(0))))
    docs = np.add.reduceat(rows[3], np.flatnonzero(pair))
    rows, pair = rows[:, firsts], pair[firsts]
    begin = np.flatnonzero(pair)
    rows[3] = 0
    rows[3, begin] = docs
    rank = np.arange(len(firsts)) - begin[np.cumsum(pair) - 1]
    return rows[:, rank < support]


def entity_terms(docs: DataFrame, reach: int, support: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(entity, term, context, docs): all terms of the documents of wanted entities and groups of them, as many
    contexts as are asked for in each task. The context is a hash of the terms up to ``reach`` away from each place of
    the entity in the document. Each document has ANY, too. Without ``wanted``, all entities and the term 0 only."""
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def contexts_of(lo: np.ndarray, hi: np.ndarray, names: np.ndarray, spans: list[tuple[int, int, int]]) -> dict[int, int]:
        """The context of each entity of one document."""
        around: dict[int, set[int]] = {}
        for s, e, name in spans:
            a, b = int(np.searchsorted(hi, s, "right")), int(np.searchsorted(lo, e))
            near = np.concatenate((names[max(a - reach, 0) : a], names[b : b + reach]))
            around.setdefault(name, set()).add(int(np.bitwise_xor.reduce(mix64(near))) if len(near) else 0)
        joint = {name: np.bitwise_xor.reduce(mix64(np.array(sorted(x), np.uint64))) for name, x in around.items()}
        return {name: int(mix64(np.array([x], np.uint64)).view(np.int64)[0]) for name, x in joint.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[np.ndarray] = []  # of the whole task
        size = 0
        for batch in sliced(batches):
            texts = batch.column(0).to_pylist()
            raw, offsets = utf8(batch.column(0))
            for i, text in enumerate(texts):
                found = base_spans(text or "")
                each = [(s, e, n) for s, k, e, v in found for n in (entity_name(k, v), entity_name(k, group_of(k, v), True))]
                if shared is not None and each:
                    hit = hits(shared.value, np.array([n for *_, n in each], np.int64).view(np.uint64))
                    each = [x for x, h in zip(each, hit.tolist(), strict=True) if h]
                if not each:
                    continue
                own = raw[offsets[i] : offsets[i + 1]]
                _, lo, hi, names = terms(own, np.array([0, len(own)]))
                lo, hi = in_code_points(own, lo), in_code_points(own, hi)
                free = outside(lo, hi, found)
                lo, hi, names = lo[free], hi[free], names[free]
                present = np.zeros(1, np.int64) if shared is None else np.unique(names).view(np.int64)
                every = contexts_of(lo, hi, names, each)
                if shared is not None:
                    every[ANY] = 0
                for name, context in every.items():
                    row = np.ones((4, len(present)), np.int64)
                    row[0], row[1], row[2] = name, present, context
                    met.append(row)
                    size += len(present)
                    if size > 1_000_000:
                        met = [counted_once(np.concatenate(met, 1), support)]
                        size = met[0].shape[1]
                        if size > 500_000:
                            yield rows(met.pop())
                            size = 0
        if size:
            yield rows(counted_once(np.concatenate(met, 1), support))

    def rows(made: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in made], ["entity", "term", "context", "docs"])

    return docs.select("text").mapInArrow(work, "entity long, term long, context long, docs long")


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Which upper bits of the hashes occur; at most 2 ** BITS / 64 rows come to the driver."""
    bit = F.shiftrightunsigned(column, 64 - BITS)
    found = rows.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def hits(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = (names >> np.uint64(64 - BITS)).astype(np.int64)
    return ((bits[at >> 6] >> (at & 63)) & 1).astype(bool)


def term_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term, docs): in how many documents each wanted term is."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def merged(met: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        name, at = np.unique(np.concatenate([k for k, _ in met]), return_inverse=True)
        return name, np.bincount(at, np.concatenate([n for _, n in met]), len(name)).astype(np.int64)

    def rows(name: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n)], ["term", "docs"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[tuple[np.ndarray, np.ndarray]] = []  # of the whole task
        for batch in sliced(batches):
            raw, offsets = utf8(batch.column(0))
            for i, j in chunks(offsets):
                row, _, _, names = terms(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                hit = hits(shared.value, names)
                row, names = row[hit], names[hit]
                _, first = np.unique(mix64(names + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                met.append(np.unique(names[first], return_counts=True))
            if sum(len(k) for k, _ in met) > 1_000_000:
                met = [merged(met)]
                if len(met[0][0]) > 500_000:
                    yield rows(*met.pop())
        if met:
            yield rows(*merged(met))

    return docs.select("text").mapInArrow(work, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


def disclosing_terms(
    docs: DataFrame, scratch: Scratch, reach: int = 8, support: int = 3, generalise: float = 0.9, remove: float = 0.97, common: float = 0.01, chance: float = 0.01
) -> DataFrame:
    """(term, gone): terms whose disclosure reaches ``generalise``; gone where it reaches ``remove``."""

    def pairs(found: DataFrame) -> DataFrame:
        """Of each entity and term, the documents that have both, where these have enough contexts."""
        each = found.groupBy("entity", "term", "context").agg(F.sum("docs").alias("docs"))
        both = each.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("docs").alias("docs"))
        return both.filter((F.col("contexts") >= support) | (F.col("entity") == ANY))

    total = float(max(docs.count(), 1))
    # no term can have more contexts than its entity
    frequent = pairs(entity_terms(docs, reach, support)).select("entity", F.col("docs").alias("entity_docs"))
    value = F.col("entity").bitwiseAND(1) == 0
    entities = scratch.write(frequent.filter(value | (F.col("entity_docs") <= common * total)), "entities")
    # a bitmap may let others pass
    wanted = entities.select("entity").union(docs.sparkSession.range(1).select(F.lit(ANY).cast("long")))
    met = scratch.write(pairs(entity_terms(docs, reach, support, bitmap(entities, "entity")).join(wanted, "entity", "left_semi")), "pairs")
    both = met.filter(F.col("entity") != ANY)
    tests = float(max(entities.count() * both.select("term").distinct().count(), 1))

    def disclosing(rows: DataFrame, term_docs: str) -> DataFrame:
        """Rows that reach ``generalise`` and are no chance, with their share. Neither can begin to hold as a term is
        in more documents."""
        joint = F.least("docs", "entity_docs", term_docs)
        content = F.log(total / F.col("entity_docs"))
        share = F.when(content > 0, F.log(joint * total / (F.col(term_docs) * F.col("entity_docs"))) / content)
        inside, usual = joint / F.col(term_docs), F.col("entity_docs") / total
        apart = F.when(inside < 1, (1 - inside) * F.log((1 - inside) / (1 - usual))).otherwise(F.lit(0.0))
        unlikely = F.col(term_docs) * (inside * F.log(inside / usual) + apart) >= math.log(tests / chance)
        return rows.withColumn("share", share).filter(unlikely & (F.col("share") >= generalise))

    least = met.filter(F.col("entity") == ANY).select("term", F.col("docs").alias("least_docs"))
    candidates = scratch.write(disclosing(both.join(entities, "entity").join(least, "term"), "least_docs").drop("share"), "candidates")
    counted = scratch.write(term_counts(docs, bitmap(candidates, "term")), "counted")
    scored = disclosing(candidates.join(counted.withColumnRenamed("docs", "term_docs"), "term"), "term_docs").groupBy("term").agg(F.max("share").alias("share"))
    return scratch.write(scored.select("term", (F.col("share") >= remove).alias("gone")), "disclosing")


SPANS = "array<struct<s:int,o:int,kind:string,e:int,mark:string>>"


def find_spans(docs: DataFrame, keep_text: bool = False, id_col: str = "doc_id", text_col: str = "text", **limits: float) -> DataFrame:
    """One row per row: doc_id, spans (array of s, o, kind, e, mark, in code points, end exclusive) and, if asked for,
    the text. A null text has none; repeated rows give repeated rows, no rows none."""
    prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "pii")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    disclosing = disclosing_terms(base, scratch, **limits)
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(disclosing, "term"))
    span, hit = "array<struct<s:int,o:int,e:int>>", "array<struct<s:int,e:int,term:long>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            raw, offsets = utf8(batch.column(1))
            spans = [base_spans(t or "") for t in texts]
            found: list[list[dict]] = [[] for _ in texts]
            for i, j in chunks(offsets):
                row, lo, hi, names = terms(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                some = np.flatnonzero(hits(wanted.value, names))
                for r in np.unique(row[some]).tolist():
                    own = raw[offsets[i + r] : offsets[i + r + 1]]
                    mine = some[row[some] == r]
                    begin, end = in_code_points(own, lo[mine]), in_code_points(own, hi[mine])
                    free = outside(begin, end, spans[i + r])
                    each = zip(begin[free].tolist(), end[free].tolist(), names[mine][free].view(np.int64).tolist(), strict=True)
                    found[i + r] = [{"s": s, "e": e, "term": t} for s, e, t in each]
            key = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() if f else None for t, f in zip(texts, found, strict=True)]
            spans_type = pa.list_(pa.struct([("s", pa.int32()), ("o", pa.int32()), ("e", pa.int32())]))
            hits_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("term", pa.int64())]))
            columns = [batch.column(0), pa.array([[{"s": s, "o": o, "e": e} for s, o, e, _ in x] for x in spans], spans_type), pa.array(found, hits_type), pa.array(key, pa.binary()), batch.column(1) if keep_text else pa.nulls(len(texts), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "hits", "key", "text"])

    marked = scratch.write(base.mapInArrow(work, f"doc_id long, base {span}, hits {hit}, key binary, text string"), "marked")
    each = marked.filter(F.col("key").isNotNull()).select("key", "hits").dropDuplicates(["key"]).select("key", F.explode("hits").alias("h"))
    marks = F.when(F.col("gone"), F.lit("")).otherwise(F.lit("[TERM]"))
    sure = each.join(disclosing, F.col("h.term") == F.col("term")).groupBy("key").agg(F.collect_list(F.struct(F.col("h.s").alias("s"), F.lit(4).alias("o"), F.lit(KINDS[4]).alias("kind"), F.col("h.e").alias("e"), marks.alias("mark"))).alias("sure"))
    kinds, base_marks = F.array(*map(F.lit, KINDS)), F.array(*map(F.lit, MARKS))
    known = F.transform("base", lambda c: F.struct(c["s"].alias("s"), c["o"].alias("o"), F.element_at(kinds, c["o"] + 1).alias("kind"), c["e"].alias("e"), F.element_at(base_marks, c["o"] + 1).alias("mark")))
    plain = marked.filter(F.col("key").isNull()).select("doc_id", "text", known.alias("spans"))
    mixed = marked.filter(F.col("key").isNotNull()).join(sure, "key", "left").select("doc_id", "text", F.array_sort(F.concat(known.cast(SPANS), F.coalesce(F.col("sure").cast(SPANS), F.array().cast(SPANS)))).alias("spans"))
    out = plain.unionByName(mixed)
    return out if keep_text else out.drop("text")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat(c["kind"], F.lit(":"), c["s"].cast("string"), F.lit(":"), c["e"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    def count(o: int) -> Column:
        return F.size(F.filter("spans", lambda c: c["o"] == o)).cast("long").alias(f"n_{KINDS[o]}")

    base = written(F.filter("spans", lambda c: c["o"] < 4))
    return found.select("doc_id", *map(count, range(4)), F.sha2(base, 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: float) -> DataFrame:
    """doc_id and the text with its entities and disclosing terms replaced by their marks, or taken out. A null text
    becomes empty; repeated rows give repeated rows, no rows none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    clean = F.when(F.size("spans") > 0, replaced(text, F.col("spans"), lambda c: c["mark"])).otherwise(text)
    return find_spans(docs, True, id_col, text_col, **limits).select("doc_id", clean.alias("text"))
