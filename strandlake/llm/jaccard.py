"""N-gram Jaccard join by grouped prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a threshold. The tokens of a
set stand in a global order, rare ones first, and two sets that link share a token of their prefixes. Documents with
the same prefix and size are one group, and a group stands once in the list of each of its prefix tokens.

Group pairs are filtered within the lists, before any member is looked at:

* by size, and by the positions of the shared token, after which only so many others can be shared;
* a list that has the same groups as the one before it is left out, and a pair whose groups share one of the three
  list tokens before this one is left to that token's list;
* by counts of the tokens in ranges of the hash space, which bound the overlap (groups of one set each);
* groups that earlier links already connect are passed over.

What is left is expanded: a group of one set is that set; for others the members meet in a list of their own, which
is filtered in the same way. The pairs of sets that remain are verified on the whole sets.

A list may hold a large share of all groups, so its pairs are never all made: if more are left than a few for each
row, only a cover of stars is (each row with one that many others may link with), at most one pair for each row. The
links found make components, and the list is read again for pairs between components, until nothing is left or no new
links come; only then all remaining pairs are made. Long lists are cut into blocks, and each pair of blocks is a
task's share. So all sets that links connect get one component; links within a component are not all looked for.

The result is exact but for collisions of 64-bit token hashes. The order is kept for at most ``most_ordered`` tokens
(the most frequent ones, counted where a task holds a token twice), which are broadcast; the others stand before them
by their hashes. Any order gives the same links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.components import connected_components
from strandlake.llm.runtime import Scratch, fresh, prepare, sliced
from strandlake.llm.textbytes import mix64, shingle_sets, utf8

LAST_ID = (1 << 63) - 1
_BLOCK = 1 << 21
#: Ranges of the coarse counts, and the most pairs of a list that are held at once.
COARSE, MOST_HELD = 128, 1 << 19
#: Sets that are compared with one in a task.
OTHERS = 256


def least_overlap(total: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The overlap that two sets of together ``total`` tokens need."""
    return -(-percent * total // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + (percent * n) // -100 + 1


def column_of_sets(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def name_of(*parts: bytes) -> bytes:
    made = hashlib.blake2b(digest_size=16)
    for p in parts:
        made.update(p)
    return made.digest()


def names_of(column: pa.ChunkedArray) -> np.ndarray:
    """16-byte names as rows of two numbers."""
    made = column.combine_chunks()
    _, offsets, data = made.buffers()
    at = int(np.frombuffer(offsets, np.int32)[made.offset])
    return np.frombuffer(data, np.uint8)[at : at + 16 * len(made)].view(np.uint64).reshape(-1, 2)


def coarse_counts(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of COARSE equal ranges, in 2, 4, 8 or 16 bits each, whichever is enough."""
    counts = np.minimum(np.bincount((tokens >> np.uint64(57)).astype(np.int64), minlength=COARSE), 65535)
    top = counts.max(initial=0)
    if top > 255:
        return counts.astype("<u2").tobytes()
    out = counts.astype(np.uint8)
    if top < 16:
        out = out[0::2] | out[1::2] << 4
    if top < 4:
        out = (out[0::2] & 3) | (out[0::2] >> 4) << 2 | (out[1::2] & 3) << 4 | (out[1::2] >> 4) << 6
    return out.tobytes()


def coarse_table(rows: list[bytes | None]) -> np.ndarray:
    """Counts as a row each. Unknown ones, and those that may not fit, are as large as can be."""
    out = np.full((len(rows), COARSE), 65535, np.uint16)
    sizes = np.array([len(r) if r is not None else 0 for r in rows])
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        raw = np.frombuffer(b"".join(rows[i] for i in at), "<u2" if size > COARSE else np.uint8).reshape(len(at), -1)
        each = COARSE // raw.shape[1]
        if each > 1:
            bits = 8 // each
            raw = np.stack([raw >> bits * k & (1 << bits) - 1 for k in range(each)], axis=2).reshape(len(at), -1)
        out[at] = raw
    return out


def token_order(docs: DataFrame, scratch: Scratch, words: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, in ascending order of their hashes, and the count of each. Tokens are counted where
    a block of a task's holds one twice: a lower bound, which is enough for an order. At most ``most`` are taken."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            some = n > 1
            return pa.RecordBatch.from_arrays([pa.array(token[some].view(np.int64)), pa.array(n[some])], ["token", "n"])

        size = 0
        for batch in batches:
            for tokens in shingle_sets(*utf8(batch.column(0)), words):
                held.append(tokens)
                size += len(tokens)
                if size >= _BLOCK:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    counted = docs.select("text").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = scratch.write(counted.filter(F.col("n") >= least), "counted")
    step = F.floor(F.log2("n")).cast("int")
    each = {r["step"]: r["count"] for r in counted.groupBy(step.alias("step")).count().collect()}
    low, total = 64, 0  # the lowest power of two from which the table still has room
    for k in sorted(each, reverse=True):
        total += each[k]
        if total > most:
            break
        low = k
    found = counted.filter(step >= low).select("token", "n").toArrow()
    scratch.drop("counted")
    token = found["token"].to_numpy().view(np.uint64)
    by = np.argsort(token)
    return token[by], found["n"].to_numpy()[by]


def signatures(docs: DataFrame, order: tuple[np.ndarray, np.ndarray], percent: int, words: int) -> DataFrame:
    """Per document the name and size of its set, its group (prefix and size), coarse counts, and the prefix with the
    number of its tokens that the order's table doesn't hold, given once for each group in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (last, count), met = shared.value, set()
        for batch in sliced(batches):
            names, sizes, groups, coarse, prefixes, rare = [], [], [], [], [], []
            for tokens in shingle_sets(*utf8(batch.column("text")), words):
                n = len(tokens)
                at = np.minimum(np.searchsorted(last, tokens), max(len(last) - 1, 0))
                late = last[at] == tokens if len(last) else np.zeros(n, bool)
                ordered = np.concatenate((tokens[~late], tokens[late][np.argsort(count[at[late]], kind="stable")])) if late.any() else tokens
                prefix = ordered[: prefix_length(n, percent)] if n else ordered
                group = name_of(prefix.tobytes(), n.to_bytes(8, "little"))
                names.append(name_of(tokens.tobytes()))
                sizes.append(n)
                groups.append(group)
                coarse.append(coarse_counts(tokens))
                prefixes.append(prefix if n and group not in met else prefix[:0])
                rare.append(min(len(prefix), n - int(late.sum())))
                if len(met) >= 1 << 20:
                    met.clear()
                met.add(group)
            made = [pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(groups, pa.binary()), pa.array(coarse, pa.binary()), pa.array(rare, pa.int32()), column_of_sets(prefixes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h1"), batch.column("h2"), *made], ["doc_id", "h1", "h2", "sid", "n", "gid", "coarse", "rare", "prefix"])

    return docs.mapInArrow(work, "doc_id long, h1 long, h2 long, sid binary, n int, gid binary, coarse binary, rare int, prefix array<long>")


def shared_rows(signed: DataFrame, most_held: int = 1 << 20) -> DataFrame:
    """(token, g, pos, same) of the prefix tokens that two groups or more have, g being a hash of the group's name and
    ``same`` one of all groups of the token, 0 where it isn't known. Tokens of the order's table are in several
    documents anyway and only lose their repeats; the others are shuffled by token."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.int64)
        token, g, pos = empty, empty, empty.astype(np.int32)
        loose = None  # a token with very many groups, whose rows are given out as they come
        for batch in chain(batches, [None]):
            if batch is not None:
                token, g, pos = (np.concatenate((x, batch.column(k).to_numpy())) for k, x in enumerate((token, g, pos)))
            if not len(token):
                continue
            fresh = np.append(True, (token[1:] != token[:-1]) | (g[1:] != g[:-1]))
            token, g, pos = token[fresh], g[fresh], pos[fresh]
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            size = np.diff(np.append(first, len(token)))
            end = len(token) if batch is None or size[-1] > most_held else int(first[-1])
            same = np.add.reduceat(mix64(g.view(np.uint64)), first).view(np.int64)
            given = (size > 1) | (token[first] == loose if loose is not None else False)
            if loose is not None:
                same[token[first] == loose] = 0
            loose = None if end < len(token) or batch is None else int(token[-1])
            if loose is not None:
                same[-1], given[-1] = 0, True
            some = np.repeat(given, size)
            some[end:] = False
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(token[some]), pa.array(g[some]), pa.array(pos[some]), pa.array(np.repeat(same, size)[some])], ["token", "g", "pos", "same"])
            token, g, pos = token[end:], g[end:], pos[end:]

    g = F.xxhash64("gid").alias("g")
    head = signed.select(F.posexplode(F.slice("prefix", F.lit(1), F.col("rare"))).alias("pos", "token"), g)
    tail = signed.select(F.posexplode(F.slice("prefix", F.col("rare") + 1, F.size("prefix"))).alias("pos", "token"), g, "rare")
    head = head.select("token", "g", "pos").repartition("token").sortWithinPartitions("token", "g")
    known = tail.select("token", "g", (F.col("pos") + F.col("rare")).alias("pos"), F.lit(0).cast("long").alias("same")).distinct()
    return head.mapInArrow(work, "token long, g long, pos int, same long").unionByName(known)


def bitmap_of(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which remainders modulo ``bits`` occur, packed; at most bits / 64 rows come to the driver."""
    bit = F.pmod(F.col(column), F.lit(bits))
    rows = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def star_cover(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the pairs (a, b) of n rows join each row that has a pair with one centre, rows of most pairs first."""
    ends, others, pair = np.concatenate((a, b)), np.concatenate((b, a)), np.tile(np.arange(len(a)), 2)
    by = np.argsort(ends, kind="stable")
    others, pair = others[by], pair[by]
    degree = np.bincount(ends, minlength=n)
    first = np.cumsum(degree) - degree
    covered, taken = np.zeros(n, bool), np.zeros(len(a), bool)
    for x in np.argsort(-degree, kind="stable").tolist():
        if not degree[x]:
            break
        if covered[x]:
            continue
        covered[x] = True
        at = slice(first[x], first[x] + degree[x])
        fresh = ~covered[others[at]]
        taken[pair[at][fresh]] = True
        covered[others[at]] = True
        if not fresh.any():  # its neighbours belong to other stars; one link to them is enough
            taken[pair[first[x]]] = True
    return taken


#: Columns of the rows of lists. ``node`` is a set, or a group of ``several``; ``side`` tells the two groups whose
#: members meet, -1 where all rows may pair; p1 to p3 are the list tokens before this one.
ROWS = ("key", "node", "several", "n", "pos", "p1", "p2", "p3", "side", "coarse")


def crossing(rows: DataFrame, blocks: DataFrame, percent: int, most_each: int | None) -> DataFrame:
    """(key, x, y, several, open): pairs of a list that the filters leave and that have different ``comp``. From a run
    with more than ``most_each`` for each row only a star cover comes, and ``open`` is true. A pair may come
    repeatedly. ``blocks`` has (key, blocks) of the long lists."""
    cut = rows.join(blocks, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), *ROWS[1:], "comp")
    dealt = cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")

    def pairs_of(table: pa.Table, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of the pairs left of each run of equal keys, and whether more were; some pairs at a time."""
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        size = np.diff(np.append(first, len(key)))
        if not (size > 1).any():
            return
        n, pos = (table[c].to_numpy().astype(np.int64) for c in ("n", "pos"))
        second, two, side = table["second"].to_numpy().astype(bool), key[:, 1] != key[:, 2], table["side"].to_numpy()
        comp = names_of(table["comp"])
        before = np.stack([table[c].to_numpy() for c in ("p1", "p2", "p3")], axis=1)
        coarse = table["coarse"].combine_chunks()
        for m in np.unique(size[size > 1]).tolist():
            x, y = np.triu_indices(m, 1)
            runs = first[size == m]
            each = max(1, MOST_HELD // len(x))
            for k in range(0, len(runs), each):
                at = runs[k : k + each, None]
                a, b = (at + x).ravel(), (at + y).ravel()
                run = np.repeat(np.arange(len(at)), len(x))
                need = least_overlap(n[a] + n[b], percent)
                keep = np.minimum(n[a] - pos[a], n[b] - pos[b]) >= need
                keep &= (comp[a] != comp[b]).any(axis=1) & (~two[a] | (second[a] != second[b])) & ((side[a] != side[b]) | (side[a] < 0))
                a, b, run, need = a[keep], b[keep], run[keep], need[keep]
                met = np.zeros(len(a), bool)
                for p in range(3):
                    for q in range(3):
                        met |= (before[a, p] == before[b, q]) & (before[a, p] != 0)
                a, b, run, need = a[~met], b[~met], run[~met], need[~met]
                some, index = np.unique(np.concatenate((a, b)), return_inverse=True)
                counts = coarse_table(coarse.take(pa.array(some)).to_pylist())
                u, v = index[: len(a)], index[len(a) :]
                wide = (counts == 65535).any(axis=1)
                left = wide[u] | wide[v]
                for s in range(0, len(a), 16384):
                    most = np.minimum(counts[u[s : s + 16384]], counts[v[s : s + 16384]]).sum(axis=1, dtype=np.int64)
                    left[s : s + 16384] |= most >= need[s : s + 16384]
                a, b, run = a[left], b[left], run[left]
                over = np.bincount(run, minlength=len(at)) > (most_each * m if most_each is not None else np.inf)
                taken = ~over[run]
                for r in np.flatnonzero(over):
                    here = np.flatnonzero(run == r)
                    taken[here] = star_cover(a[here] - at[r], b[here] - at[r], m)
                yield a[taken], b[taken], over[run[taken]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last key, which may go on in the next batch
        for batch in chain(batches, [None]):
            table = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            table = table.combine_chunks()
            key = np.stack([table[c].to_numpy() for c in ("key", "i", "j")], axis=1)
            done = len(key) if batch is None else int(np.flatnonzero((key != key[-1]).any(axis=1)).max(initial=-1)) + 1
            held = table.slice(done)
            if done:
                whole = table.slice(0, done).combine_chunks()
                node, many = whole["node"].combine_chunks(), whole["several"].to_numpy().astype(bool)
                for a, b, over in pairs_of(whole, key[:done]):
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(key[a, 0]), node.take(pa.array(a)), node.take(pa.array(b)), pa.array(many[a] | many[b]), pa.array(over)], ["key", "x", "y", "several", "open"])

    return dealt.mapInArrow(work, "key long, x binary, y binary, several boolean, open boolean")


class Join:
    """The steps of one join; tables between them are written to the shared folder."""

    def __init__(self, docs: DataFrame, percent: int, words: int, least: int, most_ordered: int, block: int, most_bits: int, pairs_each: int):
        self.spark, self.percent, self.words, self.block, self.most_bits, self.pairs_each = docs.sparkSession, percent, words, block, most_bits, pairs_each
        prepare(self.spark)
        self.scratch = Scratch(self.spark, "jaccard")
        self.docs = docs
        order = token_order(docs, self.scratch, words, least, most_ordered)
        made = signatures(docs, order, percent, words)
        signed = self.scratch.write(made.drop("prefix"), "signed")
        some = signed.filter(F.col("n") > 0)
        self.classes = self.scratch.write(some.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("gid").alias("gid"), F.first("n").alias("n"), F.first("coarse").alias("coarse")), "classes")
        # prefixes hold most of a signature's bytes, so they are made again where they are needed and not written
        self.rows = self.lists(made)
        self.signed = self.scratch.write(signed.select("doc_id", "h1", "h2", "sid", "n"), "names")
        self.scratch.drop("signed")

    def lists(self, signed: DataFrame) -> DataFrame:
        """The rows of all lists of groups, and those of groups of several sets, whose members make a list each."""
        groups = self.classes.groupBy("gid").agg(F.count("*").alias("members"), F.first("n").alias("n"), F.min("sid").alias("sid"), F.first("coarse").alias("coarse"))
        groups = self.scratch.write(groups, "groups")
        several = F.col("members") > 1
        self.several = self.scratch.write(groups.filter(several).select("gid"), "several")
        self.any_several = not self.several.isEmpty()
        shared = self.scratch.write(shared_rows(signed.filter(F.size("prefix") > 0)), "shared")
        along = Window.partitionBy("g").orderBy("pos")
        earlier = [F.coalesce(F.lag("key", k).over(along), F.lit(0)).alias(f"p{k}") for k in (1, 2, 3)]
        met = shared.withColumnRenamed("token", "key").select("key", "g", "pos", "same", F.lag("same").over(along).alias("last"), *earlier)
        # a list with the same groups as the one before it of a member has no pair that the other hasn't
        met = met.filter((F.col("same") == 0) | F.col("last").isNull() | (F.col("same") != F.col("last"))).join(groups.withColumn("g", F.xxhash64("gid")), "g")
        met = met.select("key", F.when(several, F.col("gid")).otherwise(F.col("sid")).alias("node"), several.alias("several"), "n", "pos", "p1", "p2", "p3", F.lit(-1).alias("side"), F.when(~several, F.col("coarse")).alias("coarse"))
        if self.any_several:
            met = met.unionByName(self.members(self.several.select(F.xxhash64("gid").alias("key"), F.col("gid").alias("node"), F.lit(-1).alias("side"))))
        rows = self.scratch.write(met, "rows0")
        for made in ("shared", "groups"):
            self.scratch.drop(made)
        return rows

    def members(self, ends: DataFrame) -> DataFrame:
        """Rows of the sets that the nodes of (key, node, side) stand for."""
        of = self.classes.join(self.several, "gid", "left_semi").select(F.col("gid").alias("node"), F.col("sid").alias("member"))
        each = ends.join(of, "node", "left").select("key", F.coalesce("member", "node").alias("sid"), "side")
        each = each.join(self.classes.select("sid", "n", "coarse"), "sid")
        zero = [F.lit(0).cast("long").alias(p) for p in ("p1", "p2", "p3")]
        return each.select("key", F.col("sid").alias("node"), F.lit(False).alias("several"), "n", F.lit(0).alias("pos"), *zero, "side", "coarse")

    def expanded(self, pairs: DataFrame) -> DataFrame:
        """Rows of a list for each pair (x, y) of groups, at least one of which has several sets."""
        key = F.xxhash64("x", "y").alias("key")
        ends = pairs.select(key, F.col("x").alias("node"), F.lit(0).alias("side")).unionByName(pairs.select(key, F.col("y").alias("node"), F.lit(1).alias("side")))
        return self.members(ends)

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """(rep, text) of the documents that stand for the wanted sets (sid, rep), and a few others. Documents are told
        by a bitmap of rep, which has 32 bits or so for each and ``most_bits`` at most; beyond what that can tell they
        are joined. A task gives repeated rows once."""
        n = wanted.count()
        bits = min(max(1 << 16, 1 << math.ceil(math.log2(32 * n + 1))), self.most_bits)
        docs = self.docs.select(F.col("doc_id").alias("rep"), "text")
        if bits < 8 * n:
            return docs.join(wanted.select("rep").distinct(), "rep", "left_semi")
        shared = self.spark.sparkContext.broadcast(bitmap_of(wanted, "rep", bits))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given: set[tuple[int, int]] = set()
            for batch in sliced(batches):
                at = np.mod(batch.column("rep").to_numpy(), bits)
                hit = batch.filter(pa.array(((shared.value[at >> 6] >> (at & 63)) & 1).astype(bool)))
                keys = [(i, hash(t)) for i, t in zip(hit.column("rep").to_pylist(), hit.column("text").to_pylist(), strict=True)]
                fresh = []
                for key in keys:
                    fresh.append(key not in given)
                    if len(given) >= MOST_HELD:
                        given.clear()
                    given.add(key)
                yield hit.filter(pa.array(fresh, pa.bool_()))

        return docs.mapInArrow(work, "rep long, text string")

    def dealt(self, pairs: DataFrame) -> DataFrame:
        """(sid, rep, centre, share, role): each pair's set of more pairs is its centre (role 0), which the other one
        (role 1) comes to. The others of a centre are dealt to shares of ``OTHERS`` or so."""
        degree = pairs.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("degree"))
        for end in ("a", "b"):
            pairs = pairs.join(degree.withColumnsRenamed({"sid": end, "degree": f"of_{end}"}), end)
        first = F.col("of_a") >= F.col("of_b")
        centre, other = F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a"))
        share = F.pmod(F.xxhash64(other), F.ceil(F.greatest("of_a", "of_b") / OTHERS)).alias("share")
        told = pairs.select(centre.alias("centre"), other.alias("other"), share)
        needs = told.select(F.col("other").alias("sid"), "centre", "share", F.lit(1).alias("role"))
        needs = needs.unionByName(told.select(F.col("centre").alias("sid"), "centre", "share", F.lit(0).alias("role")).distinct())
        return needs.join(self.classes.select("sid", "rep"), "sid")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that link, by their whole sets. One text moves for each pair, which is less than its set; a
        task holds one centre's set and lets the others pass."""
        percent = self.percent
        pairs = self.scratch.write(pairs, f"{name}_pairs")
        if pairs.isEmpty():
            return pairs
        needs = self.scratch.write(self.dealt(pairs), f"{name}_needs")
        texts = self.texts_of(needs.select("sid", "rep").distinct())
        words = self.words

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, None
            for batch in sliced(batches):
                a, b = [], []
                columns = (batch.column(c).to_pylist() for c in ("centre", "share", "role", "sid"))
                for centre, share, role, sid, tokens in zip(*columns, shingle_sets(*utf8(batch.column("text")), words), strict=True):
                    if name_of(tokens.tobytes()) != sid:  # another text of the same doc_id
                        continue
                    if role == 0:
                        at, held = (centre, share), tokens
                        continue
                    if at != (centre, share):
                        raise RuntimeError("a set came without its centre")
                    overlap = len(np.intersect1d(held, tokens, assume_unique=True))
                    if 100 * overlap >= percent * (len(held) + len(tokens) - overlap):
                        a.append(centre)
                        b.append(sid)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        rows = texts.join(needs, "rep").select("centre", "share", "role", "sid", "text")
        rows = rows.repartition("centre", "share").sortWithinPartitions("centre", "share", "role")
        out = self.scratch.write(rows.mapInArrow(work, "a binary, b binary"), name)
        for made in ("pairs", "needs"):
            self.scratch.drop(f"{name}_{made}")
        return out

    def merged(self, comp: DataFrame | None, links: DataFrame, k: int) -> DataFrame:
        """The components (sid, label) so far, joined by further links between them."""
        if comp is not None:
            for end in ("a", "b"):
                known = comp.withColumnsRenamed({"sid": end, "label": "l"})
                links = links.join(known, end, "left").withColumn(end, F.coalesce("l", end)).drop("l")
            links = links.select("a", "b")
        found = connected_components(links, self.scratch, f"stars{k}").select(F.col("node").alias("sid"), "label")
        if comp is not None:
            after = found.select(F.col("sid").alias("label"), F.col("label").alias("l"))
            moved = comp.join(after, "label", "left").select("sid", F.coalesce("l", "label").alias("label"))
            found = moved.unionByName(found.join(comp, "sid", "left_anti"))
        return self.scratch.write(found, f"labels{k}")

    def labels(self) -> DataFrame:
        """(sid, label): the component of every set that has a link."""
        rows, comp, k, all_left = self.rows, None, 0, False
        while True:
            placed = rows.withColumn("comp", F.col("node"))
            if comp is not None:
                placed = rows.join(comp.withColumnsRenamed({"sid": "node", "label": "comp"}), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            each = F.ceil(F.count("*") / self.block).cast("int")
            blocks = self.scratch.write(rows.groupBy("key").agg(each.alias("blocks")).filter("blocks > 1"), f"blocks{k}")
            found = crossing(placed, blocks, self.percent, None if all_left else self.pairs_each * (16 if k else 1))
            found = self.scratch.write(found, f"found{k}")
            ends = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
            new = self.verified(found.filter(~F.col("several")).select(*ends).distinct(), f"links{k}")
            linked = not new.isEmpty()
            if linked or comp is None:
                comp = self.merged(comp, new, k)
            again = rows.join(found.filter("open").select("key").distinct(), "key", "left_semi")
            if self.any_several and not found.filter("several").isEmpty():
                groups = found.filter("several").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
                again = again.unionByName(self.expanded(groups))
            following = self.scratch.write(again, f"rows{k + 1}")
            for made in (f"rows{k}", f"blocks{k}", f"found{k}"):
                self.scratch.drop(made)
            if following.isEmpty():
                return comp
            all_left = not linked or k >= 4
            rows, k = following, k + 1

    def result(self) -> DataFrame:
        """doc_id, h1, h2 (of the text), n, sid, component (a set's name) and component_id of every document."""
        placed = self.classes.select("sid", "rep").join(self.labels(), "sid", "left").withColumn("component", F.coalesce("label", "sid")).drop("label")
        placed = self.scratch.write(placed, "components")
        # written first, so Spark may split a component or a set that a large share of all documents has
        least = self.scratch.write(placed.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
        ids = self.scratch.write(placed.join(least, "component").select("sid", "component", "component_id"), "ids")
        each = self.signed.join(ids, "sid", "left")
        return each.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def based(id_col: str, text_col: str) -> list[Column]:
    text = F.col(text_col)
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")]


def joined(docs: DataFrame, percent: int, words: int, least: int, most_ordered: int, block: int, most_bits: int, pairs_each: int, id_col: str, text_col: str) -> DataFrame:
    return Join(docs.select(*based(id_col, text_col)), percent, words, least, most_ordered, block, most_bits, pairs_each).result()


def join(
    docs: DataFrame,
    percent: int = 80,
    words: int = 5,
    least: int = 8,
    most_ordered: int = 1 << 18,
    block: int = 512,
    pairs_each: int = 1,
    most_bits: int = 1 << 27,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included).

    A null or empty text, or one without words, has an empty set and links with nothing. Repeated rows are links of
    similarity 1. Rows without doc_id come last: their component has no id unless another member has one. Long texts
    are read whole. No rows give none; other columns play no part.

    ``least`` and ``most_ordered`` bound the table of frequent tokens, ``block`` the rows of a list that one task
    compares with as many others, ``pairs_each`` the pairs that a list gives for each row before stars are taken
    (sixteen times as many when it is read again), ``most_bits`` the bitmap that tells the documents to be verified.
    """
    found = joined(docs, percent, words, least, most_ordered, block, most_bits, pairs_each, id_col, text_col)
    shown = [F.when(F.col(c) != LAST_ID, F.col(c)).alias(c) for c in ("doc_id", "component_id")]
    return found.select(shown[0], F.col("n").cast("long").alias("n_shingles"), shown[1])


def keep_first(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest doc_id, of several with that
    id the one whose text has the least hash.

    Rows whose text has no words link with nothing and all stay. A row is told by its doc_id and text, so a doc_id
    with two texts may lose one and keep the other; of repeated rows one stays. Rows without doc_id come after all
    others of their component. No rows give none.
    """
    found = joined(docs, percent, 5, 8, 1 << 18, 512, 1 << 27, 1, id_col, text_col)
    scratch = Scratch(docs.sparkSession, "keep_first")
    each = found.filter(F.col("n") > 0).groupBy("component", "doc_id", "h1", "h2").agg(F.count("*").alias("times"))
    each = scratch.write(each, "rows")
    winner = scratch.write(each.groupBy("component").agg(F.min(F.struct("doc_id", "h1", "h2")).alias("w")), "winner")
    judged = each.join(winner, "component").withColumn("wins", F.struct("doc_id", "h1", "h2") == F.col("w"))
    marked = scratch.write(judged.filter(~F.col("wins") | (F.col("times") > 1)).select("doc_id", "h1", "h2", "wins"), "marked")
    names = [fresh(c, docs.columns) for c in ("own_id", "print1", "print2")]
    key, _, *prints = based(id_col, text_col)
    left = docs.withColumns(dict(zip(names, [key, *prints], strict=True)))
    marks = marked.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "h1", "h2"), names, strict=True)], F.col("wins").alias("wins"))
    out = left.join(marks.drop("wins"), names, "left_anti").drop(*names)
    if marked.filter("wins").isEmpty():
        return out
    repeated = left.join(marks.filter("wins").drop("wins"), names, "left_semi")
    one = repeated.groupBy(*names).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return out.unionByName(one.select("row.*"))
