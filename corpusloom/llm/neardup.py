"""Near-duplicate records by T-occurrence search over inverted lists (DivideSkip).

Two token sets with Jaccard similarity t or more share at least ``T = ceil(t * n)`` of the n tokens of
either.  DivideSkip divides the lists of a record's tokens: the short ones are merged and the
candidates found there are probed in the long ones.  Here, spread over executors:

1. Records are tokenised into sets of 64-bit token hashes.  Records with equal sets form one class,
   so copies (even a third of all rows) cost one record; membership is kept beside.
2. A record's tokens are ordered by the length of their inverted lists, taken from a counting sketch (an array
   of at most ``2**24`` counts; collisions change the order, never the result).  Its L longest lists are its
   long ones, by DivideSkip's cost rule: L = T / (mu log2 M + 1), M being the length of its longest list, and
   at most T - 1.  A match occurs at least T - L times in the short lists.
3. The short lists are merged: a sort-merge join on the token brings the records of each list together, and
   occurrences are counted by pair.  Each posting carries the record's size, the token's position in
   its order and a parity signature of its set, of 128, 256 or 512 bits by the size; the join condition drops pairs
   that cannot reach T by size, by position, or because the signatures differ in more bits than the sets may differ
   in tokens.  Of two records, the one whose short lists end first in the common order has all its short tokens that
   the other holds among the other's short ones, so a pair needs T - L occurrences, L being that record's, and
   only its long lists are left to probe.  Lists of more than ``hot`` records are split: each record of one
   side meets a share of the other in each task.
4. The long lists are kept as sorted inverted lists, hashed by token (and in chunks by record, so that
   no list is unbounded), of the candidates' records only.  Each candidate probes the long lists of its
   record by binary search, and the occurrences found are added up.  Pairs that reach T are kept.

All these bounds are exact.
Tokens are hashed to 64 bits, and so are classes; results are exact up to such collisions (expected
in none of 10^9 pairs of sets).

Defined results: null texts and texts with fewer than ``min_words`` words are left out; texts of any
length are used whole; a key that comes again with the same text counts once; records of one key are
never paired with each other; equal texts of different keys pair up; an empty table gives an empty
result; extra columns are unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialise, materialise_bucketed

#: Words of 64 bits of a signature and the most tokens of a set that gets so many. With more tokens, the signatures of
#: unlike sets differ in fewer bits than like sets may differ in tokens.
_WIDTHS = ((2, 98), (4, 196), (8, None))
_SIGNATURE = _WIDTHS[-1][0]
_LOW = (1 << 40) - 1


class NearDuplicates(NamedTuple):
    """``members``: (scope, key, cls, copy), ``copy`` being the hash of the text as it stands (of several
    texts of a key in one class, one); ``links``: (cls_a, cls_b, shared, size_a, size_b) of different classes."""

    members: DataFrame
    links: DataFrame


def _sets(df: DataFrame, scope: Column, key: Column, text: Column, shingle: int, min_words: int) -> DataFrame:
    """(scope, key, cls, copy, tokens): the sorted token set of each row, hashed with its scope in the JVM."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    base = df.select(scope.alias("scope"), key.cast("string").alias("key"), F.xxhash64(text).alias("copy"), words.alias("w")).filter(F.col("key").isNotNull() & (F.size("w") >= max(min_words, shingle)))
    # Filters may be evaluated after this, so it must hold for short texts too.
    n = F.greatest(F.size("w") - (shingle - 1), F.lit(0))
    if shingle == 2:
        grams = F.zip_with(F.slice("w", F.lit(1), n), F.slice("w", F.lit(2), n), lambda a, b: F.xxhash64("scope", a, b))
    else:
        grams = F.transform(F.slice("w", F.lit(1), n), lambda w, i: F.xxhash64("scope", F.slice("w", i + 1, F.lit(shingle))))
    out = base.select("scope", "key", "copy", F.array_sort(F.array_distinct(grams)).alias("tokens"))
    return out.withColumn("cls", F.xxhash64("tokens"))


class Order:
    """The common order of tokens: by the length of their lists, then by hash.

    ``counts``: a sketch of ``2**bits`` counters of one byte (0: none, 1: one, then in eighths of a power of two).
    """

    def __init__(self, counts: np.ndarray, bits: int, t: float, mu: float, hot: int):
        self.counts, self.bits, self.t, self.mu, self.hot = counts, bits, t, mu, hot

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        return self.counts[tokens & ((1 << self.bits) - 1)]

    @staticmethod
    def length(level: np.ndarray) -> np.ndarray:
        """The most records that a list of this level has."""
        return np.ceil(2.0 ** (level.astype(np.int64) / 8)).astype(np.int64)

    def divide(self, lists: pa.ListArray) -> tuple[np.ndarray, ...]:
        """(row, tokens in order, their levels, position, sizes, long): the lists of each row, divided;
        ``long``: how many of the last are its long ones."""
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        level = self.levels(flat)
        order = np.lexsort((flat, level, row))
        ends = np.cumsum(sizes)
        pos = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
        level = level[order]
        longest = np.log2(self.length(level[np.maximum(ends - 1, 0)])) if len(flat) else np.zeros(len(sizes))
        need = np.ceil(self.t * sizes - 1e-9).astype(np.int64)
        long = np.minimum(need - 1, (need / (self.mu * longest + 1)).astype(np.int64))
        return row, flat[order], level, pos, sizes, np.maximum(long, 0)

    def chunks(self, level: np.ndarray, size: int) -> np.ndarray:
        """Into how many parts a list of this level is split."""
        return -(-self.length(level) // size)


def _sketch(classes: DataFrame, bits: int) -> np.ndarray:
    """The lengths of the inverted lists, in ``2**bits`` counters."""
    bucket = F.col("token").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    scale = F.least(F.lit(255), F.round(F.log2(F.count(F.lit(1))) * 8) + 1).cast("short")
    table = classes.select(F.explode("tokens").alias("token")).groupBy(bucket.alias("b")).agg(scale.alias("c")).toArrow()
    out = np.zeros(1 << bits, np.uint8)
    out[table.column("b").to_numpy()] = table.column("c").to_numpy()
    return out


def _signatures(row: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parities of the tokens that fall on each bit, as words by row. The first 2 words are the signature of 128
    bits; the next 2 and the next 4 are the upper halves of the wider ones, whose lower halves are the narrower one
    xor the upper half. What is wider than the set's own signature is 0."""
    width = 64 * _SIGNATURE
    bit = (flat.view(np.uint64) >> np.uint64(32)).astype(np.int64) % width
    parity = np.bincount(row * width + bit, minlength=len(sizes) * width).reshape(len(sizes), width) & 1
    out = np.packbits(parity.astype(np.uint8), axis=1).view(np.int64).reshape(len(sizes), _SIGNATURE)
    for (narrow, most), (wide, _) in reversed(list(zip(_WIDTHS, _WIDTHS[1:], strict=False))):
        out[:, :narrow] ^= out[:, narrow:wide]
        out[sizes <= most, narrow:wide] = 0
    return out


def _differ(n: Column, a: str, b: str) -> Column:
    """In how many bits the signatures of two sets differ, in the width of the smaller one, of ``n`` tokens."""
    x = [F.col(f"{a}_s{i}").bitwiseXOR(F.col(f"{b}_s{i}")) for i in range(_SIGNATURE)]
    words, out = x[: _WIDTHS[0][0]], None
    for k, (_, most) in enumerate(_WIDTHS):
        if k:
            upper = x[len(words) : 2 * len(words)]
            words = [w.bitwiseXOR(u) for w, u in zip(words, upper, strict=True)] + upper
        bits = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0]))
        if most is None:
            return bits if out is None else out.otherwise(bits)
        out = (F if out is None else out).when(n <= most, bits)


def _postings(classes: DataFrame, shared: Broadcast, side: str) -> DataFrame:
    """(token, salt, cls, at, end, s0..s7) for the short lists of each class; ``at`` packs the size of the set
    and the token's position, ``end`` the number of long lists and where the short ones end in the common order.
    Tokens that stand in one class only meet nothing and are left out.  ``side``: ``cold`` for lists up to the
    bound, ``one`` and ``each`` for the two sides of longer ones, of which the second meets every share of the first."""
    sig = [f"s{i}" for i in range(_SIGNATURE)]
    names = ["token", "salt", "cls", "at", "end", *sig]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                row, flat, level, pos, sizes, long = order.divide(batch.column("tokens"))
                if not len(flat):
                    continue
                words = _signatures(row, flat, sizes)
                last = np.cumsum(sizes) - long - 1
                end = (long << 40) | (level[last].astype(np.int64) << 32) | ((flat[last] >> 32) + (1 << 31))
                parts = order.chunks(level, order.hot)
                use = (pos < (sizes - long)[row]) & (level > 1) & ((parts == 1) == (side == "cold"))
                at = np.flatnonzero(use)
                cls = batch.column("cls").to_numpy()
                salt = cls[row[at]] % parts[at] if side == "one" else np.zeros(len(at), np.int64)
                if side == "each":
                    n = parts[at]
                    at = np.repeat(at, n)
                    salt = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                row, pos, token = row[at], pos[at], flat[at]
                cols = [pa.array(token), pa.array(salt.astype(np.int32)), pa.array(cls[row]), pa.array((sizes[row] << 32) | pos), pa.array(end[row]), *(pa.array(words[row, i]) for i in range(_SIGNATURE))]
                yield pa.RecordBatch.from_arrays(cols, names)

    return classes.select("cls", "tokens").mapInArrow(emit, "token long not null, salt int not null, " + ", ".join(f"{c} long not null" for c in names[2:]))


def _merge(a: DataFrame, b: DataFrame, on: list[str], t: float) -> DataFrame:
    """(cls_a, cls_b, c, rule, sizes): pairs with their occurrences in the short lists; ``rule`` packs how many they
    need and whether the short lists of a end first, ``sizes`` both sizes."""
    columns = ["cls", "at", "end", *(f"s{i}" for i in range(_SIGNATURE))]
    a = a.select(*on, *[F.col(c).alias(f"a_{c}") for c in columns])
    b = b.select(*on, *[F.col(c).alias(f"b_{c}") for c in columns])
    size = lambda x: F.shiftright(f"{x}_at", 32)
    pos = lambda x: F.col(f"{x}_at").bitwiseAND(F.lit((1 << 32) - 1))
    low = lambda x: F.col(f"{x}_end").bitwiseAND(F.lit(_LOW))
    na, nb = size("a"), size("b")
    need = F.ceil((na + nb) * (t / (1 + t)) - F.lit(1e-9))
    reach = F.least(pos("a"), pos("b")) + F.least(na - pos("a"), nb - pos("b"))
    # The order of a pair is by (size, class), so that each pair comes from one side only.
    ordered = (na < nb) | ((na == nb) & (F.col("a_cls") < F.col("b_cls")))
    can = ordered & (na >= nb * F.lit(t) - F.lit(1e-9)) & (reach >= need) & (_differ(na, "a", "b") <= na + nb - 2 * need)
    first = low("a") <= low("b")
    hits = need - F.when(first, F.shiftright("a_end", 40)).otherwise(F.shiftright("b_end", 40))
    both = a.join(b, on).filter(can).groupBy(F.col("a_cls").alias("cls_a"), F.col("b_cls").alias("cls_b"))
    # Lists of one pair may be merged in both parts, so the threshold comes after their sum.
    return both.agg(F.count(F.lit(1)).alias("c"), F.first(F.shiftleft(hits, 1) + first.cast("long")).alias("rule"), F.first(F.shiftleft(na, 32) + nb).alias("sizes"))


def _probe(candidates: DataFrame, classes: DataFrame, shared: Broadcast, t: float, chunk: int) -> DataFrame:
    """Probe the long lists of each candidate by binary search; keep those that reach T."""
    names = ["token", "part", "probe", "cls", "asks"]
    schema = "token long, part int, probe boolean, cls long, asks long"
    sided = candidates.select("*", F.when(F.col("first"), F.col("cls_a")).otherwise(F.col("cls_b")).alias("asks"), F.when(F.col("first"), F.col("cls_b")).otherwise(F.col("cls_a")).alias("in"))

    def rows(probe: bool):
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            order = shared.value
            for whole in batches:
                for first in range(0, whole.num_rows, 1000):
                    batch = whole.slice(first, 1000)
                    row, flat, level, pos, sizes, long = order.divide(batch.column("tokens"))
                    at = np.flatnonzero((level > 1) & ((pos >= (sizes - long)[row]) | (not probe)))
                    row = row[at]
                    cls, asks = (batch.column(c).to_numpy()[row] for c in ("in", "asks"))
                    part = cls % order.chunks(level[at], chunk)
                    yield pa.RecordBatch.from_arrays([pa.array(flat[at]), pa.array(part.astype(np.int32)), pa.array(np.full(len(at), probe)), pa.array(cls), pa.array(asks)], names)

        return emit

    # The lists hold the records that candidates may stand in; the tokens of the others are not needed.
    inside = sided.select(F.col("in").alias("cls")).distinct()
    lists = classes.join(inside, "cls", "left_semi").select(F.col("cls").alias("in"), F.lit(0).cast("long").alias("asks"), "tokens").mapInArrow(rows(False), schema)
    asked = sided.select("asks", "in").join(classes.withColumnRenamed("cls", "asks"), "asks").select("in", "asks", "tokens").mapInArrow(rows(True), schema)
    each = lists.unionByName(asked).repartition("token", "part").sortWithinPartitions("token", "part", "probe", "cls")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # what was read of the list that goes on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            token, part, probe, cls, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            if kept is not None and (token[0], part[0]) == kept[:2]:
                old = kept[2]
                token, part, probe, cls, asks = (np.concatenate([x, y]) for x, y in ((np.full(len(old), kept[0]), token), (np.full(len(old), kept[1], np.int32), part), (np.zeros(len(old), bool), probe), (old, cls), (np.zeros(len(old), np.int64), asks)))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
            start = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            # The list of a group stands before its probes.
            size = np.bincount(group, weights=~probe).astype(np.int64)
            q = np.flatnonzero(probe)
            low = start[group[q]]
            high = end = low + size[group[q]]
            for _ in range(int(size.max()).bit_length()):
                middle = (low + high) // 2
                right = (middle < high) & (cls[np.minimum(middle, len(cls) - 1)] < cls[q])
                low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
            hit = (low < end) & (cls[np.minimum(low, len(cls) - 1)] == cls[q])
            q = q[hit]
            kept = (token[-1], part[-1], cls[start[-1] : start[-1] + size[-1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array(asks[q]), pa.array(cls[q])], ["asks", "in"])

    found = each.mapInArrow(search, "asks long, in long").groupBy("asks", "in").agg(F.count(F.lit(1)).alias("more"))
    shared_ = (F.col("c") + F.coalesce("more", F.lit(0))).cast("int")
    total = sided.join(found, ["asks", "in"], "left").select("cls_a", "cls_b", shared_.alias("shared"), "size_a", "size_b")
    return total.filter(F.col("shared") + F.lit(1e-9) >= t * (F.col("size_a") + F.col("size_b") - F.col("shared")))


def find(df: DataFrame, scope: Column, key: Column, text: Column, t: float = 0.8, shingle: int = 5, min_words: int = 1, mu: float = 0.01, hot: int = 8192, chunk: int = 4096, sketch_bits: int | None = None) -> NearDuplicates:
    """Classes of equal token sets and the links between classes with similarity ``t`` or more.

    ``mu``: weight of DivideSkip's cost rule (the larger, the fewer long lists; as what the merge of a list costs
    here grows with the square of its length, it is small); ``hot``: records of a short list
    from which it is split; ``chunk``: records of a chunk of a long list; ``sketch_bits``: by the data where not given.
    """
    if not 0 < t <= 1:
        raise ValueError("t must be in (0, 1]")
    sets = _sets(df, scope, key, text, shingle, min_words)
    members = materialise(sets.groupBy("scope", "key", "cls").agg(F.min("copy").alias("copy")))
    # One record per class: equal sets are equal arrays, so any will do.  In buckets of the class,
    # so that the token sets are shuffled once only.
    classes = materialise_bucketed(sets.select("cls", "tokens").dropDuplicates(["cls"]), "cls")
    total = classes.agg(F.sum(F.size("tokens"))).first()[0] or 0
    bits = sketch_bits or min(24, max(16, int(total).bit_length() - 1))
    counts = _sketch(classes, bits)
    shared = df.sparkSession.sparkContext.broadcast(Order(counts, bits, t, mu, hot))
    cold = _postings(classes, shared, "cold")
    merged = _merge(cold, cold, ["token"], t)
    if Order.length(counts.max(keepdims=True))[0] > hot:
        split = _merge(_postings(classes, shared, "one"), _postings(classes, shared, "each"), ["token", "salt"], t)
        merged = merged.unionByName(split).groupBy("cls_a", "cls_b").agg(F.sum("c").alias("c"), F.first("rule").alias("rule"), F.first("sizes").alias("sizes"))
    unpacked = [((F.col("rule") % 2) == 1).alias("first"), F.shiftright("sizes", 32).cast("int").alias("size_a"), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("size_b")]
    candidates = materialise(merged.filter(F.col("c") >= F.shiftright("rule", 1)).select("cls_a", "cls_b", "c", *unpacked))
    links = materialise(_probe(candidates, classes, shared, t, chunk))
    return NearDuplicates(members, links)


def pairs(found: NearDuplicates, expand: int | None = None, chunk: int = 1000) -> DataFrame:
    """(scope, key_a, key_b), key_a < key_b, of all linked keys.

    Members of linked classes and of one class are paired out in full.  Where ``expand`` is given, of the
    keys of one text, equal byte for byte, only the ``expand`` smallest are; each further key of that text
    is linked to the smallest.  Texts that differ at all each keep their own keys.

    Classes of more than ``chunk`` keys are paired in chunks, so that no task gets all pairs of a class.
    """
    # Only members of classes with links or several members take part.
    several = found.members.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("cls")
    ends = found.links.select(F.explode(F.array("cls_a", "cls_b")).alias("cls"))
    m = use = materialise(found.members.join(ends.unionByName(several).distinct(), "cls", "left_semi"))
    star = None
    if expand is not None:
        big = m.groupBy("cls", "copy").agg(F.count(F.lit(1)).alias("k"), F.min("key").alias("first")).filter(F.col("k") > expand)
        # Ranks are needed of texts with many copies only.
        large = m.join(big.select("cls", "copy"), ["cls", "copy"], "left_semi")
        head = large.withColumn("r", F.row_number().over(Window.partitionBy("cls", "copy").orderBy("key"))).filter(F.col("r") <= expand).drop("r")
        use = m.join(big.select("cls", "copy"), ["cls", "copy"], "left_anti").unionByName(head)
        star = large.join(big, ["cls", "copy"]).filter("key <> first").select("scope", F.col("first").alias("ka"), F.col("key").alias("kb"))
    counts = use.groupBy("cls").agg(F.count(F.lit(1)).alias("k"))
    # Members of a class pair up within it through a link of the class with itself.
    links = found.links.select("cls_a", "cls_b").unionByName(counts.filter("k > 1").select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b")))
    # The keys of a class fall into chunks, of which each left key meets one a row.
    chunks = counts.filter(F.col("k") > chunk).select("cls", F.ceil(F.col("k") / chunk).cast("int").alias("n"))
    n = F.coalesce("n", F.lit(1))
    links = links.join(chunks.withColumnRenamed("cls", "cls_b"), "cls_b", "left").select("cls_a", "cls_b", n.alias("n"))
    left = use.select("scope", F.col("cls").alias("cls_a"), F.col("key").alias("ka"))
    right = use.join(chunks, "cls", "left").select(F.col("cls").alias("cls_b"), F.col("key").alias("kb"), F.pmod(F.xxhash64("key"), n).cast("int").alias("c"))
    each = links.join(left, "cls_a").select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("c"))
    # Within a class each pair comes once; a key may stand in both of two linked classes.
    between = each.join(right, ["cls_b", "c"]).filter("ka < kb or (ka > kb and cls_a <> cls_b)").select("scope", "ka", "kb")
    both = between if star is None else between.unionByName(star)
    return both.select("scope", F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).distinct()


def _names(found: NearDuplicates) -> DataFrame:
    """(cls, scope, class): each class by its smallest key."""
    return found.members.groupBy("cls").agg(F.first("scope").alias("scope"), F.min("key").alias("class"))


def classes(found: NearDuplicates) -> DataFrame:
    """(scope, key, class, n_links): one row per record with its class of equal sets, named by the
    smallest key, and the number of other classes that are near it."""
    ends = found.links.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    named = _names(found).drop("scope").join(ends, "cls", "left")
    return found.members.join(named, "cls").select("scope", "key", "class", F.coalesce("n_links", F.lit(0)).alias("n_links")).distinct()


def class_links(found: NearDuplicates) -> DataFrame:
    """(scope, class_a, class_b, shared): all pairs of classes that are near each other, by their names, a < b."""
    names = _names(found)
    a = names.select(F.col("cls").alias("cls_a"), "scope", F.col("class").alias("x"))
    b = names.select(F.col("cls").alias("cls_b"), F.col("class").alias("y"))
    both = found.links.join(a, "cls_a").join(b, "cls_b")
    return both.select("scope", F.least("x", "y").alias("class_a"), F.greatest("x", "y").alias("class_b"), "shared")


def least_shared(n: int, t: float) -> int:
    """T: how many of its n tokens a record must share with any record of similarity t."""
    return math.ceil(t * n - 1e-9)
