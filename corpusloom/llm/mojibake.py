"""Texts that were decoded with the wrong character encoding, restored by dictionary.

1. The words of all documents that hold characters beyond ASCII are counted (a word is a longest run
   of ASCII letters and characters beyond ASCII, of any length).  Those that no encoding chain could have
   produced, as far as their characters tell, are the clean words of the corpus.
2. The garbled form of every distinct clean word is generated under every chain: the word's UTF-8 bytes
   read as a one-byte encoding, once or twice over, or its bytes in one one-byte encoding read as
   another.  Forms that stand nowhere in the corpus are dropped where they are made, by a bitmap of the hashes of
   its words (16 bits a word, at most ``2**28``).  A hash join of the corpus words with this table gives the
   verified originals.
3. Words that the table lacks (names, compounds, Japanese runs that stand nowhere undamaged) are put together
   from the garbled forms of the characters of clean words, under the chains that the join proves.
4. Documents are joined with the substitutions of their words and rewritten.  Swaps of
   one-byte encodings can turn a word into another real word.  Where several longer words prove the
   swap, it is undone on the words whose originals the corpus has, on words without ASCII letters, and, if
   the whole document can come from the swap, on all words.  Where fewer do, longer words
   count whose originals stand in more texts of the corpus than they do themselves; with them
   go such shorter words as stand next to them.

A replacement character (U+FFFD) means that characters of the original are lost.

Defined results: null, empty and blank texts and undamaged texts give no row; texts of any length are
read whole; exact copies each give a row; a damaged text in places is restored in these places only.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise

LOST = "�"
#: Encodings that UTF-8 bytes were read as, by their usual names.
READ_AS = ["cp1252", "latin-1", "cp437", "mac_roman", "cp1250", "cp1251", "cp1253", "cp1254", "cp850", "cp866", "koi8-r", "iso8859-2", "iso8859-5", "iso8859-7", "iso8859-15"]
#: Swaps of one-byte encodings: the bytes of the first read as the second.
SWAPS = [(a, b) for a in ("cp1251", "cp1250", "cp1253", "koi8-r", "iso8859-2", "iso8859-5", "iso8859-7") for b in ("cp1252", "latin-1")]
#: The pattern of words with characters beyond ASCII.
_ANY = r"A-Za-z\u0080-\uffff\x{10000}-\x{10ffff}"
#: Tried at starts of runs only and without backtracking, so that its time is linear in the text.
WORD = rf"(?<![{_ANY}])[A-Za-z]*+[{_ANY[6:]}][{_ANY}]*+"


@functools.lru_cache(maxsize=64)
def _reading(name: str) -> tuple[str, dict[int, int]]:
    """byte -> character and back; bytes that the encoding leaves open stand for themselves."""
    to = []
    for b in range(256):
        try:
            to.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            to.append(chr(b))
    back = {ord(c): b for b, c in enumerate(to)}
    if name == "cp1252":
        # Read with or without the C1 block, the byte is the same.
        back.update({b: b for b in range(128, 160)} | {ord(c): b for b, c in enumerate(to)})
    return "".join(to), back


def _bytes(word: str, name: str) -> bytes | None:
    """The bytes that read as ``name`` give ``word``, or None."""
    try:
        return codecs.charmap_encode(word, "strict", _reading(name)[1])[0]
    except UnicodeEncodeError:
        return None


def garble(word: str, name: str) -> str:
    """The UTF-8 bytes of ``word`` read as ``name``."""
    return codecs.charmap_decode(word.encode("utf-8"), "strict", _reading(name)[0])[0]


def undo(word: str, name: str) -> str | None:
    """The text whose UTF-8 bytes read as ``name`` give ``word``, or None."""
    raw = _bytes(word, name)
    try:
        got = word if raw is None else raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return got if got != word else None


def swap(word: str, true: str, wrong: str) -> str | None:
    """The bytes of ``word`` in ``true`` read as ``wrong``; None where there are none."""
    try:
        raw = word.encode(true)
    except UnicodeEncodeError:
        return None
    got = codecs.charmap_decode(raw, "strict", _reading(wrong)[0])[0]
    return got if got != word else None


def unswap(word: str, true: str, wrong: str) -> str | None:
    """Undo ``swap``; None where the word can't come from it."""
    raw = _bytes(word, wrong)
    try:
        return None if raw is None else raw.decode(true)
    except UnicodeDecodeError:
        return None


def forms(words: list[str]) -> Iterator[tuple[str, list[str | None]]]:
    """(chain, the garbled form of each of the clean ``words``), of all chains in their order."""
    # A line a word: all these encodings read the bytes of ASCII, line ends among them, as ASCII.
    lines = "\n".join(words)
    for a in READ_AS:
        once = garble(lines, a)
        yield a, once.split("\n")
        for b in READ_AS:
            yield f"{a}>{b}", garble(once, b).split("\n")
    for a, b in SWAPS:
        yield f"swap:{a}:{b}", [swap(w, a, b) for w in words]


def by_characters(word: str, chain: str, table: dict[str, str], lengths: list[int]) -> str | None:
    """``word`` put together from the garbled forms of single characters in ``table``, or None.

    UTF-8 is a prefix code and so are its readings: at each place at most one form fits.
    """
    if chain.rpartition(">")[2] == "cp1252":
        # As ``_reading``: with or without the C1 block, the byte is the same.
        to = _reading("cp1252")[0]
        word = "".join(to[ord(c)] if "\x80" <= c < "\xa0" else c for c in word)
    out, at = [], 0
    while at < len(word):
        for n in lengths:
            if (c := table.get(word[at : at + n])) is not None:
                out.append(c)
                at += n
                break
        else:
            return None
    return "".join(out)


def _suspect(word: str, alphabet: frozenset[str] | None) -> bool:
    """Could some chain have produced the word from text in ``alphabet`` (None: from any text)?"""
    once = {got for a in READ_AS if (got := undo(word, a)) is not None}
    if alphabet is None:
        return bool(once)
    twice = {got for w in once for a in READ_AS if (got := undo(w, a)) is not None}
    return any(all(c in alphabet for c in got) for got in once | twice)


def _letters(words: DataFrame) -> frozenset[str]:
    """The characters of the words and ASCII: bounded by Unicode."""
    rows = words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()
    return frozenset("".join(r.c for r in rows)) | frozenset(map(chr, range(128)))


def _word_counts(df: DataFrame, text: str) -> DataFrame:
    words = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)))
    return df.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def _bitmap(words: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """A bitmap of the hashes of the words: 16 bits each, ``2**28`` in all at most, so a bounded broadcast."""
    bits = min(28, max(16, (16 * n).bit_length()))
    at = F.xxhash64("word").bitwiseAND(F.lit((1 << bits) - 1))
    # The hash of a word is the same in numpy: 64 bits of XXH64 with seed 42 over its UTF-8 bytes.
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    got = words.select(F.shiftright(at, 6).alias("at"), one.alias("one")).groupBy("at").agg(F.bit_or("one").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return bits, out.view(np.uint8)


def substitutions(df: DataFrame, text: str, min_support: int = 3) -> DataFrame:
    """(word, original, chain, swap, sure): what each garbled word of the corpus stands for; ``sure``: of a
    swap, the original has letters and stands in more rows than the word."""
    # Few rows with much work each: spread over all cores whatever their size in bytes.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(_word_counts(df.filter(~F.contains(F.col(text), F.lit(LOST))), text)).repartition(parts, "word")

    def classify(known: frozenset[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flags = [_suspect(w, known) for w in batch.column("word").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n_docs"), pa.array(flags, pa.bool_())], ["word", "n_docs", "suspect"])

        return counts.mapInArrow(run, "word string, n_docs long, suspect boolean")

    # Words that could come from any text at all give way; from the characters of the others follows
    # which of them could come from text of this corpus.
    alphabet = _letters(classify(None).filter(~F.col("suspect")))
    words = materialise(classify(alphabet))
    clean = words.filter(~F.col("suspect"))

    bitmap = df.sparkSession.sparkContext.broadcast(_bitmap(words, words.count()))

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        bits, there = bitmap.value
        there, mask, digest = there.tobytes(), (1 << bits) - 1, xxhash.xxh64_intdigest
        for whole in batches:
            everything, n_docs = whole.column("word").to_pylist(), whole.column("n_docs").to_pylist()
            # Slices of a bounded number of characters, whatever the length of words.
            ends = np.cumsum([len(w) for w in everything]) // 20_000
            for at in np.unique(ends, return_index=True)[1].tolist():
                own = everything[at : at + int((ends == ends[at]).sum())]
                found: dict[tuple[str, int], str] = {}
                for chain, garbled in forms(own):
                    for i, g in enumerate(garbled):
                        if g is not None:
                            h = digest(g.encode("utf-8"), 42) & mask
                            # Of chains with equal forms the first counts.
                            if there[h >> 3] >> (h & 7) & 1 and g != own[i]:
                                found.setdefault((g, i), chain)
                if found:
                    i = [i for _, i in found]
                    yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in found], pa.string()), pa.array([own[k] for k in i], pa.string()), pa.array(list(found.values()), pa.string()), pa.array([n_docs[at + k] for k in i], pa.int64())], ["word", "original", "chain", "support"])

    table = clean.select("word", "n_docs").repartition(parts, "word").mapInArrow(generate, "word string, original string, chain string, support long")
    is_swap = F.col("chain").startswith("swap:")
    # Chains of UTF-8 can only hit suspect words, swaps only others.
    hit = table.drop("n_docs").join(words.select("word", "n_docs", "suspect"), "word").filter(F.col("suspect") != is_swap)
    # One original per word: that of the shortest chain, then the commonest.
    best = hit.groupBy("word").agg(F.max("n_docs").alias("n_docs"), F.min_by(F.struct("original", "chain", "support"), F.struct(F.length("chain"), -F.col("support"), F.col("original"))).alias("b"))
    swapped = F.col("b.chain").startswith("swap:")
    sure = swapped & F.col("b.original").rlike(r"\p{L}") & (F.col("b.support") > F.col("n_docs"))
    proved = materialise(best.select("word", "b.original", "b.chain", swapped.alias("swap"), sure.alias("sure")))
    # The chains that the dictionary proves: bounded by the catalog of chains.
    support = proved.filter(~F.col("swap")).groupBy("chain").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_support).orderBy(F.desc("n"), "chain").collect()
    chains = [r.chain for r in support]

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The garbled forms of the characters of clean words: bounded by Unicode and the catalog of chains.
        tables = []
        for chain in chains:
            own = {functools.reduce(garble, chain.split(">"), c): c for c in alphabet}
            tables.append((chain, own, sorted({len(g) for g in own})))
        for batch in batches:
            rows = []
            for w in batch.column("word").to_pylist():
                for chain, own, lengths in tables:
                    got = by_characters(w, chain, own, lengths)
                    if got is not None and got != w and not _suspect(got, alphabet):
                        rows.append((w, got, chain, False, False))
                        break
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["word", "original", "chain", "swap", "sure"])

    unknown = words.filter("suspect").select("word").join(proved.select("word"), "word", "left_anti").repartition(parts, "word")
    return proved.unionByName(unknown.mapInArrow(rest, "word string, original string, chain string, swap boolean, sure boolean"))


def restore(df: DataFrame, key: str, text: str, min_swaps: int = 3) -> DataFrame:
    """(key, restored, lost): each damaged row of ``df``; ``restored`` is null where ``lost``."""
    import regex

    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.col("_text").rlike(r"[^\x00-\x7f]"))
    rows = rows.withColumn("_row", F.xxhash64("_text"))
    lost = F.contains(F.col("_text"), F.lit(LOST))
    # Exact copies are restored once.
    texts = materialise(rows.filter(~lost).groupBy("_row", "_text").agg(F.lit(1).alias("one")).select("_row", "_text"))
    subs = materialise(substitutions(texts, "_text"))
    letters = _letters(subs.filter("swap").select(F.col("original").alias("word")))
    words = F.array_distinct(F.regexp_extract_all(F.col("_text"), F.lit(f"({WORD})"), F.lit(1)))
    pairs = texts.select("_row", F.explode(words).alias("word")).join(subs, "word")
    long_swap = F.col("swap") & (F.length("word") >= 4) & F.col("original").rlike(r"\p{L}")
    per_text = pairs.groupBy("_row").agg(
        F.collect_list(F.struct("word", "original", "chain", "swap", "sure")).alias("subs"), F.count(F.when(~F.col("swap"), 1)).alias("k"), F.count(F.when(long_swap, 1)).alias("s"), F.count(F.when(long_swap & F.col("sure"), 1)).alias("sure")
    )
    damaged = texts.join(per_text.filter((F.col("k") > 0) | (F.col("s") >= min_swaps) | (F.col("sure") > 0)), "_row")
    pattern = WORD.replace(r"\x{10000}-\x{10ffff}", "\U00010000-\U0010ffff")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern)
        for batch in batches:
            out = []
            for t, subs_, s in zip(batch.column("_text").to_pylist(), batch.column("subs").to_pylist(), batch.column("s").to_pylist(), strict=True):
                table = {x["word"]: x["original"] for x in subs_ if not x["swap"]}
                table |= _swapped(t, find, table, [x for x in subs_ if x["swap"]], s >= min_swaps, letters)
                places = table.pop(None, {})
                out.append(find.sub(lambda m, table=table, places=places: table.get(m.group()) or places.get(m.start()) or m.group(), t))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], ["_row", "restored"])

    fixed = damaged.select("_row", "_text", "subs", "s").mapInArrow(rewrite, "_row long, restored string")
    whole = rows.filter(~lost).join(fixed, "_row").filter("restored <> _text").select(F.col("_key").alias(key), "restored", F.lit(False).alias("lost"))
    return whole.unionByName(rows.filter(lost).select(F.col("_key").alias(key), F.lit(None).cast("string").alias("restored"), F.lit(True).alias("lost")))


def _swapped(text: str, find, table: dict[str, str], swaps: list[dict], several: bool, letters: frozenset[str]) -> dict:
    """{word: original} of the swapped words of ``text``, under None {place: original} of those that are
    so in some places only.  ``table``: the words that other chains explain; ``several``: enough longer
    words prove a swap."""
    if not several:
        swaps = [x for x in swaps if x["sure"]]
    # Pairs may agree on a word, so each is tried on all words.
    fits = {c: {x["word"]: x["original"] for x in swaps if swap(x["original"], *c.split(":")[1:]) == x["word"]} for c in sorted({x["chain"] for x in swaps})}
    if not fits:
        return {}
    chain = max(fits, key=lambda c: sum(map(len, fits[c])))
    pair, own = chain.split(":")[1:], fits[chain]
    if not several:
        found = list(find.finditer(text))
        at = {i for i, m in enumerate(found) if len(m.group()) >= 4 and m.group() in own}
        for step in (1, -1):
            for i in sorted(at, reverse=step < 0):
                j = i + step
                while 0 <= j < len(found) and found[j].group() in own and not any(c.isascii() and c.isalpha() for c in text[found[min(i, j)].end() : found[max(i, j)].start()]):
                    at.add(j)
                    i, j = j, j + step
        return {None: {found[i].start(): own[found[i].group()] for i in at}}
    seen = {m.group() for m in find.finditer(text)} - set(table)
    more = {w: got for w in seen - set(own) if (got := unswap(w, *pair)) != w}
    mixed = {w for w in more if any(c.isascii() and c.isalpha() for c in w)}
    # A text that has a character which the swap can't give, or would give it strange letters, isn't swapped as a whole.
    whole = not table and len(mixed) < len(own) and all(got and all(c in letters for c in got if c.isalpha()) for got in more.values())
    return {w: got for w, got in more.items() if got and (whole or w not in mixed)} | own


def digest(restored: str | None) -> str:
    return "" if restored is None else hashlib.md5(restored.encode("utf-8")).hexdigest()
