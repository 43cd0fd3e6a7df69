"""Encoding of whole texts with a public byte-level BPE vocabulary, at any text length.

Ordinary texts are encoded batch by batch where they stand.  Tree concatenation takes the texts that
hold more than ``unsplit`` characters without a place to split (no white space, or nothing else) and
those longer than ``piece`` characters:

1. They are cut into segments where a visible character meets white space.  Such a cut is exact, because
   the splitting pattern always starts a new part there.  Segments without long unsplit stretches hold up
   to ``piece`` characters; each long unsplit stretch is a segment of its own and is halved until its
   pieces have at most ``unsplit`` characters.
2. All pieces are encoded in parallel on all executors, whatever text they are of.
3. Neighbouring pieces of a stretch are joined in rounds, each round all pairs of all texts in parallel, keyed
   by (text, segment, pair).  A join re-encodes a window around the cut and widens it until the result
   begins with a token of the left side and ends with a token of the right side in the same places.
   Byte-pair encodings are determined by their adjacent pairs, so agreeing at one token on both sides
   makes the whole exact; the window is further required to start and end where the splitting pattern
   starts a new part or within a run of one class of characters, which its re-encoding leaves as it was.
4. The segments of a text are put together in order.

The vocabulary file is read once by the driver from a path that is a parameter and sent to the
executors (under 1 MB, whatever the data).

Defined results: null and empty texts give an empty list; blanks and any characters are text
like other text, and strings of special tokens are ordinary text; rows are never merged, so
repeated ids and texts each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise

DEFAULT_PATH = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

Encode = Callable[[str], list[int]]


@functools.lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


#: An exact cut: white space after a visible character.
_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")


def halves(stretch: str, unsplit: int) -> list[str]:
    """``stretch`` halved until its pieces have at most ``unsplit`` characters: a power of two of pieces."""
    n = 1
    while n * unsplit < len(stretch):
        n *= 2
    at = [len(stretch) * i // n for i in range(n + 1)]
    return [stretch[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def segments(text: str, piece: int, unsplit: int) -> list[list[str]]:
    """The segments of a text, each a list of pieces: one, or the halves of a long unsplit stretch."""
    out: list[list[str]] = []
    cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    start = 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > unsplit or b - start > piece:
            if a > start:
                out.append([text[start:a]])
            start = a
        if b - a > unsplit:
            out.append(halves(text[a:b], unsplit))
            start = b
    if start < len(text):
        out.append([text[start:]])
    return out


def join(left: list[int], right: list[int], encode: Encode, decode: Callable[[list[int]], bytes], width: int = 16) -> list[int]:
    """The encoding of the text of ``left`` and ``right`` together, by widening windows."""
    if not left or not right:
        return left or right
    w = width
    while True:
        a, b = max(0, len(left) - w), min(len(right), w)
        # A window starts and ends on whole characters.
        try:
            text = decode(left[a:] + right[:b]).decode("utf-8")
        except UnicodeDecodeError:
            text = None
        whole = a == 0 and b == len(right)
        if text is not None:
            got = encode(text)
            if whole:
                return got
            # The first quarter of the left tokens and the last of the right must come out again.
            m, n = max(2, (len(left) - a) // 4), max(2, b // 4)
            starts = a == 0 or (got[:m] == left[a : a + m] and _steady(decode, left[a : a + m]))
            ends = b == len(right) or (got[-n:] == right[b - n : b] and _steady(decode, right[b - n : b]))
            if starts and ends:
                return left[:a] + got + right[b:]
        elif whole:
            raise ValueError("the pieces are not whole texts")
        # Off by one at each widening, so that a window can't keep splitting a character.
        w = w * 2 + 1


def _steady(decode: Callable[[list[int]], bytes], tokens: list[int]) -> bool:
    """No apostrophe near the rim: contractions are the only parts that depend on what is before them."""
    return b"'" not in decode(tokens)


def tree_join(parts: list[list[int]], encode: Encode, decode: Callable[[list[int]], bytes]) -> list[int]:
    """Join neighbours pairwise until one encoding is left."""
    while len(parts) > 1:
        parts = [join(*parts[i : i + 2], encode, decode) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _is_long(text: Column, piece: int, unsplit: int) -> Column:
    n = unsplit + 1
    # Tried at the starts of stretches only, so that its time is linear in the text.
    stretch = rf"(?<![^ \t\n\r])[^ \t\n\r]{{{n}}}|(?<![ \t\n\r])[ \t\n\r]{{{n}}}"
    return F.coalesce((F.length(text) > piece) | ((F.length(text) > unsplit) & text.rlike(stretch)), F.lit(False))


def pieces(df: DataFrame, key: str, text: str, piece: int = 100_000, unsplit: int = 512) -> DataFrame:
    """(_key, _row, _seg, _no, _n, _piece): the pieces of the texts that take the tree; ``_n``: pieces of the segment."""
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = rows.filter(_is_long(F.col("_text"), piece, unsplit)).withColumn("_row", F.monotonically_increasing_id())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column("_text").to_pylist()):
                each = [(s, k, len(parts), p) for s, parts in enumerate(segments(t, piece, unsplit)) for k, p in enumerate(parts)]
                s, k, n, p = zip(*each, strict=True)
                at = pa.array([i] * len(each))
                yield pa.RecordBatch.from_arrays([batch.column("_key").take(at), batch.column("_row").take(at), pa.array(s, pa.int32()), pa.array(k, pa.int32()), pa.array(n, pa.int32()), pa.array(p, pa.string())], ["_key", "_row", "_seg", "_no", "_n", "_piece"])

    return rows.select("_key", "_text", "_row").mapInArrow(split, f"_key {key_type}, _row long, _seg int, _no int, _n int, _piece string")


def encode_corpus(df: DataFrame, key: str, text: str, path: str = DEFAULT_PATH, pattern: str = PATTERN, piece: int = 100_000, unsplit: int = 512) -> DataFrame:
    """(key, ids): the token ids of each row's text."""
    with open(path, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def ids_array(lists: list[list[int]]) -> pa.ListArray:
        offsets = np.zeros(len(lists) + 1, np.int32)
        np.cumsum([len(x) for x in lists], out=offsets[1:])
        flat = np.fromiter((t for x in lists for t in x), np.int32, int(offsets[-1]))
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    def encode(column: str, own: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            enc = _encoding(ranks.value, pattern)
            for batch in batches:
                # Slices bound the memory that a batch of lists takes.
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    lists = [enc.encode_ordinary(t) if t else [] for t in part.column(column).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), ids_array(lists)], [*own, "_ids"])

        return run

    def join_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = [tree_join([x["_ids"] for x in pair], enc.encode_ordinary, enc.decode_bytes) for pair in part.column("_pair").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own[:4]), ids_array(lists)], [*own[:4], "_ids"])

    own = ["_key", "_row", "_seg", "_no", "_n"]
    schema = f"_key {key_type}, _row long, _seg int, _no int"
    cut = pieces(df, key, text, piece, unsplit)
    # Written, so that the rounds neither cut nor encode again; few rows with much work each.
    encoded = materialise(cut.repartition("_row", "_seg", "_no").mapInArrow(encode("_piece", own), f"{schema}, _n int, _ids array<int>"))
    tree = encoded.filter("_n > 1").drop("_n")
    most = encoded.agg(F.max("_n")).first()[0] or 1
    for _ in range(most.bit_length() - 1):
        pairs = tree.groupBy("_row", "_seg", F.shiftright("_no", 1).alias("_no")).agg(F.first("_key").alias("_key"), F.sort_array(F.collect_list(F.struct("_no", "_ids"))).alias("_pair"))
        tree = pairs.select(*own[:4], "_pair").mapInArrow(join_pairs, f"{schema}, _ids array<int>")
    parts = encoded.filter("_n = 1").drop("_n").unionByName(tree).groupBy("_row").agg(F.first("_key").alias("_key"), F.sort_array(F.collect_list(F.struct("_seg", "_ids"))).alias("_parts"))
    long_ = parts.select("_key", F.flatten("_parts._ids").alias("_ids"))
    short = rows.filter(~_is_long(F.col("_text"), piece, unsplit)).mapInArrow(encode("_text", ["_key"]), f"_key {key_type}, _ids array<int>")
    return short.unionByName(long_).select(F.col("_key").alias(key), F.col("_ids").alias("ids"))
