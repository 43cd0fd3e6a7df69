"""Evaluation passages that leaked into a corpus: BM25 index with block-max WAND, then a proof.

The held-out items form an inverted index with BM25 weights: the postings of a term sorted by item, the
maximum weight of each list and of each block of ``block`` items in it (block maxima are kept only where the
term occurs).  Every passage of the corpus is a query: the windows of ``window`` words, overlapping by one
word less than the run that counts as a leak, so that each run lies whole in some window.

Retrieval is block-max WAND.  The cursors of a window's terms are ordered by their current item; the pivot
is the first item at which the list maxima before it can reach the threshold.  If the block maxima there
can't, all cursors before jump past the block; else they move to the pivot, and the item is scored once all
stand on it.  Postings that are jumped over are never read.  The windows of a batch move in lockstep: each
step moves the cursors of all windows that aren't finished, as arrays.

All items above the threshold are kept, and the threshold loses nothing: an item's weights are divided by
the least BM25 score that any run of ``run`` consecutive words of it can have, so a window that holds such a
run scores at least 1.  Items retrieved are then verified: the overlap with the item's own words, question and
answer alike, must hold ``run`` consecutive words, compared word by word.

Items beyond ``budget`` characters, whose index would not fit one broadcast, are divided by a hash of their key
into as many indexes as needed, and the corpus is scanned for each.  Weights depend on the index an item is in, results do not.

Defined results: null, empty and blank texts leak nothing; texts of any length are read whole;
items with fewer than ``run`` words and items without a key or text cannot leak; equal items are all
reported; repeated documents each give rows; words are as in ``words_of``; extra columns are unread.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LEAST = 0.999  # 1, less the rounding of sums
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """The longest runs of letters and digits (categories L and N) after lower-casing."""
    import regex

    return regex.findall(r"[\p{L}\p{N}]+", text.lower()) if text else []


def _rolling(terms: np.ndarray, run: int) -> np.ndarray:
    """A hash of the ``run`` terms from each place on."""
    n = max(0, len(terms) - run + 1)
    out = np.zeros(n, np.uint64)
    for k in range(run):
        out = (out + terms[k : k + n].astype(np.uint64) + np.uint64(1)) * _STEP
        out ^= out >> np.uint64(29)
    return out


class Index:
    """BM25 index of texts with list and block maxima, scaled so that a leak scores 1 or more."""

    def __init__(self, texts: list[str], run: int = 12, block: int = 8, k1: float = 1.2, b: float = 0.75):
        self.run, self.block = run, block
        bag = [(i, w) for i, w in enumerate(map(words_of, texts)) if len(w) >= run]
        self.vocabulary: dict[str, int] = {}
        for _, w in bag:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary))
        n, v = len(bag), len(self.vocabulary)
        self.n, self.positions = n, np.array([i for i, _ in bag], np.int64)
        terms = [np.array([self.vocabulary[x] for x in w], np.int64) for _, w in bag]
        # One posting per term and item: its key orders by term, then item; n stands behind all items.
        sizes = np.array([len(t) for t in terms], np.int64)
        flat = np.concatenate([*terms, np.empty(0, np.int64)])
        item = np.repeat(np.arange(n), sizes)
        keys, tf = np.unique(flat * (n + 1) + item, return_counts=True)
        term, doc = np.divmod(keys, n + 1)
        df = np.bincount(term, minlength=v)[:v]
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        mean = sizes.mean() if n else 1.0
        weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[doc] / mean))
        # The least score of a run of an item: its distinct words, as weights at their first places in the run.
        own = weight[np.searchsorted(keys, flat * (n + 1) + item)]
        least = np.full(n, np.inf)
        start = np.concatenate([[0], np.cumsum(sizes)])
        for d in range(n):
            t, w = terms[d], own[start[d] : start[d + 1]]
            runs = np.lib.stride_tricks.sliding_window_view(t, run)
            order = np.argsort(runs, axis=1, kind="stable")
            by = np.take_along_axis(runs, order, 1)
            first = np.ones_like(by, bool)
            first[:, 1:] = by[:, 1:] != by[:, :-1]
            least[d] = (np.take_along_axis(np.lib.stride_tricks.sliding_window_view(w, run), order, 1) * first).sum(axis=1).min()
        weight = weight / least[doc]
        self.listmax = np.zeros(v + 1)
        np.maximum.at(self.listmax, term, weight)
        blocks, at = np.unique(term * (n + 1) + doc // block, return_inverse=True)
        self.blocks, self.blockmax = np.append(blocks, np.iinfo(np.int64).max), np.zeros(len(blocks) + 1)
        np.maximum.at(self.blockmax, at, weight)
        # Each list ends with a posting of item n; the list of term v, for no word, holds only that.
        ends = np.arange(v + 1) * (n + 1) + n
        keys = np.concatenate([keys, ends])
        order = np.argsort(keys, kind="stable")
        self.keys, self.weight = keys[order], np.concatenate([weight, np.zeros(v + 1)])[order]
        self.block_of = np.concatenate([at, np.zeros(v + 1, np.int64)])[order]
        self.size = np.bincount(term, minlength=v + 1)
        self.start = np.concatenate([[0], np.cumsum(self.size + 1)[:-1]])
        # For the proof: the runs of the items by hash, and their words.
        self.terms, places = flat, [np.arange(start[d], start[d + 1] - run + 1) for d in range(n)]
        rolled = _rolling(flat, run)
        self.place = np.concatenate([*places, np.empty(0, np.int64)])
        proof = self._proof(np.repeat(np.arange(n), sizes - run + 1), rolled[self.place])
        order = np.argsort(proof, kind="stable")
        self.proof, self.place = proof[order], self.place[order]

    @staticmethod
    def _proof(item: np.ndarray, rolled: np.ndarray) -> np.ndarray:
        return rolled ^ ((item.astype(np.uint64) + np.uint64(1)) * _STEP)

    def retrieve(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(window, item) of all items that score 1 or more for a window, and the number of postings read.

        ``terms``: (windows, words) of term numbers, each once a window, padded with the term for no word.
        """
        n1 = self.n + 1
        most = self.listmax[terms]
        rows = np.flatnonzero(most.sum(axis=1) >= _LEAST)
        terms, most = terms[rows], most[rows]
        cursor = self.start[terms]
        doc = self.keys[cursor] - terms * n1
        read = int((most > 0).sum())
        found_w, found_d = [], []
        while len(rows):
            order = np.argsort(doc, axis=1)
            by = np.take_along_axis(doc, order, 1)
            # Lists at their end stand at item n and add nothing.
            bound = np.cumsum(np.take_along_axis(most, order, 1) * (by < self.n), axis=1)
            live = bound[:, -1] >= _LEAST
            if (n_live := int(live.sum())) < 0.8 * len(rows) or not n_live:
                # No pivot: these windows are finished.
                rows, terms, doc, most, cursor, bound, by = (x[live] for x in (rows, terms, doc, most, cursor, bound, by))
                live = live[live]
                if not n_live:
                    break
            p = (bound >= _LEAST).argmax(axis=1)
            # Windows that are finished but not yet taken out stand still: their pivot lies before all items.
            pivot = np.where(live, by[np.arange(len(rows)), p], -1)
            upto = doc <= pivot[:, None]
            # Block maxima of the lists that reach the pivot, looked up where the term has any posting in the block.
            at = np.flatnonzero(upto)
            r = at // upto.shape[1]
            block, here = pivot[r] // self.block, doc.ravel()[at] // self.block
            best = self.blockmax[self.block_of[cursor.ravel()[at]]]
            if (far := np.flatnonzero(here < block)).size:
                key = terms.ravel()[at[far]] * n1 + block[far]
                m = np.searchsorted(self.blocks, key)
                best[far] = np.where(self.blocks[m] == key, self.blockmax[m], 0.0)
            can = np.bincount(r, weights=best, minlength=len(rows)) >= _LEAST
            there = can & (by[:, 0] == pivot)
            if (scored := np.flatnonzero(there)).size:
                score = np.where(doc[scored] == pivot[scored, None], self.weight[cursor[scored]], 0.0).sum(axis=1)
                hit = scored[score >= _LEAST]
                found_w.append(rows[hit])
                found_d.append(pivot[hit])
            # Where to go: past the block (but no further than the first list behind the pivot), past the pivot, or to it.
            behind = np.where(upto, self.n, doc).min(axis=1)
            target = np.where(~can, np.minimum((pivot // self.block + 1) * self.block, behind), np.where(there, pivot + 1, pivot))
            target = np.where(live, np.minimum(target, self.n), -1)
            at = np.flatnonzero(doc < target[:, None])
            t = terms.ravel()[at] * n1
            goal, to = t + target[at // upto.shape[1]], cursor.ravel()[at] + 1
            if (far := np.flatnonzero(self.keys[to] < goal)).size:
                to[far] = np.searchsorted(self.keys, goal[far])
            to_doc = self.keys[to] - t
            # Both are contiguous, so this writes into them.
            cursor.reshape(-1)[at], doc.reshape(-1)[at] = to, to_doc
            read += int((to_doc < self.n).sum())
        join = lambda x: np.concatenate([*x, np.empty(0, np.int64)])
        return join(found_w), join(found_d), read

    def leaks(self, texts: list[str | None], window: int, at_once: int = 4096) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(text, item) of the items that share a run of words with a text, once each; with the number of
        postings read and of those in the lists of all windows."""
        run, unknown = self.run, len(self.vocabulary)
        none = np.empty(0, np.int64)
        if not self.n:
            return none, none, 0, 0
        get, ids, sizes = self.vocabulary.get, [], []
        for text in texts:
            own = [get(x, unknown) for x in words_of(text)]
            ids.extend(own)
            ids.append(unknown)
            sizes.append(len(own) + 1)
        terms = np.array(ids, np.int64)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        # A run holds known words only, so windows are taken within stretches of these.
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (terms != unknown).view(np.int8), [0]])))
        a, b = edges[::2], edges[1::2]
        a, b = a[b - a >= run], b[b - a >= run]
        step = window - run + 1
        k = (b - a - run) // step + 1
        first = np.repeat(a, k) + step * (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
        last = np.minimum(first + window, np.repeat(b, k))
        rolled = _rolling(terms, run)
        got_t, got_d, read, total = [], [], 0, 0
        for i in range(0, len(first), at_once):
            f, e = first[i : i + at_once], last[i : i + at_once]
            place = f[:, None] + np.arange(window)
            words = np.sort(np.where(place < e[:, None], terms[np.minimum(place, len(terms) - 1)], unknown), axis=1)
            words[:, 1:][words[:, 1:] == words[:, :-1]] = unknown
            total += int(self.size[words].sum())
            w, d, n = self.retrieve(words)
            read += n
            # The proof: each place of the window against the runs of the item.
            j = f[w][:, None] + np.arange(step)
            inside = j + run <= e[w][:, None]
            q, c = np.nonzero(inside)
            at = j[q, c]
            proof = self._proof(d[q], rolled[at])
            m = np.minimum(np.searchsorted(self.proof, proof), len(self.proof) - 1)
            same = self.proof[m] == proof
            q, at, m = q[same], at[same], m[same]
            ok = np.ones(len(q), bool)
            for x in range(run):
                ok &= terms[at + x] == self.terms[self.place[m] + x]
            got_t.append(text_of[at[ok]])
            got_d.append(d[q[ok]])
        pairs = np.unique(np.stack([np.concatenate([*got_t, none]), np.concatenate([*got_d, none])]), axis=1)
        return pairs[0], self.positions[pairs[1]], read, total


def find_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, run: int = 12, window: int = 20, budget: int = 20_000_000) -> DataFrame:
    """(key, item_key): every row of ``corpus`` with each item that shares ``run`` consecutive words."""
    if window < run:
        raise ValueError("window must not be shorter than run")
    rows = items.select(F.col(item_key).alias("i"), F.col(item_text).cast("string").alias("t")).filter("t is not null and i is not null")
    # The index takes about 100 bytes a character at most: the bound of what is broadcast.
    parts = max(1, -(-(rows.agg(F.sum(F.length("t"))).first()[0] or 0) // budget))
    key_type, item_type = corpus.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    out = None
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).orderBy("i", "t").toArrow().combine_chunks()
        names = own.column("i").combine_chunks() if own.num_rows else None
        shared = corpus.sparkSession.sparkContext.broadcast(pickle.dumps((Index(own.column("t").to_pylist(), run), names)))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = pickle.loads(shared.value)
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    batch = whole.slice(at, 500)
                    t, i, _, _ = index.leaks(batch.column(text).to_pylist(), window)
                    if len(t):
                        yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(t)), names.take(pa.array(i))], [key, item_key])

        got = corpus.select(key, text).mapInArrow(scan, f"`{key}` {key_type}, `{item_key}` {item_type}")
        out = got if out is None else out.unionByName(got)
    return out
