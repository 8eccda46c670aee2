"""Lexical retrieval packing into sequences of a fixed number of tokens.

Documents are tokenised and gathered into shards of a bounded number of
tokens. Each shard has a BM25 inverted index of its documents. A seed
document opens a sequence; its unused neighbours, best first, fill the
window; a document that does not fit is cut there and goes on in the next
sequence, as whose seed it then serves. Every shard is one bounded piece of
one task, so nothing is shuffled, and a lost task repeats its own shards.

A shard's last window is cut into sequences whose lengths are powers of two,
which need no padding.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare

WINDOW = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
SHARD_TOKENS = 1_000_000
# BM25 parameters, and the number of a seed's terms that make up its query: no bound.
K1, B, QUERY_TERMS = 1.2, 0.75, None
# Distinct words whose ids a worker keeps; others are tokenised as they come.
KNOWN_WORDS = 500_000
# Texts that are tokenised at once.
TEXTS = 500
# Words of Latin letters, which the tokenizer leaves in one piece, and ASCII
# symbols after them, which are another, are tokenised so many words at a time
# as one text.
LETTERS = re.compile("[a-zA-Z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+([!-/:-@\\[-`{-~]+)?")
JOINED = 200
# Marks that compose with a small letter where they do not with a capital.
MARKS = re.compile("[\u0300-\u036F]")


class Tokens:
    """Token ids of texts, through a table of words met so far.

    The tokenizer never joins characters across ASCII blanks, so the ids of a
    text are those of its blank-separated pieces in order, and each distinct
    piece is tokenised once. A-Z are lower-cased first, as the tokenizer does
    itself; texts with marks or special tokens are left to its own rules.

    New words of letters and symbols after them are joined to one text: an id
    whose token ends a piece (``</w>``) ends each of the pieces. Where the ends
    are not as many as the pieces, as with a tokenizer that marks none, each
    word is a text of its own.
    """

    class _Known(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.ids = self._Known(), np.zeros(0, dtype=np.uint16)
        self.start = np.zeros(1, dtype=np.int64)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encoded(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)"""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return sizes, np.fromiter(chain.from_iterable(got), dtype=np.uint16, count=int(sizes.sum()))

    def _words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids)"""
        found = map(LETTERS.fullmatch, words)
        pieces = np.fromiter((0 if m is None else 1 if m[1] is None else 2 for m in found), dtype=np.int64, count=len(words))
        plain = pieces > 0
        at, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        mine = [words[i] for i in at.tolist()]
        _, ids = self._encoded([" ".join(mine[lo:lo + JOINED]) for lo in range(0, len(mine), JOINED)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != pieces.sum() or (len(ids) and ends[-1:] != len(ids)):
            return self._encoded(words)
        more, rest = self._encoded([words[i] for i in other.tolist()])
        sizes = np.empty(len(words), dtype=np.int64)
        sizes[at], sizes[other] = np.diff(ends[np.cumsum(pieces[at]) - 1], prepend=0), more
        out, own = np.empty(len(ids) + len(rest), dtype=np.uint16), np.repeat(plain, sizes)
        out[own], out[~own] = ids, rest
        return sizes, out

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by END; number of ids per text)"""
        words, count = [], []
        for t in texts:
            t = t or ""
            w = t.encode("utf-8", "replace")
            if "<|" not in t and (t.isascii() or not MARKS.search(t)):
                w = w.lower()
            w = w.split()
            words += w
            count.append(len(w))
        before = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.known) > before:
            new = self._last(len(self.known) - before)
            # The library's results are large objects: few at a time.
            sizes, ids = [np.diff(self.start)], [self.ids]
            for lo in range(0, len(new), 20_000):
                size, got = self._words([w.decode() for w in new[lo:lo + 20_000]])
                sizes.append(size)
                ids.append(got)
            self.start, self.ids = np.r_[0, np.cumsum(np.concatenate(sizes))], np.concatenate(ids)
        size = self.start[at + 1] - self.start[at]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.r_[0, ends][np.cumsum(count)]  # ids before the end of each text
        ids = np.insert(ids, upto, END).astype(np.uint16)
        if len(self.known) > max(before, KNOWN_WORDS):  # full: the words of this call go again
            for w in self._last(len(self.known) - max(before, KNOWN_WORDS)):
                del self.known[w]
            self.start = self.start[:len(self.known) + 1]
            self.ids = self.ids[:self.start[-1]]
        return ids, np.diff(np.r_[0, upto]) + 1

    def _last(self, n: int) -> list:
        return list(islice(reversed(self.known), n))[::-1]


_TOKENS: dict = {}


def tokens(path: str) -> Tokens:
    """One table per worker process and tokenizer."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


class Index:
    """BM25 inverted index of the documents of one shard."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        n = len(size)
        doc = np.repeat(np.arange(n, dtype=np.int64), size)
        pair = np.sort(doc << 16 | ids)
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        tf = np.diff(np.r_[first, len(pair)])
        pair = pair[first]
        doc, term = pair >> 16, (pair & 0xFFFF).astype(np.uint16)
        self.doc_terms, self.doc_start = term, np.searchsorted(doc, np.arange(n + 1))
        df = np.bincount(term, minlength=1 << 16)
        self.df = df
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        order = np.argsort(term, kind="stable")
        self.posts = doc[order].astype(np.int32)
        norm = K1 * (1 - B + B * size / max(1.0, size.mean()))
        self.weight = (tf * (K1 + 1) / (tf + norm[doc]))[order] * self.idf[term[order]]
        self.post_start = np.r_[0, np.cumsum(df)]
        self.n = n

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with ``seed``, best first."""
        terms = self.doc_terms[self.doc_start[seed]:self.doc_start[seed + 1]].astype(np.int64)
        terms = terms[self.df[terms] > 1]
        spans = [slice(self.post_start[t], self.post_start[t + 1]) for t in terms]
        if not spans:
            return np.zeros(0, dtype=np.int64)
        score = np.bincount(np.concatenate([self.posts[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), minlength=self.n)
        found = np.flatnonzero((score > 0) & unused)
        return found[np.lexsort((found, -score[found]))]


def order_pieces(ids: np.ndarray, size: np.ndarray, window: int = WINDOW) -> list[list[tuple]]:
    """Sequences of (document, start, length) that hold each id once."""
    index = Index(ids, size)
    unused = np.ones(len(size), dtype=bool)
    sequences, current, room, fresh = [], [], window, 0
    queue: list = []  # neighbours of the seed of the current sequence

    def put(doc: int) -> None:
        nonlocal current, room, queue
        unused[doc] = False
        start, left = 0, int(size[doc])
        while left:
            if not current:  # this document is the seed
                queue = index.neighbours(doc, unused)[::-1].tolist() if left < window else []
            n = min(left, room)
            current.append((doc, start, n))
            start, left, room = start + n, left - n, room - n
            if not room:
                sequences.append(current)
                current, room, queue = [], window, []

    while True:
        while queue and not unused[queue[-1]]:
            queue.pop()
        if queue:
            put(queue.pop())
            continue
        while fresh < len(size) and not unused[fresh]:
            fresh += 1
        if fresh == len(size):
            break
        put(fresh)
    used = window - room
    bit = 1
    parts = []
    while bit <= used:  # powers of two that add up to the last window
        if used & bit:
            parts.append(bit)
        bit <<= 1
    for part in reversed(parts):
        take, seq = part, []
        while take:
            doc, start, n = current[0]
            m = min(n, take)
            seq.append((doc, start, m))
            take -= m
            current = current[1:] if m == n else [(doc, start + m, n - m), *current[1:]]
        sequences.append(seq)
    return sequences


PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECE_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _pack(path: str, shard_tokens: int, window: int, with_ids: bool):
    schema = PIECE.append(pa.field("ids", pa.binary())) if with_ids else PIECE

    def run(batches):
        encode = tokens(path)
        base, done = TaskContext.get().partitionId() << 32, 0
        held: list = []
        total = 0

        def flush():
            nonlocal done
            doc_ids = pa.concat_arrays([h[0] for h in held])
            ids, size = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            sequences = order_pieces(ids, size, window)
            doc, start, n = (np.array(c, dtype=np.int64) for c in zip(*(p for s in sequences for p in s)))
            per = np.array([len(s) for s in sequences])
            seq = np.repeat(np.arange(len(per)), per)
            ends = np.cumsum(n)
            opens = (ends - n)[np.cumsum(per) - per]
            at = (np.cumsum(size) - size)[doc] + start
            wide = ids.astype("<u4")
            raw = [wide[a:a + k].tobytes() for a, k in zip(at.tolist(), n.tolist())]
            cols = [doc_ids.take(pa.array(doc)), start, n, [zlib.crc32(r) for r in raw], size[doc],
                    base + done + seq, ends - n - opens[seq]]
            if with_ids:
                cols.append(pa.array(raw, pa.binary()))
            done += len(per)
            out = pa.table([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(cols, schema)],
                           schema=schema)
            yield from out.combine_chunks().to_batches(max_chunksize=10_000)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, size = encode(part.column("text").to_pylist())
                # Cut where the shard is full, so that a shard stays bounded.
                upto = np.cumsum(size)
                lo = 0
                while lo < len(size):
                    before = int(upto[lo - 1]) if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(upto, before + shard_tokens - total, side="right")))
                    held.append((part.column("doc_id").slice(lo, hi - lo), ids[before:int(upto[hi - 1])], size[lo:hi]))
                    total += int(upto[hi - 1]) - before
                    lo = hi
                    if total >= shard_tokens or lo < len(size):
                        yield from flush()
                        held, total = [], 0
        if held:
            yield from flush()
    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens, sequence_id, offset and, unless left out,
    ids (little-endian unsigned 32-bit).

    Null and empty texts are documents of the end token alone; null doc_ids
    and repeated rows are packed like any other row; an empty table gives no
    pieces. ``tokenizer`` is a path that the executors can read; sequence_id
    holds the task's partition in its upper half.
    """
    prepare(docs.sparkSession)
    path = tokenizer or tokenizer_path()
    ddl = PIECE_DDL + (", ids binary" if with_ids else "")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        _pack(path, shard_tokens, window, with_ids), ddl)
