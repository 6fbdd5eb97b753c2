"""Packing by lexical retrieval.

Every run of up to SHARD_DOCS documents of a partition is a shard with its
own BM25 inverted index. A shard becomes one stream of tokens: the document
at the start of a window is its seed, the seed's best unused neighbours fill
the window, and the one that the window's end cuts seeds the next. Windows
are cut at fixed length; what is left at the end of a shard is cut into
powers of two, which need no padding. Nothing is shuffled, and a lost task
is repeated with the same result.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcheck.llm.common import bounded_batches, trim
from gridcheck.llm.wordhash import Texts, slices

WINDOW, END = 2048, 1
SHARD_DOCS, SHARD_TOKENS = 1024, 2_000_000
K1, B = 1.2, 0.75
#: Entries at which a task forgets the chunks, and the stems and tails, that it has seen.
CACHED, PIECES = 800_000, 250_000
#: Marks that are parted from a stem that ends in a letter or digit. Those of which special tokens or contractions are made stay with
#: the stem, as do all marks after a capital dotted I, whose lower case ends in a mark.
MARKS = "!#$%&()*+,-./:;=?@[]^_`{}~\\"
#: Words of precomposed Latin letters; capital dotted I, whose lower case is two characters, is none of them.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+")
#: The characters by which byte-level tokenizers spell bytes: printable ones themselves, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class ChunkEncoder:
    """Ids of a tokenizer that always parts and drops ASCII white space, and
    parts letters and digits from other marks. Chunks are told apart by
    64-bit hashes over whole batches; each new one is taken apart once, and
    each new stem or tail encoded once."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces: dict[str, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk as 32-bit integers in a byte string, a third of the size of a list."""
        texts = b"\n".join(chunks).decode().split("\n")
        stems = [t.rstrip(MARKS) for t in texts]
        tails = [t[len(s) :] for t, s in zip(texts, stems, strict=True)]
        for k, s in enumerate(stems):
            if s.isalpha() and s.isascii():
                stems[k] = s.lower()
            elif tails[k] and not (s and s[-1].isalnum() and s[-1] != "İ"):
                stems[k], tails[k] = texts[k], ""
            elif _LATIN.fullmatch(s):
                # Lower case, as the tokenizer's own: only where no special token can hide.
                stems[k] = s.lower()
        if len(self.pieces) > PIECES:
            self.pieces = {}
        new = []
        model = self.tokenizer.model
        for x in {*stems, *tails}:
            if x in self.pieces:
                continue
            plain = x.isascii()
            if (plain and x.isalpha()) or (not plain and _LATIN.fullmatch(x)):
                # A word of precomposed lower-case letters passes the normalizer and the splitter as it is.
                spelt = x if plain else x.encode().decode("latin-1").translate(_BYTE_CHARS)
                self.pieces[x] = array("i", [k.id for k in model.tokenize(spelt)]).tobytes()
            else:
                new.append(x)
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.pieces.update(zip(part, [array("i", e.ids).tobytes() for e in batch(part, add_special_tokens=False)], strict=True))
        get = self.pieces.__getitem__
        return [get(a) + get(b) if b else get(a) for a, b in zip(stems, tails, strict=True)]

    def terms(self, column) -> list[np.ndarray]:
        """The numbers of the chunks of each text of an Arrow string array; they hold until clear()."""
        texts = Texts(column)
        start, end = texts.words()
        key, seen, back = np.unique(texts.hashes(start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, key)
        new = np.ones(len(key), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != key
        if new.any():
            data, spans = texts.data.tobytes(), zip(start[seen[new]].tolist(), end[seen[new]].tolist(), strict=True)
            found = self._encode([data[a:b] for a, b in spans])
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            fresh = np.arange(len(self.known), len(self.known) + len(found), dtype=np.int32)
            self.known, self.number = np.insert(self.known, at[new], key[new]), np.insert(self.number, at[new], fresh)
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.int32)])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            at = np.searchsorted(self.known, key)
        numbers = self.number[at][back] if len(key) else np.zeros(0, np.int32)
        return np.split(numbers, np.cumsum(texts.per_text(start))[:-1]) if texts.n else []

    def encode(self, terms: list[np.ndarray], end: int) -> list[np.ndarray]:
        """The ids of each text, and end after them."""
        flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        start = self.first[flat]
        size = self.first[flat + 1] - start
        ids = self.ids[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        each = np.fromiter(map(len, terms), np.int64, len(terms))
        total = np.append(0, np.cumsum(size))[np.cumsum(each)]
        with_end = np.insert(ids, total, end)
        return np.split(with_end, (total + np.arange(1, len(terms) + 1))[:-1])


class BM25:
    """An inverted index over the documents of a shard. Terms of one document
    have no neighbours to find and are left out. Those that more than a
    quarter of the documents hold have a dense row of scores instead of
    postings; the rows together hold at most four times the postings that
    they stand for."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        length = np.fromiter(map(len, docs), np.int64, n)
        owner = np.repeat(np.arange(n), length)
        pair, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + owner if n else np.zeros(0, np.int64), return_counts=True)
        term, doc = pair // max(n, 1), pair % max(n, 1)
        _, number, df = np.unique(term, return_inverse=True, return_counts=True)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(length.mean() if n else 1, 1e-9))
        score = (idf[number] * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32)
        common = df > max(2, n / 4)
        dense = common[number]
        at = (np.cumsum(common) - 1)[number[dense]]
        self.rows = np.zeros((int(common.sum()), n), np.float32)
        self.rows[at, doc[dense]] = score[dense]
        self.doc_rows, self.doc_rows_first = self._by_doc(doc[dense], at, n)
        keep = (df > 1) & ~common
        used = keep[number]
        self.doc, self.score = doc[used], score[used]
        self.first = np.append(0, np.cumsum(df[keep])).astype(np.int64)
        self.doc_terms, self.doc_first = self._by_doc(self.doc, (np.cumsum(keep) - 1)[number[used]], n)
        self.n = n

    @staticmethod
    def _by_doc(doc: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        return term[np.argsort(doc, kind="stable")], np.append(0, np.cumsum(np.bincount(doc, minlength=n)))

    def scores(self, seed: int) -> np.ndarray:
        terms = self.doc_terms[self.doc_first[seed] : self.doc_first[seed + 1]]
        start = self.first[terms]
        size = self.first[terms + 1] - start
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        rows = self.doc_rows[self.doc_rows_first[seed] : self.doc_rows_first[seed + 1]]
        return np.bincount(self.doc[at], weights=self.score[at], minlength=self.n) + self.rows[rows].sum(axis=0, dtype=np.float64)


def _best_first(score: np.ndarray, found: np.ndarray, few: int = 24):
    """found by falling score, ties in order; a few of them are sorted at first, the rest only if asked for."""
    if len(found) > 2 * few:
        least = np.partition(score[found], len(found) - few)[len(found) - few]
        top = found[score[found] >= least]
        yield from top[np.argsort(-score[top], kind="stable")]
        found = found[score[found] < least]
    yield from found[np.argsort(-score[found], kind="stable")]


def order_shard(docs: list[np.ndarray], sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The order in which the documents of a shard make up its stream."""
    n = len(docs)
    index = BM25(docs)
    unused = np.ones(n, bool)
    out: list[int] = []
    at, cursor = 0, 0
    seed = -1
    while len(out) < n:
        if seed < 0:
            while not unused[cursor]:
                cursor += 1
            seed = cursor
            unused[seed] = False
            out.append(seed)
            at += int(sizes[seed])
        room = -at % window
        if room == 0:
            seed = -1
            continue
        score = index.scores(seed) * unused
        last = seed
        found = np.flatnonzero(score > 0)
        for d in _best_first(score, found):
            unused[d] = False
            out.append(int(d))
            at += int(sizes[d])
            last = int(d)
            room -= int(sizes[d])
            if room <= 0:
                break
        if room > 0:  # no neighbour left: the next unused document joins this window
            seed = -1
        else:
            seed = last if room < 0 else -1
    return np.array(out, np.int64)


def cuts(total: int, window: int = WINDOW) -> np.ndarray:
    """Ends of the sequences of a stream: full windows, then powers of two."""
    full = np.arange(1, total // window + 1, dtype=np.int64) * window
    rest = total % window
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.concatenate([full, total - rest + np.cumsum(tail, dtype=np.int64)]).astype(np.int64)


def pack(docs: DataFrame, tokenizer_file: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit, binary), doc_tokens, sequence_id, offset.

    A document is its ids and then end; each id lies in exactly one piece.
    Sequences hold window ids, or a power of two at the end of a shard.
    sequence_id is the partition's number times 2^32 plus a counter.

    Defined cases: a null or empty text is the end id alone; a text of any
    length is packed whole, over several sequences if need be; each row,
    repeated ones and those of a null doc_id included, is a document of its
    own; an empty table gives an empty result; other columns are ignored.
    """
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        import public_tokenizers
        import pyarrow as pa
        from pyspark import TaskContext

        file = tokenizer_file or public_tokenizers.path("word_bpe_49k.json")
        encoder = ChunkEncoder(file)  # of this task alone: a worker that goes on to other stages holds none of it
        context = TaskContext.get()
        state = {"next": (context.partitionId() if context else 0) << 32}
        ids: list[int | None] = []
        terms: list[np.ndarray] = []
        tokens: list[np.ndarray] = []

        def flush():
            sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
            order = order_shard(terms, sizes, window)
            end_of_doc = np.cumsum(sizes[order])
            stream = np.concatenate([tokens[d] for d in order]).astype("<u4")
            ends = cuts(int(end_of_doc[-1]), window)
            stop = np.union1d(end_of_doc, ends)
            start = np.append(0, stop[:-1])
            seq = np.searchsorted(ends, start, "right")
            place = np.searchsorted(end_of_doc, start, "right")
            seq_start, doc_start = np.append(0, ends)[seq], np.append(0, end_of_doc)[place]
            raw = stream.tobytes()
            columns = [
                pa.array([ids[d] for d in order[place]], pa.int64()),
                pa.array(start - doc_start, pa.int64()),
                pa.array(stop - start, pa.int64()),
                pa.array([raw[4 * a : 4 * b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()),
                pa.array(sizes[order][place], pa.int64()),
                pa.array(state["next"] + seq, pa.int64()),
                pa.array(start - seq_start, pa.int64()),
            ]
            state["next"] += len(ends)
            ids.clear(), terms.clear(), tokens.clear()
            if len(encoder.known) > CACHED:
                encoder.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        held = 0
        for batch in batches:
            for at, n in slices(batch.column(1)):
                part = batch.slice(at, n)
                new = encoder.terms(part.column(1))
                ids.extend(part.column(0).to_pylist())
                terms.extend(new)
                tokens.extend(encoder.encode(new, end))
                held += sum(map(len, tokens[-len(new) :]))
                if len(ids) >= SHARD_DOCS or held >= SHARD_TOKENS:
                    yield flush()
                    held = 0
        if ids:
            yield flush()
        trim()

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
