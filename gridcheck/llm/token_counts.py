"""Token counts of a sentencepiece BPE model by rank-synchronous merging.

Texts fall apart into pre-tokens across which the model can't merge. Each
distinct pre-token is encoded once per cache life: the symbols of all of them
lie in one ragged array, and every round applies to each sequence, at once,
its merge of lowest rank, in all places where that is the same as one place
after the other. Sequences in which no pair can merge retire with the number
of symbols that survive. A sequence takes a round for each rank that it
merges at, so long ones don't take rounds by their length.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from gridcheck.llm.common import map_texts

SPACE = "▁"
NEVER = np.int32(2**31 - 1)
CACHED = 400_000
#: Symbols that are merged in one ragged array, unless one pre-token has more.
FLAT = 1_000_000
_SPACED = re.compile(" +[^ ]*")


class PieceCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = [i for i in range(len(pieces)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        symbol = {pieces[i]: i for i in normal}
        scores = sorted({-sp.get_score(i) for i in normal})
        rank = {s: r for r, s in enumerate(scores)}
        # Characters that occur inside pieces only can still take part in a merge.
        for ch in sorted({c for p in symbol for c in p if len(p) > 1} - symbol.keys()):
            symbol[ch] = len(pieces) + len(symbol)
        self.size = np.int64(max(symbol.values()) + 1)
        pairs = {}
        for i in normal:
            p = pieces[i]
            for k in range(1, len(p)):
                if p[:k] in symbol and p[k:] in symbol:
                    pairs[symbol[p[:k]] * int(self.size) + symbol[p[k:]]] = (rank[-sp.get_score(i)], i)
        self._hash(pairs)
        # Ranks whose merge can make a pair of no higher rank, or that several pieces share: there, places are merged one by one.
        formed = {i: r for r, i in pairs.values()}
        self.one_by_one = np.zeros(len(scores), bool)
        for key, (r, _) in pairs.items():
            for part in divmod(key, int(self.size)):
                if r <= formed.get(part, -1):
                    self.one_by_one[formed[part]] = True
        shared = np.bincount(list(formed.values()), minlength=len(scores)) > 1 if formed else self.one_by_one
        self.one_by_one |= shared
        chars = [c for c in symbol if len(c) == 1]
        self.char_id = np.full(0x110000, -1, np.int32)
        self.char_id[[ord(c) for c in chars]] = [symbol[c] for c in chars]
        whole = np.zeros(int(self.size), bool)
        whole[[symbol[p] for p in symbol if symbol[p] < len(pieces)]] = True
        #: Tokens that a character gives if it survives alone: its bytes, if it is no piece.
        code = np.arange(0x110000)
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        self.alone = np.where((self.char_id >= 0) & whole[self.char_id], 1, width).astype(np.int32)
        self.weight = np.ones(int(self.size), np.int32)
        for c in chars:
            self.weight[symbol[c]] = self.alone[ord(c)]
        # Neighbours that stand together in some piece; a boundary lies between all others.
        inner = sorted({p[k : k + 2] for p in symbol for k in range(len(p) - 1)})
        self.inner_class = np.zeros(0x110000, np.int32)
        letters = sorted({c for b in inner for c in b})
        self.inner_class[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joins = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for b in inner:
            self.joins[self.inner_class[ord(b[0])], self.inner_class[ord(b[1])]] = True
        self.cache: dict[str, int] = {}

    def _hash(self, pairs: dict[int, tuple[int, int]]) -> None:
        """An open-addressing table that numpy can probe for many keys at once."""
        bits = max(4, int(len(pairs) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.full(1 << bits, NEVER, np.int32)
        self.slot_id = np.full(1 << bits, -1, np.int32)
        key = np.fromiter(pairs.keys(), np.int64, len(pairs))
        val = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        at = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = todo[self.keys[at[todo]] < 0]
            self.keys[at[free]] = key[free]
            done = self.keys[at[todo]] == key[todo]
            won = todo[done]
            self.slot_rank[at[won]], self.slot_id[at[won]] = val[won, 0], val[won, 1]
            todo = todo[~done]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The table's slot of each pair; an empty slot if it can't merge."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -2
        flat = key.ravel()
        at = self._slot(flat)
        todo = np.flatnonzero((self.keys[at] != flat) & (self.keys[at] != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            todo = todo[(self.keys[at[todo]] != flat[todo]) & (self.keys[at[todo]] != -1)]
        return at.reshape(key.shape)

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of the symbols that survive in each sequence of a ragged array; characters that are no symbol count 0."""
        out = np.zeros(len(lengths), np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        slot = np.append(self._find(symbols[:-1], symbols[1:]), 0)
        ends = np.cumsum(lengths) - 1
        rank, new = self.slot_rank[slot], self.slot_id[slot]
        rank[ends] = NEVER
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(first, len(symbols)))
            low = np.minimum.reduceat(rank, first)
            done = low == NEVER
            if done.any():
                gone = np.repeat(done, size)
                rest = symbols[gone]
                out += np.bincount(owner[gone], weights=np.where(rest >= 0, self.weight[rest], 0), minlength=len(out)).astype(np.int64)
                symbols, owner, rank, new = symbols[~gone], owner[~gone], rank[~gone], new[~gone]
                low, size = low[~done], size[~done]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            # Of places that overlap, every other one from the left; of ranks that need it, the leftmost alone.
            nth = np.arange(len(at))
            head = np.append(True, at[1:] != at[:-1] + 1)
            chosen = (nth - np.maximum.accumulate(np.where(head, nth, 0))) % 2 == 0
            leftmost = np.append(True, owner[at[1:]] != owner[at[:-1]])
            at = at[chosen & (leftmost | ~self.one_by_one[rank[at]])]
            symbols[at] = new[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            # What stood after the right part of a pair stands after the pair.
            rank[at], new[at] = rank[at + 1], new[at + 1]
            symbols, owner, rank, new = symbols[keep], owner[keep], rank[keep], new[keep]
            at = at - np.arange(len(at))
            after = at[at + 1 < len(symbols)]
            after = after[owner[after + 1] == owner[after]]
            before = at[at > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            near = np.union1d(after, before)
            slot = self._find(symbols[near], symbols[near + 1])
            rank[near], new[near] = self.slot_rank[slot], self.slot_id[slot]
        return out

    def count_words(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, given without its leading space mark."""
        text = np.frombuffer("".join(SPACE + w.replace(" ", SPACE) for w in words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        owner = np.repeat(np.arange(len(words)), sizes)
        cls = self.inner_class[text]
        cut = np.ones(len(text), bool)
        cut[1:] = ~self.joins[cls[:-1], cls[1:]] | (owner[1:] != owner[:-1])
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(text)))
        symbols, alone = self.char_id[text], self.alone[text]
        tokens = np.add.reduceat(np.where(symbols < 0, alone, 0), start).astype(np.int64) if len(start) else np.zeros(0, np.int64)
        single = length == 1
        tokens[single] = alone[start[single]]
        several = np.flatnonzero(~single)
        total = np.cumsum(length[several])
        for part in np.split(several, np.searchsorted(total, np.arange(FLAT, total[-1] if len(total) else 0, FLAT))):
            n = length[part]
            at = np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            tokens[part] += self._merge(symbols[at], n)
        return np.bincount(owner[start], weights=tokens, minlength=len(words)).astype(np.int64)

    def count(self, texts: list[str | None]) -> list[int]:
        split = []
        for t in texts:
            if not t:
                split.append([])
                continue
            t = t.replace(SPACE, " ")
            if t[0] == " " or t[-1] == " " or "  " in t:
                split.append([w[1:] for w in _SPACED.findall(" " + t)])
            else:
                split.append(t.split(" "))
        new = list(set().union(*split) - self.cache.keys())
        if len(self.cache) + len(new) > CACHED:
            self.cache = {}
            new = list(set().union(*split))
        self.cache.update(zip(new, self.count_words(new).tolist() if new else [], strict=True))
        get = self.cache.__getitem__
        return [sum(map(get, words)) for words in split]


def count_tokens(docs: DataFrame, model_file: str | None = None, limit: int = 4096, keep_text: bool = True) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit).

    model_file is a sentencepiece BPE model with the identity normalizer and
    byte fallback; by default the public piece_bpe_32k.model as each executor
    has it. Counts are those of encode() without begin and end marks.

    Defined cases: a null text counts as empty, which has 0 bytes and tokens;
    any length is counted whole; equal rows give equal results; an empty
    table gives an empty result; other columns pass through, and clashing
    n_bytes, n_tokens or over_limit columns of docs are replaced.
    """

    def make():
        import public_tokenizers

        counter = PieceCounter(model_file or public_tokenizers.path("piece_bpe_32k.model"))

        def f(column):
            texts = column.to_pylist()
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            n = counter.count(texts)
            return n_bytes, n, [x > limit for x in n]

        return f

    fields = [("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")]
    return map_texts(docs, make, fields, drop=() if keep_text else ("text",))


def digest(docs: DataFrame) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text"), keep_text=False)
