"""Near duplicates: SuperMinHash, banding, verification, union-find grouping.

1. Per document, in Arrow batches: the set of hashed 5-word shingles, an
   order-free 128-bit fingerprint of it, and a SuperMinHash signature. Every
   shingle deals out the ranks of a pseudorandom permutation of the slots, so
   the values of one signature are correlated and vary less than independent
   ones; the rounds stop for a document once no later rank can lower a slot.
2. Documents of equal sets are one class, found by partial aggregation, and
   stand for one node, however many copies there are.
3. Classes that share a band form a bucket. Each is compared with the
   bucket's least member (a star, linear in the bucket), on full sets.
4. Components come from minimum labels with pointer jumping.
5. Buckets that still hold several components are searched in blocks of
   bounded size: full sets meet in an inverted index inside the task, each
   pair in the first band that it shares, and only links that join two
   components leave it. Components are then closed again.

A pair at the threshold shares no band with a chance of 2e-6 at most; all
pairs that share one and aren't in one component already are compared on full
sets. Lower thresholds have more bands, of fewer slots.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcheck.llm.common import bounded_batches, checkpointed, free_name, map_texts, small, trim
from gridcheck.llm.wordhash import LOWER_BYTES, WINDOW, Texts, mix, slices, windows

SHINGLE, PERCENT = 5, 75
SLOTS, MISSED = 72, 2e-6
#: Links, in both directions, that components() closes in one task.
ONE_TASK = 200_000
#: Members of a bucket that step 5 compares at once, twice over.
BLOCK = 1024
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SALT_1, SALT_2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def bands(percent: int) -> tuple[int, int]:
    """Bands and slots in each, the most that miss a pair at the threshold with a chance of MISSED at most."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is {percent}, not in 1 to 100")
    for rows in (3, 2, 1):
        if (1 - (percent / 100) ** rows) ** (SLOTS // rows) < MISSED:
            return SLOTS // rows, rows
    raise ValueError(f"{SLOTS} slots miss too many pairs at {percent} percent")


def shingle_sets(texts: Texts, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every distinct shingle, ascending within its text; shingles per text)."""
    start, end = texts.words()
    counts = texts.per_text(start)
    words = texts.hashes(start, end, LOWER_BYTES)
    at, key = windows(words, counts, width)
    first = np.cumsum(counts) - counts
    per = np.maximum(counts - width + 1, 0)
    # A text with fewer words has one shingle, of all of them.
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = counts[short].astype(np.uint64)
    for k in range(width - 1):
        has = counts[short] > k
        whole[has] += words[first[short[has]] + k] * WINDOW[k]
    per[short] = 1
    out = np.empty(int(per.sum()), np.uint64)
    ends = np.cumsum(per)
    begin = ends - per
    long = np.ones(len(out), bool)
    long[begin[short]] = False
    out[long], out[begin[short]] = key, mix(whole)
    for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[begin[per > 0]] = True
    owner = np.repeat(np.arange(texts.n), per)
    return out[new], np.bincount(owner[new], minlength=texts.n)


def bounded_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """shingle_sets() of a column of any size, a bounded run of texts at a time."""
    parts = [shingle_sets(Texts(column.slice(at, n))) for at, n in slices(column)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([s for s, _ in parts]), np.concatenate([n for _, n in parts])


def super_minhash(sets: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures, one row per set: the least (rank, fraction) that an element deals to each slot, as rank * 2^32 + fraction."""
    n = len(sizes)
    value = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    live = np.flatnonzero(sizes > 0)
    keys = sets
    low = np.uint64(0xFFFFFFFF)
    deal = None
    for rank in range(slots):
        x = mix(keys + np.uint64((int(GOLDEN) * (rank + 1)) % 2**64))
        pick = (((x >> np.uint64(32)) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64) + rank
        if deal is None:
            slot = pick
        else:
            line = np.arange(len(keys))
            slot = deal[line, pick].astype(np.int64)
            deal[line, pick] = deal[:, rank]
        np.minimum.at(value, owner * slots + slot, (np.uint64(rank) << np.uint64(32)) | (x & low))
        open_ = value.reshape(n, slots)[live].max(1) >= np.uint64(rank + 1) << np.uint64(32)
        live = live[open_]
        if not len(live):
            break
        still = np.zeros(n, bool)
        still[live] = True
        keep = still[owner]
        if deal is None:
            # The first swap, of slot 0 with the one picked, for the elements that go on.
            keys, owner, pick = keys[keep], owner[keep], pick[keep]
            deal = np.tile(np.arange(slots, dtype=np.uint8), (len(keys), 1))
            deal[np.arange(len(keys)), pick] = 0
        elif not keep.all():
            keys, owner, deal = keys[keep], owner[keep], deal[keep]
    return value.reshape(n, slots)


def _sums(sets: np.ndarray, sizes: np.ndarray, salt: np.uint64) -> np.ndarray:
    total = np.append(np.uint64(0), np.cumsum(mix(sets ^ salt)))
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]).view(np.int64)


def describe(column) -> list:
    """n_shingles, _f1, _f2 and _sig (little-endian 32-bit hashes of the slots)."""
    sets, sizes = shingle_sets(Texts(column))
    # Bounded work space: a permutation of the slots for every element that needs more than one round.
    sig, at = [], 0
    firsts = np.append(0, np.cumsum(sizes))
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(firsts, firsts[at] + 100_000, "right")) - 1)
        sig.append(super_minhash(sets[firsts[at] : firsts[stop]], sizes[at:stop]))
        at = stop
    slots = mix(np.concatenate(sig) if sig else np.zeros((0, SLOTS), np.uint64)).astype(np.uint32)
    return [sizes, _sums(sets, sizes, SALT_1), _sums(sets, sizes, SALT_2), [r.astype("<u4").tobytes() for r in slots]]


def common_shingles(a: np.ndarray, b: np.ndarray) -> int:
    """Members in common of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _sets(ids, column) -> dict:
    """The set of each distinct id of a batch."""
    import pyarrow as pa

    first: dict = {}
    for k, i in enumerate(ids):
        first.setdefault(i, k)
    sets, sizes = bounded_sets(column.take(pa.array(list(first.values()), pa.int64())))
    return dict(zip(first, np.split(sets, np.cumsum(sizes)[:-1]), strict=True))


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, a_fp, b, b_fp), distinct, those whose full sets agree."""
    ends = pairs.select(F.col("a").alias("_id"), F.col("a_fp").alias("_f")).union(pairs.select("b", "b_fp")).distinct()
    texts = _texts(ends, docs)
    left = texts.select(F.col("_id").alias("a"), F.col("_f").alias("a_fp"), F.col("_text").alias("_a_text"))
    right = texts.select(F.col("_id").alias("b"), F.col("_f").alias("b_fp"), F.col("_text").alias("_b_text"))
    both = pairs.join(left, ["a", "a_fp"]).join(right, ["b", "b_fp"]).select("a", "b", "a_fp", "b_fp", "_a_text", "_b_text")

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                a, b, a_fp, b_fp = (batch.column(k).to_pylist() for k in range(4))
                a_key, b_key = list(zip(a, a_fp, strict=True)), list(zip(b, b_fp, strict=True))
                a_set, b_set = _sets(a_key, batch.column(4)), _sets(b_key, batch.column(5))
                keep = []
                for k, (i, j) in enumerate(zip(a_key, b_key, strict=True)):
                    x, y = a_set[i], b_set[j]
                    both_ = common_shingles(x, y)
                    if 100 * both_ >= percent * (len(x) + len(y) - both_) and len(x):
                        keep.append(k)
                yield batch.select([0, 2, 1, 3]).take(pa.array(keep, pa.int64()))
        trim()

    bounded_batches(docs.sparkSession)
    return both.mapInArrow(run, "a long, a_fp long, b long, b_fp long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, a_fp, b, b_fp), as pairs of doc_id and hash: label is the least node reachable."""
    ends = links.select(F.struct(F.col("a").alias("id"), F.col("a_fp").alias("fp")).alias("_to"), F.struct(F.col("b").alias("id"), F.col("b_fp").alias("fp")).alias("_from"))
    ways = checkpointed(ends.union(ends.select("_from", "_to")).distinct())
    # What one task can hold is closed in one, so that the rounds shuffle nothing; results are the same.
    held = (lambda df: checkpointed(df).coalesce(1)) if ways.count() <= ONE_TASK else checkpointed
    ways = ways.coalesce(1) if held is not checkpointed else ways
    labels = held(ways.groupBy("_from").agg(F.least(F.col("_from"), F.min("_to")).alias("label")).withColumnRenamed("_from", "node"))
    while True:
        heard = ways.join(labels, ways["_from"] == labels["node"]).select(F.col("_to").alias("node"), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("_old"))
        known = labels.select("node", "label", F.col("label").alias("_old"))
        least = held(known.union(heard).groupBy("node").agg(F.min("label").alias("label"), F.max("_old").alias("_old")))
        onward = least.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
        new = held(least.join(onward, least["label"] == onward["_at"]).select("node", F.col("_next").alias("label"), "_old"))
        moved = new.where("label <> _old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels


def _search_block(key, table, percent, count, rows):
    """Links between different components in one block pair of a bucket: at most as many as would join them."""
    import pyarrow as pa

    band, lo, hi = (k.as_py() for k in key[1:])
    node = np.stack([table[c].to_numpy() for c in ("_rep", "_fp")], 1)
    comp = np.stack([table[c].to_numpy() for c in ("_c_id", "_c_fp")], 1)
    side = table["_side"].to_numpy()
    # Numbers in the order of nodes, and of the components.
    _, rep = np.unique(node, axis=0, return_inverse=True)
    _, root = np.unique(comp, axis=0, return_inverse=True)
    banded = np.frombuffer(b"".join(table["_sig"].to_pylist()), "<u4").reshape(-1, count, rows)
    sets, n = bounded_sets(pa.concat_arrays(table["_text"].chunks))
    table = None
    first = np.append(0, np.cumsum(n))
    _, number = np.unique(sets, return_inverse=True)
    held = np.append(0, np.cumsum(np.bincount(number)))
    holder = np.repeat(np.arange(len(n)), n)[np.argsort(number, kind="stable")]
    right = np.flatnonzero(side == hi)
    a: list[int] = []
    b: list[int] = []
    for i in np.flatnonzero(side == lo):
        other = right[rep[right] > rep[i]] if lo == hi else right
        other = other[(root[other] != root[i]) & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
        if len(other):
            other = other[(banded[other] == banded[i]).all(2).argmax(1) == band]
        if len(other) < 16:
            both = np.array([common_shingles(sets[first[i] : first[i + 1]], sets[first[j] : first[j + 1]]) for j in other], np.int64)
        else:
            mine = number[first[i] : first[i + 1]]
            size = held[mine + 1] - held[mine]
            at = np.repeat(held[mine] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            both = np.bincount(holder[at], minlength=len(n))[other]
        for j in other[100 * both >= percent * (n[i] + n[other] - both)]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                a.append(i)
                b.append(j)
    return pa.table([node[a, 0], node[a, 1], node[b, 0], node[b, 1]], names=["a", "a_fp", "b", "b_fp"])


def _texts(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """(_id, _f, _text) of ends (_id, _f), distinct: the texts with that doc_id and hash."""
    ends = checkpointed(ends)
    asked = small(ends, ends.count())
    source = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("_fp"), "text")
    texts = source.join(asked, (source["doc_id"] == asked["_id"]) & (source["_fp"] == asked["_f"])).select("_id", "_f", "text")
    return checkpointed(texts.groupBy("_id", "_f").agg(F.first("text").alias("_text")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) per row of docs.

    Words are runs of all but ASCII white space, A-Z lower-cased. Documents
    whose sets of distinct 5-word shingles have a Jaccard index of at least
    percent are linked; component_id is the least doc_id reachable. A percent
    for which the bands would miss pairs is an error.

    Defined cases: with fewer than five words all of them are one shingle; a
    null text or one without words has none, is linked with nothing and kept;
    any length is read whole; rows of one doc_id are linked each by its own
    text, and equal ones alike; a row of null doc_id is linked with nothing,
    has a null component_id and is kept; an empty table gives an empty
    result; other columns are ignored.
    """
    return _grouped(docs, percent).select("doc_id", "n_shingles", F.col("_comp.id").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("_comp.id")).alias("kept"))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, _fp, n_shingles, _comp) per row of docs: _comp is the least (doc_id, hash of text) reachable."""
    count, width = bands(percent)
    fields = [("n_shingles", "long"), ("_f1", "long"), ("_f2", "long"), ("_sig", "binary")]
    narrow = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_fp"))
    rows = checkpointed(map_texts(narrow, lambda: describe, fields, drop=("text",)))
    part = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = checkpointed(
        part.groupBy("_f1", "_f2")
        .agg(F.min(F.struct("doc_id", "_fp")).alias("_r"), F.first("n_shingles").alias("_n"), F.first("_sig").alias("_sig"))
        .select(F.col("_r.doc_id").alias("_rep"), F.col("_r._fp").alias("_fp"), "_n", "_f1", "_f2", "_sig")
    )
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("_sig", 1 + 4 * width * b, 4 * width)) for b in range(count)])
    banded = classes.select("_rep", "_fp", "_n", F.posexplode(keys).alias("_band", "_key"))
    hubs = banded.groupBy("_key").agg(F.min(F.struct("_rep", "_fp", "_n")).alias("_hub"), F.count(F.lit(1)).alias("_size")).where("_size > 1")
    hubs = checkpointed(hubs)
    members = checkpointed(banded.join(small(hubs, hubs.count()), "_key"))
    near = F.least("_n", "_hub._n") * 100 >= F.greatest("_n", "_hub._n") * percent
    apart = (F.col("_rep") != F.col("_hub._rep")) | (F.col("_fp") != F.col("_hub._fp"))
    star = members.where(apart & near)
    pairs = star.select(F.col("_rep").alias("a"), F.col("_fp").alias("a_fp"), F.col("_hub._rep").alias("b"), F.col("_hub._fp").alias("b_fp")).distinct()
    links = checkpointed(confirmed(checkpointed(pairs), docs, percent))
    labels = components(links)
    # Buckets that hold several components: every pair across them that may be linked.
    own = F.struct(F.col("_rep").alias("id"), F.col("_fp").alias("fp"))
    comp = F.coalesce("label", own).alias("_comp")
    placed = checkpointed(members.join(labels, own == F.col("node"), "left").select("_key", "_band", "_rep", "_fp", "_size", comp))
    mixed = placed.groupBy("_key").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi")).where("_lo < _hi").select("_key")
    mixed = checkpointed(mixed)
    rest = checkpointed(placed.join(small(mixed, mixed.count()), "_key"))
    texts = _texts(rest.select(F.col("_rep").alias("_id"), F.col("_fp").alias("_f")).distinct(), docs)
    of = classes.select("_rep", "_fp", "_sig")
    carried = texts.join(of, (F.col("_id") == F.col("_rep")) & (F.col("_f") == F.col("_fp"))).select("_rep", "_fp", "_sig", "_text")
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    side = F.pmod(F.xxhash64("_rep", "_fp"), blocks).cast("int")
    rest = rest.withColumn("_side", side).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.withColumn("_i", F.least("_side", "_other")).withColumn("_j", F.greatest("_side", "_other"))
    rest = rest.select("_key", "_band", "_i", "_j", "_rep", "_fp", F.col("_comp.id").alias("_c_id"), F.col("_comp.fp").alias("_c_fp"), "_side").join(carried, ["_rep", "_fp"])

    def search(key, table):
        return _search_block(key, table, percent, count, width)

    more = checkpointed(rest.groupBy("_key", "_band", "_i", "_j").applyInArrow(search, "a long, a_fp long, b long, b_fp long").distinct())
    if more.limit(1).count():
        labels = components(labels.select("node.id", "node.fp", "label.id", "label.fp").toDF("a", "a_fp", "b", "b_fp").union(more))
    named = classes.join(labels, own == F.col("node"), "left").select("_f1", "_f2", F.coalesce("label", own).alias("_comp"))
    known = part.join(named, ["_f1", "_f2"]).select("doc_id", "_fp", "n_shingles", "_comp")
    alone = rows.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "_fp", "n_shingles", F.struct(F.col("doc_id").alias("id"), F.col("_fp").alias("fp")).alias("_comp"))
    return known.union(alone)


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of docs for each group of near_duplicates(): the one of the
    least doc_id and, where rows share it, of the least hash of its text.

    Defined cases: rows without words stay; rows of a null doc_id stay; rows
    equal in doc_id and text are copies, one of which stays, the least by its
    other columns as text (with words or without); rows that share a doc_id
    but not their texts stay or go each by its own group; an empty table
    gives an empty result; all columns pass through.
    """
    id_, fp, row = free_name(docs, "_id", "_of", "_row")
    groups = _grouped(docs.select("doc_id", "text"), percent).where("doc_id IS NOT NULL")
    is_head = (F.col("doc_id") == F.col("_comp.id")) & (F.col("_fp") == F.col("_comp.fp"))
    found = groups.groupBy("doc_id", "_fp").agg(F.count(F.lit(1)).alias("_n"), F.bool_or(is_head).alias("_head"))
    # Both sets are narrow; most rows of a corpus are in neither.
    gone = checkpointed(found.where("NOT _head").select(F.col("doc_id").alias(id_), F.col("_fp").alias(fp)))
    many = checkpointed(found.where("_head AND _n > 1").select(F.col("doc_id").alias(id_), F.col("_fp").alias(fp)))
    n_many = many.count()
    same = (F.col("doc_id") == F.col(id_)) & (F.xxhash64("text") == F.col(fp))
    left = docs.join(small(gone, gone.count()), same, "left_anti")
    if not n_many:
        return left
    single = left.join(small(many, n_many), same, "left_anti")
    rows = left.join(small(many, n_many), same, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = rows.groupBy("doc_id", F.xxhash64("text").alias(fp)).agg(F.min_by(whole, F.to_json(whole)).alias(row))
    return single.unionByName(kept.select(*[F.col(row)[c].alias(c) for c in docs.columns]))


SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS label FROM sets
  UNION
  SELECT l.b, r.label FROM reach r JOIN links l ON l.a = r.node AND r.label < l.b
), least AS (
  SELECT node, min(label) AS component_id FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least.component_id, s.doc_id = least.component_id AS kept
FROM sets s JOIN least ON least.node = s.doc_id
"""


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"))
