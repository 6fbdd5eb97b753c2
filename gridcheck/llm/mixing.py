"""Mixing sources to target weights, DataFrame operations only.

The words of each source, its documents in a pseudorandom order, are cut into
blocks of fixed length. Output shards draw a multinomial number of slots for
each source, a draw for every slot; the slots of a source are numbered through
all shards, and number i becomes the block perm(i mod blocks) of its source,
another permutation for each time round. So the draws decide how many blocks
of a source are taken; only a source whose draws in all end more than
TOLERANCE from its share, or over CAP times its blocks, is held at that limit:
its last slots stay empty, or shards are added. Blocks join slots by (source,
index), keys that are unique on one side and at most CAP-fold on the other,
however large a source is. Running positions come from sums in two levels, so
no task holds a source or all shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcheck.llm.common import WORD, checkpointed, free_name, small

BLOCK, SHARD, CAP = 64, 16_384, 3
WEIGHTS = (1, 2, 3)
#: Share of its slots by which the draws may take a source off its target.
TOLERANCE = 0.01
#: Shards whose draws are summed before they are numbered.
RUN = 1024
#: Primes above any number of blocks: each is a full-period multiplier for every modulus.
PRIMES = (2305843009213693951, 2305843009213693921, 2305843009213693907)
#: Intervals of slot numbers are looked up by this many equal buckets.
LOOKUP = 4096
LONG = "long"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast(LONG)


def doc_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")))))


def _before(partition: list[str], *order) -> Window:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(LONG))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """Of (source, source_size), one row per source: its number _sid in the
    order by code point, null last, its target, blocks and slots. Targets
    share the total by weight; those above cap times their source stop there
    and the excess goes round again, which is filling by water level: sources
    in the order of cap * size / weight are capped while the level that the
    rest would reach is above that ratio."""
    by_name = Window.partitionBy().orderBy(F.asc_nulls_last("source"))
    ratio = [F.col("_cap") / F.col("_w"), F.col("_sid")]
    total = F.sum("source_size").over(Window.partitionBy())
    rows = sizes.withColumn("_sid", (F.row_number().over(by_name) - 1).cast("int"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("_sid") % len(weights)).cast(LONG)
    rows = rows.withColumn("_w", weight).withColumn("_cap", (cap * F.col("source_size")).cast(LONG))
    rest = Window.partitionBy().orderBy(*ratio).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("_left", total - _zero(F.sum("_cap").over(_before([], *ratio)))).withColumn("_rest", F.sum("_w").over(rest))
    fits = F.col("_left").cast("decimal(38,0)") * F.col("_w") <= F.col("_cap").cast("decimal(38,0)") * F.col("_rest")
    # The first source that fits sets the level for all from there on.
    level = F.min(F.when(fits, F.struct(*ratio, "_left", "_rest"))).over(Window.partitionBy())
    capped = F.struct(*ratio) < F.struct(level["col1"], level["_sid"])
    target = F.when(capped, F.col("_cap").cast("double")).otherwise(
        level["_left"].cast("double") / level["_rest"].cast("double") * F.col("_w")
    )
    blocks = F.ceil(F.col("source_size") / F.lit(float(block))).cast(LONG)
    slots = F.floor(F.coalesce(F.try_divide(F.col("target") * F.col("_blocks"), F.col("source_size")), F.lit(0.0)) + 0.5).cast(LONG)
    return (
        rows.withColumn("target", F.coalesce(target, F.lit(0.0)))
        .withColumn("_blocks", blocks)
        .withColumn("_slots", F.least(slots, cap * F.col("_blocks")))
        .select("source", "_sid", "source_size", "target", "_blocks", "_slots")
    )


def permuted(i: Column, blocks: Column, sid: Column, wide: bool) -> Column:
    """The block of slot number i: i * prime + offset modulo blocks, prime and offset by source and time round."""
    turn = F.call_function("div", i, blocks)
    number = "decimal(38,0)" if wide else LONG
    n = blocks.cast(number)
    prime = F.get(F.array(*[F.lit(p) for p in PRIMES]), ((sid + turn) % len(PRIMES)).cast("int"))
    step = prime % blocks
    offset = ((sid + 1) * 7919 + turn * 104729) % blocks
    return ((i.cast(number) % n * step.cast(number) + offset) % n).cast(LONG)


def drawn_slots(spark, sources: DataFrame, n_sources: int, total: int, shard: int = SHARD, seed: int = 0) -> DataFrame:
    """(_shard, _sid, _n): the multinomial counts of every output shard; slot
    number s draws a place among all shares, from a hash of s and the seed."""
    width = max(1, -(-total // LOOKUP))
    ends = Window.partitionBy().orderBy("_sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sources.where("_slots > 0").withColumn("_hi", F.sum("_slots").over(ends)).withColumn("_lo", F.col("_hi") - F.col("_slots"))
    first, last = F.expr(f"_lo div {width}L"), F.expr(f"(_hi - 1) div {width}L")
    looked = spans.select("_sid", "_lo", "_hi", F.explode(F.sequence(first, last)).alias("_at"))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))), 1, 15), 16, 10).cast(LONG)
    return (
        spark.range(total)
        .select(F.expr(f"id div {shard}L").alias("_shard"), F.pmod(draw, F.lit(total)).alias("_u"))
        .withColumn("_at", F.expr(f"_u div {width}L"))
        .join(small(looked, n_sources + LOOKUP), "_at")
        .where("_u >= _lo AND _u < _hi")
        .groupBy("_shard", "_sid")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def shard_slots(spark, sources: DataFrame, n_sources: int, total: int, shard: int = SHARD, seed: int = 0) -> DataFrame:
    """(_shard, _slot, _sid, _i): the slots of every output shard, in a
    pseudorandom order, and the number of each within its source."""
    drawn = drawn_slots(spark, sources, n_sources, total, shard, seed).withColumn("_run", F.expr(f"_shard div {RUN}L"))
    runs = drawn.groupBy("_sid", "_run").agg(F.sum("_n").alias("_r"))
    runs = runs.withColumn("_ahead", _zero(F.sum("_r").over(_before(["_sid"], "_run")))).drop("_r")
    inside = _zero(F.sum("_n").over(_before(["_sid", "_run"], "_shard")))
    numbered = drawn.withColumn("_inside", inside).join(runs, ["_sid", "_run"])
    slack = F.floor(F.col("_slots") * TOLERANCE).cast(LONG)
    limits = sources.select("_sid", (F.col("_slots") - slack).alias("_least"), F.least(F.col("_slots") + slack, CAP * F.col("_blocks")).alias("_most"))
    owned = numbered.select("_shard", "_sid", "_n", (F.col("_ahead") + F.col("_inside")).alias("_from")).join(small(limits, n_sources), "_sid")
    owned = owned.select("_shard", "_sid", "_from", F.least("_n", F.col("_most") - F.col("_from")).alias("_n")).where("_n > 0")
    got = drawn.groupBy("_sid").agg(F.sum("_n").alias("_got"))
    short = limits.join(got, "_sid", "left").withColumn("_got", _zero(F.col("_got"))).where("_got < _least")
    short = short.withColumn("_from", F.explode(F.expr(f"sequence(_got, _least - 1, {shard}L)")))
    added = F.expr(f"{-(-total // shard)}L + (_from - _got) div {shard}L").alias("_shard")
    short = short.select(added, "_sid", "_from", F.least(F.lit(shard).cast(LONG), F.col("_least") - F.col("_from")).alias("_n"))
    counts = owned.unionByName(short)
    # A shard has at most a row for each source.
    counts = counts.withColumn("_start", _zero(F.sum("_n").over(_before(["_shard"], "_sid"))))
    counts = counts.withColumn("_size", F.sum("_n").over(Window.partitionBy("_shard")))
    slots = counts.select("_shard", "_sid", "_from", "_start", "_size", F.explode(F.expr("sequence(0L, _n - 1)")).alias("_k"))
    place = F.expr(f"((_start + _k) * {PRIMES[0]}BD + _shard) % _size").cast(LONG)
    return slots.select("_shard", place.alias("_slot"), "_sid", (F.col("_from") + F.col("_k")).alias("_i"))


def mix(
    docs: DataFrame, block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 0, spans: bool = False
) -> DataFrame:
    """One row per row of docs: doc_id, source, _key, size, source_size,
    target, taken and, with spans, the array taken_spans of (turn, first,
    last, shard, slot): the words, counted from 0, that each time round takes,
    and the slot of an output shard to which they go.

    size counts the words of the whole text. taken is what the draws of all
    shards give: for a source within TOLERANCE, and about a block, of target,
    at most cap times size for each document. It depends on nothing but the
    rows and the seed.

    Defined cases: a null or wordless text has size 0 and takes nothing; null
    is a source of its own, last in order; an all-empty table has targets 0;
    rows equal in doc_id and text are documents of their own, in any order;
    other columns are ignored.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", doc_key(F.col("doc_id"), F.col("text")).alias("_key"), n_words(F.col("text")).alias("size"))
    sized = checkpointed(sized.withColumn("_bucket", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")))
    sizes = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_n")).groupBy("source").agg(F.sum("_n").alias("source_size"))
    sources = checkpointed(targets(sizes, weights, cap, block))
    totals = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("_slots"), F.lit(0)), F.coalesce(F.max("_blocks"), F.lit(0))).first()
    n_sources, total, wide = totals[0], totals[1], totals[2] >= 2**31
    few = small(sources.withColumnRenamed("source", "_source"), n_sources)
    named = sized.join(few, sized["source"].eqNullSafe(few["_source"])).drop("_source")
    ahead = named.groupBy("_sid", "_bucket").agg(F.sum("size").alias("_n"))
    ahead = ahead.withColumn("_ahead", _zero(F.sum("_n").over(_before(["_sid"], "_bucket")))).drop("_n")
    inside = _zero(F.sum("size").over(_before(["_sid", "_bucket"], "_key", "doc_id")))
    placed = named.withColumn("_inside", inside).join(ahead, ["_sid", "_bucket"])
    # A start is unique within its source among documents that have words.
    placed = placed.withColumn("_start", F.when(F.col("size") > 0, F.col("_ahead") + F.col("_inside")))
    pieces = placed.where("size > 0").select(
        "_sid", "_start", "size", F.explode(F.expr(f"sequence(_start div {block}, (_start + size - 1) div {block})")).alias("_block")
    )
    first = F.greatest(F.lit(0).cast(LONG), F.col("_block") * block - F.col("_start"))
    last = F.least(F.col("size"), (F.col("_block") + 1) * block - F.col("_start"))
    pieces = pieces.select("_sid", "_start", "_block", first.cast("int").alias("_first"), last.cast("int").alias("_last"))
    slots = shard_slots(spark, sources, n_sources, total, shard, seed).join(small(sources.select("_sid", "_blocks"), n_sources), "_sid")
    index = permuted(F.col("_i"), F.col("_blocks"), F.col("_sid"), wide).alias("_block")
    place = [F.expr("int(_i div _blocks)").alias("turn"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot")] if spans else []
    used = pieces.join(slots.select("_sid", index, *place), ["_sid", "_block"])
    found = [F.sum(F.col("_last") - F.col("_first")).alias("_taken")]
    if spans:
        span = F.struct("turn", F.col("_first").alias("first"), F.col("_last").alias("last"), "shard", "slot")
        found.append(F.array_sort(F.collect_list(span)).alias("taken_spans"))
    taken = used.groupBy("_sid", "_start").agg(*found)
    out = placed.join(taken, ["_sid", "_start"], "left")
    more = ["taken_spans"] if spans else []
    return out.select("doc_id", "source", "_key", "size", "source_size", "target", _zero(F.col("_taken")).alias("taken"), *more)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them: a row per document and time round, with
    the columns of docs, whose text is the taken words with the white space
    before them and whose n_chars, if there is such a column, is its length.

    Defined cases: those of mix(); a document of which nothing is taken, as
    one without words, is left out; rows equal in doc_id, source and text are
    documents of their own, told apart by a hash of their other columns; an
    empty table gives an empty result; all other columns pass through.
    """
    key, id_, of, spans, mine, nth, turn, words = free_name(docs, "_key", "_id", "_of", "_spans", "_mine", "_nth", "_turn", "_words")
    plan = mix(docs.select("doc_id", "source", "text"), spans=True, **options).where("taken > 0")
    plan = plan.select(F.col("doc_id").alias(id_), F.col("_key").alias(f"{key}_2"), F.col("source").alias(of), F.col("taken_spans").alias(spans))
    # Rows equal in id, source and text share their plans: the nth row takes the nth plan.
    plan = plan.withColumn(nth, F.row_number().over(Window.partitionBy(id_, f"{key}_2", of).orderBy(spans)))
    left = docs.withColumn(key, doc_key(F.col("doc_id"), F.col("text")))
    others = F.xxhash64(F.lit(0), *[F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns if c not in ("doc_id", "source", "text")])
    left = left.withColumn(mine, F.row_number().over(Window.partitionBy("doc_id", key, "source").orderBy(others)))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(f"{key}_2")) & F.col("source").eqNullSafe(F.col(of)) & (F.col(mine) == F.col(nth))
    rows = left.join(plan, same)
    rows = rows.withColumn(words, F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.withColumn(turn, F.explode(F.array_distinct(F.transform(spans, lambda s: s["turn"]))))
    taken = F.filter(spans, lambda s: s["turn"] == F.col(turn))
    text = F.array_join(F.flatten(F.transform(taken, lambda s: F.slice(words, s["first"] + 1, s["last"] - s["first"]))), "")
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), '-'), md5(coalesce(text, '')))) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, sid % 3 + 1 AS w, 3 * source_size AS cap, 3 * source_size / (sid % 3 + 1) AS ratio FROM named
), filled AS (
  SELECT *, CAST((SELECT sum(source_size) FROM named) - coalesce(sum(cap) OVER (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lft,
         CAST(sum(w) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM weighed
), level AS (
  SELECT ratio, sid, lft, rest FROM filled WHERE CAST(lft AS HUGEINT) * w <= CAST(cap AS HUGEINT) * rest ORDER BY ratio, sid LIMIT 1
), aimed AS (
  SELECT f.*, CASE WHEN f.ratio < l.ratio OR (f.ratio = l.ratio AND f.sid < l.sid) THEN CAST(cap AS DOUBLE)
              ELSE CAST(l.lft AS DOUBLE) / CAST(l.rest AS DOUBLE) * w END AS target,
         CAST(ceil(source_size / {float(BLOCK)}) AS BIGINT) AS blocks
  FROM filled f, level l
), sources AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(CAST(floor(target * blocks / source_size + 0.5) AS BIGINT), 3 * blocks) END AS slots FROM aimed
), spans AS (
  SELECT sid, CAST(sum(slots) OVER (ORDER BY sid) AS BIGINT) AS hi, CAST(sum(slots) OVER (ORDER BY sid) - slots AS BIGINT) AS lo FROM sources WHERE slots > 0
), draws AS (
  SELECT CAST('0x' || substr(md5('0:' || CAST(s AS VARCHAR)), 1, 15) AS BIGINT) % total AS u
  FROM (SELECT unnest(range(total)) AS s, total FROM (SELECT CAST(sum(slots) AS BIGINT) AS total FROM sources))
), drawn AS (
  SELECT sid, count(*) AS n FROM draws JOIN spans ON u >= lo AND u < hi GROUP BY sid
), held AS (
  SELECT s.sid, s.blocks, greatest(s.slots - CAST(floor(s.slots * {TOLERANCE}) AS BIGINT),
         least(coalesce(d.n, 0), s.slots + CAST(floor(s.slots * {TOLERANCE}) AS BIGINT), 3 * s.blocks)) AS taken
  FROM sources s LEFT JOIN drawn d ON d.sid = s.sid
), numbers AS (
  SELECT sid, blocks, unnest(range(taken)) AS i FROM held
), used AS (
  SELECT sid, (i % blocks * ([{', '.join(map(str, PRIMES))}][1 + (sid + i // blocks) % 3] % blocks)
          + ((sid + 1) * 7919 + i // blocks * 104729) % blocks) % blocks AS block, count(*) AS uses
  FROM numbers GROUP BY ALL
), placed AS (
  SELECT d.doc_id, d.size, s.sid, s.source_size, s.target,
         CAST(sum(d.size) OVER (PARTITION BY s.sid ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), pieces AS (
  SELECT *, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM placed WHERE size > 0
), taken AS (
  SELECT p.sid, p.start, CAST(sum((least(p.size, (p.block + 1) * {BLOCK} - p.start) - greatest(0, p.block * {BLOCK} - p.start)) * u.uses) AS BIGINT) AS taken
  FROM pieces p JOIN used u ON u.sid = p.sid AND u.block = p.block GROUP BY ALL
)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(CASE WHEN p.size > 0 THEN t.taken END, 0) AS taken
FROM placed p LEFT JOIN taken t ON t.sid = p.sid AND t.start = p.start
"""
