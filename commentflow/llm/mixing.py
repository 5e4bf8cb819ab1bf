"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target number of words. Its documents, permuted by a seeded hash, form blocks; a target
becomes whole copies of the source, then whole blocks of one more copy, then the documents of one cut block.
These block quotas are split among the output shards by a binary tree: at each node a uniformly random half of
the node's blocks goes left, so the counts by source follow the multivariate hypergeometric law and stay exact.
Each shard then draws its count of every source from the source's permuted blocks, disjointly, and orders its
rows by a seeded hash.

Only tables with a row for each source, or a fixed number of rows for each source, pass through a window. The
documents are joined with these by source and block and are never grouped.

Edge cases: a null or empty text has size 0, its target share is none and its copies count no words; null is a
source of its own, after all others; documents with equal ids take the same place in the permutation and are
drawn together; other columns of the input pass through ``mix`` untouched, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.llm.tables import fresh, stored, text_words

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SHARDS = 32
SEED = 17
#: Bits of the 60-bit place of a document: blocks of a source, then cells of the block that is cut.
PLACE_BITS, BLOCK_BITS, CELL_BITS = 60, 6, 14
BLOCKS = 1 << BLOCK_BITS
_BLOCK_SPAN = 1 << (PLACE_BITS - BLOCK_BITS)
_CELL_SPAN = 1 << (PLACE_BITS - BLOCK_BITS - CELL_BITS)


def _hash60(*parts: Column) -> Column:
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _place(doc_id: Column, seed: int) -> Column:
    return _hash60(F.lit(seed), doc_id)


def _size(text: Column) -> Column:
    return F.size(text_words(text)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn. The targets share all sizes by weight; a
    target stops at ``max_copies`` times its source and the excess goes to the others by weight. A source is
    capped exactly when filling all sources up to its own level would take fewer words than there are."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    unit = F.array(*[F.lit(w) for w in weights])
    weighed = per.withColumn("_w", F.get(unit, (F.row_number().over(listed) - 1) % len(weights)).cast("bigint"))
    level = Window.orderBy((F.col("source_size") / F.col("_w")), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    filled = weighed.select(
        "source", "source_size", "_w",
        F.sum("source_size").over(every).alias("_total"),
        F.sum("source_size").over(level.rowsBetween(Window.unboundedPreceding, 0)).alias("_below"),
        F.sum("_w").over(level.rowsBetween(1, Window.unboundedFollowing)).alias("_above"),
    )
    capped = (
        max_copies * F.col("_below") * F.col("_w") + max_copies * F.col("source_size") * F.coalesce("_above", F.lit(0))
        < F.col("_total") * F.col("_w")
    )
    split = filled.withColumn("_capped", capped)
    left = F.col("_total") - max_copies * F.coalesce(F.sum(F.when(F.col("_capped"), F.col("source_size"))).over(every), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(every)
    return split.select(
        "source", "source_size",
        F.when(F.col("_capped"), (max_copies * F.col("source_size")).cast("double"))
        .otherwise((left * F.col("_w")).cast("double") / open_weight.cast("double")).alias("target"),
    )


def _cuts(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """source, _cut: the last place that the extra copy of the source takes, -1 for none.

    Running sums over blocks find the block that holds the boundary, running sums over its cells the cell, and
    running sums over the documents of that one cell the place."""
    need = plan.where("_rest > 0").select(F.col("source").alias("_s"), "_rest")

    def boundary(rows: DataFrame, span: int, found: DataFrame) -> DataFrame:
        """First slot of each source at which the running sum passes the rest."""
        slots = rows.groupBy("source", F.expr(f"place div {span}L").alias("_slot")).agg(F.sum("size").alias("_n"))
        run = Window.partitionBy("source").orderBy("_slot")
        sums = slots.withColumn("_sum", F.sum("_n").over(run))
        over = sums.join(found, F.col("source").eqNullSafe(F.col("_s"))).where("_before + _sum > _rest")
        first = Window.partitionBy("source").orderBy("_slot")
        return over.withColumn("_k", F.row_number().over(first)).where("_k = 1").select(
            F.col("source").alias("_s"), "_rest", (F.col("_before") + F.col("_sum") - F.col("_n")).alias("_before"), "_slot")

    start = need.withColumn("_before", F.lit(0).cast("bigint"))
    block = stored(boundary(sizes, _BLOCK_SPAN, start), "mix-block")
    inside = sizes.join(
        block.select(F.col("_s").alias("_b"), F.col("_slot").alias("_bslot")),
        F.col("source").eqNullSafe(F.col("_b")) & (F.expr(f"place div {_BLOCK_SPAN}L") == F.col("_bslot"))).select("source", "size", "place")
    cell = stored(boundary(inside, _CELL_SPAN, block.drop("_slot")), "mix-cell")
    last = sizes.join(
        cell.withColumnRenamed("_slot", "_cell"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.expr(f"place div {_CELL_SPAN}L") == F.col("_cell")))
    tied = last.groupBy("source", "place", "_rest", "_before").agg(F.sum("size").alias("_n"))
    run = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    taken = tied.withColumn("_sum", F.col("_before") + F.sum("_n").over(run)).where("2 * _sum - _n <= 2 * _rest")
    inner = taken.groupBy(F.col("source").alias("_t")).agg(F.max("place").alias("_last"))
    return cell.join(inner, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
        F.col("_s").alias("_c"), F.coalesce("_last", F.col("_slot") * F.lit(_CELL_SPAN) - 1).alias("_cut"))


def _shares(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """source, block, draws: for each block of a source the (copy, shard) pairs it goes to.

    ``plan`` has the copies and the cut of each source. The number of shards is rounded up to a power of two."""
    last = F.when(F.col("_cut") < 0, F.lit(0)).otherwise(F.expr(f"_cut div {_BLOCK_SPAN}L") + 1)
    quota = (F.col("_copies") * BLOCKS + last).cast("int")
    balls = plan.select("source", F.explode(F.sequence(F.lit(0), quota - 1)).alias("_ball"), quota.alias("_quota")).where("_quota > 0")
    depth = max(0, (shards - 1).bit_length())
    nodes = balls.withColumn("_node", F.lit(0))
    for level in range(depth):
        node = Window.partitionBy("_node")
        order = node.orderBy(_hash60(F.lit(seed), F.lit(f"node{level}"), F.col("source"), F.col("_ball")), "source", "_ball")
        nodes = nodes.withColumn("_left", (2 * F.row_number().over(order) <= F.count("*").over(node)).cast("int"))
        nodes = nodes.withColumn("_node", 2 * F.col("_node") + 1 - F.col("_left")).drop("_left")
    quotas = nodes.groupBy("source", "_node").count()
    by_source = Window.partitionBy("source").orderBy("_node")
    spans = quotas.select(
        F.col("source").alias("_s"), "_node", F.sum("count").over(by_source).alias("_to"), "count")
    drawn = balls.select(
        "source", (F.col("_ball") / BLOCKS).cast("int").alias("_copy"), (F.col("_ball") % BLOCKS).alias("_block"),
        (F.row_number().over(Window.partitionBy("source").orderBy(
            _hash60(F.lit(seed), F.lit("draw"), F.col("source"), F.col("_ball")), "_ball")) - 1).alias("_turn"))
    placed = drawn.join(
        spans,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("_turn") < F.col("_to")) & (F.col("_turn") >= F.col("_to") - F.col("count")))
    return placed.groupBy(F.col("source").alias("_s"), "_block").agg(
        F.sort_array(F.collect_list(F.struct("_copy", F.col("_node").alias("_shard")))).alias("_draws"))


def drawn(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS,
          max_copies: int = MAX_COPIES) -> tuple[DataFrame, dict[str, str]]:
    """The input with size, source_size, target and draws, an array of (_copy, _shard); and the names of these columns."""
    size, place, block, draws, source_size, target, s1, s2, cut, copies = fresh(
        docs, "size", "place", "block", "draws", "source_size", "target", "s1", "s2", "cut", "copies")
    sizes = stored(
        docs.select("source", _size(F.col("text")).alias("size"), _place(F.col("doc_id"), seed).alias("place")), "mix-sizes")
    plan = targets(sizes, weights, max_copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = stored(plan.withColumn("_copies", whole).withColumn(
        "_rest", F.col("target") - F.col("_copies") * F.col("source_size")), "mix-plan")
    cuts = _cuts(sizes, plan)
    plan = stored(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").withColumn("_cut", F.coalesce("_cut", F.lit(-1).cast("bigint")))
        .select("source", "source_size", "target", "_copies", "_cut"), "mix-cuts")
    shares = _shares(plan, shards, seed)
    per_block = plan.select(
        "source", "source_size", "target", "_copies", "_cut", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("_b"))
    table = stored(per_block.join(
        shares, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_block")), "left").select(
            F.col("source").alias(s1), F.col("_b").alias(s2), F.col("source_size").alias(source_size), F.col("target").alias(target),
            F.col("_copies").alias(copies), F.col("_cut").alias(cut), F.col("_draws").alias(draws)), "mix-blocks")
    placed = docs.withColumn(size, _size(F.col("text"))).withColumn(place, _place(F.col("doc_id"), seed))
    placed = placed.withColumn(block, F.expr(f"cast({place} div {_BLOCK_SPAN}L as int)"))
    joined = placed.join(table, F.col("source").eqNullSafe(F.col(s1)) & (F.col(block) == F.col(s2)), "left")
    kept = F.filter(
        F.coalesce(F.col(draws), F.expr("cast(array() as array<struct<_copy: int, _shard: int>>)")),
        lambda d: (d["_copy"] < F.col(copies)) | (F.col(place) <= F.col(cut)))
    out = joined.withColumn(draws, kept).drop(s1, s2, block, cut, copies)
    return out, {"size": size, "source_size": source_size, "target": target, "draws": draws, "place": place}


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS,
        max_copies: int = MAX_COPIES) -> DataFrame:
    """The mixed rows with the input's columns, dealt to the shards and shuffled inside each."""
    table, names = drawn(docs, shards, seed, weights, max_copies)
    one, order = fresh(table, "one", "order")
    rows = table.withColumn(one, F.explode(names["draws"]))
    rows = rows.withColumn(order, _hash60(F.lit(seed), F.lit("order"), F.col(f"{one}._copy"), F.col("doc_id")))
    dealt = rows.repartition(1 << max(0, (shards - 1).bit_length()), F.col(f"{one}._shard"))
    return dealt.sortWithinPartitions(f"{one}._shard", order).select(*docs.columns)


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """For each document its size, its source's size and target, and the words that the mix takes of it."""
    table, n = drawn(docs.select("doc_id", "source", "text"), seed=seed)
    return table.select(
        "doc_id", F.col(n["size"]).alias("size"), F.col(n["source_size"]).alias("source_size"), F.col(n["target"]).alias("target"),
        (F.col(n["size"]) * F.size(n["draws"])).alias("taken"))


SQL = f"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
         cast(concat('0x', substr(md5(concat('{SEED}|', coalesce(cast(doc_id as varchar), ''))), 1, 15)) as bigint) as place
  from documents
), per as (
  select source, cast(sum(size) as bigint) as source_size,
         (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1 as w
  from d group by source
), filled as (
  select *, sum(source_size) over () as total,
         sum(source_size) over (order by source_size / w, source nulls last rows between unbounded preceding and current row) as below,
         coalesce(sum(w) over (order by source_size / w, source nulls last rows between 1 following and unbounded following), 0) as above
  from per
), capped as (
  select *, {MAX_COPIES} * below * w + {MAX_COPIES} * source_size * above < total * w as is_capped from filled
), aimed as (
  select source, source_size,
         case when is_capped then cast({MAX_COPIES} * source_size as double)
              else cast((total - {MAX_COPIES} * coalesce(sum(source_size) filter (where is_capped) over (), 0)) * w as double)
                   / cast(sum(w) filter (where not is_capped) over () as double) end as target
  from capped
), planned as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as copies from aimed
), tied as (
  select source, place, sum(size) as n from d group by source, place
), run as (
  select source, place, n, sum(n) over (partition by source order by place) as upto from tied
)
select d.doc_id, d.size, p.source_size, p.target,
       cast(d.size * (p.copies + case when p.target - p.copies * p.source_size > 0
            and 2 * r.upto - r.n <= 2 * (p.target - p.copies * p.source_size) then 1 else 0 end) as bigint) as taken
from d join planned p on d.source is not distinct from p.source
join run r on r.source is not distinct from d.source and r.place = d.place"""
