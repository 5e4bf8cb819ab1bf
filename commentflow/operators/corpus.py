"""Pre-training corpus preparation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions.text import tokens
from commentflow.operators.ranking import with_rank
from commentflow.operators.sampling import train_test_split

# ---- fixed values -------------------------------------------------------------------------
MAX_LENGTH = 256
BATCH_ROWS = 1000
# ---- end of fixed values ------------------------------------------------------------------

Tokenizer = Callable[[Column], Column]


def tokenize_truncate(
    df: DataFrame, text_col: str = "text", max_len: int = MAX_LENGTH, tokenizer: Tokenizer = tokens
) -> DataFrame:
    """Add the first ``max_len`` tokens of each text and their number."""
    cut = F.slice(tokenizer(F.col(text_col)), 1, max_len)
    return df.withColumn("tokens", cut).withColumn("token_count", F.size("tokens"))


def pack_chunks(
    df: DataFrame, text_col: str = "text", max_len: int = MAX_LENGTH, batch_rows: int = BATCH_ROWS,
    order_by: str = "id", tokenizer: Tokenizer = tokens,
) -> DataFrame:
    """Fixed-size token blocks: the tokens of each batch of rows are joined and cut, the rest dropped.

    A batch holds ``batch_rows`` consecutive rows. The sum of the token counts before a row, inside its batch, tells
    which blocks its tokens belong to, so rows are cut where they are and no more than a block is ever put together.
    """
    short = tokenize_truncate(df.filter(F.col(text_col).isNotNull()), text_col, max_len, tokenizer)
    ranked = with_rank(short.select(order_by, "tokens"), (), order_by, out="_rank")
    before = Window.partitionBy("batch").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranked.withColumn("batch", F.floor(F.col("_rank") / batch_rows))
        .withColumn("_at", F.coalesce(F.sum(F.size("tokens")).over(before), F.lit(0)))
        .withColumn("_end", F.col("_at") + F.size("tokens"))
        .filter("_end > _at")
    )

    def piece(block: Column) -> Column:
        start, end = F.greatest(F.col("_at"), block * max_len), F.least(F.col("_end"), (block + 1) * max_len)
        return F.struct(
            block.cast("int").alias("block"), start.alias("start"),
            F.slice("tokens", (start - F.col("_at") + 1).cast("int"), (end - start).cast("int")).alias("part"))

    blocks = F.sequence(F.floor(F.col("_at") / max_len), F.floor((F.col("_end") - 1) / max_len))
    pieces = placed.select("batch", F.inline(F.transform(blocks, piece)))
    ordered = F.array_sort(F.collect_list(F.struct("start", "part")))
    joined = pieces.groupBy("batch", "block").agg(F.flatten(F.transform(ordered, lambda p: p["part"])).alias("tokens"))
    return joined.filter(F.size("tokens") == max_len)


def corpus_stats(
    df: DataFrame, text_col: str = "text", max_len: int = MAX_LENGTH, batch_rows: int = BATCH_ROWS,
    order_by: str = "id", test_percent: int = 1,
) -> DataFrame:
    """Rows, tokens, blocks and split sizes of a corpus in one row.

    Blocks need only the token total of each batch, so no token leaves its row here.
    """
    short = tokenize_truncate(df.filter(F.col(text_col).isNotNull()), text_col, max_len)
    sized = train_test_split(short.select(order_by, "token_count"), test_percent, order_by)
    ranked = with_rank(sized, (), order_by, out="_rank")
    batches = ranked.groupBy(F.floor(F.col("_rank") / batch_rows).alias("batch")).agg(
        F.count("*").alias("rows"), F.sum("token_count").alias("tokens"),
        F.count_if(F.col("split_set") == "test").alias("test_rows"),
    )
    return batches.agg(
        F.sum("rows").alias("samples"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.floor(F.col("tokens") / max_len)).alias("chunks"),
        F.sum(F.col("rows") - F.col("test_rows")).alias("train_rows"),
        F.sum("test_rows").alias("test_rows"),
    )
