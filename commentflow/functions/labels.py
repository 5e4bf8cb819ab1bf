"""Label parsing, naming and model-message expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentflow.functions.text import SPACE_CLASS, strip_space
from commentflow.schema import LABEL_ROWS, UNKNOWN_LABEL_NAME, UNLABELLED

# ---- fixed values -------------------------------------------------------------------------
LABEL_TAG = rf"\[LABEL:[{SPACE_CLASS}]*([012])\]"
USER_MESSAGE = ("Bình luận: '", "'")
SEQ2SEQ_TASK = "hate-speech-detection"
# ---- end of fixed values ------------------------------------------------------------------


def label_name(label: Column) -> Column:
    """Display name of a label; anything unknown, null included, gets the fallback name."""
    known = [F.when(label == value, F.lit(name)) for value, name, *_ in LABEL_ROWS]
    return F.coalesce(*known, F.lit(UNKNOWN_LABEL_NAME))


def registry_label_name(label: Column) -> Column:
    """Name of a class as the model registry spells it, null for anything that is no class."""
    return F.coalesce(*[F.when(label == row[0], F.lit(row[4])) for row in LABEL_ROWS if row[4]])


def parse_llm_label(raw: Column) -> Column:
    """Last ``[LABEL: d]`` of a model answer, else its last digit 0, 1 or 2, else -1."""
    tagged = F.try_element_at(F.regexp_extract_all(raw, F.lit(LABEL_TAG), F.lit(1)), F.lit(-1))
    loose = F.nullif(F.regexp_extract(raw, r"(?s)^.*([012])", 1), F.lit(""))
    return F.coalesce(F.coalesce(tagged, loose).cast("int"), F.lit(UNLABELLED))


def unparsed_to_clean(label: Column) -> Column:
    return F.when(label == UNLABELLED, F.lit(0)).otherwise(label)


def map_text_label(name: Column) -> Column:
    """Class number of a textual model answer."""
    upper = F.upper(strip_space(name))
    offensive = upper.contains("OFFENSIVE")
    return (
        F.when(upper.contains("HATE") & ~offensive, 2)
        .when(offensive | upper.contains("OFF"), 1)
        .otherwise(0)
    )


def flag_target(label: Column) -> Column:
    """True when the predicted class is one that moderation acts on."""
    return label.isin(1, 2)


def argmax_label(scores: Column) -> Column:
    """Index of the largest score; the lowest index wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def build_prompt(text: Column, system: str, around: tuple[str, str] = USER_MESSAGE) -> Column:
    """System and user messages of a chat model as an array of (role, content)."""
    user = F.concat(F.lit(around[0]), text, F.lit(around[1]))
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def seq2seq_prompt(text: Column, prefix: str = SEQ2SEQ_TASK) -> Column:
    return F.concat(F.lit(f"{prefix}: "), text)


def hard_vote(first: Column, second: Column, third: Column) -> Column:
    """Majority of three; the first voter decides when all three differ. A missing vote is a vote too."""
    return F.when(second.eqNullSafe(third), second).otherwise(first)
